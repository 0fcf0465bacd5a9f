"""Shared types and fixed names."""

from __future__ import annotations

ARGS = "array<struct<key:string,value:string>>"
CALL = f"struct<name:string,arguments:{ARGS}>"
MESSAGE = f"struct<role:string,content:string,tool_calls:array<{CALL}>>"
MESSAGES = f"array<{MESSAGE}>"

JUDGE_CRITERIA = ("accuracy", "relevance", "tone")
