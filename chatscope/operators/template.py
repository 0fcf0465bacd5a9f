"""Chat template rendering.

Messages are ``ARRAY<STRUCT<role, content, tool_calls ARRAY<STRUCT<name,
arguments ARRAY<STRUCT<key, value>>>>>>`` (see ``schemas.MESSAGE``). The
template is a set of marker strings; rendering is ``transform`` +
``array_join`` inside the JVM, so it fuses into one codegen stage with the
scan. The shared prefix is rendered once and reused for the full text and the
prompt.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatscope.functions.text import col_of, py_strip
from chatscope.schemas import CALL


@dataclass(frozen=True)
class ChatTemplate:
    """Marker strings of a turn-based chat template.

    Default: ``<start_of_turn>{role}\\n{text}<end_of_turn>\\n`` with the
    assistant role written as ``model``; tool declarations go into one leading
    ``developer`` turn; tool calls use the call-marker format the extractor reads.
    """

    turn_open: str = "<start_of_turn>"
    turn_close: str = "<end_of_turn>\n"
    role_names: tuple = (("assistant", "model"),)
    generation_role: str = "model"
    tools_open: str = "<start_of_turn>developer\n<tools>"
    tools_close: str = "</tools><end_of_turn>\n"
    call_open: str = "<start_function_call>call:"
    call_close: str = "<end_function_call>"
    escape: str = "<escape>"

    def role(self, r: Column) -> Column:
        out = r
        for src, dst in self.role_names:
            out = F.when(r == src, F.lit(dst)).otherwise(out)
        return out

    @property
    def generation_header(self) -> str:
        return f"{self.turn_open}{self.generation_role}\n"


DEFAULT_TEMPLATE = ChatTemplate()


def render_call(call: Column, t: ChatTemplate = DEFAULT_TEMPLATE) -> Column:
    """``call:NAME{k:<escape>v<escape>,...}`` with keys in sorted order."""
    args = F.array_join(
        F.transform(F.array_sort(F.coalesce(call["arguments"], F.array())),
                    lambda kv: F.concat(kv["key"], F.lit(":" + t.escape), F.coalesce(kv["value"], F.lit("")), F.lit(t.escape))),
        ",",
    )
    return F.concat(F.lit(t.call_open), F.coalesce(call["name"], F.lit("")), F.lit("{"), args, F.lit("}" + t.call_close))


def render_message(m: Column, t: ChatTemplate = DEFAULT_TEMPLATE) -> Column:
    """One turn; a missing role or name renders as empty, so no message is ever left out."""
    calls = F.array_join(F.transform(F.coalesce(m["tool_calls"], F.array()), lambda c: render_call(c, t)), "")
    return F.concat(F.lit(t.turn_open), F.coalesce(t.role(m["role"]), F.lit("")), F.lit("\n"),
                    F.coalesce(m["content"], F.lit("")), calls, F.lit(t.turn_close))


def render_messages(messages: Column, t: ChatTemplate = DEFAULT_TEMPLATE) -> Column:
    return F.array_join(F.transform(messages, lambda m: render_message(m, t)), "")


def render_tools(tools_json: Column | None, t: ChatTemplate = DEFAULT_TEMPLATE) -> Column:
    if tools_json is None:
        return F.lit("")
    return F.when(tools_json.isNull() | (tools_json == "[]"), F.lit("")).otherwise(
        F.concat(F.lit(t.tools_open), tools_json, F.lit(t.tools_close)))


def with_rendered(df: DataFrame, messages: str = "messages", tools_json: str | None = None,
                  t: ChatTemplate = DEFAULT_TEMPLATE) -> DataFrame:
    """Add ``full`` (D5), ``prompt`` (D6), ``completion`` and ``prefix_ok``.

    ``completion`` is ``full[len(prompt):]`` as in the reference (an offset, not
    a prefix check); ``prefix_ok`` says whether ``prompt`` really is a prefix of
    ``full`` and ``last_role`` is the role of the final message, so callers can
    route shifted completions to quarantine.
    """
    msgs = F.col(messages)
    n = F.size(msgs)
    pre = render_tools(F.col(tools_json) if tools_json else None, t)
    head = F.concat(pre, render_messages(F.slice(msgs, 1, F.greatest(n - 1, F.lit(0))), t))
    last = F.when(n > 0, render_message(F.element_at(msgs, n), t)).otherwise(F.lit(""))
    out = (df.withColumn("_head", head)
             .withColumn("full", F.concat(F.col("_head"), last))
             .withColumn("prompt", F.concat(F.col("_head"), F.lit(t.generation_header)))
             .withColumn("completion", F.expr("substring(full, length(prompt) + 1)"))
             .withColumn("prefix_ok", F.startswith(F.col("full"), F.col("prompt")))
             .withColumn("last_role", F.when(n > 0, F.element_at(msgs, n)["role"]))
             .drop("_head"))
    return out


def strip_prompt_prefix(generated: Column | str, prompt: Column | str) -> Column:
    """``generated[len(prompt):].strip()`` (offset cut, then Python strip)."""
    g, p = col_of(generated), col_of(prompt)
    return py_strip(F.substring(g, F.length(p) + 1, F.lit(2147483647)))


# The developer-turn texts of the reference's ad-hoc evaluation.
DEVELOPER_CLOCK_INTRO = "You are a model that can do function calling with the following functions. \n    "
CLOCK_FORMAT_INTRO = "Current date and time given in YYYY-MM-DDTHH:MM:SS format: "
CLOCK_DAY = ".\n    Day of week is "
DEVELOPER_FIXED = ("Current date and time given in YYYY-MM-DDTHH:MM:SS format: 2024-11-15T05:59:00. "
                   "You are a model that can do function calling with the following functions")


def time_context(ts: Column | str, zone: str = "America/Toronto", std: str = "EST", dst: str = "EDT") -> Column:
    """The developer turn with a clock line, from an event-time column (never the wall clock).

    ``ts`` is a UTC wall time (``timestamp_ntz``); ``convert_timezone`` keeps the
    result independent of the session time zone. The abbreviation is ``dst`` where the
    UTC offset is above the smaller of the zone's offsets at the year's start and in its middle.
    """
    utc = col_of(ts).cast("timestamp_ntz")
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)

    def offset(at: Column) -> Column:
        return F.timestamp_diff("MINUTE", at, F.convert_timezone(F.lit("UTC"), F.lit(zone), at))

    start = F.date_trunc("year", utc).cast("timestamp_ntz")
    standard = F.least(offset(start), offset(start + F.expr("INTERVAL 182 DAYS")))
    abbr = F.when(offset(utc) > standard, F.lit(dst)).otherwise(F.lit(std))
    return F.concat(
        F.lit(DEVELOPER_CLOCK_INTRO + CLOCK_FORMAT_INTRO),
        F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(" "), abbr,
        F.lit(CLOCK_DAY), F.date_format(local, "EEEE"),
    )


def adhoc_messages(developer: Column, user: Column) -> Column:
    """``[developer, user]`` message list for one ad-hoc prompt."""
    empty_calls = F.array().cast(f"array<{CALL}>")
    return F.array(
        F.struct(F.lit("developer").alias("role"), developer.alias("content"), empty_calls.alias("tool_calls")),
        F.struct(F.lit("user").alias("role"), user.alias("content"), empty_calls.alias("tool_calls")),
    )
