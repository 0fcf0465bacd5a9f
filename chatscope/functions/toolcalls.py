"""Tool-call and text extraction from raw model output.

Model output holds zero or more
``<start_function_call>call:NAME{key:<escape>value<escape>,...}<end_function_call>``
blocks. The rules (per block, in text order):

1. keep only blocks whose stripped text starts with ``call:``;
2. drop blocks without ``{``;
3. name = text before the first ``{`` with every ``call:`` removed, stripped;
4. arguments = text after the first ``{``, stripped, minus one trailing ``}``;
5. pairs = lazy matches of ``([^:,]*?):<escape>(.*?)<escape>``; keys are
   stripped, values are not;
6. a repeated key keeps its last value.

Everything is a native expression (``regexp_extract_all`` + ``filter`` /
``transform`` / ``zip_with``), so extraction runs in the JVM next to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatscope.functions.text import bound, col_of, py_strip

# Fixed values of the call format.
CALL_RE = r"(?s)<start_function_call>(.*?)<end_function_call>"
PAIR_RE = r"(?s)([^:,]*?):<escape>(.*?)<escape>"
END_OF_TURN = "<end_of_turn>"
CALL_START = "<start_function_call>"


def _one_call(raw: Column) -> Column:
    pre = F.substring_index(raw, "{", 1)
    rest = F.substring(raw, F.length(pre) + 2, F.lit(2147483647))
    args = py_strip(rest)
    args = F.when(F.endswith(args, F.lit("}")), F.substring(args, F.lit(1), F.length(args) - 1)).otherwise(args)

    def last_wins(p: Column) -> Column:
        # a pair stays if its key, searched from the end, is found at its own place
        n = F.size(p["keys"])
        pairs = F.zip_with(p["keys"], p["values"], lambda k, v: F.struct(k.alias("key"), v.alias("value")))
        return bound(F.reverse(p["keys"]), lambda back: F.filter(pairs, lambda e, i: F.array_position(back, e["key"]) == n - i))

    def found(text: Column) -> Column:
        keys = F.transform(F.regexp_extract_all(text, F.lit(PAIR_RE), F.lit(1)), lambda k: py_strip(k))
        return F.struct(keys.alias("keys"), F.regexp_extract_all(text, F.lit(PAIR_RE), F.lit(2)).alias("values"))

    pairs = bound(args, lambda text: bound(found(text), last_wins))
    return F.struct(py_strip(F.replace(pre, F.lit("call:"), F.lit(""))).alias("name"), pairs.alias("arguments"))


def extract_calls(output: Column | str) -> Column:
    """``ARRAY<STRUCT<name, arguments ARRAY<STRUCT<key, value>>>>``; NULL output → empty."""
    raw = F.regexp_extract_all(F.coalesce(col_of(output), F.lit("")), F.lit(CALL_RE), F.lit(1))
    kept = F.filter(raw, lambda c: F.startswith(py_strip(c), F.lit("call:")) & F.contains(c, F.lit("{")))
    return F.transform(kept, _one_call)


def extract_text(output: Column | str) -> Column:
    """NULL when empty or starting with a call marker; else drop ``<end_of_turn>`` and strip."""
    o = col_of(output)
    return F.when(o.isNull() | (o == "") | F.startswith(o, F.lit(CALL_START)), F.lit(None).cast("string")) \
        .otherwise(py_strip(F.replace(o, F.lit(END_OF_TURN), F.lit(""))))


def call_names(calls: Column) -> Column:
    """Names in order."""
    return F.transform(calls, lambda c: c["name"])


def canonical_args(calls: Column) -> Column:
    """D13 for extracted calls: per call, JSON object text with sorted keys (values are strings)."""
    return F.transform(
        calls,
        lambda c: F.to_json(F.to_variant_object(F.map_from_entries(
            F.coalesce(c["arguments"], F.array().cast("array<struct<key:string,value:string>>"))))),
    )


def canonical_target_args(calls: Column) -> Column:
    """D13 for target calls: canonical JSON of the VARIANT arguments (types kept, keys sorted)."""
    return F.transform(calls, lambda c: F.coalesce(c["arguments_json"], F.lit("{}")))


def loose_target_args(calls: Column) -> Column:
    """``strict_types=False``: target values compared as their string forms."""
    return canonical_args(calls)
