"""String column helpers shared by the operators (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bound(value: Column, f) -> Column:
    """``f(value)`` with ``value`` computed once, however often ``f`` uses it, also under lambdas."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


# The characters of Python's ``str.isspace()``, as a regular-expression class.
WS = r"[\x09-\x0D\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"


def py_strip(c: Column | str) -> Column:
    """Python ``str.strip()``: remove leading and trailing whitespace.

    Spark ``trim`` only removes spaces, so this is a regex. ``\\z`` (not ``$``)
    anchors at the true end of the string.
    """
    return F.regexp_replace(col_of(c), rf"\A{WS}+|{WS}+\z", "")


def md5_bucket(c: Column | str) -> Column:
    """First 8 hex digits of md5(id as string) as a non-negative integer.

    A stable, engine-independent hash: DuckDB and Spark agree on md5, not on
    xxhash, so every deterministic fixture/sampling choice goes through this.
    """
    return F.conv(F.substring(F.md5(col_of(c).cast("string")), 1, 8), 16, 10).cast("bigint")


def chars(c: Column | str) -> Column:
    """One array element per code point (a surrogate pair stays one element)."""
    return F.regexp_extract_all(col_of(c), F.lit("(?s)."), F.lit(0))


def json_escape_body(c: Column | str) -> Column:
    """``json.dumps(s)[1:-1]`` with Python's defaults (``ensure_ascii=True``).

    Backslash, quote and the short control escapes are replaced first; every
    other control character and every non-ASCII code point becomes ``\\uXXXX``
    (lower-case hex, surrogate pairs above the BMP). Runs as a higher-order
    expression over the characters, so it stays inside the JVM.
    """
    s = col_of(c)

    def esc(ch: Column) -> Column:
        cp = F.ascii(ch)
        hi = F.lit(0xD800) + F.shiftright(cp - F.lit(0x10000), 10)
        lo = F.lit(0xDC00) + (cp - F.lit(0x10000)).bitwiseAND(F.lit(0x3FF))
        return (
            F.when(ch == "\\", F.lit("\\\\"))
            .when(ch == '"', F.lit('\\"'))
            .when(ch == "\n", F.lit("\\n"))
            .when(ch == "\r", F.lit("\\r"))
            .when(ch == "\t", F.lit("\\t"))
            .when(ch == "\b", F.lit("\\b"))
            .when(ch == "\f", F.lit("\\f"))
            .when(cp < 0x20, F.format_string("\\u%04x", cp))
            .when(cp <= 0x7F, ch)
            .when(cp < 0x10000, F.format_string("\\u%04x", cp))
            .otherwise(F.concat(F.format_string("\\u%04x", hi), F.format_string("\\u%04x", lo)))
        )

    return F.when(s.isNull(), F.lit(None)).otherwise(F.array_join(F.transform(chars(s), esc), ""))
