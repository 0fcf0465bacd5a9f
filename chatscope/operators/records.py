"""Chat-record parsing, repair and validation.

A raw record is one JSON object per text line. Parsing goes to VARIANT
(``try_parse_json``), fields that arrive as strings holding JSON are decoded
(after a closed list of repair rules when needed), messages are normalised to
``schemas.MESSAGES`` and every structural problem becomes a reason string
instead of a job failure. ``valid`` and ``quarantine`` are two filters over the
same projection, so together they return the input row for row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatscope.functions.text import bound, col_of
from chatscope.operators.sampling import first_row
from chatscope.schemas import CALL

# Fixed reason codes, in the order they are checked.
REASONS = (
    "invalid_json", "not_object", "missing_messages", "missing_tools",
    "messages_unparseable", "tools_unparseable", "messages_not_list", "tools_not_list",
    "missing_metadata", "message_not_object", "message_without_role", "call_without_name",
)
# Replaces invalid_json where the text is JSON but for a repeated key: VARIANT rejects it
# unless the session sets spark.sql.variant.allowDuplicateKeys (then the last value counts).
DUPLICATE_KEY = "duplicate_key"

_QUOTED = r"""\"[^"\\]*+(?:\\.[^"\\]*+)*+\"|'[^'\\]*+(?:\\.[^'\\]*+)*+'"""
_PIECES = r"(?s)" + _QUOTED + r"""|[^"']++|["']"""


def _outside_strings(s: Column, fix) -> Column:
    """Apply ``fix`` to the stretches of ``s`` that lie outside quoted strings."""
    pieces = F.regexp_extract_all(s, F.lit(_PIECES), F.lit(0))
    return F.array_join(F.transform(pieces, lambda p: F.when(
        F.startswith(p, F.lit('"')) | F.startswith(p, F.lit("'")), p).otherwise(fix(p))), "")


def _fix_tokens(p: Column) -> Column:
    p = F.regexp_replace(p, r",\s*([\]}])", "$1")
    p = F.regexp_replace(p, r"\bTrue\b", "true")
    p = F.regexp_replace(p, r"\bFalse\b", "false")
    return F.regexp_replace(p, r"\bNone\b", "null")


def _lenient(s: Column) -> Column:
    """Steps 1 to 3 of ``repair_json``."""
    options = {"allowUnquotedFieldNames": "true", "allowSingleQuotes": "true"}
    return F.coalesce(F.try_parse_json(s), F.from_json(s, "variant", options),
                      F.from_json(_outside_strings(s, _fix_tokens), "variant", options))


# a quoted string, the rest of the text behind an unclosed quote, a mark, or a bare word
_TOKEN = r"(?s)" + _QUOTED + r"""|["'].*|[{}\[\],:]|[^\s{}\[\],:"']++"""
_NUMBER = r"-?(0|[1-9]\d*)(\.\d+)?([eE][+-]?\d+)?"


def _as_json(token: Column, is_last: Column) -> Column:
    """A token as JSON: strings closed, double-quoted and without raw control characters, bare words as literals or strings."""
    quote = F.substring(token, 1, 1)
    closed = (F.length(token) > 1) & F.regexp_like(token, F.lit(r"(?s)\A(?:" + _QUOTED + r")\z"))
    inner = F.when(closed, F.substring(token, F.lit(2), F.length(token) - 2)).otherwise(
        # the cut may have left half an escape
        F.regexp_replace(F.substring(token, F.lit(2), F.length(token)), r"(?<!\\)((?:\\\\)*)\\(?:u[0-9a-fA-F]{0,3})?\z", "$1"))
    inner = F.when(quote == "'", F.replace(F.replace(inner, F.lit("\\'"), F.lit("'")), F.lit('"'), F.lit('\\"'))).otherwise(inner)
    for raw, escape in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        inner = F.replace(inner, F.lit(raw), F.lit(escape))
    literal = (F.when(token.isin("true", "True"), "true").when(token.isin("false", "False"), "false")
               .when(token.isin("null", "None"), "null"))
    number = F.regexp_replace(token, r"[.eE+-]+\z", "")  # a cut may end in the middle of a number
    bare = (F.when(literal.isNotNull(), literal)
            .when(F.regexp_like(token, F.lit(rf"\A{_NUMBER}\z")), token)
            .when(is_last & F.regexp_like(number, F.lit(rf"\A{_NUMBER}\z")), number)
            .otherwise(F.concat(F.lit('"'), F.replace(token, F.lit("\\"), F.lit("\\\\")), F.lit('"'))))
    return F.when(quote.isin('"', "'"), F.concat(F.lit('"'), inner, F.lit('"'))).otherwise(bare)


def close_json(s: Column | str) -> Column:
    """JSON text with its structure completed; NULL unless the text opens an object or a list.

    A stack automaton over the tokens: open strings, lists and objects are closed at the end of the text, a list or
    object that was left open where its parent closes is closed there, and a closing mark that nothing opened goes.
    Commas are supplied between values that meet and dropped where none follows; a quoted name without a
    value gets null. Bare words are literals, numbers or strings. What strings hold does not change, but for escapes that the text's end
    cut in half. The result need not be valid (``{"a" 1}`` has no colon); a parser decides.
    """
    # only brackets move the stack; its top is the first character
    def step(acc: Column, b: Column) -> Column:
        mark, at = b["t"], b["i"]
        stack, fixes = acc["stack"], acc["fixes"]
        below = F.instr(stack, mark)
        state = lambda s, f: F.struct(s.alias("stack"), f.alias("fixes"))
        fix = lambda close, keep: F.concat(fixes, F.array(F.struct(at.alias("i"), close.alias("close"), F.lit(keep).alias("keep"))))
        return (F.when(mark == "{", state(F.concat(F.lit("}"), stack), fixes))
                .when(mark == "[", state(F.concat(F.lit("]"), stack), fixes))
                .when(F.startswith(stack, mark), state(F.substring(stack, F.lit(2), F.length(stack)), fixes))
                .when(below > 0, state(F.substring(stack, below + 1, F.length(stack)),
                                       fix(F.substring(stack, F.lit(1), below - 1), True)))
                .otherwise(state(stack, fix(F.lit(""), False))))

    def with_stack(toks: Column, end: Column) -> Column:
        n = F.size(toks)
        fixes = end["fixes"]
        begins = lambda t: ~t.isin("}", "]", ",", ":")
        ends = lambda t: ~t.isin("{", "[", ",", ":")

        def piece(t: Column, i: Column) -> Column:
            after = F.get(toks, i + 1)
            fix = F.get(F.filter(fixes, lambda x: x["i"] == i), F.lit(0))
            mark = (F.when(t == ",", F.when(after.isNull() | after.isin("}", "]", ","), "").otherwise(","))
                    .when(t == ":", F.when(after.isNull() | after.isin("}", "]", ","), ":null").otherwise(":"))
                    .when(t.isin("{", "}", "[", "]"), F.when(F.coalesce(fix["keep"], F.lit(True)), t).otherwise("")))
            text = F.coalesce(mark, _as_json(t, i == n - 1))
            comma = F.when(after.isNotNull() & ends(t) & begins(after), ",").otherwise("")
            return F.concat(F.coalesce(fix["close"], F.lit("")), text, comma)

        last, before = F.get(toks, n - 1), F.get(toks, n - 2)
        lone = F.startswith(end["stack"], F.lit("}")) & F.substring(last, 1, 1).isin('"', "'") & before.isin("{", ",")
        tail = F.concat(F.when(F.coalesce(lone, F.lit(False)), ":null").otherwise(""), end["stack"])
        return F.concat(F.array_join(F.transform(toks, piece), ""), tail)

    def whole(toks: Column) -> Column:
        marks = F.filter(F.transform(toks, lambda t, i: F.struct(t.alias("t"), i.alias("i"))),
                         lambda x: x["t"].isin("{", "}", "[", "]"))
        start = F.struct(F.lit("").alias("stack"), F.array().cast("array<struct<i:int,close:string,keep:boolean>>").alias("fixes"))
        return bound(F.aggregate(marks, start, step), lambda end: with_stack(toks, end))

    text = col_of(s)
    opens = F.regexp_like(text, F.lit(r"\A[\s\x{FEFF}]*[\[{]"))
    return F.when(opens, bound(F.regexp_extract_all(F.regexp_replace(text, r"\A\x{FEFF}", ""), F.lit(_TOKEN), F.lit(0)), whole))


def repair_json(s: Column | str) -> Column:
    """Documented repair chain; NULL when still unparseable.

    1. strict parse; 2. without a BOM, leniently (single-quoted strings and
    unquoted field names are accepted by Spark's JSON reader options); 3. the same after
    dropping trailing commas before ``]``/``}`` and mapping Python
    ``True/False/None`` to JSON. Step 3 only touches text outside quoted
    strings, so string contents are never rewritten. 4. ``close_json``: the structure is completed.
    """
    s = F.regexp_replace(col_of(s), r"^\x{FEFF}", "")
    return F.coalesce(_lenient(s), F.try_parse_json(close_json(s)))


def repair_kind(s: Column | str) -> Column:
    """How far ``repair_json`` had to go: strict, lenient or structural; NULL where it found no way."""
    s = F.regexp_replace(col_of(s), r"^\x{FEFF}", "")
    return (F.when(F.try_parse_json(s).isNotNull(), "strict").when(_lenient(s).isNotNull(), "lenient")
            .when(F.try_parse_json(close_json(s)).isNotNull(), "structural"))


def parse_whole(text: Column) -> Column:
    """The JSON value that ``text`` is; NULL where it is none, or where anything but white space follows the value.

    Spark's parser stops behind the first value. So the text is parsed as the first of two elements of a list, the second of
    which is the text's own hash: it is found there only if the text is exactly one value.
    """
    mark = F.md5(text)
    both = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]')))
    return bound(both, lambda v: F.when(F.try_variant_get(v, "$[1]", "string") == mark, F.try_variant_get(v, "$[0]", "variant")))


def parse_whole_object(text: Column, fields: T.StructType) -> Column:
    """As ``parse_whole`` for an object with some known fields; of a repeated name the last value counts."""
    mark = F.md5(text)
    end = "_end"
    while end in fields.names:
        end += "_"
    schema = T.ArrayType(T.StructType([*fields.fields, T.StructField(end, T.StringType())]))
    both = F.from_json(F.concat(F.lit("["), text, F.lit(f',{{"{end}":"'), mark, F.lit('"}]')), schema)
    return bound(both, lambda v: F.when((F.size(v) == 2) & (F.get(v, F.lit(1))[end] == mark), F.get(v, F.lit(0))))


def _repeats_a_key(text: Column) -> Column:
    """The text is a JSON object for a parser that lets the last of equal keys count."""
    parsed = parse_whole_object(text, T.StructType([T.StructField("metadata", T.StringType())]))
    return F.regexp_like(text, F.lit(r"^\s*\{")) & parsed.isNotNull()


def _vtype(v: Column) -> Column:
    """Top-level VARIANT type name (walks the whole value: use on small values only)."""
    return F.regexp_extract(F.schema_of_variant(v), r"^([A-Z_]+)", 1)


def _is_array(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>").isNotNull()


def _is_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


def decode_nested(v: Column) -> tuple[Column, Column]:
    """A field that is a string holding JSON is repaired and parsed; else kept.

    Returns ``(value, how)`` with ``how`` in native / string / repaired / structural / failed.
    Scalars other than strings are treated like strings (they fail the list
    check either way).
    """
    scalar = ~_is_array(v) & ~_is_object(v) & ~F.coalesce(F.is_variant_null(v), F.lit(False))
    s = F.try_variant_get(v, "$", "string")
    strict = F.try_parse_json(s)
    repaired = repair_json(s)
    value = F.when(scalar, F.coalesce(strict, repaired)).otherwise(v)
    how = (F.when(v.isNull(), F.lit(None))
           .when(~scalar, F.lit("native"))
           .when(strict.isNotNull(), F.lit("string"))
           .when(_lenient(F.regexp_replace(s, r"^\x{FEFF}", "")).isNotNull(), F.lit("repaired"))
           .when(repaired.isNotNull(), F.lit("structural"))
           .otherwise(F.lit("failed")))
    return value, how


def unwrap_singleton(v: Column) -> Column:
    """D3: ``[[m, ...]] -> [m, ...]`` while the list has one element that is itself a list.

    At any nesting: the text opens with one ``[`` per wrapper, which bounds the steps.
    """
    def step(out: Column, _: Column) -> Column:
        first = F.try_variant_get(out, "$[0]", "variant")
        nest = (F.size(F.try_variant_get(out, "$", "array<variant>")) == 1) & _is_array(first)
        return F.when(F.coalesce(nest, F.lit(False)), first).otherwise(out)

    opens = F.length(F.regexp_extract(F.to_json(v), r"^(\[*)", 1))
    return F.aggregate(F.sequence(F.lit(1), F.greatest(opens, F.lit(1))), v, step)


def fence(df: DataFrame, **cols: Column) -> DataFrame:
    """Materialise expensive columns once per row.

    A one-element ``inline`` is a Generate node: filters on its output cannot
    be pushed below it, so a later ``where`` never inlines (and re-runs) the
    parse under the scan.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(k) for k, c in cols.items()]))))


def normalise_messages(v: Column) -> Column:
    """VARIANT array of message objects -> ``schemas.MESSAGES`` (plus canonical argument JSON)."""
    def call(c: Column) -> Column:
        args = F.try_variant_get(c, "$.function.arguments", "variant")
        return F.struct(
            F.try_variant_get(c, "$.function.name", "string").alias("name"),
            F.map_entries(F.coalesce(F.try_variant_get(c, "$.function.arguments", "map<string,string>"),
                                     F.create_map().cast("map<string,string>"))).alias("arguments"),
            F.to_json(args).alias("arguments_json"),
        )

    def msg(m: Column) -> Column:
        calls = F.coalesce(F.try_variant_get(m, "$.tool_calls", "array<variant>"), F.array().cast("array<variant>"))
        return F.struct(
            F.try_variant_get(m, "$.role", "string").alias("role"),
            F.try_variant_get(m, "$.content", "string").alias("content"),
            F.transform(calls, call).alias("tool_calls"),
        )

    return F.transform(F.try_variant_get(v, "$", "array<variant>"), msg)


def _nameless_call(m: Column) -> Column:
    calls = F.coalesce(F.try_variant_get(m, "$.tool_calls", "array<variant>"), F.array().cast("array<variant>"))
    return F.exists(calls, lambda c: F.try_variant_get(c, "$.function.name", "string").isNull())


def parse_records(df: DataFrame, text_col: str = "text", unwrap: bool = False) -> DataFrame:
    """A2 + C2 + D1–D3: add ``messages``, ``tools_json``, ``split``, ``decoded_from`` and ``reason``.

    All other input columns are kept. Map-only: no shuffle. The record is
    parsed once and its fields decoded once (``fence``); validity checks are
    cheap tests on those values.
    """
    out = fence(df, _rec=parse_whole(F.col(text_col)))
    rec = F.col("_rec")
    raw_m = F.try_variant_get(rec, "$.messages", "variant")
    raw_t = F.try_variant_get(rec, "$.tools", "variant")
    m_val, m_how = decode_nested(raw_m)
    t_val, _ = decode_nested(raw_t)
    if unwrap:
        m_val = unwrap_singleton(m_val)
    # the text parsed as JSON, so it is an object exactly when it opens with a brace
    is_obj = rec.isNotNull() & F.regexp_like(F.col(text_col), F.lit(r"^[ \t\n\r]*\{"))
    out = fence(out, _obj=is_obj, _m_raw=raw_m, _t_raw=raw_t, _m=m_val, decoded_from=m_how, _t=t_val,
                 _meta=F.try_variant_get(rec, "$.metadata", "string"))
    items = F.try_variant_get(F.col("_m"), "$", "array<variant>")
    checks = [
        rec.isNull(),
        ~F.col("_obj"),
        F.col("_m_raw").isNull(),
        F.col("_t_raw").isNull(),
        F.col("_m").isNull(),
        F.col("_t").isNull(),
        ~_is_array(F.col("_m")),
        ~_is_array(F.col("_t")),
        F.col("_meta").isNull(),
        F.exists(items, lambda m: ~_is_object(m)),
        F.exists(items, lambda m: F.try_variant_get(m, "$.role", "string").isNull()),
        F.exists(items, _nameless_call),
    ]
    # only the first failing check is kept as the reason, later ones are implied
    reason = F.lit(None).cast("string")
    for name, bad in reversed(list(zip(REASONS, checks))):
        reason = F.when(F.coalesce(bad, F.lit(True)), F.lit(name)).otherwise(reason)
    reason = F.when(rec.isNull() & F.coalesce(_repeats_a_key(F.col(text_col)), F.lit(False)), F.lit(DUPLICATE_KEY)).otherwise(
        reason)
    return (out.withColumn("reason", reason)
               .withColumn("messages", F.when(F.col("reason").isNull(), normalise_messages(F.col("_m"))))
               .withColumn("n_messages", F.when(F.col("reason").isNull(),
                                                F.size(F.try_variant_get(F.col("_m"), "$", "array<variant>"))))
               .withColumn("tools_json", F.when(F.col("reason").isNull(), F.to_json(F.col("_t"))))
               .withColumn("split", F.when(F.col("reason").isNull(), F.col("_meta")))
               .drop("_rec", "_obj", "_m_raw", "_t_raw", "_m", "_t", "_meta"))


def first_tools(raw: DataFrame, order: str, text_col: str = "text") -> str:
    """The tools of the first valid record by ``order``.

    Only the first rows are parsed, ever more of them until one is valid. A table
    without a valid record, or whose first one has no tools, is an error (C6).
    """
    n = 16
    while True:
        head = raw.select(order, text_col).orderBy(order).limit(n)
        row = first_row(valid(parse_records(head, text_col)), order).select("tools_json").first()
        if row or head.count() < n:
            break
        n *= 16
    if row is None:
        raise ValueError("no valid record to take the tools from")
    if row.tools_json in ("[]", "null"):
        raise ValueError("the first valid record has no tools")
    return row.tools_json


def valid(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNull()).drop("reason")


def quarantine(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNotNull())


def quarantine_counts(parsed: DataFrame) -> DataFrame:
    """I4: rejected rows per reason (partial aggregation, tiny shuffle)."""
    return quarantine(parsed).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def split_filter(df: DataFrame, name: str) -> DataFrame:
    """Rows whose split equals ``name``; values other than train/eval land in neither."""
    return df.where(F.col("split") == F.lit(name))


def split_counts(df: DataFrame) -> DataFrame:
    """Row count per split."""
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def assemble_messages(turns: DataFrame, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """One row per conversation with its ordered messages.

    A conversation is one model input, so its size is bounded by the context
    window; the ``collect_list`` is per conversation, never per table. Turns without
    a conversation id belong to none (``orphan_turns``) and never form a group.
    """
    calls_t = f"array<{CALL}>"
    return turns.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(order, "role", "text"))),
                    lambda m: F.struct(m["role"].alias("role"), m["text"].alias("content"),
                                       F.array().cast(calls_t).alias("tool_calls"))).alias("messages"))


def orphan_turns(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """The turns that ``assemble_messages`` leaves out, for quarantine."""
    return turns.where(F.col(key).isNull())


def explode_messages(df: DataFrame, key: str = "conv_id") -> DataFrame:
    """Inverse of D4: one row per message with its 0-based position."""
    return df.select(key, F.posexplode("messages").alias("turn", "m")).select(
        key, "turn", F.col("m.role").alias("role"), F.col("m.content").alias("text"))
