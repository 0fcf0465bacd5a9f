"""Derived input views (FIXTURES.md §3) built from the driver tables.

Every choice depends only on row ids (through ``md5_bucket`` or ``%``), so the
DuckDB oracle in ``plans/oracle.py`` builds the very same rows. All views are
narrow projections over one scan: filters and column pruning reach Parquet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatscope.functions.text import md5_bucket
from chatscope.session import parallelism, plan_bytes

# Fixed values of the fixtures (must equal the oracle SQL text).
DEVELOPER_TEXT = "You are a model that can do function calling with the following functions"
TEXT_ONLY_REPLY = "I can not help with that.<end_of_turn>"
CALL_OPEN = "<start_function_call>"
CALL_CLOSE = "<end_function_call>"
ESC = "<escape>"
ODD_TEXT = " (True, or None of these? pick [a, ] or {b , } False)"  # contents that JSON repair must leave alone


# id column of each driver table, used to spread small scans over the cores
KEYS = {"events": "event_id", "conversations": "conv_id", "documents": "doc_id",
        "embeddings": "vec_id", "benchmark": "item_id"}


# set by a test or bench session to spread the one-file driver tables over its cores
SPREAD_CONF = "spark.chatscope.fixture.partitions"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; hash-spread on its id over ``SPREAD_CONF`` partitions where the session sets that."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    n = spark.conf.get(SPREAD_CONF, None)
    return df.repartition(int(n), KEYS[name]) if n and name in KEYS else df


EVENT_BYTES = 2 << 20  # of the events' files for one task: short rows that cost much work each


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events, always hash-spread: a scan has no more tasks than its files have row groups, which may be one."""
    df = table(spark, sf_dir, "events")
    if spark.conf.get(SPREAD_CONF, None):
        return df
    return df.repartition(max(parallelism(spark), -(-plan_bytes(df) // EVENT_BYTES)), KEYS["events"])


def _k(props: Column) -> Column:
    return F.get_json_object(props, "$.k").try_cast("bigint")


# ---------------------------------------------------------------- FX0 chats
def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per conversation: ordered ``messages`` and an md5-based split."""
    from chatscope.operators.records import assemble_messages
    conv = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return assemble_messages(conv).withColumn(
        "split", F.when(md5_bucket("conv_id") % 10 == 0, "eval").otherwise("train"))


# -------------------------------------------------------- FX1 tool_records
def _event_parts(ev: DataFrame) -> DataFrame:
    k = _k(F.col("props"))
    uid = F.col("user_id").cast("string")
    et = F.col("event_type")
    args = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('{"k": '), k.cast("string"), F.lit("}"))).otherwise(
        F.concat(F.lit('{"k": "'), k.cast("string"), F.lit('", "user": "'), uid, F.lit('"}'))
    )
    ask = F.concat(et, F.lit(" for user "), uid, F.when(F.col("event_id") % 16 == 5, F.lit(ODD_TEXT)).when(
        F.col("event_id") % 16 == 1, F.lit(ODD_TEXT)).otherwise(F.lit("")))
    msgs = F.concat(
        F.lit('[{"role": "developer", "content": "' + DEVELOPER_TEXT + '"}, {"role": "user", "content": "'), ask,
        F.lit('"}, {"role": "assistant", "tool_calls": [{"function": {"name": "'), et,
        F.lit('", "arguments": '), args, F.lit("}}]}]"),
    )
    tools = F.concat(
        F.lit('[{"function":{"description":"Handle a '), et,
        F.lit(' event","name":"'), et,
        F.lit('","parameters":{"properties":{"k":{"type":"string"},"user":{"type":"string"}},"type":"object"}},"type":"function"}]'),
    )
    meta = F.when(F.col("event_id") % 10 == 0, "eval").when(F.col("event_id") % 10 == 1, "holdout").otherwise("train")
    return ev.select(
        F.col("event_id").alias("sample_id"), et.alias("event_type"), uid.alias("user"), k.alias("k"),
        msgs.alias("msgs"), tools.alias("tools"), meta.alias("meta"),
    )


def tool_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(sample_id, text)``: one chat-record JSON line per event, with the defect mix of FX1.

    By ``sample_id % 32``: 3 lacks a role, 11 holds a plain string as a message, 19 a call
    without a name, 27 repeats a key; the rest by ``sample_id % 8``.
    """
    p = _event_parts(events(spark, sf_dir).select("event_id", "user_id", "event_type", "props"))
    d = F.col("sample_id") % 8
    full = F.concat(F.lit('{"messages": '), F.col("msgs"), F.lit(', "tools": '), F.col("tools"),
                    F.lit(', "metadata": "'), F.col("meta"), F.lit('"}'))
    as_string = F.concat(F.lit('{"messages": "'), F.replace(F.col("msgs"), F.lit('"'), F.lit('\\"')),
                         F.lit('", "tools": '), F.col("tools"), F.lit(', "metadata": "'), F.col("meta"), F.lit('"}'))
    single_q = F.concat(F.lit('{"messages": "'), F.replace(F.col("msgs"), F.lit('"'), F.lit("'")),
                        F.lit('", "tools": '), F.col("tools"), F.lit(', "metadata": "'), F.col("meta"), F.lit('"}'))
    no_tools = F.concat(F.lit('{"messages": '), F.col("msgs"), F.lit(', "metadata": "'), F.col("meta"), F.lit('"}'))
    truncated = F.expr("substring(full, 1, length(full) div 2)")
    e = F.col("sample_id") % 32
    record = lambda m: F.concat(F.lit('{"messages": '), m, F.lit(', "tools": '), F.col("tools"), F.lit(', "metadata": "'),
                                F.col("meta"), F.lit('"}'))
    no_role = record(F.replace(F.col("msgs"), F.lit('"role": "developer", '), F.lit("")))
    plain = record(F.concat(F.lit('["hello", '), F.substring("msgs", F.lit(2), F.length("msgs"))))
    nameless = record(F.replace(F.col("msgs"), F.concat(F.lit('"name": "'), F.col("event_type"), F.lit('", ')), F.lit("")))
    twice = F.concat(F.substring(full, F.lit(1), F.length(full) - 1), F.lit(', "metadata": "twice"}'))
    text = (F.when(e == 3, no_role).when(e == 11, plain).when(e == 19, nameless).when(e == 27, twice)
            .when(d == 4, as_string).when(d == 5, single_q).when(d == 6, no_tools)
            .when(d == 7, truncated).otherwise(full))
    return p.withColumn("full", full).select("sample_id", text.alias("text"))


# ------------------------------------------------------- FX1b generations
def _call(name: Column, pairs: Column) -> Column:
    return F.concat(F.lit(CALL_OPEN + "call:"), name, F.lit("{"), pairs, F.lit("}" + CALL_CLOSE))


def _pair(key: str, value: Column) -> Column:
    return F.concat(F.lit(key + ":" + ESC), value, F.lit(ESC))


def generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(model, sample_id, output)`` with the eight output cases of FX1b for both models; some rows are missing."""
    ev = events(spark, sf_dir).select("event_id", "user_id", "event_type", "props")
    k = _k(F.col("props"))
    uid = F.col("user_id").cast("string")
    name = F.col("event_type")
    single = F.col("event_id") % 3 == 0
    kp = _pair("k", k.cast("string"))
    up = _pair("user", uid)
    pairs = F.when(single, kp).otherwise(F.concat(kp, F.lit(","), up))
    wrong_val = F.when(single, _pair("k", (k + 1).cast("string"))).otherwise(
        F.concat(_pair("k", (k + 1).cast("string")), F.lit(","), up))
    reversed_ = F.when(single, kp).otherwise(F.concat(up, F.lit(","), kp))
    dup = F.concat(_pair("k", F.lit("0")), F.lit(","), pairs)
    ev = ev.select("*", F.explode(F.array(F.lit("fine_tuned"), F.lit("baseline"))).alias("model"))
    offset = F.when(F.col("model") == "fine_tuned", 0).otherwise(1)
    c = ((F.expr("event_id div 8") + offset) % 8)
    out = (F.when(c == 0, _call(name, pairs))
           .when(c == 1, _call(F.concat(F.lit("open_"), name), pairs))
           .when(c == 2, _call(name, wrong_val))
           .when(c == 3, F.concat(F.lit(CALL_OPEN + "call:"), name, F.lit(CALL_CLOSE)))
           .when(c == 4, F.lit(TEXT_ONLY_REPLY))
           .when(c == 5, F.concat(_call(F.concat(F.lit("open_"), name), pairs), _call(name, pairs)))
           .when(c == 6, _call(name, reversed_))
           .otherwise(_call(name, dup)))
    # no generation at all for some samples of either model
    there = (F.expr("event_id div 10") + offset) % 7 != 3
    return ev.where(there).select("model", F.col("event_id").alias("sample_id"), out.alias("output"))


# ---------------------------------------------------------------- FX2 pairs
NBSP = "\u00a0"
TURNS = 1_000_000  # sample_id = conv_id * TURNS + turn


def _pair_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(sample_id, prompt, reference, other)``: ``other`` is the conversation's text two turns earlier, if any."""
    conv = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    w = Window.partitionBy("conv_id").orderBy("turn")
    nxt = conv.select(
        "conv_id", "turn", "role", "text", F.lead("role").over(w).alias("next_role"),
        F.lead("text").over(w).alias("next_text"), F.lag("text").over(w).alias("before"),
    ).where((F.col("role") == "user") & (F.col("next_role") == "assistant"))
    return nxt.select((F.col("conv_id") * TURNS + F.col("turn")).alias("sample_id"), F.col("text").alias("prompt"),
                      F.col("next_text").alias("reference"), F.coalesce("before", F.col("text")).alias("other"))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(model, sample_id, prompt, reference, prediction)`` from user→assistant turn pairs.

    The fine-tuned model's prediction is part of the reference, cut short, between stretches of another
    turn; the baseline's is another turn's text. Some are empty, and some have no-break
    spaces for spaces.
    """
    base = _pair_base(spark, sf_dir).select("*", F.explode(F.array(F.lit("fine_tuned"), F.lit("baseline"))).alias("model"))
    bucket = md5_bucket("sample_id")
    mixed = F.concat(F.expr("substring(other, 1, length(other) div 4)"), F.lit(" "),
                     F.expr("substring(reference, length(reference) div 5 + 1, length(reference) div 2)"))
    pred = F.when(F.col("model") == "fine_tuned", mixed).otherwise(F.col("other"))
    pred = F.when(bucket % 7 == 3, F.replace(pred, F.lit(" "), F.lit(NBSP))).otherwise(pred)
    pred = F.when(bucket % 20 == 0, F.lit("")).otherwise(pred)
    return base.select("model", "sample_id", "prompt", "reference", pred.alias("prediction"))


def metric_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX2d: the pairs, a fiftieth of the samples twice (a metric must count both rows)."""
    p = pairs(spark, sf_dir)
    times = F.when(md5_bucket("sample_id") % 50 == 7, 2).otherwise(1)
    return p.select("*", F.explode(F.sequence(F.lit(1), times)).alias("_t")).drop("_t")


def long_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX2L: documents as references, their first half as the prediction (one model)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select(
        F.lit("fine_tuned").alias("model"), F.col("doc_id").alias("sample_id"),
        F.lit("").alias("prompt"), F.col("text").alias("reference"),
        F.expr("substring(text, 1, length(text) div 2)").alias("prediction"),
    )


# -------------------------------------------------------- FX3 token_vectors
def token_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return e.select(
        F.expr("vec_id div 16").alias("sample_id"),
        F.when(F.col("vec_id") % 2 == 0, "pred").otherwise("ref").alias("side"),
        F.expr("(vec_id % 16) div 2").alias("pos"),
        F.col("embedding"),
    )


def model_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX3m: the token vectors keyed by model (even samples: fine_tuned, odd ones: baseline)."""
    return token_vectors(spark, sf_dir).withColumn(
        "model", F.when(F.col("sample_id") % 2 == 0, "fine_tuned").otherwise("baseline"))


# --------------------------------------------------------------- FX4 configs
CONFIG_DEPTH = 11  # levels of the nested variant


def configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(config_id, config)``: one run configuration per event, in eight variants by ``config_id % 24``.

    Most are nested objects of one shape; others are null, ``{}``, cut off, no
    object, lack keys, have extra keys (a list among them) or nest ``CONFIG_DEPTH`` levels.
    """
    ev = events(spark, sf_dir).select("event_id", "user_id", "event_type", "value", "props")
    k = _k(F.col("props"))
    head = F.concat(F.lit('{"FROM": "'), F.col("event_type"), F.lit('"'))
    model = F.concat(F.lit(', "Model": {"name": "m'), (F.col("user_id") % 5).cast("string"),
                     F.lit('", "opt": {"k": '), (k % 4).cast("string"), F.lit("}}"))
    epochs = F.concat(F.lit(', "NumEpochs": '), ((F.floor("value").cast("bigint") % 3) + 1).cast("string"))
    deep = F.concat(F.lit("".join(f', "d{i}": {{"a": {i}' for i in range(1, CONFIG_DEPTH))), F.lit(', "end": '),
                    (k % 2).cast("string"), F.lit("}" * (CONFIG_DEPTH - 1)))
    v = F.col("event_id") % 24
    doc = (F.when(v == 3, F.lit(None).cast("string")).when(v == 7, F.lit("{}")).when(v == 11, head)
           .when(v == 13, F.concat(F.lit("["), (k % 4).cast("string"), F.lit("]")))
           .when(v == 15, F.concat(head, F.lit("}"))).when(v == 17, F.concat(head, model, epochs, F.lit(', "Tags": ["x", 1, null]}')))
           .when(v == 19, F.concat(head, epochs, deep, F.lit("}"))).otherwise(F.concat(head, model, epochs, F.lit("}"))))
    return ev.select(F.col("event_id").alias("config_id"), doc.alias("config"))


# --------------------------------------------------------- FX5 judge_replies
def judge_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir).select("event_id", "props")
    k = _k(F.col("props"))
    a, r, t = (k % 11).cast("string"), ((k + 3) % 11).cast("string"), ((k + 7) % 11).cast("string")
    obj = F.concat(F.lit('{"accuracy": '), a, F.lit(', "relevance": '), r, F.lit(', "tone": '), t, F.lit("}"))
    fence = "```"
    case = F.col("event_id") % 9
    reply = (
        F.when(case == 0, obj)
        .when(case == 1, F.concat(F.lit("Here you go:\n" + fence + "json\n"), obj, F.lit("\n" + fence)))
        .when(case == 2, F.concat(F.lit(fence + "\n"), obj, F.lit("\n" + fence + "\nDone.")))
        .when(case == 3, F.lit("The completion looks fine to me."))
        .when(case == 4, F.concat(F.lit('{"accuracy": '), a, F.lit(', "relevance": '), r, F.lit("}")))
        .when(case == 5, F.concat(F.lit('{"accuracy": "'), a, F.lit('", "relevance": '), r, F.lit(', "tone": '), t, F.lit("}")))
        .when(case == 6, F.concat(F.lit('{"accuracy": '), a, F.lit(', "relevance": null, "tone": '), t, F.lit("}")))
        .when(case == 7, F.concat(F.lit("["), a, F.lit(", "), r, F.lit(", "), t, F.lit("]")))
        .otherwise(F.concat(F.lit('{"accuracy": '), ((k % 11) + 10).cast("string"), F.lit(', "relevance": '), r,
                            F.lit(', "tone": '), t, F.lit("}")))
    )
    model = F.when(F.col("event_id") % 2 == 0, "fine_tuned").otherwise("baseline")
    return ev.select(model.alias("model"), F.col("event_id").alias("sample_id"), reply.alias("reply"))


# ---------------------------------------------------------- FX6 prompt_lines
def prompt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(item_id, line_no, line)``: benchmark text split into lines, with the FX6 decorations."""
    b = table(spark, sf_dir, "benchmark").select("item_id", "text")
    lines = b.select("item_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    m = F.col("item_id") % 4
    deco = (F.when(m == 1, F.concat(F.lit('"'), F.col("line"), F.lit('"')))
            .when(m == 2, F.concat(F.lit("\t  "), F.col("line"), F.lit(" \t")))
            .when(m == 3, F.lit("   "))
            .otherwise(F.col("line")))
    return lines.select("item_id", "line_no", deco.alias("line"))
