"""Judge operators.

``judge_prompt`` builds the four-section prompt natively; ``judge_batch``
runs a caller-supplied judge through ``inference.batch_generate``;
``parse_judge_reply`` turns reply strings into per-criterion scores with the
reference's all-or-nothing rules:

* text between the first two triple-backtick fences is used when a fence
  exists, with a leading ``json`` dropped;
* unparseable JSON, text behind the JSON value or a non-object reply zeroes every
  criterion; of a repeated key the last value counts;
* a missing key scores 0 for that key only;
* an explicit ``null``, a non-numeric string, an object or a list as a value
  zeroes the whole row; booleans count 1/0; numeric strings are accepted;
  nothing is clamped to 0–10.

Rows that were zeroed are flagged ``failed`` so failures do not hide inside
the mean.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial
from inspect import signature

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatscope.functions.text import col_of
from chatscope.operators.records import parse_whole_object
from chatscope.schemas import JUDGE_CRITERIA

FENCE = "```"

# Section headings of the judge prompt as the reference writes them.
HEAD_PROMPT = "## User prompt\n"
HEAD_REFERENCE = "\n\n## Reference (ground truth) completion\n"
HEAD_CANDIDATE = "\n\n## Model completion to score\n"
HEAD_TASK = "\n\n## Task\nScore the model completion from 0 to 10 for each criterion: "
TASK_KEYS = ".\nOutput only a JSON object with keys: "
TASK_END = ". One number per key."
SYSTEM_PROMPT = (
    "You are an expert evaluator for text generation. Score the model's completion relative to the "
    "reference answer and the user prompt.\nOutput only a single JSON object with one number (0-10) per "
    'criterion. No other text.\nExample: {"accuracy": 8, "relevance": 9, "tone": 7}'
)


def judge_prompt(prompt: Column | str, reference: Column | str, candidate: Column | str,
                 criteria: Sequence[str] = JUDGE_CRITERIA) -> Column:
    """The judge's user prompt (criteria text is a literal, folded once)."""
    crit = ", ".join(criteria)
    keys = "[" + ", ".join(f'"{c}"' for c in criteria) + "]"
    return F.concat(F.lit(HEAD_PROMPT), F.coalesce(col_of(prompt), F.lit("None")),
                    F.lit(HEAD_REFERENCE), F.coalesce(col_of(reference), F.lit("None")),
                    F.lit(HEAD_CANDIDATE), F.coalesce(col_of(candidate), F.lit("None")),
                    F.lit(HEAD_TASK + crit + TASK_KEYS + keys + TASK_END))


def _reply_json(raw: Column) -> Column:
    seg = F.when(F.contains(raw, F.lit(FENCE)), F.element_at(F.split(raw, FENCE), 2)).otherwise(raw)
    return F.when(F.startswith(seg, F.lit("json")), F.substring(seg, F.lit(5), F.lit(2147483647))).otherwise(seg)


def parse_judge_reply(df: DataFrame, reply_col: str = "reply",
                      criteria: Sequence[str] = JUDGE_CRITERIA) -> DataFrame:
    """Add one double column per criterion and a ``failed`` flag."""
    # each criterion keeps its JSON type; NULL: not there
    fields = T.StructType([T.StructField(c, T.VariantType()) for c in criteria])
    out = df.withColumn("_v", parse_whole_object(_reply_json(F.col(reply_col)), fields))
    bad = F.col("_v").isNull()
    vals = {}
    for c in criteria:
        field = F.col("_v")[c]
        kind = F.regexp_extract(F.schema_of_variant(field), "^([A-Z]+)", 1)
        num = F.try_variant_get(field, "$", "double")
        bad = bad | (field.isNotNull() & (kind.isin("VOID", "OBJECT", "ARRAY") | num.isNull()))
        vals[c] = F.when(field.isNull(), F.lit(0.0)).otherwise(num)
    out = out.withColumn("failed", F.coalesce(bad, F.lit(True)))
    for c in criteria:
        out = out.withColumn(c, F.when(F.col("failed"), F.lit(0.0)).otherwise(vals[c]))
    return out.drop("_v")


def judge_batch(df: DataFrame, make_judge, criteria: Sequence[str] = JUDGE_CRITERIA,
                keep: list[str] | None = None, batch_size: int = 16,
                system_prompt: str = SYSTEM_PROMPT) -> DataFrame:
    """Build prompts, run the judge (errors → NULL reply → failed row), parse.

    ``make_judge`` is a model factory as in ``batch_generate``; one that takes an
    argument is given the system prompt, to send with every call.
    """
    from chatscope.operators.inference import batch_generate
    keep = keep or ["model", "sample_id"]
    if signature(make_judge).parameters:
        make_judge = partial(make_judge, system_prompt)
    prompts = df.select(*keep, judge_prompt("prompt", "reference", "prediction", criteria).alias("judge_prompt"))
    replies = batch_generate(prompts, make_judge, "judge_prompt", "reply", keep, batch_size, on_error="null")
    return parse_judge_reply(replies, "reply", criteria)


def judge_aggregate(scores: DataFrame, criteria: Sequence[str] = JUDGE_CRITERIA) -> DataFrame:
    """Mean per criterion and model (failures count as 0) → ``(model, metric, value)`` + ``n_failed``."""
    agg = scores.groupBy("model").agg(*[F.avg(c).alias(c) for c in criteria],
                                      F.sum(F.col("failed").cast("int")).alias("n_failed"))
    return agg.select("model", "n_failed", F.explode(F.array(*[
        F.struct(F.lit(f"judge_{c}").alias("metric"), F.col(c).alias("value")) for c in criteria])).alias("m")
    ).select("model", "m.metric", "m.value", "n_failed")
