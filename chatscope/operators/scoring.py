"""Exact-match tool-call scoring.

The eval records and the generations meet in one equi-join on ``sample_id``
(a sort-merge join; both sides are keyed by a unique id, so there is no hot key). Everything after the join is row-local expressions.
Arguments are compared as canonical JSON text: keys sorted, target values
keep their JSON type, extracted values are strings, so ``20`` never equals
``"20"`` (set ``strict_types=False`` to compare string forms).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatscope.functions import toolcalls as TC
from chatscope.operators.records import fence

EMPTY_CALLS = "array<struct<name:string,arguments:array<struct<key:string,value:string>>,arguments_json:string>>"


def eval_targets(records: DataFrame) -> DataFrame:
    """User text and first-assistant targets by position (messages[1], messages[2])."""
    m = F.col("messages")
    user = F.try_element_at(m, F.lit(2))
    asst = F.try_element_at(m, F.lit(3))
    return records.select(
        "sample_id",
        user["content"].alias("user"),
        F.coalesce(asst["tool_calls"], F.array().cast(EMPTY_CALLS)).alias("target_fc"),
        asst["content"].alias("target_text"),
    )


def align_generations(targets: DataFrame, generations: DataFrame, models: list[str]) -> DataFrame:
    """every (model, target) row, with the generation when there is one (left join).

    The model list is a handful of literals, so it is exploded in place
    rather than joined. Both sides may be as long as the tables, and Spark underestimates
    texts that are built from short columns: so a merge join, never a broadcast.
    """
    t = targets.select("*", F.explode(F.array(*[F.lit(x) for x in models])).alias("model"))
    return t.join(generations.hint("merge"), ["model", "sample_id"], "left")


def extract_outputs(generations: DataFrame) -> DataFrame:
    """Per generation: called names, canonical arguments and text.

    Runs before the join, on the generations' own partitions, so the regex
    work is spread with the scan and only compact arrays cross the shuffle.
    """
    g = generations.withColumn("_fc", TC.extract_calls("output"))
    return g.select("model", "sample_id", F.lit(True).alias("has_output"),
                    TC.call_names(F.col("_fc")).alias("output_names"),
                    TC.canonical_args(F.col("_fc")).alias("output_arguments"),
                    TC.extract_text("output").alias("output_text"))


def score_generations(targets: DataFrame, generations: DataFrame, models: list[str], strict_types: bool = True) -> DataFrame:
    """E4 from raw generations: align, extract, score; one row per model and target.

    The targets are read once, for the join; calls are extracted behind it, so
    only from generations that have a target, and once (``fence``).
    """
    aligned = align_generations(targets, generations.select("model", "sample_id", "output"), models)
    out = fence(aligned, _fc=TC.extract_calls("output"))
    out = fence(out, output_names=TC.call_names(F.col("_fc")), output_arguments=TC.canonical_args(F.col("_fc")),
                output_text=TC.extract_text("output"))
    return score(out.drop("_fc", "output"), strict_types)


def score(aligned: DataFrame, strict_types: bool = True) -> DataFrame:
    """The scored frame (names, canonical arguments, texts, correctness flags).

    ``aligned`` is targets left-joined to ``extract_outputs(generations)``; a
    missing generation scores as no calls and no text.
    """
    empty = F.array().cast("array<string>")
    tgt_args = TC.canonical_target_args(F.col("target_fc")) if strict_types else TC.loose_target_args(F.col("target_fc"))
    return (aligned
            .select(
                "model", "sample_id", "user",
                TC.call_names(F.col("target_fc")).alias("target_names"),
                F.coalesce(F.col("output_names"), empty).alias("output_names"),
                tgt_args.alias("target_arguments"),
                F.coalesce(F.col("output_arguments"), empty).alias("output_arguments"),
                "target_text", "output_text",
            )
            .withColumn("correct_names", F.col("target_names") == F.col("output_names"))
            .withColumn("correct_arguments", F.col("target_arguments") == F.col("output_arguments"))
            .withColumn("correct", F.col("correct_names") & F.col("correct_arguments")))


def review_errors(scored: DataFrame) -> DataFrame:
    """C5 + E5: incorrect rows with expected vs actual."""
    return scored.where(~F.col("correct_names") | ~F.col("correct_arguments")).select(
        "model", "sample_id", F.col("user").alias("prompt"),
        F.col("target_names").alias("expected_names"), F.col("target_arguments").alias("expected_arguments"),
        F.col("output_names").alias("actual_names"), F.col("output_arguments").alias("actual_arguments"),
    )


def accuracy_by_model(scored: DataFrame) -> DataFrame:
    """Mean of ``correct`` per model (map-side partial aggregation)."""
    return scored.groupBy("model").agg(
        F.avg(F.col("correct").cast("double")).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def compare_models(scored: DataFrame, model_a: str, model_b: str) -> DataFrame:
    """side-by-side correctness per sample (a full outer join on ``sample_id``).

    Written as one grouping on ``sample_id`` with per-model conditional
    aggregates: a single shuffle instead of two filtered copies joined.
    """
    a = F.max(F.when(F.col("model") == model_a, F.col("correct").cast("int")))
    b = F.max(F.when(F.col("model") == model_b, F.col("correct").cast("int")))
    g = scored.where(F.col("model").isin(model_a, model_b)).groupBy("sample_id").agg(
        a.alias("_a"), b.alias("_b"))
    cls = (F.when((F.col("_a") == 1) & (F.col("_b") == 1), "both")
           .when(F.col("_a") == 1, "only_a").when(F.col("_b") == 1, "only_b").otherwise("neither"))
    return g.select("sample_id", (F.col("_a") == 1).alias("correct_a"), (F.col("_b") == 1).alias("correct_b"),
                    cls.alias("outcome"))


def pair_ref_pred(references: DataFrame, predictions: DataFrame) -> DataFrame:
    """keyed pairing of references and predictions (inner join on ``sample_id``)."""
    return predictions.join(references, "sample_id", "inner")
