"""Incremental scoring of generations as they land (Structured Streaming).

The reference scores a finished batch of generations; nothing here adds an
operator. When inference workers write generation files continuously, the
same stateless steps run per micro-batch: ``extract_outputs`` on the stream,
a stream-static inner join with the eval targets, ``score``. The checkpoint
lives under the cluster's shared ``spark.checkpoint.dir`` so a restarted
driver or lost executor resumes exactly where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chatscope.operators.scoring import extract_outputs, score
from chatscope.session import scratch_path

GENERATION_SCHEMA = "model string, sample_id long, output string"


def read_generations(spark: SparkSession, path: str, fmt: str = "json", max_files: int | None = None) -> DataFrame:
    """Streaming source of ``(model, sample_id, output)`` files (explicit schema, no inference)."""
    r = spark.readStream.schema(GENERATION_SCHEMA).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def scored_stream(generations: DataFrame, targets: DataFrame, models: list[str]) -> DataFrame:
    """Stream ⋈ static targets (one row per target and model) → scored rows."""
    t = targets.select("*", F.explode(F.array(*[F.lit(m) for m in models])).alias("model"))
    return score(extract_outputs(generations).join(t, ["model", "sample_id"], "inner"))


def score_missing(scored: DataFrame, targets: DataFrame, models: list[str]) -> DataFrame:
    """Scored rows of the targets that no generation has reached (run once the stream has ended).

    A stream cannot know that a generation will never come; ``scored`` is what it has written.
    """
    t = targets.select("*", F.explode(F.array(*[F.lit(m) for m in models])).alias("model"))
    left = t.join(scored.select("model", "sample_id"), ["model", "sample_id"], "left_anti")
    none = left.withColumns({"output_names": F.lit(None).cast("array<string>"), "output_text": F.lit(None).cast("string"),
                             "output_arguments": F.lit(None).cast("array<string>")})
    return score(none)


def start_scoring(spark: SparkSession, generations_path: str, targets: DataFrame, models: list[str],
                  out_path: str, name: str = "scoring", available_now: bool = True) -> StreamingQuery:
    """Write scored rows as Parquet; ``available_now`` processes what exists and stops."""
    ckpt = scratch_path(spark, f"streams/{name}")
    w = (scored_stream(read_generations(spark, generations_path), targets, models)
         .writeStream.format("parquet").option("path", out_path).option("checkpointLocation", ckpt)
         .outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
