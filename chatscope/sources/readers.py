"""Sources (A1, A3, A4)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatscope.functions.text import json_escape_body, py_strip


def read_text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A1: one row per text line, column ``text`` (splittable, parallel scan)."""
    return spark.read.text(path).withColumnRenamed("value", "text")


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def is_complete(spark: SparkSession, path: str) -> bool:
    """The table at ``path`` was written to its end (its ``_SUCCESS`` marker is there)."""
    p, fs = _hadoop_path(spark, f"{path.rstrip('/')}/_SUCCESS")
    return fs.exists(p)


def cached_dataset(spark: SparkSession, path: str, build: Callable[[], DataFrame],
                   partition_by: str | None = None) -> DataFrame:
    """A3: load the Parquet table at ``path`` if it is complete, else build, publish and load it.

    The table is built under a path of its own beside ``path`` and then renamed
    to it, so readers see a whole table or none. Of several builders the first to rename
    wins and the others read its table. Something at ``path`` that is
    no complete table is an error, never served and never overwritten.
    """
    if not is_complete(spark, path):
        target, fs = _hadoop_path(spark, path)
        if fs.exists(target):
            raise RuntimeError(f"{path} exists but is no complete table (no _SUCCESS marker)")
        own = f"{path.rstrip('/')}.build-{uuid.uuid4().hex}"
        w = build().write.mode("errorifexists")
        (w.partitionBy(partition_by) if partition_by else w).parquet(own)
        made, _ = _hadoop_path(spark, own)
        if fs.exists(target) or not fs.rename(made, target):
            fs.delete(made, True)
            if not is_complete(spark, path):
                raise RuntimeError(f"could not publish {path}")
        else:
            nested = target.suffix("/" + made.getName())
            if fs.exists(nested):  # some file systems rename into a folder that another builder has just made
                fs.delete(nested, True)
    return spark.read.parquet(path)


def prompt_lines(df: DataFrame, line_col: str = "line") -> DataFrame:
    """A4 + C6: strip each line, reject blanks, JSON-escape without the outer quotes.

    Adds ``user_prompt`` (escaped) and ``rejected`` (blank after strip).
    """
    stripped = py_strip(F.col(line_col))
    return df.withColumn("_s", stripped).select(
        "*", json_escape_body(F.col("_s")).alias("user_prompt"), (F.length("_s") == 0).alias("rejected")
    ).drop("_s")


def read_prompt_file(spark: SparkSession, path: str) -> DataFrame:
    """A4 over a text file: ``(line, user_prompt, rejected)``."""
    return prompt_lines(read_text_lines(spark, path).withColumnRenamed("text", "line"))
