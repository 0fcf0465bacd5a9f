"""Shared helpers: table access, the shared scratch folder, bounded parallel widths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatscope.session import materialize

__all__ = ["materialize", "table", "crc32_mod", "as_text", "shuffle_width", "free_name", "for_rows"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crc32_mod(doc_id: Column | str, n: int) -> Column:
    """crc32 of the id's decimal text modulo ``n`` (null id: null)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % n


def as_text(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, base: str) -> str:
    """A column name not used by ``df`` (case-insensitive)."""
    used = {c.lower() for c in df.columns}
    name = base
    while name.lower() in used:
        name += "_"
    return name


ROWS_PER_TASK = 250_000


def for_rows(df: DataFrame, n: int) -> DataFrame:
    """``df`` in as few partitions as ``n`` narrow rows need, so that small steps do not pay for many tasks."""
    return df.coalesce(max(1, -(-n // ROWS_PER_TASK)))
