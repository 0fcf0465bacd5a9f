"""Sinks (B1–B3). Writers are idempotent (``ignore``/``overwrite`` is explicit)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _flatten_for_csv(df: DataFrame) -> DataFrame:
    """CSV has no nested types: arrays, maps, structs and variants become JSON text."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        elif isinstance(f.dataType, T.StringType):  # a text that looks like a null, or like such a text, gets one more backslash
            cols.append(F.regexp_replace(F.col(f.name), r"\A(\\+N)\z", r"\\$1").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(cols)


NULL_TEXT = "\\N"  # a null in an export; the empty string stays the empty string


def export_csv(df: DataFrame, path: str, mode: str = "ignore") -> None:
    """B1: write with a header, skipping if the target exists (``mode='ignore'``).

    Multiline text is quoted and escaped so it reads back row for row.
    """
    (_flatten_for_csv(df).write.mode(mode).option("header", True)
       .option("quoteAll", True).option("escape", '"').option("nullValue", NULL_TEXT).option("emptyValue", "")
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def read_csv_export(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    r = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option(
        "nullValue", NULL_TEXT).option("emptyValue", "")
    if schema:
        r = r.schema(schema)
    df = r.csv(path)
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.regexp_replace(F.col(c), r"\A\\(\\+N)\z", "$1") for c in texts})


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """B2: JSON lines (one object per row). Column-oriented documents do not scale."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def report_document(metrics_long: DataFrame, config: dict, timestamp: str | None = None) -> DataFrame:
    """One-row result document ``{config, models: {model: {metric: value}}, timestamp}``.

    ``metrics_long`` is ``(model, metric, value)``: a handful of rows per model,
    so the final single-row aggregation is bounded by models × metrics.
    """
    per_model = metrics_long.groupBy("model").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "value")))).alias("m"))
    doc = per_model.agg(F.map_from_entries(F.collect_list(F.struct("model", "m"))).alias("models"))
    # config values are literals or scalar-subquery columns (e.g. a sample count)
    cfg = F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in config.items()])
    return doc.select(cfg.alias("config"), "models", F.lit(timestamp).cast("string").alias("timestamp"))


def write_report(doc: DataFrame, path: str, mode: str = "overwrite") -> None:
    """B3 sink: the document is one row, so one output file."""
    doc.coalesce(1).write.mode(mode).json(path)
