"""Exact consecutive ranks and scan spreading."""

from pyspark.sql import functions as F


def test_consecutive_index_is_exact_permutation(spark):
    from chatscope.operators.sampling import consecutive_index
    df = spark.range(0, 5000).select(F.md5(F.col("id").cast("string")).alias("k"), "id")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for width in ("1", "7", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", width)
            rows = consecutive_index(df.repartition(13), ["k", "id"]).collect()
            by_idx = sorted(rows, key=lambda r: r["idx"])
            assert [r["idx"] for r in by_idx] == list(range(5000))
            assert [r["k"] for r in by_idx] == sorted(r["k"] for r in rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_tables_are_spread_only_where_the_session_says_so(spark):
    from chatscope.plans import fixtures as FX
    from tests.conftest import SF_SMALL
    assert FX.table(spark, SF_SMALL, "events").rdd.getNumPartitions() == int(spark.conf.get(FX.SPREAD_CONF))
    before = spark.conf.get(FX.SPREAD_CONF)
    spark.conf.unset(FX.SPREAD_CONF)
    try:
        plain = FX.table(spark, SF_SMALL, "events")
        assert "Exchange" not in plain._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(FX.SPREAD_CONF, before)


def test_csv_export_keeps_nulls_and_empty_strings_apart(spark, tmp_path):
    from chatscope.sources.sinks import export_csv, read_csv_export
    rows = [(1, None, "a"), (2, "", 'line\n"two", é'), (3, " padded ", None)]
    df = spark.createDataFrame(rows, "i int, a string, b string")
    export_csv(df, f"{tmp_path}/x")
    export_csv(df.limit(0), f"{tmp_path}/x")  # there already: skipped
    assert sorted(map(tuple, read_csv_export(spark, f"{tmp_path}/x", df.schema).collect())) == rows


def test_fraction_sample_is_the_same_on_every_run(spark):
    from chatscope.operators.sampling import sample_fraction
    one = {r.id for r in sample_fraction(spark.range(0, 20000, numPartitions=3), "id", 0.1).collect()}
    two = {r.id for r in sample_fraction(spark.range(0, 20000, numPartitions=7), "id", 0.1).collect()}
    assert one == two and abs(len(one) - 2000) < 200
    assert sample_fraction(spark.range(100), "id", 0.0).count() == 0 and sample_fraction(spark.range(100), "id", 1.0).count() == 100


def test_written_tables_are_released(spark):
    import os

    from chatscope import session
    t = session.materialize(spark.range(3))
    path = session._WRITTEN[-1]
    assert t.count() == 3 and os.path.exists(path.removeprefix("file:"))
    kept, session._WRITTEN[:] = session._WRITTEN[:-1], [path]
    assert session.release_tables(spark) == 1 and not os.path.exists(path.removeprefix("file:"))
    session._WRITTEN[:] = kept


def test_csv_export_keeps_texts_that_look_like_nulls(spark, tmp_path):
    from chatscope.sources.sinks import export_csv, read_csv_export
    texts = ["\\N", "\\\\N", "\\\\\\N", "\\Nx", "x\\N", "N", "\\", "\\\\", None, "", 'a "q", \\N\r\nb', "\\N\n"]
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i long, t string")
    export_csv(df, f"{tmp_path}/x")
    assert sorted(map(tuple, read_csv_export(spark, f"{tmp_path}/x", df.schema).collect())) == rows
    raw = "".join(p.read_text() for p in (tmp_path / "x").glob("*.csv"))
    assert '"\\Nx"' in raw  # other texts are written as they are
