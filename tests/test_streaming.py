"""Incremental scoring gives the same rows as the batch scoring."""

import tempfile

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


def test_stream_equals_batch(spark):
    from chatscope.operators import scoring as S
    from chatscope.operators.records import parse_records, split_filter, valid
    from chatscope.plans import fixtures as FX
    from chatscope.streaming.scoring import score_missing, start_scoring

    targets = S.eval_targets(split_filter(valid(parse_records(FX.tool_records(spark, SF_SMALL))), "eval"))
    gens = FX.generations(spark, SF_SMALL)
    src = tempfile.mkdtemp(prefix="gens-")
    out = tempfile.mkdtemp(prefix="scored-")
    gens.write.mode("overwrite").json(src)
    q = start_scoring(spark, src, targets, ["fine_tuned", "baseline"], out, name="t" + src[-6:])
    q.awaitTermination(300)
    written = spark.read.parquet(out)
    missing = score_missing(written, targets, ["fine_tuned", "baseline"])
    assert missing.count() > 0 and missing.where("correct").count() == 0
    got = written.unionByName(missing).select("model", "sample_id", "correct")
    want = S.score(S.align_generations(targets, S.extract_outputs(gens), ["fine_tuned", "baseline"])) \
        .select("model", "sample_id", "correct")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert got.where(F.col("correct")).count() > 0


def test_model_factory_runs_once_per_worker(spark):
    """The factory is cached per Python worker, not rebuilt for every task."""
    import os

    import pandas as pd

    from chatscope.operators.inference import batch_generate

    def make():
        pid = os.getpid()
        stamp = str(id(object()))  # differs for every factory call

        def fn(s: pd.Series) -> pd.Series:
            return pd.Series([f"{pid}:{stamp}"] * len(s))
        return fn

    df = spark.range(0, 400, numPartitions=40).selectExpr("id", "cast(id as string) as prompt")
    out = batch_generate(df, make, "prompt", "output", ["id"]).collect()
    by_pid = {}
    for r in out:
        pid, stamp = r["output"].split(":")
        by_pid.setdefault(pid, set()).add(stamp)
    assert all(len(stamps) == 1 for stamps in by_pid.values())
