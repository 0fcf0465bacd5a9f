"""Steps whose work must not end in the driver, in one task or in spilled n-gram rows."""

import datetime

import pytest

import __spark_entry__ as E


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def events(spark, tmp_path):
    """A folder with one small file of events, in a session that does not say how to spread it."""
    from chatscope.plans.fixtures import SPREAD_CONF
    at = datetime.datetime(2024, 1, 1)
    rows = [(i, at, i % 7, ("view", "click")[i % 2], float(i), f'{{"k": {i % 9}}}') for i in range(64)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string") \
        .coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    old = spark.conf.get(SPREAD_CONF, None)
    spark.conf.unset(SPREAD_CONF)
    yield str(tmp_path)
    if old:
        spark.conf.set(SPREAD_CONF, old)


def test_records_of_one_file_are_parsed_by_many_tasks(spark, events):
    from chatscope.plans import fixtures as FX
    assert FX.events(spark, events).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    for name in ("split_train", "repair_json_structure", "cap_eval", "compare_models"):
        assert "REPARTITION_BY_NUM" in _plan(E.queries()[name](spark, events)), name
    assert E.queries()["repair_json_structure"](spark, events).count() == 64
    files = {r.f for r in E.queries()["export_csv_roundtrip"](spark, events).selectExpr("input_file_name() AS f").collect()}
    assert len(files) > 1


def test_prompts_are_never_broadcast(spark, events):
    for name in ("strip_prompt_prefix", "compare_models"):
        assert "Broadcast" not in _plan(E.queries()[name](spark, events)), name


def test_grams_are_counted_without_rows_of_grams(spark, monkeypatch):
    """Blocks of any size give what counting one pair at a time gives; plans hold no n-gram rows, and no sort."""
    import random
    from collections import Counter

    import pyarrow as pa

    from chatscope.functions import grams
    from chatscope.operators import metrics as M
    rng = random.Random(5)
    tokens = lambda: [rng.choice(["a", "b", "ab", "é", "\U0001F600"]) for _ in range(rng.randint(0, 12))]
    pred, ref = [tokens() for _ in range(60)] + [None, []], [tokens() for _ in range(60)] + [["a"], []]
    orders = (1, 3, 6)

    def plain(p, r):
        cut = lambda t, n: Counter(tuple(t[i:i + n]) for i in range(len(t) - n + 1))
        return [{"n": n, "match": (cut(p, n) & cut(r, n)).total(), "hyp": cut(p, n).total(), "ref": cut(r, n).total()} for n in orders]

    for block in (1, 7, 1 << 19):
        monkeypatch.setattr(grams, "BLOCK_ITEMS", block)
        lists = [pa.array(x, pa.list_(pa.string())) for x in (pred, ref)]
        assert grams.clipped_counts(*lists, orders).to_pylist() == [plain(p or [], r) for p, r in zip(pred, ref)]
        texts = [["".join(x or []) for x in side] for side in (pred, ref)]
        assert grams.clipped_counts(*map(pa.array, texts), orders).to_pylist() == [plain(p, r) for p, r in zip(*texts)]
    assert grams.clipped_counts(pa.array([], pa.string()), pa.array([], pa.string()), orders).to_pylist() == []
    pairs = spark.createDataFrame([("m", 1, "a b", "a c"), ("m", 1, "a b", "a c"), ("m", 2, None, "x")],
                                  "model string, sample_id long, reference string, prediction string")
    for metric in (M.chrf, M.bleu, M.rouge_n):
        plan = _plan(metric(pairs))
        assert "Generate explode" not in plan and "Sort " not in plan, metric
    assert {r.n: (r.hyp, r.ref, r.match) for r in M.chrf_stats(pairs, 2).collect()} == {1: (4, 4, 2), 2: (2, 2, 0)}


def test_vectors_are_computed_and_dealt_once(spark):
    """One encoder pass and one exchange of its vectors; repeated positions, lone sides and blocks count as by brute force."""
    import random

    import numpy as np

    from chatscope.operators.encoding import encode_tokens, make_hash_encoder
    from chatscope.operators.metrics import embedding_match
    pairs = spark.createDataFrame([("m", 1, "a b", "a c"), ("m", 2, None, "x")],
                                  "model string, sample_id long, reference string, prediction string")
    matched = embedding_match(encode_tokens(pairs, make_hash_encoder), keys=("model", "sample_id"))
    assert sorted((r.sample_id, r.f1 > 0) for r in matched.collect()) == [(1, True), (2, False)]
    final = _plan(matched).split("== Initial Plan ==")[0]
    assert final.count("MapInArrow") == 1 and final.count("ReusedExchange") == 1

    rng = random.Random(2)
    rows = [(s, side, rng.randint(0, 9), [rng.uniform(-1, 1) for _ in range(3)])
            for s in range(6) for side in ("pred", "ref") for _ in range(rng.randint(1, 14))]
    rows += [(7, "pred", 0, [1.0, 0.0, 0.0]), (8, "other", 0, [1.0, 0.0, 0.0]), (None, "pred", 0, [1.0, 0.0, 0.0])]

    def means(s):
        sides = [[(p, np.array(e) / np.linalg.norm(e)) for k, side, p, e in rows if k == s and side == want] for want in ("pred", "ref")]
        for a, b in (sides, sides[::-1]):
            best = {}
            for p, x in a:
                for _, y in b:
                    best[p] = max(best.get(p, -2), float(x @ y))
            yield sum(best.values()) / len(best) if best else 0.0

    v = spark.createDataFrame(rows, "sample_id long, side string, pos long, embedding array<float>")
    for chunk in (2, 3, 256):
        got = {r.sample_id: (r.precision, r.recall) for r in embedding_match(v, chunk=chunk).collect()}
        assert set(got) == {*range(6), 7, 8, None}
        for s, pair in got.items():
            assert pair == pytest.approx(tuple(means(s)), abs=1e-6), s


def test_judging_reads_its_rows_once_to_send_and_once_to_answer(spark, tmp_path):
    import uuid

    from chatscope.operators.inference import make_length_judge
    from chatscope.operators.judge_journal import JudgeJournal, resume
    passes = tmp_path / "passes"
    passes.mkdir()

    def noted(batches):
        (passes / uuid.uuid4().hex).write_text("")
        yield from batches

    rows = spark.createDataFrame([("m", i, "ask", "ref", f"answer {i}") for i in range(8)],
                                 "model string, sample_id long, prompt string, reference string, prediction string")
    pairs = rows.coalesce(1).mapInPandas(noted, rows.schema)
    got = resume(JudgeJournal(spark, str(tmp_path / "journal")), pairs, make_length_judge, task_rows=3).collect()
    assert len(got) == 8 and not any(r.failed for r in got)
    assert len(list(passes.iterdir())) == 2
