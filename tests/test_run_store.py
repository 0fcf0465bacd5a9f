import json
import threading

import pytest

from chatscope.operators import run_store
from chatscope.operators.run_store import RunStore


def frame(spark, configs, start=1):
    return spark.createDataFrame([(start + i, c if c is None or isinstance(c, str) else json.dumps(c)) for i, c in enumerate(configs)],
                                 "config_id long, config string").coalesce(1)


def slots(df):
    return [(r.config_id, r.run_id, r.reused) for r in df.orderBy("config_id").collect()]


CONFIGS = [{"lr": 1, "m": {"a": 1}}, {"lr": 1}, {"lr": 2}, {"lr": 1, "m": {"a": 1}, "epochs": 9}, {"lr": 1.0}, {}, None, "{bad", "[1]"]


def test_slots_are_stored_and_found_again(spark, tmp_path):
    store = RunStore(spark, str(tmp_path / "runs"))
    assert store.version() == 0 and store.read().collect() == []
    first = slots(store.register(frame(spark, CONFIGS), ["epochs"]))
    # one after another: 2, 4 (but for epochs), 5 and 6 are held by run 1
    want = [(1, 1), (2, 1), (3, 2), (4, 1), (5, 1), (6, 1), (7, None), (8, None), (9, None)]
    assert first == [(c, r, False) for c, r in want]
    assert {r.run_id: json.loads(r.config) for r in store.read().collect()} == {1: CONFIGS[0], 2: CONFIGS[2]}
    again = slots(store.register(frame(spark, CONFIGS), ["epochs"]))
    assert again == [(c, r, r is not None) for c, r in want] and store.version() == 1
    more = slots(store.register(frame(spark, [{"lr": 3}, {"lr": 2}], 50), ["epochs"]))
    assert more == [(50, 3, False), (51, 2, True)] and store.version() == 2
    assert store.read(1).count() == 2 and store.read().count() == 3


def test_one_call_equals_one_by_one(spark, tmp_path):
    configs = [{"b": 1}, {"a": 1, "b": 1}, {"a": 1}, {"a": 1, "b": 1, "c": {"d": 2}}, {"c": {"d": 2}}, {"b": 1}]
    together = slots(RunStore(spark, str(tmp_path / "x")).register(frame(spark, configs)))
    store, apart = RunStore(spark, str(tmp_path / "y")), []
    for i, c in enumerate(configs):
        apart += slots(store.register(frame(spark, [c], i + 1)))
    assert [x[:2] for x in together] == [x[:2] for x in apart]


def test_a_lost_race_is_matched_again(spark, tmp_path, monkeypatch):
    store, other = RunStore(spark, str(tmp_path / "runs")), RunStore(spark, str(tmp_path / "runs"))
    publish, raced = RunStore._publish, []

    def late(self, version, content):
        if self is store and not raced:
            raced.append(slots(other.register(frame(spark, [{"x": 1}, {"y": 1}], 10))))
        return publish(self, version, content)

    monkeypatch.setattr(RunStore, "_publish", late)
    mine = slots(store.register(frame(spark, [{"y": 1}, {"z": 1}], 20)))
    assert raced == [[(10, 1, False), (11, 2, False)]]
    assert mine == [(20, 2, True), (21, 3, False)]  # equal configurations share, different ones do not
    assert sorted(r.run_id for r in store.read().collect()) == [1, 2, 3]
    assert len(list((tmp_path / "runs" / "data").iterdir())) == 2  # the loser's folder is gone


def test_concurrent_callers(spark, tmp_path):
    got, path = {}, str(tmp_path / "runs")

    def call(k):
        got[k] = slots(RunStore(spark, path).register(frame(spark, [{"shared": 1}, {"own": k}], 10 * k)))

    threads = [threading.Thread(target=call, args=(k,)) for k in (1, 2, 3)]
    for x in threads:
        x.start()
    for x in threads:
        x.join()
    shared, own = [got[k][0][1] for k in got], [got[k][1][1] for k in got]
    assert len(set(shared)) == 1 and len({*own, *shared}) == 4
    assert sorted(r.run_id for r in RunStore(spark, path).read().collect()) == [1, 2, 3, 4]


def test_whole_versions_and_failures(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(run_store, "WHOLE_EVERY", 2)
    store = RunStore(spark, str(tmp_path / "runs"))
    for k in range(5):
        store.register(frame(spark, [{"k": k}], k))
    assert store.version() == 5 and len(store._folders(5)) == 2 and len(store._folders(4)) == 1
    assert [store.read(v).count() for v in range(1, 6)] == [1, 2, 3, 4, 5]

    def broken(self, version, content):
        raise OSError("disk")

    monkeypatch.setattr(RunStore, "_publish", broken)
    with pytest.raises(OSError):
        store.register(frame(spark, [{"k": 99}], 99))
    assert store.version() == 5 and store.read().count() == 5


def test_documents_of_any_depth_keep_their_row(spark):
    from chatscope.operators import registry as R
    deep = {n: '{"a":' + "[" * n + "1.0" + "]" * n + ', "b": 2.0}' for n in (10, 2_000, 20_000)}
    df = spark.createDataFrame(list(deep.items()), "config_id long, config string").coalesce(1)
    got = {r.config_id: (r.status, [n.path for n in r.nodes], [n.entry[-3:] for n in r.nodes]) for r in R.with_nodes(df).collect()}
    assert got[10] == got[2_000] == ("ok", ["a", "b"], ["]]]", "R\u00012"]) and "1.0" not in got[2_000][2][0]
    assert got[20_000] == ("too_deep", [], [])
    value = {"b": [1, 2.0, {"x": []}], "a": {"z": 1e3, "y": 'é"', "q": {}}}
    assert R._plain_numbers(value) == {"b": [1, 2, {"x": []}], "a": {"z": 1000, "y": 'é"', "q": {}}} and value["b"][1] == 2.0


def test_deep_values_are_written_alike(monkeypatch):
    from chatscope.operators import registry as R
    value = {"b": [1, 2.0, {"x": [], "w": None}], "a": {"z": 1e3, "y": 'é"', "q": {}}}
    plain, whole = R._dump(value), json.dumps

    def shallow(v, **options):
        if isinstance(v, (dict, list)) and v:
            raise RecursionError
        return whole(v, **options)

    monkeypatch.setattr(R.json, "dumps", shallow)
    assert R._dump(value) == plain
