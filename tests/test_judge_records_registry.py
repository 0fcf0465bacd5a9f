"""Judge parsing (all-or-nothing), record validation, registry and escaping."""

import json

import pytest

FENCE = "```"


@pytest.mark.parametrize("reply,expected,failed", [
    ('{"accuracy": 8, "relevance": 9, "tone": 7}', (8, 9, 7), False),
    ("ok\n" + FENCE + 'json\n{"accuracy": 1, "relevance": 2, "tone": 3}\n' + FENCE, (1, 2, 3), False),
    (FENCE + '\n{"accuracy": 1, "relevance": 2, "tone": 3}\n' + FENCE, (1, 2, 3), False),
    ("no json here", (0, 0, 0), True),
    ('{"accuracy": 4, "relevance": 5}', (4, 5, 0), False),          # missing key -> that key 0
    ('{"accuracy": "6", "relevance": 5, "tone": 1}', (6, 5, 1), False),  # numeric string
    ('{"accuracy": 4, "relevance": null, "tone": 1}', (0, 0, 0), True),   # null zeroes the row
    ('[1, 2, 3]', (0, 0, 0), True),
    ('{"accuracy": 14, "relevance": true, "tone": 1}', (14, 1, 1), False),  # no clamping, bool = 1
    ('{"accuracy": "high", "relevance": 5, "tone": 1}', (0, 0, 0), True),
    ('{"accuracy": {"x": 1}, "relevance": 5, "tone": 1}', (0, 0, 0), True),
])
def test_judge_parse(spark, reply, expected, failed):
    from chatscope.operators.judge import parse_judge_reply
    r = parse_judge_reply(spark.createDataFrame([(reply,)], "reply string")).first()
    assert (r["accuracy"], r["relevance"], r["tone"]) == tuple(float(x) for x in expected)
    assert r["failed"] == failed


def test_records_quarantine_row_for_row(spark):
    from chatscope.operators.records import parse_records, quarantine, valid
    lines = [
        '{"messages": [{"role": "user", "content": "hi"}], "tools": [], "metadata": "train"}',
        '{"messages": "[{\'role\': \'user\', \'content\': \'hi\'}]", "tools": "[]", "metadata": "eval"}',
        '{"messages": "[{\\"role\\": \\"user\\",}]", "tools": [], "metadata": "train"}',
        '{"messages": [], "metadata": "train"}',
        '{"messages": [',
        '[1, 2]',
        '{"messages": {"a": 1}, "tools": [], "metadata": "train"}',
        '{"messages": [], "tools": []}',
    ]
    df = spark.createDataFrame(list(enumerate(lines)), "sample_id long, text string")
    p = parse_records(df)
    reasons = {r["sample_id"]: r["reason"] for r in p.collect()}
    assert reasons == {0: None, 1: None, 2: None, 3: "missing_tools", 4: "invalid_json", 5: "not_object",
                       6: "messages_not_list", 7: "missing_metadata"}
    assert valid(p).count() + quarantine(p).count() == len(lines)
    how = {r["sample_id"]: r["decoded_from"] for r in valid(p).collect()}
    assert how == {0: "native", 1: "repaired", 2: "repaired"}


def test_json_escape_matches_python(spark):
    from pyspark.sql import functions as F

    from chatscope.functions.text import json_escape_body
    samples = ['call "Ana\'s" desk \\ ext. 7', "tab\there", "é ü ß", "emoji 😀 ok",
               "ctrl \x01\x1f end", 'quote " and back \\ slash', ""]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r[0] for r in df.select(json_escape_body(F.col("s"))).collect()]
    assert got == [json.dumps(s)[1:-1] for s in samples]


def test_registry_prune_and_slots(spark):
    from chatscope.operators.registry import assign_run_slot, explode_nodes, paths_of, prune, with_nodes
    cfg = spark.createDataFrame([
        (1, '{"a": 1, "b": {"c": 2, "d": 3}, "e": 5}'),
        (2, '{"a": 1, "b": {"c": 2, "d": 4}}'),
        (3, '{"a": 2, "b": {"c": 2, "d": 3}}'),
        (4, '{"a": 1, "b": {"c": 2, "d": 9}}'),
    ], "config_id long, config string")
    nodes = with_nodes(cfg)
    kept = {(r["config_id"], r["path"]) for r in explode_nodes(prune(nodes, paths_of(nodes, 2), ["b/d"])).collect()}
    assert (1, "e") not in kept and (1, "b/d") not in kept and (1, "b/c") in kept and (1, "b") in kept
    registry = spark.createDataFrame([(10, '{"a": 1, "b": {"c": 2, "d": 0}}')], "run_id long, config string")
    slots = {r["config_id"]: (r["run_id"], r["reused"]) for r in assign_run_slot(cfg, registry, ["b/d"]).collect()}
    # 2 and 4 equal the stored run once b/d is excepted; 1 has a key that the stored run lacks,
    # 3 differs in a -> new slots in order of first id
    assert slots[2] == (10, True) and slots[4] == (10, True)
    assert slots[1] == (11, False) and slots[3] == (12, False)


def test_every_document_keeps_a_row_at_any_depth(spark):
    from chatscope.operators.registry import assign_run_slot, config_identical, key_paths, match_registry, with_nodes

    def nest(leaf, depth=300):
        return "".join(f'{{"k{i}":' for i in range(depth)) + leaf + "}" * depth

    docs = [(1, '{"a": 1}'), (2, "{}"), (3, "not json"), (4, None), (5, "[1]"), (6, nest("1")), (7, nest("2")),
            (8, '{"a": 1e0}'), (9, '{"a": 2, "a": 1}'), (10, '{"a": true}')]
    cfg = spark.createDataFrame(docs, "config_id long, config string")
    rows = key_paths(cfg).collect()
    assert {r.config_id for r in rows} == {d for d, _ in docs}
    assert {r.config_id: r.status for r in rows} == {
        1: "ok", 2: "ok", 3: "invalid_json", 4: "null", 5: "not_object", 6: "ok", 7: "ok", 8: "ok", 9: "ok", 10: "ok"}
    assert max(r.depth for r in rows if r.config_id == 6) == 300
    same = {r.config_id: r.identical for r in config_identical(with_nodes(cfg), 6).collect()}
    assert same == {d: d == 6 for d, _ in docs}
    assert {r.config_id for r in config_identical(with_nodes(cfg), 1).collect() if r.identical} == {1, 8, 9}
    stored = spark.createDataFrame([(5, nest("1")), (3, '{"a": 1.0, "extra": 5}'), (9, '{"extra": 5, "a": 1}'), (4, "broken")],
                                   "run_id long, config string")
    hit = {r.config_id: (r.matched_run, r.n_matches) for r in match_registry(cfg, stored).collect()}
    assert hit == {1: (3, 2), 2: (3, 3), 3: (None, 0), 4: (None, 0), 5: (None, 0), 6: (5, 1), 7: (None, 0), 8: (3, 2),
                   9: (3, 2), 10: (None, 0)}
    slots = {r.config_id: (r.run_id, r.reused) for r in assign_run_slot(cfg, stored).collect()}
    assert slots == {1: (3, True), 2: (3, True), 3: (None, False), 4: (None, False), 5: (None, False), 6: (5, True),
                     7: (10, False), 8: (3, True), 9: (3, True), 10: (11, False)}


def test_delete_path_variants(spark):
    from chatscope.operators.registry import delete_path, explode_nodes, with_nodes
    cfg = spark.createDataFrame([(1, '{"a": {"b": 1}, "ab": 2}'), (2, '{"a": {}}'), (3, '{"a": 0}'), (4, '{"c": 1}')],
                                "config_id long, config string")

    def left(**kw):
        return sorted((r.config_id, r.path) for r in explode_nodes(delete_path(with_nodes(cfg), "a", **kw)).collect() if r.path)

    assert left() == [(1, "ab"), (2, "a"), (3, "a"), (4, "c")]
    assert left(keep_falsy=False) == [(1, "ab"), (4, "c")]


def test_run_slots_edge_cases(spark):
    from chatscope.operators.registry import assign_run_slot
    cfg = spark.createDataFrame([(1, '{"a": 1}'), (2, '{"a": 1}')], "config_id long, config string")
    stored = spark.createDataFrame([(7, '{"a": 1}')], "run_id long, config string")
    def slots(registry):
        return sorted((r.config_id, r.run_id, r.reused) for r in assign_run_slot(cfg, registry).collect())

    assert slots(stored) == [(1, 7, True), (2, 7, True)]
    empty = spark.createDataFrame([], "run_id long, config string")
    assert slots(empty) == [(1, 1, False), (2, 1, False)]


def test_judge_failures_do_not_depend_on_the_batch(spark):
    """One failing row of forty gives one failed row, whatever the batch size."""
    import pandas as pd

    from chatscope.operators.judge import SYSTEM_PROMPT, judge_batch

    def make(system_prompt):
        def fn(prompts: pd.Series) -> pd.Series:
            assert system_prompt == SYSTEM_PROMPT
            if prompts.str.contains("poison").any():
                raise ValueError("refused")
            return prompts.map(lambda p: '{"accuracy": 5, "relevance": 6, "tone": %d}' % (len(p) % 7))
        return fn

    rows = [("m", i, "ask", "ref", "poison" if i == 17 else f"answer {i}") for i in range(40)]
    pairs = spark.createDataFrame(rows, "model string, sample_id long, prompt string, reference string, prediction string").coalesce(1)
    results = [{r.sample_id: (r.accuracy, r.tone, r.failed) for r in judge_batch(pairs, make, batch_size=n).collect()} for n in (1, 16, 64)]
    assert results[0] == results[1] == results[2]
    assert [i for i, r in results[0].items() if r[2]] == [17]


def test_repair_leaves_string_contents_alone(spark):
    from pyspark.sql import functions as F

    from chatscope.operators.records import repair_json
    cases = {
        """{'a': 'Is it True, or None of these?', 'b': True,}""": {"a": "Is it True, or None of these?", "b": True},
        """["pick [a, ] or {b , }", None, ]""": ["pick [a, ] or {b , }", None],
        '{"quote": "say \\"None, ]\\" now", "x": False}': {"quote": 'say "None, ]" now', "x": False},
        "\ufeff{a: 1, 'b': [True, {},],}": {"a": 1, "b": [True, {}]},
        '{"ok": "True"}': {"ok": "True"}, "{broken": None,
    }
    df = spark.createDataFrame(list(enumerate(cases)), "i int, s string")
    got = {r.i: r.j for r in df.select("i", F.to_json(repair_json("s")).alias("j")).collect()}
    assert [json.loads(got[i]) if got[i] else None for i in range(len(cases))] == list(cases.values())


def test_messages_are_validated_and_never_left_out(spark):
    from pyspark.sql import functions as F

    from chatscope.operators.records import parse_records, unwrap_singleton
    from chatscope.operators.template import with_rendered
    rec = lambda m: '{"messages": %s, "tools": [], "metadata": "train"}' % m
    lines = [rec('[{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]'), rec('[{"content": "no role"}]'),
             rec('["text"]'), rec('[{"role": "assistant", "tool_calls": [{"function": {"arguments": {}}}]}]'),
             '{"messages": [], "messages": [], "tools": [], "metadata": "x"}', '{"a": 1, "a": 2'] 
    p = parse_records(spark.createDataFrame(list(enumerate(lines)), "sample_id long, text string"))
    assert {r.sample_id: r.reason for r in p.collect()} == {
        0: None, 1: "message_without_role", 2: "message_not_object", 3: "call_without_name", 4: "duplicate_key", 5: "invalid_json"}
    turns = spark.sql("SELECT 1 AS i, array(named_struct('role', CAST(NULL AS STRING), 'content', 'lost?', 'tool_calls', "
                      "CAST(array() AS array<struct<name:string,arguments:array<struct<key:string,value:string>>>>)),"
                      "named_struct('role', 'user', 'content', 'x', 'tool_calls', "
                      "array(named_struct('name', CAST(NULL AS STRING), 'arguments', "
                      "CAST(array() AS array<struct<key:string,value:string>>))))) AS messages")
    full = with_rendered(turns, "messages").first().full
    assert full.count("<start_of_turn>") == 2 and "lost?" in full and "call:{}" in full
    nests = ["[[[[1, 2]]]]", "[[1],[2]]", "[[]]", "[3]", "{}", "[" * 40 + "5" + "]" * 40, "[[[1],[2]]]"]
    df = spark.createDataFrame(list(enumerate(nests)), "i int, s string")
    got = {r.i: r.u for r in df.select("i", F.to_json(unwrap_singleton(F.try_parse_json("s"))).alias("u")).collect()}
    assert got == {0: "[1,2]", 1: "[[1],[2]]", 2: "[]", 3: "[3]", 4: "{}", 5: "[5]", 6: "[[1],[2]]"}


def test_cached_dataset_serves_whole_tables_only(spark, tmp_path):
    from chatscope.sources.readers import cached_dataset
    path, built = f"{tmp_path}/cache", []

    def build():
        built.append(1)
        return spark.range(5)

    assert cached_dataset(spark, path, build).count() == 5 and cached_dataset(spark, path, build).count() == 5 and len(built) == 1
    assert [x.name for x in tmp_path.iterdir()] == ["cache"]
    spark.range(3).write.parquet(f"{tmp_path}/half")
    (tmp_path / "half" / "_SUCCESS").unlink()
    with pytest.raises(RuntimeError, match="no complete table"):
        cached_dataset(spark, f"{tmp_path}/half", build)

    def slow():  # another builder finishes first
        spark.range(7).write.parquet(f"{tmp_path}/race")
        return spark.range(9)

    assert cached_dataset(spark, f"{tmp_path}/race", slow).count() == 7
    assert sorted(x.name for x in tmp_path.iterdir()) == ["cache", "half", "race"]


def test_shared_dir_is_read_never_set(spark):
    from chatscope import session
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")

    class Bare:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:  # noqa: N801
            master, applicationId = "spark://host:7077", "app"
            _jsc = spark.sparkContext._jsc

    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.shared_dir(Bare)
        Bare.sparkContext.master = "local[2]"
        assert session.shared_dir(Bare) == session.shared_dir(Bare)


def test_turns_without_a_conversation_form_no_group(spark):
    from chatscope.operators.records import assemble_messages, orphan_turns
    turns = spark.createDataFrame([(1, 1, "user", "b"), (1, 0, "user", "a"), (None, 0, "user", "x"), (None, 1, "user", "y")],
                                  "conv_id long, turn int, role string, text string")
    got = assemble_messages(turns).collect()
    assert [(r.conv_id, [m.content for m in r.messages]) for r in got] == [(1, ["a", "b"])]
    assert sorted(r.text for r in orphan_turns(turns).collect()) == ["x", "y"]
