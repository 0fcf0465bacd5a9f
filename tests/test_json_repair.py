import json
import random

import pytest
from pyspark.sql import functions as F

from chatscope.operators.records import close_json, parse_records, repair_json, repair_kind

CASES = [
    ('[{"role": "user", "content": "hal', [{"role": "user", "content": "hal"}]),
    ('{"a": [1, 2, {"b": "x"', {"a": [1, 2, {"b": "x"}]}),
    ('{"a": [1 2 "x" {"b": 1} {"c": 2}]}', {"a": [1, 2, "x", {"b": 1}, {"c": 2}]}),
    ('{"a": 1 "b": 2}', {"a": 1, "b": 2}),
    ('[{"a": {"b": 1]', [{"a": {"b": 1}}]),
    ('{"a": [1, 2}', {"a": [1, 2]}),
    ('[1, 2]]', [1, 2]),
    ('{"a":', {"a": None}), ('{"a": 1, "b', {"a": 1, "b": None}), ('{"a', {"a": None}), ('{"a": }', {"a": None}),
    ('{"a": 1,', {"a": 1}), ('[1,,2,]', [1, 2]), ("[", []), ("{", {}), ('[1, 12.', [1, 12]), ('{"a": tru', {"a": "tru"}),
    ("{'it': 'a \"quoted\" word', key: None, 'n': [True, False", {"it": 'a "quoted" word', "key": None, "n": [True, False]}),
    ('{"a": "x\ny\tz"}', {"a": "x\ny\tz"}), ('["back\\\\', ["back\\"]), ('["half \\u00', ["half "]), ('["half \\', ["half "]),
    ('["keep , } ] None \\" inside" "b"', ['keep , } ] None " inside', "b"]),
    ('﻿ {"a": "b"', {"a": "b"}),
    ('["\\\\n", "a\\nb", "it\'s', ["\\n", "a\nb", "it's"]),
    # no way: no colon, no structure, empty, null
    ('{"a" 1}', None), ("hello", None), ("", None), (None, None), ('{1: {"a": 1, "a": 2', None),
]


def test_cases(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, t string")
    got = {r.i: r.j for r in df.select("i", F.to_json(repair_json("t")).alias("j")).collect()}
    for i, (text, want) in enumerate(CASES):
        assert (None if got[i] is None else json.loads(got[i])) == want, text


@pytest.mark.parametrize("seed", [1, 2])
def test_every_cut_of_a_document_is_closed(spark, seed):
    """Cut anywhere, a document keeps its beginning: every string and number of the result begins one of the whole."""
    rng = random.Random(seed)

    def value(depth):
        kind = rng.choice(["s", "n", "l", "o"] if depth < 3 else ["s", "n"])
        if kind == "s":
            return rng.choice(['a "q" b', "back\\slash", "{x: [1,", "ü\n😀", "", "None, True"]) + str(rng.randint(0, 99))
        if kind == "n":
            return rng.choice([1, -20, 3.5, True, None])
        return [value(depth + 1) for _ in range(rng.randint(0, 3))] if kind == "l" else {
            f"k{k}": value(depth + 1) for k in range(rng.randint(0, 3))}

    def leads(part, whole):
        if isinstance(whole, dict) and isinstance(part, dict):
            names = list(whole)
            return all(k in whole and leads(v, whole[k]) or v is None and any(n.startswith(k) for n in names)
                       for k, v in part.items())
        if isinstance(whole, list) and isinstance(part, list):
            return len(part) <= len(whole) and all(map(leads, part, whole))
        if isinstance(whole, str):
            return part is None or isinstance(part, str) and whole.startswith(part)
        return part is None or part == whole or str(whole).lower().startswith(str(part).lower().strip("-")) or str(
            json.dumps(whole)).startswith(str(part))

    rows = []
    for d in range(6):
        doc = {"first": value(0), "list": [value(0), value(0)], "last": value(0)}
        text = json.dumps(doc, ensure_ascii=False)
        rows += [(d * 10_000 + k, text[:k], text) for k in range(1, len(text) + 1)]
    df = spark.createDataFrame(rows, "i int, t string, w string")
    for r in df.select("t", "w", F.to_json(repair_json("t")).alias("j"), repair_kind("t").alias("k")).collect():
        assert r.j is not None, r.t
        assert leads(json.loads(r.j), json.loads(r.w)), (r.t, r.j)
        assert r.k == ("strict" if r.t == r.w else "structural"), (r.t, r.k)


def test_lost_commas_and_closers(spark):
    doc = [{"role": "user", "content": "a, b] {c}"}, {"x": [1, 2, [3]], "y": {"z": "q"}}]
    text = json.dumps(doc)
    variants = [text.replace("}, {", "} {"), text.replace('", "', '" "'), text.replace("2, [", "2 ["), text[:-1], text[:-2],
                text + "]", text.replace("}}", "}")]
    df = spark.createDataFrame([(v,) for v in variants], "t string")
    assert [json.loads(r.j) for r in df.select(F.to_json(repair_json("t")).alias("j")).collect()] == [doc] * len(variants)


def test_long_texts_take_linear_time(spark):
    text = "[" + " ".join(json.dumps({"n": i, "t": "x" * 20}) for i in range(20_000)) + ', "' + "y" * 1_000_000
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(F.size(F.from_json(close_json("t"), "array<string>")).alias("n")).first()
    assert row.n == 20_001


def test_parse_records_tells_structural_repair_apart(spark):
    rows = [(1, '[{"role": "user", "content": "cut he'), (2, "[{'role': 'user', 'content': 'x'}]"), (3, '[{"role": "user", "content": "x"}]'),
            (4, "no structure")]
    df = spark.createDataFrame([(i, json.dumps({"messages": m, "tools": [], "metadata": "train"})) for i, m in rows], "i int, text string")
    got = {r.i: (r.decoded_from, r.reason, r.messages and r.messages[0].content) for r in parse_records(df).collect()}
    assert got == {1: ("structural", None, "cut he"), 2: ("repaired", None, "x"), 3: ("string", None, "x"),
                   4: ("failed", "messages_unparseable", None)}
