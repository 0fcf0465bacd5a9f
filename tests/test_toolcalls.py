"""Hand-computed cases for call/text extraction (rules 1-6) and exact-match scoring."""

import pytest
from pyspark.sql import functions as F

from chatscope.functions import toolcalls as TC

S, E = "<start_function_call>", "<end_function_call>"


CASES = [
    (S + "call:open_map{query:<escape>San Francisco<escape>}" + E, [("open_map", [("query", "San Francisco")])]),
    (S + "call:f{a:<escape>x, y: }<escape>,b:<escape>line1\nline2<escape>}" + E,
     [("f", [("a", "x, y: }"), ("b", "line1\nline2")])]),
    (S + "open_map{q:<escape>1<escape>}" + E, []),                      # no call: prefix
    (S + "call:ping{}" + E, [("ping", [])]),                             # no arguments
    (S + "call:nobrace" + E, []),                                         # no brace: dropped
    (S + "call:f{k:<escape>0<escape>,k:<escape>7<escape>}" + E, [("f", [("k", "7")])]),  # last wins
    ("Sure, calling now. " + S + "call:f{k:<escape>1<escape>}" + E, [("f", [("k", "1")])]),
    ("", []),
    (None, []),
    (S + "  call:call:g { k :<escape> v <escape>}  " + E, [("g", [("k", " v ")])]),
    (S + "call:a{x:<escape>1<escape>}" + E + S + "call:b{y:<escape>2<escape>}" + E,
     [("a", [("x", "1")]), ("b", [("y", "2")])]),
]


@pytest.fixture(scope="module")
def extracted(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, output string")
    rows = df.select("i", TC.extract_calls("output").alias("c"), TC.extract_text("output").alias("t")).collect()
    return {r["i"]: r for r in rows}


@pytest.mark.parametrize("idx", range(len(CASES)))
def test_extract_calls(extracted, idx):
    got = [(c["name"], sorted((a["key"], a["value"]) for a in c["arguments"])) for c in extracted[idx]["c"]]
    assert got == CASES[idx][1]


def test_extract_text(extracted):
    assert extracted[0]["t"] is None                      # starts with a call marker
    assert extracted[7]["t"] is None and extracted[8]["t"] is None
    assert extracted[6]["t"] == "Sure, calling now. " + S + "call:f{k:<escape>1<escape>}" + E


def test_type_strict_arguments(spark):
    """A target number never equals an extracted string; key order does not matter."""
    from chatscope.operators.records import parse_records
    from chatscope.operators.scoring import eval_targets, extract_outputs, score
    rec = ('{"messages": [{"role": "developer", "content": "d"}, {"role": "user", "content": "u"}, '
           '{"role": "assistant", "tool_calls": [{"function": {"name": "f", "arguments": ARGS}}]}], '
           '"tools": [], "metadata": "eval"}')
    recs = spark.createDataFrame([(1, rec.replace("ARGS", '{"level": 20}')),
                                  (2, rec.replace("ARGS", '{"b": "2", "a": "1"}'))], "sample_id long, text string")
    gens = spark.createDataFrame([("m", 1, S + "call:f{level:<escape>20<escape>}" + E),
                                  ("m", 2, S + "call:f{a:<escape>1<escape>,b:<escape>2<escape>}" + E)],
                                 "model string, sample_id long, output string")
    t = eval_targets(parse_records(recs))
    j = t.select("*", F.lit("m").alias("model")).join(extract_outputs(gens), ["model", "sample_id"], "left")
    res = {r["sample_id"]: r for r in score(j).collect()}
    assert res[1]["correct_names"] and not res[1]["correct_arguments"]
    assert res[2]["correct"]
    loose = {r["sample_id"]: r for r in score(j, strict_types=False).collect()}
    assert loose[1]["correct"]


def test_many_arguments_take_linear_time(spark):
    import time

    from chatscope.functions.toolcalls import extract_calls

    def call(n):
        return "<start_function_call>call:f{" + ",".join(f"k{i % (n - n // 10)}:<escape>v{i}<escape>" for i in range(n)) + "}<end_function_call>"

    def seconds(n):
        df = spark.createDataFrame([(call(n),)], "o string").select(extract_calls("o").alias("c"))
        t0 = time.perf_counter()
        args = {a.key: a.value for a in df.first().c[0].arguments}
        assert len(args) == n - n // 10 and args["k0"] == f"v{n - n // 10}" and args[f"k{n // 2}"] == f"v{n // 2}"
        return time.perf_counter() - t0

    seconds(100)
    assert seconds(3200) < 15  # 800 arguments took 20 s when the pairs were cut again for each pair
