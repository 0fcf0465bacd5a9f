"""Guards on physical plan shapes the scale design relies on (see PLANS.md)."""

import re

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_parse_not_inlined_into_filters(spark):
    plan = _plan(E.queries()["valid_records"](spark, SF_SMALL))
    assert plan.count("parseJson") <= 12, "the validity filter re-inlined the JSON parse"


def test_ngram_counting_does_not_shuffle_grams(spark):
    for name in ("rouge_n", "bleu_corpus", "chrf_corpus"):
        plan = _plan(E.queries()[name](spark, SF_SMALL))
        exchanges = [line for line in plan.splitlines() if "Exchange" in line]
        assert not any(re.search(r"hashpartitioning\([^)]*\b(gram|g1)\b", x) for x in exchanges), name


def test_no_cartesian_products(spark):
    for name in ("scored_frame", "embedding_match", "assign_run_slot", "attach_tools"):
        plan = _plan(E.queries()[name](spark, SF_SMALL))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_scoring_parses_the_records_once(spark):
    for name in ("scored_frame", "accuracy_by_model", "review_errors"):
        plan = _plan(E.queries()[name](spark, SF_SMALL))
        assert plan.count("FileScan parquet") == 2, name  # targets and generations, each once


def test_first_tools_do_not_parse_the_table(spark):
    plan = _plan(E.queries()["attach_tools"](spark, SF_SMALL))
    assert "parse" not in plan.lower() and plan.count("FileScan parquet") == 1


def test_registry_never_explodes_to_collect_again(spark):
    plan = _plan(E.queries()["config_identical"](spark, SF_SMALL))
    assert "Generate" not in plan and "SortMergeJoin" not in plan
