"""Physical-plan guards for the registered queries: no cartesian products or
nested-loop joins, and no Python UDF evaluation in the query plans."""

import pytest

import __spark_entry__ as entry

SKIP = {"train_logreg", "train_forests", "group_folds", "group_holdout"}  # model fits: covered elsewhere
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - SKIP))
def test_plan_has_no_forbidden_operators(spark, sf, name):
    df = entry.queries()[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"


@pytest.mark.parametrize("name", ["long_dedupe", "question_code_fill"])
def test_question_numbering_spreads_over_partitions(spark, sf, name):
    plan = entry.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
