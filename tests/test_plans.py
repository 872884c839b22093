"""Plan guards over every registered query of the plans: no cross products and
no Python step."""

import pytest

import __spark_entry__ as E
from tessera.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry()[0]))
def test_no_cross_join(spark, name):
    df = E.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
    assert "Python" not in plan and "Arrow" not in plan, name


NO_TEXT = ["cluster_sizes", "contingency", "nmi", "pair_crosstab", "evaluate_clustering", "query_sample"]
NO_PROPS = ["in_degree", "pagerank_k", "lpa_k", "hll_estimate", "kmv_estimate", "events_pivot", "stream_hll_daily"]


def _scans(plan: str, table: str) -> list[str]:
    return [line for line in plan.split("\n") if "FileScan" in line and f"{table}.parquet" in line]


@pytest.mark.parametrize("name", NO_TEXT)
def test_text_column_pruned(spark, name):
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    scans = _scans(plan, "documents")
    assert scans and all("text" not in s.split("ReadSchema:")[1] for s in scans), scans


@pytest.mark.parametrize("name", NO_PROPS)
def test_props_column_pruned(spark, name):
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for s in _scans(plan, "events"):
        assert "props" not in s.split("ReadSchema:")[1], s
