"""Plan-shape assertions.

* no Python evaluation node in any report / analysis plan;
* every shuffle into a single partition sits above an aggregate or a limit,
  i.e. only aggregated (key-bounded) frames are ever gathered in one task.
"""

import pytest

import __spark_entry__ as E
from marketlake.plans.etl import load_dimension
from marketlake.plans.staging import staging
from marketlake.sources.catalog import materialize
from tests.conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")
PASS_THROUGH = ("Project", "Filter", "Sort", "Window", "Exchange", "WholeStageCodegen", "InputAdapter",
                "ColumnarToRow")  # cardinality-preserving
BOUNDED = ("HashAggregate", "ObjectHashAggregate", "SortAggregate", "TakeOrderedAndProject",
           "GlobalLimit", "LocalLimit", "CollectLimit")

NAMES = sorted(n for n in E.queries() if n[0] in "va")


def _children(node):
    kids = node.children()
    return [kids.apply(i) for i in range(kids.size())]


def _initial_plan(df):
    root = df._jdf.queryExecution().executedPlan()
    return root.initialPlan() if root.nodeName().startswith("AdaptiveSparkPlan") else root


def _walk(node):
    yield node
    for k in _children(node):
        yield from _walk(k)


def _bounded(node) -> bool:
    """The node's output is an aggregate / limit result, possibly projected, sorted,
    windowed, re-partitioned or joined with other such results."""
    name = node.nodeName()
    if name in BOUNDED:
        return True
    kids = _children(node)
    if kids and (name in PASS_THROUGH or "Join" in name or name == "BroadcastExchange"):
        return all(_bounded(k) for k in kids)
    return False


def test_upsert_joins_once_and_reads_the_increment_once(spark):
    """New keys are numbered ahead of the one outer join; staged rows are cleaned once, when the increment is stored."""
    stored = materialize(load_dimension("orders", staging(spark, SF_SMALL, "orders", loads=(1,))), "plan-test")
    plan = _initial_plan(load_dimension("orders", staging(spark, SF_SMALL, "orders", loads=(2,)), stored)).toString()
    assert plan.count("FullOuter") == 1 and "o_orderkey" not in plan


@pytest.mark.parametrize("name, scans", [("v9_category_performance", 0), ("v11_price_tiers", 0), ("v12_state_reliability", 0), ("a13_tier_shares", 1)])
def test_fact_is_scanned_once(spark, name, scans):
    """The value counts of these reports are stored in the report's one pass over the fact; V10's part of A13 is a pass of its own."""
    plan = _initial_plan(E.queries()[name](spark, SF_SMALL))
    reads = [n.toString() for n in _walk(plan) if n.nodeName().startswith("Scan parquet")]
    assert sum("fact_order_items" in r for r in reads) == scans and any("value_counts" in r for r in reads)


@pytest.mark.parametrize("name", NAMES)
def test_plan_shape(spark, name):
    plan = _initial_plan(E.queries()[name](spark, SF_SMALL))
    for node in _walk(plan):
        assert not any(p in node.nodeName() for p in PYTHON_NODES), node.nodeName()
        if node.nodeName() == "Exchange" and "SinglePartition" in node.outputPartitioning().toString():
            assert _bounded(_children(node)[0]), f"{name}: single partition over raw rows"
