"""Plan properties: no Cartesian products or nested-loop joins anywhere, and the
feature set is planned with one shuffle on the entity and two Window operators."""

import re

import pytest

import __spark_entry__ as E
from panelstride.plans.catalog import REGISTRY

SF = "/root/testdata/sf0.001"

def _plan(spark, name):
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_cross_join(spark, name):
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", _plan(spark, name))


def test_feature_windows_share_one_exchange(spark):
    from panelstride.operators import features
    from panelstride.plans import fixtures as fx

    panel = fx.panel(spark, SF).persist()
    panel.count()
    plan = features.build_features(panel)._jdf.queryExecution().executedPlan().toString()
    # above the cached panel: one hash exchange on the entity, two stacked windows
    above = plan.split("InMemoryTableScan")[0]
    assert len(re.findall(r"Exchange hashpartitioning\(ticker", above)) == 1
    assert len(re.findall(r"\bWindow \[", above)) == 2
    panel.unpersist()


def test_gold_scans_lineitem_once(spark, tmp_path):
    """The plans of everything that one build of gold runs, from Spark's own listener-free
    record: the sums per supplier and day are written by one scan, and gold reads these."""
    from panelstride.plans import queries

    plan = queries.gold(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "lineitem.parquet" not in plan and len(re.findall(r"FileScan parquet .*orders.parquet", plan)) <= 1
