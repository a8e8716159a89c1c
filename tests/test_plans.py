"""Plan shape: feature plans stay JVM-side and prune columns at the scan."""

from tables import SF001
from faresight.operators.customers import customer_features
from faresight.operators.options import option_features
from faresight.sources import candidates

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_plans_have_no_python_nodes(spark):
    c = candidates(spark, SF001)
    for df in (customer_features(c), option_features(c)):
        plan = _plan(df)
        assert not any(node in plan for node in PYTHON_NODES)


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(candidates(spark, SF001).select("ranker_id", "totalPrice"))
    li = [l for l in plan.split("\n") if "FileScan" in l and "l_orderkey" in l][0]
    assert "l_shipdate" not in li and "l_returnflag" not in li


def test_wide_customer_aggregate_is_a_hash_aggregate(spark):
    """Aggregates with buffers of unbounded or text type stay out of the wide one."""
    plan = _plan(customer_features(candidates(spark, SF001)))
    wide = [line for line in plan.split("\n") if "avg_booking_lead_days" in line and "Aggregate" in line]
    assert wide and all("HashAggregate" in line and "ObjectHashAggregate" not in line for line in wide)
