"""Physical-plan properties (scale rules, see ``plan_rules.py``).

Every query's executed plan is checked in ``test_catalog``; here: targeted properties
(filter and projection pushdown, broadcasts chosen from bytes).
"""

import pytest

from pluvia.plans import catalog

SF = "/root/testdata/sf0.001"
QUERIES = catalog.QUERIES


def plan_text(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_local_checkpoint_in_library():
    import pathlib
    root = pathlib.Path(__file__).resolve().parents[1] / "pluvia"
    for p in root.rglob("*.py"):
        assert "localCheckpoint" not in p.read_text(), p


def _orders_scan(text):
    scans = [l for l in text.splitlines() if "FileScan parquet" in l and "o_orderkey" in l
             or ("FileScan parquet" in l and "o_custkey" in l)]
    assert scans
    return scans[0]


@pytest.mark.parametrize("name", ["window_days_back", "coverage_gap", "run_summary"])
def test_date_window_reaches_the_scan(spark, name):
    scan = _orders_scan(plan_text(QUERIES[name](spark, SF)))
    pushed = scan.split("PushedFilters: [")[1].split("]")[0]
    assert "o_orderdate" in pushed, scan


def test_projection_pruned_at_scan(spark):
    scan = _orders_scan(plan_text(QUERIES["silver_clean"](spark, SF)))
    schema = scan.split("ReadSchema: struct<")[1]
    assert "o_totalprice" not in schema and "o_orderstatus" not in schema, scan


def test_a_grown_dimension_is_no_longer_broadcast(spark, tmp):
    """The planner decides from bytes at every call; no join carries a hint."""
    from pluvia.operators.joins import attach_dimension
    from pluvia.plans import fixtures as X
    path = f"{tmp}/dim"
    keys = spark.range(10, 40000).selectExpr("id AS o_orderkey", "uuid() AS name")
    keys.limit(10).coalesce(1).write.parquet(path)
    orders = X.table(spark, SF, "orders")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")
    try:
        small = attach_dimension(orders, spark.read.parquet(path), "o_orderkey")
        assert "BroadcastHashJoin" in plan_text(small)
        keys.write.mode("append").parquet(path)
        grown = attach_dimension(orders, spark.read.parquet(path), "o_orderkey")
        assert "SortMergeJoin" in plan_text(grown)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
