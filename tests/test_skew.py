"""Whole and right results when one key holds a third of all rows."""

import pytest
from pyspark.sql import functions as F

from salesprism.plans.catalogue import all_queries
from salesprism.sources.sales import sales
from oracle import TABLES, compare

KEYS = [
    "q01_overall_kpis", "q08_category_revenue", "q09_top_products_by_revenue", "q14_top_cities",
    "q20_value_tiers", "q25_executive_summary", "order_quartiles", "measures_by_category",
    "customer_scores", "constraint_checks", "orders_flat", "rolling_daily_revenue",
]


@pytest.fixture(scope="module")
def skewed(folder, tmp_path_factory):
    """The tables with a third of the lines on one part and a third on one order."""
    import duckdb

    out = str(tmp_path_factory.mktemp("skewed"))
    connection = duckdb.connect()
    for name in TABLES:
        source = f"read_parquet('{folder}/{name}.parquet')"
        rows = f"select * from {source}"
        if name == "lineitem":
            rows = (
                "select * replace (case when l_suppkey % 3 = 0 then 1 else l_partkey end as l_partkey, "
                f"case when l_suppkey % 3 = 1 then (select min(l_orderkey) from {source}) "
                f"else l_orderkey end as l_orderkey) from {source}"
            )
        connection.execute(f"copy ({rows}) to '{out}/{name}.parquet' (format parquet, row_group_size 4096)")
        connection.execute(f"create view {name} as select * from read_parquet('{out}/{name}.parquet')")
    return out, connection


@pytest.fixture(scope="module")
def small_thresholds(spark):
    """Make the planner treat these small tables like large ones."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.files.maxPartitionBytes": "100KB",
        "spark.sql.files.openCostInBytes": "1KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("key", KEYS)
def test_skewed_tables(key, spark, skewed, small_thresholds):
    folder, connection = skewed
    query = all_queries()[key]
    assert compare(query(spark, folder), connection, query.sql()) > 0


def test_hot_key_is_split(spark, skewed, small_thresholds):
    lines = sales(spark, skewed[0], "order_id", "category", "amount_cents")
    grouped = lines.groupBy("category").agg(F.count_distinct("order_id"))
    grouped.collect()
    plan = grouped._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan
