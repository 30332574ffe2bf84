"""Line keys, repeatable loads by month, and files read for a slice of days."""

import re
from datetime import date

import pytest

from pyspark.sql import functions as F

from salesprism.operators import incremental as inc, warehouse as w
from salesprism.sources.sales import sales


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df) -> list:
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def staged(spark, folder):
    return w.staging(sales(spark, folder)).filter("order_date < '1997-01-01'").cache()


def test_a_line_that_occurs_three_times_has_three_keys(spark):
    lines = spark.createDataFrame([("a", 1), ("a", 1), ("a", 1), ("b", None), ("b", None), ("c", 2)], "x string, y int")
    keyed = inc.with_line_keys(lines)
    assert keyed.columns == ["order_line_key", "x", "y"] and rows_of(keyed.drop("order_line_key")) == rows_of(lines)
    assert keyed.select("order_line_key").distinct().count() == 6
    assert inc.repeated_keys(keyed).first()[0] == 0 and inc.repeated_keys(keyed.unionByName(keyed.limit(1))).first()[0] == 1
    again = inc.with_line_keys(lines.repartition(3, "y"))
    assert rows_of(again) == rows_of(keyed)
    assert inc.with_line_keys(lines.limit(0)).count() == 0


def test_a_hot_line_is_dealt_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(inc, "BLOCK", 10)
    lines = spark.range(105).select(F.lit("hot").alias("x")).unionByName(spark.range(10).select(F.col("id").cast("string").alias("x")))
    keyed = inc.with_line_keys(lines)
    assert keyed.count() == 115 and keyed.select("order_line_key").distinct().count() == 115
    assert keyed.filter("x = 'hot'").count() == 105


def test_the_same_load_twice_changes_nothing(spark, staged, tmp_path):
    late = staged.filter("order_date >= '1996-06-01'")
    early = staged.filter("order_date < '1996-06-01'")
    whole, parts = inc.StarStore(spark, str(tmp_path / "whole")), inc.StarStore(spark, str(tmp_path / "parts"))
    whole.load(staged)
    parts.load(early)
    before = rows_of(parts.summary())
    for _ in range(2):
        parts.load(late)
    assert rows_of(parts.summary()) == rows_of(whole.summary()) != before
    for name in ("fact_orders", *inc.DIMENSIONS):
        assert rows_of(parts.table(name)) == rows_of(whole.table(name))


def test_a_month_loaded_again_is_replaced_and_others_stay(spark, staged, tmp_path):
    store = inc.StarStore(spark, str(tmp_path / "star"))
    store.load(staged)
    before = {r["month_key"]: r["rows"] for r in store.summary().filter("part = 'fact_orders'").collect()}
    fewer = staged.filter("year(order_date) = 1996 and month(order_date) = 3").limit(5)
    store.load(fewer)
    after = {r["month_key"]: r["rows"] for r in store.summary().filter("part = 'fact_orders'").collect()}
    assert after.pop(199603) == 5 and before.pop(199603) > 5 and after == before


def test_slices_read_only_their_months(spark, staged, tmp_path):
    store = inc.StarStore(spark, str(tmp_path / "star"))
    store.load(staged)
    cut = store.fact(date(1996, 2, 10), date(1996, 3, 5))
    plan = executed(cut)
    assert re.search(r"PartitionFilters: \[[^\]]*month_key", plan)
    expected = store.table("fact_orders").filter("date_key between 19960210 and 19960305")
    assert rows_of(cut) == rows_of(expected) and cut.count() > 0
    days = w.calendar(spark, date(1996, 1, 1), date(1996, 12, 31)).filter("quarter = 1 and is_weekend")
    sliced = store.fact_in(days)
    assert sliced.count() == store.table("fact_orders").join(days, "date_key", "left_semi").count() > 0
    # which months the calendar slice needs is found when the query runs
    plan = executed(sliced)
    assert "dynamicpruning" in plan.lower()
    read = sliced._jdf.queryExecution().executedPlan()
    files = [int(m) for m in re.findall(r"number of files read: (\d+)", plan)]
    assert read is not None and (not files or min(files) <= 3)
