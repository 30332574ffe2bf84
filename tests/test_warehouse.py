"""Star schema: keys, loads, checks; measures on hand-made lines."""

from datetime import date

import pytest

from salesprism.operators import measures as m, warehouse as w
from salesprism.sources.sales import sales
from salesprism.sources.sinks import read_sql, register


@pytest.fixture(scope="module")
def staged(spark, folder):
    return w.staging(sales(spark, folder))


def test_load_star_keeps_every_line(spark, staged, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("star"))
    counts = {r["table"]: r["rows"] for r in w.load_star(staged, date(1995, 1, 1), date(2001, 12, 31), out).collect()}
    assert counts["fact_orders"] == staged.count() and counts["dim_date"] == 2557
    tables = {n: spark.read.parquet(f"{out}/{n}") for n in counts}
    flat = w.orders_flat(*[tables[n] for n in ("fact_orders", "dim_date", "dim_product", "dim_location", "dim_channel")])
    assert flat.count() == counts["fact_orders"]
    register(flat, "v_orders_flat")
    assert read_sql(spark, "select count(distinct order_id) n from v_orders_flat").first()["n"] > 0


def test_reload_adds_only_new_members(spark):
    old = spark.createDataFrame([("1", "a")], "k string, v string")
    new = spark.createDataFrame([("1", "a"), ("2", "b")], "k string, v string")
    assert [tuple(r) for r in w.new_members(old, new, "k").collect()] == [("2", "b")]


def test_keys_tell_null_from_text(spark):
    df = spark.createDataFrame([(None, "a"), ("", "a"), ("!", "a"), ("a", None)], "x string, y string")
    assert df.select(w.surrogate_key("x", "y").alias("k")).distinct().count() == 4


def test_checks_find_faults(spark):
    fact = spark.createDataFrame([("k1",), ("k1",), ("k9",)], "product_key string")
    product = spark.createDataFrame([("k1", "s"), ("k1", "s")], "product_key string, sku string")
    found = {r["check"]: r["violations"] for r in w.checks(fact, {"dim_product": (product, "product_key")}).collect()}
    assert found["dim_product: repeated product_key"] == 1
    assert found["fact_orders: product_key without dim_product"] == 1


def test_calendar_bounds(spark):
    with pytest.raises(ValueError):
        w.calendar(spark, date(2022, 1, 2), date(2022, 1, 1))
    assert w.calendar(spark, date(2022, 1, 1), date(2023, 12, 31)).count() == 730


@pytest.fixture(scope="module")
def lines(spark):
    rows = [
        (1, "2022-01-05", "Delivered", 1, 1000, "A", "X", "Web", "No Promotion", "No"),
        (1, "2022-01-05", "Cancelled", 1, 500, "B", "X", "Web", "P", "No"),
        (2, "2022-03-07", "Shipped", 2, 3000, "A", "Y", "Web", "P", "Yes"),
        (3, "2023-01-09", "Cancelled", 1, 700, "B", "Y", "App", "No Promotion", "No"),
    ]
    schema = (
        "order_id long, d string, status string, qty int, amount_cents long, category string, "
        "ship_state string, sales_channel string, promotion_ids string, b2b string"
    )
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("order_date", df["d"].cast("date")).drop("d")


def test_replace_and_narrow(lines):
    context = m.FilterContext(status=("Delivered",))
    row = m.measure(lines, ["delivered_orders", "cancelled_orders", "total_orders"], (), context).first()
    # delivered narrows the slicer, cancelled replaces it
    assert tuple(row) == (1, 2, 1)
    only_shipped = m.measure(lines, ["delivered_orders", "cancelled_orders"], (), m.FilterContext(status=("Shipped",)))
    assert tuple(only_shipped.first()) == (0, 2)


def test_divisions_by_zero_give_zero(lines):
    nothing = m.FilterContext(category=("none",))
    names = ["avg_order_value", "cancellation_rate_pct", "promo_lift_pct", "category_share_pct"]
    assert tuple(m.measure(lines, names, (), nothing).first())[:3] == (0.0, 0.0, 0.0)


def test_time_gap_counts_as_zero(lines):
    rows = {str(r["month_start"]): r for r in m.time_intelligence(lines).collect()}
    assert sorted(rows) == ["2022-01-01", "2022-02-01", "2022-03-01"]
    assert rows["2022-02-01"]["revenue_mom_change"] == -10.0
    # the month before March is February, not the last month with orders
    assert rows["2022-03-01"]["revenue_mom_change"] == 30.0
    assert rows["2022-03-01"]["revenue_mom_growth_pct"] == 0.0
    assert rows["2022-03-01"]["revenue_ytd"] == 40.0


def test_date_slicer(lines):
    context = m.FilterContext(date_from=date(2022, 3, 1))
    assert m.measure(lines, ["total_orders"], (), context).first()[0] == 2
    shown = m.time_intelligence(lines, (), context).collect()
    assert [str(r["month_start"]) for r in shown] == ["2022-03-01"]
    assert shown[0]["revenue_ytd"] == 40.0


def test_top_category_tie(lines):
    tied = lines.filter("status <> 'Cancelled'").limit(0).unionByName(
        lines.filter("order_id = 2")).unionByName(lines.filter("order_id = 2").replace({"A": "0"}, subset=["category"]))
    assert m.top_category(tied).first()["top_category"] == "0"
