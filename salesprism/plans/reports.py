"""The catalogue of business reports, each a function of the order lines.

Every report is one pass of partial aggregation over the lines; shares, month
changes and sorting work on the few rows that are left. Ties in every top-k are
settled by the key columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from salesprism.functions.dates import monday_week, weekday_position
from salesprism.functions.exact import (
    mean2,
    mean_cents,
    money_sum,
    percent2,
    ratio2,
    signed_percent2,
    units,
)
from salesprism.functions.text import grouped_number, rupees
from salesprism.operators.aggregates import aov, revenue, share_of_total, totals
from salesprism.operators.cells import Cells, cells
from salesprism.operators.quantiles import tile_summary

UNKNOWN = "Unknown"  # fixed value: the text that stands for a missing place or courier


def _status_count(status: str):
    return F.count_if(F.col("status") == status)


def overall_kpis(sales: DataFrame) -> DataFrame:
    return _kpis(totals_with_range(sales))


def _kpis(totals_: DataFrame) -> DataFrame:
    return totals_.select(
        F.col("orders").alias("total_orders"),
        F.col("qty").alias("total_quantity_sold"),
        revenue().alias("total_revenue_inr"),
        aov().alias("avg_order_value"),
        mean2(F.col("cents"), F.col("orders")).alias("revenue_per_order"),
        units("smallest").alias("min_order_value"),
        units("largest").alias("max_order_value"),
    )


def totals_with_range(sales: DataFrame) -> DataFrame:
    return sales.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_distinct("order_id").alias("orders"),
        F.sum("qty").alias("qty"),
        money_sum("amount_cents").alias("cents"),
        F.min("amount_cents").alias("smallest"),
        F.max("amount_cents").alias("largest"),
    )


def status_distribution(sales: DataFrame) -> DataFrame:
    return (
        totals(sales, "status")
        .select(
            "status",
            F.col("lines").alias("order_count"),
            share_of_total("lines").alias("pct_of_total"),
            revenue().alias("total_revenue"),
            aov().alias("avg_order_value"),
        )
        .orderBy(F.desc("order_count"), "status")
    )


def b2b_split(sales: DataFrame) -> DataFrame:
    return (
        totals(sales, "b2b")
        .select(
            F.col("b2b").alias("customer_type"),
            "orders",
            F.col("qty").alias("qty_sold"),
            revenue().alias("total_revenue"),
            aov().alias("avg_order_value"),
            share_of_total("cents").alias("revenue_pct"),
        )
        .orderBy(F.desc("total_revenue"))
    )


def monthly_totals(sales: DataFrame) -> DataFrame:
    """One row per month; the shared view under the trend and the running total."""
    return totals(sales, "year", "month", "month_name")


def monthly_view(sales: DataFrame) -> DataFrame:
    return monthly_totals(sales).select(
        "year",
        "month",
        "month_name",
        F.col("orders").alias("total_orders"),
        F.col("qty").alias("total_qty"),
        revenue().alias("total_revenue"),
        aov().alias("avg_order_value"),
    )


def monthly_trend(sales: DataFrame, first_change_is_zero: bool = True) -> DataFrame:
    """Change against the previous month row. The first month compares with itself,
    or is blank with ``first_change_is_zero=False``."""
    by_month = Window.orderBy("year", "month")
    before = F.lag("cents").over(by_month)
    if first_change_is_zero:
        before = F.coalesce(before, F.col("cents"))
    return (
        monthly_totals(sales)
        .withColumn("before", before)
        .withColumn("change", F.col("cents") - F.col("before"))
        .select(
            "year",
            "month",
            "month_name",
            F.col("orders").alias("total_orders"),
            F.col("qty").alias("total_qty"),
            revenue().alias("total_revenue"),
            aov().alias("avg_order_value"),
            units("change").alias("mom_revenue_change"),
            signed_percent2(F.col("change"), F.col("before")).alias("mom_growth_pct"),
        )
        .orderBy("year", "month")
    )


def quarterly_performance(sales: DataFrame) -> DataFrame:
    return (
        totals(sales, "year", "quarter")
        .select(
            "year",
            "quarter",
            F.col("orders").alias("total_orders"),
            F.col("qty").alias("total_qty"),
            revenue().alias("total_revenue"),
            aov().alias("avg_order_value"),
        )
        .orderBy("year", "quarter")
    )


def weekday_pattern(sales: DataFrame) -> DataFrame:
    return (
        totals(sales, "day_name")
        .select(
            "day_name",
            F.col("orders").alias("total_orders"),
            F.col("qty").alias("total_qty"),
            revenue().alias("total_revenue"),
            aov().alias("avg_order_value"),
        )
        .orderBy(weekday_position(F.col("day_name")))
    )


def weekly_revenue(sales: DataFrame) -> DataFrame:
    """ISO week number beside the calendar year, as the source groups them."""
    return (
        totals(sales, "year", "week_number")
        .select(
            "year",
            "week_number",
            F.col("orders").alias("total_orders"),
            revenue().alias("weekly_revenue"),
            aov().alias("avg_order_value"),
        )
        .orderBy("year", "week_number")
    )


def weekly_revenue_in_year(sales: DataFrame) -> DataFrame:
    """Weeks 0-53 that never cross the year, with their first order day."""
    return (
        sales.groupBy(
            F.year("order_date").alias("year"), monday_week(F.col("order_date")).alias("week_number")
        )
        .agg(
            F.min("order_date").alias("week_start"),
            F.count_distinct("order_id").alias("total_orders"),
            units(money_sum("amount_cents")).alias("weekly_revenue"),
        )
        .orderBy("year", "week_number")
    )


def iso_weekly_revenue(sales: DataFrame) -> DataFrame:
    """Weekly revenue with the ISO year, so that no week is split or merged."""
    return (
        totals(
            sales,
            F.expr("extract(yearofweek from order_date)").alias("iso_year"),
            F.weekofyear("order_date").alias("week_number"),
        )
        .select(
            "iso_year",
            "week_number",
            F.col("orders").alias("total_orders"),
            revenue().alias("weekly_revenue"),
            aov().alias("avg_order_value"),
        )
        .orderBy("iso_year", "week_number")
    )


def category_revenue(sales: DataFrame) -> DataFrame:
    return (
        totals(sales, "category")
        .select(
            "category",
            F.col("orders").alias("total_orders"),
            F.col("qty").alias("total_qty"),
            revenue().alias("total_revenue"),
            aov().alias("avg_order_value"),
            share_of_total("cents").alias("revenue_pct"),
        )
        .orderBy(F.desc("total_revenue"), "category")
    )


def top_products_by_revenue(sales: DataFrame, k: int = 10) -> DataFrame:
    price = mean_cents(F.col("amount_cents"), F.col("qty"))
    return (
        sales.withColumn("price_cents", F.coalesce(price, F.col("amount_cents")))
        .groupBy("sku", "style", "category")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.count_distinct("order_id").alias("total_orders"),
            F.sum("qty").alias("qty_sold"),
            money_sum("amount_cents").alias("cents"),
            money_sum("price_cents").alias("price_cents"),
        )
        .orderBy(F.desc("cents"), "sku", "style", "category")
        .limit(k)
        .select(
            "sku",
            "style",
            "category",
            "total_orders",
            "qty_sold",
            revenue().alias("total_revenue"),
            mean2(F.col("price_cents"), F.col("lines")).alias("avg_unit_price"),
        )
    )


def top_products_by_quantity(sales: DataFrame, k: int = 10) -> DataFrame:
    return (
        totals(sales, "sku", "style", "category")
        .orderBy(F.desc("qty"), "sku", "style", "category")
        .limit(k)
        .select(
            "sku",
            "style",
            "category",
            F.col("qty").alias("qty_sold"),
            revenue().alias("total_revenue"),
            aov().alias("avg_order_value"),
        )
    )


def category_by_month(sales: DataFrame) -> DataFrame:
    return (
        totals(sales, "category", "month_name", "month")
        .select(
            "category", "month_name", "month", "orders",
            revenue().alias("revenue"), F.col("qty").alias("qty_sold"),
        )
        .orderBy("category", "month")
    )


def size_distribution(sales: DataFrame) -> DataFrame:
    return (
        totals(sales, "category", "size")
        .select("category", "size", "orders", F.col("qty").alias("qty_sold"), revenue().alias("revenue"))
        .orderBy("category", F.desc("qty_sold"), "size")
    )


def top_states(sales: DataFrame, k: int = 15) -> DataFrame:
    """Known states by revenue, with their share of all revenue."""
    return (
        totals(sales, "ship_state")
        .withColumn("revenue_pct", share_of_total("cents"))
        .filter(F.col("ship_state") != UNKNOWN)
        .orderBy(F.desc("cents"), "ship_state")
        .limit(k)
        .select(
            "ship_state",
            F.col("orders").alias("total_orders"),
            F.col("qty").alias("total_qty"),
            revenue().alias("total_revenue"),
            aov().alias("avg_order_value"),
            "revenue_pct",
        )
    )


def state_kpis(sales: DataFrame) -> DataFrame:
    """Known states with their share of the revenue of known states."""
    return (
        totals(sales.filter(F.col("ship_state") != UNKNOWN), "ship_state")
        .select(
            "ship_state",
            F.col("orders").alias("total_orders"),
            F.col("qty").alias("total_qty"),
            revenue().alias("total_revenue"),
            aov().alias("avg_order_value"),
            share_of_total("cents").alias("revenue_pct"),
        )
        .orderBy(F.desc("total_revenue"), "ship_state")
    )


def top_state_kpis(sales: DataFrame, k: int = 10) -> DataFrame:
    return state_kpis(sales).limit(k)


def top_cities(sales: DataFrame, k: int = 15) -> DataFrame:
    return (
        totals(sales.filter(F.col("ship_city") != UNKNOWN), "ship_city", "ship_state")
        .orderBy(F.desc("orders"), "ship_city", "ship_state")
        .limit(k)
        .select(
            "ship_city",
            "ship_state",
            F.col("orders").alias("total_orders"),
            F.col("qty").alias("qty_sold"),
            revenue().alias("total_revenue"),
            aov().alias("avg_order_value"),
        )
    )


def state_cancellation(sales: DataFrame, k: int = 15) -> DataFrame:
    return (
        sales.filter(F.col("ship_state") != UNKNOWN)
        .groupBy("ship_state")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            _status_count("Delivered").alias("delivered"),
            _status_count("Shipped").alias("shipped"),
            _status_count("Cancelled").alias("cancelled"),
            _status_count("Returned").alias("returned"),
        )
        .withColumn("cancel_rate_pct", percent2(F.col("cancelled"), F.col("total_orders")))
        .orderBy(F.desc("cancel_rate_pct"), "ship_state")
        .limit(k)
    )


def channel_revenue(sales: DataFrame) -> DataFrame:
    return (
        totals(sales, "sales_channel")
        .select(
            "sales_channel",
            F.col("orders").alias("total_orders"),
            F.col("qty").alias("qty_sold"),
            revenue().alias("total_revenue"),
            aov().alias("avg_order_value"),
            share_of_total("cents").alias("revenue_pct"),
        )
        .orderBy(F.desc("total_revenue"), "sales_channel")
    )


def fulfilment_analysis(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("fulfilment")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.count_distinct("order_id").alias("total_orders"),
            money_sum("amount_cents").alias("cents"),
            _status_count("Delivered").alias("delivered"),
            _status_count("Cancelled").alias("cancelled"),
        )
        .select(
            "fulfilment",
            "total_orders",
            revenue().alias("total_revenue"),
            aov().alias("avg_order_value"),
            "delivered",
            "cancelled",
            percent2(F.col("cancelled"), F.col("lines")).alias("cancel_rate_pct"),
        )
    )


def service_levels(sales: DataFrame) -> DataFrame:
    return (
        totals(sales, "ship_service_level")
        .select(
            "ship_service_level",
            F.col("orders").alias("total_orders"),
            revenue().alias("total_revenue"),
            aov().alias("avg_order_value"),
            ratio2(F.col("qty"), F.col("lines")).alias("avg_qty_per_order"),
        )
        .orderBy(F.desc("total_revenue"), "ship_service_level")
    )


def promotion_flag():
    return F.when(F.col("promotion_ids") == "No Promotion", F.lit("No Promotion")).otherwise(
        F.lit("With Promotion")
    )


def promotion_impact(sales: DataFrame) -> DataFrame:
    return totals(sales, promotion_flag().alias("promo_segment")).select(
        "promo_segment",
        F.col("orders").alias("total_orders"),
        revenue().alias("total_revenue"),
        aov().alias("avg_order_value"),
        F.col("qty").alias("total_qty"),
    )


def value_tiers(sales: DataFrame, tiers: int = 4) -> DataFrame:
    """Orders cut into equal-count tiers by their total."""
    orders = sales.groupBy("order_id").agg(F.sum("amount_cents").alias("order_cents"))
    return (
        tile_summary(orders, "order_cents", tiers)
        .select(
            F.col("tile").alias("value_tier"),
            F.col("rows").alias("orders"),
            units("smallest").alias("min_value"),
            units("largest").alias("max_value"),
            mean2(F.col("cents"), F.col("rows")).alias("avg_value"),
            revenue().alias("total_revenue"),
            share_of_total("cents").alias("revenue_pct"),
        )
        .orderBy("value_tier")
    )


def top_state_category_matrix(sales: DataFrame, k: int = 5) -> DataFrame:
    """Categories inside the k best known states. The states are ranked over the
    state-by-category cells themselves, so the lines are read once."""
    cells = totals(sales.filter(F.col("ship_state") != UNKNOWN), "ship_state", "category")
    by_state = Window.partitionBy("ship_state")
    # as many rows as there are state and category pairs
    best_first = Window.orderBy(F.desc("state_cents"), "ship_state")
    return (
        cells.withColumn("state_cents", F.sum("cents").over(by_state))
        .withColumn("state_rank", F.dense_rank().over(best_first))
        .filter(F.col("state_rank") <= k)
        .select("ship_state", "category", revenue().alias("revenue"), "orders")
        .orderBy("ship_state", F.desc("revenue"), "category")
    )


def cumulative_revenue(sales: DataFrame) -> DataFrame:
    running = (
        Window.partitionBy("year").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        monthly_totals(sales)
        .select(
            "year",
            "month",
            "month_name",
            revenue().alias("total_revenue"),
            units(F.sum("cents").over(running)).alias("cumulative_ytd"),
        )
        .orderBy("year", "month")
    )


def return_rates(sales: DataFrame) -> DataFrame:
    returned = F.when(F.col("status") == "Returned", F.col("amount_cents")).otherwise(0)
    return (
        sales.groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            _status_count("Returned").alias("returned_orders"),
            units(money_sum(returned)).alias("returned_revenue"),
        )
        .select(
            "category",
            "total_orders",
            "returned_orders",
            percent2(F.col("returned_orders"), F.col("total_orders")).alias("return_rate_pct"),
            "returned_revenue",
        )
        .orderBy(F.desc("return_rate_pct"), "category")
    )


def courier_revenue(sales: DataFrame) -> DataFrame:
    return (
        totals(sales.filter(F.col("courier_status") != UNKNOWN), "courier_status")
        .select(
            F.col("courier_status").alias("courier"),
            F.col("orders").alias("total_orders"),
            revenue().alias("total_revenue"),
            aov().alias("avg_order_value"),
            F.col("qty").alias("total_qty"),
        )
        .orderBy(F.desc("total_revenue"), "courier")
    )


def _headline(sales: DataFrame) -> DataFrame:
    """All numbers of the executive summary in one pass over the lines."""
    known_state = F.when(F.col("ship_state") != UNKNOWN, F.col("ship_state"))
    known_city = F.when(F.col("ship_city") != UNKNOWN, F.col("ship_city"))
    return cells(
        sales,
        distinct={"orders": F.col("order_id"), "skus": F.col("sku"), "states": known_state, "cities": known_city},
        counts={
            "lines": F.lit(True), "delivered": F.lower("status").like("%deliver%"),
            "cancelled": F.col("status") == "Cancelled", "returned": F.col("status") == "Returned",
        },
        sums={"qty": F.col("qty")},
        money={
            "cents": F.col("amount_cents"),
            "b2b_cents": F.when(F.col("b2b") == "Yes", F.col("amount_cents")).otherwise(0),
        },
    ).totals()


def executive_summary(sales: DataFrame) -> DataFrame:
    lines = F.col("lines")
    # fixed values: the metric names
    metrics = {
        "Total Revenue (INR)": revenue(),
        "Total Orders": F.col("orders"),
        "Total Qty Sold": F.col("qty"),
        "Avg Order Value (INR)": aov(),
        "Delivered Orders": F.col("delivered"),
        "Cancelled Orders": F.col("cancelled"),
        "Cancellation Rate (%)": percent2(F.col("cancelled"), lines),
        "Return Rate (%)": percent2(F.col("returned"), lines),
        "B2B Revenue Share (%)": percent2(F.col("b2b_cents"), F.col("cents")),
        "Unique SKUs": F.col("skus"),
        "Active States": F.col("states"),
        "Active Cities": F.col("cities"),
    }
    return metric_rows(_headline(sales), metrics, "double")


def metric_rows(one_row: DataFrame, metrics: dict, kind: str) -> DataFrame:
    """A one-row table to (metric, value) rows, without a second scan."""
    pairs = [
        F.struct(F.lit(name).alias("metric"), value.cast(kind).alias("value"))
        for name, value in metrics.items()
    ]
    return one_row.select(F.inline(F.array(*pairs)))


def executive_report(sales: DataFrame) -> DataFrame:
    """Formatted headline rows with the best category and the best known state."""
    found = _category_state_cells(sales)
    sums = found.sums("category", "ship_state")
    top_category = _best(sums, "category").select("category")
    top_state = _best(_known_states(sums), "ship_state").select("ship_state")
    numbers = found.totals().withColumns({"top_category": top_category.scalar(), "top_state": top_state.scalar()})
    cancel_pct = percent2(F.col("cancelled"), F.col("lines")).cast("decimal(10,2)").cast("string")
    mean = mean_cents(F.col("cents"), F.col("lines"))
    metrics = {
        "Total Revenue (INR)": rupees(F.col("cents")),
        "Total Orders": grouped_number(F.col("orders"), 0),
        "Total Qty Sold": grouped_number(F.col("qty"), 0),
        "Avg Order Value (INR)": rupees(mean),
        "Delivered Orders": grouped_number(F.col("delivered"), 0),
        "Cancellation Rate (%)": F.concat(cancel_pct, F.lit("%")),
        "Top Category": F.col("top_category"),
        "Top State": F.col("top_state"),
    }
    return metric_rows(numbers, metrics, "string")


def _category_state_cells(sales: DataFrame) -> Cells:
    """Sums per category and state with the bits of all orders, from one pass over the lines. Written
    once: ranking them in several ways must not read the lines several times."""
    return cells(
        sales,
        distinct={"orders": F.col("order_id")},
        counts={
            "lines": F.lit(True), "delivered": F.col("status") == "Delivered",
            "cancelled": F.col("status") == "Cancelled", "returned": F.col("status") == "Returned",
        },
        sums={"qty": F.col("qty")},
        money={"cents": F.col("amount_cents")},
        least={"smallest": F.col("amount_cents")},
        most={"largest": F.col("amount_cents")},
        by=("category", "ship_state"),
    ).stored()


def _known_states(sums: DataFrame) -> DataFrame:
    return sums.filter(F.col("ship_state") != UNKNOWN)


def _best(sums: DataFrame, key: str) -> DataFrame:
    """The key with the highest revenue, one row."""
    return (
        sums.groupBy(key)
        .agg(F.sum("cents").alias("cents"))
        .orderBy(F.desc("cents"), key)
        .limit(1)
    )


def revenue_per_order_by_state(sales: DataFrame, k: int = 15) -> DataFrame:
    return (
        totals(sales.filter(F.col("ship_state") != UNKNOWN), "ship_state")
        .select(
            "ship_state",
            F.col("orders").alias("total_orders"),
            revenue().alias("total_revenue"),
            mean2(F.col("cents"), F.col("orders")).alias("revenue_per_order"),
        )
        .orderBy(F.desc("revenue_per_order"), "ship_state")
        .limit(k)
    )


def mean_return_rate(sales: DataFrame) -> DataFrame:
    """Mean over categories of the return rate, each category weighing the same."""
    rates = return_rates(sales).withColumn(
        "rate_hundredths", F.round(F.col("return_rate_pct") * 100).cast("bigint")
    )
    return rates.agg(
        F.count(F.lit(1)).alias("categories"),
        mean2(F.sum("rate_hundredths"), F.count(F.lit(1))).alias("avg_return_rate_pct"),
    )


def insights(sales: DataFrame) -> DataFrame:
    """Headline findings: totals, best category and state, highest return rate."""
    kept = _category_state_cells(sales)
    sums = kept.sums("category", "ship_state")
    category = _best(sums, "category").select(F.struct("category", revenue().alias("r")))
    state = _best(_known_states(sums), "ship_state").select(
        F.struct("ship_state", revenue().alias("r"))
    )
    worst = (
        sums.groupBy("category")
        .agg(percent2(F.sum("returned"), F.sum("lines")).alias("pct"))
        .orderBy(F.desc("pct"), "category")
        .limit(1)
        .select(F.struct("category", "pct"))
    )
    found = _kpis(kept.totals()).withColumns(
        {"c": category.scalar(), "s": state.scalar(), "w": worst.scalar()}
    )
    return found.select(
        "total_revenue_inr",
        "total_orders",
        "avg_order_value",
        F.col("c.category").alias("top_category"),
        F.col("c.r").alias("top_category_revenue"),
        F.col("s.ship_state").alias("top_state"),
        F.col("s.r").alias("top_state_revenue"),
        F.col("w.category").alias("highest_return_category"),
        F.col("w.pct").alias("highest_return_rate_pct"),
    )
