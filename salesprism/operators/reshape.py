"""Chart-ready datasets: matrices, histograms, shares, trends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from salesprism.functions.dates import MONTHS, WEEKDAYS, month_label, week_label
from salesprism.functions.exact import floor_div, mean2, mean_cents, money_sum, percent2, units
from salesprism.operators.aggregates import totals
from salesprism.operators.cells import cells
from salesprism.operators.windows import rolling_mean


def revenue_matrix(lines: DataFrame, rows: str | Column, columns: str, values: Sequence[str]) -> DataFrame:
    """Revenue by row key and column key, 0 where nothing was sold. The column values
    are given, so the plan needs no pass to find them."""
    matrix = lines.groupBy(rows).pivot(columns, list(values)).agg(units(money_sum("amount_cents")))
    return matrix.fillna(0.0, subset=list(values))


def category_month_matrix(lines: DataFrame) -> DataFrame:
    return revenue_matrix(lines, "category", "month_name", MONTHS)


def month_category_matrix(lines: DataFrame, categories: Sequence[str]) -> DataFrame:
    month = month_label(F.col("order_date")).alias("month")
    return revenue_matrix(lines, month, "category", categories)


def state_category_matrix(lines: DataFrame, categories: Sequence[str]) -> DataFrame:
    return revenue_matrix(lines, "ship_state", "category", categories)


def month_weekday_means(lines: DataFrame) -> DataFrame:
    """Mean line amount by month name and weekday, Monday first, 0 where empty."""
    mean = mean2(money_sum("amount_cents"), F.count(F.lit(1)))
    return (
        lines.groupBy("month_name").pivot("day_name", list(WEEKDAYS)).agg(mean)
        .fillna(0.0, subset=list(WEEKDAYS))
    )


def unit_price_histogram(lines: DataFrame, width: int = 200) -> DataFrame:
    """Lines per unit-price bin of the given width in currency units."""
    price = F.coalesce(mean_cents(F.col("amount_cents"), F.col("qty")), F.col("amount_cents"))
    low = floor_div(price, F.lit(width * 100)) * width
    return lines.groupBy(low.alias("bin_start")).agg(F.count(F.lit(1)).alias("lines"))


def shares(lines: DataFrame, key: str) -> DataFrame:
    """Lines per value with their percent of all lines."""
    whole = F.sum("lines").over(Window.partitionBy())
    return (
        lines.groupBy(key)
        .agg(F.count(F.lit(1)).alias("lines"))
        .select(key, "lines", percent2(F.col("lines"), whole).alias("share_pct"))
        .orderBy(F.desc("lines"), key)
    )


def monthly_trend(lines: DataFrame, *keys: str) -> DataFrame:
    """Revenue and lines per month; lines count each order line, not distinct orders."""
    month = month_label(F.col("order_date")).alias("month")
    return totals(lines, month, *keys).select(
        "month", *keys, units("cents").alias("revenue"), F.col("lines").alias("orders")
    ).orderBy("month", *keys)


def weekly_trend(lines: DataFrame) -> DataFrame:
    week = week_label(F.col("order_date")).alias("week")
    return totals(lines, week).select("week", units("cents").alias("revenue")).orderBy("week")


def rolling_daily(lines: DataFrame) -> DataFrame:
    """Revenue per day that has orders, with means over the last 7 and 14 such days:
    gated until the frame is full, and a 7-day mean that starts at once."""
    by_day = Window.orderBy("order_date")
    days = lines.groupBy("order_date").agg(
        money_sum("amount_cents").alias("cents"), F.count(F.lit(1)).alias("orders")
    )
    return days.select(
        F.col("order_date").alias("date"),
        units("cents").alias("revenue"),
        "orders",
        rolling_mean("cents", by_day, -6, 0).alias("rolling_7"),
        rolling_mean("cents", by_day, -13, 0).alias("rolling_14"),
        rolling_mean("cents", by_day, -6, 0, full=False).alias("rolling_7_from_start"),
    ).orderBy("date")


def top_sizes(lines: DataFrame, k: int = 8) -> DataFrame:
    return (
        lines.groupBy("size").agg(F.sum("qty").alias("qty")).orderBy(F.desc("qty"), "size").limit(k)
    )


def top_by_revenue(lines: DataFrame, key: str, k: int) -> DataFrame:
    return (
        lines.groupBy(key)
        .agg(money_sum("amount_cents").alias("cents"))
        .orderBy(F.desc("cents"), key)
        .limit(k)
        .select(key, units("cents").alias("revenue"))
    )


def revenue_and_lines(lines: DataFrame, key: str | Column, name: str) -> DataFrame:
    key = F.col(key) if isinstance(key, str) else key
    return totals(lines, key.alias(name)).select(
        name, units("cents").alias("revenue"), F.col("lines").alias("orders")
    )


def headline(lines: DataFrame) -> DataFrame:
    """Totals with the percent of lines whose status mentions delivery, mentions
    cancelling, and is exactly cancelled."""
    status = F.lower("status")
    counted = cells(
        lines,
        distinct={"orders": F.col("order_id"), "categories": F.col("category")},
        counts={
            "lines": F.lit(True), "delivered": status.contains("deliver"),
            "cancelled": status.contains("cancel"), "exactly_cancelled": F.col("status") == "Cancelled",
        },
        sums={"qty": F.col("qty")},
        money={"cents": F.col("amount_cents")},
    ).totals()
    lines_ = F.col("lines")
    return counted.select(
        units("cents").alias("total_revenue"),
        F.col("orders").alias("total_orders"),
        F.col("qty").alias("total_qty"),
        mean2(F.col("cents"), lines_).alias("avg_order_value"),
        F.col("categories").alias("total_categories"),
        percent2(F.col("delivered"), lines_).alias("delivered_pct"),
        percent2(F.col("cancelled"), lines_).alias("cancel_pct"),
        percent2(F.col("exactly_cancelled"), lines_).alias("exact_cancel_pct"),
    )


def score_heatmap(scored: DataFrame, column: str) -> DataFrame:
    """Mean spend by frequency score and another score 1..5."""
    mean = mean2(money_sum("monetary_cents"), F.count(F.lit(1)))
    named = scored.withColumn("_score", F.concat(F.lit("s"), F.col(column).cast("string")))
    return named.groupBy("f_score").pivot("_score", [f"s{i}" for i in range(1, 6)]).agg(mean)
