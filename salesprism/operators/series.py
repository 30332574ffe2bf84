"""Daily revenue panels: one row per series and day, with forecast features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from salesprism.functions.dates import is_weekend
from salesprism.functions.exact import money_sum, units
from salesprism.operators.windows import rolling_mean
from salesprism.sources.sales import completed

# fixed values: the lags and windows of the features
LAGS = (1, 2, 3, 7, 14)
ROLLS = (3, 7, 14)

CALENDAR_FEATURES = (
    "day_of_week", "day_of_month", "week_number", "month", "quarter", "is_weekend",
)
FEATURES = (
    *CALENDAR_FEATURES,
    *(f"{what}_lag_{k}" for k in LAGS for what in ("revenue", "orders")),
    *(f"revenue_roll_{k}" for k in ROLLS),
    "t",
)


def daily(lines: DataFrame, series: str | None = None) -> DataFrame:
    """Orders, cents and quantity of completed lines per series and day. Without a
    series column the whole table is one series."""
    name = F.col(series) if series else F.lit("all")
    return (
        completed(lines)
        .groupBy(name.alias("series"), F.col("order_date").alias("date"))
        .agg(
            F.count("order_id").alias("orders"),
            money_sum("amount_cents").cast("decimal(38,0)").alias("cents"),
            F.sum("qty").alias("qty"),
        )
    )


def densified(days: DataFrame) -> DataFrame:
    """Every day between a series' first and last one, 0 where nothing was sold.

    Each day stretches to the eve of the next one, so no second pass finds the ends.
    """
    following = F.lead("date").over(Window.partitionBy("series").orderBy("date"))
    stretch = F.sequence(
        F.col("date"), F.coalesce(F.date_sub("_next", 1), F.col("date")), F.expr("interval 1 day")
    )
    spread = days.withColumn("_next", following).withColumn("_day", F.explode(stretch))

    def sold(column: str, zero: Column) -> Column:
        return F.when(F.col("_day") == F.col("date"), F.col(column)).otherwise(zero).alias(column)

    return spread.select(
        "series",
        F.col("_day").alias("date"),
        sold("orders", F.lit(0)),
        sold("cents", F.lit(0).cast("decimal(38,0)")),
        sold("qty", F.lit(0)),
    )


def calendar_features(day: Column) -> dict[str, Column]:
    return {
        "day_of_week": F.weekday(day),
        "day_of_month": F.dayofmonth(day),
        "week_number": F.weekofyear(day),
        "month": F.month(day),
        "quarter": F.quarter(day),
        "is_weekend": is_weekend(day).cast("int"),
    }


def with_features(days: DataFrame) -> DataFrame:
    """Calendar, lag and trailing-mean features; days without a full history go.

    Windows run per series, whose rows are bounded by the calendar.
    """
    by_day = Window.partitionBy("series").orderBy("date")
    lagged = {}
    for k in LAGS:
        lagged[f"revenue_lag_{k}"] = units(F.lag("cents", k).over(by_day))
        lagged[f"orders_lag_{k}"] = F.lag("orders", k).over(by_day)
    rolled = {f"revenue_roll_{k}": rolling_mean("cents", by_day, -k, -1) for k in ROLLS}
    position = {"t": F.row_number().over(by_day) - 1}
    full = days.withColumns(
        {
            "daily_revenue": units("cents"),
            **calendar_features(F.col("date")),
            **lagged,
            **rolled,
            **position,
        }
    )
    return full.filter(F.col("t") >= max(LAGS)).select(
        "series", "date", "daily_revenue", F.col("orders").alias("daily_orders"),
        F.col("qty").alias("daily_qty"), *FEATURES,
    )


def split_by_time(featured: DataFrame, train_tenths: int = 8) -> DataFrame:
    """Mark the first 80 % of each series' days as training rows."""
    by_day = Window.partitionBy("series").orderBy("date")
    size = F.count(F.lit(1)).over(Window.partitionBy("series"))
    limit = F.call_function("div", size * train_tenths, F.lit(10))
    return featured.withColumn("is_train", F.row_number().over(by_day) <= limit)
