"""Aggregates that most reports share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from salesprism.functions.exact import mean2, money_sum, percent2, units


def totals(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Lines, distinct orders, quantity and cents per key.

    Columns that a report does not select are pruned from the plan, the distinct
    count included.
    """
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_distinct("order_id").alias("orders"),
        F.sum("qty").alias("qty"),
        money_sum("amount_cents").alias("cents"),
    )


def revenue(cents: str = "cents") -> Column:
    return units(F.col(cents))


def aov(cents: str = "cents", lines: str = "lines") -> Column:
    """Mean amount per line, the reports' average order value."""
    return mean2(F.col(cents), F.col(lines))


def share_of_total(part: str) -> Column:
    """Percent of the sum over all rows. Only for results with one row per
    category-like key: the total comes from a window over the whole result."""
    return percent2(F.col(part), F.sum(part).over(Window.partitionBy()))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("rows"), F.asc(column))
    )
