"""Recency, frequency and spend per customer, with scores 1 to 5."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from salesprism.functions.exact import money_sum, units
from salesprism.operators.quantiles import quantile_bins, rank_bins, scaled_quantiles
from salesprism.session import materialised
from salesprism.sources.sales import completed

SCORES = 5


def rfm(lines: DataFrame) -> DataFrame:
    """One row per customer with a completed order, as of the day after the last one.

    Lines fold to customers in one shuffle with a map-side combine, so a customer with
    a third of all lines is no burden. The customer table is written once, because the
    scores and clusters read it many times.
    """
    customers = completed(lines).groupBy("customer_id").agg(
        F.max("order_date").alias("last_date"),
        F.count("order_id").alias("frequency"),
        money_sum("amount_cents").cast("bigint").alias("monetary_cents"),
    )
    customers = materialised(customers)
    last = customers.agg(F.max("last_date")).first()[0]
    return customers.select(
        "customer_id",
        (F.datediff(F.lit(last).cast("date"), F.col("last_date")) + 1).alias("recency"),
        "frequency",
        "monetary_cents",
    )


def scored(customers: DataFrame) -> DataFrame:
    """Scores by equal-count bins: recency and spend on values, so ties share a score;
    frequency on ranks with the customer as tie-break, so every score has its fifth."""
    binned = rank_bins(customers, "frequency", "customer_id", SCORES, "f_score")
    binned = quantile_bins(binned, "recency", SCORES, "r_bin", source=customers)
    binned = quantile_bins(binned, "monetary_cents", SCORES, "m_score", source=customers)
    with_r = binned.withColumn("r_score", (SCORES + 1 - F.col("r_bin")).cast("int"))
    return with_r.withColumns(
        {
            "rfm_score": F.col("r_score") + F.col("f_score") + F.col("m_score"),
            "rfm_segment": F.concat(*[F.col(c).cast("string") for c in ("r_score", "f_score", "m_score")]),
        }
    ).drop("r_bin")


def described(customers: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per measure."""
    rows = None
    for name, column, scale in (
        ("recency", "recency", 1.0),
        ("frequency", "frequency", 1.0),
        ("monetary", "monetary_cents", 100.0),
    ):
        value = F.col(column).cast("double") / F.lit(scale)
        quartiles = scaled_quantiles(
            customers, column, {"q1": (1, 4), "q2": (2, 4), "q3": (3, 4)}
        ).select(F.struct("*")).scalar()
        one = customers.agg(
            F.count(column).alias("count"),
            F.round(F.avg(value), 2).alias("mean"),
            F.round(F.stddev_samp(value), 2).alias("std"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
        ).withColumn("_q", quartiles)
        one = one.select(
            F.lit(name).alias("measure"), "count", "mean", "std", "min",
            *[(F.col(f"_q.{q}") / F.lit(4.0 * scale)).alias(p) for q, p in
              (("q1", "p25"), ("q2", "p50"), ("q3", "p75"))],
            "max",
        )
        rows = one if rows is None else rows.unionByName(one)
    return rows


def with_units(customers: DataFrame) -> DataFrame:
    """Spend as currency units, for export."""
    return customers.withColumn("monetary", units("monetary_cents")).drop("monetary_cents")
