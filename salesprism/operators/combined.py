"""The combined report over stored customer segments and a stored forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from salesprism.operators import forecast as fc, segmentation as sg

TABLES = ("segments", "forecast", "models")


def combined_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Blocks of the report as rows (block, item, metric, value, text).

    ``segments`` are customers with their segment, ``forecast`` the history and forecast days, ``models`` the comparison
    of the models: the tables of one run.
    """
    segments = sg.segment_summary(tables["segments"])
    future = tables["forecast"].filter("kind = 'forecast'").withColumnRenamed("revenue", "predicted_revenue")
    kpis = fc.forecast_kpis(future, tables["models"])
    number, text = F.lit(None).cast("double"), F.lit(None).cast("string")

    def rows(df: DataFrame, block: str, item: str, numbers: tuple[str, ...], texts: tuple[str, ...] = ()) -> DataFrame:
        cells = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"), text.alias("text")) for m in numbers]
        cells += [F.struct(F.lit(m).alias("metric"), number.alias("value"), F.col(m).cast("string").alias("text")) for m in texts]
        return df.select(F.lit(block).alias("block"), F.col(item).cast("string").alias("item"), F.inline(F.array(*cells)))

    return rows(
        segments, "segment", "segment", ("customers", "customers_pct", "avg_recency_days", "avg_frequency", "avg_monetary", "total_revenue", "revenue_share_pct"),
    ).unionByName(rows(
        kpis, "forecast", "series", ("total", "daily_mean", "best_day", "mape_pct"), ("best_date", "model_used"),
    ))


def stored_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """What must hold of a stored run whatever the models found: (item, value)."""
    segments = tables["segments"].agg(
        F.count(F.lit(1)).alias("customers"), F.count_distinct("customer_id").alias("different_customers"),
        F.sum("monetary_cents").cast("bigint").alias("revenue_cents"), F.count_if(F.col("segment").isNull()).alias("customers_without_segment"),
    )
    known = F.col("kind") == "actual"
    days = tables["forecast"].agg(
        F.count_if(known).alias("history_days"), F.count_if(~known).alias("forecast_days"),
        F.round(F.sum(F.when(known, F.col("revenue"))) * 100).cast("bigint").alias("history_cents"),
        F.datediff(F.min(F.when(~known, F.col("date"))), F.max(F.when(known, F.col("date")))).alias("gap_days"),
        F.datediff(F.max("date"), F.max(F.when(known, F.col("date")))).alias("days_ahead"),
        F.count_if(~known & ((F.col("revenue") < F.col("lo")) | (F.col("revenue") > F.col("hi")))).alias("outside_band"),
    )
    models = tables["models"].agg(F.count(F.lit(1)).alias("models"), F.count_if(F.col("rank") == 1).alias("best_models"))

    def rows(df: DataFrame) -> DataFrame:
        return df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("item"), F.col(c).cast("bigint").alias("value")) for c in df.columns])))

    return rows(segments).unionByName(rows(days)).unionByName(rows(models))
