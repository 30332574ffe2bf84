"""All registered queries."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from salesprism.plans.charts import CHARTS
from salesprism.plans.cleaning import CLEANING
from salesprism.plans.measures import MEASURE_QUERIES
from salesprism.plans.models import MODELS
from salesprism.plans.named import NAMED
from salesprism.plans.registry import NamedQuery
from salesprism.plans.warehouse import WAREHOUSE
from salesprism.sources.sinks import export_catalogue


def export_reports(spark: SparkSession, folder: str, out: str) -> DataFrame:
    """Write every business report under ``out``; returns the catalogue with row counts."""
    listed = {q.key: (q.title, partial(q, spark, folder)) for q in NAMED}
    return export_catalogue(spark, listed, out)


def all_queries() -> dict[str, NamedQuery]:
    listed = [*NAMED, *CLEANING, *WAREHOUSE, *MEASURE_QUERIES, *CHARTS, *MODELS]
    found = {q.key: q for q in listed}
    if len(found) != len(listed):
        raise ValueError("two registered queries share a key")
    return found
