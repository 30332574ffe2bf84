"""Writers: cleaned tables, query results, views and reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def write_cleaned(df: DataFrame, path: str) -> None:
    """Cleaned lines as Parquet by year and month. Rows of a month spread over as many
    files as their size asks for, so a busy month is no single task."""
    df.hint("rebalance", "year", "month").write.mode("overwrite").partitionBy(
        "year", "month"
    ).parquet(path)


def write_table(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """Segments, forecasts and other results as Parquet or CSV."""
    writer = df.write.mode("overwrite")
    if kind == "csv":
        writer = writer.option("header", True)
    writer.format(kind).save(path)


def register(df: DataFrame, name: str, saved: bool = False) -> None:
    """Make a table known to SQL, as a view or as a saved table that is replaced."""
    if saved:
        df.write.mode("overwrite").saveAsTable(name)
    else:
        df.createOrReplaceTempView(name)


def read_sql(spark: SparkSession, text: str) -> DataFrame:
    return spark.sql(text)


def write_report_json(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def write_report_text(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").text(path)


def write_counted(df: DataFrame, path: str, kind: str = "parquet") -> int:
    """Write and return the row count, observed during the write itself."""
    seen = Observation()
    write_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, kind)
    return seen.get["rows"]


def export_catalogue(
    spark: SparkSession,
    queries: dict[str, tuple[str, Callable[[], DataFrame]]],
    out: str,
) -> DataFrame:
    """Write every query result under ``out`` and return the catalogue: number, key,
    title, rows. A failing query is listed with its error and does not stop the rest."""
    listed = []
    for number, (key, (title, build)) in enumerate(queries.items(), 1):
        try:
            rows, error = write_counted(build(), f"{out}/{key}"), None
        except Exception as problem:  # the catalogue reports it
            rows, error = None, str(problem).splitlines()[0]
        listed.append((number, key, title, rows, error))
    schema = "number int, key string, title string, rows bigint, error string"
    catalogue = spark.createDataFrame(listed, schema)
    write_table(catalogue, f"{out}/catalogue")
    return catalogue
