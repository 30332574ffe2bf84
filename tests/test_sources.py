"""Cleaned files read back, saved tables, and matrices with lines that have no category."""

from pyspark.sql import functions as F

from salesprism.operators import cleaning as c, reshape as rs
from salesprism.plans import charts
from salesprism.sources.raw import raw_sales, read_cleaned_csv
from salesprism.sources.sinks import read_sql, register, write_table


def rows_of(df):
    return sorted(map(repr, df.collect()))


def test_cleaned_table_comes_back_from_csv(spark, tmp_path):
    cleaned = c.clean(raw_sales(spark, "/root/testdata/sf0.001"))
    write_table(cleaned, f"{tmp_path}/cleaned", "csv")
    back = read_cleaned_csv(spark, f"{tmp_path}/cleaned", cleaned.schema)
    assert back.dtypes == cleaned.dtypes and rows_of(back) == rows_of(cleaned)


def test_saved_tables_are_replaced(spark, tmp_path):
    spark.sql(f"create database if not exists kept location '{tmp_path}/kept'")
    try:
        for n in (3, 5):
            register(spark.range(n).toDF("n"), "kept.numbers", saved=True)
            assert read_sql(spark, "select count(*) as n from kept.numbers").first()["n"] == n
    finally:
        spark.sql("drop database kept cascade")


def test_lines_without_a_category_have_a_column(spark):
    lines = spark.createDataFrame(
        [("2022-01-05", "A", 100), ("2022-01-06", None, 250), ("2022-02-01", "B", 300), ("2022-02-02", "A", 50)], "d string, category string, amount_cents long"
    ).withColumn("order_date", F.col("d").cast("date")).drop("d")
    found = {r["month"]: r.asDict() for r in charts._by_category(lines, rs.month_category_matrix).collect()}
    assert found["2022-01"] == {"month": "2022-01", charts.BLANK: 2.5, "A": 1.0, "B": 0.0}
    assert found["2022-02"] == {"month": "2022-02", charts.BLANK: 0.0, "A": 0.5, "B": 3.0}
    known = charts._by_category(lines.where("category is not null"), rs.month_category_matrix)
    assert known.columns == ["month", "A", "B"]
