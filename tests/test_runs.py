"""Outputs of runs: read together or not at all; the combined report against SQL over the stored tables."""

import duckdb
import pytest

from pyspark.sql import functions as F

from salesprism.operators import combined
from salesprism.operators.runs import Run, committed, latest


def one(spark, value):
    return spark.createDataFrame([(value, None)], "v long, note string")


def test_a_half_written_run_is_not_read(spark, tmp_path):
    folder = str(tmp_path / "out")
    with pytest.raises(LookupError):
        latest(spark, folder, ["a"])
    first = Run(spark, folder)
    first.write("a", one(spark, 1))
    first.write("b", one(spark, 2))
    with pytest.raises(LookupError):
        latest(spark, folder, ["a"])
    first.commit()
    second = Run(spark, folder)
    second.write("a", one(spark, 3))
    found = latest(spark, folder, ["a", "b"])
    assert found["a"].first()["v"] == 1 and found["b"].first()["v"] == 2
    second.commit()
    # the newest run with both tables is still the first, so tables of two runs never meet
    found = latest(spark, folder, ["a", "b"])
    assert found["a"].first()["v"] == 1 and latest(spark, folder, ["a"])["a"].first()["v"] == 3
    assert {r["rows"] for r in committed(spark, folder).collect()} == {1}


def test_a_manifest_whose_job_broke_off_is_not_read(spark, tmp_path):
    folder = tmp_path / "out"
    run = Run(spark, str(folder))
    run.write("a", one(spark, 1))
    run.commit()
    (folder / "manifests" / run.name / "_SUCCESS").unlink()
    with pytest.raises(LookupError):
        latest(spark, str(folder), ["a"])


def test_empty_tables_keep_their_schema(spark, tmp_path):
    run = Run(spark, str(tmp_path))
    run.write("a", one(spark, 1).limit(0))
    run.commit()
    found = latest(spark, str(tmp_path), ["a"])["a"]
    assert found.dtypes == [("v", "bigint"), ("note", "string")] and found.count() == 0


def test_combined_report_is_sql_over_the_stored_tables(spark, tmp_path):
    segments = spark.createDataFrame(
        [(i, i % 90 + 1, i % 4 + 1, 1000 + 7 * i, ["High", "Low", "Low"][i % 3]) for i in range(300)],
        "customer_id long, recency int, frequency long, monetary_cents long, segment string",
    )
    forecast = spark.range(40).select(
        F.lit("all").alias("series"), F.date_add(F.lit("2022-01-01"), F.col("id").cast("int")).alias("date"),
        F.when(F.col("id") < 10, "actual").otherwise("forecast").alias("kind"), (F.col("id") * 37 % 101 + 0.25).alias("revenue"),
        F.lit(0.0).alias("lo"), F.lit(1e6).alias("hi"),
    )
    models = spark.createDataFrame([(1, "Forest", 5.9), (2, "Ridge", 8.2)], "rank int, model string, mape_pct double")
    run = Run(spark, str(tmp_path))
    for name, df in (("segments", segments), ("forecast", forecast), ("models", models)):
        run.write(name, df)
    run.commit()
    tables = latest(spark, str(tmp_path), combined.TABLES)
    found = {(r["block"], r["item"], r["metric"]): r["value"] if r["text"] is None else r["text"] for r in combined.combined_report(tables).collect()}
    base = f"{tmp_path}/{run.name}"
    duck = duckdb.connect()
    for seg, n, pct, mean, total in duck.execute(
        f"select segment, count(*), round(100.0 * count(*) / sum(count(*)) over (), 2), round(avg(monetary_cents) / 100 + 1e-9, 2), "
        f"sum(monetary_cents) / 100 from '{base}/segments/*.parquet' group by 1"
    ).fetchall():
        assert found["segment", seg, "customers"] == n and found["segment", seg, "customers_pct"] == pytest.approx(float(pct))
        assert found["segment", seg, "total_revenue"] == pytest.approx(float(total)) and found["segment", seg, "avg_monetary"] == pytest.approx(float(mean), abs=0.011)
    total, mean, best, day = duck.execute(
        f"select sum(revenue), avg(revenue), max(revenue), arg_max(date, revenue) from '{base}/forecast/*.parquet' where kind = 'forecast'"
    ).fetchone()
    assert found["forecast", "all", "total"] == pytest.approx(total, abs=0.01) and found["forecast", "all", "daily_mean"] == pytest.approx(mean, abs=0.01)
    assert found["forecast", "all", "best_day"] == best and found["forecast", "all", "best_date"] == str(day)
    assert found["forecast", "all", "model_used"] == "Forest" and found["forecast", "all", "mape_pct"] == 5.9
    checks = {r["item"]: r["value"] for r in combined.stored_checks(tables).collect()}
    assert checks["customers"] == checks["different_customers"] == 300 and checks["forecast_days"] == checks["days_ahead"] == 30
    assert checks["gap_days"] == 1 and checks["outside_band"] == 0 and checks["models"] == 2 and checks["best_models"] == 1
