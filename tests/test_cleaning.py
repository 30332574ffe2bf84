"""Cleaning on small hand-made files."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from salesprism.operators import cleaning as c, quality as q
from salesprism.sources import raw as src
from salesprism.sources.sinks import export_catalogue, write_cleaned, write_report_json, write_report_text


def order(number, **changes):
    row = {
        "index": str(number), "Order ID": f"O-{number}", "Date": "03-31-2022", "Status": "Shipped",
        "Fulfilment": "merchant", "Sales Channel ": "Shop.in", "ship-service-level": "EXPEDITED",
        "Style": "s", "SKU": f"K-{number}", "Category": "set", "Size": "3XL", "ASIN": "A",
        "Courier Status": None, "Qty": "2", "currency": "INR", "Amount": "100.00",
        "ship-city": " o'neil st ", "ship-state": None, "ship-postal-code": "400001",
        "ship-country": "IN", "promotion-ids": None, "B2B": "True", "fulfilled-by": None,
    }
    return {**row, **changes}


@pytest.fixture(scope="module")
def orders(spark):
    rows = [
        order(1), order(1), order(2, Date="nope"), order(3, Amount=None), order(4, Qty="x"),
        order(5, Amount="101.00", Status=None), order(6, Amount="99.99", Qty="0"),
        order(7, Amount="900000.00", Status=" Cancelled"), order(8, Amount="100.01", Status=" Cancelled"),
        order(9, Amount="abc"),
    ]
    return spark.createDataFrame([tuple(r[n] for n in src.RAW_HEADER) for r in rows], src.RAW_SCHEMA)


def test_clean(orders):
    rows = {r["order_id"]: r for r in c.clean(orders).collect()}
    assert sorted(rows) == ["O-1", "O-3", "O-4", "O-5", "O-6", "O-7", "O-8", "O-9"]
    first = rows["O-1"]
    assert (first["category"], first["size"], first["ship_city"], first["ship_state"]) == (
        "Set", "3Xl", "O'Neil St", "Unknown")
    assert first["sales_channel"] == "Shop.in" and first["b2b"] == "Yes"
    assert first["promotion_ids"] == "No Promotion" and first["date"] == date(2022, 3, 31)
    assert (first["month_name"], first["day_of_week"], first["week"]) == ("Mar", "Thursday", 13)
    # median of 99.99 100 100 100.01 101 900000 is 100.005, which rounds half up
    assert rows["O-3"]["amount_cents"] == rows["O-9"]["amount_cents"] == 10001
    assert rows["O-4"]["qty"] == 1 and rows["O-4"]["unit_price_cents"] == 10000
    assert rows["O-5"]["status"] == "Shipped"
    assert rows["O-6"]["unit_price_cents"] is None
    # the unit price keeps the value from before capping
    assert rows["O-7"]["unit_price_cents"] == 45_000_000 and rows["O-7"]["amount_cents"] < 20_000
    assert rows["O-7"]["status"] == "Cancelled"


def test_counts_and_report(orders, tmp_path, spark):
    run = c.start_cleaning(orders)
    counts = q.cleaning_counts(run).first()
    assert (counts["duplicates_removed"], counts["bad_dates_dropped"], counts["amount_filled"]) == (1, 1, 2)
    assert (counts["status_filled"], counts["qty_defaulted"], counts["outliers_capped"]) == (1, 1, 1)
    report = q.quality_report(run)
    assert re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}", report.first()["report_generated_at"])
    write_report_json(report, f"{tmp_path}/json")
    stored = spark.read.json(f"{tmp_path}/json").first()
    assert stored["raw_dataset"]["rows"] == 10 and stored["cleaned_dataset"]["rows"] == 8
    assert stored["cleaning_actions"][0] == "Removed 1 duplicate rows" and len(stored["cleaning_actions"]) == 12
    write_report_text(q.report_lines(report), f"{tmp_path}/text")
    assert any("CLEANED DATASET" in r[0] for r in spark.read.text(f"{tmp_path}/text").collect())


def test_profile_exact_and_sketched(orders):
    df = c.standardise_names(orders)
    exact = {r["name"]: r for r in q.profile(df).collect()}
    assert exact["order_id"]["unique_values"] == 9 and exact["courier_status"]["null_pct"] == 100.0
    assert exact["courier_status"]["sample"] == "N/A"
    rough = {r["name"]: r for r in q.profile(df, approximate=True).collect()}
    assert rough["amount"]["null_count"] == exact["amount"]["null_count"] == 1
    assert rough["order_id"]["unique_values"] == 9


def test_empty_raw_table(spark):
    empty = spark.createDataFrame([], src.RAW_SCHEMA)
    assert c.clean(empty).count() == 0
    assert q.profile(empty).count() == len(src.RAW_HEADER)
    assert q.duplicate_count(empty).first()[0] == 0


def test_names_that_clash(spark):
    with pytest.raises(ValueError, match="clash"):
        c.standardise_names(spark.createDataFrame([(1, 2)], ["Ship City", "ship-city"]))


def test_csv_round_trip(orders, spark, tmp_path):
    spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    orders.write.option("header", True).options(**spaces).csv(f"{tmp_path}/raw")
    read = src.read_raw_csv(spark, f"{tmp_path}/raw").drop(src.CORRUPT)
    assert read.exceptAll(orders).count() == 0 and orders.exceptAll(read).count() == 0
    cleaned = c.clean(read)
    write_cleaned(cleaned, f"{tmp_path}/cleaned")
    stored = spark.read.parquet(f"{tmp_path}/cleaned")
    assert stored.count() == cleaned.count()
    assert stored.filter("year = 2022 and month = 3").count() == 8
    mapped = src.read_mapped_csv(spark, f"{tmp_path}/raw", [f"c{i}" for i in range(23)])
    assert mapped.columns[1] == "c1" and mapped.count() == 10


def test_typed_import(orders):
    typed = src.with_types(c.clean(orders).withColumn("amount", F.col("amount_cents") / 100), src.IMPORT_TYPES)
    assert dict(typed.dtypes)["amount"] == "decimal(12,2)" and dict(typed.dtypes)["ship_postal_code"] == "string"


def test_reports_run_on_cleaned_lines(orders, tmp_path, spark):
    from salesprism.plans import reports as r

    lines = c.as_sales(c.clean(orders))
    assert r.overall_kpis(lines).first()["total_orders"] == 8
    listed = {
        "status": ("By status", lambda: r.status_distribution(lines)),
        "broken": ("Fails", lambda: lines.select("no_such_column")),
        "kpis": ("KPIs", lambda: r.overall_kpis(lines)),
    }
    catalogue = {x["key"]: x for x in export_catalogue(spark, listed, f"{tmp_path}/out").collect()}
    assert catalogue["status"]["rows"] == 2 and catalogue["kpis"]["rows"] == 1
    assert catalogue["broken"]["rows"] is None and catalogue["broken"]["error"]
    assert spark.read.parquet(f"{tmp_path}/out/status").count() == 2


def test_texts_are_stripped_once(orders):
    from salesprism.functions.text import stripped

    spark = orders.sparkSession
    spaces = ["\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x1f", " ", "\x85", "\xa0", " ", " ", " ", "　"]
    cores = ["", "x", "a b", "~", "é", "\x00", "~x~", "​"]
    texts = [a + core + b for core in cores for a in ["", *spaces] for b in ["", *spaces, " 　\t"]]
    found = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").select("t", stripped(F.col("t")).alias("u")).collect()
    assert [x["u"] for x in found] == [None if x["t"] is None else x["t"].strip() for x in found]

    plan = c.start_cleaning(orders).filled.select("category")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("trim(") == 1
