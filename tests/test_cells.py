"""Distinct counts that merge: equal to counting, from one scan, without Expand."""

import random

import pytest

from pyspark.sql import functions as F

from salesprism.operators.cells import cells, numbered
from salesprism.plans.catalogue import all_queries


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def lines(spark):
    random.seed(3)
    rows = [
        (random.choice(["a", "b", None]), random.choice(["x", "y", None]), random.choice([None, -1, -64, 63, 64, 2**62, *range(200)]),
         random.choice(["p", "q", "", None]), random.choice([None, 2**60, -5, 7]))
        for _ in range(3000)
    ]
    return spark.createDataFrame(rows, "g string, h string, number long, word string, cents long").repartition(5)


@pytest.fixture(scope="module")
def folded(lines):
    return cells(
        lines, distinct={"numbers": F.col("number"), "words": F.col("word")}, counts={"rows": F.lit(True), "negative": F.col("number") < 0},
        sums={"whole": F.col("number") % 7}, money={"cents_": F.col("cents")}, least={"low": F.col("number")}, most={"high": F.col("word")},
        by=("g", "h"), distinct_by=("g", "h"),
    ).stored()


@pytest.mark.parametrize("keys", [(), ("g",), ("h",), ("g", "h")])
def test_totals_of_any_keys_from_one_table(lines, folded, keys):
    expected = lines.groupBy(*keys).agg(
        F.count_distinct("number").alias("numbers"), F.count_distinct("word").alias("words"), F.count("*").alias("rows"),
        F.count_if(F.col("number") < 0).alias("negative"), F.sum(F.col("number") % 7).alias("whole"),
        F.sum(F.col("cents").cast("decimal(38,0)")).alias("cents_"), F.min("number").alias("low"), F.max("word").alias("high"),
    )
    actual = folded.totals(*keys).select(*expected.columns)
    assert sorted(map(repr, actual.collect())) == sorted(map(repr, expected.collect()))
    again = folded.rolled_up(*keys).totals(*keys).select(*expected.columns)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, expected.collect()))


def test_no_rows_count_nothing(lines):
    found = cells(lines.limit(0), distinct={"numbers": F.col("number")}, counts={"rows": F.lit(True)}, sums={"whole": F.col("number")}).totals().collect()
    assert [tuple(r) for r in found] == [(0, 0, None)]


def test_counts_need_their_keys(lines):
    with pytest.raises(ValueError):
        cells(lines, distinct={"numbers": F.col("number")}, by=("g",), distinct_by=("h",))


def test_dense_numbers_fill_words(spark, lines):
    """Sparse numbers and texts become neighbours, so that 64 of them share a cell."""
    sparse = spark.range(640).select((F.col("id") * 1_000_003).alias("order_id"), F.concat(F.lit("T"), "id").alias("name"))
    for column in sparse.columns:
        dense = numbered(sparse.unionByName(sparse), column, "n")
        found = cells(dense, distinct={"orders": F.col("n")})
        assert found.totals().first()["orders"] == 640 and found.table.filter("_kind = 0").count() == 11
    plain = cells(sparse, distinct={"orders": F.col("order_id")})
    assert plain.totals().first()["orders"] == 640
    odd = numbered(lines, "word", "n")
    assert odd.count() == lines.count() and odd.filter("(n is null) <> (word is null)").isEmpty()


@pytest.mark.parametrize("key", ["q25_executive_summary", "dashboard_headline"])
def test_headlines_scan_the_lines_once_without_expand(spark, folder, key):
    plan = executed(all_queries()[key](spark, folder))
    assert "Expand" not in plan
    assert plan.count("lineitem.parquet") == 1


def test_cleaned_summary_has_one_pass_over_the_lines(spark, folder):
    from salesprism.operators import quality

    lines = spark.createDataFrame(
        [("o1", "c", "s", "2022-03-01", 2, 100, None), ("o1", "c", "s", "2022-03-01", 2, 100, None), ("o2", "c", "t", "2022-03-02", 1, 50, "x")],
        "order_id string, category string, ship_state string, date string, qty long, amount_cents long, note string",
    )
    found = quality.cleaned_summary(lines)
    plan = executed(found)
    assert "Expand" not in plan and plan.count("Scan ") == 1
    row = found.first()
    assert (row["rows"], row["duplicates"], row["total_nulls"], row["total_orders"], row["total_qty"], row["states"]) == (3, 1, 2, 2, 5, 2)
    assert row["date_range"] == "2022-03-01 to 2022-03-02" and row["total_revenue"] == 2.5 and row["avg_order_value"] == 0.83


TEXTS = ["1", "01", "1.0", "1.00", "-0", "-0.00", "0", "0.00", "-1.50", "1.5", "100", "1e3", "", " 1", "999999999999999999", "9999999999999999999", "0.500", "x", None]


def test_numbers_in_texts_stay_different_values(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS * 3], "t string")
    found = cells(df, distinct={"n": F.col("t")}, numbers_in_text=True).totals().first()["n"]
    assert found == len(set(TEXTS)) - 1


def test_profile_shuffles_less_than_its_input(spark, folder):
    from salesprism.operators import quality

    df = spark.range(200_000).select(
        F.col("id").cast("string").alias("index"), (F.col("id") % 9).alias("kind"), (F.col("id") * 7 / 100).cast("decimal(12,2)").cast("string").alias("amount"),
        F.when(F.col("id") % 5 > 0, "x").alias("gaps"),
    )
    rows = {r["name"]: r for r in quality.profile(df).collect()}
    assert {n: r["unique_values"] for n, r in rows.items()} == {"index": 200_000, "kind": 9, "amount": 200_000, "gaps": 1}
    assert rows["gaps"]["null_count"] == 40_000 and rows["index"]["sample"] == "0" and rows["kind"]["dtype"] == "bigint"
    texts = [F.col(c).cast("string") for c in df.columns]
    table = cells(df, distinct={f"u{i}": t for i, t in enumerate(texts)}, numbers_in_text=True).table
    # a word of 64 neighbours is one row, so far fewer rows than cells with values leave the tasks
    assert table.count() < 200_000 * 2 / 8
    assert quality.null_counts(df).collect()[0].asDict() == {"name": "gaps", "null_count": 40_000, "null_pct": 20.0}
