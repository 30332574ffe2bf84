"""Repeated rows are found by hashes, and whole rows stay out of shuffles and sorts."""

import pytest
from pyspark.sql import functions as F

from salesprism.functions.text import title_case
from salesprism.operators import cleaning as c, measures as m, quality as q, repeats as r


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("most", [r.MOST_SENT, 0])
def test_distinct_rows(spark, monkeypatch, most):
    monkeypatch.setattr(r, "MOST_SENT", most)
    rows = [("a", None, 1), (None, "a", 1), ("a", None, 1), ("a", "a", 1), (None, None, None), (None, None, None), ("b", "c", 2)] * 2 + [("z", "z", 0)]
    df = spark.createDataFrame(rows, "x string, y string, z int")
    found = r.distinct_rows(r.hashed(df))
    assert found.columns == df.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, df.distinct().collect()))
    assert q.duplicate_count(df).first()[0] == len(rows) - len(set(rows))
    assert df.agg(F.count_distinct(r.row_digest(df.columns))).first()[0] == len(set(rows))


def test_rows_without_copies_are_not_shuffled(spark):
    stored = r.hashed(spark.range(1000).select(F.col("id").cast("string").alias("a"), F.lit("x").alias("b")))
    found = r.distinct_rows(stored)
    assert found.count() == 1000 and "Exchange" not in executed(found)


def test_rows_with_one_hash_are_compared(spark):
    rows = [("a", 1), ("b", 1), ("a", 1), ("c", 2)]
    stored = spark.createDataFrame(rows, f"t string, {r.HASH} long")
    assert sorted(x[0] for x in r.distinct_rows(stored).collect()) == ["a", "b", "c"]


def test_cleaned_summary_shuffles_no_whole_row(spark):
    df = spark.createDataFrame(
        [("o1", "c", "s", "2022-03-01", 2, 100, None)] * 2 + [("o2", "c", "t", "2022-03-02", 1, 50, "x")],
        "order_id string, category string, ship_state string, date string, qty long, amount_cents long, note string",
    )
    found = q.cleaned_summary(df)
    dealt = [line for line in executed(found).splitlines() if "hashpartitioning(" in line]
    assert dealt and not any("note#" in line for line in dealt)
    assert found.first()["duplicates"] == 1 and q.raw_summary(df).first()["duplicates"] == 1


def test_profile_sorts_no_cells(spark):
    df = spark.createDataFrame([("a", 1, None), ("b", 1, None), ("a", 2, None)], "x string, y int, z string")
    found = q._counted(df)
    assert "Sort [" not in executed(found)
    rows = {x["column"]: x for x in found.collect()}
    assert [(rows[k]["rows"], rows[k]["non_null"], rows[k]["unique_values"], rows[k]["sample"]) for k in "xyz"] == [
        (3, 3, 2, "a"), (3, 3, 2, "1"), (3, 0, 0, None)]


def test_cleaning_keeps_lines_that_differ_in_a_gap(spark):
    from salesprism.sources import raw as src

    base = ["1", "O", "03-31-2022", *["x"] * 10, "1", "INR", "5", *["y"] * 7]
    first, second = list(base), list(base)
    first[6], second[7] = None, None
    df = spark.createDataFrame([tuple(v) for v in (first, second, first, second, base)], src.RAW_SCHEMA)
    run = c.start_cleaning(df)
    assert run.distinct.count() == 3 and q.cleaning_counts(run).first()["duplicates_removed"] == 2


def test_title_case_of_ascii_ends(spark):
    texts = ["S3", "TOWN-4", "new TOWN-4", "3xl", "a\tb", "x-y", "é1x", "o'neil st", "", " ", "a1 b", "ab\n", "A[b", "ß-1"]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select("t", title_case(F.col("t")).alias("u")).collect()
    cut = {t: "".join(w[:1].upper() + w[1:] for w in __import__("re").findall(r"[^\W\d_]+|[\W\d_]+", t.lower())) for t in texts}
    assert {x["t"]: x["u"] for x in found} == cut


def test_sums_need_no_row_per_order(spark):
    df = spark.createDataFrame(
        [(1, "Cancelled", 2, 100, "A"), (1, "Shipped", 1, 50, "A"), (None, "Shipped", None, 25, "A"), (2, "Cancelled", 4, 10, None)],
        "order_id long, status string, qty int, amount_cents long, size string",
    )
    found = m.measure(df, ["total_revenue", "total_quantity_sold"], ["size"])
    assert "order_id#" not in "".join(line for line in executed(found).splitlines() if "hashpartitioning(" in line)
    assert {tuple(x) for x in found.collect()} == {("A", 0.75, 3), (None, 0.0, 4)}


def test_line_keys_of_single_lines_are_not_shuffled(spark):
    from salesprism.operators import incremental as inc

    single = spark.range(300).select(F.col("id").alias("order_id"), F.lit(None).cast("string").alias("note"))
    assert "hashpartitioning(" not in executed(inc.with_line_keys(single))
    keyed = inc.with_line_keys(single.unionByName(single.where("order_id < 20")).unionByName(single.where("order_id = 7")))
    assert keyed.count() == 321 and inc.repeated_keys(keyed).first()["violations"] == 0
    # a line's key is the same whether it has copies or not
    assert inc.with_line_keys(single).join(keyed, "order_line_key", "left_anti").count() == 0
