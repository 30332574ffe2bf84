"""Exact quantiles, bins and tiles against pandas and plain windows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesprism.operators import quantiles as qt
from salesprism.operators.windows import global_row_number


def frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v long")


CASES = {
    "one row": [7],
    "all equal": [5] * 11,
    "negatives and nulls": [-3, None, 4, -3_000_000, 9_000_000, 0, None],
    "wide": [(i * 7_919_333_331) % 10**10 for i in range(257)],
    "a third hot": [42] * 60 + list(range(120)),
    "fewer rows than tiles": [3, 1],
}


@pytest.mark.parametrize("name", CASES)
def test_quantiles_match_numpy(spark, name):
    known = [v for v in CASES[name] if v is not None]
    fractions = {f"q{n}_{d}": (n, d) for n, d in ((1, 4), (1, 2), (3, 4), (1, 5), (4, 5))}
    row = qt.scaled_quantiles(frame(spark, CASES[name]), "v", fractions).first()
    for column, (n, d) in fractions.items():
        assert row[column] / d == pytest.approx(np.quantile(known, n / d), rel=1e-12, abs=1e-9)


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("tiles", [2, 4, 5])
def test_ntile_matches_window(spark, name, tiles):
    df = frame(spark, CASES[name]).filter("v is not null")
    plain = df.select("id", F.ntile(tiles).over(Window.orderBy("v", "id")).alias("expected"))
    wrong = qt.ntile(df, "v", "id", tiles).join(plain, "id").filter("tile <> expected")
    assert wrong.count() == 0


@pytest.mark.parametrize("name", ["wide", "a third hot", "negatives and nulls"])
def test_tile_summary_matches_tiles(spark, name):
    df = frame(spark, CASES[name]).filter("v is not null")
    tiled = qt.ntile(df, "v", "id", 4).groupBy("tile").agg(
        F.count("*").alias("rows"), F.min("v").alias("smallest"), F.max("v").alias("largest"),
        F.sum("v").cast("decimal(38,0)").alias("cents"),
    )
    ours = qt.tile_summary(df, "v", 4).select("tile", "rows", "smallest", "largest",
                                              F.col("cents").cast("decimal(38,0)").alias("cents"))
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, tiled.collect()))


def test_quantile_bins_match_qcut(spark):
    values = [(i * 7919) % 503 % 97 for i in range(400)]
    ours = qt.quantile_bins(frame(spark, values), "v", 5, "bin").orderBy("id").collect()
    assert [r["bin"] for r in ours] == (pd.qcut(pd.Series(values), 5, labels=False) + 1).tolist()


@pytest.mark.parametrize("n", [1, 2, 5, 7, 23, 100])
def test_rank_bins_match_qcut_of_rank(spark, n):
    values = [(i * 7919) % 13 % 4 for i in range(n)]
    ours = qt.rank_bins(frame(spark, values), "v", "id", 5, "bin").orderBy("id").collect()
    ranks = pd.Series(values).rank(method="first")
    expected = (pd.qcut(ranks, 5, labels=False) + 1).tolist() if n > 1 else [1]
    assert [r["bin"] for r in ours] == expected


def test_edges_that_coincide_merge(spark):
    bins = qt.quantile_bins(frame(spark, [1] * 8 + [2, 3]), "v", 5, "bin")
    assert {(r["v"], r["bin"]) for r in bins.collect()} == {(1, 1), (2, 5), (3, 5)}


def test_grouped_quantiles_keep_the_null_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 3), ("a", 10)], "g string, v long")
    found = qt.scaled_quantiles(df, "v", {"m": (1, 2)}, ["g"]).collect()
    assert {(r["g"], r["m"]) for r in found} == {(None, 4), ("a", 20)}


def test_empty_table(spark):
    empty = frame(spark, [1]).filter("v > 5")
    assert qt.ntile(empty, "v", "id", 4).count() == 0
    assert qt.tile_summary(empty, "v", 4).count() == 0
    assert qt.mode(empty, "v").count() == 0


def test_mode_takes_the_smallest_of_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "s string")
    assert [r["s"] for r in qt.mode(df, "s").collect()] == ["a"]


def test_box_stats(spark):
    values = [1, 2, 3, 4, 5, 6, 7, 8, 100]
    df = spark.createDataFrame([("x", v) for v in values], "g string, v long")
    row = qt.box_stats(df, "v", "g").first()
    assert (row["q1"], row["median"], row["q3"]) == (3.0, 5.0, 7.0)
    assert (row["whisker_low"], row["whisker_high"], row["fliers"], row["rows"]) == (1, 8, 1, 9)


def test_global_row_number(spark):
    rows = [((i * 7919) % 13 % 3, i) for i in range(500)]
    df = spark.createDataFrame(rows, "v long, id long").repartition(7)
    numbered = global_row_number(df, ["v", "id"]).collect()
    assert [(r["v"], r["id"]) for r in sorted(numbered, key=lambda r: r["row_number"])] == sorted(rows)
    assert sorted(r["row_number"] for r in numbered) == list(range(1, 501))


def test_no_task_sees_all_rows_of_a_hot_value(spark):
    """A hot value is one counter: the only unpartitioned window runs over buckets."""
    df = frame(spark, [42] * 5000 + list(range(5000)))
    ranks = qt.value_ranks(df, "v")
    assert ranks.filter("v = 42").first()["n"] == 5001
    plan = ranks._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange SinglePartition") == 1


def test_text_ties_are_cut_in_their_own_order(spark):
    """A hundred thousand equal values and a few others: bins equal row_number over (value, text), whose ties spread over tasks."""
    rows = spark.range(100_400).select(
        F.when(F.col("id") < 100_000, 7).otherwise(F.col("id") % 5 + 5).alias("v"),
        F.concat(F.lit("C-"), F.reverse(F.col("id").cast("string")), F.lit("é")).alias("name"),
    )
    ours = qt.rank_bins(rows, "v", "name", 5, "bin")
    plain = ours.withColumn("place", F.row_number().over(Window.orderBy("v", "name"))).toPandas()
    ranks = pd.Series(range(1, len(plain) + 1))
    expected = (pd.qcut(ranks, 5, labels=False) + 1).tolist()
    assert plain.sort_values("place")["bin"].tolist() == expected
    tiles = qt.ntile(rows, "v", "name", 4).withColumn("own", F.ntile(4).over(Window.orderBy("v", "name")))
    assert tiles.where("tile <> own").isEmpty()


@pytest.mark.parametrize("values", [[], [3], [1, 1], [2, 2, 2, 2, 2, 2, 2], [1, 2, 2, 3, 3, 3, 3, 9], [None, 4, 4, None]])
def test_text_ties_of_few_rows(spark, values):
    rows = spark.createDataFrame([(v, f"c{i * 7 % 11}") for i, v in enumerate(values)], "v long, name string")
    found = qt.ntile(rows, "v", "name", 3).where("v is not null").withColumn("own", F.ntile(3).over(Window.orderBy("v", "name"))).collect()
    assert len(found) == sum(v is not None for v in values) and all(r["tile"] == r["own"] for r in found)


def rank_error(values, found, q):
    """How far the value's ranks are from the asked one, as a share of the rows."""
    ordered = np.sort(values)
    low, high = np.searchsorted(ordered, found, "left") / len(ordered), np.searchsorted(ordered, found, "right") / len(ordered)
    return max(0.0, low - q, q - high)


@pytest.mark.parametrize("kind", ["hot", "lognormal", "sorted"])
def test_sketched_quantiles_stay_within_their_rank_error(spark, kind):
    rng = np.random.default_rng(4)
    values = {
        "hot": np.where(rng.random(60_000) < 0.4, 7, rng.integers(0, 10**9, 60_000)),
        "lognormal": np.exp(rng.normal(8, 3, 60_000)).astype(np.int64),
        "sorted": np.arange(60_000) ** 2,
    }[kind]
    df = spark.createDataFrame(pd.DataFrame({"g": np.arange(60_000) % 3, "v": values})).repartition(7)
    sketches = qt.quantile_sketches(df, "v", ["g"])
    fractions = {"q1": (1, 4), "median": (1, 2), "q3": (3, 4), "p99": (99, 100)}
    bound = qt.sketch_rank_error()
    assert bound < 0.004
    by_group = qt.quantiles_of_sketches(sketches, fractions).collect()
    whole = qt.quantiles_of_sketches(qt.merged_sketches(sketches), fractions).collect()
    assert len(by_group) == 3 and len(whole) == 1
    for row in by_group:
        own = values[np.arange(60_000) % 3 == row["g"]]
        for name, (top, bottom) in fractions.items():
            assert rank_error(own, row[name] / bottom, top / bottom) <= bound
    for name, (top, bottom) in fractions.items():
        assert rank_error(values, whole[0][name] / bottom, top / bottom) <= bound


def test_tiles_on_sketches_are_nearly_equal_in_size(spark):
    df = spark.range(50_000).select((F.col("id") * 7919 % 1_000_003).alias("v")).unionByName(spark.range(1).select(F.lit(None).cast("long").alias("v")))
    sizes = {r["tile"]: r["count"] for r in qt.approximate_tiles(df, "v", 5).groupBy("tile").count().collect()}
    assert sizes.pop(None) == 1 and sorted(sizes) == [1, 2, 3, 4, 5]
    assert all(abs(n - 10_000) <= 2 * 50_000 * qt.sketch_rank_error() for n in sizes.values())


def test_sketch_of_nothing_is_null(spark):
    none = spark.createDataFrame([(None,)], "v long")
    assert tuple(qt.quantiles_of_sketches(qt.quantile_sketches(none, "v"), {"m": (1, 2)}).first()) == (None,)
