"""Exact quantiles, tiles and equal-count bins over whole tables.

Nothing here sorts all rows in one task. Rows are first counted per value (with a
map-side combine, so a value that holds a third of all rows costs one counter),
values fall into buckets of ``BUCKET`` neighbours, and only the bucket totals pass
an unpartitioned window. Values must be integers: cents, days, counts or ids.

All of it is lazy: statistics reach the rows as scalar subqueries, with no join
and no trip through the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from salesprism.functions.exact import floor_div
from salesprism.operators.windows import global_row_number

BUCKET_BITS = 20
BUCKET = 1 << BUCKET_BITS

Fraction = tuple[int, int]
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def value_ranks(df: DataFrame, value: str, group: Sequence[str] = ()) -> DataFrame:
    """Per distinct value: its rows ``n``, the rows ``before`` it and the ``total``.

    Null values are left out. The counts feed both sides of the join from one shuffle:
    the bucket is a shift, which is never null here, so no filter is inferred for one
    side only. One bucket holds at most ``BUCKET`` distinct values,
    and a group's bucket list has at most (value range / ``BUCKET``) rows.
    """
    group = list(group)
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*group, value)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bucket", F.shiftright(F.col(value), BUCKET_BITS))
    )
    by_group = Window.partitionBy(*group)
    earlier = by_group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        counts.groupBy(*group, "bucket")
        .agg(F.sum("n").alias("bucket_n"))
        .select(
            *[F.col(g).alias(f"_{g}") for g in group],
            F.col("bucket").alias("_bucket"),
            F.coalesce(F.sum("bucket_n").over(earlier), F.lit(0)).alias("bucket_before"),
            F.sum("bucket_n").over(by_group).alias("total"),
        )
    )
    matches = F.col("bucket") == F.col("_bucket")
    for g in group:
        matches = matches & F.col(g).eqNullSafe(F.col(f"_{g}"))
    inside = (
        Window.partitionBy(*group, "bucket")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return counts.join(buckets, matches).select(
        *group,
        value,
        "n",
        (F.col("bucket_before") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("before"),
        "total",
    )


def _value_at(rank: Column, value: str) -> Column:
    """Aggregate: the value that holds the 0-based rank."""
    hit = (F.col("before") <= rank) & (rank < F.col("before") + F.col("n"))
    return F.max(F.when(hit, F.col(value)))


def scaled_quantiles(
    df: DataFrame, value: str, fractions: dict[str, Fraction], group: Sequence[str] = ()
) -> DataFrame:
    """Linear-interpolated quantiles, one row per group.

    ``fractions`` maps an output column to (numerator, denominator); the column
    holds the quantile *times the denominator* as a BIGINT, which is exact.
    """
    ranks = value_ranks(df, value, group)
    last = F.col("total") - 1
    aggregates = []
    for name, (top, bottom) in fractions.items():
        low = floor_div(last * top, F.lit(bottom))
        aggregates += [
            _value_at(low, value).alias(f"{name}_low"),
            _value_at(F.least(low + 1, last), value).alias(f"{name}_high"),
            F.max((last * top) % bottom).alias(f"{name}_rest"),
        ]
    found = ranks.groupBy(*group).agg(*aggregates)
    return found.select(
        *group,
        *[
            (
                F.col(f"{name}_low") * bottom
                + F.col(f"{name}_rest") * (F.col(f"{name}_high") - F.col(f"{name}_low"))
            )
            .cast("bigint")
            .alias(name)
            for name, (_, bottom) in fractions.items()
        ],
    )


def quantile_sketches(df: DataFrame, value: str, group: Sequence[str] = (), k: int = 800) -> DataFrame:
    """A KLL sketch of the value per group, as (group, sketch): a few kilobytes that merge with others.

    For tables on which counting every value is too much. With ``k`` of 800 a quantile's rank is
    off by at most ``sketch_rank_error(k)`` of the rows, with 99 % confidence; ``scaled_quantiles``
    is exact and stays the default everywhere.
    """
    return df.groupBy(*group).agg(F.kll_sketch_agg_bigint(F.col(value).cast("bigint"), F.lit(k)).alias("sketch"))


def sketch_rank_error(k: int = 800) -> float:
    """The published bound on a KLL sketch's normalised rank error, at 99 % confidence."""
    return 2.296 / k**0.9723


def merged_sketches(sketches: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Sketches of fewer groups out of stored ones, without the rows."""
    return sketches.groupBy(*group).agg(F.kll_merge_agg_bigint("sketch").alias("sketch"))


def quantiles_of_sketches(sketches: DataFrame, fractions: dict[str, Fraction]) -> DataFrame:
    """The quantiles of each sketch, times their denominators as in ``scaled_quantiles``; null for a sketch of nothing."""
    others = [c for c in sketches.columns if c != "sketch"]
    filled = F.coalesce(F.kll_sketch_get_n_bigint("sketch"), F.lit(0)) > 0
    return sketches.select(*others, *[
        (F.when(filled, F.kll_sketch_get_quantile_bigint("sketch", F.lit(top / bottom))) * bottom).cast("bigint").alias(name)
        for name, (top, bottom) in fractions.items()
    ])


def approximate_tiles(df: DataFrame, value: str, tiles: int, output: str = "tile", k: int = 800) -> DataFrame:
    """Equal-count tiles on a sketch's cut points, right closed; ties share a tile. One scan, no shuffle of values."""
    cuts = quantiles_of_sketches(quantile_sketches(df, value, (), k), {f"e{i}": (i, tiles) for i in range(1, tiles)})
    packed = cuts.select(F.array(*[F.col(f"e{i}") for i in range(1, tiles)])).scalar()
    above = F.size(F.filter("_edges", lambda edge: F.col(value) * tiles > edge))
    return df.withColumn("_edges", packed).withColumn(
        output, F.when(F.col(value).isNotNull(), (above + 1).cast("int"))
    ).drop("_edges")


def quantile_bins(
    df: DataFrame, value: str, bins: int, output: str, source: DataFrame | None = None
) -> DataFrame:
    """Equal-count bins 1..``bins`` on value edges, right closed; ties share a bin.

    Equal edges merge: a value gets the lowest bin whose upper edge reaches it. The
    edges come from ``source`` where given: the same rows under a shorter plan.
    """
    edges = scaled_quantiles(df if source is None else source, value, {f"e{i}": (i, bins) for i in range(1, bins)})
    packed = edges.select(F.array(*[f"e{i}" for i in range(1, bins)])).scalar()
    with_edges = df.withColumn("_edges", packed)
    above = F.size(F.filter("_edges", lambda edge: F.col(value) * bins > edge))
    filled = F.when(F.col(value).isNotNull(), (above + 1).cast("int"))
    return with_edges.withColumn(output, filled).drop("_edges")


def tile_ends(tiles: int) -> Callable[[Column], list[Column]]:
    """Last 1-based rank of each NTILE tile but the final one."""

    def ends(total: Column) -> list[Column]:
        size, extra = floor_div(total, F.lit(tiles)), total % tiles
        return [size * t + F.least(F.lit(t), extra) for t in range(1, tiles)]

    return ends


def rank_bin_ends(bins: int) -> Callable[[Column], list[Column]]:
    """Last 1-based rank of each equal-width bin over ranks 1..n but the final one."""

    def ends(total: Column) -> list[Column]:
        return [floor_div((total - 1) * b, F.lit(bins)) + 1 for b in range(1, bins)]

    return ends


def cut_by_rank(
    df: DataFrame,
    value: str,
    tie: str,
    ends: Callable[[Column], list[Column]],
    output: str,
) -> DataFrame:
    """Number the pieces of the order (``value``, ``tie``) that end at given ranks.

    Only the rows at the cuts are looked up: first the value that holds each cut,
    then, where a cut splits equal values, the ``tie`` at that place. Every row then
    compares itself with the cuts, so the table itself is not shuffled or sorted.
    ``tie`` must be unique. Where it is an integer, its places are counted in buckets; for other
    kinds the rows that share a cut value are dealt to ranges of (``value``, ``tie``) and numbered by
    the ranges' offsets.
    """
    ranks = value_ranks(df, value)
    cut_ranks = ends(F.col("total"))
    held = [
        F.max(
            F.when(
                (F.col("before") < end) & (end <= F.col("before") + F.col("n")),
                F.struct(
                    F.col(value).alias("value"),
                    (end - F.col("before")).alias("place"),
                    F.col("n").alias("n"),
                ),
            )
        )
        for end in cut_ranks
    ]
    cuts = ranks.agg(F.array(*held).alias("cuts"))

    split_values = cuts.select(
        F.transform(F.filter("cuts", lambda c: c["place"] < c["n"]), lambda c: c["value"])
    ).scalar()
    tied = (
        df.select(value, tie)
        .withColumn("_split", split_values)
        .filter(F.array_contains("_split", F.col(value)))
        .select(value, tie)
    )
    if isinstance(df.schema[tie].dataType, _WHOLE):
        tie_cuts = _counted_ties(tied, value, tie, cuts, len(cut_ranks))
    else:
        tie_cuts = _ordered_ties(tied, value, tie, cuts, len(cut_ranks))

    rows = df.withColumn("_cuts", cuts.scalar()).withColumn("_ties", tie_cuts.scalar())
    piece = F.lit(1)
    for i in range(len(cut_ranks)):
        cut = F.col("_cuts")[i]
        beyond = (F.col(value) > cut["value"]) | (
            (F.col(value) == cut["value"]) & (F.col(tie) > F.col("_ties")[i])
        )
        piece = piece + F.when(beyond, 1).otherwise(0)
    filled = F.when(F.col(value).isNotNull(), piece.cast("int"))
    return rows.withColumn(output, filled).drop("_cuts", "_ties")


def _counted_ties(tied: DataFrame, value: str, tie: str, cuts: DataFrame, n: int) -> DataFrame:
    """One row: the integer tie at each cut that splits equal values, else null."""
    tie_ranks = value_ranks(tied, tie, [value]).withColumn("_cuts", cuts.scalar())
    places = []
    for i in range(n):
        cut = F.col("_cuts")[i]
        here = (
            (F.col(value) == cut["value"])
            & (cut["place"] < cut["n"])
            & (F.col("before") < cut["place"])
            & (cut["place"] <= F.col("before") + F.col("n"))
        )
        places.append(F.max(F.when(here, F.col(tie))))
    return tie_ranks.agg(F.array(*places))


def _ordered_ties(tied: DataFrame, value: str, tie: str, cuts: DataFrame, n: int) -> DataFrame:
    """The same for ties of any ordered kind: rows are numbered in the order of (value, tie) over ranges, so
    equal values spread over as many tasks as they need."""
    numbered = global_row_number(tied, [value, tie], "_order")
    # as many rows as cut values
    begins = numbered.groupBy(value).agg(F.min("_order").alias("_begin")).select(F.col(value).alias("_v"), "_begin")
    placed = numbered.join(F.broadcast(begins), F.col(value) == F.col("_v")).withColumn("_cuts", cuts.scalar())
    places = []
    for i in range(n):
        cut = F.col("_cuts")[i]
        here = (F.col(value) == cut["value"]) & (cut["place"] < cut["n"]) & (F.col("_order") - F.col("_begin") + 1 == cut["place"])
        places.append(F.max(F.when(here, F.col(tie))))
    return placed.agg(F.array(*places))


def ntile(df: DataFrame, value: str, tie: str, tiles: int, output: str = "tile") -> DataFrame:
    """``NTILE(tiles) OVER (ORDER BY value, tie)`` for non-null values."""
    return cut_by_rank(df, value, tie, tile_ends(tiles), output)


def rank_bins(df: DataFrame, value: str, tie: str, bins: int, output: str) -> DataFrame:
    """Equal-count bins over the rank of (``value``, ``tie``); ties do not share a bin."""
    return cut_by_rank(df, value, tie, rank_bin_ends(bins), output)


def tile_summary(df: DataFrame, value: str, tiles: int) -> DataFrame:
    """Rows, smallest, largest and summed value per NTILE tile.

    Rows of one value are interchangeable here, so the counts per value are shared
    out among the tiles they span and no row needs a rank of its own.
    """
    ranks = value_ranks(df, value)
    ends = [F.lit(0).cast("bigint"), *tile_ends(tiles)(F.col("total")), F.col("total")]
    spans = F.array(
        *[
            F.struct(
                F.lit(t).alias("tile"),
                (
                    F.least(F.col("before") + F.col("n"), ends[t])
                    - F.greatest(F.col("before"), ends[t - 1])
                ).alias("rows"),
            )
            for t in range(1, tiles + 1)
        ]
    )
    pieces = ranks.select(value, F.explode(F.filter(spans, lambda s: s["rows"] > 0)).alias("s"))
    amount = F.col(value).cast("decimal(20,0)") * F.col("s.rows").cast("decimal(18,0)")
    return pieces.groupBy(F.col("s.tile").alias("tile")).agg(
        F.sum("s.rows").alias("rows"),
        F.min(value).alias("smallest"),
        F.max(value).alias("largest"),
        F.sum(amount.cast("decimal(28,0)")).alias("cents"),
    )


def box_stats(df: DataFrame, value: str, group: str) -> DataFrame:
    """Box-plot numbers per group: quartiles, 1.5 x IQR whiskers, rows outside them."""
    quartiles = scaled_quantiles(
        df, value, {"q1": (1, 4), "median": (2, 4), "q3": (3, 4)}, [group]
    ).withColumnRenamed(group, "_group")
    counts = df.filter(F.col(value).isNotNull()).groupBy(group, value).agg(
        F.count(F.lit(1)).alias("n")
    )
    spread = F.col("q3") - F.col("q1")
    eight = F.col(value) * 8
    inside = (eight >= F.col("q1") * 2 - spread * 3) & (eight <= F.col("q3") * 2 + spread * 3)
    return (
        counts.join(quartiles, F.col(group).eqNullSafe(F.col("_group")))
        .groupBy(group, "q1", "median", "q3")
        .agg(
            F.sum("n").alias("rows"),
            F.min(F.when(inside, F.col(value))).alias("whisker_low"),
            F.max(F.when(inside, F.col(value))).alias("whisker_high"),
            F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("fliers"),
        )
        .withColumns({q: F.col(q) / F.lit(4.0) for q in ("q1", "median", "q3")})
    )


def mode(df: DataFrame, column: str) -> DataFrame:
    """Most frequent non-null value as a one-row table; ties give the smallest."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc(column))
        .limit(1)
        .select(column)
    )
