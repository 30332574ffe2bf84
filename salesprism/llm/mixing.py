"""Mixes of sources to target weights: water-filled targets, whole copies, Pareto order samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from salesprism.session import materialised

WORD = r"[^\x20\x09-\x0D]+"
BUCKETS = 4096  # of ranks, at each of two levels
MOST = 2.0  # copies of a document
_MD5_DIGITS = 13


def words(text: str | Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def filled(df: DataFrame, group: list[str], total: str, weight: str, most: str, output: str) -> DataFrame:
    """Shares ``total`` among the rows of a group by weight, none above its ``most``.

    What a full row cannot take is shared among the others by weight until none is above:
    rows fill in the order of most / weight, so the level that all others reach follows
    from running sums; the first row that can hold its own level gives it, and the largest such level. Weights are
    positive. A group has one row for each source or size class, never one for each document.
    """
    ratio = F.col(most) / F.col(weight)
    order = Window.partitionBy(*group).orderBy(ratio, weight, most)
    earlier = F.sum(most).over(order.rowsBetween(Window.unboundedPreceding, -1))
    others = F.sum(weight).over(order.rowsBetween(0, Window.unboundedFollowing))
    level = (F.col(total) - F.coalesce(earlier, F.lit(0.0))) / others
    leveled = df.withColumns({"_level": level, "_ratio": ratio})
    reached = F.max(F.when(F.col("_ratio") >= F.col("_level"), F.col("_level"))).over(
        Window.partitionBy(*group)
    )
    return leveled.withColumn(
        output, F.coalesce(F.least(F.col(most), reached * F.col(weight)), F.col(most))
    ).drop("_level", "_ratio")


def source_targets(
    sizes: DataFrame, share: float = 1.5, weights: tuple[float, ...] = (3.0, 1.0, 2.0)
) -> DataFrame:
    """Target in words of every source of (source, size): sources in code point order, null
    last, have the weights in turn and share ``share`` times all words; none gets over
    ``MOST`` times its own. One row per source, numbered by ``sid``."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") % len(weights) + 1).cast("int"))
    totals = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("sid", place)
        .withColumns(
            {
                "_weight": weight,
                "_most": F.col("source_size") * F.lit(MOST),
                "_total": F.sum("source_size").over(Window.partitionBy()) * F.lit(share),
            }
        )
    )
    some = filled(totals.where("source_size > 0"), [], "_total", "_weight", "_most", "target")
    none = totals.where("source_size = 0").withColumn("target", F.lit(0.0))
    return some.unionByName(none).select("sid", "source", "source_size", "target")


def size_class(size: Column) -> Column:
    """Propensity by length, 16 to 32: long documents are somewhat likelier to be repeated."""
    return 16 + F.least(F.floor(F.log2(F.greatest(size, F.lit(1)).cast("double"))), F.lit(16))


def unit(key: Column, seed: int) -> Column:
    """A random number in (0, 1) that depends only on key and seed."""
    digits = F.substring(F.md5(F.concat(key, F.lit(f"|{seed}"))), 1, _MD5_DIGITS)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(16**_MD5_DIGITS))


def _cut(ranked: DataFrame, wanted: DataFrame, bucket: str) -> DataFrame:
    """The bucket of each source in which its wanted words are reached, and what they leave
    for it. No row for sources that want more than there is."""
    order = Window.partitionBy("sid").orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    reached = (
        ranked.groupBy("sid", bucket)
        .agg(F.sum("size").alias("_words"))
        .withColumn("_upto", F.sum("_words").over(order))
        .join(wanted, "sid")
        .where("_upto > wanted and _upto - _words <= wanted")
    )
    return reached.select(
        "sid", F.col(bucket).alias(f"{bucket}_cut"), (F.col("wanted") - F.col("_upto") + F.col("_words")).alias("wanted")
    )


def mixed(docs: DataFrame, seed: int = 7, share: float = 1.5) -> DataFrame:
    """Copies that the mix takes of each row of (doc_id, source, size, key): adds source_size,
    target (of the source, in words), expected and copies.

    A source's expected copies are proportional to the propensity of the documents' size
    class, at most ``MOST``, and sum to its target in words. Whole parts are certain. The rest is
    the inclusion probability of a Pareto order sample: documents are ranked by their random
    odds over their inclusion odds, and taken in that order until the words that the target
    leaves are reached, to the nearest document.

    The words before a document come from two levels of rank buckets, so that no task sorts a
    source: only rows of one of ``BUCKETS``^2 buckets are ranked singly. Ranks depend on
    ``key`` and ``seed`` alone, so reruns agree; equal keys rank by size. A null source is a
    source, a null key ranks as an empty one, and empty documents have no copies. An empty table gives no rows.
    """
    base = docs.select(
        "doc_id", "source", "size", F.coalesce("key", F.lit("")).alias("key"), size_class(F.col("size")).alias("class")
    )
    base = materialised(base)
    targets = source_targets(base, share)
    classes = base.groupBy("source", "class").agg(F.sum("size").alias("words"))
    classes = classes.withColumnsRenamed({"source": "_source"}).join(
        targets, F.col("_source").eqNullSafe(F.col("source"))
    ).drop("_source")
    loads = classes.withColumns(
        {"_load": F.col("class").cast("double") * F.col("words"), "_most": F.col("words") * F.lit(MOST)}
    )
    rates = filled(loads.where("words > 0"), ["sid"], "target", "_load", "_most", "_taken").select(
        "sid", "source", "class", "source_size", "target", "words",
        F.least(F.col("_taken") / F.col("words"), F.lit(MOST)).alias("expected"),
    )
    rates = rates.unionByName(
        loads.where("words = 0").select(
            "sid", "source", "class", "source_size", "target", "words", F.lit(0.0).alias("expected")
        )
    )
    rates = materialised(rates.withColumn("certain", F.floor("expected")))  # a row for each source and class
    named = rates.withColumnsRenamed({"source": "_source", "class": "_class"}).drop("words")
    joined = base.join(
        named, F.col("source").eqNullSafe(F.col("_source")) & (F.col("class") == F.col("_class"))
    ).drop("_source", "_class", "class")
    part = F.col("expected") - F.col("certain")
    high, low = F.col("_unit") * (1.0 - part), (1.0 - F.col("_unit")) * part
    # the random odds over the inclusion odds q, as q / (1 + q), in buckets and buckets of these
    ranked = (
        joined.withColumn("_unit", unit(F.col("key"), seed))
        .withColumn("rank", F.when((part > 0) & (F.col("size") > 0), high / (high + low)))
        .withColumn("at1", F.least(F.floor(F.col("rank") * BUCKETS), F.lit(BUCKETS - 1)))
        .withColumn("at2", F.floor((F.col("rank") * BUCKETS - F.col("at1")) * BUCKETS))
        .drop("_unit")
    )
    ranked = materialised(ranked)
    rest = (F.max("target") - F.sum(F.col("certain") * F.col("words"))).alias("wanted")
    wanted = rates.groupBy("sid").agg(rest)
    some = ranked.where("rank is not null")
    first = materialised(_cut(some, wanted, "at1"))  # at most a row for each source, as the next
    inside = some.join(first.select("sid", "at1_cut"), "sid").where("at1 = at1_cut").drop("at1_cut")
    second = materialised(_cut(inside, first.select("sid", "wanted"), "at2"))
    cuts = materialised(first.drop("wanted").join(second, "sid", "left"))  # small, and known to be so
    placed = ranked.join(cuts, "sid", "left")
    near = F.coalesce((F.col("at1") == F.col("at1_cut")) & (F.col("at2") == F.col("at2_cut")), F.lit(False))
    before = Window.partitionBy("sid").orderBy("rank", "key", "size").rowsBetween(Window.unboundedPreceding, -1)
    single = placed.where(near).withColumn(
        "extra", F.coalesce(F.sum("size").over(before), F.lit(0)) + F.col("size") / 2.0 <= F.col("wanted")
    )
    # a source without a cut wants all; inside the first cut's bucket, one without a second cut does
    taken = F.when(F.col("at1_cut").isNull() | (F.col("at1") < F.col("at1_cut")), True).when(
        F.col("at1") == F.col("at1_cut"), F.col("at2_cut").isNull() | (F.col("at2") < F.col("at2_cut"))
    )
    others = placed.where(~near).withColumn(
        "extra", F.col("rank").isNotNull() & F.coalesce(taken, F.lit(False))
    )
    return single.unionByName(others).select(
        "doc_id", "source", "size", "key", "source_size", "target", "expected",
        (F.col("certain") + F.col("extra").cast("bigint")).alias("copies"),
    )


def mix_documents(docs: DataFrame, seed: int = 7, share: float = 1.5) -> DataFrame:
    """``mixed`` for documents with doc_id, source and text; sizes are words."""
    key = F.concat_ws(":", F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))
    rows = docs.select("doc_id", "source", words(F.col("text")).alias("size"), key.alias("key"))
    return mixed(rows, seed, share)


def repeated(docs: DataFrame, seed: int = 7, share: float = 1.5) -> DataFrame:
    """The mix itself: each document as many times as the mix takes it, all columns kept."""
    key = F.concat_ws(":", F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))
    keyed = docs.withColumn("_key", key)
    rows = keyed.select("doc_id", "source", words(F.col("text")).alias("size"), F.col("_key").alias("key"))
    # rows of one document in one source are equal here, so any of their counts will do
    copies = (
        mixed(rows, seed, share)
        .where("copies > 0")
        .groupBy(F.col("key").alias("_k"), F.col("source").alias("_s"))
        .agg(F.sort_array(F.collect_list("copies")).alias("_copies"))
    )
    place = F.row_number().over(Window.partitionBy("_key", "source").orderBy(F.lit(0)))
    numbered = keyed.withColumn("_place", place)
    met = numbered.join(copies, (F.col("_key") == F.col("_k")) & F.col("source").eqNullSafe(F.col("_s")))
    count = F.try_element_at("_copies", F.col("_place"))
    return (
        met.withColumn("_times", F.explode(F.sequence(F.lit(1), F.greatest(count, F.lit(0)).cast("int"))))
    ).select(*docs.columns)
