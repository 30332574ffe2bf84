"""A stored star that loads order lines in increments, and answers measures from the months it needs.

The fact is stored by month. A load replaces the months of its lines as a whole and adds the dimension
members that are not stored yet, so the same load done twice, or done again after a failure between two tables,
leaves the same star as done once.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from salesprism.functions.dates import date_key
from salesprism.operators import warehouse as w
from salesprism.operators.repeats import hashed, parted

#: Equal lines that one task numbers.
BLOCK = 1 << 16
MONTH = "month_key"
DIMENSIONS = {
    "dim_product": (w.dim_product, "product_key"),
    "dim_location": (w.dim_location, "location_key"),
    "dim_channel": (w.dim_channel, "channel_key"),
}


def with_line_keys(lines: DataFrame, output: str = "order_line_key") -> DataFrame:
    """Every line with a key of its own, made of its values and its number among equal lines.

    The lines are written once with a hash; a line alone on its hash is the first of its kind and stays where it is. Others
    that are equal fold to one row with their number and are dealt out again in blocks, so that a line
    that makes up a third of the table is one counter first and many tasks afterwards. Keys do not depend on the
    order of the rows or on retries.
    """
    columns = lines.columns
    alone, together = parted(hashed(lines))
    first_ones = alone.withColumn("_copy", F.lit(1).cast("bigint")).select(w.surrogate_key(*columns, "_copy").alias(output), *columns)
    if together is None:
        return first_ones
    counted = together.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count(F.lit(1)).alias("_n"))
    blocks = counted.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / BLOCK))).alias("_block"))
    dealt = blocks.hint("rebalance")
    first = F.col("_block") * BLOCK + 1
    copies = dealt.select("*", F.explode(F.sequence(first, F.least(F.col("_n"), first + BLOCK - 1))).alias("_copy"))
    return first_ones.unionByName(copies.select(w.surrogate_key(*columns, "_copy").alias(output), *columns))


def repeated_keys(keyed: DataFrame, key: str = "order_line_key") -> DataFrame:
    """One row: how many keys stand on more than one row."""
    counted = keyed.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return counted.groupBy().agg(F.count(F.lit(1)).alias("violations"))


def month_of(key: Column) -> Column:
    """``yyyyMM`` of a ``yyyyMMdd`` date key."""
    return F.floor(key / 100).cast("int")


@dataclass(frozen=True)
class StarStore:
    """The star's tables under one folder that all executors share."""

    spark: SparkSession
    folder: str

    def _path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def _exists(self, name: str) -> bool:
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._path(name))
        return place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(place)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._path(name))

    def load(self, staged: DataFrame) -> None:
        """Takes in staged lines that hold their months as a whole.

        Members first, then the fact: a fact row never refers to a member that is not stored. Only the
        months among the lines are written; a month that is loaded again gives way to its new lines.
        """
        for name, (build, key) in DIMENSIONS.items():
            incoming = build(staged)
            if self._exists(name):
                incoming = w.new_members(self.table(name), incoming, key)
            incoming.write.mode("append").parquet(self._path(name))
        fact = w.fact_orders(staged).withColumn(MONTH, month_of(F.col("date_key")))
        (
            fact.hint("rebalance", MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(MONTH).parquet(self._path("fact_orders"))
        )

    def fact(self, date_from: date | None = None, date_to: date | None = None) -> DataFrame:
        """The fact between two days; only the files of their months are read."""
        rows = self.table("fact_orders")
        for day, later in ((date_from, True), (date_to, False)):
            if day is None:
                continue
            key = date_key(F.lit(day))
            if later:
                rows = rows.filter((F.col(MONTH) >= day.year * 100 + day.month) & (F.col("date_key") >= key))
            else:
                rows = rows.filter((F.col(MONTH) <= day.year * 100 + day.month) & (F.col("date_key") <= key))
        return rows

    def fact_in(self, days: DataFrame) -> DataFrame:
        """The fact on the days of a calendar slice (date_key): the slice's months prune the fact's files at run time."""
        slice_ = days.select("date_key").distinct().withColumn(MONTH, month_of(F.col("date_key")))
        return self.table("fact_orders").join(slice_, [MONTH, "date_key"], "left_semi")

    def summary(self) -> DataFrame:
        """Rows and cents of each stored month, and the members of each dimension (part, month_key, rows, cents)."""
        result = self.table("fact_orders").groupBy(MONTH).agg(
            F.count(F.lit(1)).alias("rows"), F.sum("amount_cents").alias("cents")
        ).select(F.lit("fact_orders").alias("part"), F.col(MONTH).cast("bigint").alias(MONTH), "rows", "cents")
        for name in DIMENSIONS:
            members = self.table(name).groupBy().agg(F.count(F.lit(1)).alias("rows"))
            result = result.unionByName(members.select(
                F.lit(name).alias("part"), F.lit(None).cast("bigint").alias(MONTH), "rows", F.lit(None).cast("bigint").alias("cents")
            ))
        return result
