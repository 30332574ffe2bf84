"""Repeated rows, found by hashes, so that whole rows stay where they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from salesprism.session import materialised

HASH = "_row_hash"
#: Hashes with several rows that are sent to every task (8 bytes each); more of them meet their rows in a shuffle.
MOST_SENT = 4_000_000


def _hash(columns: list[str], seed: int) -> Column:
    # a null changes no hash by itself, so the places of the nulls are hashed too
    nulls = F.array(*[F.col(f"`{c}`").isNull() for c in columns])
    return F.xxhash64(F.lit(seed), nulls, *[F.col(f"`{c}`") for c in columns])


def row_digest(columns: list[str]) -> Column:
    """128 bits of a whole row as text, the same for equal rows."""
    return F.concat(*[F.lpad(F.hex(_hash(columns, seed)), 16, "0") for seed in (0, 1)])


def hashed(df: DataFrame) -> DataFrame:
    """The rows written once, each with 64 bits of its own."""
    return materialised(df.withColumn(HASH, _hash(df.columns, 0)))


def parted(stored: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """What ``hashed`` has stored, without the hash: the rows alone on their hash, which have no copy, and the others, if any."""
    columns = [F.col(f"`{c}`") for c in stored.columns if c != HASH]
    shared = materialised(stored.groupBy(HASH).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(HASH))
    found = shared.count()
    if not found:
        return stored.select(*columns), None
    side = F.broadcast(shared) if found <= MOST_SENT else shared
    return stored.join(side, HASH, "left_anti").select(*columns), stored.join(side, HASH, "left_semi").select(*columns)


def distinct_rows(stored: DataFrame) -> DataFrame:
    """Distinct rows of what ``hashed`` has stored, without the hash.

    Only rows that share a hash are compared as a whole, so the shuffle carries 64 bits of each row and
    whole rows just where there may be copies.
    """
    alone, together = parted(stored)
    return alone if together is None else alone.unionByName(together.dropDuplicates())
