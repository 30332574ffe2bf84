"""Row numbers over a whole table, and gated rolling means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window, WindowSpec

from salesprism.session import checkpointed

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def global_row_number(df: DataFrame, order: Sequence[str], output: str = "row_number") -> DataFrame:
    """1-based position of every row in the order of the columns, without gathering
    the rows in one task.

    Rows are range partitioned and sorted inside their partition; a row's number is
    its place there plus the rows of all earlier partitions. The sorted rows are
    checkpointed, so both parts see the same partitions even if an executor is lost.
    The last order column should be unique: it also splits ties over partitions.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumns(
            {
                "_part": F.shiftright("_at", _ROW_BITS),
                "_row": F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
            }
        )
        .drop("_at")
    )
    placed = checkpointed(placed)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            F.col("_part").alias("_p"),
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        )
    )
    # one offset row per partition, so the broadcast side is bounded by their number
    numbered = placed.join(F.broadcast(offsets), F.col("_part") == F.col("_p"))
    return numbered.withColumn(output, F.col("_before") + F.col("_row") + 1).drop(
        "_part", "_row", "_p", "_before"
    )


def rolling_mean(
    total: str, over: WindowSpec, first: int, last: int, full: bool = True
) -> Column:
    """Mean of cents as currency units over the rows ``first``..``last`` around the
    current one; with ``full`` it stays null until the frame has all its rows."""
    frame = over.rowsBetween(first, last)
    count = F.count(total).over(frame)
    mean = F.sum(total).over(frame).cast("double") / (count.cast("double") * F.lit(100.0))
    needed = last - first + 1 if full else 1
    return F.when(count >= needed, mean)
