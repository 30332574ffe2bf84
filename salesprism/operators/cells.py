"""Exact distinct counts that merge, next to sums, from one scan and without a copy of the rows per count.

Lines fold to small cells. A number to be counted sets its bit in the word of 64 neighbouring
numbers; words of one place combine by OR on the map side, in the shuffle and in every later
roll-up, so a table of cells answers distinct counts of any coarser grouping. Dense numbers, such as order
numbers, need one cell for 64 values; texts and other kinds keep a cell per value. Sums and extremes have
cells of their own, which may be finer than those of the counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F, types as T

from salesprism.functions.exact import money_sum
from salesprism.operators.windows import global_row_number
from salesprism.session import materialised

#: Whole numbers and numbers with two decimals in the one form that has no other text for the same number.
_PLAIN = r"^(0|-?[1-9][0-9]{0,17})$"
_CENTS = r"^(?!-0\.00$)-?(0|[1-9][0-9]{0,15})\.[0-9]{2}$"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _word(number: Column) -> tuple[Column, Column]:
    """The word of 64 neighbours that a number is in, and its bit there."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), number.bitwiseAND(F.lit(63)).cast("int"))
    return F.shiftright(number, 6), F.when(number.isNotNull(), bit)


@dataclass(frozen=True)
class Cells:
    """``table``: _kind (-1 for sums, else the place in ``distinct``), the keys, _word, _value, _bits and the sums."""

    table: DataFrame
    distinct: tuple[str, ...]
    counts: tuple[str, ...]
    added: tuple[str, ...]
    least: tuple[str, ...]
    most: tuple[str, ...]

    def stored(self) -> Cells:
        """The same cells, written once for several questions."""
        return replace(self, table=materialised(self.table))

    def _folded(self) -> list[Column]:
        return [
            *[F.coalesce(F.sum(c), F.lit(0).cast("bigint")).alias(c) for c in self.counts],
            *[F.sum(c).alias(c) for c in self.added], *[F.min(c).alias(c) for c in self.least],
            *[F.max(c).alias(c) for c in self.most],
        ]

    def rolled_up(self, *keys: str) -> Cells:
        """Cells of fewer keys."""
        table = self.table.groupBy("_kind", *keys, "_word", "_value").agg(F.bit_or("_bits").alias("_bits"), *self._folded())
        return replace(self, table=table)

    def sums(self, *keys: str) -> DataFrame:
        """Sums and extremes per key, without the distinct counts."""
        return self.table.filter("_kind = -1").groupBy(*keys).agg(*self._folded())

    def totals(self, *keys: str) -> DataFrame:
        """One row per key (one in all without keys): every distinct count, sum and extreme."""
        merged = self.rolled_up(*keys).table
        one = F.coalesce(F.call_function("bit_count", F.col("_bits")).cast("bigint"), F.lit(1).cast("bigint"))
        counts = [
            F.coalesce(F.sum(F.when(F.col("_kind") == i, one)), F.lit(0).cast("bigint")).alias(name)
            for i, name in enumerate(self.distinct)
        ]
        return merged.groupBy(*keys).agg(*counts, *self._folded())


def cells(
    df: DataFrame,
    distinct: Mapping[str, Column],
    counts: Mapping[str, Column] | None = None,
    sums: Mapping[str, Column] | None = None,
    money: Mapping[str, Column] | None = None,
    least: Mapping[str, Column] | None = None,
    most: Mapping[str, Column] | None = None,
    by: Sequence[str] = (),
    distinct_by: Sequence[str] = (),
    numbers_in_text: bool = False,
) -> Cells:
    """Folds the rows to cells: ``counts`` of rows that meet a condition, ``sums`` of whole numbers, exact ``money``
    sums and extremes per ``by``, values for the ``distinct`` counts per ``distinct_by``, which are among ``by``. Null values
    are not counted; over no rows counts are 0, the others null.

    With ``numbers_in_text``, texts that are numbers in their plain form (``-12``, ``0.50``) share words like numbers
    do; the form is a part of the cell, so ``1``, ``01`` and ``1.00`` stay three values.

    A key with null is a key of its own. ``totals(*keys)`` has sums for any keys out of ``by``, and counts for any
    out of ``distinct_by``.
    """
    if not set(distinct_by) <= set(by):
        raise ValueError("distinct_by must be among by")
    added = dict(sums or {}) | dict(money or {})
    carried = {n: F.when(c, 1) for n, c in (counts or {}).items()} | added | dict(least or {}) | dict(most or {})
    # typed by a projection that no row passes through
    kinds = df.select(*by, *[c.alias(n) for n, c in distinct.items()], *[c.alias(n) for n, c in carried.items()]).schema
    kind_of = {f.name: f.dataType for f in kinds}

    def nothing(kind: str | T.DataType) -> Column:
        return F.lit(None).cast(kind)

    rows = [F.struct(
        F.lit(-1).alias("_kind"), *[F.col(k).alias(k) for k in by], nothing("bigint").alias("_word"), nothing("string").alias("_value"),
        nothing("bigint").alias("_bits"), *[c.alias(n) for n, c in carried.items()],
    )]
    for i, (name, column) in enumerate(distinct.items()):
        if isinstance(kind_of[name], _WHOLE):
            own = (*_word(column.cast("bigint")), nothing("string"))
        elif numbers_in_text and isinstance(kind_of[name], T.StringType):
            form = F.when(column.rlike(_PLAIN), "0").when(column.rlike(_CENTS), "2")
            word, bits = _word(F.when(form.isNotNull(), F.replace(column, F.lit("."), F.lit(""))).try_cast("bigint"))
            own = (word, bits, F.coalesce(form, column))
        else:
            own = (nothing("bigint"), nothing("bigint"), column.cast("string"))
        rows.append(F.struct(
            F.lit(i).alias("_kind"), *[(F.col(k) if k in distinct_by else nothing(kind_of[k])).alias(k) for k in by],
            *[c.alias(n) for c, n in zip((own[0], own[2], own[1]), ("_word", "_value", "_bits"), strict=True)],
            *[nothing(kind_of[n]).alias(n) for n in carried],
        ))
    spread = df.select(F.inline(F.array(*rows))).filter("_kind = -1 or _word is not null or _value is not null")
    table = spread.groupBy("_kind", *by, "_word", "_value").agg(
        F.bit_or("_bits").alias("_bits"), *[F.count(n).alias(n) for n in counts or {}],
        *[(money_sum(n).cast("decimal(38,0)") if n in (money or {}) else F.sum(n)).alias(n) for n in added],
        *[F.min(n).alias(n) for n in least or {}], *[F.max(n).alias(n) for n in most or {}],
    )
    return Cells(table, tuple(distinct), tuple(counts or {}), tuple(added), tuple(least or {}), tuple(most or {}))


def numbered(df: DataFrame, column: str, output: str) -> DataFrame:
    """Adds dense numbers from 1 for the values of a column in their order, so that sparse or text values count as bits.

    Null stays null. One shuffle for the distinct values, and a join on the column, whose hot values adaptive execution splits.
    """
    values = df.select(F.col(column).alias("_value")).filter("_value is not null").distinct()
    values = global_row_number(values, ["_value"], output)
    return df.join(values, F.col(column) == F.col("_value"), "left").drop("_value")
