"""Rows, filled rows, distinct values and smallest texts of all columns from one scan.

Every task folds its rows to the values it has seen, with Arrow, since a cell per row and column costs more than all else.
Numbers, and texts that are numbers in their plain form (``-12``, ``0.50``), leave a task as sorted runs: a row for each 2^16
neighbours, with two bytes a number. Other texts leave it once each. What the tasks hand on is stored, so the table itself
is read once.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from salesprism.session import materialised

#: Bytes of values that a task holds before it hands them on.
MOST_HELD = 32 << 20
#: Numbers that one task counts.
COUNTED = 4_000_000
#: Values of a column that are gathered before they are compared with each other, at least.
_GATHERED = 1 << 17
_LOW_BITS = 16
#: Numbers in a row and texts in a batch that are handed on, rows that are counted at once.
_IN_ROW, _IN_BATCH, _AT_ONCE = 2048, 10_000, 2000
_SEEN = "column int, form int, bucket bigint, value binary, rows bigint, filled bigint"

#: What a row of ``_SEEN`` is: a column's rows, filled rows and smallest text; a text; numbers, as such or in cents.
_SUMS, _TEXT, _NUMBER, _CENTS = range(-1, 3)
#: The forms that have no other text for the same number; ``-0.00`` is left out, too.
_NUMBER_FORM = r"^(0|-?[1-9][0-9]{0,17})$"
_CENTS_FORM = r"^-?(0|[1-9][0-9]{0,15})\.[0-9]{2}$"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _once(numbers: list[np.ndarray]) -> np.ndarray:
    """The different numbers, in order."""
    found = np.sort(np.concatenate(numbers))
    return found[np.concatenate([[True], found[1:] != found[:-1]])] if len(found) else found


def _rows(column: int, form: int, buckets: pa.Array, values: pa.Array, rows: int | None = None, filled: int | None = None) -> pa.RecordBatch:
    n = len(values)
    kinds = [pa.array([x], kind).take(pa.array(np.zeros(n, np.int64))) for x, kind in ((column, pa.int32()), (form, pa.int32()), (rows, pa.int64()), (filled, pa.int64()))]
    return pa.RecordBatch.from_arrays([*kinds[:2], buckets, values, *kinds[2:]], names=["column", "form", "bucket", "value", "rows", "filled"])


def _runs(column: int, form: int, numbers: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sorted numbers as rows of neighbours."""
    buckets = numbers >> _LOW_BITS
    change = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]]))
    place = np.arange(len(numbers)) - np.repeat(change, np.diff(change, append=len(numbers)))
    begins = np.flatnonzero(place % _IN_ROW == 0)
    low = (numbers & ((1 << _LOW_BITS) - 1)).astype("<u2")
    ends = np.append(begins, len(numbers))
    for i in range(0, len(begins), _IN_BATCH):
        own = ends[i : i + _IN_BATCH + 1]
        data = low[own[0] : own[-1]].tobytes()
        offsets = ((own - own[0]) * 2).astype("<i4").tobytes()
        values = pa.Array.from_buffers(pa.binary(), len(own) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        yield _rows(column, form, pa.array(buckets[own[:-1]]), values)


class _Column:
    """What a task has seen of a column since it last handed values on; rows and the smallest text are kept to the end."""

    def __init__(self, place: int):
        self.place, self.rows, self.filled, self.least = place, 0, 0, None
        self.many = False  # whether most values are new, so that it is no use to look for equal ones in each batch
        self.begin()

    def begin(self) -> None:
        self.texts: list[pa.Array] = []
        self.numbers: dict[int, list[np.ndarray]] = {_NUMBER: [], _CENTS: []}
        self.held = self.gathered = self.kept = 0

    def add(self, column: pa.Array) -> None:
        values = column.drop_null()
        self.rows += len(column)
        self.filled += len(values)
        if not self.many:
            once = values.unique()
            self.many = 2 * len(once) > len(values)
            values = once
        if not len(values):
            return
        whole = pa.types.is_int64(values.type)
        # as bytes, whose order is that of the texts
        least = pc.min(values.cast(pa.string()) if whole else values).as_buffer().to_pybytes()
        self.least = least if self.least is None else min(self.least, least)
        if whole:
            self.numbers[_NUMBER].append(values.to_numpy())
            self.held += 8 * len(values)
        else:
            self._add_texts(values)
        self.gathered += len(values)
        if self.gathered > max(_GATHERED, self.kept):
            self.settle()

    def _add_texts(self, values: pa.Array) -> None:
        for form, pattern in ((_NUMBER, _NUMBER_FORM), (_CENTS, _CENTS_FORM)):
            fits = pc.match_substring_regex(values, pattern)
            if form == _CENTS:
                fits = pc.and_(fits, pc.not_equal(values, "-0.00"))
            if found := fits.true_count:
                own = values.filter(fits)
                own = pc.replace_substring(own, ".", "") if form == _CENTS else own
                self.numbers[form].append(own.cast(pa.int64()).to_numpy())
                self.held += 8 * found
                values = values.filter(pc.invert(fits))
        if len(values):
            self.texts.append(values)
            self.held += values.nbytes

    def settle(self) -> None:
        """Equal values are held once."""
        if len(self.texts):
            self.texts = [pa.chunked_array(self.texts).unique()]
        self.numbers = {form: [_once(own)] if own else [] for form, own in self.numbers.items()}
        self.kept = sum(map(len, self.texts)) + sum(len(own[0]) for own in self.numbers.values() if own)
        if self.gathered:
            self.many = 2 * self.kept > self.gathered
        self.gathered = 0
        self.held = sum(t.nbytes for t in self.texts) + sum(8 * len(own[0]) for own in self.numbers.values() if own)

    def handed_on(self) -> Iterator[pa.RecordBatch]:
        self.settle()
        for form, own in self.numbers.items():
            if own and len(own[0]):
                yield from _runs(self.place, form, own[0])
        for texts in self.texts:
            for i in range(0, len(texts), _IN_BATCH):
                some = texts.slice(i, _IN_BATCH)
                yield _rows(self.place, _TEXT, pa.nulls(len(some), pa.int64()), some.cast(pa.binary()))
        self.begin()


def _folded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    columns: list[_Column] = []
    for batch in batches:
        columns = columns or [_Column(i) for i in range(batch.num_columns)]
        for own, values in zip(columns, batch.columns, strict=True):
            own.add(values)
        if sum(c.held for c in columns) > MOST_HELD:
            for own in columns:
                own.settle()
            if sum(c.held for c in columns) > MOST_HELD // 2:
                for own in [c for c in columns if c.held > MOST_HELD // (4 * len(columns))]:
                    yield from own.handed_on()
    for own in columns:
        yield from own.handed_on()
        yield _rows(own.place, _SUMS, pa.nulls(1, pa.int64()), pa.array([own.least], pa.binary()), own.rows, own.filled)


def _numbers_of(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """The numbers in these rows, as (kind, numbers)."""
    kinds, buckets, values = (batch.column(i) for i in range(3))
    kinds = kinds.to_numpy()
    ends = np.frombuffer(values.buffers()[1], "<i4")[values.offset : values.offset + len(values) + 1] // 2
    low = np.frombuffer(values.buffers()[2], "<u2", count=int(ends[-1]))[ends[0] :]
    sizes = np.diff(ends)
    numbers = np.repeat(buckets.to_numpy() << _LOW_BITS, sizes) | low
    every = np.unique(kinds).tolist()
    of = np.repeat(kinds, sizes) if len(every) > 1 else None
    for kind in every:
        yield kind, numbers if of is None else numbers[of == kind]


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different numbers of each kind; all rows of a kind and bucket are here."""
    held: dict[int, list[np.ndarray]] = defaultdict(list)
    gathered = kept = 0
    for batch in batches:
        for i in range(0, batch.num_rows, _AT_ONCE):
            for kind, numbers in _numbers_of(batch.slice(i, _AT_ONCE)):
                held[kind].append(numbers)
                gathered += len(numbers)
            if gathered > max(1 << 20, kept):
                held = defaultdict(list, {kind: [_once(own)] for kind, own in held.items()})
                kept, gathered = sum(len(own[0]) for own in held.values()), 0
    counts = [len(_once(held[kind])) for kind in held]
    yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array(counts, pa.int64())], names=["kind", "different"])


def column_values(df: DataFrame) -> DataFrame:
    """Per column (column, rows, non_null, unique_values, sample), in their order; the sample is the smallest text.

    The rows are read when this is called. Numbers are counted in tasks of about COUNTED; other texts meet in an aggregate.
    """
    texts = [F.col(f"`{c}`").cast("bigint" if isinstance(df.schema[c].dataType, _WHOLE) else "string").alias(f"c{i}") for i, c in enumerate(df.columns)]
    seen = materialised(df.select(*texts).mapInArrow(_folded, _SEEN))
    numbers = seen.where(F.col("form") > _TEXT)
    parts = -(-(numbers.agg(F.sum(F.length("value"))).first()[0] or 1) // (2 * COUNTED))
    different = (
        numbers.repartition(parts, "column", "form", "bucket")
        .select((F.col("column") * 4 + F.col("form")).alias("kind"), "bucket", "value")
        .mapInArrow(_counted, "kind int, different bigint")
        .select(F.shiftright("kind", 2).alias("column"), "different")
        .unionByName(
            seen.where(F.col("form") == _TEXT).select("column", "value").distinct().groupBy("column").agg(F.count(F.lit(1)).alias("different"))
        )
    )
    found = seen.where(F.col("form") == _SUMS).unionByName(different, allowMissingColumns=True)

    def of(i: int, name: str):
        return F.when(F.col("column") == i, F.col(name))

    whole = found.agg(*[
        F.struct(
            F.lit(c).alias("column"),
            *[F.coalesce(F.sum(of(i, x)), F.lit(0).cast("bigint")).alias(y) for x, y in (("rows", "rows"), ("filled", "non_null"), ("different", "unique_values"))],
            F.min(of(i, "value")).cast("string").alias("sample"),
        ).alias(f"c{i}")
        for i, c in enumerate(df.columns)
    ])
    return whole.select(F.inline(F.array(*whole.columns)))
