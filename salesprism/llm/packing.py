"""Mixture-controlled packing: every window takes tokens of all sources in target proportions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from salesprism.llm.store import stored
from salesprism.llm.tokens import byte_level_ids, text_slices

LENGTH = 2048
BYTE_BPE, BYTE_BPE_END = "byte_bpe_50k.json", 1


def scaled(n: np.ndarray, part: int, whole: int) -> np.ndarray:
    """floor(n * part / whole), exact for 0 <= part <= whole and n < 2^62, by long division."""
    bits = 62 - whole.bit_length()
    if bits < 1:
        return np.array([int(x) * part // whole for x in n], dtype=np.int64)
    digits = max(1, -(-int(n.max(initial=0)).bit_length() // bits))
    done, rest = np.zeros_like(n), np.zeros_like(n)
    for k in range(digits - 1, -1, -1):
        digit = (n >> (k * bits)) & ((1 << bits) - 1)
        rest = (rest << bits) + digit * part
        done = (done << bits) + rest // whole
        rest %= whole
    return done


class Rounds:
    """Deficit round robin over source queues, in closed form.

    Queues are the leaves of a balanced tree. The two sides of a node share the slots the
    node gets: of its first n slots the left side has had floor(n * quantum / both quanta), and
    the right side the rest. What this floor cuts off is the left side's deficit, which it
    carries into all later windows, on whatever partition they are filled; it stays below one
    token for each of the log2(queues) nodes above a queue. A side that runs empty leaves its slots to
    the other. So what a queue has been served before any slot is known without replaying
    the rounds, and it never falls.
    """

    def __init__(self, tokens: list[int], quanta: list[int] | None = None) -> None:
        self.tokens = tokens
        self.quanta = quanta or tokens
        self.total = sum(tokens)
        self.held = np.cumsum([0, *map(int, tokens)], dtype=object)
        self.sums = np.cumsum([0, *map(int, self.quanta)], dtype=object)

    def served(self, queue: int, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens that this queue, and those before it, have been served in the first slots."""
        low, high, n = 0, len(self.tokens), slots
        before = np.zeros_like(slots)
        while high - low > 1:
            middle = (low + high) // 2
            left_held = int(self.held[middle] - self.held[low])
            right_held = int(self.held[high] - self.held[middle])
            quantum = int(self.sums[middle] - self.sums[low])
            both = int(self.sums[high] - self.sums[low])
            left = np.minimum(left_held, np.maximum(n - right_held, scaled(n, quantum, both)))
            if queue < middle:
                high, n = middle, left
            else:
                low, before, n = middle, before + left, n - left
        return n, before

    def window_of(self, queue: int, tokens: np.ndarray, length: int) -> np.ndarray:
        """The window that serves each of these tokens, given by their place in the queue."""
        low = np.zeros_like(tokens)
        high = np.full_like(tokens, -(-self.total // length) - 1)
        while (low < high).any():
            middle = (low + high) // 2
            late = self.served(queue, np.minimum((middle + 1) * length, self.total))[0] <= tokens
            low, high = np.where(late, middle + 1, low), np.where(late, high, middle)
        return low

    def pieces(self, queue: int, starts: np.ndarray, sizes: np.ndarray, length: int):
        """Cuts documents, given by their place in the queue, at the window borders: index of
        the document, first token in it, number of tokens, window, offset there."""
        first = self.window_of(queue, starts, length)
        last = self.window_of(queue, starts + sizes - 1, length)
        counts = last - first + 1
        doc = np.repeat(np.arange(len(starts)), counts)
        window = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts) + first[doc]
        own, before = self.served(queue, window * length)
        own_end, before_end = self.served(queue, np.minimum((window + 1) * length, self.total))
        # a window holds its sources' runs in queue order
        begin, end = np.maximum(starts[doc], own), np.minimum((starts + sizes)[doc], own_end)
        offset = (before_end - before) + (begin - own)
        some = end > begin
        doc, begin, end = doc[some], begin[some], end[some]
        return doc, begin - starts[doc], end - begin, window[some], offset[some]


_TOKENS = "doc_id bigint, source string, part bigint, before bigint, doc_tokens bigint, ids binary"
_PIECES = (
    "doc_id bigint, source string, start bigint, length bigint, ids binary, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


def tokenised(
    docs: DataFrame, encode: Callable[[list[str]], list[bytes]], end: int
) -> DataFrame:
    """Ids of each document of (doc_id, source, text), the end id added; ``before`` counts the
    ids of its source's earlier documents in the same input partition ``part``."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        last = np.array([end], dtype="<u4").tobytes()
        counts: dict = {}
        for batch in batches:
            for a, b, texts in text_slices(batch.column("text")):
                doc_ids = batch.column("doc_id").slice(a, b - a)
                sources = batch.column("source").slice(a, b - a)
                ids = [x + last for x in encode(texts)]
                sizes = [len(x) // 4 for x in ids]
                before = []
                for source, size in zip(sources.to_pylist(), sizes):
                    before.append(counts.get(source, 0))
                    counts[source] = before[-1] + size
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids, sources, pa.array([part] * (b - a), pa.int64()),
                        pa.array(before, pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()),
                    ],
                    ["doc_id", "source", "part", "before", "doc_tokens", "ids"],
                )

    picked = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), "text"
    )
    return picked.mapInArrow(encoded, _TOKENS)


def packed(
    docs: DataFrame,
    encode: Callable[[list[str]], list[bytes]] | None = None,
    end: int = BYTE_BPE_END,
    length: int = LENGTH,
    quanta: dict[str | None, int] | None = None,
) -> DataFrame:
    """Packs all documents of (doc_id, source, text) into windows of ``length`` ids, each
    filled from all source queues in proportion to their ``quanta`` (default: their tokens,
    so that every window has the mixture of the whole corpus; sources left out get 1). A
    window is a sequence; only the last one can be short. One row for each piece, with its
    ids as little-endian unsigned 32-bit integers.

    A queue holds its source's documents in the order of the stored token table, so no text
    or id is shuffled: a task needs only the tokens that earlier partitions hold of its
    sources, and each document finds its windows by itself (see ``Rounds``). The driver
    gets one number per source, whose list a mixture has anyway. Null texts are empty and
    yield the end id alone, a null source is a source, repeated rows are packed each, and an
    empty table gives no rows; other columns are ignored.
    """
    encode = encode or (lambda texts: byte_level_ids(BYTE_BPE, texts))
    table = stored(tokenised(docs, encode, end))
    parts = table.groupBy("part", "source").agg(F.sum("doc_tokens").alias("_n"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = stored(
        parts.select(
            F.col("part").alias("_part"), F.col("source").alias("_source"), "_n",
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("base"),
        )
    )
    totals = {r["_source"]: r["n"] for r in parts.groupBy("_source").agg(F.sum("_n").alias("n")).collect()}
    names = sorted((s for s in totals if s is not None)) + [None] * (None in totals)
    rounds = Rounds([totals[s] for s in names], [(quanta or {}).get(s, 1) for s in names] if quanta else None)
    queue_of = {s: i for i, s in enumerate(names)}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.to_pydict()
            starts, sizes = np.array(whole["start"], dtype=np.int64), np.array(whole["doc_tokens"], dtype=np.int64)
            queues = np.array([queue_of[s] for s in whole["source"]], dtype=np.int64)
            for queue in np.unique(queues):
                rows = np.flatnonzero(queues == queue)
                doc, first, count, window, offset = rounds.pieces(int(queue), starts[rows], sizes[rows], length)
                at = rows[doc]
                ids = [whole["ids"][r][4 * a : 4 * (a + n)] for r, a, n in zip(at.tolist(), first.tolist(), count.tolist())]
                taken = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(taken), batch.column("source").take(taken),
                        pa.array(first), pa.array(count), pa.array(ids, pa.binary()),
                        batch.column("doc_tokens").take(taken), pa.array(window), pa.array(offset),
                    ],
                    ["doc_id", "source", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
                )

    placed = table.join(
        parts.drop("_n"), (F.col("part") == F.col("_part")) & F.col("source").eqNullSafe(F.col("_source"))
    ).select("doc_id", "source", "doc_tokens", "ids", (F.col("before") + F.col("base")).alias("start"))
    return placed.mapInArrow(cut, _PIECES)
