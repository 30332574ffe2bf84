"""Token ids in directly addressable codes: any token is read without decoding its block."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from salesprism.llm.store import stored
from salesprism.llm.tokens import text_slices, word_level_ids

WORD_BPE, WORD_BPE_END = "word_bpe_49k.json", 2
BLOCK = 1 << 19  # ids after which a block ends, at the end of a document
RANK_STEP = 512  # positions per entry of a rank directory
_HEAD = struct.Struct("<4sIQQ")  # mark, levels, ids, documents
_LEVEL = struct.Struct("<IQ")  # bits of a chunk, chunks
_MARK = b"DAC1"


def widths(values: np.ndarray) -> list[int]:
    """Bits of each level's chunks with the least total size, continuation bits included."""
    top = max(1, int(values.max(initial=0)).bit_length())
    longer = [int((values >> np.uint32(b)).astype(bool).sum()) if b else len(values) for b in range(top)]
    best: list[tuple[int, list[int]]] = [(0, [])] * (top + 1)
    for low in range(top - 1, -1, -1):
        # the chunk from bit low to high is kept for all values that reach bit low
        costs = [
            (longer[low] * (high - low + (high < top)) + best[high][0], [high - low, *best[high][1]])
            for high in range(low + 1, top + 1)
        ]
        best[low] = min(costs)
    return best[0][1]


def _bits(values: np.ndarray, width: int) -> bytes:
    columns = (values[:, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(columns.astype(np.uint8).reshape(-1), bitorder="little").tobytes() + bytes(8)


def encode_block(doc_ids: list[int | None], sizes: list[int], ids: np.ndarray) -> bytes:
    """One block: the documents' ids and starts, then for each level the chunks, the bitmap of
    values that go on, and the number of set bits before every ``RANK_STEP`` positions."""
    ids = ids.astype(np.uint32)
    levels = widths(ids)
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    out = [
        _HEAD.pack(_MARK, len(levels), len(ids), len(doc_ids)),
        np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(),
        known.tobytes(),
        np.concatenate([[0], np.cumsum(sizes)]).astype("<i8").tobytes(),
    ]
    rest = ids
    for k, width in enumerate(levels):
        out.append(_LEVEL.pack(width, len(rest)))
        out.append(_bits(rest & np.uint32((1 << width) - 1), width))
        if k + 1 < len(levels):
            rest = rest >> np.uint32(width)
            more = rest > 0
            counts = np.concatenate([[0], np.cumsum(more)])[:: RANK_STEP]
            out += [np.packbits(more, bitorder="little").tobytes(), counts.astype("<u4").tobytes()]
            rest = rest[more]
    return b"".join(out)


class Block:
    """A written block; ``token(i)`` reads one id, ``tokens()`` all of them."""

    def __init__(self, data: bytes) -> None:
        mark, levels, self.size, documents = _HEAD.unpack_from(data)
        if mark != _MARK:
            raise ValueError("not a block of token ids")
        at = _HEAD.size

        def read(kind: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, n, at)
            at += found.nbytes
            return found

        ids, known = read("<i8", documents), read("u1", documents)
        self.doc_ids = [int(d) if k else None for d, k in zip(ids, known)]
        self.starts = read("<i8", documents + 1)
        self.levels = []
        for k in range(levels):
            width, n = _LEVEL.unpack_from(data, at)
            at += _LEVEL.size
            chunks = read("u1", (n * width + 7) // 8 + 8)
            more = k + 1 < levels
            bitmap = read("u1", (n + 7) // 8) if more else None
            ranks = read("<u4", n // RANK_STEP + 1) if more else None
            self.levels.append((width, n, chunks, bitmap, ranks))

    def token(self, i: int) -> int:
        """The id at a place: one chunk per level, found through the rank directory."""
        if not 0 <= i < self.size:
            raise IndexError(i)
        value = shift = 0
        for width, _, chunks, bitmap, ranks in self.levels:
            byte, bit = divmod(i * width, 8)
            word = int.from_bytes(chunks[byte : byte + 8].tobytes(), "little")
            value |= ((word >> bit) & ((1 << width) - 1)) << shift
            if bitmap is None or not bitmap[i >> 3] >> (i & 7) & 1:
                return value
            step = i // RANK_STEP
            whole = bitmap[step * RANK_STEP // 8 : i // 8]
            tail = int(bitmap[i >> 3]) & ((1 << (i & 7)) - 1)
            i = int(ranks[step]) + int(np.bitwise_count(whole).sum()) + tail.bit_count()
            shift += width
        return value

    def tokens(self) -> np.ndarray:
        values = np.zeros(self.size, dtype=np.uint32)
        places, shift = np.arange(self.size), 0
        for width, n, chunks, bitmap, _ in self.levels:
            bits = np.unpackbits(chunks, count=n * width, bitorder="little").reshape(n, width)
            powers = np.left_shift(np.uint32(1), np.arange(width, dtype=np.uint32))
            values[places] |= (bits @ powers).astype(np.uint32) << np.uint32(shift)
            if bitmap is not None:
                places = places[np.unpackbits(bitmap, count=n, bitorder="little").astype(bool)]
            shift += width
        return values


_BLOCKS = "part bigint, block bigint, n_tokens bigint, data binary"
_READ = "doc_id bigint, start bigint, n_tokens bigint, ids binary"


def written(
    docs: DataFrame, encode: Callable[[list[str]], list[bytes]] | None = None, end: int = WORD_BPE_END
) -> DataFrame:
    """Writes the ids of all documents of (doc_id, text) in ascending doc_id order, null first,
    as a table of blocks in the shared folder; blocks go by (part, block).

    Documents are range partitioned by doc_id and text hash, so a repeated id is split too. A
    block holds whole documents. Null texts are empty and have the end id alone; repeated
    rows are written each; an empty table gives no blocks; other columns are ignored.
    """
    encode = encode or (lambda texts: word_level_ids(WORD_BPE, texts))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, block = TaskContext.get().partitionId(), 0
        last = np.array([end], dtype="<u4").tobytes()
        doc_ids: list = []
        held: list[bytes] = []

        def flushed() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), dtype="<u4")
            data = encode_block(doc_ids, [len(x) // 4 for x in held], ids)
            return pa.RecordBatch.from_pydict(
                {"part": [part], "block": [block], "n_tokens": [len(ids)], "data": [data]}
            )

        size = 0
        for batch in batches:
            numbers = batch.column("doc_id").to_pylist()
            for a, b, texts in text_slices(batch.column("text")):
                for doc_id, ids in zip(numbers[a:b], encode(texts)):
                    doc_ids.append(doc_id)
                    held.append(ids + last)
                    size += len(held[-1]) // 4
                    if size >= BLOCK:
                        yield flushed()
                        doc_ids, held, size, block = [], [], 0, block + 1
        if held:
            yield flushed()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    order = [F.col("doc_id"), F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(ordered.mapInArrow(blocks, _BLOCKS), "uncompressed")


def read_back(blocks: DataFrame) -> DataFrame:
    """The documents in written blocks: doc_id, start (ids of all documents before it),
    n_tokens and its ids as little-endian unsigned 32-bit integers. Running sums go over the
    blocks of a partition and over the partitions, never over all documents."""
    earlier = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy(F.col("part").alias("_part")).agg(F.sum("n_tokens").alias("_n"))
    bases = parts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    begins = (
        blocks.select("part", "block", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)).alias("_begin"))
        .join(bases, F.col("part") == F.col("_part"))
        .select("part", "block", (F.col("_begin") + F.col("_base")).alias("begin"))
    )

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, data in zip(batch.column("begin").to_pylist(), batch.column("data")):
                block = Block(data.as_buffer().to_pybytes())
                ids = block.tokens().astype("<u4").tobytes()
                starts = block.starts.tolist()
                spans = list(zip(starts[:-1], starts[1:]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(block.doc_ids, pa.int64()),
                        pa.array([begin + a for a, _ in spans], pa.int64()),
                        pa.array([b - a for a, b in spans], pa.int64()),
                        pa.array([ids[4 * a : 4 * b] for a, b in spans], pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    placed = blocks.select("part", "block", "data").join(begins, ["part", "block"])
    return placed.select("begin", "data").mapInArrow(decoded, _READ)
