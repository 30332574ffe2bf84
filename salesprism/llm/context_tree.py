"""Context-tree weighting over bytes: scores of whole texts by a mixture over all context depths."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from salesprism.llm.store import stored
from salesprism.llm.tokens import slices

DEPTH = 4  # bytes of context
BLOCK = 6_000_000  # characters of a block of documents, about
MOST_DOCS = 60_000  # documents of a block: their number fits in 16 bits
SLICE = 3_000_000  # positions sorted at once
_END = 10  # the byte after the last word, and the context before the first


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma for x >= 1/2, by Stirling's series after a shift of 8."""
    y = x + 8.0
    shift = np.ones_like(x)
    for k in range(8):
        shift *= x + k
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(shift)


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of any sequence with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)


def canonical(text: str | None) -> bytes:
    """A text's words with A-Z in lower case, one blank between them, and the end."""
    return b" ".join((text or "").encode().lower().split()) + b"\n"


def grams(texts: list[bytes], depth: int = DEPTH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For slices of all positions: sorted distinct (gram, document) and their counts.

    A gram is a position's context, nearest byte first, and then the byte itself. Contexts
    never reach into another document.
    """
    gap = b"\n" * (depth - 1)
    data = np.frombuffer(b"\n" * depth + b"".join(t + gap for t in texts), np.uint8)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    starts = np.cumsum(lengths + depth - 1) - (lengths + depth - 1) + depth
    at = 0
    first = 0
    while first < len(texts):
        # whole documents up to a slice, or a part of a long one
        end = max(first + 1, int(np.searchsorted(starts, starts[first] + SLICE)))
        for at in range(0, int(lengths[first]), SLICE) if end == first + 1 else [None]:
            if at is None:
                a, b = int(starts[first]), int(starts[end - 1] + lengths[end - 1])
            else:
                a = int(starts[first]) + at
                b = min(a + SLICE, int(starts[first] + lengths[first]))
            doc = np.repeat(np.arange(first, end), (lengths + depth - 1)[first:end])[: b - a] if at is None else np.full(b - a, first)
            code = np.zeros(b - a, dtype=np.uint64)
            for back in range(1, depth + 1):
                code = (code << np.uint64(8)) | data[a - back : b - back]
            code = (code << np.uint64(8)) | data[a:b]
            key = (code << np.uint64(16)) | doc.astype(np.uint64)
            if at is None:  # not the gaps between documents
                inside = np.arange(b - a) + a < (starts + lengths)[doc]
                key = key[inside]
            key.sort()
            edges = np.flatnonzero(np.diff(key, prepend=key[:1] ^ np.uint64(1)))
            counts = np.diff(edges, append=len(key))
            yield key[edges] >> np.uint64(16), (key[edges] & np.uint64(0xFFFF)).astype(np.int64), counts
        first = end


def _merged(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own, inverse = np.unique(codes, return_inverse=True)
    return own, np.bincount(inverse, weights=counts, minlength=len(own)).astype(np.int64)


def _range_of_gram(codes: np.ndarray, ranges: int, depth: int) -> np.ndarray:
    """By the two nearest bytes, so that a range holds whole subtrees."""
    pair = codes >> np.uint64(8 * (depth - 1))
    return ((pair * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(ranges)


_BLOCKS = (
    "block bigint, doc_ids array<bigint>, held array<boolean>, texts binary, "
    "grams array<struct<range: bigint, keys: binary, counts: binary>>, "
    "words array<struct<range: bigint, keys: binary, counts: binary>>"
)


def blocks_of(docs: DataFrame, ranges: int, depth: int = DEPTH) -> DataFrame:
    """Documents of (doc_id, text, held) in blocks, with each block's distinct grams and words
    and how often its documents that are not held out have them, cut at ranges of keys."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        kinds = pa.list_(pa.struct([("range", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())]))
        for batch in batches:
            raw = batch.column("text").to_pylist()
            ids, held = batch.column("doc_id").to_pylist(), batch.column("held").to_pylist()
            for x, y in slices(raw, BLOCK):
                for a in range(x, y, MOST_DOCS):
                    b = min(a + MOST_DOCS, y)
                    texts = [canonical(t) for t in raw[a:b]]
                    learn = ~np.array(held[a:b], dtype=bool)
                    codes, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
                    for code, doc, n in grams(texts, depth):
                        new, added = _merged(code, n * learn[doc])
                        codes, counts = _merged(np.concatenate([codes, new]), np.concatenate([counts, added]))
                    own = _range_of_gram(codes, ranges, depth).astype(np.int64)
                    order = np.argsort(own, kind="stable")
                    codes, counts, own = codes[order], counts[order], own[order]
                    edges = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1, [len(own)]])
                    gram_rows = [
                        {"range": int(own[p]), "keys": codes[p:q].astype("<u8").tobytes(), "counts": counts[p:q].astype("<u4").tobytes()}
                        for p, q in zip(edges[:-1].tolist(), edges[1:].tolist())
                    ]
                    known: Counter = Counter()
                    other: set = set()
                    for text, train in zip(texts, learn.tolist()):
                        if train:
                            known.update(text.split())
                            known[b""] += 1  # the end
                        else:
                            other.update(text.split())
                            other.add(b"")
                    parted: dict = {}
                    for word in sorted(other.union(known)):
                        parted.setdefault(zlib.crc32(word) % ranges, []).append(word)
                    word_rows = [
                        {"range": r, "keys": b"\n".join(w), "counts": np.array([known[x] for x in w], "<u4").tobytes()}
                        for r, w in parted.items()
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([block]), pa.array([ids[a:b]], pa.list_(pa.int64())),
                            pa.array([held[a:b]], pa.list_(pa.bool_())), pa.array([b"".join(texts)], pa.binary()),
                            pa.array([gram_rows], kinds), pa.array([word_rows], kinds),
                        ],
                        ["block", "doc_ids", "held", "texts", "grams", "words"],
                    )
                    block += 1

    return docs.mapInArrow(gather, _BLOCKS)


class Tree:
    """The part of a context tree below some contexts of two bytes.

    ``codes`` are sorted distinct grams and ``counts`` how often they were learned. Every bit
    of a byte has its own tree: its node in the byte's binary tree is the last byte of the key.
    """

    def __init__(self, codes: np.ndarray, counts: np.ndarray, depth: int = DEPTH) -> None:
        self.depth = depth
        byte = (codes & np.uint64(255)).astype(np.int64)[:, None]
        place = np.arange(8)
        self.node = (1 << place) | (byte >> (8 - place))
        self.bit = (byte >> (7 - place)) & 1
        self.context = codes >> np.uint64(8)
        weights = np.repeat(counts.astype(np.float64)[:, None], 8, axis=1)
        self.levels = {}
        below = None
        for d in range(depth, 1, -1):
            keys = ((self.context >> np.uint64(8 * (depth - d)))[:, None] << np.uint64(8)) | self.node.astype(np.uint64)
            own, at = np.unique(keys, return_inverse=True)
            at = at.reshape(keys.shape)
            n = [np.bincount(at[self.bit == b], weights=weights[self.bit == b], minlength=len(own)) for b in (0, 1)]
            alone = log_estimate(*n)
            if below is None:
                weighted, stop = alone, np.ones(len(own))
            else:
                deeper, log_deeper = below
                parent = ((deeper >> np.uint64(16)) << np.uint64(8)) | (deeper & np.uint64(255))
                split = np.bincount(np.searchsorted(own, parent), weights=log_deeper, minlength=len(own))
                both = np.logaddexp(alone, split)
                weighted, stop = both - np.log(2.0), np.exp(alone - both)
            self.levels[d] = (own, at, n, stop)
            below = own, weighted
        self.pairs = below  # keys at depth 2 and the ln of their weighted probability

    def top_counts(self) -> tuple[np.ndarray, ...]:
        """For the nodes at depth 2: context, node, counts, ln of the weighted probability."""
        own, _, n, _ = self.levels[2]
        return own >> np.uint64(8), own & np.uint64(255), n[0], n[1], self.pairs[1]

    def log10(self, top: "Top") -> np.ndarray:
        """log10 of the probability of each gram's last byte after its context."""
        chance = None
        for d in range(self.depth, 1, -1):
            _, at, n, stop = self.levels[d]
            own = (np.where(self.bit == 1, n[1][at], n[0][at]) + 0.5) / (n[0][at] + n[1][at] + 1.0)
            chance = own if chance is None else stop[at] * own + (1 - stop[at]) * chance
        nearest = (self.context >> np.uint64(8 * (self.depth - 1))).astype(np.int64)[:, None]
        for n, stop in ((top.n1[:, nearest, self.node], top.stop1[nearest, self.node]), (top.n0[:, self.node], top.stop0[self.node])):
            own = (np.where(self.bit == 1, n[1], n[0]) + 0.5) / (n[0] + n[1] + 1.0)
            chance = stop * own + (1 - stop) * chance
        return np.log10(chance).sum(axis=1)


class Top:
    """Counts and stopping weights of the nodes without context and with one byte of it."""

    def __init__(self, contexts, nodes, zeros, ones, log_weighted) -> None:
        near = np.asarray(contexts, dtype=np.int64) >> 8
        at = near * 256 + np.asarray(nodes, dtype=np.int64)

        def summed(values) -> np.ndarray:
            return np.bincount(at, weights=values, minlength=65536).reshape(256, 256)

        self.n1 = np.stack([summed(zeros), summed(ones)])
        weighted, self.stop1 = self._mixed(self.n1, summed(log_weighted))
        self.n0 = self.n1.sum(axis=1)
        _, self.stop0 = self._mixed(self.n0, weighted.sum(axis=0))

    @staticmethod
    def _mixed(n: np.ndarray, split: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        alone = log_estimate(n[0], n[1])
        both = np.logaddexp(alone, split)
        # nodes that nothing reaches have probability 1 and stay neutral in sums
        return np.where(n.sum(axis=0) > 0, both - np.log(2.0), 0.0), np.exp(alone - both)


def _tree(rows: pd.DataFrame, depth: int) -> tuple[Tree, np.ndarray]:
    codes = np.concatenate([np.frombuffer(x, "<u8") for x in rows["keys"]])
    counts = np.concatenate([np.frombuffer(x, "<u4") for x in rows["counts"]])
    own, total = _merged(codes, counts)
    return Tree(own, total, depth), own


_ANSWERS = "block bigint, kind string, keys binary, values binary"


def gram_answers(blocks: DataFrame, depth: int = DEPTH) -> DataFrame:
    """log10 probabilities of each block's grams. Subtrees are weighted in their range's task;
    only nodes with two bytes of context, at most 2^24 whatever the corpus, are gathered, in sums
    over these for the 2^16 nodes above them."""
    asked = blocks.select("block", F.explode("grams").alias("g")).select("block", "g.*")

    def upper(rows: pd.DataFrame) -> pd.DataFrame:
        contexts, nodes, zeros, ones, weighted = _tree(rows, depth)[0].top_counts()
        return pd.DataFrame(
            {"near": (contexts >> np.uint64(8)).astype(np.int64), "node": nodes.astype(np.int64), "zeros": zeros, "ones": ones, "weighted": weighted}
        ).groupby(["near", "node"], as_index=False).sum()

    sums = asked.groupBy("range").applyInPandas(
        upper, "near bigint, node bigint, zeros double, ones double, weighted double"
    )
    # one row for each of at most 256 x 255 nodes
    nodes = sums.groupBy("near", "node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "weighted")])
    table = nodes.toPandas().sort_values(["near", "node"])
    top = Top(table["near"].to_numpy() << 8, table["node"], table["zeros"], table["ones"], table["weighted"])

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        tree, own = _tree(rows, depth)
        found = tree.log10(top)
        values = [found[np.searchsorted(own, np.frombuffer(x, "<u8"))].astype("<f8").tobytes() for x in rows["keys"]]
        return pd.DataFrame({"block": rows["block"], "kind": "gram", "keys": rows["keys"], "values": values})

    return asked.groupBy("range").applyInPandas(answer, _ANSWERS)


def word_answers(blocks: DataFrame) -> DataFrame:
    """Counts of each block's words over all that is learned; block -1 has for each range the
    number of learned tokens and of distinct ones."""
    asked = blocks.select("block", F.explode("words").alias("w")).select("block", "w.*")

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        total: Counter = Counter()
        words = [x.split(b"\n") for x in rows["keys"]]
        for own, counts in zip(words, rows["counts"]):
            for word, n in zip(own, np.frombuffer(counts, "<u4").tolist()):
                total[word] += n
        values = [np.array([total[w] for w in own], dtype="<i8").tobytes() for own in words]
        some = np.array([sum(total.values()), sum(n > 0 for n in total.values())], dtype="<i8").tobytes()
        return pd.DataFrame(
            {
                "block": [*rows["block"], -1], "kind": "word",
                "keys": [*rows["keys"], b""], "values": [*values, some],
            }
        )

    return asked.groupBy("range").applyInPandas(count, _ANSWERS)


_SCORES = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, n_bytes bigint, "
    "base_score double, score double"
)


def scored(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Scores of all documents of (doc_id, text): held_out, n_tokens, n_known, train_tokens,
    n_bytes, base_score (unigrams), score (log10 probability) and bits_per_byte.

    The model is a context tree weighting over the bytes of the words in lower case, one
    blank between words and a line end after the last: each of a byte's eight binary decisions has
    a tree of up to ``depth`` bytes of context, in which every node weighs its own
    Krichevsky-Trofimov estimate against its children's with one half each. It learns from
    documents whose crc32(doc_id as text) mod 5 is not 1, in any order, since the weights
    depend on counts only, and stays as it is while it scores. A null doc_id is not held out;
    null and empty texts are the end alone; repeated rows are learned and scored each; an
    empty table gives no rows; other columns are ignored.

    Documents stay in blocks. A block asks for its distinct grams and words, which are
    answered in ranges of keys, so neither the tree nor the vocabulary is ever in one place.
    """
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 1, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", held.alias("held"))
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = stored(blocks_of(rows, max(8, size // (2 * BLOCK)), depth))
    answers = stored(gram_answers(blocks, depth).unionByName(word_answers(blocks)))
    train_tokens, distinct = 0, 0
    for row in answers.where("block = -1").select("values").toLocalIterator():
        tokens, kinds = np.frombuffer(row["values"], "<i8").tolist()
        train_tokens, distinct = train_tokens + tokens, distinct + kinds

    def score(texts: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        own = known[known["kind"] == "gram"]
        codes = np.concatenate([np.frombuffer(x, "<u8") for x in own["keys"]])
        chances = np.concatenate([np.frombuffer(x, "<f8") for x in own["values"]])
        order = np.argsort(codes)
        codes, chances = codes[order], chances[order]
        counts: dict = {}
        own = known[known["kind"] == "word"]
        for keys, values in zip(own["keys"], own["values"]):
            counts.update(zip(keys.split(b"\n"), np.frombuffer(values, "<i8").tolist()))
        every = np.log10(train_tokens + 0.5 * (distinct + 1))
        logs = {w: float(np.log10(n + 0.5) - every) for w, n in counts.items()}
        unknown = {w for w, n in counts.items() if n == 0}
        ids, held = texts["doc_ids"].iloc[0], texts["held"].iloc[0]
        parts = texts["texts"].iloc[0].split(b"\n")[:-1]
        total = np.zeros(len(parts))
        for code, doc, n in grams([p + b"\n" for p in parts], depth):
            total += np.bincount(doc, weights=n * chances[np.searchsorted(codes, code)], minlength=len(parts))
        tokens = [[*p.split(), b""] for p in parts]
        return pd.DataFrame(
            {
                "doc_id": pd.array([None if pd.isna(i) else int(i) for i in ids], dtype="Int64"),
                "held_out": held,
                "n_tokens": [len(t) for t in tokens],
                "n_known": [len(t) - sum(w in unknown for w in t) for t in tokens],
                "n_bytes": [len(p) + 1 for p in parts],
                "base_score": [sum([logs[w] for w in t]) for t in tokens],
                "score": total,
            }
        )

    texts = blocks.select("block", "doc_ids", "held", "texts")
    found = texts.groupBy("block").cogroup(
        answers.where("block >= 0").groupBy("block")
    ).applyInPandas(score, _SCORES)
    return found.withColumns(
        {
            "train_tokens": F.lit(train_tokens).cast("bigint"),
            "bits_per_byte": -F.col("score") / F.lit(float(np.log10(2.0))) / F.col("n_bytes"),
        }
    )
