"""Phrases that stand together more often than their parts, counted with an index of each shard.

A shard is a bounded part of one language's text as numbers of words. Its index is a
depth-limited Burrows-Wheeler transform of the numbers and of their reverse, in which the interval of a phrase
is extended by a word on its left or its right. Counts of shards are summed. Only what can still
be frequent goes on: shards get back which of their own words, then which of their own word pairs, are
frequent in all shards, so no list of all frequent ones has to fit anywhere.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from salesprism.llm.store import stored

#: Phrases of two to four words, with so many occurrences; a longer one takes the place of those it
#: holds if it has so many hundredths of their occurrences; so many phrases of a language are reported.
LONGEST, LEAST, SHARE, TOP = 4, 30, 80, 2000
#: Words that a task holds before it closes its largest shard, and the words in a row of a shard.
SHARD, CHUNK = 3_000_000, 250_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPLIT = ".,;:!?\n\x0b\x0c\r"
_TOKEN = re.compile("[^ \t.,;:!?\n\x0b\x0c\r]+|[.,;:!?\n\x0b\x0c\r]")


class _Numbers(dict):
    """Numbers of words from 1 in the order they come; what splits pieces is 0."""

    def __init__(self):
        super().__init__(dict.fromkeys(_SPLIT, 0))

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self) - len(_SPLIT) + 1
        return n


_SHARDS = "shard long, lang string, words array<string>, counts array<long>, numbers binary"
_SHARDS_ARROW = pa.schema([
    ("shard", pa.int64()), ("lang", pa.string()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())), ("numbers", pa.binary()),
])


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers by byte planes, compressed: their high bytes are mostly 0."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    planes = pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4")[:, 0]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of shards: the first of a shard holds its words and their counts, the others its numbers."""
    task, closed, held = TaskContext.get().partitionId(), 0, 0
    open_: dict[str, tuple[_Numbers, list]] = {}

    def close(lang: str) -> Iterator[pa.RecordBatch]:
        nonlocal closed, held
        known, parts = open_.pop(lang)
        numbers = np.concatenate(parts)
        held -= len(numbers)
        shard, closed = (task << 24) + closed, closed + 1
        counts = np.bincount(numbers, minlength=len(known) - len(_SPLIT) + 1)[1:]
        words = [w for w, n in known.items() if n]
        yield pa.RecordBatch.from_pydict({"shard": [shard], "lang": [lang], "words": [words], "counts": [counts], "numbers": [None]}, _SHARDS_ARROW)
        for i in range(0, len(numbers), CHUNK):
            part = _packed(numbers[i : i + CHUNK])
            yield pa.RecordBatch.from_pydict({"shard": [shard], "lang": [lang], "words": [None], "counts": [None], "numbers": [part]}, _SHARDS_ARROW)

    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
            known, parts = open_.setdefault(lang, (_Numbers(), []))
            found = list(map(known.__getitem__, _TOKEN.findall(text)))
            found.append(0)
            parts.append(np.array(found, dtype=np.int32))
            held += len(found)
            while held > SHARD:
                yield from close(max(open_, key=lambda k: sum(map(len, open_[k][1]))))
    for lang in sorted(open_):
        yield from close(lang)


class Index:
    """Backward search over numbers that end with 0, ordered by their first ``depth`` at each place."""

    def __init__(self, numbers: np.ndarray, depth: int):
        numbers = numbers.astype(np.int64)
        rank, covered = numbers, 1
        while covered < depth:
            ahead = np.concatenate([rank[covered:], np.zeros(min(covered, len(rank)), dtype=np.int64)])
            rank = np.unique(rank * (ahead.max(initial=0) + 1) + ahead, return_inverse=True)[1]
            covered *= 2
        #: the number before each place, in the order of the places
        self.before = numbers[np.argsort(rank, kind="stable") - 1]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(numbers))])
        order = np.argsort(self.before, kind="stable")
        self._size = len(numbers)
        self._places = self.before[order] * self._size + order

    def rank(self, number: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How many of the first ``place`` entries of ``before`` are the number."""
        return np.searchsorted(self._places, number * self._size + place) - self.starts[number]

    def extensions(self, low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """The numbers before the intervals: (which interval, number, count, new low, smaller), where smaller
        counts the interval's entries with smaller numbers, 0 included."""
        which = np.repeat(np.arange(len(low)), size)
        place = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
        width = len(self.starts)
        pair, count = np.unique(which * width + self.before[place], return_counts=True)
        which, number = pair // width, pair % width
        ahead = np.cumsum(count) - count
        first = np.searchsorted(which, which)
        real = number > 0
        which, number, count, smaller = which[real], number[real], count[real], (ahead - ahead[first])[real]
        return which, number, count, self.starts[number] + self.rank(number, low[which]), smaller


class BothWays:
    """Intervals of phrases in the index of the numbers and in that of their reverse, extended on either side."""

    def __init__(self, numbers: np.ndarray, depth: int):
        self._ahead, self._back = Index(numbers, depth), Index(np.concatenate([numbers[-2::-1], [0]]), depth)
        words = np.arange(1, len(self._ahead.starts) - 1)
        size = np.diff(self._ahead.starts)[1:]
        self.single = words[:, None], self._ahead.starts[1:-1], self._back.starts[1:-1], size

    def left(self, phrases: np.ndarray, low: np.ndarray, back: np.ndarray, size: np.ndarray):
        which, word, count, own, smaller = self._ahead.extensions(low, size)
        return np.concatenate([word[:, None], phrases[which]], axis=1), own, back[which] + smaller, count

    def right(self, phrases: np.ndarray, low: np.ndarray, back: np.ndarray, size: np.ndarray):
        which, word, count, own, smaller = self._back.extensions(back, size)
        return np.concatenate([phrases[which], word[:, None]], axis=1), low[which] + smaller, own, count


def _known(numbers: pa.Table, known: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A shard's numbers with frequent words numbered anew from 1 and all others 0; ids by new number; frequent
    pairs in new numbers, one to a column."""
    whole = np.concatenate([_unpacked(part) for part in numbers["numbers"].to_pylist()])
    one, two, pair = (known[c].to_numpy() for c in ("one", "two", "pair"))
    local, ids = one[~pair], two[~pair]
    order = np.argsort(ids)
    ids = ids[order]
    new = np.zeros(int(max(whole.max(initial=0), local.max(initial=0))) + 1, dtype=np.int64)
    new[local[order]] = np.arange(1, len(order) + 1)
    return new[whole], ids, np.searchsorted(ids, np.array([one[pair], two[pair]])) + 1


def _linked(text: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Whether the word at each place and the next one are one of the pairs."""
    width = int(max(text.max(initial=0), pairs.max(initial=0))) + 1
    codes, own = np.sort(pairs[0] * width + pairs[1]), text[:-1] * width + text[1:]
    if not len(codes):
        return np.zeros(len(own), dtype=bool)
    return codes[np.minimum(np.searchsorted(codes, own), len(codes) - 1)] == own


def _runs(text: np.ndarray, linked: np.ndarray, least: int) -> np.ndarray:
    """The text's runs of ``least`` or more words, each closed by 0; linked: whether a run goes on from the word at
    each place to the next one."""
    bounds = np.flatnonzero(np.concatenate([[True], ~linked, [True]]))
    begin, length = bounds[:-1], np.diff(bounds) + 1
    kept = (length > least) & (text[begin] > 0)
    begin, length = begin[kept], length[kept]
    at = np.repeat(begin - (np.cumsum(length) - length), length) + np.arange(length.sum())
    ends = np.cumsum(length) - 1
    at[ends] = 0
    out = text[at] if len(at) else text[:0]
    out[ends] = 0
    return out


_PAIRS = pa.schema([("shard", pa.int64()), ("one", pa.int64()), ("two", pa.int64()), ("c", pa.int64())])
_LONGER = pa.schema([("one", pa.int64()), ("two", pa.int64()), ("three", pa.int64()), ("four", pa.int64()), ("c", pa.int64())])


def _pairs(numbers: pa.Table, known: pa.Table) -> pa.Table:
    """Counts of a shard's pairs of frequent words."""
    if not len(numbers) or not len(known):
        return _PAIRS.empty_table()
    text, ids, _ = _known(numbers, known)
    text = _runs(text, (text[:-1] > 0) & (text[1:] > 0), 2)
    if not len(text):
        return _PAIRS.empty_table()
    index = Index(text, 2)
    word, before, count, _, _ = index.extensions(index.starts[1:-1], np.diff(index.starts)[1:])
    shard = np.full(len(count), numbers["shard"][0].as_py())
    return pa.table([shard, ids[before - 1], ids[word], count], schema=_PAIRS)


def _longer(numbers: pa.Table, known: pa.Table) -> pa.Table:
    """Counts of a shard's phrases of three and four words all of whose pairs are frequent."""
    if not len(numbers) or not len(known):
        return _LONGER.empty_table()
    text, ids, pairs = _known(numbers, known)
    text = _runs(text, _linked(text, pairs), 3)
    if not len(text):
        return _LONGER.empty_table()
    index = BothWays(text, LONGEST)
    three = index.left(*index.left(*index.single))
    tables = [pa.table([*ids[three[0].T - 1], pa.nulls(len(three[0]), pa.int64()), three[3]], schema=_LONGER)]
    found, _, _, count = index.right(*three)
    tables.append(pa.table([*ids[found.T - 1], count], schema=_LONGER))
    return pa.concat_tables(tables)


def counted(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words (lang, word, id, f), phrases (phrase, f) of one to four ids, those with ``least`` occurrences
    or more, and all words of each language (lang, n)."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.translate("text", _UPPER, _LOWER).alias("text")).where("text is not null")
    shards = stored(texts.mapInArrow(_cut, _SHARDS))
    heads = shards.where("words is not null")
    words = heads.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("pos", "own"))
    words = words.select("shard", "lang", (F.col("pos") + 1).cast("bigint").alias("local"), F.col("own.words").alias("word"), F.col("own.counts").alias("c"))
    sizes = heads.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, c: a + c)).alias("n"))
    # what is summed over shards stays beside each shard's own row, in the one shuffle of the rows
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    same = Window.partitionBy("lang", "word")
    placed = words.repartition(parts, "lang", "word").withColumn("_row", F.monotonically_increasing_id())
    placed = placed.withColumn("f", F.sum("c").over(same)).withColumn("id", F.min("_row").over(same))
    placed = stored(placed.where(F.col("f") >= least).select("shard", "local", "lang", "word", "id", "f"))
    common = stored(placed.groupBy("lang", "word").agg(F.min("id").alias("id"), F.min("f").alias("f")))

    numbers = shards.where("numbers is not null").select("shard", "numbers")
    own = placed.select("shard", F.col("local").alias("one"), F.col("id").alias("two"), F.lit(False).alias("pair"))
    pairs = numbers.groupBy("shard").cogroup(own.groupBy("shard")).applyInArrow(_pairs, "shard long, one long, two long, c long")
    summed = pairs.withColumn("f", F.sum("c").over(Window.partitionBy("one", "two")))
    frequent = stored(summed.where(F.col("f") >= least).select("shard", "one", "two", "f"))
    known = own.unionByName(frequent.select("shard", "one", "two", F.lit(True).alias("pair")))
    ids = ["one", "two", "three", "four"]
    longer = numbers.groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(_longer, "one long, two long, three long, four long, c long")
    longer = longer.groupBy(*ids).agg(F.sum("c").alias("f")).where(F.col("f") >= least)
    two = frequent.groupBy("one", "two").agg(F.max("f").alias("f"))
    phrases = (
        common.select(F.array("id").alias("phrase"), "f")
        .unionByName(two.select(F.array("one", "two").alias("phrase"), "f"))
        .unionByName(longer.select(F.array_compact(F.array(*ids)).alias("phrase"), "f"))
    )
    return common, stored(phrases), sizes


def _wide(column: Column) -> Column:
    return column.cast("decimal(20,0)")


def collocations(docs: DataFrame, least: int = LEAST, share: int = SHARE) -> DataFrame:
    """All phrases of two to four words with ``least`` occurrences or more in their language, but those whose words
    lie in a longer one with ``share`` hundredths of their occurrences: lang, phrase, a, l, r, n, score, and
    n_left and n_right, how many frequent phrases have one word more on that side.

    Texts are lower-cased (A-Z), split into pieces and words. A null text is empty, a null lang is
    ``und``, repeated rows count again, an empty table gives no rows, other columns are ignored. Of cuts with
    equal scores the first counts.
    """
    words, phrases, sizes = counted(docs, least)
    found = phrases.where(F.size("phrase") > 1)
    cuts = found.select("phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("phrase") - 1)).alias("k"))
    cuts = cuts.withColumn("left", F.slice("phrase", F.lit(1), F.col("k"))).withColumn("right", F.slice("phrase", F.col("k") + 1, F.size("phrase")))
    cuts = cuts.join(phrases.select(F.col("phrase").alias("left"), F.col("f").alias("l")), "left")
    cuts = cuts.join(phrases.select(F.col("phrase").alias("right"), F.col("f").alias("r")), "right")
    score = F.call_function("div", _wide(F.col("a")) * F.lit(2_000_000).cast("decimal(7,0)"), _wide(F.col("l") + F.col("r")))
    best = cuts.groupBy("phrase").agg(F.min("a").alias("a"), F.min(F.struct(score.cast("bigint").alias("score"), "k", "l", "r")).alias("cut"))
    # a phrase inside one two words longer is inside one a word longer that is as frequent, so single steps are enough
    longer = found.where(F.size("phrase") > 2)
    inside = longer.select(
        F.col("f").alias("most"),
        F.explode(F.array(
            F.struct(F.slice("phrase", F.lit(2), F.size("phrase")).alias("phrase"), F.lit(1).alias("left"), F.lit(0).alias("right")),
            F.struct(F.slice("phrase", F.lit(1), F.size("phrase") - 1).alias("phrase"), F.lit(0).alias("left"), F.lit(1).alias("right")),
        )).alias("part"),
    ).groupBy("part.phrase").agg(F.max("most").alias("most"), F.sum("part.left").alias("n_left"), F.sum("part.right").alias("n_right"))
    kept = best.join(inside, "phrase", "left").where(
        F.col("most").isNull() | (_wide(F.col("most")) * 100 < _wide(F.col("a")) * share)
    )
    spelt = kept.select("phrase", F.posexplode("phrase").alias("pos", "id")).join(words.select("id", "lang", "word"), "id")
    spelt = spelt.groupBy("phrase").agg(
        F.min("lang").alias("lang"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "word"))), lambda s: s["word"]), " ").alias("text"),
    )
    return kept.join(spelt, "phrase").join(sizes, "lang").select(
        "lang", F.col("text").alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score",
        F.coalesce("n_left", F.lit(0)).cast("bigint").alias("n_left"), F.coalesce("n_right", F.lit(0)).cast("bigint").alias("n_right"),
    )


def top(found: DataFrame, most: int = TOP) -> DataFrame:
    """Each language's first ``most`` collocations with their rank, by score, occurrences and phrase."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most).withColumn("rank", F.col("rank").cast("bigint"))
