"""Tokeniser fertility: documents whose tokens per text fall outside the bands of their language."""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from salesprism.llm.store import stored
from salesprism.llm.shingles import _BLANK as BLANK, word_spans
from salesprism.llm.tokens import WordTable, distinct, runs, spaced, text_slices, tokenizer, tokenizer_path

PIECES, BYTES = "piece_bpe_32k.model", "byte_bpe_50k.json"
SYMBOLS = "#*$%&|<>"
CHUNK = 256  # pieces over which entropy is measured, so that it doesn't depend on length
KEPT = 400_000  # words whose tokens and pieces a worker holds, about
SLICE = 500_000  # bytes of texts split into words at once
LEAST_DOCS = 200  # bands of fewer documents are wider, and those of their language's scripts count too
#: measure: bins in a unit, half width of the band in robust standard deviations, the least
#: such deviation, rejects below, rejects above
MEASURES = {
    "chars_per_piece": (200, 8.0, 0.05, True, True),
    "chars_per_token": (200, 8.0, 0.05, True, True),
    "fallback_share": (1000, 8.0, 0.01, False, True),
    "piece_entropy": (500, 4.0, 0.016, True, False),
}

_LETTER = np.array([chr(b).isalpha() for b in range(128)])
_NAMES: dict[int, str | None] = {}  # script of each letter seen
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS.encode()))
_VALUES: list = []


class _Values(WordTable):
    """For a word the number of its tokens, then its pieces. ``fallback`` tells which pieces are single bytes."""

    def __init__(self) -> None:
        import sentencepiece

        super().__init__(self._packed, KEPT)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECES))
        self.spaced = spaced(tokenizer(BYTES))
        self.fallback = np.array([self.pieces.is_byte(i) for i in range(self.pieces.get_piece_size())])

    def compute(self, words: list[bytes]) -> list[tuple[int, list[int]]]:
        ends = np.cumsum([len(w) for w in words], dtype=np.int64)
        tokens, _ = self.spaced(b"".join(words), np.concatenate([[0], ends[:-1]]), ends)
        return list(zip(tokens.tolist(), self.pieces.encode([w.decode() for w in words], num_threads=1)))

    def _packed(self, data: bytes, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        tokens, _ = self.spaced(data, begins, ends)
        split = self.pieces.encode([data[a:b].decode() for a, b in zip(begins.tolist(), ends.tolist())], num_threads=1)
        sizes = np.array([len(p) for p in split], dtype=np.int64) + 1
        values = np.empty(int(sizes.sum()), dtype="<u4")
        first = np.cumsum(sizes) - sizes
        values[first] = tokens
        later = np.ones(len(values), dtype=bool)
        later[first] = False
        values[later] = np.fromiter(chain.from_iterable(split), "<u4", len(values) - len(sizes))
        return sizes, values


def _word_values() -> tuple[WordTable, np.ndarray]:
    if not _VALUES:
        table = _Values()
        _VALUES.append((table, table.fallback))
    return _VALUES[0]


def entropy(ids: np.ndarray) -> float:
    """Mean over runs of ``CHUNK`` ids of the entropy, as a share of the most it could be; a
    last run under a quarter of that counts only where it is the only one."""
    n = len(ids)
    if n < 2:
        return 1.0
    if n > CHUNK and n % CHUNK < CHUNK // 4:
        n -= n % CHUNK
    chunk = np.arange(n, dtype=np.int64) // CHUNK
    keys, counts = np.unique(chunk << 32 | ids[:n], return_counts=True)
    sizes = np.minimum(CHUNK, n - np.arange(int(chunk[-1]) + 1) * CHUNK)
    own = sizes[keys >> 32]
    bits = np.bincount(keys >> 32, weights=counts / own * np.log2(own / counts))
    return float((bits / np.log2(np.maximum(sizes, 2))).mean())


def _repeated(words: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """For each text, its words in 3-word windows that it has twice or more, each word once.
    ``words`` are numbers of words under 2^31, ``doc`` the text of each, in order."""
    flags = np.zeros(len(words), dtype=bool)
    if len(words) > 2:
        pairs = distinct(words[:-2] << 32 | words[1:-1])[1]
        windows = distinct(pairs << 32 | words[2:])[1]
        inside = np.flatnonzero(doc[2:] == doc[:-2])
        first, inverse = distinct(doc[inside] << 32 | windows[inside])
        again = inside[np.bincount(inverse, minlength=len(first))[inverse] > 1]
        for k in range(3):
            flags[again + k] = True
    return np.bincount(doc[flags], minlength=docs)


def repeated_words(words: list) -> int:
    """Words in 3-word windows that the text has twice or more, each word once."""
    numbers: dict = {}
    own = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    return int(_repeated(own, np.zeros(len(own), dtype=np.int64), 1)[0])


def duplicate_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def _scripts(texts: list[str]) -> list[str]:
    """The script most letters of each text belong to, as Unicode names it."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4")
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    plain = points < 128
    latin = np.bincount(doc[plain & _LETTER[np.minimum(points, 127)]], minlength=len(texts))
    found: list[Counter] = [Counter({"LATIN": n}) if n else Counter() for n in latin.tolist()]
    first, inverse = distinct(doc[~plain].astype(np.int64) << 32 | points[~plain])
    for i, point, n in zip(doc[~plain][first].tolist(), points[~plain][first].tolist(), np.bincount(inverse, minlength=len(first)).tolist()):
        if point not in _NAMES:
            ch = chr(point)
            _NAMES[point] = unicodedata.name(ch, "UNKNOWN").split()[0] if ch.isalpha() else None
        if _NAMES[point]:
            found[i][_NAMES[point]] += n
    return [min(f, key=lambda s: (-f[s], s)) if f else "NONE" for f in found]


def script(text: str) -> str:
    return _scripts([text])[0]


_MEASURED = (
    "doc_id bigint, lang string, script string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, n_tokens bigint, n_pieces bigint, n_fallback bigint, piece_entropy double"
)


def _counted(texts: list[str]) -> list[tuple]:
    """The columns of ``_MEASURED`` from script on, for each text."""
    n = len(texts)
    encoded = [t.encode() for t in texts]
    data = b"\n".join(encoded)
    last = np.cumsum([len(t) + 1 for t in encoded])
    hashes, begins, ends = word_spans(data)
    doc = np.searchsorted(last, begins, side="right")
    keys = hashes ^ (ends - begins).astype(np.uint64)
    first, inverse = distinct(keys)
    table, byte_piece = _word_values()
    starts, sizes = table.ready(data, keys[first], begins[first], ends[first])
    n_tokens = np.bincount(doc, weights=table.pool[starts[inverse]], minlength=n).astype(np.int64)
    counts = sizes[inverse] - 1
    ids = table.pool[runs(starts[inverse] + 1, counts)].astype(np.int64)
    n_pieces = np.bincount(doc, weights=counts, minlength=n).astype(np.int64)
    cuts = np.concatenate([[0], np.cumsum(n_pieces)]).tolist()
    falls = np.concatenate([[0], np.cumsum(byte_piece[ids])])
    letters = np.frombuffer(data, np.uint8)
    edges = np.concatenate([[0], np.minimum(last, len(data))])

    def bytes_of(kind: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(kind)])[edges])

    word_chars = bytes_of(((letters & 0xC0) != 0x80) & ~BLANK[letters])
    columns = (
        _scripts(texts), np.bincount(doc, minlength=n).tolist(), word_chars.tolist(), bytes_of(_SYMBOL[letters]).tolist(),
        map(duplicate_lines, texts), _repeated(inverse, doc, n).tolist(), n_tokens.tolist(), n_pieces.tolist(),
        (falls[cuts[1:]] - falls[cuts[:-1]]).tolist(), [entropy(ids[x:y]) for x, y in zip(cuts[:-1], cuts[1:])],
    )
    return list(zip(*columns))


def measured(docs: DataFrame) -> DataFrame:
    """Counts, main script and fertility of each document of (doc_id, lang, text); where lang is
    null, the script in brackets stands for it."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in _MEASURED.split(", ")]
        kinds = {"lang": pa.string(), "script": pa.string(), "piece_entropy": pa.float64()}
        for batch in batches:
            numbers, langs = batch.column("doc_id").to_pylist(), batch.column("lang").to_pylist()
            rows = []
            for a, b, texts in text_slices(batch.column("text"), SLICE):
                for i, counts in zip(range(a, b), _counted(texts)):
                    letters = counts[0]
                    rows.append((numbers[i], langs[i] if langs[i] is not None else f"({letters})", *counts))
            columns = zip(*rows) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kinds.get(n, pa.int64())) for n, c in zip(names, columns)], names
            )

    picked = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text"
    )
    return picked.mapInArrow(measure, _MEASURED).withColumns(
        {
            "chars_per_piece": _share("word_chars", "n_pieces"),
            "chars_per_token": _share("word_chars", "n_tokens"),
            "fallback_share": _share("n_fallback", "n_pieces"),
        }
    )


def _share(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0))


def bands(rows: DataFrame) -> DataFrame:
    """For each language, each script, and all together (kind lang, script or all; name, null for
    all): number of documents and limits low_* and high_* of each measure, around the median by so
    many times the quartiles' distance, as a standard deviation. Under ``LEAST_DOCS`` documents
    tell less of it, so the band is wider by the root of what is missing. Quantiles come from counts of bins, so
    rows of a language are never gathered."""
    cells = F.explode(
        F.array(*[
            F.struct(F.lit(m).alias("measure"), F.round(F.col(m) * bins).cast("bigint").alias("bin"))
            for m, (bins, *_) in MEASURES.items()
        ])
    )
    counts = rows.select("lang", "script", cells.alias("cell")).groupBy("lang", "script", "cell.measure", "cell.bin").agg(
        F.count(F.lit(1)).alias("n")
    )
    counts = stored(counts)  # a row for each language, script, measure and bin
    kinds = F.explode(
        F.array(*[
            F.struct(F.lit(kind).alias("kind"), name.alias("name"))
            for kind, name in (("lang", F.col("lang")), ("script", F.col("script")), ("all", F.lit(None).cast("string")))
        ])
    )
    counts = counts.select(kinds.alias("of"), "measure", "bin", "n").groupBy("of.kind", "of.name", "measure", "bin").agg(
        F.sum("n").alias("n")
    )
    group = Window.partitionBy("kind", "name", "measure")
    upto = F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.withColumns({"upto": upto, "docs": F.sum("n").over(group)})

    def quantile(q: float) -> Column:
        return F.min(F.when(F.col("upto") >= F.col("docs") * q, F.col("bin")))

    found = ranked.groupBy("kind", "name", "measure").agg(
        F.max("docs").alias("docs"), quantile(0.25).alias("q1"), quantile(0.5).alias("q2"), quantile(0.75).alias("q3")
    )
    wider = F.greatest(F.lit(1.0), F.sqrt(F.lit(float(LEAST_DOCS)) / F.col("docs")))
    columns = []
    for measure, (bins, width, least, below, above) in MEASURES.items():
        reach = F.greatest((F.col("q3") - F.col("q1")) / F.lit(1.349 * bins), F.lit(least)) * width * wider
        here = F.col("measure") == measure
        low = F.col("q2") / bins - reach if below else F.lit(float("-inf"))
        high = F.col("q2") / bins + reach if above else F.lit(float("inf"))
        columns += [F.max(F.when(here, low)).alias(f"low_{measure}"), F.max(F.when(here, high)).alias(f"high_{measure}")]
    return found.groupBy("kind", "name").agg(F.max("docs").alias("docs"), *columns)


def judged(docs: DataFrame) -> DataFrame:
    """Adds base_failed, outside (the measures outside their band) and kept to ``measured``.

    Bands are learned from all documents that the base rules pass. A language of under
    ``LEAST_DOCS`` such documents (or a script, where lang is null) is judged by its own band and
    that of the text's script together: what is inside either passes, and no other script's
    documents count. Only texts without letters, which have no script, are judged by the band of all there. Null and
    empty texts fail by the base rules; repeated rows are judged each; an empty table gives no
    rows; other columns are ignored.
    """
    rows = stored(
        measured(docs).withColumn(
            "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
        )
    )
    limits = stored(bands(rows.where("not base_failed")))  # a row for each language and script
    sides = [f"{side}_{measure}" for measure in MEASURES for side in ("low", "high")]

    def of(kind: str) -> DataFrame:
        own = limits.where(F.col("kind") == kind)
        return own.select(F.col("name").alias(f"_{kind}"), F.col("docs").alias(f"_docs_{kind}"), *[F.col(c).alias(f"{c}_{kind}") for c in sides])

    every = limits.where(F.col("kind") == "all").first()
    met = rows.join(of("lang"), F.col("lang") == F.col("_lang"), "left").join(
        of("script"), F.col("script") == F.col("_script"), "left"
    )

    def limit(name: str, wider) -> Column:
        whole = F.lit(every[name] if every else None).cast("double")
        return (
            F.when(F.col("_docs_lang") >= LEAST_DOCS, F.col(f"{name}_lang"))
            .when(F.col("script") == "NONE", whole)
            .otherwise(wider(f"{name}_lang", f"{name}_script"))
        )

    outside = []
    for measure in MEASURES:
        low, high = limit(f"low_{measure}", F.least), limit(f"high_{measure}", F.greatest)
        outside.append(F.when((F.col(measure) < low) | (F.col(measure) > high), F.lit(measure)))
    return met.withColumn("outside", F.array_compact(F.array(*outside))).select(
        *[c for c in rows.columns if c != "script"], "outside", (~F.col("base_failed") & (F.size("outside") == 0)).alias("kept")
    )


def accepted(docs: DataFrame) -> DataFrame:
    """The documents that ``judged`` keeps, with all their columns. A verdict depends on text
    and language alone, so rows meet their verdict by the hash of both."""
    key = F.xxhash64("text", "lang", F.col("lang").isNull())
    verdicts = judged(docs.select(key.alias("doc_id"), "lang", "text"))
    good = verdicts.where("kept").select(F.col("doc_id").alias("_good")).distinct()
    return docs.join(good, key == F.col("_good"), "left_semi")
