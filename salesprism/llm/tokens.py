"""Public tokenizers applied in tasks: words are encoded once and kept, texts are joined from them."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from salesprism.llm.shingles import word_spans

#: Fixed value: the code points with Unicode's White_Space property.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0        "
    "        　"
)
#: A blank after other white space: a cut there would part a run of white space.
_BLANK_IN_RUN = re.compile(f"[{WHITE_SPACE}] ")

KEPT = 1_000_000  # encoded words kept by a Python worker, about; for speed, never for results
LONGEST = 64  # bytes; longer words are not kept


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file, as installed where the task runs."""
    import public_tokenizers

    return public_tokenizers.path(name)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct key, by ascending key, and for every key the number of its own."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    inverse = np.empty(len(keys), dtype=np.int64)
    inverse[order] = np.cumsum(new) - 1
    return order[new], inverse


def runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all runs, each from its start on, one run after the other."""
    shift = starts - (np.cumsum(sizes) - sizes)
    return np.arange(int(sizes.sum())) + np.repeat(shift, sizes)


def _both_ends(data: bytes, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last eight bytes of words, which with their length are all of a word up to 16."""
    padded = data + bytes(8)
    eight = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))
    lengths = ends - begins
    unused = (8 * (8 - np.minimum(lengths, 8))).astype(np.uint64)
    front = eight[begins] << (unused & np.uint64(63))
    return front, eight[np.maximum(ends - 8, begins)] << (unused & np.uint64(63))


class WordTable:
    """Values of words (some unsigned 32-bit integers each) in arrays, not objects. A word is known by
    its hash and length as key, and by both its ends. ``encode`` gives sizes and joined values of words
    that are spans of bytes; about ``kept`` words are held between calls."""

    def __init__(self, encode: Callable[[bytes, np.ndarray, np.ndarray], tuple], kept: int = KEPT) -> None:
        self.encode = encode
        self.kept = kept
        self.keys = np.zeros(0, dtype=np.uint64)  # ascending
        self.rows = np.zeros((0, 4), dtype=np.uint64)  # both ends, place in the pool, size
        self.pool = np.zeros(0, dtype="<u4")

    def _keep(self, rows: np.ndarray) -> None:
        self.keys, self.rows = self.keys[rows], self.rows[rows]
        starts, sizes = self.rows[:, 2].astype(np.int64), self.rows[:, 3].astype(np.int64)
        self.pool = self.pool[runs(starts, sizes)]
        self.rows[:, 2] = np.cumsum(sizes) - sizes

    def ready(self, data: bytes, keys: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each word's values start in ``pool``, until the next call, and their number; keys are distinct and ascend."""
        front, back = _both_ends(data, begins, ends)

        def met() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            at = np.searchsorted(self.keys, keys)
            if not len(self.keys):
                return at, np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
            near = np.minimum(at, len(self.keys) - 1)
            taken = self.keys[near] == keys
            return at, taken, taken & (self.rows[near, 0] == front) & (self.rows[near, 1] == back)

        at, taken, hit = met()
        if len(self.keys) > self.kept or len(self.pool) > 8 * self.kept:
            self._keep(at[hit])
            at, taken, hit = met()
        starts, sizes = np.empty(len(keys), dtype=np.int64), np.empty(len(keys), dtype=np.int64)
        starts[hit], sizes[hit] = self.rows[at[hit], 2], self.rows[at[hit], 3]
        new = np.flatnonzero(~hit)
        if len(new):
            found, values = self.encode(data, begins[new], ends[new])
            starts[new], sizes[new] = len(self.pool) + np.cumsum(found) - found, found
            self.pool = np.concatenate([self.pool, values])
            kept = new[(ends - begins)[new] <= LONGEST]
            kept = kept[~taken[kept]]  # another word may have the key
            self.keys = np.insert(self.keys, at[kept], keys[kept])
            rows = np.column_stack([front[kept], back[kept], starts[kept].astype(np.uint64), sizes[kept].astype(np.uint64)])
            self.rows = np.insert(self.rows, at[kept], rows, axis=0)
        return starts, sizes


def tokenizer(name: str):
    """The tokenizer in a file; strings of its special tokens are ordinary text."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(tokenizer_path(name))
    made.encode_special_tokens = True
    return made


_TABLES: dict[tuple[str, str], WordTable] = {}
_TOGETHER = 200  # new words encoded as one text, which spares most of a call's cost
_MARK = "\x01"
_APART = f" {_MARK} ".encode()


def _alone(made, texts: list[str]) -> list[bytes]:
    from array import array

    return [array("I", e.ids).tobytes() for e in made.encode_batch_fast(texts, add_special_tokens=False)]


def _joined(made, data: bytes, begins: np.ndarray, ends: np.ndarray, before: bytes, after: bytes) -> np.ndarray:
    """Ids of the words with ``before`` and ``after`` around each, some hundred words as one text."""
    lengths = ends - begins
    whole = lengths + len(before) + len(after)
    stops = np.cumsum(whole)
    text = np.empty(int(whole.sum()), dtype=np.uint8)
    for k, byte in enumerate(before):
        text[stops - whole + k] = byte
    for k, byte in enumerate(after):
        text[stops - len(after) + k] = byte
    text[runs(stops - whole + len(before), lengths)] = np.frombuffer(data, np.uint8)[runs(begins, lengths)]
    cuts = [0, *stops[_TOGETHER - 1 : -1 : _TOGETHER].tolist(), len(text)]
    raw = text.tobytes()
    texts = [raw[a:b].decode() for a, b in zip(cuts[:-1], cuts[1:])]
    return np.frombuffer(b"".join(_alone(made, texts)), dtype="<u4")


def _with_others(made, data: bytes, begins: np.ndarray, ends: np.ndarray, good: np.ndarray, joined: Callable, before: str):
    """Sizes and ids of all words: ``joined`` gives those of good ones, the others are encoded alone."""
    sizes, ids = joined(begins[good], ends[good]) if good.any() else (np.zeros(0, dtype=np.int64), np.zeros(0, dtype="<u4"))
    if good.all():
        return sizes, ids
    rest = _alone(made, [before + data[a:b].decode() for a, b in zip(begins[~good].tolist(), ends[~good].tolist())])
    every, starts = np.empty(len(good), dtype=np.int64), np.empty(len(good), dtype=np.int64)
    every[good], every[~good] = sizes, [len(x) // 4 for x in rest]
    starts[good] = np.cumsum(sizes) - sizes
    starts[~good] = len(ids) + np.cumsum(every[~good]) - every[~good]
    return every, np.concatenate([ids, np.frombuffer(b"".join(rest), dtype="<u4")])[runs(starts, every)]


_WHITE_ENDS = {n: [int.from_bytes(w.encode(), "big") for w in WHITE_SPACE if len(w.encode()) == n] for n in (1, 2, 3)}


def _ends_white(data: bytes, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether words end in white space, told by their last bytes."""
    letters = np.frombuffer(data, np.uint8)
    last, white = np.zeros(len(ends), dtype=np.int64), np.zeros(len(ends), dtype=bool)
    for n, codes in _WHITE_ENDS.items():
        last |= letters[np.maximum(ends - n, 0)].astype(np.int64) << (8 * (n - 1))
        white |= (ends - begins >= n) & np.isin(last, codes)
    return white


def spaced(made) -> Callable[[bytes, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Ids of words after a blank, for byte-level BPE: a token's length in bytes is that of
    its name, so running lengths tell where a word of a joined text ends."""
    names = made.get_vocab()
    length = np.zeros(max(names.values()) + 1, dtype=np.int64)
    for name, i in names.items():
        length[i] = len(name)

    def packed(data: bytes, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def joined(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            ids = _joined(made, data, begins, ends, b" ", b"")
            stops = np.searchsorted(np.cumsum(length[ids]), np.cumsum(ends - begins + 1)) + 1
            return np.diff(stops, prepend=0), ids

        # a word that ends in white space would take the next word's blank with it
        return _with_others(made, data, begins, ends, (ends > begins) & ~_ends_white(data, begins, ends), joined, " ")

    return packed


def _parted(made) -> Callable[[bytes, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Ids of words for tokenizers that drop white space: a control character between the
    words of a joined text is a token of its own, which no other text gives."""
    mark, = made.encode(_MARK, add_special_tokens=False).ids

    def packed(data: bytes, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def joined(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            ids = _joined(made, data, begins, ends, b"", _APART)
            marks = np.flatnonzero(ids == mark)
            return np.diff(marks, prepend=-1) - 1, ids[ids != mark]

        marked = np.concatenate([[0], np.cumsum(np.frombuffer(data, np.uint8) == ord(_MARK))])
        return _with_others(made, data, begins, ends, marked[ends] == marked[begins], joined, "")

    return packed


def _table(name: str, kind: str) -> WordTable:
    """Ids of words after a blank ("spaced"), or of words for which white space doesn't matter ("parted")."""
    if (name, kind) not in _TABLES:
        _TABLES[name, kind] = WordTable({"spaced": spaced, "parted": _parted}[kind](_made(name)))
    return _TABLES[name, kind]


@cache
def _made(name: str):
    return tokenizer(name)


def _gathered(table: WordTable, data: bytes, spans: tuple, texts: int, doc: np.ndarray) -> list[bytes]:
    """The joined ids of each text's words. Equal words, by hash and length, are looked up once;
    ``doc`` has each word's text."""
    hashes, begins, ends = spans
    keys = hashes ^ (ends - begins).astype(np.uint64)
    first, inverse = distinct(keys)
    starts, sizes = table.ready(data, keys[first], begins[first], ends[first])
    counts = sizes[inverse]
    ids = table.pool[runs(starts[inverse], counts)].tobytes()
    cuts = np.concatenate([[0], np.cumsum(np.bincount(doc, weights=counts, minlength=texts))]).astype(np.int64) * 4
    return [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def byte_level_ids(name: str, texts: list[str]) -> list[bytes]:
    """Ids of every text as little-endian unsigned 32-bit integers, for byte-level BPE
    whose tokens hold white space only at their front.

    Such tokens end before any blank that follows a character other than white space,
    so what lies between two such blanks can be encoded alone. The few texts with a blank
    inside a run of white space are encoded whole.
    """
    plain = [not _BLANK_IN_RUN.search(t) for t in texts]
    heads = [t.split(" ", 1)[0] if good else t for t, good in zip(texts, plain)]
    wanted = list({*heads, " "})
    whole = dict(zip(wanted, _alone(_made(name), wanted)))
    encoded = [t.encode() if good else b"" for t, good in zip(texts, plain)]
    data = b" ".join(encoded)
    lengths = np.array([len(t) for t in encoded], dtype=np.int64)
    starts = np.cumsum(lengths + 1) - lengths - 1
    only_blank = np.zeros(256, dtype=bool)
    only_blank[32] = True
    hashes, begins, ends = word_spans(data, only_blank)
    doc = np.searchsorted(starts, begins, side="right") - 1
    later = begins != starts[doc] if len(doc) else np.zeros(0, dtype=bool)
    spans = hashes[later], begins[later], ends[later]
    rest = _gathered(_table(name, "spaced"), data, spans, len(texts), doc[later])
    return [
        whole[head] + ids + (whole[" "] if good and text.endswith(" ") else b"")
        for head, ids, text, good in zip(heads, rest, texts, plain)
    ]


def word_level_ids(name: str, texts: list[str]) -> list[bytes]:
    """The same for tokenizers that drop white space and never join words over it."""
    encoded = [t.encode() for t in texts]
    data = b"\n".join(encoded)
    spans = word_spans(data)
    last = np.cumsum([len(t) + 1 for t in encoded])
    doc = np.searchsorted(last, spans[1], side="right")
    return _gathered(_table(name, "parted"), data, spans, len(texts), doc)


def slices(texts: list[str | None], size: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Runs of neighbouring texts of about ``size`` characters, as (first, end)."""
    first = held = 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held >= size:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def _trim() -> None:
    """Hands freed memory back to the system, which glibc would keep in the worker for later tasks."""
    import ctypes

    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_slices(column: pa.Array, size: int = 4_000_000) -> Iterator[tuple[int, int, list[str]]]:
    """Runs of neighbouring texts of about ``size`` bytes, as (first, end, texts), null as empty. Only one
    run at a time is held as strings."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < len(column):
        reach = (int(ends[first - 1]) if first else 0) + size
        end = min(int(np.searchsorted(ends, reach)) + 1, len(column))
        yield first, end, [t or "" for t in column.slice(first, end - first).to_pylist()]
        first = end
    _trim()
