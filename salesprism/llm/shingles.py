"""Distinct word shingles of texts as sorted 64-bit hashes, computed on whole arrays of bytes."""

from __future__ import annotations

import numpy as np

WORDS = 5
PIECE = 1 << 18  # bytes hashed at once; longer words are hashed whole

_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xBF58476D1CE4E5B9)
_PLACE = _RANDOM.integers(1, 1 << 63, WORDS, dtype=np.uint64) | np.uint64(1)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads every bit over all 64."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_spans(data: bytes, blank: np.ndarray = _BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every word (run of bytes that are not ``blank``), where it begins and ends.

    A word's hash is the sum of one number for each byte, mixed from the byte and its place in the word. Sums
    of plain products would not do: some words have equal polynomials modulo 2^64 whatever the base is.
    """
    hashes, begins, ends, at = [], [], [], 0
    while at < len(data):
        end = len(data)
        if end - at > PIECE:
            cut = min((p for p in (data.find(c, at + PIECE) for c in (b" ", b"\n") if blank[c[0]]) if p >= 0), default=-1)
            end = cut + 1 if cut >= 0 else end
        letters = np.frombuffer(data, np.uint8, end - at, at)
        inside = ~blank[letters]
        edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
        begin, stop = edges[::2], edges[1::2]
        # the place of each byte in its word; what blanks get is left out of all sums
        place = np.arange(len(letters), dtype=np.uint64)
        starts = np.zeros(len(letters), dtype=np.uint64)
        starts[begin] = place[begin]
        np.maximum.accumulate(starts, out=starts)
        place -= starts
        place *= _STEP
        place += _BYTE[letters]
        place ^= place >> np.uint64(29)
        place *= _SPREAD
        place ^= place >> np.uint64(32)
        sums = np.zeros(len(letters) + 1, dtype=np.uint64)
        np.cumsum(place, out=sums[1:])
        hashes.append(mixed(sums[stop] - sums[begin]))
        begins.append(begin + at)
        ends.append(stop + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(begins), np.concatenate(ends)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word between ASCII white space, and where it begins."""
    return word_spans(data)[:2]


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``WORDS`` words, with A-Z in
    lower case; a shorter text has its whole sequence of words as one, one without words none."""
    lowered = [(t or "").encode().lower() for t in texts]
    words, places = word_hashes(b"\n".join(lowered))
    ends = np.cumsum([len(t) + 1 for t in lowered])
    doc = np.searchsorted(ends, places, side="right")
    counts = np.bincount(doc, minlength=len(texts))
    n = max(0, len(words) - WORDS + 1)
    runs = np.zeros(n, dtype=np.uint64)
    for k in range(WORDS):
        runs += words[k : k + n] * _PLACE[k]
    runs = mixed(runs)
    first = np.concatenate([[0], np.cumsum(counts)])
    sets = []
    for i, count in enumerate(counts.tolist()):
        a = first[i]
        if count >= WORDS:
            sets.append(np.unique(runs[a : a + count - WORDS + 1]))
        elif count:
            own = (words[a : a + count] * _PLACE[:count]).sum(dtype=np.uint64) + np.uint64(count)
            sets.append(mixed(np.array([own], dtype=np.uint64)))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets


def set_hash(shingles: np.ndarray) -> int:
    """A signed 64-bit hash of a set; sets with equal hashes count as equal."""
    spread = mixed(shingles ^ np.uint64(0x5851F42D4C957F2D))
    total = mixed(np.array([spread.sum(dtype=np.uint64) + np.uint64(len(shingles))], dtype=np.uint64))
    return int(total.view(np.int64)[0])
