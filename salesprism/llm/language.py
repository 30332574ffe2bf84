"""Language of texts by a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from salesprism.llm.tokens import slices

WINDOW = 96  # bytes that the network reads at once, from both ends
HIDDEN = 12  # units of each direction
PER_LANGUAGE = 400  # bound on the documents of a language that the network is fitted on
PER_DOCUMENT = 6  # bound on the windows taken of one document, spread over its whole text
STEPS, BATCH, RATE = 300, 256, 0.02
TOGETHER = 2048  # windows read at once
SLICE = 2_000_000  # characters of texts held at once
_WORD_SIGN = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    """Whether any character is a letter; numerals such as superscripts are none."""
    return any(m[0].isalpha() for m in _WORD_SIGN.finditer(text or ""))


def windows(texts: list[bytes], width: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts cut at windows (rows), the last one of each filled up with 0; the text and the
    number of bytes of each window."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    counts = -(-sizes // width)
    data = b"".join(t + bytes(int(c) * width - len(t)) for t, c in zip(texts, counts))
    owner = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.frombuffer(data, np.uint8).reshape(-1, width), owner, np.minimum(width, sizes[owner] - place * width)


class Network:
    """Two gated recurrent layers, one in each direction, and a softmax at every position.

    ``x`` is the gates' input for each byte, ``u`` their recurrent weights: rows are the
    update gate, the reset gate and the candidate; the last index of states is the window.
    """

    def __init__(self, classes: int, hidden: int = HIDDEN, seed: int = 1) -> None:
        random = np.random.default_rng(seed)
        self.hidden = hidden
        self.weights = {
            "out": random.normal(0, 0.1, (classes, 2 * hidden)),
            "bias": np.zeros((classes, 1)),
        }
        for way in ("ahead", "back"):
            self.weights[f"x_{way}"] = random.normal(0, 0.3, (3 * hidden, 256))
            self.weights[f"u_{way}"] = random.normal(0, hidden**-0.5, (3 * hidden, hidden))
        self.weights = {k: w.astype(np.float32) for k, w in self.weights.items()}

    def _step(self, way: str, letters: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        n = self.hidden
        given = self.weights[f"x_{way}"].take(letters, axis=1)
        old = self.weights[f"u_{way}"] @ h
        gates = given[: 2 * n]
        gates += old[: 2 * n]
        np.negative(gates, out=gates)
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        update, reset = gates[:n], gates[n:]
        new = given[2 * n :]
        new += reset * old[2 * n :]
        np.tanh(new, out=new)
        return new + update * (h - new), update, reset, new, old[2 * n :]

    def _run(self, way: str, rows: np.ndarray, keep: bool = False) -> list:
        order = range(rows.shape[1]) if way == "ahead" else range(rows.shape[1] - 1, -1, -1)
        h = np.zeros((self.hidden, len(rows)), dtype=np.float32)
        found: list = [None] * rows.shape[1]
        columns = np.ascontiguousarray(rows.T)
        for t in order:
            before = h
            h, *inner = self._step(way, columns[t], h)
            found[t] = (h, before, *inner) if keep else h
        return found

    def _softmax(self, ahead: np.ndarray, back: np.ndarray) -> np.ndarray:
        n, out = self.hidden, self.weights["out"]
        scores = out[:, :n] @ ahead + out[:, n:] @ back + self.weights["bias"]
        scores -= scores.max(axis=0)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=0)
        return scores

    def labels(self, rows: np.ndarray) -> Iterator[np.ndarray]:
        """Probabilities (class, window) at each position in turn, from the last to the first."""
        ahead = self._run("ahead", rows)
        columns = np.ascontiguousarray(rows.T)
        h = np.zeros((self.hidden, len(rows)), dtype=np.float32)
        for t in range(rows.shape[1] - 1, -1, -1):
            h = self._step("back", columns[t], h)[0]
            yield self._softmax(ahead[t], h)

    def summed(self, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Sum of the probabilities over each window's positions: (window, class)."""
        total = np.zeros((len(self.weights["bias"]), len(rows)), dtype=np.float32)
        for back, chances in enumerate(self.labels(rows)):
            total += chances * (sizes > rows.shape[1] - 1 - back)
        return total.T

    def gradients(self, rows: np.ndarray, sizes: np.ndarray, target: np.ndarray) -> tuple[float, dict]:
        """Mean cross entropy over all positions, and its gradients by backpropagation through time."""
        n, width = self.hidden, rows.shape[1]
        states = {way: self._run(way, rows, keep=True) for way in ("ahead", "back")}
        found = {k: np.zeros_like(w) for k, w in self.weights.items()}
        out, total, loss = self.weights["out"], sizes.sum(), 0.0
        coming: dict = {"ahead": [None] * width, "back": [None] * width}
        for t in range(width):
            a, b = states["ahead"][t][0], states["back"][t][0]
            chances = self._softmax(a, b)
            inside = (sizes > t).astype(np.float32) / total
            loss -= float((np.log(chances[target, np.arange(len(rows))] + 1e-12) * inside).sum())
            chances[target, np.arange(len(rows))] -= 1
            chances *= inside
            found["out"] += chances @ np.concatenate([a, b]).T
            found["bias"] += chances.sum(axis=1, keepdims=True)
            coming["ahead"][t], coming["back"][t] = out[:, :n].T @ chances, out[:, n:].T @ chances
        for way in ("ahead", "back"):
            u = self.weights[f"u_{way}"]
            later = np.zeros((n, len(rows)), dtype=np.float32)
            inputs = np.zeros((3 * n, width, len(rows)), dtype=np.float32)
            for t in range(width - 1, -1, -1) if way == "ahead" else range(width):
                _, before, update, reset, new, old = states[way][t]
                slope = coming[way][t] + later
                d_new = slope * (1 - update) * (1 - new * new)
                d_update = slope * (before - new) * update * (1 - update)
                d_reset = d_new * old * reset * (1 - reset)
                recurrent = np.concatenate([d_update, d_reset, d_new * reset])
                found[f"u_{way}"] += recurrent @ before.T
                later = slope * update + u.T @ recurrent
                inputs[:, t] = np.concatenate([d_update, d_reset, d_new])
            letters = rows.T.ravel()
            for k in range(3 * n):
                found[f"x_{way}"][k] = np.bincount(letters, weights=inputs[k].ravel(), minlength=256)
        return loss, found

    def fit(self, rows: np.ndarray, sizes: np.ndarray, target: np.ndarray, seed: int = 2) -> "Network":
        """Adam on batches with as many windows of each class."""
        random = np.random.default_rng(seed)
        by_class = [np.flatnonzero(target == k) for k in range(len(self.weights["bias"]))]
        mean = {k: np.zeros_like(w) for k, w in self.weights.items()}
        square = {k: np.zeros_like(w) for k, w in self.weights.items()}
        for step in range(1, STEPS + 1):
            kinds = random.permutation(BATCH) % len(by_class)
            picked = np.array([random.choice(by_class[k]) for k in kinds])
            _, slopes = self.gradients(rows[picked], sizes[picked], target[picked])
            rate = RATE * (1 - step / (STEPS + 1))
            for k, slope in slopes.items():
                mean[k] += 0.1 * (slope - mean[k])
                square[k] += 0.01 * (slope * slope - square[k])
                scaled = (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
                self.weights[k] -= (rate * scaled).astype(np.float32)
        return self


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE, seed: int = 3) -> list[tuple[str, bytes]]:
    """At most ``per_language`` documents of each language of (doc_id, lang, text), those with
    the least hashes, as at most ``PER_DOCUMENT`` windows each, spread over the whole text."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    usable = usable.select("lang", "text", F.xxhash64("doc_id", "text", F.lit(seed)).alias("hash"))
    share = F.least(F.lit(1.0), F.lit(1.3 * per_language + 50) / F.count(F.lit(1)))
    limits = usable.groupBy(F.col("lang").alias("_lang")).agg(share.alias("share"))  # a row for each language
    near = usable.join(limits, F.col("lang") == F.col("_lang")).where(
        F.col("hash").cast("double") / 2.0**64 + 0.5 < F.col("share")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for lang, text, key in zip(*[batch.column(c).to_pylist() for c in ("lang", "text", "hash")]):
                data = text.encode()
                random = np.random.default_rng(key & (2**63 - 1))
                starts = random.choice(max(1, len(data) - WINDOW // 2), min(PER_DOCUMENT, max(1, len(data) // WINDOW)), replace=False)
                rows.append((lang, key, [data[s : s + WINDOW] for s in sorted(starts.tolist())]))
            columns = zip(*rows) if rows else ([], [], [])
            kinds = [pa.string(), pa.int64(), pa.list_(pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["lang", "hash", "cuts"])

    found = near.select("lang", "text", "hash").mapInArrow(cut, "lang string, hash bigint, cuts array<binary>").collect()
    taken: dict = {}
    for row in sorted(found, key=lambda r: (r["lang"], r["hash"])):
        own = taken.setdefault(row["lang"], [])
        if len(own) < per_language:
            own.append([bytes(c) for c in row["cuts"]])
    return [(lang, c) for lang, rows in taken.items() for cuts in rows for c in cuts]


def fitted(examples: list[tuple[str, bytes]]) -> tuple[Network | None, list[str]]:
    languages = sorted({lang for lang, _ in examples})
    if not languages:
        return None, []
    rows, owner, sizes = windows([cut for _, cut in examples])
    target = np.array([languages.index(lang) for lang, _ in examples])[owner]
    return Network(len(languages)).fit(rows, sizes, target), languages


def predicted(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """Language of each document of (doc_id, lang, text): held_out, lang_pred and score, the
    mean over all bytes of the network's probability for that language.

    The network learns from documents whose crc32(doc_id as text) mod 5 is not 0 and whose
    lang is known; a null doc_id is learned from. A text is read in windows of ``WINDOW``
    bytes, in both directions, to its end. Null texts and texts without a letter are ``und``
    with score 0, as all are where nothing is labelled; repeated rows are labelled each; an
    empty table gives no rows; other columns are ignored.
    """
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text", held.alias("held_out")
    )
    network, languages = fitted(sample(rows.where("not held_out"), per_language))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            names, scores = ["und"] * len(texts), np.zeros(len(texts))
            for a, b in slices(texts, SLICE):
                own = [i for i in range(a, b) if has_letter(texts[i])] if languages else []
                data = [texts[i].encode() for i in own]
                if not own:
                    continue
                cuts, owner, sizes = windows(data)
                total = np.zeros((len(own), len(languages)))
                for x in range(0, len(cuts), TOGETHER):
                    part = slice(x, x + TOGETHER)
                    np.add.at(total, owner[part], network.summed(cuts[part], sizes[part]))
                best = total.argmax(axis=1)
                for k, i in enumerate(own):
                    names[i] = languages[best[k]]
                    scores[i] = min(1.0, total[k, best[k]] / len(data[k]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores)],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return rows.select("doc_id", "text", "held_out").mapInArrow(
        label, "doc_id bigint, held_out boolean, lang_pred string, score double"
    )
