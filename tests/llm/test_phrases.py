"""Phrase mining against brute force over whole texts, and the index against counted phrases."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from salesprism.llm import phrases, queries

UPPER = {i: i + 32 for i in range(65, 91)}


def plain_top(rows, least=30, share=80, most=2000):
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(UPPER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    found = {key: a for key, a in f.items() if a >= least}
    hidden = set()
    for (lang, p), a in found.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                if 100 * a >= share * f[lang, p[i : i + k]]:
                    hidden.add((lang, p[i : i + k]))
    by_lang: dict = {}
    for (lang, p), a in found.items():
        if len(p) > 1 and (lang, p) not in hidden:
            cuts = [(2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            by_lang.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    result = set()
    for lang, held in by_lang.items():
        for rank, (score, a, p, left, right) in enumerate(sorted(held)[:most], 1):
            result.add((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return result


def as_set(df):
    rows = [tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query_is_brute_force(spark, small, small_docs):
    expected = plain_top((r["lang"], r["text"]) for r in small_docs.select("lang", "text").collect())
    assert as_set(queries.queries()["op13_phrase_index"](spark, small)) == expected and len(expected) > 20


@pytest.mark.parametrize("shard", [50, 10**6])
def test_shards_of_any_size_give_the_same(spark, small_docs, shard, monkeypatch):
    rows = [(r["lang"], r["text"]) for r in small_docs.limit(60).collect()] + [("en", "A b. a B a b, a b a b")] * 7
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    monkeypatch.setattr(phrases, "SHARD", shard)
    monkeypatch.setattr(phrases, "CHUNK", 7)
    assert as_set(phrases.top(phrases.collocations(docs, least=3), 100_000)) == plain_top(rows, 3, most=100_000)


def test_awkward_rows(spark, awkward, nothing):
    rows = [(r["lang"], r["text"]) for r in awkward.collect()]
    assert as_set(phrases.top(phrases.collocations(awkward, least=2), 100_000)) == plain_top(rows, 2, most=100_000)
    assert phrases.top(phrases.collocations(nothing)).count() == 0
    empty = spark.createDataFrame([(None, None), ("en", ""), ("en", " .,\n")], "lang string, text string")
    assert phrases.collocations(empty).count() == 0


def test_repeats_and_overlaps(spark):
    rows = [("en", "x x x x x x. y x y"), ("en", "q r s q r s"), (None, "x x x"), ("und", "x x x"), ("xx", "a b c d " * 10)] * 3
    docs = spark.createDataFrame(rows, "lang string, text string")
    for least in (1, 3, 6, 30):
        assert as_set(phrases.top(phrases.collocations(docs, least=least), 1000)) == plain_top(rows, least, most=1000)


def test_many_neighbours_give_ranks_without_ties_lost(spark):
    random.seed(5)
    words = [f"w{i}" for i in range(12)]
    rows = [("en", " ".join(random.choices(words, k=40))) for _ in range(60)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert as_set(phrases.top(phrases.collocations(docs, least=5), 50)) == plain_top(rows, 5, most=50)


def test_intervals_hold_what_counting_finds():
    rng = np.random.default_rng(3)
    text = rng.integers(0, 5, 3000)
    text[-1] = 0
    text[0] = 1
    both = phrases.BothWays(text, 4)
    counts = Counter(tuple(text[i : i + k]) for k in (2, 3, 4) for i in range(len(text) - k + 1) if all(text[i : i + k]))
    two = both.left(*both.single)
    other = both.right(*both.single)
    for found in (two, other, both.left(*two), both.right(*two), both.left(*both.right(*other)), both.right(*both.left(*two))):
        got = {tuple(p): c for p, c in zip(found[0].tolist(), found[3].tolist(), strict=True)}
        assert len(got) == len(found[0]) and got == {p: c for p, c in counts.items() if len(p) == found[0].shape[1]}


def test_query_is_its_oracle(spark, folder, duck):
    from oracle import compare

    assert compare(queries.queries()["op13_phrase_index"](spark, folder), duck, queries.oracle_sql()["op13_phrase_index"]) > 200
