"""Packing, token codes, mixtures and the pipeline."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

import corpus_pipeline
import plain
from salesprism.llm import mixing, packing, token_codes
from salesprism.llm.queries import queries
from salesprism.llm.tokens import byte_level_ids, tokenizer, word_level_ids

ODD = [
    "", " ", "a  b\n\n c  x \t z  ", "\x1c a\x1cb \x85 q", "I'm 'll  it's\r\n 'S x", "é ́x ΑΣ ΣΑΣ. İstanbul ①② ﬁ",
    "<|endoftext|> </w> <|startoftext|>x", "\x01 \x01\x01 a\x01", "nb  sp 　 　x", "Word, word. WORD! 1,000.5 x" * 50, "y" * 300,
]


def packed_ids(name, texts):
    encoded = tokenizer(name).encode_batch(texts, add_special_tokens=False)
    return [np.array(e.ids, dtype="<u4").tobytes() for e in encoded]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(" \n\tabZé.,'!1 ́\x01\x1cΣ"), max_size=30), max_size=5))
def test_words_give_the_texts_ids(texts):
    assert byte_level_ids("byte_bpe_50k.json", texts) == packed_ids("byte_bpe_50k.json", texts)
    assert word_level_ids("word_bpe_49k.json", texts) == packed_ids("word_bpe_49k.json", texts)


def test_texts_ids(small_docs):
    texts = ODD + [r["text"] for r in small_docs.collect()]
    assert byte_level_ids("byte_bpe_50k.json", texts) == packed_ids("byte_bpe_50k.json", texts)
    assert word_level_ids("word_bpe_49k.json", texts) == packed_ids("word_bpe_49k.json", texts)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=6), st.integers(1, 17), st.data())
def test_rounds_serve_everything_once(tokens, length, data):
    quanta = data.draw(st.one_of(st.none(), st.lists(st.integers(1, 9), min_size=len(tokens), max_size=len(tokens))))
    rounds = packing.Rounds(tokens, quanta)
    slots = np.arange(rounds.total + 1)
    served = np.stack([rounds.served(q, slots)[0] for q in range(len(tokens))])
    assert (served.sum(axis=0) == slots).all() and (np.diff(served) >= 0).all()
    assert served[:, -1].tolist() == tokens
    if quanta is None:
        share = np.array(tokens)[:, None] * slots / rounds.total
        assert (abs(served - share) < 4).all()
    used = defaultdict(list)
    for q, n in enumerate(tokens):
        doc, first, count, window, offset = rounds.pieces(q, np.array([0, n // 2]), np.array([n // 2, n - n // 2]) if n > 1 else np.array([1, 1]), length) if n > 1 else rounds.pieces(q, np.array([0]), np.array([1]), length)
        for w, o, c in zip(window, offset, count):
            used[int(w)].append((int(o), int(c)))
    for w, spans in used.items():
        at = 0
        for o, c in sorted(spans):
            assert o == at
            at += c
        assert at == min(length, rounds.total - w * length)


def test_scaled_is_exact():
    big = 10**16 + 7
    n = np.array([0, 1, 12345678901234567, 10**16], dtype=np.int64)
    assert packing.scaled(n, 10**15 + 3, big).tolist() == [int(x) * (10**15 + 3) // big for x in n]


def check_pieces(rows, texts):
    ids = dict(zip(texts, packed_ids("byte_bpe_50k.json", list(texts.values()))))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == set(texts)
    for doc, own in by_doc.items():
        whole, at = ids[doc] + np.array([1], "<u4").tobytes(), 0
        for r in sorted(own, key=lambda r: r["start"]):
            part = whole[4 * at : 4 * (at + r["length"])]
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(part) and r["doc_tokens"] == len(whole) // 4
            at += r["length"]
        assert at == len(whole) // 4
    lengths = []
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        lengths.append(at)
    assert sum(n < packing.LENGTH for n in lengths) <= 1 and max(lengths) <= packing.LENGTH


def test_op7(spark, small, small_docs):
    rows = queries()["op7_mixture_packing"](spark, small).collect()
    check_pieces(rows, {r["doc_id"]: r["text"] for r in small_docs.collect()})
    full = defaultdict(dict)
    for r in rows:
        own = full[r["sequence_id"]]
        own[r["source"]] = own.get(r["source"], 0) + r["length"]
    last = max(full)
    for source in full[0]:
        counts = [w.get(source, 0) for k, w in full.items() if k != last]
        assert max(counts) - min(counts) <= 6  # a token for each level of the tree, at both borders


def test_packing_awkward(awkward, nothing):
    rows = packing.packed(awkward).collect()
    assert sum(r["length"] for r in rows) == sum(len(x) // 4 + 1 for x in packed_ids("byte_bpe_50k.json", [r["text"] or "" for r in awkward.collect()]))
    assert packing.packed(nothing).count() == 0
    weighted = packing.packed(awkward, quanta={"a": 5, "c": 1}).collect()
    assert sum(r["length"] for r in weighted) == sum(r["length"] for r in rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=1500), st.integers(0, 20))
def test_codes_round_trip(values, shift):
    ids = np.array(values, dtype=np.uint32) >> np.uint32(shift)
    block = token_codes.Block(token_codes.encode_block([7, None], [len(ids) // 2, len(ids) - len(ids) // 2], ids))
    assert block.tokens().tolist() == ids.tolist() and block.doc_ids == [7, None]
    for i in range(0, len(ids), 37):
        assert block.token(i) == ids[i]


def test_op8(spark, small, small_docs):
    docs = sorted((r["doc_id"], r["text"]) for r in small_docs.collect())
    found = {r["doc_id"]: r for r in queries()["op8_addressable_codes"](spark, small).collect()}
    at = 0
    for (doc, _), ids in zip(docs, packed_ids("word_bpe_49k.json", [t for _, t in docs])):
        whole = ids + np.array([2], "<u4").tobytes()
        r = found[doc]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(whole) // 4, zlib.crc32(whole))
        at += len(whole) // 4


def test_codes_over_blocks(awkward, nothing, monkeypatch):
    monkeypatch.setattr(token_codes, "BLOCK", 50)
    found = token_codes.read_back(token_codes.written(awkward)).collect()
    assert len(found) == awkward.count()
    ends = sorted((r["start"], r["start"] + r["n_tokens"]) for r in found)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    ids = [r["doc_id"] for r in sorted(found, key=lambda r: r["start"])]
    assert ids[:2] == [None, None] and ids[2:] == sorted(ids[2:])
    assert token_codes.read_back(token_codes.written(nothing)).count() == 0


def check_mix(rows):
    """rows: (source, size, source_size, target, taken)."""
    sources = defaultdict(list)
    for r in rows:
        sources[r["source"]].append(r)
    names = sorted((s for s in sources if s is not None), key=lambda s: s.encode()) + [None] * (None in sources)
    sizes = [sum(r["size"] for r in sources[s]) for s in names]
    filled = [k for k, n in enumerate(sizes) if n]
    targets = plain.water_filled(1.5 * sum(sizes), [((3, 1, 2)[k % 3], 2 * sizes[k]) for k in filled])
    want = dict(zip((names[k] for k in filled), targets))
    for s, size in zip(names, sizes):
        for r in sources[s]:
            assert r["source_size"] == size and r["target"] == pytest.approx(want.get(s, 0.0))
            assert 0 <= r["copies"] <= 2
        taken = sum(r["copies"] * r["size"] for r in sources[s])
        assert abs(taken - want.get(s, 0.0)) <= max(r["size"] for r in sources[s])


def test_op10(spark, folder, small):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    sizes = {r["doc_id"]: len(plain.words(r["text"])) for r in docs.collect()}
    rows = mixing.mix_documents(docs).collect()
    assert {r["doc_id"]: r["size"] for r in rows} == sizes
    check_mix(rows)
    # the split into partitions does not matter
    again = mixing.mix_documents(docs.repartition(7)).collect()
    assert sorted((r["doc_id"], r["copies"]) for r in rows) == sorted((r["doc_id"], r["copies"]) for r in again)
    assert queries()["op10_pareto_mixture"](spark, small).columns == ["doc_id", "size", "source_size", "target", "taken"]


def test_unequal_probabilities(spark):
    """Longer documents are likelier in the sample, as their propensity says."""
    rows = [(k, f"s{k % 2}", 1000 if k % 4 < 2 else 2, f"k{k}") for k in range(8000)]
    found = mixing.mixed(spark.createDataFrame(rows, "doc_id bigint, source string, size bigint, key string"), share=0.4)
    means = {(r["source"], r["size"]): (r["e"], r["c"]) for r in found.groupBy("source", "size").agg({"expected": "avg", "copies": "avg"}).toDF("source", "size", "e", "c").collect()}
    for (source, size), (expected, copies) in means.items():
        assert copies == pytest.approx(expected, abs=0.06)
    assert means["s0", 1000][0] > means["s0", 2][0]


def test_mix_awkward(awkward, nothing):
    rows = mixing.mix_documents(awkward).collect()
    assert len(rows) == awkward.count()
    check_mix(rows)
    assert mixing.mix_documents(nothing).count() == 0
    mix = mixing.repeated(awkward)
    assert mix.columns == awkward.columns
    assert mix.count() == sum(r["copies"] for r in rows)
    assert mixing.repeated(nothing).count() == 0


def test_pipeline(spark, small, small_docs):
    docs = small_docs
    left = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, small)
        assert found.columns == docs.columns, name
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = spark.createDataFrame(found.collect(), found.schema)
        after = docs.collect()
        left.append(len(after))
        if name in ("quality", "near copies"):
            assert len(after) <= left[-2]
            assert all(before[r["doc_id"]] == r for r in after)
        if name == "near copies":
            groups = plain.jaccard_components([(i, r["text"]) for i, r in before.items()])
            assert {r["doc_id"] for r in after} == {c for _, c in groups.values()}
        if name == "personal data":
            assert all(not plain.private_spans(r["text"]) for r in after)
    texts = defaultdict(int)
    for r in docs.collect():
        texts[r["doc_id"]] += 1
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, small).collect()
    total = sum(len(x) // 4 + 1 for x in packed_ids("byte_bpe_50k.json", [r["text"] for r in docs.collect()]))
    assert sum(r["length"] for r in pieces) == total
    assert corpus_pipeline.run(spark, small).columns == list(pieces[0].asDict())


def test_words_with_equal_polynomials_stay_apart(spark):
    """Two words whose byte polynomials are equal modulo 2^64 for every base: the Thue-Morse word and its complement."""
    from salesprism.llm import shingles, tokens

    a, b = "a", "b"
    for _ in range(10):
        a, b = a + b, b + a
    assert len(a) == 1024 and len(set(shingles.word_hashes(f"{a} {b}".encode())[0].tolist())) == 2
    one, two = shingles.shingle_sets([a, b])
    assert set(one.tolist()).isdisjoint(two.tolist())
    for name, ids in (("byte_bpe_50k.json", tokens.byte_level_ids), ("word_bpe_49k.json", tokens.word_level_ids)):
        made = tokens.tokenizer(name)
        texts = [f"x {a}", f"x {b}", a, b]
        expected = [np.array(made.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
        assert ids(name, texts) == expected


@pytest.mark.parametrize("kind, name", [("spaced", "byte_bpe_50k.json"), ("parted", "word_bpe_49k.json")])
def test_word_table_keeps_words_in_arrays(kind, name):
    """Values are right where words return, are dropped, are too long to keep or share a key, and a
    word that is kept isn't encoded again."""
    from salesprism.llm import tokens

    made, encoded = tokens.tokenizer(name), []
    encode = {"spaced": tokens.spaced, "parted": tokens._parted}[kind](made)

    def counting(data, begins, ends):
        encoded.extend(data[a:b].decode() for a, b in zip(begins.tolist(), ends.tolist()))
        return encode(data, begins, ends)

    table = tokens.WordTable(counting, kept=30)
    common = ["a", "word,", "nb\xa0", "e　", "é\x85", "\x01", "x\x01y", "\U0001f600x", "eightchr", "seventeen letters"[:9], "y" * 300]
    for turn in range(6):
        words = common + [f"w{turn}{k}" for k in range(12)]
        data = " ".join(words).encode()
        ends = np.cumsum([len(w.encode()) + 1 for w in words]) - 1
        begins = ends - [len(w.encode()) for w in words]
        # two words of each turn have keys that words of the first turn took
        keys = np.arange(len(words), dtype=np.uint64) + np.uint64(100 * turn) * (np.arange(len(words)) >= len(common) + 2).astype(np.uint64)
        order = np.argsort(keys)
        starts, sizes = table.ready(data, keys[order], begins[order], ends[order])
        for i, start, size in zip(order.tolist(), starts.tolist(), sizes.tolist()):
            text = " " + words[i] if kind == "spaced" else words[i]
            assert table.pool[start : start + size].tolist() == made.encode(text, add_special_tokens=False).ids
        assert len(table.keys) <= 30 + len(words) and (np.diff(table.keys.astype(np.int64)) > 0).all()
    assert encoded.count("eightchr") == 1 and encoded.count("y" * 300) == 6


def test_a_batch_of_texts_is_not_held_as_strings_at_once():
    import pyarrow as pa

    from salesprism.llm.tokens import text_slices

    texts = ["ab", None, "", "é" * 30, "x" * 100, "y", None]
    for column in (pa.array(texts, pa.string()), pa.array(["skipped", *texts], pa.string()).slice(1)):
        for size in (1, 10, 60, 10_000):
            found = list(text_slices(column, size))
            assert [t for _, _, own in found for t in own] == [t or "" for t in texts]
            assert [a for a, _, _ in found] == [0, *[b for _, b, _ in found[:-1]]] and found[-1][1] == len(texts)
            assert all(sum(len(t.encode()) for t in own[:-1]) < size for _, _, own in found)
    assert list(text_slices(pa.array([], pa.string()))) == []
