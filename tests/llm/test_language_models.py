"""Fertility, context tree weighting and the byte network."""

import numpy as np
import pytest

import plain
from salesprism.llm import context_tree, fertility, language
from salesprism.llm.queries import queries
from salesprism.llm.tokens import tokenizer


def test_base_counts(awkward):
    found = fertility.judged(awkward).collect()
    assert len(found) == awkward.count()
    by_id = {r["doc_id"]: r for r in found}
    for row in awkward.collect():
        text, r = row["text"] or "", by_id[row["doc_id"]]
        words = plain.words(text)
        windows = list(zip(words, words[1:], words[2:]))
        covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)} if len(words) < 500 else None
        assert (r["n_words"], r["word_chars"]) == (len(words), sum(len(w.decode()) for w in words))
        if covered is not None:
            assert r["n_repeat_words"] == len(covered)
            assert r["base_failed"] == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
        assert not (r["base_failed"] and r["kept"])
    assert by_id[15]["lang"] == "(CJK)" and by_id[15]["n_fallback"] >= 0


def test_empty_table(nothing):
    assert fertility.judged(nothing).count() == 0
    assert fertility.accepted(nothing).columns == nothing.columns
    assert context_tree.scored(nothing).count() == 0
    assert language.predicted(nothing).count() == 0


def test_symbols_and_lines():
    assert fertility.duplicate_lines("a\n\n \na\nb\na ") == 1
    assert fertility.repeated_words("a b c a b c x".split()) == 6
    assert fertility.entropy(np.arange(256)) == pytest.approx(1.0)
    assert fertility.entropy(np.zeros(600, dtype=np.int64)) == 0.0


def test_junk_is_outside_the_bands(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    verdicts = fertility.judged(docs).where("not base_failed").join(labels, "doc_id").select("quality", "kept").collect()
    good = [r["kept"] for r in verdicts if r["quality"] == 1]
    bad = [r["kept"] for r in verdicts if r["quality"] == 0]
    assert sum(good) >= 0.99 * len(good)
    assert sum(bad) < 0.8 * len(bad)


RARE = {
    "el": "η θάλασσα είναι ήρεμη σήμερα και τα παιδιά παίζουν στην άμμο ενώ οι γονείς τους διαβάζουν βιβλία κάτω από το δέντρο "
    "ο δρόμος προς χωριό περνά μέσα παλιό δάσος όπου πουλιά τραγουδούν κάθε πρωί μας φέρνει ψωμί τυρί ελιές κρασί γείτονας",
    "hi": "आज सुबह बाज़ार में बहुत भीड़ थी और लोग ताज़ा फल सब्ज़ियाँ खरीद रहे थे जबकि बच्चे पास के मैदान खेल बारिश शुरू होने से पहले सब अपने घर लौट गए "
    "नदी किनारे पुराना मंदिर है जहाँ हर साल मेला लगता दूर गाँवों यात्री आते संगीत सुनते मिठाई खाते कहानियाँ",
    "ko": "오늘 아침 시장에는 사람들이 매우 많았고 아이들은 운동장에서 공을 차며 놀았다 비가 오기 전에 모두 집으로 돌아갔다 강가에는 오래된 절이 있는데 해마다 "
    "축제가 열리고 먼 마을에서 손님들이 찾아온다 음악을 듣고 떡을 먹으며 옛날 이야기를 나눈다 밤하늘 별빛 아래 조용히 걷는다",
}


@pytest.mark.parametrize("named", [True, False])
def test_rare_scripts_have_no_band_of_others(spark, named):
    random, rows = np.random.default_rng(4), []
    for lang, text in RARE.items():
        for _ in range(3):
            words = text.split()
            rows.append((1_000_000 + len(rows), " ".join(random.permutation(words * 2)), lang if named else None))
    rows += [(2_000_000, " ".join(f"{k % 7}{'#' * 40}" for k in random.permutation(400)), "tlh" if named else None)]
    english = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang = 'en'").select("doc_id", "text", "lang")
    docs = english.unionByName(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    found = {r["doc_id"]: r for r in fertility.judged(docs).where("doc_id >= 1000000").collect()}
    for i, _, lang in rows[:-1]:
        assert not found[i]["base_failed"] and found[i]["outside"] == [] and found[i]["kept"], (lang, found[i])
    assert not found[2_000_000]["kept"]


def test_accepted_keeps_rows_and_columns(awkward):
    kept = fertility.accepted(awkward)
    assert kept.columns == awkward.columns
    verdicts = fertility.judged(awkward)
    assert kept.count() == verdicts.where("kept").count()


def test_context_tree_matches_plain(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    base = plain.unigrams(rows)
    texts = dict(rows)
    score = plain.context_tree([context_tree.canonical(texts[i]) for i in texts if not base[i][0]], context_tree.DEPTH)
    found = queries()["op2_context_tree"](spark, small).collect()
    assert len(found) == len(rows)
    for r in found:
        held, tokens, known, total, unigram = base[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, tokens, known, total)
        assert r["base_score"] == pytest.approx(unigram, rel=1e-9)
    for r in found[::10]:
        assert r["score"] == pytest.approx(score(context_tree.canonical(texts[r["doc_id"]])), rel=1e-9)


def test_context_tree_awkward(awkward):
    found = context_tree.scored(awkward).collect()
    assert len(found) == awkward.count()
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[5]["n_tokens"] == by_id[6]["n_tokens"] == by_id[10]["n_tokens"] == 1
    assert by_id[5]["score"] == by_id[6]["score"] < 0
    assert by_id[None]["held_out"] is False


def test_grams_cut_long_texts_alike(monkeypatch):
    texts = [b"abc abc abd\n", b"x" * 50 + b"\n", b"\n"]

    def total():
        out = {}
        for codes, docs, counts in context_tree.grams(texts, 3):
            for c, d, n in zip(codes.tolist(), docs.tolist(), counts.tolist()):
                out[c, d] = out.get((c, d), 0) + n
        return out

    whole = total()
    assert sum(whole.values()) == sum(map(len, texts))
    monkeypatch.setattr(context_tree, "SLICE", 7)
    assert total() == whole


def test_network_gradients():
    random = np.random.default_rng(0)
    network = language.Network(3, 4)
    network.weights = {k: w.astype(np.float64) for k, w in network.weights.items()}
    rows, sizes, target = random.integers(0, 256, (5, 7)).astype(np.uint8), np.array([7, 3, 5, 7, 1]), np.array([0, 1, 2, 1, 0])
    _, slopes = network.gradients(rows, sizes, target)
    for name, weights in network.weights.items():
        at = (0, int(rows[0, 1])) if name.startswith("x") else tuple(random.integers(0, s) for s in weights.shape)
        losses = []
        for step in (1e-6, -2e-6):
            weights[at] += step
            losses.append(network.gradients(rows, sizes, target)[0])
        assert (losses[0] - losses[1]) / 2e-6 == pytest.approx(slopes[name][at], rel=1e-3, abs=1e-8)


def test_letters():
    assert [language.has_letter(t) for t in (None, "", "12 ² ½ _", "x", "①é")] == [False, False, False, True, True]


def test_windows_hold_every_byte():
    texts = [b"abcdefg", b"", b"xyz"]
    rows, owner, sizes = language.windows(texts, 3)
    joined = [b"".join(rows[k].tobytes()[: sizes[k]] for k in range(len(rows)) if owner[k] == i) for i in range(3)]
    assert joined == texts


def test_held_out_languages(spark, small_docs):
    found = language.predicted(small_docs).join(small_docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r["held_out"]]
    assert held and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_awkward(awkward):
    found = {r["doc_id"]: r for r in language.predicted(awkward).collect()}
    assert all(found[i]["lang_pred"] == "und" and found[i]["score"] == 0 for i in (5, 6, 10, 16))
    assert found[9]["lang_pred"] != "und"


def test_script_and_tokens_as_counted_alone():
    import unicodedata
    from collections import Counter

    for text in ("", "1 2", "ab ж", "ж ж ж q", "中文 ab", "ªº ǅ", "٠ #$", "é", "\U000e0001 a", "Ωω ab"):
        found = Counter(unicodedata.name(ch, "UNKNOWN").split()[0] for ch in text if ch.isalpha())
        assert fertility.script(text) == (min(found, key=lambda s: (-found[s], s)) if found else "NONE")
    words = ["a", "b\xa0", "\x01", "<|endoftext|>", "word,", "\U0001f600x", "é\x85", "y" * 300] + [f"w{k}" for k in range(500)]
    made = tokenizer(fertility.BYTES)
    alone = [len(made.encode(" " + w, add_special_tokens=False)) for w in words]
    assert [n for n, _ in fertility._word_values()[0].compute([w.encode() for w in words])] == alone


def test_new_words_are_encoded_many_at_once(monkeypatch):
    """One text of a tokenizer's call for each few hundred words."""
    calls = []

    class Counting:
        def __init__(self, made):
            self.made = made

        def __getattr__(self, name):
            return getattr(self.made, name)

        def encode_batch_fast(self, texts, **more):
            calls.extend(texts)
            return self.made.encode_batch_fast(texts, **more)

    monkeypatch.setattr(fertility, "tokenizer", lambda name: Counting(tokenizer(name)))
    monkeypatch.setattr(fertility, "_VALUES", [])
    fertility._word_values()[0].compute([f"w{k}".encode() for k in range(400)])
    assert len(calls) <= 4
