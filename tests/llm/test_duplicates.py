"""Jaccard join, sorted projection passes and components."""

import numpy as np
import pytest

import plain
from plain import prose
from salesprism.llm import jaccard, projections
from salesprism.llm.components import components
from salesprism.llm.queries import queries
from salesprism.llm.store import stored
from salesprism.llm.shingles import set_hash, shingle_sets, word_hashes


def test_components(spark):
    pairs = [(k, k + 1) for k in range(40)] + [(100, 50), (50, 101), (101, 100), (7, 7), (200, 60)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    nodes = {x for p in pairs if p[0] != p[1] for x in p}
    assert found == plain.components(pairs, nodes)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_word_hashes_do_not_depend_on_place():
    a, places = word_hashes(b"one two  three\none")
    assert a[0] == a[3] and len(set(a.tolist())) == 3 and places.tolist() == [0, 4, 9, 15]
    assert word_hashes(b"")[0].size == 0


def test_sets_match_plain():
    texts = [prose(n, n) for n in (0, 1, 4, 5, 6, 300)] + ["A b C d E", "a B c D e", None, "é x y z w v"]
    sets = shingle_sets(texts)
    for text, found in zip(texts, sets):
        assert len(found) == len(plain.shingles(text))
    assert sets[6].tolist() == sets[7].tolist()


@pytest.mark.parametrize("wanted", [1, 8])
def test_random_groups_match_plain(spark, monkeypatch, wanted):
    """Chains of edits, groups of near copies and shared passages, with short and long prefixes."""
    monkeypatch.setattr(jaccard, "matches_wanted", lambda codes, shortest: min(wanted, len(codes) - shortest + 1))
    random = np.random.default_rng(wanted)
    rows, passage = [], prose(50, 999)
    for g in range(12):
        text = prose(int(random.integers(6, 160)), 1000 + g).split()
        for _ in range(int(random.integers(1, 14))):
            if random.random() < 0.5:
                text = list(text)
            copy = list(text)
            for _ in range(int(random.integers(0, 4))):
                copy[int(random.integers(0, len(copy)))] = f"w{int(random.integers(0, 10**6))}"
            if random.random() < 0.3:
                text = copy
            rows.append((len(rows), " ".join(copy) + (" " + passage if g % 3 == 0 else "")))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    want = plain.jaccard_components(rows)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.joined(docs).collect()}
    assert found == want
    assert len({c for _, c in want.values()}) < len(want)


def test_members_far_from_their_hub(spark):
    """Two clusters that only meet through members, which the hubs' distance must not hide."""
    base = [f"a{k}" for k in range(104)]
    rows = []
    for step in range(0, 40, 3):
        text = [f"b{k}" if k < step else w for k, w in enumerate(base)]
        rows.append((step, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r["component_id"] for r in jaccard.joined(docs).collect()}
    assert found == {i: c for i, (_, c) in plain.jaccard_components(rows).items()}


def test_hub_in_another_cluster(spark):
    """Chain c - b - a - d where hub b is in the cluster of c, its own holds only a, and d links with a alone."""

    def word(name, n):
        return [f"{name}{k}" for k in range(n)]

    for seed in range(500):
        k, bc, ad, ab, c, d = (word(f"{x}{seed}_", n) for x, n in zip("kpqxcd", (86, 8, 8, 10, 10, 10)))
        chain = [bc + k + c, ad + k + d, bc + k + ab, ad + k + ab]  # c, d, b, a
        classes = [set_hash(s) for s in shingle_sets([" ".join(t) for t in chain])]
        if classes == sorted(classes):
            break
    else:
        raise AssertionError("no seed gives the order of classes")
    others = [word("r", 90) + k[-4:] + c, word("s", 90) + k[-4:] + d]
    rows = [(i, " ".join(t)) for i, t in enumerate(chain + others)]
    want = plain.jaccard_components(rows)
    assert [want[i][1] for i in range(6)] == [0, 0, 0, 0, 4, 5]
    found = jaccard.joined(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == want


def test_a_group_is_not_opened_towards_sets_that_its_members_cannot_link_with(spark, monkeypatch):
    """Copies with words of their own beside sets a little too far from all of them: no member can link."""
    opened = []

    def counted(df, *more):
        table = stored(df, *more)
        if "alone_a" in table.columns:
            opened.append(table.count())
        return table

    monkeypatch.setattr(jaccard, "stored", counted)
    text = [f"t{k}" for k in range(200)]
    copies = [" ".join([*text, *(f"own{k}x{i}" for i in range(10))]) for k in range(30)]
    others = [" ".join([*text[:170], *(f"other{k}x{i}" for i in range(22))]) for k in range(30)]
    rows = list(enumerate([" ".join(text), *copies, *others]))
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in
             jaccard.joined(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found == plain.jaccard_components(rows)
    assert {c for i, (_, c) in found.items() if i <= 30} == {0} and len({c for _, c in found.values()}) == 31
    assert sum(opened) == 0


def test_jaccard_awkward(awkward, nothing):
    found = jaccard.joined(awkward).collect()
    assert len(found) == awkward.count()
    by_id = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found}
    assert by_id[2][1] == by_id[1][1] == by_id[3][1] == 1
    assert by_id[7][1] == by_id[8][1] == 7 and by_id[7][0] == 1
    assert by_id[5] == (0, 5) and by_id[6] == (0, 6) and by_id[10] == (0, 10)
    kept = jaccard.first_of_each(awkward)
    assert kept.columns == awkward.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i) == [1, 4, 5, 6, 7, 9, 10, 11, 12, 13, 14, 15, 16] and ids.count(None) == 1
    assert jaccard.joined(nothing).count() == 0


def test_ids_on_two_texts(spark):
    """Each text of id 5 by its own component: one is first of its group, the others are copies or alone."""
    one, two, three = (prose(120, seed) for seed in (71, 72, 73))

    def near(text):
        return text.replace(text.split()[60], "different", 1)

    rows = [(1, one), (5, near(one)), (5, two), (6, near(two)), (5, three), (5, three), (5, ""), (None, near(three))]
    kept = jaccard.first_of_each(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted([(1, one), (5, two), (5, three), (5, "")])


def test_op6_on_documents(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries()["op6_adaptive_prefixes"](spark, small).collect()}
    assert found == plain.jaccard_components(rows)


def vectors(spark):
    random = np.random.default_rng(5)
    rows = []
    for g in range(60):
        centre = random.normal(size=16)
        for _ in range(int(random.integers(1, 12))):
            v = centre + random.normal(size=16) * random.choice([0.0, 0.05, 0.12])
            rows.append((len(rows), [float(x) for x in v], g % 3))
    rows += [(len(rows) + k, list(rows[0][1]), rows[0][2]) for k in range(3)]
    n = len(rows)
    rows += [
        (n, None, 1), (n + 1, [], 1), (n + 2, [0.0] * 16, 1), (n + 3, [float("nan")] * 16, 1), (n + 4, [None] * 16, 1),
        (n + 5, list(rows[0][1]), None), (n + 6, [1.0, 2.0], 0), (n + 7, [2.0, 4.0], 0), (n + 8, [float("inf")] * 2, 0),
    ]
    return rows, spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")


@pytest.mark.parametrize("subgroup", [3, 1024])
def test_projections_match_plain(spark, monkeypatch, subgroup):
    monkeypatch.setattr(projections, "SUBGROUP", subgroup)
    monkeypatch.setattr(projections, "CHUNK", 64)
    rows, table = vectors(spark)
    able = {}
    for i, v, label in rows:
        if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            able[i] = (label, len(v), np.array(v) / np.linalg.norm(v))
    links = [
        (a, b) for a in able for b in able
        if a < b and able[a][:2] == able[b][:2] and able[a][2] @ able[b][2] >= projections.LEAST
    ]
    roots = plain.components(links, [i for i, *_ in rows])
    found = {r["vec_id"]: r for r in projections.near_duplicates(table).collect()}
    assert len(found) == len(rows)
    for i, *_ in rows:
        assert found[i]["component_id"] == roots[i], i
        assert found[i]["n_links"] == sum(i in p for p in links)
        assert found[i]["kept"] == (roots[i] == i)
    assert projections.near_duplicates(table.limit(0)).count() == 0


@pytest.mark.parametrize("dense", [False, True])
def test_projections_in_dense_places(spark, dense):
    """Embeddings that share a direction, with planted pairs; and one group of close vectors."""
    random = np.random.default_rng(11)
    n, size = (2500, 64) if not dense else (1500, 16)
    shared = np.eye(size)[0] * (3.0 if not dense else 5.0)

    def unit(x):
        return x / np.linalg.norm(x, axis=-1, keepdims=True)

    base = unit(shared + random.normal(size=(n, size)) / (np.sqrt(size) if not dense else 4.0))
    other = random.normal(size=(n // 4, size))
    first = base[: n // 4]
    other = unit(other - (other * first).sum(axis=1, keepdims=True) * first)
    table = np.concatenate([base, 0.981 * first + np.sqrt(1 - 0.981**2) * other])
    alike = table @ table.T >= projections.LEAST
    np.fill_diagonal(alike, False)
    roots = plain.components([(int(a), int(b)) for a, b in np.argwhere(np.triu(alike))], range(len(table)))
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(table)]
    found = projections.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found} == {
        i: (int(alike[i].sum()), roots[i]) for i in range(len(table))
    }


def test_projections_repeated_rows(spark):
    table = spark.createDataFrame(
        [(1, [1.0, 0.0], 0, "x"), (1, [1.0, 0.0], 0, "y"), (None, [1.0, 0.0], 0, None)],
        "vec_id bigint, embedding array<double>, label int, class string",
    )
    found = projections.near_duplicates(table).collect()
    assert [(r["n_links"], r["component_id"]) for r in found] == [(2, 1)] * 3
