"""Spelling variants against brute force, url filters against a plain rendering and held-out urls."""

import re
import zlib
from collections import Counter

import pytest

from pyspark.sql import functions as F

from salesprism.llm import queries, spelling, urls

UPPER = {i: i + 32 for i in range(65, 91)}


def spoiled_words(rows):
    found = Counter()
    for doc_id, text in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(UPPER)):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 97 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1:]
            found[word] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def near(a: str, b: str) -> bool:
    """Exactly one code point inserted, deleted or replaced."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    at = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[at + (len(a) == len(b)):] == b[at + 1:]


def plain_groups(words: dict) -> dict:
    by_length: dict = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    found = {}
    for w, n in words.items():
        others = [o for k in (len(w) - 1, len(w), len(w) + 1) for o in by_length.get(k, []) if near(w, o)]
        form = min(others, key=lambda o: (-words[o], o), default=None)
        if form is not None and words[form] < 2 * n:
            form = None
        found[w] = (form, n, len(others), None if form is None else words[form])
    result = {}
    for w, (form, n, count, form_n) in found.items():
        root = w
        while found[root][0] is not None:
            root = found[root][0]
        result[w] = (form, root, n, count, form_n)
    return result


def rows_by_word(df) -> dict:
    rows = df.collect()
    found = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(found) == len(rows)
    return found


def test_spelling_query_is_brute_force(spark, small, small_docs):
    expected = plain_groups(spoiled_words((r["doc_id"], r["text"]) for r in small_docs.select("doc_id", "text").collect()))
    actual = rows_by_word(queries.queries()["op11_spelling_grams"](spark, small))
    assert actual == expected and any(v[0] for v in actual.values())


@pytest.mark.parametrize("often", [0, 10, 10**9])
def test_spelling_variants_of_every_kind_are_found(spark, often):
    """Short and long words, repeated letters, edits at every place, at both ends; dictionaries of all kinds of grams."""
    bases = ["house", "aaaaa", "banana", "abcabcabc", "mississippi", "x" * 40, "éàüöß", "ababababab"]
    words = set(bases)
    for b in bases:
        for i in range(len(b) + 1):
            words |= {b[:i] + c + b[i:] for c in "aqé"} | {b[:i] + c + b[i + 1:] for c in "abz" if i < len(b)} | {b[:i] + b[i + 1:]}
    words = {w: 3 + zlib.crc32(w.encode()) % 50 for w in words}
    counted = spark.createDataFrame(list(words.items()), "word string, n long")
    assert rows_by_word(spelling.grouped(counted, often=often)) == plain_groups(words)


def test_affected_grams_bound_what_an_edit_changes(spark):
    """No edit takes more of a word's grams away than its bound says, at their place from either end."""
    words = ["abracadabra", "banana", "aaaaaaa", "tionation", "ententen", "cabbage", "nationtion"]
    edited = {}
    for w in words:
        edited[w] = {v for i in range(len(w) + 1) for c in "abnt" for v in (w[:i] + c + w[i:], w[:i] + c + w[i + 1:], w[:i] + w[i + 1:]) if v != w}
    every = sorted(set(words).union(*edited.values()))
    ids = {w: i for i, w in enumerate(every)}
    table = spark.createDataFrame([(w, i) for w, i in ids.items()], "word string, id long")
    for often in (2, 20, 200):
        grams: dict = {}
        for r in spelling.bounded(spelling.decomposed(table, often=often)).collect():
            grams.setdefault(r["id"], []).append((r["gram"], r["pos"], r["affected"]))
        for w, variants in edited.items():
            own = grams[ids[w]]
            for v in variants:
                shift = len(v) - len(w)
                theirs = {(g, p) for g, p, _ in grams[ids[v]]}
                gone = [g for g, p, _ in own if (g, p) not in theirs and (g, p + shift) not in theirs]
                assert len(gone) <= own[0][2], (often, w, v)


def test_spelling_of_awkward_rows(spark, awkward, nothing):
    rows = awkward.select("doc_id", "text").collect()
    expected = plain_groups(spoiled_words((r["doc_id"], r["text"]) for r in rows))
    assert rows_by_word(spelling.grouped(spelling.vocabulary(spelling.runs(awkward, 97)))) == expected
    assert spelling.grouped(spelling.vocabulary(spelling.runs(nothing, 97))).count() == 0
    odd = spark.createDataFrame([("house", 2, 1), ("house", 3, 1), (None, 9, 1), ("horse", 10, 1)], "word string, n long, root int")
    assert rows_by_word(spelling.grouped(odd)) == plain_groups({"house": 5, "horse": 10})


def plain_place(url):
    url = url or ""
    if "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    host = re.match("[^/?#]*", rest)[0]
    return host.translate(UPPER), re.match("[^?#]*", rest[len(host):])[0]


def plain_rule(host, path):
    best = None
    for verdict, place, start in urls.RULES:
        if (host == place or host.endswith("." + place)) and path.startswith(start):
            if best is None or len(place + start) > len(best[0]):
                best = (place + start, verdict)
    return best


def test_url_rules_are_the_plain_ones(spark, small):
    rows = urls.judged(spark.read.parquet(f"{small}/pages.parquet")).collect()
    assert rows and any(r["rule"] for r in rows)
    for r in rows:
        host, path = plain_place(r["url"])
        rule = plain_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule[0])
        assert r["verdict"] == (rule[1] if rule else "block" if r["score"] >= 0.5 else "allow")


ODD_URLS = [
    None, "", "no scheme", "http://", "HTTP://EXAMPLE.ORG", "https://a.Example.ORG/es/x?y=1&z=2#f", "x://org/", "x://org", "x://xorg/",
    "http://example.com/de/#://example.org/es/", "http://com/fr/", "http://é.example.org/en/1\n2", "a://b://c.com/de/?", "http://a.com?/de/",
    "http://user:pw@example.org:80/en/1", "http://" + "a." * 3000 + "org/" + "x/" * 5000, "http://ÀÖ.ORG/ÀÖ",
]


def test_odd_urls(spark):
    table = spark.createDataFrame(
        [(i % 7 or None, u, "x", 1, 2.0) for i, u in enumerate(ODD_URLS * 2)], "page_id long, url string, host string, rule int, score double"
    )
    rows = urls.judged(table).collect()
    assert len(rows) == 2 * len(ODD_URLS)
    verdicts = {}
    for r in rows:
        host, path = plain_place(r["url"])
        rule = plain_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule[0])
        assert verdicts.setdefault(r["url"], r["verdict"]) == r["verdict"] and r["verdict"] in ("allow", "block")
    assert urls.judged(table.limit(0)).count() == 0


def test_held_out_urls_and_lexical_signs(spark):
    """Trees learned from four fifths of labelled urls judge the rest, also where only the form of the url tells."""
    made = []
    for i in range(3000):
        bad = zlib.crc32(str(i).encode()) % 3 == 0
        # hosts never repeat, so only digits and parameters tell
        host = f"{'x' + str(i * 7919) if bad else 'site' + chr(97 + i % 26) + chr(97 + i // 26 % 26)}.h{chr(97 + i % 23)}{chr(97 + i // 23 % 26)}.example"
        made.append((f"http://{host}/{'?a=1&b=2&c=3&d=' + str(i) if bad else 'page/about.html'}", bad))
    table = spark.createDataFrame(made, "url string, blocked boolean")
    host, path = urls.host_and_path(F.col("url"))
    table = table.withColumn("host", host).withColumn("path", path)
    fold = F.crc32("url") % 5
    scored = urls.learned(table.where(fold != 0)).scored(table.where(fold == 0)).collect()
    right = sum((r["score"] >= 0.5) == r["blocked"] for r in scored)
    assert len(scored) > 300 and right >= 0.95 * len(scored)


def test_labels_of_one_verdict_or_none(spark):
    table = spark.createDataFrame([("http://a.org/", False), ("http://b.org/", False)], "url string, blocked boolean")
    host, path = urls.host_and_path(F.col("url"))
    table = table.withColumn("host", host).withColumn("path", path)
    assert {r["score"] for r in urls.learned(table).scored(table).collect()} == {0.0}
    assert {r["score"] for r in urls.learned(table.limit(0)).scored(table).collect()} == {0.0}
    assert {r["score"] for r in urls.learned(table.withColumn("blocked", F.lit(True))).scored(table).collect()} == {1.0}


def test_url_query_plan_has_no_python(spark, small):
    plan = queries.queries()["op12_boosted_urls"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_spelling_query_is_its_oracle(spark, folder, duck):
    from oracle import compare

    assert compare(queries.queries()["op11_spelling_grams"](spark, folder), duck, queries.oracle_sql()["op11_spelling_grams"]) > 10_000
