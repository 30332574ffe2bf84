"""Personal data and licence scans."""

import hashlib

import pytest
from pyspark.sql import functions as F

import plain
from salesprism.llm import licenses, pii
from salesprism.llm.queries import queries

TEXTS = [
    "a@b.co a.b@c-d.e.f, x@y x@.z @@ q%x@d.e", "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 1.2.3",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 41111111111111112 4111111111111111-4111111111111111",
    "+1 (555) 123-4567. +1 +12 34 +123456789012345678 + 1234567 +1--------2345678", "4" * 3000, "1 2 " * 3000, "a" * 5000 + "@b.c",
    "\x01 a@b.co \x02 1.1.1.1 \x01", "😀 a@b.co 😀 10.0.0.1", "write to jo (at) example (dot) org", None, "",
]


def expected(text):
    spans = plain.private_spans(text)
    digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
    return digest, *[sum(s[0] == k for s in spans) for k in pii.KINDS]


def test_base_spans(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    for r in pii.found(docs).collect():
        own = (r["base_sha256"], *[r[f"n_{k}"] for k in pii.KINDS])
        assert own == expected(TEXTS[r["doc_id"]]), TEXTS[r["doc_id"]]
        base = {f"{k}:{a}:{b}" for k, a, b in plain.private_spans(TEXTS[r["doc_id"]])}
        assert base <= set(r["spans"].split(",")) | {""} - {""} or not base


def test_op3_on_documents(spark, folder):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = queries()["op3_boosted_pii"](spark, folder).collect()
    assert len(found) == len(texts)
    for r in found:
        assert (r["base_sha256"], *[r[f"n_{k}"] for k in pii.KINDS]) == expected(texts[r["doc_id"]])


def test_plan_is_native(spark, folder):
    plan = pii.found(spark.read.parquet(f"{folder}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_trees_take_what_looks_alike():
    cells = []
    for held in (False, True):
        cells += [
            {"kind": "phone", "a": 1, "b": 0, "held": held, "good": 400, "bad": 2},
            {"kind": "phone", "a": 0, "b": 0, "held": held, "good": 1, "bad": 300},
            {"kind": "card", "a": 0, "b": 1, "held": held, "good": 0, "bad": 50},
        ]
    model = pii.fitted(cells, ["a", "b"])
    assert model.score({"a": 1, "b": 0}) >= model.thresholds["phone"] > model.score({"a": 0, "b": 0})
    assert model.thresholds["card"] == float("inf")
    assert pii.fitted([], ["a"]).thresholds["email"] == float("inf")


def test_redaction(spark, awkward, nothing):
    docs = spark.createDataFrame([(1, "Mail a@b.co now", "k"), (2, "no data", "k"), (3, None, None), (4, "10.0.0.1", "k"), (4, "10.0.0.1", "k")], "doc_id bigint, text string, row string")
    found = pii.redacted(docs)
    assert found.columns == docs.columns
    rows = sorted((r["doc_id"], r["text"] or "") for r in found.collect())
    assert rows == [(1, "Mail [EMAIL] now"), (2, "no data"), (3, ""), (4, "[IP]"), (4, "[IP]")]
    clean = pii.redacted(awkward)
    assert clean.count() == awkward.count() and clean.where("text like '%[CARD]%'").count() == 2
    assert pii.redacted(nothing).count() == 0 and pii.found(nothing).count() == 0


NOTICE = licenses.TEMPLATES["MIT"][0] + "."


@pytest.fixture(scope="module")
def files(spark):
    rows = [
        ("lib/a.py", f"{NOTICE}\n" + "code and more code " * 9), ("lib/LICENSE", licenses.TEMPLATES["GPL-3.0"][1]),
        ("lib/sub/b.py", "no notice"), ("lib/sub/deep/COPYING", licenses.TEMPLATES["Apache-2.0"][1] + "\nmore words here"),
        ("lib/sub/deep/c.py", "no notice"), ("lib2/d.py", "no notice"), ("top.py", "we talk about a licence for fishing in the old river"),
        (None, NOTICE), (None, None), ("x/e", ""), ("lib/sub/f.py", None), ("lib/sub/f.py", None),
    ]
    return spark.createDataFrame([(p, t, "k") for p, t in rows], "path string, text string, score string")


def test_inheritance(files):
    found = sorted(
        ((r["path"] or "", r["license"], r["found"], r["directory"]) for r in licenses.scanned(files).collect()),
        key=lambda r: (r[0], r[1] or ""),
    )
    assert found == [
        ("", None, "none", None), ("", "MIT", "licence file", None), ("lib/LICENSE", "GPL-3.0", "licence file", None),
        ("lib/a.py", "MIT", "header", None), ("lib/sub/b.py", "GPL-3.0", "inherited", "lib"),
        ("lib/sub/deep/COPYING", "Apache-2.0", "licence file", None), ("lib/sub/deep/c.py", "Apache-2.0", "inherited", "lib/sub/deep"),
        ("lib/sub/f.py", "GPL-3.0", "inherited", "lib"), ("lib/sub/f.py", "GPL-3.0", "inherited", "lib"),
        ("lib2/d.py", None, "none", None), ("top.py", None, "none", None), ("x/e", None, "none", None),
    ]
    assert licenses.scanned(files.limit(0)).count() == 0


def test_op9_on_documents(spark, folder):
    known = {
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    }
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = queries()["op9_license_scan"](spark, folder)
    assert "Python" not in found._jdf.queryExecution().toString()
    rows = found.collect()
    assert len(rows) == len(docs)
    for r in rows:
        own = {name for line in docs[r["doc_id"]].split("\n") for text, name in known.items() if line.strip() == text}
        assert (r["found"] in ("header", "licence file")) == bool(own)
        assert not own or r["license"] in own


def test_notices_without_lines_of_their_own(spark):
    long = " ".join(f"word{k}" for k in range(60))
    header = licenses.TEMPLATES["Apache-2.0"][1].split()
    rows = [
        ("a/one_line.txt", f"{long} Released under the MIT License {long}"),
        ("b/wrapped.py", "\n".join(" ".join(header[k : k + 3]) for k in range(0, len(header), 3)) + "\n" + long),
        ("c/LICENSE", "\n".join(" ".join(licenses.TEMPLATES["Apache-2.0"]).split())),
        ("c/code.py", long),
        ("d/none.txt", f"{long} the warranty of this old car ran out {long}"),
    ]
    found = {r["path"]: r for r in licenses.scanned(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert [(found[p]["license"], found[p]["found"]) for p, _ in rows] == [
        ("MIT", "header"), ("Apache-2.0", "header"), ("Apache-2.0", "licence file"), ("Apache-2.0", "inherited"), (None, "none")
    ]


def test_long_text_full_of_notice_words(spark):
    """Windows grow with the text, not with its square, and each stands once."""
    words = [("license" if i % 20 == 0 else f"w{i % 97}") for i in range(20_000)]
    files = spark.createDataFrame([(" ".join(words), "a/b.py"), (" ".join(words[:5_000]), "a/c.py")], "text string, path string")
    files = files.withColumn("_row", F.length("text").cast("long"))
    found = licenses.passages(files).cache()
    counts = {r["_row"]: r["count"] for r in found.groupBy("_row").count().collect()}
    assert max(counts.values()) < 4.2 * min(counts.values()) and max(counts.values()) < 4 * 20_000
    assert found.groupBy("_row", "start", "size").count().where("count > 1").isEmpty()
    for r in found.where("start % 4999 = 0").take(50):
        text = words if r["_row"] == max(counts) else words[:5_000]
        assert r["line"].split() == text[r["start"] : r["start"] + r["size"]]


def test_terms_carry_a_number_and_not_their_line(files, monkeypatch):
    kinds, weights = [], licenses._weights

    def seen(words, idf, rarest):
        kinds.append(dict(words.dtypes)["item"])
        return weights(words, idf, rarest)

    monkeypatch.setattr(licenses, "_weights", seen)
    rows = files.select("path", "text").withColumn("_row", F.monotonically_increasing_id())
    found = licenses.notices(rows, more=licenses.passages(rows))
    assert sorted(kinds) == ["bigint", "string"]  # lines by number; the fixed templates by name
    assert {r["line"]: r["license"] for r in found.collect()}[NOTICE] == "MIT"
