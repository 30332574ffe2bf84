"""Judges urls by rules and, where no rule fits, by boosted trees on lexical features.

Everything runs in Spark's own operators: features are expressions, statistics of suffixes are
aggregates, and the trees are MLlib's.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from salesprism.llm.store import stored

#: Labelled urls that the trees are fitted on, in the mean; statistics of suffixes cover all labelled urls.
SAMPLE = 100_000
TREES, DEPTH, SHRINK = 20, 4, 0.2
#: A suffix's rate starts as so many urls with the rate of the shorter suffix.
WEIGHT = 5
#: Verdict, host and start of the path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

#: Characters are told apart for the entropy as these and all others.
_KINDS = "abcdefghijklmnopqrstuvwxyz0123456789-./"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SUFFIXES = ("last_label", "domain", "directory")
FEATURES = (
    "url_length", "host_length", "path_length", "depth", "n_labels", "n_hyphens", "digit_ratio", "host_digit_ratio",
    "entropy", "host_entropy", "n_parameters", "query_length", "has_fragment", "has_extension", "first_digit",
    *(f"{s}_rate" for s in SUFFIXES), *(f"{s}_known" for s in SUFFIXES),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path, both empty for null and without ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_column(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as (rule, verdict), else null; of equally long ones the first given."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, place, start in sorted(reversed(list(rules)), key=lambda r: len(r[1] + r[2])):
        fits = ((host == place) | host.endswith("." + place)) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(place + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _count(text: Column, letters: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, letters, ""))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def _entropy(text: Column) -> Column:
    """Bits per character, in one pass over the text for each kind of character."""
    text = F.lower(text)
    n = F.char_length(text)
    kinds = F.array(*map(F.lit, _KINDS))
    known = F.transform(kinds, lambda k: n - F.char_length(F.replace(text, k, F.lit(""))))
    counts = F.concat(known, F.array(n - F.aggregate(known, F.lit(0), lambda a, c: a + c)))
    return F.aggregate(counts, F.lit(0.0), lambda a, c: a + F.when(c > 0, c / n * F.log2(n / c)).otherwise(0.0))


def lexical(urls: DataFrame) -> DataFrame:
    """The columns of ``urls`` (url, host, path and others) and the lexical features and suffixes of each."""
    url = F.coalesce("url", F.lit(""))
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    labels = F.split("host", r"\.")
    own = {
        "url_length": F.char_length(url),
        "host_length": F.char_length("host"),
        "path_length": F.char_length("path"),
        "depth": F.size(F.filter(F.split("path", "/"), lambda s: s != "")),
        "n_labels": F.size(labels),
        "n_hyphens": _count(F.col("host"), "-"),
        "digit_ratio": _share(_count(url, "0123456789"), F.char_length(url)),
        "host_digit_ratio": _share(_count(F.col("host"), "0123456789"), F.char_length("host")),
        "entropy": _entropy(url),
        "host_entropy": _entropy(F.col("host")),
        "n_parameters": F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))),
        "query_length": F.char_length(query),
        "has_fragment": (F.instr(url, "#") > 0).cast("int"),
        "has_extension": F.col("path").rlike(r"\.[A-Za-z0-9]{1,5}$").cast("int"),
        "first_digit": F.coalesce(F.regexp_extract("path", "([0-9])", 1).try_cast("int"), F.lit(-1)),
    }
    suffixes = {
        "last_label": F.element_at(labels, -1),
        "domain": F.regexp_extract("host", r"[^.]*\.?[^.]*$", 0),
    }
    suffixes["directory"] = F.concat(suffixes["domain"], F.regexp_extract("path", "^/[^/]*/?", 0))
    return urls.select(*urls.columns, *[c.cast("double").alias(k) for k, c in own.items()], *[c.alias(k) for k, c in suffixes.items()])


@dataclass
class UrlFilter:
    """What was learned: the share of blocked urls, counts by suffix, and the trees."""

    rate: float
    suffixes: dict[str, DataFrame]
    trees: GBTClassificationModel | None

    def with_rates(self, found: DataFrame) -> DataFrame:
        """Adds each suffix's smoothed share of blocked urls and the logarithm of its count."""
        rate = F.lit(self.rate)
        for name in SUFFIXES:
            table = self.suffixes[name].select(F.col(name).alias("_suffix"), "_blocked", "_n")
            found = found.join(table, F.col(name) == F.col("_suffix"), "left")
            n, blocked = F.coalesce("_n", F.lit(0)), F.coalesce("_blocked", F.lit(0))
            found = found.withColumn(f"{name}_rate", (blocked + rate * WEIGHT) / (n + WEIGHT))
            found = found.withColumn(f"{name}_known", F.log1p(n.cast("double"))).drop("_suffix", "_blocked", "_n")
            rate = F.col(f"{name}_rate")
        return found

    def scored(self, urls: DataFrame) -> DataFrame:
        """The columns of ``urls`` (url, host, path and others) and score, the chance that the url is to be blocked.

        Without labels, or with labels of one verdict only, it is that verdict's share for all; 0 without any.
        """
        if self.trees is None:
            return urls.withColumn("score", F.lit(self.rate))
        found = self.with_rates(lexical(urls))
        vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(found)
        chance = vector_to_array(F.col("probability"))[1]
        return self.trees.transform(vectors).select(*urls.columns, chance.alias("score"))


def learned(labelled: DataFrame, sample: int = SAMPLE) -> UrlFilter:
    """Learns from ``labelled`` (url, host, path, blocked); a url counts once, as blocked if any of its rows is.

    One half of the urls, by hash, gives the counts by suffix; the trees are fitted on the other
    half, so that a url's own label is in none of its features. Of that half at most ``sample`` urls, in the
    mean, are used; null labels are left out.
    """
    known = labelled.where("blocked is not null").groupBy(F.coalesce("url", F.lit("")).alias("url")).agg(
        F.any_value("host").alias("host"), F.any_value("path").alias("path"), F.max("blocked").alias("blocked")
    )
    side = F.pmod(F.xxhash64("url"), F.lit(2))
    known = stored(lexical(known.withColumn("_side", side)))
    seen = {(r["_side"], r["blocked"]): r["n"] for r in known.groupBy("_side", "blocked").agg(F.count("*").alias("n")).collect()}
    blocked, whole = seen.get((0, True), 0) + seen.get((1, True), 0), sum(seen.values())
    rate = blocked / whole if whole else 0.0
    counted = known.where("_side = 0")
    suffixes = {
        name: stored(counted.groupBy(name).agg(F.count_if("blocked").alias("_blocked"), F.count("*").alias("_n")))
        for name in SUFFIXES
    }
    found = UrlFilter(rate, suffixes, None)
    if not (seen.get((1, True)) and seen.get((1, False))):
        return found
    share = min(1.0, sample / (seen[1, True] + seen[1, False]))
    rows = found.with_rates(known.where("_side = 1").where(F.pmod(F.xxhash64("url", F.lit(1)), F.lit(1 << 20)) < math.ceil(share * (1 << 20))))
    rows = stored(rows.select(*FEATURES, F.col("blocked").cast("double").alias("label")))
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=SHRINK, seed=7).fit(vectors.select("features", "label"))
    return UrlFilter(rate, suffixes, trees)


def judged(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, sample: int = SAMPLE) -> DataFrame:
    """For each row of (page_id, url): host, path, rule, verdict, and score, the trees' chance of block.

    The urls that a rule fits are the labelled ones the trees learn from; the rule's verdict stands for
    them, all others are blocked from a score of one half on. A null url has an empty host and path. Rows
    are judged one by one, repeated ones alike; an empty table gives no rows; other columns are ignored.
    ``rules`` is a list of a few hundred at most: it becomes one expression.
    """
    urls = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url")
    host, path = host_and_path(F.col("url"))
    urls = urls.withColumn("host", host).withColumn("path", path)
    urls = urls.withColumn("_fit", rule_column(F.col("host"), F.col("path"), rules))
    urls = urls.select("page_id", "url", "host", "path", F.col("_fit.rule").alias("rule"), F.col("_fit.verdict").alias("ruled"))
    labelled = urls.where("rule is not null").withColumn("blocked", F.col("ruled") == "block")
    scored = learned(labelled, sample).scored(urls)
    own = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select("page_id", "url", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "score")
