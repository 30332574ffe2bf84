"""Personal data: overlapping candidates, boosted trees over their features, calibrated thresholds.

DataFrame functions only; the trees are fitted on counts of feature combinations, whose number
is bounded by the features' values, not by the documents.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from salesprism.llm.store import stored

KINDS = ("email", "ip", "card", "phone")

#: What the base rules match. Written so that no text makes them go back over
#: what they have read: a match begins where a run of its first characters does, or at the
#: end of the match before.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:\G|(?<![0-9])(?<![0-9][\x20-]))[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Generators of further candidates: each finds more than it should.
WIDE = {
    "email": r"(?i)(?<![a-z0-9])[a-z0-9][a-z0-9._%+-]{0,63} ?(?:@|\(at\)|\[at\]) ?[a-z0-9-]{1,63}(?: ?(?:\.|\(dot\)|\[dot\]) ?[a-z0-9-]{1,63}){1,8}",
    "ip": r"(?<![0-9.])[0-9]{1,4}(?: ?[.,] ?[0-9]{1,4}){3}(?![0-9.])",
    "card": r"(?<![0-9])[0-9](?:[\x20./-]?[0-9]){12,18}(?![0-9])",
    "phone": r"(?<![0-9])(?:\+ ?|00)?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[\x20./-]{1,2}\(?[0-9]{2,5}\)?){2,5}(?![0-9])",
}
#: Words before a candidate that speak of each kind.
CONTEXT = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write|courriel|correo|kontakt)\b",
    "ip": r"(?i)\b(?:ip|address|server|host|login|adresse|direcci.n)\b",
    "card": r"(?i)\b(?:card|visa|credit|payment|carte|karte|tarjeta)\b",
    "phone": r"(?i)\b(?:phone|tel|call|fax|mobile|cell|telefon|t.l.phone|tel.fono)\b",
}
BEFORE = 24  # characters before a candidate that are its context
TREES, DEPTH, SHRINK = 24, 3, 0.3
PRECISION = 0.98  # share of true spans that a threshold keeps on the documents held back
_OPEN, _CLOSE = "\x01", "\x02"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    places = F.sequence(F.lit(1), F.char_length(digits))
    doubled = F.transform(
        places,
        lambda i: F.substr(F.reverse(digits), i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1),
    )
    total = F.aggregate(doubled, F.lit(0), lambda s, d: s + F.when(d > 9, d - 9).otherwise(d))
    return (F.char_length(digits) > 0) & (total % 10 == 0)


def matches(rows: DataFrame, generators: dict[str, str], source: str) -> DataFrame:
    """All matches in (row, text): kind, start, end, match and the context before and after.

    Matches are marked in the text, which is then cut at the marks; running lengths of the
    cuts give the places, so a text with many matches is read once for each kind.
    """
    found = None
    for kind, pattern in generators.items():
        marked = F.regexp_replace("text", f"({pattern})", f"{_OPEN}$1{_CLOSE}")
        cuts = rows.select("row", F.posexplode(F.split(marked, _OPEN)).alias("at", "cut"))
        closes = F.locate(_CLOSE, F.col("cut"))
        own = Window.partitionBy("row").orderBy("at")
        cuts = cuts.withColumns(
            {
                "match": F.when(closes > 0, F.substring_index("cut", _CLOSE, 1)),
                "rest": F.when(closes > 0, F.substring_index("cut", _CLOSE, -1)).otherwise(F.col("cut")),
            }
        )
        size = F.char_length("rest") + F.coalesce(F.char_length("match"), F.lit(0))
        placed = cuts.withColumn("size", size).withColumns(
            {
                "start": F.coalesce(
                    F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
                ),
                "before": F.coalesce(F.lag(F.right("rest", F.lit(BEFORE))).over(own), F.lit("")),
            }
        ).where("match is not null")
        one = placed.select(
            "row", F.lit(kind).alias("kind"), F.lit(source).alias("source"), "start",
            (F.col("start") + F.char_length("match")).alias("end"), "match", "before",
            F.substring("rest", 1, 1).alias("after"),
        )
        found = one if found is None else found.unionByName(one)
    return found


def base_holds() -> Column:
    """Whether a match of a base pattern passes its kind's further rule."""
    digits = _digits(F.col("match"))
    parts = F.forall(F.split("match", r"\."), lambda p: (F.char_length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.try_to_number(F.right(F.concat(F.lit("000"), p), F.lit(3)), F.lit("999")).cast("int"), F.lit(0)) <= 255))
    return (
        F.when(F.col("kind") == "email", True)
        .when(F.col("kind") == "ip", parts)
        .when(F.col("kind") == "card", F.char_length(digits).between(16, 19) & luhn(F.substring(digits, 1, 19)))
        .otherwise(F.char_length(digits).between(8, 15))
    )


def features() -> dict[str, tuple[Column, int]]:
    """Format and context of a candidate as small numbers, each with how many values it has."""
    match, before = F.col("match"), F.col("before")
    count = F.char_length(_digits(match))
    marks = F.char_length(F.regexp_replace(match, r"[A-Za-z0-9]", ""))
    last, after = F.right(before, F.lit(1)), F.col("after")

    def beside(c: Column) -> Column:
        return F.when(c == "", 0).when(c.rlike(r"\s"), 1).when(c.rlike(r"[\p{L}]"), 2).when(c.rlike("[0-9]"), 3).otherwise(4)

    spoken = F.lit(0)
    for k, kind in enumerate(KINDS, 1):
        spoken = F.when(before.rlike(CONTEXT[kind]), k).otherwise(spoken)
    found = {
        "kind_of": (F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1, 4),
        "digits": (F.least(F.floor(count / 2), F.lit(10)).cast("int"), 11),
        "marks": (F.least(marks, F.lit(5)), 6),
        "blanks": (F.least(F.char_length(F.regexp_replace(match, r"[^ ]", "")), F.lit(2)), 3),
        "left": (beside(last), 5),
        "right": (beside(after), 5),
        "spoken": (spoken, 5),
        "plain": (F.when(match.rlike(r"[@+]"), 1).otherwise(0), 2),
        "letters": (F.when(match.rlike("[A-Za-z]"), 1).otherwise(0), 2),
    }
    return {name: (column.cast("int"), values) for name, (column, values) in found.items()}


@dataclass
class Node:
    """A split (feature, limit, low side, high side) or a leaf."""

    value: float = 0.0
    feature: str = ""
    limit: int = 0
    low: "Node | None" = None
    high: "Node | None" = None

    def of(self, row: dict) -> float:
        return self.value if self.low is None else (self.low if row[self.feature] <= self.limit else self.high).of(row)

    def column(self) -> Column:
        if self.low is None:
            return F.lit(self.value)
        return F.when(F.col(self.feature) <= self.limit, self.low.column()).otherwise(self.high.column())


def _grown(rows: list[dict], names: list[str], depth: int) -> Node:
    """A tree on gradients and curvatures of the log loss, by Newton gains."""
    g, h = sum(r["_g"] for r in rows), sum(r["_h"] for r in rows)
    best = (1e-6, "", 0)
    if depth:
        for name in names:
            sums: dict = {}
            for r in rows:
                a = sums.setdefault(r[name], [0.0, 0.0])
                a[0] += r["_g"]
                a[1] += r["_h"]
            left = [0.0, 0.0]
            for value in sorted(sums)[:-1]:
                left = [left[0] + sums[value][0], left[1] + sums[value][1]]
                gain = left[0] ** 2 / (left[1] + 1) + (g - left[0]) ** 2 / (h - left[1] + 1) - g**2 / (h + 1)
                best = max(best, (gain, name, value))
    gain, name, limit = best
    if not name:
        return Node(value=SHRINK * g / (h + 1))
    sides = [[r for r in rows if (r[name] <= limit) == low] for low in (True, False)]
    return Node(feature=name, limit=limit, low=_grown(sides[0], names, depth - 1), high=_grown(sides[1], names, depth - 1))


@dataclass
class Boosted:
    """Boosted trees and, for each kind, the score from which spans are taken."""

    start: float
    trees: list[Node]
    thresholds: dict[str, float]

    def score(self, row: dict) -> float:
        return self.start + sum(t.of(row) for t in self.trees)

    def column(self) -> Column:
        total = F.lit(self.start)
        for tree in self.trees:
            total = total + tree.column()
        return total


def fitted(cells: list[dict], names: list[str]) -> Boosted:
    """Fits on cells (features, kind, held, good, bad), which count all candidates.

    The trees learn from documents that are not held back. A kind's threshold is the least score from
    which the spans held back are true in a share of ``PRECISION``, counted with one false
    span added; a kind without such a score adds no spans.
    """
    learn = [dict(c) for c in cells if not c["held"]]
    good, bad = sum(c["good"] for c in learn), sum(c["bad"] for c in learn)
    start = math.log((good + 1) / (bad + 1))
    for c in learn:
        c["_s"] = start
    trees = []
    for _ in range(TREES if learn else 0):
        for c in learn:
            p = 1 / (1 + math.exp(-c["_s"]))
            n = c["good"] + c["bad"]
            c["_g"], c["_h"] = c["good"] - n * p, max(n * p * (1 - p), 1e-9)
        tree = _grown(learn, names, DEPTH)
        trees.append(tree)
        for c in learn:
            c["_s"] += tree.of(c)
    model = Boosted(start, trees, {})
    for kind in KINDS:
        true = false = 0.0
        model.thresholds[kind] = math.inf
        scores: dict = {}
        for c in (c for c in cells if c["held"] and c["kind"] == kind):
            own = scores.setdefault(round(model.score(c), 9), [0, 0])
            own[0] += c["good"]
            own[1] += c["bad"]
        for value in sorted(scores, reverse=True):
            true, false = true + scores[value][0], false + scores[value][1]
            if true >= PRECISION * (true + false + 1):
                model.thresholds[kind] = value - 1e-9
    return model


def spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Texts that may hold personal data (row, text and all columns of docs), and the spans
    chosen in them: (row, kind, start, end, base), in code points.

    Candidates are the matches of the base and the wide patterns. A wide one is true for
    fitting if a base span has its place; whether the base rules' own signs hold is no
    feature, so the trees judge by form and context. Base spans always stay; a wide
    candidate is taken from its kind's threshold on where no base span lies.
    """
    rows = docs.where(F.col("text").rlike(r"[0-9@]|(?i)[(\[]at[)\]]"))
    rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()))
    texts = rows.select(F.col("_row").alias("row"), F.translate("text", _OPEN + _CLOSE, "\x03\x03").alias("text"))
    sure = matches(texts, BASE, "base").where(base_holds())
    sure = stored(sure.select("row", "kind", "start", "end"))
    wide = stored(matches(texts, WIDE, "wide").drop("source"))
    near = sure.select(F.col("row").alias("_r"), F.col("kind").alias("_k"), F.col("start").alias("_s"), F.col("end").alias("_e"))
    same = wide.join(
        near.select("_r", "_k", "_s", "_e", F.lit(1).alias("_good")),
        (F.col("row") == F.col("_r")) & (F.col("kind") == F.col("_k")) & (F.col("start") == F.col("_s")) & (F.col("end") == F.col("_e")),
        "left",
    ).drop("_r", "_k", "_s", "_e")
    own = features()
    judged = same.withColumns({name: column for name, (column, _) in own.items()})
    names = list(own)
    # at most a cell for each combination of the features' values
    cells = judged.groupBy("kind", *names, (F.pmod(F.xxhash64("row"), F.lit(3)) == 0).alias("held")).agg(
        F.count("_good").alias("good"), F.sum(F.when(F.col("_good").isNull(), 1).otherwise(0)).alias("bad")
    )
    model = fitted([r.asDict() for r in cells.collect()], names)
    limit = F.lit(math.inf)
    for kind, value in model.thresholds.items():
        limit = F.when(F.col("kind") == kind, F.lit(value)).otherwise(limit)
    taken = judged.where(F.col("_good").isNull()).where(model.column() >= limit).select("row", "kind", "start", "end")
    apart = taken.join(
        near, (F.col("row") == F.col("_r")) & (F.col("start") < F.col("_e")) & (F.col("end") > F.col("_s")), "left_anti"
    )
    return rows, sure.withColumn("base", F.lit(True)).unionByName(apart.distinct().withColumn("base", F.lit(False)))


def found(docs: DataFrame) -> DataFrame:
    """For each row of (doc_id, text): counts of base spans, their digest base_sha256, and all spans.

    Null and empty texts have none; repeated rows are searched each; an empty table gives no
    rows; other columns are ignored.
    """
    rows, chosen = spans(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    span = F.struct(rank.alias("rank"), F.col("start"), F.col("end"), F.col("kind"))
    gathered = chosen.groupBy("row").agg(
        *[F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in KINDS],
        F.sort_array(F.collect_list(F.when(F.col("base"), span))).alias("_base"),
        F.sort_array(F.collect_list(span)).alias("_all"),
    )

    def joined(spans_: str) -> Column:
        return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    hit = rows.select("_row", "doc_id").join(gathered, F.col("_row") == F.col("row"), "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce(joined("_base"), F.lit("")), 256).alias("base_sha256"), F.coalesce(joined("_all"), F.lit("")).alias("spans"),
    )
    others = docs.where(~F.coalesce(F.col("text").rlike(r"[0-9@]|(?i)[(\[]at[)\]]"), F.lit(False))).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), *[F.lit(0).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.lit(""), 256).alias("base_sha256"), F.lit("").alias("spans"),
    )
    return hit.unionByName(others)


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with each chosen span, or run of overlapping ones, replaced by its kind in
    brackets; all columns kept, and rows without spans as they are."""
    rows, chosen = spans(docs)
    before = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("row").orderBy("start", "end")
    runs = (
        chosen.withColumn("new", (F.col("start") >= F.coalesce(F.max("end").over(before), F.lit(-1))).cast("int"))
        .withColumn("run", F.sum("new").over(upto.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("row", "run")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("kind", F.struct("start", "end")).alias("kind"))
    )
    runs = runs.withColumn("from", F.coalesce(F.lag("end").over(Window.partitionBy("row").orderBy("start")), F.lit(0)))
    gaps = runs.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "from", "kind"))).alias("_runs"), F.max("end").alias("_last")
    )
    pieces = F.transform(
        "_runs",
        lambda r: F.concat(
            F.substr(F.col("text"), (r["from"] + 1).cast("int"), (r["start"] - r["from"]).cast("int")),
            F.concat(F.lit("["), F.upper(r["kind"]), F.lit("]")),
        ),
    )
    gaps = gaps.withColumnRenamed("row", "_place")
    rest = F.substr(F.col("text"), (F.col("_last") + 1).cast("int"), F.char_length("text"))
    clean = F.when(F.col("_runs").isNull(), F.col("text")).otherwise(F.concat(F.array_join(pieces, ""), rest))
    met = rows.join(gaps, F.col("_row") == F.col("_place"), "left").withColumn("_clean", clean)
    hit = met.select(*[F.col("_clean").alias(c) if c == "text" else F.col(c) for c in docs.columns])
    others = docs.where(~F.coalesce(F.col("text").rlike(r"[0-9@]|(?i)[(\[]at[)\]]"), F.lit(False)))
    return hit.unionByName(others)
