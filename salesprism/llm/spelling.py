"""Groups spelling variants: frequent words one edit apart, found over an index of variable-length grams.

Words stand between marks. A dictionary holds every gram of ``SHORTEST`` characters, and each longer one
whose beginning, one character shorter, occurs more than ``OFTEN`` times; so frequent grams are cut out of it and
replaced by longer ones, up to ``LONGEST`` characters. A word is decomposed into the longest
dictionary gram at each place, without those that lie inside an earlier one.

One edit changes the grams that hold the edited place and the one that starts right after it, no others:
what starts later would have to lie inside a gram of the dictionary that reaches over it, whose beginning
would then be frequent and would already have covered it. A word's bound is the largest number of
grams that one edit can affect. Two near words share as many grams, at the same distance from their beginning
or from their end, as either has beyond its bound. So it is enough to merge, for each word, the lists of its
rarest grams, one more than its bound. Words all of whose grams one edit can affect are put into a second
index of all their shortest grams as well, of which an edit affects those that hold its place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from salesprism.llm.store import stored

#: Shortest and longest grams, and how often a gram occurs before longer ones take its place.
SHORTEST, LONGEST, OFTEN = 3, 5, 1000
#: Words have so many code points and occurrences at least.
LEAST_LENGTH, LEAST_COUNT = 5, 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(docs: DataFrame, spoil: int | None = None) -> DataFrame:
    """Each maximal run of letters of the whole texts, A-Z lower-cased, as (word); null texts have none.

    With ``spoil``, a run loses a code point where that number divides the crc32 h of ``<doc_id>:<run>``: the one at
    h modulo its length. A null doc_id counts as empty text.
    """
    found = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_doc"),
        F.explode(F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(r"[A-Za-zÀ-ÿ]+"), F.lit(0))).alias("word"),
    )
    if spoil is None:
        return found.select("word")
    h = F.crc32(F.concat("_doc", F.lit(":"), "word"))
    at = F.pmod(h, F.char_length("word")).cast("int")
    cut = F.concat(F.substr("word", F.lit(1), at), F.substr("word", at + 2))
    return found.select(F.when(F.pmod(h, F.lit(spoil)) == 0, cut).otherwise(F.col("word")).alias("word"))


def vocabulary(words: DataFrame) -> DataFrame:
    """The distinct words (word, n) that are long and frequent enough."""
    return (
        words.groupBy("word").agg(F.count("*").alias("n"))
        .where((F.char_length("word") >= LEAST_LENGTH) & (F.col("n") >= LEAST_COUNT))
    )


def _grams(words: DataFrame, longest: int) -> DataFrame:
    """All grams (id, pos, q, gram) of the marked words, from SHORTEST to longest characters."""
    places = words.select("id", F.concat(F.lit("^"), "word", F.lit("$")).alias("_w"))
    places = places.select("id", "_w", F.explode(F.sequence(F.lit(0), F.char_length("_w") - SHORTEST)).alias("pos"))
    sizes = F.sequence(F.lit(SHORTEST), F.least(F.lit(longest), F.char_length("_w") - F.col("pos")))
    whole = F.substr("_w", F.col("pos") + 1, F.lit(longest))
    return places.select("id", "pos", whole.alias("_g"), F.explode(sizes).alias("q")).select(
        "id", "pos", "q", F.substr("_g", F.lit(1), F.col("q")).alias("gram")
    )


def decomposed(words: DataFrame, longest: int = LONGEST, often: int = OFTEN) -> DataFrame:
    """The grams of each word's decomposition over the dictionary: (id, pos, end, gram, f), f its occurrences in all words."""
    grams = _grams(words, longest)
    counts = grams.groupBy("gram").agg(F.count("*").alias("f"))
    # the longest match is the first gram that is not frequent, or the longest there is
    rank = F.when(F.col("f") > often, F.lit(1000) - F.col("q")).otherwise(F.col("q"))
    best = (
        grams.join(counts, "gram")
        .groupBy("id", "pos")
        .agg(F.min(F.struct(rank.alias("rank"), "q", "gram", "f")).alias("best"))
        .select("id", "pos", (F.col("pos") + F.col("best.q") - 1).alias("end"), "best.gram", "best.f")
    )
    before = Window.partitionBy("id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return best.withColumn("_reach", F.max("end").over(before)).where("_reach is null or end > _reach").drop("_reach")


def bounded(grams: DataFrame, longest: int = LONGEST) -> DataFrame:
    """Adds size, the number of the word's grams, and affected, the most of them that one edit can affect."""
    order = Window.partitionBy("id").orderBy("pos")
    # at the place before a gram: itself, and all that reach there
    here = F.lit(1)
    for k in range(1, longest + 1):
        here = here + F.when(F.lag("end", k).over(order) >= F.col("pos") - 1, 1).otherwise(0)
    whole = Window.partitionBy("id")
    return (
        grams.withColumn("_here", here)
        .withColumn("affected", F.max("_here").over(whole)).withColumn("size", F.count("*").over(whole)).drop("_here")
    )


def _listed(grams: DataFrame, words: DataFrame, least: Column) -> DataFrame:
    """For each word its rarest grams, so many that at most ``least`` - 1 are left out: (word, len, pos, gram)."""
    rarest = Window.partitionBy("id").orderBy("f", "gram", "pos")
    kept = grams.withColumn("_at", F.row_number().over(rarest)).where(F.col("_at") <= F.col("size") - least + 1)
    return kept.select("id", "pos", "gram").join(words.select("id", "word", F.char_length("word").alias("len")), "id").drop("id")


def _merged(lists: DataFrame) -> DataFrame:
    """Pairs (a, b) of words one edit apart out of the lists, b as long as a and after it or one longer.

    Grams meet at the same place in words of one length; in words of two lengths at the same place or
    one further in the longer one. One edit leaves the first half or the rest of the shorter word as it
    is, which is looked at before the pair is verified. Found pairs may repeat.
    """
    def halves(word: str, length: Column) -> list[Column]:
        half = F.floor(length / 2).cast("int")
        return [F.substr(word, F.lit(1), half), F.substr(word, half - length)]

    head, tail = halves("word", F.col("len"))
    shorter = lists.select("gram", "pos", F.col("len").alias("_l"), F.col("word").alias("a"), head.alias("_ah"), tail.alias("_at"))
    longer = lists.select(
        "gram", F.col("word").alias("b"), F.col("len").alias("_n"),
        F.explode(F.array(
            F.struct(F.col("pos").alias("pos"), F.col("len").alias("_l")),
            F.struct(F.col("pos").alias("pos"), (F.col("len") - 1).alias("_l")),
            F.struct((F.col("pos") - 1).alias("pos"), (F.col("len") - 1).alias("_l")),
        )).alias("_to"),
    ).select("gram", "b", "_n", "_to.pos", "_to._l")
    head, tail = halves("b", F.col("_l"))
    longer = longer.withColumn("_bh", head).withColumn("_bt", tail)
    met = shorter.join(longer, ["gram", "pos", "_l"]).where(
        ((F.col("_ah") == F.col("_bh")) | (F.col("_at") == F.col("_bt"))) & ((F.col("_n") > F.col("_l")) | (F.col("a") < F.col("b")))
    )
    return met.where(F.levenshtein("a", "b", 1) == 1).select("a", "b")


def near_pairs(words: DataFrame, longest: int = LONGEST, often: int = OFTEN) -> DataFrame:
    """All pairs (a, b) of the distinct ``words`` (word) with one code point inserted, deleted or replaced, each once."""
    words = stored(words.select("word").distinct().withColumn("id", F.monotonically_increasing_id()))
    # a few files of words become many rows of grams, so they are dealt out first
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = words.repartition(parts, "id")
    grams = stored(bounded(decomposed(words, longest, often), longest))
    known = F.col("size") - F.col("affected")
    found = _merged(_listed(grams, words, F.greatest(known, F.lit(1))))
    # words without a bound of their own meet in grams of one size, of which an edit affects as many as they are long
    weak = stored(words.join(grams.where(known < 1).select("id").distinct(), "id"))
    plain = _grams(weak, SHORTEST)
    counts = plain.groupBy("gram").agg(F.count("*").alias("f"))
    sized = plain.join(counts, "gram").withColumn("size", F.count("*").over(Window.partitionBy("id")))
    found = found.unionByName(_merged(_listed(sized, weak, F.greatest(F.col("size") - SHORTEST, F.lit(1)))))
    return found.distinct()


def grouped(counted: DataFrame, longest: int = LONGEST, often: int = OFTEN) -> DataFrame:
    """For each distinct word of ``counted`` (word, n): form, root, n, n_near, form_n.

    The form is the near word of largest n, the smaller word of equal ones, where its n is twice the word's at
    least; the root is the end of the chain of forms. Null words are left out, repeated ones are added
    up, an empty table gives no rows, other columns are ignored.
    """
    counted = stored(counted.where("word is not null").groupBy("word").agg(F.sum("n").cast("bigint").alias("n")))
    pairs = stored(near_pairs(counted, longest, often))
    sides = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    other = counted.select(F.col("word").alias("b"), F.col("n").alias("_m"))
    best = sides.join(other, "b").groupBy("a").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("_m")).alias("m"), F.col("b").alias("b"))).alias("_best")
    )
    joined = counted.join(best, F.col("word") == F.col("a"), "left")
    worthy = -F.col("_best.m") >= 2 * F.col("n")
    found = stored(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(worthy, F.col("_best.b")).alias("form"), F.when(worthy, -F.col("_best.m")).alias("form_n"),
    ))
    ends = _ends(found.where("form is not null").select("word", F.col("form").alias("root")))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _ends(steps: DataFrame) -> DataFrame:
    """The end of each chain of steps (word, root); n doubles with each step, so a few jumps reach it."""
    steps = stored(steps)
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        jumped = stored(steps.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        steps = jumped.drop("_moved")
        if jumped.where("_moved").isEmpty():
            return steps
