"""Exact Jaccard join of word shingles with adaptive multi-match prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from salesprism.llm.components import components
from salesprism.llm.shingles import set_hash, shingle_sets
from salesprism.llm.store import stored
from salesprism.llm.tokens import text_slices

SHARE = 80  # per cent of the union that linked documents have in common
GROUP = 3_000_000  # shingles that one task counts or looks up, about
MOST_MATCHES = 8  # the longest prefix asks for so many shared shingles
ROUNDS = 2  # in which sets look for a hub; the join does the rest
CHECK_COST = 3.0  # of verifying a candidate, in postings that meet
SLICE = 500_000  # characters hashed at once


def least_common(n, share: int = SHARE):
    """Fewest shingles that a set of n has in common with a linked one: overlap >= share * union
    and union >= n."""
    return -(-n * share // 100)


def least_common_as_smaller(n, share: int = SHARE):
    """The same where the other set is not smaller: overlap >= share / (100 + share) * 2 n."""
    return -(-2 * n * share // (100 + share))


def linked(common, a, b, share: int = SHARE):
    return (100 + share) * common >= share * (a + b)


def _hashed(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """Place, set hash and set of each text, some texts at a time."""
    for a, b, own in text_slices(texts, SLICE):
        for i, found in zip(range(a, b), shingle_sets(own)):
            yield i, set_hash(found), found


def members(docs: DataFrame) -> DataFrame:
    """Size and hash of each document's set, and the hash of its text: (doc_id, text_hash,
    n_shingles, class)."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(len(s), h) for _, h, s in _hashed(batch.column("text"))]
            sizes, classes = zip(*found) if found else ([], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(classes, pa.int64())],
                ["doc_id", "text_hash", "n_shingles", "class"],
            )

    picked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return picked.mapInArrow(hashed, "doc_id bigint, text_hash bigint, n_shingles bigint, class bigint")


def _frequency_code(counts: np.ndarray) -> np.ndarray:
    """0 for a shingle of one set, else a number that grows with the logarithm of its sets."""
    codes = 1 + np.floor(8 * np.log2(np.maximum(counts, 1)))
    return np.where(counts == 1, 0, np.minimum(codes, 255)).astype(np.uint8)


def _sent(docs: DataFrame, bits: int) -> DataFrame:
    """The sets cut at 2^bits ranges of hashes: for each range, the sets' classes, how many
    shingles each has there, and the next 32 bits of these in order."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for _, _, texts in text_slices(batch.column("text"), SLICE):
                classes, sets = [], []
                for found in shingle_sets(texts):
                    h = set_hash(found)
                    if len(found) and h not in seen:
                        seen.add(h)
                        classes.append(h)
                        sets.append(found)
                if not sets:
                    continue
                whole = np.concatenate(sets)
                owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
                ranges = (whole >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(whole), np.int64)
                order = np.argsort(ranges, kind="stable")
                tokens = ((whole << np.uint64(bits)) >> np.uint64(32)).astype("<u4")[order]
                owner, ranges = owner[order], ranges[order]
                names = np.array(classes, dtype="<i8")
                rows = []
                edges = np.concatenate([[0], np.flatnonzero(np.diff(ranges)) + 1, [len(ranges)]])
                for x, y in zip(edges[:-1].tolist(), edges[1:].tolist()):
                    own, counts = np.unique(owner[x:y], return_counts=True)
                    rows.append((int(ranges[x]), names[own].tobytes(), counts.astype("<u4").tobytes(), tokens[x:y].tobytes()))
                r, c, n, t = zip(*rows)
                yield pa.RecordBatch.from_pydict({"range": list(r), "classes": list(c), "counts": list(n), "tokens": list(t)})

    return docs.select("text").mapInArrow(cut, "range bigint, classes binary, counts binary, tokens binary")


def _counted(sent: DataFrame, blocks: int) -> DataFrame:
    """Frequency codes of the shingles in each range, by block of classes."""

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        classes = np.concatenate([np.frombuffer(x, "<i8") for x in rows["classes"]])
        sizes = np.concatenate([np.frombuffer(x, "<u4") for x in rows["counts"]]).astype(np.int64)
        tokens = np.concatenate([np.frombuffer(x, "<u4") for x in rows["tokens"]])
        _, first = np.unique(classes, return_index=True)  # copies count once
        starts = np.cumsum(sizes) - sizes
        first = first[np.argsort(np.mod(classes[first], blocks), kind="stable")]
        own, begin, length = classes[first], starts[first], sizes[first]
        places = np.repeat(begin - (np.cumsum(length) - length), length) + np.arange(length.sum())
        taken = tokens[places]
        del tokens, places  # a group's arrays are most of what its task holds
        order = np.argsort(taken)
        taken = taken[order]
        edges = np.flatnonzero(np.concatenate([[True], taken[1:] != taken[:-1], [True]])[: len(taken) + 1])
        codes = np.empty(len(taken), dtype=np.uint8)
        codes[order] = np.repeat(_frequency_code(np.diff(edges)), np.diff(edges))
        block = np.mod(own, blocks)
        edges = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [len(block)]])
        ends = np.concatenate([[0], np.cumsum(length)])
        out = [
            (int(block[x]), int(rows["range"].iloc[0]), own[x:y].astype("<i8").tobytes(),
             length[x:y].astype("<u4").tobytes(), codes[ends[x] : ends[y]].tobytes())
            for x, y in zip(edges[:-1].tolist(), edges[1:].tolist())
        ]
        return pd.DataFrame(out, columns=["block", "range", "classes", "counts", "codes"])

    return sent.groupBy("range").applyInPandas(
        count, "block bigint, range bigint, classes binary, counts binary, codes binary"
    )


def matches_wanted(codes: np.ndarray, shortest: int) -> int:
    """Shared prefix shingles to ask for: the number of least estimated cost.

    A prefix for l matches has l - 1 shingles more than the ``shortest``. All its postings are
    read, and at most their number over l can have l matches and so be verified. ``codes``
    are the sorted frequency codes of the set.
    """
    most = min(MOST_MATCHES, len(codes) - shortest + 1)
    frequent = np.where(codes > 0, np.exp2((codes.astype(np.float64) - 1) / 8), 0.0)
    postings = np.cumsum(frequent[: shortest + most - 1])[shortest - 1 :]
    wanted = np.arange(1, most + 1)
    return int(wanted[np.argmin(postings * (1 + CHECK_COST / wanted))])


_PREFIXES = "class bigint, n bigint, own double, wanted int, prefix array<bigint>, n_index int, shingles binary"


def prefixes(docs: DataFrame, blocks: int, codes: DataFrame, share: int = SHARE) -> DataFrame:
    """One row for each set that can have links: it shares so many shingles with others at all.

    ``own`` is the share of its shingles that no other set has.
    A set's shingles are ordered by frequency, then hash. ``wanted`` matches need the first
    n - least + wanted of them; ``prefix`` holds those that other sets have too, and its first
    ``n_index`` suffice towards sets that are not smaller.
    """

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            rows = []
            for i, h, found in _hashed(batch.column("text")):
                if len(found) and h not in seen:
                    seen.add(h)
                    rows.append((h % blocks, h, i))
            block, name, at = zip(*rows) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(block, pa.int64()), pa.array(name, pa.int64()), batch.column("text").take(pa.array(at, pa.int64()))],
                ["block", "class", "text"],
            )

    def choose(texts: pd.DataFrame, coded: pd.DataFrame) -> pd.DataFrame:
        coded = coded.sort_values("range")
        owners = np.concatenate([np.frombuffer(x, "<i8") for x in coded["classes"]])
        sizes = np.concatenate([np.frombuffer(x, "<u4") for x in coded["counts"]]).astype(np.int64)
        codes_all = np.frombuffer(b"".join(coded["codes"]), np.uint8)
        # ranges ascend, so a set's codes come in the order of its hashes
        order = np.argsort(owners, kind="stable")
        starts = (np.cumsum(sizes) - sizes)[order]
        owners, sizes = owners[order], sizes[order]
        texts = texts.drop_duplicates("class")
        out = []
        names = texts["class"].tolist()
        strings = pa.array(texts.pop("text"), pa.string())
        for i, _, found in _hashed(strings):
            name, n = names[i], len(found)
            a, b = np.searchsorted(owners, name), np.searchsorted(owners, name, side="right")
            codes = np.concatenate([codes_all[s : s + k] for s, k in zip(starts[a:b], sizes[a:b])])
            single = int((codes == 0).sum())
            if n - single < least_common(n, share):
                continue
            order = np.lexsort((found, codes))
            shortest = n - least_common(n, share) + 1
            wanted = matches_wanted(codes[order], shortest)
            prefix = found[order][single : shortest + wanted - 1]
            index = max(0, n - least_common_as_smaller(n, share) + wanted - single)
            out.append((name, n, single / n, wanted, prefix.view(np.int64), index, found.astype("<u8").tobytes()))
        return pd.DataFrame(out, columns=["class", "n", "own", "wanted", "prefix", "n_index", "shingles"])

    texts = docs.select("text").mapInArrow(once, "block bigint, class bigint, text string")
    return texts.groupBy("block").cogroup(codes.groupBy("block")).applyInPandas(choose, _PREFIXES)


def verified(pairs: DataFrame, sets: DataFrame, share: int = SHARE) -> DataFrame:
    """The number of common shingles of each pair (a, b), exactly: adds common, n_a and n_b."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                both = np.concatenate([np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")])
                both.sort()
                common.append(int((both[1:] == both[:-1]).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(common, pa.int64()), batch.column("n_a"), batch.column("n_b")],
                ["a", "b", "common", "n_a", "n_b"],
            )

    first = sets.select(F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("set_a"))
    second = sets.select(F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("set_b"))
    met = pairs.select("a", "b").join(first, "a").join(second, "b")
    return met.mapInArrow(compare, "a bigint, b bigint, common bigint, n_a bigint, n_b bigint").select(
        "a", "b", "common", (F.lit(1.0) - F.col("common") / (F.col("n_a") + F.col("n_b") - F.col("common"))).alias("distance"),
        linked(F.col("common"), F.col("n_a"), F.col("n_b"), share).alias("linked"),
    )


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _with_hubs(postings: DataFrame) -> DataFrame:
    """Each set (a) with its hub (b)."""
    hubs = postings.groupBy(F.col("shingle").alias("_shingle")).agg(
        F.min(F.struct("own", "class")).alias("hub"), F.count(F.lit(1)).alias("_sets")
    ).where("_sets > 1")
    shared = (
        postings.join(hubs, F.col("shingle") == F.col("_shingle"))
        .where("hub.class <> class")
        .groupBy("class", F.col("hub.class").alias("hub"))
        .agg(F.count(F.lit(1)).alias("shared"))
    )
    best = shared.groupBy("class").agg(F.max(F.struct("shared", (-F.col("hub")).alias("less"))).alias("best"))
    return best.select(F.col("class").alias("a"), (-F.col("best.less")).alias("b"))


def links(sets: DataFrame, share: int = SHARE) -> DataFrame:
    """Pairs (a, b) of classes that connect all linked sets: verified links, enough of them
    that sets joined by any link are joined by these.

    Postings are the rows (shingle, set) of all prefixes. First each set is compared with its
    hub: of the sets that are first in its shingles' lists, the one it shares most with. First is the
    set that has the least share of shingles to itself, as what the others were copied from has.
    Sets without one look again
    among themselves. Linked sets form the hub's cluster, which then takes part in the join as one, with its
    members' prefixes, so that a group of near copies yields pairs in its number, not in the
    square of it. Clusters that share as many prefix shingles as the smaller of both wanted
    numbers are candidates: this holds for every pair of linked members. Their hubs are
    compared; members are only compared where neither the hubs' components nor the triangle
    inequality of the Jaccard distance settles it.
    """
    postings = stored(
        sets.select("class", "own", "n_index", F.posexplode("prefix").alias("at", "shingle"))
        .select("class", "own", "shingle", (F.col("at") < F.col("n_index")).alias("index"))
    )
    kept, left = None, postings
    for _ in range(ROUNDS):
        found = stored(verified(_with_hubs(left), sets, share)).where("linked")
        kept = found if kept is None else kept.unionByName(found)
        met = found.select(F.explode(F.array("a", "b")).alias("class")).distinct()
        left = stored(left.join(met, "class", "left_anti"))
    clusters = sets.select("class", "n", "own", "wanted").join(
        kept.select(F.col("a").alias("class"), F.col("b").alias("_hub"), "distance", "common"), "class", "left"
    ).select(
        "class", "n", "wanted", F.coalesce("_hub", "class").alias("cluster"),
        F.coalesce("distance", F.lit(0.0)).alias("radius"), F.round(F.col("own") * F.col("n")).alias("single"),
        F.coalesce("common", "n").alias("of_hub"),
    )
    # what a set has that is neither in its hub nor its alone is all it can share beyond what hubs share
    beyond = F.greatest(F.col("n") - F.col("of_hub") - F.col("single"), F.lit(0.0)).cast("bigint")
    clusters = stored(clusters.withColumn("gain", (100 + share) * beyond - share * F.col("n")))
    about = clusters.groupBy("cluster").agg(
        F.min("wanted").alias("wanted"), F.min("n").alias("least"), F.max("n").alias("most"),
        F.max("radius").alias("radius"), F.max("gain").alias("gain"),
        F.every(F.col("class") == F.col("cluster")).alias("alone"),
    )
    about = stored(about)
    lists = (
        postings.select("class", "shingle", "index")
        .join(clusters.select("class", "cluster"), "class")
        .groupBy("shingle", "cluster")
        .agg(F.max("index").alias("index"))
        .join(about, "cluster")
    )
    lists = stored(lists)
    x, y = lists.where("index").alias("x"), lists.alias("y")
    candidates = (
        x.join(
            y,
            (F.col("x.shingle") == F.col("y.shingle"))
            & (F.col("x.cluster") != F.col("y.cluster"))
            & (F.col("x.least") <= F.col("y.most"))
            & (F.col("x.most") * 100 >= F.col("y.least") * share),
        )
        .groupBy(F.col("x.cluster").alias("p"), F.col("y.cluster").alias("q"))
        .agg(F.count(F.lit(1)).alias("shared"), F.min(F.least("x.wanted", "y.wanted")).alias("wanted"))
        .where("shared >= wanted")
        .select(*_ordered("p", "q"))
        .distinct()
    )
    second = stored(verified(candidates, sets, share))
    edges = kept.select("a", "b").unionByName(second.where("linked").select("a", "b"))
    return edges.unionByName(_between_members(second, clusters, about, sets, edges, share))


def _between_members(
    hubs: DataFrame, clusters: DataFrame, about: DataFrame, sets: DataFrame, edges: DataFrame, share: int
) -> DataFrame:
    """Links of members where their hubs are not linked but near enough that members may be."""
    limit = 1.0 - share / 100 + 1e-9
    # a hub that joined another's cluster is not in its own, so one member alone need not be the hub
    reach = [
        about.select(F.col("cluster").alias(k), *[F.col(c).alias(f"{name}_{k}") for c, name in (("radius", "r"), ("alone", "alone"), ("gain", "gain"))])
        for k in "ab"
    ]
    # Members share at most what their hubs share and what each has beyond its hub and itself, so a link
    # needs (100 + share) * (common + both beyond) >= share * (n_a + n_b). Hubs that are not linked fall short of it by
    # themselves; a group is opened only towards clusters for which one of its members can make that up.
    shared = (100 + share) * F.col("common")
    open_pairs = (
        hubs.where("not linked").join(reach[0], "a").join(reach[1], "b")
        .where(
            ~(F.col("alone_a") & F.col("alone_b")) & (F.col("distance") <= limit + F.col("r_a") + F.col("r_b"))
            & (shared + F.col("gain_a") + F.col("gain_b") >= 0)
        )
        .select("a", "b", "distance", "common", "alone_a", "alone_b", "r_b", "gain_b")
    )
    open_pairs = stored(open_pairs)
    if open_pairs.isEmpty():
        return edges.limit(0)
    roots = components(edges)
    for k in "ab":
        named = roots.select(F.col("node").alias(k), F.col("root").alias(f"root_{k}"))
        open_pairs = open_pairs.join(named, k, "left").withColumn(f"root_{k}", F.coalesce(f"root_{k}", k))
    inside = [
        clusters.select(
            F.col("cluster").alias(k), F.col("class").alias(f"m_{k}"),
            *[F.col(c).alias(f"{c[0]}_{k}_") for c in ("n", "radius", "single", "of_hub", "gain")],
        )
        for k in "ab"
    ]
    # Linked sets differ in (100 - share) / (100 + share) of the sum of their sizes at most. They
    # differ in the shingles that each has alone, none of which is in a hub of another set, and, where
    # one is itself a hub, in at least as many of the other hub's as they have more or fewer of them.
    of_a, of_b = (
        F.when(F.col(f"alone_{one}"), F.abs(F.col(f"o_{other}_") - F.col("common"))).otherwise(0)
        for one, other in ("ba", "ab")
    )
    differ = F.col("s_a_") + F.col("s_b_") + F.greatest(of_a, of_b)
    pairs = (
        open_pairs.where("root_a <> root_b")
        .join(inside[0], "a")
        .where((F.col("distance") - F.col("r_a_") - F.col("r_b") <= limit) & (shared + F.col("g_a_") + F.col("gain_b") >= 0))
        .join(inside[1], "b")
        .where(
            (shared + F.col("g_a_") + F.col("g_b_") >= 0)
            & (F.col("distance") - F.col("r_a_") - F.col("r_b_") <= limit)
            & (F.greatest("n_a_", "n_b_") * share <= F.least("n_a_", "n_b_") * 100)
            & (differ * (100 + share) <= (F.col("n_a_") + F.col("n_b_")) * (100 - share))
        )
        .select(*_ordered("m_a", "m_b"))
        .distinct()
    )
    return verified(pairs, sets, share).where("linked").select("a", "b")


def _rooted(docs: DataFrame, share: int) -> tuple[DataFrame, DataFrame]:
    """``members``, and the root of each class of a set that isn't empty: (class, first, root)."""
    rows = stored(members(docs))
    classes = rows.where("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("first"))
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0
    groups = max(8, -(-total // GROUP))
    bits = (groups - 1).bit_length()
    codes = _counted(_sent(docs, bits), groups)
    sets = stored(prefixes(docs, groups, codes, share))
    roots = components(links(sets, share))
    known = classes.join(roots.select(F.col("node").alias("class"), "root"), "class", "left").withColumn(
        "root", F.coalesce("root", "class")
    )
    return rows, stored(known)


def joined(docs: DataFrame, share: int = SHARE) -> DataFrame:
    """Component of every document of (doc_id, text): doc_id, n_shingles and component_id, the
    least doc_id that links reach. Documents link when 100 * common >= share * union.

    Equal sets are one class, known by the hash of its set, so copies are joined once. Null and
    empty texts have an empty set, which links with nothing: component_id is their doc_id.
    Repeated rows are one class; a null doc_id has a component but is never its least id,
    unless all ids there are null. An empty table gives no rows; other columns are ignored.
    """
    rows, known = _rooted(docs, share)
    named = known.groupBy("root").agg(F.min("first").alias("component_id"))
    of_class = known.select(F.col("class").alias("_class"), "root").join(named, "root").select("_class", "component_id")
    met = rows.join(of_class, (F.col("class") == F.col("_class")) & (F.col("n_shingles") > 0), "left")
    return met.select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def first_of_each(docs: DataFrame, share: int = SHARE) -> DataFrame:
    """One document of each component of ``joined``, the one with its least doc_id, with all
    columns of docs; equal rows count as one. Documents without words all stay. Where an id
    stands on several texts, each is judged by its own component."""
    rows, known = _rooted(docs, share)
    texts = rows.groupBy("doc_id", "text_hash", "n_shingles", "class").agg(F.count(F.lit(1)).alias("copies"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "class", "text_hash", "copies")).alias("least")
    chosen = texts.where("n_shingles > 0").join(known.select("class", "root"), "class").groupBy("root").agg(least)
    empty = texts.where("n_shingles = 0").select("doc_id", "text_hash", "copies")
    first = stored(chosen.select("least.doc_id", "least.text_hash", "least.copies").unionByName(empty))
    kept = docs.join(
        first.select(F.col("doc_id").alias("_first"), F.col("text_hash").alias("_text")),
        F.col("doc_id").eqNullSafe(F.col("_first")) & (F.xxhash64("text") == F.col("_text")), "left_semi",
    )
    # only where a row stands twice can kept rows be equal
    return kept.dropDuplicates(["doc_id", "text"]) if first.where("copies > 1").count() else kept
