"""Near-duplicate vectors by sorted projection passes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from salesprism.llm.components import components
from salesprism.llm.store import stored
from salesprism.operators.windows import global_row_number

LEAST = 0.98
WINDOW = 24  # neighbours in the order of a pass that a vector is compared with
BITS = 62  # signs of random projections, most significant first, that a pass orders by
MISSED = 1e-4  # chance that no pass brings a pair of the least similarity into a window
FIRST_PASSES = 4  # passes from which on the number that a vector needs is foreseen
MOST_PASSES = 64  # vectors that would need more are compared with each other instead
FEW = 256  # vectors of a group that are cheaper to compare with each other than to order again
CHUNK = 2048  # rows of a pass compared in one group
BLOCK = 1024  # vectors compared with as many others in one group
SUBGROUP = 1024  # rows of a component compared with each other in one group


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """All rows in double precision: vec_id, class (equal label and embedding), group (label and
    dimension) and unit, which is null for rows that cannot link."""
    able = F.col("label").isNotNull() & (F.size("embedding") > 0)
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.xxhash64("label", "embedding").alias("class"),
        F.xxhash64(F.col("label"), F.size("embedding")).alias("group"),
        F.when(able, F.col("embedding").cast("array<double>")).alias("embedding"),
    )

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units: list[bytes | None] = []
            for values in batch.column("embedding").to_pylist():
                v = np.array(values or [np.nan], dtype=np.float64)  # null components become not a number
                most = np.abs(v).max() if np.isfinite(v).all() else 0.0
                v = v / most if most > 0 else v
                units.append((v / np.sqrt(v @ v)).astype("<f8").tobytes() if most > 0 else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("class"), batch.column("group"), pa.array(units, pa.binary())],
                ["vec_id", "class", "group", "unit"],
            )

    return rows.mapInArrow(scaled, "vec_id bigint, class bigint, group bigint, unit binary")


def centres(classes: DataFrame) -> DataFrame:
    """Mean of the vectors of each group: (group, centre)."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            groups = batch.column("group").to_numpy()
            for g in np.unique(groups).tolist():
                v = np.stack([np.frombuffer(batch.column("unit")[i].as_buffer(), "<f8") for i in np.flatnonzero(groups == g)])
                n, total = sums.get(g, (0, np.zeros(v.shape[1])))
                sums[g] = n + len(v), total + v.sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()), pa.array([n for n, _ in sums.values()], pa.int64()),
             pa.array([t.astype("<f8").tobytes() for _, t in sums.values()], pa.binary())],
            ["group", "n", "total"],
        )

    def mean(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(t, "<f8") for t in rows["total"]], axis=0)
        return pd.DataFrame({"group": rows["group"].iloc[:1], "centre": [(total / rows["n"].sum()).tobytes()]})

    parts = classes.select("group", "unit").mapInArrow(added, "group bigint, n bigint, total binary")
    return parts.groupBy("group").applyInPandas(mean, "group bigint, centre binary")


def _ordered(classes: DataFrame, turn: int) -> DataFrame:
    """Adds the sort key of a pass, concatenated signs of random projections of the vector from
    its group's centre, and its distance from there."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict = {}
        for batch in batches:
            units = [np.frombuffer(u.as_buffer(), "<f8") for u in batch.column("unit")]
            middle = [np.frombuffer(u.as_buffer(), "<f8") for u in batch.column("centre")]
            keys, away = np.zeros(len(units), dtype=np.int64), np.zeros(len(units))
            sizes = np.array([len(u) for u in units])
            for size in set(sizes.tolist()):
                if size not in planes:
                    planes[size] = np.random.default_rng([turn, size]).normal(size=(size, BITS))
                own = np.flatnonzero(sizes == size)
                v = np.stack([units[i] for i in own]) - np.stack([middle[i] for i in own])
                keys[own] = (v @ planes[size] > 0) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))
                away[own] = np.sqrt(np.einsum("ij,ij->i", v, v))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("class", "group", "unit")], pa.array(keys), pa.array(away)],
                ["class", "group", "unit", "key", "away"],
            )

    return classes.select("class", "group", "unit", "centre").mapInArrow(
        hashed, "class bigint, group bigint, unit binary, key bigint, away double"
    )


def log_missed(keys: np.ndarray, away: np.ndarray, least: float = LEAST) -> np.ndarray:
    """Logarithm of the chance that a pass misses a vector's pair of the least similarity, for
    vectors of a group in the order of the pass.

    A sign parts two vectors at angle a, as seen from the centre, with probability a / pi. Whoever
    shares more first signs with a vector than the ``WINDOW``-th neighbours do is inside its window.
    """
    shared = np.full(len(keys), -1)  # where there are fewer neighbours, all are in the window
    if len(keys) > WINDOW:
        alike = BITS - np.frexp((keys[:-WINDOW] ^ keys[WINDOW:]).astype(np.float64))[1]
        shared[:-WINDOW] = alike
        shared[WINDOW:] = np.maximum(shared[WINDOW:], alike)
    apart = math.sqrt(2 - 2 * least) / np.maximum(away, 1e-12)
    together = np.where(apart < 1, 1 - np.arcsin(np.minimum(apart, 1)) / math.pi, 0.0)
    found = np.where(shared >= BITS, 0.0, together ** (shared + 1))
    return np.log1p(-np.minimum(found, 1 - 1e-12))


def window_pairs(classes: DataFrame, turn: int, least: float = LEAST) -> DataFrame:
    """Pairs (a, b) of classes that are near in the order of a pass and similar enough; and for
    each class a without b its group and ``log_missed``."""
    placed = global_row_number(_ordered(classes, turn), ["group", "key", "class"], "place")
    own, at = F.floor(F.col("place") / CHUNK), F.col("place") % CHUNK
    # rows at either end of a chunk are also neighbours of those of the chunk next to it
    chunks = F.array_compact(F.array(own, F.when(at < WINDOW, own - 1), F.when(at >= CHUNK - WINDOW, own + 1)))
    dealt = placed.select("class", "group", "unit", "key", "away", "place", F.explode(chunks).alias("chunk"))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        group, names = rows["group"].to_numpy(), rows["class"].to_numpy()
        keys, away = rows["key"].to_numpy(), rows["away"].to_numpy()
        inside = (rows["place"] // CHUNK == rows["chunk"]).to_numpy()
        units = [np.frombuffer(u, "<f8") for u in rows["unit"]]
        found, missed = [], np.zeros(len(rows))
        edges = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]])
        for x, y in zip(edges[:-1].tolist(), edges[1:].tolist()):
            missed[x:y] = log_missed(keys[x:y], away[x:y], least)
            if y - x > 1:
                v, own = np.stack(units[x:y]), names[x:y]
                for k in range(1, min(WINDOW, y - x - 1) + 1):
                    hit = np.flatnonzero(np.einsum("ij,ij->i", v[:-k], v[k:]) >= least)
                    found.append(np.stack([np.minimum(own[hit], own[hit + k]), np.maximum(own[hit], own[hit + k])], axis=1))
        pairs = np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64)
        return pd.DataFrame(
            {
                "a": np.concatenate([pairs[:, 0], names[inside]]),
                "b": pd.array([*pairs[:, 1].tolist(), *[None] * int(inside.sum())], dtype="Int64"),
                "group": np.concatenate([np.zeros(len(pairs), np.int64), group[inside]]),
                "missed": np.concatenate([np.zeros(len(pairs)), missed[inside]]),
            }
        )

    return dealt.groupBy("chunk").applyInPandas(compare, "a bigint, b bigint, group bigint, missed double")


def _met(members: DataFrame, most: int) -> DataFrame:
    """Rows of groups of ``size`` dealt to parts of about ``most``, and these to pairs (low, high)
    of parts, so that every two rows of a group meet."""
    parts = F.ceil(F.col("size") / most)
    part = F.pmod(F.xxhash64("class"), parts)
    meets = F.transform(
        F.sequence(F.lit(0).cast("bigint"), parts - 1),
        lambda other: F.struct(F.least(part, other).alias("low"), F.greatest(part, other).alias("high")),
    )
    return members.select("*", part.alias("part"), F.explode(meets).alias("meet")).select("*", "meet.low", "meet.high").drop("meet")


def joined_pairs(left: DataFrame, least: float = LEAST) -> DataFrame:
    """All links among (class, group, unit), exactly: pairs (a, b) that connect what they connect,
    fewer than there are vectors in two parts that meet."""
    sizes = left.groupBy(F.col("group").alias("_group")).agg(F.count(F.lit(1)).alias("size"))
    sized = left.select("class", "group", "unit").join(sizes, F.col("group") == F.col("_group")).drop("_group")

    def connect(rows: pd.DataFrame) -> pd.DataFrame:
        v, names = np.stack([np.frombuffer(u, "<f8") for u in rows["unit"]]), rows["class"].to_numpy()
        low, high = (np.flatnonzero((rows["part"] == rows[side]).to_numpy()) for side in ("low", "high"))
        alike = (v[low] @ v[high].T) >= least
        roots, none = np.arange(len(names)), len(names)
        while True:
            before = roots.copy()
            roots[low] = np.minimum(roots[low], np.where(alike, roots[high][None, :], none).min(axis=1, initial=none))
            roots[high] = np.minimum(roots[high], np.where(alike, roots[low][:, None], none).min(axis=0, initial=none))
            roots = roots[roots]
            if (roots == before).all():
                break
        own = np.flatnonzero(roots != np.arange(len(names)))
        return pd.DataFrame({"a": names[roots[own]], "b": names[own]})

    return _met(sized, BLOCK).groupBy("group", "low", "high").applyInPandas(connect, "a bigint, b bigint")


def link_counts(members: DataFrame, least: float = LEAST) -> DataFrame:
    """For each class of (class, unit, copies, root, size): the number of vectors of other
    classes in its component that it links with.

    A component is dealt to subgroups, and every two of them are compared in one group; only
    counts leave it, never pairs.
    """
    dealt = _met(members.select("class", "unit", "copies", "root", "size"), SUBGROUP)

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        v = np.stack([np.frombuffer(u, "<f8") for u in rows["unit"]])
        low = (rows["part"] == rows["low"]).to_numpy()
        copies, names = rows["copies"].to_numpy(), rows["class"].to_numpy()
        high = (rows["part"] == rows["high"]).to_numpy()
        alike = (v[low] @ v[high].T) >= least
        alike &= names[low][:, None] != names[high][None, :]
        if rows["low"].iloc[0] == rows["high"].iloc[0]:
            return pd.DataFrame({"class": names[low], "links": alike @ copies[high]})
        return pd.DataFrame(
            {
                "class": np.concatenate([names[low], names[high]]),
                "links": np.concatenate([alike @ copies[high], copies[low] @ alike]),
            }
        )

    partial = dealt.groupBy("root", "low", "high").applyInPandas(count, "class bigint, links bigint")
    return partial.groupBy("class").agg(F.sum("links").alias("links"))


def _pairs(classes: DataFrame, number: int, least: float) -> DataFrame:
    """Pairs (a, b) of (class, group, unit) that connect all linked classes, by passes as long as
    these pay, then by comparing those that the passes left with each other."""
    middle = stored(centres(classes)).withColumnRenamed("group", "_group")
    centred = classes.join(middle, F.col("group") == F.col("_group")).select("class", "group", "unit", "centre")
    active, scores, pairs, turn = centred, None, None, 0
    enough = math.log(MISSED)
    while True:
        found = stored(window_pairs(active, turn, least).distinct())
        near = found.where("b is not null").select("a", "b")
        pairs = near if pairs is None else pairs.unionByName(near)
        own = found.where("b is null").select(F.col("a").alias("class"), "group", "missed")
        if scores is not None:
            own = own.join(scores.select("class", F.col("missed").alias("so_far")), "class").select(
                "class", "group", (F.col("missed") + F.col("so_far")).alias("missed")
            )
        scores = stored(own.where(F.col("missed") > enough))
        turn += 1
        done_in_time = F.col("missed") <= turn * enough / MOST_PASSES
        of_group = scores.groupBy("group").agg(
            F.count(F.lit(1)).alias("n"), F.count(F.when(done_in_time, F.lit(1))).alias("soon")
        )
        n = F.col("n").cast("double")
        later = n - F.col("soon") if turn >= FIRST_PASSES else F.lit(0.0)
        saved = of_group.agg(F.sum(n * n - later * later)).first()[0]  # comparisons that more passes save
        if saved is None:
            return pairs
        active = centred.join(scores.select("class"), "class", "left_semi")
        if saved <= FEW * number:
            return pairs.unionByName(stored(joined_pairs(active, least)))


def near_duplicates(vectors: DataFrame, least: float = LEAST) -> DataFrame:
    """For each row of (vec_id, embedding, label): n_links, component_id and kept.

    Vectors of equal label and dimension link from cosine ``least`` on. Equal vectors are one
    class. Each pass orders the classes by concatenated random signs, taken from their group's
    centre, and compares each with the next ``WINDOW``. How dense the order is around a class gives the
    chance that the pass misses a pair of it; a class leaves when the passes so far miss one with
    probability ``MISSED`` at most. Classes that are left when the others are done, in dense places, are all
    compared with each other. Verified pairs form components, inside which links are
    then counted exactly. Vectors that are null, empty, zero or not finite, and rows without a
    label, link with nothing: component_id is their vec_id. Repeated rows are vectors of their own, a
    null vec_id never names a component; an empty table gives no rows; other columns are ignored.
    """
    rows = stored(unit_vectors(vectors))
    classes = stored(
        rows.where("unit is not null").groupBy("class").agg(
            F.first("group").alias("group"), F.first("unit").alias("unit"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first")
        )
    )
    number = classes.count()
    pairs = None
    if number > 1:
        pairs = _pairs(classes, number, least)
    if pairs is None:
        pairs = classes.select(F.col("class").alias("a"), F.col("class").alias("b")).limit(0)
    roots = components(pairs)
    named = classes.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    named = stored(named)
    about = named.groupBy("root").agg(F.count(F.lit(1)).alias("size"), F.min("first").alias("component_id"))
    placed = stored(named.join(about, "root"))
    links = link_counts(placed.where("size > 1"), least)
    of_class = placed.join(links, "class", "left").select(
        F.col("class").alias("_class"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    met = rows.join(of_class, (F.col("class") == F.col("_class")) & F.col("unit").isNotNull(), "left")
    component = F.when(F.col("_class").isNotNull(), F.col("component_id")).otherwise(F.col("vec_id"))
    return met.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
