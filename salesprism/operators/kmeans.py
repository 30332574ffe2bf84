"""K-means for many numbers of clusters and many starts at once.

One step reads the points once and moves the centres of every run that is still under way, so the scans are as
many as the longest run has steps, not as many as all runs have together. A task keeps a sum per centre and hands on
one row per centre; the points stay where they are. Distances to all centres are matrix products in numpy, since
as expressions they would be compiled anew with each step's centres.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Points that the starts are drawn from; steps and costs are over all points.
START_SAMPLE = 10_000
#: Distances that are held at once while points are summed, so that they stay in a core's cache.
HELD = 1 << 16
TOLERANCE = 1e-4


@dataclass(frozen=True)
class Run:
    """Centres, the sum of squared distances to them, and the steps it took."""

    centres: np.ndarray
    cost: float
    steps: int

    @property
    def k(self) -> int:
        return len(self.centres)

    def cluster(self, features: Column) -> Column:
        """The nearest centre's number; the first one on ties."""
        far = [
            sum(((features[j] - F.lit(v)) * (features[j] - F.lit(v)) for j, v in enumerate(centre)), F.lit(0.0))
            for centre in self.centres.tolist()
        ]
        return F.array_min(F.array(*[F.struct(d.alias("far"), F.lit(i).alias("i")) for i, d in enumerate(far)]))["i"]


def starts(points: DataFrame, k: int, seeds: Iterable[int], sample: np.ndarray | None = None) -> list[np.ndarray]:
    """K-means++ starts, one per seed, drawn from a bounded sample of ``points`` (features array<double>)."""
    own = sampled_points(points) if sample is None else sample
    return [_plus_plus(own, k, np.random.default_rng([seed, k])) for seed in seeds]


def sampled_points(points: DataFrame) -> np.ndarray:
    """At most START_SAMPLE points, the same ones every time: those with the least hashes."""
    rows = points.select("features").where("features is not null").orderBy(F.xxhash64("features"), "features").limit(START_SAMPLE)
    return np.array([r[0] for r in rows.collect()], dtype=float)


def _plus_plus(points: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Fewer than k centres where there are fewer different points."""
    if not len(points):
        return points
    chosen = [points[rng.integers(len(points))]]
    far = ((points - chosen[0]) ** 2).sum(axis=1)
    while len(chosen) < k and far.sum() > 0:
        chosen.append(points[rng.choice(len(points), p=far / far.sum())])
        far = np.minimum(far, ((points - chosen[-1]) ** 2).sum(axis=1))
    return np.array(chosen)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    lists = batch.column(0).drop_null()
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1) if len(lists) else np.empty((0, 0))


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return sum((points[:, j, None] - centres[None, :, j]) ** 2 for j in range(points.shape[1]))


def _nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distance to the nearest centre of each run, and its place, the first one on ties: (runs, points) each.

    ``centres`` are (places, runs, width)."""

    def distance(place: np.ndarray) -> np.ndarray:
        found = np.zeros((len(place), len(points)))
        for j in range(place.shape[1]):
            part = points[None, :, j] - place[:, j, None]
            part *= part
            found += part
        return found

    far = distance(centres[0])
    own = np.zeros(far.shape, np.int64)
    for i, place in enumerate(centres[1:], 1):
        other = distance(place)
        np.copyto(own, i, where=other < far)
        np.minimum(far, other, out=far)
    return far, own


def _summed(points: DataFrame, runs: Sequence[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """For each run: rows and sums of the points nearest to each centre, and the squared distances in all. One scan."""
    ends = np.cumsum([0, *[len(r) for r in runs]])
    every = np.concatenate(runs)
    width = every.shape[1]
    sizes = np.diff(ends)
    # runs of one size are compared together: their centres by place (k, runs, width), and their first numbers
    alike = []
    for k in np.unique(sizes[sizes > 0]).tolist():
        begin = ends[:-1][sizes == k]
        alike.append((k, begin, np.stack([every[begin + i] for i in range(k)])))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, sums, cost = np.zeros(len(every)), np.zeros((len(every), width)), np.zeros(len(every))
        for batch in batches:
            whole = _matrix(batch)
            for k, begin, centres in alike:
                step = max(1, HELD // len(begin))
                for x in (whole[i : i + step] for i in range(0, len(whole), step)):
                    far, own = _nearest(x, centres)
                    own += begin[:, None]
                    flat = own.ravel()
                    rows += np.bincount(flat, minlength=len(every))
                    for j in range(width):
                        sums[:, j] += np.bincount(flat, weights=np.tile(x[:, j], len(begin)), minlength=len(every))
                    cost += np.bincount(flat, weights=far.ravel(), minlength=len(every))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(every))), pa.array(rows), pa.array(cost), *[pa.array(sums[:, j]) for j in range(width)]],
            names=["centre", "rows", "cost", *[f"s{j}" for j in range(width)]],
        )

    kinds = ", ".join(["centre long, rows double, cost double", *[f"s{j} double" for j in range(width)]])
    found = points.select("features").mapInArrow(partial, kinds).groupBy("centre").agg(
        *[F.sum(c).alias(c) for c in ("rows", "cost", *[f"s{j}" for j in range(width)])]
    ).collect()  # a row per centre
    rows, sums, cost = np.zeros(len(every)), np.zeros((len(every), width)), np.zeros(len(every))
    for r in found:
        rows[r["centre"]], cost[r["centre"]] = r["rows"], r["cost"]
        sums[r["centre"]] = [r[f"s{j}"] for j in range(width)]
    return [(rows[a:b], sums[a:b], float(cost[a:b].sum())) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def together(points: DataFrame, begun: Sequence[np.ndarray], tolerance: float = TOLERANCE, limit: int = 300) -> tuple[list[Run], int]:
    """Runs from the given starts until no centre moves by more than ``tolerance``, and the scans of ``points``.

    A centre without points stays where it is. Runs that have ended are left out of further scans; a
    last one takes the costs of all.
    """
    centres = [np.array(b, dtype=float) for b in begun]
    steps, moving, scans = [0] * len(centres), [i for i, c in enumerate(centres) if len(c)], 0
    active = list(moving)
    while moving and scans < limit:
        found = _summed(points, [centres[i] for i in moving])
        scans += 1
        still = []
        for i, (rows, sums, _) in zip(moving, found, strict=True):
            moved = np.where(rows[:, None] > 0, sums / np.maximum(rows, 1)[:, None], centres[i])
            steps[i] += 1
            if (((moved - centres[i]) ** 2).sum(axis=1) > tolerance**2).any():
                still.append(i)
            centres[i] = moved
        moving = still
    costs = [0.0] * len(centres)
    if active:
        for i, (_, _, cost) in zip(active, _summed(points, [centres[i] for i in active]), strict=True):
            costs[i] = cost
        scans += 1
    return [Run(c, cost, s) for c, cost, s in zip(centres, costs, steps, strict=True)], scans


def silhouettes(points: DataFrame, runs: Sequence[Run]) -> list[float]:
    """Mean silhouette over squared distances of each run, all from two scans.

    The mean squared distance of a point to a cluster follows from the cluster's size, mean and
    spread, so no pairs are formed. A point alone in its cluster, or with one cluster in all, has 0.
    """
    if not runs:
        return []
    sums = _summed(points, [r.centres for r in runs])
    known = []
    for run, (rows, total, _) in zip(runs, sums, strict=True):
        known.append((run.centres, rows, total / np.maximum(rows, 1)[:, None]))
    spread = _spread(points, known)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, n = np.zeros(len(known)), 0
        for batch in batches:
            x = _matrix(batch)
            if not len(x):
                continue
            n += len(x)
            for i, ((centres, rows, means), within) in enumerate(zip(known, spread, strict=True)):
                own = _distances(x, centres).argmin(axis=1)
                # mean squared distance to all points of a cluster: to its mean, and the cluster's own spread
                mean = _distances(x, means) + within[None, :]
                mean[:, rows == 0] = np.inf
                at = np.arange(len(x))
                size = rows[own]
                inner = mean[at, own] * size / np.maximum(size - 1, 1)
                mean[at, own] = np.inf
                outer = mean.min(axis=1)
                real = np.isfinite(outer) & (size > 1) & (np.maximum(inner, outer) > 0)
                whole[i] += ((outer - inner)[real] / np.maximum(inner, outer)[real]).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(known))), pa.array(whole), pa.array(np.full(len(known), float(n)))], names=["run", "s", "n"])

    found = points.select("features").mapInArrow(partial, "run long, s double, n double").groupBy("run").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()
    by_run = {r["run"]: r["s"] / r["n"] if r["n"] else 0.0 for r in found}
    return [by_run.get(i, 0.0) for i in range(len(runs))]


def _spread(points: DataFrame, known: Sequence[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """Mean squared distance of each cluster's points to the cluster's mean."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(len(c)) for c, _, _ in known]
        for batch in batches:
            x = _matrix(batch)
            if not len(x):
                continue
            for total, (centres, _, means) in zip(sums, known, strict=True):
                own = _distances(x, centres).argmin(axis=1)
                total += np.bincount(own, weights=((x - means[own]) ** 2).sum(axis=1), minlength=len(centres))
        flat = np.concatenate(sums)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["centre", "s"])

    found = points.select("features").mapInArrow(partial, "centre long, s double").groupBy("centre").agg(F.sum("s").alias("s")).collect()
    flat = np.zeros(sum(len(c) for c, _, _ in known))
    for r in found:
        flat[r["centre"]] = r["s"]
    ends = np.cumsum([0, *[len(c) for c, _, _ in known]])
    return [flat[a:b] / np.maximum(rows, 1) for a, b, (_, rows, _) in zip(ends[:-1], ends[1:], known, strict=True)]
