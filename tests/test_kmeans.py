"""All runs of the elbow in one pass per step: equal to plain Lloyd runs from the same starts."""

import numpy as np
import pytest

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from salesprism.operators import kmeans as km, segmentation as sg


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(1)
    return np.concatenate([rng.normal(c, 0.6, (300, 3)) for c in ([0, 0, 0], [3, 1, 0], [-2, 4, 1], [5, 5, 5])])


@pytest.fixture(scope="module")
def points(spark, cloud):
    return spark.createDataFrame([(row,) for row in cloud.tolist()], "features array<double>").repartition(5).cache()


def plain_lloyd(x, centres, tolerance=km.TOLERANCE):
    steps = 0
    while True:
        own = ((x[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        moved = np.array([x[own == i].mean(axis=0) if (own == i).any() else c for i, c in enumerate(centres)])
        steps += 1
        done = (((moved - centres) ** 2).sum(axis=1) <= tolerance**2).all()
        centres = moved
        if done:
            return centres, ((x[:, None] - centres[None]) ** 2).sum(axis=2).min(axis=1).sum(), steps


def test_runs_together_are_single_runs(points, cloud):
    begun = [own for k in (2, 3, 5, 8) for own in km.starts(points, k, range(3))]
    runs, scans = km.together(points, begun)
    for run, own in zip(runs, begun, strict=True):
        centres, cost, steps = plain_lloyd(cloud, own)
        assert run.steps == steps and np.allclose(run.centres, centres, atol=1e-9) and np.isclose(run.cost, cost)
    assert scans == max(r.steps for r in runs) + 1 < sum(r.steps for r in runs)


def test_centres_without_points_stay(points, cloud):
    begun = np.array([[0.0, 0, 0], [1e6, 1e6, 1e6]])
    runs, _ = km.together(points, [begun])
    assert np.allclose(runs[0].centres[0], cloud.mean(axis=0)) and (runs[0].centres[1] == 1e6).all()


def test_assignment_is_the_nearest_centre(points, cloud):
    run = sg.fit(points, 4, restarts=4)
    rows = sg.clustered(run, points).collect()
    for r in rows:
        assert r["cluster"] == ((np.array(r["features"]) - run.centres) ** 2).sum(axis=1).argmin()
    assert np.isclose(run.cost, plain_lloyd(cloud, run.centres)[1])


def test_silhouettes_of_all_k_are_the_evaluators(points):
    curve, runs = sg.elbow(points, (2, 3, 4, 6), restarts=2)
    for row in curve.collect():
        assigned = sg.clustered(runs[row["k"]], points).withColumn("v", array_to_vector("features"))
        expected = ClusteringEvaluator(predictionCol="cluster", featuresCol="v").evaluate(assigned)
        assert row["silhouette"] == pytest.approx(expected, abs=1e-9)
    assert sg.best_k(curve) == 4


def test_few_points(spark):
    same = spark.createDataFrame([([1.0, 2.0],)] * 5 + [(None,)], "features array<double>")
    run = sg.fit(same, 3, restarts=2)
    assert run.k == 1 and run.cost == 0 and km.silhouettes(same, [run]) == [0.0]
    none = same.where(F.lit(False))
    runs, scans = km.together(none, km.starts(none, 2, range(2)))
    assert scans == 0 and all(r.k == 0 for r in runs)
