"""Runs of several sizes are summed as each alone, over few distances at once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesprism.operators import kmeans as km, segmentation as sg


@pytest.mark.parametrize("held", [1, 64, km.HELD])
def test_sums_of_runs_of_several_sizes(spark, monkeypatch, held):
    monkeypatch.setattr(km, "HELD", held)
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(60, 3)), 2)
    points = spark.createDataFrame([(v.tolist(),) for v in x] + [(None,)], "features array<double>")
    runs = [x[:3].copy(), x[5:7].copy(), x[10:13].copy(), np.vstack([x[:1], x[:1]]), x[:1].copy()]
    for run, (rows, sums, cost) in zip(runs, km._summed(points, runs), strict=True):
        far = ((x[:, None] - run[None]) ** 2).sum(axis=2)
        own = far.argmin(axis=1)
        assert rows.tolist() == np.bincount(own, minlength=len(run)).tolist()
        assert np.allclose(sums, [x[own == i].sum(axis=0) for i in range(len(run))])
        assert np.isclose(cost, far.min(axis=1).sum())


def test_nearest_holds_no_distances_of_all_centres():
    points, centres = np.zeros((5, 2)), np.zeros((4, 3, 2))
    far, own = km._nearest(points, centres)
    assert far.shape == own.shape == (3, 5) and not own.any()


def test_points_have_a_file_per_core(spark):
    customers = spark.range(500).coalesce(1).select(
        F.col("id").alias("customer_id"), (F.col("id") % 30).alias("recency"), (F.col("id") % 7).alias("frequency"), (F.col("id") * 10).alias("monetary_cents")
    )
    points = sg.vectors(customers)
    assert points.count() == 500
    assert len(points.inputFiles()) == spark.sparkContext.defaultParallelism
