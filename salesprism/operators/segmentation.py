"""Customer clusters over recency, frequency and spend.

The silhouette is the linear-time one over squared distances; the all-pairs form does
not scale, so values differ from it and the best k can too.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from salesprism.functions.exact import mean2, money_sum, percent2, ratio2, units
from salesprism.operators.kmeans import Run, sampled_points, silhouettes, starts, together
from salesprism.operators.scaling import Standardiser
from salesprism.session import materialised

MEASURED = ("recency", "frequency", "monetary_cents")
# fixed values: segment names from the highest mean spend down
SEGMENT_NAMES = (
    "High Value Customers", "Regular Customers", "Occasional Buyers", "At Risk Customers",
    "Lost Customers",
)
RESTARTS = 10
SEED = 42
MAX_ITERATIONS = 300  # a safeguard: runs end by their tolerance


def vectors(customers: DataFrame) -> DataFrame:
    """Customers with their standardised measures as ``features``, written once: many passes read it."""
    customers = materialised(customers)
    scaler = Standardiser.fit(customers, MEASURED)
    scaled = scaler.transform(customers).withColumn("features", F.array(*scaler.outputs()))
    # a file per core: few bytes are much work in every step
    cores = customers.sparkSession.sparkContext.defaultParallelism
    return materialised(scaled.drop(*scaler.outputs()).repartition(cores))


def fit_many(
    points: DataFrame, ks: Iterable[int], restarts: int = RESTARTS, seed: int = SEED
) -> dict[int, Run]:
    """Per k the best of several k-means runs by cost; all runs of all k go through the same scans."""
    sample = sampled_points(points)
    begun = [(k, own) for k in ks for own in starts(points, k, range(seed, seed + restarts), sample)]
    runs, _ = together(points, [own for _, own in begun], limit=MAX_ITERATIONS)
    best: dict[int, Run] = {}
    for (k, _), run in zip(begun, runs, strict=True):
        if k not in best or run.cost < best[k].cost:
            best[k] = run
    return best


def fit(points: DataFrame, k: int, restarts: int = RESTARTS, seed: int = SEED) -> Run:
    return fit_many(points, [k], restarts, seed)[k]


def elbow(
    points: DataFrame, ks: Iterable[int] = range(2, 9), restarts: int = RESTARTS
) -> tuple[DataFrame, dict[int, Run]]:
    """Cost and silhouette per k, with the runs."""
    runs = fit_many(points, ks, restarts)
    scores = silhouettes(points, list(runs.values()))
    rows = [(k, run.cost, score) for (k, run), score in zip(runs.items(), scores, strict=True)]
    return points.sparkSession.createDataFrame(rows, "k int, cost double, silhouette double"), runs


def best_k(curve: DataFrame) -> int:
    """The k with the highest silhouette; the smallest one on ties."""
    return curve.orderBy(F.desc("silhouette"), "k").first()["k"]


def clustered(run: Run, points: DataFrame) -> DataFrame:
    return points.withColumn("cluster", run.cluster(F.col("features")))


def cluster_profile(assigned: DataFrame) -> DataFrame:
    """Mean measures per cluster and its rank by mean spend."""
    size = F.count(F.lit(1))
    profile = assigned.groupBy("cluster").agg(
        size.alias("customers"),
        ratio2(F.sum("recency"), size).alias("recency"),
        ratio2(F.sum("frequency"), size).alias("frequency"),
        mean2(money_sum("monetary_cents"), size).alias("monetary"),
        *([ratio2(F.sum("rfm_score"), size).alias("rfm_score_mean")] if "rfm_score" in assigned.columns else []),
    )
    # as many rows as clusters
    return profile.withColumn(
        "spend_rank", F.row_number().over(Window.orderBy(F.desc("monetary"), "cluster"))
    )


def segment_name(rank: Column) -> Column:
    names = F.array(*[F.lit(n) for n in SEGMENT_NAMES])
    numbered = F.concat(F.lit("Segment "), rank.cast("string"))
    return F.when(rank <= len(SEGMENT_NAMES), F.element_at(names, rank)).otherwise(numbered)


def segment_customers(scored: DataFrame, k: int | None = None) -> DataFrame:
    """Customers with cluster and segment name; without k the best silhouette decides."""
    points = vectors(scored)
    if k is None:
        curve, runs = elbow(points)
        run = runs[best_k(curve)]
    else:
        run = fit(points, k)
    return labelled(clustered(run, points))


def labelled(assigned: DataFrame) -> DataFrame:
    """Customers with the business name of their cluster."""
    names = cluster_profile(assigned).select("cluster", segment_name(F.col("spend_rank")).alias("segment"))
    # one row per cluster, so the broadcast side is bounded by k
    return assigned.join(F.broadcast(names), "cluster")


def segment_summary(segmented: DataFrame) -> DataFrame:
    size = F.count(F.lit(1))
    grouped = segmented.groupBy("segment").agg(
        size.alias("customers"),
        ratio2(F.sum("recency"), size).alias("avg_recency_days"),
        ratio2(F.sum("frequency"), size).alias("avg_frequency"),
        mean2(money_sum("monetary_cents"), size).alias("avg_monetary"),
        money_sum("monetary_cents").alias("cents"),
    )
    whole = F.sum("cents").over(Window.partitionBy())
    return grouped.select(
        "segment", "customers", percent2(F.col("customers"), F.sum("customers").over(Window.partitionBy())).alias("customers_pct"),
        "avg_recency_days", "avg_frequency", "avg_monetary",
        units("cents").alias("total_revenue"),
        percent2(F.col("cents"), whole).alias("revenue_share_pct"),
    ).orderBy(F.desc("total_revenue"), "segment")


def projection(segmented: DataFrame) -> tuple[DataFrame, PCAModel]:
    """Customers on the first two principal components; the model has the explained
    variance. The sign of a component is arbitrary."""
    segmented = segmented.withColumn("_v", array_to_vector("features"))
    model = PCA(k=2, inputCol="_v", outputCol="_pc").fit(segmented)
    placed = model.transform(segmented).withColumn("_xy", vector_to_array("_pc"))
    points = placed.select(
        "customer_id", "segment", F.col("_xy")[0].alias("pc1"), F.col("_xy")[1].alias("pc2")
    )
    return points, model


def sampled(df: DataFrame, n: int, key: str, seed: int = SEED) -> DataFrame:
    """n rows picked by a seeded hash of the key, the same ones every time."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(n)
