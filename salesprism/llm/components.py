"""Connected components of large graphs by hooking to the least neighbour and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from salesprism.llm.store import stored


def components(edges: DataFrame) -> DataFrame:
    """For each node of the undirected ``edges`` (a, b), the least node it reaches: (node, root).

    A round gives every node its least neighbour as parent where that is smaller, follows
    parents to their roots by pointer jumping, and puts roots for nodes in the edges. Nodes
    that are not local minima vanish, so few rounds remain even for long chains. Hot nodes
    only meet in aggregates that combine on the map side and in joins that can be split.
    Every round is a stored table; only counts reach the driver.
    """
    left = stored(edges.select("a", "b").where("a <> b").distinct())
    labels = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root"))
        parents = _flat(stored(parents))
        labels = parents if labels is None else stored(_renamed(labels, parents, "root"))
        met = _renamed(_renamed(left, parents, "a"), parents, "b")
        left = stored(met.where("a <> b").distinct())
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    return labels


def _renamed(df: DataFrame, parents: DataFrame, column: str) -> DataFrame:
    """The root of each value of the column, or the value itself."""
    roots = parents.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    met = df.join(roots, F.col(column) == F.col("_node"), "left")
    return met.withColumn(column, F.coalesce("_root", column)).drop("_node", "_root")


def _flat(parents: DataFrame) -> DataFrame:
    """Every node's root instead of its parent."""
    while True:
        jumped = stored(_renamed(parents.withColumn("was", F.col("root")), parents, "root"))
        moved = not jumped.where("root <> was").isEmpty()
        parents = jumped.drop("was")
        if not moved:
            return parents
