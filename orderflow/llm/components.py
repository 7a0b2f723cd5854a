"""Connected components of an edge table by joins: hooking to the least neighbour, then pointer jumping."""

from pyspark.sql import functions as F

from orderflow.llm.common import written


def _followed(parents):
    """Every node with the root of its tree: paths are halved until none is left."""
    while True:
        up = parents.select(F.col("node").alias("n"), F.col("parent").alias("up")).where("n <> up")
        step = parents.join(up, F.col("parent") == F.col("n"), "left")
        parents = written(step.select(
            "node", F.coalesce("up", "parent").alias("parent"), F.col("up").isNotNull().alias("moved")
        ), "parents")
        if not parents.where("moved").limit(1).count():
            return parents.select("node", "parent")
        parents = parents.select("node", "parent")


def components(edges):
    """`node` and `component` (the least node of it) of all nodes that have an edge (a, b)."""
    edges = written(edges.select("a", "b").where("a <> b").distinct(), "edges")
    labels = None
    while True:
        ends = edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
        ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
        parents = ends.groupBy("node").agg(F.min("other").alias("least"))
        parents = _followed(written(parents.select("node", F.least("node", "least").alias("parent")), "parents"))
        if labels is None:
            labels = parents.select("node", F.col("parent").alias("component"))
        else:
            up = parents.select(F.col("node").alias("n"), "parent")
            labels = labels.join(up, F.col("component") == F.col("n"), "left")
            labels = written(labels.select("node", F.coalesce("parent", "component").alias("component")), "labels")
        left = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        right = parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        edges = edges.join(left, "a").join(right, "b").select(F.col("pa").alias("a"), F.col("pb").alias("b"))
        edges = written(edges.where("a <> b").distinct(), "edges")
        if not edges.limit(1).count():
            return labels
