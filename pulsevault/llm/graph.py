"""Connected components by iterated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsevault.llm.common import stored


def components(edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): the root is the component's smallest node.

    Each round takes the smallest root among a node's neighbours (a partial aggregate, so a node with any
    number of neighbours is one row per task), hooks the old root on to it, and then halves the paths to
    the roots; rounds grow with the logarithm of the longest chain. Every round is a stored table, so a
    lost executor never replays earlier rounds."""
    e = edges.filter("a <> b")
    e = stored(e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-edges")
    labels = stored(e.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("root")), f"{name}-roots")
    for _ in range(max_rounds):
        near = e.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        step = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("new"))
        step = stored(step, f"{name}-step")
        hooked = stored(step.filter("new < old").groupBy(F.col("old").alias("node")).agg(F.min("new").alias("via")), f"{name}-hooks")
        if hooked.isEmpty():
            return labels
        lower = step.join(hooked, "node", "left").select("node", F.least("new", F.coalesce("via", "new")).alias("root"))
        lower = stored(lower, f"{name}-lower")
        up = lower.select(F.col("node").alias("root"), F.col("root").alias("up"))
        labels = stored(lower.join(up, "root", "left").select("node", F.least("root", F.coalesce("up", "root")).alias("root")), f"{name}-roots")
    raise RuntimeError(f"{name}: no fixed point after {max_rounds} rounds")
