"""Reachability over an edge table by frontiers."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kartoteka.operators.shared import stored


#: After so many steps the nodes found are written together, so plans of long chains stay small.
COMPACT = 16


def reach(edges: DataFrame, start: DataFrame, most: int | None = None) -> DataFrame:
    """(node, depth) of all nodes that start (node) leads to over edges (src, dst), to the fixpoint; an error if `most` steps do not reach it."""
    seen = stored(start.select("node").distinct().withColumn("depth", F.lit(0)), "frontier")
    frontier = seen
    for depth in count(1):
        step = edges.join(frontier.select(F.col("node").alias("src")), "src").select(F.col("dst").alias("node")).distinct()
        frontier = stored(step.join(seen.select("node"), "node", "left_anti").withColumn("depth", F.lit(depth)), "frontier")
        if frontier.isEmpty():
            return seen
        if most is not None and depth >= most:
            raise RuntimeError(f"new nodes after {most} steps, so the fixpoint is not reached")
        seen = seen.unionByName(frontier)
        if depth % COMPACT == 0:
            seen = stored(seen, "seen")
