"""Connected components by alternating star contraction, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.workspace import Workspace


def _rewired(edges: DataFrame, root: DataFrame) -> DataFrame:
    return edges.join(root, "u")


def connected_components(edges: DataFrame, work: Workspace) -> DataFrame:
    """Smallest reachable node of every node on an edge.

    ``edges`` has two columns ``a`` and ``b`` of one orderable type; direction,
    repeats and self loops don't matter, and edges with a null end are ignored.
    Returns ``node, root``; a node whose only edges are self loops isn't
    returned.  Every round is a large-star then a small-star step: neighbours
    are rehung on the smallest neighbour, so paths halve and the rounds grow
    with the logarithm of the longest path.  A star's minimum is a map-side
    combined aggregate and the rehanging a plain equi-join that AQE may split,
    so a hub of any size is no single task.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = work.keep(pairs, "edges")
    seen = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        root = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _rewired(both.where("v > u"), root).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _rewired(large, least).select(
            F.explode(
                F.array(
                    F.struct(F.col("u"), F.col("m").alias("v")),
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                )
            ).alias("e")
        )
        after = work.keep(small.select("e.u", "e.v").where("u <> v").distinct(), "edges")
        state = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        work.drop(now)
        now = after
        if state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
