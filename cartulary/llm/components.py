"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartulary.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node of its component, for every node of ``edges(a, b)``.

    Alternating large-star and small-star steps. Each step writes its tables, so lineage stays
    short, and joins two written tables, so that the node of a large star can be split over tasks.
    Edges may repeat. A node that has only an edge to itself is left out; without edges the result
    is empty.
    """
    pairs = stored(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    seen = None
    while True:
        pairs = _star(pairs, large=True)
        pairs = _star(pairs, large=False)
        now = pairs.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.count_if(F.col("u") == F.col("v"))
        ).first()
        if now == seen:
            break
        seen = now
    # No node is under two roots now, and every root stands for itself.
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("root"))
    ).distinct()


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Joins each node's larger (or else its smaller) neighbours with its smallest one."""
    if large:
        near = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = pairs
    least = stored(near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    near = near.where(F.col("v") > F.col("u")) if large else near
    moved = near.join(least.withColumnRenamed("u", "_u"), F.col("u") == F.col("_u")).select(
        F.col("v").alias("u"), F.col("m").alias("v")
    )
    own = least.select("u", F.col("m").alias("v"))
    return stored(
        moved.unionByName(own).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where(
            F.col("u") != F.col("v")
        ).distinct(),
        "star",
    )
