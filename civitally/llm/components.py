"""Connected components of a distributed edge table by alternating star contraction.

Every round hangs neighbours on the smallest node they can see: the large star moves
larger neighbours, the small star moves smaller ones. Both are a map-side combined
minimum and a join on the node; a node with very many edges is a skewed join side,
which adaptive execution splits. Rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import Workspace


def _star(directed: DataFrame, larger: bool) -> DataFrame:
    """One contraction over edges (u, v): v hangs on the smallest node u sees."""
    least = directed.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    pairs = directed.join(least, "u")
    if larger:
        moved = pairs.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = pairs.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.where("u <> v").distinct()


def components(edges: DataFrame, ws: Workspace, label: str = "cc") -> DataFrame:
    """``node, component`` of every node with an edge; the component is its least node.

    ``edges`` has two columns of one orderable type. Repeated edges and loops are
    harmless; null ends are dropped. No edges give no rows.
    """
    a, b = edges.columns
    edges = edges.dropna()
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    stars = ws.stage(
        pairs.where("u <> v").distinct(),
        f"{label}-0",
    )
    seen, step = None, 0
    while True:
        state = stars.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == seen or not state[0]:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        seen, step = state, step + 1
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = ws.stage(_star(both, larger=True), f"{label}-{step}l")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        stars = ws.stage(_star(down, larger=False), f"{label}-{step}s")
