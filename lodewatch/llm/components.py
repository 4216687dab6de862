"""Connected components of an edge table by alternating large-star and small-star steps on Spark.

Each step is a minimum per vertex (map-side combined) and a join back; the edge table is written after each round
to the shared folder, so a lost executor repeats one round at most. Nothing but counts and checksums comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodewatch.session import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Moves edges (a > b) to the least neighbour: of all neighbours (larger ends only), or of the smaller ones."""
    if large:
        directed = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = directed.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        moved = directed.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        directed = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        least = directed.groupBy("u").agg(F.min("v").alias("m"))
        moved = directed.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(vertex, root) for every vertex of `edges` (a, b) that is not itself the least of its component."""
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(mark) == state:
            return now.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
        state = tuple(mark)
        if not state[0]:
            return now.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
        now = stored(_star(_star(now, True), False), "edges")
