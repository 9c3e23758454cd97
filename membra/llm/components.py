"""Connected components of an edge table by alternating star contractions.

Each round joins every edge to the smallest neighbour of its ends (large star,
then small star) and is written to the shared folder, so neither links nor
labels reach the driver and a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

#: least files of a round, and the edges for each where there are more
LEAST_FILES, FILE_EDGES = 12, 20_000


def _mark(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node with an edge: the smallest node reachable.

    Loops, repeated edges and either direction are fine; no edges give no rows."""
    e = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct()
    e = staged(e, "edges")
    mark = _mark(e)
    while mark[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = e.join(low, e["a"] == low["u"]).select(F.col("m").alias("a"), "b")  # repeats go below
        low = large.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m"))
        near = large.join(low, large["b"] == low["u"]).select("m", F.explode(F.array("a", "u")).alias("x"))
        new = near.where("m < x").select(F.col("m").alias("a"), F.col("x").alias("b")).distinct()
        new = staged(new.coalesce(max(LEAST_FILES, mark[0] // FILE_EDGES)), "edges")
        before, mark = mark, _mark(new)
        e = new
        if mark == before:
            break
    return e.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        e.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
