"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is a map-side combined minimum per vertex and one join; every second step is written to the shared
folder.  The driver reads a count and a checksum per round, never vertices or edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from runsight.llm.common import written


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(id, component) for every vertex that is in an edge (a, b); component is the smallest id reachable."""
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct()
    e, mark = _kept(e)
    for _ in range(max_rounds):
        e, new = _kept(_small(_large(e)))
        if new == mark:
            break
        mark = new
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def _kept(e: DataFrame):
    seen = Observation("edges")
    out = written(e.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")), "edges")
    return out, (seen.get["n"], seen.get["x"])


def _large(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
