"""Connected components by alternating star contraction, each round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 100) -> DataFrame:
    """(id, component): every node of the edges, with the smallest node that it reaches.

    Large stars hang every larger neighbour on the smallest one; small stars hang
    the smaller ones on it.  Both keep components and neither adds edges, and the
    rounds needed grow with the logarithm of the size.  Only minima are grouped
    by node, with partial sums, and the joins back are of the kind that Spark
    splits under skew.  Loops and null ends are ignored.
    """
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct()
    now, before = materialize(now, "edges"), None
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m"))
        large = both.join(least, "u").filter((F.col("v") > F.col("u")) & (F.col("v") != F.col("m"))).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(least, "u")
        small = tied.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        now = materialize(small, "stars")
        state = tuple(now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
