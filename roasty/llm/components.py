"""Connected components of an edge table, by Spark joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roasty.llm.common import discard, stored


def _checksum(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).collect()[0]
    return r["n"], r["s"]


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``u, v`` with v the smallest node that u reaches, for every node of the
    edge table (columns ``u, v``) that is not itself the smallest.

    Each round turns the edges to the smallest neighbour, first of the larger
    nodes, then of the smaller ones, until nothing changes: rounds grow with
    the logarithm of the longest chain. Each round is written, so lost
    executors cost one round."""
    now = stored(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    seen = _checksum(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("c")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "c")
        small = large.join(small_least, F.col("u") == F.col("c")).select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")
        ).select("e.*").filter("u != v").distinct()
        before, now = now, stored(small, name)
        discard(before)
        after = _checksum(now)
        if after == seen:
            break
        seen = after
    return now
