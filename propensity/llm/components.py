"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm.common import discard, staged


def _signature(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.where("v > u").join(low, "u").where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    return (down.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                      F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u <> v").distinct())


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` -> ``(u, v)``: every vertex that has an edge to a smaller
    one, with the smallest vertex of its component (which itself is not listed).

    Each round contracts neighbourhoods towards their minimum by grouped
    minima and joins; the edge table is written after every round, so lineage
    stays one round long and neither vertices nor links reach the driver.
    """
    spark = edges.sparkSession
    now, path = staged(edges.where("u <> v").select("u", "v").distinct(), "edges")
    seen = _signature(now)
    while True:
        following, new_path = staged(_small_star(_large_star(now)), "edges")
        discard(spark, path)
        now, path = following, new_path
        sign = _signature(now)
        if sign == seen:
            return now
        seen = sign
