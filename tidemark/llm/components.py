"""Connected components of an edge table, with no vertex's neighbours gathered anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import erase, written


def components(edges: DataFrame) -> DataFrame:
    """edges(u, v) -> (v, root) for each vertex but the roots; root is the least vertex of the component.

    Alternates two steps until nothing changes. Large star: each vertex's greater neighbours are tied to its least one.
    Small star: each vertex's lesser neighbours, and itself, are tied to the least. Either keeps the components and at
    most doubles the edges; stars remain after about log2(vertices) rounds. The least neighbour is a partial aggregate,
    and the joins on a vertex are plain shuffled ones, which adaptive execution splits where the centre of a large star
    makes a partition long. The tables of earlier rounds are deleted.
    """

    def least(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("_m"))

    def large(e: DataFrame) -> DataFrame:
        both = e.union(e.select("v", "u"))
        near = least(both).withColumn("_m", F.least("u", "_m"))
        return both.join(near, "u").where("v > u").select(F.col("v").alias("u"), F.col("_m").alias("v")).where("u <> v").distinct()

    def small(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        tied = down.join(least(down), "u")
        return tied.select(F.explode(F.array("u", "v")).alias("u"), F.col("_m").alias("v")).where("u <> v").distinct()

    def state(e: DataFrame) -> tuple:
        h = F.xxhash64("u", "v")
        return tuple(e.agg(F.count("*"), F.bit_xor(h), F.bit_xor(F.xxhash64(h, F.lit(1)))).first())

    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = state(now)
    while before[0]:
        old, now = now, written(small(large(now)), "edges")
        erase(old)
        if (after := state(now)) == before:
            break
        before = after
    return now.select(F.col("u").alias("v"), F.col("v").alias("root"))
