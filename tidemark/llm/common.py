"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.store import erase, shared_dir, written

__all__ = ["erase", "pieces", "salted_join", "shared_dir", "table", "told_apart", "unit", "written"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches in slices of at most so many rows, so that few texts are Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def unit(*cols: Column | str, seed: int) -> Column:
    """A hash of cols as a long; equal rows get equal values, whatever task computes them."""
    return F.xxhash64(F.lit(seed), *cols)


def salted_join(left: DataFrame, right: DataFrame, key: str, spread: Column, salts: int = 32) -> DataFrame:
    """left.join(right, key, "left") where right has each key once: a hot key of left is dealt over `salts` tasks.

    spread: any column of left whose values differ within a key. right grows `salts`-fold, so it should be narrow.
    """
    left = left.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [key, "_salt"], "left").drop("_salt")


def told_apart(df: DataFrame, key: str, rows_per_chunk: int = 65_536) -> DataFrame:
    """df, written, with _copy: rows of one key are numbered from 0, gapless.

    Equal rows get different hashes of key and number, so that they spread over tasks. A group is numbered chunk by chunk
    of the places where its rows were written, so no task holds a whole one; where keys are hashes of whole rows it makes
    no difference which row has which number. Only keys and places are shuffled, and rows are joined only if a key repeats.
    """
    df = written(df.withColumn("_place", F.monotonically_increasing_id()), "places")
    narrow = df.select(key, "_place")
    many = written(narrow.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").select(key, F.lit(True).alias("_many")), "equal-keys")
    if many.isEmpty():
        erase(many)
        return df.drop("_place").withColumn("_copy", F.lit(0).cast("long"))
    again = salted_join(narrow, many, key, F.col("_place")).where("_many").drop("_many")
    again = written(again.withColumn("_part", F.floor(F.col("_place") / rows_per_chunk)), "equal-rows")
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = again.groupBy(key, "_part").agg(F.count("*").alias("_n")).select(key, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy(key, "_part").orderBy("_place")) - 1
    copies = again.withColumn("_in", inside).join(starts, [key, "_part"]).select("_place", (F.col("_start") + F.col("_in")).alias("_copy"))
    copies = written(copies.where("_copy > 0"), "copies")
    erase(many, again)
    return df.join(copies, "_place", "left").drop("_place").withColumn("_copy", F.coalesce("_copy", F.lit(0).cast("long")))
