"""The corpus pipeline: language ID, near-dedup, decontamination, mixing and sharding of `documents`.

Each stage takes all rows that the one before kept and returns their columns, with row_key up to mixing. Rows with null or
repeated doc_ids are rows of their own; an empty table passes through as an empty one; other columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table, written
from tidemark.llm.decontaminate import decontaminate
from tidemark.llm.langid import held_out, predict, train
from tidemark.llm.mixing import mix
from tidemark.llm.neardup import near_duplicates
from tidemark.llm.shards import document_shards


def keyed(docs: DataFrame) -> DataFrame:
    """docs with row_key, a key of each row: its doc_id, but a new one where that is null or another row has it already.

    New keys lie above all doc_ids. Of rows that share a doc_id, the one with the least hash of its text has it as key.
    Texts are written once and not shuffled: only the places of rows with new keys are looked up.
    """
    if "row_key" in docs.columns:
        return docs
    docs = written(docs.withColumn("_place", F.monotonically_increasing_id()), "keyed")
    above = docs.agg(F.coalesce(F.max("doc_id"), F.lit(0)) + 1).first()[0]
    first = F.min(F.struct(F.xxhash64("text").alias("h"), "_place"))["_place"]
    shared = docs.where("doc_id is not null").groupBy("doc_id").agg(first.alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    again = docs.select("doc_id", "_place").join(shared, "doc_id").where("_place <> _first").select("_place")
    new = written(again.union(docs.where("doc_id is null").select("_place")).withColumn("_new", F.lit(True)), "new-keys")
    key = F.when(F.col("_new"), F.col("_place") + above).otherwise(F.col("doc_id"))
    return docs.join(new, "_place", "left").withColumn("row_key", key).drop("_place", "_new")


def by_key(docs: DataFrame) -> DataFrame:
    """docs as the operators take them, with row_key for doc_id."""
    return docs.select(F.col("row_key").alias("doc_id"), *(c for c in docs.columns if c not in ("doc_id", "row_key")))


def without(docs: DataFrame, bad: DataFrame, name: str) -> DataFrame:
    """The rows of docs whose row_key is no doc_id in bad. The keys are written first: they are worked out once, and where
    they are few their known size lets Spark send them to the rows instead of shuffling texts."""
    bad = written(bad.select(F.col("doc_id").alias("row_key")), name)
    return docs.join(bad, "row_key", "left_anti").select(docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected are texts whose language is none of those learned, and those without letters (null and empty ones)."""
    docs = keyed(docs)
    model = train(by_key(docs).where(~held_out()).select("doc_id", "lang", "text"))
    return without(docs, predict(by_key(docs), model).where("rejected"), "rejected")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays; a text without words is linked with nothing, and stays."""
    docs = keyed(docs)
    return without(docs, near_duplicates(by_key(docs)).where("not kept"), "copies")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold an item of the benchmark go."""
    docs = keyed(docs)
    return without(docs, decontaminate(by_key(docs), table(spark, sf_dir, "benchmark")).where("contaminated"), "contaminated")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with mix_slot, their block's place in the schedule; the default weights name every source (a null one, too), so that none goes."""
    return mix(docs).where("_kept").select(*(c for c in docs.columns if c not in ("row_key", "mix_slot")), F.col("_slot").alias("mix_slot"))


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row in one of 24 shards, whose slots follow the order of the mix; a null text has the size of an empty one."""
    return document_shards(docs, 24, "mix_slot" if "mix_slot" in docs.columns else None)


STAGES = [("language ID", language), ("near-dedup", near_dedup), ("decontamination", decontamination), ("mixing", mixing), ("sharding", sharding)]
#: SQL can express neither the models nor the draws.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
