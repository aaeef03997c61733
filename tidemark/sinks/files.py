"""Writers, each with the reader that gives the same rows again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def training_export(tables: dict[str, DataFrame], path: str) -> None:
    """train(anchor, positive, negative), queries, corpus, relevant(term, gene) and stats as JSON lines, a folder each; relevant genes as one sorted list a term."""
    for name, df in tables.items():
        if name == "relevant":
            df = df.groupBy("term").agg(F.array_sort(F.collect_set("gene")).alias("genes"))
        df.write.mode("overwrite").json(f"{path}/{name}")


def training_import(spark: SparkSession, path: str, schemas: dict[str, str]) -> dict[str, DataFrame]:
    """The tables of training_export, relevant as (term, gene) rows; schemas: of all but relevant."""
    out = {name: spark.read.schema(schema).json(f"{path}/{name}") for name, schema in schemas.items() if name != "relevant"}
    if "relevant" in schemas:
        kinds = dict(x.split() for x in schemas["relevant"].split(", "))
        rows = spark.read.schema(f"term {kinds['term']}, genes array<{kinds['gene']}>").json(f"{path}/relevant")
        out["relevant"] = rows.select("term", F.explode("genes").alias("gene"))
    return out


def index_export(records: DataFrame, chunks: DataFrame, manifest: DataFrame, path: str) -> None:
    """Records and chunks with their vectors as columns, and a manifest of one row; a record or chunk without a vector is refused."""
    for name, df in (("records", records), ("chunks", chunks)):
        checked = df.withColumn("dense", F.when(F.col("dense").isNull(), F.raise_error(F.lit(f"{name} without vectors")).cast(df.schema["dense"].dataType)).otherwise(F.col("dense")))
        checked.write.mode("overwrite").parquet(f"{path}/{name}")
    manifest.write.mode("overwrite").json(f"{path}/manifest")


def index_import(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records, chunks, manifest); counts that differ from the manifest's are refused."""
    records, chunks, manifest = spark.read.parquet(f"{path}/records"), spark.read.parquet(f"{path}/chunks"), spark.read.json(f"{path}/manifest")
    said = manifest.first()
    if (records.count(), chunks.count()) != (said["records"], said["chunks"]):
        raise ValueError("the index has other numbers of rows than its manifest")
    return records, chunks, manifest


def per_query(rankings: DataFrame, metrics: DataFrame, path: str) -> None:
    """One JSON object a query: n_relevant, runs (arm -> ranked ids) and scores (arm -> metrics)."""
    names = [c for c in metrics.columns if c not in ("arm", "query_id", "n_rel")]
    ids = F.transform(F.array_sort(F.collect_list(F.struct("rank", F.col("id").cast("string").alias("id")))), lambda x: x["id"])
    runs = rankings.groupBy("query_id", "arm").agg(ids.alias("ids")).groupBy("query_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("arm", "ids")))).alias("runs"))
    scores = metrics.groupBy("query_id").agg(F.max("n_rel").alias("n_relevant"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("arm", F.struct(*names).alias("s"))))).alias("scores"))
    scores.join(runs, "query_id").write.mode("overwrite").json(path)


def graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Nodes and edges in folders by label."""
    nodes.write.mode("overwrite").partitionBy("label").parquet(f"{path}/nodes")
    edges.write.mode("overwrite").partitionBy("label").parquet(f"{path}/edges")


def diff(df: DataFrame, path: str, run_id: str) -> None:
    """A run's rows appended to the diff log, which is kept in folders by run; a run that is written again replaces its own rows."""
    df.write.mode("overwrite").parquet(f"{path}/run_id={run_id}")
