"""Cutting lineage in iterative operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_kept: list[str] = []  # what this process has written here and not deleted


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, else (local mode, as in tests) a new local one."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, what: str) -> DataFrame:
    """df, cut from its lineage: written to the shared folder and read again, so a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    _kept.append(path)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


class Growing:
    """A written table that grows by parts; each row is written once, and all parts are read as one."""

    def __init__(self, spark: SparkSession, what: str):
        self.spark, self.path, self.parts, self.schema = spark, f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}", [], None
        _kept.append(self.path)

    def add(self, df: DataFrame) -> DataFrame:
        """Writes df as a part, and gives it as it was written."""
        path = f"{self.path}/{len(self.parts)}"
        df.write.parquet(path)
        self.parts.append(path)
        self.schema = self.schema or df.schema
        return self.spark.read.schema(df.schema).parquet(path)

    def all(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*self.parts)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)
    if path in _kept:
        _kept.remove(path)


def erase(*tables: DataFrame) -> None:
    """Deletes what `written` wrote for these tables; nothing that is still to be computed may read them."""
    for df in tables:
        _delete(df.sparkSession, df.written_at)


def erase_all(spark: SparkSession) -> int:
    """Deletes all tables that this process has written and not deleted yet, and gives their number.

    Results of operators may read them: save what is wanted first.
    """
    paths = list(_kept)
    for path in paths:
        _delete(spark, path)
    return len(paths)
