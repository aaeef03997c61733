"""Change capture over streams: each micro-batch is staged, merged and logged; later stages see the scopes that changed.

A scope must be whole within a batch: what a batch does not name in its scopes is deleted from them. A file holds whole
scopes, and the batch id is the run id, so that a batch that is run again after a failure replaces its own diff. The table
lies in hash buckets of its scope: a batch reads and writes the buckets of the scopes that it names and no others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import cdc
from ..operators.buckets import ScopeTable
from ..sinks import files


def latest(spark: SparkSession, path: str, schema: str, scope: list[str], before: int | None = None) -> DataFrame:
    """The table's newest version below batch `before`, empty without one."""
    return ScopeTable(spark, path, schema, scope).read(before=before)


def cdc_apply(
    stream: DataFrame, table: str, log: str, checkpoint: str, identity: list[str], scope: list[str], order_by: list[str], scope_rows: str | None = None, n_buckets: int = 256
) -> StreamingQuery:
    """Applies a stream of staged rows to the table (see ScopeTable) and its diff log, as far as there is input, and stops.

    scope_rows: a column with the number of rows that the scope has in all; a batch that has fewer distinct ones than that
    is refused, because a scope that is split over batches loses rows. The diff is logged before the table's new version
    is put in place: a batch that fails between the two is run again from the same table and replaces its own diff.
    """
    columns = [c for c in stream.columns if c != scope_rows]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema if f.name != scope_rows)

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            staged = cdc.stage(batch, identity, order_by)
            if scope_rows:
                torn = staged.groupBy(*scope).agg(F.count("*").alias("_n"), F.max(scope_rows).alias("_all")).where("_n < _all")
                if not torn.isEmpty():
                    raise ValueError(f"a scope is split over batches: {torn.first()}")
            kept = ScopeTable(spark, table, schema, scope, n_buckets)
            kept.merge_identity(staged.select(columns), identity, batch_id, before_commit=lambda diff: files.diff(diff, log, str(batch_id)))
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def changed_scopes(
    spark: SparkSession, log: str, schema: str, scope: str, checkpoint: str, out: str, order: Column | None = None, runs_kept: int = 1, files_per_batch: int | None = None
) -> StreamingQuery:
    """Reads a diff log as a stream and writes each (run_id, scope) once, as far as there is input. schema: of the log without run_id.

    order: a run's place among the runs as a whole number from 0 (default: run_id itself, as one). Keys that were seen are state,
    and a run's are dropped once a batch has brought a run more than runs_kept places later: state is that of the last
    runs, not of the whole log. Runs are logged one after the other and files are read oldest first, so by then a run is
    over; rows of a run that has been dropped would be ignored, and `late_rows` counts them.
    """
    place = (F.col("run_id").cast("long") if order is None else order).cast("long")
    reader = spark.readStream.schema(f"{schema}, run_id string")
    diffs = (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(log)
    changed = diffs.where(F.col(scope).isNotNull()).select("run_id", scope, F.timestamp_seconds(place + 1).alias("_run"))  # times after 0, where watermarks start
    once = changed.withWatermark("_run", f"{runs_kept * 1000 + 500} milliseconds").dropDuplicates(["run_id", scope, "_run"]).select("run_id", scope)
    return once.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).format("parquet").option("path", out).start()


def late_rows(query: StreamingQuery) -> int:
    """Rows of runs that the query had dropped already, over its recent batches."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


def state_rows(query: StreamingQuery) -> list[int]:
    """The number of keys in state after each recent batch."""
    return [sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in query.recentProgress]
