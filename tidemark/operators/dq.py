"""Data-quality gates: each gives the rows, or counts, that break a rule, or refuses to go on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_columns(df: DataFrame, key: str, not_null: list[str], max_len: dict[str, int], types: dict[str, str] | None = None) -> DataFrame:
    """key, column, problem (type, null, too long) of each violation. A missing column is an error, extra columns are ignored.

    types: the type of each column; a value that cannot be cast to it breaks the rule.
    """
    types = types or {}
    if missing := {key, *not_null, *max_len, *types} - set(df.columns):
        raise ValueError(f"missing columns: {sorted(missing)}")
    rule = lambda c, text, bad: F.when(bad, F.struct(F.lit(c).alias("column"), F.lit(text).alias("problem")))
    rules = [rule(c, "type", F.col(c).isNotNull() & F.col(c).try_cast(k).isNull()) for c, k in types.items()]
    rules += [rule(c, "null", F.col(c).isNull()) for c in not_null] + [rule(c, "too long", F.length(c) > n) for c, n in max_len.items()]
    return df.select(key, F.explode(F.array_compact(F.array(*rules))).alias("_v")).select(key, "_v.*")


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    return child.where(F.col(fk).isNotNull()).join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def check_expr(df: DataFrame, rule: Column) -> DataFrame:
    """Rows for which the rule is false; null passes, as in SQL."""
    return df.where(~rule)


def failure_gate(df: DataFrame, failed: Column) -> DataFrame:
    """failed, total of the rows; an error once failures exceed 5 and a hundredth of all (null counts as passed)."""
    counts = df.agg(F.count_if(failed).alias("failed"), F.count("*").alias("total"))
    over = F.col("failed") > F.greatest(F.lit(5), F.expr("total div 100"))
    return counts.withColumn("failed", F.when(over, F.raise_error(F.concat_ws(" ", "failed", F.lit("of"), "total", F.lit("failed"))).cast("long")).otherwise(F.col("failed")))


def reconcile(a: DataFrame, b: DataFrame, metrics: dict[str, Column], tolerance: float = 0.01) -> DataFrame:
    """metric, a, b, failed for each metric (an aggregate): |a - b| / |a| above tolerance fails, and any difference where a is 0."""
    stack = lambda df, name: df.agg(*(m.cast("double").alias(k) for k, m in metrics.items())).unpivot([], list(metrics), "metric", name)
    drift = F.try_divide(F.abs(F.col("a") - F.col("b")), F.abs(F.col("a")))
    return stack(a, "a").join(stack(b, "b"), "metric").withColumn("failed", F.coalesce(drift > tolerance, ~F.col("a").eqNullSafe(F.col("b"))))


def refuse_empty(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("an empty table is refused")
    return df
