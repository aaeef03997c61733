"""Change data capture: staging, merges that emit a diff, what reads the diff, and its replay."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import written


def stage(df: DataFrame, keys: list[str], order_by: list[Column | str]) -> DataFrame:
    """The first row per key in ascending order of order_by. With several keys a null equals an empty string."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) if len(keys) > 1 else F.col(k) for k in keys]
    first = F.min_by(F.struct(*df.columns), F.struct(*order_by)).alias("_r")
    return df.groupBy(*(p.alias(f"_k{i}") for i, p in enumerate(parts))).agg(first).select("_r.*")


def identity_hash(cols: list[str], collision_safe: bool = False) -> Column:
    """SHA-256 over the columns as text, joined by '|', null as '∅'; collision_safe: over their JSON, where no value can imitate the separator."""
    if collision_safe:
        return F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)
    return F.sha2(F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("∅")) for c in cols)), 256)


def _paired(current: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    a = current.select(key, F.struct(*current.columns).alias("_cur"))
    b = staged.select(key, F.struct(*current.columns).alias("_stg"))
    return a.join(b, key, "full_outer")


def merge_keyed(current: DataFrame, staged: DataFrame, key: str, diff_cols: list[str], null_safe: bool = True) -> tuple[DataFrame, DataFrame]:
    """(new current, diff of key and action): inserts unmatched rows, overwrites all columns where a diff column differs, never deletes.

    Null against a value is a change; with null_safe off, a plain comparison, it is not.
    """

    def differs(c: str) -> Column:
        a, b = F.col(f"_cur.{c}"), F.col(f"_stg.{c}")
        return ~a.eqNullSafe(b) if null_safe else F.coalesce(a != b, F.lit(False))

    changed = reduce(Column.__or__, map(differs, diff_cols), F.lit(False))
    both = F.col("_cur").isNotNull() & F.col("_stg").isNotNull()
    pairs = _paired(current, staged, key).withColumn("action", F.when(F.col("_cur").isNull(), "INSERT").when(both & changed, "UPDATE"))
    new = pairs.select(F.when(F.col("action").isNotNull(), F.col("_stg")).otherwise(F.col("_cur")).alias("_r")).select("_r.*")
    return new, pairs.where("action is not null").select(key, "action")


def _merged(current: DataFrame, staged: DataFrame, on: list[str], scope: list[str], payload: list[str]) -> tuple[DataFrame, DataFrame]:
    """One full outer join on `on` tells inserts, deletes (of scopes that are staged) and, by payload columns, updates."""
    cols = current.columns
    scopes = staged.select(*(F.col(c).alias(c) for c in scope)).distinct().withColumn("_staged", F.lit(True))
    a = current.join(scopes, scope, "left").select(*on_columns(on), F.struct(*cols).alias("_cur"), F.coalesce("_staged", F.lit(False)).alias("_staged"))
    b = staged.select(*on_columns(on), F.struct(*cols).alias("_stg")).dropDuplicates([f"_on{i}" for i in range(len(on))])
    pairs = a.join(b, [f"_on{i}" for i in range(len(on))], "full_outer")
    differs = reduce(Column.__or__, (~F.col(f"_cur.{c}").eqNullSafe(F.col(f"_stg.{c}")) for c in payload), F.lit(False))
    gone = F.col("_stg").isNull() & F.col("_staged")
    action = F.when(F.col("_cur").isNull(), "INSERT").when(gone, "DELETE").when(F.col("_stg").isNotNull() & differs, "UPDATE")
    pairs = pairs.withColumn("action", action)
    new = pairs.where("action is null or action <> 'DELETE'").select(F.when(F.col("action").isNull(), F.col("_cur")).otherwise(F.col("_stg")).alias("_r")).select("_r.*")
    diff = pairs.where("action is not null").select(F.when(F.col("action") == "DELETE", F.col("_cur")).otherwise(F.col("_stg")).alias("_r"), "action").select("_r.*", "action")
    return new, diff


def on_columns(on: list) -> list[Column]:
    return [(F.col(c) if isinstance(c, str) else c).alias(f"_on{i}") for i, c in enumerate(on)]


def merge_identity(current: DataFrame, staged: DataFrame, identity: list[str], scope: list[str], update_payload: bool = False) -> tuple[DataFrame, DataFrame]:
    """(new current, diff of all columns and action). Rows match on the hash of their identity, nulls included; current
    rows whose scope is staged but whose identity is not are deleted (a null scope never is); matched rows stay as they
    are, or, with update_payload, take what is staged for columns outside the identity."""
    payload = [c for c in current.columns if c not in identity] if update_payload else []
    return _merged(current, staged.select(current.columns), [identity_hash(identity)], scope, payload)


def merge_composite(current: DataFrame, staged: DataFrame, keys: list[str], scope: list[str]) -> tuple[DataFrame, DataFrame]:
    """merge_identity on key columns themselves, which are not null."""
    return _merged(current, staged.select(current.columns), list(keys), scope, [])


def upsert(current: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    """Inserts, or overwrites on every match; no diff."""
    return _paired(current, staged, key).select(F.coalesce("_stg", "_cur").alias("_r")).select("_r.*")


def replace_snapshot(staged: DataFrame) -> DataFrame:
    """The staged rows as the new table, written to a folder of its own; an empty snapshot is refused, and so is one that landed with another number of rows."""
    landed = written(staged, "snapshot")
    if not (n := landed.count()):
        raise ValueError("an empty snapshot is refused")
    if n != staged.count():
        raise ValueError("the snapshot landed with another number of rows than staged")
    return landed


def changed_keys(diffs: list[DataFrame], key: str) -> DataFrame:
    return reduce(DataFrame.union, (d.select(key) for d in diffs)).distinct()


def source_changed(current: DataFrame, new: DataFrame, key: str = "source") -> DataFrame:
    """new with `changed`: by etag where both have one, else by last_modified, else taken for changed; a first fetch is."""
    old = current.select(key, F.col("etag").alias("_etag"), F.col("last_modified").alias("_modified"), F.lit(True).alias("_known"))
    same = F.when(F.col("etag").isNotNull() & F.col("_etag").isNotNull(), F.col("etag") == F.col("_etag")).when(
        F.col("last_modified").isNotNull() & F.col("_modified").isNotNull(), F.col("last_modified") == F.col("_modified")
    )
    out = new.join(old, key, "left").withColumn("changed", F.col("_known").isNull() | ~F.coalesce(same, F.lit(False)))
    return out.select(*new.columns, "changed")


def diff_current(diff: DataFrame, current: DataFrame, keys: list[str], types: DataFrame | None = None, entity: str | None = None) -> DataFrame:
    """Diff rows completed from the current table on the full key; deleted rows drop out. types(entity_id, entity_type): the type of column `entity`, too."""
    out = diff.join(current, keys)
    if types is not None:
        out = out.join(types.select(F.col("entity_id").alias(entity), "entity_type"), entity)
    return out


def diff_edges_typed(diff: DataFrame, entities: DataFrame, src: str, dst: str) -> DataFrame:
    """An edge diff with src_type and dst_type, the types of both ends in entities(entity_id, entity_type); edges without one drop out."""
    a = entities.select(F.col("entity_id").alias(src), F.col("entity_type").alias("src_type"))
    b = entities.select(F.col("entity_id").alias(dst), F.col("entity_type").alias("dst_type"))
    return diff.join(a, src).join(b, dst).select(*diff.columns, "src_type", "dst_type")


def diff_annotations(annotations: DataFrame, entities: DataFrame, diff: DataFrame, key: str = "entity_id") -> DataFrame:
    """Annotations, with entity_type, of the entities that the entity diff names; the key as text."""
    typed = annotations.join(entities.select(key, "entity_type"), key).join(diff.select(key).distinct(), key, "left_semi")
    return typed.withColumn(key, F.col(key).cast("string"))


def diff_gene_accessions(diff: DataFrame, entities: DataFrame, crosswalk: DataFrame | None = None) -> DataFrame:
    """Distinct accessions of the genes that the diff(entity_id) names; crosswalk(entity_id, accession): where genes have ids of another kind."""
    genes = diff.select("entity_id").join(entities.where("entity_type = 'gene'").select("entity_id"), "entity_id", "left_semi")
    if crosswalk is not None:
        return genes.join(crosswalk, "entity_id").select("accession").distinct()
    return genes.select(F.col("entity_id").alias("accession")).distinct()


def diff_batches(log: DataFrame, run_id: str) -> DataFrame:
    """One run's rows of a diff log, deletions included; a log partitioned by run_id is read for that run alone."""
    return log.where(F.col("run_id") == run_id).drop("run_id")


def reproject_scope(diffs: list[DataFrame], full: DataFrame | None = None, key: str = "pathway_id") -> DataFrame:
    """Distinct scopes that any diff names, null left out; or all of `full`."""
    tables = [full] if full is not None else diffs
    return reduce(DataFrame.union, (d.select(key) for d in tables)).where(F.col(key).isNotNull()).distinct()


def apply_diff(base: DataFrame, diff: DataFrame, identity: list[str], order: Column | str) -> DataFrame:
    """base after the last action per identity, by `order`, of a diff that carries all columns; nulls in the identity are values like others."""
    h = identity_hash(identity).alias("_h")
    rows = diff.select(h, F.struct(*base.columns, "action").alias("_r"), (F.col(order) if isinstance(order, str) else order).alias("_o"))
    last = rows.groupBy("_h").agg(F.max_by("_r", "_o").alias("_r"))
    kept = base.select("*", h).join(last.select("_h"), "_h", "left_anti").drop("_h")
    return kept.unionByName(last.select("_r.*").where("action <> 'DELETE'").select(base.columns))


def grouped_ids(pairs: DataFrame, by: str, member: str) -> DataFrame:
    """Each group's whole, sorted list of distinct members as text; groups are small by nature (the accessions of a gene)."""
    return pairs.where(F.col(by).isNotNull()).groupBy(by).agg(F.array_sort(F.collect_set(F.col(member).cast("string"))).alias("ids"))


def resolve_deferred_fk(staged: DataFrame, ref: DataFrame, natural: str, ref_natural: str, ref_id: str, out: str) -> DataFrame:
    """staged with `out`: the lowest ref_id of its natural key, null if there is none; never more rows than staged."""
    lowest = ref.groupBy(F.col(ref_natural).alias("_k")).agg(F.min(ref_id).alias(out))
    return staged.join(lowest, F.col(natural) == F.col("_k"), "left").drop("_k")


def match_natural_key(current: DataFrame, staged: DataFrame, unique: list[str], id_col: str) -> DataFrame:
    """staged with ids: those of current rows equal in `unique` (null equals null), else new ones after the greatest.

    New ids are given by chunks of a hash, so no task numbers all rows.
    """
    on = reduce(Column.__and__, (F.col(f"s.{c}").eqNullSafe(F.col(f"c.{c}")) for c in unique))
    found = staged.alias("s").join(current.select(id_col, *unique).alias("c"), on, "left").select("s.*", F.col(f"c.{id_col}").alias(id_col))
    new = found.where(F.col(id_col).isNull()).withColumn("_chunk", F.pmod(F.xxhash64(*unique), F.lit(256)))
    starts = new.groupBy("_chunk").agg(F.count("*").alias("_n"))
    starts = starts.select("_chunk", (F.sum("_n").over(Window.orderBy("_chunk")) - F.col("_n")).alias("_start"))  # 256 rows
    top = current.agg(F.coalesce(F.max(id_col), F.lit(0))).first()[0]
    place = F.row_number().over(Window.partitionBy("_chunk").orderBy(*unique))
    new = new.withColumn("_p", place).join(starts, "_chunk").withColumn(id_col, F.lit(top) + F.col("_start") + F.col("_p"))
    return found.where(F.col(id_col).isNotNull()).unionByName(new.select(found.columns))
