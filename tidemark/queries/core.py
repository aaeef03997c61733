"""Queries of change capture, data quality and graphs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cdc, dq, graph
from ..operators.buckets import ScopeTable
from ..operators.store import shared_dir, written
from .base import query, t

# Current orders are those not open; the load brings those not of low priority, and closes pending ones.
_CUR = "cur AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus <> 'O')"
_STG = "stg AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus, o_orderpriority FROM orders WHERE o_orderpriority <> '5-LOW')"


def order_load(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    load = o.where("o_orderpriority <> '5-LOW'").withColumn("o_orderstatus", F.when(F.col("o_orderstatus") == "P", "F").otherwise(F.col("o_orderstatus")))
    return o.where("o_orderstatus <> 'O'"), load


@query(f"""WITH {_CUR}, {_STG} SELECT o_orderkey, CASE WHEN c.o_orderkey IS NULL THEN 'INSERT' ELSE 'UPDATE' END AS action
    FROM stg s LEFT JOIN cur c USING (o_orderkey) WHERE c.o_orderkey IS NULL OR c.o_orderstatus <> s.o_orderstatus""")
def cdc_merge_keyed(spark, sf_dir):
    return cdc.merge_keyed(*order_load(spark, sf_dir), "o_orderkey", ["o_orderstatus"])[1]


@query(f"""WITH {_CUR}, {_STG} SELECT * FROM stg UNION ALL SELECT * FROM cur WHERE o_orderkey NOT IN (SELECT o_orderkey FROM stg)""")
def cdc_upsert(spark, sf_dir):
    return cdc.upsert(*order_load(spark, sf_dir), "o_orderkey")


_LINES = "cur AS (SELECT DISTINCT l_orderkey, l_partkey, l_returnflag FROM lineitem WHERE l_linestatus = 'F'), stg AS (SELECT DISTINCT l_orderkey, l_partkey, l_returnflag FROM lineitem WHERE l_quantity > 25)"
_DIFF = """ins AS (SELECT *, 'INSERT' AS action FROM stg s WHERE NOT EXISTS (SELECT 1 FROM cur c WHERE c.l_orderkey = s.l_orderkey AND c.l_partkey = s.l_partkey AND c.l_returnflag = s.l_returnflag)),
    del AS (SELECT *, 'DELETE' AS action FROM cur c WHERE l_orderkey IN (SELECT l_orderkey FROM stg) AND NOT EXISTS (SELECT 1 FROM stg s WHERE c.l_orderkey = s.l_orderkey AND c.l_partkey = s.l_partkey AND c.l_returnflag = s.l_returnflag))"""


def line_load(spark, sf_dir):
    x = t(spark, sf_dir, "lineitem")
    cols = ["l_orderkey", "l_partkey", "l_returnflag"]
    return x.where("l_linestatus = 'F'").select(cols).distinct(), x.where("l_quantity > 25").select(cols).distinct(), cols


@query(f"WITH {_LINES}, {_DIFF} SELECT * FROM ins UNION ALL SELECT * FROM del")
def cdc_merge_identity(spark, sf_dir):
    cur, stg, cols = line_load(spark, sf_dir)
    return cdc.merge_identity(cur, stg, cols, ["l_orderkey"])[1]


@query(f"WITH {_LINES}, {_DIFF} SELECT * FROM ins UNION ALL SELECT * FROM del")
def cdc_merge_composite(spark, sf_dir):
    cur, stg, cols = line_load(spark, sf_dir)
    return cdc.merge_composite(cur, stg, cols, ["l_orderkey"])[1]


def bucketed(spark: SparkSession, current: DataFrame, scope: list[str]) -> ScopeTable:
    """current as version 0 of a table in buckets of its scope."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in current.schema)
    table = ScopeTable(spark, f"{shared_dir(spark)}/bucketed-{uuid.uuid4().hex}", schema, scope, 64)
    table.load(current, lambda _, rows: (rows, rows), 0)
    return table


@query(f"WITH {_LINES}, {_DIFF} SELECT * FROM ins UNION ALL SELECT * FROM del")
def cdc_scope_table_identity(spark, sf_dir):
    cur, stg, cols = line_load(spark, sf_dir)
    diff = []
    bucketed(spark, cur, ["l_orderkey"]).merge_identity(stg, cols, 1, before_commit=lambda d: diff.append(written(d, "diff")))
    return diff[0]


@query(f"""WITH {_CUR}, {_STG} SELECT s.* FROM stg s LEFT JOIN cur c USING (o_orderkey) WHERE c.o_orderkey IS NULL OR c.o_orderstatus <> s.o_orderstatus
    UNION ALL SELECT c.* FROM cur c LEFT JOIN stg s USING (o_orderkey) WHERE s.o_orderkey IS NULL OR c.o_orderstatus = s.o_orderstatus""")
def cdc_scope_table_keyed(spark, sf_dir):
    cur, stg = order_load(spark, sf_dir)
    table = bucketed(spark, cur, ["o_orderkey"])
    table.merge_keyed(stg, "o_orderkey", ["o_orderstatus"], 1)
    return table.read()


@query(f"WITH {_LINES}, {_DIFF} SELECT l_orderkey, l_partkey, l_returnflag FROM ins UNION ALL SELECT * FROM cur c WHERE NOT EXISTS (SELECT 1 FROM del d WHERE c.l_orderkey = d.l_orderkey AND c.l_partkey = d.l_partkey AND c.l_returnflag = d.l_returnflag)")
def cdc_apply_diff(spark, sf_dir):
    cur, stg, cols = line_load(spark, sf_dir)
    return cdc.apply_diff(cur, cdc.merge_identity(cur, stg, cols, ["l_orderkey"])[1], cols, F.lit(1))


@query("SELECT l_orderkey, l_partkey, l_linenumber, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS n FROM lineitem) WHERE n = 1")
def cdc_stage(spark, sf_dir):
    return cdc.stage(t(spark, sf_dir, "lineitem"), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]).select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")


@query("SELECT c_custkey, sha256(concat_ws('|', coalesce(c_name, '∅'), coalesce(CAST(c_nationkey AS VARCHAR), '∅'), coalesce(c_mktsegment, '∅'))) AS row_hash FROM customer")
def cdc_identity_hash(spark, sf_dir):
    return t(spark, sf_dir, "customer").select("c_custkey", cdc.identity_hash(["c_name", "c_nationkey", "c_mktsegment"]).alias("row_hash"))


@query("SELECT DISTINCT k FROM (SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'P' UNION ALL SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def cdc_changed_keys(spark, sf_dir):
    a = t(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k"))
    return cdc.changed_keys([a, t(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("k"))], "k")


@query("SELECT l_orderkey, array_to_string(list_sort(list(DISTINCT CAST(l_partkey AS VARCHAR))), ',') AS ids FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY 1")
def cdc_grouped_ids(spark, sf_dir):
    return cdc.grouped_ids(t(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey").withColumn("ids", F.array_join("ids", ","))


@query("SELECT o_orderkey, (SELECT min(c_custkey) FROM customer WHERE c_custkey = o_custkey) AS customer_id FROM orders")
def cdc_resolve_deferred_fk(spark, sf_dir):
    c = t(spark, sf_dir, "customer").select("c_custkey", F.col("c_custkey").alias("natural"))
    return cdc.resolve_deferred_fk(t(spark, sf_dir, "orders"), c, "o_custkey", "natural", "c_custkey", "customer_id").select("o_orderkey", "customer_id")


@query("""SELECT c_custkey, 'c_mktsegment' AS "column", 'null' AS problem FROM customer WHERE c_mktsegment IS NULL
    UNION ALL SELECT c_custkey, 'c_mktsegment', 'too long' FROM customer WHERE length(c_mktsegment) > 9""")
def dq_check_columns(spark, sf_dir):
    return dq.check_columns(t(spark, sf_dir, "customer"), "c_custkey", ["c_mktsegment"], {"c_mktsegment": 9})


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0)")
def dq_orphans(spark, sf_dir):
    return dq.orphans(t(spark, sf_dir, "orders"), t(spark, sf_dir, "customer").where("c_acctbal > 0"), "o_custkey", "c_custkey").select("o_orderkey", "o_custkey")


@query("SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def dq_duplicates(spark, sf_dir):
    return dq.duplicates(t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey"])


@query("SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE NOT (l_discount <= 0.05)")
def dq_check_expr(spark, sf_dir):
    return dq.check_expr(t(spark, sf_dir, "lineitem"), F.col("l_discount") <= 0.05).select("l_orderkey", "l_linenumber", "l_discount")


@query("""SELECT 'keys' AS metric, a, b, abs(a - b) / a > 0.01 AS failed
    FROM (SELECT CAST(count(DISTINCT l_orderkey) AS DOUBLE) AS a FROM lineitem), (SELECT CAST(count(DISTINCT o_orderkey) AS DOUBLE) AS b FROM orders)""")
def dq_reconcile(spark, sf_dir):
    keys = {"keys": F.count_distinct("k")}
    return dq.reconcile(t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k")), t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k")), keys)


def tree(spark, sf_dir):
    """Customers as a tree: each reports to the one of half its key."""
    return t(spark, sf_dir, "customer").where("c_custkey > 1").select(F.col("c_custkey").alias("src"), F.floor(F.col("c_custkey") / 2).cast("long").alias("dst"))


@query("""WITH RECURSIVE e AS (SELECT c_custkey AS src, c_custkey // 2 AS dst FROM customer WHERE c_custkey > 1),
    r AS (SELECT c_custkey AS seed, c_custkey AS id FROM customer UNION SELECT seed, dst FROM r JOIN e ON id = src) SELECT seed, id FROM r""")
def graph_reachable(spark, sf_dir):
    return graph.reachable(tree(spark, sf_dir), t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("seed")))


@query("""WITH e AS (SELECT c_custkey AS src, c_custkey // 2 AS dst FROM customer WHERE c_custkey > 1)
    SELECT c_custkey AS seed, dst AS id FROM customer JOIN e ON c_custkey = src
    UNION SELECT c_custkey, b.dst FROM customer JOIN e a ON c_custkey = a.src JOIN e b ON a.dst = b.src""")
def graph_expand_bounded(spark, sf_dir):
    return graph.expand_bounded(tree(spark, sf_dir), t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("seed")), 1, 2)


@query("""SELECT l_orderkey AS reaction_id, coalesce(string_agg(DISTINCT CASE WHEN l_returnflag = 'A' THEN CAST(l_partkey AS VARCHAR) END, ',' ORDER BY CASE WHEN l_returnflag = 'A' THEN CAST(l_partkey AS VARCHAR) END), '') AS reactants,
    coalesce(string_agg(DISTINCT CASE WHEN l_returnflag = 'R' THEN CAST(l_partkey AS VARCHAR) END, ',' ORDER BY CASE WHEN l_returnflag = 'R' THEN CAST(l_partkey AS VARCHAR) END), '') AS products,
    coalesce(string_agg(DISTINCT CASE WHEN l_returnflag = 'N' THEN CAST(l_partkey AS VARCHAR) END, ',' ORDER BY CASE WHEN l_returnflag = 'N' THEN CAST(l_partkey AS VARCHAR) END), '') AS catalysts
    FROM lineitem GROUP BY 1""")
def graph_reaction_card(spark, sf_dir):
    role = F.when(F.col("l_returnflag") == "A", "reactant").when(F.col("l_returnflag") == "R", "product").when(F.col("l_returnflag") == "N", "catalyst")
    parts = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("reaction_id"), F.col("l_partkey").cast("string").alias("entity_id"), role.alias("role"))
    return graph.reaction_card(parts).select("reaction_id", *(F.array_join(c, ",").alias(c) for c in ("reactants", "products", "catalysts")))


@query("SELECT l_suppkey AS pathway_id, count(DISTINCT l_partkey) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10")
def graph_pathway_sizes(spark, sf_dir):
    return graph.pathway_sizes(t(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("pathway_id"), F.col("l_partkey").alias("entity_id")), 10)


@query("SELECT DISTINCT x.l_partkey AS a, y.l_partkey AS b FROM lineitem x JOIN lineitem y ON x.l_orderkey = y.l_orderkey WHERE x.l_suppkey <> y.l_suppkey AND x.l_partkey < y.l_partkey")
def graph_co_assembly_pairs(spark, sf_dir):
    return graph.co_assembly_pairs(t(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("gene"), F.col("l_orderkey").alias("assembly"), F.col("l_suppkey").alias("via")))


@query("""SELECT count(*) FILTER (l.id IS NOT NULL AND r.id IS NOT NULL) AS "both", count(*) FILTER (r.id IS NULL) AS only_left, count(*) FILTER (l.id IS NULL) AS only_right
    FROM (SELECT DISTINCT c_custkey AS id FROM customer) l FULL JOIN (SELECT DISTINCT o_custkey AS id FROM orders) r USING (id)""")
def graph_store_overlap(spark, sf_dir):
    return graph.store_overlap(t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id")))


@query("""SELECT o_custkey AS src, o_orderpriority AS dst, array_to_string(list_sort(list(DISTINCT o_orderstatus)), ',') AS pathway_ids, max(o_orderdate)::VARCHAR AS last, 'F' AS kept
    FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer) GROUP BY 1, 2""")
def graph_upsert_edges(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("src"), F.col("o_orderpriority").alias("dst"), F.lit("ORDERS").alias("label"), F.col("o_orderstatus").alias("pathway_id"), F.col("o_orderdate").cast("string").alias("day"))
    first = o.groupBy("src", "dst", "label").agg(F.collect_set("pathway_id").alias("pathway_ids")).withColumn("props", F.create_map(F.lit("kept"), F.lit("F"), F.lit("last"), F.lit("never")))
    nodes = t(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id")).union(o.select("dst"))
    # First-load edges without a customer would stay: they are checked on load, as later ones are.
    first = first.join(nodes.select(F.col("id").alias("src")).distinct(), "src", "left_semi")
    new = o.withColumn("props", F.create_map(F.lit("last"), F.col("day"), F.lit("none"), F.lit(None).cast("string")))
    out = graph.upsert_edges(first, new, nodes, order=["day"])
    return out.select(F.col("src").cast("long").alias("src"), "dst", F.array_join("pathway_ids", ",").alias("pathway_ids"), F.col("props")["last"].alias("last"), F.col("props")["kept"].alias("kept"))
