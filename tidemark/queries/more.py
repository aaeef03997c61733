"""More queries of change capture, data quality and graphs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cdc, dq, graph
from ..operators.store import written
from .base import query, t
from .core import _CUR, _DIFF, _LINES, _STG, line_load, order_load

# Orders with a priority as entity type, in a key-only diff.
_ODIFF = f"WITH {_CUR}, {_STG}, d AS (SELECT o_orderkey, CASE WHEN c.o_orderkey IS NULL THEN 'INSERT' ELSE 'UPDATE' END AS action FROM stg s LEFT JOIN cur c USING (o_orderkey) WHERE c.o_orderkey IS NULL OR c.o_orderstatus <> s.o_orderstatus)"


def merged_orders(spark, sf_dir):
    return cdc.merge_keyed(*order_load(spark, sf_dir), "o_orderkey", ["o_orderstatus"])


@query(f"{_ODIFF} SELECT s.* FROM stg s WHERE o_orderkey IN (SELECT o_orderkey FROM d) UNION ALL SELECT * FROM cur WHERE o_orderkey NOT IN (SELECT o_orderkey FROM d)")
def cdc_merge_keyed_table(spark, sf_dir):
    return merged_orders(spark, sf_dir)[0]


@query(f"{_ODIFF} SELECT o_orderkey, d.action, s.o_custkey, s.o_orderstatus, s.o_orderpriority, c_mktsegment AS entity_type FROM d JOIN stg s USING (o_orderkey) JOIN customer ON c_custkey = s.o_custkey")
def cdc_diff_current(spark, sf_dir):
    new, diff = merged_orders(spark, sf_dir)
    types = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entity_id"), F.col("c_mktsegment").alias("entity_type"))
    return cdc.diff_current(diff, new, ["o_orderkey"], types, "o_custkey")


@query(f"WITH {_LINES}, {_DIFF} SELECT l_orderkey, l_partkey, l_returnflag, action, o_orderpriority AS src_type, p_brand AS dst_type FROM (SELECT * FROM ins UNION ALL SELECT * FROM del) JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey")
def cdc_diff_edges_typed(spark, sf_dir):
    cur, stg, cols = line_load(spark, sf_dir)
    diff = cdc.merge_identity(cur, stg, cols, ["l_orderkey"])[1]
    # Orders and parts have keys of their own: each end looks up its own kind.
    orders = t(spark, sf_dir, "orders").select(F.concat(F.lit("O"), "o_orderkey").alias("entity_id"), F.col("o_orderpriority").alias("entity_type"))
    entities = orders.union(t(spark, sf_dir, "part").select(F.concat(F.lit("P"), "p_partkey"), "p_brand"))
    named = diff.withColumns({"src": F.concat(F.lit("O"), "l_orderkey"), "dst": F.concat(F.lit("P"), "l_partkey")})
    return cdc.diff_edges_typed(named, entities, "src", "dst").drop("src", "dst")


@query(f"{_ODIFF} SELECT CAST(o_orderkey AS VARCHAR) AS entity_id, o_totalprice, o_orderpriority AS entity_type FROM orders WHERE o_orderkey IN (SELECT o_orderkey FROM d)")
def cdc_diff_annotations(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    diff = merged_orders(spark, sf_dir)[1].select(F.col("o_orderkey").alias("entity_id"))
    annotations = o.select(F.col("o_orderkey").alias("entity_id"), "o_totalprice")
    return cdc.diff_annotations(annotations, o.select(F.col("o_orderkey").alias("entity_id"), F.col("o_orderpriority").alias("entity_type")), diff)


@query(f"{_ODIFF} SELECT DISTINCT l_partkey AS accession FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderpriority = '1-URGENT' AND o_orderkey IN (SELECT o_orderkey FROM d)")
def cdc_diff_gene_accessions(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    diff = merged_orders(spark, sf_dir)[1].select(F.col("o_orderkey").alias("entity_id"))
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", "gene").otherwise("other")
    walk = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("entity_id"), F.col("l_partkey").alias("accession"))
    return cdc.diff_gene_accessions(diff, o.select(F.col("o_orderkey").alias("entity_id"), kind.alias("entity_type")), walk)


@query(f"WITH {_LINES}, {_DIFF} SELECT * FROM ins UNION ALL SELECT * FROM del")
def cdc_diff_batches(spark, sf_dir):
    cur, stg, cols = line_load(spark, sf_dir)
    log = cdc.merge_identity(cur, stg, cols, ["l_orderkey"])[1].withColumn("run_id", F.lit("run-2")).unionByName(cur.withColumns({"action": F.lit("INSERT"), "run_id": F.lit("run-1")}))
    return cdc.diff_batches(written(log, "log"), "run-2")


@query(f"WITH {_LINES}, {_DIFF} SELECT l_orderkey AS pathway_id FROM ins UNION SELECT l_orderkey FROM del UNION SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'")
def cdc_reproject_scope(spark, sf_dir):
    cur, stg, cols = line_load(spark, sf_dir)
    diff = cdc.merge_identity(cur, stg, cols, ["l_orderkey"])[1].select(F.col("l_orderkey").alias("pathway_id"))
    return cdc.reproject_scope([diff, t(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("pathway_id")), diff.where("false")])


@query("""SELECT o_orderkey AS source, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS etag, o_orderdate AS last_modified,
    CASE WHEN o_orderstatus = 'O' THEN true WHEN o_orderkey % 3 = 0 THEN o_orderstatus = 'P' ELSE o_orderkey % 5 = 0 AND o_orderpriority <> '5-LOW' END AS changed FROM orders""")
def cdc_source_changed(spark, sf_dir):
    k = F.col("o_orderkey")
    new = t(spark, sf_dir, "orders").select(k.alias("source"), F.when(k % 3 != 0, F.col("o_orderpriority")).alias("etag"), F.col("o_orderdate").alias("last_modified"), "o_orderstatus")
    other = F.when(F.col("source") % 5 == 0, F.when(F.col("etag").isNotNull(), "5-LOW")).otherwise(F.col("etag"))
    old_day = F.when(F.col("o_orderstatus") == "P", F.date_add("last_modified", 1)).otherwise(F.col("last_modified"))
    old = new.where("o_orderstatus <> 'O'").select("source", other.alias("etag"), old_day.alias("last_modified"))
    return cdc.source_changed(old, new.drop("o_orderstatus"))


@query("SELECT c_custkey, c_name, c_nationkey FROM customer")
def cdc_replace_snapshot(spark, sf_dir):
    return cdc.replace_snapshot(t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey"))


@query("""WITH known AS (SELECT DISTINCT l_partkey AS a, l_suppkey AS b FROM lineitem WHERE l_returnflag = 'R'), ids AS (SELECT *, row_number() OVER (ORDER BY a, b) AS id FROM known),
    stg AS (SELECT DISTINCT l_partkey AS a, CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE l_suppkey END AS b FROM lineitem)
    SELECT count(*) AS rows, count(DISTINCT i.id) AS old_ids, count(*) FILTER (i.id IS NULL) AS new_rows, (SELECT max(id) FROM ids) + count(*) FILTER (i.id IS NULL) AS top FROM stg LEFT JOIN ids i ON stg.a = i.a AND stg.b IS NOT DISTINCT FROM i.b""")
def cdc_match_natural_key(spark, sf_dir):
    from pyspark.sql import Window

    x = t(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b"), "l_returnflag")
    known = x.where("l_returnflag = 'R'").select("a", "b").distinct()
    # Ids by place, in parts by key: part's first place is the number of keys before it.
    before = known.groupBy("a").agg(F.count("*").alias("n")).select("a", (F.sum("n").over(Window.orderBy("a")) - F.col("n")).alias("start"))
    cur = known.join(before, "a").select("a", "b", (F.col("start") + F.row_number().over(Window.partitionBy("a").orderBy("b"))).alias("id"))
    stg = x.select("a", F.when(F.col("b") % 7 != 0, F.col("b")).alias("b")).distinct()
    out = cdc.match_natural_key(cur, stg, ["a", "b"], "id")
    top = cur.agg(F.max("id").alias("m"))
    got = out.join(top).agg(F.count("*").alias("rows"), F.count_distinct(F.when(F.col("id") <= F.col("m"), F.col("id"))).alias("old_ids"), F.count_if(F.col("id") > F.col("m")).alias("new_rows"), F.max("id").alias("top"))
    return got


@query("SELECT count(*) FILTER (l_quantity > 50) AS failed, count(*) AS total FROM lineitem")
def dq_failure_gate(spark, sf_dir):
    return dq.failure_gate(t(spark, sf_dir, "lineitem"), F.col("l_quantity") > 50)


@query("SELECT n_nationkey, n_name FROM nation")
def dq_refuse_empty(spark, sf_dir):
    return dq.refuse_empty(t(spark, sf_dir, "nation").select("n_nationkey", "n_name"))


# Customers and suppliers are nodes of nations; a second load renames some and brings a new property.
_NODES = """n AS (SELECT 'Customer' AS label, 'C' || c_custkey AS id, c_mktsegment AS seg, NULL AS bal FROM customer UNION ALL SELECT 'Supplier', 'S' || s_suppkey, NULL, NULL FROM supplier),
    m AS (SELECT 'Customer' AS label, 'C' || c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'MOVED' END AS seg, CAST(c_nationkey AS VARCHAR) AS bal FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT 'Customer', 'N' || c_custkey, 'NEW', NULL FROM customer WHERE c_custkey % 10 = 0),
    up AS (SELECT coalesce(n.label, m.label) AS label, coalesce(n.id, m.id) AS id, coalesce(m.seg, n.seg) AS seg, coalesce(m.bal, n.bal) AS bal FROM n FULL JOIN m ON n.label = m.label AND n.id = m.id)"""
_EDGES = """e AS (SELECT DISTINCT 'C' || o_custkey AS src, 'S' || l_suppkey AS dst, o_orderstatus AS p FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"""


def nodes(spark, sf_dir):
    props = lambda **kv: F.map_filter(F.create_map(*(x for k, v in kv.items() for x in (F.lit(k), v.cast("string")))), lambda k, v: v.isNotNull())
    c, s = t(spark, sf_dir, "customer"), t(spark, sf_dir, "supplier")
    key = F.col("c_custkey")
    first = c.select(F.lit("Customer").alias("label"), F.concat(F.lit("C"), key).alias("id"), props(seg=F.col("c_mktsegment")).alias("props"))
    first = first.union(s.select(F.lit("Supplier"), F.concat(F.lit("S"), "s_suppkey"), F.create_map().cast("map<string,string>")))
    moved = c.where(key % 3 == 0).select(F.lit("Customer").alias("label"), F.concat(F.lit("C"), key).alias("id"), F.create_map(F.lit("seg"), F.when(key % 2 == 0, "MOVED"), F.lit("bal"), F.col("c_nationkey").cast("string")).alias("props"))
    fresh = c.where(key % 10 == 0).select(F.lit("Customer"), F.concat(F.lit("N"), key), props(seg=F.lit("NEW")))
    return first, moved.union(fresh)


def edges(spark, sf_dir):
    """src, dst, label, pathway_id of customers' orders at suppliers, by status."""
    both = t(spark, sf_dir, "orders").join(t(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    return both.select(F.concat(F.lit("C"), "o_custkey").alias("src"), F.concat(F.lit("S"), "l_suppkey").alias("dst"), F.lit("BUYS").alias("label"), F.col("o_orderstatus").alias("pathway_id")).distinct()


def supported(rows):
    return rows.groupBy("src", "dst", "label").agg(F.array_sort(F.collect_set("pathway_id")).alias("pathway_ids")).withColumn("props", F.create_map().cast("map<string,string>"))


def flat_nodes(df):
    return df.select("label", "id", F.col("props")["seg"].alias("seg"), F.col("props")["bal"].alias("bal"))


@query(f"WITH {_NODES} SELECT * FROM up")
def graph_upsert_nodes(spark, sf_dir):
    return flat_nodes(graph.upsert_nodes(*nodes(spark, sf_dir)))


@query(f"WITH {_NODES}, {_EDGES}, g AS (SELECT 'C' || c_custkey AS id FROM customer WHERE c_acctbal < 0) SELECT 'node' AS kind, label, count(*) AS n FROM n WHERE id NOT IN (SELECT id FROM g) GROUP BY 2 UNION ALL SELECT 'edge', 'BUYS', count(DISTINCT (src, dst)) FROM e WHERE src NOT IN (SELECT id FROM g)")
def graph_delete_nodes(spark, sf_dir):
    gone = t(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.lit("Customer").alias("label"), F.concat(F.lit("C"), "c_custkey").alias("id"))
    return graph.size(*graph.delete_nodes(nodes(spark, sf_dir)[0], supported(edges(spark, sf_dir)), gone))


# Customers and suppliers bear plain numbers as ids, so most ids are those of one of each; suppliers in debt go.
@query("""WITH gone AS (SELECT s_suppkey AS id FROM supplier WHERE s_acctbal < 0), e AS (SELECT DISTINCT o_custkey AS src, l_suppkey AS dst FROM orders JOIN lineitem ON o_orderkey = l_orderkey)
    SELECT 'node' AS kind, 'Customer' AS label, count(*) AS n FROM customer UNION ALL SELECT 'node', 'Supplier', count(*) FROM supplier WHERE s_suppkey NOT IN (SELECT id FROM gone) UNION ALL SELECT 'edge', 'BUYS', count(*) FROM e WHERE dst NOT IN (SELECT id FROM gone)""")
def graph_delete_nodes_by_label(spark, sf_dir):
    c, s = t(spark, sf_dir, "customer"), t(spark, sf_dir, "supplier")
    plain = lambda df, label, key: df.select(F.lit(label).alias("label"), F.col(key).cast("string").alias("id"), graph.no_props().alias("props"))
    e = supported(edges(spark, sf_dir)).withColumns({"src": F.substring("src", 2, 20), "dst": F.substring("dst", 2, 20), "src_label": F.lit("Customer"), "dst_label": F.lit("Supplier")})
    gone = plain(s.where("s_acctbal < 0"), "Supplier", "s_suppkey")
    return graph.size(*graph.delete_nodes(plain(c, "Customer", "c_custkey").union(plain(s, "Supplier", "s_suppkey")), e, gone))


@query(f"WITH {_NODES}, {_EDGES} SELECT 'node' AS kind, label, count(*) AS n FROM n GROUP BY 2 UNION ALL SELECT 'edge', 'BUYS', count(DISTINCT (src, dst)) FROM e")
def graph_size(spark, sf_dir):
    return graph.size(nodes(spark, sf_dir)[0], supported(edges(spark, sf_dir)))


@query(f"WITH {_EDGES} SELECT src, dst, array_to_string(list_sort(list(p)), ',') AS pathway_ids FROM e WHERE p <> 'P' GROUP BY 1, 2")
def graph_delete_edges(spark, sf_dir):
    e = edges(spark, sf_dir)
    return graph.delete_edges(supported(e), e.where("pathway_id = 'P'")).select("src", "dst", F.array_join("pathway_ids", ",").alias("pathway_ids"))


# The replay deletes customers in debt, renames and adds nodes, takes pending orders out and puts open ones in.
_REPLAY = f"""WITH {_NODES}, {_EDGES}, gone AS (SELECT 'C' || c_custkey AS id FROM customer WHERE c_acctbal < 0),
    ins AS (SELECT * FROM m WHERE id NOT IN (SELECT id FROM gone)),
    kept AS (SELECT coalesce(n.label, m.label) AS label, coalesce(n.id, m.id) AS id, coalesce(m.seg, n.seg) AS seg, coalesce(m.bal, n.bal) AS bal FROM (SELECT * FROM n WHERE id NOT IN (SELECT id FROM gone)) n FULL JOIN ins m ON n.label = m.label AND n.id = m.id),
    old AS (SELECT * FROM e WHERE p <> 'O' AND src NOT IN (SELECT id FROM gone) AND p <> 'P'), fresh AS (SELECT * FROM e WHERE p = 'O' AND src IN (SELECT id FROM kept) AND dst IN (SELECT id FROM kept))"""


def replayed(spark, sf_dir):
    first, load = nodes(spark, sf_dir)
    gone = t(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.lit("Customer").alias("label"), F.concat(F.lit("C"), "c_custkey").alias("id"))
    load = load.join(gone.select("id"), "id", "left_anti").select("label", "id", "props", F.lit("UPDATE").alias("action"))
    node_diff = load.unionByName(gone.withColumns({"props": F.create_map().cast("map<string,string>"), "action": F.lit("DELETE")}))
    e = edges(spark, sf_dir)
    action = F.when(F.col("pathway_id") == "O", "INSERT").otherwise("DELETE")
    edge_diff = e.where("pathway_id in ('O', 'P')").withColumns({"action": action, "props": F.create_map().cast("map<string,string>")})
    return graph.replay_diff(first, supported(e.where("pathway_id <> 'O'")), node_diff, edge_diff)


@query(f"{_REPLAY} SELECT src, dst, array_to_string(list_sort(list(p)), ',') AS pathway_ids FROM (SELECT * FROM old UNION SELECT * FROM fresh) GROUP BY 1, 2")
def graph_replay_diff(spark, sf_dir):
    return replayed(spark, sf_dir)[1].select("src", "dst", F.array_join("pathway_ids", ",").alias("pathway_ids"))


@query(f"{_REPLAY} SELECT * FROM kept")
def graph_replay_diff_nodes(spark, sf_dir):
    return flat_nodes(replayed(spark, sf_dir)[0])


@query(f"WITH {_NODES} SELECT n.label, n.id, coalesce(m.seg, n.seg) AS seg, coalesce(m.bal, n.bal) AS bal, (SELECT count(*) FROM m) AS offered, (SELECT count(*) FROM m JOIN n USING (label, id)) AS matched FROM n LEFT JOIN m ON n.label = m.label AND n.id = m.id")
def graph_annotate_nodes(spark, sf_dir):
    first, load = nodes(spark, sf_dir)
    out, counts = graph.annotate_nodes(first, load)
    return flat_nodes(out).join(counts)


# Customers are genes with a symbol and two accessions; each order's lines annotate by symbol or by accession.
_GAF = """a AS (SELECT CASE WHEN o_custkey % 2 = 0 THEN c_name END AS symbol, 'A' || o_custkey AS accession, l_returnflag AS qualifier, 'P:' || l_partkey AS term, o_orderpriority AS evidence
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey), terms AS (SELECT 'P_' || p_partkey AS term FROM part WHERE p_size <= 30),
    g AS (SELECT c_custkey AS id, c_name AS symbol, ['A' || c_custkey, 'B' || (c_custkey - 1), 'A' || (c_custkey * 3)] AS acc FROM customer)"""


@query(f"""WITH {_GAF}, k AS (SELECT * REPLACE (replace(term, ':', '_') AS term) FROM a WHERE replace(term, ':', '_') IN (SELECT term FROM terms)),
    f AS (SELECT g.id AS gene, qualifier, term, evidence FROM k JOIN g USING (symbol) UNION SELECT id, qualifier, term, evidence FROM k JOIN (SELECT id, unnest(acc) AS accession FROM g) USING (accession))
    SELECT gene, qualifier, term, array_to_string(list_sort(list(DISTINCT evidence)), ',') AS evidence FROM f GROUP BY 1, 2, 3""")
def graph_ontology_annotations(spark, sf_dir):
    o, x, c = (t(spark, sf_dir, n) for n in ("orders", "lineitem", "customer"))
    rows = o.join(x, F.col("o_orderkey") == F.col("l_orderkey")).join(c, F.col("c_custkey") == F.col("o_custkey"))
    ann = rows.select(F.when(F.col("o_custkey") % 2 == 0, F.col("c_name")).alias("symbol"), F.concat(F.lit("A"), "o_custkey").alias("accession"), F.col("l_returnflag").alias("qualifier"), F.concat(F.lit("P:"), "l_partkey").alias("term"), F.col("o_orderpriority").alias("evidence"))
    k = F.col("c_custkey")
    genes = c.select(k.alias("id"), F.col("c_name").alias("symbol"), F.array(F.concat(F.lit("A"), k), F.concat(F.lit("B"), k - 1), F.concat(F.lit("A"), k * 3)).alias("uniprot_ids"))
    terms = t(spark, sf_dir, "part").where("p_size <= 30").select(F.concat(F.lit("P_"), "p_partkey").alias("term"))
    return graph.ontology_annotations(ann, genes, terms).withColumn("evidence", F.array_join("evidence", ","))


@query("""SELECT o_custkey AS gene, o_orderkey AS entity_id, o_orderpriority AS display_name FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)) WHERE n <= 25""")
def graph_forms_of(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    genes = t(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("gene"))
    return graph.forms_of(o.select(F.col("o_orderkey").alias("entity_id"), F.col("o_custkey").alias("reference_id")), o.select(F.col("o_orderkey").alias("entity_id"), F.col("o_orderpriority").alias("display_name")), genes)


@query("""WITH ann AS (SELECT DISTINCT l_returnflag || l_linestatus AS term, l_partkey AS gene FROM lineitem), h AS (SELECT l_returnflag || l_linestatus AS term, l_partkey AS gene, row_number() OVER (PARTITION BY l_returnflag || l_linestatus ORDER BY sum(l_quantity) DESC, l_partkey) AS rank FROM lineitem GROUP BY 1, 2)
    SELECT term, count(*) AS annotated, count(rank) AS found, min(rank) AS best_rank FROM (SELECT * FROM ann WHERE gene IN (SELECT p_partkey FROM part WHERE p_size <= 25)) LEFT JOIN (SELECT * FROM h WHERE rank <= 100) USING (term, gene) GROUP BY 1""")
def graph_grounded_hits(spark, sf_dir):
    from pyspark.sql import Window

    x = t(spark, sf_dir, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("term"), F.col("l_partkey").alias("gene"), "l_quantity")
    sums = x.groupBy("term", "gene").agg(F.sum("l_quantity").alias("q"))
    ranked = sums.withColumn("rank", F.row_number().over(Window.partitionBy("term").orderBy(F.desc("q"), "gene"))).where("rank <= 100")
    hits = ranked.select(F.col("term").alias("query_id"), F.col("gene").alias("id"), "rank")
    return graph.grounded_hits(x.select("term", "gene"), t(spark, sf_dir, "part").where("p_size <= 25").select(F.col("p_partkey").alias("id")), hits)


@query("""WITH RECURSIVE e AS (SELECT p_partkey AS src, p_partkey // 2 AS dst, CASE WHEN p_partkey % 2 = 0 THEN 'is_a' ELSE 'part_of' END AS label FROM part WHERE p_partkey > 1)
    SELECT p_partkey AS seed, p_partkey AS id FROM part UNION SELECT src, dst FROM e WHERE label = 'is_a' UNION SELECT a.src, b.dst FROM e a JOIN e b ON a.dst = b.src WHERE a.label = 'is_a' AND b.label = 'is_a'""")
def graph_expand_bounded_labels(spark, sf_dir):
    k = F.col("p_partkey")
    p = t(spark, sf_dir, "part")
    e = p.where("p_partkey > 1").select(k.alias("src"), F.floor(k / 2).cast("long").alias("dst"), F.when(k % 2 == 0, "is_a").otherwise("part_of").alias("label"))
    return graph.expand_bounded(e, p.select(k.alias("seed")), 0, 2, ["is_a"])


@query("SELECT c_custkey, 'c_name' AS \"column\", 'type' AS problem FROM customer WHERE c_name IS NOT NULL AND TRY_CAST(c_name AS INTEGER) IS NULL")
def dq_check_columns_types(spark, sf_dir):
    return dq.check_columns(t(spark, sf_dir, "customer"), "c_custkey", [], {}, {"c_name": "int", "c_nationkey": "int", "c_mktsegment": "string"})
