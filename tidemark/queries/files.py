"""Queries of record shaping, sources, sinks and streams. What sources read is written by Spark from the given tables, as
files of each format."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cdc, ir, shape
from ..operators.store import shared_dir
from ..sinks import files as sinks
from ..sources import files as sources
from ..streaming import cdc as streaming
from .base import query, t
from .core import _DIFF, _LINES, line_load


def folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def lines(rows: DataFrame, name: str, compression: str | None = None) -> str:
    """Writes a one-column table as text files; their folder."""
    path = folder(rows.sparkSession, name)
    rows.write.text(path, compression=compression)
    return path


def s(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


# Record shaping: parts are objects of a class by size, orders the things that hold them.
_CLASSES = ("EntityWithAccessionedSequence", "Complex", "DefinedSet", "SimpleEntity", "ChemicalDrug", "Polymer", "OtherEntity")
_CLASS_SQL = f"(list_value({', '.join(repr(c) for c in _CLASSES)}))[p_partkey % 7 + 1]"


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    p = t(spark, sf_dir, "part")
    kind = F.get(F.array(*map(F.lit, _CLASSES)), (k % 7).cast("int"))
    db = F.when(k % 7 == 0, F.when(k % 2 == 0, "UniProt").otherwise("ENSEMBL")).when(k % 7 == 3, "ChEBI").when(k % 7 == 4, "Guide to Pharmacology").when(k % 7 == 5, "Other DB 9")
    return p.select(
        F.concat(F.lit("P"), s(k % 5)).alias("pathway_id"), F.concat(F.lit("R-HSA-"), s(k)).alias("object_id"), kind.alias("class_name"),
        F.concat("p_name", F.when(k % 2 == 0, F.concat(F.lit(" ["), "p_brand", F.lit("]"))).otherwise("")).alias("display_name"), F.when(k % 3 != 0, F.array("p_brand")).alias("compartments"),
        F.split("p_name", " ").alias("names"), F.when(k % 4 != 0, F.array(F.concat(F.lit("S"), s(k % 23)), "p_brand")).alias("gene_names"),
        F.when(k % 11 != 0, F.concat(F.lit("X"), s(k))).alias("identifier"), db.alias("database"), F.when(k % 5 == 0, F.col("p_type")).alias("formula"), F.lit(None).cast("string").alias("ensembl_gene"),
    )


_OBJ = f"""ob AS (SELECT 'P' || (p_partkey % 5) AS pathway_id, 'R-HSA-' || p_partkey AS object_id, {_CLASS_SQL} AS class_name, p_name || CASE WHEN p_partkey % 2 = 0 THEN ' [' || p_brand || ']' ELSE '' END AS display_name, CASE WHEN p_partkey % 3 <> 0 THEN p_brand END AS compartment,
    string_split(p_name, ' ') AS names, CASE WHEN p_partkey % 4 <> 0 THEN ['S' || (p_partkey % 23), p_brand] END AS gene_names, CASE WHEN p_partkey % 11 <> 0 THEN 'X' || p_partkey END AS identifier, p_partkey % 7 AS m,
    CASE p_partkey % 7 WHEN 0 THEN CASE WHEN p_partkey % 2 = 0 THEN 'uniprot' ELSE 'ensembl' END WHEN 3 THEN 'chebi' WHEN 4 THEN 'guide to pharmacology' WHEN 5 THEN 'other db 9' ELSE '' END AS db, CASE WHEN p_partkey % 5 = 0 THEN p_type END AS formula, p_name, p_brand, p_partkey FROM part)"""


@query(f"WITH {_OBJ} SELECT object_id, (list_value('ewas', 'complex', 'defined_set', 'simple_entity', 'drug', 'polymer', 'other_entity'))[m + 1] AS entity_type FROM ob")
def shape_entity_type(spark, sf_dir):
    return objects(spark, sf_dir).select("object_id", shape.entity_type(F.col("class_name")).alias("entity_type"))


@query(f"WITH {_OBJ} SELECT object_id AS entity_id, p_name AS display_name, compartment FROM ob")
def shape_entity_data(spark, sf_dir):
    return shape.entity_data(objects(spark, sf_dir))


_REST = lambda c, sep: f"nullif(array_to_string({c}[2:], '{sep}'), '')"


@query(f"WITH {_OBJ} SELECT identifier AS uniprot_id, coalesce(gene_names[1], identifier) AS gene_name, names[1] AS full_name, {_REST('gene_names', ', ')} AS gene_synonym, CAST(NULL AS VARCHAR) AS ensembl_gene FROM ob")
def shape_gene(spark, sf_dir):
    return shape.gene(objects(spark, sf_dir))


@query(f"WITH {_OBJ} SELECT identifier AS compound_id, names[1] AS compound_name, formula, {_REST('names', '; ')} AS compound_synonyms FROM ob")
def shape_compound(spark, sf_dir):
    return shape.compound(objects(spark, sf_dir))


@query(f"WITH {_OBJ} SELECT identifier AS drug_id, display_name AS drug_name, class_name AS drug_type FROM ob")
def shape_drug(spark, sf_dir):
    return shape.drug(objects(spark, sf_dir))


@query(f"WITH {_OBJ} SELECT object_id AS pathway_id, display_name AS description FROM ob")
def shape_pathway(spark, sf_dir):
    return shape.pathway(objects(spark, sf_dir))


@query(f"WITH {_OBJ} SELECT object_id AS reaction_id, display_name AS name, compartment, class_name AS reaction_type, pathway_id FROM ob")
def shape_reaction(spark, sf_dir):
    return shape.reaction(objects(spark, sf_dir))


def fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p_partkey, r: flat-file records as maps."""
    k = F.col("p_partkey")
    pairs = {
        "ENTRY": F.concat(s(k), F.lit("  CDS")), "SYMBOL": F.when(k % 3 != 0, F.concat("p_brand", F.lit(", A"), s(k))), "NAME": F.when(k % 5 != 0, F.when(k % 2 == 0, F.concat("p_name", F.lit("; B"), s(k))).otherwise(F.concat(F.lit("(RefSeq) "), "p_name"))),
        "MOL_WEIGHT": F.when(k % 4 == 0, s("p_retailprice")), "MASS": F.when(k % 4 != 1, F.concat(s(k), F.lit(".128 (x)"))), "FORMULA": F.when(k % 6 == 0, F.col("p_type")), "COMPOSITION": F.when(k % 2 == 0, F.col("p_brand")),
        "DEFINITION": F.col("p_type"), "EQUATION": F.col("p_name"), "COMMENT": F.when(k % 7 == 0, F.lit("c")), "DESCRIPTION": F.when(k % 3 == 0, F.col("p_name")),
    }
    record = F.map_filter(F.create_map(*(x for kv in pairs.items() for x in (F.lit(kv[0]), kv[1]))), lambda a, b: b.isNotNull())
    return t(spark, sf_dir, "part").select("p_partkey", record.alias("r"))


_NAME = "CASE WHEN p_partkey % 5 <> 0 THEN CASE WHEN p_partkey % 2 = 0 THEN p_name || '; B' || p_partkey ELSE '(RefSeq) ' || p_name END END"
_MASS = "CASE WHEN p_partkey % 4 <> 1 THEN p_partkey + 0.128 ELSE 0 END"


def flat(spark: SparkSession, sf_dir: str, form) -> DataFrame:
    return fields(spark, sf_dir).select(form(F.col("r")).alias("x")).select("x.*")


@query(f"SELECT CASE WHEN p_partkey % 3 <> 0 THEN p_brand ELSE 'LOC' || p_partkey || '  CDS' END AS gene_name, CAST(p_partkey AS INTEGER) AS uid, trim(replace({_NAME}, '(RefSeq)', '')) AS full_name, CASE WHEN p_partkey % 3 <> 0 THEN 'A' || p_partkey ELSE '' END AS gene_synonym FROM part")
def shape_kegg_gene(spark, sf_dir):
    return flat(spark, sf_dir, shape.kegg_gene)


def _substance(prefix: str) -> str:
    return f"""SELECT CAST(p_partkey AS VARCHAR) AS {prefix}_id, CASE WHEN p_partkey % 5 = 0 THEN 'NA' WHEN p_partkey % 2 = 0 THEN p_name ELSE '(RefSeq) ' || p_name END AS {prefix}_name, CASE WHEN p_partkey % 6 = 0 THEN p_type WHEN p_partkey % 2 = 0 THEN p_brand ELSE 'NA' END AS formula,
        CASE WHEN p_partkey % 5 <> 0 AND p_partkey % 2 = 0 THEN ' B' || p_partkey ELSE 'NA' END AS {prefix}_synonyms, round(CASE WHEN p_partkey % 4 = 0 THEN CAST(p_retailprice AS DOUBLE) ELSE {_MASS} END, 2) AS mol_weight FROM part"""


@query(_substance("compound"))
def shape_kegg_compound(spark, sf_dir):
    return flat(spark, sf_dir, shape.kegg_compound)


@query(_substance("drug"))
def shape_kegg_drug(spark, sf_dir):
    return flat(spark, sf_dir, shape.kegg_drug)


@query(f"SELECT CAST(p_partkey AS VARCHAR) AS glycan_id, coalesce({_NAME}, 'undefined') AS glycan_name, CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE 'undefined' END AS composition, round(CAST({_MASS} AS DOUBLE), 2) AS mass FROM part")
def shape_kegg_glycan(spark, sf_dir):
    return flat(spark, sf_dir, shape.kegg_glycan)


@query(f"SELECT CAST(p_partkey AS VARCHAR) AS ortho_id, CASE WHEN p_partkey % 3 <> 0 THEN p_brand END AS ortho_name, {_NAME} AS full_name FROM part")
def shape_kegg_ortholog(spark, sf_dir):
    return flat(spark, sf_dir, shape.kegg_ortholog)


@query(f"SELECT CAST(p_partkey AS VARCHAR) AS reaction_id, coalesce({_NAME}, 'undefined') AS name, p_type AS definition, p_name AS equation, CASE WHEN p_partkey % 7 = 0 THEN 'c' END AS comment, CAST(NULL AS VARCHAR) AS reaction_type, CAST(NULL AS VARCHAR) AS pathway_id FROM part")
def shape_kegg_reaction(spark, sf_dir):
    return flat(spark, sf_dir, shape.kegg_reaction)


@query("SELECT CAST(p_partkey AS VARCHAR) AS pathway_id, CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE '' END AS description FROM part")
def shape_kegg_pathway(spark, sf_dir):
    return flat(spark, sf_dir, shape.kegg_pathway)


@query(f"WITH {_OBJ} SELECT object_id, CASE db WHEN 'chebi' THEN 'chebi' WHEN 'guide to pharmacology' THEN 'gtp' WHEN '' THEN 'unknown' ELSE replace(db, ' ', '') END || coalesce(':' || identifier, '') AS node_id FROM ob")
def shape_namespaced_id(spark, sf_dir):
    return objects(spark, sf_dir).select("object_id", shape.namespaced_id(F.lower("database"), F.col("identifier")).alias("node_id"))


@query("SELECT l_orderkey, count(*) AS n, CAST(sum(l_partkey) AS BIGINT) AS total FROM lineitem GROUP BY 1 UNION ALL SELECT -1 - o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END FROM orders")
def shape_as_list(spark, sf_dir):
    many = t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.to_json(F.collect_list(F.struct(F.col("l_partkey").alias("id")))).alias("j"))
    one = t(spark, sf_dir, "orders").select((-1 - F.col("o_orderkey")).alias("l_orderkey"), F.when(F.col("o_orderkey") % 2 == 0, F.to_json(F.struct(F.col("o_custkey").alias("id")))).otherwise("17").alias("j"))
    parsed = many.unionByName(one).select("l_orderkey", shape.as_list(F.col("j"), "struct<id:bigint>").alias("a"))
    total = F.aggregate("a", F.lit(0).cast("long"), lambda x, y: x + y["id"])
    return parsed.select("l_orderkey", F.size("a").cast("long").alias("n"), F.when(F.size("a") > 0, total).alias("total"))


def residues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as residues: lines are modifications, of three kinds, and the first and second line's flags the psi-mod terms."""
    x = t(spark, sf_dir, "lineitem")
    k = F.col("l_partkey")
    mod = F.struct(F.when(k % 3 == 0, F.concat(F.lit("R-HSA-"), s(k))).when(k % 3 == 1, F.concat(F.lit("chebi:"), s(k))).otherwise(F.concat(F.lit("other:"), s(k))).alias("id"), F.when(k % 4 != 0, s(k)).alias("identifier"))
    rows = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", mod.alias("m"), F.concat(F.lit("MOD:"), "l_returnflag").alias("p"))))
    r = x.groupBy(F.concat(F.lit("O"), s("l_orderkey")).alias("entity_id")).agg(rows.alias("r"))
    return r.select("entity_id", F.transform(F.slice("r", 1, 2), lambda y: y["p"]).alias("psi_mods"), F.transform("r", lambda y: y["m"]).alias("modifications"))


_RES = """rs AS (SELECT 'O' || l_orderkey AS entity_id, l_partkey AS k, l_returnflag, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag) AS i FROM lineitem),
    rp AS (SELECT *, first_value(l_returnflag) OVER (PARTITION BY entity_id ORDER BY i) AS f FROM rs),
    mo AS (SELECT entity_id, CASE WHEN k % 3 = 0 THEN 'R-HSA-' || k WHEN k % 4 <> 0 THEN 'chebi:' || k END AS moiety_id, 'MOD:' || CASE WHEN i <= 2 THEN l_returnflag ELSE f END AS psi_mod, k % 3 = 1 AS is_reference FROM rp WHERE k % 3 <> 2 AND (k % 3 = 0 OR k % 4 <> 0))"""


@query(f"WITH {_RES} SELECT * FROM mo")
def shape_moieties(spark, sf_dir):
    return shape.moieties(residues(spark, sf_dir))


def children(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = t(spark, sf_dir, "lineitem")
    return x.select(F.concat(F.lit("P"), s(F.col("l_orderkey") % 5)).alias("pathway_id"), F.concat(F.lit("O"), s(F.col("l_orderkey") % 200)).alias("parent_id"), F.get(F.array(*map(F.lit, shape.SLOTS)), (F.col("l_linenumber") % 4).cast("int")).alias("rel"), F.when(F.col("l_partkey") % 9 != 0, F.concat(F.lit("R-HSA-"), s("l_partkey"))).alias("child_id"))


_MEM = """mem AS (SELECT 'P' || (l_orderkey % 5) AS pathway_id, 'O' || (l_orderkey % 200) AS parent_id, (list_value('hasComponent', 'hasMember', 'hasCandidate', 'repeatedUnit'))[l_linenumber % 4 + 1] AS rel, 'R-HSA-' || l_partkey AS child_id, count(*) AS stoichiometry FROM lineitem WHERE l_partkey % 9 <> 0 GROUP BY ALL)"""


@query(f"WITH {_MEM} SELECT * FROM mem")
def shape_membership(spark, sf_dir):
    return shape.membership(children(spark, sf_dir))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as gene products, their parts the references."""
    x = t(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey").distinct()
    db = F.when(F.col("l_partkey") % 3 == 0, "ENSEMBL").when(F.col("l_partkey") % 3 == 1, "HGNC")
    refs = F.array_sort(F.collect_list(F.struct(s("l_partkey").alias("o"), db.alias("db"), F.concat(F.lit("X"), s("l_partkey")).alias("id"))))
    return x.groupBy(F.concat(F.lit("U"), s("l_suppkey")).alias("uniprot_id")).agg(F.transform(refs, lambda r: F.struct(r["db"].alias("db"), r["id"].alias("id"))).alias("refs"))


_XREF = "xr AS (SELECT DISTINCT 'U' || l_suppkey AS uniprot_id, CASE l_partkey % 3 WHEN 0 THEN 'ENSEMBL' WHEN 1 THEN 'HGNC' ELSE 'unknown' END AS xref_db, 'X' || l_partkey AS xref_id FROM lineitem)"


@query(f"WITH {_XREF} SELECT x.*, e.ensembl_gene FROM xr x LEFT JOIN (SELECT uniprot_id, min(xref_id) AS ensembl_gene FROM xr WHERE xref_db = 'ENSEMBL' GROUP BY 1) e USING (uniprot_id)")
def shape_gene_xrefs(spark, sf_dir):
    xrefs, first = shape.gene_xrefs(products(spark, sf_dir))
    return xrefs.join(first, "uniprot_id", "left")


_IDENT = f"""{_OBJ}, {_XREF}, kd AS (SELECT *, CASE WHEN db = 'uniprot' THEN 'gene' WHEN m IN (3, 4, 5) THEN CASE WHEN m = 4 THEN 'drug' ELSE 'compound' END ELSE 'sequence' END AS kind FROM ob WHERE identifier IS NOT NULL),
    sy AS (SELECT pathway_id, symbol, min(identifier) AS by_symbol FROM (SELECT pathway_id, identifier, unnest(gene_names) AS symbol FROM kd WHERE kind = 'gene') GROUP BY 1, 2), xx AS (SELECT xref_id, min(uniprot_id) AS by_xref FROM xr WHERE xref_id LIKE '%7' GROUP BY 1),
    br AS (SELECT k.pathway_id, object_id, coalesce(max(by_xref), max(s1.by_symbol), max(s2.by_symbol)) AS r FROM kd k LEFT JOIN xx ON xref_id = identifier LEFT JOIN sy s1 ON s1.pathway_id = k.pathway_id AND s1.symbol = gene_names[1] LEFT JOIN sy s2 ON s2.pathway_id = k.pathway_id AND s2.symbol = gene_names[2] WHERE kind = 'sequence' GROUP BY 1, 2),
    idn AS (SELECT pathway_id, object_id AS entity_id, CASE WHEN kind = 'gene' THEN identifier ELSE CASE m WHEN 3 THEN 'chebi:' WHEN 4 THEN 'gtp:' ELSE 'otherdb9:' END || identifier END AS reference_id, kind AS reference_type FROM kd WHERE kind <> 'sequence' UNION ALL SELECT pathway_id, object_id, r, 'gene' FROM br WHERE r IS NOT NULL)"""


@query(f"WITH {_IDENT} SELECT * FROM idn")
def shape_identities(spark, sf_dir):
    return shape.identities(objects(spark, sf_dir), shape.gene_xrefs(products(spark, sf_dir))[0].where("xref_id like '%7'"))


@query(f"WITH {_OBJ}, {_MEM}, {_RES}, {_XREF} SELECT 'entity_data' AS \"table\", count(*) AS n FROM ob UNION ALL SELECT 'memberships', count(*) FROM mem UNION ALL SELECT 'moieties', count(*) FROM (SELECT DISTINCT entity_id, moiety_id, psi_mod FROM mo) UNION ALL SELECT 'gene_xrefs', count(*) FROM xr UNION ALL SELECT 'entity_path_mem', count(DISTINCT (object_id, pathway_id)) FROM ob UNION ALL SELECT 'participations', count(*) FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)")
def shape_record_fanout(spark, sf_dir):
    o = objects(spark, sf_dir)
    parts = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("reaction_id"), F.col("l_partkey").alias("entity_id"))
    made = shape.record_fanout(o, children(spark, sf_dir), parts, residues(spark, sf_dir), products(spark, sf_dir), o.select("pathway_id", F.col("object_id").alias("entity_id")))
    names = ["entity_data", "memberships", "moieties", "gene_xrefs", "entity_path_mem", "participations"]
    out = [made[n].agg(F.count("*").alias("n")).select(F.lit(n).alias("table"), "n") for n in names]
    return out[0].union(out[1]).union(out[2]).union(out[3]).union(out[4]).union(out[5])


_FRONT = """st AS (SELECT p_partkey AS a, p_partkey // 3 AS b FROM part WHERE p_partkey >= 3 AND p_size > 10), mt AS (SELECT p_partkey AS e, p_partkey + 5 AS m FROM part WHERE p_partkey % 50 = 0),
    f1 AS (SELECT p_partkey AS id FROM part WHERE p_size > 35 UNION SELECT b FROM f1 JOIN st ON a = id), f2 AS (SELECT m AS id FROM mt JOIN f1 ON e = f1.id WHERE e IN (SELECT p_partkey FROM part WHERE p_size > 10) UNION SELECT b FROM f2 JOIN st ON a = id), al AS (SELECT id FROM f1 UNION SELECT id FROM f2)"""


@query(f"WITH RECURSIVE {_FRONT} SELECT id, id IN (SELECT p_partkey FROM part WHERE p_size > 10) AS resolved FROM al")
def shape_resolve_frontier(spark, sf_dir):
    p = t(spark, sf_dir, "part")
    k = F.col("p_partkey")
    steps = p.where("p_partkey >= 3").select(k.alias("parent_id"), F.floor(k / 3).cast("long").alias("child_id"))
    moiety = p.where("p_partkey % 50 = 0").select(k.alias("entity_id"), (k + 5).alias("moiety_id"), F.lit(False).alias("is_reference"))
    known, lost = shape.resolve_frontier(p.where("p_size > 35").select(k.alias("id")), steps, moiety, p.where("p_size > 10").select(k.alias("object_id")))
    return known.withColumn("resolved", F.lit(True)).unionByName(lost.withColumn("resolved", F.lit(False)))


@query("SELECT 'customer' AS entity_type, c_custkey AS key FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') UNION ALL SELECT 'part', p_partkey FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50)")
def shape_route_annotations(spark, sf_dir):
    c, p = t(spark, sf_dir, "customer"), t(spark, sf_dir, "part")
    changed = t(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("entity_id"), F.lit("customer").alias("entity_type"))
    changed = changed.union(t(spark, sf_dir, "lineitem").where("l_quantity = 50").select("l_partkey", F.lit("part"))).union(c.select("c_custkey", F.lit("pathway")))
    out = shape.route_annotations(changed, {"customer": c, "part": p}, {"customer": "c_custkey", "part": "p_partkey"})
    return out["customer"].select(F.lit("customer").alias("entity_type"), F.col("c_custkey").alias("key")).union(out["part"].select(F.lit("part"), "p_partkey"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus || ',' || o_custkey END AS tags, strftime(CAST(o_orderdate AS TIMESTAMP) + INTERVAL 90 MINUTE, '%Y-%m-%dT%H:%M:%S') AS at FROM orders")
def shape_flatten_row(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    tags = F.when(F.col("o_orderkey") % 3 != 0, F.array("o_orderstatus", s("o_custkey"))).otherwise(F.array().cast("array<string>"))
    return shape.flatten_row(o.select("o_orderkey", tags.alias("tags"), (F.to_timestamp("o_orderdate") + F.expr("interval 90 minutes")).alias("at")))


@query("SELECT CASE WHEN c_acctbal < 0 THEN 'Debtor' ELSE 'Customer' END AS label, CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS name, CAST(c_nationkey AS VARCHAR) AS nation, CAST(CASE WHEN c_custkey % 2 = 0 THEN 2 ELSE 1 END AS INTEGER) AS n_props, CAST(2 AS INTEGER) AS n_labels FROM customer")
def shape_graph_nodes(spark, sf_dir):
    c = t(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("c_name"), "c_nationkey", "c_acctbal")
    label = F.when(F.col("c_acctbal") < 0, "Debtor").otherwise("Customer")
    n = shape.graph_nodes(c.withColumn("label_", label).drop("c_acctbal"), "c_custkey", F.col("label_"), {"c_name": "name", "c_nationkey": "nation"}, "Entity")
    return n.select("label", "id", F.col("props")["name"].alias("name"), F.col("props")["nation"].alias("nation"), (F.size("props") - 1).alias("n_props"), F.size("labels").alias("n_labels"))


@query(f"""WITH {_MEM} SELECT child_id AS src, parent_id AS dst, CASE rel WHEN 'hasMember' THEN 'HAS_MEMBER' WHEN 'hasCandidate' THEN 'HAS_CANDIDATE' ELSE 'HAS_COMPONENT' END AS label, pathway_id, CAST(stoichiometry AS VARCHAR) AS n FROM mem
    UNION ALL SELECT CASE WHEN l_returnflag = 'A' THEN 'O' || l_orderkey ELSE 'L' || l_partkey END, CASE WHEN l_returnflag = 'A' THEN 'L' || l_partkey ELSE 'O' || l_orderkey END, CASE l_returnflag WHEN 'A' THEN 'PRODUCT' WHEN 'R' THEN 'REACTANT' ELSE 'CATALYST' END, 'P1', NULL FROM lineitem""")
def shape_graph_edges(spark, sf_dir):
    m = shape.graph_edges(shape.membership(children(spark, sf_dir)), "memberships")
    role = F.when(F.col("l_returnflag") == "A", "product").when(F.col("l_returnflag") == "R", "reactant").otherwise("catalyst")
    x = t(spark, sf_dir, "lineitem").select(F.concat(F.lit("O"), s("l_orderkey")).alias("reaction_id"), F.concat(F.lit("L"), s("l_partkey")).alias("entity_id"), role.alias("role"), F.lit("P1").alias("pathway_id"))
    both = m.unionByName(shape.graph_edges(x, "participations"))
    return both.select("src", "dst", "label", "pathway_id", F.col("props")["stoichiometry"].alias("n"))


# Ontology JSON: parts are classes, some deprecated or without a label.


def ontology(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) by way of a JSON file a thousand parts."""
    k = F.col("p_partkey")
    url = lambda c: F.concat(F.lit("http://x.org/obo/GO_"), s(c))
    prop = lambda p, v: F.struct(F.lit(f"http://x.org/ns#{p}").alias("pred"), v.alias("val"))
    val = lambda c: F.struct(c.alias("val"))
    meta = F.struct(val(F.col("p_type")).alias("definition"), F.when(k % 13 == 0, True).alias("deprecated"), F.array(val(F.col("p_brand"))).alias("synonyms"), F.array(prop("size", s("p_size")), prop("hasSpace", F.lit("old")), prop("hasSpace", F.col("p_brand"))).alias("basicPropertyValues"))
    node = F.struct(url(k).alias("id"), F.when(k % 7 != 0, F.col("p_name")).alias("lbl"), F.when(k % 17 == 0, "PROPERTY").otherwise("CLASS").alias("type"), meta.alias("meta"))
    pred = F.when(k % 2 == 0, "is_a").otherwise("http://x.org/obo/BFO_0000050")
    edge = F.struct(url(k).alias("sub"), pred.alias("pred"), url(F.floor(k / 3).cast("long")).alias("obj"))
    graph = F.struct(F.collect_list(node).alias("nodes"), F.collect_list(F.when(k >= 3, edge)).alias("edges"))
    docs = t(spark, sf_dir, "part").groupBy(F.floor(k / 1000).alias("_g")).agg(graph.alias("g")).select("_g", F.to_json(F.struct(F.array("g").alias("graphs"))).alias("value"))
    # One document a file, as a folder each: obo_graph reads whole files, and a second document in one would be lost.
    path = folder(spark, "obo")
    docs.write.partitionBy("_g").text(path)
    return sources.obo_graph(spark, path)


_ONTO = "SELECT 'GO_' || p_partkey AS term, p_name AS name, p_type AS definition, p_brand AS synonyms, p_brand AS space, CAST(p_size AS VARCHAR) AS size FROM part WHERE p_partkey % 13 <> 0 AND p_partkey % 7 <> 0 AND p_partkey % 17 <> 0"


@query(_ONTO)
def shape_ontology_nodes(spark, sf_dir):
    n = shape.ontology_nodes(ontology(spark, sf_dir)[0])
    return n.select("term", "name", *(F.col("props")[a].alias(b) for a, b in (("definition", "definition"), ("synonyms", "synonyms"), ("hasSpace", "space"), ("size", "size"))))


@query("SELECT 'GO_' || p_partkey AS child, 'GO_' || (p_partkey // 3) AS parent, CASE WHEN p_partkey % 2 = 0 THEN 'is_a' ELSE 'part_of' END AS rel FROM part WHERE p_partkey >= 3 AND p_partkey % 13 <> 0 AND ((p_partkey // 3) % 13 <> 0 OR p_partkey // 3 NOT IN (SELECT p_partkey FROM part))")
def shape_ontology_edges(spark, sf_dir):
    nodes, edges = ontology(spark, sf_dir)
    return shape.ontology_edges(edges, nodes)


@query("SELECT 'http://x.org/obo/GO_' || p_partkey AS id, CASE WHEN p_partkey % 7 <> 0 THEN p_name END AS lbl FROM part")
def sources_obo_graph(spark, sf_dir):
    return ontology(spark, sf_dir)[0].select("id", "lbl")


# Pathway XML: a supplier is a pathway, its parts the species, its orders the reactions.


def sbml_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Exchanged once, before the texts are made, which are thirty times as long; compressed, as files of such texts are.
    x = t(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_partkey", "l_returnflag", "l_linenumber").repartition("l_suppkey").distinct()
    ref = lambda uri: f'<annotation><rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:bqbiol="http://biomodels.net/biology-qualifiers/"><rdf:Description><bqbiol:is><rdf:Bag><rdf:li rdf:resource="{uri}"/></rdf:Bag></bqbiol:is></rdf:Description></rdf:RDF></annotation>'
    own = F.when(F.col("l_partkey") % 2 == 0, F.format_string(ref("http://identifiers.org/reactome:R-HSA-%d"), "l_partkey")).otherwise(F.format_string(ref("http://identifiers.org/uniprot/U%d"), "l_partkey"))
    species = F.concat(F.format_string('<species id="s%d" name="part %d" compartment="c1">', "l_partkey", "l_partkey"), own, F.lit("</species>"))
    flag = F.col("l_returnflag")
    side = lambda f: F.concat_ws("", F.array_sort(F.collect_list(F.when(flag == f, F.format_string('<speciesReference species="s%d" stoichiometry="%d.0"/>', "l_partkey", "l_linenumber")))))
    mods = F.concat_ws("", F.array_sort(F.collect_list(F.when(flag == "N", F.format_string('<modifierSpeciesReference species="s%d" sboTerm="SBO:00000%s"/>', "l_partkey", F.when(F.col("l_linenumber") % 2 == 0, "13").otherwise("20"))))))
    r = x.groupBy("l_suppkey", "l_orderkey").agg(side("R").alias("r"), side("A").alias("p"), mods.alias("m"))
    rx = r.select("l_suppkey", F.concat(F.format_string('<reaction id="reaction_%d" name="order %d" compartment="c1">', "l_orderkey", "l_orderkey"), F.lit("<listOfReactants>"), "r", F.lit("</listOfReactants><listOfProducts>"), "p", F.lit("</listOfProducts><listOfModifiers>"), "m", F.lit("</listOfModifiers></reaction>")).alias("x"))
    a = x.groupBy("l_suppkey").agg(F.concat_ws("", F.array_sort(F.collect_set(species))).alias("s"))
    b = rx.groupBy("l_suppkey").agg(F.concat_ws("", F.array_sort(F.collect_list("x"))).alias("x"))
    head = '<sbml xmlns="http://www.sbml.org/sbml/level3/version1/core"><model id="pathway_%d" name="supplier %d"><listOfCompartments><compartment id="c1" name="cytosol"/></listOfCompartments><listOfSpecies>'
    docs = a.join(b, "l_suppkey").select(F.concat(F.format_string(head, "l_suppkey", "l_suppkey"), "s", F.lit("</listOfSpecies><listOfReactions>"), "x", F.lit("</listOfReactions></model></sbml>")).alias("value"))
    return spark.read.text(lines(docs, "sbml", "gzip")).select(F.col("value").alias("text"))


@query("""SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS pathway_id, CAST(l_orderkey AS VARCHAR) AS reaction_id, CASE WHEN l_partkey % 2 = 0 THEN 'R-HSA-' || l_partkey ELSE 's' || l_partkey END AS entity_id,
    CASE l_returnflag WHEN 'R' THEN 'reactant' WHEN 'A' THEN 'product' ELSE CASE WHEN l_linenumber % 2 = 0 THEN 'catalyst' ELSE 'inhibitor' END END AS role, CASE WHEN l_returnflag = 'N' THEN 1 ELSE CAST(l_linenumber AS INTEGER) END AS stoichiometry FROM lineitem""")
def sources_sbml(spark, sf_dir):
    return sources.sbml(sbml_files(spark, sf_dir))[3].distinct()


@query("SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS pathway_id, CASE WHEN l_partkey % 2 = 0 THEN 'R-HSA-' || l_partkey ELSE 's' || l_partkey END AS entity_id, 'part ' || l_partkey AS display_name, 'cytosol' AS compartment, CASE WHEN l_partkey % 2 <> 0 THEN 'U' || l_partkey END AS uniprot, CAST(NULL AS VARCHAR) AS chebi FROM lineitem")
def sources_sbml_species(spark, sf_dir):
    return sources.sbml(sbml_files(spark, sf_dir))[1]


# Graphic pathway XML: entries are lines with a gene and a compound, relations go from each to the next but one number.


def kgml_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = t(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("k"), F.min("l_suppkey").alias("q"))
    kind = F.when(F.col("l_linenumber") % 5 == 4, "map").otherwise("gene")
    entry = F.format_string('<entry id="%d" name="hsa:%d cpd:C%d" type="%s"/>', "l_linenumber", "k", "q", kind)
    rel = F.format_string('<relation entry1="%d" entry2="%d">%s</relation>', "l_linenumber", F.col("l_linenumber") + 1, F.when(F.col("l_linenumber") % 2 == 0, '<subtype name="activation" value="x"/>').otherwise(""))
    rx = F.format_string('<reaction id="%d" name="rn:R%d" type="x"><substrate id="1" name="cpd:S%d"/><product id="2" name="gl:G%d"/></reaction>', "l_linenumber", "k", "q", "k")
    all_ = lambda c: F.concat_ws("", F.array_sort(F.collect_list(c)))
    docs = x.groupBy("l_orderkey").agg(F.concat(all_(entry), all_(rel), all_(rx)).alias("b")).select(F.concat(F.format_string('<pathway name="path:hsa%d" title="order %d">', "l_orderkey", "l_orderkey"), "b", F.lit("</pathway>")).alias("value"))
    return spark.read.text(lines(docs, "kgml")).select(F.col("value").alias("text"))


_KGML = "x AS MATERIALIZED (SELECT 'hsa' || l_orderkey AS pathway_id, l_linenumber AS i, min(l_partkey) AS k, min(l_suppkey) AS q FROM lineitem GROUP BY 1, 2), en AS MATERIALIZED (SELECT * FROM x WHERE i % 5 <> 4), ref AS MATERIALIZED (SELECT pathway_id, i, CAST(k AS VARCHAR) AS e FROM en UNION ALL SELECT pathway_id, i, 'C' || q FROM en)"


@query(f"WITH {_KGML} SELECT a.e AS source_id, b.e AS target_id, CASE WHEN a.i % 2 = 0 THEN 'activation' ELSE 'undefined' END AS relation_type, a.pathway_id FROM ref a JOIN ref b ON a.pathway_id = b.pathway_id AND b.i = a.i + 1")
def sources_kgml(spark, sf_dir):
    return sources.kgml(kgml_files(spark, sf_dir))[3]


@query(f"WITH {_KGML} SELECT DISTINCT 'R' || k AS reaction_id, u.e AS entity_id, u.r AS role, pathway_id FROM en, LATERAL (SELECT CAST(k AS VARCHAR) AS e, 'catalyst' AS r UNION ALL SELECT 'C' || q, 'catalyst' UNION ALL SELECT 'S' || q, 'substrate' UNION ALL SELECT 'G' || k, 'product') u")
def sources_kgml_participants(spark, sf_dir):
    return sources.kgml(kgml_files(spark, sf_dir))[4]


@query("SELECT p_partkey, 'C' || p_partkey AS code, 'compound' AS type FROM part UNION ALL SELECT p_partkey, 'G' || p_size, 'glycan' FROM part WHERE p_partkey % 2 = 0")
def sources_prefixed_refs(spark, sf_dir):
    k = F.col("p_partkey")
    refs = F.concat(F.lit(" cpd:C"), s(k), F.when(k % 2 == 0, F.concat(F.lit("  gl:G"), s("p_size"))).otherwise(""))
    return sources.prefixed_refs(t(spark, sf_dir, "part").select("p_partkey", refs.alias("refs")), "refs")


@query("SELECT CAST(p_partkey AS VARCHAR) AS entry, p_name || chr(10) || p_brand AS name, p_type || chr(10) || chr(30) || CAST(p_size AS VARCHAR) AS remark FROM part")
def sources_flatfile(spark, sf_dir):
    pad = lambda k: F.rpad(F.lit(k), 12, " ")
    nl = F.lit("\n")
    rec = F.concat(pad("ENTRY"), s("p_partkey"), nl, pad("NAME"), "p_name", nl, pad(""), "p_brand", nl, pad("REMARK"), "p_type", nl, pad("REMARK"), s("p_size"), nl, F.lit("///"))
    out = sources.flatfile(spark, lines(t(spark, sf_dir, "part").select(rec.alias("value")), "flat"))
    return out.select(F.col("fields")["ENTRY"].alias("entry"), F.col("fields")["NAME"].alias("name"), F.col("fields")["REMARK"].alias("remark"))


def tree_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """json: a tree a region, of its nations and their suppliers."""
    n = t(spark, sf_dir, "nation")
    sup = t(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("n_nationkey"), F.struct(F.concat(F.lit("07 "), "s_name").alias("name"), F.concat(F.lit("S"), s("s_suppkey")).alias("stId"), F.when(F.col("s_suppkey") % 2 == 0, "Pathway").otherwise("Reaction").alias("type")).alias("x"))
    kids = sup.groupBy("n_nationkey").agg(F.collect_list("x").alias("children"))
    nat = n.join(kids, "n_nationkey", "left").select("n_regionkey", F.struct(F.concat(F.lit(" 12 "), "n_name").alias("name"), F.concat(F.lit("N"), s("n_nationkey")).alias("stId"), F.lit("Pathway").alias("type"), "children").alias("x"))
    reg = nat.groupBy("n_regionkey").agg(F.collect_list("x").alias("children")).join(t(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
    return reg.select(F.to_json(F.struct(F.col("r_name").alias("name"), F.concat(F.lit("R"), s("n_regionkey")).alias("stId"), F.lit("TopLevelPathway").alias("type"), "children")).alias("value"))


@query("SELECT r_name AS name, NULL AS parent_name FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM nation) UNION ALL SELECT n_name, r_name FROM nation JOIN region ON r_regionkey = n_regionkey UNION ALL SELECT s_name, n_name FROM supplier JOIN nation ON n_nationkey = s_nationkey")
def sources_class_tree(spark, sf_dir):
    return sources.class_tree(spark.read.text(lines(tree_lines(spark, sf_dir), "tree")).select(F.col("value").alias("json")))


_EVENTS = "ev AS (SELECT 'R' || r_regionkey AS stid, NULL AS parent_stid FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM nation) UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey FROM nation UNION ALL SELECT 'S' || s_suppkey, 'N' || s_nationkey FROM supplier WHERE s_suppkey % 2 = 0)"


@query(f"WITH {_EVENTS} SELECT stid, parent_stid, stid NOT IN (SELECT parent_stid FROM ev WHERE parent_stid IS NOT NULL) AS leaf FROM ev")
def sources_event_tree(spark, sf_dir):
    hierarchy, leaves = sources.event_tree(spark.read.text(lines(tree_lines(spark, sf_dir), "tree")).select(F.col("value").alias("json")))
    return hierarchy.join(leaves.withColumn("l", F.lit(True)), "stid", "left").select("stid", "parent_stid", F.coalesce("l", F.lit(False)).alias("leaf"))


@query("SELECT 'hsa' || p_partkey AS pathway_id, p_name || chr(9) || p_brand AS description FROM part")
def sources_pathway_list(spark, sf_dir):
    row = F.concat(F.lit("hsa"), s("p_partkey"), F.lit("\t"), "p_name", F.lit("\t"), "p_brand")
    return sources.pathway_list(spark, lines(t(spark, sf_dir, "part").select(row.alias("value")).union(spark.range(3).select(F.lit(" "))), "list"))


@query("SELECT 'A' || l_partkey AS accession, l_returnflag AS qualifier, 'GO:' || l_suppkey AS term, CASE WHEN l_linenumber = 1 THEN '' ELSE l_linestatus END AS evidence, count(*) AS n FROM lineitem WHERE l_orderkey % 3 <> 0 GROUP BY ALL")
def sources_gaf(spark, sf_dir):
    fields_ = [F.when(F.col("l_orderkey") % 3 != 0, "UniProtKB").otherwise("PDB"), F.concat(F.lit("A"), s("l_partkey")), F.lit("sym"), F.col("l_returnflag"), F.concat(F.lit("GO:"), s("l_suppkey")), F.lit("ref"), F.when(F.col("l_linenumber") == 1, "").otherwise(F.col("l_linestatus"))]
    row = F.concat_ws("\t", *fields_, *[F.lit("x")] * 10)
    path = lines(spark.range(2).select(F.lit("!gaf-version: 2.2").alias("value")).union(t(spark, sf_dir, "lineitem").select(row)), "gaf")
    return sources.gaf(spark, path).groupBy("accession", "qualifier", "term", "evidence").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT 'A' || l_partkey AS uniprot_id, CAST(x AS VARCHAR) AS entrez_id FROM lineitem, LATERAL (SELECT l_suppkey AS x UNION ALL SELECT l_linenumber) u")
def sources_idmapping(spark, sf_dir):
    row = F.concat_ws("\t", F.concat(F.lit("A"), s("l_partkey")), F.lit("name"), F.concat(s("l_suppkey"), F.lit("; "), s("l_linenumber"), F.lit(";,")))
    return sources.idmapping(spark, lines(t(spark, sf_dir, "lineitem").select(row.alias("value")), "ids"))


@query("SELECT 'A' || p_partkey AS uniprot_id, p_name || ' ' || p_type AS function_text FROM part WHERE p_partkey % 4 <> 0")
def sources_function_tsv(spark, sf_dir):
    body = F.when(F.col("p_partkey") % 4 == 0, "FUNCTION:  {ECO:1}").otherwise(F.concat(F.lit("FUNCTION: "), "p_name", F.lit("  "), "p_type", F.lit(" {ECO:0000269}")))
    row = F.concat_ws("\t", F.concat(F.lit("A"), s("p_partkey")), body)
    path = folder(spark, "function")
    t(spark, sf_dir, "part").select(F.concat(F.lit("A"), s("p_partkey")).alias("Entry"), body.alias("Function")).write.csv(path, sep="\t", header=True, quote="")
    return sources.function_tsv(spark, path)


@query("SELECT 'A' || p_partkey AS id, p_name AS text FROM part WHERE p_partkey % 4 <> 0 UNION ALL SELECT 'S' || s_suppkey, s_name FROM supplier")
def sources_corpus(spark, sf_dir):
    k = F.col("p_partkey")
    name, body = F.concat(F.lit("A"), s(k)), F.when(k % 4 == 0, " ").otherwise(F.col("p_name"))
    rows = t(spark, sf_dir, "part").select(F.when(k % 2 == 0, F.to_json(F.struct(name.alias("uniprot_id"), body.alias("text")))).otherwise(F.to_json(F.struct(name.alias("gene"), body.alias("text")))).alias("value"))
    maps = t(spark, sf_dir, "supplier").select(F.to_json(F.create_map(F.concat(F.lit("S"), s("s_suppkey")), "s_name")))
    return sources.corpus(spark, lines(rows.union(maps), "corpus"))


@query("WITH p AS (SELECT 'A' || l_partkey AS id, CAST(l_suppkey AS VARCHAR) AS e FROM lineitem UNION SELECT 'B' || c_custkey, CAST(c_nationkey AS VARCHAR) FROM customer) SELECT id, array_to_string(list_sort(list(DISTINCT e)), ',') AS entrez_ids FROM p GROUP BY 1")
def sources_id_crosswalk(spark, sf_dir):
    many = t(spark, sf_dir, "lineitem").groupBy("l_suppkey", (F.col("l_orderkey") % 50).alias("_b")).agg(F.collect_set(F.concat(F.lit("A"), s("l_partkey"))).alias("a"))
    rows = many.select(F.to_json(F.create_map(s("l_suppkey"), "a")).alias("value"))
    plain = t(spark, sf_dir, "customer").select(F.to_json(F.create_map(F.concat(F.lit("B"), s("c_custkey")), s("c_nationkey"))))
    return sources.id_crosswalk(spark, lines(rows.union(plain), "walk")).select("id", F.array_join("entrez_ids", ",").alias("entrez_ids"))


@query("SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(10, 2)) AS DOUBLE) AS o_totalprice FROM orders")
def sources_table(spark, sf_dir):
    path = folder(spark, "orders")
    t(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(10,2)").alias("o_totalprice")).write.parquet(path)
    return sources.table(spark, path, empty_is_error=True)


@query("SELECT md5(n_name || chr(10)) AS file_hash, count(*) AS n FROM nation GROUP BY 1")
def sources_content_hash(spark, sf_dir):
    path = folder(spark, "hashes")
    t(spark, sf_dir, "nation").select(F.col("n_name"), F.col("n_nationkey").alias("k")).write.partitionBy("k").text(path)
    files_ = sources.content_hash(spark, path).where("path like '%.txt' and path not like '%/_%.txt/_%'")
    return files_.groupBy("file_hash").agg(F.count("*").alias("n"))


# Sinks: written and read again.


@query("SELECT o_custkey AS term, o_orderkey AS gene FROM orders UNION ALL SELECT -1 - l_partkey, l_suppkey FROM lineitem")
def sinks_training_export(spark, sf_dir):
    relevant = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("term"), F.col("o_orderkey").alias("gene"))
    train = t(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("anchor"), F.col("l_suppkey").alias("positive"), F.col("l_linenumber").alias("negative"))
    path = folder(spark, "training")
    sinks.training_export({"train": train, "relevant": relevant}, path)
    back = sinks.training_import(spark, path, {"train": "anchor long, positive long, negative long", "relevant": "term long, gene long"})
    return back["relevant"].unionByName(back["train"].select((-1 - F.col("anchor")).alias("term"), F.col("positive").alias("gene")))


@query("SELECT vec_id, len(embedding) AS n FROM embeddings UNION ALL SELECT -1 - vec_id, len(embedding) FROM embeddings")
def sinks_index_export(spark, sf_dir):
    e = t(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("dense"))
    path = folder(spark, "index")
    n = e.agg(F.count("*").alias("records"), F.count("*").alias("chunks"))
    sinks.index_export(e, e.withColumn("chunk_idx", F.lit(0)), n, path)
    records, chunks, _ = sinks.index_import(spark, path)
    return records.select(F.col("id").alias("vec_id"), F.size("dense").cast("long").alias("n")).unionByName(chunks.select((-1 - F.col("id")).alias("vec_id"), F.size("dense").cast("long").alias("n")))


@query("SELECT o_custkey AS query_id, count(*) FILTER (o_orderpriority = '1-URGENT') AS n_relevant, least(count(*), 100) AS n_ranked FROM orders GROUP BY 1 HAVING count(*) FILTER (o_orderpriority = '1-URGENT') > 0")
def sinks_per_query(spark, sf_dir):
    from .evaluation import arms

    ranked, relevant = arms(spark, sf_dir)
    path = folder(spark, "per-query")
    sinks.per_query(ranked, ir.per_query(ranked, relevant, (1, 10), 10), path)
    back = spark.read.schema("query_id long, n_relevant long, runs map<string,array<string>>").json(path)
    return back.select("query_id", "n_relevant", F.size(F.col("runs")["price"]).cast("long").alias("n_ranked"))


@query("SELECT o_orderstatus AS label, count(*) AS n FROM orders GROUP BY 1 UNION ALL SELECT c_mktsegment, count(*) FROM customer GROUP BY 1")
def sinks_graph(spark, sf_dir):
    empty = F.create_map().cast("map<string,string>")
    nodes = t(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("label"), s("c_custkey").alias("id"), empty.alias("props"))
    edges = t(spark, sf_dir, "orders").select(s("o_custkey").alias("src"), s("o_orderkey").alias("dst"), F.col("o_orderstatus").alias("label"))
    path = folder(spark, "graph")
    sinks.graph(nodes, edges, path)
    count = lambda kind: spark.read.parquet(f"{path}/{kind}").groupBy("label").agg(F.count("*").alias("n"))
    return count("nodes").unionByName(count("edges"))


@query(f"WITH {_LINES}, {_DIFF} SELECT 'b' AS run_id, * FROM (SELECT * FROM ins UNION ALL SELECT * FROM del) UNION ALL SELECT 'a', *, 'INSERT' FROM cur")
def sinks_diff(spark, sf_dir):
    cur, stg, cols = line_load(spark, sf_dir)
    path = folder(spark, "difflog")
    sinks.diff(cur.withColumn("action", F.lit("INSERT")), path, "a")
    sinks.diff(stg.withColumn("action", F.lit("INSERT")), path, "b")
    sinks.diff(cdc.merge_identity(cur, stg, cols, ["l_orderkey"])[1], path, "b")  # run again: replaces its rows
    return spark.read.parquet(path).select("run_id", *cols, "action")


# Streams: users' events by type are scopes of three loads; the third load of a user has only some of its events.


def event_loads(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """(folder of the loads as files, in order of time; the events)"""
    e = t(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    path = folder(spark, "loads")
    for i, part in enumerate((e.where("event_id % 2 = 0"), e.where("user_id % 2 = 0"), e.where("user_id % 3 = 0 and event_id % 3 = 0"))):
        part.coalesce(1).write.mode("append").parquet(path)
    return path, e


def replay(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str, str]:
    """(new table, path of the log, schema) after the three loads came as a stream, one file a batch."""
    path, e = event_loads(spark, sf_dir)
    table, log, check = (folder(spark, n) for n in ("table", "log", "checkpoint"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in e.schema)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    streaming.cdc_apply(stream, table, log, check, ["user_id", "event_type", "event_id"], ["user_id"], ["event_id"]).awaitTermination()
    return streaming.latest(spark, table, schema, ["user_id"]), log, schema


@query("""SELECT user_id, event_type, event_id FROM events e WHERE CASE WHEN user_id % 3 = 0 AND user_id IN (SELECT user_id FROM events WHERE event_id % 3 = 0) THEN event_id % 3 = 0 WHEN user_id % 2 = 0 THEN true ELSE event_id % 2 = 0 END""")
def stream_cdc_apply(spark, sf_dir):
    return replay(spark, sf_dir)[0]


@query("""WITH a AS (SELECT user_id, event_id FROM events WHERE event_id % 2 = 0), b AS (SELECT user_id, event_id FROM events WHERE user_id % 2 = 0), ab AS (SELECT * FROM a WHERE user_id % 2 <> 0 UNION ALL SELECT * FROM b), c AS (SELECT user_id, event_id FROM events WHERE user_id % 3 = 0 AND event_id % 3 = 0)
    SELECT '0' AS run_id, user_id FROM a UNION SELECT '1', user_id FROM b WHERE event_id % 2 <> 0 UNION SELECT '2', user_id FROM ab WHERE user_id IN (SELECT user_id FROM c) AND event_id % 3 <> 0 UNION SELECT '2', user_id FROM c WHERE event_id NOT IN (SELECT event_id FROM ab)""")
def stream_changed_scopes(spark, sf_dir):
    _, log, schema = replay(spark, sf_dir)
    out = folder(spark, "scopes")
    streaming.changed_scopes(spark, log, f"{schema}, action string", "user_id", folder(spark, "checkpoint"), out).awaitTermination()
    return spark.read.schema(f"run_id string, user_id {dict(x.split() for x in schema.split(', '))['user_id']}").parquet(out)
