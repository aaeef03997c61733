"""Queries of the derived network. Orders are reactions of three pathways, parts their participants; a part's role comes
from its line. Parts 40k to 40k + 39 are below part k in the pathway of their own number; some parts are genes, some compounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import graph, net
from .base import query, t

_BASE = """WITH RECURSIVE parts AS (SELECT DISTINCT 'P' || (l_orderkey % 3) AS p, 'R' || l_orderkey AS r, 'E' || l_partkey AS e, CASE WHEN l_returnflag = 'R' THEN 'reactant' WHEN l_returnflag = 'A' THEN 'product'
        WHEN l_linenumber % 3 = 0 THEN 'catalyst' WHEN l_linenumber % 3 = 1 THEN 'inhibitor' ELSE 'stimulator' END AS role FROM lineitem),
    mem AS (SELECT 'P' || (p_partkey % 3) AS p, 'E' || (p_partkey // 40) AS parent, 'E' || p_partkey AS child FROM part WHERE p_partkey >= 40),
    own AS (SELECT * FROM (SELECT 'E' || p_partkey AS id, CASE WHEN p_partkey % 4 = 3 THEN 'Compound' ELSE 'Gene' END AS label,
        CASE WHEN p_partkey % 4 <> 3 THEN 'G' || (p_partkey % 97) WHEN p_partkey % 28 = 3 THEN 'chebi:15377' ELSE 'chebi:' || (p_partkey % 89) END AS key FROM part WHERE p_partkey % 4 <> 0) WHERE key <> 'chebi:15377'),
    moi AS (SELECT 'E' || p_partkey AS id, 'E' || (p_partkey // 2 + 1) AS m FROM part WHERE p_partkey % 7 = 0),
    clo AS (SELECT p, e AS seed, e AS id FROM parts UNION SELECT p, m, m FROM moi, (VALUES ('P0'), ('P1'), ('P2')) AS x(p)
        UNION SELECT clo.p, seed, child FROM clo JOIN mem ON clo.p = mem.p AND clo.id = mem.parent),
    rx AS (SELECT DISTINCT p, r, e FROM parts WHERE role = 'reactant'), pr AS (SELECT DISTINCT p, r, e FROM parts WHERE role = 'product'), cat AS (SELECT DISTINCT p, r, e FROM parts WHERE role = 'catalyst'),
    below AS (SELECT r.p, r, e, role, id FROM parts r JOIN clo c ON r.p = c.p AND r.e = c.seed),
    chg AS (SELECT p, r, id FROM below WHERE role = 'reactant' EXCEPT SELECT p, r, id FROM below WHERE role = 'product'),
    don AS (SELECT DISTINCT b.p, b.r, label, key FROM below b JOIN moi ON b.id = moi.id JOIN clo c ON c.p = b.p AND c.seed = m JOIN own ON own.id = c.id WHERE role = 'product' AND label = 'Gene'),
    main AS (SELECT p, r, label, key FROM chg JOIN own USING (id) EXCEPT SELECT * FROM don),
    fb AS (SELECT DISTINCT p, r, e, label, key FROM below JOIN own USING (id) WHERE role = 'reactant' AND (p, r, label, key) NOT IN (SELECT * FROM don) AND (p, r) NOT IN (SELECT p, r FROM main)),
    enz AS (SELECT DISTINCT p, r, label, key FROM (SELECT p, r, e, label, key FROM below JOIN own USING (id) WHERE role = 'catalyst' AND label = 'Gene'
        EXCEPT SELECT b.p, b.r, e, label, key FROM below b JOIN own USING (id) JOIN chg ON chg.p = b.p AND chg.r = b.r AND chg.id = b.id WHERE role = 'catalyst' AND label = 'Gene')),
    sets AS (SELECT p, seed AS e, list_sort(list(DISTINCT key)) AS genes FROM clo JOIN own USING (id) WHERE label = 'Gene' GROUP BY 1, 2),
    wide AS (SELECT DISTINCT p, r, e FROM parts WHERE role IN ('reactant', 'product') AND (p, r) IN (SELECT p, r FROM main)), narrow AS (SELECT * FROM rx WHERE (p, r) NOT IN (SELECT p, r FROM main)),
    tg AS (SELECT p, r, c, label, key FROM (SELECT p, r, cat.e AS c, label, key FROM cat JOIN main USING (p, r) UNION SELECT cat.p, cat.r, cat.e, label, key FROM cat JOIN fb ON cat.p = fb.p AND cat.r = fb.r AND cat.e <> fb.e) WHERE (p, r, label, key) NOT IN (SELECT * FROM enz)),
    whole AS (SELECT p, r, c, list_sort(list(DISTINCT key)) AS genes FROM tg GROUP BY 1, 2, 3 HAVING bool_and(label = 'Gene') AND count(DISTINCT key) >= 2),
    cands AS (SELECT wide.p, wide.r, cat.e AS c, wide.e FROM wide JOIN cat USING (p, r) UNION SELECT n.p, n.r, cat.e, n.e FROM narrow n JOIN cat ON cat.p = n.p AND cat.r = n.r AND cat.e <> n.e),
    named AS (SELECT p, r, c, min(e) AS key FROM whole JOIN cands USING (p, r, c) JOIN sets USING (p, e, genes) GROUP BY 1, 2, 3),
    tgt AS (SELECT p, r, label, key FROM tg WHERE (p, r, c) NOT IN (SELECT p, r, c FROM named) UNION SELECT p, r, 'Entity', key FROM named),
    cts AS (SELECT enz.p, enz.r, enz.key AS s, tgt.key AS t, enz.label AS sl, tgt.label AS tl, 'catalysis' AS mech, NULL AS sign, NULL AS via FROM enz JOIN tgt USING (p, r)),
    plain AS (SELECT * FROM (SELECT * FROM main UNION SELECT p, r, label, key FROM fb) WHERE (p, r) NOT IN (SELECT p, r FROM enz)),
    aims AS (SELECT *, 1 AS k FROM enz UNION ALL SELECT *, 2 FROM plain),
    awhole AS (SELECT p, r, k, list_sort(list(DISTINCT key)) AS genes FROM aims GROUP BY 1, 2, 3 HAVING bool_and(label = 'Gene') AND count(DISTINCT key) >= 2),
    acands AS (SELECT *, 1 AS k FROM cat UNION ALL SELECT *, 2 FROM wide UNION ALL SELECT *, 2 FROM narrow),
    anamed AS (SELECT p, r, k, min(e) AS key FROM awhole JOIN acands USING (p, r, k) JOIN sets USING (p, e, genes) GROUP BY 1, 2, 3),
    atgt AS (SELECT p, r, label, key FROM aims WHERE (p, r, k) NOT IN (SELECT p, r, k FROM anamed) UNION SELECT p, r, 'Entity', key FROM anamed),
    agents AS (SELECT DISTINCT p, r, label, key, CASE role WHEN 'inhibitor' THEN 'negative' ELSE 'positive' END AS sign FROM below JOIN own USING (id) WHERE role IN ('inhibitor', 'stimulator') AND (p, r, label, key) NOT IN (SELECT p, r, label, key FROM aims)),
    reg AS (SELECT a.p, a.r, a.key AS s, b.key AS t, a.label AS sl, b.label AS tl, 'regulation' AS mech, sign, NULL AS via FROM agents a JOIN atgt b USING (p, r)),
    alone AS (SELECT p, r FROM rx GROUP BY 1, 2 HAVING count(*) >= 2 AND (p, r) NOT IN (SELECT p, r FROM parts WHERE role IN ('catalyst', 'inhibitor', 'stimulator'))),
    ass AS (SELECT DISTINCT b.p, b.r, key AS s, pr.e AS t, label AS sl, 'Entity' AS tl, 'association' AS mech, NULL AS sign, b.e AS via FROM below b JOIN own USING (id) JOIN alone USING (p, r) JOIN pr USING (p, r) WHERE role = 'reactant'),
    edges AS (SELECT DISTINCT *, CASE WHEN mech = 'association' THEN 'ASSOCIATED_WITH' WHEN sl = 'Compound' OR tl = 'Compound' THEN 'ACTS_ON_CHEMICAL' ELSE 'ACTS_ON' END AS rel_type FROM (SELECT * FROM cts UNION ALL SELECT * FROM reg UNION ALL SELECT * FROM ass)
        WHERE NOT (s = t AND sl = tl) AND NOT (sl = 'Compound' AND tl = 'Compound')) """
_SET = "p AS pathway_id, r AS reaction_id"
_EDGE = f"{_SET}, s AS source_id, t AS target_id, sl AS source_label, tl AS target_label, mech AS mechanism, sign, via"


def tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(parts, members, identity, moieties)"""
    text = lambda prefix, c: F.concat(F.lit(prefix), c.cast("string"))
    x, k = t(spark, sf_dir, "lineitem"), F.col("p_partkey")
    third = F.col("l_linenumber") % 3
    modifier = F.when(third == 0, "catalyst").when(third == 1, "inhibitor").otherwise("stimulator")
    role = F.when(F.col("l_returnflag") == "R", "reactant").when(F.col("l_returnflag") == "A", "product").otherwise(modifier)
    parts = x.select(text("P", F.col("l_orderkey") % 3).alias("pathway_id"), text("R", F.col("l_orderkey")).alias("reaction_id"), text("E", F.col("l_partkey")).alias("entity_id"), role.alias("role"))
    p = t(spark, sf_dir, "part")
    div = lambda n: F.floor(k / n).cast("long")
    members = p.where(k >= 40).select(text("P", k % 3).alias("pathway_id"), text("E", div(40)).alias("parent_id"), text("E", k).alias("child_id"))
    compound = F.when(k % 28 == 3, "chebi:15377").otherwise(text("chebi:", k % 89))
    kind = F.when(k % 4 == 3, "compound").otherwise("gene")
    identity = p.where(k % 4 != 0).select(text("E", k).alias("entity_id"), F.when(k % 4 == 3, compound).otherwise(text("G", k % 97)).alias("reference_id"), kind.alias("reference_type"))
    moieties = p.where(k % 7 == 0).select(text("E", k).alias("entity_id"), text("E", div(2) + 1).alias("moiety_id"))
    return parts, members, identity, moieties


def reactions(spark: SparkSession, sf_dir: str) -> net.Reactions:
    return net.Reactions(*tables(spark, sf_dir))


@query(_BASE + "SELECT DISTINCT c.p AS pathway_id, seed, id FROM clo c JOIN parts ON c.p = parts.p AND seed = e")
def net_closures(spark, sf_dir):
    parts, members, _, _ = tables(spark, sf_dir)
    return net.closures(members, parts)


@query(_BASE + "SELECT DISTINCT c.p AS pathway_id, seed, label, key FROM clo c JOIN own USING (id) JOIN parts ON c.p = parts.p AND seed = e")
def net_carried(spark, sf_dir):
    parts, members, identity, _ = tables(spark, sf_dir)
    return net.carried(net.closures(members, parts), net.carriers(identity))


@query(_BASE + f"SELECT {_SET}, label, key FROM don")
def net_donated(spark, sf_dir):
    return reactions(spark, sf_dir).gifts


@query(_BASE + f"SELECT {_SET}, id FROM chg")
def net_changed(spark, sf_dir):
    return reactions(spark, sf_dir).changes


@query(_BASE + f"SELECT {_SET}, label, key FROM main UNION SELECT p, r, label, key FROM fb")
def net_acted_on(spark, sf_dir):
    r = reactions(spark, sf_dir)
    return r.main.unionByName(r.fallback.select(*net.REACTION, *net.NODE)).distinct()


@query(_BASE + f"SELECT {_SET}, label, key FROM enz")
def net_enzymes(spark, sf_dir):
    return reactions(spark, sf_dir).enzymes


@query(_BASE + f"SELECT {_SET}, label, key FROM enz WHERE (p, r, 1) NOT IN (SELECT p, r, k FROM anamed) UNION SELECT p, r, 'Entity', key FROM anamed WHERE k = 1")
def net_as_assembly(spark, sf_dir):
    r = reactions(spark, sf_dir)
    return net.as_assembly(r.enzymes, net.role(r.parts, "catalyst"), r.sets, net.REACTION)


@query(_BASE + f"SELECT {_EDGE} FROM cts")
def net_catalysis(spark, sf_dir):
    return net.catalysis(reactions(spark, sf_dir))


@query(_BASE + f"SELECT {_EDGE} FROM reg")
def net_regulation(spark, sf_dir):
    return net.regulation(reactions(spark, sf_dir))


@query(_BASE + f"SELECT {_EDGE} FROM ass")
def net_association(spark, sf_dir):
    return net.association(reactions(spark, sf_dir))


@query(_BASE + f"SELECT {_EDGE}, rel_type FROM edges WHERE mech <> 'catalysis'")
def net_emit(spark, sf_dir):
    r = reactions(spark, sf_dir)
    return net.emit(net.association(r).unionByName(net.regulation(r)))


_COLLAPSED = "SELECT p AS pathway_id, s AS source_id, t AS target_id, sl AS source_label, tl AS target_label, mech AS mechanism, sign, via, rel_type, min(r) AS reaction_id, count(DISTINCT r) AS weight FROM edges"


@query(_BASE + f"{_COLLAPSED} WHERE mech = 'association' GROUP BY ALL")
def net_collapse(spark, sf_dir):
    return net.collapse(net.emit(net.association(reactions(spark, sf_dir))))


@query(_BASE + f"{_COLLAPSED} GROUP BY ALL")
def net_derive_all(spark, sf_dir):
    return net.derive_all(*tables(spark, sf_dir))


@query(_BASE + """, op AS (SELECT DISTINCT coalesce(x.key, a.e) AS a, coalesce(y.key, b.e) AS b FROM rx a JOIN pr b USING (p, r)
    LEFT JOIN (SELECT DISTINCT seed, key FROM clo JOIN own USING (id) SEMI JOIN parts ON clo.p = parts.p AND clo.seed = parts.e WHERE label = 'Gene') x ON x.seed = a.e LEFT JOIN (SELECT DISTINCT seed, key FROM clo JOIN own USING (id) SEMI JOIN parts ON clo.p = parts.p AND clo.seed = parts.e WHERE label = 'Gene') y ON y.seed = b.e)
    SELECT a, b FROM op WHERE a <> b""")
def graph_gene_gene(spark, sf_dir):
    parts, members, identity, _ = tables(spark, sf_dir)
    react, made = net.role(parts, "reactant"), net.role(parts, "product")
    edges = react.select(*net.REACTION, F.col("entity_id").alias("src")).join(made.select(*net.REACTION, F.col("entity_id").alias("dst")), net.REACTION).select("src", "dst")
    genes = net.carried(net.closures(members, parts), net.carriers(identity).where("label = 'Gene'")).select(F.col("seed").alias("assembly"), F.col("key").alias("gene")).distinct()
    return graph.gene_gene(edges, genes)
