"""Queries of the ontology data set and its probes. Customers in credit are genes with text, parts are terms in a DAG (of
halves of a third of their number), an order's lines annotate its customer; the order's priority is the evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import onto, probe
from ..operators.store import written
from .base import query, t

CFG = onto.Config(keep_evidence=("1-URGENT", "2-HIGH", "9-NONE"), keep_namespaces=("F", "P"), blocklist=("17",), min_pos=3, max_pos=12, pos_per_anchor=5, test_frac=0.1, seed=13)
_GENES = "g AS (SELECT c_custkey AS gene, c_name AS text FROM customer WHERE c_acctbal > 0)"
_TERMS = "tm AS (SELECT CAST(p_partkey AS VARCHAR) AS term, CASE WHEN p_size <= 45 THEN p_name END AS name, CASE p_partkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'P' ELSE 'C' END AS namespace FROM part WHERE p_size <> 7)"
_HIER = """hi AS (SELECT CAST(p_partkey AS VARCHAR) AS child, CAST(p_partkey // 6 AS VARCHAR) AS parent, 'is_a' AS rel FROM part WHERE p_partkey >= 6 UNION ALL SELECT CAST(p_partkey AS VARCHAR), CAST(p_partkey // 10 AS VARCHAR), 'part_of' FROM part WHERE p_partkey >= 10
    UNION ALL SELECT CAST(p_partkey AS VARCHAR), CAST(p_partkey // 2 AS VARCHAR), 'regulates' FROM part WHERE p_partkey >= 2)"""
_ANN = """an AS (SELECT o_custkey AS gene, CAST(l_partkey AS VARCHAR) AS term, CASE WHEN l_returnflag = 'R' THEN ' NOT|involved_in' WHEN l_returnflag = 'A' THEN 'Involved_in' WHEN l_linenumber = 1 THEN 'acts_upstream_of_positive' WHEN l_linenumber = 2 THEN NULL ELSE 'enables' END AS q, o_orderpriority AS ev FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"""
_CLEAN = f"""WITH RECURSIVE {_GENES}, {_TERMS}, {_HIER}, {_ANN}, f AS (SELECT a.gene, a.term, coalesce(upper(trim(q)) LIKE 'NOT%', false) AS negated, CASE WHEN g.gene IS NULL OR tm.term IS NULL THEN 'missing' WHEN ev NOT IN ('1-URGENT', '2-HIGH') THEN 'weak' WHEN q LIKE 'acts_upstream_of%' THEN 'indirect' ELSE 'kept' END AS fate
        FROM an a LEFT JOIN g USING (gene) LEFT JOIN tm USING (term)),
    dp AS (SELECT DISTINCT gene, term FROM f WHERE fate = 'kept' AND NOT negated), dn AS (SELECT DISTINCT gene, term FROM f WHERE fate = 'kept' AND negated), da AS (SELECT DISTINCT gene, term FROM f WHERE fate <> 'missing' AND NOT negated),
    an_ AS (SELECT CAST(p_partkey AS VARCHAR) AS term, CAST(p_partkey AS VARCHAR) AS ancestor FROM part UNION SELECT term, parent FROM an_ JOIN hi ON child = ancestor WHERE rel IN ('is_a', 'part_of')),
    pos AS (SELECT DISTINCT gene, ancestor AS term FROM dp JOIN an_ USING (term)), anypos AS (SELECT DISTINCT gene, ancestor AS term FROM da JOIN an_ USING (term)),
    neg0 AS (SELECT DISTINCT gene, a.term FROM dn JOIN an_ a ON a.ancestor = dn.term), neg AS (SELECT * FROM neg0 EXCEPT SELECT * FROM pos),
    el AS (SELECT term, name, count(*) AS n_pos FROM pos JOIN tm USING (term) WHERE coalesce(name, '') <> '' AND namespace IN ('F', 'P') AND term <> '17' GROUP BY 1, 2), anch AS (SELECT * FROM el WHERE n_pos BETWEEN 3 AND 12),
    sib AS (SELECT DISTINCT a.child AS term, b.child AS sibling FROM hi a JOIN hi b ON a.parent = b.parent AND a.rel = 'is_a' AND b.rel = 'is_a' WHERE a.child <> b.child)"""
_SPLIT = f"""{_CLEAN}, test AS (SELECT term FROM anch ORDER BY md5('13:' || term), term LIMIT (SELECT CASE WHEN count(*) = 0 THEN 0 ELSE greatest(1, CAST(floor(count(*) * 0.1) AS BIGINT)) END FROM anch)),
    lin AS (SELECT ancestor AS term FROM an_ WHERE term IN (SELECT term FROM test) UNION SELECT term FROM an_ WHERE ancestor IN (SELECT term FROM test)),
    sp AS (SELECT *, CASE WHEN term IN (SELECT term FROM test) THEN 'test' WHEN term IN (SELECT term FROM lin) THEN 'buffer' ELSE 'train' END AS part FROM anch)"""


class Data:
    """The tables of the module's text, and what is derived from them, each written once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        c, p = t(spark, sf_dir, "customer"), t(spark, sf_dir, "part")
        k, name = F.col("p_partkey"), F.col("p_partkey").cast("string")
        self.genes = c.where("c_acctbal > 0").select(F.col("c_custkey").alias("gene"), F.col("c_name").alias("text"))
        space = F.when(k % 3 == 0, "F").when(k % 3 == 1, "P").otherwise("C")
        self.terms = p.where("p_size <> 7").select(name.alias("term"), F.when(F.col("p_size") <= 45, F.col("p_name")).alias("name"), space.alias("namespace"))
        edge = lambda n, rel: p.where(k >= n).select(name.alias("child"), F.floor(k / n).cast("long").cast("string").alias("parent"), F.lit(rel).alias("rel"))
        self.hierarchy = edge(6, "is_a").unionByName(edge(10, "part_of")).unionByName(edge(2, "regulates"))
        rows = t(spark, sf_dir, "orders").join(t(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
        flag, line = F.col("l_returnflag"), F.col("l_linenumber")
        q = F.when(flag == "R", " NOT|involved_in").when(flag == "A", "Involved_in").when(line == 1, "acts_upstream_of_positive").when(line != 2, "enables")
        self.annotations = rows.select(F.col("o_custkey").alias("gene"), F.col("l_partkey").cast("string").alias("term"), q.alias("qualifier"), F.array("o_orderpriority").alias("evidence"))
        self.all_terms = p.select(name.alias("term"))

    def cleaned(self, once: bool = False):
        return onto.clean(self.annotations, self.genes, self.terms, CFG, once)

    def closure(self) -> DataFrame:
        return onto.ancestors(self.hierarchy, self.all_terms)

    def positives(self, closure: DataFrame | None = None) -> DataFrame:
        return onto.propagate_up(self.cleaned()[0], closure or self.closure())


@query(f"WITH {_GENES}, x AS (SELECT DISTINCT l_orderkey % 50 AS gene, l_suppkey AS accession FROM lineitem) SELECT x.gene, accession, text FROM x JOIN g ON g.gene = accession")
def onto_corpus_map(spark, sf_dir):
    walk = t(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % 50).alias("gene"), F.col("l_suppkey").alias("accession"))
    pairs, corpus = onto.corpus_map(Data(spark, sf_dir).genes.withColumnRenamed("gene", "accession"), walk)
    return pairs.join(corpus, "accession").select("gene", "accession", "text")


@query(f"WITH {_GENES} SELECT l_orderkey AS gene, array_to_string(list_sort(list(DISTINCT l_suppkey)), ',') AS accessions FROM lineitem WHERE l_suppkey IN (SELECT gene FROM g) GROUP BY 1")
def onto_crosswalk(spark, sf_dir):
    pairs = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("gene"), F.col("l_suppkey").alias("accession"))
    out = onto.crosswalk(pairs, Data(spark, sf_dir).genes.select(F.col("gene").alias("accession")))
    return out.select("gene", F.array_join(F.transform("accessions", lambda x: x.cast("string")), ",").alias("accessions"))


@query(f"WITH {_ANN} SELECT l_suppkey AS gene, term, count(*) AS n FROM an JOIN (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) ON l_orderkey = gene GROUP BY 1, 2")
def onto_expand_annotations(spark, sf_dir):
    pairs = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("gene"), F.col("l_suppkey").alias("accession")).distinct()
    rows = onto.expand_annotations(Data(spark, sf_dir).annotations, pairs).select("gene", "term")
    # Exchanged first: nearly every pair is another one, and counts before the exchange would hold all that a task meets.
    return rows.repartition("gene", "term").groupBy("gene", "term").agg(F.count("*").alias("n"))


@query(f"WITH {_ANN} SELECT q AS raw, coalesce(upper(trim(q)) LIKE 'NOT%', false) AS negated, CASE WHEN q IS NULL THEN '' WHEN upper(trim(q)) LIKE 'NOT%' THEN lower(substr(trim(q), strpos(trim(q), '|') + 1)) ELSE lower(trim(q)) END AS qualifier, count(*) AS n FROM an GROUP BY 1, 2, 3")
def onto_parse_qualifier(spark, sf_dir):
    rows = Data(spark, sf_dir).annotations.select(F.col("qualifier").alias("raw"), onto.parse_qualifier(F.col("qualifier")).alias("q"))
    return rows.groupBy("raw", "q.negated", "q.qualifier").agg(F.count("*").alias("n"))


@query(f"{_CLEAN} SELECT 'positive' AS kind, * FROM dp UNION ALL SELECT 'negative', * FROM dn UNION ALL SELECT 'any', * FROM da")
def onto_clean(spark, sf_dir):
    pos, neg, any_, _ = Data(spark, sf_dir).cleaned()
    tag = lambda df, k: df.select(F.lit(k).alias("kind"), "gene", "term")
    return tag(pos, "positive").union(tag(neg, "negative")).union(tag(any_, "any"))


@query(f"{_CLEAN} SELECT count(*) FILTER (fate = 'missing') AS drop_missing_text_or_term, count(*) FILTER (fate = 'weak') AS drop_weak_evidence, count(*) FILTER (fate = 'indirect') AS drop_indirect_qualifier, count(*) FILTER (fate = 'kept') AS kept FROM f")
def onto_clean_counts(spark, sf_dir):
    return Data(spark, sf_dir).cleaned()[3]


@query(f"{_CLEAN} SELECT * FROM an_")
def onto_ancestors(spark, sf_dir):
    return Data(spark, sf_dir).closure()


@query(f"{_CLEAN} SELECT ancestor AS term, term AS descendant FROM an_ WHERE ancestor IN (SELECT CAST(p_partkey AS VARCHAR) FROM part)")
def onto_descendants(spark, sf_dir):
    d = Data(spark, sf_dir)
    return onto.descendants(d.hierarchy, d.all_terms)


@query(f"{_CLEAN} SELECT * FROM pos")
def onto_propagate_up(spark, sf_dir):
    return Data(spark, sf_dir).positives()


@query(f"{_CLEAN} SELECT * FROM neg0")
def onto_propagate_down(spark, sf_dir):
    d = Data(spark, sf_dir)
    return onto.propagate_down(d.cleaned()[1], d.closure())


@query(f"{_CLEAN} SELECT *, (SELECT count(*) FROM neg0 SEMI JOIN pos USING (gene, term)) AS conflicts FROM neg")
def onto_resolve_conflicts(spark, sf_dir):
    d = Data(spark, sf_dir)
    closure, (pos, neg, _, _) = d.closure(), d.cleaned(once=True)
    left, n = onto.resolve_conflicts(onto.propagate_down(neg, closure), onto.propagate_up(pos, closure))
    return left.join(F.broadcast(n))


@query(f"{_CLEAN} SELECT * FROM sib")
def onto_siblings(spark, sf_dir):
    return onto.siblings(Data(spark, sf_dir).hierarchy)


@query(f"{_CLEAN} SELECT * FROM anch")
def onto_anchors(spark, sf_dir):
    d = Data(spark, sf_dir)
    return onto.anchors(d.positives(), d.terms, CFG)


@query(f"{_CLEAN} SELECT 'eligible_terms' AS stat, count(*) AS n FROM el UNION ALL SELECT 'rejected_below_min_pos', count(*) FROM el WHERE n_pos < 3 UNION ALL SELECT 'rejected_above_max_pos', count(*) FROM el WHERE n_pos > 12 UNION ALL SELECT 'pos_size_' || k, (SELECT count(*) FROM el WHERE n_pos = k) FROM range(1, 7) AS r(k)")
def onto_anchor_stats(spark, sf_dir):
    d = Data(spark, sf_dir)
    return onto.anchor_stats(d.positives(), d.terms, CFG)


def parted(d: Data, pairs: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(parts, positives of the anchors); pairs: the direct positives. Terms that are certain to have more than max_pos are no anchors, and their positives are not listed."""
    pairs = written(d.cleaned()[0], "direct") if pairs is None else pairs
    few = onto.uncrowded(pairs, d.hierarchy, d.all_terms, CFG.max_pos)
    pos = written(onto.propagate_up(pairs, onto.closure_to(d.hierarchy, few)), "positives")
    return written(onto.split(written(onto.anchors(pos, d.terms, CFG), "anchors"), None, CFG, d.hierarchy), "parts"), pos


@query(f"{_SPLIT} SELECT * FROM sp")
def onto_split(spark, sf_dir):
    return parted(Data(spark, sf_dir))[0]


@query(f"{_SPLIT} SELECT count(*) AS anchors_total, count(*) FILTER (part = 'test') AS anchors_test, count(*) FILTER (part = 'train') AS anchors_train, count(*) FILTER (part = 'buffer') AS anchors_lost_to_buffer FROM sp")
def onto_split_counts(spark, sf_dir):
    return onto.split_counts(parted(Data(spark, sf_dir))[0])


_HEX = lambda x: f"CAST('0x' || substr(md5({x}), 1, 8) AS BIGINT)"
_MINE = f"""{_SPLIT}, ch AS (SELECT term, gene AS positive FROM (SELECT *, row_number() OVER (PARTITION BY term ORDER BY md5('13:pos:' || term || ':' || gene), gene) AS r FROM pos WHERE term IN (SELECT term FROM sp WHERE part = 'train')) WHERE r <= 5),
    dr AS (SELECT *, {_HEX("'13:u:' || term || ':' || positive")} / 4294967296.0 AS u, {_HEX("'13:neg:' || term || ':' || positive")} AS d FROM ch),
    cu AS (SELECT term, gene, row_number() OVER (PARTITION BY term ORDER BY md5('13:' || term || ':' || gene), gene) - 1 AS i, count(*) OVER (PARTITION BY term) AS n FROM neg WHERE term IN (SELECT term FROM ch)),
    pg AS (SELECT parent, gene, row_number() OVER (PARTITION BY parent ORDER BY md5(CAST(gene AS VARCHAR)), gene) - 1 AS pl, count(*) OVER (PARTITION BY parent) AS n FROM (SELECT DISTINCT parent, gene FROM hi JOIN pos ON term = child WHERE rel = 'is_a')),
    pn AS (SELECT ch.term, parent, n, sum(n) OVER (PARTITION BY ch.term ORDER BY parent) - n AS st, sum(n) OVER (PARTITION BY ch.term) AS total FROM (SELECT DISTINCT term FROM ch) ch JOIN (SELECT DISTINCT child, parent FROM hi WHERE rel = 'is_a') ON child = ch.term JOIN (SELECT DISTINCT parent, n FROM pg) USING (parent)),
    po AS (SELECT term, gene, st + pl AS place, total AS n FROM pn JOIN pg USING (parent) ANTI JOIN anypos USING (term, gene)),
    src AS (SELECT dr.*, c.n AS cn, s.n AS sn, CASE WHEN c.n IS NOT NULL AND (u < 0.5 OR s.n IS NULL) THEN 'curated_NOT' WHEN s.n IS NOT NULL THEN 'sibling' ELSE 'random' END AS source FROM dr LEFT JOIN (SELECT * FROM cu WHERE i = 0) c USING (term) LEFT JOIN (SELECT DISTINCT term, n FROM po) s USING (term)),
    al AS (SELECT gene, row_number() OVER (ORDER BY md5(CAST(gene AS VARCHAR)), gene) - 1 AS at, count(*) OVER () AS n FROM g),
    ra AS (SELECT src.term, positive, arg_min(al.gene, (al.at - src.d % al.n + al.n) % al.n) AS negative FROM src JOIN al ON true ANTI JOIN anypos x ON x.term = src.term AND x.gene = al.gene WHERE source = 'random' GROUP BY 1, 2),
    tri AS (SELECT src.term, positive, gene AS negative, source FROM src JOIN cu ON cu.term = src.term AND cu.i = d % cn WHERE source = 'curated_NOT' UNION ALL SELECT src.term, positive, arg_min(gene, (place - d % sn + sn) % sn), source FROM src JOIN po USING (term) WHERE source = 'sibling' GROUP BY src.term, positive, source UNION ALL SELECT term, positive, negative, 'random' FROM ra)"""


def triplets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(triplets, parts, positives)"""
    d = Data(spark, sf_dir)
    direct, refuted, any_, _ = d.cleaned(once=True)
    parts, pos = parted(d, direct)
    train = parts.where("part = 'train'").select("term")
    # Only what the train anchors need: the pools' positives, and what links or refutes a gene for an anchor itself.
    near = onto.closure_to(d.hierarchy, train)
    pools = written(onto.propagate_up(direct, onto.closure_to(d.hierarchy, onto.pool_terms(train, d.hierarchy))), "pools")
    any_pos = written(onto.propagate_up(any_, near), "any")
    left = onto.resolve_conflicts(onto.propagate_down(refuted, onto.ancestors(d.hierarchy, train)), pools)[0]
    return onto.mine_triplets(train, pools, left, any_pos, d.hierarchy, d.genes, CFG), parts, pos


@query(f"{_MINE} SELECT * FROM tri")
def onto_mine_triplets(spark, sf_dir):
    return triplets(spark, sf_dir)[0]


@query(f"{_SPLIT} SELECT term, name, gene FROM sp JOIN pos USING (term) WHERE part = 'test'")
def onto_eval_set(spark, sf_dir):
    d = Data(spark, sf_dir)
    parts, pos = parted(d)
    queries, _, relevant = onto.eval_set(parts, pos, d.genes)
    return relevant.join(queries, "term").select("term", "name", "gene")


@query("""WITH h AS (SELECT sha256('{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}') AS r FROM customer),
    s AS (SELECT count(*) AS n, sum(CAST('0x' || substr(r, 1, 8) AS BIGINT)) AS a, sum(CAST('0x' || substr(r, 9, 8) AS BIGINT)) AS b, sum(CAST('0x' || substr(r, 17, 8) AS BIGINT)) AS c, sum(CAST('0x' || substr(r, 25, 8) AS BIGINT)) AS d FROM h) SELECT n, sha256(concat_ws(':', n, a, b, c, d)) AS fingerprint FROM s""")
def onto_fingerprint(spark, sf_dir):
    return onto.fingerprint(t(spark, sf_dir, "customer").select("c_name", "c_custkey"))


@query("SELECT 'orders' AS name FROM (SELECT count(*) FROM orders)")
def onto_publish_if_changed(spark, sf_dir):
    named = lambda n: onto.fingerprint(t(spark, sf_dir, n)).withColumn("name", F.lit(n))
    both = named("orders").unionByName(named("customer").unionByName(named("nation")))
    log = named("customer").unionByName(named("nation"))
    return onto.publish_if_changed(both, log).select("name")


_COUNTED = f"{_CLEAN}, cn AS (SELECT tm.term, name, namespace, count(gene) AS n_pos FROM tm LEFT JOIN pos USING (term) GROUP BY 1, 2, 3)"


def counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Data(spark, sf_dir)
    n = d.positives().groupBy("term").agg(F.count("*").alias("n_pos"))
    return d.terms.join(n, "term", "left").withColumn("n_pos", F.coalesce("n_pos", F.lit(0)))


@query(f"WITH {_ANN} SELECT q AS qualifier, ev AS evidence, count(*) AS n FROM an GROUP BY 1, 2")
def probe_inventory(spark, sf_dir):
    return probe.inventory(Data(spark, sf_dir).annotations)


@query(f"WITH {_ANN}, w AS (SELECT unnest(['1-URGENT', '2-HIGH', '9-NONE']) AS evidence) SELECT evidence, 'configured, absent' AS problem FROM w WHERE evidence NOT IN (SELECT ev FROM an) UNION ALL SELECT DISTINCT ev, 'present, excluded' FROM an WHERE ev NOT IN (SELECT evidence FROM w)")
def probe_code_gaps(spark, sf_dir):
    return probe.code_gaps(Data(spark, sf_dir).annotations, CFG)


@query(f"""{_COUNTED}, k AS (SELECT *, coalesce(name, '') <> '' AND namespace IN ('F', 'P') AND term <> '17' AND n_pos > 0 AS ok FROM cn)
    SELECT namespace, count(*) AS terms, count(*) FILTER (ok) AS eligible, count(*) FILTER (ok AND n_pos < 3) AS below, count(*) FILTER (ok AND n_pos > 12) AS above, count(*) FILTER (ok AND n_pos BETWEEN 3 AND 12) AS anchors, max(n_pos) AS max_n FROM k GROUP BY 1""")
def probe_funnel(spark, sf_dir):
    return probe.funnel(counted(spark, sf_dir), CFG)


@query(f"{_COUNTED} SELECT term, n_pos, 'above' AS verdict FROM cn WHERE n_pos > 12 ORDER BY n_pos DESC, term LIMIT 25")
def probe_terms(spark, sf_dir):
    return probe.terms(counted(spark, sf_dir), 25, "above", CFG)


@query(f"{_CLEAN} SELECT term, count(*) AS n_genes, CAST(sum(w) AS BIGINT) AS n_pos FROM pos JOIN (SELECT o_custkey AS gene, count(DISTINCT o_orderkey) AS w FROM orders GROUP BY 1) USING (gene) GROUP BY 1")
def probe_weights(spark, sf_dir):
    gene_map = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("gene"), F.col("o_orderkey").alias("accession"))
    d = Data(spark, sf_dir)
    return probe.weights(gene_map, d.cleaned()[0], d.closure())


@query("SELECT count(*) AS terms_at_depth FROM part WHERE p_partkey // 6 // 6 >= 1")
def probe_depth_check(spark, sf_dir):
    d = Data(spark, sf_dir)
    return probe.depth_check(d.hierarchy.where("rel = 'is_a'"), d.all_terms, 2)


@query(f"{_COUNTED} SELECT lo AS min_pos, count(*) FILTER (n_pos BETWEEN lo AND 5) AS max_5, count(*) FILTER (n_pos BETWEEN lo AND 12) AS max_12, count(*) FILTER (n_pos BETWEEN lo AND 50) AS max_50 FROM cn, (VALUES (1), (2), (3), (5)) AS l(lo) GROUP BY 1")
def probe_sweep(spark, sf_dir):
    return probe.sweep(counted(spark, sf_dir), [1, 2, 3, 5], [5, 12, 50])


@query(f"""{_COUNTED}, b AS (SELECT *, CASE WHEN n_pos < 26 THEN '3-25' WHEN n_pos < 51 THEN '26-50' WHEN n_pos < 101 THEN '51-100' WHEN n_pos < 201 THEN '101-200' WHEN n_pos < 301 THEN '201-300' WHEN n_pos < 1001 THEN '301-1000' ELSE '1001+' END AS band FROM cn WHERE n_pos >= 3)
    SELECT band, count(*) AS terms, CAST(sum(least(n_pos, 5)) AS BIGINT) AS triplet_rows, CAST(floor(quantile_cont(n_pos, 0.5)) AS BIGINT) AS median_n_pos, round(100 * quantile_cont(n_pos, 0.5) / (SELECT count(*) FROM g), 1) AS pct_corpus, count(*) FILTER (n_pos > 12) AS above_ceiling FROM b GROUP BY 1""")
def probe_bands(spark, sf_dir):
    return probe.bands(counted(spark, sf_dir), Data(spark, sf_dir).genes.count(), CFG)


@query(f"""WITH {_GENES}, {_ANN}, a AS (SELECT gene, bool_or(ev IN ('1-URGENT', '2-HIGH')) AS s, gene IN (SELECT gene FROM g) AS t FROM an GROUP BY 1)
    SELECT count(*) AS annotated, count(*) FILTER (NOT t) AS without_text, count(*) FILTER (s) AS strong, count(*) FILTER (s AND NOT t) AS strong_lost, round(100 * count(*) FILTER (s AND NOT t) / count(*) FILTER (s), 2) AS strong_lost_pct FROM a""")
def probe_text_coverage(spark, sf_dir):
    d = Data(spark, sf_dir)
    strong = d.annotations.where(F.arrays_overlap("evidence", F.array(F.lit("1-URGENT"), F.lit("2-HIGH")))).select("gene")
    return probe.text_coverage(d.annotations.select("gene"), strong, d.genes)


@query(f"{_COUNTED} SELECT CAST(k AS INTEGER) AS min_pos, (SELECT count(*) FROM cn WHERE n_pos >= k AND n_pos < 3) AS gained FROM range(1, 3) AS r(k) WHERE gained > 0")
def probe_gained_below(spark, sf_dir):
    return probe.gained_below(counted(spark, sf_dir), CFG)


@query(f"""{_MINE}, rs AS (SELECT min(n) AS lo, max(n) AS hi FROM (SELECT count(*) AS n FROM pos WHERE term IN (SELECT term FROM sp WHERE part = 'test') GROUP BY term)), ts AS (SELECT min(n) AS lo, max(n) AS hi FROM (SELECT count(*) AS n FROM tri GROUP BY term))
    SELECT 'min_pos' AS parameter, 3 AS configured, least(rs.lo, ts.lo) AS observed, 3 <= least(rs.lo, ts.lo) AS consistent FROM rs, ts UNION ALL SELECT 'max_pos', 12, rs.hi, 12 >= rs.hi FROM rs UNION ALL SELECT 'pos_per_anchor', 5, ts.hi, 5 = ts.hi FROM ts""")
def probe_verify_export(spark, sf_dir):
    tri, parts, pos = triplets(spark, sf_dir)
    relevant = pos.join(parts.where("part = 'test'").select("term"), "term", "left_semi")
    return probe.verify_export(relevant, tri, CFG)
