"""Faults that showed on larger tables only, made small."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import net, probe, search
from tidemark.queries import QUERIES
from tidemark.queries import onto as queries_onto
from tidemark.sources import files


@pytest.fixture
def conf(spark):
    """Sets options for one test."""
    old = {}

    def put(key, value):
        old[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)

    yield put
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_ontology_has_one_document_a_file(spark, conf, tmp_path):
    """With many partitions two documents came to lie in one file, and the second was not read."""
    conf("spark.sql.shuffle.partitions", "40")
    conf("spark.sql.adaptive.enabled", "false")
    k = F.col("id")
    part = spark.range(12_000).select(k.alias("p_partkey"), F.concat(F.lit("n"), k.cast("string")).alias("p_name"), F.lit("b").alias("p_brand"), F.lit("t").alias("p_type"), (k % 50).cast("int").alias("p_size"))
    part.write.parquet(f"{tmp_path}/part.parquet")
    assert QUERIES["sources_obo_graph"](spark, str(tmp_path)).distinct().count() == 12_000
    kept = sum(1 for i in range(3, 12_000) if i % 13 and (i // 3) % 13)
    assert QUERIES["shape_ontology_edges"](spark, str(tmp_path)).count() == kept


def ranked(df):
    return sorted(tuple(r) for r in df.select("query_id", "id", "score", "rank").collect())


def test_sparse_in_many_parts(spark):
    """Parts after the first give only what reaches the floor; the rows are those of a plain sum, with and without bounds."""
    rng = np.random.default_rng(5)
    docs = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.4, 30) if x < 500)) for i in range(1500)]
    index = search.bm25_index(spark.createDataFrame(docs, "id long, text string")).cache()
    asked = [(q, f"w{int(w)}") for q in range(12) for w in {1, 2, *rng.integers(1, 60, 4)}]
    weight = {}
    for i, term, w in index.collect():
        weight.setdefault(term, {})[i] = w
    want = []
    for q in range(12):
        total = {}
        for _, term in [a for a in asked if a[0] == q]:
            of = weight.get(term, {})
            for i, w in of.items():
                total[i] = total.get(i, 0) + w * np.log((1500 - len(of) + 0.5) / (len(of) + 0.5) + 1)
        best = sorted((-round(x, 6), i) for i, x in total.items())[:7]
        want += [(q, i, -x, n) for n, (x, i) in enumerate(best, 1)]
    terms = spark.createDataFrame(asked, "query_id int, term string")
    assert ranked(search.sparse(terms, index, 1500, 7, part_rows=1000)) == sorted(want)
    bounded = search.sparse_bounded(terms, index, search.block_index(index), 1500, 7, part_rows=1000)
    assert ranked(bounded.ranking) == sorted(want)
    assert all(r["read"] <= 2 * r["postings"] for r in bounded.read.collect())
    own = spark.createDataFrame([(q, i) for q, i, _, _ in want], "query_id int, id long")
    assert ranked(search.sparse(terms, index, 1500, 7, within=own)) == sorted(want)
    index.unpersist()


def test_vectors_without_clusters_are_not_sent_ring_by_ring(spark, monkeypatch):
    """Each query was sent, with its vector, to every ring: rows in the product of queries and rings."""
    made = {}
    plain = search.written

    def counting(df, name):
        out = plain(df, name)
        made[name] = out.count()
        return out

    monkeypatch.setattr(search, "written", counting)
    v = np.random.default_rng(2).normal(size=(4000, 24))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, dense array<double>")
    got = search.nearest(df.where("id % 40 = 0").withColumnRenamed("id", "query_id"), df, 5, vector_rows=500)
    assert made["then"] < 100
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    want = []
    for q in range(0, 4000, 40):
        s = np.round(u @ u[q], 6) + 0.0
        want += [(q, int(i), float(s[i]), n) for n, i in enumerate(np.lexsort((np.arange(4000), -s))[:5], 1)]
    assert ranked(got.ranking) == sorted(want)


def test_multiplicities_are_those_of_md5_one_by_one():
    from hashlib import md5

    from tidemark.operators.ir import multiplicities

    n = 40_013  # numbers of one to five digits
    draws = [int.from_bytes(md5(b"7:123:%d" % (j // 4)).digest()[j % 4 * 4 : j % 4 * 4 + 4], "big") % n for j in range(n)]
    want = np.bincount(draws, minlength=n)
    assert (multiplicities(7, 123, n) == want).all()
    assert (multiplicities(7, 123, n, 30_000, 5000) == want[30_000:35_000]).all()


def test_graphic_pathways_are_parsed_once(spark):
    """Each part of the result that read the files parsed them again."""
    from tidemark.sources import files as sources

    text = '<pathway name="path:hsa1" title="t"><entry id="1" name="hsa:5" type="gene"/><reaction id="1" name="rn:R7"><substrate name="cpd:C1"/></reaction></pathway>'
    found = sources.kgml(spark.createDataFrame([(text,)], "text string"))[4]
    assert "from_xml" not in found._jdf.queryExecution().toString().lower()
    assert sorted(map(tuple, found.collect())) == [("R7", "5", "catalyst", "hsa1"), ("R7", "C1", "substrate", "hsa1")]


DATA = "/root/testdata/sf0.001"


def recorded(monkeypatch, *modules):
    """Names of the tables that the modules write from now on, and the tables."""
    made = []
    for m in modules:
        plain = m.written
        monkeypatch.setattr(m, "written", lambda df, name, plain=plain: made.append((name, out := plain(df, name))) or out)
    return made


def test_rules_make_only_what_they_read(spark, monkeypatch):
    """Every rule made donations, targets and gene sets of all reactions, whatever it read."""
    made = recorded(monkeypatch, net)
    QUERIES["net_changed"](spark, DATA)
    QUERIES["net_carried"](spark, DATA)
    assert [name for name, _ in made] == ["parts", "changes"]


def test_only_large_reactions_are_copied(spark, monkeypatch):
    """Each reaction's targets were copied 16 times."""
    made = recorded(monkeypatch, net)
    node = lambda n, r: [("P", r, "Gene", f"{r}{i}") for i in range(n)]
    of = "pathway_id string, reaction_id string, label string, key string"
    a, b = spark.createDataFrame(node(50, "x") + node(3, "y"), of), spark.createDataFrame(node(4, "x") + node(2, "y"), of)
    got = net.crossed(a, b, "m", rows_per_task=20).select("reaction_id", "source_id", "target_id").collect()
    assert len(got) == 50 * 4 + 3 * 2 == len(set(got))
    assert [tuple(r) for r in dict(made)["large"].collect()] == [("P", "x", 3)]


def test_sbml_is_parsed_once(spark):
    """Both sides of a join parsed the files, by the slow from_xml."""
    text = '<sbml xmlns="u"><model id="pathway_1"><listOfSpecies><species id="s" compartment="c"><annotation><r:RDF xmlns:r="q"><r:Description><is><r:Bag><r:li r:resource="http://identifiers.org/chebi:7"/></r:Bag></is><hasPart><r:Bag><r:li r:resource="http://identifiers.org/chebi:8"/></r:Bag></hasPart></r:Description></r:RDF></annotation></species></listOfSpecies><listOfReactions><reaction id="reaction_2"><listOfReactants><speciesReference species="s" stoichiometry="2.0"/></listOfReactants></reaction></listOfReactions></model></sbml>'
    pathways, species, _, parts = files.sbml(spark.createDataFrame([(text,), ("<no",), (None,)], "text string"))
    plan = parts._jdf.queryExecution().toString().lower()
    assert "from_xml" not in plan and "mapinarrow" not in plan
    assert [tuple(r) for r in parts.collect()] == [("1", "2", "s", "reactant", 2)]
    assert [tuple(r) for r in species.collect()] == [("1", "s", "s", None, None, "7")]
    assert pathways.count() == 3


def test_only_the_anchors_pairs_are_listed(spark, monkeypatch):
    """All pairs of all terms with all their ancestors were written and compared, for anchors that have few."""
    made = recorded(monkeypatch, queries_onto)
    tri, parts, _ = queries_onto.triplets(spark, DATA)
    train = parts.where("part = 'train'").select("term")
    made = dict(made)
    assert made["any"].join(train, "term", "left_anti").isEmpty()
    d = queries_onto.Data(spark, DATA)
    everything = d.positives()
    assert made["positives"].count() < everything.count()
    plain = queries_onto.onto.anchors(everything, d.terms, queries_onto.CFG)
    assert sorted(plain.collect()) == sorted(parts.select("term", "name", "n_pos").collect())


def test_weights_before_ancestors(spark):
    """Pairs with ancestors were exchanged again to be weighed."""
    d = queries_onto.Data(spark, DATA)
    closure, (pos, *_) = d.closure(), d.cleaned()
    genes = spark.read.parquet(f"{DATA}/orders.parquet").selectExpr("o_custkey AS gene", "o_orderkey AS accession")
    want = probe.weights(genes, queries_onto.onto.propagate_up(pos, closure))
    assert sorted(probe.weights(genes, pos, closure).collect()) == sorted(want.collect())


def test_conflicts_in_one_pass(spark, monkeypatch):
    """Refuted and trusted pairs were worked out twice, for what is left and for the number of conflicts."""
    made = recorded(monkeypatch, queries_onto.onto)
    of = "gene long, term string"
    left, n = queries_onto.onto.resolve_conflicts(spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], of), spark.createDataFrame([(1, "b"), (3, "a")], of))
    assert [name for name, _ in made] == ["refuted"]
    assert sorted(map(tuple, left.collect())) == [(1, "a"), (2, "a")] and n.first()[0] == 1


def test_nothing_is_counted_before_the_exchange(spark):
    """A map-side count held nearly every pair that a task met."""
    plan = QUERIES["onto_expand_annotations"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" not in plan[plan.index("REPARTITION_BY_COL") :].split("SortMergeJoin")[-1] and "REPARTITION_BY_COL" in plan
