"""Operators on small cases by hand: what the queries over the given tables cannot show."""

import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cdc, dq, graph, ir, net, onto, search, shape, text
from tidemark.sources import files as sources
from tidemark.streaming import cdc as streaming


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


CUR = [("p1", "a", None, 1), ("p1", "b", "x", 2), ("p2", "c", None, 3), (None, "d", None, 4)]
STG = [("p1", "a", None, 9), ("p1", "e", None, 5), ("p3", None, None, 6)]
EDGE = "scope string, child string, sign string, payload int"


def test_merge_identity_with_nulls_is_replayed(spark):
    cur, stg = spark.createDataFrame(CUR, EDGE), spark.createDataFrame(STG, EDGE)
    key = ["scope", "child", "sign"]
    new, diff = cdc.merge_identity(cur, stg, key, ["scope"])
    # b goes, for p1 is staged; p2 and the null scope are not; a keeps its payload.
    assert rows(new) == rows(spark.createDataFrame([("p1", "a", None, 1), ("p1", "e", None, 5), ("p2", "c", None, 3), ("p3", None, None, 6), (None, "d", None, 4)], EDGE))
    assert rows(diff, "child", "action") == [("b", "DELETE"), ("e", "INSERT"), (None, "INSERT")]
    assert rows(cdc.apply_diff(cur, diff, key, F.lit(1))) == rows(new)
    assert cdc.merge_identity(new, stg, key, ["scope"])[1].isEmpty()
    new, diff = cdc.merge_identity(cur, stg, key, ["scope"], update_payload=True)
    assert ("a", "UPDATE") in rows(diff, "child", "action") and rows(cdc.apply_diff(cur, diff, key, F.lit(1))) == rows(new)


def test_merges_in_batches_of_whole_scopes_equal_one(spark):
    cur, stg = spark.createDataFrame(CUR, EDGE), spark.createDataFrame(STG, EDGE)
    key = ["scope", "child", "sign"]
    both = cur
    for p in ("p1", "p3"):
        both = cdc.merge_identity(both, stg.where(F.col("scope") == p), key, ["scope"])[0]
    assert rows(both) == rows(cdc.merge_identity(cur, stg, key, ["scope"])[0])


def test_merge_keyed_and_composite_are_replayed(spark):
    cur = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, "c", "y")], "k int, v string, w string")
    stg = spark.createDataFrame([(1, "a", "new"), (2, "B", "x"), (4, None, None)], "k int, v string, w string")
    new, diff = cdc.merge_keyed(cur, stg, "k", ["v", "w"], null_safe=False)
    assert rows(diff) == [(2, "UPDATE"), (4, "INSERT")]  # null against a value is no change
    new, diff = cdc.merge_keyed(cur, stg, "k", ["v", "w"])
    assert rows(diff) == [(1, "UPDATE"), (2, "UPDATE"), (4, "INSERT")]
    assert rows(cdc.apply_diff(cur, cdc.diff_current(diff, new, ["k"]).select("k", "v", "w", "action"), ["k"], F.lit(1))) == rows(new)
    new, diff = cdc.merge_composite(cur, stg, ["k"], ["w"])
    assert rows(diff, "k", "action") == [(1, "INSERT"), (4, "INSERT")] or rows(diff, "k", "action") == [(4, "INSERT")]
    assert rows(cdc.apply_diff(cur, diff, ["k"], F.lit(1))) == rows(new)


def test_log_with_several_actions_takes_the_last(spark):
    base = spark.createDataFrame([("a", 1)], "k string, v int")
    log = spark.createDataFrame([("b", 2, "INSERT", 1), ("b", 2, "DELETE", 2), ("a", 1, "DELETE", 1), ("a", 7, "INSERT", 3)], "k string, v int, action string, run int")
    assert rows(cdc.apply_diff(base, log, ["k"], "run")) == [("a", 7)]


def test_stage_takes_null_for_empty_with_several_keys(spark):
    df = spark.createDataFrame([("a", None, 2), ("a", "", 1), (None, "b", 3)], "k string, l string, n int")
    assert rows(cdc.stage(df, ["k", "l"], ["n"])) == [("a", "", 1), (None, "b", 3)]


def test_gates(spark):
    a, none = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([], "x int")
    n = {"n": F.count("*"), "s": F.sum("x")}
    assert rows(dq.reconcile(none, a, n), "metric", "failed") == [("n", True), ("s", True)]
    assert rows(dq.reconcile(none, none, n), "metric", "failed") == [("n", False), ("s", False)]
    assert rows(dq.failure_gate(spark.range(20), F.col("id") < 5)) == [(5, 20)]
    with pytest.raises(Exception, match="6 of 20 failed"):
        dq.failure_gate(spark.range(20), F.col("id") < 6).collect()
    for refuse in (dq.refuse_empty, cdc.replace_snapshot):
        with pytest.raises(ValueError):
            refuse(none)
    with pytest.raises(ValueError, match="missing"):
        dq.check_columns(a, "x", ["y"], {})
    with pytest.raises(Exception, match="without a gene"):
        graph.store_overlap(a.withColumnRenamed("x", "id"), spark.range(3), every_right=True).collect()


def test_edges_keep_and_overwrite_properties(spark):
    kind = "src string, dst string, label string, props map<string,string>, pathway_ids array<string>"
    edges = spark.createDataFrame([("a", "b", "L", {"x": "1", "y": "1"}, ["p"])], kind)
    new = spark.createDataFrame([("a", "b", "L", {"x": "2", "y": None}, "q", 1), ("a", "b", "L", {"x": "3"}, "p", 2), ("a", "z", "L", {}, "p", 1)], "src string, dst string, label string, props map<string,string>, pathway_id string, w int")
    out = graph.upsert_edges(edges, new, spark.createDataFrame([("a",), ("b",)], "id string"), order=["w"]).collect()
    assert [(r["dst"], r["props"], r["pathway_ids"]) for r in out] == [("b", {"x": "3", "y": "1"}, ["p", "q"])]


def test_closure_of_a_cycle_stays_in_its_pathway(spark):
    edges = spark.createDataFrame([("p", 1, 2), ("p", 2, 3), ("p", 3, 1), ("q", 3, 9)] + [("p", i, i + 1) for i in range(10, 30)], "pathway_id string, src int, dst int")
    got = graph.reachable(edges, spark.createDataFrame([("p", 1), ("q", 3), ("p", 10)], "pathway_id string, seed int"), by=("pathway_id",))
    assert rows(got) == sorted([("p", 1, 1), ("p", 1, 2), ("p", 1, 3), ("q", 3, 3), ("q", 3, 9)] + [("p", 10, i) for i in range(10, 31)], key=lambda r: tuple((x is None, str(x)) for x in r))


#: Reactions with the shapes of the golden cases: (reaction, participants by role), expected (source, target, mechanism, sign).
NETWORK = {
    "phosphorylation": ({"catalyst": ["WEE1"], "reactant": ["CCNB1:CDK1"], "product": ["CCNB1:p-CDK1"], "inhibitor": ["CCNA1", "CCNA2"]}, {("WEE1", "CDK1", "catalysis", None), ("CCNA1", "WEE1", "regulation", "negative"), ("CCNA2", "WEE1", "regulation", "negative")}),
    "binding": ({"reactant": ["CDC25C", "SFN"], "product": ["CDC25C:SFN"]}, {("CDC25C", "CDC25C:SFN", "association", None), ("SFN", "CDC25C:SFN", "association", None)}),
    "translocation": ({"reactant": ["CDC25C:SFN"], "product": ["CDC25C:SFN"]}, set()),
    "itself": ({"catalyst": ["WEE1"], "reactant": ["WEE1"], "product": ["p-WEE1"]}, set()),
    "transcription": ({"reactant": ["CDKN1A gene"], "product": ["CDKN1A"], "stimulator": ["WEE1"]}, {("WEE1", "CDKN1A", "regulation", "positive")}),
    "ubiquitination": ({"catalyst": ["MDM2"], "reactant": ["TP53", "UB"], "product": ["ub-TP53"]}, {("MDM2", "TP53", "catalysis", None)}),
    "assembly": ({"catalyst": ["SFN"], "reactant": ["CCNB1:CDK1"], "product": ["x"]}, {("SFN", "CCNB1:CDK1", "catalysis", None)}),
    "chemistry": ({"catalyst": ["WEE1"], "reactant": ["glucose", "ATP"], "product": ["G6P"]}, {("WEE1", "chebi:1", "catalysis", None)}),
    "small molecules": ({"reactant": ["glucose"], "product": ["G6P"], "inhibitor": ["G6P"]}, set()),
}


def test_network_of_golden_shapes(spark):
    parts = [("P", r, e, role) for r, (by, _) in NETWORK.items() for role, es in by.items() for e in es]
    members = [("P", c, m) for c in ("CCNB1:CDK1", "CCNB1:p-CDK1", "CDC25C:SFN") for m in c.split(":")] + [("P", "CDK1", "loop"), ("P", "loop", "CDK1")]
    genes = ["WEE1", "CCNB1", "CDK1", "CCNA1", "CCNA2", "CDC25C", "SFN", "CDKN1A", "MDM2", "TP53", "UB"]
    identity = [(g, g, "gene") for g in genes] + [("p-CDK1", "CDK1", "gene"), ("p-WEE1", "WEE1", "gene"), ("CDKN1A gene", "CDKN1A", "gene"), ("ub-TP53", "TP53", "gene"), ("glucose", "chebi:1", "compound"), ("ATP", "chebi:30616", "compound"), ("G6P", "chebi:2", "compound")]
    tables = [spark.createDataFrame(x, s) for x, s in ((parts, "pathway_id string, reaction_id string, entity_id string, role string"), (members, "pathway_id string, parent_id string, child_id string"), (identity, "entity_id string, reference_id string, reference_type string"), ([("ub-TP53", "UB")], "entity_id string, moiety_id string"))]
    r = net.Reactions(*tables)
    edges = net.emit(net.catalysis(r).unionByName(net.regulation(r)).unionByName(net.association(r))).collect()
    got = {k: {(e["source_id"], e["target_id"], e["mechanism"], e["sign"]) for e in edges if e["reaction_id"] == k} for k in NETWORK}
    assert got == {k: want for k, (_, want) in NETWORK.items()}
    assert {e["rel_type"] for e in edges if e["reaction_id"] == "chemistry"} == {"ACTS_ON_CHEMICAL"}


def test_toy_ontology(spark):
    hierarchy = spark.createDataFrame([(c, p, "is_a") for c, p in (("repair", "root"), ("homeostasis", "root"), ("ber", "repair"), ("ner", "repair"), ("glc", "homeostasis"), ("ca", "homeostasis"))], "child string, parent string, rel string")
    terms = spark.createDataFrame([(t, t.upper(), "P") for t in ("root", "repair", "homeostasis", "ber", "ner", "glc", "ca")], "term string, name string, namespace string")
    genes = spark.createDataFrame([(g, f"text of {g}") for g in ("OGG1", "XPA", "TP53", "INS", "CALM", "XRCC1")], "gene string, text string")
    ann = [("OGG1", "ber", "involved_in", "IDA"), ("XRCC1", "ber", "involved_in", "IMP"), ("XPA", "ner", "involved_in", "IDA"), ("XPA", "ber", "NOT|involved_in", "IDA"), ("TP53", "ner", "involved_in", "IEA"), ("TP53", "glc", "acts_upstream_of", "IDA"), ("INS", "glc", "involved_in", "IDA"), ("CALM", "ca", "involved_in", "IDA")]
    cfg = onto.Config(keep_namespaces=("P",), min_pos=1, max_pos=3, test_frac=0, p_curated_neg=1)
    a = spark.createDataFrame([(g, t, q, [e]) for g, t, q, e in ann], "gene string, term string, qualifier string, evidence array<string>")
    pos, neg, any_, counts = onto.clean(a, genes, terms, cfg)
    assert rows(counts) == [(0, 1, 1, 6)]
    closure = onto.ancestors(hierarchy, terms)
    up, any_up = onto.propagate_up(pos, closure), onto.propagate_up(any_, closure)
    assert {r["term"]: r["n_pos"] for r in onto.anchors(up, terms, cfg).collect()} == {"repair": 3, "homeostasis": 2, "ber": 2, "ner": 1, "glc": 1, "ca": 1}
    parts = onto.split(onto.anchors(up, terms, cfg), closure, cfg)
    tri = onto.mine_triplets(parts.where("part = 'train'"), up, neg, any_up, hierarchy, genes, cfg).collect()
    assert {(r["negative"], r["source"]) for r in tri if r["term"] == "ber"} == {("XPA", "curated_NOT")}
    assert not {r["negative"] for r in tri if r["term"] in ("ner", "glc")} & {"TP53"}
    assert all((r["term"], r["negative"]) not in {(x["term"], x["gene"]) for x in any_up.collect()} for r in tri if r["source"] != "curated_NOT")


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("E. coli enzyme. Acts on DNA.", ["E. coli enzyme.", "Acts on DNA."]),
        ("Acts e.g. on this. Then that", ["Acts e.g. on this.", "Then that"]),
        ("1. First item. Second.", ["1. First item.", "Second."]),
        ("About approx. 3 kDa. (PubMed:1). Next", ["About approx. 3 kDa. (PubMed:1).", "Next"]),
        ('He said "no." Then left! ok? Yes', ['He said "no."', "Then left! ok?", "Yes"]),
        ("one blob without an end", ["one blob without an end"]),
        ("", []),
        (None, []),
        ("  \n ", []),
    ],
)
def test_sentences(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "t string").select(text.split_sentences(F.col("t")).alias("s")).first()["s"] == want


def test_windows_and_point_ids(spark):
    spans = lambda n, w, s: [(x["sent_start"], x["sent_end"]) for x in spark.range(1).select(text.windows(F.array(*[F.lit(str(i)) for i in range(n)]).cast("array<string>"), w, s).alias("w")).first()["w"]]
    assert (spans(0, 2, 1), spans(1, 2, 1), spans(3, 2, 1), spans(4, 3, 2), spans(5, 3, 2)) == ([], [(0, 1)], [(0, 2), (1, 3)], [(0, 3), (1, 4)], [(0, 3), (2, 5)])
    ids = ["P11111", "P11111#3", "ü#0"]
    got = spark.createDataFrame([(i,) for i in ids], "k string").select(text.point_id(F.col("k")).alias("u")).collect()
    assert [r["u"] for r in got] == [str(uuid.uuid5(uuid.NAMESPACE_URL, i)) for i in ids]


def test_rerank_keeps_every_record(spark):
    short = spark.createDataFrame([(1, i, r) for r, i in enumerate("abcd", 1)], "query_id int, id string, rank int")
    best = spark.createDataFrame([(1, "b", 0, 1.0), (1, "b", 1, 0.5), (1, "c", 0, 0.9), (1, "c", 1, 0.8)], "query_id int, id string, chunk_idx int, score double")
    order = lambda how: [r["id"] for r in search.chunk_rerank(short, best, 9, how).orderBy("rank").collect()]
    assert order("max") == ["b", "c", "a", "d"] and order("top2") == ["c", "b", "a", "d"]
    assert {r["id"]: r["chunk_score"] for r in search.chunk_rerank(short, best, 9, "top2").collect()} == {"a": None, "b": 0.75, "c": 0.85, "d": None}


def test_metrics_of_perfect_and_missing_rankings(spark):
    relevant = spark.createDataFrame([(1, "a"), (1, "b"), (2, "z")], "query_id int, id string")
    ranked = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "q", 1)], "query_id int, id string, rank int")
    got = {r["query_id"]: r.asDict() for r in ir.per_query(ranked, relevant, (2,), 2).collect()}
    assert {k: v for k, v in got[1].items() if k not in ("query_id", "n_rel")} == {"accuracy_2": 1.0, "precision_2": 1.0, "recall_2": 1.0, "mrr_2": 1.0, "ndcg_2": 1.0, "map_2": 1.0}
    assert all(v == 0 for k, v in got[2].items() if k not in ("query_id", "n_rel"))


def test_unknown_names_are_errors(spark):
    one = spark.createDataFrame([("Nothing",)], "c string")
    with pytest.raises(Exception, match="unknown class"):
        one.select(shape.entity_type(F.col("c"))).collect()
    for ref in ("xyz:1", "C00022"):
        with pytest.raises(Exception, match="unknown reference"):
            sources.prefixed_refs(one.withColumn("c", F.lit(ref)), "c").collect()
    xml = '<sbml><model id="pathway_1"><listOfSpecies><species id="s"/></listOfSpecies><listOfReactions><reaction id="reaction_1"><listOfModifiers><modifierSpeciesReference species="s" sboTerm="SBO:9"/></listOfModifiers></reaction></listOfReactions></model></sbml>'
    with pytest.raises(Exception, match="unknown modifier term"):
        sources.sbml(one.select(F.lit(xml).alias("text")))[3].collect()


def test_stream_refuses_a_split_scope(spark, tmp_path):
    schema = "scope string, item int, n int"
    spark.createDataFrame([("a", 1, 2)], schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    run = streaming.cdc_apply(stream, f"{tmp_path}/table", f"{tmp_path}/log", f"{tmp_path}/check", ["scope", "item"], ["scope"], ["item"], scope_rows="n")
    with pytest.raises(Exception, match="split over batches"):
        run.awaitTermination()
