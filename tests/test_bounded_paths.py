"""What operators leave unread, unsent or unkept, and that their results stay the same for it."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import cdc, graph, ir, search, shape
from tidemark.operators.buckets import ScopeTable
from tidemark.streaming import cdc as streaming


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


def test_nearest_compares_few_parts(spark):
    rng = np.random.default_rng(1)
    middle = rng.normal(size=(30, 12))
    data = [(i, (middle[i % 30] + 0.05 * rng.normal(size=12)).tolist()) for i in range(2400)]
    data += [(5000 + i, [1.0] * 12) for i in range(1200)] + [(9000, None), (9001, [0.0] * 12), (9002, [float("nan")] * 12)]  # a third are equal
    df = spark.createDataFrame(data, "id long, dense array<double>")
    q = df.where("id % 60 = 0").withColumnRenamed("id", "query_id")
    got = search.nearest(q, df, 20, query_rows=16, vector_rows=300, rings=4)
    kept = [(i, np.array(v) / np.linalg.norm(v)) for i, v in data if v and not np.isnan(v).any() and any(v)]
    ids, m = np.array([i for i, _ in kept]), np.array([v for _, v in kept])
    want = []
    for i, v in kept:
        if i % 60 == 0:
            scores = np.round(m @ v, 6) + 0.0
            want += [(i, int(ids[at]), float(scores[at]), rank + 1) for rank, at in enumerate(np.lexsort((ids, -scores))[:20])]
    assert rows(got.ranking) == rows(spark.createDataFrame(want, "query_id long, id long, score double, rank int"))
    met = got.compared.collect()
    assert sum(r["rows"] for r in met) < 0.6 * len(met) * len(kept)
    assert search.nearest(q.limit(0), df, 3).ranking.isEmpty() and search.nearest(q, df.limit(0), 3).ranking.isEmpty()


def test_long_chains_and_cycles_take_few_rounds(spark):
    chain = spark.range(10_000).select(F.col("id"), (F.col("id") + 1).alias("dst"))
    ring = spark.range(3000).select((F.col("id") + 50_000).alias("id"), (F.pmod(F.col("id") + 1, F.lit(3000)) + 50_000).alias("dst"))
    tail = spark.createDataFrame([(10_000, 20_001), (10_000, 20_002), (20_001, 20_003), (20_002, 20_003), (20_003, 50_007)], "id long, dst long")
    edges = chain.union(ring).union(tail)
    found = graph.closure(edges, spark.createDataFrame([(0,)], "id long"), "id", [], [])
    assert found.rounds <= 20
    assert sorted(r[0] for r in found.all().collect()) == [*range(10_001), 20_001, 20_002, 20_003, *range(50_000, 53_000)]


def test_closure_equals_a_plain_search(spark):
    rng = random.Random(4)
    pairs = [(rng.randrange(80), rng.randrange(80)) for _ in range(70)] + [(i, i + 1) for i in range(100, 140)]
    after = {}
    for a, b in pairs:
        after.setdefault(a, set()).add(b)
    want = set()
    for s in range(0, 141, 7):
        todo, seen = [s], {s}
        while todo:
            new = after.get(todo.pop(), set()) - seen
            seen |= new
            todo += new
        want |= {(s, x) for x in seen}
    edges = spark.createDataFrame(pairs, "id long, dst long").distinct()
    starts = spark.createDataFrame([(s, s) for s in range(0, 141, 7)], "seed long, id long")
    for plain in (0, 100):
        assert {tuple(r) for r in graph.closure(edges, starts, "id", [], ["seed"], plain_rounds=plain).all().collect()} == want


def test_frontier_marks_each_node_once(spark):
    """Many roots over one long path: one row a node is written, not one a root and node."""
    edges = spark.range(40).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    found = graph.reached(edges, spark.range(30).select("id"))
    assert found.all().count() == 41
    objects = spark.range(35).select(F.col("id").alias("object_id"))
    moiety = spark.createDataFrame([(3, 100, False), (4, 101, True), (99, 102, False)], "entity_id long, moiety_id long, is_reference boolean")
    known, lost = shape.resolve_frontier(spark.range(30).select("id"), edges.select(F.col("src").alias("parent_id"), F.col("dst").alias("child_id")), moiety, objects)
    assert rows(known) == rows(spark.range(35)) and rows(lost) == [(100,), (35,)]


def test_paths_of_a_length(spark):
    pairs = [(i, i + 1) for i in range(6)] + [(10, 11), (11, 10), (20, 21), (6, 3)]
    edges = spark.createDataFrame(pairs, "src long, dst long")
    starts = spark.createDataFrame([(i,) for i in (0, 5, 6, 10, 20, 21)], "id long")
    after = {}
    for a, b in pairs:
        after.setdefault(a, set()).add(b)
    for depth in (0, 2, 9):
        def far(i, d):
            now = {i}
            for _ in range(d):
                now = {y for x in now for y in after.get(x, ())}
            return now
        assert {r[0] for r in graph.ends_after(edges, starts, depth).collect()} == {i for i in (0, 5, 6, 10, 20, 21) if far(i, depth)}
        want = {(i, x) for i in (0, 5, 6, 10, 20, 21) for d in range(min(depth, 2), depth + 1) for x in far(i, d)}
        assert {tuple(r) for r in graph.expand_bounded(edges, starts.withColumnRenamed("id", "seed"), min(depth, 2), depth).collect()} == want


def test_nodes_are_deleted_by_label_and_id(spark):
    nodes = spark.createDataFrame([("Gene", "1", {}), ("Compound", "1", {}), ("Gene", "2", {})], "label string, id string, props map<string,string>")
    gone = spark.createDataFrame([("Gene", "1")], "label string, id string")
    form = "src string, dst string, label string, props map<string,string>, pathway_ids array<string>"
    named = spark.createDataFrame([("1", "2", "A", {}, ["p"], "Gene", "Gene"), ("1", "2", "B", {}, ["p"], "Compound", "Gene"), ("2", "1", "C", {}, ["p"], "Gene", "Gene")], f"{form}, src_label string, dst_label string")
    kept, rest = graph.delete_nodes(nodes, named, gone)
    assert rows(kept.select("label", "id")) == [("Compound", "1"), ("Gene", "2")] and rows(rest.select("label")) == [("B",)]
    bare = named.drop("src_label", "dst_label")
    assert graph.delete_nodes(nodes, bare, gone)[1].count() == 3  # 1 is still a compound
    assert graph.delete_nodes(nodes.where("label = 'Gene'"), bare, gone)[1].isEmpty()
    new = named.withColumn("pathway_id", F.lit("q")).drop("pathway_ids")
    assert rows(graph.upsert_edges(named, new, kept).select("label", "pathway_ids")) == [("A", ["p"]), ("B", ["p", "q"]), ("C", ["p"])]


FORM = "scope string, item int, v int"


def test_load_of_one_scope_writes_one_bucket(spark, tmp_path):
    table = ScopeTable(spark, f"{tmp_path}/t", FORM, ["scope"], 8)
    make = lambda data: spark.createDataFrame(data, FORM)
    first = make([(f"s{i}", j, 0) for i in range(20) for j in range(3)] + [(None, 1, 1)])
    assert len(table.merge_identity(first, ["scope", "item"], 0).buckets) == 8
    load = make([("s3", 1, 5), ("s3", 9, 0)])
    plain, diff = cdc.merge_identity(table.read(), load, ["scope", "item"], ["scope"])
    want, want_diff = rows(plain), rows(diff)
    for _ in range(2):  # the second time as after a failure: the same table, the same diff
        logged = []
        done = table.merge_identity(load, ["scope", "item"], 1, before_commit=lambda d: logged.append(rows(d)))  # noqa: B023
        assert len(done.buckets) == 1 and logged == [want_diff] and rows(table.read()) == want
        assert [n for n in table._names(f"{tmp_path}/t/data/v=1") if n.startswith("_bucket")] == [f"_bucket={done.buckets[0]}"]
    assert {f.split("/v=")[1][0] for f in table.read(done.buckets).inputFiles()} == {"1"}

    def fails(diff):
        raise RuntimeError("log")

    with pytest.raises(RuntimeError, match="log"):
        table.merge_identity(make([("s4", 0, 0)]), ["scope", "item"], 2, before_commit=fails)
    assert rows(table.read()) == want and table.versions() == [0, 1]
    table.merge_identity(make([("s5", 0, 0)]), ["scope", "item"], 2)
    now = rows(table.read())
    table.clean(1)
    assert rows(ScopeTable(spark, f"{tmp_path}/t", FORM, ["scope"]).read()) == now and table.versions() == [2]
    with pytest.raises(ValueError, match="older"):
        table.merge_identity(load, ["scope", "item"], 1)
    with pytest.raises(ValueError, match="scope"):
        table.merge_identity(load, ["item"], 3)


def test_seen_scopes_are_dropped_after_their_run(spark, tmp_path):
    for run in range(4):
        data = [(f"s{i}", run, 0) for i in range(5 + run)] * 3
        spark.createDataFrame(data, FORM).repartition(2).withColumn("run_id", F.lit(str(run))).write.partitionBy("run_id").mode("append").parquet(f"{tmp_path}/log")
        time.sleep(1.1)
    query = streaming.changed_scopes(spark, f"{tmp_path}/log", FORM, "scope", f"{tmp_path}/check", f"{tmp_path}/out", files_per_batch=1)
    query.awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/out").select("run_id", "scope")) == sorted((str(r), f"s{i}") for r in range(4) for i in range(5 + r))
    assert streaming.late_rows(query) == 0 and max(streaming.state_rows(query)) < 26 and streaming.state_rows(query)[-1] <= 15


def test_bootstrap_takes_either_way(spark):
    rng = random.Random(3)
    data = [(m, q, round(rng.uniform(-1, 1), 3)) for m, n in (("a", 23), ("b", 23), ("c", 7), ("d", 1)) for q in range(n)]
    delta = spark.createDataFrame(data, "metric string, query_id long, delta double")
    rounded = lambda most: rows(ir.paired_bootstrap(delta, 60, 5, most=most).select("metric", "queries", *(F.round(c, 9) for c in ("delta", "ci_lo", "ci_hi", "p_two_sided")), "improved"))
    together = rounded(1 << 20)
    assert together == rounded(10) == rounded(0) and len(together) == 4
    from hashlib import md5

    values = [d for m, _, d in data if m == "a"]
    draw = lambda i, j: int(md5(f"5:{i}:{j // 4}".encode()).hexdigest()[j % 4 * 8 : j % 4 * 8 + 8], 16) % 23
    means = sorted(round(sum(values[draw(i, j)] for j in range(23)) / 23, 12) for i in range(60))
    at = lambda p: means[int(p * 59)] + (p * 59 - int(p * 59)) * (means[min(int(p * 59) + 1, 59)] - means[int(p * 59)])
    assert together[0][3:5] == (round(at(0.025), 9), round(at(0.975), 9))


def test_sparse_opens_few_blocks(spark):
    """Terms from rare to very common: the same rows as the plain sum, from a part of the postings."""
    rng = random.Random(9)
    docs = [(i, " ".join([f"common{rng.randrange(2)}"] * rng.randint(1, 9) + [f"mid{rng.randrange(40)}" for _ in range(6)] + [f"rare{rng.randrange(3000)}" for _ in range(8)])) for i in range(3000)]
    df = spark.createDataFrame(docs, "id long, text string")
    index = search.bm25_index(df, stem=None).cache()
    asked = [(q, f"{w}") for q, words in enumerate([("common0", "rare7", "mid3"), ("common1", "common0"), ("rare1", "rare2", "rare9999"), ("mid1", "mid2", "common1", "rare5"), ("none",), ("rare11", "common0", "common1")]) for w in words]
    terms = spark.createDataFrame(asked, "query_id int, term string")
    blocks = search.block_index(index, rows=64).cache()
    assert blocks.agg(F.sum("n")).first()[0] == index.count()
    got = search.sparse_bounded(terms, index, blocks, len(docs), 5)
    assert rows(got.ranking.select("query_id", "id", "score", "rank")) == rows(search.sparse(terms, index, len(docs), 5).select("query_id", "id", "score", "rank"))
    read = {r["query_id"]: (r["read"], r["postings"]) for r in got.read.collect()}
    assert all(read[q][0] < 0.5 * read[q][1] for q in (0, 3, 5)) and 4 not in read
    index.unpersist()
    blocks.unpersist()


def test_written_tables_can_all_be_deleted(spark):
    from tidemark.operators import store

    store.erase_all(spark)
    kept = graph.reachable(spark.createDataFrame([(1, 2), (2, 3)], "src long, dst long"), spark.createDataFrame([(1,)], "seed long"))
    assert kept.count() == 3 and store.erase_all(spark) == 1 and store.erase_all(spark) == 0
