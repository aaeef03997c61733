"""From an ontology and its annotations to a contrastive data set: cleaning, propagation, anchors, split, triplets.

Tables: annotations(gene, term, qualifier, evidence array), hierarchy(child, parent, rel), terms(term, name, namespace),
genes(gene, text). Pairs are (gene, term). Draws are ranks by md5 of a seed and keys.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import reachable, reached
from .store import erase, written
from .text import parse_qualifier

#: The rules' defaults.
KEEP_EVIDENCE = ("EXP", "IDA", "IPI", "IMP", "IGI", "IEP", "HTP", "HDA", "HMP", "HGI", "HEP", "TAS", "IC")
INDIRECT = ("acts_upstream_of", "colocalizes_with")


@dataclass(frozen=True)
class Config:
    keep_evidence: tuple[str, ...] = KEEP_EVIDENCE
    drop_qualifier_prefixes: tuple[str, ...] = INDIRECT
    keep_namespaces: tuple[str, ...] = ("molecular_function", "biological_process")
    blocklist: tuple[str, ...] = ("GO_0005515",)
    min_pos: int = 3
    max_pos: int = 150
    pos_per_anchor: int = 50
    p_curated_neg: float = 0.5
    test_frac: float = 0.1
    seed: int = 13


def order_of(seed: int, *keys: Column | str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *(F.col(k).cast("string") if isinstance(k, str) else k for k in keys)))


def corpus_map(function: DataFrame, crosswalk: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(map, corpus) of function(accession, text): map(gene, accession) by a crosswalk(gene, accession), else the accession itself; corpus(accession, text) without blank texts."""
    corpus = function.where(F.trim(F.coalesce("text", F.lit(""))) != "").groupBy("accession").agg(F.min("text").alias("text"))
    if crosswalk is None:
        return corpus.select(F.col("accession").alias("gene"), "accession"), corpus
    return crosswalk.select("gene", "accession").distinct().join(corpus.select("accession"), "accession", "left_semi").select("gene", "accession"), corpus


def crosswalk(pairs: DataFrame, corpus: DataFrame) -> DataFrame:
    """gene -> accessions, sorted and distinct, of those in the corpus; a gene has few."""
    known = pairs.select("gene", "accession").join(corpus.select("accession").distinct(), "accession", "left_semi")
    return known.groupBy("gene").agg(F.array_sort(F.collect_set("accession")).alias("accessions"))


def expand_annotations(annotations: DataFrame, gene_map: DataFrame) -> DataFrame:
    """Each annotation of a gene for every accession under it, as the gene."""
    rest = [c for c in annotations.columns if c != "gene"]
    return annotations.join(gene_map, "gene").select(F.col("accession").alias("gene"), *rest)


def clean(annotations: DataFrame, genes: DataFrame, terms: DataFrame, cfg: Config = Config(), once: bool = False) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(positives, negatives, any, counts): distinct pairs, trusted, refuted and linked by any evidence; and a row of what was dropped.

    Any takes all that are not negated before weak evidence and indirect qualifiers go. once: the pairs are written, for
    those who read several of the three.
    """
    codes = F.array(*map(F.lit, cfg.keep_evidence))
    evidence = F.coalesce("evidence", F.array().cast("array<string>"))
    q = parse_qualifier(F.col("qualifier"))
    indirect = reduce(Column.__or__, (q["qualifier"].startswith(p) for p in cfg.drop_qualifier_prefixes), F.lit(False))
    fate = F.when(~F.arrays_overlap(evidence, codes), "weak").when(indirect, "indirect").otherwise("kept")
    rows = annotations.select("gene", "term", q["negated"].alias("negated"), fate.alias("fate"))
    known = genes.select("gene").distinct(), terms.select("term").distinct()
    is_kept = F.col("fate") == "kept"
    pairs = rows.where(is_kept | ~F.col("negated")).join(known[0], "gene", "left_semi").join(known[1], "term", "left_semi")
    pairs = pairs.select("gene", "term", (is_kept & ~F.col("negated")).alias("_pos"), (is_kept & F.col("negated")).alias("_neg"), (~F.col("negated")).alias("_any"))
    if once:
        flags = [F.bool_or(c).alias(c) for c in ("_pos", "_neg", "_any")]
        pairs = written(pairs.groupBy("gene", "term").agg(*flags), "pairs")
    pick = lambda c: pairs.where(c).select("gene", "term") if once else pairs.where(c).select("gene", "term").distinct()
    full = rows.join(known[0].withColumn("_g", F.lit(True)), "gene", "left").join(known[1].withColumn("_t", F.lit(True)), "term", "left")
    full = full.withColumn("fate", F.when(F.col("_g").isNull() | F.col("_t").isNull(), "missing").otherwise(F.col("fate")))
    n = lambda f, name: F.count_if(F.col("fate") == f).alias(name)
    counts = full.agg(n("missing", "drop_missing_text_or_term"), n("weak", "drop_weak_evidence"), n("indirect", "drop_indirect_qualifier"), n("kept", "kept"))
    return pick("_pos"), pick("_neg"), pick("_any"), counts


def ancestors(hierarchy: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, ancestor) over is_a and part_of, each term itself included."""
    up = hierarchy.where(F.col("rel").isin("is_a", "part_of")).select(F.col("child").alias("src"), F.col("parent").alias("dst"))
    return reachable(up, terms.select(F.col("term").alias("seed"))).select(F.col("seed").alias("term"), F.col("id").alias("ancestor"))


def descendants(hierarchy: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, descendant), each term itself included."""
    turned = hierarchy.select(F.col("parent").alias("child"), F.col("child").alias("parent"), "rel")
    return ancestors(turned, terms).withColumnRenamed("ancestor", "descendant")


def closure_to(hierarchy: DataFrame, wanted: DataFrame) -> DataFrame:
    """(term, ancestor) as `ancestors` has them, of the ancestors in wanted(term) alone, from which it goes down."""
    return descendants(hierarchy, wanted.select("term").distinct()).select(F.col("descendant").alias("term"), F.col("term").alias("ancestor"))


def uncrowded(pairs: DataFrame, hierarchy: DataFrame, terms: DataFrame, most: int) -> DataFrame:
    """The terms without those that certainly get more than `most` genes from direct pairs: by their own and their children's
    pairs, or because they lie above such a term, whose genes they get as well."""
    up = hierarchy.where(F.col("rel").isin("is_a", "part_of")).select(F.col("child").alias("src"), F.col("parent").alias("dst")).distinct()
    near = pairs.union(pairs.join(up.withColumnRenamed("src", "term"), "term").select("gene", F.col("dst").alias("term"))).distinct()
    crowded = written(near.groupBy("term").agg(F.count("*").alias("_n")).where(F.col("_n") > most).select(F.col("term").alias("id")), "crowded")
    return terms.select("term").distinct().join(reached(up, crowded).all().withColumnRenamed("id", "term"), "term", "left_anti")


def pool_terms(train: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """The terms whose positives `mine_triplets` reads: the anchors, and the children of their is_a parents."""
    isa, own = hierarchy.where("rel = 'is_a'").select("child", "parent"), train.select("term")
    parents = isa.join(own.withColumnRenamed("term", "child"), "child", "left_semi").select("parent").distinct()
    return own.union(isa.join(parents, "parent", "left_semi").select(F.col("child").alias("term"))).distinct()


def propagate_up(pairs: DataFrame, closure: DataFrame) -> DataFrame:
    """Pairs with the terms' ancestors: a gene has what its terms imply. closure(term, ancestor) includes the term."""
    return pairs.join(closure, "term").select("gene", F.col("ancestor").alias("term")).distinct()


def propagate_down(pairs: DataFrame, closure: DataFrame) -> DataFrame:
    """Refuted pairs with the terms' descendants. closure(term, ancestor) is read the other way."""
    return pairs.join(closure.select(F.col("ancestor").alias("term"), F.col("term").alias("_d")), "term").select("gene", F.col("_d").alias("term")).distinct()


def resolve_conflicts(negatives: DataFrame, positives: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(negatives without those that a trusted positive contradicts, one row with their number); both have a pair once.

    Both sides are exchanged once and the refuted pairs written, so that the two results cost one pass.
    """
    side = lambda df, pos: df.select("gene", "term", F.lit(pos).alias("_p"))
    both = side(negatives, False).union(side(positives, True)).groupBy("gene", "term").agg(F.bool_or("_p").alias("_p"), F.bool_or(~F.col("_p")).alias("_n"))
    refuted = written(both.where("_n").select("gene", "term", "_p"), "refuted")
    return refuted.where("not _p").select("gene", "term"), refuted.where("_p").agg(F.count("*").alias("conflicts"))


def siblings(hierarchy: DataFrame) -> DataFrame:
    """(term, sibling): other terms with a common is_a parent. One row per pair: a parent of m children gives m * (m - 1)."""
    isa = hierarchy.where("rel = 'is_a'").select("child", "parent").distinct()
    pairs = isa.select(F.col("child").alias("term"), "parent").join(isa.select(F.col("child").alias("sibling"), "parent"), "parent")
    return pairs.where("term <> sibling").select("term", "sibling").distinct()


def eligible(positives: DataFrame, terms: DataFrame, cfg: Config = Config()) -> DataFrame:
    """term, name, n_pos of named terms of the namespaces kept, not on the blocklist, with any positive."""
    named = terms.where(F.coalesce("name", F.lit("")) != "").where(F.col("namespace").isin(*cfg.keep_namespaces) & ~F.col("term").isin(*cfg.blocklist))
    return positives.groupBy("term").agg(F.count("*").alias("n_pos")).join(named.select("term", "name"), "term").select("term", "name", "n_pos")


def anchors(positives: DataFrame, terms: DataFrame, cfg: Config = Config()) -> DataFrame:
    """The eligible terms with min_pos to max_pos positives."""
    return eligible(positives, terms, cfg).where(F.col("n_pos").between(cfg.min_pos, cfg.max_pos))


def anchor_stats(positives: DataFrame, terms: DataFrame, cfg: Config = Config()) -> DataFrame:
    """stat, n: eligible_terms, rejected_below_min_pos, rejected_above_max_pos, and pos_size_<n> for n from 1 to min_pos + 3."""
    found = eligible(positives, terms, cfg)
    n = lambda c, name: F.count_if(c).alias(name)
    sizes = range(1, cfg.min_pos + 4)
    stats = found.agg(F.count("*").alias("eligible_terms"), n(F.col("n_pos") < cfg.min_pos, "rejected_below_min_pos"), n(F.col("n_pos") > cfg.max_pos, "rejected_above_max_pos"), *(n(F.col("n_pos") == k, f"pos_size_{k}") for k in sizes))
    return stats.unpivot([], stats.columns, "stat", "n")


def split(anchor: DataFrame, closure: DataFrame | None, cfg: Config = Config(), hierarchy: DataFrame | None = None) -> DataFrame:
    """anchors with `part`: test (the first share by md5 of seed and term, one at least), buffer (others that are above or below a test term) or train.

    What is above or below comes from closure(term, ancestor), or without one from the hierarchy, node by node.
    """
    n = anchor.count()
    n_test = max(1, int(n * cfg.test_frac)) if cfg.test_frac > 0 and n else 0
    order = F.struct(order_of(cfg.seed, "term"), "term")
    test = written(anchor.orderBy(order).limit(n_test).select("term"), "test")
    if closure is None:
        up = hierarchy.where(F.col("rel").isin("is_a", "part_of")).select(F.col("child").alias("src"), F.col("parent").alias("dst"))
        down, starts = up.select(F.col("dst").alias("src"), F.col("src").alias("dst")), test.withColumnRenamed("term", "id")
        lineage = reached(up, starts).all().union(reached(down, starts).all()).distinct().withColumnRenamed("id", "term")
    else:
        above = closure.join(test, "term", "left_semi").select(F.col("ancestor").alias("term"))
        lineage = above.union(closure.join(test.withColumnRenamed("term", "ancestor"), "ancestor", "left_semi").select("term")).distinct()
    marked = anchor.join(test.withColumn("_test", F.lit(True)), "term", "left").join(lineage.withColumn("_near", F.lit(True)), "term", "left")
    part = F.when(F.col("_test"), "test").when(F.col("_near"), "buffer").otherwise("train")
    return marked.withColumn("part", part).drop("_test", "_near")


def split_counts(parts: DataFrame) -> DataFrame:
    """One row: anchors_total, anchors_test, anchors_train, anchors_lost_to_buffer."""
    n = lambda p: F.count_if(F.col("part") == p)
    return parts.agg(F.count("*").alias("anchors_total"), n("test").alias("anchors_test"), n("train").alias("anchors_train"), n("buffer").alias("anchors_lost_to_buffer"))


def numbered(pool: DataFrame, by: str, seed: int) -> DataFrame:
    """pool(by, gene) with _i, its place from 0 in an order drawn for `by`, and _n, the size of the pool."""
    w = Window.partitionBy(by)
    return pool.withColumn("_i", F.row_number().over(w.orderBy(order_of(seed, by, "gene"), "gene")) - 1).withColumn("_n", F.count("*").over(w))


def mine_triplets(train: DataFrame, positives: DataFrame, negatives: DataFrame, any_pos: DataFrame, hierarchy: DataFrame, genes: DataFrame, cfg: Config = Config()) -> DataFrame:
    """term, positive, negative, source of up to pos_per_anchor positives of each train anchor.

    The negative is a curated one with probability p_curated_neg, or when there is no sibling's; else a gene of a sibling
    term (a child of one of the anchor's is_a parents) that nothing links to the anchor; else any gene that nothing links
    to it; without any the positive is left out. any_pos holds the positives as well. Draws are the md5 of seed, term and
    positive. A curated one is drawn modulo their number. Siblings' genes are never listed for an anchor: the genes of
    each parent's children are, once, in places from 0, and an anchor's places are those of its parents one after the
    other; it has a free one unless its links take them all, which counts tell. The negative is the first unlinked gene at or
    after the drawn place, round the end; for a random one places are those of all genes. An anchor has at most max_pos
    trusted positives but may have more links, so places from the drawn one on are tried in blocks that double.
    """
    train = train.select("term")
    chosen = positives.join(train, "term", "left_semi").withColumn("_r", F.row_number().over(Window.partitionBy("term").orderBy(order_of(cfg.seed, F.lit("pos"), "term", "gene"), "gene")))
    chosen = chosen.where(F.col("_r") <= cfg.pos_per_anchor).select("term", F.col("gene").alias("positive"))
    u = F.conv(F.substring(order_of(cfg.seed, F.lit("u"), "term", "positive"), 1, 8), 16, 10).cast("long")
    chosen = chosen.withColumn("_u", u / F.lit(float(1 << 32))).withColumn("_d", F.conv(F.substring(order_of(cfg.seed, F.lit("neg"), "term", "positive"), 1, 8), 16, 10).cast("long"))
    curated = numbered(negatives.join(train, "term", "left_semi").select("term", "gene").distinct(), "term", cfg.seed)
    isa = hierarchy.where("rel = 'is_a'").select("child", "parent").distinct()
    own = written(isa.withColumnRenamed("child", "term").join(train, "term", "left_semi").withColumnRenamed("parent", "pool"), "parents")
    under = isa.join(own.select(F.col("pool").alias("parent")).distinct(), "parent", "left_semi").join(positives.withColumnRenamed("term", "child"), "child")
    placed = places(under.select(F.col("parent").alias("pool"), "gene").distinct())
    # An anchor's stretch of places for each of its parents.
    along = Window.partitionBy("term").orderBy("pool")
    sizes = placed.groupBy("pool").agg(F.count("*").alias("_size"))
    own = written(own.join(sizes, "pool").withColumn("_start", F.sum("_size").over(along) - F.col("_size")), "stretches")
    linked = any_pos.join(own.select("term", "pool"), "term").join(placed.select("pool", "gene"), ["pool", "gene"]).groupBy("term").agg(F.count("*").alias("_linked"))
    free = own.groupBy("term").agg(F.sum("_size").alias("_s")).join(linked, "term", "left").where("_s > coalesce(_linked, 0)").select("term", "_s")
    rows = chosen.join(curated.where("_i = 0").select("term", F.col("_n").alias("_c")), "term", "left").join(free, "term", "left")
    source = F.when(F.col("_c").isNotNull() & ((F.col("_u") < cfg.p_curated_neg) | F.col("_s").isNull()), "curated_NOT").when(F.col("_s").isNotNull(), "sibling").otherwise("random")
    rows = written(rows.withColumn("source", source), "triplets")
    drawn = rows.where("source = 'curated_NOT'").withColumn("_i", F.pmod("_d", "_c"))
    out = drawn.join(curated.select("term", "_i", F.col("gene").alias("negative")), ["term", "_i"]).select("term", "positive", "negative", "source")
    out = out.unionByName(_first_free(rows.where("source = 'sibling'"), own.select("term", "pool", "_start", "_size"), placed, any_pos))
    everything = places(genes.select(F.lit("").alias("pool"), "gene").distinct())
    stretch = everything.agg(F.lit("").alias("pool"), F.lit(0).cast("long").alias("_start"), F.count("*").alias("_size")).where("_size > 0")
    at_random = rows.where("source = 'random'")
    whole = at_random.select("term").distinct().join(stretch)  # one row on the right
    return out.unionByName(_first_free(at_random, whole, everything, any_pos))


def places(pool: DataFrame) -> DataFrame:
    """pool(pool, gene) with _at: places from 0 within each pool, in the order of the gene's md5. Numbered by chunks of the hash, so that no task holds a pool."""
    hashed = pool.withColumn("_h", F.md5(F.col("gene").cast("string"))).withColumn("_k", F.substring("_h", 1, 2))
    hashed = written(hashed, "pools")
    before = Window.partitionBy("pool").orderBy("_k")
    starts = hashed.groupBy("pool", "_k").agg(F.count("*").alias("_n")).withColumn("_before", F.sum("_n").over(before) - F.col("_n")).drop("_n")  # 256 rows a pool
    place = F.row_number().over(Window.partitionBy("pool", "_k").orderBy("_h", "gene")) - 1
    out = written(hashed.withColumn("_p", place).join(starts, ["pool", "_k"]).select("pool", "gene", (F.col("_p") + F.col("_before")).cast("long").alias("_at")), "places")
    erase(hashed)
    return out


def _first_free(rows: DataFrame, stretches: DataFrame, placed: DataFrame, any_pos: DataFrame) -> DataFrame:
    """rows(term, positive, source, _d) with the first gene that any_pos does not link to the term, at or after place _d modulo
    the term's places, round the end. stretches(term, pool, _start, _size): the pools whose places a term has one after the other."""
    spark, cols = rows.sparkSession, ["term", "positive", "negative", "source"]
    total = stretches.groupBy("term").agg(F.sum("_size").alias("_total"))
    left = written(rows.join(total, "term").select("term", "positive", "source", "_d", "_total"), "open")
    found, first, step = [], 0, 4
    while not left.isEmpty():
        tries = left.where(F.col("_total") > first).select("*", F.explode(F.sequence(F.lit(first).cast("long"), F.least(F.lit(first + step).cast("long"), F.col("_total")) - 1)).alias("_t"))
        tried = tries.withColumn("_place", F.pmod(F.col("_d") + F.col("_t"), F.col("_total"))).join(stretches, "term").where("_place >= _start and _place < _start + _size")
        tried = tried.withColumn("_at", F.col("_place") - F.col("_start")).join(placed.withColumnRenamed("gene", "negative"), ["pool", "_at"])
        free = tried.join(any_pos.select("term", F.col("gene").alias("negative")), ["term", "negative"], "left_anti")
        best = written(free.groupBy("term", "positive", "source").agg(F.min_by("negative", "_t").alias("negative")).select(cols), "free")
        found.append(best)
        old, left = left, written(left.where(F.col("_total") > first + step).join(best, ["term", "positive"], "left_anti"), "open")
        erase(old)
        first, step = first + step, step * 2
    erase(left)
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], rows.select("term", "positive", F.col("positive").alias("negative"), "source").schema)


def eval_set(parts: DataFrame, positives: DataFrame, genes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(queries(term, name), corpus(gene, text), relevant(term, gene)) of the test anchors."""
    queries = parts.where("part = 'test'").select("term", "name")
    return queries, genes.select("gene", "text"), positives.join(queries.select("term"), "term", "left_semi").select("term", "gene")


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: n and fingerprint of the rows, whatever their order; equal tables have equal ones, repeated rows count."""
    row = F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256)
    part = lambda k: F.sum(F.conv(F.substring(row, 1 + 8 * k, 8), 16, 10).cast("decimal(20,0)"))
    sums = df.agg(F.count("*").alias("n"), *(F.coalesce(part(k), F.lit(0).cast("decimal(30,0)")).alias(f"_s{k}") for k in range(4)))
    return sums.select("n", F.sha2(F.concat_ws(":", F.col("n").cast("string"), *(F.col(f"_s{k}").cast("string") for k in range(4))), 256).alias("fingerprint"))


def publish_if_changed(current: DataFrame, log: DataFrame) -> DataFrame:
    """The row of a fingerprint that the log(fingerprint) does not have yet; none: nothing to publish."""
    return current.join(log.select("fingerprint").distinct(), "fingerprint", "left_anti")
