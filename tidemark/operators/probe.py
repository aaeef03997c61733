"""Analytic queries over annotations and data sets: what a configuration keeps, and what an export was built with.

Tables as in `onto`; counted(term, name, namespace, n_pos) has the number of positives of each term.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import ends_after
from .onto import Config


def inventory(annotations: DataFrame) -> DataFrame:
    """qualifier, evidence, n: annotations by qualifier and evidence code; one without codes has a null one."""
    return annotations.select("qualifier", F.explode_outer("evidence").alias("evidence")).groupBy("qualifier", "evidence").agg(F.count("*").alias("n"))


def code_gaps(annotations: DataFrame, cfg: Config = Config()) -> DataFrame:
    """evidence, problem: codes that are configured but absent, and those present but excluded."""
    have = annotations.select(F.explode("evidence").alias("evidence")).where("evidence is not null").distinct()
    want = annotations.sparkSession.createDataFrame([(c,) for c in cfg.keep_evidence], "evidence string")
    absent = want.join(have, "evidence", "left_anti").withColumn("problem", F.lit("configured, absent"))
    return absent.union(have.join(want, "evidence", "left_anti").withColumn("problem", F.lit("present, excluded")))


def verdict(cfg: Config):
    n = F.col("n_pos")
    return F.when(n < cfg.min_pos, "below").when(n > cfg.max_pos, "above").otherwise("ANCHOR")


def funnel(counted: DataFrame, cfg: Config = Config()) -> DataFrame:
    """namespace, terms, eligible (named, kept, not blocked, with any positive), below, above, anchors, max_n."""
    kept = (F.coalesce("name", F.lit("")) != "") & F.col("namespace").isin(*cfg.keep_namespaces) & ~F.col("term").isin(*cfg.blocklist) & (F.col("n_pos") > 0)
    n = lambda v, name: F.count_if(kept & (verdict(cfg) == v)).alias(name)
    return counted.groupBy("namespace").agg(F.count("*").alias("terms"), F.count_if(kept).alias("eligible"), n("below", "below"), n("above", "above"), n("ANCHOR", "anchors"), F.max("n_pos").alias("max_n"))


def terms(counted: DataFrame, k: int | None = None, only: str | None = None, cfg: Config = Config()) -> DataFrame:
    """term, n_pos, verdict (below, above or ANCHOR), largest first; only: one verdict; k: the report's length."""
    rows = counted.select("term", "n_pos", verdict(cfg).alias("verdict"))
    rows = (rows.where(F.col("verdict") == only) if only else rows).orderBy(F.desc("n_pos"), "term")
    return rows.limit(k) if k else rows


def weights(gene_map: DataFrame, pairs: DataFrame, closure: DataFrame | None = None) -> DataFrame:
    """term, n_genes, n_pos: the latter counts each gene as often as it has accessions with text in gene_map(gene, accession).

    closure(term, ancestor): pairs are direct ones and count for the terms' ancestors, too. Genes are weighed before that,
    so that the many pairs with ancestors are exchanged once.
    """
    w = gene_map.groupBy("gene").agg(F.count_distinct("accession").alias("_w"))
    known = pairs.select("gene", "term").distinct().join(w, "gene")
    if closure is not None:
        known = known.join(closure, "term").select("gene", F.col("ancestor").alias("term"), "_w").distinct()
    return known.groupBy("term").agg(F.count("*").alias("n_genes"), F.sum("_w").alias("n_pos"))


def depth_check(hierarchy: DataFrame, terms: DataFrame, depth: int = 20) -> DataFrame:
    """One row: terms whose chain of ancestors reaches `depth` steps."""
    up = hierarchy.select(F.col("child").alias("src"), F.col("parent").alias("dst"))
    return ends_after(up, terms.select(F.col("term").alias("id")), depth).agg(F.count("*").alias("terms_at_depth"))


def sweep(counted: DataFrame, lows: list[int], highs: list[int]) -> DataFrame:
    """min_pos, max_<high> for each: how many terms have min_pos to high positives."""
    sizes = counted.groupBy("n_pos").agg(F.count("*").alias("_n"))
    rows = sizes.withColumn("min_pos", F.explode(F.array(*map(F.lit, lows))))
    n = lambda h: F.coalesce(F.sum(F.when(F.col("n_pos").between(F.col("min_pos"), F.lit(h)), F.col("_n"))), F.lit(0)).alias(f"max_{h}")
    return rows.groupBy("min_pos").agg(*map(n, highs))


#: The least size of each band of terms.
BANDS = (26, 51, 101, 201, 301, 1001)


def bands(counted: DataFrame, corpus: int, cfg: Config = Config()) -> DataFrame:
    """band, terms, triplet_rows (each term's at most pos_per_anchor), median_n_pos (a whole number), pct_corpus, above_ceiling (terms over max_pos)."""
    n = F.col("n_pos")
    edges = [cfg.min_pos, *BANDS]
    band = F.lit(f"{BANDS[-1]}+")
    for lo, hi in reversed(list(zip(edges, BANDS, strict=False))):
        band = F.when(n < hi, f"{lo}-{hi - 1}").otherwise(band)
    rows = counted.where(n >= cfg.min_pos).withColumn("band", band)
    median = F.percentile("n_pos", F.lit(0.5))
    return rows.groupBy("band").agg(
        F.count("*").alias("terms"), F.sum(F.least(n, F.lit(cfg.pos_per_anchor))).alias("triplet_rows"), F.floor(median).alias("median_n_pos"), F.round(100 * median / corpus, 1).alias("pct_corpus"), F.count_if(n > cfg.max_pos).alias("above_ceiling")
    )


def text_coverage(pairs: DataFrame, strong: DataFrame, genes: DataFrame) -> DataFrame:
    """One row: annotated (genes), without_text, strong (genes with strong evidence), strong_lost, strong_lost_pct."""
    have = genes.select("gene", F.lit(True).alias("_t")).distinct()
    all_ = pairs.select("gene").distinct().join(strong.select("gene", F.lit(True).alias("_s")).distinct(), "gene", "left").join(have, "gene", "left")
    lost = F.col("_t").isNull()
    n = all_.agg(F.count("*").alias("annotated"), F.count_if(lost).alias("without_text"), F.count("_s").alias("strong"), F.count_if(lost & F.col("_s")).alias("strong_lost"))
    return n.withColumn("strong_lost_pct", F.round(F.try_divide(100 * F.col("strong_lost"), F.col("strong")), 2))


def gained_below(counted: DataFrame, cfg: Config = Config()) -> DataFrame:
    """min_pos, gained: anchors that each lower min_pos would add; at most min_pos rows."""
    rows = counted.where(F.col("n_pos").between(1, cfg.min_pos - 1)).withColumn("min_pos", F.explode(F.sequence(F.lit(1), F.col("n_pos").cast("int"))))
    return rows.groupBy("min_pos").agg(F.count("*").alias("gained"))


def verify_export(relevant: DataFrame, triplets: DataFrame, cfg: Config = Config()) -> DataFrame:
    """parameter, configured, observed, consistent of an exported data set: relevant(term, gene) of the test terms, and its triplets(term, ...).

    Sizes bound the thresholds: min_pos is at most the least and max_pos at least the greatest; pos_per_anchor is the most
    triplets that a term has.
    """
    sizes = relevant.groupBy("term").agg(F.count("*").alias("n")).agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    rows = triplets.groupBy("term").agg(F.count("*").alias("n")).agg(F.min("n").alias("_lo"), F.max("n").alias("most"))
    one = sizes.join(rows).select(F.least("lo", "_lo").alias("min_pos"), F.col("hi").alias("max_pos"), F.col("most").alias("pos_per_anchor"))
    long = one.unpivot([], ["min_pos", "max_pos", "pos_per_anchor"], "parameter", "observed")
    want = F.when(F.col("parameter") == "min_pos", cfg.min_pos).when(F.col("parameter") == "max_pos", cfg.max_pos).otherwise(cfg.pos_per_anchor)
    ok = F.when(F.col("parameter") == "min_pos", want <= F.col("observed")).when(F.col("parameter") == "max_pos", want >= F.col("observed")).otherwise(want == F.col("observed"))
    return long.select("parameter", want.alias("configured"), "observed", ok.alias("consistent"))
