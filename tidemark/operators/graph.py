"""Property graphs as node and edge tables: nodes(label, id, props), edges(src, dst, label, props, pathway_ids).

A node is known by its label and id. Edges may name the labels of their ends (src_label, dst_label), and then two nodes of
one id are told apart; without these columns an end is any node of its id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import Growing, erase, written

EDGE = ["src", "dst", "label"]
END_LABELS = ("src_label", "dst_label")


def edge_key(edges: DataFrame) -> list[str]:
    return [*EDGE, *(c for c in END_LABELS if c in edges.columns)]


def ends(edges: DataFrame, nodes: DataFrame, how: str) -> DataFrame:
    """edges by a left_semi or left_anti join of each end with nodes(label, id)."""
    for side in ("src", "dst"):
        named = f"{side}_label" in edges.columns
        key = nodes.select(F.col("id").alias(side), *([F.col("label").alias(f"{side}_label")] if named else [])).distinct()
        edges = edges.join(key, key.columns, how).select(edges.columns)
    return edges


def no_props() -> Column:
    return F.create_map().cast("map<string,string>")


def overwritten(old: Column | str, new: Column | str) -> Column:
    """The map `old` with the non-null values of `new` over it; null maps are empty."""
    old, new = F.coalesce(old, no_props()), F.map_filter(F.coalesce(new, no_props()), lambda k, v: v.isNotNull())
    return F.map_concat(F.map_filter(old, lambda k, v: ~F.map_contains_key(new, k)), new)


def upsert_nodes(nodes: DataFrame, new: DataFrame) -> DataFrame:
    """Merges on (label, id): non-null new properties overwrite, others stay. `new` has each (label, id) once."""
    both = nodes.select("label", "id", "props").join(new.select("label", "id", F.col("props").alias("_new")), ["label", "id"], "full_outer")
    return both.select("label", "id", overwritten("props", "_new").alias("props"))


def delete_nodes(nodes: DataFrame, edges: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables without the nodes of gone(label, id) and their edges.

    A node of the same id and another label stays, and so do its edges where edges name the labels of their ends; where they
    do not, an edge goes unless each of its ends still names some node that was not deleted.
    """
    gone = gone.select("label", "id").distinct()
    kept = nodes.join(gone, ["label", "id"], "left_anti").select(nodes.columns)
    for side in ("src", "dst"):
        if f"{side}_label" in edges.columns:
            lost = gone.select(F.col("id").alias(side), F.col("label").alias(f"{side}_label"))
        else:
            lost = gone.select("id").distinct().join(kept.select("id").distinct(), "id", "left_anti").withColumnRenamed("id", side)
        edges = edges.join(lost, lost.columns, "left_anti").select(edges.columns)
    return kept, edges


def upsert_edges(edges: DataFrame, new: DataFrame, nodes: DataFrame, order: list[str] | None = None) -> DataFrame:
    """One edge per (src, label, dst) and, where named, labels of the ends; rows of `new`(src, dst, label, pathway_id, props) without both endpoints are dropped.

    The support set grows; the last row's properties, by the columns `order` (else by the properties as text), overwrite
    the old ones. A table without props has empty ones.
    """
    with_props = lambda df: df if "props" in df.columns else df.withColumn("props", no_props())
    new, edges = with_props(new), with_props(edges)
    fit, key = ends(new, nodes, "left_semi"), edge_key(edges)
    place = F.struct(*(order or []), F.to_json("props"))
    fresh = fit.groupBy(*key).agg(F.max_by("props", place).alias("_new"), F.collect_set("pathway_id").alias("_more"))
    both = edges.select(*key, "props", "pathway_ids").join(fresh, key, "full_outer")
    none = F.array().cast("array<string>")
    support = F.array_sort(F.array_union(F.coalesce("pathway_ids", none), F.coalesce("_more", none)))
    return both.select(*key, overwritten("props", "_new").alias("props"), support.alias("pathway_ids"))


def delete_edges(edges: DataFrame, gone: DataFrame) -> DataFrame:
    """Takes pathways of gone(src, dst, label, pathway_id) out of the support sets; an edge without support goes."""
    key = edge_key(edges)
    drop = gone.groupBy(*key).agg(F.collect_set("pathway_id").alias("_gone"))
    left = edges.join(drop, key, "left").withColumn("pathway_ids", F.when(F.col("_gone").isNull(), F.col("pathway_ids")).otherwise(F.array_except("pathway_ids", "_gone")))
    return left.where("_gone is null or size(pathway_ids) > 0").select(edges.columns)


def replay_diff(nodes: DataFrame, edges: DataFrame, node_diff: DataFrame, edge_diff: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) after a run's diffs: node_diff(label, id, props, action), edge_diff(src, dst, label, pathway_id, props, action).

    Deleted nodes go with their edges; inserted and updated ones are upserted before the edges that need them; an edge is
    taken out of the pathways of its deletions, then put into those of its insertions.
    """
    kept, rest = delete_nodes(nodes, edges, node_diff.where("action = 'DELETE'"))
    kept = upsert_nodes(kept, node_diff.where("action <> 'DELETE'").select("label", "id", "props"))
    rest = delete_edges(rest, edge_diff.where("action = 'DELETE'"))
    return kept, upsert_edges(rest, edge_diff.where("action <> 'DELETE'").drop("action"), kept)


def annotate_nodes(nodes: DataFrame, annotations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, counts): annotations(label, id, props[, action]) overwrite properties of nodes that are there; deletions are ignored.

    counts: one row of offered and matched annotations.
    """
    if "action" in annotations.columns:
        annotations = annotations.where("action is null or action <> 'DELETE'").drop("action")
    patch = annotations.groupBy("label", "id").agg(F.max_by("props", F.to_json("props")).alias("_new"), F.count("*").alias("_n"))
    found = patch.join(nodes.select("label", "id", F.lit(True).alias("_there")), ["label", "id"], "left")
    counts = found.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("offered"), F.coalesce(F.sum(F.when(F.col("_there"), F.col("_n"))), F.lit(0)).alias("matched"))
    out = nodes.join(patch, ["label", "id"], "left").select("label", "id", overwritten("props", "_new").alias("props"))
    return out, counts


def ontology_annotations(annotations: DataFrame, genes: DataFrame, terms: DataFrame) -> DataFrame:
    """annotations(symbol, accession, qualifier, term, evidence) -> gene, qualifier, term, evidence (sorted, without repeats).

    Genes(id, symbol, uniprot_ids) are found by symbol or by accession: two equi joins, so that neither becomes a nested
    loop. ':' in term ids becomes '_'; terms that are not in terms(term) drop out.
    """
    known = annotations.withColumn("term", F.replace("term", F.lit(":"), F.lit("_"))).join(terms.select("term").distinct(), "term", "left_semi")
    by_symbol = known.join(genes.where("symbol is not null").select(F.col("id").alias("gene"), "symbol"), "symbol")
    ids = genes.select(F.col("id").alias("gene"), F.explode("uniprot_ids").alias("accession"))
    by_accession = known.join(ids, "accession")
    cols = ["gene", "qualifier", "term", "evidence"]
    found = by_symbol.select(cols).union(by_accession.select(cols)).distinct()
    return found.groupBy("gene", "qualifier", "term").agg(F.array_sort(F.collect_set("evidence")).alias("evidence"))


def size(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """kind, label, n for nodes and edges."""
    one = lambda df, kind: df.groupBy("label").agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "label", "n")
    return one(nodes, "node").union(one(edges, "edge"))


def jumps(edges: DataFrame, key: list[str]) -> list[DataFrame]:
    """Tables (key, dst) by k: where 2**k steps lead from nodes whose next 2**k steps leave no choice. key names a node; edges are distinct."""
    single = edges.groupBy(*key).agg(F.min("dst").alias("dst"), F.count("*").alias("_n")).where("_n = 1").drop("_n")
    out = [written(single, "jumps")]
    most = out[0].count()  # no stretch is longer
    while 1 << len(out) <= most:
        ahead = out[-1].select(*key[:-1], F.col(key[-1]).alias("dst"), F.col("dst").alias("_to"))
        further = written(out[-1].join(ahead, [*key[:-1], "dst"]).select(*key, F.col("_to").alias("dst")), "jumps")
        if further.isEmpty():
            erase(further)
            break
        out.append(further)
    return out


def closure(edges: DataFrame, starts: DataFrame, name: str, by: list[str], mark: list[str], max_depth: int | None = None, plain_rounds: int = 16) -> Growing:
    """All (by, mark, name) that starts(by, mark, name) reach by edges(by, name, dst), each written once.

    Each round extends what the last one found, less what is known. After plain_rounds such rounds, stretches without a
    choice are passed at once: tables of 1, 2, 4, ... steps ahead (see `jumps`) give all places on them in as many joins as
    the length has binary digits, so a long chain or cycle costs no round a node. Branching at every step still does.
    """
    key, known, depth = [*by, *mark, name], Growing(starts.sparkSession, "reached"), 0
    frontier, ahead = known.add(starts.select(key).distinct()), None
    while not frontier.isEmpty() and (max_depth is None or depth < max_depth):
        step = frontier.join(edges, [*by, name]).select(*by, *mark, F.col("dst").alias(name)).distinct()
        if max_depth is None and depth >= plain_rounds:
            ahead = jumps(edges, [*by, name]) if ahead is None else ahead
            for table in reversed(ahead):
                further = step.join(table, [*by, name]).select(*by, *mark, F.col("dst").alias(name))
                longer = written(step.union(further).distinct(), "along")
                if hasattr(step, "written_at"):
                    erase(step)
                step = longer
        frontier, depth = known.add(step.join(known.all(), key, "left_anti").select(key)), depth + 1
        if hasattr(step, "written_at"):
            erase(step)
    erase(*(ahead or []))
    known.rounds = depth
    return known


def reachable(edges: DataFrame, seeds: DataFrame, max_depth: int | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """edges(src, dst), seeds(seed) -> (seed, id): all that a seed reaches, itself included. Cycles are safe.

    by: columns that both tables have and within which paths stay. See `closure` for how.
    """
    by = list(by)
    edges = edges.select(*by, F.col("src").alias("id"), "dst").distinct()
    return closure(edges, seeds.select(*by, "seed", F.col("seed").alias("id")), "id", by, ["seed"], max_depth).all()


def reached(edges: DataFrame, starts: DataFrame) -> Growing:
    """edges(src, dst), starts(id) -> (id): what any start reaches. One mark a node, whichever start it comes from."""
    return closure(edges.select(F.col("src").alias("id"), "dst").distinct(), starts, "id", [], [])


def expand_bounded(edges: DataFrame, seeds: DataFrame, lo: int, hi: int, labels: list[str] | None = None) -> DataFrame:
    """(seed, id): distinct ends of paths of lo to hi edges from each seed; labels: of edges with one of these labels alone.

    The ends at each depth are written and extended from there, so no plan holds more than one step, whatever hi is; it
    stops once no path goes on.
    """
    step = (edges.where(F.col("label").isin(labels)) if labels else edges).select(F.col("src").alias("id"), "dst").distinct()
    now = written(seeds.select("seed", F.col("seed").alias("id")).distinct(), "depth")
    found = Growing(now.sparkSession, "expanded")
    found.add(now if lo == 0 else now.limit(0))
    for depth in range(1, hi + 1):
        further, old = now.join(step, "id").select("seed", F.col("dst").alias("id")).distinct(), now
        now = written(further, "depth") if depth < lo else found.add(further)
        if hasattr(old, "written_at"):  # not a part of what is found
            erase(old)
        if now.isEmpty():
            break
    return found.all().distinct()


def ends_after(edges: DataFrame, starts: DataFrame, depth: int) -> DataFrame:
    """starts(id) from which some path of `depth` edges(src, dst) leads on; nodes may come again.

    Nodes that have a path of d edges are those with an edge to one that has a path of d - 1: a set of nodes for each depth,
    not of pairs. The sets shrink; once one equals the one before, the rest do.
    """
    step = edges.select(F.col("src").alias("id"), F.col("dst")).distinct()
    far, size = None, -1
    for _ in range(depth):
        nodes = step if far is None else step.join(far.withColumnRenamed("id", "dst"), "dst", "left_semi")
        old, far = far, written(nodes.select("id").distinct(), "far")
        if old is not None:
            erase(old)
        last, size = size, far.count()
        if size == last or not size:
            break
    return starts.select("id").distinct() if far is None else starts.select("id").distinct().join(far, "id", "left_semi")


def forms_of(identity: DataFrame, entities: DataFrame, genes: DataFrame, limit: int = 25) -> DataFrame:
    """gene, entity_id, display_name: the first `limit` physical states of each gene of genes(gene), by entity_id; the report has that limit in the reference, too."""
    forms = identity.select("entity_id", F.col("reference_id").alias("gene")).join(genes.select("gene").distinct(), "gene", "left_semi")
    named = forms.join(entities.select("entity_id", "display_name"), "entity_id").distinct()
    first = F.array_sort(F.collect_set(F.struct("entity_id", "display_name")))
    return named.groupBy("gene").agg(F.slice(first, 1, limit).alias("_f")).select("gene", F.inline("_f"))


def reaction_card(parts: DataFrame) -> DataFrame:
    """parts(reaction_id, entity_id, role) -> sorted distinct reactants, products and catalysts of each reaction."""
    pick = lambda role: F.array_sort(F.collect_set(F.when(F.col("role") == role, F.col("entity_id")))).alias(f"{role}s")
    return parts.groupBy("reaction_id").agg(*map(pick, ("reactant", "product", "catalyst")))


def pathway_sizes(members: DataFrame, k: int) -> DataFrame:
    return members.groupBy("pathway_id").agg(F.count_distinct("entity_id").alias("n")).orderBy(F.desc("n"), "pathway_id").limit(k)


def gene_gene(edges: DataFrame, genes_of: DataFrame) -> DataFrame:
    """a, b: edges(src, dst) with assemblies replaced by their genes, genes_of(assembly, gene); no self-pairs."""
    one = lambda side, out: genes_of.select(F.col("assembly").alias(side), F.col("gene").alias(out))
    open_ = edges.select("src", "dst").distinct().join(one("src", "_a"), "src", "left").join(one("dst", "_b"), "dst", "left")
    return open_.select(F.coalesce("_a", "src").alias("a"), F.coalesce("_b", "dst").alias("b")).where("a <> b").distinct()


def co_assembly_pairs(assoc: DataFrame, salts: int = 16) -> DataFrame:
    """assoc(gene, assembly, via) -> pairs a < b that meet in one assembly by different `via`.

    Two genes meet unless both come by one and the same `via`: the least and the greatest of each gene's tell that, so the
    join has a row per gene and assembly, and not per way in. One side of each assembly is dealt over `salts` tasks, the other
    is copied to them; the answer itself has as many rows as there are pairs.
    """
    ways = assoc.groupBy("gene", "assembly").agg(F.min("via").alias("lo"), F.max("via").alias("hi"))
    a = ways.select(F.col("gene").alias("a"), "assembly", F.col("lo").alias("la"), F.col("hi").alias("ha"), F.pmod(F.xxhash64("gene"), F.lit(salts)).alias("_salt"))
    b = ways.select(F.col("gene").alias("b"), "assembly", F.col("lo").alias("lb"), F.col("hi").alias("hb"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    return a.join(b, ["assembly", "_salt"]).where("a < b and (la <> hb or lb <> ha)").select("a", "b").distinct()


def store_overlap(left: DataFrame, right: DataFrame, every_right: bool = False) -> DataFrame:
    """Ids in both tables, and in one alone; every_right: an error if a right one (a record) has no left one (its gene)."""
    both = left.select("id", F.lit(1).alias("l")).distinct().join(right.select("id", F.lit(1).alias("r")).distinct(), "id", "full_outer")
    n = both.agg(F.count_if(F.col("l").isNotNull() & F.col("r").isNotNull()).alias("both"), F.count_if(F.col("r").isNull()).alias("only_left"), F.count_if(F.col("l").isNull()).alias("only_right"))
    if every_right:
        n = n.withColumn("only_right", F.when(F.col("only_right") > 0, F.raise_error("records without a gene").cast("long")).otherwise(F.col("only_right")))
    return n


def grounded_hits(annotations: DataFrame, records: DataFrame, hits: DataFrame) -> DataFrame:
    """term, annotated (genes that have text), found (those among the query's hits), best_rank; hits(query_id, id, rank), a query being a term."""
    with_text = annotations.select("term", "gene").distinct().join(records.select(F.col("id").alias("gene")).distinct(), "gene", "left_semi")
    ranked = hits.select(F.col("query_id").alias("term"), F.col("id").alias("gene"), "rank")
    both = with_text.join(ranked, ["term", "gene"], "left")
    return both.groupBy("term").agg(F.count("*").alias("annotated"), F.count("rank").alias("found"), F.min("rank").alias("best_rank"))
