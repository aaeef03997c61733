"""The derived gene network: rules that turn reactions into directed edges between genes, compounds and assemblies.

All reactions of all pathways are derived in one plan. Tables: parts(pathway_id, reaction_id, entity_id, role),
members(pathway_id, parent_id, child_id), identity(entity_id, reference_id, reference_type: gene or compound),
moieties(entity_id, moiety_id). A node of the network is (label, key): Gene, Compound or Entity. Sets of nodes of a
reaction are tables with pathway_id, reaction_id, label, key.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import reachable
from .store import written

#: Cosubstrates that are consumed but never name an edge (water, protons, ATP and ADP, phosphates, gases, NAD and NADP).
CURRENCY = [
    "chebi:15377", "chebi:15378", "chebi:29888", "chebi:30616", "chebi:456216", "chebi:43474", "chebi:33019",
    "chebi:16526", "chebi:15379", "chebi:57540", "chebi:57945", "chebi:58349", "chebi:57783",
]
REACTION, NODE = ["pathway_id", "reaction_id"], ["label", "key"]
SIGNS = {"inhibitor": "negative", "stimulator": "positive"}
EDGE = ["source_id", "target_id", "source_label", "target_label", "mechanism", "sign", "via"]


def role(parts: DataFrame, *names: str) -> DataFrame:
    """Distinct (pathway_id, reaction_id, entity_id) of the participants with one of these roles."""
    return parts.where(F.col("role").isin(*names)).select(*REACTION, "entity_id").distinct()


def closures(members: DataFrame, seeds: DataFrame) -> DataFrame:
    """pathway_id, seed, id: each seed(pathway_id, entity_id) and every entity below it in its pathway."""
    edges = members.select("pathway_id", F.col("parent_id").alias("src"), F.col("child_id").alias("dst"))
    return reachable(edges, seeds.select("pathway_id", F.col("entity_id").alias("seed")).distinct(), by=("pathway_id",))


def carriers(identity: DataFrame, currency: list[str] | None = None) -> DataFrame:
    """id, label, key: the gene or compound that an entity is; a container has none of its own, and currency compounds are left out."""
    label = F.when(F.col("reference_type") == "gene", "Gene").when(F.col("reference_type") == "compound", "Compound")
    own = identity.select(F.col("entity_id").alias("id"), label.alias("label"), F.col("reference_id").alias("key")).where("label is not null and key is not null")
    return own.where(~((F.col("label") == "Compound") & F.col("key").isin(CURRENCY if currency is None else currency))).distinct()


def carried(closure: DataFrame, own: DataFrame) -> DataFrame:
    """closure(..., id) -> its other columns with label, key: what the entities carry directly, each once."""
    rest = [c for c in closure.columns if c != "id"]
    return closure.join(own, "id").select(*rest, *NODE).distinct()


def below(parts: DataFrame, closure: DataFrame) -> DataFrame:
    """The participants with id, every entity in their closure."""
    return parts.join(closure.withColumnRenamed("seed", "entity_id"), ["pathway_id", "entity_id"])


def moiety_seeds(parts: DataFrame, members: DataFrame, moieties: DataFrame) -> DataFrame:
    """pathway_id, entity_id: the moieties of all entities that a pathway names; those of what its closures hold are among them."""
    named = parts.select("pathway_id", "entity_id").union(members.select("pathway_id", "parent_id")).union(members.select("pathway_id", "child_id")).distinct()
    return named.join(moieties.select("entity_id", "moiety_id").distinct(), "entity_id").select("pathway_id", F.col("moiety_id").alias("entity_id")).distinct()


def held(parts: DataFrame, nodes: DataFrame) -> DataFrame:
    """The participants with what they carry, nodes(pathway_id, seed, label, key): entities are not listed for each participant."""
    return parts.join(nodes.withColumnRenamed("seed", "entity_id"), ["pathway_id", "entity_id"])


def donated(parts: DataFrame, closure: DataFrame, members: DataFrame | None, moieties: DataFrame, own: DataFrame) -> DataFrame:
    """Genes that a reaction attaches to its products: those in the closures of the moieties of anything in a product's closure.

    Without members, closure holds those of the moieties (see moiety_seeds) already. What an entity donates is worked out
    once for a pathway, not for each reaction that makes it.
    """
    made = role(parts, "product")
    seeds = made.select("pathway_id", F.col("entity_id").alias("seed")).distinct()
    attached = closure.join(seeds, ["pathway_id", "seed"], "left_semi").join(moieties.select(F.col("entity_id").alias("id"), "moiety_id").distinct(), "id")
    attached = attached.select("pathway_id", F.col("seed").alias("entity_id"), "moiety_id").distinct()
    inside = closure if members is None else closures(members, attached.select("pathway_id", F.col("moiety_id").alias("entity_id")))
    genes = carried(inside, own.where("label = 'Gene'")).withColumnRenamed("seed", "moiety_id")
    given = attached.join(genes, ["pathway_id", "moiety_id"]).select("pathway_id", "entity_id", *NODE).distinct()
    return made.join(given, ["pathway_id", "entity_id"]).select(*REACTION, *NODE).distinct()


def changed(parts: DataFrame, closure: DataFrame) -> DataFrame:
    """pathway_id, reaction_id, id: entities in the closures of the reactants and in none of the products'."""
    sides = below(parts.where(F.col("role").isin("reactant", "product")), closure)
    return sides.groupBy(*REACTION, "id").agg(F.bool_and(F.col("role") == "reactant").alias("_gone")).where("_gone").drop("_gone")


def acted_on(parts: DataFrame, nodes: DataFrame, changes: DataFrame, gifts: DataFrame, own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(main, fallback), both written: what a reaction works on. nodes(pathway_id, seed, label, key): what entities carry.

    main: what its changed entities carry, less what is donated. fallback, for reactions without: what reactants carry,
    less what is donated, with entity_id, the reactant that carries it, so that a catalyst that is a reactant can be left out.
    """
    main = written(carried(changes, own).join(gifts, [*REACTION, *NODE], "left_anti"), "main")
    rest = held(role(parts, "reactant").join(main.select(*REACTION).distinct(), REACTION, "left_anti"), nodes)
    return main, written(rest.join(gifts, [*REACTION, *NODE], "left_anti").select(*REACTION, "entity_id", *NODE), "fallback")


def enzymes(parts: DataFrame, closure: DataFrame, nodes: DataFrame, changes: DataFrame, own: DataFrame) -> DataFrame:
    """Genes of each catalyst but those that it carries in entities that the reaction changes. nodes: as in acted_on."""
    cats = role(parts, "catalyst")
    spent = carried(below(cats, closure).join(changes, [*REACTION, "id"], "left_semi"), own.where("label = 'Gene'"))
    left = held(cats, nodes.where("label = 'Gene'")).join(spent, [*REACTION, "entity_id", *NODE], "left_anti")
    return left.select(*REACTION, *NODE).distinct()


def gene_sets(nodes: DataFrame) -> DataFrame:
    """pathway_id, entity_id, genes: the sorted genes that an entity carries, of nodes(pathway_id, seed, label, key)."""
    found = nodes.where("label = 'Gene'").withColumnRenamed("seed", "entity_id")
    return found.groupBy("pathway_id", "entity_id").agg(F.array_sort(F.collect_set("key")).alias("genes"))


def as_assembly(target: DataFrame, candidates: DataFrame, sets: DataFrame, by: list[str]) -> DataFrame:
    """target(by, label, key), where two genes or more, and no compound, are just what a candidate(by, entity_id) holds: that entity (the least id) instead."""
    is_gene = F.col("label") == "Gene"
    whole = target.groupBy(*by).agg(F.array_sort(F.collect_set(F.when(is_gene, F.col("key")))).alias("genes"), F.bool_and(is_gene).alias("_pure")).where("_pure and size(genes) >= 2").drop("_pure")
    found = whole.join(candidates, by).join(sets, ["pathway_id", "entity_id", "genes"]).groupBy(*by).agg(F.min("entity_id").alias("key"))
    return target.join(found.select(by), by, "left_anti").select(*by, *NODE).unionByName(found.select(*by, F.lit("Entity").alias("label"), "key"))


def crossed(sources: DataFrame, targets: DataFrame, mechanism: str, rows_per_task: int = 1024) -> DataFrame:
    """Each source node of a reaction with each target node; sources may have sign and via.

    The sources of a reaction that has more than rows_per_task are dealt over tasks by that number, and only such a
    reaction's targets are copied to them.
    """
    s = sources.withColumnsRenamed({"label": "source_label", "key": "source_id"})
    t = targets.select(*REACTION, F.col("label").alias("target_label"), F.col("key").alias("target_id"))
    for c in ("sign", "via"):
        if c not in s.columns:
            s = s.withColumn(c, F.lit(None).cast("string"))
    s = written(s, "sources")
    large = s.groupBy(*REACTION).agg(F.count("*").alias("_n")).where(F.col("_n") > rows_per_task)
    large = written(large.select(*REACTION, F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_salts")), "large")
    salts = F.coalesce("_salts", F.lit(1))
    s = s.join(large, REACTION, "left").withColumn("_salt", F.pmod(F.xxhash64("source_id", "via"), salts).cast("int"))
    t = t.join(large, REACTION, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return s.join(t, [*REACTION, "_salt"]).withColumn("mechanism", F.lit(mechanism)).select(*REACTION, *EDGE)


def minus(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.join(b.select(*REACTION, *NODE), [*REACTION, *NODE], "left_anti")


class Reactions:
    """What the rules share: closures, carriers, changes, donations, targets, enzymes and gene sets of all reactions.

    Each is made when a rule first asks for it, and written once.
    """

    def __init__(self, parts: DataFrame, members: DataFrame, identity: DataFrame, moieties: DataFrame, currency: list[str] | None = None):
        self.parts = written(parts.select(*REACTION, "entity_id", "role").distinct(), "parts")
        self.members, self.moieties = members, moieties
        self.own = carriers(identity, currency)

    @cached_property
    def closure(self) -> DataFrame:
        """Of participants and of moieties, in one go."""
        return closures(self.members, self.parts.select("pathway_id", "entity_id").union(moiety_seeds(self.parts, self.members, self.moieties)))

    @cached_property
    def nodes(self) -> DataFrame:
        """pathway_id, seed, label, key: what each seed of the closure carries."""
        return written(carried(self.closure, self.own), "nodes")

    @cached_property
    def changes(self) -> DataFrame:
        return written(changed(self.parts, self.closure), "changes")

    @cached_property
    def gifts(self) -> DataFrame:
        return written(donated(self.parts, self.closure, None, self.moieties, self.own), "gifts")

    @cached_property
    def _acted_on(self) -> tuple[DataFrame, DataFrame]:
        return acted_on(self.parts, self.nodes, self.changes, self.gifts, self.own)

    @property
    def main(self) -> DataFrame:
        return self._acted_on[0]

    @property
    def fallback(self) -> DataFrame:
        return self._acted_on[1]

    @cached_property
    def enzymes(self) -> DataFrame:
        return written(enzymes(self.parts, self.closure, self.nodes, self.changes, self.own), "enzymes")

    @cached_property
    def sets(self) -> DataFrame:
        return written(gene_sets(self.nodes), "sets")

    def candidates(self, exclude_catalyst: bool) -> DataFrame:
        """Entities that may name a target: reactants and products where something changed, else reactants; with exclude_catalyst, for each catalyst c, and c is none."""
        some = self.main.select(*REACTION).distinct()
        wide = role(self.parts, "reactant", "product").join(some, REACTION, "left_semi")
        narrow = role(self.parts, "reactant").join(some, REACTION, "left_anti")
        if not exclude_catalyst:
            return wide.union(narrow)
        cats = role(self.parts, "catalyst").withColumnRenamed("entity_id", "c")
        return wide.join(cats, REACTION).unionByName(narrow.join(cats, REACTION).where("entity_id <> c")).select(*REACTION, "c", "entity_id")


def catalysis(r: Reactions) -> DataFrame:
    """Enzyme genes act on what the reaction works on, themselves excepted."""
    by = [*REACTION, "c"]
    cats = role(r.parts, "catalyst").withColumnRenamed("entity_id", "c")
    worked = r.main.join(cats, REACTION).select(*by, *NODE).unionByName(r.fallback.join(cats, REACTION).where("entity_id <> c").select(*by, *NODE).distinct())
    targets = as_assembly(minus(worked, r.enzymes).select(*by, *NODE), r.candidates(True), r.sets, by)
    return crossed(r.enzymes, targets.select(*REACTION, *NODE).distinct(), "catalysis")


def regulation(r: Reactions) -> DataFrame:
    """What regulators carry acts on the enzyme, or without one on what the reaction works on; the sign is the role's."""
    with_enzyme = r.enzymes.select(*REACTION).distinct()
    plain = r.main.unionByName(r.fallback.select(*REACTION, *NODE).distinct()).join(with_enzyme, REACTION, "left_anti")
    targets = as_assembly(r.enzymes, role(r.parts, "catalyst"), r.sets, REACTION).unionByName(as_assembly(plain, r.candidates(False), r.sets, REACTION))
    sign = F.when(F.col("role") == "inhibitor", SIGNS["inhibitor"]).otherwise(SIGNS["stimulator"])
    agents = held(r.parts.where(F.col("role").isin(*SIGNS)).withColumn("sign", sign).drop("role"), r.nodes)
    return crossed(minus(agents, r.enzymes.unionByName(plain)).select(*REACTION, *NODE, "sign").distinct(), targets, "regulation")


def association(r: Reactions) -> DataFrame:
    """Without a modifier, and of two reactants or more: what each reactant carries joins each product, via that reactant."""
    alone = role(r.parts, "reactant").groupBy(*REACTION).agg(F.count("*").alias("_n")).where("_n >= 2").select(*REACTION)
    alone = alone.join(role(r.parts, "catalyst", *SIGNS).select(*REACTION), REACTION, "left_anti")
    joined = held(role(r.parts, "reactant").join(alone, REACTION, "left_semi"), r.nodes).withColumnRenamed("entity_id", "via")
    made = role(r.parts, "product").select(*REACTION, F.lit("Entity").alias("label"), F.col("entity_id").alias("key"))
    return crossed(joined, made, "association")


def emit(edges: DataFrame) -> DataFrame:
    """Distinct edges with rel_type; edges of a node to itself and between compounds are dropped."""
    rel = F.when(F.col("mechanism") == "association", "ASSOCIATED_WITH").when((F.col("source_label") == "Compound") | (F.col("target_label") == "Compound"), "ACTS_ON_CHEMICAL").otherwise("ACTS_ON")
    own = (F.col("source_id") == F.col("target_id")) & (F.col("source_label") == F.col("target_label"))
    chemical = (F.col("source_label") == "Compound") & (F.col("target_label") == "Compound")
    return edges.where(~own & ~chemical).withColumn("rel_type", rel).distinct()


def collapse(edges: DataFrame) -> DataFrame:
    """One row per pathway, ends, rel_type, mechanism, sign and via; weight: distinct reactions, 1 at least; reaction_id: the smallest."""
    return edges.groupBy("pathway_id", *EDGE, "rel_type").agg(F.min("reaction_id").alias("reaction_id"), F.greatest(F.count_distinct("reaction_id"), F.lit(1)).alias("weight"))


def derive_all(parts: DataFrame, members: DataFrame, identity: DataFrame, moieties: DataFrame, pathways: DataFrame | None = None, currency: list[str] | None = None) -> DataFrame:
    """The whole network of all pathways, or of those in pathways(pathway_id); to be merged by cdc.merge_identity with pathway_id as its scope."""
    if pathways is not None:
        parts, members = (df.join(pathways.select("pathway_id").distinct(), "pathway_id", "left_semi") for df in (parts, members))
    r = Reactions(parts, members, identity, moieties, currency)
    return collapse(emit(catalysis(r).unionByName(regulation(r)).unionByName(association(r))))
