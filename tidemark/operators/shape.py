"""Records of pathway databases shaped into rows: types, names, identities, memberships, nodes and edges.

Objects are rows as the sources give them: object_id, class_name, display_name, compartments, names, gene_names,
identifier, database, ... Each function is an expression, or a function of such tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import no_props, reached

#: Classes of physical entities and events, and the type of each.
ENTITY_TYPES = {
    "EntityWithAccessionedSequence": "ewas", "Complex": "complex", "DefinedSet": "defined_set", "CandidateSet": "candidate_set", "Polymer": "polymer",
    "SimpleEntity": "simple_entity", "OtherEntity": "other_entity", "GenomeEncodedEntity": "genome_encoded_entity", "Cell": "cell", "ChemicalDrug": "drug", "ProteinDrug": "drug", "RNADrug": "drug",
    "Reaction": "reaction", "BlackBoxEvent": "reaction", "Polymerisation": "reaction", "Depolymerisation": "reaction", "FailedReaction": "reaction", "CellDevelopmentStep": "reaction",
    "Pathway": "pathway", "TopLevelPathway": "pathway", "CellLineagePath": "pathway",
}
#: Databases with a prefix of their own, slots that hold children, classes that are chemicals.
PREFIXES = {"chebi": "chebi", "guide to pharmacology": "gtp", "guide to pharmacology - ligands": "gtp", "pubchem compound": "pubchem", "pubchem substance": "pubchemsub"}
SLOTS = ("hasComponent", "hasMember", "hasCandidate", "repeatedUnit")
CHEMICAL_CLASSES = ("SimpleEntity", "ChemicalDrug", "ProteinDrug", "RNADrug", "Polymer")


def mapped(c: Column, values: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for kv in values.items() for x in kv))[c]


def entity_type(class_name: Column) -> Column:
    """The type of a class; an unknown class is an error, null stays null."""
    found = mapped(class_name, ENTITY_TYPES)
    return F.when(class_name.isNotNull() & found.isNull(), F.raise_error(F.concat(F.lit("unknown class "), class_name)).cast("string")).otherwise(found)


def first_of(names: Column, default: Column) -> Column:
    return F.coalesce(F.get(names, F.lit(0)), default)


def rest_of(names: Column, sep: str) -> Column:
    """All but the first, joined; null without any."""
    return F.nullif(F.array_join(F.slice(names, 2, F.greatest(F.size(names) - 1, F.lit(0))), sep), F.lit(""))


def entity_data(objects: DataFrame) -> DataFrame:
    """entity_id, display_name without a compartment in brackets at its end, compartment (the first)."""
    name = F.coalesce(F.nullif("display_name", F.lit("")), "object_id")
    return objects.select(F.col("object_id").alias("entity_id"), F.regexp_replace(name, r"\s*\[[^\[\]]*\]$", "").alias("display_name"), F.get("compartments", F.lit(0)).alias("compartment"))


def gene(objects: DataFrame) -> DataFrame:
    """uniprot_id, gene_name (the first, else the identifier), full_name (else undefined), gene_synonym (the rest), ensembl_gene."""
    names = F.col("gene_names")
    return objects.select(F.col("identifier").alias("uniprot_id"), first_of(names, F.col("identifier")).alias("gene_name"), first_of(F.col("names"), F.lit("undefined")).alias("full_name"), rest_of(names, ", ").alias("gene_synonym"), "ensembl_gene")


def compound(objects: DataFrame) -> DataFrame:
    """compound_id, compound_name, formula, compound_synonyms."""
    names = F.col("names")
    return objects.select(F.col("identifier").alias("compound_id"), first_of(names, F.coalesce("display_name", F.lit("undefined"))).alias("compound_name"), "formula", rest_of(names, "; ").alias("compound_synonyms"))


def drug(objects: DataFrame) -> DataFrame:
    """drug_id, drug_name, drug_type (the class)."""
    return objects.select(F.col("identifier").alias("drug_id"), F.coalesce("display_name", F.lit("undefined")).alias("drug_name"), F.coalesce("class_name", F.lit("ChemicalDrug")).alias("drug_type"))


def pathway(objects: DataFrame) -> DataFrame:
    return objects.select(F.col("object_id").alias("pathway_id"), F.coalesce("display_name", F.lit("")).alias("description"))


def reaction(objects: DataFrame) -> DataFrame:
    """reaction_id, name, compartment, reaction_type (the class), pathway_id."""
    kind = F.coalesce("class_name", F.lit("Reaction"))
    return objects.select(F.col("object_id").alias("reaction_id"), F.coalesce("display_name", "object_id").alias("name"), F.get("compartments", F.lit(0)).alias("compartment"), kind.alias("reaction_type"), "pathway_id")


# Flat-file records: a map of upper-case keys to text.


def _first_word(c: Column) -> Column:
    return F.regexp_extract(c, r"^\s*(\S+)", 1)


def _record(r: Column, key: str, default: str | None = None) -> Column:
    return r[key] if default is None else F.coalesce(r[key], F.lit(default))


def _weight(r: Column) -> Column:
    return F.round(F.coalesce(r["MOL_WEIGHT"].cast("double"), _first_word(r["MASS"]).try_cast("double"), F.lit(0.0)), 2)


def kegg_gene(r: Column) -> Column:
    """struct(gene_name, uid, full_name, gene_synonym): the symbols' first and the others; LOC and the entry without any."""
    symbols = F.transform(F.split(F.coalesce(r["SYMBOL"], F.concat(F.lit("LOC"), r["ENTRY"])), ","), lambda x: F.trim(x))
    others = F.array_join(F.slice(symbols, 2, F.greatest(F.size(symbols) - 1, F.lit(0))), ", ")
    return F.struct(F.get(symbols, F.lit(0)).alias("gene_name"), _first_word(r["ENTRY"]).try_cast("int").alias("uid"), F.trim(F.replace(r["NAME"], F.lit("(RefSeq)"), F.lit(""))).alias("full_name"), others.alias("gene_synonym"))


def _kegg_substance(r: Column, prefix: str) -> Column:
    names = F.split(r["NAME"], ";")
    several = F.size(names) > 1
    name = F.when(r["NAME"].isNull(), "NA").when(several, F.trim(F.get(names, F.lit(0)))).otherwise(r["NAME"])
    others = F.when(several, F.array_join(F.slice(names, 2, F.greatest(F.size(names) - 1, F.lit(0))), ";")).otherwise("NA")
    return F.struct(_first_word(r["ENTRY"]).alias(f"{prefix}_id"), name.alias(f"{prefix}_name"), F.coalesce(r["FORMULA"], r["COMPOSITION"], F.lit("NA")).alias("formula"), others.alias(f"{prefix}_synonyms"), _weight(r).alias("mol_weight"))


def kegg_compound(r: Column) -> Column:
    """struct(compound_id, compound_name, formula, compound_synonyms, mol_weight): NA for what is missing, 0 for the weight."""
    return _kegg_substance(r, "compound")


def kegg_drug(r: Column) -> Column:
    return _kegg_substance(r, "drug")


def kegg_glycan(r: Column) -> Column:
    mass = F.round(F.coalesce(_first_word(r["MASS"]).try_cast("double"), F.lit(0.0)), 2)
    return F.struct(_first_word(r["ENTRY"]).alias("glycan_id"), _record(r, "NAME", "undefined").alias("glycan_name"), _record(r, "COMPOSITION", "undefined").alias("composition"), mass.alias("mass"))


def kegg_ortholog(r: Column) -> Column:
    return F.struct(_first_word(r["ENTRY"]).alias("ortho_id"), F.get(F.split(r["SYMBOL"], ", "), F.lit(0)).alias("ortho_name"), r["NAME"].alias("full_name"))


def kegg_reaction(r: Column) -> Column:
    rest = [r[k].alias(k.lower()) for k in ("COMMENT", "REACTION_TYPE", "PATHWAY_ID")]
    return F.struct(_first_word(r["ENTRY"]).alias("reaction_id"), _record(r, "NAME", "undefined").alias("name"), r["DEFINITION"].alias("definition"), r["EQUATION"].alias("equation"), *rest)


def kegg_pathway(r: Column) -> Column:
    return F.struct(_first_word(r["ENTRY"]).alias("pathway_id"), _record(r, "DESCRIPTION", "").alias("description"))


def namespaced_id(database: Column, identifier: Column) -> Column:
    """<slug>:<id>; the slug is the database's prefix, else its letters and digits, else unknown."""
    slug = F.coalesce(mapped(database, PREFIXES), F.nullif(F.regexp_replace(F.coalesce(database, F.lit("")), "[^a-z0-9]", ""), F.lit("")), F.lit("unknown"))
    return F.concat_ws(":", slug, identifier)


def as_list(slot: Column, schema: str) -> Column:
    """A JSON slot that holds one object or several, as an array of structs; other JSON and null are an empty one."""
    t = F.trim(F.coalesce(slot, F.lit("")))
    many, one = F.from_json(t, f"array<{schema}>"), F.array(F.from_json(t, schema))
    none = F.array().cast(f"array<{schema}>")
    return F.coalesce(F.when(t.startswith("["), F.filter(many, lambda x: x.isNotNull())).when(t.startswith("{"), F.filter(one, lambda x: x.isNotNull())), none)


def moieties(residues: DataFrame) -> DataFrame:
    """residues(entity_id, psi_mods array<string>, modifications array<struct<id, identifier>>) -> entity_id, moiety_id, psi_mod, is_reference.

    The n-th modification goes with the n-th psi-mod term, else with the first. R-... ids are entities, chebi: ids compounds
    (by their identifier); others are left out.
    """
    m = residues.select("entity_id", F.filter("psi_mods", lambda x: x.isNotNull()).alias("_p"), F.posexplode("modifications").alias("_i", "_m"))
    psi = F.coalesce(F.get("_p", F.col("_i")), F.get("_p", F.lit(0)))
    chemical = F.col("_m.id").startswith("chebi:") & F.col("_m.identifier").isNotNull()
    moiety = F.when(F.col("_m.id").startswith("R-"), F.col("_m.id")).when(chemical, namespaced_id(F.lit("chebi"), F.col("_m.identifier")))
    return m.select("entity_id", moiety.alias("moiety_id"), psi.alias("psi_mod"), F.coalesce(chemical, F.lit(False)).alias("is_reference")).where("moiety_id is not null")


def membership(children: DataFrame) -> DataFrame:
    """children(pathway_id, parent_id, rel, child_id) -> one row each with stoichiometry: how often a child is listed; null children (back references) do not count."""
    return children.where("child_id is not null").groupBy("pathway_id", "parent_id", "rel", "child_id").agg(F.count("*").alias("stoichiometry"))


def identities(objects: DataFrame, xrefs: DataFrame) -> DataFrame:
    """pathway_id, entity_id, reference_id, reference_type of objects(pathway_id, object_id, class_name, identifier, database, gene_names).

    A UniProt reference is a gene; a chemical database or class gives a compound, or a drug where the class ends in Drug;
    other sequences are bridged to a gene, first by xrefs(xref_id, uniprot_id), then by a gene symbol of a protein in the
    same pathway. What stays unresolved is left out.
    """
    db = F.lower(F.coalesce("database", F.lit("")))
    rows = objects.where("identifier is not null").withColumn("_db", db)
    protein = F.col("_db").startswith("uniprot")
    chemical = F.col("_db").startswith("chebi") | F.col("_db").startswith("guide to pharmacology") | F.col("class_name").isin(*CHEMICAL_CLASSES)
    kind = F.when(protein, "gene").when(F.coalesce(chemical, F.lit(False)), F.when(F.col("class_name").endswith("Drug"), "drug").otherwise("compound")).otherwise("sequence")
    rows = rows.withColumn("_kind", kind)
    symbols = rows.where("_kind = 'gene'").select("pathway_id", "identifier", F.explode("gene_names").alias("symbol")).groupBy("pathway_id", "symbol").agg(F.min("identifier").alias("_by_symbol"))
    lookup = xrefs.groupBy(F.col("xref_id").alias("identifier")).agg(F.min("uniprot_id").alias("_by_xref"))
    others = rows.where("_kind = 'sequence'").join(lookup, "identifier", "left")
    named = others.select("pathway_id", "object_id", F.posexplode("gene_names").alias("_i", "symbol")).join(symbols, ["pathway_id", "symbol"]).groupBy("pathway_id", "object_id").agg(F.min_by("_by_symbol", "_i").alias("_by_symbol"))
    bridged = others.join(named, ["pathway_id", "object_id"], "left").select("pathway_id", F.col("object_id").alias("entity_id"), F.coalesce("_by_xref", "_by_symbol").alias("reference_id"), F.lit("gene").alias("reference_type")).where("reference_id is not null")
    own = F.when(F.col("_kind") == "gene", F.col("identifier")).otherwise(namespaced_id(F.col("_db"), F.col("identifier")))
    direct = rows.where("_kind <> 'sequence'").select("pathway_id", F.col("object_id").alias("entity_id"), own.alias("reference_id"), F.col("_kind").alias("reference_type"))
    return direct.unionByName(bridged)


def gene_xrefs(products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(xrefs(uniprot_id, xref_db, xref_id), ensembl(uniprot_id, ensembl_gene: the first)) of products(uniprot_id, refs array<struct<db, id>>)."""
    rows = products.select("uniprot_id", F.posexplode("refs").alias("_i", "_r")).where("_r.id is not null")
    xrefs = rows.select("uniprot_id", F.coalesce(F.nullif("_r.db", F.lit("")), F.lit("unknown")).alias("xref_db"), F.col("_r.id").alias("xref_id")).distinct()
    first = rows.where("_r.db = 'ENSEMBL'").groupBy("uniprot_id").agg(F.min_by("_r.id", F.struct("_i", "_r.id")).alias("ensembl_gene"))
    return xrefs, first


def record_fanout(objects: DataFrame, children: DataFrame, parts: DataFrame, residues: DataFrame, products: DataFrame, species: DataFrame) -> dict[str, DataFrame]:
    """The tables of resolved pathways: entities, entity_data, entity_path_mem, memberships, moieties, identities, genes, compounds, drugs, gene_xrefs, pathways, reactions, participations.

    objects are all resolved objects of all pathways, events included (pathway_id, object_id, class_name, display_name,
    compartments, names, gene_names, identifier, database, formula); species(pathway_id, entity_id) are those that a
    pathway names itself. One row per key in the registry tables: the first by key order where objects repeat.
    """
    xrefs, ensembl = gene_xrefs(products)
    idents = identities(objects, xrefs)
    kind = entity_type(F.col("class_name"))
    once = lambda df, key: df.groupBy(key).agg(F.min(F.struct(*(c for c in df.columns if c != key))).alias("_r")).select(key, "_r.*")
    attached = moieties(residues)
    known = objects.select(F.col("object_id").alias("entity_id"), kind.alias("entity_type")).unionByName(idents.select(F.col("reference_id").alias("entity_id"), F.col("reference_type").alias("entity_type")))
    known = known.unionByName(attached.where("is_reference").select(F.col("moiety_id").alias("entity_id"), F.lit("compound").alias("entity_type")))
    ref = objects.join(idents.withColumnRenamed("entity_id", "object_id"), ["pathway_id", "object_id"]).withColumn("identifier", F.col("reference_id"))
    ref = ref.drop("ensembl_gene").join(ensembl.withColumnRenamed("uniprot_id", "identifier"), "identifier", "left")
    events, states = kind.isin("pathway", "reaction"), ~kind.isin("pathway", "reaction")
    return {
        "entities": known.distinct(),
        "entity_data": once(entity_data(objects.where(states)), "entity_id"),
        "entity_path_mem": species.select("entity_id", "pathway_id").distinct(),
        "memberships": membership(children),
        "moieties": attached.select("entity_id", "moiety_id", "psi_mod").distinct(),
        "identities": idents.select("entity_id", "reference_id", "reference_type").distinct(),
        "genes": once(gene(ref.where("reference_type = 'gene'")), "uniprot_id"),
        "compounds": once(compound(ref.where("reference_type = 'compound'")), "compound_id"),
        "drugs": once(drug(ref.where("reference_type = 'drug'")), "drug_id"),
        "gene_xrefs": xrefs,
        "pathways": once(pathway(objects.where(events & (kind == "pathway"))), "pathway_id"),
        "reactions": once(reaction(objects.where(events & (kind == "reaction"))), "reaction_id"),
        "participations": parts.distinct(),
    }


def resolve_frontier(roots: DataFrame, children: DataFrame, moiety: DataFrame, objects: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(resolved(id), unresolved(id)): what roots(id) reach through children(parent_id, child_id), then what the moieties of those reach.

    An id without an object is unresolved, and never taken for absent; nothing is followed from it. Each node is marked once,
    by whichever root comes first.
    """
    have = objects.select(F.col("object_id").alias("src")).distinct()
    steps = children.where("child_id is not null").select(F.col("parent_id").alias("src"), F.col("child_id").alias("dst")).join(have, "src", "left_semi")
    first = reached(steps, roots.select("id")).all()
    attached = moiety.where("not is_reference").join(first.join(have.withColumnRenamed("src", "id"), "id", "left_semi").withColumnRenamed("id", "entity_id"), "entity_id", "left_semi")
    new = attached.select(F.col("moiety_id").alias("id")).distinct().join(first, "id", "left_anti")
    seen = first.union(reached(steps, new).all()).distinct()
    known = have.withColumnRenamed("src", "id")
    return seen.join(known, "id", "left_semi"), seen.join(known, "id", "left_anti")


def route_annotations(changed: DataFrame, tables: dict[str, DataFrame], keys: dict[str, str]) -> dict[str, DataFrame]:
    """For each type, the rows of its annotation table whose key is among changed(entity_id, entity_type); types without a table (pathways) are skipped."""
    return {k: df.join(changed.where(F.col("entity_type") == k).select(F.col("entity_id").alias(keys[k])).distinct(), keys[k], "left_semi") for k, df in tables.items()}


def flatten_row(df: DataFrame) -> DataFrame:
    """Arrays as comma text (null if empty), timestamps as ISO text; other columns as they are."""

    def flat(name: str, kind: str) -> Column:
        c = F.col(name)
        if kind.startswith("array"):
            return F.nullif(F.array_join(F.transform(c, lambda x: x.cast("string")), ","), F.lit("")).alias(name)
        return (F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss") if kind in ("timestamp", "timestamp_ntz") else c).alias(name)

    return df.select(*(flat(*x) for x in df.dtypes))


def graph_nodes(df: DataFrame, key: str, label: str | Column, renames: dict[str, str] | None = None, extra: str | None = None) -> DataFrame:
    """label, id (as text), labels, props (as text, nulls dropped, columns renamed) of the rows of an entity table; extra: a second label for all."""
    renames = renames or {}
    label = F.lit(label) if isinstance(label, str) else label
    props = [x for c in df.columns if c != key for x in (F.lit(renames.get(c, c)), F.col(c).cast("string"))]
    kept = F.map_filter(F.create_map(*props), lambda k, v: v.isNotNull()) if props else no_props()
    return df.select(label.alias("label"), F.col(key).cast("string").alias("id"), F.array_compact(F.array(label, F.lit(extra))).alias("labels"), kept.alias("props"))


#: Edge labels of membership slots and of participants' roles.
MEMBER_LABELS = {"hasComponent": "HAS_COMPONENT", "hasMember": "HAS_MEMBER", "hasCandidate": "HAS_CANDIDATE", "repeatedUnit": "HAS_COMPONENT"}
ROLE_LABELS = {"reactant": "REACTANT", "product": "PRODUCT", "catalyst": "CATALYST", "inhibitor": "INHIBITOR", "stimulator": "STIMULATOR"}
LEGACY_ROLE_LABELS = {"substrate": "SUBSTRATE_OF", "product": "PRODUCES", "catalyst": "CATALYZES"}


def _edges(df: DataFrame, src: Column, dst: Column, label: Column, support: Column | None, **props: Column) -> DataFrame:
    pairs = [x for k, v in props.items() for x in (F.lit(k), v.cast("string"))]
    kept = F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull()) if pairs else no_props()
    known = label.isNotNull() & src.isNotNull() & dst.isNotNull()
    return df.where(known).select(src.cast("string").alias("src"), dst.cast("string").alias("dst"), label.alias("label"), kept.alias("props"), (F.lit(None) if support is None else support).cast("string").alias("pathway_id"))


def _participations(df: DataFrame, labels: dict[str, str]) -> DataFrame:
    made = F.col("role") == "product"
    src, dst = F.when(made, F.col("reaction_id")).otherwise(F.col("entity_id")), F.when(made, F.col("entity_id")).otherwise(F.col("reaction_id"))
    more = {"stoichiometry": F.col("stoichiometry")} if "stoichiometry" in df.columns else {}
    return _edges(df, src, dst, mapped(F.col("role"), labels), F.col("pathway_id"), **more)


EDGE_BUILDERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "memberships": lambda df: _edges(df, F.col("child_id"), F.col("parent_id"), mapped(F.col("rel"), MEMBER_LABELS), F.col("pathway_id"), stoichiometry=F.col("stoichiometry")),
    "participations": lambda df: _participations(df, ROLE_LABELS),
    "legacy_participations": lambda df: _participations(df, LEGACY_ROLE_LABELS),
    "interactions": lambda df: _edges(df, F.col("source_id"), F.col("target_id"), F.col("relation_type"), F.col("pathway_id")),
    "identities": lambda df: _edges(df, F.col("entity_id"), F.col("reference_id"), F.lit("IS_FORM_OF"), None),
    "moieties": lambda df: _edges(df, F.col("entity_id"), F.col("moiety_id"), F.lit("HAS_MOIETY"), None, psi_mod=F.col("psi_mod")),
    "entity_path_mem": lambda df: _edges(df, F.col("entity_id"), F.col("pathway_id"), F.lit("IN_PATHWAY"), F.col("pathway_id")),
    "gene_edges": lambda df: _edges(df, F.col("source_id"), F.col("target_id"), F.col("rel_type"), F.col("pathway_id"), mechanism=F.col("mechanism"), sign=F.col("sign"), via=F.col("via"), weight=F.col("weight")),
}


def graph_edges(df: DataFrame, table: str) -> DataFrame:
    """src, dst, label, props, pathway_id of the rows of one of the tables in EDGE_BUILDERS: children point to parents, participants to reactions, and reactions to their products."""
    return EDGE_BUILDERS[table](df)


#: Predicates of ontology edges and their names.
PREDICATES = {"BFO_0000050": "part_of", "RO_0002211": "regulates", "RO_0002212": "negatively_regulates", "RO_0002213": "positively_regulates"}


def last_segment(c: Column) -> Column:
    return F.substring_index(c, "/", -1)


def ontology_nodes(nodes: DataFrame) -> DataFrame:
    """term, name, props of nodes(id, lbl, type, meta) that are classes with a label and not deprecated.

    props: definition, xrefs, synonyms (joined by '|') and the basic properties by their predicate's local name, the last of equal ones.
    """
    meta = F.col("meta")
    fine = (F.col("type") == "CLASS") & (F.coalesce("lbl", F.lit("")) != "") & ~F.coalesce(meta["deprecated"], F.lit(False))
    basic = F.coalesce(meta["basicPropertyValues"], F.array().cast("array<struct<pred:string,val:string>>"))
    named = F.transform(basic, lambda x: F.struct(F.regexp_extract(x["pred"], "([^/#]*)$", 1).alias("k"), x["val"].alias("v")))
    keys = F.array_distinct(F.transform(named, lambda x: x["k"]))
    last = F.transform(keys, lambda k: F.struct(k.alias("key"), F.element_at(F.filter(named, lambda x: x["k"] == k), -1)["v"].alias("value")))
    joined = lambda c: F.nullif(F.array_join(F.transform(c, lambda x: x["val"]), "|"), F.lit(""))
    own = F.create_map(F.lit("definition"), meta["definition"]["val"], F.lit("xrefs"), joined(meta["xrefs"]), F.lit("synonyms"), joined(meta["synonyms"]))
    more = F.map_filter(F.map_from_entries(last), lambda k, v: ~k.isin("definition", "xrefs", "synonyms"))
    return nodes.where(fine).select(last_segment(F.col("id")).alias("term"), F.col("lbl").alias("name"), F.map_filter(F.map_concat(own, more), lambda k, v: v.isNotNull()).alias("props"))


def ontology_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """child, parent, rel of edges(sub, pred, obj) neither end of which is a deprecated node; known predicates have their names."""
    gone = nodes.where(F.coalesce(F.col("meta")["deprecated"], F.lit(False))).select("id").distinct()
    kept = edges.join(gone.withColumnRenamed("id", "sub"), "sub", "left_anti").join(gone.withColumnRenamed("id", "obj"), "obj", "left_anti")
    pred = last_segment(F.col("pred"))
    return kept.select(last_segment(F.col("sub")).alias("child"), last_segment(F.col("obj")).alias("parent"), F.coalesce(mapped(pred, PREDICATES), pred).alias("rel"))
