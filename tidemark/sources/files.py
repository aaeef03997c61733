"""Readers. Each takes a path that Spark can read, local or not, and gives tables; a file is parsed within a row, so that
many files are read by many tasks."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from ..operators.shape import mapped
from ..operators.store import written
from ..operators.text import clean_function

_text = lambda *names: [(n, pa.string()) for n in names]
_NAMED = [*_text("id", "name", "compartment"), ("resources", pa.list_(pa.string()))]
_REFS = pa.list_(pa.struct(_text("species", "stoichiometry")))
_REACTION = pa.struct([*_NAMED, ("reactants", _REFS), ("products", _REFS), ("modifiers", pa.list_(pa.struct(_text("species", "term"))))])
SBML = pa.schema([
    *_text("id", "name"), ("resources", pa.list_(pa.string())), ("compartments", pa.list_(pa.struct(_text("id", "name")))),
    ("species", pa.list_(pa.struct(_NAMED))), ("reactions", pa.list_(_REACTION)), ("part", pa.int32()),
])
#: Species and reactions of a row, at most: a longer model is several rows, whose part counts them from 0.
SBML_ROWS = 64
#: Roles by the systems-biology term of a modifier.
SBO_ROLES = {"SBO:0000013": "catalyst", "SBO:0000020": "inhibitor", "SBO:0000459": "stimulator", "SBO:0000461": "stimulator"}


@contextmanager
def arrow_bytes(spark: SparkSession, most: str) -> Iterator[None]:
    """What is run within sends tasks' texts to Python in batches of at most so many bytes (or one row): else some 64 MB are held
    by the JVM and by the worker, more than once each."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, most)
    try:
        yield
    finally:
        spark.conf.set(key, old)


def whole_files(spark: SparkSession, path: str) -> DataFrame:
    """path, text: a row for each file."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def _down(element: ElementTree.Element, *names: str) -> list[ElementTree.Element]:
    """The elements below along a path of names, in whatever namespace."""
    found = [element]
    for name in names:
        found = [c for e in found for c in e if c.tag.rpartition("}")[2] == name]
    return found


def _attributes(element: ElementTree.Element) -> dict[str, str]:
    return {k.rpartition("}")[2]: v.strip() for k, v in element.attrib.items()}


def _named(element: ElementTree.Element) -> dict:
    """Its attributes, and the resources of all `is` bags of its annotation."""
    bags = _down(element, "annotation", "RDF", "Description", "is", "Bag", "li")
    return _attributes(element) | {"resources": [_attributes(li).get("resource") for li in bags]}


def _model(text: str | None) -> dict:
    """The model of one document as SBML has it; all is null where there is none, or the text is no XML."""
    try:
        models = _down(ElementTree.fromstring(text), "model") if text else []
    except ElementTree.ParseError:
        models = []
    if not models:
        return {}
    model = models[-1]
    refs = lambda r, kind, name: [_attributes(x) for x in _down(r, f"listOf{kind}", name)]
    modifiers = lambda r: [{"species": x.get("species"), "term": x.get("sboTerm")} for x in refs(r, "Modifiers", "modifierSpeciesReference")]
    reactions = [
        _named(r) | {"reactants": refs(r, "Reactants", "speciesReference"), "products": refs(r, "Products", "speciesReference"), "modifiers": modifiers(r)}
        for r in _down(model, "listOfReactions", "reaction")
    ]
    places = [_attributes(c) for c in _down(model, "listOfCompartments", "compartment")]
    return _named(model) | {"compartments": places, "species": [_named(x) for x in _down(model, "listOfSpecies", "species")], "reactions": reactions}


def _parts(model: dict) -> Iterator[dict]:
    """The model cut into rows of bounded size, each with what it says of itself and its compartments."""
    longest = max(len(model.get("species") or []), len(model.get("reactions") or []))
    for k, at in enumerate(range(0, max(1, longest), SBML_ROWS)):
        yield model | {x: model[x][at : at + SBML_ROWS] for x in ("species", "reactions") if x in model} | {"part": k}


def _models(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(batch.num_rows):
            rows = [*_parts(_model(batch.column(0)[at].as_py()))]
            yield pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in SBML], schema=SBML)


def _own_id(resources: Column, fallback: Column) -> Column:
    found = F.filter(F.transform(resources, lambda r: F.regexp_extract(r, r"reactome:(R-[A-Z]{3}-\d+)", 1)), lambda x: x != "")
    return F.coalesce(F.get(found, F.lit(0)), fallback)


def _reference(resources: Column, database: str) -> Column:
    """The first accession of a database among the resources: identifiers.org/db:id or db/id, or the older form for chebi."""
    own = F.transform(resources, lambda r: F.regexp_extract(r, rf"(?i)identifiers\.org/{database}[:/]([^/\s]+)$", 1))
    if database == "chebi":
        own = F.concat(own, F.transform(resources, lambda r: F.regexp_extract(r, r"chebiId=CHEBI:(\d+)", 1)))
    return F.get(F.filter(own, lambda x: x != ""), F.lit(0))


def sbml(files: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(pathways, species, reactions, participations) of pathway XML, files(text).

    species(pathway_id, entity_id, display_name, compartment, uniprot, chebi): the entity id is the reference to the pathway
    database, else the element's id. participations(pathway_id, reaction_id, entity_id, role, stoichiometry): reactants
    and products, with whole stoichiometries (1 if missing), and modifiers by their term; an unknown term is an error.
    """
    with arrow_bytes(files.sparkSession, "8m"):
        m = written(files.select("text").mapInArrow(_models, from_arrow_schema(SBML)), "sbml")  # parsed once for all tables
    m = m.withColumn("pathway_id", _own_id(F.col("resources"), F.replace("id", F.lit("pathway_"), F.lit(""))))
    pathways = m.where("part = 0").select("pathway_id", F.coalesce("name", F.lit("")).alias("description"))
    places = F.map_from_entries(F.coalesce("compartments", F.array().cast("array<struct<id:string,name:string>>")))
    m = m.withColumn("places", places)
    s = m.select("pathway_id", "places", F.explode("species").alias("s"))
    entity = F.coalesce(_reference(F.col("s.resources"), "reactome"), F.col("s.id"))
    species = s.select("pathway_id", F.col("s.id").alias("_sbml"), entity.alias("entity_id"), F.coalesce("s.name", entity).alias("display_name"), F.col("places")[F.col("s.compartment")].alias("compartment"), _reference(F.col("s.resources"), "uniprot").alias("uniprot"), _reference(F.col("s.resources"), "chebi").alias("chebi"))
    r = m.select("pathway_id", "places", F.explode("reactions").alias("r"))
    r = r.withColumn("reaction_id", _own_id(F.col("r.resources"), F.replace("r.id", F.lit("reaction_"), F.lit(""))))
    reactions = r.select("pathway_id", "reaction_id", F.coalesce("r.name", "reaction_id").alias("name"), F.col("places")[F.col("r.compartment")].alias("compartment"))
    side = lambda c, role: F.transform(c, lambda x: F.struct(x["species"].alias("_sbml"), F.lit(role).alias("role"), F.coalesce(x["stoichiometry"].cast("double"), F.lit(1.0)).cast("int").alias("stoichiometry")))
    role = lambda t: F.coalesce(mapped(t, SBO_ROLES), F.raise_error(F.concat(F.lit("unknown modifier term "), F.coalesce(t, F.lit("null")))).cast("string"))
    modifiers = F.transform("r.modifiers", lambda x: F.struct(x["species"].alias("_sbml"), role(x["term"]).alias("role"), F.lit(1).alias("stoichiometry")))
    parts = r.select("pathway_id", "reaction_id", F.explode(F.concat(side("r.reactants", "reactant"), side("r.products", "product"), modifiers)).alias("p")).select("pathway_id", "reaction_id", "p.*")
    parts = parts.join(species.select("pathway_id", "_sbml", "entity_id"), ["pathway_id", "_sbml"]).select("pathway_id", "reaction_id", "entity_id", "role", "stoichiometry")
    return pathways, species.drop("_sbml"), reactions, parts


#: Reference prefixes of the graphic pathway format, and the kinds of entries that are read.
REF_TYPES = {"cpd": "compound", "gl": "glycan", "dr": "drug", "rn": "reaction", "hsa": "gene", "ko": "ortholog", "path": "pathway"}
ENTRY_KINDS = ("gene", "ortholog", "compound", "drug", "glycan")
KGML = (
    "_name string, _title string, entry array<struct<_id:string,_name:string,_type:string,_reaction:string>>,"
    "relation array<struct<_entry1:string,_entry2:string,subtype:array<struct<_name:string>>>>,"
    "reaction array<struct<_id:string,_name:string,substrate:array<struct<_name:string>>,product:array<struct<_name:string>>>>"
)


def references(raw: Column) -> Column:
    """'cpd:C00022 gl:G00115' as an array of (code, type); an unknown prefix or one without ':' is an error."""

    def one(token: Column) -> Column:
        prefix, code = F.substring_index(token, ":", 1), F.regexp_replace(token, "^[^:]*:", "")
        bad = F.raise_error(F.concat(F.lit("unknown reference "), token)).cast("string")
        return F.struct(F.when(F.contains(token, F.lit(":")), code).otherwise(bad).alias("code"), F.coalesce(mapped(prefix, REF_TYPES), bad).alias("type"))

    return F.transform(F.filter(F.split(F.coalesce(raw, F.lit("")), r"\s+"), lambda x: x != ""), one)


def prefixed_refs(df: DataFrame, column: str) -> DataFrame:
    """The other columns with code and type, a row for each reference in the column."""
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.inline(references(F.col(column))))


def kgml(files: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """(pathways, entities, memberships, relations, participants) of graphic pathway XML, files(text).

    An entry's name holds several references. A relation is each entity of one entry with each of the other; without
    a subtype it is `undefined`, and one with an unknown entry is skipped. A reaction has its entry's entities as
    catalysts; substrates and products that no entry has become entities as well, and so do the reactions that entries name.
    """
    p = files.select(F.from_xml("text", KGML).alias("p")).select(F.regexp_replace("p._name", "^path:", "").alias("pathway_id"), "p.*")
    p = written(p, "kgml")  # parsed once for all tables
    pathways = p.select("pathway_id", F.col("_title").alias("description"))
    e = p.select("pathway_id", F.explode("entry").alias("e")).where(F.col("e._type").isin(*ENTRY_KINDS))
    own = e.select("pathway_id", F.col("e._id").alias("entry_id"), F.inline(references(F.col("e._name")))).withColumnsRenamed({"code": "entity_id", "type": "entity_type"})
    memberships = own.select("entity_id", "pathway_id").distinct()
    rel = p.select("pathway_id", F.explode("relation").alias("r")).select("pathway_id", F.col("r._entry1").alias("a"), F.col("r._entry2").alias("b"), F.coalesce(F.get("r.subtype", F.lit(0))["_name"], F.lit("undefined")).alias("relation_type"))
    side = lambda k, name: own.select("pathway_id", F.col("entry_id").alias(k), F.col("entity_id").alias(name))
    relations = rel.join(side("a", "source_id"), ["pathway_id", "a"]).join(side("b", "target_id"), ["pathway_id", "b"]).select("source_id", "target_id", "relation_type", "pathway_id")
    rx = p.select("pathway_id", F.explode("reaction").alias("x")).select("pathway_id", F.col("x._id").alias("entry_id"), F.explode(references(F.col("x._name"))).alias("rn"), "x.substrate", "x.product")
    rx = rx.join(own.select("pathway_id", "entry_id").distinct(), ["pathway_id", "entry_id"], "left_semi").withColumn("reaction_id", F.col("rn.code"))
    catalysts = rx.select("pathway_id", "entry_id", "reaction_id").join(own, ["pathway_id", "entry_id"]).select("pathway_id", "reaction_id", "entity_id", "entity_type", F.lit("catalyst").alias("role"))
    ends = lambda c: rx.select("pathway_id", "reaction_id", F.explode(c).alias("s")).select("pathway_id", "reaction_id", F.inline(references(F.col("s._name"))), F.lit(c).alias("role")).withColumnsRenamed({"code": "entity_id", "type": "entity_type"})
    chemicals = ends("substrate").unionByName(ends("product"))
    participants = catalysts.unionByName(chemicals).select("reaction_id", "entity_id", "role", "pathway_id").distinct()
    named = e.select(F.inline(references(F.col("e._reaction")))).select(F.col("code").alias("entity_id"), F.col("type").alias("entity_type"))
    entities = own.select("entity_id", "entity_type").union(chemicals.select("entity_id", "entity_type")).union(named).union(p.select("pathway_id", F.lit("pathway"))).distinct()
    return pathways, entities, memberships, relations, participants


def flatfile(spark: SparkSession, path: str) -> DataFrame:
    """path, record (its text's hash), fields (a map of key to text) of flat files with records ended by '///'.

    The first twelve columns hold the key; a line without one continues the last; a key that repeats joins its values by
    a newline and the character U+001E, so that they can be split again.
    """
    text = spark.read.option("lineSep", "///").text(path).select(F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", r"^\s*\n|\s+$", "").alias("text"))
    return text.where(F.trim("text") != "").select("path", F.xxhash64("text").alias("record"), record_fields(F.col("text")).alias("fields"))


def record_fields(text: Column) -> Column:
    """The map of one record's text. A field begins at each line whose first character is not blank."""
    fields = F.filter(F.split(F.regexp_replace(text, "\r", ""), r"\n(?=\S)"), lambda x: F.trim(x) != "")

    def field(x: Column) -> Column:
        lines = F.transform(F.filter(F.split(x, "\n"), lambda y: F.trim(y) != ""), lambda y: F.rtrim(F.substr(y, F.lit(13))))
        return F.struct(F.trim(F.substr(x, F.lit(1), F.lit(12))).alias("key"), F.trim(F.array_join(lines, "\n")).alias("value"))

    pairs = F.transform(fields, field)
    keys = F.array_distinct(F.transform(pairs, lambda p: F.regexp_extract(p["key"], r"^([^\n]*)", 1)))
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(k.alias("key"), F.array_join(F.transform(F.filter(pairs, lambda p: F.regexp_extract(p["key"], r"^([^\n]*)", 1) == k), lambda p: p["value"]), "\n\x1e").alias("value"))))


def _levels(roots: DataFrame, kinds: tuple[str, ...] | None) -> DataFrame:
    """node, parent_id, parent_name of all nodes of recursive JSON trees, roots(node variant), level by level until none is left.

    kinds: only nodes of these types count, and nothing is followed from others.
    """
    fits = lambda df: df.where(F.try_variant_get("node", "$.type", "string").isin(*kinds)) if kinds else df
    null = F.lit(None).cast("string")
    now = written(fits(roots.select("node", null.alias("parent_id"), null.alias("parent_name"))), "tree")
    levels = []
    while not now.isEmpty():
        levels.append(now)
        below = now.select("node", F.try_variant_get("node", "$.children", "array<variant>").alias("_c"))
        name = F.coalesce(F.try_variant_get("node", "$.name", "string"), F.try_variant_get("node", "$.displayName", "string"))
        step = below.select(F.explode("_c").alias("_n"), F.try_variant_get("node", "$.stId", "string").alias("parent_id"), name.alias("parent_name"))
        now = written(fits(step.withColumnRenamed("_n", "node").select("node", "parent_id", "parent_name")), "tree")
    return reduce(DataFrame.unionByName, levels) if levels else now


def plain_name(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s*\d+\s*", "")


def class_tree(trees: DataFrame) -> DataFrame:
    """name, parent_name of the nodes of class trees, trees(json); numbers before the names are dropped, roots have no parent."""
    found = _levels(trees.select(F.parse_json("json").alias("node")), None)
    return found.select(plain_name(F.try_variant_get("node", "$.name", "string")).alias("name"), plain_name(F.col("parent_name")).alias("parent_name"))


#: The types of events that are pathways.
PATHWAY_TYPES = ("Pathway", "TopLevelPathway", "CellLineagePath")


def event_tree(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(hierarchy(stid, name, parent_stid), leaves(stid)) of event trees, events(json), a root a row.

    Edges are distinct by (stid, parent_stid), a root has no parent; a leaf is a pathway that holds no pathway.
    """
    found = _levels(events.select(F.parse_json("json").alias("node")), PATHWAY_TYPES)
    name = F.coalesce(F.try_variant_get("node", "$.name", "string"), F.try_variant_get("node", "$.displayName", "string"), F.lit(""))
    rows = found.select(F.try_variant_get("node", "$.stId", "string").alias("stid"), name.alias("name"), F.col("parent_id").alias("parent_stid")).where("stid is not null")
    hierarchy = rows.groupBy("stid", "parent_stid").agg(F.min("name").alias("name")).select("stid", "name", "parent_stid")
    parents = rows.where("parent_stid is not null").select(F.col("parent_stid").alias("stid"))
    return hierarchy, rows.select("stid").distinct().join(parents, "stid", "left_anti")


def pathway_list(spark: SparkSession, path: str) -> DataFrame:
    """pathway_id, description of two-column files; blank lines are skipped, a line is cut at its first tab."""
    line = F.split("value", "\t", 2)
    return spark.read.text(path).where(F.trim("value") != "").select(F.get(line, F.lit(0)).alias("pathway_id"), F.get(line, F.lit(1)).alias("description"))


_VALUES = "array<struct<val:string>>"
OBO = (
    "graphs array<struct<nodes:array<struct<id:string,lbl:string,type:string,meta:struct<definition:struct<val:string>,deprecated:boolean,"
    f"xrefs:{_VALUES},synonyms:{_VALUES},basicPropertyValues:array<struct<pred:string,val:string>>>>>,edges:array<struct<sub:string,pred:string,obj:string>>>>"
)


def obo_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(nodes(id, lbl, type, meta), edges(sub, pred, obj)) of ontology JSON: those of the first graph."""
    g = spark.read.schema(OBO).json(path, multiLine=True).select(F.get("graphs", F.lit(0)).alias("g"))
    return g.select(F.inline("g.nodes")), g.select(F.inline("g.edges"))


#: The columns of an annotation file.
GAF = (
    "db accession symbol qualifier term reference evidence with_from aspect name synonym object_type taxon date assigned_by extension form"
).split()


def gaf(spark: SparkSession, path: str) -> DataFrame:
    """The 17 columns of annotation files as text, of rows of the database UniProtKB; '!' begins a comment, an empty field is an empty text."""
    rows = spark.read.csv(path, sep="\t", comment="!", quote="", schema=", ".join(f"{c} string" for c in GAF))
    return rows.where("db = 'UniProtKB'").select(*(F.coalesce(c, F.lit("")).alias(c) for c in GAF))


def idmapping(spark: SparkSession, path: str) -> DataFrame:
    """Distinct uniprot_id, entrez_id of mapping files: column 0, and column 2 cut at ';' and ','; blanks are dropped."""
    rows = spark.read.csv(path, sep="\t", quote="", schema="uniprot_id string, name string, ids string")
    ids = rows.select("uniprot_id", F.explode(F.split("ids", "[;,]")).alias("entrez_id")).withColumn("entrez_id", F.trim("entrez_id"))
    return ids.where("entrez_id <> '' and uniprot_id is not null").distinct()


def function_tsv(spark: SparkSession, path: str) -> DataFrame:
    """uniprot_id, function_text (cleaned) of files with the columns Entry and Function; rows without text are dropped."""
    rows = spark.read.csv(path, sep="\t", header=True, quote="")
    out = rows.select(F.col("Entry").alias("uniprot_id"), clean_function(F.coalesce(rows["Function"], F.lit(""))).alias("function_text"))
    return out.where("function_text <> ''")


def corpus(spark: SparkSession, path: str) -> DataFrame:
    """id, text of a JSON map of texts, or of JSON lines with text and uniprot_id or gene; blank texts are dropped."""
    lines = spark.read.text(path)
    rows = lines.select(F.parse_json("value").alias("v")).select(F.coalesce(F.try_variant_get("v", "$.uniprot_id", "string"), F.try_variant_get("v", "$.gene", "string")).alias("id"), F.try_variant_get("v", "$.text", "string").alias("text"), F.col("v"))
    named = rows.where("id is not null").select("id", "text")
    maps = rows.where("id is null").select(F.explode(F.try_variant_get("v", "$", "map<string,string>")).alias("id", "text"))
    return named.unionByName(maps).where(F.trim(F.coalesce("text", F.lit(""))) != "")


def id_crosswalk(spark: SparkSession, path: str) -> DataFrame:
    """id -> entrez_ids (sorted, distinct) of JSON lines that are maps, either {entrez: [accession, ...]} or {accession: entrez}."""
    pairs = spark.read.text(path).select(F.explode(F.try_variant_get(F.parse_json("value"), "$", "map<string,variant>")).alias("k", "v"))
    many = F.try_variant_get("v", "$", "array<string>")
    turned = pairs.where(F.schema_of_variant("v").startswith("ARRAY")).select(F.explode(many).alias("id"), F.col("k").alias("entrez_id"))
    plain = pairs.where(~F.schema_of_variant("v").startswith("ARRAY")).select(F.col("k").alias("id"), F.try_variant_get("v", "$", "string").alias("entrez_id"))
    return turned.unionByName(plain).where("id is not null and entrez_id is not null").groupBy("id").agg(F.array_sort(F.collect_set("entrez_id")).alias("entrez_ids"))


def table(spark: SparkSession, path: str, empty_is_error: bool = False) -> DataFrame:
    """A stored table, its decimals as doubles; with empty_is_error a table without rows is refused."""
    df = spark.read.parquet(path)
    df = df.select(*(F.col(c).cast("double").alias(c) if k.startswith("decimal") else F.col(c) for c, k in df.dtypes))
    if empty_is_error and df.isEmpty():
        raise ValueError(f"no rows in {path}")
    return df


def content_hash(spark: SparkSession, path: str) -> DataFrame:
    """path, file_hash (md5 of the bytes), last_checked of all files of a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.md5("content").alias("file_hash"), F.current_timestamp().alias("last_checked"))
