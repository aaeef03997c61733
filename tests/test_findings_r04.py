"""Faults that showed on larger tables only, made small."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import search, text
from tidemark.sources import files


def test_long_models_are_rows_of_bounded_size(spark, monkeypatch):
    """A row held a whole model, and a batch some 64 MB of texts."""
    species = "".join(f'<species id="s{i}" name="part {i}" compartment="c1"/>' for i in range(200))
    reactions = "".join(
        f'<reaction id="reaction_{i}" compartment="c1"><listOfReactants><speciesReference species="s{i}"/></listOfReactants><listOfProducts><speciesReference species="s{199 - i}" stoichiometry="2"/></listOfProducts></reaction>'
        for i in range(150)
    )
    model = f'<sbml><model id="pathway_1" name="one"><listOfCompartments><compartment id="c1" name="cytosol"/></listOfCompartments><listOfSpecies>{species}</listOfSpecies><listOfReactions>{reactions}</listOfReactions></model></sbml>'
    seen, write, key = [], files.written, "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)

    def spy(df, what):
        seen.append((write(df, what), spark.conf.get(key)))
        return seen[0][0]

    monkeypatch.setattr(files, "written", spy)
    texts = spark.createDataFrame([(model,), ("no XML",), (None,), ('<sbml><model id="pathway_2"/></sbml>',)], "text string")
    pathways, found, reacts, parts = files.sbml(texts)
    ((rows, during),) = seen
    assert rows.agg(F.max(F.greatest(F.size("species"), F.size("reactions")))).first()[0] <= 64
    assert during != before == spark.conf.get(key)
    assert sorted((r["pathway_id"] or "", r["description"]) for r in pathways.collect()) == [("", ""), ("", ""), ("1", "one"), ("2", "")]
    assert sorted(r["entity_id"] for r in found.where("compartment = 'cytosol'").collect()) == sorted(f"s{i}" for i in range(200))
    assert {(r["reaction_id"], r["compartment"]) for r in reacts.collect()} == {(str(i), "cytosol") for i in range(150)} and reacts.count() == 150
    want = [(str(i), f"s{i}", "reactant", 1) for i in range(150)] + [(str(i), f"s{199 - i}", "product", 2) for i in range(150)]
    assert sorted((r["reaction_id"], r["entity_id"], r["role"], r["stoichiometry"]) for r in parts.collect()) == sorted(want)


def test_terms_are_counted_without_a_shuffle_of_texts(spark):
    """Only keys that several rows share are added up across rows; null keys, too."""
    rows = [(1, "apples and pears, apples"), (2, "pears"), (3, None), (None, "figs figs"), (None, "figs plums"), (4, "plum tart"), (4, "plum cake"), (5, "the")]
    docs = spark.createDataFrame(rows, "id long, text string")
    got = {(r["id"], r["term"]): r["weight"] for r in search.bm25_index(docs).collect()}
    weight = lambda tf, n: tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / 256))
    want = {(1, "apple"): (2, 3), (1, "pear"): (1, 3), (2, "pear"): (1, 1), (None, "fig"): (3, 2), (None, "plum"): (1, 2), (4, "plum"): (2, 2), (4, "tart"): (1, 2), (4, "cake"): (1, 2)}
    assert got == pytest.approx({k: weight(*x) for k, x in want.items()})
    alone = search.bm25_index(docs.where("id < 4"))
    assert "Exchange" not in alone._jdf.queryExecution().toString() and alone.count() == 3


def test_blocks_are_cut_after_one_shuffle(spark):
    index = spark.createDataFrame([(i, "x" if i < 50 else f"y{i}", 1.0) for i in range(60)], "id long, term string, weight double")
    blocks = search.block_index(index, rows=8)
    assert len(re.findall(r"Exchange hashpartitioning", blocks._jdf.queryExecution().executedPlan().toString())) == 1
    got = blocks.collect()
    assert sorted(p["id"] for r in got for p in r["postings"]) == [*range(60)] and sum(r["n"] for r in got) == 60
    assert len([r for r in got if r["term"] == "x"]) > 3 and all(len(r["postings"]) == r["n"] for r in got)


def test_sentences_are_split_without_patterns_a_piece(spark):
    plan = spark.createDataFrame([("a. B",)], "t string").select(text.split_sentences(F.col("t")))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "lambda" not in plan
    assert text.sentences_of("One e.g. two\x01 Three?) Four. 5. six (A. B) [no. x. End\x02of.  ") == ["One e.g. two Three?)", "Four.", "5. six (A. B) [no. x.", "End", "of."]
