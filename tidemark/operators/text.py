"""Text records: cleaning, sentences, overlapping windows, records and chunks."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from string import ascii_uppercase, digits

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tokens whose full stop ends no sentence.
ABBREVIATIONS = (
    "e.g i.e cf ca approx vs resp etc et al fig figs tab ref refs eq eqs no nos vol pp sec min h hr hrs kda da mol mm um nm pm ph"
    " sp spp subsp var str cv gen fam ord st dr prof mr ms jr sr inc ltd"
).split()
_ABBREVIATED = frozenset(ABBREVIATIONS)
#: Where a sentence may end, and what may open the next one; white space is that of str.isspace, the same as [\x09-\x0D\x1C-\x20\x85\p{Z}].
_CLOSERS, _OPENERS = """)]"'’”""", frozenset("""(["'‘“""" + ascii_uppercase + digits)
_END = re.compile(rf"[.!?]+[{re.escape(_CLOSERS)}]*\s+")
WINDOW = "array<struct<chunk_idx:int,sent_start:int,sent_end:int,text:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value worked out once however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def clean_function(c: Column) -> Column:
    """Without evidence tags in braces and FUNCTION: prefixes, white space collapsed."""
    c = F.regexp_replace(F.regexp_replace(c, r"\s*\{[^}]*\}", ""), r"FUNCTION:\s*", "")
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def sentences_of(text: str | None) -> list[str]:
    """The sentences of one text: see `split_sentences`. Only str methods see whole pieces, so that a text takes time in its length."""
    pieces = _END.sub("\\g<0>\x01", (text or "").strip()).split("\x01")
    for i, piece in enumerate(pieces):
        # The last token before the end of the piece, without its full stops.
        before = piece.rstrip()
        if len(before) < len(piece) and (bare := before.rstrip(_CLOSERS)) != (body := bare.rstrip(".!?")):
            before = body
        else:
            before = piece
        token = "" if not before or before[-1] in "([" or before[-1].isspace() else before.replace("(", " ").replace("[", " ").rsplit(None, 1)[-1].rstrip(".")
        after = pieces[i + 1][:1] if i + 1 < len(pieces) else ""
        if not (token.lower() in _ABBREVIATED or token.isdecimal() or ("A" <= token <= "Z" and len(token) == 1) or (after and after not in _OPENERS)):
            pieces[i] = piece + "\x02"
    return [x for y in "".join(pieces).split("\x02") if (x := y.strip())]


def split_sentences(c: Column) -> Column:
    """Array of sentences, none for null or blank text, else one at least.

    A sentence may end at full stops, exclamation or question marks with closing brackets or quotes and white space behind
    them; it does not after an abbreviation, a single capital or a number, nor before what cannot open a sentence.
    """

    def split(texts):
        return pa.array([sentences_of(x) for x in texts.to_pylist()], pa.list_(pa.string()))

    split.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(split, "array<string>")(c)


def windows(sentences: Column, width: int, stride: int) -> Column:
    """Array of (chunk_idx, sent_start, sent_end, text): windows of `width` sentences, the last one ending with the text."""

    def of(sentences: Column) -> Column:
        n = F.size(sentences)
        tail = F.greatest(n - width, F.lit(0))
        starts = let(F.sequence(F.lit(0), tail, F.lit(stride)), lambda s: F.when(F.element_at(s, -1) < tail, F.array_append(s, tail)).otherwise(s))

        def window(s: Column, i: Column) -> Column:
            end = F.least(s + width, n)
            return F.struct(i.alias("chunk_idx"), s.alias("sent_start"), end.alias("sent_end"), F.array_join(F.slice(sentences, s + 1, end - s), " ").alias("text"))

        return F.when(n > 0, F.transform(starts, window)).otherwise(F.array().cast(WINDOW))

    return let(sentences, of)


def shape(corpus: DataFrame, width: int = 3, stride: int = 2, crosswalk: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(records, chunks) of corpus(id, text): records(id, text, sentences, n_chunks, entrez_id), chunks(id, chunk_idx, sent_start, sent_end, text).

    crosswalk(id, entrez_id): each record's sorted distinct ids; null without any.
    """
    cut = corpus.select("id", "text", split_sentences(F.col("text")).alias("sentences")).withColumn("_w", windows(F.col("sentences"), width, stride))
    records = cut.select("id", "text", "sentences", F.size("_w").alias("n_chunks"))
    if crosswalk is None:
        records = records.withColumn("entrez_id", F.lit(None).cast("array<string>"))
    else:
        ids = crosswalk.where("entrez_id is not null").groupBy("id").agg(F.array_sort(F.collect_set(F.col("entrez_id").cast("string"))).alias("entrez_id"))
        records = records.join(ids, "id", "left")
    return records, cut.select("id", F.inline("_w"))


def merge_corpora(sources: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(corpus, conflicts) of tables (id, text), the first of which wins; conflicts(id, n_texts): ids with different texts."""
    all_ = reduce(DataFrame.unionByName, (s.select("id", "text", F.lit(i).alias("_p")) for i, s in enumerate(sources)))
    all_ = all_.where(F.trim(F.coalesce("text", F.lit(""))) != "")
    corpus = all_.groupBy("id").agg(F.min_by("text", F.struct("_p", "text")).alias("text"))
    return corpus, all_.groupBy("id").agg(F.count_distinct("text").alias("n_texts")).where("n_texts > 1")


def point_id(c: Column) -> Column:
    """The version-5 UUID of a text in the URL namespace."""

    def made(h: Column) -> Column:
        variant = F.lower(F.hex((F.conv(h.substr(17, 1), 16, 10).cast("int") % 4 + 8).cast("long")))
        return F.concat_ws("-", h.substr(1, 8), h.substr(9, 4), F.concat(F.lit("5"), h.substr(14, 3)), F.concat(variant, h.substr(18, 3)), h.substr(21, 12))

    url = F.unhex(F.lit("6ba7b8119dad11d180b400c04fd430c8"))
    return let(F.sha1(F.concat(url, F.encode(c, "UTF-8"))), made)


def embed(df: DataFrame, encoder: Callable[[list[str]], list[list[float]]], column: str = "text", batch_size: int = 256) -> DataFrame:
    """df with `dense`, the vector at length 1 that a user's encoder gives a batch of texts; null texts have none. The
    encoder travels to the executors once a task and sees batches of batch_size texts."""
    import numpy as np
    import pandas as pd

    def encode(batches):
        for texts in batches:
            out = [None] * len(texts)
            known = [i for i, x in enumerate(texts) if x is not None]
            for k in range(0, len(known), batch_size):
                part = known[k : k + batch_size]
                v = np.asarray(encoder([texts.iloc[i] for i in part]), float)
                v /= np.maximum(np.sqrt((v * v).sum(1, keepdims=True)), 1e-12)
                for i, x in zip(part, v, strict=True):
                    out[i] = x.tolist()
            yield pd.Series(out)

    from collections.abc import Iterator

    encode.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return df.withColumn("dense", F.pandas_udf(encode, "array<double>")(column))


def index_manifest(records: DataFrame, chunks: DataFrame, width: int, stride: int) -> DataFrame:
    """One row of counts: records, chunks, chunks_per_record, with_entrez, multi_entrez, window, stride."""
    n = records.agg(F.count("*").alias("records"), F.count_if(F.size("entrez_id") > 0).alias("with_entrez"), F.count_if(F.size("entrez_id") > 1).alias("multi_entrez"), F.sum("n_chunks").alias("_expected"))
    both = n.join(chunks.agg(F.count("*").alias("chunks")))
    per = F.round(F.col("chunks") / F.col("records"), 6).alias("chunks_per_record")
    return both.select("records", "chunks", per, "with_entrez", "multi_entrez", F.lit(width).alias("window"), F.lit(stride).alias("stride"))


def parse_qualifier(c: Column) -> Column:
    """struct(negated, qualifier), in lower case: 'NOT|x' is (true, x), NOT without a bar (true, ''), null (false, ''), else (false, the word)."""
    word = F.trim(F.coalesce(c, F.lit("")))
    negated = F.upper(word).startswith("NOT")
    after = F.when(F.contains(word, F.lit("|")), F.regexp_replace(word, r"^[^|]*\|", "")).otherwise("")
    return F.struct(negated.alias("negated"), F.lower(F.when(negated, after).otherwise(word)).alias("qualifier"))
