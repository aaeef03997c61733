"""Retrieval over a two-level index of records and their chunks, for all queries at once.

Rankings are tables (query_id, id, score, rank), chunk rankings have chunk_idx as well; rank begins at 1 and ties go to the
smaller id. Dense search meets only parts that can hold an answer; sparse search is BM25 with a fixed average length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import erase, written

#: English words that carry no meaning of their own.
STOP_WORDS = "a an and are as at be but by for if in into is it no not of on or such that the their then there these they this to was will with".split()
PREFETCH, RRF_K = 200, 60


def light_stem(term: Column) -> Column:
    """English plurals made singular: -ies to -y, -es to -e, -s off; not after the letters that make no plural."""
    return (
        F.when(~F.endswith(term, F.lit("s")), term)  # most words: without a look at the patterns
        .when(F.rlike(term, F.lit("[^ea]ies$")), F.regexp_replace(term, "ies$", "y"))
        .when(F.rlike(term, F.lit("[^aeo]es$")), F.regexp_replace(term, "es$", "e"))
        .when(F.rlike(term, F.lit("[^us]s$")), F.regexp_replace(term, "s$", ""))
        .otherwise(term)
    )


def _words(stop_words: list[str] | None, stem: Callable[[Column], Column] | None) -> Column:
    stop = STOP_WORDS if stop_words is None else stop_words
    words = F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: (w != "") & ~w.isin(stop))
    return F.transform(words, stem) if stem else words


def terms(docs: DataFrame, stop_words: list[str] | None = None, stem: Callable[[Column], Column] | None = light_stem, keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """docs(keys, text) -> keys, term, length (of the text in terms): runs of letters and digits in lower case, without stop words, stemmed."""
    words = _words(stop_words, stem)
    # One row of words with their number: it is counted before they part, and the text goes no further.
    row = F.transform(F.array(words), lambda w: F.struct(w.alias("w"), F.size(w).alias("length")))
    cut = docs.select(*keys, F.inline(row))
    return cut.select(*keys, "length", F.explode("w").alias("term"))


def bm25_index(docs: DataFrame, k: float = 1.2, b: float = 0.75, avg_len: float = 256.0, stop_words: list[str] | None = None, stem: Callable[[Column], Column] | None = light_stem, keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """docs(keys, text) -> keys, term, weight: the saturated term frequency, with a fixed average length.

    Terms are counted within each row; only those of keys that several rows share are shuffled, to be added up. Such keys are
    looked for first, in a pass over the keys alone.
    """
    several = written(docs.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").select(*(F.col(c).alias(f"_{c}") for c in keys)), "keys-of-several")
    counted = lambda df: df.select(*keys, F.inline(_term_counts(_words(stop_words, stem))))
    if several.isEmpty():
        erase(several)
        tf = counted(docs)
    else:
        same = reduce(lambda x, y: x & y, (docs[c].eqNullSafe(several[f"_{c}"]) for c in keys))
        again = counted(docs.join(several, same, "left_semi")).groupBy(*keys, "term").agg(F.sum("_tf").alias("_tf"), F.first("_len").alias("_len"))
        tf = counted(docs.join(several, same, "left_anti")).unionByName(again)
    return tf.select(*keys, "term", (F.col("_tf") * (k + 1) / (F.col("_tf") + k * (1 - b + b * F.col("_len") / avg_len))).alias("weight"))


def _term_counts(words: Column) -> Column:
    """Array of (term, _tf, _len) of an array of words: the distinct ones, how often each comes and how many there are in all."""

    def count(lists):
        size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = lists.flatten().dictionary_encode("encode")
        n = max(1, len(coded.dictionary))
        key, times = np.unique(np.repeat(np.arange(len(lists)), size) * n + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
        row = key // n
        found = pa.StructArray.from_arrays([coded.dictionary.take(pa.array(key % n)).cast(pa.string()), pa.array(times), pa.array(size[row])], ["term", "_tf", "_len"])
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(lists) + 1)).astype(np.int32)), found)

    count.__annotations__ = {"lists": pa.Array, "return": pa.Array}
    return F.arrow_udf(count, "array<struct<term:string,_tf:long,_len:long>>")(words)


def inverse_frequency(index: DataFrame, n_docs: int | Column) -> DataFrame:
    df = index.groupBy("term").agg(F.count("*").alias("df"))
    return df.select("term", "df", F.log((F.lit(n_docs) - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1).alias("idf"))


def top(scores: DataFrame, k: int, by: tuple[str, ...] = ("query_id",), ids: tuple[str, ...] = ("id",)) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), *ids))
    return scores.withColumn("rank", rank).where(F.col("rank") <= k)


def sparse(queries: DataFrame, index: DataFrame, n_docs: int, k: int, ids: tuple[str, ...] = ("id",), within: DataFrame | None = None, part_rows: int = 1 << 22) -> DataFrame:
    """queries(query_id, term) -> the k best of each query by the sum of weight (above 0) times idf; each term counts once.

    within(query_id, id): only these are scored, by the idf of the whole index; their rows of the index are found by id
    first. Else every posting of every term is added up, part by part: see `_scan`; `sparse_bounded` gives the same rows
    and leaves postings unread.
    """
    wanted = queries.select("query_id", "term").distinct()
    some = written(index.join(F.broadcast(wanted.select("term").distinct()), "term", "left_semi"), "wanted-postings")
    idf = written(inverse_frequency(some, n_docs), "idf")
    if within is None:
        out = written(_scan(wanted, some, idf, k, ids, part_rows, False)[0], "ranking")
        erase(some, idf)
        return out
    matches = some.join(within.select("query_id", "id"), "id").join(wanted, ["query_id", "term"]).join(F.broadcast(idf), "term")
    score = matches.groupBy("query_id", *ids).agg(F.round(F.sum(F.col("weight") * F.col("idf")), 6).alias("score"))
    return top(score, k, ids=ids)


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k greatest scores, in order; ties go to the smaller place."""
    at = np.arange(len(scores)) if len(scores) <= k else np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return at[np.argsort(-scores[at], kind="stable")[:k]]


def _places(columns: list[pa.ChunkedArray]) -> tuple[np.ndarray, np.ndarray]:
    """(each row's place among the distinct rows in ascending order, a row for each place)."""
    codes, n = np.zeros(len(columns[0]), np.int64), 1
    for c in columns:
        coded = c.combine_chunks().dictionary_encode()
        rank = np.empty(len(coded.dictionary), np.int64)
        rank[pc.array_sort_indices(coded.dictionary).to_numpy()] = np.arange(len(rank))
        codes, n = np.unique(codes, return_inverse=True)[1] * len(rank) + rank[coded.indices.to_numpy()], n * len(rank)
    _, first, place = np.unique(codes, return_index=True, return_inverse=True)
    return place, first


SLACK = 4e-6  #: more than the rounding of angles and of scores


def _add_up(starts: np.ndarray, docs: np.ndarray, weights: np.ndarray, slots: np.ndarray, n: int, k: int, floor: float, bounded: bool) -> tuple[np.ndarray, np.ndarray, int]:
    """(places, scores to 6 places, postings looked at) of a query's k best in one part of an index; slots: its terms there.

    Bounded: terms are read from that of the greatest weight down, until those left cannot lift a document that holds no
    other to the k-th score so far; after that only documents that can still reach it are looked up.
    """
    acc, looked = np.zeros(n), 0
    spans = [slice(starts[j], starts[j + 1]) for j in slots]
    if bounded:
        bound = np.array([weights[x].max() for x in spans])
        order = np.argsort(-bound, kind="stable")
        spans, rest = [spans[i] for i in order], np.append(np.cumsum(bound[order][::-1])[::-1], 0.0)
    for i, x in enumerate(spans):
        if bounded and i:
            if np.count_nonzero(acc) >= k:
                floor = max(floor, np.partition(acc, n - k)[n - k])
            if rest[i] < floor - SLACK:
                break
        acc[docs[x]] += weights[x]
        looked += x.stop - x.start
    else:
        i = len(spans)
    found = np.flatnonzero(acc)
    for j in range(i, len(spans)):
        found = found[acc[found] + rest[j] >= floor - SLACK]
        x = spans[j]
        at = np.minimum(np.searchsorted(docs[x], found), x.stop - x.start - 1)
        hit = docs[x][at] == found
        acc[found[hit]] += weights[x][at[hit]]
        looked += len(found)
    scores = np.round(acc[found], 6)
    found, scores = found[scores >= floor - SLACK], scores[scores >= floor - SLACK]
    best = _best(scores, k)
    return found[best], scores[best], looked


def _scan(wanted: DataFrame, index: DataFrame, idf: DataFrame, k: int, ids: tuple[str, ...], part_rows: int, bounded: bool, query_rows: int = 1 << 16) -> tuple[DataFrame, DataFrame | None]:
    """(ranking, read(query_id, read) if bounded) of wanted(query_id, term) over the postings of index, cut by document into
    parts of about part_rows postings: a task adds up one part for as many as query_rows queries.

    Of many parts the square root of their number comes first: a query's k-th score there is a floor, and the other parts
    give only what reaches it, so that the answers of all parts together stay few. index and idf are written tables.
    """
    spark, form = index.sparkSession, lambda df, c: df.schema[c].dataType.simpleString()
    n_parts = max(1, -(-index.count() // part_rows))
    codes = written(idf.select("term", "idf", F.monotonically_increasing_id().alias("_t")), "terms")
    asked = written(wanted.join(F.broadcast(codes), "term").groupBy("query_id").agg(F.collect_list("_t").alias("_ts")), "asked")
    blocks = max(1, -(-asked.count() // query_rows))
    weighed = index.join(F.broadcast(codes), "term").select(*ids, "_t", (F.col("weight") * F.col("idf")).alias("_w"), F.pmod(F.xxhash64(*ids), F.lit(n_parts)).alias("_p"))
    out = ", ".join([f"query_id {form(wanted, 'query_id')}", *(f"{c} {form(index, c)}" for c in ids), "score double", "_read long"])

    def meet(q: pa.Table, v: pa.Table) -> pa.Table:
        place, first = _places([v[c] for c in ids]) if len(v) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        t, w = v["_t"].to_numpy(), v["_w"].to_numpy()
        order = np.lexsort((place, t))
        t, place, w = t[order], place[order], w[order]
        here, starts = np.unique(t, return_index=True)
        starts = np.append(starts, len(t))
        rows, at, scores, looked = [], [], [], []
        for i, (ts, floor) in enumerate(zip(q["_ts"], q["_floor"].to_pylist())):
            ts = np.asarray(ts.values)
            slot = np.searchsorted(here, ts)
            slot = slot[(slot < len(here)) & (here[np.minimum(slot, len(here) - 1)] == ts)] if len(here) else slot[:0]
            found, score, read = _add_up(starts, place, w, slot, len(first), k, floor or 0.0, bounded)
            rows.append(np.full(len(found), i))
            at.append(first[found])
            scores.append(score)
            looked.append(read)
        flat = lambda parts, kind: np.concatenate([*parts, np.zeros(0, kind)]).astype(kind)
        rows, at = pa.array(flat(rows, np.int64)), pa.array(flat(at, np.int64))
        names = ["query_id", *ids, "score", "_read"]
        best = pa.table([q["query_id"].take(rows), *(v[c].take(at) for c in ids), pa.array(flat(scores, float)), pa.nulls(len(rows), pa.int64())], names=names)
        if not bounded:
            return best
        none = [pa.nulls(len(q), v.schema.field(c).type) for c in ids]
        return pa.concat_tables([best, pa.table([q["query_id"], *none, pa.nulls(len(q), pa.float64()), pa.array(looked, pa.int64())], names=names)])

    def pass_(q: DataFrame, lo: int, hi: int) -> DataFrame:
        number = lambda a, b: F.explode(F.sequence(F.lit(a).cast("long"), F.lit(b - 1).cast("long")))
        q = q.withColumn("_b", F.pmod(F.xxhash64("query_id"), F.lit(blocks).cast("long"))).withColumn("_p", number(lo, hi))
        v = weighed.where(F.col("_p").between(lo, hi - 1)).withColumn("_b", number(0, blocks))
        return written(q.groupBy("_p", "_b").cogroup(v.groupBy("_p", "_b")).applyInArrow(meet, out), "found")

    lead = n_parts if n_parts <= 4 else int(np.ceil(np.sqrt(n_parts)))
    passes = [pass_(asked.withColumn("_floor", F.lit(None).cast("double")), 0, lead)]
    answers = lambda df: df.where("score is not null").drop("_read")
    if lead < n_parts:
        floors = top(answers(passes[0]), k, ids=ids).where(F.col("rank") == k).select("query_id", F.col("score").alias("_floor"))
        passes.append(pass_(asked.join(floors, "query_id", "left"), lead, n_parts))
    found = reduce(DataFrame.unionByName, passes)
    read = found.where("_read is not null").groupBy("query_id").agg(F.sum("_read").alias("read")) if bounded else None
    return top(answers(found), k, ids=ids), read


def block_index(index: DataFrame, rows: int = 4096, levels: int = 32, ids: tuple[str, ...] = ("id",)) -> DataFrame:
    """index(ids, term, weight) -> term, level, part, max_weight, min_weight, n, postings (array of ids): a term's postings in
    blocks of like weight, the heaviest at level 0, of about `rows` at most. Where one level of a term has more, a hash cuts it."""
    most = index.agg(F.max("weight")).first()[0] or 1.0
    level = F.least(F.floor((1 - F.col("weight") / most) * levels), F.lit(levels - 1)).cast("int")
    at = index.select("term", level.alias("level"), "weight", F.struct(*ids).alias("_id"))
    parts = F.ceil(F.count("*").over(Window.partitionBy("term", "level")) / rows)  # one shuffle for counts and blocks
    cut = at.withColumn("_parts", parts).withColumn("part", F.pmod(F.xxhash64("_id"), F.col("_parts")))
    return cut.groupBy("term", "level", "part").agg(F.max("weight").alias("max_weight"), F.min("weight").alias("min_weight"), F.count("*").alias("n"), F.collect_list("_id").alias("postings"))


@dataclass
class Sparse:
    """ranking(query_id, ids, score, rank) and read(query_id, read, postings): postings that were looked at for a query, and those of its terms in all."""

    ranking: DataFrame
    read: DataFrame


def sparse_bounded(queries: DataFrame, index: DataFrame, blocks: DataFrame, n_docs: int, k: int, ids: tuple[str, ...] = ("id",), part_rows: int = 1 << 22) -> Sparse:
    """The rows of `sparse`, without reading all postings.

    Frequencies come from the blocks (see block_index). A term adds at most its greatest weight times its idf to a score.
    In each part of the index a query's terms are read from the greatest bound down; once those left cannot reach the k-th
    score so far even together, they are only looked up for the documents that can (see `_scan`). The tables of both
    results are written and stay.
    """
    wanted = queries.select("query_id", "term").distinct()
    df = blocks.join(F.broadcast(wanted.select("term").distinct()), "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df"))
    idf = written(df.withColumn("idf", F.log((F.lit(n_docs) - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1)), "idf")
    some = written(index.join(F.broadcast(idf.select("term")), "term", "left_semi"), "wanted-postings")
    ranking, looked = _scan(wanted, some, idf, k, ids, part_rows, True)
    everything = wanted.join(F.broadcast(idf), "term").groupBy("query_id").agg(F.sum("df").alias("postings"))
    read = written(looked.join(everything, "query_id").select("query_id", "read", "postings"), "read")
    ranking = written(ranking, "ranking")
    erase(some)
    return Sparse(ranking, read)


def _vectors(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.combine_chunks()
    v = rows.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(rows), -1) if len(rows) else np.zeros((0, 1))
    return v / np.maximum(np.sqrt((v * v).sum(1, keepdims=True)), 1e-300)


@dataclass
class Nearest:
    """ranking(query_id, id, score, rank) and compared(query_id, parts, rows): the parts, and their rows, that each query met."""

    ranking: DataFrame
    compared: DataFrame


def dense(queries: DataFrame, vectors: DataFrame, k: int, query_rows: int = 1024, vector_rows: int = 32_768) -> DataFrame:
    """queries(query_id, dense), vectors(id, dense) -> the k vectors of greatest cosine, rounded to 6 places, for each query: see `nearest`."""
    return nearest(queries, vectors, k, query_rows, vector_rows).ranking


def nearest(queries: DataFrame, vectors: DataFrame, k: int, query_rows: int = 1024, vector_rows: int = 32_768, most_pivots: int = 1024, rings: int = 8) -> Nearest:
    """Exact search by cosine that looks only where a query's k best can be.

    Vectors belong to the pivot that is nearest by angle, and within it to a ring of angles. By the triangle inequality a
    ring with angles lo to hi holds nothing nearer to a query, at angle a from the pivot, than a - hi or lo - a. A query
    first meets the rings of the highest bounds that hold k rows; its k-th score there is a floor, and of the other rings
    only those whose bound reaches the floor are searched. So a query is sent to the rings that it needs, and to no other;
    one whose rings hold more than half of all rows (as where vectors have no clusters) meets all rows in large parts. A ring of more than vector_rows rows is cut by hash, equal vectors
    included, and where more than query_rows queries need it, they are dealt over tasks, each with a copy of the ring. A table of
    at most vector_rows rows is one part, without rings.

    Vectors that are null, hold a null or not a number, or are zero take no part; all have one length. Of queries with one
    query_id one is answered. The driver sees pivots (at most most_pivots) and rings (`rings` times as many), chosen and
    counted; intermediate tables are deleted, the two results are written.
    """
    good = lambda df: df.where("dense is not null and not exists(dense, x -> x is null or isnan(x)) and exists(dense, x -> x <> 0)")
    queries, vectors = good(queries.select("query_id", "dense")).dropDuplicates(["query_id"]), good(vectors.select("id", "dense"))
    spark, n = vectors.sparkSession, vectors.count()
    id_type, query_type, dense_type, q_dense = (df.schema[c].dataType.simpleString() for df, c in ((vectors, "id"), (queries, "query_id"), (vectors, "dense"), (queries, "dense")))
    score_form = f"query_id {query_type}, id {id_type}, score double"
    if not n:
        return Nearest(spark.createDataFrame([], f"{score_form}, rank int"), spark.createDataFrame([], f"query_id {query_type}, parts long, rows long"))
    dims = vectors.select(F.size("dense")).first()[0]

    def meet(q: pa.Table, v: pa.Table) -> pa.Table:
        v = v.take(pc.sort_indices(v["id"]))
        a, b = _vectors(q["dense"]), _vectors(v["dense"]).T if len(v) else np.zeros((1, 0))
        floors = q["floor"].to_numpy(zero_copy_only=False).astype(float) if "floor" in q.column_names else np.full(len(q), np.nan)
        rows, at, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        few = max(1, (1 << 22) // max(1, len(v)))  # 32 MB of scores at once
        for lo in range(0, len(q) if len(v) else 0, few):
            for i, row in enumerate(a[lo : lo + few] @ b, lo):
                near = np.arange(len(row)) if np.isnan(floors[i]) else np.flatnonzero(row >= floors[i] - slack)
                found = np.round(row[near], 6) + 0.0
                best = _best(found, k)
                rows.append(np.full(len(best), i))
                at.append(near[best])
                scores.append(found[best])
        rows, at = pa.array(np.concatenate(rows)), pa.array(np.concatenate(at))
        return pa.table([q["query_id"].take(rows), v["id"].take(at), pa.array(np.concatenate(scores))], names=["query_id", "id", "score"])

    def exhaust(q: DataFrame) -> DataFrame:
        """The k best of q(query_id, dense[, floor]) in each part of all vectors: a part is of about 64 MB, and as many queries meet it in a task as fill 32 MB."""
        parts, asking = max(1, -(-n * dims // (1 << 23))), q.count()
        blocks = max(1, -(-asking * dims // (1 << 22)), min(-(-16 // parts), -(-asking // query_rows)))
        number = lambda most: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(most - 1).cast("long")))
        q = q.withColumn("_b", F.pmod(F.xxhash64("query_id"), F.lit(blocks).cast("long"))).withColumn("_p", number(parts))
        v = vectors.withColumn("_p", F.pmod(F.xxhash64("id", "dense"), F.lit(parts).cast("long"))).withColumn("_b", number(blocks))
        return q.groupBy("_p", "_b").cogroup(v.groupBy("_p", "_b")).applyInArrow(meet, score_form)

    slack = SLACK
    if n <= vector_rows:  # one part: every query meets it
        return Nearest(top(exhaust(queries), k), queries.select("query_id", F.lit(1).cast("long").alias("parts"), F.lit(n).cast("long").alias("rows")))
    chosen = vectors.orderBy(F.xxhash64("id"), F.xxhash64("dense")).limit(min(most_pivots, max(1, n // (64 * rings)))).select("dense").toArrow()
    pivots = spark.sparkContext.broadcast(np.unique(_vectors(chosen["dense"]), axis=0))

    def slices(batches: Iterator[pa.RecordBatch], wide: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        """Rows and their cosines with the pivots, so few at once that `wide` numbers a row fill 16 MB."""
        few = max(1, (1 << 21) // wide)
        for batch in batches:
            for lo in range(0, len(batch), few):
                part = batch.slice(lo, few)
                yield part, np.clip(_vectors(pa.chunked_array([part.column(1)])) @ pivots.value.T, -1, 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, cosines in slices(batches, len(pivots.value)):
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cosines.argmax(1)), pa.array(np.arccos(cosines.max(1, initial=-1)))], ["id", "dense", "cell", "angle"])

    cells = written(vectors.mapInArrow(place, f"id {id_type}, dense {dense_type}, cell long, angle double"), "cells")
    cuts = cells.groupBy("cell").agg(F.approx_percentile("angle", F.array(*(F.lit(i / rings) for i in range(1, rings))), 1000).alias("_cuts"))  # a row a pivot
    ringed = cells.join(F.broadcast(cuts), "cell").withColumn("ring", F.size(F.filter("_cuts", lambda c: c < F.col("angle")))).drop("_cuts")
    summary = ringed.groupBy("cell", "ring").agg(F.count("*").alias("n"), F.min("angle").alias("lo"), F.max("angle").alias("hi")).collect()
    at = spark.sparkContext.broadcast({c: np.array([r[c] for r in summary]) for c in ("cell", "ring", "n", "lo", "hi")})
    def wanted(batches: Iterator[pa.RecordBatch], how: str) -> Iterator[pa.RecordBatch]:
        """query_id, dense[, floor] -> a row for each ring that the query meets first, or then; count: how many rows it would then meet."""
        cell, ring, rows, lo, hi = (at.value[c] for c in ("cell", "ring", "n", "lo", "hi"))
        for batch, cosines in slices(batches, len(cell)):
            a = np.arccos(cosines)[:, cell]
            bound = np.cos(np.maximum(np.maximum(a - hi, lo - a) - slack, 0))
            order = np.argsort(-bound, axis=1, kind="stable")
            before = np.cumsum(rows[order], axis=1) - rows[order]
            need = np.zeros(bound.shape, bool)
            np.put_along_axis(need, order, before < k, axis=1)
            if how != "first":
                floor = batch.column(2).to_numpy(zero_copy_only=False).astype(float)  # null, not a number: fewer than k so far
                need = ~need & ~(bound + slack < floor[:, None])
            if how == "count":
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(need @ rows)], ["query_id", "_meets"])
                continue
            q, r = np.nonzero(need)
            for i in range(0, len(q), 1 << 15):  # each takes the query's vector along
                take, to = pa.array(q[i : i + (1 << 15)]), r[i : i + (1 << 15)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(cell[to]), pa.array(ring[to].astype(np.int32))], ["query_id", "dense", "cell", "ring"])

    def search(sent: DataFrame) -> DataFrame:
        """The k best of each query in each part of the rings that it is sent to."""
        asked = {(r["cell"], r["ring"]): r["n"] for r in sent.groupBy("cell", "ring").agg(F.count("*").alias("n")).collect()}  # a row a ring
        sizes = spark.createDataFrame(
            [(r["cell"], r["ring"], -(-r["n"] // vector_rows), -(-asked[r["cell"], r["ring"]] // query_rows)) for r in summary if (r["cell"], r["ring"]) in asked], "cell long, ring int, _parts long, _blocks long"
        )
        one = F.lit(1).cast("long")
        q = sent.join(F.broadcast(sizes), ["cell", "ring"]).withColumn("_b", F.pmod(F.xxhash64("query_id"), F.col("_blocks"))).withColumn("_p", F.explode(F.sequence(one, F.col("_parts"))))
        v = ringed.join(F.broadcast(sizes), ["cell", "ring"]).withColumn("_p", F.pmod(F.xxhash64("id", "dense"), F.col("_parts")) + 1).withColumn("_b", F.explode(F.sequence(one - 1, F.col("_blocks") - 1)))
        key, cols = ["cell", "ring", "_p", "_b"], ["cell", "ring", "_p", "_b", "dense"]
        return q.select("query_id", *cols).groupBy(*key).cogroup(v.select("id", *cols).groupBy(*key)).applyInArrow(meet, score_form)

    form = f"query_id {query_type}, dense {q_dense}, cell long, ring int"
    sent = written(queries.mapInArrow(lambda it: wanted(it, "first"), form), "first")
    found = written(top(search(sent), k), "found")
    floors = found.where(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
    floored = written(queries.join(floors, "query_id", "left").select("query_id", "dense", "floor"), "floors")
    # Rings that spare less than half of all rows cost more than they save: such queries meet all parts instead.
    meets = floored.mapInArrow(lambda it: wanted(it, "count"), f"query_id {query_type}, _meets long")
    counted = written(floored.join(meets, "query_id"), "counted")
    few, many = counted.where(F.col("_meets") * 2 <= n).drop("_meets"), counted.where(F.col("_meets") * 2 > n).drop("_meets")
    again = written(few.mapInArrow(lambda it: wanted(it, "then"), form), "then")
    ringwise = found.drop("rank").join(few.select("query_id"), "query_id", "left_semi").unionByName(search(again))
    ranking = written(top(ringwise.unionByName(exhaust(many)), k), "ranking")
    sizes = spark.createDataFrame([(r["cell"], r["ring"], -(-r["n"] // vector_rows), r["n"]) for r in summary], "cell long, ring int, _parts long, _n long")
    met = sent.join(few.select("query_id"), "query_id", "left_semi").unionByName(again).join(F.broadcast(sizes), ["cell", "ring"])  # a row a ring
    all_parts = sum(-(-r["n"] // vector_rows) for r in summary)
    compared = met.groupBy("query_id").agg(F.sum("_parts").alias("parts"), F.sum("_n").alias("rows"))
    compared = written(compared.unionByName(many.select("query_id", F.lit(all_parts).cast("long").alias("parts"), F.lit(n).cast("long").alias("rows"))), "compared")
    erase(cells, sent, found, floored, counted, again)
    return Nearest(ranking, compared)


def rrf(rankings: list[DataFrame], k: int, k0: int = RRF_K, ids: tuple[str, ...] = ("id",)) -> DataFrame:
    """Reciprocal-rank fusion of rankings."""
    both = reduce(DataFrame.unionByName, (r.select("query_id", *ids, "rank") for r in rankings))
    fused = both.groupBy("query_id", *ids).agg(F.round(F.sum(1.0 / (F.col("rank") + k0)), 9).alias("score"))
    return top(fused, k, ids=ids)


def record_hybrid(dense_ranking: DataFrame, sparse_ranking: DataFrame, k: int, prefetch: int = PREFETCH) -> DataFrame:
    """The k best records by fusion of the first `prefetch` of both rankings."""
    return rrf([r.where(F.col("rank") <= prefetch) for r in (dense_ranking, sparse_ranking)], k)


def chunk_hybrid(queries: DataFrame, query_terms: DataFrame, chunks: DataFrame, index: DataFrame, shortlist: DataFrame, n_chunks: int, prefetch: int) -> DataFrame:
    """Fused ranking (query_id, id, chunk_idx, score, rank) of the chunks of shortlisted records.

    chunks(id, chunk_idx, dense), index(id, chunk_idx, term, weight), shortlist(query_id, id).
    """
    ids = ("id", "chunk_idx")
    near = shortlist.select("query_id", "id").join(chunks.select(*ids, "dense"), "id").join(queries.select("query_id", F.col("dense").alias("_q")), "query_id")
    norm = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, x: a + x * x))
    dot = F.aggregate(F.zip_with("dense", "_q", lambda x, y: x.cast("double") * y), F.lit(0.0), lambda a, x: a + x)
    by_vector = top(near.select("query_id", *ids, F.round(dot / norm("dense") / norm("_q"), 6).alias("score")), prefetch, ids=ids)
    by_words = sparse(query_terms, index, n_chunks, prefetch, ids=ids, within=shortlist)
    return rrf([by_vector, by_words], prefetch * 2, ids=ids)


def best_chunks(hits: DataFrame, n: int) -> DataFrame:
    """The n best chunks of each query and record of a chunk ranking; `place` counts them from 1."""
    place = F.row_number().over(Window.partitionBy("query_id", "id").orderBy(F.desc("score"), "chunk_idx"))
    return hits.withColumn("place", place).where(F.col("place") <= n)


def attach_snippets(ranking: DataFrame, best: DataFrame, chunks: DataFrame, n: int) -> DataFrame:
    """ranking with snippets: array of (place, chunk_idx, text, score, chars) of each record's n best chunks; order and rows stay."""
    texts = best.where(F.col("place") <= n).join(chunks.select("id", "chunk_idx", "text"), ["id", "chunk_idx"])
    snippet = F.struct("place", "chunk_idx", "text", "score", F.length("text").alias("chars"))
    found = texts.groupBy("query_id", "id").agg(F.array_sort(F.collect_list(snippet)).alias("snippets"))
    none = F.array().cast(found.schema["snippets"].dataType)
    return ranking.join(found, ["query_id", "id"], "left").withColumn("snippets", F.coalesce("snippets", none))


def blom(n: Column, most: int = 200) -> Column:
    """Expected greatest of n standard normals, by Blom's approximation; 0 for fewer than 2. Tables longer than `most` draws end there."""
    values = [0.0, 0.0, *(NormalDist().inv_cdf((i - 0.375) / (i + 0.25)) for i in range(2, most + 1))]
    return F.get(F.array(*map(F.lit, values)), F.least(n, F.lit(most)).cast("int"))


def chunk_rerank(shortlist: DataFrame, best: DataFrame, k: int, how: str = "max") -> DataFrame:
    """query_id, id, record_rank, chunk_score, rank: shortlist(query_id, id, rank) in the order of its records' best chunks.

    how: max, top2 (mean of the two best), lognorm (max less Blom's advantage of many draws, in the record's own standard
    deviation) or rrf (fusion of the record's rank with that of its best chunk). Ties keep the records' order; records
    without a chunk come after all others, in their order.
    """
    s = best.groupBy("query_id", "id").agg(F.array_sort(F.collect_list("score")).alias("_s"), F.max("score").alias("_max"), F.stddev_pop("score").alias("_sd"), F.count("*").alias("_n"))
    two = F.aggregate(F.slice("_s", F.greatest(F.size("_s") - 1, F.lit(1)), 2), F.lit(0.0), lambda a, x: a + x) / F.least(F.size("_s"), F.lit(2))
    score = {"max": F.col("_max"), "rrf": F.col("_max"), "top2": two, "lognorm": F.when(F.col("_n") < 2, F.col("_max")).otherwise(F.col("_max") - blom(F.col("_n")) * F.col("_sd"))}[how]
    both = shortlist.select("query_id", "id", F.col("rank").alias("record_rank")).join(s.select("query_id", "id", F.round(score, 12).alias("chunk_score")), ["query_id", "id"], "left")
    query = Window.partitionBy("query_id")
    key = F.col("chunk_score")
    if how == "rrf":
        chunk_rank = F.row_number().over(query.orderBy(F.desc_nulls_last("chunk_score"), "record_rank"))
        key = F.when(F.col("chunk_score").isNotNull(), F.round(1.0 / (RRF_K + F.col("record_rank")) + 1.0 / (RRF_K + chunk_rank), 12))
    ranked = both.withColumn("_key", key).withColumn("rank", F.row_number().over(query.orderBy(F.desc_nulls_last("_key"), "record_rank")))
    return ranked.where(F.col("rank") <= k).drop("_key")


def snippets(asked: DataFrame, queries: DataFrame, query_terms: DataFrame, chunks: DataFrame, index: DataFrame, n_chunks: int, n: int = 3) -> DataFrame:
    """The n best chunks of each record of asked(query_id, id) against its query."""
    hits = chunk_hybrid(queries, query_terms, chunks, index, asked, n_chunks, prefetch=50)
    return best_chunks(hits, n)


def expand(asked: DataFrame, records: DataFrame, chunks: DataFrame, radius: int = 1) -> DataFrame:
    """asked(id, chunk_idx) with the sentences [start, end) around each chunk, radius more on either side: of, at_start, at_end, text, chars; error where there is no such chunk or record."""
    found = asked.select("id", "chunk_idx").join(chunks.select("id", "chunk_idx", "sent_start", "sent_end"), ["id", "chunk_idx"], "left").join(records.select("id", "sentences"), "id", "left")
    of = F.when(F.col("sentences").isNotNull(), F.size("sentences"))
    start, end = F.greatest(F.lit(0), F.col("sent_start") - radius), F.least(of, F.col("sent_end") + radius)
    ok = F.col("sent_start").isNotNull() & of.isNotNull()
    span = found.select("id", "chunk_idx", "sentences", F.when(ok, start).alias("start"), F.when(ok, end).alias("end"), F.when(ok, of).alias("of"), F.when(F.col("sent_start").isNull(), "no chunk").when(of.isNull(), "no record").alias("error"))
    words = F.when(F.col("error").isNull(), F.array_join(F.slice("sentences", F.col("start") + 1, F.col("end") - F.col("start")), " "))
    out = span.select("id", "chunk_idx", "start", "end", "of", (F.col("start") == 0).alias("at_start"), (F.col("end") == F.col("of")).alias("at_end"), words.alias("text"), "error")
    return out.withColumn("chars", F.length("text"))


def read_record(asked: DataFrame, records: DataFrame) -> DataFrame:
    """asked(id) with the record's text, n_chunks and entrez_id; error where there is none."""
    out = asked.select("id").join(records.select("id", "text", "n_chunks", "entrez_id"), "id", "left")
    return out.withColumn("error", F.when(F.col("n_chunks").isNull(), F.lit("no record")))


def by_entrez(asked: DataFrame, records: DataFrame) -> DataFrame:
    """asked(entrez_id) -> entrez_id, id, text, n_chunks of all records that list it."""
    listed = records.select("id", "text", "n_chunks", F.explode("entrez_id").alias("entrez_id"))
    return asked.select("entrez_id").distinct().join(listed, "entrez_id")
