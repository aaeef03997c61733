"""Exact top-k search by a Voronoi join.

Rows, queries among them, belong to the cell of their nearest pivot. For each cell a summary is kept: its pivot, its
radius, its greatest norm and its number of rows. With q.v = q.p + q.(v - p), a cell's scores lie within q.p -+ |q| r, so
the summaries give each query a score that its k-th answer surely reaches, and a cell whose best possible score is less
is not needed. A query meets only the cells that it needs, in blocks with others of its cell that need them; cells are cut into packed
chunks of bounded size, so a cell that holds a third of all rows is dealt over many tasks. Each meeting yields the k best
of a query, and these are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

PACK = "cell int, chunk int, ids binary, data binary, kind string"


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as an int64 matrix; shorter vectors get zeros, which add nothing to a score."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def _packed(m: np.ndarray) -> tuple[bytes, str]:
    """The matrix in the narrowest type that holds it."""
    top = int(np.abs(m).max(initial=0))
    kind = next((t for t in ("int16", "int32") if top <= np.iinfo(t).max), "int64")
    return m.astype(kind).tobytes(), kind


def _scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in doubles where no sum can leave their whole numbers, else in 64-bit integers."""
    if float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * q.shape[1] < 2**52:
        return (q.astype(np.float64) @ v.astype(np.float64).T).astype(np.int64)
    return q.astype(np.int64) @ v.astype(np.int64).T


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, by score, then smaller id."""
    if len(ids) > 4 * k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= floor)
    else:
        at = np.arange(len(ids))
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def _top(batches_of_frames, width: int, k: int):
    for batch in batches_of_frames:
        rows = {"query_id": [], "vec_id": [], "score": []}
        for r in batch.to_pylist():
            q_ids, v_ids = np.frombuffer(r["q_ids"], np.int64), np.frombuffer(r["ids"], np.int64)
            s = _scores(np.frombuffer(r["q_data"], r["q_kind"]).reshape(-1, width), np.frombuffer(r["data"], r["kind"]).reshape(-1, width))
            for i, q in enumerate(q_ids):
                others = np.flatnonzero(v_ids != q)
                at = others[_best(s[i, others], v_ids[others], k)]
                rows["query_id"].append(np.full(len(at), q))
                rows["vec_id"].append(v_ids[at])
                rows["score"].append(s[i, at])
        if rows["score"]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in rows.values()], list(rows))


def inner_product_topk(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, chunk_rows: int = 4096, query_rows: int = 1024, most_pivots: int = 1024) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row with is_query its k best others (all, if fewer).

    vectors(vec_id, embedding): components become floor(scale * x); the score is the integer inner product, ties go to
    the smaller vec_id. A row takes no part if its vec_id or vector is null or the vector holds a null or non-finite
    component. Vectors of unlike length score over the components that both have. Rows that repeat a vec_id are
    candidates each, but not of a query of that id; a repeated query is answered once, by the least of its vectors. An empty table gives an empty one.
    Other columns are ignored. Pivots are at most most_pivots rows, chosen by a hash; every row is searched.
    """
    spark = vectors.sparkSession
    x = F.col("embedding")
    fit = F.forall(x, lambda a: a.isNotNull() & ~F.isnan(a.cast("double")) & (F.abs(a.cast("double")) < float("inf")))
    ints = F.transform(x, lambda a: F.floor(a.cast("double") * scale).cast("long"))
    rows = vectors.where(F.col("vec_id").isNotNull() & x.isNotNull()).where(fit).select(F.col("vec_id").cast("long").alias("vec_id"), ints.alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    total, width = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    if not total or not width:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    n_pivots = min(most_pivots, max(16, total // chunk_rows))
    chosen = rows.select("vec_id", "v", F.xxhash64("vec_id").alias("h")).orderBy("h", "vec_id").limit(n_pivots).collect()  # at most most_pivots rows
    pivots = np.zeros((len(chosen), width), np.int64)
    for i, r in enumerate(chosen):
        pivots[i, : len(r["v"])] = r["v"]
    pivots, first = np.unique(pivots, axis=0, return_index=True)
    shared = spark.sparkContext.broadcast((pivots.astype(np.float64), np.array([chosen[i]["vec_id"] for i in first])))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value[0]
        half = (p * p).sum(1) / 2
        for b in batches:
            m = _matrix(b.column(1), width).astype(np.float64)
            cell = (m @ p.T - half).argmax(1)
            away = np.sqrt(((m - p[cell]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32)), pa.array(away), pa.array(np.sqrt((m * m).sum(1)))], ["vec_id", "v", "is_query", "cell", "away", "norm"])

    placed = rows.mapInArrow(assign, "vec_id long, v array<long>, is_query boolean, cell int, away double, norm double")
    placed = written(placed.withColumn("place", F.monotonically_increasing_id()), "cells")  # rows that repeat an id or a vector lie apart, too
    summary = placed.groupBy("cell").agg(F.count("*").alias("n"), F.count_if("is_query").alias("nq"), F.max("away").alias("radius"), F.max("norm").alias("norm")).collect()  # a row a pivot
    cells = {r["cell"]: r for r in summary}
    repeats = total - placed.agg(F.count_distinct("vec_id")).first()[0]  # such rows may be the query's own
    known = np.array(sorted(cells))
    stats = spark.sparkContext.broadcast((known, *(np.array([float(cells[c][f]) for c in known]) for f in ("n", "radius", "norm"))))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                ids = np.array([x["vec_id"] for x in r["rows"]], np.int64)
                m = np.zeros((len(ids), width), np.int64)
                for i, x in enumerate(r["rows"]):
                    m[i, : len(x["v"])] = x["v"]
                data, kind = _packed(m)
                out.append({"cell": r["cell"], "chunk": r["chunk"], "ids": ids.tobytes(), "data": data, "kind": kind})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("cell", pa.int32()), ("chunk", pa.int32()), ("ids", pa.binary()), ("data", pa.binary()), ("kind", pa.string())]))

    def chunked(df: DataFrame, count: str, size: int, key: str) -> DataFrame:
        parts = spark.createDataFrame([(int(c), -(-cells[c][count] // size) or 1) for c in map(int, known)], "cell int, _parts long")
        df = df.join(F.broadcast(parts), "cell")  # a row a pivot
        df = df.withColumn("chunk", F.pmod(F.xxhash64(key, F.lit(5)), F.col("_parts")).cast("int"))
        return df.groupBy("cell", "chunk").agg(F.collect_list(F.struct("vec_id", "v")).alias("rows")).mapInArrow(pack, PACK)

    data = written(chunked(placed, "n", chunk_rows, "place"), "chunks")
    asking = placed.where("is_query").groupBy("vec_id").agg(F.min(F.struct("v", "cell")).alias("q")).select("vec_id", "q.*")
    queries = chunked(asking, "nq", query_rows, "vec_id")

    def needs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block of queries -> for each cell those of them that need it."""
        p, pivot_ids = shared.value
        cell_ids, n, radius, norm = stats.value
        for b in batches:
            out = []
            for r in b.to_pylist():
                q = np.frombuffer(r["data"], r["kind"]).reshape(-1, width).astype(np.float64)
                own, size = np.frombuffer(r["ids"], np.int64), np.sqrt((q * q).sum(1))
                at_pivots = q @ p.T
                middle = at_pivots[:, cell_ids]
                high = np.minimum(middle + size[:, None] * radius, size[:, None] * norm)
                low = middle - size[:, None] * radius
                wanted = np.zeros((len(q), len(cell_ids)), bool)
                for i in range(len(q)):
                    # Pivots are rows, so the k-th best of them (but the query's own) is reached; so is a cell's low end, by all its rows.
                    seen = np.sort(at_pivots[i, pivot_ids != own[i]])[::-1]
                    floor = seen[k - 1] if len(seen) >= k else -np.inf
                    order = np.argsort(-low[i])
                    rows_so_far = np.cumsum(n[order]) - 1 - repeats
                    enough = np.flatnonzero(rows_so_far >= k)
                    if len(enough):
                        floor = max(floor, low[i, order[enough[0]]])
                    slack = 1e-9 * (1 + abs(floor)) + 1e-9 * size[i] * norm.max()
                    wanted[i] = high[i] + slack >= floor
                packed = np.frombuffer(r["data"], r["kind"]).reshape(-1, width)
                for c in np.flatnonzero(wanted.any(0)):
                    mine = wanted[:, c]
                    out.append({"q_ids": own[mine].tobytes(), "q_data": packed[mine].tobytes(), "q_kind": r["kind"], "cell": int(cell_ids[c])})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("q_ids", pa.binary()), ("q_data", pa.binary()), ("q_kind", pa.string()), ("cell", pa.int32())]))

    sent = queries.mapInArrow(needs, "q_ids binary, q_data binary, q_kind string, cell int")
    parts = spark.createDataFrame([(int(c), int(-(-cells[c]["n"] // chunk_rows) or 1)) for c in map(int, known)], "cell int, _parts int")
    sent = sent.join(F.broadcast(parts), "cell").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    met = sent.join(data, ["cell", "chunk"]).select("q_ids", "q_data", "q_kind", "ids", "data", "kind")
    found = met.mapInArrow(lambda it: _top(it, width, k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
