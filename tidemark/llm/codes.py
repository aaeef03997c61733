"""Compression of vectors into codes, one codebook a part, by exact k-means with adaptive bounds.

Each part of each row keeps an upper bound of the distance to its entry, its b next closest entries with lower bounds in
rising order, and one outer bound for all entries that are not listed. When entries move, bounds widen by how far. A part
whose upper bound lies under its first lower bound keeps its entry without a look at its numbers. Else its own and the
listed entries are compared, in whole numbers; and only if none of these surely lies nearer than the outer bound, all
entries are, and the list is made anew. Bounds are floats, rounded to the safe side; whatever they leave open, ties
included, whole numbers decide, so the codes are those of plain k-means.

After each round every part position gets a list length of its own: shorter where hardly any row used the last listed
entry, longer where many rows had to be compared with all.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import erase, pieces, written

UP, DOWN = 1 + 2.0**-20, 1 - 2.0**-20  # more than the rounding of a few operations and of float32
LIMB = 32  # bits: sums travel as numbers below 2**32 times powers of it, and are added up as longs
SUMS = "array<struct<part:int,entry:int,place:int,limb:int,value:long>>"
COUNT, LEVEL = -1, -2  # places of a group's count, and of the number of rows by level
MOST_LONG, MOST_FLOAT = 2**63 - 1, 3e38


def _root(x: int) -> float:
    try:
        return math.sqrt(x)
    except OverflowError:
        return math.inf


def roots(squares: np.ndarray) -> np.ndarray:
    if squares.dtype == object:
        return np.array([_root(x) for x in squares.ravel()], float).reshape(squares.shape)
    return np.sqrt(squares.astype(float))


def squared(x: np.ndarray, c: np.ndarray, small: bool) -> np.ndarray:
    """Exact squared distances of the rows of x (n, m) and c (k, m), as long as the type of x holds them.

    small: no sum leaves the whole numbers of doubles, so a matrix product gives them.
    """
    if small:
        x, c = x.astype(float), c.astype(float)
        return ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)).astype(np.int64)
    return np.stack([((x - e) ** 2).sum(1) for e in c], 1)


@dataclass
class Bounds:
    """Bounds of one part position for a batch: own (n,), upper (n,), listed (n, b), lower (n, b), outer (n,).

    Free places of a list hold the number of entries, and the outer bound.
    """

    own: np.ndarray
    upper: np.ndarray
    listed: np.ndarray
    lower: np.ndarray
    outer: np.ndarray

    @staticmethod
    def of(squares: np.ndarray, b: int) -> Bounds:
        """From the distances to all entries; of equal ones the first is nearer."""
        k = squares.shape[1]
        order = np.argsort(squares, axis=1, kind="stable")
        far = roots(np.take_along_axis(squares, order, 1))
        n, b = len(order), min(b, k - 1)
        outer = far[:, b + 1] * DOWN if k > b + 1 else np.full(n, np.inf)
        return Bounds(order[:, 0], far[:, 0] * UP, order[:, 1 : b + 1], far[:, 1 : b + 1] * DOWN, outer)

    def widened(self, moved: np.ndarray) -> Bounds:
        """After entry e moved by at most moved[e]."""
        most = moved.max(initial=0.0)
        each = np.append(moved, most)
        outer = self.outer - most
        low = np.column_stack([self.lower - each[self.listed], outer])
        low = np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1]
        return Bounds(self.own, (self.upper + moved[self.own]) * UP, self.listed, low[:, :-1], outer)

    def resized(self, b: int, k: int) -> Bounds:
        """With lists of b entries: longer ones are cut, and the bound of what is cut becomes the outer one."""
        n, have = self.listed.shape
        if have > b:
            return Bounds(self.own, self.upper, self.listed[:, :b], self.lower[:, :b], np.minimum(self.outer, self.lower[:, b]))
        free = b - have
        return Bounds(self.own, self.upper, np.column_stack([self.listed, np.full((n, free), k)]), np.column_stack([self.lower, *[self.outer] * free]), self.outer)

    def put(self, at: np.ndarray, other: Bounds) -> None:
        for name in ("own", "upper", "listed", "lower", "outer"):
            getattr(self, name)[at] = getattr(other, name)


def assign(x: np.ndarray, c: np.ndarray, was: Bounds, b: int, small: bool) -> tuple[Bounds, np.ndarray]:
    """(bounds with the nearest entries of x among c, level of each row).

    Level 0: the bounds sufficed, or did with the distance to the own entry; 1 to b: that many listed entries were needed;
    b + 1: all entries were.
    """
    k, size = len(c), was.listed.shape[1]
    out, level = was.resized(max(b, size), k), np.zeros(len(x), np.int64)
    first = was.lower[:, 0] if size else was.outer
    open_ = np.flatnonzero(~(was.upper < first))
    own = ((x[open_] - c[was.own[open_]]) ** 2).sum(1)
    out.upper[open_] = roots(own) * UP
    still = ~(out.upper[open_] < first[open_])
    at, own = open_[still], own[still]
    if len(at):
        entries = np.column_stack([was.own[at], was.listed[at]])
        none = own.max(initial=0) + 1 if own.dtype == object else np.iinfo(np.int64).max
        squares = np.empty(entries.shape, own.dtype)
        squares[:, 0] = own
        for i in range(1, size + 1):
            real = entries[:, i] < k
            squares[:, i] = none
            squares[real, i] = ((x[at[real]] - c[entries[real, i]]) ** 2).sum(1)
        best = np.minimum.accumulate(squares, axis=1)
        bound = np.column_stack([was.lower[at], was.outer[at]])
        sure = roots(best) * UP < bound
        level[at] = np.where(sure.any(1), sure.argmax(1), size + 1)
        by_entry = np.argsort(entries, axis=1, kind="stable")
        entries, squares = np.take_along_axis(entries, by_entry, 1), np.take_along_axis(squares, by_entry, 1)
        by_square = np.argsort(squares, axis=1, kind="stable")
        entries, far = np.take_along_axis(entries, by_square, 1), roots(np.take_along_axis(squares, by_square, 1))
        outer = was.outer[at]
        lower = np.where(entries[:, 1:] < k, np.minimum(far[:, 1:] * DOWN, outer[:, None]), outer[:, None])
        out.put(at, Bounds(entries[:, 0], far[:, 0] * UP, entries[:, 1:], lower, outer).resized(max(b, size), k))
        everything = at[level[at] > size]
        if len(everything):
            out.put(everything, Bounds.of(squared(x[everything], c, small), max(b, size)).resized(max(b, size), k))
    return out.resized(b, k), level


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """(i, number) with value = sum of number * 2**(LIMB * i); one pair if it fits a few bits more than a limb."""
    i = 0
    while not -(1 << 40) < value < 1 << 40:
        yield i, value & ((1 << LIMB) - 1)
        value >>= LIMB
        i += 1
    yield i, value


@dataclass
class Compressed:
    """rows(vec_id, label, code: array of entries, error), codebooks[part][entry][place], and of each assignment after the
    first one dict a part: b (list length), kept, listed, all (rows by what decided them)."""

    rows: DataFrame
    codebooks: list[list[list[int]]]
    report: list[list[dict]]


def next_length(b: int, k: int, levels: dict[int, int]) -> int:
    """Shorter where under 1% of the rows used the last listed entry or more, longer where over 5% needed all entries."""
    rows = sum(levels.values())
    if levels.get(b + 1, 0) * 20 > rows:
        return min(b + 1, max(1, k // 2))
    if (levels.get(b, 0) + levels.get(b + 1, 0)) * 100 < rows:
        return max(b - 1, min(b, max(1, k // 8)))
    return b


def compress(vectors: DataFrame, n_parts: int = 8, k: int = 16, rounds: int = 6, scale: int = 4096, id_col: str = "vec_id", label_col: str = "label") -> Compressed:
    """Codes of vectors(vec_id, embedding[, label]), whose components become floor(scale * x).

    A vector takes no part if it is null or holds a null or a component that, times scale, is not a finite double. Vectors
    are cut into n_parts equal parts; a shorter vector than the longest, or a length that n_parts does not divide, is filled
    up with zeros. The codebook of each part position starts as that part of the k rows of smallest vec_id (nulls last;
    of equal ids the smaller vector first), or of all rows where there are fewer. Rounds are as in k-means: nearest entry
    by squared Euclidean distance, ties to the lower index; then each used entry becomes floor(sum / count). Rows with null
    or equal ids are rows of their own. Without a label column labels are null. error is capped at the largest long. An
    empty table gives no rows and no codebooks. Other columns are ignored.

    Each round reads and writes one table in the shared folder (vectors and bounds) and deletes the one before. Sums leave
    tasks added up by batch; the driver sees k * (length + list lengths) numbers, whatever the rows. k: 256 at most.
    """
    spark = vectors.sparkSession
    if not 1 <= k <= 256:
        raise ValueError("1 to 256 entries")
    x, kind = F.col("embedding"), vectors.schema[id_col].dataType.simpleString()
    label = F.col(label_col) if label_col in vectors.columns else F.lit(None).cast("int")
    label_kind = vectors.schema[label_col].dataType.simpleString() if label_col in vectors.columns else "int"
    fit = F.forall(x, lambda a: a.isNotNull() & ~F.isnan(a.cast("double")) & (F.abs(a.cast("double") * scale) < float("inf")))
    rows = vectors.where(x.isNotNull()).where(fit).select(F.col(id_col).alias("vec_id"), label.alias("label"), F.transform(x, lambda a: a.cast("double")).alias("x"))
    total, width, top = rows.agg(F.count("*"), F.max(F.size("x")), F.max(F.array_max(F.transform("x", lambda a: F.ceil(F.abs(a * scale)).cast("double"))))).first()
    if not total:
        return Compressed(spark.createDataFrame([], f"vec_id {kind}, label {label_kind}, code array<int>, error long"), [], [])
    m = max(1, -(-width // n_parts))
    worst = 4 * int(top or 0) ** 2 * m + 1
    small, number = worst < 2**51, np.int64 if worst < 2**61 else object
    stored = "int16" if (top or 0) < 2**15 else "int32" if (top or 0) < 2**31 else "float64"

    def whole(raw: list[bytes]) -> np.ndarray:
        """(n, parts, m) whole numbers of packed vectors."""
        flat = np.frombuffer(b"".join(raw), stored)
        if number is object:
            flat = np.array([int(a) for a in flat.tolist()], object)
        return flat.astype(number).reshape(len(raw), n_parts, m)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch.column(2).to_pylist():
                full = np.zeros(n_parts * m)
                full[: len(v)] = np.floor(np.array(v, float) * scale)
                out.append(full.astype(stored).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["vec_id", "label", "v"])

    head = f"vec_id {kind}, label {label_kind}, v binary"
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(k).mapInArrow(packed, head).collect()
    start = whole([bytes(r["v"]) for r in first])
    books = [[[int(a) for a in e] for e in start[:, p]] for p in range(n_parts)]
    k = len(first)
    lengths, report, now = [min(max(1, k // 4), k - 1)] * n_parts, [], None

    def bounds_in(raw: list[bytes], b: list[int]) -> list[Bounds]:
        form = np.dtype([(f"p{p}", [("own", "u1"), ("upper", "f4"), ("listed", "u2", (n,)), ("lower", "f4", (n,)), ("outer", "f4")]) for p, n in enumerate(b)])
        a = np.frombuffer(b"".join(raw), form)
        get = lambda p, n, t: a[f"p{p}"][n].astype(t)
        return [Bounds(get(p, "own", int), get(p, "upper", float) * UP, get(p, "listed", int), get(p, "lower", float) * DOWN, get(p, "outer", float) * DOWN) for p in range(n_parts)]

    def bounds_out(parts: list[Bounds], b: list[int]) -> list[bytes]:
        form = np.dtype([(f"p{p}", [("own", "u1"), ("upper", "f4"), ("listed", "u2", (n,)), ("lower", "f4", (n,)), ("outer", "f4")]) for p, n in enumerate(b)])
        a = np.empty(len(parts[0].own), form)
        with np.errstate(over="ignore"):
            for p, x in enumerate(parts):
                for n in form[f"p{p}"].names:  # a lower bound must not round up to infinity
                    a[f"p{p}"][n] = np.minimum(getattr(x, n), MOST_FLOAT) if n in ("lower", "outer") else getattr(x, n)
        raw, step = a.tobytes(), form.itemsize
        return [raw[i : i + step] for i in range(0, len(raw), step)]

    def step(books: list, moved: list | None, had: list[int] | None, b: list[int], last: bool):
        """A function of batches: assigns them; with had, from the bounds that they carry, else anew."""
        shared = spark.sparkContext.broadcast((books, moved))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            c = [np.array(p, number).reshape(k, m) for p in shared.value[0]]
            for batch in pieces(batches, 4096):
                v, parts, counted = whole(batch.column(2).to_pylist()), [], []
                was = bounds_in(batch.column(3).to_pylist(), had) if had else None
                for p in range(n_parts):
                    if was is None:
                        new = Bounds.of(squared(v[:, p], c[p], small), b[p])
                    else:
                        new, level = assign(v[:, p], c[p], was[p].widened(shared.value[1][p]), b[p], small)
                        counted += [(p, int(e), LEVEL, 0, int(n)) for e, n in zip(*np.unique(np.minimum(level, had[p] + 1), return_counts=True), strict=True)]
                    parts.append(new)
                own = np.stack([x.own for x in parts], 1)
                if last:
                    error = sum(((v[:, p] - c[p][own[:, p]]) ** 2).sum(1) for p in range(n_parts))
                    codes = pa.ListArray.from_arrays(pa.array(np.arange(0, own.size + 1, n_parts, dtype=np.int32)), pa.array(own.ravel().astype(np.int32)))
                    columns = [*batch.columns[:2], codes, pa.array([min(int(e), MOST_LONG) for e in error.tolist()], pa.int64())]
                    names = ["vec_id", "label", "code", "error"]
                else:
                    for p in range(n_parts):
                        for e in np.unique(own[:, p]).tolist():
                            its = v[own[:, p] == e, p]
                            counted.append((p, e, COUNT, 0, len(its)))
                            counted += [(p, e, place, i, n) for place, s in enumerate(its.sum(0).tolist()) for i, n in limbs(int(s))]
                    columns = [*batch.columns[:3], pa.array(bounds_out(parts, b), pa.binary())]
                    names = ["vec_id", "label", "v", "bounds"]
                fields = zip(*counted, strict=True) if counted else [[]] * 5
                flat = pa.StructArray.from_arrays([pa.array(list(f), t) for f, t in zip(fields, [pa.int32()] * 4 + [pa.int64()], strict=True)], ["part", "entry", "place", "limb", "value"])
                ends = np.full(batch.num_rows + 1, len(counted), np.int32)  # the first row carries the batch's sums
                ends[0] = 0
                yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(ends), flat)], [*names, "sums"])

        return run

    moved = had = None
    table = written(rows.mapInArrow(packed, head), "vectors")
    for turn in range(rounds + 1):
        last = turn == rounds
        kept = f"vec_id {kind}, label {label_kind}, code array<int>, error long, sums {SUMS}" if last else f"{head}, bounds binary, sums {SUMS}"
        now = written(table.mapInArrow(step(books, moved, had, lengths, last), kept), f"codes-{turn}")
        erase(table)
        sums = now.select(F.inline("sums")).groupBy("part", "entry", "place", "limb").agg(F.sum("value").alias("value")).collect()
        got: dict[tuple[int, int, int], int] = {}
        for r in sums:
            at = r["part"], r["entry"], r["place"]
            got[at] = got.get(at, 0) + (r["value"] << (LIMB * r["limb"]))
        if had:
            levels = [{e: n for (q, e, place), n in got.items() if q == p and place == LEVEL} for p in range(n_parts)]
            report.append([{"b": b, "kept": x.get(0, 0), "listed": sum(n for e, n in x.items() if 0 < e <= b), "all": x.get(b + 1, 0)} for b, x in zip(had, levels, strict=True)])
        if last:
            break
        had = lengths
        if turn:
            lengths = [next_length(b, k, x) for b, x in zip(lengths, levels, strict=True)]
        fresh = [[[got.get((p, e, j), 0) // got[p, e, COUNT] for j in range(m)] if (p, e, COUNT) in got else books[p][e] for e in range(k)] for p in range(n_parts)]
        moved = [np.array([_root(sum((a - z) ** 2 for a, z in zip(old, new, strict=True))) for old, new in zip(books[p], fresh[p], strict=True)]) * UP for p in range(n_parts)]
        table, books = now.drop("sums"), fresh
        table.written_at = now.written_at
    return Compressed(now.select("vec_id", "label", "code", "error"), books, report)


def books_digest(books: list[list[list[int]]]) -> str:
    return hashlib.sha256(",".join(str(a) for part in books for entry in part for a in entry).encode()).hexdigest()


def with_label_errors(rows: DataFrame, hot_rows: int = 100_000) -> DataFrame:
    """rows(label, error, ...) with label_error, the error summed over equal labels (nulls together; capped at the largest long).

    A label of more than hot_rows rows (of which there are at most rows / hot_rows) is looked up by broadcast, so that it
    fills no task; the others are joined by their label.
    """
    key = F.struct(F.col("label").alias("label"))  # equal for nulls, too
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST_LONG).cast("decimal(38,0)")).cast("long")
    sums = written(rows.select(key.alias("_key"), "error").groupBy("_key").agg(total.alias("label_error"), F.count("*").alias("_n")), "label-errors")
    keyed = rows.withColumn("_key", key)
    hot = F.broadcast(sums.where(F.col("_n") > hot_rows).drop("_n"))
    cold = sums.where(F.col("_n") <= hot_rows).drop("_n")
    return keyed.join(hot, "_key").unionByName(keyed.join(hot, "_key", "left_anti").join(cold, "_key")).drop("_key")
