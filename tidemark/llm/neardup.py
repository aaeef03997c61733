"""Near-duplicate groups by min-max hashing.

Both the least and the greatest value of each hash function over a document's shingles enter its signature, so 64
functions give 128 unbiased values: 32 bands of 4, each of four different functions (two least, two greatest values).
Equal shingle sets are one class. Classes that share a band are candidates; every link is confirmed on full shingle
sets. At similarity 0.75 a pair shares no band with probability (1 - 0.75**4)**32, about 5e-6 (small sets somewhat more,
for there the values of two functions are not independent).

A bucket of a band is settled in rounds. In each round some members are pivots, and the members of other components are
compared with them; then pivots retire, for nothing is left to be told of them, and a bucket ends when its members are in
one component. The first pivot is the member that shares the most crowded buckets, which in a group of copies is the
text that they were made from. Later there are 16, 256, ... pivots, so that members that are truly unlike are settled,
too: then their comparisons are as many as their pairs, but a pair is only taken further if its sketches allow a link.
The sketch has 1024 bits, each the parity of the shingles hashed to it. A shingle that one set alone has flips a bit, so
sketches never differ in more bits than sets do in shingles: the test loses nothing, and is part of the join.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import erase, written
from .components import components
from .words import U, blocks, mixed, shingles, split_words

SIZE, FUNCTIONS, ROWS = 5, 64, 4
BANDS = FUNCTIONS * 2 // ROWS
_rng = np.random.default_rng(20240501)
_ODD = _rng.integers(0, 1 << 63, FUNCTIONS, dtype=np.uint64) * U(2) + U(1)
_ADD = _rng.integers(0, 1 << 63, FUNCTIONS, dtype=np.uint64) * U(2)
_MIX = np.array([pow(0xA0761D6478BD642F, k + 1, 1 << 64) for k in range(ROWS)], U)
#: For each row of a band and each band, the place of its value among (least, greatest) of all functions.
_PLACES = np.array([[2 * ((b + shift) % FUNCTIONS) + side for b in range(BANDS)] for side, shift in ((0, 0), (0, BANDS), (1, 13), (1, BANDS + 13))])
SKETCH = [f"b{k}" for k in range(16)]


def set_keys(sets: list[np.ndarray]) -> list[bytes]:
    """128-bit keys of shingle sets: sums of two hashes of the members."""
    return [(mixed(s ^ U(0x5851F42D4C957F2D)).sum(dtype=U).tobytes() + mixed(s * U(0x2545F4914F6CDD1D)).sum(dtype=U).tobytes()) for s in sets]


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """One row of BANDS band keys for each (non-empty) set."""
    flat = np.concatenate(sets)
    at = np.cumsum([0, *map(len, sets[:-1])])
    values = np.empty((FUNCTIONS * 2, len(sets)), U)
    for k in range(FUNCTIONS):
        h = flat * _ODD[k]
        h += _ADD[k]
        values[2 * k], values[2 * k + 1] = np.minimum.reduceat(h, at), np.maximum.reduceat(h, at)
    bands = mixed((mixed(values)[_PLACES] * _MIX[:, None, None]).sum(0, dtype=U))
    return mixed(bands + np.arange(BANDS, dtype=U)[:, None]).T  # the band's number is part of its key


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """One row of 16 longs for each set: the parities of its shingles in 1024 cells."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    cells = owner * 1024 + (mixed(np.concatenate(sets) + U(0x632BE59BD9B4E019)) >> U(54)).astype(np.int64)
    return np.packbits((np.bincount(cells, minlength=1024 * len(sets)) & 1).astype(np.uint8)).view(np.int64).reshape(len(sets), 16)


def text_sets(column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    for at in range(0, len(column), 512):
        texts = [t or b"" for t in column.slice(at, 512).cast(pa.binary()).to_pylist()]
        for first, part in blocks(texts):
            yield at + first, shingles(*split_words(part), SIZE)


SIGNATURE = "doc_id long, node binary, n_shingles long, bands array<long>, " + ", ".join(f"{b} long" for b in SKETCH)


def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text -> doc_id, node, n_shingles, bands, sketch. node: the set's key; null without words."""
    names = ["doc_id", "node", "n_shingles", "bands", *SKETCH]
    for batch in batches:
        for first, sets in text_sets(batch.column(1)):
            full = [s for s in sets if len(s)]
            at = np.full(len(sets), -1)
            at[[i for i, s in enumerate(sets) if len(s)]] = np.arange(len(full))
            rows = pa.array(at, mask=at < 0)
            bands = pa.array(list(band_keys(full).view(np.int64)) if full else [], pa.list_(pa.int64()))
            bits = sketches(full).T if full else np.zeros((16, 0), np.int64)
            made = [pa.array(set_keys(full), pa.binary()), pa.array([len(s) for s in sets], pa.int64()), bands, *(pa.array(b) for b in bits)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(sets)), *(c if i == 1 else c.take(rows) for i, c in enumerate(made))], names)


def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text -> node, members (the shingle hashes)."""
    for batch in batches:
        for _, sets in text_sets(batch.column(0)):
            full = [s.view(np.int64) for s in sets if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array(set_keys([s.view(U) for s in full]), pa.binary()), pa.array(full, pa.list_(pa.int64()))], ["node", "members"])


def may_link(percent: int) -> Column:
    """For a member (n, b0, ...) and a pivot (pn, pb0, ...): their sizes and sketches allow a similarity of percent."""
    apart = reduce(Column.__add__, (F.bit_count(F.col(b).bitwiseXOR(F.col(f"p{b}"))) for b in SKETCH))
    return (F.least("n", "pn") * 100 >= F.greatest("n", "pn") * percent) & (apart * (100 + percent) <= (F.col("n") + F.col("pn")) * (100 - percent))


def near_duplicates(docs: DataFrame, percent: int = 75, broadcast_ids: int = 100_000) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept (doc_id is component_id).

    Documents are linked when 100 * |intersection| >= percent * |union| of their shingle sets (64-bit hashes of 5 words;
    with fewer words, all of them as one); component_id is the least doc_id that links reach. A text without words (null,
    empty or blank) is linked with nothing. A row with a null doc_id takes its component from the other rows of its group
    and is never kept; alone, its component is null. Rows that repeat a doc_id are rows of their own. An empty table
    gives an empty one. Only doc_id and text are read, whatever other columns docs has.

    broadcast_ids: candidates' ids, at most so many, are broadcast to pick their texts; more are joined by a shuffle.
    """
    sigs = written(docs.select("doc_id", "text").mapInArrow(signatures, SIGNATURE), "signatures")
    firsts = [F.first(c).alias(c) for c in ("bands", *SKETCH)]
    classes = written(sigs.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first"), F.first("n_shingles").alias("n"), *firsts), "classes")
    slots = classes.select("node", F.explode("bands").alias("bucket"))
    crowded = slots.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = written(slots.join(crowded, "bucket"), "members")
    return _grouped(sigs, _class_roots(docs, classes, members, percent, broadcast_ids))


def _grouped(sigs: DataFrame, roots: DataFrame) -> DataFrame:
    firsts = sigs.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first"))
    # Only classes with links are in `roots`; the others are their own root.
    firsts = written(firsts.join(roots.withColumnRenamed("v", "node"), "node", "left").withColumn("root", F.coalesce("root", "node")), "firsts")
    least = firsts.groupBy("root").agg(F.min("first").alias("component_id"))
    named = firsts.select("node", "root").join(least, "root").select("node", "component_id")
    out = sigs.select("doc_id", "node", "n_shingles").join(named, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(False)).alias("kept"))


def _class_roots(docs: DataFrame, classes: DataFrame, members: DataFrame, percent: int, broadcast_ids: int) -> DataFrame:
    """(v, root) for each class but the roots: the components of all links among candidates."""
    spark = docs.sparkSession
    weights = members.groupBy("node").agg(F.sum("size").alias("weight"))
    wanted = written(weights.join(classes, "node").select("node", "first", "n", "weight", *SKETCH), "candidates")
    ids = wanted.select(F.col("first").alias("doc_id"))
    if wanted.count() <= broadcast_ids:
        ids = F.broadcast(ids)
    texts = docs.select("doc_id", "text").join(ids, docs["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi").select("text")
    sets = texts.mapInArrow(full_sets, "node binary, members array<long>").join(wanted.select("node"), "node", "left_semi")
    sets = written(sets.dropDuplicates(["node"]), "sets")

    roots = written(spark.createDataFrame([], "v binary, root binary"), "roots")
    live, pivots = written(members.select("bucket", "node").join(wanted.drop("first"), "node").withColumn("root", F.col("node")), "live"), 1
    erase(classes, members, wanted)
    while True:
        if pivots == 1:
            heads = live.groupBy("bucket").agg(F.max(F.struct("weight", "node", "n", "root", *SKETCH)).alias("p")).select("bucket", "p.*")
        else:
            size = live.groupBy("bucket").agg(F.count("*").alias("_size"))
            share = F.pmod(F.xxhash64("node", F.lit(pivots)), F.lit(1 << 20)) / (1 << 20)
            heads = live.join(size, "bucket").where(share * F.col("_size") < pivots).drop("_size")
        heads = written(heads.select("bucket", "node", "n", "root", *SKETCH), "heads")
        them = heads.select("bucket", F.col("node").alias("p"), F.col("n").alias("pn"), F.col("root").alias("pr"), *(F.col(b).alias(f"p{b}") for b in SKETCH))
        x, y = F.struct("node", "root"), F.struct(F.col("p").alias("node"), F.col("pr").alias("root"))
        pairs = (
            live.join(them, "bucket")
            .where((F.col("root") != F.col("pr")) & may_link(percent))
            .select(F.least(x, y).alias("x"), F.greatest(x, y).alias("y"))
            .select(F.col("x")["node"].alias("u"), F.col("x")["root"].alias("ru"), F.col("y")["node"].alias("v"), F.col("y")["root"].alias("rv"))
            .distinct()
        )
        pairs = written(pairs, "pairs")
        with_v = pairs.join(sets.withColumnsRenamed({"node": "v", "members": "b"}), "v")
        with_both = with_v.join(sets.withColumnsRenamed({"node": "u", "members": "a"}), "u")
        common = F.size(F.array_intersect("a", "b"))
        linked = common * (100 + percent) >= (F.size("a") + F.size("b")) * percent
        moved = components(with_both.where(linked).select(F.col("ru").alias("u"), F.col("rv").alias("v")).distinct())
        moved = written(moved.select(F.col("v").alias("root"), F.col("root").alias("new")), "moved")
        kept = roots.join(moved, "root", "left").select("v", F.coalesce("new", "root").alias("root"))
        old_roots, roots = roots, written(kept.union(moved.select("root", "new")), "roots")
        # Pivots retire, and so do buckets whose other members are in one component.
        rest = live.join(heads.select("bucket", "node"), ["bucket", "node"], "left_anti")
        rest = written(rest.join(moved, "root", "left").withColumn("root", F.coalesce("new", "root")).select(live.columns), "rest")
        h = F.xxhash64("root")
        open_buckets = rest.groupBy("bucket").agg(F.min(h).alias("_a"), F.max(h).alias("_b")).where("_a <> _b").select("bucket")
        old_live, live = live, written(rest.join(open_buckets, "bucket", "left_semi"), "live")
        erase(heads, pairs, moved, old_roots, rest, old_live)
        if live.isEmpty():
            erase(sets, live)
            return roots
        pivots *= 16
