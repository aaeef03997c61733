"""A uniform shuffle of rows into shards of exact size, from a hypergeometric communication matrix.

Rows first fall into blocks by a hash. How many rows of each block go to each shard is drawn exactly (a multivariate
hypergeometric matrix with the blocks' counts and the shards' sizes as margins), each block is permuted and dealt out by
its row of the matrix, rows are exchanged, and each shard is permuted again. Only DataFrame functions touch rows; the
driver draws the matrix, of which it needs the blocks' counts alone.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import told_apart, unit, written


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """How many of `draws` rows, taken without replacement from good + bad, are good: exact inversion from the mode outwards."""
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    lf = lambda n: math.lgamma(n + 1)
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))
    p = math.exp(lf(good) - lf(mode) - lf(good - mode) + lf(bad) - lf(draws - mode) - lf(bad - draws + mode) - lf(good + bad) + lf(draws) + lf(good + bad - draws))
    u = rng.random() - p
    up, down, pu, pd = mode, mode, p, p
    while u > 0 and (up < high or down > low):
        if up < high:
            pu *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up += 1
            u -= pu
            if u <= 0:
                return up
        if down > low:
            pd *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            u -= pd
            if u <= 0:
                return down
    return mode


def communication_matrix(counts: list[int], sizes: list[int], seed: int) -> list[list[int]]:
    """Rows of block i for shard j, with margins counts and sizes, as a uniform permutation of all rows would have them."""
    rng, left, out = random.Random(seed), list(sizes), []
    rest = sum(sizes)
    for n in counts:
        row, need, pool = [], n, rest
        for size in left:
            k = hypergeometric(rng, size, pool - size, need)
            row.append(k)
            need, pool = need - k, pool - size
        out.append(row)
        left = [a - b for a, b in zip(left, row, strict=True)]
        rest -= n
    return out


def shuffled_shards(df: DataFrame, identity: list[Column], shards: int, seed: int = 17, rows_per_block: int = 1_000_000, least_blocks: int = 1024, order: str | None = None) -> DataFrame:
    """df with shard (0 to shards-1; sizes differ by one at most) and slot (gapless from 0 within its shard).

    identity: columns that tell rows apart; they seed the permutations, so recomputed tasks agree. Rows equal in them are
    interchangeable; they are numbered and fall into different blocks. Nulls are values like any other; an empty table stays empty; columns of df keep their names, except
    that earlier shard and slot columns are replaced. order: a column of whole numbers from 0, spread evenly; slots then
    follow it within each shard instead of a second permutation, nulls last. Blocks hold about rows_per_block rows at any table size.
    """
    df = df.drop("shard", "slot").withColumns({"_a": unit(*identity, seed=seed), "_b": unit(*identity, seed=seed + 1)})
    df = told_apart(df.withColumn("_equal", F.struct("_a", "_b")), "_equal").drop("_equal")
    df = df.withColumns({c: F.when(F.col("_copy") > 0, unit(c, "_copy", seed=seed)).otherwise(F.col(c)) for c in ("_a", "_b")}).drop("_copy")
    blocks = max(least_blocks, -(-df.count() // rows_per_block))
    df = df.withColumn("_block", F.pmod("_a", F.lit(blocks)))
    counts = {r["_block"]: r["n"] for r in df.groupBy("_block").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    sizes = [total // shards + (j < total % shards) for j in range(shards)]
    present = sorted(counts)
    matrix = communication_matrix([counts[b] for b in present], sizes, seed)
    # One row a block, so its size is fixed by `blocks` and `shards`.
    ends = [(b, [sum(row[: j + 1]) for j in range(shards)]) for b, row in zip(present, matrix, strict=True)]
    ends = df.sparkSession.createDataFrame(ends, "_block long, _ends array<long>")
    local = F.row_number().over(Window.partitionBy("_block").orderBy("_b", "_a")) - 1
    dealt = (
        df.withColumn("_rank", local)
        .join(F.broadcast(ends), "_block")
        .withColumn("shard", F.size(F.filter("_ends", lambda e: e <= F.col("_rank"))).cast("int"))
        .drop("_ends", "_rank", "_block")
    )
    # The second permutation: shards are cut into chunks by another hash, so that no task holds a whole shard.
    chunks = max(64, -(-total // (shards * rows_per_block)))
    if order is None:
        dealt = dealt.withColumn("_c", unit("_b", seed=seed + 2)).withColumn("_chunk", F.pmod("_c", F.lit(chunks)))
    else:  # ranges of the order take the place of chunks by a hash
        last = df.agg(F.max(order)).first()[0] or 0
        dealt = dealt.withColumn("_c", F.coalesce(F.col(order), F.lit(last + 1)).cast("long"))
        dealt = dealt.withColumn("_chunk", F.floor(F.col("_c") / (last // chunks + 1)).cast("long"))
    dealt = written(dealt, "dealt")
    starts = dealt.groupBy("shard", "_chunk").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("shard", "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("shard", "_chunk").orderBy("_c", "_b", "_a")) - 1
    return (
        dealt.withColumn("_within", within)
        .join(F.broadcast(starts), ["shard", "_chunk"])  # shards x chunks rows, fixed by rows_per_block
        .withColumn("slot", F.col("_start") + F.col("_within"))
        .drop("_a", "_b", "_c", "_chunk", "_start", "_within")
    )


def sized(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text plus 8; null text: 8), text_crc32 (null text: that of no bytes, 0) and the columns in more."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    return docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), *more)


def document_shards(docs: DataFrame, shards: int = 24, order: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law ('rows'), shard, slot, grown_shard (null: only for law 'key') of every row of docs.

    order: a column that the slots of each shard follow, see shuffled_shards.
    """
    rows = shuffled_shards(sized(docs, *([order] if order else [])), [F.col("doc_id"), F.col("text_crc32"), F.col("size")], shards, order=order)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
