"""Mixing sources to target weights by Pfair scheduling.

A source of weight a/D (a whole number of every D blocks) gives its j-th block the window from its release,
floor(j*D/a), to its deadline, ceil((j+1)*D/a). Slots go to the released block with the earliest deadline, which keeps
every source less than one block from its share at every prefix. A source that has given all its blocks leaves, and the
others go on at their relative weights: with v rounds in which source s gives min(a*v, its blocks), the slot of v is the
sum of these, so a window is that from v = j/a to v = (j+1)/a. Between two leavings the schedule repeats itself, so only
its beginning and one period are worked out (each bounded by `resolution`, once for each leaving); each document finds
its slot from its rank within its source.
"""

from __future__ import annotations

from bisect import bisect_right
from fractions import Fraction
from heapq import heapify, heappop, heappush
from math import gcd, isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import told_apart, unit, written


def whole_weights(weights: dict[str, float], resolution: int) -> dict[str, int]:
    """Weights as whole numbers that add up to resolution (largest remainders; at least 1 each)."""
    if not weights or any(not w > 0 for w in weights.values()):
        raise ValueError("weights must be positive")
    if len(weights) > resolution:
        raise ValueError("resolution must be at least the number of sources")
    total, spare = sum(weights.values()), resolution - len(weights)
    exact = {s: w / total * spare for s, w in weights.items()}
    out = {s: 1 + int(x) for s, x in exact.items()}
    for s in sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))[: resolution - sum(out.values())]:
        out[s] += 1
    return out


def phases(shares: dict[str, int], blocks: dict[str, int]) -> list[tuple[Fraction, int, int]]:
    """(v, e, a) from each leaving to the next: the round v at which it begins, and e + a*v, the slot of round v within it.

    The slot of any v is the least of all e + a*v, as the slope a falls from phase to phase.
    """
    ends = sorted((Fraction(blocks[s], shares[s]), s) for s in shares)
    out, e, a = [(Fraction(0), 0, sum(shares.values()))], 0, sum(shares.values())
    for v, s in ends[:-1]:
        e, a = e + blocks[s], a - shares[s]
        if v == out[-1][0]:
            out.pop()
        out.append((v, e, a))
    return [x for x in out if x[0] < ends[-1][0]]


def schedule(shares: dict[str, int], blocks: dict[str, int]) -> dict[str, list[tuple[int, int, list[int]]]]:
    """For each source, (first, shift, slots) by first: block first + i has slot slots[i % n] + i // n * shift, n = len(slots).

    Earliest deadline first among released blocks, ties by source name. blocks: whole numbers from 1.
    """
    parts = phases(shares, blocks)
    starts = [-(-(e * v.denominator + a * v.numerator) // v.denominator) for v, e, a in parts]
    out = {s: [(0, 0, [])] for s in shares}
    released, phase_of = dict.fromkeys(shares, 0), dict.fromkeys(shares, 0)
    coming, ready = [(0, s) for s in sorted(shares)], []
    ends = sorted((Fraction(blocks[s], shares[s]), s) for s in shares)
    divisors = [0]  # of the shares of those that leave last, by their number
    for _, s in reversed(ends):
        divisors.append(gcd(divisors[-1], shares[s]))
    t, total, p, mark, before = 0, sum(blocks.values()), -1, 0, None
    while t < total:
        while p + 1 < len(parts) and t >= starts[p + 1]:
            p, mark, before = p + 1, -1, None
            left = bisect_right(ends, parts[p][0], key=lambda x: x[0])
            g = divisors[len(ends) - left]
            period = parts[p][2] // g
            if (starts[p + 1] if p + 1 < len(parts) else total) - t > period:  # else nothing repeats before the next leaving
                until = parts[p + 1][0] if p + 1 < len(parts) else ends[-1][0]
                mark, step = t, {s: shares[s] // g for _, s in ends[left:]}
        if t == mark:  # a period after the last mark: does it repeat?
            now = {s: released[s] for s in step}, sorted((d - t, s) for d, s in ready)
            if before and now[1] == before[1] and all(now[0][s] == before[0][s] + step[s] for s in step):
                m = min(int((until - Fraction(released[s], shares[s])) * g) for s in step)
                if m > 0:
                    for s in step:
                        first, _, slots = out[s].pop()
                        n = len(slots) - step[s]
                        out[s] += [(first, 0, slots[:n]), (first + n, period, slots[n:]), (first + n + (m + 1) * step[s], 0, [])]
                        released[s] += m * step[s]
                    t += m * period
                    ready = [(d + m * period, s) for d, s in ready]
                    coming = [(r + m * period, s) for r, s in coming if released[s] < blocks[s]]
                    heapify(coming)
                    before, mark = None, -1
                    continue
            before, mark = now, t + period
        while coming and coming[0][0] <= t:
            s = heappop(coming)[1]
            x = released[s] = released[s] + 1
            while (q := phase_of[s] + 1) < len(parts) and x * parts[q][0].denominator >= parts[q][0].numerator * shares[s]:
                phase_of[s] = q
            _, e, a = parts[phase_of[s]]
            heappush(ready, (e - (-a * x // shares[s]), s))
            if x < blocks[s]:
                heappush(coming, (e + a * x // shares[s], s))
        deadline, s = heappop(ready)
        if t >= deadline:
            raise AssertionError("a deadline was missed")
        out[s][-1][2].append(t)
        t += 1
    return {s: [x for x in segments if x[2]] for s, segments in out.items()}


def one_period(shares: dict[str, int]) -> dict[str, list[int]]:
    """The slots of each source's blocks in one period, at whose end all sources leave."""
    return {s: segments[0][2] for s, segments in schedule(shares, shares).items()}


def ranked(df: DataFrame, by: str, order: list[Column], rows_per_chunk: int) -> DataFrame:
    """df with _rank: gapless from 0 within each value of `by`, in the order of a hash. No task holds a whole value.

    Each value is cut into chunks by hash; a row's rank is the rows of earlier chunks plus its place in its own. Equal rows
    are numbered, and their numbers hashed, too.
    """
    chunks = max(256, -(-df.count() // rows_per_chunk))
    df = df.withColumns({"_h": unit(*order, seed=29), "_equal": F.struct(by, unit(*order, seed=29).alias("a"), unit(*order, seed=31).alias("b"))})
    df = told_apart(df, "_equal").drop("_equal")
    df = df.withColumn("_h", F.when(F.col("_copy") > 0, unit("_h", "_copy", seed=29)).otherwise(F.col("_h"))).drop("_copy")
    df = df.withColumn("_chunk", F.pmod("_h", F.lit(chunks)))
    counts = df.groupBy(by, "_chunk").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(by, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy(by, "_chunk").orderBy("_h", *order)) - 1
    df = df.withColumn("_place", place)
    return df.join(starts, [by, "_chunk"]).withColumn("_rank", F.col("_start") + F.col("_place")).drop("_h", "_chunk", "_start", "_place")


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    temper: float = 0.75,
    block_rows: int = 8,
    resolution: int = 10_000,
    rows_per_chunk: int = 1_000_000,
) -> DataFrame:
    """docs with _source, _block, _release, _deadline, _slot and _kept.

    weights: target weights by source; a source that is not named gets none of the mix. Default: each source's number of
    rows to the power of `temper`, which lowers the share of the largest. _kept is true for every row of a source that
    has a weight: none is left out because another source is small. A source that runs out leaves the mix, and the others
    go on at their relative weights (see the module), which hold at every prefix, to less than a block; a source's last
    block may be short. The schedule is made on the driver: it takes time in the number of blocks, or of two periods
    for each leaving where that is less; a period has `resolution` blocks, or 4 for each source where that is more.
    A null source is the source 'null'; rows equal in doc_id and text are interchangeable;
    an empty table gives an empty one. Rows keep their columns; only columns with these names are replaced.
    """
    docs = docs.drop("_source", "_block", "_release", "_deadline", "_slot", "_kept").withColumn("_source", F.coalesce("source", F.lit("null")))
    counts = {r["_source"]: r["n"] for r in docs.groupBy("_source").agg(F.count("*").alias("n")).collect()}
    if weights is None:
        weights = {s: n**temper for s, n in counts.items()}
    weights = {s: w for s, w in weights.items() if s in counts}
    new = "_block long, _release long, _deadline long, _slot long, _kept boolean"
    if not weights:
        empty = [F.lit(None).cast(x.split()[1]).alias(x.split()[0]) for x in new.split(", ")]
        return docs.select("*", *empty[:4], F.lit(False).alias("_kept"))
    shares = whole_weights(weights, max(resolution, 4 * len(weights)))
    blocks = {s: -(-counts[s] // block_rows) for s in shares}
    plan, session = schedule(shares, blocks), docs.sparkSession
    # A block's window lies on the line of its phase. Lines stand in groups of a square root of their number; a row looks
    # for its group among their starts (v = n/d), then for its line in the group.
    parts = phases(shares, blocks)
    width = isqrt(len(parts) - 1) + 1
    groups = [parts[i : i + width] for i in range(0, len(parts), width)]
    starts = [(group[0][0].numerator, group[0][0].denominator) for group in groups]
    groups = [(i, [(e, a) for _, e, a in group]) for i, group in enumerate(groups)]
    groups = session.createDataFrame(groups, "_group int, _lines array<struct<e:long,a:long>>")
    sources = [(s, shares[s], [x[0] for x in plan[s]], starts) for s in sorted(shares)]
    sources = session.createDataFrame(sources, "_source string, _share long, _firsts array<long>, _starts array<struct<n:long,d:long>>")
    segments = [(s, i, *x) for s in sorted(shares) for i, x in enumerate(plan[s])]
    segments = session.createDataFrame(segments, "_source string, _segment int, _first long, _shift long, _slots array<long>")
    rank = ranked(docs, "_source", [F.col("doc_id"), F.xxhash64("text")], rows_per_chunk)
    group_of = lambda b: F.expr(f"size(filter(_starts, x -> x.n * _share <= ({b}) * x.d)) - 1")
    return (
        rank.withColumn("_block", F.floor(F.col("_rank") / block_rows).cast("long"))
        .join(F.broadcast(sources), "_source", "left")  # a row a source
        .withColumns({"_from": group_of("_block"), "_to": group_of("_block + 1"), "_segment": F.expr("size(filter(_firsts, x -> x <= _block)) - 1")})
        .join(F.broadcast(groups.toDF("_from", "_lines")), "_from", "left")  # a line a leaving, in all
        .withColumn("_release", F.expr("array_min(transform(_lines, l -> l.e + l.a * _block div _share))"))
        .drop("_lines")
        .join(F.broadcast(groups.toDF("_to", "_lines")), "_to", "left")
        .withColumn("_deadline", F.expr("array_min(transform(_lines, l -> l.e + (l.a * (_block + 1) + _share - 1) div _share))"))
        .drop("_share", "_firsts", "_starts", "_lines", "_from", "_to")
        .join(F.broadcast(segments), ["_source", "_segment"], "left")  # some periods' numbers for each leaving, in all
        .withColumn("_slot", F.expr("get(_slots, cast((_block - _first) % size(_slots) as int)) + (_block - _first) div size(_slots) * _shift"))
        .withColumn("_kept", F.col("_slot").isNotNull())
        .drop("_segment", "_first", "_shift", "_slots", "_rank")
    )
