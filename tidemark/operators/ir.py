"""Evaluation of rankings: metrics, comparisons between arms, paired statistics and gates.

Randomness is md5 of a seed and keys, so that other engines can draw the same.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import written

METRICS = ("accuracy", "precision", "recall", "mrr", "ndcg")


def eval_set(queries: DataFrame, relevant: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(queries that have a relevant id, one row with the number dropped)."""
    has = relevant.select("query_id").distinct()
    return queries.join(has, "query_id", "left_semi"), queries.join(has, "query_id", "left_anti").agg(F.count("*").alias("dropped"))


def per_query(rankings: DataFrame, relevant: DataFrame, ks: tuple[int, ...] = (1, 3, 5, 10), map_k: int = 100) -> DataFrame:
    """rankings([arm,] query_id, id, rank), relevant(query_id, id) -> n_rel, accuracy, precision, recall, mrr, ndcg at each k (as accuracy_1, ...) and map at map_k.

    Each query that has a relevant id has a row, for each arm that ranks any query.
    """
    arm = ["arm"] if "arm" in rankings.columns else []
    relevant = relevant.select("query_id", "id").distinct()
    n = relevant.groupBy("query_id").agg(F.count("*").alias("n_rel"))
    if arm:
        n = n.join(F.broadcast(rankings.select("arm").distinct()))  # a handful of arms
    hits = rankings.where(F.col("rank") <= max(*ks, map_k)).join(relevant, ["query_id", "id"], "left_semi")
    so_far = F.row_number().over(Window.partitionBy(*arm, "query_id").orderBy("rank"))
    hits = hits.withColumn("_gain", 1 / F.log2(F.col("rank") + 1)).withColumn("_p", so_far / F.col("rank"))
    sums = [F.sum(F.when(F.col("rank") <= map_k, F.col("_p"))).alias("_ap"), F.min("rank").alias("_first")]
    for k in ks:
        sums += [F.count_if(F.col("rank") <= k).alias(f"_n{k}"), F.sum(F.when(F.col("rank") <= k, F.col("_gain"))).alias(f"_dcg{k}")]
    got = n.join(hits.groupBy(*arm, "query_id").agg(*sums), [*arm, "query_id"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    out = []
    for k in ks:
        hit = F.coalesce(F.col(f"_n{k}"), F.lit(0))
        ideal = F.aggregate(F.sequence(F.lit(1), F.least("n_rel", F.lit(k)).cast("int")), F.lit(0.0), lambda a, i: a + 1 / F.log2(i + 1))
        out += [
            (hit > 0).cast("double").alias(f"accuracy_{k}"),
            (hit / k).alias(f"precision_{k}"),
            (hit / F.col("n_rel")).alias(f"recall_{k}"),
            zero(F.when(F.col("_first") <= k, 1 / F.col("_first"))).alias(f"mrr_{k}"),
            zero(F.col(f"_dcg{k}") / ideal).alias(f"ndcg_{k}"),
        ]
    return got.select(*arm, "query_id", "n_rel", *out, zero(F.col("_ap") / F.least("n_rel", F.lit(map_k))).alias(f"map_{map_k}"))


def stacked(metrics: DataFrame, names: list[str]) -> DataFrame:
    """arm, query_id, metric, value of per-query metrics in columns."""
    return metrics.unpivot(["arm", "query_id"], names, "metric", "value")


def aggregate(metrics: DataFrame, names: list[str]) -> DataFrame:
    """The mean of each metric by arm."""
    return metrics.groupBy("arm").agg(*(F.avg(m).alias(m) for m in names))


def compare(summary: DataFrame, names: list[str], baseline: str, arms: list[str]) -> DataFrame:
    """metric, a column for each arm, and delta_<arm> against the baseline."""
    wide = summary.unpivot(["arm"], names, "metric", "value").groupBy("metric").pivot("arm", arms).agg(F.first("value"))
    return wide.select("metric", *arms, *((F.col(a) - F.col(baseline)).alias(f"delta_{a}") for a in arms if a != baseline))


def deltas(metrics: DataFrame, names: list[str], arm: str, baseline: str, by: list[str] | None = None) -> DataFrame:
    """metric, by, query_id, delta of each query: arm less baseline, to 12 places, so that equal values differ by 0 in whatever order their parts were added."""
    keep = by or []
    long = metrics.unpivot(["arm", "query_id", *keep], names, "metric", "value").where(F.col("arm").isin(arm, baseline))
    pick = lambda a: F.max(F.when(F.col("arm") == a, F.col("value")))
    return long.groupBy("metric", *keep, "query_id").agg(pick(arm).alias("_a"), pick(baseline).alias("_b")).where("_a is not null and _b is not null").select("metric", *keep, "query_id", F.round(F.col("_a") - F.col("_b"), 12).alias("delta"))


#: Fixed values of md5: rotations, constants and the first state.
_TURNS = [7, 12, 17, 22] * 4 + [5, 9, 14, 20] * 4 + [4, 11, 16, 23] * 4 + [6, 10, 15, 21] * 4
_SINES = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_STATE = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


def _digests(head: bytes, first: int, last: int) -> np.ndarray:
    """The md5 of head and each number from first to last - 1 in decimal, all of as many digits, as four words each. Many at
    once take a sixth of the time of one after the other; head and digits are at most 55 bytes."""
    digits = len(str(first))
    size = len(head) + digits
    text = head + bytes(digits) + b"\x80"
    fixed = [int(x) for x in np.frombuffer(text.ljust(56, b"\0") + (8 * size).to_bytes(8, "little"), "<u4")]
    j, own = np.arange(first, last, dtype=np.uint32), {}
    for k in range(digits):
        at = size - 1 - k
        byte = (j // np.uint32(10**k) % np.uint32(10) + np.uint32(48)) << np.uint32(8 * (at % 4))
        own[at // 4] = own.get(at // 4, np.uint32(fixed[at // 4])) | byte
    a, b, c, d = (np.full(len(j), x, np.uint32) for x in _STATE)
    f, turned = np.empty_like(a), np.empty_like(a)
    for i in range(64):
        if i < 32:
            x, y, z, m = (b, c, d, i) if i < 16 else (d, b, c, (5 * i + 1) % 16)
            np.bitwise_xor(y, z, f)
            f &= x
            f ^= z
        elif i < 48:
            m = (3 * i + 5) % 16
            np.bitwise_xor(b, c, f)
            f ^= d
        else:
            m = 7 * i % 16
            np.bitwise_not(d, f)
            f |= b
            f ^= c
        f += a
        if m in own:
            f += own[m]
        f += np.uint32((_SINES[i] + (0 if m in own else fixed[m])) % 2**32)
        np.right_shift(f, np.uint32(32 - _TURNS[i]), turned)
        f <<= np.uint32(_TURNS[i])
        f |= turned
        f += b
        a, b, c, d, f = d, f, b, c, a
    return np.stack([x + np.uint32(y) for x, y in zip((a, b, c, d), _STATE)], axis=1)


def multiplicities(seed: int, i: int, n: int, lo: int = 0, width: int | None = None) -> np.ndarray:
    """How often resample i draws each of n places, or of the `width` places from lo on. The md5 of seed, i and j // 4 gives draws j, j + 1, j + 2 and j + 3: four bytes each, modulo n."""
    head, last, width = b"%d:%d:" % (seed, i), -(-n // 4), n if width is None else width
    cuts = sorted({0, last, *(10**k for k in range(1, 20) if 10**k < last)})
    draws, at = np.empty((last, 4), np.uint32), 0
    for start, stop in zip(cuts, cuts[1:]):
        for at in range(start, stop, 1 << 14):
            draws[at : min(at + (1 << 14), stop)] = _digests(head, at, min(at + (1 << 14), stop))
    places = draws.ravel().byteswap()[:n] % np.uint32(n)
    if width < n:
        places -= np.uint32(lo)
        places = places[places < width]
    return np.bincount(places, minlength=width)


def resampled(delta: DataFrame, n: int, seed: int, by: list[str], most: int, block: int | None = None) -> DataFrame:
    """by, _i, _mean: the mean of each group's delta in each of n resamples.

    Draws depend on a group's size alone. Groups of one size are put together, so that one table of multiplicities
    (resample x place), made `block` resamples a task (a 48th of all unless given), is multiplied with all of them at once. A
    task holds about `most` numbers: where the groups have more, places are cut into ranges, each a task that counts the
    draws that fall into it, and the ranges' sums are added.
    """
    most, block = max(most, 1), block or -(-n // 48)
    place = F.row_number().over(Window.partitionBy(*by).orderBy("query_id")) - 1
    placed = written(delta.select(*by, "delta", place.cast("long").alias("_place")), "places")
    sizes = placed.groupBy(*by).agg(F.count("*").alias("_n"))
    fit = F.greatest(F.lit(1024), F.floor(F.lit(most) / F.col("_n")))  # groups of a part
    groups = sizes.groupBy("_n").agg(F.count("*").alias("_g")).withColumn("_parts", F.ceil(F.col("_g") / fit))
    ranges = F.least(F.col("_n"), F.greatest(F.lit(1), F.ceil(F.least("_g", fit) * F.col("_n") / most)))
    groups = groups.withColumn("_width", F.ceil(F.col("_n") / ranges)).select("_n", "_parts", "_width")
    sized = placed.join(sizes.join(groups, "_n"), by)
    by_ = F.struct(*by)
    cut = sized.select(
        by_.alias("_by"), "_n", "_width", F.pmod(F.xxhash64(F.to_json(by_)), F.col("_parts")).alias("_part"), F.floor(F.col("_place") / F.col("_width")).alias("_range"), "_place", "delta"
    )
    # A row for each 65,536 places of a group and range.
    piece = F.floor((F.col("_place") - F.col("_range") * F.col("_width")) / (1 << 16))
    rows = cut.groupBy("_by", "_n", "_width", "_part", "_range", piece.alias("_piece")).agg(F.array_sort(F.collect_list(F.struct("_place", "delta"))).alias("_d"))
    rows = rows.select("_by", "_n", "_width", "_part", "_range", F.col("_d.delta").alias("_d"), "_piece").withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit((n - 1) // block))))

    def sums(key: tuple, groups: pa.Table) -> pa.Table:
        size, width, number, first = key[0].as_py(), key[1].as_py(), key[3].as_py(), key[4].as_py() * block
        wide = min(width, size - number * width)
        names, at = np.unique([repr(x) for x in groups["_by"].to_pylist()], return_index=True, return_inverse=True)[1:]
        values = np.zeros((len(names), wide))
        for row, piece_, d in zip(at, groups["_piece"].to_pylist(), groups["_d"]):
            x = d.values.to_numpy(zero_copy_only=False)
            values[row, piece_ << 16 : (piece_ << 16) + len(x)] = x
        found, last = [np.zeros((0, len(names)))], min(first + block, n)
        few = max(1, (1 << 22) // wide)  # 32 MB of multiplicities at once
        for i in range(first, last, few):
            found.append(np.stack([multiplicities(seed, j, size, number * width, wide) for j in range(i, min(i + few, last))]).astype(float) @ values.T)
        found = np.concatenate(found)
        of = pa.array(np.tile(names, len(found)))
        return pa.table([groups["_by"].combine_chunks().take(of), pa.array(np.repeat(np.arange(first, last), len(names))), pa.array(found.ravel() / size)], names=["_by", "_i", "_part_of_mean"])

    form = ", ".join(f"`{c}`: {delta.schema[c].dataType.simpleString()}" for c in by)
    # Rows are few and their work is much: by a number of partitions of its own, as by size they would come to few tasks.
    keys = ["_n", "_width", "_part", "_range", "_block"]
    parts = rows.repartition(192, *keys).groupBy(*keys).applyInArrow(sums, f"_by struct<{form}>, _i long, _part_of_mean double")
    return parts.groupBy("_by", "_i").agg(F.sum("_part_of_mean").alias("_mean")).select("_by.*", "_i", "_mean")


def paired_bootstrap(delta: DataFrame, n: int = 10_000, seed: int = 0, by: tuple[str, ...] = ("metric",), most: int = 1 << 25) -> DataFrame:
    """delta(by, query_id, delta) -> by, queries, delta (mean), ci_lo, ci_hi, p_two_sided, improved, worsened, unchanged.

    Resamples the queries of each group with replacement n times; draw j of resample i takes the query at a
    place told by an md5 (see `multiplicities`). A task holds about `most` numbers of the groups (see `resampled`). Interval: 2.5 and 97.5 percentiles, linear; p: twice the smaller tail, 1 at most.
    """
    by = list(by)
    total = delta.groupBy(*by).agg(
        F.count("*").alias("queries"), F.avg("delta").alias("delta"), F.count_if(F.col("delta") > 0).alias("improved"), F.count_if(F.col("delta") < 0).alias("worsened"), F.count_if(F.col("delta") == 0).alias("unchanged")
    )
    means = resampled(delta, n, seed, by, most).withColumn("_mean", F.round("_mean", 12))
    spread = means.groupBy(*by).agg(
        F.percentile("_mean", F.lit(0.025)).alias("ci_lo"), F.percentile("_mean", F.lit(0.975)).alias("ci_hi"), F.least(F.avg((F.col("_mean") <= 0).cast("double")), F.avg((F.col("_mean") >= 0).cast("double"))).alias("_tail")
    )
    p = F.least(F.lit(1.0), 2 * F.col("_tail")).alias("p_two_sided")
    return total.join(spread, by).select(*by, "queries", "delta", "ci_lo", "ci_hi", p, "improved", "worsened", "unchanged")


def significance_table(metrics: DataFrame, names: list[str], arm: str, baseline: str, n: int = 10_000, seed: int = 0) -> DataFrame:
    """The bootstrap of many metrics at once; significant: the interval leaves out 0."""
    out = paired_bootstrap(deltas(metrics, names, arm, baseline), n, seed)
    return out.withColumn("significant", (F.col("ci_lo") > 0) | (F.col("ci_hi") < 0))


def stratum(n: Column) -> Column:
    return F.when(n <= 5, "1-5").when(n <= 15, "6-15").when(n <= 40, "16-40").otherwise("41+")


def stratify(metrics: DataFrame, name: str, arm: str, baseline: str, n: int = 5000, seed: int = 0) -> DataFrame:
    """bucket of relevant ids, queries, the mean of both arms, and the bootstrap of their difference."""
    rows = metrics.withColumn("bucket", stratum(F.col("n_rel")))
    mean = lambda a, out: F.avg(F.when(F.col("arm") == a, F.col(name))).alias(out)
    both = rows.groupBy("bucket").agg(mean(arm, "arm_mean"), mean(baseline, "baseline_mean"))
    boot = paired_bootstrap(deltas(rows, [name], arm, baseline, by=["bucket"]), n, seed, by=("bucket",))
    return both.join(boot, "bucket")


def treated_subset(rankings: DataFrame, arm: str, baseline: str, k: int) -> DataFrame:
    """Queries whose first k ids, in order, differ between two arms."""
    first = rankings.where((F.col("rank") <= k) & F.col("arm").isin(arm, baseline)).groupBy("query_id", "rank").agg(F.count_distinct("id").alias("_ids"), F.count("*").alias("_n"))
    return first.where("_ids > 1 or _n < 2").select("query_id").distinct()


def coverage(queries: DataFrame, relevant: DataFrame, corpus: DataFrame) -> DataFrame:
    """One row: queries, relevant (distinct ids), missing (those that the corpus lacks)."""
    ids = relevant.select("id").distinct()
    gone = ids.join(corpus.select("id").distinct(), "id", "left_anti").agg(F.count("*").alias("missing"))
    return queries.agg(F.count_distinct("query_id").alias("queries")).join(ids.agg(F.count("*").alias("relevant"))).join(gone)


def order_statistics(values: DataFrame, by: str, value: str, places: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """by, and for each name in `places` the value at that place (from 0) of the group's values in order; places: of the count n.

    Equal values are counted first. What remains is cut into ranges of (by, value); a place falls into one range of its
    group by the ranges' counts, and only those ranges are put in order, each by a task of its own. So no task holds a group.
    """
    counted = values.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.count("*").alias("_c"))
    cut = written(counted.repartitionByRange(by, value).withColumn("_part", F.spark_partition_id()), "ranges")
    along = Window.partitionBy(by).orderBy("_part")
    ranges = cut.groupBy(by, "_part").agg(F.sum("_c").alias("_n"))  # a row a range
    ranges = ranges.withColumns({"_start": F.sum("_n").over(along) - F.col("_n"), "_all": F.sum("_n").over(Window.partitionBy(by))})
    wanted = F.explode(F.array(*(F.struct(F.lit(name).alias("_name"), f(F.col("_all")).cast("long").alias("_place")) for name, f in places.items())))
    found = ranges.select(by, "_part", "_start", "_n", wanted.alias("_w")).where("_w._place >= _start and _w._place < _start + _n").select(F.col(by).alias("_by"), F.col("_part").alias("_in"), "_w._name", (F.col("_w._place") - F.col("_start")).alias("_place"))
    upto = F.sum("_c").over(Window.partitionBy(by, "_part").orderBy(value))
    near = cut.join(found.select("_by", "_in").distinct(), F.col(by).eqNullSafe(F.col("_by")) & (F.col("_part") == F.col("_in")), "left_semi").withColumn("_upto", upto)
    hits = near.join(found, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_part") == F.col("_in")) & (F.col("_place") < F.col("_upto")) & (F.col("_place") >= F.col("_upto") - F.col("_c")))
    return hits.groupBy(by).agg(*(F.max(F.when(F.col("_name") == name, F.col(value))).alias(name) for name in places))


#: Places of the two middle values, and of the ranked 90th percentile: a value itself, never between two.
MIDDLE = {"_low": lambda n: F.floor((n - 1) / 2), "_high": lambda n: F.ceil((n - 1) / 2)}
RANKED_90 = {"p90": lambda n: F.least(n - 1, F.floor(F.lit(0.9) * n))}


def latency(timings: DataFrame) -> DataFrame:
    """timings(arm, query_id, seconds) -> arm, queries, median_ms."""
    n = timings.groupBy("arm").agg(F.count("*").alias("queries"))
    middle = order_statistics(timings, "arm", "seconds", MIDDLE).withColumnRenamed("arm", "_arm")
    return n.join(middle, n["arm"].eqNullSafe(F.col("_arm")), "left").select("arm", "queries", ((F.col("_low") + F.col("_high")) / 2 * 1000).alias("median_ms"))


def discrimination(scores: DataFrame, records: DataFrame, corpus_size: int, shortlist: int) -> DataFrame:
    """One row that tells if chunks of a record answer a query better than another query does.

    scores(kind: true or control, query_id, id, chunk_idx, score), records(query_id, id, score: of the whole record).
    Spread: greatest less least chunk score of a record. within_true, within_control: means over records of more than one
    chunk; across: mean over queries of the spread of records' best chunks; lift: mean of the best chunk less the record;
    positive_pct: share of records where that is above 0; ratio: within_true by within_control. A shortlist of half the
    corpus or more is refused: then the control would be a permutation of the true condition.
    """
    if 2 * shortlist >= corpus_size:
        raise ValueError("the shortlist covers half of the corpus or more")
    each = scores.groupBy("kind", "query_id", "id").agg((F.max("score") - F.min("score")).alias("spread"), F.max("score").alias("best"), F.count("*").alias("_n")).where("_n > 1")
    true = each.where("kind = 'true'").join(records.select("query_id", "id", F.col("score").alias("record")), ["query_id", "id"])
    own = true.agg(F.count("*").alias("records"), F.avg("spread").alias("within_true"), F.avg(F.col("best") - F.col("record")).alias("lift"), (100 * F.avg((F.col("best") > F.col("record")).cast("double"))).alias("positive_pct"))
    control = each.where("kind = 'control'").agg(F.avg("spread").alias("within_control"))
    across = true.groupBy("query_id").agg((F.max("best") - F.min("best")).alias("_a"), F.count("*").alias("_n")).where("_n > 1").agg(F.avg("_a").alias("across"))
    t, c = F.col("within_true"), F.col("within_control")
    ratio = F.when(c > 1e-9, t / c).when(t > 1e-9, F.lit(float("inf"))).otherwise(1.0)
    return own.join(control).join(across).withColumn("ratio", ratio)


def spread_summary(values: DataFrame, by: str, value: str) -> DataFrame:
    """by, n, mean, median and the ranked 90th percentile of each group's values."""
    own = values.groupBy(by).agg(F.count(value).alias("n"), F.avg(value).alias("mean"))
    ranked = order_statistics(values, by, value, MIDDLE | RANKED_90).withColumnRenamed(by, "_group")
    return own.join(ranked, F.col(by).eqNullSafe(F.col("_group")), "left").select(by, "n", "mean", ((F.col("_low") + F.col("_high")) / 2).alias("median"), "p90")


def context_tokens(chars: Column) -> Column:
    """About a token per four characters, rounded half to even, at least one."""
    return F.greatest(F.lit(1), F.bround(chars / 4).cast("int"))


def context_cost(ranked: DataFrame) -> DataFrame:
    """ranked(query_id, id, n_chunks, full_chars, snippet_chars) -> bucket (chunks of the record: 1, 2-3, 4-7, 8+), hits, full, snippet (tokens), saved_pct.

    A hit without a snippet costs its full text. The bucket 'all' has all hits, and query_mean_full and query_mean_snippet
    the mean of its queries' sums.
    """
    full = context_tokens(F.col("full_chars"))
    rows = ranked.select("query_id", F.when(F.col("n_chunks") <= 1, "1").when(F.col("n_chunks") <= 3, "2-3").when(F.col("n_chunks") <= 7, "4-7").otherwise("8+").alias("bucket"), full.alias("_full"), F.when(F.col("snippet_chars") > 0, context_tokens(F.col("snippet_chars"))).otherwise(full).alias("_snippet"))
    sums = lambda df: df.agg(F.count("*").alias("hits"), F.sum("_full").cast("long").alias("full"), F.sum("_snippet").cast("long").alias("snippet"))
    none = F.lit(None).cast("double")
    parts = sums(rows.groupBy("bucket")).withColumns({"query_mean_full": none, "query_mean_snippet": none})
    each = rows.groupBy("query_id").agg(F.sum("_full").alias("_f"), F.sum("_snippet").alias("_s"))
    whole = sums(rows).select(F.lit("all").alias("bucket"), "hits", "full", "snippet").join(each.agg(F.avg("_f").alias("query_mean_full"), F.avg("_s").alias("query_mean_snippet")))
    return parts.unionByName(whole).withColumn("saved_pct", 100 * (1 - F.col("snippet") / F.col("full")))


def quality_gate(summary: DataFrame, names: list[str], floor: float = 0.15, strict: bool = False) -> DataFrame:
    """arm, metric, value of everything below the floor (null, too); strict: an error if there is any."""
    low = summary.unpivot(["arm"], names, "metric", "value").where(F.col("value").isNull() | (F.col("value") < floor))
    if strict and (bad := low.limit(5).collect()):
        raise ValueError(f"not to be promoted: {bad}")
    return low


def drift_check(history: DataFrame, floor: float = 0.35, drop: float = 0.02) -> DataFrame:
    """history(measured, value) with previous and reasons: below_floor, dropped (by more than `drop` against the measurement before).

    A log of measurements has a row a run: one window orders all of it.
    """
    rows = history.withColumn("previous", F.lag("value").over(Window.orderBy("measured")))
    reasons = F.array_compact(F.array(F.when(F.col("value") < floor, "below_floor"), F.when(F.col("previous") - F.col("value") > drop, "dropped")))
    return rows.withColumn("reasons", F.array_join(reasons, ","))
