"""Queries of evaluation. Customers are queries, their orders the ids: one arm ranks them by price, the other by day; urgent
orders are relevant. Rankings go to 100, as their mean average precision does."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ir, search
from ..operators.store import written
from .base import query, t

KS = (1, 3, 10)
NAMES = [f"{m}_{k}" for k in KS for m in ir.METRICS] + ["map_100"]
_RANKED = """o AS (SELECT o_custkey AS query_id, o_orderkey AS id, o_totalprice, o_orderdate, o_orderpriority FROM orders),
    ranked AS (SELECT 'price' AS arm, query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY o_totalprice DESC, id) AS rank FROM o QUALIFY rank <= 100 UNION ALL SELECT 'day', query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY o_orderdate DESC, id) AS rank FROM o QUALIFY rank <= 100),
    rel AS (SELECT DISTINCT query_id, id FROM o WHERE o_orderpriority = '1-URGENT'), nrel AS (SELECT query_id, count(*) AS n_rel FROM rel GROUP BY 1),
    h AS (SELECT arm, query_id, rank, row_number() OVER (PARTITION BY arm, query_id ORDER BY rank) AS hit FROM ranked JOIN rel USING (query_id, id))"""
_ONE = """coalesce(count(h.rank) FILTER (h.rank <= {k}) > 0, false)::INT::DOUBLE AS accuracy_{k}, count(h.rank) FILTER (h.rank <= {k}) / {k} AS precision_{k}, count(h.rank) FILTER (h.rank <= {k}) / n_rel AS recall_{k}, coalesce(1 / min(h.rank) FILTER (h.rank <= {k}), 0) AS mrr_{k},
    coalesce(sum(1 / log2(h.rank + 1)) FILTER (h.rank <= {k}) / (SELECT sum(1 / log2(i + 1)) FROM range(1, 11) AS x(i) WHERE i <= least(n_rel, {k})), 0) AS ndcg_{k}"""
_METRICS = f"""WITH {_RANKED}, met AS (SELECT a.arm, n.query_id, n_rel, {', '.join(_ONE.format(k=k) for k in KS)}, coalesce(sum(hit / h.rank), 0) / least(n_rel, 100) AS map_100
    FROM nrel n JOIN (VALUES ('price'), ('day')) AS a(arm) ON true LEFT JOIN h ON h.query_id = n.query_id AND h.arm = a.arm GROUP BY a.arm, n.query_id, n_rel)"""
_ROUNDED = ", ".join(f"round({m}, 6) AS {m}" for m in NAMES)


def arms(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(rankings, relevant)"""
    o = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("query_id"), F.col("o_orderkey").alias("id"), "o_totalprice", "o_orderdate", "o_orderpriority")
    rank = lambda c, arm: search.top(o.select("query_id", "id", F.col(c).alias("score")), 100).select(F.lit(arm).alias("arm"), "query_id", "id", "rank")
    return rank("o_totalprice", "price").unionByName(rank("o_orderdate", "day")), o.where("o_orderpriority = '1-URGENT'").select("query_id", "id")


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ir.per_query(*arms(spark, sf_dir), KS, 100)


def rounded(df: DataFrame, *names: str, places: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, places) for n in names})


@query(f"{_METRICS} SELECT arm, query_id, n_rel, {_ROUNDED} FROM met")
def ir_per_query(spark, sf_dir):
    return rounded(metrics(spark, sf_dir), *NAMES)


@query(f"WITH {_RANKED} SELECT c_custkey AS query_id, (SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT query_id FROM rel)) AS dropped FROM customer WHERE c_custkey IN (SELECT query_id FROM rel)")
def ir_eval_set(spark, sf_dir):
    kept, dropped = ir.eval_set(t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("query_id")), arms(spark, sf_dir)[1])
    return kept.join(dropped)


@query(f"{_METRICS} SELECT arm, {', '.join(f'round(avg({m}), 6) AS {m}' for m in NAMES)} FROM met GROUP BY 1")
def ir_aggregate(spark, sf_dir):
    return rounded(ir.aggregate(metrics(spark, sf_dir), NAMES), *NAMES)


_LONG = f"long AS (SELECT arm, query_id, n_rel, metric, value FROM (SELECT * FROM met) UNPIVOT (value FOR metric IN ({', '.join(NAMES)})))"


@query(f"{_METRICS}, {_LONG}, s AS (SELECT metric, avg(value) FILTER (arm = 'price') AS price, avg(value) FILTER (arm = 'day') AS day FROM long GROUP BY 1) SELECT metric, round(price, 6) AS price, round(day, 6) AS day, round(day - price, 6) AS delta_day FROM s")
def ir_compare(spark, sf_dir):
    return rounded(ir.compare(ir.aggregate(metrics(spark, sf_dir), NAMES), NAMES, "price", ["price", "day"]), "price", "day", "delta_day")


def _boot(seed: int, n: int, by: str, names: list[str]) -> str:
    """SQL of the bootstrap of d([by,] query_id, and a difference a name): a row for each of `by` and name. All names have the same queries."""
    each = lambda form: ", ".join(form.format(m=m) for m in names)
    part, and_by = (f"PARTITION BY {by}", f"{by}, ") if by else ("", "")
    return f"""pl AS MATERIALIZED (SELECT *, row_number() OVER ({part} ORDER BY query_id) - 1 AS place, count(*) OVER ({part}) AS n FROM d),
    dr AS (SELECT {and_by}i, n, CAST('0x' || substr(md5('{seed}:' || i || ':' || (place // 4)), CAST(place % 4 * 8 + 1 AS INTEGER), 8) AS BIGINT) % n AS place FROM pl, range({n}) AS r(i)),
    mu AS (SELECT {and_by}i, place, count(*) AS times FROM dr GROUP BY ALL),
    me AS MATERIALIZED (SELECT {and_by}i, {each('round(sum(times * {m}) / any_value(n), 12) AS {m}')} FROM mu JOIN pl USING ({and_by}place) GROUP BY {and_by}i),
    ml AS (SELECT {and_by}metric, m FROM me UNPIVOT (m FOR metric IN ({each('{m}')}))),
    sp AS (SELECT {and_by}metric, quantile_cont(m, 0.025) AS ci_lo, quantile_cont(m, 0.975) AS ci_hi, least(avg((m <= 0)::INT), avg((m >= 0)::INT)) AS tail FROM ml GROUP BY ALL),
    tot AS (SELECT {and_by}metric, count(*) AS queries, avg(delta) AS delta, count(*) FILTER (delta > 0) AS improved, count(*) FILTER (delta < 0) AS worsened, count(*) FILTER (delta = 0) AS unchanged FROM (SELECT * FROM d) UNPIVOT (delta FOR metric IN ({each('{m}')})) GROUP BY ALL),
    boot AS (SELECT {and_by}metric, queries, round(delta, 6) AS delta, round(ci_lo, 6) AS ci_lo, round(ci_hi, 6) AS ci_hi, round(least(1.0, 2 * tail), 6) AS p_two_sided, improved, worsened, unchanged, ci_lo > 0 OR ci_hi < 0 AS significant FROM tot JOIN sp USING ({and_by}metric))"""


def _differences(source: str, names: list[str], by: str = "") -> str:
    pick = ", ".join(f"round(max({m}) FILTER (arm = 'day') - max({m}) FILTER (arm = 'price'), 12) AS {m}" for m in names)
    return f"d AS MATERIALIZED (SELECT {by}query_id, {pick} FROM {source} GROUP BY ALL)"


BOOT = ("delta", "ci_lo", "ci_hi", "p_two_sided")
RESAMPLES, STRATUM_RESAMPLES = 10_000, 5_000


@query(f"{_METRICS}, {_differences('met', NAMES)}, {_boot(0, RESAMPLES, '', NAMES)} SELECT * EXCLUDE (significant) FROM boot")
def ir_paired_bootstrap(spark, sf_dir):
    m = written(metrics(spark, sf_dir), "metrics")
    return rounded(ir.paired_bootstrap(ir.deltas(m, NAMES, "day", "price"), RESAMPLES), *BOOT)


@query(f"{_METRICS}, {_differences('met', NAMES)}, {_boot(7, RESAMPLES, '', NAMES)} SELECT * FROM boot")
def ir_significance_table(spark, sf_dir):
    m = written(metrics(spark, sf_dir), "metrics")
    return rounded(ir.significance_table(m, NAMES, "day", "price", RESAMPLES, 7), *BOOT)


_BUCKET = "CASE WHEN n_rel <= 5 THEN '1-5' WHEN n_rel <= 15 THEN '6-15' WHEN n_rel <= 40 THEN '16-40' ELSE '41+' END"


@query(f"""{_METRICS}, b AS (SELECT *, {_BUCKET} AS bucket FROM met), {_differences('b', ['ndcg_10'], 'bucket, ')}, {_boot(3, STRATUM_RESAMPLES, 'bucket', ['ndcg_10'])}
    SELECT bucket, round(avg(ndcg_10) FILTER (arm = 'day'), 6) AS arm_mean, round(avg(ndcg_10) FILTER (arm = 'price'), 6) AS baseline_mean, any_value(queries) AS queries, any_value(delta) AS delta, any_value(ci_lo) AS ci_lo, any_value(ci_hi) AS ci_hi, any_value(p_two_sided) AS p_two_sided, any_value(improved) AS improved, any_value(worsened) AS worsened, any_value(unchanged) AS unchanged FROM b JOIN boot USING (bucket) GROUP BY 1""")
def ir_stratify(spark, sf_dir):
    m = written(metrics(spark, sf_dir), "metrics")
    return rounded(ir.stratify(m, "ndcg_10", "day", "price", STRATUM_RESAMPLES, 3).drop("metric"), "arm_mean", "baseline_mean", *BOOT)


@query(f"WITH {_RANKED} SELECT query_id FROM (SELECT query_id, list(id ORDER BY rank) FILTER (arm = 'price' AND rank <= 3) AS a, list(id ORDER BY rank) FILTER (arm = 'day' AND rank <= 3) AS b FROM ranked GROUP BY 1) WHERE a IS DISTINCT FROM b")
def ir_treated_subset(spark, sf_dir):
    return ir.treated_subset(arms(spark, sf_dir)[0], "day", "price", 3)


@query("SELECT (SELECT count(DISTINCT c_custkey) FROM customer) AS queries, (SELECT count(DISTINCT l_partkey) FROM lineitem) AS relevant, (SELECT count(DISTINCT l_partkey) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25)) AS missing")
def ir_coverage(spark, sf_dir):
    ids = t(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("id"))
    return ir.coverage(t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("query_id")), ids, t(spark, sf_dir, "part").where("p_size <= 25").select(F.col("p_partkey").alias("id")))


@query("SELECT event_type AS arm, count(*) AS queries, round(quantile_cont(value, 0.5) * 1000, 6) AS median_ms FROM events GROUP BY 1")
def ir_latency(spark, sf_dir):
    e = t(spark, sf_dir, "events").select(F.col("event_type").alias("arm"), F.col("user_id").alias("query_id"), F.col("value").alias("seconds"))
    return rounded(ir.latency(e), "median_ms")


# Orders are records of an order's customer, their lines the chunks; the control scores lines by tax instead of quantity.
_SCORES = """s AS (SELECT 'true' AS kind, o_custkey AS query_id, o_orderkey AS id, l_quantity / 50.0 AS score FROM orders JOIN lineitem ON o_orderkey = l_orderkey UNION ALL SELECT 'control', o_custkey, o_orderkey, l_tax * 10 FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
    e AS (SELECT kind, query_id, id, max(score) - min(score) AS spread, max(score) AS best FROM s GROUP BY 1, 2, 3 HAVING count(*) > 1), tr AS (SELECT e.*, o_totalprice / 500000.0 AS record FROM e JOIN orders ON o_orderkey = id WHERE kind = 'true')"""


@query(f"""WITH {_SCORES}, own AS (SELECT count(*) AS records, avg(spread) AS within_true, avg(best - record) AS lift, 100 * avg((best > record)::INT) AS positive_pct FROM tr), c AS (SELECT avg(spread) AS within_control FROM e WHERE kind = 'control'),
    a AS (SELECT avg(x) AS across FROM (SELECT max(best) - min(best) AS x FROM tr GROUP BY query_id HAVING count(*) > 1))
    SELECT records, round(within_true, 6) AS within_true, round(within_control, 6) AS within_control, round(across, 6) AS across, round(lift, 6) AS lift, round(positive_pct, 6) AS positive_pct, round(within_true / within_control, 6) AS ratio FROM own, c, a""")
def ir_discrimination(spark, sf_dir):
    rows = t(spark, sf_dir, "orders").join(t(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    pick = lambda kind, c: rows.select(F.lit(kind).alias("kind"), F.col("o_custkey").alias("query_id"), F.col("o_orderkey").alias("id"), F.col("l_linenumber").alias("chunk_idx"), c.alias("score"))
    scores = pick("true", F.col("l_quantity") / 50.0).unionByName(pick("control", F.col("l_tax") * 10))
    o = t(spark, sf_dir, "orders")
    records = o.select(F.col("o_custkey").alias("query_id"), F.col("o_orderkey").alias("id"), (F.col("o_totalprice") / 500000.0).alias("score"))
    out = ir.discrimination(scores, records, o.count(), 50)
    return rounded(out, "within_true", "within_control", "across", "lift", "positive_pct", "ratio")


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) - 1 AS i, count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem)
    SELECT l_returnflag AS "group", count(*) AS n, round(avg(l_extendedprice), 4) AS mean, round(quantile_cont(l_extendedprice, 0.5), 4) AS median, round(max(l_extendedprice) FILTER (i = least(n - 1, CAST(floor(0.9 * n) AS BIGINT))), 4) AS p90 FROM r GROUP BY 1""")
def ir_spread_summary(spark, sf_dir):
    x = t(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("group"), F.col("l_extendedprice").cast("double").alias("v"))
    return rounded(ir.spread_summary(x, "group", "v"), "mean", "median", "p90", places=4)


_COST = """r AS (SELECT doc_id AS id, doc_id % 37 AS query_id, doc_id % 11 AS n_chunks, length(text) AS f, CASE WHEN doc_id % 5 <> 0 THEN length(text) // 3 ELSE 0 END AS s FROM documents WHERE text IS NOT NULL),
    k AS (SELECT query_id, CASE WHEN n_chunks <= 1 THEN '1' WHEN n_chunks <= 3 THEN '2-3' WHEN n_chunks <= 7 THEN '4-7' ELSE '8+' END AS bucket, greatest(1, CAST(round_even(f / 4, 0) AS INTEGER)) AS full, CASE WHEN s > 0 THEN greatest(1, CAST(round_even(s / 4, 0) AS INTEGER)) ELSE greatest(1, CAST(round_even(f / 4, 0) AS INTEGER)) END AS snip FROM r)"""


@query(f"""WITH {_COST} SELECT bucket, count(*) AS hits, CAST(sum("full") AS BIGINT) AS "full", CAST(sum(snip) AS BIGINT) AS snippet, CAST(NULL AS DOUBLE) AS query_mean_full, CAST(NULL AS DOUBLE) AS query_mean_snippet, round(100 * (1 - sum(snip) / sum("full")), 6) AS saved_pct FROM k GROUP BY 1
    UNION ALL SELECT 'all', count(*), CAST(sum("full") AS BIGINT), CAST(sum(snip) AS BIGINT), (SELECT round(avg(x), 6) FROM (SELECT sum("full") AS x FROM k GROUP BY query_id)), (SELECT round(avg(x), 6) FROM (SELECT sum(snip) AS x FROM k GROUP BY query_id)), round(100 * (1 - sum(snip) / sum("full")), 6) FROM k""".replace("AS full,", 'AS "full",'))
def ir_context_cost(spark, sf_dir):
    d = t(spark, sf_dir, "documents").where("text is not null")
    n = F.length("text")
    ranked = d.select((F.col("doc_id") % 37).alias("query_id"), F.col("doc_id").alias("id"), (F.col("doc_id") % 11).alias("n_chunks"), n.alias("full_chars"), F.when(F.col("doc_id") % 5 != 0, F.floor(n / 3)).otherwise(0).alias("snippet_chars"))
    return rounded(ir.context_cost(ranked), "query_mean_full", "query_mean_snippet", "saved_pct")


@query(f"{_METRICS}, {_LONG}, s AS (SELECT arm, metric, avg(value) AS value FROM long GROUP BY 1, 2) SELECT arm, metric, round(value, 6) AS value FROM s WHERE value IS NULL OR value < 0.15")
def ir_quality_gate(spark, sf_dir):
    return rounded(ir.quality_gate(ir.aggregate(metrics(spark, sf_dir), NAMES), NAMES), "value")


@query("""WITH m AS (SELECT o_orderdate AS measured, round(avg((o_orderstatus = 'F')::INT), 6) AS value FROM orders GROUP BY 1), l AS (SELECT *, lag(value) OVER (ORDER BY measured) AS previous FROM m)
    SELECT measured, value, previous, concat_ws(',', CASE WHEN value < 0.35 THEN 'below_floor' END, CASE WHEN previous - value > 0.02 THEN 'dropped' END) AS reasons FROM l""")
def ir_drift_check(spark, sf_dir):
    m = t(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").alias("measured")).agg(F.round(F.avg((F.col("o_orderstatus") == "F").cast("double")), 6).alias("value"))
    return ir.drift_check(m)
