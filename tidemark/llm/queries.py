"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import sys
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encode_decode
from .codes import books_digest, compress, with_label_errors
from .common import table
from .decontaminate import decontaminate
from .knn import inner_product_topk
from .langid import identify_languages
from .mixing import mix
from .neardup import near_duplicates
from .pages import page_texts
from .pii import document_pii
from .secrets import document_secrets
from .runs import periodic_runs
from .shards import document_shards
from .tokens import token_counts


def vocabulary_path(name: str, folder: str = "/opt/tokenizers") -> str:
    """Where the public vocabulary file lies; its folder is a parameter."""
    try:
        import public_tokenizers
    except ModuleNotFoundError:
        if folder not in sys.path:
            return f"{folder}/{name}"
        raise
    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_shards(table(spark, sf_dir, "documents"), 24)


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inner_product_topk(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_pii(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", *(F.col(f"_{c}").alias(c) for c in ("block", "release", "deadline", "slot", "kept")))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_secrets(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_texts(table(spark, sf_dir, "pages"))


def tail_repeated(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words, their tail made periodic where crc32(doc_id) is divisible by 10; a null doc_id changes nothing."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = (g := h // 10) % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = periodic_runs(table(spark, sf_dir, "documents"), rewrite=tail_repeated)
    longest = F.reduce(  # runs come by start, then period: of equal exponents the first stays
        F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))), F.get("runs", F.lit(0)), lambda a, r: F.when(r["length"] * a["period"] > a["length"] * r["period"], r).otherwise(a)
    )
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    best = F.col("_best")
    return runs.withColumn("_best", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(best[c].alias(c) for c in ("start", "length", "period")),
        F.expr("_best.length * 1000 div _best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_decode(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = compress(table(spark, sf_dir, "embeddings"), n_parts=8, k=16, rounds=6, scale=4096)
    digits = F.array_join(F.transform("code", lambda e: F.lower(F.lpad(F.hex(e), 2, "0"))), "")
    return with_label_errors(made.rows.withColumn("code", digits)).select("vec_id", "code", "error", "label_error", F.lit(books_digest(made.codebooks)).alias("codebooks_sha256"))


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_sharding, op3_near_duplicates, op4_topk, op5_pii, op6_mixing, op7_language, op8_secrets, op9_decontamination, op10_page_text, op11_periodic_runs, op12_bpe, op13_vector_codes)}

def _codes_sql(rounds: int = 6, k: int = 16, parts: int = 8, scale: int = 4096) -> str:
    """Plain k-means, a step for each round; lists of doubles, in which all numbers are whole and exact."""
    near = """n{i} AS MATERIALIZED (SELECT vec_id, p, arg_min(e, 256 * d + e) AS e, min(d) AS d FROM (
            SELECT vec_id, p, e, list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c) AS d FROM pt JOIN b{i} USING (p)) GROUP BY 1, 2)"""
    move = """m{i} AS MATERIALIZED (SELECT p, e, list(m ORDER BY j) AS m FROM (SELECT p, e, j, floor(sum(x[j]) / count(*)) AS m FROM n{i} JOIN pt USING (vec_id, p), range(1, (SELECT any_value(len(x)) FROM pt) + 1) AS r(j) GROUP BY ALL) GROUP BY 1, 2),
        b{j} AS MATERIALIZED (SELECT p, e, coalesce(m, c) AS c FROM b{i} LEFT JOIN m{i} USING (p, e))"""
    steps = [near.format(i=0)]
    for i in range(rounds):
        steps += [move.format(i=i, j=i + 1), near.format(i=i + 1)]
    return f"""
        WITH v AS MATERIALIZED (
            SELECT vec_id, label, [floor({scale} * CAST(x AS DOUBLE)) FOR x IN embedding] AS v, row_number() OVER (ORDER BY vec_id) - 1 AS place
            FROM embeddings WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), pt AS MATERIALIZED (SELECT vec_id, place, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS x FROM v, range({parts}) AS r(p)),
        b0 AS MATERIALIZED (SELECT p, place AS e, x AS c FROM pt WHERE place < {k}), {", ".join(steps)},
        o AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM n{rounds} GROUP BY 1),
        h AS (SELECT sha256(string_agg(CAST(c[j] AS BIGINT)::VARCHAR, ',' ORDER BY p, e, j)) AS codebooks_sha256 FROM b{rounds}, range(1, (SELECT any_value(len(x)) FROM pt) + 1) AS r(j))
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM o JOIN v USING (vec_id), h"""


#: DuckDB SQL over the same tables, where SQL can express the rows.
ORACLE_SQL = {
    "op4_topk": """
        WITH v AS (
            SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
            FROM embeddings
            WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 50 = 0
        ), r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op13_vector_codes": _codes_sql(),
}
