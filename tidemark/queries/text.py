"""Queries of text records and retrieval. Documents are records; those whose id is divisible by 100 are the queries, each
with its first sentence as text. A record's vector is the embedding of its own number (modulo their number), a chunk's that of
its record's number and its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import search, text
from ..operators.store import written
from .base import query, t

_WS = r"[\x09-\x0D\x1C-\x20\x{85}\p{Z}]"
_ABBR = ", ".join(f"'{a}'" for a in text.ABBREVIATIONS)
_STOP = ", ".join(f"'{a}'" for a in search.STOP_WORDS)
_STRIP = lambda c: f"regexp_replace({c}, '^{_WS}+|{_WS}+$', '', 'g')"
_END = r"""[.!?]+[)\]"''’”]*""" + f"{_WS}+"
#: sents(doc_id, s): a document's sentences, told piece by piece from the pieces between the places where one may end.
_SENTS = f"""pieces AS (SELECT doc_id, string_split(regexp_replace({_STRIP("coalesce(text, '')")}, '({_END})', '\\1' || chr(1), 'g'), chr(1)) AS p FROM documents),
    flat AS (SELECT doc_id, i, p[i] AS x, coalesce(p[i + 1], '') AS after, len(p) AS n FROM pieces, unnest(range(1, len(p) + 1)) AS u(i)),
    told AS (SELECT *, regexp_replace(string_split_regex(regexp_replace(x, '{_END}$', ''), '{_WS}|[(\\[]')[-1], '\\.+$', '') AS token FROM flat),
    cut AS (SELECT doc_id, string_agg(x || CASE WHEN lower(token) IN ({_ABBR}) OR regexp_full_match(token, '[A-Z]|\\p{{Nd}}+') OR (after <> '' AND NOT regexp_matches(after, '^[(\\["''‘“A-Z0-9]')) THEN '' ELSE chr(2) END, '' ORDER BY i) AS j FROM told GROUP BY 1),
    sents AS (SELECT doc_id, [y FOR y IN [{_STRIP('z')} FOR z IN string_split(j, chr(2))] IF y <> ''] AS s FROM cut)"""
_CHUNKS = """spans AS (SELECT doc_id, s, CAST(b AS INTEGER) AS b FROM sents, unnest(CASE WHEN len(s) = 0 THEN [] WHEN len(s) <= 3 THEN [0] ELSE list_distinct(list_concat(range(0, len(s) - 2, 2), [len(s) - 3])) END) AS u(b)),
    chunks AS (SELECT doc_id AS id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY b) - 1 AS INTEGER) AS chunk_idx, b AS sent_start, CAST(least(b + 3, len(s)) AS INTEGER) AS sent_end, array_to_string(s[b + 1 : b + 3], ' ') AS text FROM spans)"""
_WORDS = lambda c: f"[CASE WHEN regexp_matches(w, '[^ea]ies$') THEN regexp_replace(w, 'ies$', 'y') WHEN regexp_matches(w, '[^aeo]es$') THEN regexp_replace(w, 'es$', 'e') WHEN regexp_matches(w, '[^us]s$') THEN regexp_replace(w, 's$', '') ELSE w END FOR w IN string_split_regex(lower(coalesce({c}, '')), '[^\\p{{L}}\\p{{N}}]+') IF w <> '' AND w NOT IN ({_STOP})]"


def _index(name: str, source: str, keys: str) -> str:
    return f"""{name}_w AS (SELECT {keys}, {_WORDS('text')} AS ws FROM {source}), {name}_e AS (SELECT {keys}, len(ws) AS n, unnest(ws) AS term FROM {name}_w),
    {name} AS (SELECT {keys}, term, count(*) * 2.2 / (count(*) + 1.2 * (0.25 + 0.75 * n / 256.0)) AS weight FROM {name}_e GROUP BY {keys}, term, n)"""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")


def crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the customers of their number; several for some."""
    c = t(spark, sf_dir, "customer")
    return c.select(F.floor(F.col("c_custkey") / 2).cast("long").alias("id"), F.col("c_custkey").alias("entrez_id"))


_XWALK = "x AS (SELECT c_custkey // 2 AS id, list_sort(list(DISTINCT CAST(c_custkey AS VARCHAR))) AS e FROM customer GROUP BY 1)"


def shaped(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return text.shape(documents(spark, sf_dir), 3, 2, crosswalk(spark, sf_dir))


@query(r"""SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(text, '\s*\{[^}]*\}', '', 'g'), 'FUNCTION:\s*', '', 'g'), '[ \t\n\x0B\f\r]+', ' ', 'g')) AS cleaned FROM documents""")
def text_clean_function(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", text.clean_function(F.col("text")).alias("cleaned"))


@query(f"WITH {_SENTS} SELECT doc_id, array_to_string(s, chr(3)) AS sentences, CAST(len(s) AS INTEGER) AS n FROM sents")
def text_split_sentences(spark, sf_dir):
    d = t(spark, sf_dir, "documents").select("doc_id", text.split_sentences(F.col("text")).alias("s"))
    return d.select("doc_id", F.array_join("s", "\x03").alias("sentences"), F.size("s").alias("n"))


@query("""WITH s AS (SELECT doc_id, string_split(text, '. ') AS s FROM documents WHERE text IS NOT NULL), n AS (SELECT *, greatest(len(s) - 2, 0) AS tail FROM s)
    SELECT doc_id, CAST(b AS INTEGER) AS sent_start, CAST(least(b + 2, len(s)) AS INTEGER) AS sent_end, array_to_string(s[b + 1 : b + 2], ' ') AS chunk FROM n, unnest(range(0, tail + 1)) AS u(b)""")
def text_windows(spark, sf_dir):
    d = t(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.split("text", r"\. ").alias("s"))
    return d.select("doc_id", F.explode(text.windows(F.col("s"), 2, 1)).alias("w")).select("doc_id", "w.sent_start", "w.sent_end", F.col("w.text").alias("chunk"))


@query(f"WITH {_SENTS}, {_CHUNKS} SELECT * FROM chunks")
def text_shape(spark, sf_dir):
    return shaped(spark, sf_dir)[1]


@query(f"WITH {_SENTS}, {_CHUNKS}, {_XWALK} SELECT d.doc_id AS id, text, CAST(len(s) AS INTEGER) AS n_sentences, CAST((SELECT count(*) FROM chunks WHERE chunks.id = d.doc_id) AS INTEGER) AS n_chunks, array_to_string(e, ',') AS entrez_id FROM documents d JOIN sents USING (doc_id) LEFT JOIN x ON x.id = d.doc_id")
def text_shape_records(spark, sf_dir):
    return shaped(spark, sf_dir)[0].select("id", "text", F.size("sentences").alias("n_sentences"), "n_chunks", F.array_join("entrez_id", ",").alias("entrez_id"))


# Three corpora by language, the first wins; ids are shared by halves, so that texts differ.
_CORPORA = "c AS (SELECT doc_id // 2 AS id, text, CASE lang WHEN 'en' THEN 0 WHEN 'de' THEN 1 ELSE 2 END AS p FROM documents WHERE trim(coalesce(text, '')) <> '')"


def corpora(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    d = t(spark, sf_dir, "documents").select(F.floor(F.col("doc_id") / 2).cast("long").alias("id"), "text", F.coalesce("lang", F.lit("")).alias("lang"))
    return text.merge_corpora([d.where("lang = 'en'"), d.where("lang = 'de'"), d.where("lang not in ('en', 'de')")])


@query(f"WITH {_CORPORA} SELECT id, text FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY p, text) AS n FROM c) WHERE n = 1")
def text_merge_corpora(spark, sf_dir):
    return corpora(spark, sf_dir)[0]


@query(f"WITH {_CORPORA} SELECT id, count(DISTINCT text) AS n_texts FROM c GROUP BY 1 HAVING count(DISTINCT text) > 1")
def text_merge_corpora_conflicts(spark, sf_dir):
    return corpora(spark, sf_dir)[1]


@query(None)
def text_point_id(spark, sf_dir):
    chunks = shaped(spark, sf_dir)[1]
    return chunks.select("id", "chunk_idx", text.point_id(F.concat_ws("#", F.col("id").cast("string"), F.col("chunk_idx").cast("string"))).alias("point_id"))


def letter_counts(texts: list[str]) -> list[list[float]]:
    """A plain encoder: how often each of 26 letters occurs."""
    return [[float(x.lower().count(chr(97 + i))) + (1e-9 if i == 0 else 0) for i in range(26)] for x in texts]


_LETTERS = ", ".join(f"len(lower(text)) - len(replace(lower(text), '{chr(97 + i)}', ''))" + (" + 1e-9" if i == 0 else "") for i in range(26))


@query(f"WITH v AS (SELECT doc_id, [CAST(x AS DOUBLE) FOR x IN [{_LETTERS}]] AS v FROM documents WHERE text IS NOT NULL) SELECT doc_id, round(v[1] / sqrt(list_inner_product(v, v)), 6) AS first, round(v[5] / sqrt(list_inner_product(v, v)), 6) AS fifth FROM v")
def text_embed(spark, sf_dir):
    d = text.embed(t(spark, sf_dir, "documents").where("text is not null").select("doc_id", "text"), letter_counts)
    return d.select("doc_id", F.round(F.col("dense")[0], 6).alias("first"), F.round(F.col("dense")[4], 6).alias("fifth"))


@query(f"""WITH {_SENTS}, {_CHUNKS}, {_XWALK} SELECT (SELECT count(*) FROM documents) AS records, (SELECT count(*) FROM chunks) AS chunks, round((SELECT count(*) FROM chunks) / (SELECT count(*) FROM documents), 6) AS chunks_per_record,
    (SELECT count(*) FROM documents JOIN x ON x.id = doc_id) AS with_entrez, (SELECT count(*) FROM documents JOIN x ON x.id = doc_id WHERE len(e) > 1) AS multi_entrez, CAST(3 AS INTEGER) AS "window", CAST(2 AS INTEGER) AS stride""")
def text_index_manifest(spark, sf_dir):
    return text.index_manifest(*shaped(spark, sf_dir), 3, 2)


@query(f"WITH {_index('i', '(SELECT doc_id AS id, text FROM documents)', 'id')} SELECT id, term, round(weight, 6) AS weight FROM i")
def search_bm25_index(spark, sf_dir):
    return search.bm25_index(documents(spark, sf_dir)).withColumn("weight", F.round("weight", 6))


# Queries, and vectors by number.
_Q = "q AS (SELECT doc_id AS query_id, s[1] AS text FROM sents WHERE doc_id % 100 = 0 AND len(s) > 0)"
_V = "v AS (SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS e, count(*) OVER () AS n FROM embeddings)"
_RV = "rv AS (SELECT doc_id AS id, e FROM documents JOIN v ON vec_id = doc_id % n)"


def vectors(spark: SparkSession, sf_dir: str, rows: DataFrame, number: str) -> DataFrame:
    """rows with dense: the embedding of the number, modulo the number of embeddings."""
    e = t(spark, sf_dir, "embeddings")
    numbered = rows.join(e.agg(F.count("*").alias("_n"))).withColumn("vec_id", F.expr(number) % F.col("_n"))
    return numbered.join(e.select("vec_id", F.col("embedding").alias("dense")), "vec_id").drop("vec_id", "_n")


def asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, id, text, dense of the queries."""
    d = documents(spark, sf_dir).where("id % 100 = 0").select("id", F.get(text.split_sentences(F.col("text")), F.lit(0)).alias("text")).where("text is not null")
    return vectors(spark, sf_dir, d, "id").withColumn("query_id", F.col("id")).select("query_id", "text", "dense")


def query_terms(q: DataFrame) -> DataFrame:
    return search.terms(q, keys=("query_id",)).select("query_id", "term").distinct()


_SCORED = """score_t AS (SELECT DISTINCT query_id, unnest(ws) AS term FROM (SELECT query_id, {words} AS ws FROM q)), df AS (SELECT term, ln(((SELECT count(*) FROM documents) - count(*) + 0.5) / (count(*) + 0.5) + 1) AS idf FROM i GROUP BY 1)"""
_SPARSE = _SCORED.format(words=_WORDS("text")) + ", sp AS (SELECT query_id, id, round(sum(weight * idf), 6) AS score FROM score_t JOIN i USING (term) JOIN df USING (term) GROUP BY 1, 2), spr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM sp)"
_DENSE = f"{_V}, {_RV}, de AS (SELECT query_id, r.id, round(list_cosine_similarity(a.e, r.e), 6) AS score FROM q JOIN rv a ON a.id = query_id JOIN rv r ON true), der AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM de)"
_HYBRID = f"WITH {_SENTS}, {_CHUNKS}, {_Q}, {_index('i', '(SELECT doc_id AS id, text FROM documents)', 'id')}, {_SPARSE}, {_DENSE}, fu AS (SELECT query_id, id, round(sum(1 / (60 + rank)), 9) AS score FROM (SELECT query_id, id, rank FROM spr WHERE rank <= 200 UNION ALL SELECT query_id, id, rank FROM der WHERE rank <= 200) GROUP BY 1, 2), hy AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank FROM fu)"


@query(f"{_HYBRID} SELECT query_id, id, score, CAST(rank AS INTEGER) AS rank FROM spr WHERE rank <= 20")
def search_sparse(spark, sf_dir):
    d, q = documents(spark, sf_dir), asked(spark, sf_dir)
    return search.sparse(query_terms(q), search.bm25_index(d), d.count(), 20)


@query(f"{_HYBRID} SELECT query_id, id, score, CAST(rank AS INTEGER) AS rank FROM spr WHERE rank <= 10")
def search_sparse_bounded(spark, sf_dir):
    d, q = documents(spark, sf_dir), asked(spark, sf_dir)
    index = written(search.bm25_index(d), "index")
    blocks = written(search.block_index(index, 256), "blocks")
    return search.sparse_bounded(query_terms(q), index, blocks, d.count(), 10).ranking


_COSINES = """WITH v AS (SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS e FROM embeddings), s AS (SELECT a.vec_id AS query_id, b.vec_id AS id, round(list_cosine_similarity(a.e, b.e), 6) AS score FROM v a JOIN v b ON true WHERE a.vec_id % 100 = 0)
    SELECT query_id, id, score, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s) WHERE rank <= 20"""


@query(_COSINES)
def search_dense(spark, sf_dir):
    e = t(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("dense"))
    return search.dense(e.where("id % 100 = 0").withColumnRenamed("id", "query_id"), e, 20)


@query(_COSINES)
def search_dense_rings(spark, sf_dir):
    """In parts of 256 rows, so that the small table has rings, too."""
    e = t(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("dense"))
    return search.nearest(e.where("id % 100 = 0").withColumnRenamed("id", "query_id"), e, 20, vector_rows=256).ranking


@query("""WITH a AS (SELECT o_custkey AS query_id, o_orderkey AS id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders QUALIFY rank <= 10),
    b AS (SELECT o_custkey AS query_id, o_orderkey AS id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rank FROM orders QUALIFY rank <= 10),
    s AS (SELECT query_id, id, sum(1 / (60 + rank)) AS score FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY 1, 2)
    SELECT query_id, id, round(score, 9) AS score FROM s""")
def search_rrf(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("query_id"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("score"), "o_orderdate")
    recent = search.top(o.withColumn("score", F.col("o_orderdate")), 10)
    return search.rrf([search.top(o, 10), recent], 20).select("query_id", "id", "score")


def hybrid(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    d, q = documents(spark, sf_dir), asked(spark, sf_dir)
    sparse = search.sparse(query_terms(q), search.bm25_index(d), d.count(), search.PREFETCH)
    dense = search.dense(q, vectors(spark, sf_dir, d.select("id"), "id"), search.PREFETCH)
    return search.record_hybrid(dense, sparse, k)


@query(f"{_HYBRID} SELECT query_id, id, score, rank FROM hy WHERE rank <= 20")
def search_record_hybrid(spark, sf_dir):
    return hybrid(spark, sf_dir, 20)


_CI = _index("ci", "chunks", "id, chunk_idx")
_CHUNK_HITS = f"""{_HYBRID}, short AS (SELECT query_id, id, score, rank FROM hy WHERE rank <= 20), {_CI}, cdf AS (SELECT term, ln(((SELECT count(*) FROM chunks) - count(*) + 0.5) / (count(*) + 0.5) + 1) AS idf FROM ci GROUP BY 1),
    cs AS (SELECT query_id, id, chunk_idx, round(sum(weight * idf), 6) AS score FROM score_t JOIN ci USING (term) JOIN cdf USING (term) SEMI JOIN short USING (query_id, id) GROUP BY 1, 2, 3),
    cd AS (SELECT query_id, c.id, chunk_idx, round(list_cosine_similarity(a.e, w.e), 6) AS score FROM short s JOIN chunks c ON c.id = s.id JOIN rv a ON a.id = query_id JOIN v w ON w.vec_id = (c.id + chunk_idx) % w.n),
    both_c AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id, chunk_idx) AS rank FROM cs QUALIFY rank <= 200 UNION ALL SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id, chunk_idx) AS rank FROM cd QUALIFY rank <= 200),
    fc AS (SELECT query_id, id, chunk_idx, round(sum(1 / (60 + rank)), 9) AS score FROM both_c GROUP BY 1, 2, 3), hits AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id, chunk_idx) AS rank FROM fc) WHERE rank <= 400),
    best AS (SELECT * FROM (SELECT query_id, id, chunk_idx, score, CAST(row_number() OVER (PARTITION BY query_id, id ORDER BY score DESC, chunk_idx) AS INTEGER) AS place FROM hits) WHERE place <= 10)"""


def searched(spark: SparkSession, sf_dir: str, n: int = 10) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(shortlist, chunks, best chunks)"""
    q = written(asked(spark, sf_dir), "asked")
    short = written(hybrid(spark, sf_dir, 20), "shortlist")
    chunks = written(shaped(spark, sf_dir)[1], "chunks")
    dense = vectors(spark, sf_dir, chunks.select("id", "chunk_idx"), "id + chunk_idx")
    index = search.bm25_index(chunks, keys=("id", "chunk_idx"))
    hits = search.chunk_hybrid(q, query_terms(q), dense, index, short, chunks.count(), search.PREFETCH)
    return short, chunks, written(search.best_chunks(hits, n), "best")


@query(f"{_CHUNK_HITS} SELECT query_id, id, chunk_idx, score, place FROM best")
def search_best_chunks(spark, sf_dir):
    return searched(spark, sf_dir)[2].select("query_id", "id", "chunk_idx", "score", "place")


@query(f"{_CHUNK_HITS} SELECT s.query_id, s.id, s.rank, coalesce(string_agg(b.chunk_idx || ':' || length(c.text), ',' ORDER BY place), '') AS snippets FROM short s LEFT JOIN (SELECT * FROM best WHERE place <= 3) b ON b.query_id = s.query_id AND b.id = s.id LEFT JOIN chunks c ON c.id = b.id AND c.chunk_idx = b.chunk_idx GROUP BY 1, 2, 3")
def search_attach_snippets(spark, sf_dir):
    short, chunks, best = searched(spark, sf_dir)
    out = search.attach_snippets(short, best, chunks, 3)
    return out.select("query_id", "id", "rank", F.array_join(F.transform("snippets", lambda s: F.concat_ws(":", s["chunk_idx"], s["chars"])), ",").alias("snippets"))


# Blom's quantiles for up to 10 chunks, as the SQL's own fixed list.
_BLOM = "[" + ", ".join(repr(x) for x in [0.0, *(search.NormalDist().inv_cdf((i - 0.375) / (i + 0.25)) for i in range(2, 11))]) + "]"
_AGG = f"""agg AS (SELECT query_id, id, max(score) AS mx, count(*) AS n, stddev_pop(score) AS sd, list_sort(list(score), 'DESC') AS l FROM best GROUP BY 1, 2),
    sc AS (SELECT s.query_id, s.id, s.rank AS record_rank, how, round(CASE how WHEN 'top2' THEN CASE WHEN n > 1 THEN (l[1] + l[2]) / 2 ELSE l[1] END WHEN 'lognorm' THEN CASE WHEN n < 2 THEN mx ELSE mx - {_BLOM}[n] * sd END ELSE mx END, 12) AS chunk_score
        FROM short s LEFT JOIN agg USING (query_id, id), (VALUES ('max'), ('top2'), ('lognorm'), ('rrf')) AS h(how)),
    kd AS (SELECT *, CASE WHEN how <> 'rrf' THEN chunk_score WHEN chunk_score IS NOT NULL THEN round(1 / (60 + record_rank) + 1 / (60 + row_number() OVER (PARTITION BY query_id, how ORDER BY chunk_score DESC NULLS LAST, record_rank)), 12) END AS k FROM sc)
    SELECT how, query_id, id, record_rank, chunk_score, CAST(row_number() OVER (PARTITION BY query_id, how ORDER BY k DESC NULLS LAST, record_rank) AS INTEGER) AS rank FROM kd"""


@query(f"{_CHUNK_HITS}, {_AGG}")
def search_chunk_rerank(spark, sf_dir):
    short, _, best = searched(spark, sf_dir)
    out = [search.chunk_rerank(short, best, 20, how).withColumn("how", F.lit(how)) for how in ("max", "top2", "lognorm", "rrf")]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


_OWN = _CHUNK_HITS.replace("short AS (SELECT query_id, id, score, rank FROM hy WHERE rank <= 20)", "short AS (SELECT query_id, query_id AS id, 1.0 AS score, 1 AS rank FROM q)").replace("QUALIFY rank <= 200", "QUALIFY rank <= 50").replace("WHERE rank <= 400", "WHERE rank <= 100").replace("place <= 10", "place <= 3")


@query(f"{_OWN} SELECT query_id, id, chunk_idx, score, place FROM best")
def search_snippets(spark, sf_dir):
    q = written(asked(spark, sf_dir), "asked")
    chunks = written(shaped(spark, sf_dir)[1], "chunks")
    dense = vectors(spark, sf_dir, chunks.select("id", "chunk_idx"), "id + chunk_idx")
    own = q.select("query_id", F.col("query_id").alias("id"))
    out = search.snippets(own, q, query_terms(q), dense, search.bm25_index(chunks, keys=("id", "chunk_idx")), chunks.count(), 3)
    return out.select("query_id", "id", "chunk_idx", "score", "place")


@query(f"""WITH {_SENTS}, {_CHUNKS}, a AS (SELECT doc_id AS id, CAST(doc_id % 5 AS INTEGER) AS chunk_idx FROM documents), f AS (SELECT a.id, a.chunk_idx, s, sent_start, CASE WHEN sent_start IS NOT NULL THEN greatest(0, sent_start - 1) END AS st, CASE WHEN sent_start IS NOT NULL THEN least(len(s), sent_end + 1) END AS en FROM a LEFT JOIN chunks c ON c.id = a.id AND c.chunk_idx = a.chunk_idx LEFT JOIN sents ON doc_id = a.id)
    SELECT id, chunk_idx, CAST(st AS INTEGER) AS start, CAST(en AS INTEGER) AS "end", CASE WHEN st IS NOT NULL THEN CAST(len(s) AS INTEGER) END AS "of", st = 0 AS at_start, en = len(s) AS at_end, CASE WHEN st IS NOT NULL THEN array_to_string(s[st + 1 : en], ' ') END AS text, CASE WHEN sent_start IS NULL THEN 'no chunk' END AS error, CASE WHEN st IS NOT NULL THEN CAST(length(array_to_string(s[st + 1 : en], ' ')) AS INTEGER) END AS chars FROM f""")
def search_expand(spark, sf_dir):
    records, chunks = shaped(spark, sf_dir)
    ask = documents(spark, sf_dir).select("id", (F.col("id") % 5).cast("int").alias("chunk_idx"))
    return search.expand(ask, records, chunks, 1)


@query(f"WITH {_SENTS}, {_CHUNKS}, {_XWALK}, a AS (SELECT doc_id * 2 AS id FROM documents) SELECT a.id, text, CASE WHEN d.doc_id IS NOT NULL THEN CAST((SELECT count(*) FROM chunks WHERE chunks.id = a.id) AS INTEGER) END AS n_chunks, array_to_string(CASE WHEN d.doc_id IS NOT NULL THEN e END, ',') AS entrez_id, CASE WHEN d.doc_id IS NULL THEN 'no record' END AS error FROM a LEFT JOIN documents d ON d.doc_id = a.id LEFT JOIN x ON x.id = a.id")
def search_read_record(spark, sf_dir):
    ask = documents(spark, sf_dir).select((F.col("id") * 2).alias("id"))
    return search.read_record(ask, shaped(spark, sf_dir)[0]).withColumn("entrez_id", F.array_join("entrez_id", ","))


@query(f"WITH {_SENTS}, {_CHUNKS} SELECT CAST(c_custkey AS VARCHAR) AS entrez_id, doc_id AS id, CAST((SELECT count(*) FROM chunks WHERE chunks.id = doc_id) AS INTEGER) AS n_chunks FROM customer JOIN documents ON doc_id = c_custkey // 2")
def search_by_entrez(spark, sf_dir):
    ask = t(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("entrez_id"))
    return search.by_entrez(ask, shaped(spark, sf_dir)[0]).select("entrez_id", "id", "n_chunks")
