"""Periodic runs, BPE encoding and vector codes against plain versions, and on nulls, empties, ties and repeats."""

import hashlib
import math
import os
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.bpe import Codec, encode_decode
from tidemark.llm.codes import compress, with_label_errors
from tidemark.llm.knn import inner_product_topk
from tidemark.llm.mixing import phases, schedule, whole_weights
from tidemark.llm.queries import ORACLE_SQL, QUERIES, tail_repeated, vocabulary_path
from tidemark.llm.runs import periodic_runs, text_runs

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
PATH = vocabulary_path("byte_bpe_50k.json")


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def plain_runs(w):
    """Every shift, every stretch, every shorter period."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q) and not any(w[i : i + length - p] == w[i + p : i + length] for p in range(1, q)):
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def repetitive(rng):
    k, n, form = rng.choice([1, 2, 2, 3, 30]), rng.randint(0, 160), rng.random()
    if form < 0.3:
        return [b"%d" % rng.randrange(k) for _ in range(n)]
    if form < 0.45:
        return [b"%d" % (i.bit_count() % 2) for i in range(n)] * rng.choice([1, 4])  # no cubes, then four copies
    if form < 0.55:
        a, b = [b"a"], [b"a", b"b"]
        while len(b) < n:
            a, b = b, b + a
        return b
    out = []
    while len(out) < n:
        part = [b"%d" % rng.randrange(k) for _ in range(rng.randint(1, 40))] * rng.choice([1, 1, 4])
        part = part * rng.randint(1, 7)
        if rng.random() < 0.4:
            part[rng.randrange(len(part))] = b"z"
        out += part
    return out[:400]


def test_runs_plain():
    rng = random.Random(11)
    for _ in range(150):
        texts = [repetitive(rng) for _ in range(rng.randint(1, 9))]
        assert text_runs(texts) == [plain_runs(x) for x in texts]
    long = [b"%d" % rng.randrange(3) for _ in range(997)] * 40
    assert (0, len(long), 997) in text_runs([long])[0]


def test_runs_query(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in QUERIES["op11_periodic_runs"](spark, DATA).collect()}
    planted = 0
    for doc_id, text in docs:
        words = tail_repeated(doc_id, (text or "").encode().split())
        if len(words) > 3000:  # the plain version takes quadratic time; such texts are in test_runs_plain
            continue
        runs, r = plain_runs(words), got[doc_id]
        drop = {i for a, n, q in runs for i in range(a + q, a + n)}
        assert r["n_runs"] == len(runs)
        assert r["runs_sha256"] == sha("".join(f"{a},{n},{q}\n" for a, n, q in runs))
        assert r["collapsed_sha256"] == sha(b" ".join(x for i, x in enumerate(words) if i not in drop))
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=None)
        assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        planted += zlib.crc32(str(doc_id).encode()) % 10 == 0
    assert len(got) == len(docs) and planted > 5


def test_runs_odd_rows(spark):
    rows = [(1, "a " * 9, 0), (1, "a " * 9, 0), (None, None, None), (2, "", 1), (3, " \t\x0b\n", 1), (4, "x y " * 7, 2), (5, "ab " * 500_000, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    got = sorted(((r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic_runs(df).collect()))
    one = (1, 9, [(0, 9, 1)], "a")
    assert got == [(0, 0, [], ""), one, one, (2, 0, [], ""), (3, 0, [], ""), (4, 7, [(0, 7, 1)], "x y"), (5, 500_000, [(0, 500_000, 1)], "ab")]
    assert periodic_runs(df.limit(0)).count() == 0
    assert tail_repeated(None, [b"a", b"b"]) == [b"a", b"b"] and tail_repeated(7, []) == []


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_bpe_library(library):
    with open(PATH, encoding="utf-8") as f:
        codec = Codec(f.read(), room=500)  # so small that it fills up
    rng = random.Random(12)
    letters = [" ", "a", "b", "e", "s", "t", "-", "=", "\n", "\x00", "é", "日", "🙂", "\u0085", "'s", "1", "in", " the", "<|endoftext|>", "x" * 50, " " * 40]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(3000)] + ["a" * 5000, " " * 777, "=-" * 999, "ha" * 4000]
    texts += ["".join(chr(rng.choice([rng.randint(1, 0x2FF), rng.randint(0x3000, 0x9FFF), rng.randint(0x1F300, 0x1F9FF)])) for _ in range(30)) for _ in range(300)]
    for text in texts:
        ids = codec.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert codec.decode(ids) == text
    for _ in range(500):  # any ids, so that bytes need be no text
        ids = [rng.randrange(50_257) for _ in range(12)]
        assert codec.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)


def test_bpe_prefixes(library):
    """One pass gives the encodings of all prefixes."""
    with open(PATH, encoding="utf-8") as f:
        codec = Codec(f.read())
    word = "internationalizationismusabababab"
    last = codec.last_tokens(word)
    for j in range(1, len(word) + 1):
        assert codec.ids[last[j]] == library.encode(word[:j], add_special_tokens=False).ids[-1]


def test_bpe_query(spark, library):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    want = set()
    for doc_id, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.add((doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids, skip_special_tokens=False))))
    assert {tuple(r) for r in QUERIES["op12_bpe"](spark, DATA).collect()} == want


def test_bpe_odd_rows(spark, library):
    rows = [(1, "a b", 1), (1, "a b", 1), (None, None, None), (2, "", 0), (3, "<|endoftext|>x", 0), (4, "q" * 1_000_000, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = encode_decode(df, PATH).collect()
    assert len(got) == len(rows) and encode_decode(df.limit(0), PATH).count() == 0
    for r in got:
        text = {x[0]: x[1] or "" for x in rows}[r["doc_id"]]
        assert r["decoded"] == text and np.frombuffer(r["ids"], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert r["n_tokens"] == len(r["ids"]) // 4


def plain_codes(rows, parts=8, k=16, rounds=6, scale=4096):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    m = max(1, -(-max(len(v) for _, v in kept) // parts))
    kept = sorted(((i, v + [0] * (parts * m - len(v))) for i, v in kept), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = [[v[p * m : p * m + m] for _, v in kept] for p in range(parts)]
    books = [[list(x) for x in c[:k]] for c in cut]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), j) for j, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for x in cut[p]:
                groups.setdefault(near(x, books[p])[1], []).append(x)
            books[p] = [[sum(a) // len(groups[j]) for a in zip(*groups[j], strict=True)] if j in groups else e for j, e in enumerate(books[p])]
    found = [[near(cut[p][n], books[p]) for p in range(parts)] for n in range(len(kept))]
    return sorted(((i is None, i or 0), [j for _, j in f], min(sum(d for d, _ in f), 2**63 - 1)) for (i, _), f in zip(kept, found, strict=True)), books


def codes_of(made):
    return sorted(((r["vec_id"] is None, r["vec_id"] or 0), r["code"], r["error"]) for r in made.rows.collect()), made.codebooks


def cases():
    rng = random.Random(13)
    return {
        "ties": [(i, [rng.choice([0.0, 0.001, -0.001]) for _ in range(16)]) for i in range(300)],
        "all equal": [(i, [0.5] * 8) for i in range(40)],
        "few": [(i, [float(i)] * 8) for i in range(5)],
        "one": [(1, [1.0, 2.0])],
        "odd": [(rng.choice([None, *range(50)]), rng.choice([None, [None] * 8, [float("nan")] * 8, [float("inf")], [rng.random() for _ in range(rng.randint(0, 19))]])) for _ in range(200)],
        "large": [(i, [rng.choice([1e5, -3e5, 100.0]) * rng.random() for _ in range(10)]) for i in range(200)],
        "huge": [(i, [rng.choice([1e30, -3e20, 1e5, 0.3, 7.0, 1e38, 5e13]) * rng.random() for _ in range(10)]) for i in range(80)],
        "groups": [(i, [(i * 7 + d) % 5 + rng.random() / 10 for d in range(16)]) for i in range(400)],
    }


@pytest.mark.parametrize("name", sorted(cases()))
def test_codes_plain(spark, name):
    rows = cases()[name]
    made = compress(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert codes_of(made) == plain_codes(rows)
    if name == "groups":  # the bounds spare most comparisons once the entries settle
        assert sum(x["kept"] for x in made.report[-1]) > sum(x["all"] for x in made.report[-1])


def test_codes_extra_columns(spark):
    df = spark.createDataFrame([(i, [float(i % 3)] * 8, "x" if i % 3 else None, 1, "s") for i in range(30)], "vec_id long, embedding array<float>, label string, code int, sums string")
    made = compress(df)
    rows = with_label_errors(made.rows, hot_rows=15).collect()
    assert len(rows) == 30
    total = {}
    for r in rows:
        total[r["label"]] = total.get(r["label"], 0) + r["error"]
    assert {(r["label"], r["label_error"]) for r in rows} == set(total.items())
    none = compress(df.limit(0))
    assert none.rows.count() == 0 and none.codebooks == [] and with_label_errors(none.rows).count() == 0


def test_codes_query(spark):
    rows = [(r["vec_id"], list(r["embedding"]), r["label"]) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    want, books = plain_codes([r[:2] for r in rows])
    got = QUERIES["op13_vector_codes"](spark, DATA).collect()
    assert sorted((r["vec_id"], r["code"], r["error"]) for r in got) == [(i[1], "".join(f"{j:02x}" for j in code), e) for i, code, e in want]
    assert {r["codebooks_sha256"] for r in got} == {sha(",".join(str(a) for part in books for e in part for a in e))}
    label, error = {r[0]: r[2] for r in rows}, {}
    for r in got:
        error[label[r["vec_id"]]] = error.get(label[r["vec_id"]], 0) + r["error"]
    assert all(r["label_error"] == error[label[r["vec_id"]]] for r in got)


def plain_schedule(shares, blocks):
    """Slot by slot, earliest deadline first among released blocks, ties by source."""
    lines = phases(shares, blocks)
    release = lambda j, s: min(e + a * j // shares[s] for _, e, a in lines)
    deadline = lambda j, s: min(e - (-a * (j + 1) // shares[s]) for _, e, a in lines)
    out = {s: [] for s in shares}
    for t in range(sum(blocks.values())):
        due, s = min((deadline(len(out[s]), s), s) for s in shares if len(out[s]) < blocks[s] and release(len(out[s]), s) <= t)
        assert t < due
        out[s].append(t)
    return out


def slots_of(plan, blocks):
    out = {}
    for s, parts in plan.items():
        ends = [first for first, _, _ in parts[1:]] + [blocks[s]]
        out[s] = [slots[(b - first) % len(slots)] + (b - first) // len(slots) * shift for (first, shift, slots), end in zip(parts, ends, strict=True) for b in range(first, end)]
    return out


def test_schedule_plain():
    """Sources of unlike sizes, which leave one by one."""
    rng = random.Random(6)
    draws = [(200, [17405, 9546, 176, 279, 484, 10397, 66, 73, 12063, 37005, 18120, 16194, 1301, 97, 377])]
    draws += [(resolution, [rng.choice([rng.randint(1, 50), rng.randint(1, 3000)]) for _ in range(k)]) for k, resolution in ((2, 50), (3, 1000), (10, 50), (40, 200), (40, 1000), (120, 500))]
    for resolution, rows in draws:
        shares = whole_weights({f"s{i:04d}": n**0.75 for i, n in enumerate(rows)}, resolution)
        blocks = {s: -(-n // 8) for s, n in zip(shares, rows, strict=True)}
        assert slots_of(schedule(shares, blocks), blocks) == plain_schedule(shares, blocks)
    for _ in range(2):  # the default resolution: each slot once, none past its deadline
        shares = whole_weights({f"s{i:04d}": rng.randint(1, 100_000) ** 0.75 for i in range(300)}, 10_000)
        blocks = {s: rng.randint(1, 3000) for s in shares}
        assert sorted(x for slots in slots_of(schedule(shares, blocks), blocks).values() for x in slots) == list(range(sum(blocks.values())))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{DATA}/embeddings.parquet'")
    got = QUERIES[name](spark, DATA)
    want = con.execute(f"SELECT {', '.join(sorted(got.columns))} FROM ({ORACLE_SQL[name]})").fetchall()
    assert sorted(map(tuple, got.select(sorted(got.columns)).collect())) == sorted(want)


def test_topk_with_a_hot_id(spark):
    """A third of the rows have one id, which is a query, and some of them one vector."""
    rng = random.Random(4)
    rows = [(0, [rng.choice([0.5, -0.25, 1.0]) for _ in range(4)]) for _ in range(150)] + [(i, [rng.random() - 0.5 for _ in range(4)]) for i in range(1, 301)]
    ints = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    asking = {}
    for i, v in ints:
        if i % 50 == 0:
            asking[i] = min(v, asking.get(i, v))
    want = set()
    for q, own in asking.items():
        best = sorted((-sum(a * b for a, b in zip(own, v, strict=True)), i) for i, v in ints if i != q)[:5]
        want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {tuple(r) for r in inner_product_topk(df, F.col("vec_id") % 50 == 0, 5, chunk_rows=16, query_rows=4).collect()} == want


def test_language_of_a_long_text(spark, monkeypatch):
    """Pieces of a text add up to the whole."""
    import tidemark.llm.langid as module

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = module.train(docs.select("doc_id", "lang", "text"))
    texts = [r["text"] for r in docs.where("text is not null").limit(40).collect()]
    texts += ["", " ".join(texts), "ab"]
    whole = model.entropies(texts)
    monkeypatch.setattr(module, "PIECE", 1000)
    parts = model.entropies(texts)
    assert np.allclose(whole[0], parts[0], atol=1e-5) and (whole[1] == parts[1]).all()


def test_one_automaton_for_whole_rules():
    import re

    from tidemark.llm.secrets import Scanner

    rng, scan = random.Random(5), Scanner()
    assert scan.automaton.states < 4096 and scan.automaton.states <= scan.automaton.reached
    patterns = {
        "github": (r"gh[pousr]_[A-Za-z0-9]+", 40),
        "slack": (r"xox[abprs]-[A-Za-z0-9-]+", 15),
        "google": (r"AIza[A-Za-z0-9_-]+", 39),
        "pem": (r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0),
        "access": (r"AKIA[A-Z0-9]+", 18),
        "hex": (r"[0-9a-f]+", 16),
    }
    parts = ["ghp_", "gho_", "xoxb-", "xoxp-", "AIza", "AKIA", "token=", "-----BEGIN ", "RSA ", "PRIVATE KEY-----", "abcdef0123456789", "Z" * 15, "x" * 36, "_", "-", " ", "\n"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        want = sorted((m.start(), k, m.end()) for k, (p, least) in patterns.items() for m in re.finditer(p, text) if len(m.group()) >= least)
        assert sorted((a, k, b) for a, _, k, b in scan(text.encode()) if k != "assign") == want


@pytest.mark.parametrize("tasks", [1, 7])
def test_equal_rows_are_told_apart(spark, tasks):
    from tidemark.llm.common import told_apart

    rows = spark.range(3000).select(F.when(F.col("id") < 1000, 0).when(F.col("id") < 1003, 1).otherwise(F.col("id")).alias("k")).repartition(tasks)
    out = told_apart(rows.withColumn("_key", F.struct("k")), "_key", rows_per_chunk=64).groupBy("k").agg(F.sort_array(F.collect_list("_copy")).alias("c")).collect()
    assert {r["k"]: r["c"] for r in out} == {0: list(range(1000)), 1: [0, 1, 2]} | {k: [0] for k in range(1003, 3000)}


def test_shards_and_mixing_of_a_third_of_equal_rows(spark):
    from tidemark.llm.mixing import mix
    from tidemark.llm.shards import shuffled_shards

    rows = spark.range(900).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 10).alias("doc_id"), F.lit("a b").alias("text"), F.lit("s").alias("source"))
    found = []
    for tasks in (1, 5):
        df = rows.repartition(tasks)
        shards = sorted(tuple(r) for r in shuffled_shards(df, [F.col("doc_id"), F.col("text")], 7).select("shard", "slot", "doc_id").collect())
        assert [x[:2] for x in shards] == [(s, i) for s in range(7) for i in range(900 // 7 + (s < 900 % 7))]
        slots = sorted(tuple(r) for r in mix(df).select("_slot", "_block", "doc_id").collect())
        assert [x[0] for x in slots] == [i // 8 for i in range(900)]
        found.append((shards, slots))
    assert found[0] == found[1]  # whatever task holds them
    # Equal rows lie among the others, not in one stretch.
    places = [i for i, x in enumerate(found[0][1]) if x[2] == 7]
    assert len(places) == 300 and len({x // 90 for x in places}) == 10


def test_mixing_of_many_sources(spark):
    """More sources than the default resolution, and windows of every block against the fluid schedule."""
    from tidemark.llm.mixing import mix

    sizes = {f"s{i}": 1 + i * 37 % 23 for i in range(400)}
    rows = spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate(sizes.items())], "doc_id long, source string, n int")
    rows = rows.select("doc_id", "source", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("text")).withColumn("text", F.col("text").cast("string"))
    got = mix(rows, block_rows=2, resolution=40).collect()  # fewer than there are sources
    shares = whole_weights({s: n**0.75 for s, n in sizes.items()}, 1600)
    blocks = {s: -(-n // 2) for s, n in sizes.items()}
    lines = phases(shares, blocks)
    assert len(lines) > 10
    windows = {(r["_source"], r["_block"]): (r["_release"], r["_slot"], r["_deadline"]) for r in got}
    assert len(got) == sum(sizes.values()) and sorted(t for _, t, _ in windows.values()) == list(range(sum(blocks.values())))
    for (s, b), (release, slot, deadline) in windows.items():
        assert release == min(e + a * b // shares[s] for _, e, a in lines)
        assert deadline == min(e - (-a * (b + 1) // shares[s]) for _, e, a in lines)
        assert release <= slot < deadline
