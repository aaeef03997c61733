"""Language identification by interpolated Kneser-Ney character models.

A text becomes its lower-cased letters, with each run of anything else as one space. Per language, character n-grams are
counted; the highest order uses counts, lower orders the number of distinct left neighbours, each with its absolute
discount D = n1 / (n1 + 2 n2), and unigrams interpolate with the uniform distribution. All n-grams of one order stand in
one sorted array of hashes, with a column of log probabilities (contexts: of backoff weights) for each language. A text
gets the language of the lowest cross-entropy a character; one that is worse than held-back texts of that language by a
calibrated margin is rejected.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pieces

ORDER = 4
U = np.uint64
_ODD = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) | 1 for k in range(ORDER)], U)
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(characters of all texts, each led by ORDER - 1 spaces and closed by one; where each starts; letters of each)."""
    lead = " " * (ORDER - 1)
    joined = "".join(f"\0{t.lower()} " for t in texts)
    c = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    mark = c == 0
    # A text may hold \0 itself: only the marks that lengths call for are starts.
    starts = np.cumsum([0, *(len(t.lower()) + 2 for t in texts)])[:-1]
    mark = np.zeros(len(c), bool)
    mark[starts] = True
    letter = _is_letter()[c] & ~mark
    keep = letter | mark
    keep[1:] |= letter[:-1] & ~letter[1:]  # one space after each run of letters
    at = np.flatnonzero(keep)
    out = np.where(letter[at], c[at], 32).astype(np.uint32)
    first = np.flatnonzero(mark[at])
    counts = np.add.reduceat(letter, starts) if len(texts) else np.zeros(0, int)
    # The mark is one space; the rest of the lead goes before it.
    out = np.insert(out, np.repeat(first, len(lead) - 1), 32)
    first = first + np.arange(len(first)) * (len(lead) - 1)
    return out, first, counts


def gram_keys(c: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n characters that end at each place from n - 1 on."""
    h = np.zeros(max(0, len(c) - n + 1), U)
    for k in range(n):
        h += (c[k : k + len(h)].astype(U) + U(1)) * _ODD[k]
    h ^= h >> U(29)
    return h * U(0xBF58476D1CE4E5B9)


def key_of(gram: str) -> int:
    return int(gram_keys(np.array([ord(x) for x in gram], np.uint32), len(gram))[0])


def _probabilities(grams: dict[str, int], alphabet: int) -> tuple[list[dict[str, float]], dict[str, float]]:
    """(probability of each seen n-gram by order, backoff weight of each context) of one language."""
    counts: list[dict[str, int]] = [{} for _ in range(ORDER + 1)]
    counts[ORDER] = grams
    for n in range(ORDER - 1, 0, -1):  # continuation counts
        c: dict[str, int] = defaultdict(int)
        for g in counts[n + 1]:
            c[g[1:]] += 1
        counts[n] = dict(c)
    seen: list[dict[str, float]] = [{} for _ in range(ORDER + 1)]
    backoff: dict[str, float] = {}
    for n in range(1, ORDER + 1):
        values = list(counts[n].values())
        n1, n2 = values.count(1), values.count(2)
        d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        total: dict[str, int] = defaultdict(int)
        kinds: dict[str, int] = defaultdict(int)
        for g, k in counts[n].items():
            total[g[:-1]] += k
            kinds[g[:-1]] += 1
        for h in total:
            backoff[h] = d * kinds[h] / total[h]
        for g, k in counts[n].items():
            h = g[:-1]
            lower = 1 / alphabet if n == 1 else seen[n - 1][g[1:]]
            seen[n][g] = max(k - d, 0) / total[h] + backoff[h] * lower
    return seen, backoff


#: Characters that are scored at once.
PIECE = 1 << 18


class Model:
    """Sorted hash arrays by order: keys, log probabilities [n-gram, language]; of contexts, log backoff weights."""

    def __init__(self, grams: dict[str, dict[str, int]]):
        self.langs = sorted(grams)
        alphabet = len({x for g in grams.values() for t in g for x in t}) + 1
        fitted = {s: _probabilities(grams[s], alphabet) for s in self.langs}

        def log_p(lang: str, g: str) -> float:
            seen, backoff = fitted[lang]
            weight = 1.0
            while g:
                if g in seen[len(g)]:
                    return float(np.log(weight * seen[len(g)][g]))
                weight, g = weight * backoff.get(g[:-1], 1.0), g[1:]
            return float(np.log(weight / alphabet))

        self.floor = np.array([np.log(fitted[s][1].get("", 1.0) / alphabet) for s in self.langs], np.float32)
        self.tables = []
        for n in range(1, ORDER + 1):
            self.tables.append(self._sorted({g: [log_p(s, g) for s in self.langs] for g in {g for s in self.langs for g in fitted[s][0][n]}}))
        self.contexts = [self._sorted({h: [np.log(fitted[s][1].get(h, 1.0)) for s in self.langs] for h in {h for s in self.langs for h in fitted[s][1] if len(h) == n}}) for n in range(1, ORDER)]
        self.limits: np.ndarray | None = None

    @staticmethod
    def _sorted(rows: dict[str, list[float]]) -> tuple[np.ndarray, np.ndarray]:
        keys = np.array([key_of(g) for g in rows], U)
        order = np.argsort(keys)
        return keys[order], np.array(list(rows.values()), np.float32)[order]

    def _found(self, table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
        return at, table[0][at] == keys

    def log_probabilities(self, c: np.ndarray) -> np.ndarray:
        """[character from the ORDER-th on, language]; unseen n-grams back off, order by order."""
        out = np.zeros((max(0, len(c) - ORDER + 1), len(self.langs)), np.float32)
        open_at = np.arange(len(out))
        for n in range(ORDER, 0, -1):
            ends = c[np.add.outer(open_at, np.arange(ORDER - n, ORDER))] if n < ORDER else None
            keys = gram_keys(c, n) if n == ORDER else _row_keys(ends)
            at, hit = self._found(self.tables[n - 1], keys)
            out[open_at[hit]] += self.tables[n - 1][1][at[hit]]
            missed = ~hit
            if n > 1 and missed.any():
                contexts = c[np.add.outer(open_at[missed], np.arange(ORDER - n, ORDER - 1))]
                at, known = self._found(self.contexts[n - 2], _row_keys(contexts))
                rows = open_at[missed][known]
                out[rows] += self.contexts[n - 2][1][at[known]]
            open_at = open_at[missed]
        out[open_at] += self.floor
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(cross-entropy a character [text, language], letters); texts without letters have entropy 0."""
        c, first, letters = codes(texts)
        sums = np.zeros((len(texts), len(self.langs)))
        if not len(texts):
            return sums, letters
        ends = np.append(first[1:], len(c))
        # Characters that the next text's lead would end are not this text's. Long texts are scored piece by piece.
        n = ends - first - (ORDER - 1)
        for lo in range(0, len(c), PIECE):
            p = self.log_probabilities(c[lo : lo + PIECE + ORDER - 1])
            here = np.flatnonzero((n > 0) & (first < lo + len(p)) & (first + n > lo))
            for i in here.tolist():
                a, b = max(int(first[i]) - lo, 0), min(int(first[i] + n[i]) - lo, len(p))
                sums[i] -= p[a:b].sum(0, dtype=np.float64)
        sums /= np.maximum(n, 1)[:, None]
        return sums, letters


def _row_keys(rows: np.ndarray) -> np.ndarray:
    h = np.zeros(len(rows), U)
    for k in range(rows.shape[1]):
        h += (rows[:, k].astype(U) + U(1)) * _ODD[k]
    h ^= h >> U(29)
    return h * U(0xBF58476D1CE4E5B9)


def _in_blocks(texts: list[str | None], most: int = 1 << 17) -> Iterator[list[str]]:
    block, size = [], 0
    for t in texts:
        t = t or ""
        if block and size + len(t) > most:
            yield block
            block, size = [], 0
        block.append(t)
        size += len(t)
    if block:
        yield block


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, text -> lang, gram, n: n-grams of the highest order, summed over each batch's texts."""
    for batch in pieces(batches):
        by_lang = defaultdict(list)
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            by_lang[lang].append(text)
        for lang, texts in by_lang.items():
            for block in _in_blocks(texts):
                c, first, _ = codes(block)
                grams = np.lib.stride_tricks.sliding_window_view(c, ORDER) if len(c) >= ORDER else np.zeros((0, ORDER), np.uint32)
                over = np.zeros(len(c), bool)  # windows that reach into the next text
                for f in first[1:]:
                    over[max(0, f - ORDER + 1) : f] = True
                keys, at, n = np.unique(_row_keys(grams)[~over[: len(grams)]], return_index=True, return_counts=True)
                kept = grams[~over[: len(grams)]][at]
                strings = ["".join(map(chr, g)) for g in kept.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(strings, pa.string()), pa.array(n, pa.int64())], ["lang", "gram", "n"])


def train(labelled: DataFrame, sample_docs: int = 1000, margin: float = 1.0) -> Model | None:
    """A model of labelled(doc_id, lang, text): fitted on about sample_docs whole texts a language, chosen by a hash, or all where there are fewer.

    A tenth of that number is held back: the limit of a language is the entropy that 99 of 100 of them stay below, plus
    `margin` nats a character. The model's size is bounded by sample_docs and the number of languages. None without text.
    """
    labelled = labelled.where("lang is not null and text is not null")
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row a language
    if not counts:
        return None
    spark = labelled.sparkSession
    share = spark.createDataFrame([(s, min(1.0, sample_docs * 1.1 / n)) for s, n in counts.items()], "lang string, _share double")
    ranked = labelled.select("lang", "text", (F.pmod(F.xxhash64("doc_id", F.lit(41)), F.lit(1 << 30)) / (1 << 30)).alias("_u"))
    chosen = ranked.join(F.broadcast(share), "lang").where("_u < _share")
    fit, held = chosen.where("_u < _share * 10 / 11").select("lang", "text"), chosen.where("_u >= _share * 10 / 11").select("lang", "text")
    grams: dict[str, dict[str, int]] = defaultdict(dict)
    summed = fit.mapInArrow(count_grams, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    t = summed.toArrow()  # bounded by the sample
    for lang, gram, n in zip(t["lang"].to_pylist(), t["gram"].to_pylist(), t["n"].to_pylist(), strict=True):
        grams[lang][gram] = n
    if not grams:
        return None
    model = Model(grams)
    shared = spark.sparkContext.broadcast(model)

    def entropy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows = [e for block in _in_blocks(batch.column(1).to_pylist()) for e in zip(*shared.value.entropies(block), strict=True)]
            own = [float(e[shared.value.langs.index(s)]) if s in shared.value.langs and n > 20 else None for s, (e, n) in zip(batch.column(0).to_pylist(), rows, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.float64())], ["lang", "e"])

    limits = {r["lang"]: r["q"] for r in held.mapInArrow(entropy, "lang string, e double").groupBy("lang").agg(F.percentile("e", 0.99).alias("q")).collect()}
    usual = [x for x in limits.values() if x is not None] or [float("inf")]
    model.limits = np.array([(limits.get(s) if limits.get(s) is not None else max(usual)) + margin for s in model.langs])
    return model


def predict(docs: DataFrame, model: Model | None, short: int = 40) -> DataFrame:
    """doc_id, lang_pred, score, entropy, rejected of every row of docs.

    lang_pred: `und` for a null text or one without letters (score 0, rejected), else a learned language, ties to the
    first by name. score: the share of the best language among exp(-entropy * letters), letters counted up to 50.
    rejected: the entropy exceeds the language's limit; texts of fewer than `short` letters are given more room.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in pieces(batches):
            pred, score, entropy, rejected = [], [], [], []
            for block in _in_blocks(batch.column(1).to_pylist()):
                if model is None:
                    e, letters = np.zeros((len(block), 0)), np.zeros(len(block), int)
                else:
                    e, letters = model.entropies(block)
                for x, n in zip(e, letters, strict=True):
                    if not n:
                        pred.append("und"), score.append(0.0), entropy.append(None), rejected.append(True)
                        continue
                    best = int(x.argmin())
                    w = np.exp((x[best] - x) * min(int(n), 50))
                    room = max(0.0, short / int(n) - 1) * 0.5
                    pred.append(model.langs[best]), score.append(float(1 / w.sum())), entropy.append(float(x[best]))
                    rejected.append(bool(x[best] > model.limits[best] + room))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(entropy, pa.float64()), pa.array(rejected, pa.bool_())], ["doc_id", "lang_pred", "score", "entropy", "rejected"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scored, "doc_id long, lang_pred string, score double, entropy double, rejected boolean")


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def identify_languages(docs: DataFrame, sample_docs: int = 1000) -> DataFrame:
    """doc_id, held_out, lang_pred, score, entropy, rejected: trained on the rows that are not held out, applied to all.

    Rows with a null doc_id are not held out. Repeated rows give repeated results; an empty table gives an empty one;
    other columns are ignored.
    """
    model = train(docs.where(~held_out()).select("doc_id", "lang", "text"), sample_docs)
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "entropy", "rejected")
