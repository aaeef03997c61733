"""Benchmark decontamination by latent semantic retrieval.

Passages are windows of words. Words fall into hashed features weighted by idf over all documents; a randomised SVD of
the TF-IDF passages (range finder with one power step, its products summed over tasks) gives each feature a vector, and
a passage's vector is the weighted sum of its words'. The benchmark's passages weigh more than the corpus's, so that the
space tells them apart. A window of a document is compared by the cosine of its vector with that of a benchmark window of
about its length, where its own length is that of the whole TF-IDF vector: what lies outside the space counts against it.
Windows whose cosine reaches a share of what the benchmark window itself would reach are candidates. Most windows are
left out without their vectors, by an upper bound of their cosines that is a sum over their words. A candidate is confirmed on the words themselves: the longest common subsequence of the item and the
document's words around the window must cover most of the item, and its answer (its last words) must be there, too, or
the cover be near complete.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import erase, written
from .words import U, blocks, mixed, split_words

FEATURES, RANK = 1 << 16, 256
#: Kinds of windows: (words of a window, step between windows of documents, items of fewer words than this belong to the kind).
WINDOWS = ((12, 3, 20), (24, 6, 1 << 31))
#: Items of fewer words are found word for word.
LEAST_WORDS = 8
#: All passages of a space's items together weigh so many times the passages of the documents.
BENCHMARK_WEIGHT = 100
#: Items of a space, and spaces that are searched in one pass over the documents.
SPACE_ITEMS, PASS_SPACES = 256, 8
#: Windows that are compared at once; groups of item windows that have a bound of their own.
CHUNK, GROUPS = 512, 8


def _words(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(index of the first, number, word hashes, offsets) of texts, by blocks."""
    for at in range(0, len(column), 512):
        texts = [t or b"" for t in column.slice(at, 512).cast(pa.binary()).to_pylist()]
        for first, part in blocks(texts):
            yield at + first, len(part), *split_words(part, bare=True)


def features(words: np.ndarray) -> np.ndarray:
    return (words >> U(48)).astype(np.int64)


def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text, draw -> codes (the features of the text's words, two bytes each), draw."""
    for batch in batches:
        for first, size, w, at in _words(batch.column(0)):
            parts = [None, pa.py_buffer((at * 2).astype(np.int32)), pa.py_buffer(features(w).astype(np.uint16))]
            yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), size, parts), batch.column(1).slice(first, size)], ["codes", "draw"])


def _codes(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features, offsets) of texts as `encoded` has them, by blocks."""
    for first in range(0, len(column), 512):
        part = column.slice(first, 512).cast(pa.large_binary())
        _, offsets, data = part.buffers()
        at = np.frombuffer(offsets, np.int64)[part.offset : part.offset + len(part) + 1] // 2
        yield (np.frombuffer(data, np.uint16, count=at[-1])[at[0] :] if at[-1] else np.zeros(0, np.uint16)), at - at[0]


def document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """codes -> feature, df (summed over the task's texts), feature -1 with the number of texts and -2 with that of words."""
    df, n, words = np.zeros(FEATURES, np.int64), 0, 0
    for batch in batches:
        for f, at in _codes(batch.column(0)):
            pairs = np.repeat(np.arange(len(at) - 1, dtype=np.uint32) << 16, np.diff(at)) | f
            pairs.sort()
            df += np.bincount(pairs[np.flatnonzero(np.diff(pairs, prepend=~pairs[:1]))] & 0xFFFF, minlength=FEATURES)
            n += len(at) - 1
            words += len(f)
    some = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(some, [-1, -2]).astype(np.int32)), pa.array(np.append(df[some], [n, words]))], ["feature", "df"])


def windows_of(at: np.ndarray, size: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, start, end) of the windows of texts with words at[i]:at[i+1]; the last window ends with its text, a shorter text is one window."""
    n = np.diff(at)
    steps = np.where(n > 0, 1 + np.maximum(n - size + stride - 1, 0) // stride, 0)
    owner = np.repeat(np.arange(len(n)), steps)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(steps) - steps, steps)
    start = at[owner] + np.minimum(place * stride, np.maximum(n[owner] - size, 0))
    return owner, start, np.minimum(start + size, at[owner + 1])


def embedded(c: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Vectors of word windows: sums of rows of `table` (whose last row is zero) at the words' numbers c in the vocabulary."""
    size = int((end - start).max(initial=0))
    at = start[:, None] + np.arange(size)
    rows = np.where(at < end[:, None], c[np.minimum(at, len(c) - 1)], len(table) - 1)
    out = np.zeros((len(start), table.shape[1]), np.float32)
    for k in range(size):
        out += table[rows[:, k]]
    return out


def unit_rows(v: np.ndarray) -> np.ndarray:
    """Rows at length 1; a zero row stays."""
    size = np.sqrt((v * v).sum(1, keepdims=True))
    return v / np.where(size > 1e-6, size, 1)


def running(x: np.ndarray) -> np.ndarray:
    """Running sums down the rows, with a zero row before."""
    out = np.zeros((len(x) + 1, *x.shape[1:]))
    np.cumsum(x, axis=0, out=out[1:])
    return out


def lengths(f: np.ndarray, start: np.ndarray, end: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Lengths of the windows' TF-IDF vectors, where each word counts as its own; at least a small number."""
    run = running(idf[f] ** 2)
    return np.sqrt(np.maximum(run[end] - run[start], 1e-6))


def vocabulary(f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the distinct features f, for every feature its number among them or, for others, their count)."""
    known = np.unique(f)
    index = np.full(FEATURES, len(known), np.int32)
    index[known] = np.arange(len(known))
    return known, index


def add_product(total: np.ndarray, c: np.ndarray, at: np.ndarray, table: np.ndarray, weight: float = 1.0) -> None:
    """Adds to each word's row of `total` the unit vector of its passage, for texts with word numbers c[at[i]:at[i+1]]. A word
    that the last two passages of a text share counts for the last one.

    A passage's vector is the sum of its words' rows of `table`, whose last row is zero and stands for all words outside the
    vocabulary. Only words of the vocabulary are added, the ones that many passages hold by a product of matrices.
    """
    width, none, many = WINDOWS[-1][0], len(table) - 1, 16
    place, (_, start, end) = np.arange(width), windows_of(at, width, width)
    upto = np.minimum(end, np.append(start[1:], end[-1:]))
    sums, taken = (np.empty((2 * CHUNK, table.shape[1]), np.float32) for _ in range(2))
    for k in range(0, len(start), 2 * CHUNK):
        p = start[k : k + 2 * CHUNK, None] + place
        held = np.where(p < end[k : k + 2 * CHUNK, None], c[np.minimum(p, len(c) - 1)], none)
        mine = (p < upto[k : k + 2 * CHUNK, None]) & (held < none)
        word, row = held[mine], np.repeat(np.arange(len(p)), mine.sum(1))
        held.sort(axis=1)
        n = (held < none).sum(1)
        by = np.argsort(-n, kind="stable")
        held, n = held[by], n[by]
        row = np.argsort(by)[row]
        y = sums[: len(n)]
        y[:] = 0
        for j, m in enumerate(np.searchsorted(-n, -place, "left")):  # the first m have more than j words
            y[:m] += np.take(table, held[:m, j], axis=0, out=taken[:m], mode="clip")
        y = unit_rows(y) * np.float32(weight)
        order = np.argsort(word.astype(np.uint16), kind="stable")
        word, row = word[order], row[order]
        head = np.flatnonzero(np.diff(word, prepend=-1))
        count = np.diff(np.append(head, len(word)))
        big = count > many
        if big.any():
            at_big, number = np.repeat(big, count), np.repeat(np.arange(big.sum()), count[big])
            total[word[head[big]]] += np.bincount(number * len(n) + row[at_big], minlength=big.sum() * len(n)).reshape(-1, len(n)).astype(np.float32) @ y
        few = np.flatnonzero(~big)
        few = few[np.argsort(-count[few], kind="stable")]
        head, count = head[few], count[few]
        rows = y[row[head]]
        for j in range(1, count.max(initial=0)):
            m = np.searchsorted(-count, -j, "left")
            rows[:m] += y[row[head[:m] + j]]
        total[word[head]] += rows


@dataclass
class Space:
    """What a space is fitted on besides the documents: its items' words and the number of each among the known features."""

    rows: list
    words: np.ndarray
    at: np.ndarray
    weight: float

    def __post_init__(self):
        self.f = features(self.words)
        self.known, self.index = vocabulary(self.f)


def fit_spaces(codes: DataFrame, spaces: list[Space], idf: np.ndarray, steps: int = 2, seed: int = 11) -> list[np.ndarray]:
    """For each space (len(known) + 1) x RANK, the last row zero: idf-weighted right singular vectors of the TF-IDF matrix A over
    its known features, by repeated orthonormalised A'A products. A's rows are the passages of all texts and of the space's items,
    whose weight multiplies their part of the product. A step is one pass over codes(codes) for all spaces.

    A task gives a row for each known feature at most; few tasks take all partitions, so that these rows do not grow with the texts.
    """
    spark = codes.sparkSession
    own = [np.append(idf[s.known], 0)[:, None] for s in spaces]
    table = lambda s, basis: np.vstack([idf[s.known][:, None] * basis, np.zeros((1, basis.shape[1]))]).astype(np.float32)
    start = lambda n: np.linalg.qr(np.random.default_rng(seed).standard_normal((n, min(RANK, n))))[0] if n else np.zeros((0, 1))
    tables = [table(s, start(len(s.known))) for s in spaces]
    texts, rank = codes.select("codes").coalesce(4 * spark.sparkContext.defaultParallelism), max(t.shape[1] for t in tables)
    for _ in range(steps if any(len(s.known) for s in spaces) else 0):
        shared = spark.sparkContext.broadcast([(s.index, t) for s, t in zip(spaces, tables, strict=True)])

        def product(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            totals = [np.zeros(t.shape) for _, t in shared.value]
            for batch in batches:
                for f, at in _codes(batch.column(0)):
                    for total, (index, t) in zip(totals, shared.value, strict=True):
                        add_product(total, index[f], at, t)
            for k, total in enumerate(totals):
                some = np.flatnonzero(np.abs(total).sum(1))
                cells = [pa.array(total[some, r].astype(np.float32)) if r < total.shape[1] else pa.array(np.zeros(len(some), np.float32)) for r in range(rank)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), k, np.int32)), pa.array(some.astype(np.int32)), *cells], ["space", "word", *(f"r{r}" for r in range(rank))])

        parts = texts.mapInArrow(product, f"space int, word int, {', '.join(f'r{r} float' for r in range(rank))}")
        summed = parts.groupBy("space", "word").agg(*(F.sum(f"r{r}").cast("float").alias(f"r{r}") for r in range(rank))).toArrow()  # a row for each known feature of each space at most
        shared.unpersist()
        of, word = summed["space"].to_numpy(), summed["word"].to_numpy()
        cells = np.column_stack([summed[f"r{r}"].to_numpy() for r in range(rank)])
        for k, (s, t) in enumerate(zip(spaces, tables, strict=True)):
            total = np.zeros(t.shape)
            total[word[of == k]] = cells[of == k, : t.shape[1]]
            add_product(total, s.index[s.f], s.at, t, s.weight)
            z = (own[k] * total)[:-1]
            if np.abs(z).sum():
                tables[k] = table(s, np.linalg.qr(z)[0])
    return tables


class Item:
    """A benchmark item's words, as bit masks for common subsequences."""

    def __init__(self, item_id, words: np.ndarray):
        self.item_id, self.n = item_id, len(words)
        self.masks: dict[int, int] = {}
        for i, w in enumerate(words.tolist()):
            self.masks[w] = self.masks.get(w, 0) | 1 << i

    def matched(self, words: list[int]) -> int:
        """Bits of the item's words at which the longest common subsequence grows: their number is its length."""
        full = (1 << self.n) - 1
        v = full
        for w in words:
            if m := self.masks.get(w):
                u = v & m
                v = (v + u | v - u) & full
        return ~v & full


class Targets:
    """Windows of one kind of some items: their unit vectors in order of group, the cosine from which they take a candidate, and bounds.

    limits[c, g] is the most that the word numbered c adds to the product with any window of group g. A window whose
    words' limits do not add up to the floor of a group is no candidate of it: found from running sums, without its vector.
    """

    def __init__(self, kind: tuple[int, int, int], items: list[tuple[Item, int, int]], f: np.ndarray, index: np.ndarray, space: np.ndarray, idf: np.ndarray, cosine: float):
        self.size, self.stride, _ = kind
        self.items = items
        found = [(i, s, e) for i, (_, a, b) in enumerate(items) for s, e in zip(*windows_of(np.array([a, b]), self.size, self.size)[1:], strict=True)]
        bounds = np.array(found, int).reshape(-1, 3)
        vectors = embedded(index[f], bounds[:, 1], bounds[:, 2], space) if found else np.zeros((0, space.shape[1]), np.float32)
        own = np.sqrt((vectors * vectors).sum(1)) / lengths(f, bounds[:, 1], bounds[:, 2], idf)
        vectors = unit_rows(vectors)
        # Groups: windows fall to the nearest of a few of them.
        heads = vectors[:: max(1, len(vectors) // GROUPS)][:GROUPS]
        group = (vectors @ heads.T).argmax(1) if found else np.zeros(0, int)
        order = np.argsort(group, kind="stable")
        self.vectors, self.bounds, self.floor = vectors[order], bounds[order], (cosine * np.maximum(own, 0.05))[order]
        edges = np.flatnonzero(np.diff(group[order], prepend=-1))
        self.parts = [(int(a), int(b)) for a, b in zip(edges, [*edges[1:], len(order)], strict=False)]  # none without windows
        self.least = np.array([self.floor[a:b].min() for a, b in self.parts])
        self.limits = np.zeros((len(space), len(self.parts)))
        for g, (a, b) in enumerate(self.parts):
            self.limits[:, g] = (space @ self.vectors[a:b].T).max(1)

    def candidates(self, f: np.ndarray, c: np.ndarray, at: np.ndarray, space: np.ndarray, idf: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(owner, start of the window, number of the target) of all pairs that reach the target's floor, some at a time."""
        owner, start, end = windows_of(at, self.size, self.stride)
        if not len(owner) or not self.parts:
            return
        length = lengths(f, start, end, idf)
        run = running(self.limits[c])
        reach = np.take(run, end, axis=0) - np.take(run, start, axis=0) >= length[:, None] * (self.least - 1e-4)
        for g, (a, b) in enumerate(self.parts):
            near = np.flatnonzero(reach[:, g])
            for k in range(0, len(near), CHUNK):
                n = near[k : k + CHUNK]
                v = embedded(c, start[n], end[n], space) / length[n, None]
                i, t = np.nonzero(v @ self.vectors[a:b].T >= self.floor[a:b])
                if len(i):
                    yield owner[n[i]], start[n[i]], t + a

    def regions(self, f: np.ndarray, c: np.ndarray, at: np.ndarray, space: np.ndarray, idf: np.ndarray) -> Iterator[tuple[int, Item, int, int]]:
        """(owner, item, lo, hi): words of texts in which an item may be, taken from its candidates; those that overlap are one,
        up to three times the item's length."""
        found = list(self.candidates(f, c, at, space, idf))
        if not found:
            return
        d, start, t = (np.concatenate(x) for x in zip(*found, strict=True))
        number, s = self.bounds[t, 0], self.bounds[t, 1]
        # Where the item would start if the windows were aligned, with room for inserted words.
        n = np.array([item.n for item, _, _ in self.items])[number]
        lead, room = s - np.array([first for _, first, _ in self.items])[number], 8 + n // 8
        lo, hi = np.maximum(at[d], start - lead - room), np.minimum(at[d + 1], start - lead + n + room)
        order = np.lexsort((hi, lo, number, d))
        rows = np.column_stack([d, number, lo, hi])[order]
        rows = rows[np.append(True, (np.diff(rows, axis=0) != 0).any(1))]
        last = None
        for d, number, lo, hi in rows.tolist():
            if last and last[:2] == (d, number) and lo < last[3] and hi - last[2] <= 3 * self.items[number][0].n:
                last = (d, number, last[2], max(hi, last[3]))
                continue
            if last:
                yield last[0], self.items[last[1]][0], last[2], last[3]
            last = (d, number, lo, hi)
        if last:
            yield last[0], self.items[last[1]][0], last[2], last[3]


class ShortItems:
    """Items of fewer words than a window can tell: they are found word for word.

    An item of WHOLE words or fewer says too little inside a longer text, and is found where it is all of the text.
    """

    WHOLE = 2

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.by_size: dict[int, tuple[np.ndarray, list[tuple[int, np.ndarray]]]] = {}
        for n in {len(w) for _, w in items}:
            own = sorted(((self.hashes(w, n)[0], i, w) for i, w in items if len(w) == n), key=lambda x: (x[0], x[1] is None, x[1] or 0))
            self.by_size[n] = np.array([h for h, _, _ in own], U), [(i, w) for _, i, w in own]

    @staticmethod
    def hashes(w: np.ndarray, n: int) -> np.ndarray:
        """A hash of each n words in a row."""
        out = np.zeros(max(0, len(w) - n + 1), U)
        for k in range(n):
            out = mixed(out + w[k : k + len(out)])
        return out

    def found(self, w: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int]]:
        """(owner, item_id) of texts with words at[i]:at[i+1] and the items that they hold."""
        for n, (keys, items) in self.by_size.items():
            h = self.hashes(w, n)
            place = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            for i in np.flatnonzero(keys[place] == h).tolist():
                d = int(np.searchsorted(at, i, side="right")) - 1
                if i + n > at[d + 1] or (n <= self.WHOLE and at[d + 1] - at[d] != n):
                    continue
                for item_id, own in items[place[i] :]:
                    if not (own == w[i : i + n]).all():
                        break
                    yield d, item_id


def _before(a, b) -> bool:
    """Whether item id a comes before b; null comes last."""
    return a is not None and (b is None or a < b)


def searcher(shared, cover: float, near_complete: float, answer_words: int):
    """doc_id, text, k1, k2 -> doc_id, k1, k2, contaminated, item_id, overlap against the shared items."""

    def best_of(w: np.ndarray, at: np.ndarray) -> dict[int, tuple[bool, float, object]]:
        idf, spaces = shared.value
        f = features(w)
        best: dict[int, tuple[bool, float, object]] = {}
        for index, space, kinds, short in spaces:
            for d, item_id in short.found(w, at):
                old = best.get(d, (False, -1.0, None))
                if (True, 1.0) > old[:2] or ((True, 1.0) == old[:2] and _before(item_id, old[2])):
                    best[d] = (True, 1.0, item_id)
            c = index[f]
            for targets in kinds:
                for d, item, lo, hi in targets.regions(f, c, at, space, idf):
                    bits = item.matched(w[lo:hi].tolist())
                    ratio = bits.bit_count() / item.n
                    tail = min(answer_words, item.n)
                    answer = (bits >> (item.n - tail)).bit_count() * 2 >= tail
                    hit = ratio >= near_complete or (ratio >= cover and answer)
                    old = best.get(d, (False, -1.0, None))
                    if (hit, ratio) > old[:2] or ((hit, ratio) == old[:2] and _before(item.item_id, old[2])):
                        best[d] = (hit, ratio, item.item_id)
        return best

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, size, w, at in _words(batch.column(1)):
                best = best_of(w, at)
                found = [best.get(d, (False, 0.0, None)) for d in range(size)]
                made = [pa.array([x[0] for x in found], pa.bool_()), pa.array([x[2] if x[0] else None for x in found], pa.int64()), pa.array([x[1] for x in found], pa.float64())]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(first, size) for c in (0, 2, 3)), *made], ["doc_id", "k1", "k2", "contaminated", "item_id", "overlap"])

    return search


def decontaminate(docs: DataFrame, benchmark: DataFrame, cosine: float = 0.4, cover: float = 0.5, near_complete: float = 0.7, answer_words: int = 8, sample_docs: int | None = None) -> DataFrame:
    """doc_id, contaminated, item_id, overlap of every row of docs: the item of the benchmark that it holds most of.

    contaminated: the longest common subsequence with the words around a candidate window covers `cover` of an item and
    half of its last answer_words words, or near_complete of it. Words are runs of letters and digits, in any case.
    cosine: the share of its own cosine at which a window of an item takes a candidate. overlap: the greatest cover of a
    candidate item (0 without one); item_id: that of a contaminated row (ties: the smaller), else null. Idf counts all
    documents; all windows of all documents are searched.

    The benchmark is dealt into spaces of SPACE_ITEMS items, for one space cannot tell many more apart; each is fitted on
    its items and all documents (with sample_docs, on about so many whole ones, chosen by a hash). PASS_SPACES of them are
    fitted together and broadcast for a pass over docs; verdicts of several passes depend on the text alone and meet by its
    hash. So time grows with the benchmark, and memory does not. The features of the documents' words are written once, two
    bytes a word, and erased when all spaces are fitted. Items of fewer than LEAST_WORDS words have no windows: they count
    where all their words stand in a row, with an overlap of 1 (items of one or two words only where they are the whole
    text, for many texts have such words). Items without words are not found; those with a null id are searched like others
    (a row that holds one is contaminated, and its item_id is null; ties: after all ids). Null and empty texts are clean;
    rows that repeat have the same verdict each; an empty table gives an empty one; an empty benchmark leaves all rows
    clean; other columns are ignored.
    """
    spark = docs.sparkSession
    items = benchmark.where("text is not null").select("item_id", "text").dropDuplicates()
    spaces = max(1, -(-items.count() // SPACE_ITEMS))

    draw = F.pmod(F.xxhash64("doc_id", F.lit(43)), F.lit(1 << 30)).alias("draw")
    codes = written(docs.select("text", draw).mapInArrow(encoded, "codes binary, draw long"), "codes")
    counted = codes.select("codes").mapInArrow(document_frequencies, "feature int, df long").groupBy("feature").agg(F.sum("df").alias("df")).toArrow()  # at most FEATURES rows
    f, df = counted["feature"].to_numpy(), counted["df"].to_numpy()
    total, total_words = int(df[f == -1].sum()), int(df[f == -2].sum())
    idf = np.full(FEATURES, np.log(1 + total))
    idf[f[f >= 0]] = np.log((1 + total) / (1 + df[f >= 0])) + 1e-3
    share = min(1.0, sample_docs / max(total, 1)) if sample_docs else 1.0
    fitted_on = codes.where(F.col("draw") < int(share * (1 << 30)))

    def items_of(k: int) -> Space:
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(spaces)) == k)
        rows = own.orderBy("item_id", "text").collect()  # about SPACE_ITEMS
        words, at = split_words([r["text"].encode() for r in rows] or [b""], bare=True)
        return Space(rows, words, at, BENCHMARK_WEIGHT * max(1.0, total_words * share / max(len(words), 1)))

    def searched(own: Space, space: np.ndarray) -> tuple:
        bounds = list(zip(own.rows, own.at[:-1], own.at[1:], strict=False))
        long = [(Item(r["item_id"], own.words[a:b]), int(a), int(b)) for r, a, b in bounds if b - a >= LEAST_WORDS]
        short = ShortItems([(r["item_id"], own.words[a:b]) for r, a, b in bounds if 0 < b - a < LEAST_WORDS])
        kinds, below = [], 0
        for kind in WINDOWS:
            kinds.append(Targets(kind, [x for x in long if below <= x[0].n < kind[2]], own.f, own.index, space, idf, cosine))
            below = kind[2]
        return own.index, space, kinds, short

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"))
    out = "doc_id long, k1 long, k2 long, contaminated boolean, item_id long, overlap double"
    found = []
    for k in range(0, spaces, PASS_SPACES):
        own = [items_of(i) for i in range(k, min(k + PASS_SPACES, spaces))]
        shared = spark.sparkContext.broadcast((idf, [searched(s, space) for s, space in zip(own, fit_spaces(fitted_on, own, idf), strict=True)]))
        hits = keyed.mapInArrow(searcher(shared, cover, near_complete, answer_words), out)
        if k + PASS_SPACES >= spaces:
            erase(codes)
        if spaces <= PASS_SPACES:
            return hits.drop("k1", "k2")
        found.append(written(hits.where("overlap > 0").drop("doc_id").distinct(), "hits"))
        shared.unpersist()
    best = reduce(DataFrame.unionByName, found).groupBy("k1", "k2").agg(F.max(F.struct("contaminated", "overlap", (-F.col("item_id")).alias("_i"))).alias("b"))
    joined = keyed.drop("text").join(best, ["k1", "k2"], "left")
    return joined.select("doc_id", F.coalesce("b.contaminated", F.lit(False)).alias("contaminated"), (-F.col("b._i")).alias("item_id"), F.coalesce("b.overlap", F.lit(0.0)).alias("overlap"))
