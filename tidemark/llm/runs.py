"""Runs of repeated words, found with string synchronising sets.

A run of period q is found at the scale t = 2**k with t <= q < 2t. There, a place belongs to the synchronising set if the
least hash of the t-word blocks that begin at it and up to t words on is that of the first or of the last of them. So
whether a place belongs depends on its context of 2t words alone, and every t neighbouring places have a member. Blocks
that have a period of t/4 or less are left out of the minimum: within such a region members would lie as close as its
period, and its run is known from the smaller scales. In a run of at least 4q words a member among its first t places
recurs with its context q words on and not before (the context is longer than q), so members of equal context that follow
each other propose the period; each proposal is extended to the whole run and checked against shorter periods.

Contexts are compared by names: equal blocks have equal whole numbers, made scale by scale by doubling, without hashing.
Places whose block does not recur in their text drop out on the way.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import pieces
from .words import blocks, mixed

RUN = "array<struct<start:long,length:long,period:long>>"
LEAST = 6  # words
TIMES = 4  # periods
MOST = np.uint64(np.iinfo(np.uint64).max)


def recurring(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(mask of keys that occur twice, their names: numbers below the number of keys, equal for equal keys)."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    new = np.concatenate(([True], k[1:] != k[:-1]))
    again = ~new | np.concatenate((~new[1:], [False]))
    names, mask = np.empty(len(keys), np.int64), np.empty(len(keys), bool)
    names[order], mask[order] = np.cumsum(new) - 1, again
    return mask, names


def window_least(x: np.ndarray, t: int) -> np.ndarray:
    """The least of x[i .. i + t] for each i, t a power of two, by doubling."""
    m, w = x, 1
    while w < t:
        m, w = np.minimum(m, np.concatenate((m[w:], np.full(min(w, len(m)), MOST)))), 2 * w
    return np.minimum(m, np.concatenate((x[t:], np.full(min(t, len(x)), MOST))))


def stretches(w: np.ndarray, d: int, at: np.ndarray) -> list[tuple[int, int]]:
    """(start, length) of the longest stretches of period d that hold one of the places `at` (rising) and the word d after it."""
    if d < 8 or len(at) > 64 + len(w) // 4096:  # many: all stretches of this period in one pass
        edge = np.flatnonzero(np.diff(np.concatenate(([False], w[:-d] == w[d:], [False])).view(np.int8)))
        which = np.unique(np.searchsorted(edge[0::2], at, side="right") - 1)
        return [(int(a), int(b - a) + d) for a, b in zip(edge[0::2][which], edge[1::2][which], strict=True)]
    out, end = [], 0
    for s in at.tolist():
        if s < end:
            continue
        right, step = s, 64
        while right + d < len(w):
            top = min(right + step, len(w) - d)
            off = np.flatnonzero(w[right:top] != w[right + d : top + d])
            if len(off):
                right += int(off[0])
                break
            right, step = top, 2 * step
        left, step = s, 64
        while left > 0:
            low = max(left - step, 0)
            off = np.flatnonzero(w[low:left] != w[low + d : left + d])
            if len(off):
                left = low + int(off[-1]) + 1
                break
            left, step = low, 2 * step
        end = right
        out.append((left, right - left + d))
    return out


def primes_of(d: int) -> list[int]:
    out, r = [], 2
    while r * r <= d:
        if d % r == 0:
            out.append(r)
            while d % r == 0:
                d //= r
        r += 1
    return out + [d] * (d > 1)


def repetitions(w: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every longest stretch of smallest period q and at least 4q words, unordered.

    w: whole numbers; a place where texts part holds a number of its own, so that no run reaches across it.
    """
    size, found = len(w), []
    if size < TIMES:
        return found
    periodic: dict[int, list[tuple[int, int]]] = defaultdict(list)  # scale -> (start, length) of runs that are highly periodic from there on
    mask, name = recurring(w)
    names = np.where(mask, name, np.arange(size) + size)  # of blocks of t words; those that do not recur have names of their own
    live, t = np.flatnonzero(mask), 1
    known: list[tuple[int, int]] = []
    while len(live):
        known += periodic.pop(t, [])
        alone = np.ones(size + t, bool)
        alone[live] = False
        both = live[~alone[live + t]]  # contexts of 2t words that may recur
        mask, name = recurring(names[both].astype(np.uint64) << np.uint64(32) | names[both + t].astype(np.uint64)) if len(both) else (np.zeros(0, bool), np.zeros(0, np.int64))
        context, name = both[mask], name[mask]
        if not len(context):
            break
        hashes = mixed(names.astype(np.uint64) + np.uint64(t))
        if known:
            cover = np.zeros(size + 1, np.int32)
            for a, n in known:
                if n >= t:
                    cover[a] += 1
                    cover[a + n - t + 1] -= 1
            hashes[np.cumsum(cover[:-1]) > 0] = MOST
        least = window_least(hashes, t)[context]
        member = (least != MOST) & ((hashes[context] == least) | (hashes[context + t] == least))
        at, its = context[member], name[member]
        order = np.lexsort((at, its))
        at, its = at[order], its[order]
        gap = np.diff(at)
        pair = (its[1:] == its[:-1]) & (gap >= t) & (gap < 2 * t)
        at, gap = at[:-1][pair], gap[pair]
        for d in np.unique(gap).tolist():
            for a, n in stretches(w, d, np.sort(at[gap == d])):
                if n >= TIMES * d and not any((w[a : a + d] == w[a + d // r : a + d + d // r]).all() for r in primes_of(d)):
                    found.append((a, n, d))
                    scale = 1 << (TIMES * d - 1).bit_length()  # the first of at least 4d words
                    periodic[max(scale, 2 * t)].append((a, n))
        fresh = np.arange(size) + size
        fresh[context] = name
        names, live, t = fresh, context, 2 * t
    return found


def text_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each text's words that have LEAST words, by start, then period."""
    sizes = np.array([len(x) + 1 for x in texts], np.int64)
    start = np.concatenate(([0], np.cumsum(sizes)))
    w = np.empty(start[-1], np.int64)
    for i, words in enumerate(texts):  # numbers differ between texts, and each ends with a number of its own
        index = defaultdict(count(start[i]).__next__)
        w[start[i] : start[i + 1] - 1] = [index[x] for x in words]
        w[start[i + 1] - 1] = -1 - i
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for a, n, q in sorted(repetitions(w), key=lambda r: (r[0], r[2])):
        if n >= LEAST:
            i = int(np.searchsorted(start, a, side="right")) - 1
            out[i].append((a - int(start[i]), n, q))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, one space between them, each run cut to its first period."""
    if not runs:
        return b" ".join(words)
    drop = np.zeros(len(words) + 1, np.int32)
    for a, n, q in runs:
        drop[a + q] += 1
        drop[a + n] -= 1
    return b" ".join([x for x, k in zip(words, np.cumsum(drop).tolist(), strict=False) if not k])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """One row per row of docs: id, n_words, runs (start, length, period in words; by start, then period) and collapsed.

    Words are what white space of ASCII parts. A run is a stretch of words with smallest period q, of at least 4q and at
    least 6 words, that no neighbouring word extends. collapsed has the words that are left, one space between them, when
    each run keeps its first q words alone. rewrite(id, words) may change a text's words first. Null and empty texts have no
    words and no runs; null ids of rows stay; repeated rows give repeated results; an empty table gives an empty one; other
    columns are ignored. No shuffle: texts are worked on where they are read, about 256 kB of them at a time.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            ids, texts = batch.column(0).to_pylist(), [(x or "").encode() for x in batch.column(1).to_pylist()]
            for first, some in blocks(texts):
                words = [x.split() for x in some]
                if rewrite:
                    words = [rewrite(i, x) for i, x in zip(ids[first:], words, strict=False)]
                runs = text_runs(words)
                flat = np.array([r for x in runs for r in x], np.int64).reshape(-1, 3)
                parts = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in runs]))).astype(np.int32)
                columns = [batch.column(0).slice(first, len(some)), pa.array([len(x) for x in words], pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), parts), pa.array([collapsed(x, r).decode() for x, r in zip(words, runs, strict=True)], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [id_col, "n_words", "runs", "collapsed"])

    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, n_words long, runs {RUN}, collapsed string")
