"""Words of many texts at once, as 64-bit hashes in numpy arrays.

A word is a run of bytes other than space and \\x09-\\x0D, with A-Z in lower case. Its hash is a polynomial in its
bytes modulo 2**64, taken from one running sum over all texts, then mixed. With `bare`, all of ASCII but letters and
digits parts words, so that punctuation makes no difference.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BARE = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def mixed(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i below n; kept up to 1 MB of text."""
    if len(_powers[0]) >= n:
        return _powers[0][:n], _powers[1][:n]
    out = []
    for b in (_BASE, _INVERSE):
        p = np.full(n, b, U)
        p[0] = 1
        out.append(np.cumprod(p, dtype=U))
    if n <= 1 << 20:
        _powers[:] = out
    return out[0], out[1]


def split_words(texts: list[bytes], bare: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, offsets): text i has words offsets[i]:offsets[i+1]."""
    data = np.frombuffer(b"\n".join([*texts, b""]).lower(), np.uint8)
    ends_at = np.cumsum([len(t) + 1 for t in texts])
    gap = (_BARE if bare else _SPACE)[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True])).view(np.int8)))
    start, end = edge[0::2], edge[1::2]
    offsets = np.concatenate(([0], np.searchsorted(start, ends_at)))
    if not len(start):
        return np.zeros(0, U), offsets
    up, down = powers(len(data) + 1)
    total = np.concatenate((np.zeros(1, U), np.cumsum((data.astype(U) + U(1)) * up[: len(data)], dtype=U)))
    return mixed((total[end] - total[start]) * down[start] + (end - start).astype(U)), offsets


def shingles(words: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Each text's distinct shingles of `size` words, sorted; all its words as one shingle where it has fewer, none without words."""
    n = len(words)
    odd = [U(pow(0xD1342543DE82EF95, k + 1, 1 << 64)) for k in range(size)]
    run = np.zeros(max(0, n - size + 1), U)
    for k in range(size):
        run += words[k : k + len(run)] * odd[k]
    run = mixed(run)
    out = []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        if b - a >= size:
            out.append(np.unique(run[a : b - size + 1]))
        elif b > a:
            short = np.full(1, (int(b - a) * _BASE) & ((1 << 64) - 1), U)
            for k in range(b - a):
                short += words[a + k : a + k + 1] * odd[k]
            out.append(mixed(short))
        else:
            out.append(run[:0])
    return out


def blocks(texts: list[bytes], most: int = 1 << 18) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, texts) in runs of about `most` bytes; a longer text is a run of its own."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield first, texts[first:]
