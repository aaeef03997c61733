"""Token counts by byte-pair merging with a heap and a linked list.

Only counts leave the operator: a word's count is its number of bytes less the number of merges, so no identifiers are
looked up. Vocabulary files are read on the driver (size fixed by the vocabulary) and broadcast.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import pieces

#: The pre-tokenizer's pattern of byte-level BPE, with white space as Unicode defines it.
WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


def byte_letters() -> dict[str, str]:
    """Byte-level BPE writes each byte as a printable letter; maps those letters back to bytes, as Latin-1 characters."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): chr(b) for b in shown} | {chr(256 + k): chr(b) for k, b in enumerate(hidden)}


def load_vocabulary(path: str) -> tuple[dict[tuple[str, str], int], list[str]]:
    """Merge ranks (pairs of Latin-1 strings, one character a byte) and the added tokens of a byte-level BPE .json file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if spec["model"]["type"] != "BPE" or spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
        raise ValueError("a byte-level BPE file without normalizer and prefix space is needed")
    letters = str.maketrans(byte_letters())
    pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
    ranks = {(a.translate(letters), b.translate(letters)): k for k, (a, b) in enumerate(pairs)}
    return ranks, [t["content"] for t in spec["added_tokens"]]


def merged_length(symbols: str, ranks: dict[tuple[str, str], int]) -> int:
    """Symbols left once no adjacent pair has a rank: the lowest rank goes first, the leftmost of equal ones.

    A heap holds candidate pairs, a doubly linked list the living symbols; stale heap entries are skipped.
    """
    n = count = len(symbols)
    part: list[str | None] = list(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[pair], i, pair) for i, pair in enumerate(zip(symbols, symbols[1:], strict=False)) if pair in ranks]
    heapify(heap)
    while heap:
        _, i, (a, b) = heappop(heap)
        j = after[i]
        if part[i] != a or j >= n or part[j] != b:
            continue
        part[i], part[j] = a + b, None
        count -= 1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (rank := ranks.get(pair := (part[i], part[k]))) is not None:
                heappush(heap, (rank, i, pair))
        if (h := before[i]) >= 0 and (rank := ranks.get(pair := (part[h], part[i]))) is not None:
            heappush(heap, (rank, h, pair))
    return count


class Counts(dict):
    """Word -> tokens, for at most `room` words of at most 64 characters at a time."""

    def __init__(self, ranks: dict, room: int):
        super().__init__()
        self.ranks, self.room = ranks, room

    def __missing__(self, word: str) -> int:
        n = merged_length(word.encode().decode("latin-1"), self.ranks)
        if len(word) <= 64:
            if len(self) >= self.room:
                self.clear()
            self[word] = n
        return n


class Counter:
    """Counts the tokens of texts; its cache lives as long as its task."""

    def __init__(self, ranks: dict, added: list[str], room: int = 1_500_000):
        self.words, self.count = regex.compile(WORDS), Counts(ranks, room)
        self.added = added
        self.cut = regex.compile("|".join(regex.escape(t) for t in sorted(added, key=len, reverse=True))) if added else None

    def __call__(self, text: str) -> int:
        parts = [text]
        if self.cut and any(t in text for t in self.added):
            parts = self.cut.split(text)
        return len(parts) - 1 + sum(sum(map(self.count.__getitem__, self.words.findall(p))) for p in parts)


_counters: dict[str, Counter] = {}


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Null and empty texts have 0 bytes and 0 tokens; null ids stay; repeated rows give repeated results; an empty table
    gives an empty one; other columns of docs are ignored. Added tokens of the vocabulary (special strings) inside a
    text count as one token, as the tokenizer's default has it. No shuffle: every text is counted where it is read.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(load_vocabulary(vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counters.get(vocabulary) or _counters.setdefault(vocabulary, Counter(*shared.value))
        for batch in pieces(batches):
            texts = [x or "" for x in batch.column(1).to_pylist()]
            tokens = [counter(t) for t in texts]
            sizes = [len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())], [id_col, "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(count, f"{id_col} {kind}, n_bytes long, n_tokens long, over_limit boolean")
