"""Byte-pair encoding by a dynamic program over prefixes, and decoding.

Every prefix of a word has one last token in its encoding. It is that token, among those that end the prefix, which may
follow the last token of the rest: no merge of lower rank reaches across the two. So one table of last tokens, filled
from left to right, holds the encodings of all prefixes, and following it back from the end gives the ids. The tokens
that end each prefix come from an automaton over the vocabulary. Time is linear in a word's length, however long.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import pieces
from .tokens import WORDS, byte_letters


class Known(dict):
    """Word -> its ids, for at most `room` words of at most 64 characters at a time."""

    def __init__(self, codec: Codec, room: int):
        super().__init__()
        self.codec, self.room = codec, room

    def __missing__(self, word: str) -> bytes:
        out = self.codec.encode_word(word)
        if len(word) <= 64:
            if len(self) >= self.room:
                self.clear()
            self[word] = out
        return out


class Codec:
    """Encodes and decodes with a byte-level BPE .json file. Tokens are strings of one Latin-1 character a byte."""

    def __init__(self, spec: str, room: int = 400_000):
        spec = json.loads(spec)
        model, split = spec["model"], spec["pre_tokenizer"]
        plain = not any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        added = spec["added_tokens"]
        if model["type"] != "BPE" or spec["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"] or not plain or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("a byte-level BPE file without normalizer and prefix space is needed, added tokens without options")
        letters = str.maketrans(byte_letters())
        self.ids = {t.translate(letters): i for t, i in model["vocab"].items()}
        self.bytes_of = {i: t.encode("latin-1") for t, i in self.ids.items()} | {t["id"]: t["content"].encode() for t in added}
        merges = (tuple(x.translate(letters) for x in (m if isinstance(m, list) else m.split(" "))) for m in model["merges"])
        self.ranks = {pair: k for k, pair in enumerate(merges)}
        self.compatible = lru_cache(1 << 18)(self.follows)
        self.made_of: dict[str, tuple[str, str]] = {}
        self.rank = {chr(b): -1 for b in range(256)}
        if any(b not in self.ids for b in self.rank):
            raise ValueError("each byte must be a token")
        for pair, k in self.ranks.items():  # a token counts if its own text is merged into it, by this pair
            a, b = pair
            if a in self.rank and b in self.rank and a + b not in self.rank and self.follows(a, b, k):
                self.rank[a + b], self.made_of[a + b] = k, pair
        self.tokens = ahocorasick.Automaton()
        for t in self.rank:
            self.tokens.add_word(t, t)
        self.tokens.make_automaton()
        self.words = regex.compile(WORDS)
        self.added = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in added}
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if added else None
        self.known = Known(self, room)

    def follows(self, a: str, b: str, below: float = float("inf")) -> bool:
        """Whether no merge of rank under `below` reaches across the two, each merged within itself.

        The two are taken apart again, the later merge first; of two equal ones the right one was later. While a part
        stands at the seam, a pair across it would have been merged if its rank came before the next merge of either.
        """
        ranks, rank, made_of = self.ranks, self.rank, self.made_of
        while True:
            if ranks.get((a, b), below) < below:
                return False
            x, y = rank[a], rank[b]
            if x > y:
                a, below = made_of[a][1], x
            elif y >= 0:
                b, below = made_of[b][0], y + 1
            else:
                return True

    def last_tokens(self, word: str) -> list[str]:
        """For each prefix but the empty one, the last token of its encoding."""
        last: list[str] = [""] * (len(word) + 1)
        for end, token in self.tokens.iter(word):
            j = end + 1
            if not last[j] and ((i := j - len(token)) == 0 or self.compatible(last[i], token)):
                last[j] = token
        return last

    def encode_word(self, word: str) -> bytes:
        """The ids of one pre-token, as little-endian unsigned 32-bit integers."""
        letters = word.encode().decode("latin-1")
        last, j, ids = self.last_tokens(letters), len(letters), []
        while j:
            ids.append(self.ids[last[j]])
            j -= len(last[j])
        return np.array(ids[::-1], "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        parts = self.cut.split(text) if self.cut and any(t in text for t in self.added) else [text]
        return b"".join(self.added[p] if i % 2 else b"".join(map(self.known.__getitem__, self.words.findall(p))) for i, p in enumerate(parts))

    def decode(self, ids: bytes) -> str:
        """The text of the ids; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def encode_decode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_tokens, ids (binary: little-endian unsigned 32-bit integers), decoded (string).

    Null and empty texts have no ids and decode to the empty text; null ids of rows stay; repeated rows give repeated
    results; an empty table gives an empty one; other columns of docs are ignored. Added tokens of the vocabulary (special
    strings) inside a text become their id, as the tokenizer's default has it. No shuffle: each text is encoded where it is
    read; the vocabulary file is read on the driver (its size is fixed) and broadcast.
    """
    with open(vocabulary, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codecs.get(vocabulary) or _codecs.setdefault(vocabulary, Codec(shared.value))
        for batch in pieces(batches, 256):
            ids = [codec.encode(t or "") for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array([codec.decode(x) for x in ids], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "n_tokens", "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, n_tokens long, ids binary, decoded string")
