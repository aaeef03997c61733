"""Secret scans by one combined automaton.

Rules are written as small expressions over byte sets: a head of a fixed length (or several) and a tail. The heads of all
rules are compiled together by subset construction and minimised (Moore), each tail likewise. What all these do beside
each other is then made one automaton: its states are the sets of one head state and the states of the tails under way,
as far as any text reaches them, minimised again into one transition array over classes of bytes. A scan moves one state,
one look-up a byte, whatever number of rules is under way. Lengths are not counted in states: a state tells which heads
and which matches have just ended there, and the scan keeps their places.

Two properties make this exact, and both hold for runs and for all rules here. A tail that accepts goes on accepting until
it can go no further (checked when the automaton is built), so a match ends where its tail does. No head of a rule ends
within its tail after the last place where that accepts, so a match in progress hides no later one of its rule.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import pieces

# Expressions: a frozenset of bytes, or ("seq", ...), ("alt", ...), ("star", x).
DIGITS, LOWER, UPPER = (frozenset(range(ord(a), ord(b) + 1)) for a, b in ("09", "az", "AZ"))


def any_of(chars: str) -> frozenset:
    return frozenset(chars.encode())


def seq(*x):
    return ("seq", *x)


def alt(*x):
    return ("alt", *x)


def star(x):
    return ("star", x)


def plus(x):
    return seq(x, star(x))


def maybe(x):
    return alt(x, seq())


def word(s: str, either_case: bool = False):
    return seq(*(frozenset({*c.lower().encode(), *c.upper().encode()} if either_case else c.encode()) for c in s))


def times(n: int, x):
    return seq(*[x] * n)


_SPACES, _QUOTE = star(any_of(" ")), maybe(any_of("\"'"))
_VALUE = DIGITS | LOWER | UPPER | any_of("+/_.=-")
_ID = DIGITS | LOWER | UPPER
_HEX = DIGITS | any_of("abcdef")
#: Each rule's heads (with their lengths) and its tail, in the order in which kinds are listed.
HEADS = {
    "assign": [(word(w, either_case=True), len(w)) for w in ("password", "passwd", "secret", "token", "apikey", "api_key")],
    "access": [(word("AKIA"), 4)],
    "hex": [(times(16, _HEX), 16)],
    "github": [(seq(word("gh"), any_of("pousr"), word("_")), 4)],
    "slack": [(seq(word("xox"), any_of("abprs"), word("-")), 5)],
    "google": [(word("AIza"), 4)],
    "pem": [(word("-----BEGIN "), 11)],
}
TAILS = {
    "assign": seq(_QUOTE, _SPACES, any_of(":="), _SPACES, _QUOTE, plus(_VALUE)),
    "access": plus(DIGITS | UPPER),
    "hex": star(_HEX),
    "github": plus(_ID),
    "slack": plus(_ID | any_of("-")),
    "google": plus(_ID | any_of("_-")),
    "pem": seq(star(UPPER | any_of(" ")), word("PRIVATE KEY-----")),
}
BASE = ("assign", "access", "hex")
#: The least length of a match that counts (for assign, that of its value, is checked apart).
LEAST = {"access": 18, "hex": 16, "github": 40, "slack": 15, "google": 39}


class Automaton:
    """A minimal deterministic automaton of some rules. next: flat array, state * 256 + byte -> state * 256.

    anywhere: a match may start at any byte; else only at the first. Accepting states are numbered last, from `accept` on
    (times 256); rules[state] tells which rules end there. Without `anywhere`, state 0 is dead.
    """

    def __init__(self, rules: dict[object, object], anywhere: bool):
        moves: list[list[tuple[frozenset, int]]] = []
        free: list[list[int]] = []

        def state() -> int:
            moves.append([])
            free.append([])
            return len(moves) - 1

        def build(x, a: int) -> int:
            """Adds x after state a; its end."""
            if isinstance(x, frozenset):
                b = state()
                moves[a].append((x, b))
                return b
            if x[0] == "seq":
                for y in x[1:]:
                    a = build(y, a)
                return a
            if x[0] == "alt":
                b = state()
                for y in x[1:]:
                    free[build(y, a)].append(b)
                return b
            start, end = state(), state()
            free[a].append(start)
            free[start].append(end)
            free[build(x[1], start)].append(start)
            return end

        first = state()
        ends = {}
        for name, x in rules.items():
            start = state()
            free[first].append(start)
            ends[build(x, start)] = name

        def closed(states) -> frozenset:
            todo, seen = list(states), set(states)
            while todo:
                for b in free[todo.pop()]:
                    if b not in seen:
                        seen.add(b)
                        todo.append(b)
            return frozenset(seen)

        # Bytes that no rule tells apart move alike.
        sets = {s for m in moves for s, _ in m}
        kinds: dict[tuple, list[int]] = {}
        for byte in range(256):
            kinds.setdefault(tuple(byte in s for s in sets), []).append(byte)
        groups = list(kinds.values())
        origin = closed([first])
        index = {frozenset(): 0, origin: 1}
        table, todo = [[0] * len(groups)], [origin]
        while todo:
            now = todo.pop(0)
            row = []
            for g in groups:
                to = {b for a in now for s, b in moves[a] if g[0] in s}
                to = closed(to | set(origin)) if anywhere else closed(to)
                if to not in index:
                    index[to] = len(index)
                    todo.append(to)
                row.append(index[to])
            table.append(row)
        if anywhere:
            table[0] = table[1]
        named = [frozenset(ends[a] for a in s if a in ends) for s in index]
        # Moore: split classes until members move alike.
        labels = {x: k for k, x in enumerate(dict.fromkeys(named))}
        part = [labels[x] for x in named]
        while True:
            keys = [(part[s], *(part[t] for t in table[s])) for s in range(len(table))]
            names = {k: i for i, k in enumerate(dict.fromkeys(keys))}
            if len(names) == len(set(part)):
                break
            part = [names[k] for k in keys]
        sample = {c: s for s, c in reversed(list(enumerate(part)))}
        order = sorted(sample, key=lambda c: (bool(named[sample[c]]), c != part[0], c))
        number = {c: i for i, c in enumerate(order)}
        self.rules = [named[sample[c]] for c in order]
        self.accept = 256 * next(i for i, r in enumerate([*self.rules, True]) if r)
        self.start = 256 * number[part[1]]
        self.next = [0] * (256 * len(order))
        for c in order:
            for g, to in zip(groups, table[sample[c]], strict=True):
                for byte in g:
                    self.next[256 * number[c] + byte] = 256 * number[part[to]]


class Combined:
    """All rules, heads and tails, in one minimal automaton.

    next: flat list, state * width + class of a byte -> state * width; classes: the class of each byte. States from `loud`
    on (times width) have events: (rule, length of its head) where a head ends, (rule, 0) where a match ended at the byte
    before. going[state]: the rules whose match would end with the text.
    """

    def __init__(self, heads: dict[str, list], tails: dict[str, object]):
        named = {(rule, k, length): x for rule, found in heads.items() for k, (x, length) in enumerate(found)}
        head, rules = Automaton(named, anywhere=True), list(tails)
        tail = [Automaton({rule: tails[rule]}, anywhere=False) for rule in rules]
        for rule, x in zip(rules, tail, strict=True):
            if any(0 < t < x.accept for t in x.next[x.accept :]):
                raise ValueError(f"the tail of {rule} must accept until it ends")
        found = [sorted({(rules.index(rule), length) for rule, _, length in names}) for names in head.rules]
        kinds: dict[tuple, int] = {}
        of_byte = [kinds.setdefault(tuple(tuple(x.next[byte::256]) for x in (head, *tail)), len(kinds)) for byte in range(256)]
        byte_of = [of_byte.index(k) for k in range(len(kinds))]
        self.classes, self.width = bytes(of_byte), len(kinds)

        def move(state, byte):
            h, under, _ = state
            h, under, events = head.next[h + byte], list(under), []
            for r, t in enumerate(under):
                if t:
                    under[r] = tail[r].next[t + byte]
                    if not under[r] and t >= tail[r].accept:
                        events.append((r, 0))
            for r, length in found[h >> 8]:
                if not under[r]:
                    under[r] = tail[r].start
                    events.append((r, length))
            return h, tuple(under), tuple(events)

        first = (head.start, (0,) * len(rules), ())
        index, todo, table = {first: 0}, [first], []
        for state in todo:  # grows as states are found
            row = [move(state, byte) for byte in byte_of]
            for to in row:
                if to not in index:
                    index[to] = len(index)
                    todo.append(to)
            table.append([index[to] for to in row])
        self.reached = len(todo)  # before minimising
        ends = [tuple(r for r, t in enumerate(under) if t and t >= tail[r].accept) for _, under, _ in todo]
        labels = [(events, end) for (_, _, events), end in zip(todo, ends, strict=True)]
        names = {x: k for k, x in enumerate(dict.fromkeys(labels))}
        table, part, classes = np.array(table), np.array([names[x] for x in labels]), 0
        while classes < part.max() + 1:  # Moore: split classes until members move alike
            classes = part.max() + 1
            part = np.unique(np.column_stack([part, part[table]]), axis=0, return_inverse=True)[1].ravel()
        _, sample = np.unique(part, return_index=True)
        order = sorted(range(len(sample)), key=lambda c: (bool(labels[sample[c]][0]), c))
        number = np.empty(len(order), dtype=np.int64)
        number[order] = np.arange(len(order))
        self.states, self.start = len(order), int(number[part[0]]) * self.width
        self.next = (number[part[table[sample[order]]]] * self.width).ravel().tolist()
        self.loud = self.width * sum(not labels[sample[c]][0] for c in order)
        self.events = [[(rules[r], length) for r, length in labels[sample[c]][0]] for c in order]
        self.going = [[rules[r] for r in labels[sample[c]][1]] for c in order]


class Scanner:
    def __init__(self):
        self.automaton = Combined(HEADS, TAILS)
        self.rank = {rule: i for i, rule in enumerate(HEADS)}

    def __call__(self, data: bytes) -> list[tuple[int, int, str, int]]:
        """(start, rank of the kind, kind, end) of every secret, in order; bytes."""
        m = self.automaton
        step, loud, width, s = m.next, m.loud, m.width, m.start
        since: dict[str, int | None] = {}  # rule -> where its last head began; None if that overlaps its last match
        done: dict[str, int] = {}  # rule -> end of its last match
        out: list[tuple[str, int, int]] = []
        for i, kind in enumerate(data.translate(m.classes)):
            s = step[s + kind]
            if s >= loud:
                for rule, length in m.events[s // width]:
                    if length:
                        start = i + 1 - length
                        since[rule] = start if start >= done.get(rule, 0) else None
                    elif since[rule] is not None:
                        done[rule] = i
                        out.append((rule, since[rule], i))
        out += [(rule, since[rule], len(data)) for rule in m.going[s // width] if since[rule] is not None]
        return sorted((a, self.rank[k], k, b) for k, a, b in out if b - a >= LEAST.get(k, 0) and (k != "assign" or _value_length(data, a, b) >= 12))


def _value_length(data: bytes, start: int, end: int) -> int:
    """Length of what an assignment gives: after the name, quote, spaces, sign, spaces and quote."""
    at = next(i for i in range(start, end) if data[i] in b":=") + 1
    while data[at] == 0x20:
        at += 1
    return end - at - (data[at] in b"\"'")


_scanner: list[Scanner] = []


def secret_spans(docs: DataFrame) -> DataFrame:
    """doc_id, secrets (array of kind, start, end; code points, end exclusive; by start, then kind as RULES lists them).

    One row per row of docs; null and empty texts have an empty array; nothing is shuffled; other columns are ignored.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not _scanner:
            _scanner.append(Scanner())
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in pieces(batches):
            rows = []
            for data in batch.column(1).cast(pa.binary()).to_pylist():
                row, at, points = [], 0, 0
                for start, _, name, end in _scanner[0](data or b""):
                    points, at = points + len(data[at:start].decode(errors="ignore")), start
                    row.append({"kind": name, "start": points, "end": points + end - start})
                rows.append(row)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], ["doc_id", "secrets"])

    return docs.select("doc_id", "text").mapInArrow(scan, "doc_id long, secrets array<struct<kind:string,start:long,end:long>>")


def document_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row of docs."""
    from pyspark.sql import functions as F

    from .pii import digest

    number = lambda k: F.size(F.filter("secrets", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return secret_spans(docs).select(
        "doc_id", *(number(k) for k in BASE), F.sha2(digest(F.col("secrets"), BASE), 256).alias("base_sha256"), digest(F.col("secrets")).alias("spans")
    )
