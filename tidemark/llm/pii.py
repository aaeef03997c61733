"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust the score.

DataFrame functions only. A pattern's matches come from regexp_extract_all and the text between them from split; their
lengths give the places, so a text is read twice by each pattern that occurs in it, and nothing is shuffled. Patterns
use possessive repeats and start-of-run tests, which change no match but keep the work linear in the text: a run of
characters that fails once is not tried again from its middle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of an IBAN by country (the registry of ISO 13616).
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def iban_pattern() -> str:
    """A country's IBAN ends at its length, so that words and numbers behind it are not taken in; other codes, at any length."""
    known = [rf"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, codes in IBAN_LENGTHS.items()]
    other = rf"(?!{'|'.join(IBAN_LENGTHS.values()).replace(' ', '|')})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}}+"
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join([*known, other])})(?![A-Za-z0-9])"


#: Fixed values. Patterns, in the order in which kinds are listed; iban is not among the base kinds.
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": iban_pattern(),
}
BASE = ("email", "ip", "card", "phone")
SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.5, "iban": 0.9}
#: Words near a span that speak for its kind, or against personal data.
FOR = {
    "email": r"\b(e-?mail|mail|contact|write)\b",
    "ip": r"\b(ip|address|host|server|login)\b",
    "card": r"\b(card|credit|debit|visa|mastercard|amex|payment|cvv)\b",
    "phone": r"\b(phone|tel|telephone|call|mobile|fax|sms|whatsapp)\b",
    "iban": r"\b(iban|bank|account|transfer|bic|swift)\b",
}
AGAINST = r"\b(version|isbn|example|order|serial|test|doi)\b"


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def letters(c: Column) -> Column:
    return F.filter(F.split(c, ""), lambda x: x != "")


def luhn(number: Column) -> Column:
    """True if the digits pass Luhn's test: every second digit from the right counts double, less 9 above 9."""

    def part(x: Column, i: Column) -> Column:
        d = x.cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2)

    return F.aggregate(F.transform(letters(F.reverse(number)), part), F.lit(0), lambda a, d: a + d) % 10 == 0


def mod97(iban: Column) -> Column:
    """True if an IBAN's check digits fit: its first four characters moved to the end, letters as 10 to 35, is 1 modulo 97."""
    s = F.regexp_replace(iban, " ", "")
    turned = F.concat(s.substr(F.lit(5), F.length(s)), s.substr(F.lit(1), F.lit(4)))

    def step(a: Column, x: Column) -> Column:
        v = F.when(x >= "A", F.ascii(x) - 55).otherwise(F.ascii(x) - 48)
        return (a * F.when(v > 9, 100).otherwise(10) + v) % 97

    return F.aggregate(letters(turned), F.lit(0), step) == 1


def confirmed(kind: str, m: Column) -> Column:
    if kind == "ip":
        small = lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.ltrim(p, F.lit("0")).try_cast("int"), F.lit(0)) <= 255)
        return F.forall(F.split(m, r"\."), small)
    if kind == "card":
        return F.length(digits(m)).between(14, 19) & luhn(digits(m))
    if kind == "phone":
        return F.length(digits(m)).between(10, 15)
    if kind == "iban":
        return mod97(m)
    return F.lit(True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value worked out once however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def placed(rows: Column) -> Column:
    """rows, an array of (gap, m, after), with the start of each m: gaps and matches follow one another from 0.

    A fold that appends copies what it has so far, so it goes by blocks of about the root of their number: the starts of
    blocks first, then each block from its start.
    """
    length = lambda x: F.length(x["gap"]) + F.length(x["m"])
    none = F.array().cast("array<struct<m:string,start:int,before:string,after:string>>")

    def blocks(rows: Column) -> Column:
        b = F.ceil(F.sqrt(F.size(rows))).cast("int")
        return F.transform(F.sequence(F.lit(0), ((F.size(rows) - 1) / b).cast("int")), lambda i: F.slice(rows, i * b + 1, b))

    def first(acc: Column, block: Column) -> Column:
        return F.struct((acc["at"] + F.aggregate(block, F.lit(0), lambda n, x: n + length(x))).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))

    def one(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        row = F.struct(x["m"].alias("m"), start.alias("start"), x["gap"].alias("before"), x["after"].alias("after"))
        return F.struct((start + F.length(x["m"])).alias("at"), F.concat(acc["out"], F.array(row)).alias("out"))

    def within(block: Column, start: Column) -> Column:
        return F.aggregate(block, F.struct(start.alias("at"), none.alias("out")), one, lambda acc: acc["out"])

    def by_blocks(found: Column) -> Column:
        starts = F.aggregate(found, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), first, lambda acc: acc["out"])
        return F.flatten(F.zip_with(found, starts, within))

    return let(let(rows, blocks), by_blocks)


def matches(kind: str, text: Column, reach: int) -> Column:
    """The kind's confirmed spans: array of (start, rank, kind, end, score); code points, end exclusive."""
    pattern = PATTERNS[kind]
    rank = list(PATTERNS).index(kind)
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,score:double>>")

    def scored(x: Column) -> Column:
        near = F.lower(F.concat(F.right(x["before"], F.lit(reach)), F.lit(" "), F.left(x["after"], F.lit(reach))))
        points = lambda near: F.lit(SCORE[kind]) + F.when(F.rlike(near, F.lit(FOR[kind])), 0.1).otherwise(0.0) - F.when(F.rlike(near, F.lit(AGAINST)), 0.3).otherwise(0.0)
        return F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), (x["start"] + F.length(x["m"])).alias("end"), F.round(let(near, points), 2).alias("score"))

    def spans(found: Column) -> Column:
        def rows(gaps: Column) -> Column:
            n = F.size(found)
            both = F.zip_with(F.slice(gaps, 1, n), found, lambda gap, m: F.struct(gap.alias("gap"), m.alias("m")))
            return F.zip_with(both, F.slice(gaps, 2, n), lambda x, after: F.struct(x["gap"].alias("gap"), x["m"].alias("m"), after.alias("after")))

        good = F.filter(placed(let(F.split(text, pattern, -1), rows)), lambda x: confirmed(kind, x["m"]))
        return F.when(F.size(found) > 0, F.transform(good, scored)).otherwise(none)

    seen = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+")), "ip": F.rlike(text, F.lit(r"[0-9]\.[0-9]"))}.get(kind, F.lit(True))
    return F.when(seen, let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)).otherwise(none)


def find_pii(docs: DataFrame, text_col: str = "text", reach: int = 40, least: float = 0.0) -> DataFrame:
    """docs with pii: array of (start, rank, kind, end, score), by start, then kind as PATTERNS lists them.

    reach: characters on either side, as far as the next match of the kind, in which context words count. least: spans that score lower are left out.
    A null or empty text has an empty array; whole texts are searched; other columns stay (an earlier pii is replaced).
    """
    text = F.coalesce(text_col, F.lit(""))
    spans = F.concat(*(matches(k, text, reach) for k in PATTERNS))
    return docs.withColumn("pii", F.array_sort(F.filter(spans, lambda x: x["score"] >= least)))


def digest(spans: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """kind:start:end of spans (of some kinds), comma-joined."""
    if kinds:
        spans = F.filter(spans, lambda x: x["kind"].isin(*kinds))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def document_pii(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores (of spans, in order) of every row of docs."""
    found = find_pii(docs.select("doc_id", "text")).drop("text")
    number = lambda k: F.size(F.filter("pii", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id",
        *(number(k) for k in BASE),
        F.sha2(digest(F.col("pii"), BASE), 256).alias("base_sha256"),
        digest(F.col("pii")).alias("spans"),
        F.array_join(F.transform("pii", lambda x: x["score"].cast("string")), ",").alias("scores"),
    )
