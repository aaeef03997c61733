"""Main text of web pages by equivalence-class template deduction.

Pages of one host are made from a template. A token is an element's start at its path (tags, with the class or id of
each), or a block of text at its path. Tokens whose occurrence vectors over the host's pages are equal form a class. The
elements that most pages hold once are the template's frame; they nest by their paths and are the slots. The slot that
holds the article is chosen once for a host. Within it, boilerplate elements (menus, adverts, ...) are cut, and so is the
fixed text: blocks that most pages hold and that are of a class with an element of the frame, or that nearly all of many
pages hold. What remains is extracted, block by block. A page that lacks the slot is read from the body down.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pieces, salted_join, written

#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|textarea|title|noscript|template|iframe|svg|xmp"
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
BOILERPLATE = frozenset("head nav header footer aside form button select option label menu dialog fieldset object canvas audio video input".split())
#: Words in a class, id or role that name boilerplate wherever they stand in the name,
STRONG = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promos nav navbar navigation breadcrumb breadcrumbs sidebar masthead cookie cookies consent popup modal"
    " newsletter subscribe disqus comment comments replies commentlist widget pager pagination complementary contentinfo".split()
)
#: that do so alone or with words of layout, for an article may be about them ("social-history", "search-theory"),
WEAK = frozenset(
    "banner banners promotion menu header footer notice notices subscription signup login share sharing social related copyright search"
    " reviews respond discussion feedback reactions".split()
)
#: and the words of layout.
LAYOUT = frozenset(
    "bar box form button buttons btn link links list icons icon container wrapper wrap section block area panel top bottom left right site page main global primary secondary posts post articles"
    " stories media inner outer row col column content area item items user users reader readers your leave new all the module component region group input field results toggle dropdown sub mini sticky fixed legal gdpr privacy".split()
)
ARTICLE = re.compile(r"(?:^|[\s_-])(?:article|post|entry|story|content|main|body)(?:$|[\s_-])", re.I)
#: Comments, elements without markup inside, tags, declarations. What the end of the page breaks off goes as far as that, so
#: every place is read once: quotes that close nothing are plain characters, and nothing is tried again.
MARKUP = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*+)((?:\"[^\"]*\"|'[^']*'|[^>])*+)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S | re.I
)
HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?=[\s/]|$)|style\s*=\s*(?:\"[^\"]*?|'[^']*?|)(?:display\s*:\s*none|visibility\s*:\s*hidden)|aria-hidden\s*=\s*[\"']?true)", re.I)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
#: Elements that a start tag closes when they are open.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var".split())


#: Browsers nest no deeper: what opens below is a sibling of the deepest element. So a page's paths take memory in its length.
DEEPEST = 512


def events(page: str) -> Iterator[tuple[str, str, str]]:
    """("open", path, tag), ("close", path, tag), ("text", path, text) of a page; paths join the open elements by '/'.

    Mis-nested pages are read as browsers do in the main: an end tag closes the nearest open element of its name, a
    block start closes an open p, the end of the page closes all. Inline elements do not belong to paths, but for those
    that are boilerplate by their class or hidden: their text has their path, and they part no block.
    """
    stack: list[tuple[str, str]] = []
    known: dict[str, str] = {}  # one string for a path, however often it comes
    opened: dict[str, int] = {}  # how many elements of a tag are open
    at = 0
    for m in MARKUP.finditer(page):
        if m.start() > at:
            yield "text", stack[-1][1] if stack else "", page[at : m.start()]
        at = m.end()
        tag = (m.group(3) or "").lower()
        if not tag:
            continue
        if tag == "br" or (tag in VOID and tag not in BLOCKS):
            if tag == "br":
                yield "text", stack[-1][1] if stack else "", " "
            continue
        if m.group(2):
            if opened.get(tag):
                while True:
                    t, path = stack.pop()
                    opened[t] -= 1
                    if t not in INLINE:
                        yield "close", path, t
                    if t == tag:
                        break
            continue
        marks = "".join("." + re.sub(r"[/\s]+", " ", next(filter(None, g[1:]), "")).strip() for g in ATTRIBUTE.findall(m.group(4)))
        if HIDDEN.search(m.group(4)):
            marks += f".{UNSEEN}"
        # Within an inline element that is left out, others are kept count of, so that each end tag finds its own.
        if tag in INLINE and not is_noise(tag + marks) and not (stack and stack[-1][0] in INLINE):
            continue
        ends = CLOSES.get(tag, set()) | ({"p"} if tag in BLOCKS else set())
        while stack and (stack[-1][0] in ends or (tag in BLOCKS and stack[-1][0] in INLINE)):
            t, path = stack.pop()
            opened[t] -= 1
            if t not in INLINE:
                yield "close", path, t
        if len(stack) >= DEEPEST:
            t, path = stack.pop()
            opened[t] -= 1
            if t not in INLINE:
                yield "close", path, t
        path = f"{stack[-1][1] if stack else ''}/{tag}{marks}"
        path = known.setdefault(path, path)
        if tag not in INLINE:
            yield "open", path, tag
        if tag in VOID or m.group(4).rstrip().endswith("/") and tag not in BLOCKS:
            if tag not in INLINE:
                yield "close", path, tag
        else:
            stack.append((tag, path))
            opened[tag] = opened.get(tag, 0) + 1
    if at < len(page):
        yield "text", stack[-1][1] if stack else "", page[at:]
    for t, path in reversed(stack):
        if t not in INLINE:
            yield "close", path, t


UNSEEN = "~unseen"  # the mark of an element that a style or attribute hides


def names_noise(name: str) -> bool:
    """Whether one class, id or role names boilerplate."""
    words = re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower())
    if any(w in STRONG for w in words):
        return True
    return any(w in WEAK for w in words) and all(w in WEAK or w in LAYOUT for w in words)


@lru_cache(100_000)
def is_noise(step: str, in_article: bool = False) -> bool:
    """Whether an element is boilerplate, in an article or elsewhere: a header within an article is the article's own."""
    tag, _, marks = step.partition(".")
    if UNSEEN in marks or (tag in BOILERPLATE and not (in_article and tag == "header")):
        return True
    return tag not in ("html", "body", "article", "main") and any(map(names_noise, re.split(r"[.\s]+", marks)))


def noisy(path: str, spared: frozenset[str] = frozenset()) -> bool:
    """True if the path leads through a boilerplate element that is not spared."""
    end, in_article = 0, False
    for step in path.split("/")[1:]:
        end += 1 + len(step)
        if is_noise(step, in_article) and path[:end] not in spared:
            return True
        in_article = in_article or step.partition(".")[0] == "article"
    return False


def above(path: str) -> frozenset[str]:
    """The element at path and all that contain it."""
    return frozenset(path[: m.start()] for m in re.finditer("/|$", path) if m.start())


def wrappers(found: list[tuple[str, str, str]]) -> frozenset[str]:
    """Elements of a page that no word in their class, id or role (nor a form that wraps all) makes boilerplate.

    Those are what contains the article: the article or main element with the most text, if all others are boilerplate
    as well or it has most of the page's text; in a page without one, what has most of the page's text, if boilerplate
    has most of it. Text in other elements that are boilerplate by their tag counts for nothing.
    """
    texts: dict[str, int] = {}
    for kind, path, x in found:
        if kind == "text" and (size := len(x.strip())):
            texts[path] = texts.get(path, 0) + size
    chars: dict[str, int] = {}
    total = clean = 0
    for path, size in texts.items():
        if any((t := step.partition(".")[0]) in BOILERPLATE and t != "form" for step in path.split("/")):
            continue
        total += size
        clean += 0 if noisy(path) else size
        for p in above(path):
            chars[p] = chars.get(p, 0) + size
    if clean == total:
        return frozenset()
    articles = sorted((-n, p) for p, n in chars.items() if p.rpartition("/")[2].partition(".")[0] in ("article", "main"))
    if articles:
        size, best = articles[0]
        return above(best) if noisy(best) and (-size * 2 > total or all(noisy(p) for _, p in articles)) else frozenset()
    return frozenset(p for p, n in chars.items() if n * 2 > total) if clean * 2 < total else frozenset()


def host(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1), F.lit("")))


def text_token(path: str, text: str) -> str:
    return "#" + blake2b(f"{path}\0{text}".encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


def squeezed(pieces: list[str]) -> str:
    return " ".join(html.unescape("".join(pieces)).split())


TOKENS = "host string, page long, token string, n long, chars long"


def page_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host, page (its hash), html -> for each page its tokens outside boilerplate: how often each occurs, and the
    characters of text within. The token '' stands for the page; a page without elements and text has none."""
    for batch in pieces(batches):
        rows: list[tuple[str, int, str, int, int]] = []
        for name, number, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            n: dict[str, int] = {}
            chars: dict[str, int] = {}
            found = list(events(page or ""))
            spared = wrappers(found)
            cut: dict[str, bool] = {}
            now: list[str] = []
            at = ""

            def close() -> None:
                if text := squeezed(now):
                    token = text_token(at, text)
                    n[token] = n.get(token, 0) + 1
                    chars[token] = chars.get(token, 0) + len(text)
                    for path in ("", *above(at)):
                        chars[path] = chars.get(path, 0) + len(text)
                now.clear()

            for kind, path, x in found:
                if path not in cut:
                    cut[path] = noisy(path, spared)
                if kind != "text":
                    close()
                    if kind == "open" and not cut[path]:
                        n[path] = n.get(path, 0) + 1
                elif not cut[path]:
                    now.append(x)
                    at = path
            close()
            if n:
                n[""] = 1
            rows += [(name, number, token, k, chars.get(token, 0)) for token, k in n.items()]
            if len(rows) >= 20_000:
                yield token_batch(rows)
                rows = []
        if rows:
            yield token_batch(rows)


def token_batch(rows: list[tuple[str, int, str, int, int]]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["host", "page", "token", "n", "chars"])


def templates(pages: DataFrame) -> DataFrame:
    """pages(host, html) -> host, slot: the path of the frame's element that holds the article (null for the whole page),
    and fixed: the tokens of the template's text. Pages of a host that are copies of each other count as one.

    Per host and token: the pages that have it, those that have it once, and a XOR of hashes of page and count, which
    stands for the occurrence vector. The slot: the shallowest article or main element, else the deepest named as
    content, else the deepest element that holds nine tenths of the host's text. Text is fixed by its class from 5 pages
    on, by nine tenths of the pages from 10 on, and only where it is less than half of the host's text: pages that are
    near copies of each other are no template.
    """
    tokens = pages.select("host", F.xxhash64("html").alias("page"), "html").mapInArrow(page_tokens, TOKENS).dropDuplicates(["host", "token", "page"])
    seen = tokens.groupBy("host", "token").agg(F.count("*").alias("pages"), F.count_if(F.col("n") == 1).alias("once"), F.bit_xor(F.xxhash64("page", "n")).alias("vector"), F.sum("chars").alias("chars"))
    seen = written(seen.where("pages > 1 or token not like '#%'"), "tokens")
    total = seen.where("token = ''").select("host", F.col("pages").alias("total"), F.col("chars").alias("all_chars"))
    likely = seen.where("token != ''").join(total, "host").where("pages * 2 > total")  # most pages have it
    frame = likely.where("once * 2 > total and token like '/%'")
    classes = frame.select("host", "vector").distinct().withColumn("framed", F.lit(True))
    fixed = likely.where("token like '#%'").join(classes, ["host", "vector"], "left").where("total >= 5 and framed or total >= 10 and pages * 10 >= total * 9")
    # A page has few such blocks, and each is on most pages, so a host has few.
    fixed = fixed.groupBy("host").agg(F.collect_list("token").alias("fixed"), F.sum("chars").alias("cut"), F.max("all_chars").alias("of")).where("cut * 2 < of").select("host", "fixed")
    steps = F.size(F.split("token", "/")) - 1
    last = F.element_at(F.split("token", "/"), -1)
    tag = F.substring_index(last, ".", 1)
    named = F.rlike(last, F.lit(r"(?i)[. _-](article|post|entry|story|content|main)($|[. _-])"))
    frame = frame.withColumns({"depth": steps, "is_article": tag.isin("article", "main"), "named": named & ~tag.isin("html", "body")})
    most = frame.groupBy("host").agg(F.max("chars").alias("most"))
    frame = frame.join(most, "host").where(F.col("chars") * 10 >= F.col("most") * 9)
    kind = F.when(F.col("is_article"), 2).when(F.col("named"), 1).otherwise(0)
    order = F.struct(kind, F.when(F.col("is_article"), -F.col("depth")).otherwise(F.col("depth")), "token")
    return frame.groupBy("host").agg(F.max_by("token", order).alias("slot")).join(fixed, "host", "full")


def slot_text(page: str, slot: str, fixed: frozenset[str] = frozenset()) -> str:
    """Text of the page within the slot (without one: of its article elements, else of its body), by blocks; fixed: left out."""
    found = list(events(page))
    spared = wrappers(found) | above(slot)
    if not slot or not any(k == "open" and p == slot for k, p, _ in found):
        inner = sorted({p for k, p, t in found if k == "open" and t in ("article", "main") and not noisy(p, spared)}, key=len)
    else:
        inner = [slot]
        leaf = slot.rsplit("/", 1)[-1].partition(".")[0]
        if leaf not in ("article", "main"):
            inner = sorted({p for k, p, t in found if k == "open" and t in ("article", "main") and p.startswith(slot + "/") and not noisy(p, spared)}, key=len) or inner
    blocks: list[str] = []
    now: list[str] = []
    at = ""

    def close() -> None:
        if (text := squeezed(now)) and not (fixed and text_token(at, text) in fixed):
            blocks.append(text)
        now.clear()

    inside: dict[str, bool] = {}
    for kind, path, x in found:
        if kind != "text":
            close()
        else:
            if path not in inside:
                inside[path] = not noisy(path, spared) and (not inner or any(path == s or path.startswith(s + "/") for s in inner))
            if inside[path]:
                now.append(x)
                at = path
    close()
    return "\n".join(blocks)


def page_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every row of pages(page_id, url, html).

    A null or empty html gives an empty text; a null url belongs to the host ''. Rows that repeat are rows of their own;
    an empty table gives an empty one; other columns are ignored. A host with any number of pages is dealt over tasks.
    """
    named = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"))
    slots = written(templates(named.where("html is not null")), "templates")
    joined = salted_join(named, slots, "host", F.struct("page_id", "url"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            texts = [slot_text(h or "", s or "", frozenset(f or ())) for h, s, f in zip(*(b.column(i).to_pylist() for i in (2, 3, 4)), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return joined.select("page_id", "url", "html", "slot", "fixed").mapInArrow(extract, f"page_id {kind}, url string, text string, n_chars long")
