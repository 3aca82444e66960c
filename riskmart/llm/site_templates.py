"""Main text of web pages by removal of site templates.

1. Every page is parsed once into text blocks. Each element, in the article or not, has a
   hash of its subtree: tag, class, id and text.
2. Spark counts, per host, in how many different contents each subtree occurs; a content is
   the whole text of a page, so copies of a page count once. A subtree in ``LEAST_PAGES``
   contents belongs to the template. What is text by its tag (``FLOW``: paragraphs, headings,
   list items and so on) may well be repeated by an author, so it also needs ``PAGE_SHARE`` of its
   host's contents, and within an article ``LEAST_FLOW_PAGES`` and ``SITE_SHARE`` of them.
3. Blocks inside a template subtree are deleted, as is what markup itself marks as no
   content (navigation, forms, adverts, comments and so on, by tag, role, class or id).

Where a page marks its article (``article``, ``main`` or that role), the text is what is left
in there. Stories that share most of their text on some pages of a host are no template: if an
article would lose more than half of its text, it only loses subtrees in ``SITE_SHARE`` of the
host's contents, and nothing if these are all it has. Class words mark neither an article nor
what lies around the only article of a page, unless they are those of comments and adverts. Other
pages give all blocks of the body that survive.

Text is what a reader sees: character references decoded, white space of a block turned
into one space, blocks trimmed and joined by one space in page order.

Defined cases: NULL and empty pages give an empty text; a NULL or odd url has the empty
host; unclosed and stray tags are tolerated; repeated rows each give a text; other columns are
not read.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Collection
from hashlib import blake2b
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.arrays import pieces
from riskmart.llm.common import stored

LEAST_PAGES = 3
LEAST_FLOW_PAGES = 5
PAGE_SHARE = 0.02
SITE_SHARE = 0.5

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|iframe|svg|xmp)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)>"
    r"|<[!?][^>]*>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/>]|\Z)", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: These do not part the text around them.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr img".split()
)
NO_CONTENT = frozenset(
    "head nav footer aside form script style noscript template textarea title iframe svg button select dialog menu"
    " object canvas audio video map applet".split()
)
NO_CONTENT_ROLES = frozenset(
    "navigation banner complementary contentinfo search form alert alertdialog dialog menu menubar toolbar".split()
)
#: Words in a class or an id that mark what is no content.
NO_CONTENT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent"
    " gdpr notice notification popup modal overlay newsletter subscribe subscription sidebar comment comments reply"
    " replies respond disqus share sharing social related recommended widget breadcrumb breadcrumbs menu nav navbar"
    " navigation footer login signup masthead".split()
)
#: Those of them that mark no content even around or on an article.
NEVER_CONTENT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion comment comments reply replies"
    " respond disqus related recommended".split()
)
#: Only outside the article, where these are the page's own.
HEADER_NAMES = frozenset("header topbar".split())
#: An open element of these closes at the start of the ones named.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",),
}
LIST_LIMITS = frozenset("ul ol dl table body article main section div".split())
ENDS_PARAGRAPH = frozenset(
    "p div ul ol dl table article section main aside header footer nav form h1 h2 h3 h4 h5 h6 blockquote pre hr figure"
    " address fieldset details".split()
)
#: Text of the page's author, not a part of the site, if nothing else is known.
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th blockquote pre figure figcaption caption".split())

#: Where an element lies. Of what class words drop, an article can be the only one of its page.
DROPPED, DROPPED_BY_NAME, BODY, ARTICLE, NAMED_ARTICLE = -2, -1, 0, 1, 2


class Element:
    __slots__ = ("tag", "name", "place", "parts", "first")

    def __init__(self, tag: str, name: str, place: int, first: int):
        self.tag, self.name, self.place = tag, name, place
        self.parts: list[bytes] = []
        self.first = first


def _hash(parts: list[bytes]) -> int:
    return int.from_bytes(blake2b(b"\0".join(parts), digest_size=8).digest(), "big", signed=True)


def _subtree_hash(element: Element) -> int:
    """Odd for ``FLOW``, else even."""
    own = _hash([element.tag.encode(), element.name.encode(), *element.parts])
    return own & ~1 | (element.tag in FLOW)


def _place(around: int, tag: str, unwanted: bool, names: Collection[str], article: bool) -> int:
    """Where an element lies that stands in a place; ``names`` are empty unless one of them drops it."""
    whole = tag in ("html", "body")
    if around == DROPPED:
        return around
    if unwanted and not whole:
        return DROPPED
    if names and not whole:
        final = around > BODY or not NEVER_CONTENT_NAMES.isdisjoint(names)
        return DROPPED if final else DROPPED_BY_NAME
    if article and around <= BODY:
        return ARTICLE if around == BODY else NAMED_ARTICLE
    return around


def parse(page: str) -> tuple[list[tuple[str, bool]], list[tuple[int, int, int]]]:
    """Blocks (text, inside an article) of a page, and subtrees as (hash, first block, blocks end)."""
    blocks: list[tuple[str, int]] = []
    subtrees: list[tuple[int, int, int]] = []
    stack = [Element("#page", "", BODY, 0)]
    text: list[str] = []
    open_tags: Counter[str] = Counter()

    def flush() -> None:
        if text:
            words = " ".join("".join(text).split())
            text.clear()
            top = stack[-1]
            if words and top.place >= BODY:
                blocks.append((words, top.place))
            if words:
                top.parts.append(words.encode("utf-8", "replace"))

    def close() -> None:
        flush()
        element = stack.pop()
        open_tags[element.tag] -= 1
        if element.parts:
            number = _subtree_hash(element)
            stack[-1].parts.append(number.to_bytes(8, "big", signed=True))
            subtrees.append((number, element.first, len(blocks)))

    def close_to(depth: int) -> None:
        while len(stack) > depth:
            close()

    # No tag starts behind the last ">"; looking for one would take quadratic time.
    at, limit = 0, page.rfind(">") + 1
    cut_off = False
    for token in TAG.finditer(page, 0, limit):
        if token.start() > at:
            text.append(entities.unescape(page[at : token.start()]))
        at = token.end()
        tag = token["tag"]
        if tag is None:
            raw = token["raw"]
            if at == limit and (raw is not None or token[0].startswith("<!--")):
                whole = token[0].endswith("-->") if raw is None else re.search(rf"</{raw}\s*>\Z", token[0], re.I)
                cut_off = not whole
            continue
        tag = tag.lower()
        if tag in INLINE and not token["end"] and not token["attrs"]:
            continue
        if tag in VOID:
            if tag not in INLINE:
                flush() if tag == "hr" else text.append(" ")
            continue
        if token["end"]:
            if tag in INLINE:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag == tag:
                        close_to(depth)
                        break
                    if stack[depth].tag not in INLINE:
                        break
                continue
            flush()
            if open_tags[tag]:
                depth = len(stack) - 1
                while stack[depth].tag != tag:
                    depth -= 1
                close_to(depth)
            continue
        values = {k.lower(): a or b or c or "" for k, a, b, c in ATTRIBUTE.findall(token["attrs"] or "")}
        name = f"{values.get('class', '')} {values.get('id', '')}".strip()
        role = values.get("role", "").lower()
        names = set(re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower())) if name else ()
        hidden = "hidden" in values or values.get("aria-hidden", "").lower() == "true" or (
            "none" in values.get("style", "") and re.search(r"display\s*:\s*none", values["style"], re.I) is not None
        )
        around = stack[-1].place
        article = tag in ("article", "main") or role == "main"
        unwanted = tag in NO_CONTENT or role in NO_CONTENT_ROLES or hidden
        if article and around <= BODY:
            # Here a word that is only a part of a class ("comments-open") says nothing.
            names = NEVER_CONTENT_NAMES.intersection(name.lower().split())
        named = bool(names and not NO_CONTENT_NAMES.isdisjoint(names))
        if around <= BODY and not article:
            unwanted = unwanted or tag == "header"
            named = named or bool(names and not HEADER_NAMES.isdisjoint(names))
        if tag in INLINE:
            if not (unwanted or named):
                continue
        if tag in ENDS_PARAGRAPH:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == "p":
                    close_to(depth)
                    break
                if stack[depth].tag not in INLINE:
                    break
        elif tag in CLOSES:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in CLOSES[tag]:
                    close_to(depth)
                    break
                if stack[depth].tag in LIST_LIMITS:
                    break
        flush()
        stack.append(Element(tag, name, _place(stack[-1].place, tag, unwanted, names if named else (), article), len(blocks)))
        open_tags[tag] += 1
    if at < len(page) and not cut_off:
        text.append(entities.unescape(page[at:]))
    close_to(1)
    flush()
    best = min((place for _, place in blocks if place), default=BODY)
    marked = [(t, place != BODY and place == best) for t, place in blocks if place in (BODY, best)]
    if any(place not in (BODY, best) for _, place in blocks):
        at = [*accumulate((int(place in (BODY, best)) for _, place in blocks), initial=0)]
        subtrees = [(number, at[first], at[end]) for number, first, end in subtrees]
    return marked, subtrees


def main_part(page: str) -> tuple[list[str], bool, list[tuple[int, int, int]]]:
    """Blocks of the article, or all if none is marked; whether one is; subtrees over these blocks."""
    blocks, subtrees = parse(page)
    inside = [t for t, marked in blocks if marked]
    if not inside:
        return [t for t, _ in blocks], False, subtrees
    at = [*accumulate((int(marked) for _, marked in blocks), initial=0)]
    return inside, True, [(number, at[first], at[end]) for number, first, end in subtrees]


def _parse(batches):
    types = [
        pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()),
        pa.list_(pa.int32()), pa.list_(pa.int32()),
    ]
    names = ["page_id", "url", "marked", "content", "blocks", "hashes", "firsts", "ends"]
    for piece in pieces(batches, "html"):
        rows = []
        for page in piece.column("html").to_pylist():
            blocks, marked, subtrees = main_part(page or "")
            content = _hash([b.encode("utf-8", "replace") for b in blocks])
            rows.append((marked, content, blocks, *([s[k] for s in subtrees] for k in range(3))))
        columns = [piece.column("page_id"), piece.column("url"), *(zip(*rows))]
        yield pa.record_batch(
            [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)], names=names
        )


def templates(parsed: DataFrame) -> DataFrame:
    """host and hash of the template subtrees, and whether they are all over the site (``site``)."""
    contents = parsed.groupBy("host").agg(F.count_distinct("content").alias("contents"))
    counted = (
        parsed.select("host", "content", F.explode("hashes").alias("hash"))
        .groupBy("host", "hash")
        .agg(F.count_distinct("content").alias("times"))
        .where(F.col("times") >= LEAST_PAGES)
    )
    times, flow = F.col("times"), F.col("hash") % 2 != 0
    site = (times >= SITE_SHARE * F.col("contents")) & (~flow | (times >= LEAST_FLOW_PAGES))
    return (
        counted.join(contents, "host")
        .where(~flow | (times >= PAGE_SHARE * F.col("contents")))
        .select("host", "hash", site.alias("site"))
    )


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url and text of every page.

    Subtrees meet the templates as narrow rows, and only what these cut meets the page again. Both
    are stored before, so Spark knows their size: pages are shuffled only where cuts are
    too many for a broadcast, by a number of their own, so no host is in one task.
    """
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    parsed = stored(
        pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
        .mapInArrow(
            _parse,
            "page_id long, url string, marked boolean, content long, blocks array<string>, hashes array<long>, "
            "firsts array<int>, ends array<int>",
        )
        .withColumn("host", host)
        .withColumn("row", F.monotonically_increasing_id()),
        "parsed-pages",
    )
    found = stored(templates(parsed), "site-templates")
    subtrees = parsed.select("row", "host", "marked", F.inline(F.arrays_zip("hashes", "firsts", "ends"))).select(
        "row", "host", "marked", F.col("hashes").alias("hash"), "firsts", "ends"
    )
    cuts = stored(
        subtrees.where(F.col("firsts") < F.col("ends"))
        .join(found, ["host", "hash"])
        .where(F.col("site") | ~F.col("marked") | (F.col("hash") % 2 == 0))
        .groupBy("row")
        .agg(F.collect_set(F.struct("firsts", "ends", "site")).alias("cuts")),
        "site-template-cuts",
    )

    def without(test) -> Column:
        covered = lambda i: F.exists("cuts", lambda s: test(s) & (s["firsts"] <= i) & (i < s["ends"]))
        return F.array_join(F.filter("blocks", lambda b, i: ~covered(i)), " ")

    whole, rest, site_rest = F.array_join("blocks", " "), without(lambda s: F.lit(True)), without(lambda s: s["site"])
    text = (
        F.when(F.col("cuts").isNull(), whole)
        .when(~F.col("marked") | (2 * F.length(rest) >= F.length(whole)), rest)
        .otherwise(F.when(site_rest == "", whole).otherwise(site_rest))
    )
    return parsed.join(cuts, "row", "left").select("page_id", "url", text.alias("text"))
