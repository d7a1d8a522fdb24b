"""Operator 8, HTML extraction with removal of what a site repeats.

The sub-trees of whole pages are hashed and counted by site, whatever they are; those on many pages go.
Only of what is left do elements, roles and names decide what else isn't the main text: that which a site
doesn't repeat often enough to be known by its repetition.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlight.llm.store import kept

# Fixed values of the HTML standard: elements without an end tag, elements whose content is not markup,
# elements that stand on lines of their own, and those whose start ends an open paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg math".split())
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul".split())
ENDS_P = BLOCK - {"br", "option", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "body", "html", "head"}
# Elements, roles and words of class or id that are never the main text.
SIDE = frozenset("nav header footer aside form script style head button select menu dialog noscript template iframe svg math textarea title object canvas video audio".split())
SIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
SIDE_NAMES = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo banner nav navbar navigation menu breadcrumb breadcrumbs header footer sidebar aside widget cookie cookies consent notice notices gdpr popup modal newsletter subscribe signup login share sharing social related comment comments replies reply disqus pagination pager skip".split())
#: Words that a name may have beside these. With any other, as in article-header or notice-board, it says nothing.
PLAIN_NAMES = frozenset("site main top bottom left right global primary secondary box bar block list section wrapper wrap container slot item items link links area inner outer form count button buttons icon icons group row unit zone mobile desktop sticky fixed wide narrow small large".split())

_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_LISTS = ("ul", "ol", "dl", "table", "select")
_STOPS = frozenset("ul ol dl table article section main div nav aside header footer body html td th blockquote form".split())
#: Elements that are open at most; deeper ones count as part of the last.
DEEPEST = 512
#: Characters that a block of a menu has at most. Sub-trees of longer blocks, and those of one block, may be prose.
SHORT = 80
#: What a sub-tree is, in the low bits of its number: of short blocks; of anything else; in an article or main element.
MENU, PROSE, INSIDE = 0, 1, 2


def _tag_end(page: str, at: int, absent: set[str]) -> int:
    """Behind the `>` that ends a tag, where quotes hide it; an unclosed quote hides nothing. -1: there is none.

    absent: quotes of which the page has none any more, which is kept from tag to tag.
    """
    while True:
        m = _STOP.search(page, at)
        if m is None or m[0] == ">":
            return m.end() if m else -1
        at = m.end()
        if m[0] not in absent:
            closed = page.find(m[0], at) + 1
            if closed:
                at = closed
            else:
                absent.add(m[0])


def tags(page: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """Begin, end, whether it closes, name and attributes of each tag; the name is empty for comments and declarations.

    Each step goes on from where the last one ended, so malformed pages take no more time than others.
    """
    at, absent = page.find("<"), set()
    while at >= 0:
        if page.startswith(("!", "?"), at + 1):
            mark = "-->" if page.startswith("<!--", at) else "]]>" if page.startswith("<![CDATA[", at) else ">"
            end = page.find(mark, at + 2)
            end = len(page) if end < 0 else end + len(mark)
            yield at, end, False, "", ""
        else:
            m = _NAME.match(page, at + 1)
            if m is None:
                at = page.find("<", at + 1)
                continue
            end = _tag_end(page, m.end(), absent)
            if end < 0:
                return
            name = m[2].lower()
            if name in RAW and not m[1]:
                close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, end)
                yield at, close.end() if close else len(page), False, "", ""
                end = close.end() if close else len(page)
            else:
                yield at, end, bool(m[1]), name, page[m.end() : end - 1]
        at = page.find("<", end)


def is_side(attributes: str) -> bool:
    """Whether a role, or a word of class or id, says that an element isn't main text."""
    for kind, value in _ATTRIBUTE.findall(attributes):
        value = value.strip("\"'").lower()
        if kind.lower() == "role":
            if value in SIDE_ROLES:
                return True
            continue
        for name in value.split():
            parts = set(re.split(r"[-_]+|(?<=[a-z])(?=[0-9])", name)) - {""}
            if parts & SIDE_NAMES and all(p in SIDE_NAMES or p in PLAIN_NAMES or p.isdigit() for p in parts):
                return True
    return False


class Page:
    """A page's elements and blocks of text.

    parent, hash: of each element, the page itself first; parents stand before their elements. texts: the
    blocks in page order; node, side, main: the element of each, whether markup sets it aside, and
    whether it is in an article or main element. tag, inside: of each element, and whether it is in one of these.
    """

    def __init__(self, page: str):
        self.parent, self.hash, self.texts, self.node, self.side, self.main = [0], [0], [], [], [], []
        self.tag, self.inside = [""], [False]
        # number, tag, side, main and running hash of the open elements
        stack = [(0, "", False, False, xxhash.xxh64())]
        open_tags: dict[str, int] = {}
        pending: list[str] = []

        def flush() -> None:
            raw = "".join(pending)
            pending.clear()
            if not raw or raw.isspace():
                return
            text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
            if text:
                number, _, side, main, running = stack[-1]
                running.update("\x01" + text)
                self.texts.append(text)
                self.node.append(number)
                self.side.append(side)
                self.main.append(main)

        def close(n: int) -> None:
            flush()
            while len(stack) > n:
                number, tag, _, _, running = stack.pop()
                open_tags[tag] -= 1
                self.hash[number] = _signed(running.intdigest())
                stack[-1][4].update(b"\x02" + running.digest())

        def last_open(*wanted: str, stop: tuple[str, ...] | frozenset = ()) -> int:
            if any(open_tags.get(t) for t in wanted):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][1] in wanted:
                        return i
                    if stack[i][1] in stop:
                        return 0
            return 0

        at = 0
        for begin, end, closes, tag, attributes in tags(page):
            pending.append(page[at:begin])
            at = end
            if not tag:
                continue
            if closes:
                found = last_open(tag)
                if tag in BLOCK:
                    flush()
                if found and (tag in BLOCK or tag in SIDE or not any(stack[i][1] in BLOCK for i in range(found + 1, len(stack)))):
                    close(found)  # what was opened inside it without an end goes with it
                continue
            if tag in BLOCK:
                flush()
            if tag in ENDS_P:
                found = last_open("p", stop=_STOPS)
                if found:
                    close(found)
            if tag in _CLOSES:
                found = last_open(*_CLOSES[tag], stop=_LISTS)
                if found:
                    close(found)
            marked = bool(attributes) and tag not in ("html", "body", "main") and is_side(attributes)
            if tag not in VOID and (tag in BLOCK or tag in SIDE or marked) and len(stack) <= DEEPEST:
                flush()
                number, _, side, main, _ = stack[-1]
                open_tags[tag] = open_tags.get(tag, 0) + 1
                self.parent.append(number)
                self.hash.append(0)
                self.tag.append(tag)
                self.inside.append(main)
                stack.append((len(self.hash) - 1, tag, side or marked or tag in SIDE and not (tag == "header" and main), main or tag in ("article", "main"), xxhash.xxh64(tag)))
        pending.append(page[at:])
        close(1)
        self.hash[0] = _signed(stack[0][4].intdigest())

    def numbers(self) -> list[int | None]:
        """Of each element: its hash with what it is in the low bits; None for those that are never the site's.

        Those are the page, its body, article and main elements and what these stand in, single blocks of text inside
        them, and elements without text.
        """
        n = len(self.parent)
        blocks, longest, holds = [0] * n, [0] * n, [t in ("article", "main", "html", "body") for t in self.tag]
        for t, k in zip(self.texts, self.node, strict=True):
            blocks[k] += 1
            longest[k] = max(longest[k], len(t))
        for k in range(n - 1, 0, -1):
            up = self.parent[k]
            blocks[up] += blocks[k]
            longest[up] = max(longest[up], longest[k])
            holds[up] = holds[up] or holds[k]
        out: list[int | None] = [None] * n
        for k in range(1, n):
            if not blocks[k] or holds[k] or self.inside[k] and blocks[k] == 1:
                continue
            kind = INSIDE if self.inside[k] else MENU if blocks[k] > 1 and longest[k] <= SHORT else PROSE
            out[k] = self.hash[k] & ~3 | kind
        return out

    def trees(self) -> list[int]:
        """Numbers of the elements that may be the site's."""
        return sorted({x for x in self.numbers() if x is not None})

    def text(self, site: frozenset[int]) -> str:
        """The main text without the sub-trees of the site."""
        gone = [False] * len(self.parent)
        if site:
            numbers = self.numbers()
            for k in range(1, len(gone)):
                gone[k] = gone[self.parent[k]] or numbers[k] in site
        left = [(t, m) for t, k, s, m in zip(self.texts, self.node, self.side, self.main, strict=True) if not s and not gone[k]]
        main = [t for t, m in left if m]
        taken = main if 2 * sum(map(len, main)) > sum(len(t) for t, _ in left) else [t for t, _ in left]
        return " ".join(taken)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def host(url: Column) -> Column:
    """Lower-case host of a URL; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def site_trees(hosted: DataFrame, share: float, least: int, fewest: int) -> tuple[DataFrame, DataFrame]:
    """(host, tree, n) of the sub-trees that a site repeats, and (host, page_key, page_hash, trees) of its different pages.

    hosted: host, page_key (a hash of html), html.
    """

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                pages = [Page(page or "") for page in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("host"), part.column("page_key"), pa.array([p.hash[0] for p in pages], pa.int64()), pa.array([p.trees() for p in pages], pa.list_(pa.int64()))], ["host", "page_key", "page_hash", "trees"])

    found = hosted.mapInArrow(parsed, "host string, page_key long, page_hash long, trees array<long>")
    pages = kept(found.groupBy("host", "page_key").agg(F.first("page_hash").alias("page_hash"), F.first("trees").alias("trees")))
    different = pages.groupBy("host", "page_hash").agg(F.first("trees").alias("trees"))
    total = different.groupBy("host").agg(F.count("*").alias("total"))
    often = different.select("host", F.explode("trees").alias("tree")).groupBy("host", "tree").agg(F.count("*").alias("n")).where(F.col("n") >= min(least, fewest))
    part = F.greatest(F.lit(fewest), F.ceil(F.lit(share) * F.col("total")))
    kind = F.col("tree").bitwiseAND(F.lit(3))
    enough = F.when(kind == MENU, F.least(F.lit(least), part)).when(kind == INSIDE, F.greatest(F.lit(least), part)).otherwise(part)
    return often.join(total, "host").where(F.col("n") >= enough).select("host", "tree", "n"), pages


def extract(pages: DataFrame, share: float = 0.5, least: int = 10, fewest: int = 3) -> DataFrame:
    """page_id, url, text and n_chars of every row of pages (page_id, url, html).

    Element sub-trees of whole pages, menus and footers among them, are hashed with their content and counted
    by host: those on `share` of its different pages, but no fewer than `fewest`, are the site's, and their text
    goes. For sub-trees of several short blocks, as menus are, `least` pages are enough on a host of any size; those
    in article or main elements need `least` as well as the share. A single block of text in these is never taken
    for the site's, however often it stands there, nor are these elements themselves and what holds them. Copies of a
    page count once, so a page that is copied often isn't taken for a template. Of the rest goes what stands in elements, roles or names
    of menus, headers, footers, sidebars, notices, adverts, forms and comments. If article and main elements
    hold more than half of the characters that are left of a page, only they are taken. Blocks are runs of
    text between tags of elements that stand on lines of their own; character references are decoded, white
    space in a block becomes one space, blocks are joined by one space; nothing else goes. Null and
    empty html: an empty text. A null url has the host "". Rows of a repeated page_id are all returned.
    Tags that never end are text. Other columns of pages are left out.

    Pages are parsed twice, once for their sub-trees and once, with the site's at hand, for their text.
    """
    kind, url_kind = (pages.schema[c].dataType.simpleString() for c in ("page_id", "url"))
    hosted = pages.select("page_id", "url", host(F.col("url")).alias("host"), "html", F.xxhash64("html").alias("page_key"))
    sites, known = site_trees(hosted.select("host", "page_key", "html"), share, least, fewest)
    each = known.select("host", "page_key", F.explode("trees").alias("tree"))
    own = kept(each.join(sites, ["host", "tree"]).groupBy("host", "page_key").agg(F.collect_list("tree").alias("site")))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                out = [Page(page or "").text(frozenset(site or ())) for page, site in zip(part.column("html").to_pylist(), part.column("site").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(out, pa.string())], ["page_id", "url", "text"])

    joined = hosted.join(own.hint("shuffle_hash"), ["host", "page_key"], "left").select("page_id", "url", "html", "site")
    return joined.mapInArrow(texts, f"page_id {kind}, url {url_kind}, text string").withColumn("n_chars", F.length("text").cast("long"))
