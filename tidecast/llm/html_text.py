"""HTML extraction by composite text density.

A page becomes a flat table of its block elements in page order (parent,
characters, characters in links, tags, link tags; inline elements count for
the block they stand in).  An element's density is its characters per tag,
adjusted for links by the logarithm of the ratios of text to link text and
of tags to link tags.  The densities of the children sum up; the element
with the largest sum is the core of the page, and the least density on its
path up to the body is the threshold.  Every element that reaches the
threshold marks the element with the largest sum in its subtree as content;
paragraphs, headings, lists and quotes beside a marked element follow it.

Elements that are no article text by their name, role, or a word of their
class or id are taken out before; a class or id does not count where the element
holds the page's article or, on a page without one, most of its text, and within
an article or main element the words for headers don't.  On a
page with a single outermost article or main element, that element stands
for the body.

Svg and math elements are dropped as elements (a self-closed one is only its
tag), so is a select, and an object that has an end; an unclosed one ends
where its parent or a start tag that it can't hold ends it.

The content of scripts, styles, text areas and the like is skipped as raw text up
to their end tag (without one, to the end of the page), whatever it holds.

Cases: null or empty html gives an empty text; unclosed, crossed or stray
tags follow the usual implied ends; html cut off within a tag loses that
tag; a page without elements is one block; null ids, null urls and repeated
rows are returned as they are; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import text_of

# Names of HTML elements, roles, and words of classes and ids.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre section table ul".split()
)
RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table figure figcaption".split())
FOREIGN = frozenset(("svg", "math"))
#: Within these the content of an svg or math element is HTML again; in the labels only inline elements.
INTEGRATION = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
LABELS = INTEGRATION - {"foreignobject", "annotation-xml"}
#: Start tags that end an open svg or math element, and an open select.
BREAKOUT = CLOSES_P | frozenset(
    "b big body br code dd dt em embed head i img li meta nobr ruby s small span strong strike sub sup tt u var".split()
)
ENDS_SELECT = (CLOSES_P - {"div", "hr"}) | frozenset(("input", "select", "textarea"))
IMPLIED = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "thead": ("tr", "td", "th", "tbody", "tfoot"), "tbody": ("tr", "td", "th", "thead", "tfoot"), "tfoot": ("tr", "td", "th", "tbody"),
    "option": ("option",), "body": ("head",),
}
FENCES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "p": ("td", "th", "table", "div", "section", "article", "body")}
DROPPED = frozenset("head nav footer aside form button dialog menu svg math select".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
WORDS = frozenset(
    "ad ads advert advertisement adverts advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup sidebar sidebars aside widget widgets menu nav navbar navigation "
    "breadcrumb breadcrumbs header masthead footer comment comments commentlist disqus reply replies respond share sharing social related "
    "recommended pagination pager toolbar login search form copyright skip hidden".split()
)
CORE = frozenset(("article", "main"))
#: Words that don't count within the page's article, where they name the head of the text.
OWN_WORDS = frozenset(("header", "masthead"))

#: Comments, declarations and tags; in a tag a quote protects ``>`` only after ``=``.
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+"[^"]*+"|=\s*+'[^']*+'|[^>])*+)(>|\Z)""",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|\b(hidden)\b""")
SELF_CLOSED = re.compile(r"""(?<!=)(?:\A|["'\s]|[\s"'][^\s"'=]+)/\Z""")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _noise(name: str, attributes: str, in_core: bool = False) -> tuple[bool, bool]:
    """(noise by name or role, noise by a word of class or id)."""
    if name in DROPPED:
        return True, False
    hinted = False
    for m in ATTRIBUTE.finditer(attributes):
        if m[3]:
            return True, False
        key, value = m[1].lower(), m[2].strip("\"'")
        if key == "role" and value.lower() in ROLES:
            return True, False
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True, False
        if key == "aria-hidden" and value.lower() == "true":
            return True, False
        if key in ("class", "id") and any(w.lower() in WORDS and not (in_core and w.lower() in OWN_WORDS) for w in WORD.findall(value)):
            hinted = True
    return False, hinted


class Open:
    """The open elements.  Each name's places are at hand, so that no tag walks
    the whole stack; inline elements carry the block they stand in."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int]] = [("#page", 0)]
        self.places: dict[str, list[int]] = {}
        self.blocks = [0]  # places of elements that are not inline

    def __len__(self) -> int:
        return len(self.stack)

    @property
    def block(self) -> int:
        return self.stack[-1][1]

    def element(self, place: int) -> int:
        return self.stack[place][1]

    def last(self, name: str) -> int:
        """Place of the innermost open element of the name; 0 without one."""
        own = self.places.get(name)
        return own[-1] if own else 0

    def block_between(self, after: int, before: int) -> bool:
        i = bisect_left(self.blocks, before) - 1
        return i >= 0 and self.blocks[i] > after

    def push(self, name: str, block: int) -> None:
        self.places.setdefault(name, []).append(len(self.stack))
        if name not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append((name, block))

    def cut(self, place: int) -> int:
        """Close the elements from ``place`` on; links closed by it."""
        links = 0
        while len(self.stack) > place:
            name, _ = self.stack.pop()
            self.places[name].pop()
            if name not in INLINE:
                self.blocks.pop()
            links += name == "a"
        return links

    def close(self, names: tuple[str, ...], fences: tuple[str, ...]) -> int:
        """Close the innermost open element of ``names`` within the fences; links closed by it."""
        place = max(map(self.last, names))
        return self.cut(place) if place > max(map(self.last, fences), default=0) else 0


class Page:
    """Flat table of a page's block elements; row 0 is the page itself."""

    def __init__(self, source: str):
        self.name, self.parent, self.noise, self.hinted = ["#page"], [-1], [False], [False]
        self.tags, self.link_tags = [1], [0]
        self.pieces: list[tuple[int, str, bool]] = []  # (element, text, in a link)
        self._read(source)

    def _read(self, source: str) -> None:
        stack = Open()
        links = at = 0
        foreign: list[tuple[int, str]] = []  # places and names of open svg and math elements and of integration points in them
        selects: list[int] = []  # places of open selects

        def settle() -> None:
            while foreign and foreign[-1][0] >= len(stack):
                foreign.pop()
            while selects and selects[-1] >= len(stack):
                selects.pop()

        while m := TOKEN.search(source, at):  # from the end of what was read: nothing begins inside raw text
            if m.start() > at and not foreign:
                self.pieces.append((stack.block, source[at: m.start()], links > 0))
            at = m.end()
            name = (m[2] or "").lower()
            if not name:
                continue
            if m[4] != ">":
                at = len(source)
                break  # cut off within a tag
            block = stack.block
            if m[1]:
                depth = stack.last(name)
                if depth and name in INLINE and stack.block_between(depth, next((i for i, x in foreign if x in FOREIGN and i > depth), len(stack))):
                    depth = 0  # an inline end does not close the blocks within
                inside = foreign and (not depth or depth >= foreign[0][0])
                if depth:
                    if name == "object":
                        self.noise[stack.element(depth)] = True  # one without an end holds the text after it
                    links -= stack.cut(depth)
                    settle()
                if name not in INLINE and not inside:
                    self.pieces.append((block, " ", False))
                continue
            attributes = m[3]
            while foreign and name in (BREAKOUT if foreign[-1][1] in FOREIGN else CLOSES_P if foreign[-1][1] in LABELS else ()):
                links -= stack.cut(foreign[-1][0])
                settle()
            if selects and not foreign and name in ENDS_SELECT:
                links -= stack.cut(selects[-1])
                settle()
            within = bool(foreign) and foreign[-1][1] in FOREIGN
            if (within or name in FOREIGN) and SELF_CLOSED.search(attributes):
                continue
            if within or foreign and name not in RAW and name not in VOID:
                if name in FOREIGN or within and name in INTEGRATION:
                    foreign.append((len(stack), name))
                links += name == "a"
                stack.push(name, stack.block)  # all of it is dropped with the outermost one
                continue
            if name in RAW:
                raw = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE).search(source, at)
                at = raw.end() if raw else len(source)
                continue
            if name in CLOSES_P:
                links -= stack.close(("p",), FENCES["p"])
            if name in IMPLIED:
                links -= stack.close(IMPLIED[name], FENCES.get(name, ()))
            settle()
            block = stack.block
            if name in VOID:
                if foreign:
                    continue
                self.tags[block] += 1
                self.pieces.append((block, " ", False))
                continue
            in_core = any(stack.last(x) for x in CORE)
            noise, hinted = _noise(name, attributes, in_core)
            if name in INLINE and not (noise or hinted):
                self.tags[block] += 1
                if name == "a":
                    self.link_tags[block] += 1
                    links += 1
                stack.push(name, block)
                continue
            if name == "header" and not in_core:
                noise = True
            self.name.append(name)
            self.parent.append(block)
            self.noise.append(noise)
            self.hinted.append(hinted and name not in ("html", "body", "main"))
            self.tags.append(1)
            self.link_tags.append(0)
            if name in FOREIGN:
                foreign.append((len(stack), name))
            elif name not in INLINE:
                self.pieces.append((block, " ", False))
            elif name == "a":
                links += 1
            if name == "select":
                selects.append(len(stack))
            stack.push(name, len(self.name) - 1)
        if at < len(source) and not foreign:
            self.pieces.append((stack.block, source[at:], links > 0))

    def _upwards(self, own: list[float]) -> list[float]:
        total = list(own)
        for i in range(len(total) - 1, 0, -1):
            total[self.parent[i]] += total[i]
        return total

    def dropped(self) -> list[bool]:
        """Elements that are no article text by name, role, class or id, with all that is in them."""
        n = len(self.name)
        chars = [0] * n
        for i, text, link in self.pieces:
            if not link:
                chars[i] += len(text) - text.count(" ")
        plain = [0 if self.noise[i] else c for i, c in enumerate(chars)]
        for i in range(1, n):
            if self.noise[self.parent[i]]:
                self.noise[i] = True
                plain[i] = 0
        total = self._upwards(plain)
        core = self._upwards([x in CORE and not h and not o for x, h, o in zip(self.name, self.hinted, self.noise)])
        out = list(self.noise)
        for i in range(1, n):
            whole = core[i] or not core[0] and total[i] > 0.6 * total[0]
            out[i] = out[i] or out[self.parent[i]] or (self.hinted[i] and not whole)
        return out

    def _scope(self, out: list[bool]) -> int:
        """The page's only outermost article or main element, else its body."""
        outer: list[int] = []
        inside = [False] * len(self.name)
        for i, x in enumerate(self.name):
            inside[i] = i > 0 and inside[self.parent[i]]
            if x in CORE and not inside[i] and not out[i]:
                inside[i] = True
                outer.append(i)
        if len(outer) == 1:
            return outer[0]
        return next((i for i, x in enumerate(self.name) if x == "body"), 0)

    def content(self) -> list[bool]:
        n, out = len(self.name), self.dropped()
        chars, linked = [0.0] * n, [0.0] * n
        for i, text, link in self.pieces:
            if not out[i]:
                size = len(" ".join(text.split()))
                chars[i] += size
                linked[i] += size * link
        chars, linked = self._upwards(chars), self._upwards(linked)
        tags = self._upwards([0 if o else t for o, t in zip(out, self.tags)])
        link_tags = self._upwards([0 if o else t for o, t in zip(out, self.link_tags)])
        body = self._scope(out)
        share = linked[body] / max(chars[body], 1)
        density = [0.0] * n
        for i in range(n):
            c, lc, t, lt = chars[i], linked[i], tags[i], link_tags[i]
            if out[i] or not c:
                continue
            links = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
            density[i] = c / max(t, 1) * math.log1p(c / max(lc, 1) * max(t, 1) / max(lt, 1)) / math.log1p(links)
        sums, leaf = [0.0] * n, [True] * n
        for i in range(1, n):
            if not out[i]:
                sums[self.parent[i]] += density[i]
                leaf[self.parent[i]] = False
        sums = [density[i] if leaf[i] else s for i, s in enumerate(sums)]
        best = list(range(n))
        for i in range(n - 1, 0, -1):
            if not out[i] and sums[best[i]] > sums[best[self.parent[i]]]:
                best[self.parent[i]] = best[i]
        least, at = math.inf, best[body]
        while at >= 0:
            least = min(least, density[at])
            if at == body:
                break
            at = self.parent[at]
        marked = [False] * n
        within = [False] * n
        for i in range(n):
            within[i] = i == body or i > 0 and within[self.parent[i]]
            if within[i] and not out[i] and density[i] >= least > 0:
                marked[best[i]] = True
        # running text beside what is marked belongs to it, if it isn't mostly links
        fed = [False] * n
        for i in range(1, n):
            fed[self.parent[i]] = fed[self.parent[i]] or marked[i]
        for i in range(1, n):
            up = self.parent[i]
            if fed[up] and within[i] and self.name[i] in RUNNING and (up != body or self.name[up] in CORE):
                marked[i] = marked[i] or 2 * linked[i] <= chars[i]
            marked[i] = (marked[i] or marked[up]) and not out[i]
        return marked

    def text(self) -> str:
        kept = self.content()
        return " ".join(html.unescape("".join(t if kept[i] else " " for i, t, _ in self.pieces if kept[i] or t == " ")).split())


def main_text(source: str | None) -> str:
    return Page(source).text() if source else ""


def extract_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), text_of(source).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
