"""Main text of web pages by tree scoring.

A page is tokenised once into blocks of text that know their open elements.
Every paragraph gives points for its length and commas, discounted by the
share of its characters inside links: all of them to its container, half to
the container above, less further up. The container with the most points
(after its own link density) wins; an ``article`` or ``main`` element it lies
in stands for it, otherwise its siblings are kept when they score too or are
plain headings and paragraphs. Menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles, hidden elements and reader comments are left
out wherever they stand, recognised by element, role and the words of class
and id, as are lists that consist of links.

Character references are decoded, white space inside a block becomes one
space, blocks are joined in page order by an empty line. Nothing else is
dropped or cut. Pages are independent, so the work is one map over the rows.

Defined cases: null or empty html and pages without text give the empty
string; markup that is not closed ends with the page; a page without markup is one
block; null page_ids, repeated rows and extra columns pass through untouched;
an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

# HTML element names by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe xmp noembed noframes textarea title "
                "svg canvas object select".split())
LEFT_OUT = frozenset("nav aside footer header form button dialog menu head fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCKS = HEADINGS | frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form head header hgroup hr html legend li main menu nav "
    "ol p pre section summary table tbody td tfoot th thead tr ul".split())
ENDS_P = BLOCKS - frozenset("body caption dd dt head html legend li tbody td tfoot th thead "
                            "tr".split())
# An opening element closes an open one of these, up to the element that holds them.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}),
          "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "tbody": ({"thead", "tbody", "tr"}, {"table"}),
          "tfoot": ({"thead", "tbody", "tr"}, {"table"}), "option": ({"option"}, {"select"})}
PARAGRAPHS = HEADINGS | frozenset("p pre li td th dd dt blockquote figcaption caption "
                                  "summary".split())
WHOLE = frozenset("html body article main".split())  # never left out by name

NOT_TEXT = frozenset(
    "ad ads adbox adslot adsense banner sponsor sponsored promo promotion popup modal overlay "
    "cookie cookies consent gdpr notice notices alert menu menus nav navbar navigation subnav "
    "breadcrumb breadcrumbs sidebar sidebars side rail footer foot header masthead topbar toolbar "
    "share sharing social related recommended comment comments disqus reply replies discussion "
    "newsletter subscribe subscription signup login search form pagination pager skip "
    "copyright complementary contentinfo dialog".split())
NOT_TEXT_STARTS = ("advert", "comment", "cookie", "sidebar", "breadcrumb", "sponsor",
                   "newsletter", "navigation", "navbar", "footer")

TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)"
    r"(?P<attrs>(?:[^>=]|=(?:\s*(?:\"[^\"]*\"|'[^']*'))?)*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)", re.S)
ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


def _attrs(text: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in ATTR.finditer(text)}


def hidden(text: str) -> bool:
    """Do the attributes say that this element is not shown?"""
    a = _attrs(text)
    return bool("hidden" in a or a.get("aria-hidden") == "true" or re.search(
        r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", "")))


def named_out(tag: str, text: str) -> bool:
    """Do the attributes say that this element is not part of the main text?"""
    a = _attrs(text)
    if tag in WHOLE or tag in HEADINGS:
        return False
    for name in f"{a.get('class', '')} {a.get('id', '')} {a.get('role', '')}".split():
        words = [w.lower() for w in NAME_WORDS.findall(name)]
        if words and words[0] in ("has", "with", "no", "without"):
            continue
        if any(w in NOT_TEXT or w.startswith(NOT_TEXT_STARTS) for w in words):
            return True
    return False


class _Page:
    """Elements (tag, parent, links) and blocks (element, text, linked characters)."""

    def __init__(self, html: str, by_name: bool, spared: frozenset[int] = frozenset()):
        self.tag, self.parent = ["#"], [-1]
        self.shut = [False]  # is the element left out, or in one that is?
        self.blocks: list[tuple[int, str, int]] = []
        self.links: list[int] = []  # links of each element's blocks
        stack, out, inside = [0], 0, 0  # out: open left-out elements; inside: open links
        opened = Counter()  # open elements by tag
        dropped = [False]
        pieces: list[str] = []
        linked: list[str] = []
        anchors = 0

        def flush() -> None:
            nonlocal pieces, linked, anchors
            if pieces:
                text = " ".join("".join(pieces).split())
                if text:
                    at = next(k for k in reversed(stack)
                              if self.tag[k] in BLOCKS or not k)
                    self.blocks.append((at, text, len(" ".join("".join(linked).split()))))
                    self.links.append(anchors)
                pieces, linked, anchors = [], [], 0

        def pop() -> None:
            nonlocal out, inside
            k = stack.pop()
            if self.tag[k] in BLOCKS:
                flush_at(k)
            opened[self.tag[k]] -= 1
            out -= dropped[k]
            inside -= self.tag[k] == "a"

        def flush_at(k: int) -> None:
            stack.append(k)
            flush()
            stack.pop()

        def close(tags, stops) -> None:
            if not any(opened[t] for t in tags):
                return
            for depth in range(len(stack) - 1, 0, -1):
                name = self.tag[stack[depth]]
                if name in tags:
                    while len(stack) > depth:
                        pop()
                    return
                if name in stops:
                    return

        at, size = 0, len(html)
        while at < size:
            m = TOKEN.search(html, at)
            text = html[at:m.start() if m else size]
            if text and not out:
                text = unescape(text) if "&" in text else text
                pieces.append(text)
                if inside:
                    linked.append(text)
            if not m:
                break
            at = m.end()
            if not m["tag"]:
                continue
            tag = m["tag"].lower()
            if m["close"]:
                if tag in ("br", "p") and not opened[tag]:
                    pieces.append(" ")
                    continue
                close({tag}, {"table"} if tag not in BLOCKS else ())
                continue
            if tag in RAW:
                end = re.compile(rf"</{tag}[\s/>]", re.I).search(html, at)
                at = html.find(">", end.start()) + 1 if end else size
                at = at or size
                pieces.append(" ")
                continue
            if tag in BLOCKS:
                if tag in ENDS_P:
                    close({"p"}, {"table", "td", "th"})
                if tag in CLOSES:
                    close(*CLOSES[tag])
                if tag not in ("html", "head"):
                    close({"head"}, ())
                flush()
            if tag == "a":
                close({"a"}, {"table"})
                anchors += 1
            if tag in VOID:
                pieces.append(" ")
                continue
            self.tag.append(tag)
            self.parent.append(stack[-1])
            attrs = m["attrs"]
            drop = ((tag in LEFT_OUT or (by_name and bool(attrs) and named_out(tag, attrs)))
                    and len(self.tag) - 1 not in spared)
            drop = drop or (by_name and bool(attrs) and hidden(attrs))
            self.shut.append(drop or out > 0)
            if drop and not out:
                flush()
            dropped.append(drop)
            out += drop
            inside += tag == "a"
            opened[tag] += 1
            stack.append(len(self.tag) - 1)
        while len(stack) > 1:
            pop()
        flush()

    def above(self, k: int) -> Iterator[int]:
        while k >= 0:
            yield k
            k = self.parent[k]

    def points(self):
        """Per element its points, and of its subtree: are there scored blocks, characters,
        linked characters and links. A paragraph's box has its points whole, the box's
        parent half, the next a sixth, and each further one two thirds of the last."""
        n = len(self.tag)
        chars, linked, links = [0] * n, [0] * n, [0] * n
        own, handed, scored = [0.0] * n, [0.0] * n, [False] * n
        for (k, text, in_links), anchors in zip(self.blocks, self.links, strict=True):
            size = len(text)
            score = 1 + text.count(",") + min(size / 100, 3) if size >= 25 else size / 50
            score *= 1 - min(1.0, in_links / size)
            box = self.parent[k] if self.tag[k] in PARAGRAPHS else k
            own[box] += score
            scored[box] = True
            chars[k] += size
            linked[k] += in_links
            links[k] += anchors
        points = own[:]
        for e in range(n - 1, 0, -1):  # children come after their parents
            up = self.parent[e]
            chars[up] += chars[e]
            linked[up] += linked[e]
            links[up] += links[e]
            points[up] += own[e] / 2 + handed[e]
            handed[up] += own[e] / 6 + handed[e] * 2 / 3
            scored[up] |= scored[e]
        return points, scored, chars, linked, links

    def kept(self) -> list[str]:
        if not self.blocks:
            return []
        n = len(self.tag)
        points, scored, chars, linked, links = self.points()

        def density(e: int) -> float:
            return min(1.0, linked[e] / chars[e])

        rated = {e: points[e] * (1 - density(e)) for e in range(n) if scored[e] and chars[e]}
        best = max(rated, key=lambda e: (rated[e], -e)) if rated else 0
        boxes = {best}
        marked = [e for e in self.above(best) if self.tag[e] == "article"] or [
            e for e in self.above(best) if self.tag[e] == "main"]
        if marked:
            boxes = {marked[0]}
        else:
            for e in range(1, len(self.tag)):
                if self.parent[e] == self.parent[best] and chars[e] and e != best and (
                        rated.get(e, 0) >= 0.2 * rated[best]
                        or self.tag[e] in HEADINGS
                        or (self.tag[e] == "p" and density(e) < 0.25)):
                    boxes.add(e)
        held, listed = [False] * n, [False] * n  # in a box; in a list of links
        for e in range(n):
            held[e] = e in boxes or (e > 0 and held[self.parent[e]])
            listed[e] = (e > 0 and listed[self.parent[e]]) or (
                self.tag[e] in ("ul", "ol", "dl", "table") and links[e] >= 3 and density(e) > 0.8)
        return [text for k, text, _ in self.blocks if held[k] and not listed[k]]


def main_text(html: str | None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    page = _Page(html, by_name=True)
    marked = [k for k, tag in enumerate(page.tag) if tag in ("article", "main")]
    if marked and all(page.shut[k] for k in marked):
        page = _unwrapped(html, page, marked) or page
    elif not page.blocks and not marked:
        page = _Page(html, by_name=False)  # the names speak of the whole page
        if not page.blocks:  # or a form is around it
            page = _Page(html, False, frozenset(
                k for k, tag in enumerate(page.tag) if tag == "form"))
    return "\n\n".join(page.kept())


def _unwrapped(html: str, page: _Page, marked: list[int]) -> _Page | None:
    """The page without the wrappers that took its only articles with them - a layout
    named after its sidebar, a form around everything - if those articles are most of
    what it then says. Asides, menus and the like are no wrappers."""
    spared = {e for k in marked for e in page.above(k)}
    if any(page.tag[e] in LEFT_OUT - {"form"} for e in spared):
        return None
    open_page = _Page(html, True, frozenset(spared))
    inside = set(marked)
    within = [False] * len(open_page.tag)
    for e in range(1, len(within)):
        within[e] = e in inside or within[open_page.parent[e]]
    held = sum(len(text) for k, text, _ in open_page.blocks if within[k])
    whole = sum(len(text) for _, text, _ in open_page.blocks)
    return open_page if 2 * held > whole else None


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [main_text(b.column("html")[k].as_py()) for k in range(b.num_rows)]
        yield pa.RecordBatch.from_arrays(
            [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` per row of ``pages(page_id, url, html)``."""
    kinds = dict(pages.dtypes)
    return pages.select("page_id", "url", "html").mapInArrow(
        _extract, f"page_id {kinds['page_id']}, url string, text string, n_chars bigint")
