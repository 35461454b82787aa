"""Main text of a web page by tag-path ratios.

A page becomes text blocks, each under its path of block tags from the root. For
every path, text length and punctuation are added up and divided by the number of
its blocks; both ratios are smoothed over the parent and sibling paths and fused,
and paths over a threshold hold content, as does any path with a sentence or a main
heading, however long the page's other paths are. If nearly all of the content's
weight lies in article or main elements, they are the article; else it is the
innermost container of all content paths. All blocks in it are the text, short
ones too. Menus, forms, notices, comments and the like are known by tag, role or
class and take no part.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML's elements by their part in a page, and usual names of page furniture.
RAW = "script|style|noscript|template|textarea|iframe|noembed|noframes|xmp|title|svg|math|object"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr input".split())
FURNITURE = frozenset("nav footer aside form button select option datalist dialog menu head audio video canvas".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promoted promotion "
    "nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars footer masthead topbar toolbar "
    "comment comments reply replies disqus respond cookie cookies consent gdpr notice notices popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended recommendations widget "
    "widgets pagination pager skip".split())
#: An open element of the key ends where one of the values starts.
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|</?[a-zA-Z!?][^>]*>",
    re.S | re.I)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|style|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？、]")
SIBLING, PARENT = math.exp(-2.0), math.exp(-0.5)
THRESHOLD = 0.25
#: Score of a block that is content on its own: 60 characters with a mark, or 120 without.
SENTENCE = 120
#: Share of the content's weight that article and main elements must hold to be the article.
HOLDS = 0.8
MARKED = frozenset(("article", "main"))


def _furniture(tag: str, attributes: str, path: tuple) -> bool:
    if tag in FURNITURE or tag == "header" and "article" not in path and "main" not in path:
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "role" and value in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if name in ("class", "id") and not NAMES.isdisjoint(re.split(r"[^a-z0-9]+", value)):
            return True
    return False


def blocks(page: str) -> list[tuple[tuple, str]]:
    """(path, text) of every block with text outside furniture, in page order."""
    out: list[tuple[tuple, str]] = []
    stack: list[tuple[str, bool]] = []  # block elements that are open, and whether they or one above is furniture
    held: list[str] = []
    path: tuple = ()
    inline: list[str] = []  # inline furniture that is open

    def end() -> None:
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if text and not (stack and stack[-1][1]):
                out.append((path, text))

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at and not inline:
            held.append(page[at:m.start()])
        at = m.end()
        tag = m[3]
        if not tag:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "br":
                held.append(" ")
            elif m[2]:
                if inline and tag == inline[0]:
                    inline.pop()
            elif inline and tag == inline[0]:
                inline.append(tag)
            elif not inline and tag not in VOID and m[4] and _furniture(tag, m[4], path):
                inline.append(tag)
            continue
        end()
        inline.clear()
        if m[2]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    del stack[depth:]
                    break
        elif tag not in VOID:
            while stack and (stack[-1][0] == "p" or stack[-1][0] in HEADINGS and tag in HEADINGS or tag in CLOSED_BY.get(stack[-1][0], ())):
                stack.pop()
            path = tuple(t for t, _ in stack)
            if not m[4].rstrip().endswith("/") or tag in ("p", "div"):
                stack.append((tag, bool(stack and stack[-1][1]) or _furniture(tag, m[4], path)))
        path = tuple(t for t, _ in stack)
    if at < len(page) and not inline:
        held.append(page[at:])
    end()
    return out


def content_paths(found: list[tuple[tuple, str]]) -> dict[tuple, float]:
    """Paths whose fused ratio reaches the threshold, or with a sentence or main heading of their own, with the length of their text."""
    length, marks, nodes = defaultdict(float), defaultdict(float), defaultdict(float)
    family: dict[tuple, list[float]] = defaultdict(lambda: [0.0, 0.0, 0.0])
    sure = set()
    for path, text in found:
        size, points = len(text), len(PUNCTUATION.findall(text))
        if size * (1 + points) >= SENTENCE or "h1" in path:
            sure.add(path)
        for table, x in ((length, size), (marks, points), (nodes, 1)):
            table[path] += x
        for k, x in enumerate((size, points, 1)):
            family[path[:-1]][k] += x
    score = {}
    for path in length:
        up = path[:-1]
        own = (length[path], marks[path], nodes[path])
        near = [x + SIBLING * (f - x) + PARENT * t.get(up, 0.0) * (up != path) for x, f, t in zip(own, family[up], (length, marks, nodes))]
        score[path] = near[0] / near[2] * (1 + near[1] / near[2])
    limit = THRESHOLD * max(score.values(), default=0.0)
    return {path: length[path] for path, x in score.items() if x >= limit or path in sure}


def main_text(page: str) -> str:
    """The article's blocks joined by line feeds; empty if the page has none."""
    found = blocks(page)
    chosen = content_paths(found)
    if not chosen:
        return ""
    marked = sum(weight for path, weight in chosen.items() if not MARKED.isdisjoint(path))
    if marked >= HOLDS * sum(chosen.values()):
        return "\n".join(text for path, text in found if not MARKED.isdisjoint(path))
    low, high = min(chosen), max(chosen)  # what these share, all share
    depth = 0
    while depth < min(len(low), len(high)) - 1 and low[depth] == high[depth]:
        depth += 1
    return "\n".join(text for path, text in found if path[:depth] == low[:depth])


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [main_text(x or "") for x in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())],
            ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row; NULL and empty pages and pages without an article have an empty text.

    A page is worked on alone and whole: repeated rows, NULL ids and very long
    pages are rows like any other, and other columns are not read.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return pages.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
