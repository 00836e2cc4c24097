"""Main text of web pages by differencing pages of near addresses.

Pages are put in the order of host, path and id, and each is paired with that neighbour on the
same host whose path agrees with its own the longest. The text lines (blocks) of both are
aligned by a longest common subsequence; lines that both have are the site's, not the page's.

Differencing alone cannot give right results where neighbours share real content (licence
lines, copied articles, sentences that one page has as an advert) or where menus differ from
page to page, so markup goes first: elements that are no content by their kind, role or class
go, and the lines of an ``article`` (where a page has none, of ``main``) stay. Differencing
decides all other lines: what a page shares with its neighbour goes, the rest stays. A page
that marks no content and whose lines are all shared is a copy of its neighbour and keeps them;
a page with content marked and no neighbour keeps that alone.

Rules for odd input: null and empty pages give the empty text; a page without a neighbour on
its host is judged by its markup; repeated rows are neighbours and alike; null urls are one
host. Cut-off and wrongly nested markup is read as browsers do it, in the main. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import in_order

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*(?:"|\Z)|'[^']*(?:'|\Z))*+)>?|<[!?][^>]*>?""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")

# Kinds of elements, and words of classes, ids and roles of what is no content.
RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "svg", "object"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "search", "section", "select",
    "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
CLOSED_BY = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
CHROME_TAGS = {"aside", "button", "dialog", "footer", "form", "head", "menu", "nav", "search", "select"}
CHROME_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "alert", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "disclaimer", "footer", "gdpr",
    "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pagination", "popup", "promo", "related", "respond", "share", "sharing", "sidebar", "social",
    "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
CHROME_ROLES = {"alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar", "navigation", "search"}
SCHEMA = "page_id long, url string, text string, n_chars long"


def _is_chrome(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in CHROME_TAGS or tag == "header" and not in_article:
        return True
    if not attributes or tag in ("html", "body", "main"):
        return False
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        words = (a or b or c).lower().split()
        if name.lower() == "role" and not CHROME_ROLES.isdisjoint(words):
            return True
        if name.lower() in ("class", "id") and any(w in CHROME_WORDS or re.split("[-_]", w, maxsplit=1)[0] in CHROME_WORDS for w in words):
            return True
    return False


def lines_of(html: str | None) -> list[tuple[str, int]]:
    """(text, place) of the blocks of a page: 2 in an article, 1 in main, 0 elsewhere, -1 in
    what is no content by its markup."""
    html = html or ""
    out: list[tuple[str, int]] = []
    stack: list[tuple[str, int]] = []  # open elements and the place inside them
    held: list[str] = []
    place = 0

    def flush() -> None:
        if held:
            if line := " ".join(unescape("".join(held)).split()):
                out.append((line, place))
            held.clear()

    def close_to(k: int) -> None:
        nonlocal place
        del stack[k:]
        now = stack[-1][1] if stack else 0
        if now != place:
            flush()
            place = now

    at = 0
    while m := TOKEN.search(html, at):
        if m.start() > at:
            held.append(html[at : m.start()])
        at = m.end()
        closing, tag = m[1], m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            held.append(" ")
            continue
        if tag in BLOCKS:
            flush()
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    close_to(k)
                    break
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        for k in range(len(stack) - 1, -1, -1):
            if tag in CLOSED_BY.get(stack[k][0], ()):
                close_to(k)
                break
            if stack[k][0] in BLOCKS and stack[k][0] != "p":
                break
        if tag in VOID or m[3].endswith("/") and tag not in BLOCKS:
            continue
        own = place
        if place >= 0:
            if _is_chrome(tag, m[3], place > 0):
                own = -1
            elif tag == "article":
                own = 2
            elif tag == "main":
                own = max(place, 1)
        stack.append((tag, own))
        if own != place:
            flush()
            place = own
    held.append(html[at:])
    flush()
    return out


def common_lines(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Positions of a longest common subsequence of two lists of lines (Hunt and Szymanski)."""
    where = defaultdict(list)
    for j, line in enumerate(b):
        where[line].append(j)
    ends: list[int] = []  # of the best chain of each length: its last position in b
    tails: list[tuple | None] = []
    for i, line in enumerate(a):
        for j in reversed(where.get(line, ())):
            k = bisect_left(ends, j)
            link = (i, j, tails[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                tails.append(link)
            elif j < ends[k]:
                ends[k], tails[k] = j, link
    out, at = [], tails[-1] if tails else None
    while at:
        out.append(at[:2])
        at = at[2]
    return out[::-1]


def main_text(own: list[tuple[str, int]], near: list[tuple[str, int]] | None) -> str:
    """The lines of a page that are its own, given those of its neighbour."""
    best = max((place for _, place in own), default=0)
    marked = {i for i, (_, place) in enumerate(own) if place == best > 0}
    open_lines = [i for i, (_, place) in enumerate(own) if place == 0]
    if open_lines and near:
        shared = {i for i, _ in common_lines([x for x, _ in own], [x for x, _ in near])}
        content = marked.union(i for i in open_lines if i not in shared) or open_lines
    else:
        content = marked or open_lines
    return "\n".join(own[i][0] for i in sorted(content))


def _agreement(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def _nearest(page: tuple, others: list[tuple | None]) -> list | None:
    same = [o for o in others if o is not None and o[0] == page[0]]
    return max(same, key=lambda o: _agreement(o[1], page[1]))[2] if same else None


def _rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Goes through the pages in order with one page held on either side."""
    columns = [c.split()[0] for c in SCHEMA.split(", ")]
    before = here = None  # (host, path, lines, range, own row or None)

    def done(page, left, right):
        beside = [x if x is not None and x[3] == page[3] else None for x in (left, right)]
        text = main_text(page[2], _nearest(page, beside))
        return (*page[4], text, len(text))

    for frame in frames:
        out = []
        for number, side, host, path, page_id, url, html in zip(*(frame[c] for c in ("_range", "_side", "host", "path", "page_id", "url", "html")), strict=True):
            page = (host, path, lines_of(html), number, None if side else (page_id, url))
            if here is not None and here[4] is not None:
                out.append(done(here, before, page))
            before, here = here, page
        yield pd.DataFrame(out, columns=columns).astype({"page_id": "Int64"})
    if here is not None and here[4] is not None:
        yield pd.DataFrame([done(here, before, None)], columns=columns).astype({"page_id": "Int64"})


def extract(pages: DataFrame, ranges: int | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    n = ranges or int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    url = F.coalesce("url", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        "html",
        F.lower(F.regexp_extract(url, r"^[^:/?#]+://([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(url, r"^(?:[^:/?#]+://[^/?#]*)?([^?#]*)", 1).alias("path"),
    )
    key = [F.col("host"), F.col("path"), F.coalesce("page_id", F.lit(2**63 - 1))]
    return in_order(rows, key, n, both_sides=True, ties=F.xxhash64("html")).select("_range", "_side", "host", "path", "page_id", "url", "html").mapInPandas(_rows, SCHEMA)
