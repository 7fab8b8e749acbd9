"""HTML extraction over a ``pages(page_id, url, html)`` table.

Parsing is the one step with no Spark expression, so each page is parsed in
Python inside ``mapInPandas`` (Arrow batches, pages spread over the cluster).
One pass over the tags fills a flat table of elements in document order; the
descendants of an element are the rows up to its ``end``, and its text is a
range of the page's text nodes, so nothing recurses and depth costs nothing.
Void elements never nest, an end tag closes up to its nearest open match, an
end tag with no open match is ignored, script/style bodies are raw text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.functions.stamps import NEWS_BASE_URL, absolute_url

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# Text whose direct parent is one of these is never visible.
INVISIBLE_PARENTS = ["style", "script", "head", "title", "meta", "[document]", "nav", ""]
# Ancestors that hide text once they occur this many times above it.
BAD_PARENT_LIMITS = {
    "nav": 1,
    "header": 1,
    "footer": 1,
    "article": 2,
    "figcaption": 1,
    "figure": 1,
    "ul": 1,
    "h1": 1,
    "h2": 1,
    "h3": 1,
    "h4": 1,
    "h5": 1,
}
# Only so many of the nearest ancestors can hide a text (a rule of the result,
# a parameter of ``visible_text``).
NEAREST_ANCESTORS = 100
# Categories of the listing site's section links.
CATEGORIES = ["U.S.", "World", "Business", "Technology", "Entertainment", "Sports", "Science", "Health"]
# Link markers inside a listing article.
PUBLICATION_MARK = "./publications"
ARTICLE_MARK = "./article"
NO_SOURCE = "N/A"
NO_URL = "XXX"
# ---------------------------------------------------------------------------

# Elements that cannot hold children (HTML void elements and legacy ones).
VOID_ELEMENTS = frozenset({
    "area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link", "menuitem",
    "meta", "param", "source", "track", "wbr", "basefont", "bgsound", "command", "frame",
    "image", "isindex", "nextid", "spacer",
})


class Element:
    """A row of the element table."""

    __slots__ = ("tag", "attrs", "parent", "at", "end", "text_from", "text_to")

    def __init__(self, tag, attrs, parent, at, text_from):
        self.tag, self.attrs, self.parent, self.at, self.text_from = tag, attrs, parent, at, text_from
        self.end, self.text_to = at + 1, text_from


class PageTable(HTMLParser):
    """``elements`` in document order, ``texts`` (all text nodes but comments) and
    which of them are ``shown``.

    For every hiding tag the depths of its open elements are kept, so whether a
    text is hidden is one look at the innermost of them.
    """

    def __init__(self, nearest: int = NEAREST_ANCESTORS):
        super().__init__(convert_charrefs=True)
        self.nearest = nearest
        self.elements: list[Element] = []
        self.texts: list[str] = []
        self.shown: list[bool] = []
        self.open: list[Element] = []
        self.depths: dict[str, list[int]] = {}
        self.pending: list[str] = []

    @classmethod
    def of(cls, html: str | None, nearest: int = NEAREST_ANCESTORS) -> PageTable:
        page = cls(nearest)
        page.feed(html or "")
        page.close()
        page._end_text()
        while page.open:
            page._leave()
        return page

    def _visible(self) -> bool:
        if not self.open or self.open[-1].tag in INVISIBLE_PARENTS:
            return False
        farthest = len(self.open) - self.nearest
        return not any(len(at) >= limit and at[-limit] >= farthest
                       for tag, limit in BAD_PARENT_LIMITS.items() if (at := self.depths.get(tag)))

    def _end_text(self) -> None:
        if self.pending:
            self.texts.append("".join(self.pending))
            self.shown.append(self._visible())
            self.pending = []

    def _enter(self, tag, attrs) -> Element:
        self._end_text()
        parent = self.open[-1] if self.open else None
        row = Element(tag, dict(attrs), parent, len(self.elements), len(self.texts))
        self.elements.append(row)
        return row

    def _leave(self) -> str:
        row = self.open.pop()
        row.end, row.text_to = len(self.elements), len(self.texts)
        self.depths[row.tag].pop()
        return row.tag

    def handle_starttag(self, tag, attrs):
        row = self._enter(tag, attrs)
        if tag not in VOID_ELEMENTS:
            self.depths.setdefault(tag, []).append(len(self.open))
            self.open.append(row)

    def handle_startendtag(self, tag, attrs):
        self._enter(tag, attrs)

    def handle_endtag(self, tag):
        self._end_text()
        if self.depths.get(tag):
            while self._leave() != tag:
                pass

    def handle_data(self, data):
        self.pending.append(data)

    def handle_comment(self, data):
        self._end_text()

    def inside(self, row: Element | None, *tags: str) -> list[Element]:
        """Elements below ``row`` (None: the page), of ``tags``, in document order."""
        below = self.elements if row is None else self.elements[row.at + 1:row.end]
        return [e for e in below if e.tag in tags]

    def text(self, row: Element) -> str:
        return "".join(self.texts[row.text_from:row.text_to])


_SPACES = re.compile(" +")


def visible_text(html: str | None, nearest: int = NEAREST_ANCESTORS) -> str:
    """H1 + H2 + F14: the page's visible text."""
    page = PageTable.of(html, nearest)
    body = " ".join(t.strip() for t, shown in zip(page.texts, page.shown) if shown)
    return _SPACES.sub(" ", body).strip().replace(" .", ".")


def absolute(fragment: str, base: str = NEWS_BASE_URL) -> str:
    return base + fragment[1:]


def _last(values, default):
    found = default
    for v in values:
        found = v
    return found


def listing_rows(html: str | None, base: str = NEWS_BASE_URL) -> list[dict]:
    """H3: one row per ``<article>`` that has a ``<time>``."""
    page = PageTable.of(html)

    def hrefs(links, mark):
        return (e for e in links if mark in (e.attrs.get("href") or ""))

    def row(article: Element, time: Element) -> dict:
        links = page.inside(article, "a")
        near_time = filter(None, map(page.text, page.inside(time.parent, "a")))
        source = _last(map(page.text, hrefs(links, PUBLICATION_MARK)), None)
        headings = sorted(page.inside(article, "h3", "h4"), key=lambda e: e.tag)  # stable: every h3 before every h4
        return {"source": _last(near_time, NO_SOURCE) if source is None else source,
                "datetime": time.attrs.get("datetime"),
                "headline": page.text(headings[0]) if headings else None,
                "url": _last((absolute(e.attrs["href"], base) for e in hrefs(links, ARTICLE_MARK)), NO_URL)}

    with_time = ((a, page.inside(a, "time")) for a in page.inside(None, "article"))
    return [row(a, times[0]) for a, times in with_time if times]


def link_rows(html: str | None) -> list[dict]:
    """H4 building block: every ``<a>`` with its href, aria-label and text."""
    page = PageTable.of(html)
    return [{"position": i, "href": e.attrs.get("href"), "aria_label": e.attrs.get("aria-label"), "text": page.text(e)}
            for i, e in enumerate(page.inside(None, "a"))]


# ---------------------------------------------------------------------------- Spark operators

def page_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """H1: ``id_col, body`` visible text of every page."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({id_col: pdf[id_col], "body": [visible_text(h) for h in pdf[html_col]]})

    return pages.select(id_col, html_col).mapInPandas(run, f"{id_col} long, body string")


def listing_articles(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
                     category_col: str | None = None, base: str = NEWS_BASE_URL,
                     since: str | None = None) -> DataFrame:
    """H3: ``id_col, category, source, datetime, headline, url`` per listed article,
    from the cut-off ``since`` (inclusive, same format as ``datetime``) on."""
    cols = [id_col, html_col] + ([category_col] if category_col else [])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for rec in pdf.itertuples(index=False):
                d = rec._asdict()
                for r in listing_rows(d[html_col], base):
                    r[id_col] = d[id_col]
                    r["category"] = d[category_col] if category_col else None
                    rows.append(r)
            yield pd.DataFrame(rows, columns=[id_col, "category", "source", "datetime", "headline", "url"])

    schema = f"{id_col} long, category string, source string, datetime string, headline string, url string"
    out = pages.select(*cols).mapInPandas(run, schema)
    return out if since is None else out.filter(F.col("datetime") >= since)


def page_links(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """H4 building block: ``id_col, position, href, aria_label, text`` for every link."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for pid, html in zip(pdf[id_col], pdf[html_col]):
                for r in link_rows(html):
                    r[id_col] = pid
                    rows.append(r)
            yield pd.DataFrame(rows, columns=[id_col, "position", "href", "aria_label", "text"])

    return pages.select(id_col, html_col).mapInPandas(
        run, f"{id_col} long, position int, href string, aria_label string, text string")


def category_links(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """H4: ``id_col, category, url``: the page's first link, in document order,
    labelled with each section category."""
    tagged = page_links(pages, id_col, html_col).filter(F.col("aria_label").isin(CATEGORIES) & F.col("href").isNotNull())
    first = tagged.groupBy(id_col, F.col("aria_label").alias("category")).agg(F.min_by("href", "position").alias("href"))
    return first.select(id_col, "category", absolute_url("href").alias("url"))
