"""Page listings and links as table functions for SQL.

    register_table_functions(spark)
    SELECT p.page_id, l.* FROM pages p, LATERAL page_links(p.html) l

A null or empty page has no rows.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from textmill.functions.stamps import NEWS_BASE_URL
from textmill.operators.html import link_rows, listing_rows

LINK_COLUMNS = "position int, href string, aria_label string, text string"
LISTING_COLUMNS = "source string, datetime string, headline string, url string"


class Links:
    """Every link of a page: H4's building block."""

    def eval(self, html: str):
        for r in link_rows(html):
            yield r["position"], r["href"], r["aria_label"], r["text"]


class Listing:
    """The articles a page lists (H3), from the cut-off ``since`` on, if given."""

    def eval(self, html: str, since: str = None):
        for r in listing_rows(html, NEWS_BASE_URL):
            if since is None or (r["datetime"] is not None and r["datetime"] >= since):
                yield r["source"], r["datetime"], r["headline"], r["url"]


page_links = udtf(Links, returnType=LINK_COLUMNS)
listing = udtf(Listing, returnType=LISTING_COLUMNS)


def register_table_functions(spark: SparkSession) -> None:
    """Make ``page_links(html)`` and ``listing(html[, since])`` known to SQL."""
    spark.udtf.register("page_links", page_links)
    spark.udtf.register("listing", listing)
