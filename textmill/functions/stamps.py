"""Batch stamps, URLs and chunking helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# Batch file stamp: ISO seconds without colons, e.g. 2020-06-15T120000.
STAMP_FORMAT = "yyyy-MM-dd'T'HHmmss"
# ISO form used inside the articles, e.g. 2020-06-15T12:00:00Z.
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
# Date part used in titles.
DAY_FORMAT = "yyyy-MM-dd"
# Base the listing links are relative to.
NEWS_BASE_URL = "https://news.google.com"
# Source ids per API request.
SOURCE_CHUNK_SIZE = 19
# ---------------------------------------------------------------------------

# DuckDB spellings of the same formats, for the oracle SQL.
STAMP_FORMAT_SQL = "%Y-%m-%dT%H%M%S"
ISO_FORMAT_SQL = "%Y-%m-%dT%H:%M:%SZ"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def stamp(ts) -> Column:
    """timestamp -> batch stamp (seconds truncated)."""
    return F.date_format(_c(ts), STAMP_FORMAT)


def parse_stamp(s) -> Column:
    """F7 inverse: batch stamp -> timestamp (null for a malformed stamp)."""
    return F.try_to_timestamp(_c(s), F.lit(STAMP_FORMAT))


def iso(ts) -> Column:
    return F.date_format(_c(ts), ISO_FORMAT)


def day_of(ts) -> Column:
    """F8: date part of a timestamp as text."""
    return F.date_format(_c(ts), DAY_FORMAT)


def file_stem(name) -> Column:
    """file name up to the first dot."""
    return F.substring_index(_c(name), ".", 1)


def absolute_url(fragment, base: str = NEWS_BASE_URL) -> Column:
    """base + fragment without its first character (``./x`` -> ``base/x``)."""
    return F.concat(F.lit(base), F.substring(_c(fragment), 2, 1 << 30))
