"""Row filters.  Each is a ``DataFrame -> DataFrame`` step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# Hosts whose pages are dropped after fetching (substring of the final URL).
BLOCKED_HOSTS = ["washingtonpost.com", "youtube.com"]
# Sources declared as blocked; the reference never applies this list.
BLOCKED_SOURCES = ["The Washington Post", "Miami Herald"]
# Length band of the article text, in characters: API preset keeps
# 141..300, page preset keeps more than 140.
MIN_CHARS_EXCLUSIVE = 140
API_MAX_CHARS = 300
# ---------------------------------------------------------------------------


def drop_null_text(df: DataFrame, col: str = "description") -> DataFrame:
    """Drop rows whose text is null."""
    return df.filter(F.col(col).isNotNull())


def drop_any_null(df: DataFrame) -> DataFrame:
    """Drop rows with a null in any column."""
    return df.na.drop(how="any")


def length_band(df: DataFrame, col: str = "description", min_exclusive: int = MIN_CHARS_EXCLUSIVE,
                max_inclusive: int | None = None) -> DataFrame:
    """Keep ``min_exclusive < length <= max_inclusive`` (code points)."""
    n = F.length(col)
    cond = n > min_exclusive
    if max_inclusive is not None:
        cond = cond & (n <= max_inclusive)
    return df.filter(cond)


def category_is(df: DataFrame, value: str, col: str = "category") -> DataFrame:
    """P5: case-insensitive category equality."""
    return df.filter(F.lower(F.col(col)) == value.lower())


def not_blocked(df: DataFrame, col: str = "url", hosts: Sequence[str] = BLOCKED_HOSTS) -> DataFrame:
    """Drop rows whose URL contains any blocked host."""
    cond: Column = F.lit(True)
    for h in hosts:
        cond = cond & ~F.col(col).contains(h)
    return df.filter(cond)


def not_blocked_source(df: DataFrame, col: str = "source",
                       sources: Sequence[str] = BLOCKED_SOURCES) -> DataFrame:
    """Optional source block list (off in the reference's runs)."""
    return df.filter(~F.col(col).isin(list(sources)) | F.col(col).isNull())


def since(df: DataFrame, cutoff, col: str = "ts") -> DataFrame:
    """Keep rows at or after the cut-off (inclusive, like the reference)."""
    return df.filter(F.col(col) >= F.lit(cutoff))


def fetched_ok(df: DataFrame, col: str = "status") -> DataFrame:
    """Keep only successfully fetched pages."""
    return df.filter(F.col(col) == "ok")
