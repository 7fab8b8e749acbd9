"""The article corpus every topic and sentiment plan starts from.

SURVEY 3.1 stages "window -> null -> dedup -> language -> length -> tokens"
as one lazily-built DataFrame.  The length is a function of the text, so equal
texts pass or fail together and the cheap filter goes first; the text is
shuffled once, by the dedup, and its language detected once per text left.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from textmill.functions.text import tokenize
from textmill.operators.dedup import dedup_keep_first
from textmill.operators.filters import API_MAX_CHARS, MIN_CHARS_EXCLUSIVE, drop_null_text, length_band, not_blocked_source
from textmill.operators.language import filter_languages
from textmill.operators.ngrams import Profiles, keep_languages, learn_profiles
from textmill.sources.stopwords import topic_stop_words
from textmill.sources.tables import articles


@dataclass(frozen=True)
class Preset:
    """Differences between the two topic scripts of the reference."""

    min_chars_exclusive: int = MIN_CHARS_EXCLUSIVE
    max_chars_inclusive: int | None = None
    strip_boilerplate: bool = False
    optimize_k: bool = False
    blocked_sources: tuple[str, ...] = ()  # P8, off in both scripts


API_PRESET = Preset(max_chars_inclusive=API_MAX_CHARS, optimize_k=True)
PAGE_PRESET = Preset()


def prepare_articles(df: DataFrame, preset: Preset = PAGE_PRESET, languages: Sequence[str] = ("en",),
                     stop_words: Sequence[str] | None = None, text_col: str = "description",
                     profiles: Profiles | None = None) -> DataFrame:
    """P1 -> A5 -> language -> P4 -> tokens over any article-shaped frame.

    The language is identified from the text, by trigram ``profiles`` or else by
    stop words, and returned as ``lang``; an empty ``languages`` list means no
    language filter.  Of equal texts the one with the first ``batch_stamp`` and
    ``doc_id`` stays, as far as the frame has these columns; without either, the
    smallest of its other columns.
    """
    stop = list(stop_words) if stop_words is not None else topic_stop_words()
    df = drop_null_text(df, text_col)
    if preset.blocked_sources:
        df = not_blocked_source(df, "source", preset.blocked_sources)
    order = [c for c in ("batch_stamp", "doc_id") if c in df.columns] or [c for c in df.columns if c != text_col]
    df = length_band(df, text_col, preset.min_chars_exclusive, preset.max_chars_inclusive)
    df = dedup_keep_first(df, text_col, order)
    if profiles is None:
        df = filter_languages(df, languages, text_col, "lang")
    else:
        df = keep_languages(df, profiles, languages, text_col, "lang")
    return df.withColumn("tokens", tokenize(text_col, stop, preset.strip_boilerplate))


def article_corpus(spark: SparkSession, sf_dir: str, preset: Preset = PAGE_PRESET,
                   languages: Sequence[str] = ("en",), stop_words: Sequence[str] | None = None) -> DataFrame:
    """The corpus over the ``documents`` table, with language profiles learned
    from its labelled rows."""
    df = articles(spark, sf_dir)
    profiles = learn_profiles(df, "description") if languages else None
    return prepare_articles(df, preset, languages, stop_words, profiles=profiles)
