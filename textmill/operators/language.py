"""Language identification as a column expression.

The reference calls a per-row statistical detector.  Here a document's
language is the profile language whose stop words it uses most, counted inside
the row: no explode, join or shuffle.  Ties go to the smaller language code; a
document with no profile word gets ``Error``, like a failed detection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.sources.stopwords import language_profiles

# Fixed value: the label of a text whose language cannot be determined.
UNDETECTED = "Error"
WORD_SPLIT = r"[^\p{L}]+"


def language_of(text_col: str = "description") -> Column:
    """The detected language of a text column."""
    words = F.split(F.lower(F.col(text_col)), WORD_SPLIT)
    profiles: dict[str, list[str]] = {}
    for lang, word in language_profiles():
        profiles.setdefault(lang, []).append(word)

    def counted(rank: int, lang: str) -> Column:
        return F.struct(F.size(F.filter(words, lambda w: w.isin(profiles[lang]))).alias("n"), F.lit(-rank).alias("rank"),
                        F.lit(lang).alias("lang"))

    best = F.greatest(*[counted(i, lang) for i, lang in enumerate(sorted(profiles))])
    return F.when(best["n"] > 0, best["lang"]).otherwise(F.lit(UNDETECTED))


def detect_language(df: DataFrame, text_col: str = "description", id_col: str = "doc_id",
                    out_col: str = "language") -> DataFrame:
    """``id_col, out_col`` for every row of ``df``."""
    return df.select(id_col, language_of(text_col).alias(out_col))


def filter_languages(df: DataFrame, languages: Sequence[str], text_col: str = "description",
                     out_col: str = "language") -> DataFrame:
    """Keep rows in ``languages`` and add ``out_col``; an empty list keeps
    every row and adds no column (as in the reference)."""
    if not languages:
        return df
    return df.withColumn(out_col, language_of(text_col)).filter(F.col(out_col).isin(list(languages)))
