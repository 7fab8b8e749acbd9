"""Statistical language identification by letter trigrams.

A profile per language is learned from labelled texts: the counts of the
trigrams of their lower-cased letters, a word being padded with one space on
either side.  The most frequent trigrams of every language together are the
vocabulary; each has a smoothed log-probability per language, in thousandths, so
that sums are whole numbers and equal on every run.  A text has the language of
the largest sum over its trigrams, scored inside the row.

Training reads at most ``SAMPLE_ROWS`` texts per language, chosen by a hash of
the id; the model holds ``PROFILE_GRAMS`` trigrams per language at most.

Defined results: a null or empty text, and one without a known trigram, is
``Error``; ties go to the smaller language code; without labelled texts every
language is ``Error``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from textmill.operators.language import UNDETECTED
from textmill.operators.terms import top_n_per_group

SAMPLE_ROWS = 300
PROFILE_GRAMS = 3000
MAX_LANGUAGES = 200
#: Smoothing: what a trigram that a language never shows counts as.
UNSEEN = 0.5
_SPACE = 32


def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def gram_keys(text: str | None, letters: np.ndarray) -> np.ndarray:
    """The trigrams of a text as numbers, three code points of 21 bits each."""
    raw = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "replace"), np.uint32)
    codes = np.where(letters[raw], raw, _SPACE).astype(np.int64)
    first = np.ones(len(codes), bool)  # of a run of spaces
    first[1:] = (codes[1:] != _SPACE) | (codes[:-1] != _SPACE)
    codes = codes[first]
    return (codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:]


def _gram(key: int) -> str:
    return "".join(chr(key >> s & 0x1FFFFF) for s in (42, 21, 0))


@dataclass(frozen=True)
class Profiles:
    """Sorted trigram numbers, and the weight of each for every language."""

    languages: list[str]
    keys: np.ndarray
    weights: np.ndarray

    def detect(self, texts, letters: np.ndarray) -> list[str]:
        out = []
        for text in texts:
            found = gram_keys(text, letters)
            at = np.searchsorted(self.keys, found)
            at[at == len(self.keys)] = 0
            known = at[self.keys[at] == found] if len(self.keys) else at[:0]
            # The largest sum; argmax takes the first of equal ones, and languages are in order.
            out.append(self.languages[int(self.weights[known].sum(0).argmax())] if len(known) else UNDETECTED)
        return out


def training_sample(docs: DataFrame, text_col: str, lang_col: str, id_col: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled texts per language, the first by a hash of the id."""
    labelled = docs.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    order = [F.md5(F.col(id_col).cast("string").cast("binary")), F.col(id_col)]
    chosen = top_n_per_group(labelled.select(id_col, lang_col), [lang_col], rows, order).select(id_col, lang_col)
    return docs.select(id_col, text_col, lang_col).join(F.broadcast(chosen), [id_col, lang_col])  # rows x languages at most


def gram_counts(sample: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``lang, gram, n`` over all texts; counted inside the tasks first."""
    def run(batches):
        letters = _letters_of_worker()
        for pdf in batches:
            for lang, texts in pdf.groupby("lang")["text"]:
                keys, n = np.unique(np.concatenate([gram_keys(t, letters) for t in texts]), return_counts=True)
                yield pd.DataFrame({"lang": lang, "gram": keys, "n": n})

    rows = sample.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    return (rows.mapInPandas(run, "lang string, gram bigint, n bigint")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def learn_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
                   rows: int = SAMPLE_ROWS, grams: int = PROFILE_GRAMS) -> Profiles:
    """Profiles of the languages of ``lang_col``."""
    counts = gram_counts(training_sample(docs, text_col, lang_col, id_col, rows), text_col, lang_col)
    top = top_n_per_group(counts, ["lang"], grams, [F.desc("n"), F.asc("gram")]).select("gram").distinct()
    # All languages' counts of the vocabulary, and each language's total.
    table = counts.join(top, "gram", "left_semi").unionByName(
        counts.groupBy("lang").agg(F.sum("n").alias("n")).withColumn("gram", F.lit(-1).cast("bigint")))
    found = table.toPandas()  # languages x vocabulary at most
    languages = sorted(found["lang"].unique())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    keys = np.array(sorted(set(found["gram"]) - {-1}), np.int64)
    n = np.zeros((len(keys), len(languages)))
    total = np.ones(len(languages))
    for lang, of in found.groupby("lang"):
        j = languages.index(lang)
        mine = of[of["gram"] >= 0]
        n[np.searchsorted(keys, mine["gram"]), j] = mine["n"]
        total[j] = of.loc[of["gram"] < 0, "n"].sum()
    weights = np.round(1000 * np.log((n + UNSEEN) / (total + UNSEEN * len(keys)))).astype(np.int64)
    return Profiles(languages, keys, weights)


def language_by_grams(text_col: str, profiles: Profiles) -> Column:
    """The detected language of a text column.  Marked as not to be moved, so it
    runs where it is written: once per row, after whatever thins the rows."""
    @F.pandas_udf("string")
    def detect(batches: pd.Series) -> pd.Series:
        return pd.Series(profiles.detect(batches, _letters_of_worker()))

    return detect.asNondeterministic()(F.col(text_col))


def _letters_of_worker() -> np.ndarray:
    """``_letters``, kept as long as the Python worker lives."""
    import sys
    import types

    kept = sys.modules.setdefault("_textmill_letters", types.ModuleType("letters")).__dict__
    if "is" not in kept:
        kept["is"] = _letters()
    return kept["is"]


def profile_frame(spark, profiles: Profiles) -> DataFrame:
    """``lang, gram, weight``: the model as rows."""
    rows = [(lang, _gram(int(k)), int(profiles.weights[i, j]))
            for i, k in enumerate(profiles.keys) for j, lang in enumerate(profiles.languages)]
    return spark.createDataFrame(rows, StructType.fromDDL("lang string, gram string, weight bigint"))


def detect_by_grams(df: DataFrame, profiles: Profiles, text_col: str = "text", id_col: str = "doc_id",
                    out_col: str = "language") -> DataFrame:
    """``id_col, out_col`` for every row of ``df``."""
    return df.select(id_col, language_by_grams(text_col, profiles).alias(out_col))


def keep_languages(df: DataFrame, profiles: Profiles, languages: Sequence[str], text_col: str = "description",
                   out_col: str = "language") -> DataFrame:
    """Rows detected as one of ``languages``, with ``out_col``; an empty list
    keeps every row and adds no column."""
    if not languages:
        return df
    return df.withColumn(out_col, language_by_grams(text_col, profiles)).filter(F.col(out_col).isin(list(languages)))
