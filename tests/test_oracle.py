"""Every registered Spark query against its DuckDB oracle at sf0.01."""

import pytest

from conftest import SF001
from oracle_harness import compare, duck
from textmill.plans import catalog
from textmill.plans.catalog import oracle_sql, queries

# Pinned, so that a query that loses its SQL fails here.
NAMES = [
    "absolute_url", "ascii_fold", "bigram_words", "blocked_hosts", "category_lookup", "centroid_distances",
    "chunked_lists", "clean_text", "cluster_keywords", "cluster_keywords_no_parts", "counts_rollup", "daily_window",
    "day_split_counts", "dedup_keep_first", "detect_language", "detect_language_grams", "distinct_rows",
    "doc_frequency", "drop_any_null", "embedding_silhouette", "high_water_mark", "high_water_mark_listing", "inertia",
    "json_flatten", "keywords_api_preset", "keywords_by_group", "keywords_reused", "labelled_scan",
    "language_profiles", "length_band", "nb_accuracy", "nb_classify", "nb_informative", "nb_train", "ngrams",
    "score_titles", "score_titles_category", "sentiment_tokens", "shorten", "silhouette", "silhouette_sample",
    "since_cutoff", "stamp_format", "stream_daily_window", "stream_dedup", "stream_dedup_history", "stream_ingest",
    "stream_scores", "stream_weekly_sliding", "strip_boilerplate", "strip_non_ascii", "tfidf", "tokenize",
    "tokens_no_stop", "topic_wide", "union_batches", "weekly_sliding", "window_scan",
]


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, queries()[name], oracle_sql()[name], SF001, con)
    assert r["match"], r


def test_no_query_has_lost_its_sql():
    assert sorted(oracle_sql()) == NAMES


def test_one_failing_oracle_hides_no_other(monkeypatch):
    def fails():
        raise FileNotFoundError("nowhere")

    monkeypatch.setitem(catalog._ORACLE, "window_scan", fails)
    with pytest.warns(UserWarning, match="window_scan"):
        assert set(NAMES) - set(oracle_sql()) == {"window_scan"}


def test_no_query_needs_files_beside_pyspark(monkeypatch):
    import glob
    import zipfile

    monkeypatch.setattr(glob, "glob", lambda *a, **k: [])
    monkeypatch.setattr(zipfile, "ZipFile", None)
    assert sorted(oracle_sql()) == NAMES
