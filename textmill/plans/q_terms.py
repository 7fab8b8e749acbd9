"""Queries over article text: cleaning, tokens, keywords, n-grams, TF-IDF."""

from __future__ import annotations

from pyspark.sql import functions as F

from textmill.functions.text import clean_text, word_tokens
from textmill.operators.terms import (
    TOP_KEYWORDS,
    bigram_words,
    keywords_by_group,
    term_frequencies,
    tfidf,
    with_kept_tokens,
    with_vectorizer_terms,
    vocabulary,
)
from textmill.plans.catalog import register
from textmill.operators.filters import API_MAX_CHARS
from textmill.plans.corpus import API_PRESET, article_corpus
from textmill.plans.sqltext import (
    clean_sql,
    corpus_sql,
    kept_terms_sql,
    pairs_sql,
    tokens_sql,
    words_sql,
)
from textmill.sources.tables import table


def _terms_corpus(spark, sf_dir):
    corpus = article_corpus(spark, sf_dir).select("doc_id", "source", "tokens")
    return with_vectorizer_terms(corpus).select("doc_id", "source", "terms")


def _kept_corpus(spark, sf_dir):
    """The tokens that the terms are made of, a quarter of their bytes."""
    corpus = article_corpus(spark, sf_dir).select("doc_id", "source", "tokens")
    return with_kept_tokens(corpus).select("doc_id", "source", "kept")


def _terms_cte() -> str:
    return (f"c AS ({corpus_sql()}), "
            f"k AS (SELECT doc_id, source, {kept_terms_sql('tokens')} AS kept FROM c), "
            f"tm AS (SELECT doc_id, source, list_concat(kept, {pairs_sql('kept')}) AS terms FROM k), "
            f"tf AS (SELECT doc_id, term, count(*) AS tf FROM "
            f"(SELECT doc_id, unnest(terms) AS term FROM tm) GROUP BY doc_id, term)")


# -- flagship: A1 top keywords per group ------------------------------------

def _keywords_sql() -> str:
    return (f"WITH c AS ({corpus_sql()}), "
            f"x AS (SELECT source, unnest(tokens) AS token FROM c), "
            f"g AS (SELECT source, token, count(*) AS n FROM x GROUP BY source, token), "
            f"r AS (SELECT source, token, n, row_number() OVER (PARTITION BY source "
            f"ORDER BY n DESC, token) - 1 AS rank FROM g) "
            f"SELECT source, rank, token, n FROM r WHERE rank < {TOP_KEYWORDS}")


@register("keywords_by_group", _keywords_sql)
def q_keywords_by_group(spark, sf_dir):
    return keywords_by_group(article_corpus(spark, sf_dir), "source", TOP_KEYWORDS)


@register("keywords_reused", _keywords_sql)
def q_keywords_reused(spark, sf_dir):
    """The keywords stored once, then read again without their input."""
    from textmill.session import scratch_path
    from textmill.sources.results import ResultStore

    store = ResultStore(spark, scratch_path(spark, "results"))

    def ask():
        return store.get("keywords", [f"{sf_dir}/documents.parquet"], {"top": TOP_KEYWORDS, "group": "source"},
                         lambda: q_keywords_by_group(spark, sf_dir))

    ask()
    return ask()


def _api_keywords_sql() -> str:
    return (f"WITH c AS ({corpus_sql(max_chars=API_MAX_CHARS)}), "
            f"x AS (SELECT source, unnest(tokens) AS token FROM c), "
            f"g AS (SELECT source, token, count(*) AS n FROM x GROUP BY source, token), "
            f"r AS (SELECT source, token, n, row_number() OVER (PARTITION BY source "
            f"ORDER BY n DESC, token) - 1 AS rank FROM g) "
            f"SELECT source, rank, token, n FROM r WHERE rank < {TOP_KEYWORDS}")


@register("keywords_api_preset", _api_keywords_sql)
def q_keywords_api_preset(spark, sf_dir):
    """The API script's preset end to end: its length band as well."""
    return keywords_by_group(article_corpus(spark, sf_dir, API_PRESET), "source", TOP_KEYWORDS)


# -- F1 clean_text, F3 tokenize, J3 tokens_no_stop ---------------------------

@register("clean_text", lambda: f"SELECT doc_id, {clean_sql('text')} AS clean FROM documents")
def q_clean_text(spark, sf_dir):
    return table(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id", clean_text("text").alias("clean"))


@register("tokenize", lambda: (f"SELECT doc_id, array_to_string({words_sql(clean_sql('text'))}, ' ') "
                               f"AS tokens, len({words_sql(clean_sql('text'))}) AS n_tokens FROM documents"))
def q_tokenize(spark, sf_dir):
    words = (table(spark, sf_dir, "documents", "doc_id", "text")
             .select("doc_id", word_tokens(clean_text("text")).alias("w")))
    return words.select("doc_id", F.array_join("w", " ").alias("tokens"),
                        F.size("w").cast("bigint").alias("n_tokens"))


@register("tokens_no_stop", lambda: (f"SELECT doc_id, array_to_string(tokens, ' ') AS tokens, "
                                     f"len(tokens) AS n_tokens FROM (SELECT doc_id, {tokens_sql('text')} "
                                     f"AS tokens FROM documents)"))
def q_tokens_no_stop(spark, sf_dir):
    from textmill.functions.text import tokenize
    from textmill.sources.stopwords import topic_stop_words

    toks = (table(spark, sf_dir, "documents", "doc_id", "text")
            .select("doc_id", tokenize("text", topic_stop_words()).alias("t")))
    return toks.select("doc_id", F.array_join("t", " ").alias("tokens"),
                       F.size("t").cast("bigint").alias("n_tokens"))


# -- F4 ngrams, A2 doc_frequency, A3 tfidf, A4 bigram_words --------------------

@register("ngrams", lambda: f"WITH {_terms_cte()} SELECT doc_id, term, tf FROM tf")
def q_ngrams(spark, sf_dir):
    return term_frequencies(_terms_corpus(spark, sf_dir))


@register("doc_frequency", lambda: (f"WITH {_terms_cte()} SELECT term, count(*) AS df FROM tf "
                                    f"GROUP BY term HAVING count(*) >= 5"))
def q_doc_frequency(spark, sf_dir):
    return vocabulary(_terms_corpus(spark, sf_dir))


def _tfidf_sql() -> str:
    return (f"WITH {_terms_cte()}, "
            f"n AS (SELECT count(*)::DOUBLE AS n FROM c), "
            f"v AS (SELECT term, count(*) AS df FROM tf GROUP BY term HAVING count(*) >= 5), "
            f"w AS (SELECT tf.doc_id, tf.term, tf.tf * (ln((n.n + 1) / (v.df + 1)) + 1) AS w "
            f"FROM tf JOIN v ON tf.term = v.term, n), "
            f"nr AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY doc_id) "
            f"SELECT w.doc_id, w.term, round(w.w / nr.norm, 6) AS weight "
            f"FROM w JOIN nr ON w.doc_id = nr.doc_id")


@register("tfidf", _tfidf_sql)
def q_tfidf(spark, sf_dir):
    t = tfidf(_terms_corpus(spark, sf_dir))
    return t.select("doc_id", "term", F.round("weight", 6).alias("weight"))


@register("bigram_words", lambda: (f"WITH {_terms_cte()}, v AS (SELECT term FROM tf GROUP BY term "
                                   f"HAVING count(*) >= 5) SELECT DISTINCT unnest(string_split(term, ' ')) "
                                   f"AS word FROM v WHERE contains(term, ' ')"))
def q_bigram_words(spark, sf_dir):
    return bigram_words(vocabulary(_terms_corpus(spark, sf_dir)))
