"""Queries over raw pages and language identification."""

from __future__ import annotations

from pyspark.sql import functions as F

from textmill.operators import html
from textmill.operators.language import UNDETECTED, WORD_SPLIT, detect_language
from textmill.operators.filters import fetched_ok, not_blocked
from textmill.operators.ngrams import detect_by_grams, learn_profiles, profile_frame
from textmill.plans.catalog import register
from textmill.plans.sqltext import gram_language_sql, gram_profile_sql, lit, lower_sql
from textmill.sources.stopwords import language_profiles
from textmill.sources.tables import table


@register("page_text")
def q_page_text(spark, sf_dir):
    """H1 + H2 + P7 + P11: visible text of every fetched page whose host is not
    blocked.  A page without html stands for a failed fetch."""
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    fetched = pages.withColumn("status", F.when(F.col("html").isNull(), "failed").otherwise("ok"))
    return html.page_text(not_blocked(fetched_ok(fetched), "url"))


@register("listing_articles")
def q_listing_articles(spark, sf_dir):
    """H3: listed articles (headline, time, source, link) of every page."""
    return html.listing_articles(table(spark, sf_dir, "pages", "page_id", "html"))


@register("page_links")
def q_page_links(spark, sf_dir):
    """H4 building block: every link of every page."""
    return html.page_links(table(spark, sf_dir, "pages", "page_id", "html"))


@register("page_links_lateral")
def q_page_links_lateral(spark, sf_dir):
    """2.12: the links by a lateral join with the table function."""
    from textmill.operators.html_udtf import register_table_functions

    register_table_functions(spark)
    return spark.sql("SELECT p.page_id, l.* FROM {pages} p, LATERAL page_links(p.html) l",
                     pages=table(spark, sf_dir, "pages", "page_id", "html"))


@register("category_urls")
def q_category_urls(spark, sf_dir):
    """H4: per page, the first link labelled with each section category."""
    return html.category_links(table(spark, sf_dir, "pages", "page_id", "html"))


def _language_sql() -> str:
    prof = ", ".join(f"({lit(la)}, {lit(w)})" for la, w in language_profiles())
    return (f"WITH w AS (SELECT doc_id, unnest(string_split_regex({lower_sql('text')}, {lit(WORD_SPLIT)})) "
            f"AS word FROM documents), "
            f"p AS (SELECT * FROM (VALUES {prof}) p(lang, word)), "
            f"h AS (SELECT w.doc_id, p.lang, count(*) AS n FROM w JOIN p ON w.word = p.word GROUP BY 1, 2), "
            f"r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, lang) AS rn "
            f"FROM h) "
            f"SELECT d.doc_id, coalesce(r.lang, '{UNDETECTED}') AS language FROM documents d "
            f"LEFT JOIN r ON d.doc_id = r.doc_id AND r.rn = 1")


@register("detect_language", _language_sql)
def q_detect_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return detect_language(docs, "text", "doc_id", "language")


@register("detect_language_grams", lambda: (
    f"SELECT d.doc_id, coalesce(g.language, '{UNDETECTED}') AS language FROM documents d "
    f"LEFT JOIN ({gram_language_sql()}) g ON d.doc_id = g.doc_id"))
def q_detect_language_grams(spark, sf_dir):
    """The language of every document by trigram profiles learned from the labelled rows."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return detect_by_grams(docs, learn_profiles(docs))


@register("language_profiles", lambda: f"WITH {gram_profile_sql()} SELECT lang, gram, weight FROM gw")
def q_language_profiles(spark, sf_dir):
    """The learned profiles, a weight per language and trigram."""
    return profile_frame(spark, learn_profiles(table(spark, sf_dir, "documents", "doc_id", "text", "lang")))
