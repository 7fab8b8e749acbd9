"""Sentiment queries.

Labelled rows come from ``labels`` joined to ``documents``: toxic -> negative,
else quality -> positive, else neutral.  Training tokens drop English stop
words, scoring tokens do not (as in the reference; stop words were never
learned, so the known-token join drops them anyway).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from textmill.functions.text import sentiment_tokens, title_of
from textmill.operators import sentiment as nb
from textmill.operators.dedup import dedup_keep_first
from textmill.operators.filters import category_is
from textmill.operators.language import filter_languages
from textmill.plans.catalog import register
from textmill.plans.sqltext import language_sql, lit, sentiment_tokens_sql
from textmill.sources.articles import SENTIMENT_LABELS
from textmill.sources.stopwords import stop_words
from textmill.session import written
from textmill.sources.tables import table

LABELS = list(SENTIMENT_LABELS)


def labelled_docs(spark, sf_dir):
    """S3 stand-in: ``doc_id, label, text``."""
    labels = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    label = (F.when(F.col("toxic") == 1, "negative")
             .when(F.col("quality") == 1, "positive").otherwise("neutral"))
    return labels.join(docs, "doc_id").select("doc_id", label.alias("label"), "text")


def _split(spark, sf_dir):
    from textmill.session import materialize

    lab = labelled_docs(spark, sf_dir)
    tr, te = nb.split_train_test(lab)
    # Training tokens feed the model and every label statistic; write them
    # once instead of re-tokenising per branch.
    tr = materialize(tr.select("doc_id", "label",
                               sentiment_tokens("text", stop_words("en")).alias("tokens")))
    te = te.select("doc_id", "label", sentiment_tokens("text").alias("tokens"))
    return tr, te


# ---------------------------------------------------------------------------- SQL

_LABEL_SQL = ("CASE WHEN l.toxic = 1 THEN 'negative' WHEN l.quality = 1 THEN 'positive' "
              "ELSE 'neutral' END")


def _model_cte() -> str:
    stop = stop_words("en")
    cnt = ", ".join(f"count(*) FILTER (WHERE label = '{x}') AS c_{x}" for x in LABELS)
    ncnt = ", ".join(f"count(*) FILTER (WHERE label = '{x}') AS n_{x}" for x in LABELS)
    seen = " + ".join(f"max(CASE WHEN label = '{x}' THEN 1 ELSE 0 END)" for x in LABELS)
    total = " + ".join(f"m.c_{x}" for x in LABELS)
    lps = ", ".join(
        f"ln((m.c_{x} + 0.5) / (st.n_{x} + 0.5 * CASE WHEN {total} < st.n THEN 2.0 ELSE 1.0 END)) AS lp_{x}"
        for x in LABELS)
    return (f"lab AS (SELECT l.doc_id, {_LABEL_SQL} AS label, d.text FROM labels l JOIN documents d "
            f"ON l.doc_id = d.doc_id), "
            f"tr AS (SELECT doc_id, label, list_distinct({sentiment_tokens_sql('text', stop)}) AS toks "
            f"FROM lab WHERE doc_id % 4 < 3), "
            f"te AS (SELECT doc_id, label, list_distinct({sentiment_tokens_sql('text')}) AS toks "
            f"FROM lab WHERE doc_id % 4 = 3), "
            f"st AS (SELECT count(*) AS n, {ncnt}, {seen} AS n_labels FROM tr), "
            f"m AS (SELECT token, {cnt} FROM (SELECT label, unnest(toks) AS token FROM tr) GROUP BY token), "
            f"lp AS (SELECT m.token, {lps} FROM m, st)")


def _scores_cte(docs: str) -> str:
    """Scores of the documents of CTE ``docs`` (doc_id, toks)."""
    sums = ", ".join(f"sum(lp.lp_{x}) AS s_{x}" for x in LABELS)
    scores = ", ".join(
        f"CASE WHEN st.n_{x} > 0 THEN ln((st.n_{x} + 0.5) / (st.n + 0.5 * st.n_labels)) "
        f"+ coalesce(s.s_{x}, 0) END AS score_{x}" for x in LABELS)
    return (f"s AS (SELECT t.doc_id, {sums} FROM (SELECT doc_id, unnest(toks) AS token FROM {docs}) t "
            f"JOIN lp ON t.token = lp.token GROUP BY t.doc_id), "
            f"sc AS (SELECT {docs}.doc_id, {scores} FROM {docs} LEFT JOIN s ON {docs}.doc_id = s.doc_id, st)")


def _prediction_sql() -> str:
    best = "greatest(" + ", ".join(f"score_{x}" for x in LABELS) + ")"
    whens = " ".join(f"WHEN score_{x} = {best} THEN '{x}'" for x in sorted(LABELS))
    return f"CASE {whens} END"


# ---------------------------------------------------------------------------- queries

@register("labelled_scan", lambda: (
    f"SELECT l.doc_id, {_LABEL_SQL} AS label FROM labels l JOIN documents d ON l.doc_id = d.doc_id"))
def q_labelled_scan(spark, sf_dir):
    return labelled_docs(spark, sf_dir).select("doc_id", "label")


@register("sentiment_tokens", lambda: (
    f"SELECT doc_id, array_to_string(t, ' ') AS tokens, len(t) AS n_tokens FROM "
    f"(SELECT doc_id, {sentiment_tokens_sql('text', stop_words('en'))} AS t FROM documents)"))
def q_sentiment_tokens(spark, sf_dir):
    t = table(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id", sentiment_tokens("text", stop_words("en")).alias("t"))
    return t.select("doc_id", F.array_join("t", " ").alias("tokens"),
                    F.size("t").cast("bigint").alias("n_tokens"))


@register("nb_train", lambda: (
    f"WITH {_model_cte()} SELECT token, " + ", ".join(f"c_{x}" for x in LABELS) + " FROM m"))
def q_nb_train(spark, sf_dir):
    tr, _ = _split(spark, sf_dir)
    model, _stats = nb.train(tr, "tokens", LABELS)
    return model


@register("nb_classify", lambda: (
    f"WITH {_model_cte()}, {_scores_cte('te')} SELECT doc_id, "
    + ", ".join(f"round(score_{x}, 6) AS score_{x}" for x in LABELS)
    + f", {_prediction_sql()} AS prediction FROM sc"))
def q_nb_classify(spark, sf_dir):
    tr, te = _split(spark, sf_dir)
    model, stats = nb.train(tr, "tokens", LABELS)
    out = nb.classify(te, model, stats, "doc_id", "tokens", LABELS)
    return out.select("doc_id", *[F.round(f"score_{x}", 6).alias(f"score_{x}") for x in LABELS], "prediction")


@register("nb_accuracy", lambda: (
    f"WITH {_model_cte()}, {_scores_cte('te')}, p AS (SELECT sc.doc_id, {_prediction_sql()} AS prediction "
    f"FROM sc) SELECT avg(CASE WHEN p.prediction = te.label THEN 1.0 ELSE 0.0 END) AS accuracy, "
    f"count(*) AS n_test FROM p JOIN te ON p.doc_id = te.doc_id"))
def q_nb_accuracy(spark, sf_dir):
    tr, te = _split(spark, sf_dir)
    model, stats = nb.train(tr, "tokens", LABELS)
    pred = nb.classify(te, model, stats, "doc_id", "tokens", LABELS)
    return nb.accuracy(pred.join(te.select("doc_id", "label"), "doc_id"))


def _informative_sql() -> str:
    total = " + ".join(f"m.c_{x}" for x in LABELS)
    bins = f"CASE WHEN {total} < st.n THEN 2.0 ELSE 1.0 END"
    pres = ", ".join(f"CASE WHEN m.c_{x} > 0 THEN (m.c_{x} + 0.5) / (st.n_{x} + 0.5 * {bins}) END" for x in LABELS)
    absn = ", ".join(
        f"CASE WHEN st.n_{x} - m.c_{x} > 0 THEN (st.n_{x} - m.c_{x} + 0.5) / (st.n_{x} + 0.5 * {bins}) END"
        for x in LABELS)
    return (f"WITH {_model_cte()}, f AS ("
            f"SELECT m.token, 'True' AS value, greatest({pres}) AS hi, least({pres}) AS lo FROM m, st "
            f"UNION ALL SELECT m.token, 'None', greatest({absn}), least({absn}) FROM m, st) "
            f"SELECT token, value, hi / lo AS ratio FROM f WHERE hi IS NOT NULL "
            f"ORDER BY ratio DESC, token, value LIMIT 10")


@register("nb_informative", _informative_sql)
def q_nb_informative(spark, sf_dir):
    tr, _ = _split(spark, sf_dir)
    model, stats = nb.train(tr, "tokens", LABELS)
    return nb.informative_features(model, stats, 10, LABELS)


def _titles_sql(category: str | None = None) -> str:
    chosen = "SELECT doc_id, text, source FROM documents WHERE text IS NOT NULL" + (
        f" AND lower(source) = {lit(category.lower())}" if category else "")
    return (f"WITH {_model_cte()}, "
            f"ti AS (SELECT doc_id, split_part(text, chr(10), 1) AS title FROM "
            f"(SELECT doc_id, text FROM ({chosen}) QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1) "
            f"WHERE {language_sql('text')} = 'en'), "
            f"tt AS (SELECT doc_id, list_distinct({sentiment_tokens_sql('title')}) AS toks FROM ti), "
            f"{_scores_cte('tt')} SELECT ti.doc_id, ti.title, {_prediction_sql()} AS sentiment "
            f"FROM sc JOIN ti ON sc.doc_id = ti.doc_id")


#: The category of the registered query (P5); ``documents`` has sources for categories.
TITLE_CATEGORY = "SRC3"


@register("score_titles", _titles_sql)
def q_score_titles(spark, sf_dir):
    """N3 + S10: titles of the deduplicated English articles with a label."""
    return _scored_titles(spark, sf_dir)


@register("score_titles_category", lambda: _titles_sql(TITLE_CATEGORY))
def q_score_titles_category(spark, sf_dir):
    """N3 + P5: the same for the articles of one category."""
    return _scored_titles(spark, sf_dir, TITLE_CATEGORY)


def _scored_titles(spark, sf_dir, category=None):
    tr, _ = _split(spark, sf_dir)
    model, stats = nb.train(tr, "tokens", LABELS)
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source").filter(F.col("text").isNotNull())
    if category is not None:
        docs = category_is(docs, category, "source")
    arts = filter_languages(dedup_keep_first(docs, "text", ["doc_id"]), ["en"], "text")
    # Written once: the titles are read again beside their scores.
    titles = written(arts.select("doc_id", title_of("text").alias("title")), "titles")
    toks = titles.select("doc_id", sentiment_tokens("title").alias("tokens"))
    scored = nb.classify(toks, model, stats, "doc_id", "tokens", LABELS)
    return titles.join(scored.select("doc_id", F.col("prediction").alias("sentiment")), "doc_id")
