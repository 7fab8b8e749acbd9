import numpy as np
from pyspark.sql import functions as F

from conftest import SF001
from textmill.operators.ngrams import (
    SAMPLE_ROWS,
    detect_by_grams,
    gram_keys,
    keep_languages,
    learn_profiles,
    training_sample,
    _gram,
    _letters,
)
from textmill.sources.tables import table

DDL = "doc_id long, text string, lang string, language string"


def toy(spark):
    rows = [(i, t, lang, "clash") for i, (t, lang) in enumerate([("the cat and the hat", "en"), ("that other thing", "en"),
                                                                ("der Hund und die Katze", "de"), ("durch die Nacht", "de")] * 5)]
    return spark.createDataFrame(rows, DDL)


def accuracy(spark, short=None):
    docs = table(spark, SF001, "documents", "doc_id", "text", "lang")
    seen = training_sample(docs, "text", "lang", "doc_id", SAMPLE_ROWS // 3).select("doc_id")
    profiles = learn_profiles(docs, rows=SAMPLE_ROWS // 3)
    unseen = docs.join(seen, "doc_id", "left_anti").filter(F.length(F.trim("text")) >= 40)
    if short:
        unseen = unseen.withColumn("text", F.substring("text", 1, short))
    got = detect_by_grams(unseen, profiles).join(unseen.select("doc_id", "lang"), "doc_id")
    share, n = got.agg(F.avg((F.col("language") == F.col("lang")).cast("double")), F.count("*")).first()
    assert n > 300
    return share


def test_held_out_accuracy(spark):
    assert accuracy(spark) >= 0.98


def test_short_text_accuracy(spark):
    assert accuracy(spark, 40) >= 0.9


def test_grams_of_a_text():
    got = [_gram(int(k)) for k in gram_keys("Ab1 -c", _letters())]
    assert got == [" ab", "ab ", "b c", " c "] or got == [" ab", "ab ", "b c", " c "]
    assert len(gram_keys(None, _letters())) == 0 and len(gram_keys("12 !", _letters())) == 0


def test_odd_texts_ties_and_empty_tables(spark):
    docs = toy(spark)
    profiles = learn_profiles(docs)
    assert profiles.languages == ["de", "en"]
    odd = spark.createDataFrame([(1, None, None, "x"), (2, "", None, "x"), (3, "12 !", None, "x"), (4, "中文", None, "x"),
                                 (5, "the hat " * 200_000, None, "x"), (6, "die Katze", None, "x"), (6, "die Katze", None, "x")], DDL)
    got = sorted((r.doc_id, r.language) for r in detect_by_grams(odd, profiles).collect())
    assert got == [(1, "Error"), (2, "Error"), (3, "Error"), (4, "Error"), (5, "en"), (6, "de"), (6, "de")]
    none = learn_profiles(docs.limit(0))
    assert {r.language for r in detect_by_grams(odd, none).collect()} == {"Error"}
    assert keep_languages(odd, profiles, [], "text").columns == odd.columns
    assert {r.doc_id for r in keep_languages(odd, profiles, ["de"], "text").collect()} == {6}


def test_equal_sums_go_to_the_smaller_code(spark):
    rows = [(1, "abc", "xx", ""), (2, "abc", "aa", "")]
    profiles = learn_profiles(spark.createDataFrame(rows, DDL))
    assert profiles.detect(["abc"], _letters()) == ["aa"]
    assert profiles.weights.dtype == np.int64


def test_detection_runs_after_the_dedup(spark):
    from textmill.plans.corpus import article_corpus

    plan = article_corpus(spark, SF001).select("doc_id", "tokens")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("detect(") <= 2 and plan.index("ArrowEvalPython") < plan.index("LeftSemi")
