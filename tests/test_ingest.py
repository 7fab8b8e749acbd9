"""Sources and sinks of the ingest path on small files."""

import json
from datetime import datetime

from pyspark.sql import functions as F

from textmill.operators.filters import category_is, fetched_ok
from textmill.sources.articles import flatten_pages, label_articles, read_catalogue, read_labelled, read_pages
from textmill.sources.batches import append_run, write_points


def _article(i, source="s1", **more):
    return {"source": {"id": source, "name": source}, "author": "a", "title": f"t{i}", "description": "d", "url": f"u{i}",
            "urlToImage": "x", "publishedAt": "2020-01-01T00:00:00Z", "content": "c"} | more


def test_pages_flatten_label_and_drop_nulls(spark, tmp_path):
    pages = [{"status": "ok", "totalResults": 2, "articles": [_article(1), _article(2, "s2", urlToImage=None)]},
             {"status": "ok", "totalResults": 1, "articles": [_article(3, "unknown"), _article(3, "unknown")]},
             {"status": "error"}, {"status": "ok", "articles": []}]
    (tmp_path / "p.json").write_text("\n".join(map(json.dumps, pages)) + "\nnot json")
    arts, rejects = flatten_pages(read_pages(spark, str(tmp_path / "p.json")), datetime(2020, 1, 2))
    assert arts.count() == 4 and rejects.count() == 2
    assert {r.source for r in arts.collect()} == {"s1", "s2", "unknown"} and "scraping_date" in arts.columns
    (tmp_path / "c.json").write_text(json.dumps({"sources": [{"id": "s1", "category": "Business"}, {"id": "s2", "category": "x"}]}))
    catalogue = read_catalogue(spark, str(tmp_path / "c.json"))
    whole = label_articles(arts.dropna().distinct(), catalogue)
    assert sorted((r.title, r.category) for r in whole.collect()) == [("t1", "Business"), ("t3", "NC")]
    assert [r.title for r in category_is(whole, "business").collect()] == ["t1"]
    out = str(tmp_path / "runs")
    for _ in range(2):  # a repeated run replaces its own batch
        name = append_run(whole, out, datetime(2020, 1, 2, 3))
    append_run(whole.limit(1), out, datetime(2020, 1, 3))
    rows = spark.read.parquet(out).groupBy("batch_name").count().collect()
    assert sorted(r["count"] for r in rows) == [1, 2] and len(name) == 17


def test_labelled_csv(spark, tmp_path):
    (tmp_path / "l.csv").write_bytes('positive,"caf\xe9, ""good"""\nneutral,plain\nodd,x\n'.encode("latin-1"))
    rows, rejects = read_labelled(spark, str(tmp_path / "l.csv"))
    assert sorted((r.label, r.text) for r in rows.collect()) == [("neutral", "plain"), ("positive", 'café, "good"')]
    assert rejects.count() == 1


def test_point_table_is_written_and_read_again(spark, tmp_path):
    points = spark.createDataFrame([(0.5, -1.25, "3", 'a "b",\nc'), (1.0, 2.0, "1", "d")], "x double, y double, cluster string, headline string")
    assert sorted(write_points(points, str(tmp_path / "pts")).collect()) == sorted(points.collect())


def test_fetched_pages_only(spark):
    rows = spark.createDataFrame([("ok", 1), ("timeout", 2), (None, 3)], "status string, page_id long")
    assert [r.page_id for r in fetched_ok(rows).collect()] == [1]


def test_readme_example(spark, tmp_path):
    from textmill.operators.terms import keywords_by_group, tfidf, with_vectorizer_terms
    from textmill.plans.corpus import API_PRESET, prepare_articles
    from textmill.sources.batches import load_window

    text = "the market and the bank of the city were in the news about money markets " * 3
    for day in (1, 2):
        (tmp_path / f"2020-01-0{day}T000000.csv").write_text(f'source,category,description\ns1,business,"{text}"\ns2,world,short\n')
    batches = load_window(spark, str(tmp_path), to_ts=datetime(2020, 1, 8), days=7,
                          schema="source string, category string, description string")
    corpus = prepare_articles(batches, API_PRESET)
    assert [(r.category, r.lang, r.batch_stamp) for r in corpus.collect()] == [("business", "en", "2020-01-01T000000")]
    assert {r.token for r in keywords_by_group(corpus, "category", 3).collect()} <= set(text.split())
    assert tfidf(with_vectorizer_terms(corpus).withColumn("doc_id", F.lit(1)), min_df=1).count() > 5
