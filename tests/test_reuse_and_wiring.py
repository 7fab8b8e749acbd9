"""Kept results, batch listings, table functions and filters of the presets."""

import os
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from textmill.operators.clusters import centroid_sums, sparse_products
from textmill.operators.html_udtf import register_table_functions
from textmill.operators.indexing import dense_index
from textmill.operators.kmeans import number_of_clusters
from textmill.plans.corpus import PAGE_PRESET, prepare_articles
from textmill.sources.batches import append_batch
from textmill.sources.results import ResultStore, latest_batch, list_files


def test_second_run_reads_the_result_and_changes_recompute(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(5).write.parquet(source)
    store, built = ResultStore(spark, str(tmp_path / "store")), []

    def ask(params=None):
        def build():
            built.append(1)
            return spark.read.parquet(source).agg(F.count("*").alias("n"))

        return store.get("count", [source], params, build).first().n

    assert (ask(), ask(), len(built)) == (5, 5, 1)
    assert (ask({"k": 2}), ask({"k": 2}), len(built)) == (5, 5, 2)
    spark.range(3).write.mode("append").parquet(source)
    assert (ask(), ask(), len(built)) == (8, 8, 3)
    part = next(f for f in os.listdir(source) if f.endswith(".parquet"))
    os.utime(os.path.join(source, part), (1, 1))  # rewritten at another time
    assert (ask(), len(built)) == (8, 4)


def test_a_failed_run_leaves_no_result(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(5).write.parquet(source)
    store = ResultStore(spark, str(tmp_path / "store"))
    bad = F.when(F.col("id") == 3, F.raise_error(F.lit("stop")).cast("long")).otherwise(F.col("id"))
    with pytest.raises(Exception, match="stop"):
        store.get("x", [source], None, lambda: spark.read.parquet(source).select(bad.alias("id")))
    assert store.get("x", [source], None, lambda: spark.read.parquet(source)).count() == 5


def test_latest_batch_opens_no_data_file(spark, tmp_path):
    for name in ("2020-01-02T000000.csv", "2020-01-10T030000.csv", "2020-01-09T000000.csv"):
        (tmp_path / name).write_bytes(b"\xff\xfe not, a csv")
        os.chmod(tmp_path / name, 0o000)
    assert latest_batch(spark, str(tmp_path)).first().last_stamp == "2020-01-10T030000"
    plan = list_files(spark, [str(tmp_path)])._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]
    empty = tmp_path / "none"
    empty.mkdir()
    assert latest_batch(spark, str(empty), "2019-01-01T000000").first().last_stamp == "2019-01-01T000000"
    assert latest_batch(spark, str(empty)).first().last_stamp is None


def test_a_batch_is_named_by_its_newest_article_or_not_written(spark, tmp_path):
    path = str(tmp_path / "news")
    news = spark.createDataFrame([("a", "2020-06-14T12:00:00Z"), ("b", "2020-06-15T09:30:00Z"), ("c", None)], "source string, publishedAt string")
    assert append_batch(news, path) == "2020-06-15T093000"
    assert append_batch(news.limit(0), path) is None and append_batch(news.filter("publishedAt is null"), path) is None
    assert os.listdir(path) == ["batch_name=2020-06-15T093000"]
    assert latest_batch(spark, path).first().last_stamp == "2020-06-15T093000"
    assert append_batch(news.withColumn("publishedAt", F.lit(datetime(2021, 1, 1))), path) == "2021-01-01T000000"


def test_table_functions_equal_the_operators(spark):
    from textmill.operators.html import listing_articles, page_links

    page = ('<article><h3>First</h3><a href="./articles/abc">x</a><div><a href="./publications/p1">Pub</a>'
            '<time datetime="2020-10-01T12:00:00Z">1h</time></div></article>'
            '<article><h3>Second</h3><div><a>Paper</a><time datetime="2020-10-02T12:00:00Z">1h</time></div></article>')
    pages = spark.createDataFrame([(1, page), (2, None), (3, ""), (4, "<a href='/x' aria-label='World'>w</a>")], "page_id long, html string")
    register_table_functions(spark)
    lateral = lambda call: sorted(tuple(r) for r in spark.sql(f"SELECT p.page_id, l.* FROM {{pages}} p, LATERAL {call} l", pages=pages).collect())
    assert lateral("page_links(p.html)") == sorted(tuple(r) for r in page_links(pages).collect())
    want = sorted(tuple(r) for r in listing_articles(pages).drop("category").collect())
    assert lateral("listing(p.html)") == want and len(want) == 2
    assert [r[3] for r in lateral("listing(p.html, '2020-10-02T12:00:00Z')")] == ["Second"]


def test_blocked_sources_of_a_preset(spark):
    rows = [(1, "x " * 100, "Miami Herald"), (2, "y " * 100, "Other"), (3, "z " * 100, None)]
    df = spark.createDataFrame(rows, "doc_id long, description string, source string")
    every = prepare_articles(df, PAGE_PRESET, languages=[])
    some = prepare_articles(df, replace(PAGE_PRESET, blocked_sources=("Miami Herald",)), languages=[])
    assert {r.doc_id for r in every.collect()} == {1, 2, 3} and {r.doc_id for r in some.collect()} == {2, 3}


def test_preset_decides_the_number_of_clusters(spark):
    from pyspark.ml.linalg import Vectors

    feats = spark.createDataFrame([(Vectors.dense([float(10 * (i % 3)), 0.01 * i]),) for i in range(30)], ["features"])
    assert number_of_clusters(feats, False) == 60 and number_of_clusters(feats, False, 7) == 7
    assert number_of_clusters(feats, True, ks=range(2, 6)) == 3


def test_split_terms_give_the_same_products(spark):
    rows = [(d, t, 0.1 * (d % 7) + t) for d in range(200) for t in (0, 1 + d % 5, 9)]
    vectors = spark.createDataFrame(rows, "doc_id long, term long, weight double")
    assign = spark.createDataFrame([(d, d % 3) for d in range(200)], "doc_id long, cluster long")
    sums = centroid_sums(vectors, assign)
    result = lambda **k: {(r.doc_id, r.cluster): round(r.dot, 6) for r in sparse_products(vectors, sums, **k).collect()}
    want = result()
    assert result(term_rows=30) == want and result(term_rows=30, common_terms=1) == want


def test_dense_index_over_many_partitions(spark):
    got = dense_index(spark.range(100).select((F.col("id") * 7 % 101).alias("k")), ["k"], num_partitions=9)
    assert [r.idx for r in got.orderBy("k").collect()] == list(range(100))
