"""Vectors as a row per document with numbered terms, from TF-IDF to k-means."""

import random

import numpy as np
from pyspark.sql import functions as F

from textmill.operators import kmeans_table as KT
from textmill.operators import terms as T
from test_kmeans_table import frames, unit_rows


def test_numbered_terms_are_the_terms(spark, monkeypatch):
    """Repeated and null ids, documents without terms, several parts."""
    monkeypatch.setattr(T, "PART_ROWS", 4)
    words = ["alpha", "beta", "gamma", "alpha beta", "the", "x", None]
    rows = [(i if i % 9 else None, [words[(i * j + j) % 7] for j in range(i % 8)]) for i in range(40)] + [(3, ["alpha", "beta"]), (41, None)]
    docs = spark.createDataFrame(rows, "doc_id long, kept array<string>")
    want = {(r.doc_id, r.term): r.weight for r in T.tfidf(docs, terms_col="kept", min_df=2, pairs=True).collect()}
    vectors, vocab = T.numbered_tfidf(docs, terms_col="kept", min_df=2, pairs=True)
    name = {r.idx: r.term for r in vocab.collect()}
    assert [name[i] for i in range(len(name))] == sorted({t for _, t in want})
    got = {(r.doc_id, name[i]): w for r in vectors.collect() for i, w in zip(r.terms, r.weights)}
    assert got.keys() == want.keys() and np.allclose([got[k] for k in want], list(want.values()), rtol=1e-12)
    assert vectors.schema["terms"].dataType.simpleString() == "array<int>"
    none, vocab = T.numbered_tfidf(docs.limit(0), terms_col="kept")
    assert none.count() == vocab.count() == 0


def test_rows_of_documents_fit_like_their_weights(spark):
    rows = unit_rows(random.Random(7), 4, 60)
    vectors, docs = frames(spark, rows, more=[900])
    packed = vectors.groupBy("doc_id").agg(F.collect_list("idx").alias("terms"), F.collect_list("weight").alias("weights"))
    found = []
    for v in (vectors, packed):
        parts, model = KT.fit(v, docs, 4, part_rows=50)
        found.append({r.doc_id: (r.cluster, round(r.cost, 9)) for r in KT.assign(parts, model).collect()})
    assert found[0] == found[1] and len(found[0]) == 241


def test_every_bundle_of_documents_is_a_task(spark):
    """Small parts were joined to a few tasks, whatever the work on them."""
    vectors, docs = frames(spark, unit_rows(random.Random(8), 4, 100))
    parts, model = KT.fit(vectors, docs, 3, max_iter=1)
    assert parts.packed.count() == 4 == KT.assign(parts, model).rdd.getNumPartitions()
