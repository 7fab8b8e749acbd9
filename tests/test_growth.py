"""What must not grow with the tables: parts, files and memory of one task."""

import math
import os
import random

from textmill.operators import terms
from textmill.plans import q_streams
from textmill.streaming import ingest

DOCS = "doc_id long, text string"


def test_a_stream_reads_a_table_that_is_a_folder_of_files(spark, tmp_path):
    folder = str(tmp_path / "documents.parquet")
    spark.createDataFrame([(i, f"text {i}") for i in range(9)], DOCS).repartition(3).write.parquet(folder)
    spark.createDataFrame([(99, "no")], DOCS).write.parquet(str(tmp_path / "documents.parquet2"))
    spark.createDataFrame([(98, "no")], DOCS).coalesce(1).write.parquet(str(tmp_path / "labels.parquet"))
    out, ckpt = ingest.stream_folder(spark, "folder")
    ingest.run_to_table(q_streams._source(spark, str(tmp_path), "documents", "doc_id"), out, ckpt)
    assert sorted(r.doc_id for r in spark.read.parquet(out).collect()) == list(range(9))


def test_arriving_files_are_bounded_and_come_in_four_batches(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(i, f"text {i % 150}") for i in range(400)], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(q_streams, "ARRIVAL_ROWS", 50, raising=False)
    streams = []
    real = ingest.read_stream

    def read(spark, path, *a, **k):
        streams.append((path, k.get("max_files_per_trigger")))
        return real(spark, path, *a, **k)

    monkeypatch.setattr(ingest, "read_stream", read)
    out = q_streams.q_stream_dedup_history(spark, str(tmp_path))
    assert sorted(r.text for r in out.collect()) == sorted(f"text {i}" for i in range(150))
    (path, per_batch), = streams
    files = [f for f in os.listdir(path.removeprefix("file:")) if f.startswith("part-")]
    assert per_batch == 2 and len(files) == 8


def test_term_counts_are_taken_inside_the_row(spark, monkeypatch):
    """No (document, term) row is shuffled or held in a table of a task; repeated
    and null ids are one document, in whatever part."""
    monkeypatch.setattr(terms, "PART_ROWS", 3, raising=False)
    rows = [(1, ["a", "b", "a"]), (1, ["a"]), (None, ["a", "c"]), (None, ["c", None]), (5, []), (6, None)]
    rows += [(i, ["a", f"x{i % 3}", f"x{i % 3}"]) for i in range(10, 30)]
    docs = spark.createDataFrame(rows, "doc_id long, terms array<string>")
    for frame in (terms.term_frequencies(docs), terms.tfidf(docs, min_df=2)):
        assert "term" not in " ".join(x for x in plan(frame).split("\n") if "HashAggregate" in x or "rangepartitioning" in x)
    count, df = {}, {}
    for d, ts in rows:
        for t in ts or ():
            if t is not None:
                count[d, t] = count.get((d, t), 0) + 1
        for t in set(ts or ()) - {None}:
            df[t] = df.get(t, 0) + 1
    assert {(r.doc_id, r.term): r.tf for r in terms.term_frequencies(docs).collect()} == count
    want = {(d, t): n * (math.log((len(rows) + 1) / (df[t] + 1)) + 1) for (d, t), n in count.items() if df[t] >= 2}
    norm = {}
    for (d, _), w in want.items():
        norm[d] = norm.get(d, 0) + w * w
    got = {(r.doc_id, r.term): r.weight for r in terms.tfidf(docs, min_df=2).collect()}
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], w / math.sqrt(norm[k[0]]), rel_tol=1e-12) for k, w in want.items())
    assert terms.tfidf(docs.limit(0)).count() == 0


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_registered_kmeans_fits_nothing_on_the_driver(spark, monkeypatch):
    from pyspark.ml.clustering import KMeans
    from textmill.plans import q_clusters

    def fails(*_):
        raise AssertionError("MLlib keeps k dense centres on the driver")

    monkeypatch.setattr(KMeans, "_fit", fails)
    words = [f"{a}{b}" for a in "bcdfg" for b in "aeiou"]
    rows = [(i % 38, "s", "c", f"h{i}", [words[(5 * (i % 4) + j) % 25] for j in range(5)]) for i in range(40)] + [(None, "s", "c", "n", [])]
    corpus = spark.createDataFrame(rows, "doc_id long, source string, category string, description string, tokens array<string>")
    monkeypatch.setattr("textmill.plans.corpus.article_corpus", lambda *_: corpus)
    assert sum(r.n for r in q_clusters.q_kmeans_sizes(spark, "").collect()) >= 40
    docs, _, model, assign = q_clusters._fit(spark, "")
    assert docs.count() == 41 and assign.select("cluster").distinct().count() > 3
    assert sorted({r.doc_id for r in assign.filter("doc_id is not null").collect()}) == list(range(38))


def test_a_fit_keeps_the_centres_of_its_last_round_only(spark):
    from textmill import session
    from textmill.operators import kmeans_sweep, kmeans_table
    from test_kmeans_table import frames, unit_rows

    def kept(name):
        return sum(f.startswith(name) for f in os.listdir(session._scratch_root(spark).removeprefix("file:")))

    vectors, docs = frames(spark, unit_rows(random.Random(5), 4, 30))
    before = kept("sums-")
    _, model = kmeans_table.fit(vectors, docs, 3, max_iter=4, tol=-1)
    assert model.iterations == 4 and model.sums.count() > 0 and kept("sums-") - before <= 2
    before = kept("sweep-sums-")
    kmeans_sweep.k_sweep(vectors, docs, [2, 3], max_iter=4, tol=-1)
    assert kept("sweep-sums-") - before <= 2


def test_the_k_sweeps_fit_nothing_on_the_driver(spark, monkeypatch):
    from pyspark.ml.clustering import KMeans
    from textmill.plans import q_clusters

    def fails(*_):
        raise AssertionError("MLlib keeps k dense centres on the driver")

    monkeypatch.setattr(KMeans, "_fit", fails)
    words = [f"{a}{b}" for a in "bcdfg" for b in "aeiou"]
    rows = [(i % 7, "s", "c", f"h{i}", [words[8 * (i % 3) + j] for j in range(8)]) for i in range(21)] + [(None, "s", "c", "n", [])]
    corpus = spark.createDataFrame(rows, "doc_id long, source string, category string, description string, tokens array<string>")
    monkeypatch.setattr("textmill.plans.corpus.article_corpus", lambda *_: corpus)
    sweep = {r.k: r for r in q_clusters.q_k_sweep(spark, "").collect()}
    assert sorted(sweep) == list(range(2, 80))
    assert all((sweep[k].silhouette is None) == (sweep[k].inertia is None) == (k >= 22) for k in sweep)
    best = max((r for r in sweep.values() if r.silhouette is not None), key=lambda r: (r.silhouette, -r.k))
    assert q_clusters.q_best_k(spark, "").first().k == best.k
    sizes = q_clusters.q_kmeans_sizes_best_k(spark, "").collect()
    assert sum(r.n for r in sizes) >= 22 and len(sizes) <= best.k
