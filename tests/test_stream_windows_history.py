from datetime import datetime, timedelta

from pyspark.sql import functions as F

from textmill.operators.counts import sliding_counts
from textmill.streaming import ingest
from textmill.streaming.history import TextHistory, dedup_against_history

EVENTS = "ts timestamp, kind string, beat boolean"
DOCS = "doc_id long, text string"


def write(spark, path, rows, ddl):
    spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(path)


def test_sliding_stream_equals_batch_after_restarts(spark, tmp_path):
    source, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    start = datetime(2024, 1, 1, 5)
    days = [[(start + timedelta(days=d, hours=h), k, False) for h, k in ((0, "a"), (3, "b"), (20, "a"))] for d in range(0, 24, 2)]
    days[5].append((None, "a", False))
    for chunk in days:
        write(spark, source, chunk, EVENTS)
    schema = spark.read.parquet(source).schema

    def run():
        stream = ingest.read_stream(spark, source, schema, max_files_per_trigger=3)
        ingest.run_to_table(ingest.sliding_counts_stream(stream, "ts", "kind", beat_col="beat"), out, ckpt)
        return spark.read.parquet(out)

    early = run().count()  # the last windows are open still
    ingest.heartbeat(spark, source, schema, "ts", start + timedelta(days=90), "beat")
    got = run()
    batch = sliding_counts(spark.createDataFrame([r for c in days for r in c if r[0]], EVENTS), "ts", "kind")
    want = sorted(tuple(r) for r in batch.select("window_start", "window_end", "kind", "n").collect())
    assert sorted(tuple(r) for r in got.collect()) == want and 0 < early < len(want)
    assert run().count() == len(want)  # nothing new, nothing twice


def test_history_drops_late_repeats_and_survives_replays(spark, tmp_path):
    for limit in (1000, 0):  # hashes sent to the scan, or joined by a shuffle
        out, path = str(tmp_path / f"out{limit}"), str(tmp_path / f"history{limit}")
        run = dedup_against_history(TextHistory(spark, path, limit), out, "text", ["doc_id"])
        batches = [[(3, "a"), (1, "a"), (2, "b"), (4, None)], [(5, "a"), (6, "c")], [], [(7, "b"), (8, "c"), (9, "d"), (10, "")]]
        frames = [spark.createDataFrame(b, DOCS) for b in batches]
        kept = lambda: sorted(tuple(r) for r in spark.read.schema(DOCS).parquet(out).select("doc_id", "text").collect())
        for i, b in enumerate(frames):
            run(b, i)
        want = [(1, "a"), (2, "b"), (6, "c"), (9, "d"), (10, "")]
        assert kept() == want
        for i in (3, 1, 0):  # replayed, in any order
            run(frames[i], i)
            assert kept() == want
        run(spark.createDataFrame([(20, "a"), (21, "e")], DOCS), 400)  # however much later
        assert kept() == sorted(want + [(21, "e")])
        assert TextHistory(spark, path).before(500).count() == 6


def test_history_in_a_stream_is_restartable(spark, tmp_path):
    source, out, ckpt, path = (str(tmp_path / n) for n in ("in", "out", "ckpt", "history"))
    schema = spark.createDataFrame([], DOCS).schema
    texts = []
    for i in range(5):
        rows = [(100 * i + j, f"t{(i * 3 + j) % 11}") for j in range(6)]
        texts += [t for _, t in rows]
        write(spark, source, rows, DOCS)
        stream = ingest.read_stream(spark, source, schema, max_files_per_trigger=1)
        ingest.run_each_batch(stream, dedup_against_history(TextHistory(spark, path), out, "text", ["doc_id"]), ckpt)
    got = [r.text for r in spark.read.schema(DOCS).parquet(out).collect()]
    assert sorted(got) == sorted(set(texts))
    assert spark.read.schema(DOCS).parquet(out).agg(F.countDistinct("text")).first()[0] == len(got)
