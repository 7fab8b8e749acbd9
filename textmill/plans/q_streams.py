"""Streaming queries.  Each runs a stream over a given table
with ``availableNow`` and returns the table the stream wrote."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from textmill.functions.text import sentiment_tokens, title_of
from textmill.operators import sentiment as nb
from textmill.plans.catalog import register
from textmill.plans.q_sentiment import LABELS, _model_cte, _prediction_sql, _scores_cte, _split
from textmill.plans.sqltext import sentiment_tokens_sql
from textmill.sources.tables import table
from textmill.streaming import ingest
from textmill.streaming.history import TextHistory, dedup_against_history


def _source(spark, sf_dir, name, *cols):
    path = os.path.join(sf_dir, f"{name}.parquet")
    schema = spark.read.parquet(path).schema
    # A file source watches a folder or a glob; this one names the table only,
    # be it a file or a folder of part files.
    stream = ingest.read_stream(spark, os.path.join(sf_dir, f"{name}.parque[t]"), schema)
    return stream.select(*cols) if cols else stream


@register("stream_ingest", lambda: "SELECT event_id, ts, event_type FROM events")
def q_stream_ingest(spark, sf_dir):
    """Incremental ingest of the events table into a parquet table."""
    out, ckpt = ingest.stream_folder(spark, "stream_ingest")
    ingest.run_to_table(_source(spark, sf_dir, "events", "event_id", "ts", "event_type"), out, ckpt)
    return spark.read.parquet(out)


@register("stream_dedup", lambda: "SELECT DISTINCT props FROM events")
def q_stream_dedup(spark, sf_dir):
    """Repeat-safe dedup of event payloads within a 7-day watermark."""
    out, ckpt = ingest.stream_folder(spark, "stream_dedup")
    ev = _source(spark, sf_dir, "events", "ts", "props")
    ingest.run_to_table(ingest.dedup_stream(ev, ["props"], "ts"), out, ckpt)
    return spark.read.parquet(out).select("props")


@register("stream_daily_window", lambda: (
    "SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, "
    "event_type, count(*) AS n FROM events GROUP BY 1, 2, 3"))
def q_stream_daily_window(spark, sf_dir):
    """Daily counts per event type, maintained by a streaming aggregation."""
    out, ckpt = ingest.stream_folder(spark, "stream_daily")
    ev = _source(spark, sf_dir, "events", "ts", "event_type")
    counts = ingest.daily_counts_stream(ev, "ts", "event_type")
    ingest.run_each_batch(counts, ingest.batch_table(out), ckpt, mode="update")
    return ingest.latest(spark, out, ["window_start", "window_end", "event_type"], "n")


@register("stream_weekly_sliding", lambda: (
    "SELECT w AS window_start, w + INTERVAL 7 DAY AS window_end, event_type, count(*) AS n FROM (SELECT event_type, "
    "unnest(list_transform(range(7), lambda i: date_trunc('day', ts) - to_days(i::INTEGER))) AS w FROM events) GROUP BY 1, 2, 3"))
def q_stream_weekly_sliding(spark, sf_dir):
    """7-day windows starting daily, from a stream; a heartbeat after the last
    event, read by a second run from the same checkpoint, closes the last windows."""
    out, ckpt = ingest.stream_folder(spark, "stream_weekly")
    events = _source(spark, sf_dir, "events", "ts", "event_type").withColumn("ts", F.col("ts").cast("timestamp")) \
        .withColumn("beat", F.lit(False))
    beats = f"{out}-beats"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(beats)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)

    def run():
        both = events.unionByName(ingest.read_stream(spark, beats, events.schema))
        ingest.run_to_table(ingest.sliding_counts_stream(both, "ts", "event_type", beat_col="beat"), out, ckpt)

    run()
    last = table(spark, sf_dir, "events", "ts").agg(F.max(F.col("ts").cast("timestamp")) + F.make_interval(days=F.lit(30))).first()[0]
    if last is not None:
        ingest.heartbeat(spark, beats, events.schema, "ts", last, "beat")
        run()
    schema = "window_start timestamp, window_end timestamp, event_type string, n bigint"
    return spark.read.schema(schema).parquet(out)


#: Documents of an arriving file.
ARRIVAL_ROWS = 25_000


@register("stream_dedup_history", lambda: "SELECT DISTINCT text FROM documents WHERE text IS NOT NULL")
def q_stream_dedup_history(spark, sf_dir):
    """T2 + A5: documents arriving in several files, each batch deduplicated
    against all before it."""
    out, ckpt = ingest.stream_folder(spark, "stream_history")
    arrivals = f"{out}-arrivals"
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    # Files of bounded size, a quarter of them at a time.
    files = 4 * max(1, -(-docs.count() // (4 * ARRIVAL_ROWS)))
    docs.repartitionByRange(files, "doc_id").write.parquet(arrivals)
    history = TextHistory(spark, f"{out}-history")
    stream = ingest.read_stream(spark, arrivals, docs.schema, max_files_per_trigger=files // 4)
    ingest.run_each_batch(stream, dedup_against_history(history, out, "text", ["doc_id"]), ckpt)
    return spark.read.schema(docs.schema).parquet(out).select("text")


def _stream_scores_sql() -> str:
    return (f"WITH {_model_cte()}, "
            f"ti AS (SELECT doc_id, split_part(text, chr(10), 1) AS title FROM documents), "
            f"tt AS (SELECT doc_id, list_distinct({sentiment_tokens_sql('title')}) AS toks FROM ti), "
            f"{_scores_cte('tt')} SELECT ti.doc_id, ti.title, {_prediction_sql()} AS sentiment "
            f"FROM sc JOIN ti ON sc.doc_id = ti.doc_id")


@register("stream_scores", _stream_scores_sql)
def q_stream_scores(spark, sf_dir):
    """T4: score document titles as they arrive against a static model."""
    tr, _ = _split(spark, sf_dir)
    model, stats = nb.train(tr, "tokens", LABELS)
    out, ckpt = ingest.stream_folder(spark, "stream_scores")

    def score(batch, batch_id):
        titles = batch.select("doc_id", title_of("text").alias("title"))
        toks = titles.select("doc_id", sentiment_tokens("title").alias("tokens"))
        scored = nb.classify(toks, model, stats, "doc_id", "tokens", LABELS)
        ingest.batch_table(out)(
            titles.join(scored.select("doc_id", F.col("prediction").alias("sentiment")), "doc_id"), batch_id)

    ingest.run_each_batch(_source(spark, sf_dir, "documents", "doc_id", "text"), score, ckpt)
    return spark.read.parquet(out).select("doc_id", "title", "sentiment")
