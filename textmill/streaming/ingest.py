"""Structured Streaming forms of the periodic collection jobs.

The reference collects a batch every few hours and remembers the newest
stamp.  Here the remembered position is the stream checkpoint: a file
source only reads files it has not committed yet, so a re-run (or a restart
after a lost executor or driver) continues where the last one stopped, and
``trigger(availableNow=True)`` turns a periodic run into "process what has
arrived, then stop".

Every sink is a table in the shared checkpoint folder (never the memory
sink, which would gather results on the driver).
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.operators.counts import daily_counts
from textmill.session import scratch_path

DEDUP_WATERMARK = "7 days"


def read_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, options: dict | None = None) -> DataFrame:
    """T1 source: new files under ``path`` (a folder or a glob)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load(path)


def run_to_table(df: DataFrame, out_path: str, checkpoint: str, mode: str = "append",
                 partition_by: Sequence[str] = ()) -> str:
    """T1 sink: write the stream to parquet at ``out_path`` until the input
    available now is consumed; returns ``out_path``."""
    w = (df.writeStream.format("parquet").outputMode(mode)
         .option("path", out_path).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start()
    q.awaitTermination()
    return out_path


def run_each_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                   mode: str = "append") -> None:
    """T4 sink: call ``fn(batch_df, batch_id)`` per micro-batch (idempotent
    writes keyed by ``batch_id`` make replays after a failure harmless)."""
    q = (df.writeStream.outputMode(mode).foreachBatch(fn)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def dedup_stream(df: DataFrame, keys: Sequence[str], ts_col: str,
                 watermark: str = DEDUP_WATERMARK) -> DataFrame:
    """Drop repeats of ``keys`` arriving within ``watermark`` of each other.
    State per key expires with the watermark, so it stays bounded.  Event
    time must be a session-zoned TIMESTAMP, so NTZ columns are cast."""
    df = df.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
    return df.withWatermark(ts_col, watermark).dropDuplicatesWithinWatermark(list(keys))


def daily_counts_stream(df: DataFrame, ts_col: str, group_col: str,
                        watermark: str = DEDUP_WATERMARK) -> DataFrame:
    """The batch ``daily_counts`` expression on a stream.  A day's state goes
    once the watermark has passed it; later rows of that day are late."""
    return daily_counts(df.withColumn(ts_col, F.col(ts_col).cast("timestamp")).withWatermark(ts_col, watermark),
                        ts_col, group_col)


def sliding_counts_stream(df: DataFrame, ts_col: str, group_col: str, days: int = 7,
                          watermark: str = DEDUP_WATERMARK, beat_col: str | None = None) -> DataFrame:
    """Windows of ``days`` days that start every day, as two aggregations in a
    row: rows to days, closed days to windows.  Only days are repeated ``days``
    times, and a window's row is written once, when the watermark has passed it
    (append mode).  Rows with a true ``beat_col`` are heartbeats: they move the
    watermark and are not counted."""
    real = F.lit(1) if beat_col is None else F.when(F.col(beat_col), 0).otherwise(1)
    rows = df.withColumn(ts_col, F.col(ts_col).cast("timestamp")).withColumn("_real", real).withWatermark(ts_col, watermark)
    daily = rows.groupBy(F.window(ts_col, "1 day").alias("day"), group_col).agg(F.sum("_real").alias("n"))
    return (daily.groupBy(F.window(F.window_time("day"), f"{days} days", "1 day").alias("w"), group_col)
            .agg(F.sum("n").alias("n")).filter("n > 0")
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), group_col, "n"))


def heartbeat(spark: SparkSession, folder: str, schema, ts_col: str, at, beat_col: str) -> None:
    """Write a row that is nothing but a time, as a new file of a stream's
    ``folder``: what came before ``at`` less the watermark can be closed."""
    row = spark.createDataFrame([(at,)], "t timestamp").select(*[
        F.col("t").cast(f.dataType).alias(f.name) if f.name == ts_col else F.lit(True).alias(f.name) if f.name == beat_col
        else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
    row.coalesce(1).write.mode("append").parquet(folder)


def stream_folder(spark: SparkSession, name: str) -> tuple[str, str]:
    """(output, checkpoint) folders for one stream run in the shared folder."""
    base = scratch_path(spark, name)
    return os.path.join(base, "out"), os.path.join(base, "checkpoint")


def batch_table(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer: each batch replaces its own part of the table, so a
    replayed batch changes nothing and the others are never touched."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def latest(spark: SparkSession, path: str, keys: Sequence[str], value: str) -> DataFrame:
    """The last value of each key of an update-mode ``batch_table``."""
    return (spark.read.parquet(path).groupBy(*keys)
            .agg(F.max_by(value, "batch_id").alias(value)))
