"""Stamped article batches.

A batch is one file whose name is the collection stamp.  Reading a window of
batches is a single multi-file scan with a predicate on the file name, which
Spark evaluates before opening files; our own output is partitioned by
``batch_date`` so the same window prunes whole directories.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from textmill.functions.stamps import STAMP_FORMAT, file_stem, parse_stamp, stamp

# Options that round-trip article bodies with newlines and doubled quotes.
CSV_OPTIONS = {"header": "true", "multiLine": "true", "escape": '"', "mode": "PERMISSIVE"}


def stamp_text(ts: datetime) -> str:
    """Python side of F7 for parameters (``now`` is always a parameter)."""
    return ts.strftime("%Y-%m-%dT%H%M%S")


def scan_batches(spark: SparkSession, path: str, schema: StructType | str | None = None,
                 fmt: str = "csv", options: dict | None = None) -> DataFrame:
    """All batch files under ``path`` with a ``batch_stamp`` column."""
    reader = spark.read.format(fmt)
    opts = dict(CSV_OPTIONS) if fmt == "csv" else {}
    opts.update(options or {})
    reader = reader.options(**opts)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    return df.withColumn("batch_stamp", file_stem(F.col("_metadata.file_name")))


def select_window(df: DataFrame, from_ts: datetime, to_ts: datetime,
                  stamp_col: str = "batch_stamp") -> DataFrame:
    """Batches whose stamp is in ``[from, to)``, compared as text like the
    reference (stamps sort chronologically)."""
    lo, hi = stamp_text(from_ts), stamp_text(to_ts)
    return df.filter((F.col(stamp_col) >= lo) & (F.col(stamp_col) < hi))


def load_window(spark: SparkSession, path: str, to_ts: datetime, days: int = 7,
                schema: StructType | str | None = None, fmt: str = "csv") -> DataFrame:
    """The reference's loader: last ``days`` of batches before ``to_ts``."""
    return select_window(scan_batches(spark, path, schema, fmt), to_ts - timedelta(days=days), to_ts)


def union_batches(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; columns missing in a frame become null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def high_water_mark(df: DataFrame, default_ts: datetime | None = None,
                    stamp_col: str = "batch_stamp") -> DataFrame:
    """One row ``last_stamp, last_ts``: the largest stamp, or the default."""
    last = F.max(stamp_col)
    if default_ts is not None:
        last = F.coalesce(last, F.lit(stamp_text(default_ts)))
    return (df.agg(last.alias("last_stamp"))
            .withColumn("last_ts", parse_stamp("last_stamp")))


DAY_US = 86_400_000_000


def day_batches(df: DataFrame, now: datetime, days: int = 13, ts_col: str = "ts",
                year: int | None = None) -> DataFrame:
    """Tag each row with the daily batch it falls in, in one pass.

    Batch d (1..days) holds ``now - d days <= ts < now - (d-1) days`` and is
    named by its upper bound.  Rows outside every batch are dropped.
    ``year`` adds the reference's year predicate.
    """
    # Works for TIMESTAMP and TIMESTAMP_NTZ columns (session time zone UTC).
    ts = F.col(ts_col).cast("timestamp")
    now_us = F.unix_micros(F.lit(now).cast("timestamp"))
    diff = now_us - F.unix_micros(ts)
    d = ((diff + F.lit(DAY_US - 1)) / F.lit(DAY_US)).cast("long")
    out = df.filter(ts < F.lit(now).cast("timestamp"))
    if year is not None:
        out = out.filter(F.year(ts_col) == year)
    out = out.withColumn("_d", d).filter(F.col("_d").between(1, days))
    upper = F.timestamp_micros(now_us - (F.col("_d") - 1) * F.lit(DAY_US))
    return out.withColumn("batch_name", stamp(upper)).drop("_d")


def write_batches(df: DataFrame, path: str, partition_col: str = "batch_name",
                  fmt: str = "parquet", mode: str = "append") -> None:
    """S6/S7 sink: one directory per batch; ``append`` adds a run's batch."""
    df.write.mode(mode).format(fmt).partitionBy(partition_col).save(path)


def append_run(df: DataFrame, path: str, at: datetime, fmt: str = "parquet") -> str:
    """The articles of one run as the batch named by its time.  The batch's
    own directory is replaced, so a repeated run does not double it."""
    name = stamp_text(at)
    df.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/batch_name={name}")
    return name


def append_batch(df: DataFrame, path: str, ts_col: str = "publishedAt", fmt: str = "parquet") -> str | None:
    """S7 as the collector does it: the batch is named by its newest article and
    written only if there is one; the name, or None.  ``ts_col`` is a timestamp
    or ISO text.  ``df`` is read twice; write it first if it is expensive."""
    newest = df.agg(F.max(F.col(ts_col).cast("timestamp")).alias("at")).select(stamp("at")).first()[0]
    if newest is not None:
        df.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/batch_name={newest}")
    return newest


def write_points(points: DataFrame, path: str) -> DataFrame:
    """The point table (or S10: scored titles) as CSV with a header, read
    back with its schema."""
    points.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)
    return (points.sparkSession.read.schema(points.schema).option("header", "true")
            .option("escape", '"').option("multiLine", "true").csv(path))


__all__ = ["CSV_OPTIONS", "STAMP_FORMAT", "append_batch", "append_run", "day_batches", "high_water_mark", "load_window",
           "scan_batches", "select_window", "stamp_text", "union_batches", "write_batches", "write_points"]
