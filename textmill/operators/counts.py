"""Counts and time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def counts_rollup(df: DataFrame, group_col: str) -> DataFrame:
    """Count per group plus the grand total (group null)."""
    return df.rollup(group_col).agg(F.count(F.lit(1)).alias("n"))


def daily_counts(df: DataFrame, ts_col: str, group_col: str) -> DataFrame:
    """Tumbling one-day windows; same expression in batch and streaming."""
    return (df.groupBy(F.window(ts_col, "1 day").alias("w"), group_col)
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    group_col, "n"))


def sliding_counts(df: DataFrame, ts_col: str, group_col: str, days: int = 7) -> DataFrame:
    """Windows of ``days`` days that start every day, summed from the daily
    counts, so only days and not rows are repeated ``days`` times."""
    starts = F.transform(F.sequence(F.lit(0), F.lit(days - 1)),
                         lambda i: F.col("window_start") - F.make_interval(days=i))
    return (daily_counts(df, ts_col, group_col)
            .select(F.explode(starts).alias("window_start"), group_col, "n")
            .groupBy("window_start", group_col).agg(F.sum("n").alias("n"))
            .select("window_start", (F.col("window_start") + F.make_interval(days=F.lit(days))).alias("window_end"),
                    group_col, "n"))
