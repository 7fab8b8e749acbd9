"""Dedup of every micro-batch against all earlier ones.

The watermark form forgets after its delay.  Here the 256-bit hashes of all texts
kept so far are a table with a folder per batch, sorted by hash.  A batch looks up
its own hashes in it: at most ``BROADCAST_HASHES`` of them are sent to the scan of
the table, so that the history is read but never shuffled; a larger batch is
joined by a shuffle.  What the history lacks is kept, one row per text, and the
batch's hashes are added to the table.

Both writes replace the batch's own folder, and a batch looks at smaller batch ids
only, so a replay gives the same result and changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.session import written
from textmill.streaming.ingest import batch_table

BROADCAST_HASHES = 500_000


class TextHistory:
    """The hashes of all texts kept, below ``path``."""

    def __init__(self, spark: SparkSession, path: str, broadcast_hashes: int = BROADCAST_HASHES):
        self.spark, self.path, self.limit = spark, path.rstrip("/"), broadcast_hashes
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)

    def before(self, batch_id: int) -> DataFrame:
        """``digest`` of all texts kept by earlier batches."""
        rows = self.spark.read.schema("digest binary, batch_id bigint").parquet(self.path)
        return rows.filter(F.col("batch_id") < batch_id).select("digest")

    def new_texts(self, batch: DataFrame, batch_id: int, key: str, order: Sequence[str]) -> DataFrame:
        """The rows of ``batch`` whose ``key`` no earlier batch and no earlier row
        by ``order`` (unique within a key) has; rows without a key are dropped.
        Their hashes are added to the history."""
        digest = F.unhex(F.sha2(F.col(key).cast("binary"), 256))
        rows = batch.filter(F.col(key).isNotNull()).withColumn("_digest", digest)
        first = (rows.select(F.col("_digest").alias("digest"), *order).groupBy("digest")
                 .agg(F.min(F.struct(*order)).alias("first")))
        first = written(first, "batch-hashes")
        mine = first.select("digest")
        known = self.before(batch_id).join(F.broadcast(mine) if first.count() <= self.limit else mine, "digest", "left_semi")
        fresh = written(first.join(known, "digest", "left_anti"), "fresh-hashes")
        (fresh.select("digest").sortWithinPartitions("digest").write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}"))
        chosen = fresh.select(F.col("digest").alias("_digest"), *[F.col(f"first.{c}").alias(f"_{c}") for c in order])
        same = rows["_digest"] == chosen["_digest"]
        for c in order:
            same = same & rows[c].eqNullSafe(chosen[f"_{c}"])
        return rows.join(chosen, same, "left_semi").drop("_digest")


def dedup_against_history(history: TextHistory, out_path: str, key: str,
                          order: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer: the batch's new texts as its part of ``out_path``."""
    write = batch_table(out_path)

    def run(batch: DataFrame, batch_id: int) -> None:
        write(history.new_texts(written(batch, "batch"), batch_id, key, order), batch_id)

    return run
