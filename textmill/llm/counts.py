"""Token totals by source, language and tokenizer version, kept by deltas.

Every batch of signed changes (inserts, deletes, revised counts) is summed to
a few rows per group and written as a part of the batch's folder.  Totals
are the sum over one part of every committed batch, so they never need the
documents again.  A part is written beside the table first, then renamed to a
name of its own, so no writer can disturb another.  Committing an id again
changes nothing, whether the first try ended or not; of writers that commit one
id at the same moment, each unaware of the others, the part first in name order
counts alone.

Sums are combined before the shuffle: a source with a third of all rows costs a
row per task.

Defined results: null source, language or tokenizer are groups of their own; a
null text counts zero tokens; a change with a null or unknown kind is refused when
the batch is committed; repeated changes count each; groups whose document and
token totals are zero leave the totals; an empty batch is committed with no
rows; further columns are ignored.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm.common import table
from textmill.session import scratch_path, written

KEYS = ("source", "lang", "tokenizer")
#: Counters by version; each is an expression over the text.
TOKENIZERS = {
    "spaces-1": r"[^ ]+",
    "words-2": r"[^ \t\n\r]+",
    "pieces-1": r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]",
}


def token_count(text: str | Column, tokenizer: str) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_count(F.coalesce(c, F.lit("")), F.lit(TOKENIZERS[tokenizer])).cast("bigint")


def changes(frame: DataFrame, kind: str, tokenizer: str, tokens=None, old_tokens=None) -> DataFrame:
    """Change rows of ``frame`` (source, lang): ``insert`` and ``delete`` have
    ``tokens``; ``revise`` also ``old_tokens``, the count it replaces."""
    none = F.lit(None).cast("bigint")
    return frame.select(F.lit(kind).alias("kind"), "source", "lang", F.lit(tokenizer).alias("tokenizer"),
                        (none if tokens is None else tokens).alias("tokens"),
                        (none if old_tokens is None else old_tokens).alias("old_tokens"))


def signed(change_rows: DataFrame) -> DataFrame:
    """(source, lang, tokenizer, docs, tokens) with signs."""
    kind, new, old = F.col("kind"), F.coalesce("tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
    refused = F.raise_error(F.concat(F.lit("unknown kind of change: "), F.coalesce(kind, F.lit("null"))))
    docs = F.when(kind == "insert", 1).when(kind == "delete", -1).when(kind == "revise", 0).otherwise(refused.cast("int"))
    tokens = F.when(kind == "insert", new).when(kind == "delete", -new).when(kind == "revise", new - old)
    return change_rows.select(*KEYS, docs.cast("bigint").alias("docs"), tokens.cast("bigint").alias("tokens"))


class Rollup:
    """A table of committed batches below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.path}/batches"))

    def _place(self, batch: str):
        if not batch or not all(c.isalnum() or c in "-." for c in batch) or batch.startswith("."):
            raise ValueError("a batch id is letters, digits, dots and dashes")
        return f"{self.path}/batches/batch=id-{batch}"  # never read as a number

    def _parts(self, batch: str) -> list[str]:
        place = self._path(self._place(batch))
        return sorted(s.getPath().getName() for s in self._fs.listStatus(place)) if self._fs.exists(place) else []

    def commit(self, batch: str, change_rows: DataFrame) -> bool:
        """Add a batch; False if its id is committed already."""
        if self._parts(batch):
            return False
        rows = signed(change_rows).groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        part = f"part=p{time.time_ns():020d}-{uuid.uuid4().hex}"
        aside = f"{self.path}/trying/{part}"
        rows.write.parquet(aside)
        self._fs.mkdirs(self._path(self._place(batch)))
        if not self._fs.rename(self._path(aside), self._path(f"{self._place(batch)}/{part}")):
            raise OSError(f"batch {batch} could not be put in its place")
        return self._parts(batch)[0] == part

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens) over all committed batches."""
        schema = "source string, lang string, tokenizer string, docs bigint, tokens bigint, batch string, part string"
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/batches")
        counted = rows.groupBy("batch").agg(F.min("part").alias("part"))  # a row per batch
        return (rows.join(counted, ["batch", "part"], "left_semi").groupBy(*KEYS).agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"))
                .filter("n_docs <> 0 or n_tokens <> 0"))


def op8_token_rollup(spark, sf_dir):
    """All documents through four batches: counted by ``spaces-1``; the version
    replaced by ``words-2`` (deletes and inserts); documents labelled low in
    quality deleted; the rest counted by ``pieces-1`` as well, first by mistake
    with the words' count, then revised.  One batch is sent twice."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    counted = written(docs.select("doc_id", "source", "lang", *[
        token_count("text", t).alias(t.replace("-", "_")) for t in TOKENIZERS]), "token-counts")
    low = table(spark, sf_dir, "labels").filter("quality = 0").select("doc_id").distinct()
    kept, gone = counted.join(low, "doc_id", "left_anti"), counted.join(low, "doc_id", "left_semi")
    spaces, words, pieces = F.col("spaces_1"), F.col("words_2"), F.col("pieces_1")
    rollup = Rollup(spark, scratch_path(spark, "token-rollup"))
    rollup.commit("1-load", changes(counted, "insert", "spaces-1", spaces))
    renewed = changes(counted, "delete", "spaces-1", spaces).unionByName(changes(counted, "insert", "words-2", words))
    rollup.commit("2-renew", renewed)
    rollup.commit("2-renew", renewed)
    rollup.commit("3-low", changes(gone, "delete", "words-2", words))
    rollup.commit("4-pieces", changes(kept, "insert", "pieces-1", words)
                  .unionByName(changes(kept, "revise", "pieces-1", pieces, words)))
    return rollup.totals()


OP8_SQL = r"""
WITH k AS (
  SELECT source, lang, coalesce(text, '') AS t FROM documents
  WHERE doc_id IS NULL OR doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0 AND doc_id IS NOT NULL)),
c AS (
  SELECT source, lang, 'words-2' AS tokenizer, len(regexp_extract_all(t, '[^ \t\n\r]+')) AS n FROM k
  UNION ALL
  SELECT source, lang, 'pieces-1',
         len(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]')) FROM k)
SELECT source, lang, tokenizer, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens FROM c GROUP BY ALL
"""
