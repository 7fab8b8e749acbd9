"""The corpus pipeline: documents to packed training sequences in five stages.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and
returns a frame that ``run`` writes as Parquet to the shared folder and reads
again as the next stage's docs.  All but the last return the columns of
documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm import decontaminate, quality, toxicity
from textmill.llm.common import table
from textmill.llm.packing import pack_documents, tokenizer_path
from textmill.llm.simhash import simhash_groups
from textmill.session import written

TOXIC_FROM = 0.5
QUALITY_FROM = 0.3

ORACLE_SQL = None  # learned scores, SimHash and packing have no SQL form


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored toxic go."""
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels"), TOXIC_FROM)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored low in quality go."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"), QUALITY_FROM)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group the document with the smallest doc_id stays (its
    row, if that repeats, with it).  An id may stand on different texts: each of
    its rows goes or stays by its own group.  Rows without an id go where the
    group has one, and stay where it has none."""
    groups = simhash_groups(docs, shingle=4, max_bits=4)
    gone = (groups.filter(~F.col("doc_id").eqNullSafe(F.col("component_id")))
            .select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct())
    same = docs["doc_id"].eqNullSafe(gone["gone_id"]) & (F.xxhash64(docs["text"]) == gone["gone_hash"])
    return docs.join(gone, same, "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their places in sequences of 4096 tokens."""
    return pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
