"""Readers for the parquet tables the jobs run on.

Every reader selects the columns it needs right at the scan, so the parquet
``ReadSchema`` holds only those and filters written later are pushed into the
scan by Catalyst.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.text import title_of
from textmill.session import spread

# Row id of the tables whose rows carry long text; scans of these are spread
# over the cluster before per-row text work (see ``session.spread``).
TEXT_TABLE_KEYS = {"documents": "doc_id", "pages": "page_id", "benchmark": "item_id"}


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    df = df.select(*cols) if cols else df
    key = TEXT_TABLE_KEYS.get(name)
    if key and key in df.columns:
        df = spread(df, key)
    return df


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article view of ``documents``: description = text, category = source,
    title = first line.  The article columns of the reference map onto it.  Read
    as stored: the dedup that every article plan begins with deals the rows out."""
    return (spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
            .select("doc_id",
                    F.col("text").alias("description"),
                    "lang",
                    "source",
                    F.col("source").alias("category"),
                    title_of("text").alias("title")))
