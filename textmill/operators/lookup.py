"""Dimension lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Fixed value: category given to a source missing from the catalogue.
NO_CATEGORY = "NC"


def lookup_with_default(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                        value_col: str, out_col: str, default: str = NO_CATEGORY) -> DataFrame:
    """Left join to a dimension, missing or null keys get ``default``.

    The dimension is deduplicated on its key first (a dict keeps one value
    per key); AQE broadcasts it by its measured size.
    """
    d = (dim.groupBy(dim_key).agg(F.min(value_col).alias("_v"))
         .withColumnRenamed(dim_key, "_k"))
    joined = facts.join(d, facts[fact_key] == d["_k"], "left")
    return joined.withColumn(out_col, F.coalesce(F.col("_v"), F.lit(default))).drop("_k", "_v")


def attach(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Left join of a keyed dimension (e.g. cluster -> snippet)."""
    return facts.join(dim, key, "left")
