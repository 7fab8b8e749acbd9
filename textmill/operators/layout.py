"""Two-dimensional article map.

The reference embeds the document x centroid distance matrix with t-SNE on
one machine.  Here the same matrix (k columns per document) is projected on
its first two principal components with MLlib ``PCA``: the k x k covariance
is aggregated across the cluster, so the step is linear in documents.
"""

from __future__ import annotations

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.functions.text import shorten


def distance_vectors(distances: DataFrame) -> DataFrame:
    """``doc_id, dist`` vector of distances ordered by cluster (k per doc)."""
    per_doc = (distances.groupBy("doc_id")
               .agg(F.array_sort(F.collect_list(F.struct("cluster", "distance"))).alias("_d")))
    return per_doc.select("doc_id", array_to_vector(F.transform("_d", lambda s: s["distance"])).alias("dist"))


def project_2d(vectors: DataFrame, seed: int = 0) -> DataFrame:
    """M7: ``doc_id, x, y`` from the first two principal components."""
    model = PCA(k=2, inputCol="dist", outputCol="_xy").fit(vectors)
    xy = model.transform(vectors).select("doc_id", vector_to_array("_xy").alias("_a"))
    return xy.select("doc_id", F.col("_a")[0].alias("x"), F.col("_a")[1].alias("y"))


def point_table(xy: DataFrame, assign: DataFrame, articles: DataFrame, topics: DataFrame) -> DataFrame:
    """M8: ``x, y, cluster, headline, description, category, desc``.

    ``articles`` carries ``doc_id, headline, category``; ``topics`` carries
    ``cluster, snippet`` (J4, a k-row dimension).
    """
    pts = (xy.join(assign, "doc_id")
           .join(articles, "doc_id")
           .join(F.broadcast(topics.select("cluster", "snippet")), "cluster", "left"))
    return pts.select("doc_id", "x", "y", F.col("cluster").cast("string").alias("cluster"), "headline",
                      shorten("headline").alias("description"), "category",
                      F.col("snippet").alias("desc"))
