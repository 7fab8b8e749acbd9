"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.session import written


def _pointed(pairs: DataFrame, keep) -> DataFrame:
    """Each ``b`` of a node ``a`` is hung below the least node of a's
    neighbourhood (``a`` included).  The minimum is combined before the
    shuffle, so a node with very many neighbours costs one row per task; the
    join back splits such nodes by AQE."""
    least = pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return pairs.join(least, "a").filter(keep).select(F.col("b").alias("a"), F.col("m").alias("b"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the least node
    reachable.  Rounds of large-star and small-star until nothing changes; each
    round is written to the shared folder.  An empty table gives no rows."""
    edges = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _pointed(both, F.col("b") > F.col("a")).filter("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (down.join(least, "a")
                 .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                           F.struct(F.col("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.a", "e.b").filter("a <> b").distinct())
        edges = written(small, "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1000003), F.sum(F.hash("b", "a"))).first()
        if state == seen:
            roots = edges.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
        seen = state
    raise RuntimeError(f"components did not converge in {max_rounds} rounds")
