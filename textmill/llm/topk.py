"""Exact top-k inner products with multi-resolution segment statistics.

Components are scaled to integers.  At each resolution a vector is cut into
segments; the segment means and deviations (times the root of the segment's
size) are a shorter vector whose distance to another's never exceeds the true
distance.  Since both keep the vector's length, the inner product of the
short vectors is an upper bound of the true score.  Candidates pass the
resolutions from coarse to fine, as matrix products of a block of queries with
a batch of candidates; only candidates that may still enter a query's list are
scored exactly.

Queries go to the tasks in blocks of about ``QUERY_BLOCK`` different rows, every
block meets all candidates, and a task returns k rows per query at most.

Defined results: vectors that are null or hold null or non-finite components
take no part; vectors of different length have no score; a query row excludes
itself once, other rows of its id are candidates; repeated query rows get a
list each; null ids are candidates after all others and never queries;
a vector so long that its scores may leave 64 bits (a squared length of 2**62
after scaling) fails the query; empty tables give no rows; further columns are
ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.common import map_rows, table

QUERY_BLOCK = 1024
SEGMENTS = (4, 16)
_LONGEST = 2.0 ** 62
_LAST = 2 ** 63 - 1


def scaled(frame: DataFrame, factor: int) -> DataFrame:
    """(vec_id, v): integer vectors of the rows that take part."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    length = F.aggregate(x, F.lit(0.0), lambda a, c: a + F.pow(F.floor(c * factor).cast("double"), F.lit(2.0)))
    too_long = F.raise_error(F.lit("a vector's inner products may leave 64 bits")).cast("array<bigint>")
    whole = F.when(length < _LONGEST, F.transform(x, lambda c: F.floor(c * factor).cast("bigint"))).otherwise(too_long)
    return frame.filter(F.col("embedding").isNotNull() & F.coalesce(good, F.lit(False))).select("vec_id", whole.alias("v"))


def summary(v: np.ndarray, segments: int) -> np.ndarray:
    """Segment means and deviations of each row, scaled by the root of the size."""
    parts = np.array_split(v.astype(np.float64), min(segments, max(1, v.shape[1])), axis=1)
    cols = [p.mean(1) * np.sqrt(p.shape[1]) for p in parts if p.shape[1]] + [p.std(1) * np.sqrt(p.shape[1]) for p in parts if p.shape[1]]
    return np.stack(cols, 1) if cols else np.zeros((len(v), 1))


class Block:
    """Queries of one vector length with the best rows found so far."""

    def __init__(self, number: list[int], ids: list[int], v: np.ndarray, k: int):
        self.number, self.ids, self.v, self.k = np.array(number), np.array(ids), v, k
        self.short = [summary(v, s) for s in SEGMENTS]
        self.size = np.linalg.norm(v.astype(np.float64), axis=1)
        self.q = np.empty(0, np.int64)
        self.score, self.id, self.own = self.q, self.q, np.empty(0, bool)
        self.least = np.full(len(v), -np.inf)

    def meet(self, ids: np.ndarray, v: np.ndarray) -> None:
        size = np.linalg.norm(v.astype(np.float64), axis=1)
        at = np.arange(len(v))
        may = None
        for short, s in zip(self.short, SEGMENTS):
            slack = 1e-9 * (1 + np.outer(self.size, size[at]))
            may = short @ summary(v[at], s).T + slack >= self.least[:, None]
            left = may.any(0)
            at, may = at[left], may[:, left]
            if not len(at):
                return
        exact = self.v.astype(np.float64) @ v[at].T.astype(np.float64) if self.size.max() * size.max() < 2 ** 52 \
            else self.v @ v[at].T
        q, c = np.nonzero(may & (exact >= self.least[:, None]))
        own = (ids[at][c] == self.ids[q])
        own[own] = (v[at][c[own]] == self.v[q[own]]).all(1)
        self.q = np.concatenate((self.q, q))
        self.score = np.concatenate((self.score, exact[q, c].astype(np.int64)))
        self.id = np.concatenate((self.id, ids[at][c]))
        self.own = np.concatenate((self.own, own))
        # Of each query's rows the k + 1 best stay: one of them may be its own.
        order = np.lexsort((self.id, -self.score, self.q))
        q = self.q[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        order = order[rank <= self.k]
        self.q, self.score, self.id, self.own = self.q[order], self.score[order], self.id[order], self.own[order]
        rank = rank[rank <= self.k]
        full = rank == self.k
        self.least[self.q[full]] = self.score[full]

    def found(self) -> dict:
        return {"query": self.number[self.q], "vec_id": [None if x == _LAST else x for x in self.id.tolist()],
                "score": self.score, "own": self.own}


def top_k(vectors: DataFrame, is_query, k: int = 5, factor: int = 256, query_block: int = QUERY_BLOCK,
          rows: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best candidates of each row of
    ``vectors`` (vec_id, embedding) that ``is_query`` holds for."""
    spark = vectors.sparkSession
    vectors = scaled(vectors, factor)
    queries = vectors.filter(F.col("vec_id").isNotNull() & is_query).groupBy("vec_id", "v").agg(F.count("*").alias("copies"))
    blocks = -(-queries.count() // query_block) or 1
    parts = []
    for n in range(blocks):
        block = sorted(queries.filter(F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)) == n).collect())
        shared = spark.sparkContext.broadcast([(r.vec_id, list(r.v)) for r in block])

        def run(batches, shared=shared):
            groups: dict[int, list] = {}
            for i, (vec_id, v) in enumerate(shared.value):
                groups.setdefault(len(v), []).append((i, vec_id, v))
            mine = {d: Block([x[0] for x in g], [x[1] for x in g], np.array([x[2] for x in g], np.int64).reshape(len(g), d), k)
                    for d, g in groups.items()}
            for b in batches:
                for lo in range(0, len(b["v"]), rows):
                    some, ids = b["v"][lo:lo + rows], b["vec_id"][lo:lo + rows]
                    sizes = np.fromiter(map(len, some), np.int64, len(some))
                    for d in mine.keys() & set(sizes.tolist()):
                        at = np.flatnonzero(sizes == d).tolist()
                        mine[d].meet(np.array([_LAST if ids[i] is None else ids[i] for i in at], np.int64),
                                     np.array([some[i] for i in at], np.int64).reshape(len(at), d))
            for x in mine.values():
                yield x.found()

        found = map_rows(vectors, run, "query int, vec_id bigint, score bigint, own boolean")
        names = spark.createDataFrame([(i, r.vec_id, r.copies) for i, r in enumerate(block)],
                                      "query int, query_id bigint, copies bigint")
        # A query's own row goes once, then the best k of all tasks' lists stay.
        one = found.withColumn("o", F.row_number().over(Window.partitionBy("query", "own").orderBy("score")))
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
        best = one.filter("not (own and o = 1)").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        parts.append(best.join(F.broadcast(names), "query")  # at most query_block rows, bounded by the block
                     .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
                     .select("query_id", "rank", "vec_id", "score"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def op5_exact_top_k(spark, sf_dir):
    """The 5 best other vectors of every vector whose id is divisible by 50."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


OP5_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rk FROM s)
SELECT query_id, CAST(rk AS INTEGER) AS rank, vec_id, score FROM r WHERE rk <= 5
"""
