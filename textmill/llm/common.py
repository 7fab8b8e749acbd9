"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The whole table ``name`` of ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id"):
    """True where crc32 of the id as text is divisible by 5 (never trained on).
    A null id counts as the empty string."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 5 == 0


def map_rows(df: DataFrame, fn: Callable[[Iterator[dict]], Iterable[dict]], schema: str) -> DataFrame:
    """``fn`` over the Arrow batches of ``df``: it gets an iterator of
    ``{column: python list}`` and yields ``{column: list or array}``."""
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(StructType.fromDDL(schema), prefers_large_types=False)

    def run(batches):
        columns = ({c: b.column(i).to_pylist() for i, c in enumerate(b.schema.names)} for b in batches)
        for out in fn(columns):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled training documents as (doc_id, text, label).

    Only rows that are not held out take part, and only labels of ids that
    ``docs`` has, so the sample is ``rows`` or all of them.  The ``rows`` smallest
    hashes of the id are chosen, so the choice is the same on every run and the
    broadcast side of the join holds at most ``rows`` ids, whatever the size of
    the tables.  A document with contradicting labels counts as 1; of
    several texts of one id the smallest is taken, combined before the shuffle.
    """
    chosen = (labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
              .join(docs.select("doc_id"), "doc_id", "left_semi")
              .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
              .orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(rows))
    return (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .join(F.broadcast(chosen), "doc_id")
            .groupBy("doc_id", "label").agg(F.min("text").alias("text")))


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker, across its tasks."""
    import sys
    import types

    return sys.modules.setdefault("_textmill_worker_cache", types.ModuleType("cache")).__dict__.setdefault(name, {})


def shared(spark: SparkSession, value) -> Callable[[], object]:
    """Send ``value`` to the executors once; the returned function gives it inside
    a task.  It travels with the code of its classes, which plain broadcasts
    leave to the workers' own path.  A worker keeps the last few values opened."""
    name, sent = uuid.uuid4().hex, spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def get():
        opened = worker_cache("shared")
        if name not in opened:
            while len(opened) > 3:
                del opened[next(iter(opened))]
            opened[name] = pickle.loads(sent.value)
        return opened[name]

    return get


def filter_rows(df: DataFrame, keep: Callable[[list], Iterable[bool]]) -> DataFrame:
    """Rows of ``df`` (all its columns) whose ``text`` ``keep`` is true for;
    ``keep`` gets the texts of a batch.  No shuffle."""
    def run(batches):
        for b in batches:
            yield b.filter(pa.array(keep(b.column("text").to_pylist()), pa.bool_()))

    return df.mapInArrow(run, df.schema)
