"""Results kept and read again instead of computed.

A result is stored under a key made of its name, its parameters and the files it
is computed from: their paths, sizes and times, taken from the listing alone.  If
the key is there, the result is read and no input file is opened; a file added,
removed or rewritten gives another key.  A result is written beside the store and
then renamed, so a reader sees it whole or not at all.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, paths: Sequence[str], pattern: str = "*") -> DataFrame:
    """``path, length, modificationTime`` of the files at and below ``paths``.
    Only the listing is read: the content column is pruned."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    return reader.load(list(paths)).select("path", "length", "modificationTime")


class ResultStore:
    """Results below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._folder(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._folder(self.path))

    def key(self, name: str, inputs: Sequence[str], params: Mapping | None = None) -> str:
        """The name, and a digest of parameters and input files."""
        file = F.xxhash64("path", "length", F.unix_micros("modificationTime"))
        files = list_files(self.spark, inputs).agg(F.count("*"), F.bit_xor(file), F.sum(file.bitwiseAND(0xFFFFFFFF))).first()
        said = json.dumps([name, sorted((params or {}).items()), list(files)], sort_keys=True, default=str)
        return f"{name}-{hashlib.sha256(said.encode()).hexdigest()[:32]}"

    def has(self, key: str) -> bool:
        return self._fs.exists(self._folder(f"{self.path}/{key}/_SUCCESS"))

    def get(self, name: str, inputs: Sequence[str], params: Mapping | None, build: Callable[[], DataFrame]) -> DataFrame:
        """The stored result of ``build`` for these inputs and parameters, which
        are text, numbers or lists of them; built and stored if there is none."""
        key = self.key(name, inputs, params)
        if not self.has(key):
            aside = f"{self.path}/.{key}-{uuid.uuid4().hex}"
            build().write.parquet(aside)
            if not self.has(key) and not self._fs.rename(self._folder(aside), self._folder(f"{self.path}/{key}")):
                raise OSError(f"result {key} could not be put in its place")
        return self.spark.read.parquet(f"{self.path}/{key}")


def latest_batch(spark: SparkSession, path: str, default_stamp: str | None = None, pattern: str = "*") -> DataFrame:
    """S8 from the listing: one row ``last_stamp`` over the batches below ``path``,
    whether files named by their stamp or folders ``batch_name=<stamp>``; the
    default if there is none.  No data file is opened."""
    folder = F.regexp_extract("path", r"/batch_name=([^/]+)/", 1)
    stem = F.substring_index(F.element_at(F.split("path", "/"), -1), ".", 1)
    named = F.when(folder != "", F.replace(folder, F.lit("%3A"), F.lit(":"))).otherwise(stem)
    return list_files(spark, [path], pattern).agg(F.coalesce(F.max(named), F.lit(default_stamp)).alias("last_stamp"))
