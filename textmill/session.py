"""Session construction and small cluster-safety helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings of sessions that ``build_session`` makes; a session made
# elsewhere keeps its own.
#
# * AQE re-plans joins and coalesces shuffle partitions at run time; skew-join
#   splitting protects the term and token joins, whose keys are Zipf-skewed.
# * No broadcast on *estimated* sizes: after checkpoints and explodes the
#   planner's estimates can be orders of magnitude too small.  Broadcasts
#   happen either explicitly, for fixed-size dimensions, or by AQE once a
#   shuffle stage has *measured* the side below the adaptive threshold.
# * Timestamps are interpreted in UTC.
RUNTIME_SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Settings fixed when the session starts.
SESSION_DEFAULTS = {
    **RUNTIME_SQL_DEFAULTS,
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Python workers are reused between tasks: the HTML parser and the
    # pandas batches then pay interpreter start-up once per executor core.
    "spark.python.worker.reuse": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "textmill", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the textmill defaults.

    On a cluster ``master`` stays ``None`` so spark-submit decides; locally
    pass ``local[N]``.  ``shuffle_partitions`` should be sized so that one
    shuffle partition holds roughly 128-256 MB at the target scale; scans of
    the text tables are dealt over as many tasks.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
        conf["spark.textmill.scan.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only where that is
    unset, and only in a local session (tests, a laptop), a sub-folder of the
    warehouse is used; on a cluster its default is no shared place, so the
    setting is required there.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    folder = configured or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a written table, below this application's part of the
    shared folder (``drop_scratch`` removes that part)."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/textmill-{spark.sparkContext.applicationId}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete every intermediate table of this application.  Call it when no
    frame returned by a query is read any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_written(df: DataFrame) -> None:
    """Delete the intermediate tables that ``df``, a frame of ``written`` ones,
    reads, and let go of the shuffle files of frames that are out of use.  Only
    for loops, whose earlier rounds nothing reads any more."""
    spark = df.sparkSession
    root, jvm = _scratch_root(spark), spark.sparkContext._jvm
    name = root.rstrip("/").rsplit("/", 1)[1]
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if folder.rsplit("/", 2)[1] == name:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    release(spark)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of frames that are out of use: after a large
    table is written, so that a query's disk is that of its largest step and not
    of all its steps together."""
    spark.sparkContext._jvm.System.gc()


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as parquet into the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, and later branches get
    column pruning and statistics from parquet.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal rows out by their unique id before per-row text work, where the
    session asks for it with ``spark.textmill.scan.partitions``: for tables stored
    as fewer splits than there are cores.  Unset, nothing is shuffled."""
    n = df.sparkSession.conf.get("spark.textmill.scan.partitions", None)
    return df.repartition(int(n), key) if n else df


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage (see ``written``).

    Used where a plan reads an expensive intermediate from several branches
    (e.g. per-document terms feeding tf, df, norms and the document count):
    the branches read parquet instead of re-running the text pipeline.
    """
    return written(df, "materialized")
