import os

from pyspark.sql import functions as F

from textmill.operators.counts import daily_counts
from textmill.streaming import ingest

SCHEMA = "id long, ts timestamp, kind string, text string"


def _write(spark, folder, rows, name):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(os.path.join(folder, name))


def test_incremental_ingest_resumes_and_matches_batch(spark, tmp_path):
    src = str(tmp_path / "in")
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    from datetime import datetime as dt
    _write(spark, src, [(1, dt(2024, 1, 1, 1), "a", "x"), (2, dt(2024, 1, 1, 5), "b", "y")], "b1")
    stream = ingest.read_stream(spark, src + "/*", SCHEMA)
    ingest.run_to_table(stream, out, ckpt)
    assert spark.read.parquet(out).count() == 2
    _write(spark, src, [(3, dt(2024, 1, 2, 1), "a", "z")], "b2")
    ingest.run_to_table(ingest.read_stream(spark, src + "/*", SCHEMA), out, ckpt)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2, 3]

    counts_out, counts_ckpt = str(tmp_path / "counts"), str(tmp_path / "counts_ckpt")
    write = ingest.batch_table(counts_out)

    def twice(batch, batch_id):  # a replayed batch must change nothing
        write(batch, batch_id)
        write(batch, batch_id)

    ingest.run_each_batch(ingest.daily_counts_stream(ingest.read_stream(spark, src + "/*", SCHEMA), "ts", "kind"),
                          twice, counts_ckpt, mode="update")
    batch = daily_counts(spark.read.parquet(src + "/*"), "ts", "kind")
    keys = [c for c in batch.columns if c != "n"]
    got = ingest.latest(spark, counts_out, keys, "n").select(batch.columns)
    assert sorted(got.collect()) == sorted(batch.collect())


def test_dedup_within_watermark(spark, tmp_path):
    from datetime import datetime as dt
    src = str(tmp_path / "in")
    _write(spark, src, [(1, dt(2024, 1, 1), "a", "same"), (2, dt(2024, 1, 2), "a", "same"),
                        (3, dt(2024, 1, 2), "a", "other")], "b1")
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    ingest.run_to_table(ingest.dedup_stream(ingest.read_stream(spark, src + "/*", SCHEMA), ["text"], "ts"), out, ckpt)
    assert sorted(r.text for r in spark.read.parquet(out).collect()) == ["other", "same"]


def test_dedup_over_several_batches(spark, tmp_path):
    """A repeat within the watermark goes, one long after it counts as new."""
    from datetime import datetime as dt
    src, out, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    for name, rows in (("b1", [(1, dt(2024, 1, 1), "a", "same")]), ("b2", [(2, dt(2024, 1, 3), "a", "same")]),
                       ("b3", [(3, dt(2024, 2, 1), "a", "new")]), ("b4", [(4, dt(2024, 2, 10), "a", "same")])):
        _write(spark, src, rows, name)
        ingest.run_to_table(ingest.dedup_stream(ingest.read_stream(spark, src + "/*", SCHEMA), ["text"], "ts"), out, ckpt)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 3, 4]
