from datetime import datetime

from pyspark.sql import functions as F

from textmill.operators.indexing import chunk_lists, dense_index
from textmill.operators.lookup import lookup_with_default
from textmill.sources.batches import day_batches, high_water_mark, scan_batches, select_window, union_batches


def _write_batch(folder, name, rows):
    import csv

    with open(folder / name, "w", encoding="utf-8", newline="") as fh:
        w = csv.DictWriter(fh, ["source", "description"])
        w.writeheader()
        w.writerows({"source": s, "description": d} for s, d in rows)


def test_window_scan_reads_files_by_stamp(spark, tmp_path):
    _write_batch(tmp_path, "2020-01-01T000000.csv", [("a", 'one "quoted"\nline')])
    _write_batch(tmp_path, "2020-01-02T000000.csv", [("b", "two")])
    _write_batch(tmp_path, "2020-01-09T000000.csv", [("c", "three")])
    df = scan_batches(spark, str(tmp_path), "source string, description string")
    got = select_window(df, datetime(2020, 1, 1), datetime(2020, 1, 8))
    rows = sorted((r.source, r.description, r.batch_stamp) for r in got.collect())
    assert rows == [("a", 'one "quoted"\nline', "2020-01-01T000000"), ("b", "two", "2020-01-02T000000")]
    hwm = high_water_mark(df).first()
    assert hwm.last_stamp == "2020-01-09T000000" and hwm.last_ts == datetime(2020, 1, 9)


def test_high_water_mark_default_when_empty(spark):
    empty = spark.createDataFrame([], "batch_stamp string")
    assert high_water_mark(empty, datetime(2020, 1, 1)).first().last_stamp == "2020-01-01T000000"


def test_day_split_bounds(spark):
    now = datetime(2020, 6, 15, 12, 0, 0)
    ts = ["2020-06-14 12:00:00", "2020-06-15 12:00:00", "2020-06-02 12:00:00", "2020-06-02 11:59:59"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ts)], "i int, s string") \
        .withColumn("ts", F.to_timestamp("s"))
    got = {r.i: r.batch_name for r in day_batches(df, now, 13, "ts").collect()}
    assert got == {0: "2020-06-15T120000", 2: "2020-06-03T120000"}


def test_lookup_with_default(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "i int, source string")
    dim = spark.createDataFrame([("a", "business")], "id string, category string")
    got = {r.i: r.category for r in lookup_with_default(facts, dim, "source", "id", "category", "category")
           .collect()}
    assert got == {1: "business", 2: "NC", 3: "NC"}


def test_chunks_and_dense_index(spark):
    df = spark.createDataFrame([(x,) for x in "edcba"], "s string")
    got = sorted((r.chunk, r.members) for r in chunk_lists(df, "s", 2).collect())
    assert got == [(0, "a,b"), (1, "c,d"), (2, "e")]
    big = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"))
    idx = dense_index(big, ["k"], num_partitions=5).collect()
    assert sorted((r.k, r.idx) for r in idx) == [(i, i) for i in range(1000)]


def test_union_by_name_fills_missing(spark):
    a = spark.createDataFrame([(1, "x")], "id int, text string")
    b = spark.createDataFrame([(2, "y", "user")], "id int, text string, role string")
    rows = sorted(union_batches([a, b]).collect(), key=lambda r: r.id)
    assert rows[0].role is None and rows[1].role == "user"
