from pyspark.sql import functions as F

from conftest import SF001, SF0001
from textmill.operators.language import detect_language, filter_languages
from textmill.sources.tables import table


def test_language_detection_agrees_with_given_labels(spark):
    docs = table(spark, SF001, "documents", "doc_id", "text", "lang")
    got = detect_language(docs, "text").join(docs, "doc_id")
    share = got.agg(F.avg((F.col("language") == F.col("lang")).cast("double"))).first()[0]
    assert share >= 0.95


def test_no_hit_is_error_and_empty_list_keeps_all(spark):
    df = spark.createDataFrame([(1, "zzz qqq"), (2, "the cat and the dog")], "doc_id long, description string")
    got = {r.doc_id: r.language for r in detect_language(df).collect()}
    assert got == {1: "Error", 2: "en"}
    assert filter_languages(df, []).columns == df.columns


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["source", "rank", "token", "n"]
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_stands_without_the_optional_subpackage():
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ("import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; "
            "n = sorted(e.queries()); print(len(n), any(x.startswith('op') or x == 'pipeline' for x in n), len(e.oracle_sql()))")
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=repo, capture_output=True, text=True, timeout=120)
    count, llm, sql = done.stdout.split()
    assert int(count) >= 60 and llm == "False" and int(sql) >= 50, done.stderr
