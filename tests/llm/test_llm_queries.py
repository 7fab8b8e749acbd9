"""The registered queries of the subpackage on the small tables."""

import pytest

from conftest import SF001
from oracle_harness import compare, duck
from textmill.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    r = compare(spark, name, QUERIES[name], ORACLE[name], SF001, con)
    assert r["match"], r


@pytest.mark.parametrize("name, label, least", [("op4_toxicity", "toxic", 0.9), ("op9_quality_neighbours", "quality", 0.95)])
def test_held_out_accuracy(spark, name, label, least):
    scored = QUERIES[name](spark, SF001).filter("held_out")
    labels = spark.read.parquet(f"{SF001}/labels.parquet").select("doc_id", label)
    rows = scored.join(labels, "doc_id").collect()
    assert sum(r.predicted == r[label] for r in rows) >= least * len(rows)


def test_pipeline_runs_whole(spark):
    import corpus_pipeline as c

    docs, sizes = c.table(spark, SF001, "documents"), []
    columns = docs.columns
    for name, stage in c.STAGES:
        docs = c.written(stage(spark, docs, SF001), name)
        sizes.append(docs.count())
        if name != c.STAGES[-1][0]:
            assert docs.columns == columns
    assert sizes[:4] == sorted(sizes[:4], reverse=True) and sizes[3] > 600
