import math

from textmill.operators import sentiment as nb

LABELS = ["pos", "neg"]


def test_naive_bayes_fixture(spark):
    train = spark.createDataFrame([(1, "pos", ["a", "b"]), (2, "pos", ["a"]), (3, "neg", ["b"])],
                                  "doc_id long, label string, tokens array<string>")
    model, stats = nb.train(train, "tokens", LABELS)
    docs = spark.createDataFrame([(10, ["a", "b"]), (11, ["b"]), (12, ["zzz"]), (13, ["a", "a", "b"])],
                                 "doc_id long, tokens array<string>")
    out = {r.doc_id: r for r in nb.classify(docs, model, stats, "doc_id", "tokens", LABELS).collect()}
    expect = {10: (0.2604166667, 0.0703125), 11: (0.3125, 0.28125), 12: (0.625, 0.375),
              13: (0.2604166667, 0.0703125)}
    for doc, (p, n) in expect.items():
        assert math.isclose(math.exp(out[doc].score_pos), p, rel_tol=1e-9)
        assert math.isclose(math.exp(out[doc].score_neg), n, rel_tol=1e-9)
        assert out[doc].prediction == "pos"


def test_split_is_three_quarters(spark):
    df = spark.range(0, 400).withColumnRenamed("id", "doc_id")
    tr, te = nb.split_train_test(df)
    assert tr.count() == 300 and te.count() == 100
