"""Repeated ids, ties, racing writers, odd labels and workers without the package."""

import os
import random
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmill.llm import licences as L
from textmill.llm import quality as Q
from textmill.llm import simhash as S
from textmill.llm import topk as K
from textmill.llm import toxicity as T
from textmill.llm import urls as U
from textmill.llm.common import held_out, labelled_sample
from textmill.llm.counts import Rollup, changes
from textmill.session import scratch_path

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="module")
def entry_pipeline():
    sys.path.insert(0, REPO)
    import corpus_pipeline

    return corpus_pipeline


# -- pipeline ---------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def near_copy_rows(pipeline, spark, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    kept = pipeline.drop_near_copies(spark, docs, None)
    assert kept.columns == docs.columns
    return sorted([(r.doc_id, r.text) for r in kept.collect()], key=str)


def test_near_copies_with_repeated_ids_keep_a_row_of_each_group(spark, entry_pipeline):
    w, u = "one text of some words here", "quite another text that shares no words"
    got = near_copy_rows(entry_pipeline, spark, [(3, w), (5, w), (5, u), (6, u), (7, u)])
    assert got == sorted([(3, w), (5, u)], key=str)
    got = near_copy_rows(entry_pipeline, spark, [(None, w), (4, w), (None, u), (None, u), (9, None), (8, "")])
    assert got == sorted([(4, w), (None, u), (None, u), (8, "")], key=str)
    assert near_copy_rows(entry_pipeline, spark, []) == []


def test_pipeline_stages_on_odd_rows(spark, entry_pipeline, tmp_path):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps"]) + str(rng.randrange(99)) for _ in range(n))
    rows = [(i, text(60)) for i in range(30)] + [(30, None), (31, ""), (32, text(30_000)), (None, text(20)), (7, text(50)), (33, text(40))]
    rows.append((33, rows[-1][1]))
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    empty = docs.limit(0)
    labels = spark.createDataFrame([(i, i % 2, i % 3 == 0 and 1 or 0) for i in range(40)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, text(12))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in entry_pipeline.STAGES:
        got = stage(spark, docs, str(tmp_path))
        if name == "packing":
            assert {r.doc_id for r in got.collect()} == {i for i, _ in rows} and "sequence_id" in got.columns
        else:
            assert got.columns == docs.columns and got.count() <= len(rows)
        assert stage(spark, empty, str(tmp_path)).count() == 0


# -- 2 ----------------------------------------------------------------------

def test_root_licence_is_inherited_everywhere(spark):
    mit = L.TEMPLATES["MIT"] if "MIT" in L.TEMPLATES else next(iter(L.TEMPLATES.values()))
    name = "MIT" if "MIT" in L.TEMPLATES else next(iter(L.TEMPLATES))
    rows = [(1, "LICENSE", mit), (2, "src/a.py", "x = 1"), (3, "README", "read me"), (4, "src/deep/b.py", "y"), (5, None, "z")]
    files = spark.createDataFrame(rows, "id long, path string, text string")
    got = {r.id: (r.licence, r.from_directory) for r in L.scan_licences(files, F.array("text")).collect()}
    assert got == {1: (name, None), 2: (name, ""), 3: (name, ""), 4: (name, ""), 5: (None, None)}


def test_too_many_passages_are_refused():
    with pytest.raises(ValueError, match="passages"):
        L._passage_rows({}, [("X", "word " * L.MAX_CHARS)], 0.6)


# -- 4, 9 -------------------------------------------------------------------

def test_sample_counts_only_labels_of_documents(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    labels = spark.range(100_000).select((F.col("id") + 400).alias("doc_id"), F.lit(1).alias("toxic"))
    present = docs.join(labels, "doc_id").filter(~held_out()).count()
    assert labelled_sample(docs, labels, "toxic", 200).count() == present
    assert labelled_sample(docs, labels, "toxic", 20).count() == 20


def test_one_label_and_no_significant_term_score_the_base_rate(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(40)], "doc_id long, text string")
    for toxic, want in ((1, {1.0}), (0, {0.0})):
        labels = docs.select("doc_id", F.lit(toxic).alias("toxic"))
        assert {r.score for r in T.toxicity(docs, labels).collect()} == want
        assert T.clean_documents(docs, labels).count() == (0 if toxic else 40)
    mixed = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    scores = {r.score for r in T.toxicity(docs, mixed).collect()}
    assert len(scores) == 1 and 0.1 < scores.pop() < 0.5


def test_quality_vote_equals_brute_force(spark):
    rng = random.Random(4)
    styles = [lambda: " ".join(rng.choice("ABC") * 3 for _ in range(20)), lambda: "a well formed line, with words. " * 3 + str(rng.random())]
    rows = [(i, styles[i % 2]()) for i in range(90)] + [(200, rows0 := styles[0]()), (201, rows0), (202, None), (203, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 2 == 0 or i % 7 == 0)) for i in range(90)], "doc_id long, quality int")
    model = Q.fit(docs, labels)
    texts = [t for _, t in rows]
    got = {}
    for r in Q.quality(docs, labels).collect():
        got.setdefault(r.doc_id, r.score)
    x = np.concatenate(list(Q.bags(texts)))
    v = (np.log1p(x) * model.idf) @ model.project
    v = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    for (doc, _), own in zip(rows, v):
        near = sorted((-float(own.astype(np.float32) @ t), i) for i, t in enumerate(model.vectors))
        edge = -near[model.neighbours - 1][0]
        sure = [i for s, i in near if -s > edge + 1e-5]
        tied = [i for s, i in near if abs(-s - edge) <= 1e-5]
        w = lambda i: np.exp(Q.SHARPNESS * (float(own @ model.vectors[i]) - 1))
        free = model.neighbours - len(sure)
        marks = sorted(float(model.labels[i]) for i in tied)
        total = sum(map(w, sure)) + free * np.exp(Q.SHARPNESS * (edge - 1))
        least = (sum(w(i) * model.labels[i] for i in sure) + sum(marks[:free]) * np.exp(Q.SHARPNESS * (edge - 1))) / total
        most = (sum(w(i) * model.labels[i] for i in sure) + sum(marks[len(marks) - free:]) * np.exp(Q.SHARPNESS * (edge - 1))) / total
        assert least - 1e-3 <= got[doc] <= most + 1e-3


# -- 5 ----------------------------------------------------------------------

def test_top_k_of_large_components_is_exact_or_refused(spark):
    rows = [(0, [3e5, 2.0]), (1, [3e5, -1.0]), (2, [2.9e5, 7.0]), (50, [-3e5, 0.25])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    scaled = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
    want = {(q, sum(a * b for a, b in zip(scaled[q], scaled[c])), c) for q in (0, 50) for c in scaled if c != q}
    got = K.top_k(frame, F.col("vec_id") % 50 == 0, k=5).collect()
    assert {(r.query_id, r.score, r.vec_id) for r in got} == want
    with pytest.raises(Exception, match="64 bits"):
        K.top_k(spark.createDataFrame([(0, [1e12]), (1, [1.0])], "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0).collect()


# -- 6 ----------------------------------------------------------------------

def test_equal_lengths_do_not_depend_on_blocks(spark):
    rng = random.Random(5)
    hosts = ["org", "example.org", "a.example.org", "b.example.org", "com", "a.com"]
    rules = sorted({(rng.choice(["allow", "block"]), rng.choice(hosts) + rng.choice(["/", "/x", "/x1", "/x12345", "/x1234567", "/x123"]))
                    for _ in range(40)})
    urls = [f"http://{h}/{p}" for h in hosts + ["q.a.example.org"] for p in ("", "x", "x1", "x123", "x12345", "x1234567890")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    frame = spark.createDataFrame(rules, "verdict string, rule string")

    def fits(url, rule):
        host, _, path = url.partition("://")[2].partition("/")
        h, _, p = rule.partition("/")
        return (host == h or host.endswith("." + h)) and path.startswith(p)

    want = {}
    for i, u in enumerate(urls):
        best = max(((len(r), len(r.partition("/")[0]), v, r) for v, r in rules if fits(u, r)), default=None)
        want[i] = best and (best[3], best[2])
    for block in (U.RULE_BLOCK, 3, 1):
        got = {r.page_id: r.rule and (r.rule, r.verdict) for r in U.judge_urls(pages, frame, rule_block=block).collect()}
        assert got == want


# -- 8 ----------------------------------------------------------------------

def test_two_writers_of_one_batch_count_once(spark):
    path = scratch_path(spark, "rollup")
    first, second = Rollup(spark, path), Rollup(spark, path)
    docs = spark.createDataFrame([("a", "en", 10, 99)], "source string, lang string, n long, docs int")
    load = changes(docs, "insert", "v1", F.col("n"))
    seen = second._parts
    second._parts = lambda batch: [] if not calls.append(batch) and len(calls) == 1 else seen(batch)  # looks before the other ends
    calls: list = []
    assert first.commit("007", load)
    second.commit("007", load)
    assert len(calls) == 2 and len(first._parts("007")) == 2
    assert [tuple(r) for r in first.totals().collect()] == [("a", "en", "v1", 1, 10)]
    assert first.commit("7", load) and not second.commit("7", load)
    assert [tuple(r) for r in second.totals().collect()] == [("a", "en", "v1", 2, 20)]


# -- 10 ---------------------------------------------------------------------

def test_a_dense_ball_beyond_the_limit_is_linked_in_blocks(spark):
    rng = random.Random(6)
    centre = rng.getrandbits(64)
    ball = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))) for _ in range(400)}
    far = [rng.getrandbits(64) for _ in range(40)]
    fps = sorted(ball) + far
    frame = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    pairs = {(int(np.int64(r.a).astype(np.uint64)), int(np.int64(r.b).astype(np.uint64))) for r in S.links(frame, 4, cell_rows=20).collect()}
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        assert (a ^ b).bit_count() <= 4
        root[find(a)] = find(b)
    want = {f: f for f in fps}
    mine, root = {f: find(f) for f in fps}, want
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 4:
                root[find(a)] = find(b)
    assert {frozenset(f for f in fps if mine[f] == r) for r in mine.values()} == {
        frozenset(f for f in fps if find(f) == r) for r in {find(f) for f in fps}}


# -- workers ----------------------------------------------------------------

def test_operators_run_where_workers_lack_the_package(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {REPO!r})
from textmill.session import build_session
from textmill.llm import quality, toxicity, urls
spark = build_session("local[2]", 2)
docs = spark.createDataFrame([(i, ("vile " if i % 2 else "kind ") * 5 + "word%d. X, y" % (i % 5) + "!" * (i % 2)) for i in range(60)], "doc_id long, text string")
labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
assert toxicity.toxicity(docs, labels).filter("score > 0.5").count() == 30
assert quality.quality(docs, labels).count() == 60
pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
assert urls.judge_urls(pages, spark.createDataFrame(urls.RULES, "verdict string, rule string")).first().rule == "org/"
print("all ran")
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "all ran" in done.stdout, done.stderr[-2000:]


def test_licence_anchors_bound_every_cosine():
    import random

    from textmill.llm import licences

    rng = random.Random(7)
    for v, least in ((v, 0.6) for v in licences.template_vectors(licences.TEMPLATES)[0].values()):
        anchors = set(licences._anchors(v, least))
        rest = [w for w in v if w not in anchors]
        # The best text without anchors is the rest of the template itself.
        assert sum(v[w] ** 2 for w in rest) ** 0.5 < least
        for _ in range(20):
            x = {w: rng.random() for w in rest}
            norm = sum(y * y for y in x.values()) ** 0.5 or 1.0
            assert sum(x[w] * v[w] for w in x) / norm < least


def test_licence_words_are_those_of_the_pattern(spark):
    import re

    from pyspark.sql import functions as F

    from textmill.llm import licences

    texts = ["".join(map(chr, range(700))) + " \U0001F600x Y", "", " ", "\x00A\x00b", "É_a-B9"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    lower = str.maketrans(licences._UPPER, licences._LOWER)
    for text, words in df.select("text", licences._words(F.col("text"))).collect():
        assert words == re.findall(licences._WORD, text.translate(lower))


def _brute_licence(text, templates, passages, threshold):
    """The best (licence, score) of one part, every window of every passage scored."""
    import re
    from collections import Counter

    def words(t):
        return re.findall(L._WORD, t.translate(str.maketrans(L._UPPER, L._LOWER)))

    def cosine(window, vector, idf, unknown):
        bag = {w: n * idf.get(w, unknown) for w, n in Counter(window).items()}
        norm = sum(x * x for x in bag.values()) ** 0.5
        return round(sum(x * vector.get(w, 0.0) for w, x in bag.items()) / norm, 6) if norm else 0.0

    ws, found = words(text), []
    vectors, idf, unknown = L._vectors(templates)
    for k, v in vectors.items():
        found.append((False, -cosine(ws, v, idf, unknown), 0, k, threshold))
    texts = [*templates.items(), *passages]
    vectors, idf, unknown = L._vectors({str(i): t for i, (_, t) in enumerate(texts)})
    for i, (k, t) in enumerate(texts):
        n, v, tag = len(words(t)), vectors[str(i)], t.startswith("SPDX-License-Identifier:")
        if len(ws) > n:
            windows, least = [ws[p:p + n] for p in range(len(ws)) if ws[p] in v], 1 - 1e-6 if tag else L.WITHIN
        else:
            windows, least = [ws], 2.0 if i < len(templates) else 1 - 1e-6 if tag else threshold
        found += [(k == L.RESERVED, -cosine(w, v, idf, unknown), -n, k, least) for w in windows]
    best = min((f for f in found if -f[1] >= f[4] and f[1] < 0), default=None)
    return best and (best[3], -best[1])


def test_licence_passages_are_those_of_every_window(spark):
    """Bounds and anchors lose nothing: random parts, passages with words dropped,
    replaced and put between other words, against all windows scored in Python."""
    import random

    rnd = random.Random(5)
    pool = sorted({w for _, t in (*L.TEMPLATES.items(), *L.PASSAGES) for w in t.split()}) + ["Zebra", "é", "of", "lorem", "x1"]
    texts = [*L.TEMPLATES.values(), *(t for _, t in L.PASSAGES), "", " .,"]
    for t in [*L.TEMPLATES.values(), *(t for _, t in L.PASSAGES)] * 2:
        ws = [rnd.choice(pool) if rnd.random() < 0.12 else w for w in t.split() if rnd.random() > 0.1]
        texts.append(" ".join([*rnd.choices(pool, k=rnd.choice((0, 3, 40))), *ws, *rnd.choices(pool, k=rnd.choice((0, 2, 60)))]))
    parts = spark.createDataFrame(list(enumerate(texts)), "file long, text string").selectExpr("file", "0 as part", "text")
    got = {r.file: (r.licence, r.score) for r in L.own_licences(parts, L.TEMPLATES, L.THRESHOLD, L.PASSAGES).collect()}
    want = {i: _brute_licence(t, L.TEMPLATES, L.PASSAGES, L.THRESHOLD) for i, t in enumerate(texts)}
    want = {i: b for i, b in want.items() if b}
    assert got.keys() == want.keys() and len(want) > 100
    for i, (licence, score) in want.items():
        assert abs(got[i][1] - score) < 2e-6, texts[i]
        assert got[i][0] == licence or abs(got[i][1] - score) > 0, texts[i]
