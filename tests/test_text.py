import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textmill.functions.stamps import stamp
from textmill.functions.text import (
    CLEAN_LEAD_REWRITES,
    CLEAN_TAIL_REWRITES,
    clean_text,
    shorten,
    tokenize,
)
from textmill.sources.stopwords import topic_stop_words

CASES = [
    ("what's new", "what is new"),
    ("it's", "it is"),
    ("can't", "cannot"),
    ("won't", "wo not"),
    ("don't", "do not"),
    ("they're", "they are"),
    ("he'd", "he would"),
    ("(AP) - It's what's new, can't won't I'm they're he'd we'll I've &rsquo;s Café_x 9 ?! ",
     "it is what is new cannot wo not i am they are he would we will i have is cafx"),
    ("", ""),
]


def py_clean(text: str) -> str:
    """The cleaning rules written as plain Python, for the property test."""
    t = text.lower()
    for a, b in CLEAN_LEAD_REWRITES + CLEAN_TAIL_REWRITES:
        t = t.replace(a, b)
    t = re.sub(r"\W+", " ", t)
    t = re.sub(r"\s+", " ", t)
    t = re.sub("[^a-zA-Z ?!]+", "", t)
    return "".join(c for c in t if ord(c) < 128).strip()


def _clean_all(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(clean_text("t")).collect()]


def test_clean_text_fixtures(spark):
    got = _clean_all(spark, [c[0] for c in CASES])
    assert got == [c[1] for c in CASES]


def test_empty_text_has_no_tokens(spark):
    df = spark.createDataFrame([("",)], "t string")
    assert df.select(tokenize("t", topic_stop_words())).first()[0] == []


def test_fused_words_split_and_stop_words_drop(spark):
    df = spark.createDataFrame([("Gonna cannot lemme Zebra zebras will",)], "t string")
    toks = df.select(tokenize("t", topic_stop_words())).first()[0]
    assert toks == ["gon", "na", "lem", "zebra", "zebras"]


PIECES = list("abcXYZ '’&;()-_.,?!9éüİ\n\t") + ["'s", "n't", "what's", "(ap) - ", "&rsquo;", "İstanbul"]


@settings(max_examples=1, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), min_size=1, max_size=12), min_size=50, max_size=50))
def test_clean_text_matches_python_rules(spark, pieces):
    texts = ["".join(p) for p in pieces]
    assert _clean_all(spark, texts) == [py_clean(t) for t in texts]


def test_shorten(spark):
    df = spark.createDataFrame([("x" * 99,), ("y" * 100,)], "t string")
    out = [r[0] for r in df.select(shorten("t")).collect()]
    assert out == ["x" * 99, "y" * 100 + "..."]


def test_stamp_format(spark):
    df = spark.createDataFrame([("2020-06-15 12:00:00",)], "s string")
    assert df.select(stamp(F.to_timestamp("s"))).first()[0] == "2020-06-15T120000"
