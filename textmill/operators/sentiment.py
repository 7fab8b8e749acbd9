"""Token-presence Naive Bayes as relational operators.

Semantics of the reference's classifier (expected-likelihood smoothing,
gamma = 0.5):

* prior(l)   = (N_l + .5) / (N + .5 L)                L = labels seen
* P(t | l)   = (c_tl + .5) / (N_l + .5 B_t)           c_tl = training docs of l holding t
* B_t        = 2 if some training document lacks t, else 1
* score(l)   = ln prior(l) + sum of ln P(t | l) over the document's distinct
               tokens that occur in training; absent tokens add nothing.

The model is one row per token with a count column per label (a pivot over
the fixed label domain), so training and scoring are aggregations and one
equi-join, never a token x label cross product.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.sources.articles import SENTIMENT_LABELS

GAMMA = 0.5
TRAIN_BUCKETS = 4  # doc_id % 4 < 3 -> training (3/4 share, like the reference)


def split_train_test(df: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Deterministic 3/4 : 1/4 split on the row id."""
    bucket = F.pmod(F.col(id_col), F.lit(TRAIN_BUCKETS))
    return df.filter(bucket < TRAIN_BUCKETS - 1), df.filter(bucket == TRAIN_BUCKETS - 1)


def label_stats(train: DataFrame, labels: Sequence[str] = SENTIMENT_LABELS) -> DataFrame:
    """One row: ``n_<label>`` training documents per label, ``n`` total,
    ``n_labels`` labels seen."""
    counts = [F.sum((F.col("label") == lab).cast("long")).alias(f"n_{lab}") for lab in labels]
    seen = sum((F.max((F.col("label") == lab).cast("int")) for lab in labels), F.lit(0))
    return train.agg(*counts, F.count(F.lit(1)).alias("n"), seen.alias("n_labels"))


def train(docs: DataFrame, tokens_col: str = "tokens",
          labels: Sequence[str] = SENTIMENT_LABELS) -> tuple[DataFrame, DataFrame]:
    """Returns ``(model, stats)``.

    ``model``: ``token, c_<label>...`` (documents of each label holding the
    token, presence only).  ``stats``: the one-row output of ``label_stats``.
    """
    present = docs.select("label", F.explode_outer(F.array_distinct(tokens_col)).alias("token")) \
        .filter(F.col("token").isNotNull())
    # One conditional count per label: one shuffle by token, combined map-side.
    model = present.groupBy("token").agg(*[F.count_if(F.col("label") == lab).alias(f"c_{lab}") for lab in labels])
    return model, label_stats(docs, labels)


def _stat_values(stats: DataFrame) -> dict[str, Column]:
    """The one ``label_stats`` row as literal columns.

    Read once (one small job) instead of one scalar subquery per statistic,
    each of which would scan the training documents again.
    """
    return {k: F.lit(v) for k, v in stats.first().asDict().items()}


def log_likelihoods(model: DataFrame, stats: DataFrame,
                    labels: Sequence[str] = SENTIMENT_LABELS, values: dict[str, Column] | None = None) -> DataFrame:
    """``token, lp_<label>...``: ln P(t | l) for every known token."""
    st = values if values is not None else _stat_values(stats)
    n = st["n"]
    total = sum((F.col(f"c_{lab}") for lab in labels), F.lit(0))
    bins = F.when(total < n, F.lit(2.0)).otherwise(F.lit(1.0))
    cols = []
    for lab in labels:
        n_l = st[f"n_{lab}"]
        p = (F.col(f"c_{lab}") + GAMMA) / (n_l + GAMMA * bins)
        cols.append(F.log(p).alias(f"lp_{lab}"))
    return model.select("token", *cols)


def classify(docs: DataFrame, model: DataFrame, stats: DataFrame, id_col: str = "doc_id",
             tokens_col: str = "tokens", labels: Sequence[str] = SENTIMENT_LABELS) -> DataFrame:
    """``id_col, score_<label>..., prediction`` for every input document.

    Unknown tokens are dropped by the inner join; documents with no known
    token keep their row through the final left join and score the prior.
    Ties go to the label first in alphabetical order.
    """
    st = _stat_values(stats)
    lp = log_likelihoods(model, stats, labels, st)
    toks = docs.select(id_col, F.explode_outer(F.array_distinct(tokens_col)).alias("token")) \
        .filter(F.col("token").isNotNull())
    sums = (toks.join(lp, "token")
            .groupBy(id_col)
            .agg(*[F.sum(f"lp_{lab}").alias(f"s_{lab}") for lab in labels]))
    n = st["n"]
    n_labels = st["n_labels"]
    out = docs.select(id_col).join(sums, id_col, "left")
    scores = []
    for lab in labels:
        n_l = st[f"n_{lab}"]
        prior = F.log((n_l + GAMMA) / (n + GAMMA * n_labels))
        score = F.when(n_l > 0, prior + F.coalesce(F.col(f"s_{lab}"), F.lit(0.0)))
        scores.append(score.alias(f"score_{lab}"))
    out = out.select(id_col, *scores)
    best = F.greatest(*[F.col(f"score_{lab}") for lab in labels])
    pred = None
    for lab in sorted(labels, reverse=True):
        hit = F.col(f"score_{lab}") == best
        pred = F.when(hit, F.lit(lab)) if pred is None else F.when(hit, F.lit(lab)).otherwise(pred)
    return out.withColumn("prediction", pred)


def accuracy(predicted: DataFrame, label_col: str = "label") -> DataFrame:
    """Share of test rows whose prediction equals the label."""
    return predicted.agg(F.avg((F.col("prediction") == F.col(label_col)).cast("double")).alias("accuracy"),
                         F.count(F.lit(1)).alias("n_test"))


def informative_features(model: DataFrame, stats: DataFrame, n: int = 10,
                         labels: Sequence[str] = SENTIMENT_LABELS) -> DataFrame:
    """Features (token, value) ranked by max/min P(value | l) over the
    labels where that value was observed; value 'True' = token present,
    'None' = token absent."""
    st = _stat_values(stats)
    n_all = st["n"]
    total = sum((F.col(f"c_{lab}") for lab in labels), F.lit(0))
    bins = F.when(total < n_all, F.lit(2.0)).otherwise(F.lit(1.0))
    present, absent = [], []
    for lab in labels:
        n_l = st[f"n_{lab}"]
        c = F.col(f"c_{lab}")
        denom = n_l + GAMMA * bins
        present.append(F.when(c > 0, (c + GAMMA) / denom))
        absent.append(F.when(n_l - c > 0, (n_l - c + GAMMA) / denom))
    rows = model.select("token", F.array(
        F.struct(F.lit("True").alias("value"), F.greatest(*present).alias("hi"), F.least(*present).alias("lo")),
        F.struct(F.lit("None").alias("value"), F.greatest(*absent).alias("hi"), F.least(*absent).alias("lo")),
    ).alias("f"))
    feats = rows.select("token", F.explode("f").alias("f")).select("token", "f.value", "f.hi", "f.lo") \
        .filter(F.col("hi").isNotNull())
    ranked = feats.withColumn("ratio", F.col("hi") / F.col("lo"))
    return (ranked.orderBy(F.desc("ratio"), F.asc("token"), F.asc("value"))
            .limit(n).select("token", "value", "ratio"))
