"""Quality by nearest-neighbour voting in a latent-semantic space.

A document is a bag of style terms: hashed four-grams of its text's shape
(letters by case, digits, white space and punctuation signs, runs shortened to
one sign) and graded terms for how much its words, neighbouring words and lines
repeat.  Their log counts are weighted by inverse document frequency and
projected on the leading singular vectors of a bounded labelled sample.  The
sample's vectors with their labels (``TRAIN_ROWS`` x ``DIMENSIONS`` numbers at
most) are broadcast; every document takes exact cosine products with all of
them, in blocks, and its ``NEIGHBOURS`` nearest vote, weighted by similarity.

Documents are scored where they are read; only the sample moves.

Defined results: null and empty texts have no shape terms and are scored by the
neighbours of the empty bag; without labels every score is 0.5; if the sample
has one label only, that is the score; repeated rows are scored each; a null doc_id is
kept, its remainder taken of the empty string; null labels take no part;
further columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import filter_rows, held_out, labelled_sample, map_rows, shared, table
from textmill.session import written

TRAIN_ROWS = 6_000
DIMENSIONS = 64
NEIGHBOURS = 15
SHAPES = 1024
GRADES = 11
SHARPNESS = 12.0
#: 3 graded terms of 11 steps after the shapes.
TERMS = SHAPES + 3 * GRADES
BLOCK = 2_000
CHUNK = 1_000_000

# White space, line end, small, capital, digit, then signs of their own.
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_CLASS = np.full(256, 2, np.uint8)
_CLASS[:33] = 0
_CLASS[10] = 1
_CLASS[65:91] = 3
_CLASS[48:58] = 4
for _i, _c in enumerate(_SIGNS):
    _CLASS[ord(_c)] = 5 + _i
_CLASS[0x80:0x9F] = 3  # capitals of the Latin-1 letters, by their second byte
_LEADS = bytes(range(0xC2, 0xF5))


def _bags(texts: list[bytes]) -> np.ndarray:
    """Counts of all terms, a row per text; texts without lead bytes."""
    n = len(texts)
    out = np.zeros((n, TERMS), np.float32)
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, n) + 1
    doc = np.repeat(np.arange(n), sizes)
    cls = _CLASS[raw]
    keep = np.concatenate(([True], (cls[1:] != cls[:-1]) | (doc[1:] != doc[:-1])))
    shape, of = cls[keep].astype(np.int64), doc[keep]
    if len(shape) > 3:
        gram = ((shape[:-3] * 41 + shape[1:-2]) * 41 + shape[2:-1]) * 41 + shape[3:]
        same = of[:-3] == of[3:]
        term = (gram[same] * 0x9E3779B1 >> 11) % SHAPES
        out[:, :SHAPES] = np.bincount(of[:-3][same] * SHAPES + term, minlength=n * SHAPES).reshape(n, SHAPES)
    space = cls <= 1
    first = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    if not len(first):
        return out
    # A polynomial hash of each word, by prefix sums (arithmetic modulo 2**64).
    rolled = _rolled(raw)
    last = np.flatnonzero(~space & np.concatenate((space[1:], [True])))
    word = _span_hash(rolled, first, last + 1)
    wdoc = doc[first]
    words = np.bincount(wdoc, minlength=n)
    _grade(out, SHAPES, 1 - _distinct(wdoc, word, n) / np.maximum(words, 1), words)
    again = (word[1:] == word[:-1]) & (wdoc[1:] == wdoc[:-1])
    _grade(out, SHAPES + GRADES, np.bincount(wdoc[1:][again], minlength=n) / np.maximum(words, 1), words)
    end = np.flatnonzero(raw == 10)
    begin = np.concatenate(([0], end[:-1] + 1))
    full = end > begin + 1
    ldoc = doc[begin[full]]
    lines = np.bincount(ldoc, minlength=n)
    _grade(out, SHAPES + 2 * GRADES,
           1 - _distinct(ldoc, _span_hash(rolled, begin[full], end[full]), n) / np.maximum(lines, 1), lines)
    return out


_BASE = 0x100000001B3
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _rolled(raw: np.ndarray) -> np.ndarray:
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(raw)))))


def _span_hash(rolled: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Equal bytes get equal hashes, wherever they stand."""
    return (rolled[end] - rolled[first]) * _powers(_INVERSE, len(rolled))[first]


def _distinct(doc: np.ndarray, key: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((key, doc))
    d, k = doc[order], key[order]
    new = np.concatenate(([True], (d[1:] != d[:-1]) | (k[1:] != k[:-1])))
    return np.bincount(d[new], minlength=n)


def _grade(out: np.ndarray, at: int, share: np.ndarray, has: np.ndarray) -> None:
    """All steps up to the share are set, so near shares have near bags."""
    steps = np.arange(GRADES)[None, :] <= np.round(share * (GRADES - 1))[:, None]
    out[:, at:at + GRADES] = np.where(steps & (has > 0)[:, None], 30.0, 0.0)


def bags(texts: list[str | None]):
    """Blocks of bags of whole texts, a row per text."""
    i = 0
    while i < len(texts):
        some, size = [], 0
        while i < len(texts) and len(some) < BLOCK and (not some or size < CHUNK):
            some.append((texts[i] or "").encode("utf-8", "replace").translate(None, _LEADS))
            size += len(some[-1])
            i += 1
        yield _bags(some)


class Model:
    def __init__(self, counts: np.ndarray, labels: np.ndarray, dimensions: int, neighbours: int):
        x = np.log1p(counts.astype(np.float64))
        self.idf = np.log((1 + len(x)) / (1 + (counts > 0).sum(0))) + 0.1
        x *= self.idf
        _, vectors = np.linalg.eigh(x.T @ x)
        self.project = vectors[:, ::-1][:, :dimensions]
        self.vectors = self._unit(x @ self.project).astype(np.float32)
        self.labels = labels.astype(np.float32)
        self.neighbours = min(neighbours, len(labels))

    @staticmethod
    def _unit(v: np.ndarray) -> np.ndarray:
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)

    def score(self, counts: np.ndarray) -> np.ndarray:
        v = self._unit((np.log1p(counts) * self.idf) @ self.project).astype(np.float32)
        near = v @ self.vectors.T
        k = self.neighbours
        at = np.argpartition(near, -k, axis=1)[:, -k:]
        weight = np.exp(SHARPNESS * (np.take_along_axis(near, at, 1).astype(np.float64) - 1))
        return np.clip((weight * self.labels[at]).sum(1) / weight.sum(1), 0.0, 1.0)


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, dimensions: int = DIMENSIONS,
        neighbours: int = NEIGHBOURS) -> Model | float:
    """A model of labels.quality, or a constant score where there is nothing to tell apart."""
    sample = written(labelled_sample(docs, labels, "quality", train_rows), "quality-sample")

    def run(batches):
        for b in batches:
            lo = 0
            for x in bags(b["text"]):
                yield {"doc_id": b["doc_id"][lo:lo + len(x)], "label": b["label"][lo:lo + len(x)],
                       "bag": [r.astype(np.float32).tobytes() for r in x]}
                lo += len(x)

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = map_rows(sample.select("doc_id", "text", "label"), run, f"doc_id {kind}, label int, bag binary")
    rows = sorted(rows.collect(), key=lambda r: (str(r.doc_id), bytes(r.bag)))  # at most train_rows
    y = np.array([r.label for r in rows], np.float64)
    if not len(y):
        return 0.5
    if y.min() == y.max():
        return float(y[0])
    return Model(np.stack([np.frombuffer(r.bag, np.float32) for r in rows]), y, dimensions, neighbours)


def quality(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, score) of every row of ``docs`` (doc_id, text)."""
    model = fit(docs, labels, train_rows)
    docs = docs.select("doc_id", "text")
    if isinstance(model, float):
        return docs.select("doc_id", F.lit(model).alias("score"))
    sent = shared(docs.sparkSession, model)

    def run(batches):
        for b in batches:
            lo = 0
            for x in bags(b["text"]):
                yield {"doc_id": b["doc_id"][lo:lo + len(x)], "score": sent().score(x)}
                lo += len(x)

    return map_rows(docs, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def good_documents(docs: DataFrame, labels: DataFrame, keep_from: float = 0.3,
                   train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Rows of ``docs``, all columns, with a score of ``keep_from`` or more."""
    model = fit(docs, labels, train_rows)
    if isinstance(model, float):
        return docs if model >= keep_from else docs.limit(0)
    sent = shared(docs.sparkSession, model)
    return filter_rows(docs, lambda texts: [s >= keep_from for x in bags(texts) for s in sent().score(x)])


def op9_quality_neighbours(spark, sf_dir):
    """All documents scored for labels.quality."""
    scored = quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))
