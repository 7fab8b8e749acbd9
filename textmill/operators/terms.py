"""Token and term statistics.

Tokens live as an ``array<string>`` per document until a statistic needs
them one per row; the explode is always followed directly by an aggregate
(which combines map-side) so the fan-out never crosses a shuffle unreduced.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.operators.indexing import dense_index
from textmill.session import materialize, release, written
from textmill.sources.stopwords import stop_words as own_stop_words

# Defaults of the topic job's vectorizer.
MIN_DF = 5
TOP_KEYWORDS = 8


def explode_values(df: DataFrame, array_col: str, out_col: str, *keep: str) -> DataFrame:
    """One row per array element, with ``keep`` columns carried along.

    ``explode_outer`` plus a null filter instead of ``explode``: for a plain
    explode Catalyst infers ``size(array) > 0`` and pushes that predicate
    down through aggregates to the scan, where it would evaluate the whole
    tokenizer a second time.
    """
    return (df.select(*keep, F.explode_outer(array_col).alias(out_col))
            .filter(F.col(out_col).isNotNull()))


def top_n_per_group(counts: DataFrame, group_cols: Sequence[str], n: int,
                    order: Sequence[Column], rank_col: str = "rank") -> DataFrame:
    """Keep the first ``n`` rows of each group by ``order``; ``rank`` is 0-based.

    ``row_number() <= n`` lets Spark insert a ``WindowGroupLimit`` before the
    shuffle, so each map task forwards at most ``n`` rows per group and a hot
    group cannot overload the window task.
    """
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return (counts.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") <= n)
            .withColumn(rank_col, (F.col("_rn") - 1).cast("long"))
            .drop("_rn"))


def keywords_by_group(df: DataFrame, group_col: str, n: int = TOP_KEYWORDS,
                      tokens_col: str = "tokens") -> DataFrame:
    """A1: the ``n`` most frequent tokens of each group.

    Output ``group_col, rank, token, n``; ties broken by token.
    """
    counts = (explode_values(df, tokens_col, "token", group_col)
              .groupBy(group_col, "token")
              .agg(F.count(F.lit(1)).alias("n")))
    ranked = top_n_per_group(counts, [group_col], n, [F.desc("n"), F.asc("token")])
    return ranked.select(group_col, "rank", "token", "n")


def with_vectorizer_terms(df: DataFrame, tokens_col: str = "tokens", out_col: str = "terms",
                          stop_words: Sequence[str] | None = None) -> DataFrame:
    """add the vectorizer's terms of each document, in order.

    Tokens shorter than two characters and the vectorizer's own English stop
    words go first; then every token and every pair of neighbours joined by a
    space.  The English list defaults to Spark's (see README).  The kept
    tokens are their own projection so the pair step reads them, not four
    copies of the filter.
    """
    df = with_kept_tokens(df, tokens_col, "_kept", stop_words)
    k = F.col("_kept")
    m = F.greatest(F.size(k) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(k, 1, m), F.slice(k, 2, m), lambda a, b: F.concat_ws(" ", a, b))
    return df.withColumn(out_col, F.concat(k, pairs)).drop("_kept")


def with_kept_tokens(df: DataFrame, tokens_col: str = "tokens", out_col: str = "kept",
                     stop_words: Sequence[str] | None = None) -> DataFrame:
    """The tokens the vectorizer's terms are made of: a quarter of the terms' bytes
    (``tfidf`` with ``pairs`` forms the pairs inside its tasks)."""
    stop = sorted(set(stop_words if stop_words is not None else own_stop_words("en")))
    return df.withColumn(out_col, F.filter(F.col(tokens_col), lambda x: (F.length(x) >= 2) & ~x.isin(stop)))


#: Documents of a part: what the weights of a part's own terms are held for.
PART_ROWS = 10_000
#: Fewer documents than this are not worth a part of their own.
LEAST_ROWS = 500
# Rows a task returns at once.
_OUT_ROWS = 50_000


def _with_pairs(names: pa.Array, code: np.ndarray, row: np.ndarray):
    """Words by their places, and the pairs of neighbours in a row: all names,
    each once, and place and row of every word and pair."""
    row, code = row[code >= 0], code[code >= 0]
    next_to = np.flatnonzero(row[1:] == row[:-1])
    found, pair = np.unique(code[next_to] * max(1, len(names)) + code[next_to + 1], return_inverse=True)
    left, right = (names.take(pa.array(x)) for x in (found // max(1, len(names)), found % max(1, len(names))))
    every = pa.concat_arrays([names, pc.binary_join_element_wise(left, right, pa.scalar(" ", names.type))]).dictionary_encode()
    place = every.indices.to_numpy().astype(np.int64)  # a word with a space may be a pair, too
    return every.dictionary, place[np.append(code, len(names) + pair)], np.append(row, row[next_to])


def _counted(ids: pa.Array, terms: pa.Array, pairs: bool = False):
    """The different terms (dictionary), and per document and term of rows in the
    order of ids: first row of the document, place of the term, occurrences."""
    codes = ids.dictionary_encode(null_encoding="encode").indices.to_numpy()
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    sizes = pc.fill_null(pc.list_value_length(terms), 0).to_numpy(zero_copy_only=False)
    found = pc.list_flatten(terms).dictionary_encode()
    code = pc.fill_null(found.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(ids)), sizes)
    names = found.dictionary
    if pairs:
        names, code, row = _with_pairs(names, code, row)
    doc = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(ids))))[row]
    cells, n = np.unique((doc * max(1, len(names)) + code)[code >= 0], return_counts=True)
    return names, first[cells // max(1, len(names))], cells % max(1, len(names)), n


def _documents(batches, rows):
    """``rows(batch)`` for record batches in the order of ``_doc``, cut so that no
    document is in two of them."""
    held = None
    for b in batches:
        if not b.num_rows:
            continue
        b = b if held is None else pa.concat_batches([held, b])
        codes = b.column("_doc").dictionary_encode(null_encoding="encode").indices.to_numpy()
        last = len(codes) - int(np.argmax(np.append(codes[::-1] != codes[-1], True)))
        held = b.slice(last)
        if last:
            yield from rows(b.slice(0, last))
    if held is not None:
        yield from rows(held)


def _sliced(batch):
    for lo in range(0, batch.num_rows, _OUT_ROWS):
        yield batch.slice(lo, _OUT_ROWS)


def by_part(batches):
    """(rows of kind 0, batches of kind 1) of each part, of record batches in the
    order of ``_part`` and ``_kind``; the latter as they come."""
    def runs():
        for b in batches:
            if b.num_rows:
                key = b.column("_part").to_numpy().astype(np.int64) * 2 + b.column("_kind").to_numpy()
                cut = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
                for lo, hi in zip(cut, cut[1:]):
                    yield int(key[lo]) >> 1, int(key[lo]) & 1, b.slice(lo, hi - lo)

    for _, of in groupby(runs(), key=lambda x: x[0]):
        side = []
        for _, is_docs, b in of:
            if is_docs:
                yield side, chain([b], (x for _, _, x in of))
                break
            side.append(b)


def term_frequencies(docs: DataFrame, doc_col: str = "doc_id", terms_col: str = "terms") -> DataFrame:
    """Raw term counts ``doc_col, term, tf``.

    The documents' arrays are dealt by id and counted inside the row, so that a
    task holds a batch of documents and never a table of its terms."""
    def rows(b):
        names, row, at, n = _counted(b.column("_doc"), b.column("_terms"))
        yield from _sliced(pa.RecordBatch.from_arrays(
            [b.column("_doc").take(pa.array(row)), names.take(pa.array(at)), pa.array(n, pa.int64())], [doc_col, "term", "tf"]))

    dealt = docs.select(F.col(doc_col).alias("_doc"), F.col(terms_col).alias("_terms")).repartition("_doc").sortWithinPartitions("_doc")
    kind = dealt.schema["_doc"].dataType.simpleString()
    return dealt.mapInArrow(lambda batches: _documents(batches, rows), f"`{doc_col}` {kind}, term string, tf bigint")


def tfidf(docs: DataFrame, doc_col: str = "doc_id", terms_col: str = "terms",
          min_df: int = MIN_DF, reuse_input: bool = True, pairs: bool = False,
          packed: bool = False, cluster_col: str | None = None, vocab_of=None) -> DataFrame:
    """A3: L2-normalised TF-IDF, smooth idf, long form ``doc_col, term, weight``.

    idf = ln((1 + n) / (1 + df)) + 1 with n the number of documents (also the
    ones without a term).

    The documents are dealt by id into parts of about ``PART_ROWS``.  Only a
    part's different terms are shuffled by term, to add up df, and only those in
    the vocabulary come back to the part, with their idf, where they meet the
    documents' arrays: counts, weights and norms are taken inside the row.  No
    (document, term) row is shuffled.  A task holds the weights of one part's
    terms and one batch of documents.

    With ``pairs`` the arrays hold tokens, and every pair of neighbours joined by a
    space is a term as well (``with_vectorizer_terms``): the pairs are formed in
    the tasks and not moved.  With ``packed`` the rows of a document come as one,
    ``doc_col, terms, weights`` (documents without a term have none), and with
    ``cluster_col`` also ``clusters``, the values of that column in all rows of the
    document, so that no join has to bring them.  ``vocab_of`` numbers the vocabulary
    (``numbered_tfidf``): ``terms`` are numbers then.

    ``docs`` are read three times; with ``reuse_input`` they are materialised once
    (``session.materialize``) instead of re-running the text pipeline.
    """
    if reuse_input:
        docs = materialize(docs.select(doc_col, terms_col))
    n_docs = docs.count()
    cores = docs.sparkSession.sparkContext.defaultParallelism
    parts = max(1, -(-n_docs // PART_ROWS), min(cores, n_docs // LEAST_ROWS))
    part = F.pmod(F.xxhash64(doc_col), F.lit(parts)).cast("int")
    rows = docs.select(part.alias("_part"), F.col(doc_col).alias("_doc"), F.col(terms_col).alias("_terms"),
                       *([F.col(cluster_col).alias("_cluster")] if cluster_col else []))
    kind = rows.schema["_doc"].dataType.simpleString()

    def own_terms(batches):
        for b in batches:
            if b.num_rows:
                where, every = b.column("_part").to_numpy(), pa.array(np.arange(b.num_rows))
                names, row, at, _ = _counted(every, b.column("_terms"), pairs)
                cells, n = np.unique(where[row].astype(np.int64) * max(1, len(names)) + at, return_counts=True)
                yield from _sliced(pa.RecordBatch.from_arrays(
                    [pa.array(cells // max(1, len(names)), pa.int32()), names.take(pa.array(cells % max(1, len(names)))),
                     pa.array(n, pa.int64())], ["_part", "term", "n"]))

    # A term has a row per batch of a part at most, so a window of it is small.
    own = rows.repartitionById(parts, "_part").select("_part", "_terms").mapInArrow(own_terms, "_part int, term string, n bigint")
    df = F.sum("n").over(Window.partitionBy("term"))
    idf = own.withColumn("df", df).filter(F.col("df") >= min_df).select(
        "_part", "term", (F.log((F.lit(float(n_docs)) + 1) / (F.col("df") + 1)) + 1).alias("idf"))
    numbered = vocab_of is not None
    if numbered:
        idf = written(idf, "idf")
        idf = idf.join(vocab_of(idf.select("term").distinct()), "term").select("_part", "term", "idf", F.col("idx").cast("int").alias("_idx"))
    # In each part the terms' weights come first, then the documents in order.
    both = rows.withColumn("_kind", F.lit(1)).unionByName(idf.withColumn("_kind", F.lit(0)), allowMissingColumns=True)

    def weigh(batches):
        def weighed(b):
            names, row, at, n = _counted(b.column("_doc"), b.column("_terms"), pairs)
            place = pc.fill_null(pc.index_in(names, value_set=known), -1).to_numpy(zero_copy_only=False)[at]
            kept = place >= 0
            row, at, w = row[kept], at[kept], n[kept] * weights[place[kept]]
            norm = np.sqrt(np.bincount(row, w * w, b.num_rows))
            w = pa.array(w / norm[row])
            if packed:
                first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))[:len(row)])
                cut = pa.array(np.append(first, len(row)), pa.int32())
                found = names.take(pa.array(at)) if numbers is None else pa.array(numbers[place[kept]], pa.int32())
                out = [b.column("_doc").take(pa.array(row[first])), pa.ListArray.from_arrays(cut, found),
                       pa.ListArray.from_arrays(cut, w)]
                if cluster_col:
                    codes = b.column("_doc").dictionary_encode(null_encoding="encode").indices.to_numpy()
                    begin = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
                    all_of = pa.ListArray.from_arrays(pa.array(np.append(begin, b.num_rows), pa.int32()), b.column("_cluster"))
                    out.append(all_of.take(pa.array(np.searchsorted(begin, row[first]))))
                yield pa.RecordBatch.from_arrays(out, [doc_col, "terms", "weights", "clusters"][:len(out)])
            else:
                yield from _sliced(pa.RecordBatch.from_arrays(
                    [b.column("_doc").take(pa.array(row)), names.take(pa.array(at)), w], [doc_col, "term", "weight"]))

        for side, docs_of in by_part(batches):
            known = pa.concat_arrays([pa.array([], pa.string()), *[b.column("term").cast(pa.string()) for b in side]])
            weights = np.concatenate([np.empty(0), *[b.column("idf").to_numpy(zero_copy_only=False) for b in side]])
            numbers = None if not numbered else np.concatenate([np.empty(0, np.int32), *[b.column("_idx").to_numpy(zero_copy_only=False) for b in side]]).astype(np.int32)
            side.clear()
            yield from _documents((b.select(["_doc", "_terms", *(["_cluster"] if cluster_col else [])]) for b in docs_of), weighed)

    schema = f"terms array<{'int' if numbered else 'string'}>, weights array<double>" if packed else "term string, weight double"
    if packed and cluster_col:
        schema += f", clusters array<{rows.schema['_cluster'].dataType.simpleString()}>"
    return (both.repartitionById(parts, "_part").sortWithinPartitions("_part", "_kind", "_doc")
            .mapInArrow(weigh, f"`{doc_col}` {kind}, {schema}"))


def numbered_tfidf(docs: DataFrame, doc_col: str = "doc_id", terms_col: str = "terms", min_df: int = MIN_DF,
                   pairs: bool = False, cluster_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``tfidf`` with ``packed`` rows, written, whose ``terms`` are the numbers of the
    vocabulary ``term, idx`` (in term order), also returned: the strings meet the
    tokens inside the tasks and are not moved.  ``docs`` are written already."""
    vocab = []

    def numbers(terms):
        vocab.append(written(dense_index(written(terms, "terms"), ["term"]), "vocabulary"))
        return vocab[0]

    vectors = tfidf(docs, doc_col, terms_col, min_df, reuse_input=False, pairs=pairs, packed=True, cluster_col=cluster_col, vocab_of=numbers)
    vectors = written(vectors, "vectors")
    release(docs.sparkSession)
    return vectors, vocab[0]


def vocabulary(docs: DataFrame, doc_col: str = "doc_id", terms_col: str = "terms",
               min_df: int = MIN_DF) -> DataFrame:
    """Terms kept by the vectorizer: ``term, df``.

    ``docs`` holds one row per document, so each document's distinct terms
    (``array_distinct``, in the row) counted per term is the document
    frequency: one shuffle by term, fed with at most one row per document
    and term and combined map-side, instead of a (document, term) count
    followed by a second aggregation.
    """
    return (explode_values(docs.select(terms_col), F.array_distinct(terms_col), "term")
            .groupBy("term").agg(F.count(F.lit(1)).alias("df"))
            .filter(F.col("df") >= min_df))


def bigram_words(vocab: DataFrame, term_col: str = "term") -> DataFrame:
    """A4: the words that occur inside a two-word vocabulary term."""
    return (vocab.filter(F.col(term_col).contains(" "))
            .select(F.explode_outer(F.split(term_col, " ")).alias("word"))
            .distinct())
