"""Benchmark decontamination as a prefix-filtered set join.

Every benchmark item is cut into windows of ``window`` consecutive words (an
item of fewer words, but not none, is one window).  A document holds a window
exactly when it holds all of its shingles in place, so one shingle of the
window is a sufficient prefix for the join: the rarest, by how often each
occurs in all documents.  Windows whose rarest shingle never occurs cannot
match and leave the index.  A document position that holds a prefix shingle
gives the only place where the window can start; the place has to lie within
the document (positional and length bounds) before the words are compared one
by one.

The benchmark side goes to the tasks in blocks of at most ``BLOCK_CHARS``
characters (an item longer than that is a block of its own), counted before
anything is gathered; documents are never shuffled with their texts, so a
passage that a third of all documents hold costs no task more than another.

Defined results: null and empty texts have no words and no hits; a null
item_id takes no part, as it cannot be named; rows that repeat an item_id add
their windows to it; repeated documents give a row each; a null doc_id is
kept; empty tables give no rows or no hits; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import filter_rows, map_rows, table

WINDOW = 10
SHINGLE = 2
BLOCK_CHARS = 8_000_000
#: A-Z lower-cased; 0-9, a-z and all bytes of non-ASCII characters stay; the rest parts words.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_BYTES).split() if text else []


def windows_of(ws: list[bytes], window: int) -> list[tuple[bytes, ...]]:
    return [tuple(ws[i:i + window]) for i in range(max(1, len(ws) - window + 1))] if ws else []


def _shingles(win: tuple, n: int) -> list[tuple]:
    n = min(n, len(win))
    return [win[i:i + n] for i in range(len(win) - n + 1)]


def _runs(ws: list[bytes], n: int):
    return zip(*(ws[i:] for i in range(n)))


def _counts(docs: DataFrame, wanted: dict[int, frozenset]) -> dict[tuple, int]:
    """How often each wanted shingle occurs in all documents.  Every task sends
    one row per shingle it met; the result is bounded by the block."""
    def run(batches):
        found = Counter()
        for b in batches:
            for text in b["text"]:
                ws = words(text)
                for n, keep in wanted.items():
                    found.update(filter(keep.__contains__, _runs(ws, n)))
        if found:
            yield {"shingle": [b" ".join(k) for k in found], "n": list(found.values())}

    rows = map_rows(docs.select("text"), run, "shingle binary, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))
    return {tuple(bytes(r.shingle).split(b" ")): r.n for r in rows.collect()}


def prefix_index(items: list[tuple], counts: dict[tuple, int], window: int, shingle: int) -> dict:
    """{shingle length: {prefix shingle: [(offset, window, item ids)]}}."""
    owners: dict[tuple, set] = {}
    for item, text in items:
        for win in windows_of(words(text), window):
            owners.setdefault(win, set()).add(item)
    index: dict[int, dict] = {}
    for win, ids in owners.items():
        parts = _shingles(win, shingle)
        at = min(range(len(parts)), key=lambda i: (counts.get(parts[i], 0), i))
        if counts.get(parts[at], 0):
            index.setdefault(len(parts[at]), {}).setdefault(parts[at], []).append((at, win, sorted(ids)))
    return index


def find(ws: list[bytes], index: dict) -> tuple[list[tuple[int, int]], set]:
    """Spans (start, end) of all occurrences in ``ws``, merged; ids of their items."""
    spans, items = [], set()
    for n, prefixes in index.items():
        for p, key in enumerate(_runs(ws, n)):
            if key in prefixes:
                for offset, win, ids in prefixes[key]:
                    start, end = p - offset, p - offset + len(win)
                    if start >= 0 and end <= len(ws) and tuple(ws[start:end]) == win:
                        spans.append((start, end))
                        items.update(ids)
    return merged(spans), items


def merged(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _blocks(benchmark: DataFrame, block_chars: int) -> list[DataFrame]:
    size, longest = benchmark.agg(F.sum(F.length("text")), F.max(F.length("text"))).first()
    n = -(-2 * (size or 0) // block_chars) if (size or 0) > block_chars else 1
    return [benchmark.filter(F.pmod(F.xxhash64("item"), F.lit(n)) == i) for i in range(n)]


def _indexes(docs: DataFrame, benchmark: DataFrame, window: int, shingle: int, block_chars: int) -> list:
    """A broadcast prefix index for each block of the benchmark."""
    bench = (benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
             .filter("item is not null and text is not null"))
    out = []
    for block in _blocks(bench, block_chars):
        items = [tuple(r) for r in block.collect()]
        wanted: dict[int, set] = {}
        for _, text in items:
            for win in windows_of(words(text), window):
                for s in _shingles(win, shingle):
                    wanted.setdefault(len(s), set()).add(s)
        counts = _counts(docs, {n: frozenset(x) for n, x in wanted.items()}) if wanted else {}
        out.append(docs.sparkSession.sparkContext.broadcast(prefix_index(items, counts, window, shingle)))
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
                    block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Rows of ``docs``, all columns, that hold no window of the benchmark."""
    out = docs
    for shared in _indexes(docs, benchmark, window, shingle, block_chars):
        out = filter_rows(out, lambda texts, shared=shared: [not find(words(t), shared.value)[0] for t in texts])
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
                  block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document: doc_id, n_words, spans (merged hit word ranges,
    end excluded), n_hit (words inside them), items (ids as strings, sorted)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", "text")
    schema = f"doc_id {kind}, id bigint, n_words bigint, spans array<struct<start:bigint,end:bigint>>, items array<string>"
    parts = []
    indexes = _indexes(docs, benchmark, window, shingle, block_chars)
    # The hash of the text tells rows of one doc_id apart when blocks meet.
    of = F.xxhash64("text") if len(indexes) > 1 else F.lit(None).cast("bigint")
    for shared in indexes:

        def run(batches, shared=shared):
            index = shared.value
            for b in batches:
                out = {"doc_id": b["doc_id"], "id": b["id"], "n_words": [], "spans": [], "items": []}
                for text in b["text"]:
                    ws = words(text)
                    spans, ids = find(ws, index)
                    out["n_words"].append(len(ws))
                    out["spans"].append([{"start": s, "end": e} for s, e in spans])
                    out["items"].append(sorted(ids))
                yield out

        parts.append(map_rows(docs.select("doc_id", of.alias("id"), "text"), run, schema))
    if len(parts) == 1:
        found = parts[0]
    else:
        found = parts[0]
        for p in parts[1:]:
            found = found.unionByName(p)
        found = (found.groupBy("doc_id", "id", "n_words")
                 .agg(F.flatten(F.collect_list("spans")).alias("spans"),
                      F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
                      F.count("*").alias("n"))
                 .withColumn("copy", F.explode(F.sequence(F.lit(1), (F.col("n") / len(parts)).cast("int")))))

        def join_spans(batches):
            for b in batches:
                yield b | {"spans": [[{"start": s, "end": e} for s, e in merged((x["start"], x["end"]) for x in spans)]
                                     for spans in b["spans"]]}

        found = map_rows(found.select("doc_id", "id", "n_words", "spans", "items"), join_spans, schema)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", "spans", n_hit.alias("n_hit"), "items")


def op1_decontaminate(spark, sf_dir):
    """Every document against all benchmark items."""
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
b_at AS (SELECT item_id, ws, unnest(range(1, greatest(2, len(ws) - 8))) AS i FROM b WHERE len(ws) > 0),
win AS (SELECT DISTINCT item_id, ws[i] AS head, array_to_string(ws[i:i + 9], ' ') AS win, len(ws[i:i + 9]) AS n FROM b_at),
d_at AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM d),
cand AS (SELECT doc_id, ws, p, item_id, n, win FROM d_at JOIN win ON head = ws[p]),
occ AS (SELECT doc_id, p, item_id, n FROM cand WHERE array_to_string(ws[p:p + n - 1], ' ') = win),
hit AS (SELECT doc_id, count(DISTINCT w) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS w FROM occ) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""
