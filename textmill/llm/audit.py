"""How document filters interact: what each removes, alone and after others.

Conditions on a text alone are bits of one scan.  The duplicate filter is an
existential self-join: a left-semi join on hash, exact text and smaller doc_id
marks the rows that have an earlier copy.  Their keys are united with those of
all rows, the bits are combined per row, and only the counts of bit combinations
are left: a few dozen rows per part, from which every order of the filters
follows without another look at the documents.

The joined side holds each repeated text once, with its smallest id, combined
before the shuffle and written; a text that a third of all rows share is then
split at run time, since both inputs of the join are plain tables.

Defined results: a null text is the empty text; a null language is the part
``''``; a null doc_id is neither smaller than another nor has a smaller one, and
has no labels; repeated rows count each and are no copies of each other by an
equal id; several labels of one id count as 1 if any is 1; an empty table gives
no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import table
from textmill.session import written

_SPACE = r"\x20\x09-\x0D"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"[^{_SPACE}]+"), F.lit(0))


#: Failure conditions on a text and its words, by letter (fixed values of the contract).
CONDITIONS: dict[str, Callable[[Column, Column], Column]] = {
    "A": lambda text, words: F.size(words) < 200,
    "B": lambda text, words: 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
    "C": lambda text, words: 100 * F.regexp_count(text, F.lit("[A-Z]")) > 3 * F.length(text),
    "D": lambda text, words: text.rlike(r"[#$%&*|]"),
}
DUPLICATE = "E"


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"), F.xxhash64(text).alias("hash"))


def earlier_copies(rows: DataFrame) -> DataFrame:
    """The rows of ``rows`` (doc_id, text, hash, ...) whose text stands at a
    smaller doc_id as well, without the text."""
    repeated = (rows.groupBy("hash", "text").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
                .filter((F.col("copies") > 1) & F.col("least").isNotNull()).drop("copies"))
    first = written(repeated, "repeated-texts").alias("first")
    row = rows.alias("row")
    same = (F.col("row.hash") == F.col("first.hash")) & (F.col("row.text") == F.col("first.text"))
    return row.join(first, same & (F.col("first.least") < F.col("row.doc_id")), "left_semi").drop("text")


def failed_filters(docs: DataFrame, conditions=None, duplicate: str = DUPLICATE) -> tuple[DataFrame, str]:
    """(doc_id, part, failed, n) with the bits of the filters that a row fails,
    in the order of the returned letters; n rows are alike in all of it."""
    conditions = CONDITIONS if conditions is None else conditions
    letters = "".join(conditions) + duplicate
    rows = _rows(docs)
    with_words = rows.withColumn("words", _words(F.col("text")))
    own = sum((F.when(c(F.col("text"), F.col("words")), 1 << i).otherwise(0) for i, c in enumerate(conditions.values())), F.lit(0))
    key = ["doc_id", "part", "hash"]
    every = with_words.select(*key, own.alias("failed"), F.lit(1).alias("n"))
    copies = earlier_copies(rows).select(*key, F.lit(1 << len(conditions)).alias("failed"), F.lit(0).alias("n"))
    united = every.unionByName(copies).groupBy(*key).agg(F.bit_or("failed").alias("failed"), F.sum("n").alias("n"))
    return united.groupBy("doc_id", "part", "failed").agg(F.sum("n").alias("n")), letters


def combinations(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, n, good, toxic): rows per bit combination, and how many
    of them are labelled good in quality and toxic."""
    marks = (labels.filter("doc_id is not null").groupBy("doc_id")
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    n = F.col("n")
    return (failed.join(marks, "doc_id", "left").groupBy("part", "failed")
            .agg(F.sum(n).alias("n"), F.sum(F.when(F.col("good") == 1, n).otherwise(0)).alias("good"),
                 F.sum(F.when(F.col("toxic") == 1, n).otherwise(0)).alias("toxic")))


def effects(combined: DataFrame, letters: str) -> DataFrame:
    """Every order of the filters ``letters``, step by step, per part."""
    orders = F.array(*[F.lit("".join(o)) for o in permutations(letters)])
    steps = combined.select("*", F.explode(orders).alias("filter_order")) \
        .select("*", F.posexplode(F.split("filter_order", "")).alias("at", "filter"))
    order, step = F.col("filter_order"), F.col("at") + 1
    bit = sum((F.when(F.col("filter") == c, 1 << i).otherwise(0) for i, c in enumerate(letters)), F.lit(0))
    before = sum((F.when(F.instr(order, c) < step, 1 << i).otherwise(0) for i, c in enumerate(letters)), F.lit(0))
    steps = steps.select("*", step.cast("int").alias("step"), bit.alias("bit"), before.alias("before"))
    fails = F.col("failed").bitwiseAND(F.col("bit")) != 0
    gone = F.col("failed").bitwiseAND(F.col("before")) != 0

    def total(what: str, when: Column) -> Column:
        return F.sum(F.when(when, F.col(what)).otherwise(0))

    here = (steps.groupBy("part", "filter_order", "step", "filter").agg(
        total("n", ~fails & ~gone).alias("kept"), total("n", fails & ~gone).alias("removed"),
        total("n", fails & gone).alias("redundant"), total("n", F.col("failed") == F.col("bit")).alias("unique_fails"),
        total("good", fails & ~gone).alias("good_lost"), total("toxic", fails & ~gone).alias("toxic_lost")))
    here = written(here, "filter-steps")  # orders x filters rows per part
    shares = here.groupBy("part", "filter").agg(F.sum("removed").alias("shapley"))
    return here.join(shares, ["part", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(docs: DataFrame, labels: DataFrame, conditions=None, duplicate: str = DUPLICATE) -> DataFrame:
    """The effects of all orders of the filters on ``docs`` (doc_id, text, lang)."""
    failed, letters = failed_filters(docs, conditions, duplicate)
    return effects(written(combinations(failed, labels), "filter-combinations"), letters)


def op12_filter_audit(spark, sf_dir):
    """All orders of the five filters over all documents."""
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
l AS (SELECT t, min(doc_id) AS least FROM t GROUP BY t),
m AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
w AS (SELECT t.*, regexp_extract_all(t.t, '[^\x20\x09-\x0D]+') AS words, coalesce(l.least < t.doc_id, false) AS copy
      FROM t JOIN l ON t.t = l.t),
f AS (
  SELECT part, coalesce(m.good, false) AS good, coalesce(m.toxic, false) AS toxic,
         (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
         + 4 * (100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t))::INT
         + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * copy::INT AS failed
  FROM w LEFT JOIN m ON w.doc_id = m.doc_id),
c AS (SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY ALL),
x AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) x(c, bit)),
o AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
      FROM x a, x b, x c, x d, x e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
      AND len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
s AS (SELECT filter_order, unnest(range(1, 6)) AS step, bits FROM o),
b AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before FROM s),
g AS (
  SELECT part, filter_order, step, bit,
         sum(n) FILTER (failed & bit = 0 AND failed & before = 0) AS kept, sum(n) FILTER (failed & bit > 0 AND failed & before = 0) AS removed,
         sum(n) FILTER (failed & bit > 0 AND failed & before > 0) AS redundant, sum(n) FILTER (failed = bit) AS unique_fails,
         sum(good) FILTER (failed & bit > 0 AND failed & before = 0) AS good_lost,
         sum(toxic) FILTER (failed & bit > 0 AND failed & before = 0) AS toxic_lost
  FROM c, b GROUP BY ALL),
z AS (SELECT part, filter_order, step::INTEGER AS step, bit, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
         coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
         coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost FROM g)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM z
"""
