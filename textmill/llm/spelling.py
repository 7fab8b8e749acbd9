"""Spelling variants of frequent words, by asymmetric q-chunks.

A word of length L takes two roles.  As the shorter (or equally long, smaller)
word of a pair it gives two disjoint chunks of ``L // 2`` letters, its beginning
and its end.  As the other word it gives all its positional grams of the two
chunk lengths that a partner can have.  One inserted, deleted or replaced letter
changes one chunk at most, so the other one stands in the partner as a gram,
moved by one place at most.  Equal gram, partner length and place are one join
key; every candidate is verified by its edit distance.

A key whose chunks and grams would make more than ``KEY_PAIRS`` candidates is
not joined as it is.  A single edit always leaves the beginning in place or the
end in place, counted from the end; of the rest of the word, cut in two again,
one part stays as well.  The rows of such a key are dealt by that part too, so
nothing is lost and its groups share three quarters of their letters.

Words are counted inside the tasks first, and only words with their counts
are shuffled.

Defined results: null and empty texts have no words; a null doc_id counts as the
empty string where runs are damaged; repeated rows count each; of near words
with equal counts the smallest in code-point order is the form; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import map_rows, table
from textmill.session import written

LETTERS = "a-zÀ-ÿ"
LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
KEY_PAIRS = 1_000_000
#: Different words that a task holds before it hands their counts on.
HELD = 200_000
DAMAGE_EVERY = 199
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_KEY = ["gram", "target", "place"]


def lowered(text: str | None) -> str:
    """``text`` with A-Z, and nothing else, in lower case."""
    return (text or "").encode("utf-8", "replace").translate(_LOWER).decode()


def damaged(doc_id, run: str, every: int, start: int | None = None) -> str:
    """``run`` without one letter where ``every`` divides the checksum of
    ``<doc_id>:<run>``; ``start`` is the checksum of ``<doc_id>:`` if known."""
    if start is None:
        start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    h = zlib.crc32(run.encode(), start)
    if h % every:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def word_counts(docs: DataFrame, damage_every: int | None = None, held: int = HELD) -> DataFrame:
    """(word, n): the letter runs of whole texts, A-Z in lower case.  With
    ``damage_every`` some lose a letter first (see ``damaged``)."""
    def run(batches):
        runs = re.compile(f"[{LETTERS}]+").findall
        counts: Counter = Counter()
        for b in batches:
            for doc_id, text in zip(b["doc_id"], b["text"]):
                found = runs(lowered(text))
                if damage_every is None:
                    counts.update(found)
                else:
                    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                    for word, n in Counter(found).items():
                        counts[damaged(doc_id, word, damage_every, start)] += n
                if len(counts) > held:
                    yield {"word": list(counts), "n": list(counts.values())}
                    counts.clear()
        if counts:
            yield {"word": list(counts), "n": list(counts.values())}

    return map_rows(docs.select("doc_id", "text"), run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _chunks(words: DataFrame) -> DataFrame:
    """A row per chunk, partner length and place of it there."""
    size, q = F.length("word"), F.floor(F.length("word") / 2).cast("int")
    first, last = F.substring(F.col("word"), F.lit(1), q), F.substring(F.col("word"), size - q + 1, q)

    def at(gram, longer: int, place):
        return F.struct(gram.alias("gram"), (size + longer).alias("target"), place.cast("int").alias("place"))

    rows = F.array(*[at(gram, longer, place + shift) for gram, place in ((first, F.lit(0)), (last, size - q))
                     for longer in (0, 1) for shift in range(longer + 1)])
    return words.select("word", "n", F.explode(rows).alias("c")).select("c.*", "word", "n")


def _grams(words: DataFrame) -> DataFrame:
    """A row per positional gram of the lengths that a partner's chunks have."""
    size = F.length("word")
    halves = F.array_distinct(F.array(F.floor(size / 2).cast("int"), F.floor((size - 1) / 2).cast("int")))
    rows = F.flatten(F.transform(halves, lambda q: F.transform(
        F.sequence(F.lit(0), size - q),
        lambda p: F.struct(F.substring(F.col("word"), p + 1, q).alias("gram"), size.alias("target"), p.alias("place")))))
    return words.select("word", "n", F.explode(rows).alias("g")).select("g.*", "word", "n")


def _dealt_again(rows: DataFrame, partner: bool) -> DataFrame:
    """Rows of crowded keys, for places counted from the beginning or the end
    that do not move, with a part of the rest of the word that stays too."""
    size, q = F.length("word"), F.length("gram")
    begins, ends = F.col("place") == 0, F.col("place") + q == F.col("target")
    rest = F.when(begins, F.substring(F.col("word"), q + 1, size)).otherwise(F.substring(F.col("word"), F.lit(1), size - q))
    # Length of the chunk's word: its own, or a partner's of equal or one less.
    short = F.array(size) if not partner else F.filter(F.array(size, size - 1), lambda x: F.floor(x / 2) == q)

    def parts(x):
        half = F.floor((x - q) / 2).cast("int")
        return F.array(
            F.struct(x.alias("short"), F.lit(0).alias("part"), F.substring(F.col("rest"), F.lit(1), half).alias("kept")),
            F.struct(x.alias("short"), F.lit(1).alias("part"),
                     F.substring(F.col("rest"), F.length("rest") - (x - q - half) + 1, x - q - half).alias("kept")))

    return (rows.filter(begins | ends).withColumn("rest", rest)
            .select(*_KEY, "word", "n", F.explode(F.flatten(F.transform(short, parts))).alias("p"))
            .select(*_KEY, "p.*", "word", "n"))


def near_words(words: DataFrame, key_pairs: int = KEY_PAIRS) -> DataFrame:
    """(a, a_n, b, b_n): every pair of ``words`` (word, n; different words of two
    letters or more) that one edit parts, once, the shorter or smaller as a."""
    chunks, grams = _chunks(words), _grams(words)
    sizes = (chunks.groupBy(*_KEY).agg(F.count("*").alias("c"))
             .join(grams.groupBy(*_KEY).agg(F.count("*").alias("g")), _KEY))
    crowded = written(sizes.filter(F.col("c") * F.col("g") > key_pairs).select(*_KEY), "crowded-keys")

    def pairs(left, right, key):
        a, b = left.withColumnsRenamed({"word": "a", "n": "a_n"}), right.withColumnsRenamed({"word": "b", "n": "b_n"})
        later = (F.length("a") < F.length("b")) | (F.col("a") < F.col("b"))
        return (a.join(b, key).filter(later & (F.levenshtein("a", "b", 1) == 1))
                .select("a", "a_n", "b", "b_n"))

    if crowded.limit(1).count():
        found = pairs(chunks.join(crowded, _KEY, "left_anti"), grams, _KEY).unionByName(pairs(
            _dealt_again(chunks.join(crowded, _KEY, "left_semi"), False),
            _dealt_again(grams.join(crowded, _KEY, "left_semi"), True), [*_KEY, "short", "part", "kept"]))
    else:
        found = pairs(chunks, grams, _KEY)
    return found.dropDuplicates(["a", "b"])


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of ``forms`` (word, form) that starts
    at each word.  Each round doubles the steps; a form's count is a multiple of
    its word's, so chains end and the rounds are the logarithm of a logarithm."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        again = written(now.join(on, "root", "left")
                        .select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        now = again.select("word", "root")
        if not again.filter("moved").limit(1).count():
            return now


def spelling_variants(counts: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
                      ratio: int = RATIO, key_pairs: int = KEY_PAIRS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of ``counts`` (word, n)
    that are long and frequent enough.  ``form`` is the most frequent near word
    if it has ``ratio`` times the word's count or more."""
    if least_length < 2 or ratio < 2:
        raise ValueError("words need two letters, forms a count of twice the word's")
    words = written(counts.filter((F.length("word") >= least_length) & (F.col("n") >= least_count)), "words")
    pairs = written(near_words(words, key_pairs), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    form_n = -F.col("best.m")
    strong = form_n >= ratio * F.col("n")
    known = written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(strong, F.col("best.near")).alias("form"),
        F.when(strong, form_n).alias("form_n")), "forms")
    ends = roots(known.filter("form is not null"))
    return (known.join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def op11_spelling_variants(spark, sf_dir):
    """All frequent words of the documents, some of whose runs lose a letter."""
    return spelling_variants(word_counts(table(spark, sf_dir, "documents"), DAMAGE_EVERY))


# The checksum runs over UTF-8 bytes with a table built by rule; near words are
# equal with one place blanked, or one is the other without one letter.
OP11_SQL = """
WITH t AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
r AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[a-zÀ-ÿ]+')) AS run FROM documents),
g AS (SELECT doc_id, run, count(*) AS n FROM r GROUP BY doc_id, run),
c AS (
  SELECT run, n, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
         lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT]
                   ELSE [(192 + (unicode(x) >> 6))::BIGINT, (128 + (unicode(x) & 63))::BIGINT] END)) AS bytes FROM g),
h AS (
  SELECT run, n, xor(list_reduce(bytes, lambda a, b: xor(tab[CAST(xor(a, b) & 255 AS INTEGER) + 1], a >> 8), 4294967295::BIGINT),
         4294967295::BIGINT) AS h FROM c, t),
d AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2)
         ELSE run END AS word, n FROM h),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM d GROUP BY word HAVING length(word) >= 6 AND sum(n) >= 5),
s AS (
  SELECT word, n, i, left(word, i - 1) || '*' || substr(word, i + 1) AS hole, left(word, i - 1) || substr(word, i + 1) AS less
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
p AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM s a JOIN s b ON a.hole = b.hole AND a.word <> b.word
  UNION SELECT a.word, w.word, w.n FROM s a JOIN w ON a.less = w.word
  UNION SELECT w.word, a.word, a.n FROM s a JOIN w ON a.less = w.word),
k AS (SELECT word, count(*) AS n_near, max(near_n) AS most FROM p GROUP BY word),
f AS (
  SELECT p.word, min(p.near) AS form, max(p.near_n) AS form_n FROM p JOIN k ON p.word = k.word AND p.near_n = k.most
  JOIN w ON w.word = p.word WHERE p.near_n >= 5 * w.n GROUP BY p.word),
x(word, root, steps) AS (
  SELECT word, word, 0 FROM w UNION ALL SELECT x.word, f.form, x.steps + 1 FROM x JOIN f ON f.word = x.root),
e AS (SELECT word, arg_max(root, steps) AS root FROM x GROUP BY word)
SELECT w.word, f.form, e.root, w.n, coalesce(k.n_near, 0) AS n_near, f.form_n
FROM w JOIN e ON e.word = w.word LEFT JOIN k ON k.word = w.word LEFT JOIN f ON f.word = w.word
""".replace("WITH t AS", "WITH RECURSIVE t AS", 1)
