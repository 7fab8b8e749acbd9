"""Spelling variants, the filter audit and token files against brute force on
small tables, with nulls, empty and long texts, ties, repeated rows, empty tables
and clashing columns."""

import random
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmill.llm import audit as A
from textmill.llm import spelling as V
from textmill.llm import token_files as B
from textmill.llm.packing import tokenizer_path
from textmill.session import scratch_path

DOCS = "doc_id long, text string, lang string, word string, n int, hash long, file string, start int"


def docs_of(spark, rows):
    """Documents (id, text[, lang]) with further columns whose names clash with results."""
    return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "en", "w", 7, 7, "f", 7) for r in rows], DOCS)


ODD = [(900, None), (901, ""), (902, " \t\n"), (None, "no id here"), (903, "ÀÉ ß 中文 \x00 end"), (903, "ÀÉ ß 中文 \x00 end")]


# -- 11 ---------------------------------------------------------------------

def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def brute_counts(rows, every):
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            out[run] += 1
    return out


def brute_variants(counts, least_length=6, least_count=5, ratio=5):
    words = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        if vs:
            v = min(vs, key=lambda v: (-words[v], v))
            if words[v] >= ratio * words[w]:
                form[w] = v
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        out.add((w, f, root, n, len(near[w]), words[f] if f else None))
    return out


def edited(rng, w, letters):
    k = rng.randrange(len(w) + 1)
    how = rng.choice("idr")
    if how == "i":
        return w[:k] + rng.choice(letters) + w[k:]
    k = min(k, len(w) - 1)
    return w[:k] + ("" if how == "d" else rng.choice(letters)) + w[k + 1:]


@pytest.mark.parametrize("key_pairs", [V.KEY_PAIRS, 3, 0])
def test_spelling_variants_are_exact(spark, key_pairs):
    rng = random.Random(5)
    for letters in ("ab", "abcdeéÿ"):
        words = {"".join(rng.choice(letters) for _ in range(rng.randint(5, 13))) for _ in range(60)}
        words |= {"prefix" + "".join(rng.choice(letters) for _ in range(5)) for _ in range(40)}  # one crowded beginning
        words |= {edited(rng, w, letters) for w in sorted(words) for _ in range(4)}
        words |= {edited(rng, w, letters) for w in sorted(words)[:80]}
        counts = {w: rng.choice([4, 5, 6, 25, 30, 125, 700, 4000]) for w in sorted(words)}
        got = V.spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n long"), key_pairs=key_pairs)
        rows = [tuple(r) for r in got.select("word", "form", "root", "n", "n_near", "form_n").collect()]
        assert len(rows) == len(set(rows)) and set(rows) == brute_variants(counts)


def test_word_counts_with_and_without_damage(spark):
    rng = random.Random(6)
    rows = ODD + [(i, " ".join("".join(rng.choice("ABcdéÉ×-") for _ in range(rng.randint(1, 8))) for _ in range(30))) for i in range(200)]
    rows += [(7, "repeated Row")] * 5 + [(8, "long " * 200_000)]
    for every in (None, 199, 3):
        got = V.word_counts(docs_of(spark, rows), every, held=50)
        assert {r.word: r.n for r in got.collect()} == dict(brute_counts(rows, every))


def test_spelling_chain_of_forms_and_empty(spark):
    chain = {"aaaaaa": 5, "aaaaaab": 25, "aaaaaabb": 125, "aaaaaabbb": 625, "aaaaaabbbb": 3125, "zzzzzz": 9}
    got = {r.word: r.root for r in V.spelling_variants(spark.createDataFrame(list(chain.items()), "word string, n long")).collect()}
    assert got == {w: "aaaaaabbbb" if w != "zzzzzz" else w for w in chain}
    empty = V.spelling_variants(V.word_counts(docs_of(spark, ODD[:2])))
    assert empty.columns == ["word", "form", "root", "n", "n_near", "form_n"] and empty.count() == 0


# -- 12 ---------------------------------------------------------------------

def brute_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    fails = []
    for i, text, lang in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        own = {f for f, bad in (("A", len(words) < 200), ("B", 100 * len(set(words)) < 50 * len(words)),
                                ("C", 100 * len(re.findall("[A-Z]", text)) > 3 * len(text)), ("D", re.search(r"[#$%&*|]", text)),
                                ("E", any((t or "") == text and j is not None and i is not None and j < i for j, t, _ in rows))) if bad}
        fails.append((lang or "", own, i))
    out, share = [], Counter()
    for part in {p for p, _, _ in fails}:
        mine = [(own, i) for p, own, i in fails if p == part]
        for order in map("".join, permutations("ABCDE")):
            for s, f in enumerate(order):
                here = [(own, i) for own, i in mine if not own & set(order[:s])]
                removed = [i for own, i in here if f in own]
                share[part, f] += len(removed)
                out.append((part, order, s + 1, len(here) - len(removed), len(removed),
                            sum(f in own for own, _ in mine) - len(removed), sum(own == {f} for own, _ in mine),
                            sum(i in good for i in removed), sum(i in toxic for i in removed), f))
    return {r[:-1] + (share[r[0], r[-1]],) for r in out}


def test_filter_audit_is_exact(spark):
    rng = random.Random(7)
    texts = ["", "A B#", "word " * 210, " ".join(f"w{i}" for i in range(230)), " ".join(f"W{i}" for i in range(230)),
             " ".join(f"x{i}|" for i in range(150)), "short\ttext", None, " ".join(f"v{i}" for i in range(30_000))]
    rows = [(rng.randrange(60), rng.choice(texts), rng.choice(["en", "de", None, ""])) for _ in range(120)]
    rows += [(None, "short\ttext", "en"), (None, "short\ttext", "en"), (5, "short\ttext", "en"), (5, "short\ttext", "en")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 80, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit("x")).withColumn("n", F.lit(3))
    got = A.audit(docs_of(spark, rows), frame)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) == 3 * 120 * 5 and set(found) == brute_audit(rows, labels)


def test_filter_audit_of_nothing(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert A.audit(docs_of(spark, []), labels).count() == 0


# -- 13 ---------------------------------------------------------------------

def test_simple8b_round_trip_with_escapes():
    rng = np.random.default_rng(8)
    for _ in range(150):
        lists = []
        for _ in range(rng.integers(1, 6)):
            n = int(rng.integers(0, 500))
            shift = rng.integers(0, 64, n) if rng.random() < 0.5 else np.full(n, rng.integers(0, 64))
            lists.append((rng.integers(0, 2 ** 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)) >> shift.astype(np.uint64))
        lists.append(np.zeros(rng.integers(0, 400), np.uint64))
        coded = B.encode(lists)
        file = B.FileBytes(block_words=int(rng.integers(1, 20)))
        for i, (ids, (words, escapes)) in enumerate(zip(lists, coded)):
            assert np.array_equal(B.decode(np.frombuffer(words, "<u8"), np.frombuffer(escapes, "<u8")), ids)
            file.add(None if i % 3 == 2 else i - 1, len(ids), words, escapes)
        data = file.finish()
        opened = B.TokenFile(data)
        assert opened.doc_ids == [None if i % 3 == 2 else i - 1 for i in range(len(lists))]
        parts, ended = [[] for _ in lists], []
        for doc, part in opened.documents():
            ended.append(doc) if part is None else parts[doc].append(part)
        assert ended == list(range(len(lists)))
        for i, ids in enumerate(lists):
            assert np.array_equal(opened.document(i), ids)
            assert np.array_equal(np.concatenate([*parts[i], np.empty(0, np.uint64)]), ids)


def test_simple8b_takes_the_widest_fit():
    ids = np.array([1] * 60 + [3] * 30 + [2 ** 20 - 1] * 3 + [2 ** 60], np.uint64)
    (words, escapes), = B.encode([ids])
    assert [w >> 60 for w in np.frombuffer(words, "<u8").tolist()] == [2, 3, 13, 0]
    assert np.frombuffer(escapes, "<u8").tolist() == [2 ** 60]


def test_damaged_token_files_fail():
    file = B.FileBytes()
    file.add(1, 3, *B.encode([np.arange(3, dtype=np.uint64)])[0])
    data = file.finish()
    for broken in (data[:-1], data[1:], b"", data[:9] + b"\x07" + data[10:]):
        with pytest.raises(B.TokenFileError):
            list(B.TokenFile(broken).documents())


def brute_files(rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path(B.TOKENIZER))
    out, start = [], 0
    for doc_id, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("sizes", [{}, {"file_bytes": 2000, "part_bytes": 5000, "block_words": 16}])
def test_token_files_round_trip(spark, sizes):
    rng = random.Random(9)
    alphabet = "aé中\U0001F600 .,'\n\t \x1c0٣𝟙#A"
    rows = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) + "Don't they've I'll 12's  x ") for i in range(150)]
    rows += [(-5, None), (150, ""), (151, "<|endoftext|> is special"), (152, "a very long text " * 20_000), (153, "a" * 5000)]
    rng.shuffle(rows)
    folder = scratch_path(spark, "token-test")
    files = B.write_token_files(docs_of(spark, rows).repartition(3), folder, tokenizer_path(B.TOKENIZER), **sizes)
    got = B.read_token_files(spark, folder, files)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(tuple(r) for r in got.collect()) == brute_files(sorted(rows))
    assert files.count() == 1 if not sizes else files.count() > 5


def test_token_files_with_repeated_and_null_ids(spark):
    rows = [(3, "x y"), (1, "b"), (3, "x y"), (None, "z"), (None, None), (1, "a longer one"), (None, "z")]
    folder = scratch_path(spark, "token-test")
    got = B.read_token_files(spark, folder, B.write_token_files(docs_of(spark, rows), folder, tokenizer_path(B.TOKENIZER)))
    got = sorted((tuple(r) for r in got.collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [1, 1, 3, 3, None, None, None]
    assert [r[1] for r in got] == np.cumsum([0] + [r[2] for r in got])[:-1].tolist()
    assert sorted((str(r[0]), *r[2:]) for r in got) == sorted((str(r[0]), *r[2:]) for r in brute_files(rows))


def test_token_files_of_nothing_and_unnamed_files(spark):
    folder = scratch_path(spark, "token-test")
    files = B.write_token_files(docs_of(spark, []), folder, tokenizer_path(B.TOKENIZER))
    assert files.count() == 0 and B.read_token_files(spark, folder, files).count() == 0
    B.write_token_files(docs_of(spark, [(1, "left by a lost task")]), folder, tokenizer_path(B.TOKENIZER))
    assert B.read_token_files(spark, folder, files).count() == 0
