"""The training-data operators against brute force on small tables, with nulls,
empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from textmill.llm import decontaminate as D
from textmill.llm import licences as L
from textmill.llm import packing as P
from textmill.llm import quality as Q
from textmill.llm import simhash as S
from textmill.llm import topk as K
from textmill.llm import toxicity as T
from textmill.llm import urls as U
from textmill.llm import warc as W
from textmill.llm.counts import Rollup, changes
from textmill.llm.graph import components
from textmill.session import scratch_path

DOCS = "doc_id long, text string, label int, n_words int, score double, fp long, part int"


def docs_of(spark, rows):
    """Documents with further columns whose names clash with results."""
    return spark.createDataFrame([(i, t, 7, 7, 0.5, 7, 7) for i, t in rows], DOCS)


def rand_words(rng, n, letters="abcdefgh", least=2, most=6):
    return ["".join(rng.choice(letters) for _ in range(rng.randint(least, most))) for _ in range(n)]


ODD = [(900, None), (901, ""), (902, " \t\n"), (None, "no id here"), (903, "ÀÉ ß 中文 \x00 end"), (903, "ÀÉ ß 中文 \x00 end")]


# -- 1 ----------------------------------------------------------------------

def brute_hits(text, items):
    ws = D.words(text)
    hit, ids = set(), set()
    for item, t in items:
        for win in D.windows_of(D.words(t), 10):
            for p in range(len(ws) - len(win) + 1):
                if tuple(ws[p:p + len(win)]) == win:
                    hit.update(range(p, p + len(win)))
                    ids.add(str(item))
    return len(ws), len(hit), sorted(ids)


@pytest.mark.parametrize("block_chars", [D.BLOCK_CHARS, 200])
def test_decontaminate_is_exact(spark, block_chars):
    rng = random.Random(1)
    items = [(i, " ".join(rand_words(rng, rng.choice([1, 5, 10, 14, 30]), "ab", 1, 3))) for i in range(12)]
    items += [(3, "Repeated Item, words!"), (50, None), (51, ""), (52, items[0][1])]
    rows = ODD + [(i, " ".join(rand_words(rng, 60, "ab", 1, 3) + rng.choice(items[:12])[1].upper().split() + ["x"])) for i in range(40)]
    rows += [(7, rows[-1][1]), (7, rows[-1][1]), (800, "long " * 50_000)]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items] + [(None, "ab ab", 1)], "item_id long, text string, n_words int")
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, list(r["items"]))
                 for r in D.decontaminate(docs_of(spark, rows), bench, block_chars=block_chars).collect())
    assert got == sorted((str(i), *brute_hits(t, items)) for i, t in rows)
    kept = D.clean_documents(docs_of(spark, rows), bench, block_chars=block_chars)
    assert kept.columns == docs_of(spark, []).columns
    assert kept.count() == sum(g[2] == 0 for g in got)
    assert D.decontaminate(docs_of(spark, []), bench).count() == 0
    assert D.decontaminate(docs_of(spark, rows), bench.limit(0)).agg(F.sum("n_hit")).first()[0] == 0


# -- 2 ----------------------------------------------------------------------

def test_licences_are_inherited_from_the_nearest_ancestor(spark):
    mit, apache = L.TEMPLATES["MIT"], L.TEMPLATES["Apache-2.0"]
    rows = [(1, "a/x.py", f"# {mit}\ncode"), (2, "a/b/y.py", "code only"), (3, "a/b/c/z.py", "the of and"),
            (4, "a/b/c/LICENSE", apache), (5, "q/none.py", None), (6, None, mit), (7, "a/b/c/d/e.py", ""),
            (8, "a/x2.py", "released under the mit license"), (8, "a/x2.py", "released under the mit license"),
            (9, "q/far.py", "the license of this work is a long story about public version notes " * 30)]
    files = spark.createDataFrame([(*r, "clash") for r in rows], "id long, path string, text string, licence string")
    got = {r.id: (r.own_licence, r.licence, r.from_directory) for r in L.scan_licences(files, F.split("text", "\n")).collect()}
    assert got == {1: ("MIT", "MIT", None), 2: (None, "MIT", "a"), 3: (None, "Apache-2.0", "a/b/c"), 4: ("Apache-2.0", "Apache-2.0", None),
                   5: (None, None, None), 6: ("MIT", "MIT", None), 7: (None, "Apache-2.0", "a/b/c"), 8: ("MIT", "MIT", None), 9: (None, None, None)}
    assert L.scan_licences(files, F.split("text", "\n")).count() == len(rows)
    assert L.scan_licences(files.limit(0), F.split("text", "\n")).count() == 0


def test_licence_headers_tags_and_texts_are_found(spark):
    gpl = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
           "published by the Free Software Foundation, either version {} of the License, or (at your option) any later version.")
    cases = [("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
             ("GPL-3.0", gpl.format(3)), ("GPL-2.0", gpl.format(2)), ("MIT", "SPDX-License-Identifier: MIT"),
             ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
             ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"), ("CC-BY-SA-4.0", "SPDX-License-Identifier: CC-BY-SA-4.0"),
             ("proprietary", "Copyright 2020 Foo Inc. All rights reserved."), ("MIT", "Licensed under the MIT License")]
    prose = "the river runs of old under a bridge and this is what people use to cross it with any person they like "
    none = [prose, prose * 40, "Free of charge", "SPDX-License-Identifier: LicenseRef-ours", "This program is free to all, you may modify nothing."]
    rows = [(i, f"d{i}/x", t) for i, (_, t) in enumerate(cases)]
    rows += [(100 + i, f"e{i}/x", prose * 9 + t + " " + prose * 9) for i, (_, t) in enumerate(cases)]
    rows += [(200 + i, f"f{i}/x", t) for i, t in enumerate(none)]
    rows += [(300, "g/x", "Copyright 2020 Foo Inc. All rights reserved. " + cases[3][1]), (301, "d0/y/z", None)]
    files = spark.createDataFrame(rows, "id long, path string, text string")
    got = {r.id: r.licence for r in L.scan_licences(files, F.array("text")).collect()}
    assert got == {**{i + k: c for k in (0, 100) for i, (c, _) in enumerate(cases)}, **{200 + i: None for i in range(len(none))},
                   300: "MIT", 301: "Apache-2.0"}


# -- 3 ----------------------------------------------------------------------

def test_warc_round_trip(spark):
    rows = [(1, "http://u/1", "same"), (2, None, "same"), (3, "http://u/ 3\n", None), (4, "", ""), (5, "http://u/5", "é" * 200_000),
            (None, "n", "same"), (6, "r", "x"), (6, "r", "x"), (6, "r", "other")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")
    folder = scratch_path(spark, "warc")
    assert W.write_warc(pages, folder, archive_bytes=50_000) == len(rows)
    got = W.read_warc(spark, folder).collect()
    full = sorted((str(i), len((h or "").encode()), W.payload_digest((h or "").encode())) for i, _, h in rows)
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest) for r in got) == full
    assert {r.page_id: r.refers_to for r in got if r.record_type == "revisit"} == {2: 1, 4: 3}
    assert all(bytes(r.payload) == next((h or "").encode() for i, _, h in rows if i == r.page_id and W.payload_digest((h or "").encode()) == r.payload_digest)
               for r in got if r.record_type == "response")
    empty = scratch_path(spark, "warc")
    assert W.write_warc(pages.limit(0), empty) == 0 and W.read_warc(spark, empty).count() == 0


def test_warc_reader_refuses_what_breaks_the_format():
    records = [W.record_bytes(i, "http://x", f"payload {i}".encode() * 50) for i in range(40)]
    data = next(iter(W.archives(records)))
    assert [r["length"] for r in W.read_archive(data)] == [len(f"payload {i}") * 50 for i in range(40)]
    for broken in (data[:-3], data[4:], data + b"xx", data[:len(data) // 2] + b"\xff\xff" + data[len(data) // 2 + 2:]):
        with pytest.raises(W.WarcError):
            list(W.read_archive(broken))
    good = W.record_bytes(1, "u", b"abc")
    for bad in (good.replace(b"WARC/1.1", b"WARX/1.1"), good.replace(b"abc", b"abd"), good + b"x", good.replace(b"WARC-Date", b"X-Date"),
                good.replace(b"Content-Length: ", b"Content-Length: 1")):
        with pytest.raises(W.WarcError):
            W.parse_record(bad)


# -- 4, 9 -------------------------------------------------------------------

def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    return a == b or any(a[:i] + a[i + 1:] == b for i in range(len(a))) or any(b[:i] + b[i + 1:] == a for i in range(len(b))) \
        or (len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1)


def test_automaton_equals_edit_distance():
    rng = random.Random(3)
    terms = ["abcab$", "bacca$", "cab$", "abb"]
    auto = T.Automaton(terms)
    classes = auto.letter_classes()
    words = list(dict.fromkeys(rand_words(rng, 4000, "abcd", 1, 7)))
    at, which, starts = auto.matches(" ".join(words), classes)
    assert len(starts) == len(words)
    found = {int(np.searchsorted(starts, p)): auto.accepts[w] for p, w in zip(at, which)}
    for i, w in enumerate(words):
        if w.startswith("abb"):  # a stem ends the match where it ends
            continue
        ok = w == "cab" or within_one(w, "abcab") or within_one(w, "bacca")
        assert (i in found) == ok, w
        if ok and w in ("abcab", "bacca", "cab"):
            assert found[i] == (terms.index(w + "$"), 0)


def test_a_stem_keeps_its_words_misspellings():
    terms = T.without_nested({"pathetic$": 100, "pathet": 110, "patheti$": 4, "path$": 3, "pathe": 111, "drab": 50, "drabnok$": 49})
    assert sorted(terms) == ["drabnok$", "path$", "pathet", "patheti$", "pathetic$"]
    auto = T.Automaton(terms)
    at, which, _ = auto.matches("pothetic pathetisch athetic harmless", auto.letter_classes())
    assert [(p, terms[auto.accepts[w][0]], auto.accepts[w][1]) for p, w in zip(at.tolist(), which)] == [
        (0, "pathetic$", 1), (9, "pathet", 0), (20, "pathetic$", 1)]


@pytest.mark.parametrize("part_terms", [1, 7, 1000])
def test_parts_of_a_lexicon_match_like_one_automaton(part_terms):
    rng = random.Random(11)
    whole = sorted({w + "$" for w in rand_words(rng, 60, "abcé", 3, 8)})
    terms = T.without_nested({t: rng.randint(3, 9) for t in {*whole, *(t[:5] for t in whole[::3] if len(t) > 6)}})
    assert any(not t.endswith("$") for t in terms)
    one, parts = T.Automaton(terms), T.Automata(terms, part_terms)
    text = " ".join(rand_words(rng, 3000, "abcdé", 1, 9)) + "\n中文 x"
    found = [[(int(p), a.accepts[w]) for p, w in zip(*a.matches(text, a.letter_classes())[:2])] for a in (one, parts)]
    assert found[0] and found[0] == found[1]


def test_copies_are_evidence_once():
    a, b = frozenset(range(10)), frozenset(range(20, 32))
    assert T._first_copies([a, b, a, a | {50}, frozenset([1]), frozenset([1]), a | b, frozenset()]) == [0, 1, 4, 5, 7]
    assert T._first_copies([a, frozenset(range(8, 18)), b]) == [0, 1, 2]


def test_every_significant_term_scores(spark):
    rng = random.Random(12)
    vile = list(dict.fromkeys(rand_words(rng, 150, "qxyzvwjk", 8, 9)))
    bag = [w for w in vile for _ in range(12)]
    rng.shuffle(bag)
    toxic = [bag[i:i + 3] for i in range(0, len(bag), 3)]
    ids = [i for i in range(9 * len(toxic)) if zlib.crc32(str(i).encode()) % 5][:5 * len(toxic)]  # never held out
    rows = [(i, " ".join(rand_words(rng, 12) + (toxic[k] if k < len(toxic) else []))) for k, i in enumerate(ids)]
    probe = [(100_000 + i, "a plain text with " + w) for i, w in enumerate(vile)] + [(200_000, "a plain text with nothing")]
    labels = spark.createDataFrame([(i, int(k < len(toxic)), 1) for k, i in enumerate(ids)], "doc_id long, toxic int, quality int")
    got = {r.doc_id: r.score for r in T.toxicity(docs_of(spark, rows + probe), labels).collect()}
    assert len(got) == len(rows) + len(probe)
    assert [w for i, w in enumerate(vile) if got[100_000 + i] <= got[200_000] + 0.1] == []


def test_toxicity_learns_and_separates_quotation(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(240):
        ws = rand_words(rng, 60)
        toxic = i % 4 == 0
        if toxic:
            for w in rng.sample(["zorgon", "kwimpel", "drabnok"], 2):
                ws.insert(rng.randrange(len(ws)), w)
        rows.append((i, " ".join(ws)))
        labels.append((i, int(toxic), 1))
    extra = [(1000, "aa bb cc zorgn dd ee ff zorgonn gg"), (1001, 'he wrote "zorgon" once ' + " ".join(rand_words(rng, 80)))]
    docs = docs_of(spark, rows + extra + ODD)
    labels = spark.createDataFrame(labels + [(None, 1, 1), (5, None, 1)], "doc_id long, toxic int, quality int")
    score = {}
    for r in T.toxicity(docs, labels).collect():
        score.setdefault(r.doc_id, r.score)
    assert all((score[i] >= 0.5) == (i % 4 == 0) for i in range(240))
    assert score[1000] >= 0.5 > score[900] == score[901] and score[1001] < score[1000]
    kept = T.clean_documents(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 180 + 1 + len(ODD)
    assert T.toxicity(docs.limit(0), labels).count() == 0
    assert {r.score for r in T.toxicity(docs, labels.limit(0)).collect()} == {0.0}


def test_quoted_context():
    text = 'they say "you are a clown" to him\nnow you clown'
    assert T.quoted(text, text.index("clown")) and not T.quoted(text, text.rindex("clown"))


def test_quality_votes(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(200):
        ws = rand_words(rng, 50)
        good = i % 5 != 0
        text = " ".join(ws).capitalize() + ".\nMore " + " ".join(ws[:9]) + "." if good else "!! ".join(w.upper() for w in ws) + "!!"
        rows.append((i, text))
        labels.append((i, int(good)))
    docs = docs_of(spark, rows + ODD)
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    score = {r.doc_id: r.score for r in Q.quality(docs, labels).collect()}
    assert all((score[i] >= 0.3) == (i % 5 != 0) for i in range(200))
    assert all(0 <= s <= 1 for s in score.values())
    kept = Q.good_documents(docs, labels)
    assert kept.columns == docs.columns and 160 <= kept.count() <= 160 + len(ODD)
    assert {r.score for r in Q.quality(docs, labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in Q.quality(docs, labels.filter("quality = 1")).collect()} == {1.0}
    assert Q.quality(docs.limit(0), labels).count() == 0


def test_bags_do_not_depend_on_neighbours():
    texts = ["One two two.\nOne two two.", None, "", "a" * 3_000_000, "x y", "Ünï ÜBER"]
    alone = np.concatenate([next(Q.bags([t])) for t in texts])
    assert (np.concatenate(list(Q.bags(texts))) == alone).all()


# -- 5 ----------------------------------------------------------------------

def test_top_k_is_exact(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.normal(size=12).round(2)]) for i in range(300)]
    rows += [(300 + i, rows[50][1]) for i in range(20)]  # ties
    rows += [(50, rows[50][1]), (700, None), (701, []), (702, [1.0, None]), (703, [float("nan")] * 12), (704, [float("inf")] * 12),
             (705, [1.0] * 5), (None, rows[3][1])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int").repartition(5)
    got = {}
    for r in K.top_k(frame, F.col("vec_id") % 50 == 0, k=4, query_block=3).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    good = [(i, np.floor(256 * np.array(v, np.float32).astype(np.float64)).astype(np.int64)) for i, v in rows
            if v is not None and None not in v and np.isfinite(v).all()]
    for n, (i, v) in enumerate(good):
        if i is not None and i % 50 == 0:
            best = sorted((-int(v @ w), j is None, j or 0) for m, (j, w) in enumerate(good) if m != n and len(w) == len(v))[:4]
            want = [(k + 1, None if none else j, -s) for k, (s, none, j) in enumerate(best)]
            copies = sum(j == i for j, _ in good)
            assert sorted(got.get(i, []), key=lambda x: x[0]) == sorted(want * copies, key=lambda x: x[0]), i
    assert K.top_k(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_segment_bound_holds():
    rng = np.random.default_rng(8)
    v = rng.integers(-500, 500, (60, 37))
    for s in K.SEGMENTS:
        short = K.summary(v, s)
        assert (short @ short.T >= v @ v.T - 1e-6).all()


# -- 6 ----------------------------------------------------------------------

@pytest.mark.parametrize("rule_block", [U.RULE_BLOCK, 4])
def test_url_rules_against_brute_force(spark, rule_block):
    rng = random.Random(9)
    hosts = ["org", "example.org", "a.example.org", "a.b.example.org", "xexample.org", "com", "x.com", "org.com", ""]
    paths = ["/", "/e", "/es/", "/es/1", "/en/", "/en/12", ""]
    rules = U.RULES + [(rng.choice(["allow", "block"]), rng.choice(hosts[:-1]) + rng.choice(paths[:-1])) for _ in range(15)]
    rules = list(dict.fromkeys(rules))
    urls = [f"{rng.choice(['http', 'HTTPS'])}://{rng.choice(hosts).upper()}{rng.choice(paths)}{rng.choice(['', '?q=/es/', '#top'])}" for _ in range(300)]
    urls += [None, "", "no scheme", "http://", "http://A.Example.ORG", "x://é.example.org/es/\nb"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)] + [(None, urls[0], "c"), (0, urls[0], "c")],
                                  "page_id long, url string, path string")
    frame = spark.createDataFrame(rules + [(None, "org/"), ("block", None), ("block", "/x")], "verdict string, rule string")
    merged = {}
    for verdict, rule in sorted(rules):
        merged[rule] = verdict
    for r in U.judge_urls(pages, frame, rule_block=rule_block).collect():
        fits = [x for x in merged if r.host and (r.host == x.partition("/")[0] or r.host.endswith("." + x.partition("/")[0]))
                and r.path.startswith("/" + x.partition("/")[2])]
        want = max(fits, key=lambda x: (len(x), len(x.partition("/")[0])), default=None)
        assert (r.rule and len(r.rule)) == (want and len(want))
        assert r.verdict == (merged[r.rule] if r.rule else "allow")
    assert U.judge_urls(pages, frame, rule_block=rule_block).count() == len(urls) + 2
    assert U.judge_urls(pages.limit(0), frame).count() == 0
    assert {r.rule for r in U.judge_urls(pages, frame.limit(0)).collect()} == {None}


# -- 7 ----------------------------------------------------------------------

def test_word_ids_equal_the_tokenizer():
    from tokenizers import Tokenizer

    path = P.tokenizer_path()
    whole, mine = Tokenizer.from_file(path), P.WordIds(path, limit=50)
    rng = random.Random(10)
    texts = ["", "It's 3½ don't I'LL, stop... !!x", "<|endoftext|>hi", "a\x1cb\x85c\u00a0d", "é e\u0301 中文 İ ΣΑΣ ß", "v\x05 \tâ.\x02"]
    texts += ["".join(chr(rng.choice([rng.randrange(0x250), rng.randrange(0x80), rng.randrange(0x300, 0x2100), 32])) for _ in range(20))
              for _ in range(400)]
    for t in texts:
        assert mine.of(t) == np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), repr(t)


def test_packing_keeps_all_tokens(spark):
    rng = random.Random(11)
    rows = ODD + [(i, " ".join(rand_words(rng, rng.choice([1, 30, 200, 900])))) for i in range(80)] + [(500, "ab " * 9000)]
    packed = P.pack_documents(docs_of(spark, rows), P.tokenizer_path(), capacity=512, keep_ids=True)
    got = packed.collect()
    by_seq = {}
    for r in got:
        by_seq.setdefault(r.sequence_id, []).append(r)
        assert r.length == len(r.ids) // 4 <= 512 and zlib.crc32(bytes(r.ids)) == r.ids_crc32 and r.start == 512 * r.piece
    for rs in by_seq.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 512
    assert len(by_seq) == P.lower_bound([r.length for r in got], 512)
    mine = P.WordIds(P.tokenizer_path())
    assert sum(r.length for r in got) == sum(len(mine.of(t or "")) // 4 + 1 for _, t in rows)
    assert P.sequences(packed).count() == len(by_seq)
    assert P.pack_documents(docs_of(spark, []), P.tokenizer_path()).count() == 0


def test_lower_bound_and_best_fit():
    rng = random.Random(12)
    for _ in range(200):
        lengths = sorted((rng.randint(1, 30) for _ in range(rng.randint(1, 9))), reverse=True)
        bins, offsets, rooms = P.best_fit(lengths, 30)
        assert P.lower_bound(lengths, 30) <= fewest(lengths, 30) <= len(rooms)
        assert all(sum(s for s, b in zip(lengths, bins) if b == k) + left == 30 for k, left in enumerate(rooms))
    assert P.lower_bound([20, 20, 20], 30) == 3


def fewest(lengths, capacity):
    best = [len(lengths)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= lengths[i]:
                go(i + 1, rooms[:k] + [rooms[k] - lengths[i]] + rooms[k + 1:])
        go(i + 1, rooms + [capacity - lengths[i]])

    go(0, [])
    return best[0]


def test_exchange_closes_gaps(spark):
    """Two halves whose best fit leaves a gap that the exchange closes or leaves valid."""
    rng = random.Random(13)
    cut = spark.createDataFrame([(i, 0, rng.choice([5, 7, 11, 13])) for i in range(400)], "doc_id long, piece int, length long") \
        .withColumn("ids_crc32", F.col("doc_id"))
    got = P.pack(cut, capacity=30, part_rows=40).collect()
    assert len(got) == 400
    one = P.pack(cut, capacity=30, part_rows=1000).select("sequence_id").distinct().count()
    assert len({r.sequence_id for r in got}) <= one * 1.1
    sums = {}
    for r in got:
        sums[r.sequence_id] = sums.get(r.sequence_id, 0) + r.length
    assert max(sums.values()) <= 30


# -- 8 ----------------------------------------------------------------------

def test_rollup_is_additive_and_idempotent(spark):
    rollup = Rollup(spark, scratch_path(spark, "rollup"))
    docs = spark.createDataFrame([("a", "en", 10), ("a", "en", 5), (None, "fr", 7), ("b", None, None)], "source string, lang string, n long")
    load = changes(docs, "insert", "v1", F.col("n"))
    assert rollup.commit("1", load) and not rollup.commit("1", load)
    total = {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in rollup.totals().collect()}
    assert total == {("a", "en"): (2, 15), (None, "fr"): (1, 7), ("b", None): (1, 0)}
    rollup.commit("2", changes(docs.filter("n = 5"), "revise", "v1", F.lit(8).cast("long"), F.col("n")))
    rollup.commit("3", changes(docs.filter("n = 7"), "delete", "v1", F.col("n")))
    rollup.commit("4", load.limit(0))
    total = {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in rollup.totals().collect()}
    assert total == {("a", "en"): (2, 18), ("b", None): (1, 0)}
    with pytest.raises(Exception, match="unknown kind"):
        rollup.commit("5", changes(docs, "upsert", "v1", F.col("n")))
    assert {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in rollup.totals().collect()} == total


# -- 10 ---------------------------------------------------------------------

def slow_fingerprint(text):
    ws = (text or "").encode().translate(S._LOWER).split()
    hs = [xxhash.xxh64_intdigest(b" ".join(ws[i:i + 4]), 42) for i in range(max(1, len(ws) - 3))] if ws else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprints(spark):
    rng = random.Random(14)
    for t in [None, "", " \x0b ", "One", "a b c d", "A B c d e", *(" ".join(rand_words(rng, n)) for n in range(1, 40))]:
        assert S.fingerprint(t) % 2 ** 64 == slow_fingerprint(t)


def grouped(fps, d):
    par = list(range(len(fps)))

    def root(x):
        while par[x] != x:
            x = par[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin((fps[i] ^ fps[j]) % 2 ** 64).count("1") <= d:
                par[root(i)] = root(j)
    return [root(i) for i in range(len(fps))]


@pytest.mark.parametrize("cell_rows", [S.CELL_ROWS, 5])
def test_links_connect_what_is_near(spark, cell_rows):
    rng = random.Random(15)
    base = [rng.getrandbits(64) for _ in range(30)]
    fps = {b ^ sum(1 << k for k in set(rng.choices(range(64), k=rng.randint(0, 5)))) for b in base for _ in range(12)}
    ball = rng.getrandbits(64)
    fps |= {ball ^ rng.getrandbits(9) for _ in range(200)}  # a dense ball: one cell holds very many
    fps = [x - 2 ** 64 if x >= 2 ** 63 else x for x in sorted(fps)]
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    edges = S.links(frame, 4, cell_rows)
    for a, b in edges.collect():
        assert 0 < bin((a ^ b) % 2 ** 64).count("1") <= 4
    roots = {r.node: r.root for r in components(edges).collect()}
    got, want = [roots.get(f, f) for f in fps], grouped(fps, 4)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_simhash_groups(spark):
    rng = random.Random(16)
    ws = rand_words(rng, 300)
    near = ws[:150] + ["changed"] + ws[151:]
    rows = ODD + [(i, " ".join(rand_words(rng, 80))) for i in range(20)] + [(31, " ".join(ws)), (30, " ".join(ws)), (40, " ".join(near))]
    got = S.simhash_groups(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    fps = [S.fingerprint(t) for _, t in rows]
    want = grouped(fps, 4)
    least = {}
    for (i, _), w in zip(rows, want):
        if i is not None:
            least[w] = min(least.get(w, i), i)
    expected = sorted((str(i), str(least.get(w))) for (i, _), w in zip(rows, want))
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got) == expected
    assert S.simhash_groups(docs_of(spark, [])).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    roots = {r.node: r.root for r in components(edges).collect()}
    assert all(roots[i] == 0 for i in range(61)) and roots[101] == roots[100] == 100
    assert components(edges.limit(0)).count() == 0


def test_digest_of_no_items():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


def test_labelled_sample_is_bounded(spark):
    from textmill.llm.common import labelled_sample

    docs = spark.createDataFrame([(1, "b"), (1, "a"), (1, None)] * 50 + [(i, "x") for i in range(2, 60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(1, 0), (None, 1)], "doc_id long, toxic int")
    rows = labelled_sample(docs, labels, "toxic", 20).collect()
    assert len(rows) <= 20 and len({r.doc_id for r in rows}) == len(rows)
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 for r in rows)
    whole = {r.doc_id: (r.text, r.label) for r in labelled_sample(docs, labels, "toxic", 1000).collect()}
    assert 1 not in whole or whole[1] == ("", 1)
