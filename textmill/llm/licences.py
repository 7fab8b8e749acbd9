"""Licence scan: sparse TF-IDF cosine to templates, then inheritance by path.

Every part of a file (a line of text, a text node of a page, or the whole file)
is a possible licence header or text, a bag of words.  Its cosine with a
template can only reach the threshold if its known words weigh enough against
the number of its unknown ones; this bound is an expression over the row, and
only parts that meet it are exploded and joined with the template words.  It is
taken only where a part has an anchor: without the words of each template that
leave too little of its weight to reach the threshold, no cosine can.

Headers, SPDX tags and the passages that open licence texts (``PASSAGES``) are
sought in windows of their own length, and so are the notices inside longer
parts, so that the words around them do not count: every window that begins
with a word of the passage is scored, with the cosine again.  A part reaches
this only if it holds enough of a passage's weight, a bound that loses nothing.
A part no longer than the passage is one window and needs ``threshold``; windows
inside a longer part are the best of many and need ``WITHIN``, tags all words.
A file can be one part: its windows then run across line ends.

The best template or passage of all parts of a file is its own licence.

A directory's licence is that of most files in it that have their own.  Files
without one inherit from the nearest ancestor: each different directory is cut
into its ancestors, which meet the licensed directories in an equi-join on the
path, and the longest wins.  A directory that holds a third of all files is one row there.

Everything is DataFrame expressions.  The templates are a fixed table of the
package (or a parameter); their number and length are checked before their
words become literals of the plan.

Defined results: null and empty texts have no licence of their own; files of a
null path neither give nor inherit one; a reservation of rights found beside a licence
yields to it; ties of the cosine go to the longer passage and then, like ties of
a directory's files, to the smaller licence name; repeated rows give a row each and count
each for their directory; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from math import log, sqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import table
from textmill.session import written

THRESHOLD = 0.6
MAX_TEMPLATES = 200
MAX_CHARS = 100_000
#: Short licence notices by SPDX name (fixed values).
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms are permitted under the BSD 3-Clause License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.",
    "proprietary": "All rights reserved.",
}
WITHIN = 0.8
RESERVED = "proprietary"
#: More than rounding the scores to six digits can add to a squared cosine.
SLACK = 1e-5
#: Words that most texts hold: the last to be taken as anchors.
COMMON = frozenset(
    "a all an and any are as at be but by can for from has have if in into is it its may more must name no not of on one or our "
    "that the they this to under use was we with work you your".split())
_TAGGED = (
    "MIT", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "BSD-2-Clause", "BSD-3-Clause", "ISC",
    "MPL-2.0", "EPL-2.0", "Unlicense", "CC0-1.0", "BSL-1.0", "Zlib", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0",
    "CC-BY-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0")
_FREE = ("This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} as published by "
         "the Free Software Foundation, either version {2} of the License, or (at your option) any later version.")
_GNU = (("GPL-2.0", "program", "General Public License", "2", "June 1991"),
        ("GPL-3.0", "program", "General Public License", "3", "29 June 2007"),
        ("LGPL-2.1", "library", "Lesser General Public License", "2.1", "February 1999"),
        ("LGPL-3.0", "library", "Lesser General Public License", "3", "29 June 2007"),
        ("AGPL-3.0", "program", "Affero General Public License", "3", "19 November 2007"))
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
#: Headers, tags and passages of licence texts: (SPDX name, text).
PASSAGES = (
    *((k, f"SPDX-License-Identifier: {k}") for k in _TAGGED),
    *((k, _FREE.format(what, name, version)) for k, what, name, version, _ in _GNU),
    *((k, f"GNU {name} Version {version}, {date}") for k, _, name, version, date in _GNU),
    *((k, f"licensed under the GNU {name} version {version}") for k, _, name, version, _ in _GNU),
    ("MIT", "licensed under the MIT License"),
    ("MIT", "licensed under the terms of the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License."),
    ("Apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("BSD-2-Clause", f"{_BSD} the following conditions are met: 1. Redistributions of source code must retain the above copyright "
                     "notice, this list of conditions and the following disclaimer."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                     "products derived from this software without specific prior written permission."),
    ("BSD-3-Clause", "licensed under the BSD 3-Clause License"),
    ("BSD-2-Clause", "licensed under the BSD 2-Clause License"),
    ("MPL-2.0", "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "licensed under the Mozilla Public License, Version 2.0"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
             "liable for any damages arising from the use of this software."),
    *((f"CC-{k.upper().replace(' ', '-')}-4.0", f"licensed under a Creative Commons {name} 4.0 International License")
      for k, name in (("by", "Attribution"), ("by sa", "Attribution-ShareAlike"), ("by nc", "Attribution-NonCommercial"),
                      ("by nd", "Attribution-NoDerivatives"), ("by nc sa", "Attribution-NonCommercial-ShareAlike"),
                      ("by nc nd", "Attribution-NonCommercial-NoDerivatives"))),
    *((f"CC-{k.replace(' ', '-')}-4.0", f"Licensed under CC {k} 4.0") for k in ("BY SA", "BY ND", "BY NC SA", "BY NC ND")),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BETWEEN = "".join(c for c in map(chr, range(128)) if not c.isalnum())


def _words(text):
    # One pass over the characters, then a cut at a plain one: several times as fast as a pattern.
    return F.array_remove(F.split(F.translate(text, _UPPER + _BETWEEN, _LOWER + " " * len(_BETWEEN)), " "), "")


def template_vectors(templates: dict[str, str]) -> tuple[dict[str, dict[str, float]], dict[str, float], float]:
    """({licence: {word: weight}} of unit length, {word: idf}, idf of a word that
    no template has)."""
    if len(templates) > MAX_TEMPLATES or sum(map(len, templates.values())) > MAX_CHARS:
        raise ValueError(f"more than {MAX_TEMPLATES} templates or {MAX_CHARS} characters")
    return _vectors(templates)


def _vectors(templates: dict[str, str]) -> tuple[dict[str, dict[str, float]], dict[str, float], float]:
    lower = str.maketrans(_UPPER, _LOWER)
    bags = {k: Counter(re.findall(_WORD, t.translate(lower))) for k, t in templates.items()}
    df = Counter(w for b in bags.values() for w in b)
    idf = {w: log((1 + len(bags)) / (1 + n)) + 1 for w, n in df.items()}
    out = {}
    for k, b in bags.items():
        norm = sqrt(sum((n * idf[w]) ** 2 for w, n in b.items())) or 1.0
        out[k] = {w: n * idf[w] / norm for w, n in b.items()}
    return out, idf, log(1 + len(bags)) + 1


def _anchors(vector: dict[str, float], least: float) -> list[str]:
    """Words of which every part with a cosine of ``least`` has one: what the others
    have of the unit vector's squared weight bounds a cosine without them."""
    out, left = [], 1.0
    for w in sorted(vector, key=lambda w: (w in COMMON, -vector[w], w)):
        if left < least * least - SLACK:
            break
        out.append(w)
        left -= vector[w] ** 2
    return out


def _passage_rows(templates: dict[str, str], passages, threshold: float):
    """(rows, {word: idf}, idf of an unknown word, words of which every part
    that can reach a passage has one).  A row is (licence, number of words, least
    cosine in a longer part, least of a part no longer, {word: idf * weight},
    squared weights in the order of {word: idf})."""
    if len(passages) > MAX_TEMPLATES or sum(len(t) for _, t in passages) > MAX_CHARS:
        raise ValueError(f"more than {MAX_TEMPLATES} passages or {MAX_CHARS} characters")
    texts = [*templates.items(), *passages]
    vectors, idf, unknown = _vectors({str(i): t for i, (_, t) in enumerate(texts)})
    rows, anchors = [], set()
    for i, (licence, text) in enumerate(texts):
        v = vectors[str(i)]
        if not v:
            continue
        n = len(re.findall(_WORD, text.translate(str.maketrans(_UPPER, _LOWER))))
        tag = text.startswith("SPDX-License-Identifier:")
        inside = 1 - 1e-6 if tag else max(threshold, WITHIN)
        # Notices are scored by whole parts already, where those are no longer.
        alone = 2.0 if i < len(templates) else 1 - 1e-6 if tag else threshold
        rows.append((licence, n, inside, alone, {w: idf[w] * x for w, x in v.items()}, [v.get(w, 0.0) ** 2 for w in idf]))
        anchors.update(_anchors(v, min(inside, alone)))
    return rows, idf, unknown, sorted(anchors)


def _literal(value, schema: str):
    """A constant of the plan, folded by the optimizer.  One text of JSON is one
    call to the JVM, where a literal per word takes seconds."""
    return F.from_json(F.lit(json.dumps(value)), schema)


def _literal_map(d: dict[str, float]):
    return _literal(d, "map<string,double>")


def _among(xs, words):
    """The different items of ``xs`` that are in ``words``: a look into a set made
    once, which array functions build again for every row."""
    return F.array_distinct(F.filter(xs, lambda x: x.isin(sorted(words))))


def _once(value):
    """``value`` as a generated column, so that no filter on it repeats its work."""
    return F.explode_outer(F.array(value))


def _passages_found(near: DataFrame, idf: dict[str, float], unknown: float) -> DataFrame:
    """(file, licence, n, score) of every part's passages ``ts`` with a window
    that reaches the least cosine."""
    weights, zero = _literal_map(idf), F.lit(0.0)
    weight = lambda w: F.coalesce(F.element_at(weights, w), F.lit(unknown))
    total = lambda xs: F.aggregate(xs, zero, lambda a, x: a + x)
    n = F.col("t.n")
    least = F.when(F.size("ws") > n, F.col("t.inside")).otherwise(F.col("t.alone"))
    weighed = near.select("file", "ws", "ts", _once(F.transform("ws", lambda w: F.pow(weight(w), F.lit(2.0)))).alias("squares"))
    laid = weighed.select("file", "ws", "squares", F.explode("ts").alias("t")).select("file", "ws", "squares", "t", least.alias("least"), _once(
        F.transform("ws", lambda w: F.coalesce(F.element_at(F.col("t.dots"), w), zero))).alias("dots"))

    def promising(p):
        # A repeated word adds more to the norm than its squares.
        low = total(F.slice(F.col("squares"), p, n))
        return ((F.size("ws") <= n) | (F.element_at(F.col("dots"), p) > 0)) & (
            total(F.slice(F.col("dots"), p, n)) >= (F.col("least") - SLACK) * F.sqrt(low))

    def score(p):
        window = F.slice("ws", p, n)
        norm = F.aggregate(F.array_distinct(window), zero, lambda a, w: a + F.pow(
            weight(w) * F.size(F.filter(window, lambda y: y == w)), F.lit(2.0)))
        return F.round(total(F.slice(F.col("dots"), p, n)) / F.sqrt(norm), 6)

    starts = F.filter(F.sequence(F.lit(1), F.when(F.size("ws") > n, F.size("ws")).otherwise(1)), promising)
    best = laid.select("file", "t", "least", _once(F.array_max(F.transform(starts, score))).alias("score"))
    return best.filter(F.col("score") >= F.col("least")).select("file", "t.licence", "t.n", "score")


def own_licences(parts: DataFrame, templates: dict[str, str], threshold: float = THRESHOLD, passages=()) -> DataFrame:
    """(file, licence, score): the best template or passage of each file of
    ``parts`` (file, part, text), where it reaches its least cosine."""
    vectors, idf, unknown = template_vectors(templates)
    rows, p_idf, p_unknown, anchors = _passage_rows(templates, passages, threshold)
    spark = parts.sparkSession
    own = {w for v in vectors.values() for w in _anchors(v, threshold)}

    def has(words):
        words = sorted(words)
        return F.exists("ws", lambda w: w.isin(words)) if words else F.lit(False)

    weights = _literal_map(idf)
    ws = F.col("ws")
    # Squared weight of the known words, and the least that the unknown add.
    mass = F.aggregate(_among(ws, idf), F.lit(0.0), lambda a, w: a + F.pow(
        F.element_at(weights, w) * F.size(F.filter(ws, lambda x: x == w)), F.lit(2.0)))
    strange = F.array_distinct(F.filter(ws, lambda x: ~x.isin(sorted(idf))))
    rest = F.size(strange) * (unknown * unknown)
    whole = has(own) & (mass >= (threshold * threshold - SLACK) * (mass + rest))
    # A cosine of c with a passage needs c * c of the passage's squared weight.
    fields = {"licence": "string", "n": "int", "inside": "double", "alone": "double",
              "dots": "map<string,double>", "shares": "array<double>",
              "inside_share": "double", "alone_share": "double"}
    passage = _literal([dict(zip(fields, (*row, row[2] ** 2 - SLACK, row[3] ** 2 - SLACK))) for row in rows], f"array<struct<{','.join(f'{k}:{t}' for k, t in fields.items())}>>")
    # The words of passages that a part holds, as their numbers: passages find their shares by place.
    numbers = _literal({w: i for i, w in enumerate(p_idf)}, "map<string,int>")
    held = F.transform(_among(ws, p_idf), lambda w: F.element_at(numbers, w))

    def reaches(t, words):
        share = F.aggregate(words, F.lit(0.0), lambda a, w: a + F.get(t["shares"], w))
        return share >= F.when(F.size(ws) > t["n"], t["inside_share"]).otherwise(t["alone_share"])

    near = (parts.select("file", "part", _once(_words(F.col("text"))).alias("ws"))
            .filter(has({*own, *anchors}))
            .select("file", "part", "ws", _once(F.struct(whole.alias("whole"), F.when(has(anchors), held).alias("held"))).alias("x")))
    if rows:
        # No passage is reached where even the largest share of every held word is too little;
        # parts longer than all passages need the share of a window inside.
        most = _literal([max(x) for x in zip(*(shares for *_, shares in rows))], "array<double>")
        inside, either = (min(xs) ** 2 - SLACK for xs in ([i for _, _, i, *_ in rows], [min(i, a) for _, _, i, a, *_ in rows]))
        needed = F.when(F.size(ws) > max(n for _, n, *_ in rows), inside).otherwise(either)
        bound = F.aggregate("x.held", F.lit(0.0), lambda a, w: a + F.get(most, w))
        ts = F.when((F.size("x.held") > 0) & (bound >= needed), F.filter(passage, lambda t: reaches(t, F.col("x.held"))))
        near = near.select("file", "part", "ws", "x.whole", _once(ts).alias("ts"))
    else:
        near = near.select("file", "part", "ws", "x.whole", F.lit(None).cast("array<string>").alias("ts"))
    near = written(near.filter(F.col("whole") | (F.size("ts") > 0)), "licence-parts")
    tf = near.filter("whole").select("file", "part", F.explode("ws").alias("word")).groupBy("file", "part", "word").agg(F.count("*").alias("tf"))
    flat = [(k, w, x) for k, v in vectors.items() for w, x in v.items()]
    flat = F.broadcast(spark.createDataFrame(flat, "licence string, word string, weight double"))  # checked above
    weighed = tf.withColumn("w", F.col("tf") * F.coalesce(F.element_at(weights, F.col("word")), F.lit(unknown)))
    norms = weighed.groupBy("file", "part").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = weighed.join(flat, "word").groupBy("file", "part", "licence").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    scored = dots.join(norms, ["file", "part"]).withColumn("score", F.round(F.col("dot") / F.col("norm"), 6))
    found = (scored.filter(F.col("score") >= threshold)
             .select("file", F.lit(False).alias("last"), "score", F.lit(0).alias("n"), "licence"))
    if rows:
        inside = _passages_found(near.filter(F.size("ts") > 0), p_idf, p_unknown)
        found = found.union(inside.select("file", (F.col("licence") == RESERVED).alias("last"), "score", "n", "licence"))
    best = F.min(F.struct("last", (-F.col("score")).alias("minus"), (-F.col("n")).alias("short"), "licence")).alias("best")
    return found.groupBy("file").agg(best).select("file", "best.licence", (-F.col("best.minus")).alias("score"))


def scan_licences(files: DataFrame, pieces, templates: dict[str, str] = TEMPLATES,
                  threshold: float = THRESHOLD, passages=PASSAGES) -> DataFrame:
    """(id, path, own_licence, score, licence, from_directory) of every row of
    ``files`` (id, path, text).  ``pieces`` is an expression that cuts ``text``
    into an array of parts; ``from_directory`` is null for own licences."""
    file = F.xxhash64("id", "path", "text").alias("file")
    directory = F.regexp_extract("path", r"(?s)^(.*)/[^/]*$", 1)
    parts = files.select(file, F.posexplode(pieces).alias("part", "text"))
    own = own_licences(parts, templates, threshold, passages).withColumnRenamed("licence", "own_licence")
    lean = written(files.select("id", "path", file, F.when(F.col("path").isNotNull(), directory).alias("dir"))
                   .join(own, "file", "left"), "own-licences")
    votes = lean.filter("own_licence is not null and dir is not null").groupBy("dir", "own_licence").agg(F.count("*").alias("n"))
    of_dir = (votes.groupBy("dir").agg(F.min(F.struct((-F.col("n")).alias("minus"), "own_licence")).alias("best"))
              .select(F.col("dir").alias("at"), F.col("best.own_licence").alias("inherited")))
    steps = F.split("dir", "/")
    # Of relative paths the root directory, '', is above every other.
    ups = F.array_union(F.array(F.lit("")), F.transform(
        F.sequence(F.lit(1), F.size(steps)), lambda i: F.array_join(F.slice(steps, F.lit(1), i), "/")))
    lacking = lean.filter("own_licence is null and dir is not null").select("dir").distinct()
    nearest = (lacking.select("dir", F.explode(ups).alias("at")).join(of_dir, "at")
               .groupBy("dir").agg(F.max(F.struct(F.length("at").alias("long"), "at", "inherited")).alias("up"))
               .select("dir", F.col("up.at").alias("at"), F.col("up.inherited").alias("inherited")))
    nearest = written(nearest, "nearest")
    out = lean.join(nearest, "dir", "left")
    lacks = F.col("own_licence").isNull()
    return out.select("id", "path", "own_licence", "score", F.coalesce("own_licence", "inherited").alias("licence"),
                      F.when(lacks, F.col("at")).alias("from_directory"))


_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def op2_licences(spark, sf_dir):
    """Every page: its text nodes against the templates; its path is the host,
    last label first, and the URL's path."""
    pages = table(spark, sf_dir, "pages")
    host = F.array_join(F.reverse(F.split(F.regexp_extract("url", _PARTS, 1), r"\.")), "/")
    path = F.concat(host, F.regexp_extract("url", _PARTS, 2))
    files = pages.select(F.col("page_id").alias("id"), path.alias("path"), F.col("html").alias("text"))
    found = scan_licences(files, F.split("text", "<[^>]*>"))
    return found.select(F.col("id").alias("page_id"), "path", "own_licence", "score", "licence", "from_directory")


def _sql() -> str:
    vectors, idf, unknown = template_vectors(TEMPLATES)
    flat = ", ".join(f"('{k}', '{w}', CAST({x!r} AS DOUBLE))" for k, v in vectors.items() for w, x in v.items())
    idfs = ", ".join(f"('{w}', CAST({x!r} AS DOUBLE))" for w, x in idf.items())
    return rf"""
WITH t(licence, word, weight) AS (VALUES {flat}), i(word, idf) AS (VALUES {idfs}),
p AS (
  SELECT page_id, html, array_to_string(list_reverse(string_split(regexp_extract(url, '{_PARTS}', 1), '.')), '/')
         || regexp_extract(url, '{_PARTS}', 2) AS path
  FROM pages),
n AS (SELECT page_id, path, unnest(string_split_regex(html, '<[^>]*>')) AS node FROM p),
n2 AS (SELECT page_id, path, row_number() OVER () AS part, node FROM n),
w AS (SELECT page_id, path, part, unnest(regexp_extract_all(translate(node, '{_UPPER}', '{_LOWER}'), '{_WORD}')) AS word FROM n2),
tf AS (SELECT page_id, path, part, word, count(*) AS tf FROM w GROUP BY ALL),
ww AS (SELECT tf.*, tf * coalesce(idf, {unknown!r}) AS x FROM tf LEFT JOIN i USING (word)),
nn AS (SELECT part, sqrt(sum(x * x)) AS norm FROM ww GROUP BY part),
dd AS (SELECT page_id, path, part, licence, sum(x * weight) AS dot FROM ww JOIN t USING (word) GROUP BY ALL),
sc AS (SELECT page_id, path, licence, round(dot / norm, 6) AS score FROM dd JOIN nn USING (part)),
own AS (SELECT page_id, path, licence, score FROM (
  SELECT *, row_number() OVER (PARTITION BY page_id, path ORDER BY score DESC, licence) AS rn FROM sc WHERE score >= {THRESHOLD})
  WHERE rn = 1),
f AS (
  SELECT p.page_id, p.path, regexp_extract(p.path, '(?s)^(.*)/[^/]*$', 1) AS dir, own.licence AS own_licence, score
  FROM p LEFT JOIN own ON p.page_id = own.page_id AND p.path = own.path),
v AS (SELECT dir, own_licence, count(*) AS n FROM f WHERE own_licence IS NOT NULL GROUP BY ALL),
od AS (SELECT dir AS up_dir, own_licence AS inherited FROM (
  SELECT *, row_number() OVER (PARTITION BY dir ORDER BY n DESC, own_licence) AS rn FROM v) WHERE rn = 1),
up AS (SELECT dir, up_dir, inherited FROM (
  SELECT d.dir, od.up_dir, inherited, row_number() OVER (PARTITION BY d.dir ORDER BY length(up_dir) DESC) AS rn
  FROM (SELECT DISTINCT dir FROM f WHERE own_licence IS NULL) d JOIN od ON d.dir = up_dir OR up_dir = '' OR starts_with(d.dir, up_dir || '/')) WHERE rn = 1)
SELECT page_id, path, own_licence, score, coalesce(own_licence, inherited) AS licence,
       CASE WHEN own_licence IS NULL THEN up_dir END AS from_directory
FROM f LEFT JOIN up USING (dir)
"""


OP2_SQL = _sql()
