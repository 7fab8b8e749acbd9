"""Toxicity scores from a learned lexicon matched with spelling errors.

1. Lexicon: words and word stems whose documents are toxic far more often than
   chance (log-likelihood ratio on a bounded sample of labelled documents).
2. Matching: the lexicon is a trie; its intersection with Levenshtein automata
   of distance one (for words of ``FUZZY_FROM`` letters or more; stems and
   short words match exactly) is made deterministic once and runs over whole
   texts as table look-ups, all words of a batch at a time.  Every
   ``PART_TERMS`` terms have an automaton of their own; of the matches of one
   word the one counts that a single automaton would find.
3. Context: a match with quotation marks around it within ``CONTEXT``
   characters of its line counts as quotation and only in part.
4. Score: a logistic model of the strongest match, the summed matches and
   their density, fitted on the same bounded sample.

Only the model (the terms that the sample bears out, all of them) is broadcast, documents are scored where
they are read, and nothing but the sample is shuffled.

Defined results: null and empty texts have no match and get the score of a
text without matches; without any toxic label every score is 0; repeated rows
are scored each; a null doc_id is kept, its remainder taken of the empty string;
null labels take no part; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import filter_rows, held_out, labelled_sample, map_rows, shared, table, worker_cache
from textmill.session import written

TRAIN_ROWS = 8_000
PART_TERMS = 500
COPY_HITS = 8
LEAST_G2 = 20.0
FUZZY_FROM = 5
CONTEXT = 80
QUOTED_SHARE = 0.25
MISSPELT = 0.8
STEMS = (4, 5, 6)
_WORD = re.compile(r"[^\W\d_]+")
_QUOTES = re.compile("[\"«»‘“”„‹›「」]")
CHUNK = 1_000_000


# -- lexicon ---------------------------------------------------------------

def candidates(text: str) -> set[str]:
    """Whole words (ending in ``$``) and stems of one text."""
    out = set()
    for w in set(_WORD.findall(text.lower())):
        if 3 <= len(w) <= 30:
            out.add(w + "$")
            out.update(w[:k] for k in STEMS if len(w) > k)
    return out


def lexicon(sample: DataFrame, least: float = LEAST_G2) -> list[str]:
    """All significant terms of the sample (doc_id, text, label); the sample's
    size bounds them."""
    n1, n = sample.agg(F.sum("label"), F.count("*")).first()
    if not n1 or n1 == n:
        return []

    def run(batches):
        with_term, toxic = Counter(), Counter()
        for b in batches:
            for text, label in zip(b["text"], b["label"]):
                c = candidates(text)
                with_term.update(c)
                if label:
                    toxic.update(c)
        if with_term:
            yield {"term": list(with_term), "n": list(with_term.values()), "a": [toxic[t] for t in with_term]}

    r = n1 / n
    a, b = F.col("a"), F.col("n") - F.col("a")
    part = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0.0)
    rows = (map_rows(sample.select("text", "label"), run, "term string, n bigint, a bigint")
            .groupBy("term").agg(F.sum("n").alias("n"), F.sum("a").alias("a"))
            .filter((a >= 3) & (a * 2 > F.col("n")))
            .withColumn("g2", 2 * (part(a, F.col("n") * r) + part(b, F.col("n") * (1 - r))))
            .filter(F.col("g2") >= least).select("term", "a").collect())
    docs = {x.term: x.a for x in rows}
    return sorted(without_nested(docs), key=lambda t: (-docs[t], t))


def without_nested(docs: dict[str, int]) -> list[str]:
    """Of nested terms with nearly the same documents the longest stays; what a
    kept stem begins needs no term of its own, but for the whole words that
    match with a spelling error: a stem matches exactly only."""
    longer: dict[str, int] = {}
    for u, n in docs.items():
        for k in STEMS:
            if len(u) > k:
                longer[u[:k]] = max(n, longer.get(u[:k], 0))
    own = [t for t in docs if t.endswith("$") or longer.get(t, -1) < 0.95 * docs[t]]
    stems = {t for t in own if not t.endswith("$")}
    return [t for t in own if (t.endswith("$") and len(t) > FUZZY_FROM)
            or not any(len(t) > k and t[:k] in stems for k in STEMS)]


# -- automaton -------------------------------------------------------------

class Automaton:
    """Deterministic automaton of all words within the allowed distance of a
    term.  ``step[state, class of letter]``; state 0 is dead, 1 the start, the
    first states from 2 on accept: ``accepts[state - 2]`` is (term, distance)."""

    def __init__(self, terms: list[str], fuzzy_from: int = FUZZY_FROM):
        letters = sorted({c for t in terms for c in t if c != "$"})
        self.classes = {c: i + 2 for i, c in enumerate(letters)}  # 0: no letter, 1: any other letter
        trie: list[dict] = [{}, {}]  # two roots: exact terms, terms with a spelling error
        ends: dict[int, int] = {}
        stems: dict[int, int] = {}
        for i, t in enumerate(terms):
            word, whole = t.rstrip("$"), t.endswith("$")
            node = 1 if whole and len(word) >= fuzzy_from else 0
            for c in word:
                if c not in trie[node]:
                    trie[node][c] = len(trie)
                    trie.append({})
                node = trie[node][c]
            (ends if whole else stems)[node] = i
        fuzzy = set()
        grow = [1]
        while grow:
            node = grow.pop()
            fuzzy.add(node)
            grow += trie[node].values()

        def closed(positions):
            """With letters left out of the word (an error each)."""
            out = set(positions)
            for node, e in positions:
                if node in fuzzy and e == 0:
                    out.update((child, 1) for child in trie[node].values())
            return frozenset(p for p in out if p[1] == 0 or (p[0], 0) not in out)

        def moved(positions, letter):
            out = set()
            for node, e in positions:
                child = trie[node].get(letter)
                if child is not None:
                    out.add((child, e))
                if node in fuzzy and e == 0:
                    out.update((c, 1) for c in trie[node].values())
                    out.add((node, 1))
            return closed(out)

        def accepted(positions, table):
            return min(((e, table[node]) for node, e in positions if node in table), default=None)

        outcomes: dict[tuple, int] = {}
        start = closed({(0, 0), (1, 0)})
        states, queue, rows = {start: 0}, [start], []
        while queue:
            now = queue.pop(0)
            row = []
            for letter in ["", None, *letters]:
                if letter == "":  # the word ends here
                    hit = accepted(now, ends)
                    row.append(("end", (hit[1], hit[0])) if hit else None)
                    continue
                to = moved(now, letter)
                stem = accepted(to, stems)
                if stem:
                    row.append(("end", (stem[1], stem[0])))
                elif to:
                    if to not in states:
                        states[to] = len(states)
                        queue.append(to)
                    row.append(("state", states[to]))
                else:
                    row.append(None)
            rows.append(row)
        for row in rows:
            for x in row:
                if x and x[0] == "end":
                    outcomes.setdefault(x[1], len(outcomes))
        self.accepts = list(outcomes)
        first = 2 + len(self.accepts)
        # The start is state 1; every state but it is numbered after the accepting ones.
        number = [1] + [first + i for i in range(len(rows) - 1)]
        self.step = np.zeros((first + max(0, len(rows) - 1), len(letters) + 2), np.int32)
        for i, row in enumerate(rows):
            for c, x in enumerate(row):
                if x:
                    self.step[number[i], c] = 2 + outcomes[x[1]] if x[0] == "end" else number[x[1]]

    def letter_classes(self) -> np.ndarray:
        """Class of every code point."""
        return _letter_classes(self.classes)

    def matches(self, text: str, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start of the word, accepted index) of every match in lower-case
        ``text``, in order, and where all words start."""
        cls, starts = _classed(text, classes)
        return *self.run(cls, starts), starts

    def run(self, cls: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start of the word, accepted index) of every match, in order, in a
        text given as letter classes."""
        at, begun = starts, starts
        state = np.ones(len(starts), np.int32)
        found_at, found = [], []
        while len(at):
            state = self.step[state, cls[at]]
            hit = (state >= 2) & (state < 2 + len(self.accepts))
            if hit.any():
                found_at.append(begun[hit])
                found.append(state[hit] - 2)
            on = (state > 0) & ~hit
            at, begun, state = at[on] + 1, begun[on], state[on]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        found_at, found = np.concatenate(found_at), np.concatenate(found)
        order = np.argsort(found_at, kind="stable")
        return found_at[order], found[order]


def _letter_classes(letters: dict[str, int]) -> np.ndarray:
    """Class of every code point: 0 no letter, 1 a letter not among ``letters``."""
    cache = worker_cache("letters")
    if "is" not in cache:
        cache["is"] = np.fromiter((chr(i).isalpha() for i in range(0x110000)), np.uint8, 0x110000)
    out = cache["is"].astype(np.uint8 if len(letters) < 250 else np.uint32)
    for c, i in letters.items():
        out[ord(c)] = i
    return out


def _classed(text: str, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the letters of ``text`` and of a blank, and where words start."""
    cls = classes[np.frombuffer((text + " ").encode("utf-32-le", "replace"), np.uint32)]
    letter = cls > 0
    return cls, np.flatnonzero(letter & ~np.concatenate(([False], letter[:-1])))


class Automata:
    """Automata of at most ``part_terms`` terms each that give the matches of a
    single one: in a word a stem, else the least distance and of these the first
    term.  ``accepts`` is (term, distance) as in ``Automaton``."""

    def __init__(self, terms: list[str], part_terms: int = PART_TERMS):
        order = sorted(range(len(terms)), key=lambda i: terms[i])  # neighbours share states
        self.accepts: list[tuple[int, int]] = []
        self.parts: list[tuple[Automaton, int]] = []  # with the number of its first outcome
        for i in range(0, len(order), part_terms):
            ids = sorted(order[i:i + part_terms])
            part = Automaton([terms[j] for j in ids])
            self.parts.append((part, len(self.accepts)))
            self.accepts += [(ids[t], e) for t, e in part.accepts]
        self.classes = {c: i + 2 for i, c in enumerate(sorted({c for p, _ in self.parts for c in p.classes}))}
        # Class in a part of every common class.
        self.own = [np.array([0, 1, *(p.classes.get(c, 1) for c in self.classes)], np.uint32) for p, _ in self.parts]
        rank = sorted(range(len(self.accepts)), key=lambda k: (terms[self.accepts[k][0]].endswith("$"), *self.accepts[k][::-1]))
        self.rank = np.empty(len(rank), np.int64)
        self.rank[rank] = np.arange(len(rank))

    def letter_classes(self) -> np.ndarray:
        """Class of every code point."""
        return _letter_classes(self.classes)

    def matches(self, text: str, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``Automaton.matches``."""
        cls, starts = _classed(text, classes)
        at, which = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for (part, first), own in zip(self.parts, self.own):
            found_at, found = part.run(own[cls] if len(self.parts) > 1 else cls, starts)
            at.append(found_at)
            which.append(found + first)
        at, which = np.concatenate(at), np.concatenate(which)
        if len(self.parts) > 1:
            order = np.lexsort((self.rank[which], at))
            at, which = at[order], which[order]
            best = np.concatenate(([True], at[1:] != at[:-1]))[:len(at)]
            at, which = at[best], which[best]
        return at, which, starts


def quoted(text: str, start: int, window: int = CONTEXT) -> bool:
    """Quotation marks on both sides of the word at ``start``, on its line and
    within ``window`` characters."""
    before = text[max(0, start - window):start].rpartition("\n")[2]
    after = text[start:start + window].partition("\n")[0]
    return bool(_QUOTES.search(before) and _QUOTES.search(after))


# -- scoring ---------------------------------------------------------------

def _hits(texts: list[str | None], automaton: Automata, classes: np.ndarray):
    """(words, [(accepted index, quoted)]) of each text; short texts are run
    together, so that the table look-ups work on long arrays."""
    out, i = [], 0
    while i < len(texts):
        some, size = [], 0
        while i < len(texts) and (not some or size < CHUNK):
            some.append((texts[i] or "").lower())
            size += len(some[-1])
            i += 1
        joined = "\n".join(some)
        begins = np.cumsum([0] + [len(t) + 1 for t in some])
        at, which, starts = automaton.matches(joined, classes)
        n_words = np.diff(np.searchsorted(starts, begins))
        own = [[] for _ in some]
        for k, p, w in zip((np.searchsorted(begins, at, "right") - 1).tolist(), at.tolist(), which.tolist()):
            own[k].append((w, quoted(joined, p)))
        out += list(zip(n_words.tolist(), own))
    return out


def _features(n_words: int, hits: list, weights: np.ndarray) -> list[float]:
    """Strongest match, summed matches, density."""
    if not hits:
        return [0.0, 0.0, 0.0]
    w = [weights[i] * (QUOTED_SHARE if q else 1.0) for i, q in hits]
    best = {}
    for (i, _), x in zip(hits, w):
        best[i] = max(best.get(i, -9.0), x)
    total = sum(max(0.0, x) for x in best.values())
    return [max(0.0, max(w)), math.log1p(total), math.log1p(100 * sum(max(0.0, x) for x in w) / max(20, n_words))]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights with the intercept last, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[-1] = 1e-3
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep), x.T @ (p - y) + keep * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _first_copies(hits: list[frozenset[int]]) -> list[int]:
    """Positions without the near copies of an earlier one: ``COPY_HITS`` or more
    matches, and at least half of all matches of both in common."""
    firsts, postings = [], {}
    for r, own in enumerate(hits):
        if len(own) >= COPY_HITS:
            shared = Counter(f for i in own for f in postings.get(i, ()))
            if any(2 * n >= len(own) + len(hits[f]) - n for f, n in shared.items()):
                continue
            for i in own:
                postings.setdefault(i, []).append(r)
        firsts.append(r)
    return firsts


class Model:
    """A fitted scorer: automata, weight of each accepted outcome, logistic weights."""

    def __init__(self, terms, weights=None, line=None):
        self.automaton, self.weights, self.line = Automata(terms), weights, line

    def score(self, texts: list[str | None], classes: np.ndarray) -> list[float]:
        x = np.array([_features(n, h, self.weights) for n, h in _hits(texts, self.automaton, classes)]).reshape(-1, 3)
        return (1 / (1 + np.exp(-np.clip(x @ self.line[:-1] + self.line[-1], -30, 30)))).tolist()


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model | float:
    """A model of labels.toxic from at most ``train_rows`` labelled documents, or
    the share of toxic ones as a constant score where nothing tells them apart:
    labels all alike (0 without any), or no significant term."""
    sample = written(labelled_sample(docs, labels, "toxic", train_rows), "toxic-sample")
    terms = lexicon(sample)
    if not terms:
        return float(sample.agg(F.avg("label")).first()[0] or 0.0)
    model = Model(terms)

    def run(batches):
        classes = model.automaton.letter_classes()
        for b in batches:
            found = _hits(b["text"], model.automaton, classes)
            yield {"label": b["label"], "n_words": [n for n, _ in found], "which": [[i for i, _ in h] for _, h in found],
                   "quoted": [[q for _, q in h] for _, h in found]}

    rows = map_rows(sample.select("text", "label"), run,
                    "label int, n_words bigint, which array<int>, quoted array<boolean>").collect()  # at most train_rows
    # Copies of one toxic document are evidence once: their rarer words are no terms of their own.
    docs_with = [Counter(), Counter()]
    toxic = [frozenset(r.which) for r in sorted(rows, key=lambda r: (r.n_words, r.which)) if r.label]
    firsts = _first_copies(toxic)
    for i in firsts:
        docs_with[1].update(toxic[i])
    for r in rows:
        if not r.label:
            docs_with[0].update(set(r.which))
    n1, n0 = max(1, len(firsts)), max(1, len(rows) - len(toxic))
    accepts = model.automaton.accepts

    def odds(i: int) -> float:
        return float(np.clip(math.log((docs_with[1][i] + 0.5) / (n1 + 1) * (n0 + 1) / (docs_with[0][i] + 0.5)), -3, 6))

    exact = {term: odds(i) for i, (term, distance) in enumerate(accepts) if distance == 0}
    # A misspelling that the sample never has counts as most of its term.
    model.weights = np.array([odds(i) if docs_with[0][i] + docs_with[1][i] else MISSPELT * exact.get(term, 0.0)
                              for i, (term, _) in enumerate(accepts)])
    x = np.array([_features(r.n_words, list(zip(r.which, r.quoted)), model.weights) for r in rows])
    model.line = _logistic(x, np.array([float(r.label) for r in rows]))
    return model


def toxicity(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, score) of every row of ``docs`` (doc_id, text)."""
    model = fit(docs, labels, train_rows)
    docs = docs.select("doc_id", "text")
    if isinstance(model, float):
        return docs.select("doc_id", F.lit(model).alias("score"))
    sent = shared(docs.sparkSession, model)

    def run(batches):
        model = sent()
        classes = model.automaton.letter_classes()
        for b in batches:
            yield {"doc_id": b["doc_id"], "score": model.score(b["text"], classes)}

    return map_rows(docs, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def clean_documents(docs: DataFrame, labels: DataFrame, reject_from: float = 0.5,
                    train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Rows of ``docs``, all columns, with a score below ``reject_from``."""
    model = fit(docs, labels, train_rows)
    if isinstance(model, float):
        return docs if model < reject_from else docs.limit(0)
    sent = shared(docs.sparkSession, model)

    def keep(texts):
        return [s < reject_from for s in sent().score(texts, sent().automaton.letter_classes())]

    return filter_rows(docs, keep)


def op4_toxicity(spark, sf_dir):
    """All documents scored for labels.toxic."""
    scored = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
