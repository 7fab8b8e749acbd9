"""DuckDB spellings of the text expressions, for the oracle SQL.

Each builder mirrors one column function of ``textmill.functions.text`` and
reads the same fixed values, so the Spark plan and the oracle cannot drift
apart silently.  RE2 has no look-around, hence the explicit chains here.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from textmill.functions.text import (
    BOILERPLATE_PHRASES,
    CLEAN_LEAD_REWRITES,
    CLEAN_TAIL_REWRITES,
    FUSED_WORDS,
    KEEP_ASCII_LETTERS,
    NON_WORD,
    PUNCTUATION,
    SHORTEN_AT,
)
from textmill.sources.stopwords import stop_words, topic_stop_words


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def str_list(words: Iterable[str]) -> str:
    return "[" + ", ".join(lit(w) for w in words) + "]"


def lower_sql(expr: str) -> str:
    # Python and Java lower-case the dotted capital I to "i" + combining dot;
    # DuckDB to a bare "i".  Spell out the two-character form.
    return f"lower(replace({expr}, {lit(chr(304))}, 'i' || chr(775)))"


def clean_sql(expr: str, strip_boilerplate: bool = False) -> str:
    c = lower_sql(expr)
    pairs = list(CLEAN_LEAD_REWRITES)
    if strip_boilerplate:
        pairs += [(p.lower(), "") for p in BOILERPLATE_PHRASES]
    pairs += CLEAN_TAIL_REWRITES
    for a, b in pairs:
        c = f"replace({c}, {lit(a)}, {lit(b)})"
    c = f"regexp_replace({c}, {lit(NON_WORD)}, ' ', 'g')"
    c = f"regexp_replace({c}, {lit(KEEP_ASCII_LETTERS)}, '', 'g')"
    return f"trim({c})"


def banned_list(stop_words: Sequence[str]) -> str:
    return str_list(sorted(set(stop_words) | set(PUNCTUATION)))


def words_sql(clean_expr: str) -> str:
    c = clean_expr
    for a, b in FUSED_WORDS:
        c = f"regexp_replace({c}, {lit(chr(92) + 'b' + a + b + chr(92) + 'b')}, {lit(a + ' ' + b)}, 'g')"
    return f"list_filter(string_split({c}, ' '), lambda x: x <> '')"


def tokens_sql(expr: str, stop_words: Sequence[str] | None = None, strip_boilerplate: bool = False) -> str:
    stop = list(stop_words) if stop_words is not None else topic_stop_words()
    w = words_sql(clean_sql(expr, strip_boilerplate))
    return f"list_filter({w}, lambda x: NOT list_contains({banned_list(stop)}, x))"


def kept_terms_sql(tokens_expr: str) -> str:
    stop = str_list(sorted(set(stop_words("en"))))
    return f"list_filter({tokens_expr}, lambda x: length(x) >= 2 AND NOT list_contains({stop}, x))"


def pairs_sql(kept_expr: str) -> str:
    return (f"list_transform(range(1, len({kept_expr})), "
            f"lambda i: {kept_expr}[i] || ' ' || {kept_expr}[i + 1])")


def shorten_sql(expr: str, width: int = SHORTEN_AT) -> str:
    return f"CASE WHEN length({expr}) >= {width} THEN left({expr}, {width}) || '...' ELSE {expr} END"


def dedup_sql(cols: str = "doc_id, text, lang, source") -> str:
    """Keep-first dedup of documents by text, as a subquery."""
    return (f"(SELECT {cols} FROM (SELECT {cols}, row_number() OVER "
            f"(PARTITION BY text ORDER BY doc_id) AS rn FROM documents WHERE text IS NOT NULL) "
            f"WHERE rn = 1)")


def corpus_sql(max_chars: int | None = None, languages: Sequence[str] = ("en",),
               extra_cols: str = "") -> str:
    """SQL of ``plans.corpus.article_corpus``: doc_id, source, lang, text, tokens."""
    band = "length(text) > 140" + (f" AND length(text) <= {max_chars}" if max_chars else "")
    lang = f" AND lang IN ({', '.join(lit(x) for x in languages)})" if languages else ""
    extra = f", {extra_cols}" if extra_cols else ""
    detected = (f"(SELECT d.* REPLACE (coalesce(g.language, 'Error') AS lang) FROM {dedup_sql()} d LEFT JOIN "
                f"({gram_language_sql()}) g ON d.doc_id = g.doc_id)" if languages else dedup_sql())
    return (f"SELECT doc_id, source, lang, text{extra}, {tokens_sql('text')} AS tokens "
            f"FROM {detected} WHERE {band}{lang}")


def gram_profile_sql() -> str:
    """CTEs of ``operators.ngrams.learn_profiles`` over documents: ``gw(lang,
    gram, weight)``, and ``gt(doc_id, gram, n)`` of all documents."""
    from textmill.operators.ngrams import PROFILE_GRAMS, SAMPLE_ROWS, UNSEEN

    letters = f"regexp_replace({lower_sql('text')}, {lit(chr(92) + 'P{L}+')}, ' ', 'g')"
    return (f"gl AS (SELECT doc_id, ' ' || trim({letters}) || ' ' AS s FROM documents WHERE text IS NOT NULL), "
            f"gt AS (SELECT doc_id, gram, count(*) AS n FROM (SELECT doc_id, unnest(list_transform(range(1, length(s) - 1), "
            f"lambda i: substr(s, i, 3))) AS gram FROM gl) GROUP BY ALL), "
            f"gs AS (SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY "
            f"md5(doc_id::VARCHAR), doc_id) AS rn FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL) WHERE rn <= {SAMPLE_ROWS}), "
            f"gc AS (SELECT lang, gram, sum(n) AS n FROM gs JOIN gt ON gs.doc_id = gt.doc_id GROUP BY ALL), "
            f"gv AS (SELECT DISTINCT gram FROM (SELECT gram, row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) AS rn "
            f"FROM gc) WHERE rn <= {PROFILE_GRAMS}), "
            f"gn AS (SELECT lang, sum(n) AS total FROM gc GROUP BY lang), "
            f"gw AS (SELECT gn.lang, gv.gram, CAST(round(1000 * ln((coalesce(gc.n, 0) + {UNSEEN}) / (gn.total + {UNSEEN} * "
            f"(SELECT count(*) FROM gv)))) AS BIGINT) AS weight FROM gn CROSS JOIN gv LEFT JOIN gc ON gc.lang = gn.lang AND gc.gram = gv.gram)")


def gram_language_sql() -> str:
    """SQL of ``operators.ngrams`` over documents: doc_id, language (texts
    without a known trigram are missing)."""
    return (f"WITH {gram_profile_sql()}, "
            f"ge AS (SELECT gt.doc_id, gw.lang, sum(gt.n * gw.weight) AS e FROM gt JOIN gw ON gt.gram = gw.gram GROUP BY ALL) "
            f"SELECT doc_id, lang AS language FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY doc_id ORDER BY e DESC, lang) "
            f"AS rn FROM ge) WHERE rn = 1")


def language_sql(expr: str) -> str:
    """SQL of ``operators.language.language_of``."""
    from textmill.operators.language import UNDETECTED, WORD_SPLIT
    from textmill.sources.stopwords import language_profiles

    words = f"string_split_regex({lower_sql(expr)}, {lit(WORD_SPLIT)})"
    profiles: dict[str, list[str]] = {}
    for code, word in language_profiles():
        profiles.setdefault(code, []).append(word)
    n = {code: f"len(list_filter({words}, lambda x: x IN ({', '.join(map(lit, ws))})))" for code, ws in sorted(profiles.items())}
    best = f"greatest({', '.join(n.values())})"
    whens = " ".join(f"WHEN {c} = {best} THEN {lit(code)}" for code, c in n.items())
    return f"CASE WHEN coalesce({best}, 0) = 0 THEN {lit(UNDETECTED)} {whens} END"


def sentiment_tokens_sql(expr: str, stop_words: Sequence[str] = ()) -> str:
    """SQL of ``functions.text.sentiment_tokens``."""
    from textmill.functions.text import (
        CLITIC_PATTERN,
        MENTION_PATTERN,
        NEGATION_PATTERN,
        NON_TOKEN,
        URL_PATTERN,
    )

    c = f"regexp_replace({expr}, {lit(URL_PATTERN)}, ' ', 'g')"
    c = f"regexp_replace({c}, {lit(MENTION_PATTERN)}, ' ', 'g')"
    c = lower_sql(c)
    c = f"regexp_replace({c}, {lit(NEGATION_PATTERN)}, {lit(" n't")}, 'g')"
    c = f"regexp_replace({c}, {lit(CLITIC_PATTERN)}, {lit(r"\1 '\2")}, 'g')"
    c = f"regexp_replace({c}, {lit(NON_TOKEN)}, ' ', 'g')"
    return (f"list_filter(string_split(trim({c}), ' '), lambda x: x <> '' AND "
            f"NOT list_contains({banned_list(stop_words)}, x))")
