"""Queries for scans, filters, scalar functions, lookups, counts and windows.

Time parameters are fixed so results are reproducible: the article window
ends at ``AS_OF`` (inside the span of ``events.ts``) and reaches back
``WINDOW_DAYS``.  ``events`` stands in for stamped batches: one batch per
day, named by the day's stamp.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from textmill.functions.stamps import (
    ISO_FORMAT_SQL,
    NEWS_BASE_URL,
    SOURCE_CHUNK_SIZE,
    STAMP_FORMAT_SQL,
    absolute_url,
    day_of,
    iso,
    stamp,
)
from textmill.functions.text import ascii_fold, clean_text, shorten, strip_non_ascii
from textmill.operators.counts import counts_rollup, daily_counts, sliding_counts
from textmill.operators.dedup import dedup_keep_first, distinct_rows
from textmill.operators.filters import (
    API_MAX_CHARS,
    BLOCKED_HOSTS,
    MIN_CHARS_EXCLUSIVE,
    drop_any_null,
    length_band,
    not_blocked,
)
from textmill.operators.indexing import chunk_lists
from textmill.operators.lookup import NO_CATEGORY, lookup_with_default
from textmill.plans.catalog import register
from textmill.plans.sqltext import clean_sql, dedup_sql, lit, lower_sql, shorten_sql
from textmill.sources.batches import day_batches, high_water_mark, select_window, union_batches
from textmill.sources.tables import table

AS_OF = datetime(2024, 1, 15, 12, 0, 0)
WINDOW_DAYS = 7
SPLIT_DAYS = 13
SPLIT_YEAR = 2024
SCRAPED_AT = datetime(2024, 1, 15, 12, 0, 0)

_TS = lambda d: f"TIMESTAMP '{d:%Y-%m-%d %H:%M:%S}'"


def _event_batches(spark, sf_dir, *cols):
    ev = table(spark, sf_dir, "events", *cols)
    return ev.withColumn("batch_stamp", stamp(F.date_trunc("day", "ts")))


_BATCH_SQL = f"strftime(date_trunc('day', ts), '{STAMP_FORMAT_SQL}')"


# -- S1 window scan ----------------------------------------------------------

@register("window_scan", lambda: (
    f"SELECT event_id, event_type, {_BATCH_SQL} AS batch_stamp FROM events "
    f"WHERE {_BATCH_SQL} >= '{AS_OF - timedelta(days=WINDOW_DAYS):%Y-%m-%dT%H%M%S}' "
    f"AND {_BATCH_SQL} < '{AS_OF:%Y-%m-%dT%H%M%S}'"))
def q_window_scan(spark, sf_dir):
    ev = _event_batches(spark, sf_dir, "event_id", "event_type", "ts")
    # A batch is a whole day, so the window lies in a range of ts, which the scan
    # can prune by; the stamps decide within it.
    first, last = (f"{d:%Y-%m-%d}" for d in (AS_OF - timedelta(days=WINDOW_DAYS), AS_OF + timedelta(days=1)))
    ev = ev.filter(F.expr(f"ts >= TIMESTAMP_NTZ '{first} 00:00:00' AND ts < TIMESTAMP_NTZ '{last} 00:00:00'"))
    return select_window(ev, AS_OF - timedelta(days=WINDOW_DAYS), AS_OF).drop("ts")


# -- S6 day split (+ P10 year predicate) ----------------------------------------

def _day_split_sql() -> str:
    now = _TS(AS_OF)
    return (f"WITH b AS (SELECT (epoch_us({now}) - epoch_us(ts) + 86399999999) // 86400000000 AS d "
            f"FROM events WHERE ts < {now} AND year(ts) = {SPLIT_YEAR}) "
            f"SELECT strftime(make_timestamp(epoch_us({now}) - (d - 1) * 86400000000), "
            f"'{STAMP_FORMAT_SQL}') AS batch_name, count(*) AS n FROM b "
            f"WHERE d BETWEEN 1 AND {SPLIT_DAYS} GROUP BY 1")


@register("day_split_counts", _day_split_sql)
def q_day_split_counts(spark, sf_dir):
    ev = table(spark, sf_dir, "events", "event_id", "ts")
    return (day_batches(ev, AS_OF, SPLIT_DAYS, "ts", year=SPLIT_YEAR)
            .groupBy("batch_name").agg(F.count(F.lit(1)).alias("n")))


# -- S8 high-water mark, P9 since cut-off ----------------------------------------

@register("high_water_mark_listing", lambda: f"SELECT max({_BATCH_SQL}) AS last_stamp FROM events")
def q_high_water_mark_listing(spark, sf_dir):
    """S8 from the names of written batches alone."""
    from textmill.session import scratch_path
    from textmill.sources.batches import write_batches
    from textmill.sources.results import latest_batch

    path = scratch_path(spark, "batches")
    write_batches(_event_batches(spark, sf_dir, "event_id", "ts").withColumnRenamed("batch_stamp", "batch_name"), path)
    return latest_batch(spark, path)


@register("high_water_mark", lambda: (
    f"SELECT coalesce(max({_BATCH_SQL}), '{AS_OF - timedelta(days=7):%Y-%m-%dT%H%M%S}') AS last_stamp, "
    f"strftime(strptime(coalesce(max({_BATCH_SQL}), '{AS_OF - timedelta(days=7):%Y-%m-%dT%H%M%S}'), "
    f"'{STAMP_FORMAT_SQL}'), '{ISO_FORMAT_SQL}') AS last_iso FROM events"))
def q_high_water_mark(spark, sf_dir):
    ev = _event_batches(spark, sf_dir, "ts")
    return (high_water_mark(ev, AS_OF - timedelta(days=7))
            .select("last_stamp", iso("last_ts").alias("last_iso")))


@register("since_cutoff", lambda: (
    "SELECT event_id, event_type FROM events WHERE ts >= "
    "(SELECT max(date_trunc('day', ts)) FROM events)"))
def q_since_cutoff(spark, sf_dir):
    ev = table(spark, sf_dir, "events", "event_id", "event_type", "ts")
    cutoff = ev.select(F.max(F.date_trunc("day", "ts"))).scalar()
    return ev.filter(F.col("ts") >= cutoff).select("event_id", "event_type")


# -- P3 drop rows with any null -------------------------------------------------

@register("drop_any_null", lambda: (
    "SELECT d.doc_id, d.source, l.quality, l.toxic FROM documents d LEFT JOIN labels l "
    "ON d.doc_id = l.doc_id WHERE d.doc_id IS NOT NULL AND d.source IS NOT NULL "
    "AND l.quality IS NOT NULL AND l.toxic IS NOT NULL"))
def q_drop_any_null(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "source")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    return drop_any_null(docs.join(labels, "doc_id", "left"))


# -- P4 length band (API preset), P15 shorten ---------------------------------------

@register("length_band", lambda: (
    f"SELECT doc_id, length(text) AS n_cp FROM documents WHERE length(text) > {MIN_CHARS_EXCLUSIVE} "
    f"AND length(text) <= {API_MAX_CHARS}"))
def q_length_band(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return (length_band(docs, "text", MIN_CHARS_EXCLUSIVE, API_MAX_CHARS)
            .select("doc_id", F.length("text").cast("bigint").alias("n_cp")))


@register("shorten", lambda: f"SELECT doc_id, {shorten_sql('text')} AS label FROM documents")
def q_shorten(spark, sf_dir):
    return table(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id", shorten("text").alias("label"))


# -- F2, F5, F6 -------------------------------------------------------------------

@register("strip_boilerplate", lambda: (
    f"SELECT doc_id, {clean_sql('text', strip_boilerplate=True)} AS clean FROM documents"))
def q_strip_boilerplate(spark, sf_dir):
    return table(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id", clean_text("text", strip_boilerplate=True).alias("clean"))


@register("strip_non_ascii", lambda: (
    "SELECT doc_id, regexp_replace(text, '[^\\x00-\\x7F]', '', 'g') AS ascii_text FROM documents"))
def q_strip_non_ascii(spark, sf_dir):
    return table(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id", strip_non_ascii("text").alias("ascii_text"))


@register("ascii_fold", lambda: (
    f"SELECT doc_id, regexp_replace(translate(text, '“”', {lit(chr(39) * 2)}), '[^\\x00-\\x7F]', ' ', 'g') "
    "AS folded FROM documents"))
def q_ascii_fold(spark, sf_dir):
    return table(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id", ascii_fold("text").alias("folded"))


# -- F7, F8 stamps ----------------------------------------------------------------

@register("stamp_format", lambda: (
    f"SELECT event_id, strftime(ts, '{STAMP_FORMAT_SQL}') AS stamp, strftime(ts, '%Y-%m-%d') AS day, "
    f"strftime(ts, '{ISO_FORMAT_SQL}') AS iso FROM events"))
def q_stamp_format(spark, sf_dir):
    ev = table(spark, sf_dir, "events", "event_id", "ts")
    return ev.select("event_id", stamp("ts").alias("stamp"), day_of("ts").alias("day"),
                     iso("ts").alias("iso"))


# -- F10 absolute links of pages ------------------------------------------------------

HREF = r'href="([^"]*)"'


@register("absolute_url", lambda: (
    f"SELECT page_id, href, {lit(NEWS_BASE_URL)} || substring(href, 2) AS url FROM "
    f"(SELECT page_id, unnest(regexp_extract_all(html, {lit(HREF)}, 1)) AS href FROM pages)"))
def q_absolute_url(spark, sf_dir):
    pages = table(spark, sf_dir, "pages", "page_id", "html")
    links = (pages.select("page_id", F.explode_outer(F.regexp_extract_all("html", F.lit(HREF), 1))
                          .alias("href"))
             .filter(F.col("href").isNotNull()))
    return links.select("page_id", "href", absolute_url("href").alias("url"))


# -- F11 chunked source lists -------------------------------------------------------

@register("chunked_lists", lambda: (
    f"SELECT idx // {SOURCE_CHUNK_SIZE} AS chunk, string_agg(source, ',' ORDER BY source) AS members "
    f"FROM (SELECT source, row_number() OVER (ORDER BY source) - 1 AS idx FROM "
    f"(SELECT DISTINCT source FROM documents WHERE source IS NOT NULL)) GROUP BY 1"))
def q_chunked_lists(spark, sf_dir):
    return chunk_lists(table(spark, sf_dir, "documents", "source"), "source", SOURCE_CHUNK_SIZE)


# -- J1 lookup with default ----------------------------------------------------------

@register("category_lookup", lambda: (
    f"SELECT e.event_id, coalesce(c.category, '{NO_CATEGORY}') AS category FROM events e LEFT JOIN "
    f"(SELECT n.n_nationkey AS id, min(r.r_name) AS category FROM nation n JOIN region r "
    f"ON n.n_regionkey = r.r_regionkey GROUP BY 1) c ON e.user_id = c.id"))
def q_category_lookup(spark, sf_dir):
    """Source catalogue = nation -> region name; events' user ids beyond the
    catalogue fall back to NC."""
    nation = table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region", "r_regionkey", "r_name")
    cat = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("bigint").alias("id"), F.col("r_name").alias("category"))
    ev = table(spark, sf_dir, "events", "event_id", "user_id")
    return (lookup_with_default(ev, cat, "user_id", "id", "category", "category")
            .select("event_id", "category"))


# -- A8 counts with total -----------------------------------------------------------------

@register("counts_rollup", lambda: (
    "SELECT event_type, count(*) AS n FROM events GROUP BY ROLLUP (event_type)"))
def q_counts_rollup(spark, sf_dir):
    return counts_rollup(table(spark, sf_dir, "events", "event_type"), "event_type")


# -- U1 union by name ---------------------------------------------------------------------

@register("union_batches", lambda: (
    "SELECT 'documents' AS origin, doc_id AS id, NULL::BIGINT AS turn, NULL::VARCHAR AS role, source, "
    "length(text) AS n_cp FROM documents UNION ALL "
    "SELECT 'conversations', conv_id, turn, role, NULL, length(text) FROM conversations UNION ALL "
    "SELECT 'benchmark', item_id, NULL, NULL, NULL, length(text) FROM benchmark"))
def q_union_batches(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text").select(
        F.lit("documents").alias("origin"), F.col("doc_id").alias("id"), "source", "text")
    conv = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").select(
        F.lit("conversations").alias("origin"), F.col("conv_id").alias("id"), "turn", "role", "text")
    bench = table(spark, sf_dir, "benchmark", "item_id", "text").select(
        F.lit("benchmark").alias("origin"), F.col("item_id").alias("id"), "text")
    u = union_batches([docs, conv, bench])
    return u.select("origin", "id", "turn", "role", "source",
                    F.length("text").cast("bigint").alias("n_cp"))


# -- S5 JSON payload flatten + P12 constant columns ----------------------------------------

@register("json_flatten", lambda: (
    f"SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, '{NO_CATEGORY}' AS category, "
    f"{_TS(SCRAPED_AT)} AS scraping_date FROM events"))
def q_json_flatten(spark, sf_dir):
    ev = table(spark, sf_dir, "events", "event_id", "props")
    return ev.select("event_id", F.from_json("props", "k bigint").alias("p")).select(
        "event_id", F.col("p.k").alias("k"), F.lit(NO_CATEGORY).alias("category"),
        F.lit(SCRAPED_AT).cast("timestamp").alias("scraping_date"))


# -- A5 dedup keep-first, A6 distinct --------------------------------------------------------

@register("dedup_keep_first", lambda: f"SELECT doc_id, lang, source FROM {dedup_sql()}")
def q_dedup_keep_first(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source").filter(
        F.col("text").isNotNull())
    return dedup_keep_first(docs, "text", ["doc_id"]).select("doc_id", "lang", "source")


@register("distinct_rows", lambda: (
    "SELECT lang, source, length(text) AS n_cp FROM (SELECT DISTINCT lang, source, text FROM documents)"))
def q_distinct_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "lang", "source", "text")
    return distinct_rows(docs).select("lang", "source", F.length("text").cast("bigint").alias("n_cp"))


# -- P7 blocked hosts --------------------------------------------------------------------------

@register("blocked_hosts", lambda: (
    "SELECT page_id, url FROM pages WHERE "
    + " AND ".join(f"NOT contains(url, {lit(h)})" for h in BLOCKED_HOSTS)))
def q_blocked_hosts(spark, sf_dir):
    return not_blocked(table(spark, sf_dir, "pages", "page_id", "url"), "url", BLOCKED_HOSTS)


# -- T3 daily and 7-day sliding counts (batch form of the streaming query) -----------------

@register("daily_window", lambda: (
    "SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, "
    "event_type, count(*) AS n FROM events GROUP BY 1, 2, 3"))
def q_daily_window(spark, sf_dir):
    return daily_counts(table(spark, sf_dir, "events", "ts", "event_type"), "ts", "event_type")


@register("weekly_sliding", lambda: (
    "SELECT s AS window_start, s + INTERVAL 7 DAY AS window_end, event_type, count(*) AS n FROM "
    "(SELECT date_trunc('day', ts) - to_days(CAST(i AS INTEGER)) AS s, event_type FROM events, "
    "range(0, 7) t(i)) GROUP BY 1, 2, 3"))
def q_weekly_sliding(spark, sf_dir):
    return sliding_counts(table(spark, sf_dir, "events", "ts", "event_type"), "ts", "event_type")


__all__ = ["AS_OF", "WINDOW_DAYS", "lower_sql"]
