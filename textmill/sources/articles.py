"""Article-shaped inputs: raw JSON pages, labelled text, source catalogue
(SURVEY S3, S5, S11, P12)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.operators.lookup import NO_CATEGORY, lookup_with_default

# Schema of one page of the article API: every field of its payload, since rows
# with any null are dropped later (P3).  Pass a wider schema for further fields.
PAGE_SCHEMA = ("status string, totalResults bigint, "
               "articles array<struct<source: struct<id: string, name: string>, author: string, "
               "title: string, description: string, url: string, urlToImage: string, "
               "publishedAt: string, content: string>>, _corrupt_record string")
CATALOGUE_SCHEMA = "sources array<struct<id: string, name: string, category: string, language: string>>"
LABELLED_SCHEMA = "label string, text string, _corrupt_record string"
# Fixed value: the labels the sentiment training file may hold.
SENTIMENT_LABELS = ["positive", "neutral", "negative"]


def read_pages(spark: SparkSession, path: str, schema: str = PAGE_SCHEMA) -> DataFrame:
    """Raw API pages, one JSON document per line; malformed lines keep their
    text in ``_corrupt_record``."""
    return (spark.read.schema(schema)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record")
            .json(path))


def flatten_pages(pages: DataFrame, scraped_at: datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """S5 + U2 + P12: one row per article, ``source`` = ``source.id``.

    Returns ``(articles, rejects)``: a page without an ``articles`` array
    goes to the reject output instead of aborting the whole run.
    """
    ok = pages.filter(F.col("articles").isNotNull())
    rejects = pages.filter(F.col("articles").isNull())
    arts = ok.select(F.explode_outer("articles").alias("a")).filter(F.col("a").isNotNull())
    arts = arts.select("a.*").withColumn("source", F.col("source.id"))
    if scraped_at is not None:
        arts = arts.withColumn("scraping_date", F.lit(scraped_at).cast("timestamp"))
    return arts, rejects


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Source catalogue ``id, category``."""
    return (spark.read.schema(CATALOGUE_SCHEMA).json(path)
            .select(F.explode_outer("sources").alias("s"))
            .filter(F.col("s").isNotNull())
            .select(F.col("s.id").alias("id"), F.col("s.category").alias("category")))


def label_articles(articles: DataFrame, catalogue: DataFrame) -> DataFrame:
    """J1 applied to articles: category from the catalogue, else ``NC``."""
    return lookup_with_default(articles, catalogue, "source", "id", "category", "category", NO_CATEGORY)


def read_labelled(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """S3: headerless ISO-8859-1 CSV ``label, text``.

    Returns ``(rows, rejects)``; rows with a label outside the three known
    ones are rejected (the reference stops with a KeyError on them).
    """
    df = (spark.read.schema(LABELLED_SCHEMA)
          .option("header", "false").option("encoding", "ISO-8859-1")
          .option("multiLine", "true").option("escape", '"')
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
          .csv(path))
    good = F.col("label").isin(SENTIMENT_LABELS) & F.col("_corrupt_record").isNull()
    rows = df.filter(good).select("label", "text")
    rejects = df.filter(~good | F.col("label").isNull())
    return rows, rejects
