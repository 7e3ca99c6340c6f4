"""Per-document measures and their aggregates by nothing, domain, language or histogram value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def doc_measures(docs: DataFrame) -> DataFrame:
    """One row of measures a document; the input of all aggregates."""
    rows = docs.select("doc_id", "lang", "source", "text", T.words(F.col("text")).alias("w"), T.lines(F.col("text")).alias("l"))
    return rows.select(
        "doc_id", "lang", "source",
        F.length("text").cast("bigint").alias("n_chars"),
        F.size("w").cast("bigint").alias("n_words"),
        F.size("l").cast("bigint").alias("n_lines"),
        F.size(T.paragraphs(F.col("text"))).cast("bigint").alias("n_paragraphs"),
        T.sentence_count(F.col("text")).cast("bigint").alias("n_sentences"),
        F.aggregate("w", F.lit(0).cast("bigint"), lambda a, x: a + F.length(x)).alias("word_chars"),
        F.size(F.filter("l", lambda x: F.length(x) <= 30)).cast("bigint").alias("short_lines"),
        F.size(F.array_distinct("w")).cast("bigint").alias("distinct_words"),
    )


def summary(measures: DataFrame, column: str, by: list[str] | None = None) -> DataFrame:
    """count, total, mean, smallest and largest of a measure."""
    c = F.col(column)
    return measures.groupBy(*(by or [])).agg(
        F.count(c).alias("n"), F.sum(c).alias("total"), F.round(F.avg(c), 6).alias("mean"), F.min(c).alias("low"), F.max(c).alias("high")
    )


def top_groups(measures: DataFrame, key: Column, column: str, k: int) -> DataFrame:
    """The ``k`` groups with most rows (ties by key)."""
    out = measures.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"), F.sum(column).alias("total"), F.round(F.avg(column), 6).alias("mean"))
    return out.orderBy(F.desc("n"), "key").limit(k)


def histogram(values: DataFrame, column: str, digits: int = 1) -> DataFrame:
    return values.groupBy(F.round(F.col(column).cast("double"), digits).alias("value")).agg(F.count(F.lit(1)).alias("total"))


def merged(parts: DataFrame) -> DataFrame:
    """Merge partial (n, total, low, high) rows into one."""
    return parts.agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high")).withColumn("mean", F.round(F.try_divide(F.col("total").cast("double"), F.col("n").cast("double")), 6))
