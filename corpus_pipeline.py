"""A corpus pipeline of five operators, each working on all that the one before it kept.

Stages in order: quality rules and toxicity reject documents, exact dedup and the n-gram Jaccard join leave one document
of each group, and best-fit packing lays out what is left. Every stage's result is written as Parquet to the shared
folder and read again as the next one's ``docs``. Nulls, empty texts, repeated rows and empty tables are handled as the
operators' docstrings say; extra columns pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm.exact_dedup import drop_copies
from corpusloom.llm.ngram_join import keep_one_each
from corpusloom.llm.packing import best_fit_packing
from corpusloom.llm.quality_rules import keep_good
from corpusloom.llm.shared import fresh_path, table
from corpusloom.llm.toxicity import keep_ordinary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_ordinary(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_each(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return best_fit_packing(docs)


STAGES = [("quality_rules", quality), ("toxicity", toxicity), ("exact_dedup", exact), ("ngram_jaccard_join", near), ("best_fit_packing", packing)]

#: Compression distances can't be had in SQL, so the pipeline is tested against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for ``documents`` in ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
