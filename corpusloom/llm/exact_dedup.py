"""Exact deduplication by skew-safe combining.

Three stages, each an aggregation whose key holds the whole text beside its digest, so content is compared in full
every time and the digest only decides where rows go:

1. local: the map side of the first aggregation leaves one row for a text in each input partition;
2. salted: those rows meet in groups of (digest, salt, text), the salt being the input partition's number modulo
   ``salts``, so even a text that every partition holds is spread over ``salts`` groups;
3. global: the salt winners, at most ``salts`` for a text, are combined.

Null and empty texts: all null texts are one group and all empty texts another. Repeated rows (also of one doc_id)
are copies. The smallest doc_id stays (a null doc_id only where all are null). An empty table gives an empty result.
Columns that the input has besides ``doc_id`` and ``text`` don't matter, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 64


def _combined(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.min("_first").alias("_first"), F.sum("_n").alias("_n"))


def exact_groups(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row for each distinct text: ``_digest``, ``_text``, ``_first`` (the doc_id that stays) and ``_n`` copies."""
    rows = docs.select(
        F.xxhash64("text").alias("_digest"), F.col("text").alias("_text"), F.pmod(F.spark_partition_id(), F.lit(salts)).alias("_salt"), F.col("doc_id").alias("_first"), F.lit(1).cast("bigint").alias("_n")
    )
    salted = _combined(rows, ["_digest", "_salt", "_text"])
    return _combined(salted, ["_digest", "_text"])


def exact_dedup(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The documents that stay: ``doc_id``, ``text_md5`` and ``n_copies``, the number of rows with that very text."""
    return exact_groups(docs, salts).select(F.col("_first").alias("doc_id"), F.md5("_text").alias("text_md5"), F.col("_n").alias("n_copies"))


def drop_copies(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """``docs`` with one row for each text, all columns of one and the same row, in the columns' order.

    The other columns travel as one struct through the three stages; of equal doc_ids the row with the smallest
    (doc_id, remaining orderable columns) stays, so the choice doesn't hang on the order of the rows.
    """
    plain = [f.name for f in docs.schema if f.name != "text"]
    orderable = [f"`{f.name}`" for f in docs.schema if f.name not in ("text", "doc_id") and f.dataType.typeName() not in ("map", "variant")]
    order = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(orderable)])
    maps = len(orderable) + 1 < len(plain)
    if maps:
        value = F.struct(*[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(plain)])
        rows = docs.select(F.xxhash64("text").alias("_digest"), F.col("text").alias("_text"), F.pmod(F.spark_partition_id(), F.lit(salts)).alias("_salt"), order.alias("_order"), value.alias("_rest"))
        for keys in (["_digest", "_salt", "_text"], ["_digest", "_text"]):
            rows = rows.groupBy(*keys).agg(F.min_by("_rest", "_order").alias("_rest"), F.min("_order").alias("_order"))
        got = {c: F.col(f"_rest.v{i}") for i, c in enumerate(plain)}
    else:
        rows = docs.select(F.xxhash64("text").alias("_digest"), F.col("text").alias("_text"), F.pmod(F.spark_partition_id(), F.lit(salts)).alias("_salt"), order.alias("_order"))
        for keys in (["_digest", "_salt", "_text"], ["_digest", "_text"]):
            rows = rows.groupBy(*keys).agg(F.min("_order").alias("_order"))
        got = {"doc_id": F.col("_order.b")} | {c.strip("`"): F.col(f"_order.c{i}") for i, c in enumerate(orderable)}
    got["text"] = F.col("_text")
    return rows.select(*[got[c].alias(c) for c in docs.columns])
