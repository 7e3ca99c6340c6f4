"""The filter chain of a corpus: every document with the first reason for which it is rejected.

One narrow pass works out all verdicts that a document's own text and address decide: no join but that with the
blocklist, no shuffle where the list is small enough for a broadcast. The perplexity filter needs the corpus; it works
on what the others keep.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import filters
from ..sources.shared import stored

REASONS = ("url", "language", "gopher_rep", "gopher_quality", "c4", "fineweb", "flagged_words", "perplexity", "kept")


def reasons(docs: DataFrame, blocked: tuple[str, ...] = (), max_dup_lines: float = 0.3) -> DataFrame:
    """``docs`` with ``reason``: url, gopher_rep, gopher_quality or kept, in this order.

    The short chain: sources in ``blocked``, repeated lines, quality. Repeated, null and tied ids are no matter.
    """
    lines = T.lines(F.col("text"))
    dup = filters.share(F.size(lines) - F.size(F.array_distinct(lines)), F.size(lines))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "text", "source", dup.alias("_dup"))
    judged = filters.gopher_quality(rows, carry=("_row", "source", "_dup"))
    reason = F.when(F.col("source").isin(*blocked), "url").when(F.col("_dup") > max_dup_lines, "gopher_rep").when(~F.col("keep"), "gopher_quality").otherwise("kept")
    return judged.select("_row.*", F.coalesce(reason, F.lit("kept")).alias("reason"))


def judge(
    docs: DataFrame, url: Column, blocklist: DataFrame, languages: dict[str, tuple[str, ...]], accept: tuple[str, ...], flagged: dict[str, dict[str, int | None]],
    whitelist: tuple[str, ...] = (), language_threshold: float = 0.05, quality: dict | None = None, c4: dict | None = None, short_line: int = 20, flagged_threshold: float = 0.01, flagged_keep: float = 0.1,
) -> DataFrame:
    """``docs`` with ``text`` as the chain leaves it, ``detected`` and ``reason``: the first filter that rejects, or kept.

    Filters in order: blocked address (whitelisted sites pass), language, repetition, quality, C4 (which edits the text
    that later filters see), FineWeb and flagged words by the language found. Null texts count as empty ones; repeated
    rows are judged each. Columns other than ``doc_id`` and ``text`` pass through, whatever their names.
    """
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"), url.alias("_url"))
    rows = filters.blocked_domains(rows, F.col("_url"), blocklist, "_blocked")
    rows = rows.select("_row", "doc_id", "text", (~filters.with_whitelist(F.col("_blocked"), F.col("_url"), whitelist)).alias("_url"), filters.language_of(F.col("text"), languages).alias("_lang"))
    carry = ("_row", "_url", "_lang")
    rows = filters.gopher_repetition(rows, (*carry, "text")).select("doc_id", "text", *carry, (~F.col("keep")).alias("_rep"))
    carry += ("_rep",)
    rows = filters.gopher_quality(rows, carry=(*carry, "text"), **(quality or {})).select("doc_id", "text", *carry, (~F.col("keep")).alias("_quality"))
    carry += ("_quality",)
    rows = filters.c4_quality(rows, carry=carry, **(c4 or {})).select("doc_id", F.col("text_out").alias("text"), *carry, (~F.col("keep")).alias("_c4"))
    carry += ("_c4",)
    rows = filters.fineweb_quality(rows, short_line, (*carry, "text")).select("doc_id", "text", *carry, (~F.col("keep")).alias("_fineweb"), F.col("_lang.detected").alias("detected"))
    carry += ("_fineweb", "detected")
    rows = filters.flagged_words(rows, flagged, flagged_threshold, flagged_keep, mode="syllables", carry=(*carry, "text"), lang="detected")
    foreign = ~(F.col("detected").isin(*accept) & (F.col("_lang.score") >= language_threshold))
    reason = F.lit("kept")
    for name, rejects in reversed((("url", F.col("_url")), ("language", foreign), ("gopher_rep", F.col("_rep")), ("gopher_quality", F.col("_quality")), ("c4", F.col("_c4")), ("fineweb", F.col("_fineweb")), ("flagged_words", ~F.col("keep")))):
        reason = F.when(rejects, name).otherwise(reason)
    return rows.select(*[F.col("text") if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns], "detected", reason.alias("reason"))


def perplexity_filter(docs: DataFrame, model: DataFrame, url: Column, whitelist: tuple[str, ...] = (), low: float = 0.2, high: float = 0.8, keep_fraction: float = 0.1) -> DataFrame:
    """``docs`` with ``ppl`` and ``keep``: within the quantiles, or kept by hash, or from a whitelisted site or none.

    Ids name the documents. Texts without words have a null score and stay.
    """
    scores = stored(filters.perplexity(docs, model), "perplexity")
    judged = filters.quantile_filter(scores, "ppl", low, high, keep_fraction).select(F.col("doc_id").alias("_id"), F.col("ppl").alias("_ppl"), F.col("keep").alias("_keep"))
    rows = docs.join(judged, docs["doc_id"] == judged["_id"], "left")
    keep = filters.with_whitelist(~F.coalesce("_keep", F.lit(True)), url, whitelist)
    return rows.withColumn("keep", keep).withColumnRenamed("_ppl", "ppl").drop("_id", "_keep")


def write_by_reason(judged: DataFrame, path: str) -> None:
    """Kept and rejected documents, a folder for each reason, in one pass."""
    judged.write.mode("overwrite").partitionBy("reason").parquet(path)


def read_by_reason(spark, path: str, reason: str) -> DataFrame:
    """What one filter removed (or, for kept, what all have left): only its folder is read."""
    return spark.read.parquet(path).where(F.col("reason") == reason)
