"""Saved harvest records: which have a usable link, and what is known of their licences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def usable_records(records: DataFrame) -> DataFrame:
    """Add ``view_url, download_url``; drop records without a relation, a PDF, matching lengths or a view link."""
    rows = records.where("relation is not null").withColumn("relation", F.filter("relation", lambda x: ~x.contains("downloadSuppFile")))
    rows = rows.where(F.col("format").isNull() | F.array_contains("format", "application/pdf"))
    rows = rows.where(F.col("format").isNull() | ~((F.size("format") != F.size("relation")) & (F.size("format") > 1)))
    view = F.get(F.reverse(F.filter("relation", lambda x: x.contains("view"))), F.lit(0))
    return rows.withColumn("view_url", view).where("view_url is not null").withColumn("download_url", F.replace("view_url", F.lit("view"), F.lit("download")))


def with_licenses(records: DataFrame, licenses: DataFrame) -> DataFrame:
    """Left join of scraped licences by ``download_url``, united with those in the record's metadata."""
    empty = F.expr("cast(array() as array<string>)")
    both = records.join(licenses.select("download_url", F.col("licenses").alias("_l")), "download_url", "left")
    return both.withColumn("licenses", F.array_union(F.coalesce("_l", empty), F.coalesce("rights", empty))).drop("_l").withColumn("acceptable", (F.size("licenses") == 0) | T.license_ok(F.col("licenses")))


def unscraped(records: DataFrame, known: DataFrame) -> DataFrame:
    return records.join(known.select("download_url"), "download_url", "left_anti")


def journals(csv: DataFrame, languages: str = "Vietnamese|English", licenses: tuple[str, ...] = ("CC BY", "CC BY-SA", "CC BY-NC", "CC BY-NC-SA"), country: str = "Viet Nam", least: int = 10) -> DataFrame:
    """Journals of a country with enough records, an accepted licence and one of the languages."""
    return csv.where((F.col("country") == country) & (F.col("records") > least) & F.col("license").isin(*licenses) & F.col("languages").rlike(languages))


def records_by_language(csv: DataFrame, subsets: dict[str, str]) -> DataFrame:
    """``subset, records``: the records of the journals whose languages match each pattern."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("subset"), F.when(F.col("languages").rlike(p), F.col("records")).otherwise(0).alias("r")) for k, p in subsets.items()]))
    return csv.select(each.alias("s")).groupBy("s.subset").agg(F.sum("s.r").cast("bigint").alias("records"))


def totals(records: DataFrame) -> DataFrame:
    """``n_records, n_journals``."""
    return records.agg(F.count(F.lit(1)).alias("n_records"), F.count_distinct("journal").alias("n_journals"))


def incompatible_count(records: DataFrame) -> DataFrame:
    """How many records have no acceptable licence; one without any licence counts."""
    return records.agg(F.sum((~T.license_ok(F.col("licenses"))).cast("bigint")).alias("n_incompatible"))


def outcomes(results: DataFrame) -> DataFrame:
    """By journal: downloads that ended well, that were there already, of a wrong kind, and that raised an error."""
    n = lambda c: F.coalesce(F.sum(c.cast("bigint")), F.lit(0).cast("bigint"))
    none = F.col("error").isNull()
    return results.groupBy("journal").agg(
        n(none & F.col("success")).alias("n_success"), n(none & F.col("already")).alias("n_already"), n(none & ~F.col("success")).alias("n_wrong_type"), n(~none).alias("n_errors")
    )


def to_compress(files: DataFrame, kinds: DataFrame, least_bytes: int, key: str = "path") -> DataFrame:
    """Files of at least ``least_bytes`` with their kind, ``unknown`` for those that weren't classified.

    ``key`` names a file in both; one that is classified several times has one row, with the first kind by name.
    """
    kinds = kinds.groupBy(key).agg(F.min("kind").alias("kind"))
    return files.where(F.col("n_bytes") >= least_bytes).join(kinds, key, "left").withColumn("kind", F.coalesce("kind", F.lit("unknown")))


def with_texts(records: DataFrame, texts: DataFrame) -> DataFrame:
    """Records joined with their converted files; those without a file drop out."""
    return records.join(texts, "local_pdf_file")
