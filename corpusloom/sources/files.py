"""Readers, writers and layouts."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import with_row_number
from .shared import fresh_path

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def read_documents(spark: SparkSession, path: str, dump: str | None = None) -> DataFrame:
    """A folder of Parquet files, subfolders included, with a default for the ``dump`` column."""
    df = spark.read.option("recursiveFileLookup", True).parquet(path)
    return df if dump is None else df.withColumn("dump", F.lit(dump))


def read_source(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(f"{root}/*/{name}")


def read_jsonl(spark: SparkSession, path: str, schema: str = DOCUMENT) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_json_metadata(spark: SparkSession, path: str, keys: tuple[str, ...]) -> DataFrame:
    """JSON lines with the named keys of ``metadata`` as columns."""
    df = spark.read.schema("id string, text string, metadata map<string,string>").json(path)
    return df.select("id", "text", *[F.col("metadata")[k].alias(k) for k in keys])


#: How :func:`write_csv` and :func:`read_csv` quote, so that white space at a value's ends, empty values and nulls survive.
#: A null is a private-use character that no text consists of.
CSV = {"header": True, "escape": '"', "emptyValue": "", "nullValue": "\ue000", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV).option("quoteAll", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Values as they are written; a field without anything between its commas is null as well."""
    return spark.read.schema(schema).options(**CSV).option("multiLine", True).csv(path)


def read_instructions(spark: SparkSession, path: str) -> DataFrame:
    """An instruction set as one JSON array: ``instruction, context, output``. A row of the kind that has its request in
    ``input`` gets that as its instruction."""
    rows = spark.read.schema("instruction string, input string, output string").option("multiLine", True).json(path)
    return rows.select(F.coalesce("instruction", "input").alias("instruction"), F.when(F.col("instruction").isNotNull(), F.col("input")).alias("context"), "output")


def write_jsonl(df: DataFrame, path: str, parts: int | None = None) -> None:
    (df if parts is None else df.repartition(parts)).write.mode("overwrite").option("compression", "gzip").json(path)


def write_lines(df: DataFrame, path: str, *columns: str) -> None:
    """Tab-separated text lines."""
    df.select(F.concat_ws("\t", *columns).alias("value")).write.mode("overwrite").text(path)


def write_parquet(df: DataFrame, path: str, by: str | None = None) -> None:
    w = df.write.mode("overwrite")
    (w.partitionBy(by) if by else w).parquet(path)


def jsonl_roundtrip(df: DataFrame) -> DataFrame:
    path = fresh_path(df.sparkSession, "jsonl")
    write_jsonl(df, path)
    return read_jsonl(df.sparkSession, path)


def estimated_size(df: DataFrame) -> DataFrame:
    """Half a byte for each character, whole bytes."""
    return df.agg(F.floor(F.lit(0.5) * F.coalesce(F.sum(F.length("text")), F.lit(0))).alias("n_bytes"))


def shard_count(df: DataFrame, shard_bytes: int = 100_000_000) -> int:
    return max(1, estimated_size(df).first()["n_bytes"] // shard_bytes)


def write_shards(df: DataFrame, path: str, shard_bytes: int = 100_000_000) -> int:
    """Write ``df`` as ``part-0000.parquet`` and so on, as many files as its size asks for; gives their number.

    Rows go to files by the hash of their position in no particular order, as evenly as it falls.
    """
    spark, n = df.sparkSession, shard_count(df, shard_bytes)
    df.repartition(n).write.mode("overwrite").parquet(path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in fs.listStatus(target) if s.getPath().getName().startswith("part-"))
    for i, name in enumerate(names):
        fs.rename(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target, name), spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target, f"part-{i:04}.parquet"))
    return len(names)


def token_count(tokens: DataFrame) -> DataFrame:
    """The size of tokenised documents: one token counts one."""
    return tokens.agg(F.coalesce(F.sum(F.size("input_ids").cast("bigint")), F.lit(0).cast("bigint")).alias("n_tokens"))


def concatenated(*parts: DataFrame) -> DataFrame:
    """All rows of several sources; columns that one lacks are null there."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def overlaid(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The union of two keyed tables; where both have a key the right one's row counts."""
    return left.join(right.select(key), key, "left_anti").unionByName(right)


def save_resource(path: str, value) -> None:
    """A small JSON resource of the driver's, indented by two."""
    with open(path, "w", encoding="utf-8") as f:
        json.dump(value, f, ensure_ascii=False, indent=2)


def load_resource(path: str, default=None):
    """What :func:`save_resource` wrote, or ``default`` where there is no such file."""
    if not os.path.exists(path):
        return default
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def read_blocks(spark: SparkSession, path: str, seed: int = 0) -> DataFrame:
    """Packed token blocks in a seeded order."""
    return spark.read.parquet(path).orderBy(F.xxhash64("block_id", F.lit(seed)), "block_id")


def shard_plan(df: DataFrame, shard_bytes: int = 100_000_000) -> DataFrame:
    """Rows and characters of each shard when rows go round the shards in id order."""
    n = shard_count(df, shard_bytes)
    rows = with_row_number(df.select("doc_id", F.length("text").cast("bigint").alias("c")), "doc_id", "rn")
    return rows.groupBy(((F.col("rn") - 1) % n).alias("shard")).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("c").alias("n_chars"))


def reshard(df: DataFrame, n: int) -> DataFrame:
    """Rewrite as ``n`` gzipped JSON files and read them back."""
    path = fresh_path(df.sparkSession, "reshard")
    write_jsonl(df, path, n)
    return read_jsonl(df.sparkSession, path)


def retain_metadata(df: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """The named keys of ``metadata`` as columns; a missing key is null."""
    return df.select("doc_id", "text", *[F.try_element_at("metadata", F.lit(k)).alias(k) for k in fields])
