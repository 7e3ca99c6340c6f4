"""Helpers that the operators of this folder share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import ARROW_BYTES, bound_batches, fresh_path, shared_dir, stored

__all__ = ["ARROW_BYTES", "bound_batches", "freed_shuffles", "fresh_path", "removed", "shared_dir", "stored", "table", "with_sized_broadcast"]

#: A side of a join is broadcast up to this many rows of a few bytes; beyond it the join shuffles.
BROADCAST_ROWS = 2_000_000

@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries that run inside go when their query ends, not when the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def removed(df: DataFrame) -> None:
    """Delete the files of a ``stored`` table that nothing reads any more."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        path.getFileSystem(conf).delete(path, True)


def with_sized_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast if it has at most ``limit`` rows; larger sides keep the shuffle join."""
    few = df.limit(limit + 1).count() <= limit
    return F.broadcast(df) if few else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
