"""The folder that all executors see, and tables written to it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.

    Where that is unset, a session whose tasks all run in the driver's own process gets a temporary folder; on a
    cluster an executor's disk would be no place for tables that others read, so there it is an error.
    """
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir isn't set; it must name a folder that all executors share")
        place = "file://" + tempfile.mkdtemp(prefix="corpusloom-")
        spark.conf.set("spark.checkpoint.dir", place)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(place)
    return place


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the driver's JVM ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again, so that later steps start from files that outlive executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of the Arrow batches that texts travel in. The JVM and the Python worker hold such a batch several times over.
ARROW_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Set the session's bound on Arrow batches to ``ARROW_BYTES``, unless the session has a bound of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if key not in spark.conf.getAll:
        spark.conf.set(key, str(ARROW_BYTES))


#: A side of a join is broadcast up to this many rows of a few bytes; beyond it the join shuffles.
BROADCAST_ROWS = 2_000_000


def sized(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast if it has at most ``limit`` rows; larger sides keep the shuffle join."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
