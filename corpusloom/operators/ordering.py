"""Global ranks and running sums without a single-partition window.

Only the keys (and weights) are ranked: they are written in ranges of neighbouring keys, about ``PER_RANGE`` rows each,
every range is ranked on its own and gets the total of the ranges before it. The rows, with their texts, meet their
ranks in one join, so no task has to take in more than its share of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import stored

PER_RANGE = 1_000_000


def with_running_total(df: DataFrame, key: str | list[str], out: str, weight: Column | None = None, per_range: int = PER_RANGE) -> DataFrame:
    """Add ``out``, the sum of ``weight`` (1 by default) over all rows before this one in the order of ``key``.

    The key is a column or several, of any types that sort; nulls come first. It should name the rows: rows that share
    one come one after the other, the lighter first, which takes a window over them.
    """
    names = [key] if isinstance(key, str) else key
    w = (F.lit(1) if weight is None else F.coalesce(weight, F.lit(0))).cast("bigint")
    ks = [f"_k{i}" for i in range(len(names))]
    keys = df.select(*[F.col(n).alias(k) for n, k in zip(names, ks)], w.alias("_w")).groupBy(*ks).agg(F.sum("_w").alias("_w"), F.count(F.lit(1)).alias("_n"))
    sort = [F.col(k).asc_nulls_first() for k in ks]
    ranges = max(1, -(-df.count() // per_range))
    keys = keys.repartitionByRange(ranges, *sort) if ranges > 1 else keys.coalesce(1)
    # written, as a range may be another one when it is worked out again
    keys = stored(keys.withColumn("_b", F.spark_partition_id()), "ranges")
    before = keys.groupBy("_b").agg(F.sum("_w").alias("_s"))
    before = before.select("_b", (F.sum("_s").over(Window.orderBy("_b")) - F.col("_s")).alias("_before"))  # a row a range
    upto = F.sum("_w").over(Window.partitionBy("_b").orderBy(*sort).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    first = keys.withColumn("_upto", upto).join(F.broadcast(before), "_b").select(*ks, "_n", (F.col("_before") + F.col("_upto") - F.col("_w")).alias("_at"))
    rows = df.withColumn("_w", w).join(first, reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(k)) for n, k in zip(names, ks)]))
    if first.where("_n > 1").limit(1).count():
        within = F.sum("_w").over(Window.partitionBy(*ks).orderBy("_w").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_w")
        rows = rows.withColumn("_at", F.col("_at") + within)
    return rows.withColumn(out, F.col("_at")).drop(*ks, "_w", "_n", "_at")


def with_row_number(df: DataFrame, key: str | list[str], out: str, per_range: int = PER_RANGE) -> DataFrame:
    """Add the 1-based position of each row in the order of ``key``."""
    return with_running_total(df, key, out, None, per_range).withColumn(out, F.col(out) + 1)
