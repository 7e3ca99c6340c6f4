"""Best-fit packing of documents into fixed token windows, after Martello-Toth dominance reduction.

A document is its whitespace words (``size_of`` takes another length). One longer than ``capacity`` fills whole windows
first; what is left over is an item. Items of equal size are interchangeable, so the instance is the histogram of
sizes: at most ``capacity`` rows, however large the corpus. It is worked out by the aggregation, solved on the driver
in bulk steps (all copies of a bin pattern at once), and the solution - ranges of ranks within each size - is joined
back to the items, whose ranks come from a two-level count (salted groups, then offsets), so no window sees a whole
size or the whole corpus.

Reduction: with an item j, the largest first, and room r beside it, a set is fixed for good where it dominates every feasible set
that holds j: {j} if nothing else fits; {j, k}, k the largest that fits, if k fills r, if no two items fit together,
or if no three do and no two together exceed k; {j, k, b} if no three items fit and every feasible pair is dominated
by (k, b). An item without such a set is left where it is, as a partner of others, and the next size is tried; passes over all
sizes are repeated on the shrunk instance until none has a set. What remains is packed best fit decreasing; the log
says how many items the reduction fixed.

Null and empty texts have no words and no rows in the result. Ties: equal sizes are ranked by (salt, doc_id). Repeated
rows are packed each. An empty table gives an empty result. Columns of the input beyond doc_id and text are ignored.
"""

from __future__ import annotations

import logging
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

CAPACITY, SALTS = 2048, 64
_log = logging.getLogger(__name__)


class _Sizes:
    """A multiset of sizes as counts, with its sizes in order."""

    def __init__(self, counts: dict[int, int]):
        self.count = {s: c for s, c in counts.items() if c > 0}
        self.order = sorted(self.count)

    def take(self, s: int, n: int) -> None:
        self.count[s] -= n
        if not self.count[s]:
            del self.count[s]
            del self.order[bisect_left(self.order, s)]

    def largest(self, room: int, used: tuple[int, ...] = ()) -> int | None:
        """The largest size of at most ``room`` that is still there beside the items ``used``."""
        at = bisect_right(self.order, room) - 1
        while at >= 0:
            s = self.order[at]
            if self.count[s] > used.count(s):
                return s
            at -= 1
        return None

    def smallest(self, n: int, used: tuple[int, ...]) -> list[int]:
        out: list[int] = []
        for s in self.order:
            out += [s] * min(n - len(out), self.count[s] - used.count(s))
            if len(out) == n:
                break
        return out

    def pairs(self, room: int, used: tuple[int, ...]) -> tuple[int, int]:
        """The best sum of two items within ``room``, and the largest smaller item of such a pair; 0 if there is none."""
        best = small = 0
        for c in self.order[: bisect_right(self.order, room)]:
            d = self.largest(min(c, room - c), (*used, c))
            if self.count[c] > used.count(c) and d is not None:
                best, small = max(best, c + d), max(small, d)
        return best, small


def _dominating(left: _Sizes, j: int, capacity: int) -> tuple[int, ...] | None:
    """The set with item j that dominates every feasible set with it, if one of the criteria finds it."""
    room = capacity - j
    k = left.largest(room, (j,))
    if k is None:
        return (j,)
    if k == room:
        return (j, k)
    low = left.smallest(3, (j,))
    if len(low) < 2 or sum(low[:2]) > room:
        return (j, k)
    if len(low) == 3 and sum(low) <= room:
        return None
    best, small = left.pairs(room, (j,))
    b = left.largest(room - k, (j, k))
    return (j, k) if best <= k else (j, k, b) if b is not None and small <= b else None


def reduce_instance(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Bins that dominance fixes, as (sizes, how many), and the counts that remain."""
    left, fixed = _Sizes(counts), []
    more = True
    while more:
        more = False
        for j in left.order[::-1]:
            while j in left.count and (fit := _dominating(left, j, capacity)):
                # taking a set only removes feasible sets, so it stays dominant while its own sizes last: copies go at once
                n = min(left.count[s] // fit.count(s) for s in fit)
                fixed.append((fit, n))
                for s in set(fit):
                    left.take(s, n * fit.count(s))
                more = True
    return fixed, dict(left.count)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit decreasing over a histogram, in bulk: bins of one content form a class."""
    classes: dict[int, list[list]] = defaultdict(list)  # room left: [content, how many]
    rooms: list[int] = []

    def put(room: int, content: tuple[int, ...], n: int) -> None:
        if n:
            if not classes[room]:
                insort(rooms, room)
            classes[room].append([content, n])

    for s in sorted(counts, reverse=True):
        n = counts[s]
        while n:
            at = bisect_left(rooms, s)
            if at == len(rooms):
                each = capacity // s
                put(capacity - each * s, (s,) * each, n // each)
                put(capacity - n % each * s, (s,) * (n % each), int(n % each > 0))
                break
            room = rooms[at]
            content, bins = classes[room][-1]
            each = room // s
            full = min(bins, n // each)
            rest = n - full * each if full < bins and n - full * each < each else 0
            if full + bool(rest) == bins:
                classes[room].pop()
            else:
                classes[room][-1][1] -= full + bool(rest)
            if not classes[room]:
                rooms.remove(room)
            put(room - each * s, content + (s,) * each, full)
            put(room - rest * s, content + (s,) * rest, int(rest > 0))
            n -= full * each + rest
    return [(content, n) for of in classes.values() for content, n in of]


def pack_sizes(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    fixed, left = reduce_instance(counts, capacity)
    _log.info("reduction fixed %d of %d items", sum(len(content) * n for content, n in fixed), sum(counts.values()))
    return fixed + best_fit(left, capacity)


def _ranges(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(size, first rank, end, first bin, items of this size a bin, offset): which ranks of a size go to which bins."""
    rank, out, first = defaultdict(int), [], 0
    for content, n in patterns:
        at = 0
        for s in sorted(set(content), reverse=True):
            each = content.count(s)
            out.append((s, rank[s], rank[s] + n * each, first, each, at))
            rank[s] += n * each
            at += each * s
        first += n
    return out


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\t\n\x0B\f\r ]+")), F.lit(0)).cast("bigint")


def best_fit_packing(docs: DataFrame, capacity: int = CAPACITY, salts: int = SALTS, size_of=word_count) -> DataFrame:
    """Rows ``doc_id, piece, start, n_tokens, bin_id, bin_offset``: where each piece of each document lies.

    ``bin_id`` counts from 0 without gaps: the bins with items first, then the whole windows.
    """
    spark = docs.sparkSession
    sized = docs.select("doc_id", size_of(F.col("text")).alias("size")).where("size > 0").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
    sized = stored(sized.withColumn("whole", F.expr(f"size div {capacity}")).withColumn("item", (F.col("size") % capacity).cast("int")), "packing-sizes")
    counts = sized.where("item > 0").groupBy("item", "salt").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["item"]: r["n"] for r in counts.groupBy("item").agg(F.sum("n").alias("n")).collect()}
    patterns = pack_sizes(histogram, capacity)
    n_bins = sum(n for _, n in patterns)
    ranges = spark.createDataFrame(_ranges(patterns), "item int, low bigint, high bigint, bin0 bigint, each int, at int")

    by_item = Window.partitionBy("item").orderBy("salt")
    offsets = counts.withColumn("before", F.sum("n").over(by_item) - F.col("n")).select("item", "salt", "before")
    ranked = sized.where("item > 0").withColumn("r", F.row_number().over(Window.partitionBy("item", "salt").orderBy("doc_id", "size")) - 1)
    # both tables have at most capacity * salts and about as many rows, however large the corpus
    placed = ranked.join(F.broadcast(offsets), ["item", "salt"]).withColumn("r", F.col("r") + F.col("before"))
    placed = placed.join(F.broadcast(ranges), "item").where("r >= low and r < high")
    last = placed.select(
        "doc_id", F.col("whole").alias("piece"), (F.col("whole") * capacity).alias("start"), F.col("item").cast("bigint").alias("n_tokens"),
        F.expr("bin0 + (r - low) div each").alias("bin_id"), F.expr("at + ((r - low) % each) * item").cast("bigint").alias("bin_offset"),
    )

    wholes = sized.where("whole > 0")
    by_salt = wholes.groupBy("salt").agg(F.sum("whole").alias("n"))
    starts = by_salt.withColumn("before", F.sum("n").over(Window.orderBy("salt")) - F.col("n")).select("salt", "before")
    run = Window.partitionBy("salt").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = wholes.withColumn("upto", F.sum("whole").over(run)).join(F.broadcast(starts), "salt").withColumn("first", F.col("before") + F.col("upto") - F.col("whole") + n_bins)
    full = numbered.select("doc_id", "first", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("whole") - 1)).alias("piece")).select(
        "doc_id", "piece", (F.col("piece") * capacity).alias("start"), F.lit(capacity).cast("bigint").alias("n_tokens"), (F.col("first") + F.col("piece")).alias("bin_id"), F.lit(0).cast("bigint").alias("bin_offset")
    )
    return last.unionByName(full)
