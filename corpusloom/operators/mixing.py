"""Splits, seeded shuffles, packing of token streams and weighted mixtures."""

from __future__ import annotations

import base64
import functools

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.shared import bound_batches, stored
from .ordering import with_row_number, with_running_total

BOS, EOS, FIRST_ID = 1, 2, 16
GPT2_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def word_ids(text: Column, vocabulary: int = 49_152) -> Column:
    """A stand-in tokeniser: an id from each word's MD5, the same in any engine."""

    @F.arrow_udf("array<int>")
    def ids(words: pa.Array) -> pa.Array:
        none, flat = words.is_null(), pa.array((T.md5_numbers(words.flatten()) % (vocabulary - FIRST_ID) + FIRST_ID).astype(np.int32))
        ends = np.cumsum(pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False))
        return pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), flat, mask=none)

    return ids(T.words(text))


def bpe_ids(path: str, pattern: str = GPT2_PATTERN):
    """Ids of a byte-pair vocabulary in the tiktoken format; ``path`` must be readable on every executor."""

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        t = _encoding(path, pattern)
        return texts.map(lambda x: None if x is None else np.array(t.encode_ordinary(x), np.int32))

    return ids


@functools.lru_cache(2)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("text", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def tokenize(docs: DataFrame, bos: int = BOS, eos: int = EOS, ids=word_ids, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, input_ids`` between the two marks. Documents that are tokenised already are an error."""
    if "input_ids" in docs.columns:
        raise ValueError("the documents have input_ids already")
    bound_batches(docs.sparkSession)
    return docs.select(*carry, "doc_id", F.concat(F.array(F.lit(bos)), ids(F.col("text")), F.array(F.lit(eos))).alias("input_ids"))


def pack(tokens: DataFrame, block: int = 2049, drop_last: bool = True) -> DataFrame:
    """Concatenate the sequences in id order and cut every ``block`` tokens: ``block_id, tokens``.

    A document's place comes from a bucketed running sum; it is cut into pieces at the block borders where it lies, so
    the shuffle moves pieces, not single tokens.
    """
    # written, as they are needed for their sizes and again for their places
    placed = with_running_total(stored(tokens.select("doc_id", "input_ids"), "tokens"), "doc_id", "at", F.size("input_ids"))
    n = F.size("input_ids")
    spans = placed.where(n > 0).select("input_ids", "at", F.explode(F.sequence(F.expr(f"at div {block}"), F.expr(f"(at + size(input_ids) - 1) div {block}"))).alias("block_id"))
    start = F.greatest(F.col("block_id") * block - F.col("at"), F.lit(0))
    stop = F.least((F.col("block_id") + 1) * block - F.col("at"), F.size("input_ids"))
    pieces = spans.select("block_id", F.struct(F.greatest(F.col("at"), F.col("block_id") * block).alias("p"), F.slice("input_ids", (start + 1).cast("int"), (stop - start).cast("int")).alias("t")).alias("s"))
    out = pieces.groupBy("block_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["t"])).alias("tokens"))
    return out.where(F.size("tokens") == block) if drop_last else out


def split(df: DataFrame, key: str = "doc_id", fractions: tuple = (("train", 80), ("val", 90), ("test", 100)), seed: str = "split") -> DataFrame:
    """Add ``split`` by hash bucket; fractions are upper bounds in percent. :func:`holdout` takes any fraction."""
    b = T.hash_bucket(F.col(key), seed, 100)
    out: Column = F.lit(fractions[-1][0])
    for name, upto in reversed(fractions[:-1]):
        out = F.when(b < upto, F.lit(name)).otherwise(out)
    return df.withColumn("split", out)


def holdout(df: DataFrame, fraction: float, key: str = "doc_id", seed: str = "holdout") -> DataFrame:
    """Add ``held``: a seeded share of the rows, any fraction to a billionth."""
    return df.withColumn("held", T.hash_unit(F.col(key), seed) < F.lit(float(fraction)))


def shuffle_take(df: DataFrame, n: int, key: str = "doc_id", seed: str = "20250801") -> DataFrame:
    """The first ``n`` rows of a seeded order."""
    return df.orderBy(F.md5(F.concat(F.lit(seed + ":"), F.col(key).cast("string"))), key).limit(n)


def batches(df: DataFrame, size: int, key: str = "doc_id", mode: str = "stride") -> DataFrame:
    """``batch`` for each row: strides of ``size`` rows, or (as written) windows that begin one row apart."""
    rows = with_row_number(df.select(key), key, "rn").withColumn("i", F.col("rn") - 1)
    if mode == "stride":
        return rows.select(key, F.expr(f"i div {size}").alias("batch"))
    last = max(df.count() // size - 1, 0)
    windows = rows.select(key, F.greatest(F.col("i") - size + 1, F.lit(0)).alias("a"), F.least(F.col("i"), F.lit(last).cast("bigint")).alias("b"))
    return windows.where("a <= b").select(key, F.explode(F.sequence("a", "b")).alias("batch"))


def mixture(df: DataFrame, source: str, weights: dict[str, float], n: int, key: str = "doc_id", seed: str = "mix", size_scaled: bool = True) -> DataFrame:
    """``n`` rows drawn without replacement: a row's draw time is exponential with rate p of its source.

    ``p`` is the source's weight over its size (characters), normalised; ``size_scaled=False`` leaves the sizes out.
    """
    rows = df.where(F.col(source).isin(*weights)).select(key, source, F.length("text").cast("bigint").alias("n_chars"))
    w = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])[F.col(source)]
    sizes = rows.groupBy(source).agg(F.sum("n_chars").alias("total"))
    p = sizes.select(source, (w / F.col("total") if size_scaled else w * 1.0).alias("p"))
    p = p.crossJoin(F.broadcast(p.agg(F.sum("p").alias("all")))).select(source, (F.col("p") / F.col("all")).alias("p"))  # one row
    timed = rows.join(F.broadcast(p), source).select(key, source, F.round(-F.log(T.hash_unit(F.col(key), seed)) / F.col("p"), 6).alias("t"))  # as many rows as weights
    return timed.orderBy("t", key).limit(n)


def moving_average(events: DataFrame, value: str, order: list[str], by: list[str], n: int = 20) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(-(n - 1), 0)
    return events.withColumn("moving_avg", F.round(F.avg(value).over(w), 6))
