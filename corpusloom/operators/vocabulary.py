"""Vocabulary extension: language of tokens, merging, pair counts and embedding initialisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.shared import stored
from .ordering import with_row_number


def token_counts(docs: DataFrame) -> DataFrame:
    return docs.select(F.explode(T.words(F.col("text"))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def by_language(vocabulary: DataFrame, syllables: DataFrame, least_n: int = 1) -> DataFrame:
    """Add ``in_language``: every syllable of the cleaned token is known (vacuously so for an empty token)."""
    v = vocabulary.where(F.col("n") >= least_n).withColumn("s", F.filter(F.split(F.trim(F.lower(F.regexp_replace("token", r"[^\p{L} ]", " "))), " +"), lambda x: x != ""))
    known = syllables.select(F.col("syllable")).distinct()
    parts = v.select("token", F.explode("s").alias("syllable"))
    missing = parts.join(known, "syllable", "left_anti").select("token").distinct().withColumn("_m", F.lit(True))
    return v.join(missing, "token", "left").select("token", "n", F.col("_m").isNull().alias("in_language"))


def cleaned(token: Column) -> Column:
    """A token without punctuation at its edges; one of letters only is as it is."""
    return F.when(token.rlike(r"^\p{L}+$"), token).otherwise(F.regexp_replace(token, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))


def merge(new: DataFrame, base: DataFrame, whitelist: tuple[str, ...] = (), factor: int = 128) -> DataFrame:
    """The tokens to add, in order of frequency, cut to a multiple of ``factor``: ``token, rn``.

    Rules in order: tokens that aren't letters only lose edge punctuation, and go unless what is left is letters and
    itself (or capitalised, or in lower case) a new token; tokens of the base vocabulary go; ASCII words go unless
    whitelisted.
    """
    rows = new.select("token", "n", cleaned(F.col("token")).alias("c"))
    rows = rows.where(F.col("c").rlike(r"^\p{L}+$"))
    variants = rows.withColumn("v", F.explode(F.array_distinct(F.array("c", T.capitalized(F.col("c")), F.lower("c")))))
    found = variants.join(new.select(F.col("token").alias("v")), "v", "left_semi").select("token").distinct()
    rows = rows.join(found, "token", "left_semi").groupBy("c").agg(F.max("n").alias("n"))
    rows = rows.join(base.select(F.col("token").alias("c")).distinct(), "c", "left_anti")
    ascii_only = F.col("c").rlike("^[A-Za-z]+$")
    rows = rows.where(~ascii_only | F.lower("c").isin(*whitelist) if whitelist else ~ascii_only)
    rows = stored(rows.select(F.col("c").alias("token"), (-F.col("n")).alias("rank")), "merged")
    ranked = with_row_number(rows, ["rank", "token"], "rn")
    return ranked.where(F.col("rn") <= rows.count() // factor * factor).select("token", "rn")


def dropped(new: DataFrame, merged: DataFrame) -> DataFrame:
    """``token``: the new tokens of which :func:`merge` kept no form."""
    rows = new.select("token", cleaned(F.col("token")).alias("c"))
    return rows.join(merged.select(F.col("token").alias("c")), "c", "left_anti").select("token")


def added_count(base: DataFrame, extended: DataFrame) -> DataFrame:
    """``n_added``: tokens of the extended vocabulary that the base one lacks."""
    return extended.select("token").distinct().join(base.select("token"), "token", "left_anti").agg(F.count(F.lit(1)).alias("n_added"))


def tokens_of_ids(ids: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """The token of each id; ids that the vocabulary lacks have a null one."""
    return ids.join(vocabulary.select("token_id", "token"), "token_id", "left")


def scan(vocabulary: DataFrame, syllables: DataFrame, least_id: int = 0, special: tuple[int, ...] = ()) -> DataFrame:
    """``token_id, token`` of the tokens from ``least_id`` on that aren't special and whose syllables all are known."""
    rows = vocabulary.where((F.col("token_id") >= least_id) & ~F.col("token_id").isin(*special))
    good = by_language(rows.select("token", F.lit(1).alias("n")).distinct(), syllables).where("in_language").select("token")
    return rows.join(good, "token", "left_semi").select("token_id", "token")


def pair_counts(docs: DataFrame, least: int = 1) -> DataFrame:
    """``left, right, n``: adjacent characters over all words, each word weighted by its count."""
    w = token_counts(docs)
    pairs = w.where(F.length("token") > 1).select("n", F.explode(F.transform(F.sequence(F.lit(1), F.length("token") - 1), lambda i: F.struct(F.substring(F.col("token"), i, F.lit(1)).alias("left"), F.substring(F.col("token"), i + 1, F.lit(1)).alias("right")))).alias("p"))
    return pairs.groupBy(F.col("p.left").alias("left"), F.col("p.right").alias("right")).agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _joiner(a: str, b: str):
    def joined(acc, x):
        meets = (F.get(acc, F.size(acc) - 1) == a) & (x == b)
        return F.when(meets, F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.lit(a + b)))).otherwise(F.concat(acc, F.array(x)))

    return joined


def train_merges(docs: DataFrame, merges: int, least: int = 2, alphabet: int | None = None, prefix: str = "", dropout: float = 0.0, seed: str = "bpe") -> list[tuple[str, str]]:
    """Byte-pair merges over words: a bounded loop of pair counts, the words kept as distributed symbol lists.

    ``prefix`` is put before each word as the mark of its beginning. ``alphabet`` keeps the most frequent characters
    only; others stand apart and never merge. ``dropout`` leaves each pair of a word out of a round's counts with that
    probability, by a seeded hash.
    """
    words = token_counts(docs).select(F.split(F.concat(F.lit(prefix), F.col("token")), "").alias("s"), "n")
    words = words.select(F.filter("s", lambda x: x != "").alias("s"), "n")
    if alphabet is not None:
        letters = words.select("n", F.explode("s").alias("c")).groupBy("c").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "c").limit(alphabet).collect()
        known = [r["c"] for r in letters]  # at most `alphabet` characters
        words = words.withColumn("s", F.transform("s", lambda x: F.when(x.isin(*known), x)))
    words = stored(words, "bpe-words")
    out: list[tuple[str, str]] = []
    for _ in range(merges):
        pairs = words.where(F.size("s") > 1).select("n", F.explode(F.arrays_zip(F.slice("s", F.lit(1), F.size("s") - 1).alias("l"), F.slice("s", F.lit(2), F.size("s") - 1).alias("r"))).alias("p"))
        pairs = pairs.where("p.l is not null and p.r is not null")
        if dropout:
            pairs = pairs.where(F.pmod(F.xxhash64("p.l", "p.r", "n", F.lit(f"{seed}{len(out)}")), F.lit(1_000_000)) >= int(dropout * 1_000_000))
        best = pairs.groupBy("p.l", "p.r").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "l", "r").limit(1).collect()
        if not best or best[0]["n"] < least:
            break
        a, b = best[0]["l"], best[0]["r"]
        out.append((a, b))

        joined = _joiner(a, b)
        words = words.select(F.aggregate("s", F.expr("cast(array() as array<string>)"), joined).alias("s"), "n")
    return out


def mean_vector(vectors: DataFrame, by: str) -> DataFrame:
    """Element-wise mean: ``by, pos, mean`` rows."""
    rows = vectors.select(by, F.posexplode("embedding").alias("pos", "x"))
    return rows.groupBy(by, "pos").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("mean"))


def blend(vectors: DataFrame, by: str, key: str, t: float = 0.9) -> DataFrame:
    """``key, pos, x``: each vector moved towards the mean of its group, t parts of the mean."""
    rows = vectors.select(key, by, F.posexplode("embedding").alias("pos", "x"))
    return rows.join(mean_vector(vectors, by), [by, "pos"]).select(key, "pos", (F.round(F.lit(t) * F.col("mean") + F.lit(1 - t) * F.col("x").cast("double"), 5) + F.lit(0.0)).alias("x"))
