"""Quality, repetition, URL and word-list filters: measures as columns, verdicts as predicates over them."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.shared import BROADCAST_ROWS, bound_batches, sized, stored
from .dedup import powers

GOPHER_STOP_WORDS = ("the", "be", "to", "of", "and", "that", "have", "with")
POLICY_PHRASES = ("terms of use", "privacy policy", "cookie policy", "uses cookies", "use of cookies", "use cookies")
TERMINAL = (".", "!", "?", '"', "”")


def share(top: Column, bottom: Column) -> Column:
    """A ratio rounded to 6 digits, 0 where the bottom is 0."""
    return F.coalesce(F.round(F.try_divide(top.cast("double"), bottom.cast("double")), 6), F.lit(0.0))


def _chars(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0).cast("bigint"), lambda a, x: a + F.length(x))


def _line_measures() -> list[Column]:
    return [
        share(F.size("l") - F.size("dl"), F.size("l")).alias("dup_line_frac"),
        share(F.size("p") - F.size("dp"), F.size("p")).alias("dup_para_frac"),
        share(_chars(F.col("l")) - _chars(F.col("dl")), F.col("n")).alias("dup_line_char_frac"),
        share(_chars(F.col("p")) - _chars(F.col("dp")), F.col("n")).alias("dup_para_char_frac"),
    ]


def line_repetition(docs: DataFrame) -> DataFrame:
    """Shares of repeated lines and paragraphs, by number and by characters."""
    rows = docs.select("doc_id", F.length("text").alias("n"), T.lines(F.col("text")).alias("l"), T.paragraphs(F.col("text")).alias("p"))
    rows = rows.select("*", F.array_distinct("l").alias("dl"), F.array_distinct("p").alias("dp"))
    return rows.select("doc_id", *_line_measures())


def ngram_measures(top: tuple[int, ...], dup: tuple[int, ...]):
    """A vectorised function of word lists: for each n in ``top`` the characters in the most frequent n-gram (the longest
    of equals; 0 if none repeats), for each n in ``dup`` the characters of the words that repeated n-grams cover, and
    ``chars``, those of all words. N-grams are compared by a rolling 64-bit hash.

    Nine sizes of n-grams by explode and groupBy would shuffle nine times the corpus; a document's n-grams never leave
    its row here. A longer n-gram can repeat only where a shorter one does, so each size looks at what the last one left.
    """
    names = [f"top_{n}" for n in top] + [f"dup_{n}" for n in dup] + ["chars"]
    base = 0xD6E8FEB86659FD93

    def of(h: np.ndarray, size: np.ndarray, up: np.ndarray, down: np.ndarray) -> dict[str, int]:
        before = np.append(0, np.cumsum(size))
        sums = np.append(np.uint64(0), np.cumsum(h * up[: len(h)]))
        row, at = {"chars": int(before[-1])}, np.arange(len(h))
        for n in sorted({*top, *dup}):
            at = at[: np.searchsorted(at, len(h) - n, "right")]
            if len(at) < 2:
                break
            grams = (sums[at + n] - sums[at]) * down[at]
            order = np.argsort(grams)
            grams = grams[order]
            start = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
            counts = np.diff(np.append(start, len(grams)))
            most = int(counts.max())
            if most < 2:
                break
            if n in top:
                first = at[order[start[counts == most]]]
                row[f"top_{n}"] = most * int((before[first + n] - before[first]).max()) + most * (n - 1)
            at = np.sort(at[order[np.repeat(counts > 1, counts)]])
            if n in dup:
                edge = np.bincount(at, minlength=len(h) + 1) - np.bincount(at + n, minlength=len(h) + 1)
                row[f"dup_{n}"] = int(size[np.cumsum(edge)[:-1] > 0].sum())
        return row

    @F.arrow_udf(f"struct<{', '.join(f'{n}: bigint' for n in names)}>")
    def measures(words: pa.Array) -> pa.Array:
        ends = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)))
        d = words.flatten().dictionary_encode()
        code, length = d.indices.to_numpy(), pc.utf8_length(d.dictionary).to_numpy().astype(np.int64)
        # a number for each word of the batch, mixed
        number = np.arange(1, len(length) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        number = (number ^ (number >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        number = (number ^ (number >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        number ^= number >> np.uint64(31)
        up, down = powers(int(np.diff(ends).max(initial=0)) + 1, base)
        rows = [of(number[c], length[c], up, down) for c in (code[a:b] for a, b in zip(ends, ends[1:]))]
        return pa.StructArray.from_arrays([pa.array([r.get(n, 0) for r in rows], pa.int64()) for n in names], names)

    return measures


def gopher_repetition(docs: DataFrame, carry: tuple[str, ...] = (), top: tuple = ((2, 0.2), (3, 0.18), (4, 0.16)), dup: tuple = ((5, 0.15), (6, 0.14), (7, 0.13), (8, 0.12), (9, 0.11), (10, 0.1))) -> DataFrame:
    """All repetition measures and ``keep``, in one narrow pass. Here and below, ``carry`` names columns that stay."""
    rows = docs.select("doc_id", *carry, F.length("text").alias("n"), T.lines(F.col("text")).alias("l"), T.paragraphs(F.col("text")).alias("p"), T.words(F.coalesce("text", F.lit(""))).alias("w"))
    bound_batches(docs.sparkSession)
    rows = rows.select("*", F.array_distinct("l").alias("dl"), F.array_distinct("p").alias("dp"), ngram_measures(tuple(n for n, _ in top), tuple(n for n, _ in dup))("w").alias("g"))
    out = rows.select(
        "doc_id", *carry, *_line_measures(),
        *[share(F.col(f"g.top_{n}"), F.col("n")).alias(f"top_{n}") for n, _ in top],
        *[share(F.col(f"g.dup_{n}"), F.col("g.chars")).alias(f"dup_{n}") for n, _ in dup],
    )
    bad = (F.col("dup_line_frac") > 0.3) | (F.col("dup_para_frac") > 0.3) | (F.col("dup_line_char_frac") > 0.2) | (F.col("dup_para_char_frac") > 0.2)
    for name, limit in [(f"top_{n}", x) for n, x in top] + [(f"dup_{n}", x) for n, x in dup]:
        bad = bad | (F.col(name) > limit)
    return out.withColumn("keep", ~bad)


def gopher_quality(docs: DataFrame, low: int = 50, high: int = 100_000, carry: tuple[str, ...] = (), shortest: float = 3, longest: float = 10, stop_words: tuple[str, ...] = GOPHER_STOP_WORDS, least_stop_words: int = 2) -> DataFrame:
    rows = docs.select("doc_id", *carry, F.col("text").alias("_t"), T.words(F.col("text")).alias("w"), T.lines(F.col("text")).alias("l"))
    stop = F.array(*[F.lit(x) for x in stop_words])
    rows = rows.select(
        "doc_id", *carry,
        F.size("w").cast("bigint").alias("n_words"),
        share(_chars(F.col("w")), F.size("w")).alias("avg_word_len"),
        share(F.size(F.filter("l", lambda x: x.rlike(r"^\s*[•*-]"))), F.size("l")).alias("bullet_frac"),
        share(F.size(F.filter("l", lambda x: x.endswith("...") | x.endswith("…"))), F.size("l")).alias("ellipsis_frac"),
        F.size(F.array_intersect(F.col("w"), stop)).cast("bigint").alias("stop_words"),
        share(F.regexp_count("_t", F.lit(r"#|\.\.\.|…")), F.size("w")).alias("symbol_ratio"),
        share(F.size(F.filter("w", lambda x: x.rlike(r"\p{L}"))), F.size("w")).alias("alpha_frac"),
    )
    keep = F.col("n_words").between(low, high) & F.col("avg_word_len").between(shortest, longest) & (F.col("bullet_frac") <= 0.9) & (F.col("ellipsis_frac") <= 0.3)
    return rows.withColumn("keep", keep & (F.col("stop_words") >= least_stop_words) & (F.col("symbol_ratio") <= 0.1) & (F.col("alpha_frac") >= 0.8))


def c4_quality(
    docs: DataFrame, least_sentences: int = 3, carry: tuple[str, ...] = (), terminal_punctuation: bool = False, least_words_a_line: int = -1,
    javascript: bool = False, curly_bracket: bool = False, policy: bool = True, citations: bool = True, lorem_ipsum: bool = True,
) -> DataFrame:
    """Drop lines and citation marks, then ask for enough sentences. ``text_out`` is what later filters see.

    Lines go that name a policy (``policy``) or javascript, don't end a sentence (``terminal_punctuation``) or have too
    few words; a document goes that has a curly bracket (``curly_bracket``) or filler text.
    """
    text = F.regexp_replace(F.col("text"), r"\[\d*\]|\[edit\]|\[citation needed\]", "") if citations else F.col("text")

    def stays(line: Column) -> Column:
        low, out = F.lower(line), F.lit(True)
        if terminal_punctuation:
            ends = line.endswith(TERMINAL[0])
            for e in TERMINAL[1:]:
                ends = ends | line.endswith(e)
            out = out & ends & ~line.endswith("...")
        if least_words_a_line > 0:
            out = out & (F.size(T.words(line)) >= least_words_a_line)
        for p in (*(POLICY_PHRASES if policy else ()), *(("javascript",) if javascript else ())):
            out = out & ~low.contains(p)
        return out

    rows = docs.select("doc_id", *carry, F.array_join(F.filter(T.lines(text), stays), "\n").alias("text_out"))
    rows = rows.withColumn("n_sentences", T.sentence_count(F.col("text_out")).cast("bigint"))
    keep = F.col("n_sentences") >= least_sentences
    if lorem_ipsum:
        keep = keep & ~F.lower("text_out").contains("lorem ipsum")
    if curly_bracket:
        keep = keep & ~F.col("text_out").contains("{")
    return rows.withColumn("keep", keep)


def fineweb_quality(docs: DataFrame, short: int = 30, carry: tuple[str, ...] = ()) -> DataFrame:
    rows = docs.select("doc_id", *carry, F.col("text").alias("_t"), F.filter(T.lines(F.col("text")), lambda x: F.trim(x) != "").alias("l"), F.size(T.words(F.col("text"))).alias("n"))
    ends = lambda x: x.endswith(TERMINAL[0]) | x.endswith(TERMINAL[1]) | x.endswith(TERMINAL[2]) | x.endswith(TERMINAL[3]) | x.endswith(TERMINAL[4])
    rows = rows.select(
        "doc_id", *carry,
        share(F.size(F.filter("l", ends)), F.size("l")).alias("line_punct"),
        share(F.size(F.filter("l", lambda x: F.length(x) <= short)), F.size("l")).alias("short_lines"),
        share(_chars(F.col("l")) - _chars(F.array_distinct("l")), _chars(F.col("l"))).alias("char_dup"),
        share(F.length("_t") - F.length(F.replace("_t", F.lit("\n"), F.lit(""))), F.col("n")).alias("newline_ratio"),
    )
    return rows.withColumn("keep", (F.col("line_punct") > 0.1) & (F.col("short_lines") < 0.67) & (F.col("char_dup") < 0.1) & (F.col("newline_ratio") <= 0.3))


def _weighing(weights: Column):
    return lambda a, x: a + weights[x]


def flagged_words(
    docs: DataFrame, scores: dict[str, int | None] | dict[str, dict[str, int | None]], threshold: float = 0.01, keep_fraction: float = 0.1, seed: str = "flagged", mode: str = "as_written",
    carry: tuple[str, ...] = (), lang: str | None = None,
) -> DataFrame:
    """``n_flagged, ratio, keep``: weights 2^(score-5) of the flagged phrases found, over the number of words.

    Matches use up the character on either side. ``mode='as_written'`` counts a phrase's blanks, so single words weigh
    nothing; ``'syllables'`` counts its words. Rejected documents stay with probability ``keep_fraction`` by hash.
    With ``lang`` naming a column, ``scores`` has a list for each language, and documents of others are accepted.
    """
    found, ratio = F.lit(0).cast("bigint"), F.lit(0.0)
    n = F.size(T.words(F.col("text")))
    for language, words in scores.items() if lang else [("", scores)]:
        low = {w.lower(): 2.0 ** ((x or 3) - 5) * (len(w.split(" ")) - (mode == "as_written")) for w, x in words.items()}
        pattern = "|".join(sorted((re.escape(w).replace("\\ ", " ") for w in low), key=lambda w: (-len(w), w)))
        f = F.regexp_extract_all(F.lower("text"), F.lit(rf"(?:[^\p{{L}}\p{{N}}_]|^)({pattern})(?:[^\p{{L}}\p{{N}}_]|$)"), F.lit(1))
        weights = F.create_map(*[F.lit(x) for kv in low.items() for x in kv])
        mine = F.col(lang) == language if lang else F.lit(True)
        found = F.when(mine, F.size(f).cast("bigint")).otherwise(found)
        ratio = F.when(mine, share(F.aggregate(f, F.lit(0.0), _weighing(weights)), n)).otherwise(ratio)
    rows = docs.select("doc_id", *carry, found.alias("n_flagged"), ratio.alias("ratio"))
    return rows.withColumn("keep", (F.col("ratio") <= threshold) | (T.hash_bucket(F.col("doc_id"), seed) < int(keep_fraction * 1000)))


def blocked_domains(docs: DataFrame, url: Column, blocklist: DataFrame, out: str = "blocked") -> DataFrame:
    """Add ``out``: whether the address's host or registered domain is in ``blocklist`` (column ``domain``).

    The list is broadcast if it is small enough, else joined by shuffle; rows without an address aren't blocked.
    """
    names = sized(blocklist.select(F.lower("domain").alias("_name")).where("_name is not null").distinct())
    rows = docs.withColumn("_host", F.lower(T.host(url))).withColumn("_site", F.lower(T.registered_domain(url)))
    for c in ("_host", "_site"):
        rows = rows.join(names.withColumn(f"{c}_in", F.lit(True)).withColumnRenamed("_name", f"{c}_name"), F.col(c) == F.col(f"{c}_name"), "left").drop(f"{c}_name")
    return rows.withColumn(out, F.coalesce("_host_in", "_site_in", F.lit(False))).drop("_host", "_site", "_host_in", "_site_in")


def with_whitelist(rejected: Column, url: Column, domains: tuple[str, ...], allow_no_url: bool = True) -> Column:
    """Whether a row is kept: whitelisted domains pass, rows without a URL too (or raise), others if not ``rejected``."""
    base = F.when(T.registered_domain(url).isin(*domains), F.lit(True)).otherwise(~F.coalesce(rejected, F.lit(False)))
    none = F.lit(True) if allow_no_url else F.raise_error(F.lit("a document has no url")).cast("boolean")
    return F.when(url.isNull(), none).otherwise(base)


def language_of(text: Column, lists: dict[str, tuple[str, ...]]) -> Column:
    """A struct of ``detected``, the language with most stop-word hits (ties: the first by name; ``und`` without any), and
    ``score``, its share of the words. Any other classifier may stand in for it that gives such a struct."""

    def among(ws):
        return lambda x: x.isin(*ws)

    def best(w: Column) -> Column:
        scored = F.array(*[F.struct(F.size(F.filter(w, among(ws))).alias("n"), F.lit(-i).alias("o"), F.lit(k).alias("lang")) for i, (k, ws) in enumerate(sorted(lists.items()))])
        return F.transform(F.array(F.array_max(scored)), lambda b: F.struct(F.when(b["n"] > 0, b["lang"]).otherwise("und").alias("detected"), share(b["n"], F.size(w)).alias("score")))[0]

    return F.transform(F.array(T.words(F.lower(text))), best)[0]


def language_scores(docs: DataFrame, lists: dict[str, tuple[str, ...]], carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, detected, score``, a row for each row of ``docs``."""
    return docs.select("doc_id", *carry, language_of(F.col("text"), lists).alias("_l")).select("doc_id", *carry, "_l.detected", "_l.score")


def quantile_bounds(values: DataFrame, column: str, low: float = 0.2, high: float = 0.8, digits: int = 1) -> DataFrame:
    """One row ``lo, hi`` of quantiles of the rounded values, weighted by how often each occurs."""
    hist = values.select(F.round(F.col(column).cast("double"), digits).alias("v")).where("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    p = hist.agg(F.percentile("v", F.array(F.lit(low), F.lit(high)), F.col("n")).alias("p"))
    return p.select(F.col("p")[0].alias("lo"), F.col("p")[1].alias("hi"))


def quantile_filter(values: DataFrame, column: str, low: float = 0.2, high: float = 0.8, keep_fraction: float = 0.1, seed: str = "quantile", digits: int = 1) -> DataFrame:
    """Keep rows within the bounds, and others by hash with probability ``keep_fraction``."""
    rows = values.crossJoin(F.broadcast(quantile_bounds(values, column, low, high, digits)))  # one row
    inside = F.col(column).between(F.col("lo"), F.col("hi"))
    return rows.withColumn("keep", inside | (T.hash_bucket(F.col("doc_id"), seed) < int(keep_fraction * 1000)))


def unigram_model(docs: DataFrame) -> DataFrame:
    """``word, logp``: each word's log probability with one added to every count; the null word stands for all others."""
    counts = stored(docs.select(F.explode(T.words(F.col("text"))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")), "unigrams")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("t"), F.count(F.lit(1)).alias("v")).first()
    below = float(total["t"] + total["v"] + 1)
    other = counts.sparkSession.createDataFrame([(None, 0)], "word string, n bigint")
    return counts.unionByName(other).select("word", F.log((F.col("n") + 1) / F.lit(below)).alias("logp"))


def perplexity(docs: DataFrame, model: DataFrame, hot: int = 200_000, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``doc_id, ppl``: exp of the mean negative log probability of a document's words. Ids name the documents.

    A model of at most ``limit`` words is broadcast, so that words are looked up where they are and a row a document is
    shuffled. Of a larger one the ``hot`` likeliest words are, which most rows have; only rarer ones are shuffled to
    theirs. Sums are exact, whatever the order: log probabilities are added as whole numbers of 2^-30 and of 2^-60.
    Documents without words have no row.
    """
    unit = float(1 << 30)
    parts = lambda x: [F.floor(x * unit).alias("hi"), F.round((x * unit - F.floor(x * unit)) * unit).cast("bigint").alias("lo")]
    other = model.where("word is null").select(*parts(F.col("logp"))).first()
    known = model.where("word is not null").select("word", *parts(F.col("logp")), "logp")
    whole = known.limit(limit + 1).count() <= limit
    # at most `limit` or `hot` rows of a word and two numbers
    top = known.drop("logp") if whole else stored(known.orderBy(F.desc("logp"), "word").limit(hot).drop("logp"), "hot-words")
    words = docs.select("doc_id", F.explode(T.words(F.col("text"))).alias("word")).join(F.broadcast(top), "word", "left")
    if whole:
        rows = words.select("doc_id", F.lit(1).alias("n"), F.coalesce("hi", F.lit(other["hi"])).alias("hi"), F.coalesce("lo", F.lit(other["lo"])).alias("lo"))
    else:
        # a row for the hot words of a document, and one for each other word
        rare = F.when(F.col("hi").isNull(), F.col("word"))
        sums = stored(words.groupBy("doc_id", rare.alias("word")).agg(F.count(F.lit(1)).alias("n"), F.sum("hi").alias("hi"), F.sum("lo").alias("lo")), "words")
        cold = known.join(F.broadcast(top.select("word")), "word", "left_anti").select("word", F.col("hi").alias("_hi"), F.col("lo").alias("_lo"))
        rest = sums.where("word is not null").drop("hi", "lo").join(cold, "word", "left")
        rest = rest.select("doc_id", "n", *[(F.col("n") * F.coalesce(f"_{c}", F.lit(other[c]))).alias(c) for c in ("hi", "lo")])
        rows = sums.where("word is null").drop("word").unionByName(rest)
    sums = rows.groupBy("doc_id").agg(F.sum("n").alias("n"), F.sum("hi").alias("hi"), F.sum("lo").alias("lo"))
    return sums.select("doc_id", F.exp(-(F.col("hi") / F.lit(unit) + F.col("lo") / F.lit(unit * unit)) / F.col("n")).alias("ppl"))
