"""Toxicity by compression distance.

Two zstandard dictionaries are trained with zstandard's own trainer on labelled documents: one on ordinary text, one on
toxic text without the words that ordinary text has as well. Text is given to the trainer and to the compressor as a
sequence of word codes (the word's 64-bit hash; words are runs of letters, lower-cased), so that a match means a whole
word, never syllables that happen to occur inside another one. The toxic dictionary is followed by the content of the
ordinary one, so only toxic words tell the two apart. A window of ``window`` words is compressed with either; the bytes
that the toxic dictionary saves are the window's distance. Windows are disjoint blocks, so a passage across a border is
shared out between two windows and its distance falls.

A word is toxic text's own if at least ``SHARE`` of the toxic documents (and three) have it, ``ODDS`` times the share of
ordinary documents that do. The ordinary dictionary is trained on the ``ORDINARY_WORDS`` most widespread words.

The threshold on a document's largest window distance is calibrated on labelled documents that training didn't see:
the cut with the best F1, midway where several cuts are equally good. ``sample`` bounds the labelled documents of
each class used for fitting, ``SAMPLE_BYTES`` the text of a class that is sent to the driver: of the documents that have
a label, those with the smallest hash of their doc_id are taken, near copies among them count once. Scoring covers every
block of every document, the last, shorter one included.

Null and empty texts have no windows, score 0 and aren't toxic. With fewer than ``LEAST`` documents of either class
nothing can be trained: all scores are 0 and nothing is toxic. Repeated rows get the same score each; a doc_id that is
labelled more than once counts as toxic if any label says so, one that has several texts stands for its smallest.
Labels without a document and null labels are ignored and take up no part of the sample.
Other columns of the input are ignored by :func:`toxicity_scores` and kept by :func:`keep_ordinary`.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ngram_join import ngram_set
from .shared import bound_batches, stored

WINDOW, SAMPLE, SAMPLE_BYTES, ORDINARY_WORDS, LEAST = 32, 4000, 64_000_000, 400, 5
ODDS, SHARE = 20, 0.01
_KNOWN = 150_000
_WORD = re.compile(r"[^\W\d_]+")


class Codes(dict):
    """Word to code, kept up to a bound."""

    def __missing__(self, word: str) -> bytes:
        code = xxhash.xxh64_digest(word.encode("utf-8", "surrogatepass"))
        if len(self) >= _KNOWN:
            self.clear()
        self[word] = code
        return code


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass
class Model:
    """The two dictionaries' contents and the calibrated thresholds."""

    ordinary: bytes
    toxic: bytes
    window: int
    threshold: float

    def scorer(self):
        """A function from a text to (largest distance of a window, windows, windows at or above the threshold)."""
        # tables that hold the whole dictionary: smaller ones overwrite entries, and then the two dictionaries differ on
        # ordinary words as well
        log = max(13, len(self.toxic).bit_length())
        setting = zstandard.ZstdCompressionParameters.from_level(
            3, source_size=self.window * 8, dict_size=len(self.toxic), write_content_size=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
            min_match=6, strategy=zstandard.STRATEGY_LAZY, hash_log=log, chain_log=log + 1, search_log=7, window_log=max(17, log + 1),
        )
        plain, toxic = (
            zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=setting).compress for d in (self.ordinary, self.toxic)
        )
        codes, n, cut = Codes(), self.window, self.threshold

        def score(text: str) -> tuple[int, int, int]:
            w = [codes[x] for x in _words(text)]
            most = windows = hits = 0
            for i in range(0, len(w), n):
                e = b"".join(w[i : i + n])
                d = len(plain(e)) - len(toxic(e))
                windows += 1
                if d > most:
                    most = d
                hits += d >= cut
            return most, windows, hits

        return score


def _unlike(texts: list[str]) -> list[str]:
    """Leave out texts of which a fifth or more of the 5-grams were seen in earlier ones (by a bitmap of their hashes)."""
    seen = np.zeros(1 << 24, np.uint8)
    out = []
    for t in texts:
        h = ngram_set(t, 5) >> np.uint64(37)
        at, bit = (h >> np.uint64(3)).astype(np.int64), np.uint8(1) << (h & np.uint64(7)).astype(np.uint8)
        if np.count_nonzero(seen[at] & bit) < 0.2 * max(1, len(h)):
            out.append(t)
        np.bitwise_or.at(seen, at, bit)
    return out


def _trained(sequences: list[list[str]]) -> bytes:
    """A dictionary that zstandard trains on word sequences, about twice as large as their distinct words.

    Where there is too little for its trainer, the distinct words' codes themselves, the most frequent last.
    """
    codes = Codes()
    counts = Counter(w for s in sequences for w in s)
    samples = [b"".join([codes[w] for w in s[i : i + 8]]) for s in sequences for i in range(0, len(s), 8)]
    try:
        return zstandard.train_dictionary(16 * len(counts) + 512, samples, k=16, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"\0" * 8 + b"".join([codes[w] for w in sorted(counts, key=lambda w: (counts[w], w))])


def _dictionaries(toxic: list[str], plain: list[str], ordinary_words: int) -> tuple[bytes, bytes]:
    words = [[_words(t) for t in texts] for texts in (toxic, plain)]
    df_t, df_o = (Counter(w for s in texts for w in set(s)) for texts in words)
    common = set(sorted(df_o, key=lambda w: (df_o[w], w))[-ordinary_words:])
    few = max(3, SHARE * len(toxic))
    own = {w for w, c in df_t.items() if c >= few and c / len(toxic) >= ODDS * (df_o[w] + 0.5) / max(1, len(plain))}
    ordinary = _trained([[w for w in s if w in common] for s in words[1]])
    return ordinary, _trained([[w for w in s if w in own] for s in words[0]]) + ordinary


def fit(rows: list[tuple[int, str, int]], window: int = WINDOW, ordinary_words: int = ORDINARY_WORDS) -> Model | None:
    """A model from (doc_id, text, toxic) rows; None if there are too few of either class."""
    rows = sorted((r for r in rows if r[1]), key=lambda r: (xxhash.xxh64_intdigest(str(r[0])), r[1]))
    by = {k: _unlike([t for _, t, x in rows if bool(x) == k]) for k in (True, False)}
    if min(len(x) for x in by.values()) < LEAST:
        return None
    train = {k: v[: math.ceil(0.7 * len(v))] for k, v in by.items()}
    held = {k: v[len(train[k]) :] or v for k, v in by.items()}
    score = Model(*_dictionaries(train[True], train[False], ordinary_words), window, 3).scorer()
    got = {k: Counter(score(t)[0] for t in v) for k, v in held.items()}
    best: list[tuple[float, int]] = []
    for cut in range(3, max(max(c, default=3) for c in got.values()) + 2):
        caught, false = (sum(n for d, n in got[k].items() if d >= cut) for k in (True, False))
        best.append((2 * caught / max(1, caught + false + len(held[True])), cut))
    top = max(f for f, _ in best)
    good = [c for f, c in best if f == top]
    return Model(*_dictionaries(by[True], by[False], ordinary_words), window, good[(len(good) - 1) // 2])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, window: int = WINDOW, sample_bytes: int = SAMPLE_BYTES) -> Model | None:
    """Fit on at most ``sample`` labelled documents and ``sample_bytes`` of text of each class."""
    bound_batches(docs.sparkSession)
    flags = labels.select("doc_id", F.col("toxic").cast("int").alias("flag")).where("doc_id is not null and flag is not null").groupBy("doc_id").agg(F.max("flag").alias("flag"))
    sized = docs.select("doc_id", F.octet_length(F.col("text").cast("string")).alias("n")).where("n > 0").join(flags, "doc_id").groupBy("doc_id").agg(F.max("n").alias("n"), F.max("flag").alias("flag"))
    picked = None
    for k in (1, 0):
        part = sized.where((F.col("flag") == k) if k == 0 else (F.col("flag") != 0)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        upto = F.sum("n").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))  # at most `sample` rows
        part = part.withColumn("upto", upto).where((F.col("upto") <= sample_bytes) | (F.col("upto") == F.col("n"))).select("doc_id", "flag")
        picked = part if picked is None else picked.unionByName(part)
    picked = stored(picked, "toxicity-sample")
    # at most 2 * sample rows: a bound that doesn't grow with the corpus
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text <> ''").join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("flag").alias("flag"))
    return fit([(r["doc_id"], r["text"], r["flag"]) for r in rows.collect()], window)


def _scored(model: Model | None, at: int):
    def run(batches):
        score = model.scorer() if model else lambda text: (0, 0, 0)
        for batch in batches:
            # a few hundred texts as Python strings at a time
            for i in range(0, batch.num_rows, 500):
                b = batch.slice(i, 500)
                yield b, [score(t) if t else (0, 0, 0) for t in b.column(at).to_pylist()]

    return run


def toxicity_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, window: int = WINDOW) -> DataFrame:
    """``doc_id, distance, n_windows, n_toxic_windows, is_toxic``, a row for each row of ``docs``."""
    model = train(docs, labels, sample, window)
    scored = _scored(model, 1)

    def run(batches):
        for b, got in scored(batches):
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array([g[i] for g in got], pa.int32()) for i in range(3)], pa.array([g[2] > 0 for g in got], pa.bool_())],
                names=["doc_id", "distance", "n_windows", "n_toxic_windows", "is_toxic"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, distance int, n_windows int, n_toxic_windows int, is_toxic boolean")


def keep_ordinary(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, window: int = WINDOW) -> DataFrame:
    """The documents that aren't toxic, columns unchanged."""
    model = train(docs, labels, sample, window)
    scored = _scored(model, docs.columns.index("text"))

    def run(batches):
        for b, got in scored(batches):
            yield b.filter(pa.array([g[2] == 0 for g in got], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
