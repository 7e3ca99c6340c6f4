"""Language-model scoring by compression cross-entropy.

Word counts are taken over all documents, and over all in-domain ones, in one aggregation. Either count fills a
zstandard dictionary: the words with most weight (count times length), the heaviest last, where the compressor reaches
them with the shortest offsets. A text's size under the in-domain dictionary stands for its in-domain cross-entropy,
the size under the general one for the general cross-entropy:

    score = (general size - in-domain size) / general size

The larger, the more the text is like the in-domain documents. A text is compressed in windows of ``window`` bytes of
its UTF-8 form, each on its own, and the windows' sizes are added up; in one piece a long text would be its own
dictionary and its score would fall with its length. All windows of all texts are compressed.

:func:`lm_scores` uses these dictionaries of bounded size; :func:`corpus_scores`, which the query runs, adds to them all
pieces of text that other rows hold, so that they grow with the corpus.

In-domain documents are those with a row in ``in_domain``; without any, both dictionaries are equal and all scores 0.
Null and empty texts have sizes and score 0. Repeated rows count and are scored each. Of equal weights the smaller word
goes first. Null and repeated doc_ids in ``in_domain`` don't matter. Other columns are ignored. An empty table gives an
empty result. A dictionary holds ``size`` bytes; words that are longer than that are left out of it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ngram_join import _fragment, _starts, word_hashes
from .shared import stored, with_sized_broadcast

DICTIONARY_BYTES, WINDOW, LEVEL, PIECE_WORDS = 32_768, 512, 3, 32
SCORES = "doc_id bigint, in_domain_size bigint, general_size bigint, score double"


def word_counts(docs: DataFrame, in_domain: DataFrame) -> DataFrame:
    """``word, n, n_in`` over all documents and over the in-domain ones."""
    chosen = in_domain.select(F.col("doc_id").alias("_in")).where("_in is not null").distinct()
    flagged = docs.select("doc_id", "text").join(with_sized_broadcast(chosen), F.col("doc_id") == F.col("_in"), "left")
    words = flagged.select(F.col("_in").isNotNull().cast("bigint").alias("i"), F.explode(F.split(F.col("text"), r"[\t\n\x0B\f\r ]+")).alias("word"))
    return words.where("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum("i").alias("n_in"))


def dictionary(counts: DataFrame, column: str, size: int = DICTIONARY_BYTES) -> bytes:
    """The heaviest words by ``column`` times length, as many as ``size`` bytes hold, the heaviest last."""
    weight = F.col(column) * F.octet_length("word")
    # no word is shorter than a byte and a blank, so this bound on the rows is never the one that cuts
    top = counts.where((F.col(column) > 0) & (F.octet_length("word") < size)).orderBy(weight.desc(), "word").limit(size // 2).select("word").collect()
    words, used = [], 0
    for (w,) in top:
        raw = w.encode() + b" "
        if used + len(raw) > size:
            break
        words.append(raw)
        used += len(raw)
    return b"".join(reversed(words))


def sizer(content: bytes, window: int = WINDOW):
    """A function from bytes to the sum of their windows' compressed sizes under a dictionary."""
    known = {"dict_data": zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)} if len(content) >= 8 else {}
    setting = zstandard.ZstdCompressionParameters.from_level(LEVEL, source_size=window, dict_size=len(content), write_content_size=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
    compress = zstandard.ZstdCompressor(compression_params=setting, **known).compress
    return lambda raw: sum([len(compress(raw[i : i + window])) for i in range(0, len(raw), window)])


def lm_scores(docs: DataFrame, in_domain: DataFrame, size: int = DICTIONARY_BYTES, window: int = WINDOW) -> DataFrame:
    """``doc_id, in_domain_size, general_size, score``, a row for each row of ``docs``."""
    counts = stored(word_counts(docs, in_domain), "word-counts")
    general = dictionary(counts, "n", size)
    inside = dictionary(counts, "n_in", size) or general

    def run(batches):
        a, b_ = sizer(inside, window), sizer(general, window)
        for b in batches:
            raw = [t.encode() if t else b"" for t in b.column(1).to_pylist()]
            x = [a(t) for t in raw]
            y = [b_(t) for t in raw]
            score = [round((g - i) / g, 6) if g else 0.0 for i, g in zip(x, y)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.int64()), pa.array(y, pa.int64()), pa.array(score, pa.float64())], names=["doc_id", "in_domain_size", "general_size", "score"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCORES)


# scores under dictionaries that grow with the corpus

_CUT = "batch bigint, fragment bigint, first bigint, members binary, counts binary, inside binary, ids array<bigint>, chosen binary, ends binary, pieces binary, sizes binary"
_CUT_ARROW = pa.schema(
    [("batch", pa.int64()), ("fragment", pa.int64()), ("first", pa.int64()), ("members", pa.binary()), ("counts", pa.binary()), ("inside", pa.binary()), ("ids", pa.list_(pa.int64()))]
    + [(c, pa.binary()) for c in ("chosen", "ends", "pieces", "sizes")]
)


def cut_pieces(raw: bytes, words: int = PIECE_WORDS) -> list[bytes]:
    """``raw`` cut after each word whose hash is a multiple of ``words``, so that equal passages are cut alike anywhere."""
    if not raw:
        return []
    solid = np.frombuffer(raw, np.uint8) > 32
    ends = np.flatnonzero(solid & ~np.append(solid[1:], False)) + 1
    cuts = ends[word_hashes(raw) % np.uint64(words) == 0].tolist()
    if not cuts or cuts[-1] < len(raw):
        cuts.append(len(raw))
    return [raw[a:b] for a, b in zip([0, *cuts], cuts)]


class MatchSizes(dict):
    """The size of a piece, by its length, under a dictionary that holds it: one match, so the content doesn't matter."""

    def __missing__(self, length: int) -> int:
        if length < 8:  # too short for a dictionary
            return length + 16
        content = np.random.default_rng(length).bytes(length)
        self[length] = sizer(content, max(length, 1))(content)
        return self[length]


def _cut(inside: bytes, general: bytes, fragments: int, piece_words: int, most_docs: int, most_bytes: int):
    """Arrow batches of (doc_id, text, chosen) to rows for the fragments and one row of each batch's own.

    A batch sends each fragment its distinct pieces there with the number of its rows, and of its in-domain rows, that
    hold them; which row holds which, and what a piece costs, stays in the batch's own row (without a fragment).
    """

    def flush(ids, chosen, rows, hashes, sizes, place):
        h = np.array(hashes, np.uint64)
        ends = np.cumsum([len(r) for r in rows])
        at = np.array([p for r in rows for p in r], np.int64)
        row = np.repeat(np.arange(len(rows)), np.diff(ends, prepend=0))
        held = np.unique(row * max(1, len(h)) + at)  # a piece counts once a row
        once, by = held % max(1, len(h)), np.array(chosen, bool)[held // max(1, len(h))] if len(held) else np.empty(0, bool)
        order = np.argsort(h)
        n, n_in = (np.bincount(x, minlength=len(h))[order].astype(np.uint32) for x in (once, once[by]))
        rank = np.empty(len(h), np.int32)
        rank[order] = np.arange(len(h), dtype=np.int32)
        h = h[order]
        key = xxhash.xxh64_intdigest(h.tobytes() + at.tobytes(), seed=xxhash.xxh64_intdigest(str(place))) >> 1
        frag = _fragment(h, fragments)
        first = _starts(frag).tolist()
        out = [(key, int(frag[a]), a, h[a:b].tobytes(), n[a:b].tobytes(), n_in[a:b].tobytes(), *[None] * 5) for a, b in zip(first, [*first[1:], len(h)])]
        cost = np.array(sizes, np.int32).reshape(-1, 3)[order]
        out.append((key, None, None, None, None, None, ids, np.array(chosen, bool).tobytes(), ends.astype(np.int64).tobytes(), rank[at].tobytes(), cost.tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _CUT_ARROW)], schema=_CUT_ARROW)

    def run(batches):
        context = TaskContext.get()
        x, y, match = sizer(inside, 1 << 30), sizer(general, 1 << 30), MatchSizes()
        number, size = 0, 0
        ids, chosen, rows, hashes, sizes, known = [], [], [], [], [], {}
        for b in batches:
            for i, t, c in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                raw = (t.as_py() or "").encode("utf-8", "surrogatepass")
                row = []
                for p in cut_pieces(raw, piece_words):
                    h = xxhash.xxh64_intdigest(p)
                    at = known.get(h)
                    if at is None:
                        at = known[h] = len(hashes)
                        hashes.append(h)
                        sizes.append((x(p), y(p), match[len(p)]))
                    row.append(at)
                ids.append(i)
                chosen.append(c)
                rows.append(row)
                size += len(raw)
                if len(ids) >= most_docs or size >= most_bytes:
                    yield flush(ids, chosen, rows, hashes, sizes, (context.partitionId(), number))
                    number, size = number + 1, 0
                    ids, chosen, rows, hashes, sizes, known = [], [], [], [], [], {}
        if ids:
            yield flush(ids, chosen, rows, hashes, sizes, (context.partitionId(), number))

    return run


def _held(table: pa.Table) -> pa.Table:
    """For each piece that a batch sent: bit 0 if two rows of the corpus hold it, above it the in-domain rows, 2 at most."""
    h, n, n_in = (np.concatenate([np.frombuffer(v.as_py(), kind) for v in table.column(c)]) for c, kind in (("members", np.uint64), ("counts", np.uint32), ("inside", np.uint32)))
    order = np.argsort(h)
    first = _starts(h[order])
    total, total_in = (np.add.reduceat(c[order].astype(np.int64), first) for c in (n, n_in))
    flags = np.empty(len(h), np.uint8)
    flags[order] = np.repeat((total > 1) + 2 * np.minimum(total_in, 2), np.diff(np.append(first, len(h))))
    lengths = [len(v.as_py()) // 8 for v in table.column("members")]
    parts = [f.tobytes() for f in np.split(flags, np.cumsum(lengths)[:-1])]
    return pa.table({"batch": table.column("batch"), "first": table.column("first"), "flags": pa.array(parts, pa.binary())})


def _summed(domain: bool):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        own = next(r for r in rows if r["ids"] is not None)
        flags = np.frombuffer(b"".join(r["flags"] for r in sorted((r for r in rows if r["ids"] is None), key=lambda r: r["first"])), np.uint8)
        ends, at, cost = np.frombuffer(own["ends"], np.int64), np.frombuffer(own["pieces"], np.int32), np.frombuffer(own["sizes"], np.int32).reshape(-1, 3).astype(np.int64)
        row = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        f = flags[at]
        shared = (f & 1).astype(bool)
        # in-domain rows other than the row itself
        others = (f >> 1) > np.frombuffer(own["chosen"], bool)[row] if domain else shared
        inside, general = (np.where(k, np.minimum(cost[at, c], cost[at, 2]), cost[at, c]) for c, k in ((0, others), (1, shared)))
        x, y = (np.diff(np.append(0, np.cumsum(v))[ends], prepend=0) for v in (inside, general))
        return pa.table({"doc_id": pa.array(own["ids"], pa.int64()), "in_domain_size": x, "general_size": y, "score": np.round((y - x) / np.maximum(y, 1), 6)})

    return run


def corpus_scores(
    docs: DataFrame, in_domain: DataFrame, size: int = DICTIONARY_BYTES, piece_words: int = PIECE_WORDS, per_fragment: int = 1_000_000, most_docs: int = 20_000, most_bytes: int = 16_000_000
) -> DataFrame:
    """``doc_id, in_domain_size, general_size, score`` as :func:`lm_scores`, under dictionaries that grow with the corpus.

    Beside the heaviest words, the general dictionary holds every piece of text that two rows of ``docs`` hold, and the
    in-domain one every piece that an in-domain row other than the scored one holds. Pieces are about ``piece_words``
    words long and end where the words say (:func:`cut_pieces`). No task could hold such a dictionary, so each piece is
    compressed under the words, and, where it is in the dictionary, as the one match that it then is; the smaller size
    counts. A text's size is the sum over all of its pieces. Whether a piece is in the dictionary comes from exact
    counts over all rows (of 64-bit hashes): batches of rows send every fragment of the hash order their distinct
    pieces and get bits back, so a piece that a third of all rows hold costs each batch one entry.

    Nulls, ties, repeated rows (which hold each other's pieces), empty tables and other columns: as in the module's text.
    """
    counts = stored(word_counts(docs, in_domain), "word-counts")
    general = dictionary(counts, "n", size)
    words = dictionary(counts, "n_in", size)
    total = counts.agg(F.sum("n")).first()[0] or 0
    fragments = max(1, -(-total // (piece_words * per_fragment)))
    chosen = in_domain.select(F.col("doc_id").alias("_in")).where("_in is not null").distinct()
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).join(with_sized_broadcast(chosen), F.col("doc_id") == F.col("_in"), "left")
    rows = rows.select("doc_id", "text", F.col("_in").isNotNull().alias("chosen"))
    cut = stored(rows.mapInArrow(_cut(words or general, general, fragments, piece_words, most_docs, most_bytes), _CUT), "pieces")
    flags = cut.where("fragment is not null").select("fragment", "batch", "first", "members", "counts", "inside").groupBy("fragment").applyInArrow(_held, "batch bigint, first bigint, flags binary")
    own = cut.where("fragment is null").select("batch", "ids", "chosen", "ends", "pieces", "sizes")
    return flags.unionByName(own, allowMissingColumns=True).groupBy("batch").applyInArrow(_summed(bool(words)), SCORES)
