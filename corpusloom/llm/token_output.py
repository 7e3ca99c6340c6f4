"""Token ids as frequency ranks in a byte-aligned variable-length code with separate control bytes.

The corpus is tokenised once into a table of plain ids in the shared folder. Its id counts, over all documents, give
the ranks: the most frequent id is 0, ties go to the smaller id. Each document's ranks are then coded with one to four
bytes each; two bits a number, four numbers a control byte, say how many, and control and data bytes are kept apart,
so numpy decodes whole arrays by looking the control bytes up in a table.

Null texts have null counts and codes, empty ones no tokens and empty codes. Repeated rows are coded each. An empty
table gives an empty result and an empty rank table. Other columns of the input are ignored. The rank table has at
most as many rows as the vocabulary; it is broadcast.
"""

from __future__ import annotations

import base64
import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.lru_cache(2)
def tokenizer(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


#: Runs of white space (as the pattern's ``\\s`` has it) that are too long for the pattern's backtracking.
_LONG = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{5000,}")


def token_ids(t, text: str) -> list[int]:
    """The ids of a text. Of a long run of white space all but the last character is one piece, as the pattern would have it."""
    if len(text) < 5000 or not _LONG.search(text):
        return t.encode_ordinary(text)
    out: list[int] = []
    start = 0
    for m in _LONG.finditer(text):
        out += t.encode_ordinary(text[start : m.start()])
        start = m.end() - (m.end() < len(text))
        out += t._encode_single_piece(text[m.start() : start])
    return out + t.encode_ordinary(text[start:])


_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1
_MASKS = np.array([0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def encode(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit numbers."""
    v = np.ascontiguousarray(values, "<u4")
    extra = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    padded = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    padded[: len(v)] = extra
    control = padded.reshape(-1, 4) @ np.array([1, 4, 16, 64], np.uint8)
    data = v.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def decode(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers that :func:`encode` coded."""
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    at = np.cumsum(lengths) - lengths
    raw = np.frombuffer(data + b"\0\0\0", np.uint8).astype(np.uint32)
    wide = raw[at] | raw[at + 1] << 8 | raw[at + 2] << 16 | raw[at + 3] << 24 if n else np.empty(0, np.uint32)
    return wide & _MASKS[lengths - 1]


def tokenised(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id`` and the ids of each text as little-endian 32-bit numbers (16-bit ones where the vocabulary allows)."""

    def run(batches):
        t = tokenizer(vocabulary)
        kind = "<u2" if t.n_vocab <= 1 << 16 else "<u4"
        for b in batches:
            ids = [None if x is None else np.array(token_ids(t, x), kind).tobytes() for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id bigint, ids binary")


def id_ranks(ids: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``token_id, n, rank`` of every id that occurs, from counts that each task adds up before they are sent."""

    def run(batches):
        size = tokenizer(vocabulary).n_vocab
        kind = "<u2" if size <= 1 << 16 else "<u4"
        counts = np.zeros(size, np.int64)
        for b in batches:
            raw = b"".join(x for x in b.column(0).to_pylist() if x)
            counts += np.bincount(np.frombuffer(raw, kind), minlength=size)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], names=["token_id", "n"])

    summed = ids.select("ids").mapInArrow(run, "token_id int, n bigint").groupBy("token_id").agg(F.sum("n").alias("n"))
    return summed.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "token_id")) - 1)  # at most the vocabulary's rows


def encode_corpus(docs: DataFrame, vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """(``doc_id, n_tokens, control, data``, the rank table ``token_id, n, rank``)."""
    ids = stored(tokenised(docs, vocabulary), "token-ids")
    ranks = stored(id_ranks(ids, vocabulary), "token-ranks")
    got = ranks.select("token_id", "rank").toPandas()
    size = int(got["token_id"].max()) + 1 if len(got) else 1
    rank_of = np.zeros(size, np.uint32)
    rank_of[got["token_id"].to_numpy(np.int64)] = got["rank"].to_numpy()
    wide = tokenizer(vocabulary).n_vocab > 1 << 16

    def run(batches):
        kind = "<u4" if wide else "<u2"
        for b in batches:
            n, control, data = [], [], []
            for x in b.column(1).to_pylist():
                v = None if x is None else rank_of[np.frombuffer(x, kind)]
                c, d = (None, None) if x is None else encode(v)
                n.append(None if x is None else len(v))
                control.append(c)
                data.append(d)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(control, pa.binary()), pa.array(data, pa.binary())], names=["doc_id", "n_tokens", "control", "data"])

    return ids.mapInArrow(run, "doc_id bigint, n_tokens bigint, control binary, data binary"), ranks


def decode_corpus(encoded: DataFrame, ranks: DataFrame) -> DataFrame:
    """``doc_id`` and ``token_ids`` of a coded corpus."""
    got = ranks.select("token_id", "rank").toPandas().sort_values("rank")
    id_of = got["token_id"].to_numpy(np.int64)

    def run(batches):
        for b in batches:
            ids = [None if n is None else id_of[decode(c, d, n)] for n, c, d in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "token_ids"])

    return encoded.select("doc_id", "n_tokens", "control", "data").mapInArrow(run, "doc_id bigint, token_ids array<int>")
