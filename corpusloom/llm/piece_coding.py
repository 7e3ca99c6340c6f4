"""Exact SentencePiece encoding and decoding for merge-type (BPE) models.

A text is cut where no piece can reach across, and each unit is encoded by backtracking: an Aho-Corasick automaton
gives the longest piece at every position; a piece may follow another only if merging the two pieces' text again gives
just these two (checked once a pair, then remembered); where it may not, the next shorter piece is tried, and a
bitfield holds the positions from which no way leads on. Units are remembered, up to a bound, as texts repeat words.

Characters that no piece has become the byte pieces of their UTF-8 form, or the unknown piece in models without them.
Null texts have null ids; empty ones have none. Repeated rows are encoded each. Other columns of the input are
ignored. An empty table gives an empty result. Models with a character map in their normaliser aren't supported.
"""

from __future__ import annotations

import functools
import re
import struct

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_META = "▁"
_KNOWN = 1_200_000


def _fields(data: bytes):
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 0x7F) << shift
            shift += 7
            if b < 0x80:
                return out

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        else:
            size = varint() if kind == 2 else 8 if kind == 1 else 4
            value = data[at : at + size]
            at += size
        yield key >> 3, value


class PieceModel:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            model = list(_fields(f.read()))
        self.pieces: list[str] = []
        self.score: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.bytes: dict[int, int] = {}
        self.control: set[int] = set()
        self.unknown = 0
        for n, message in model:
            if n != 1:
                continue
            piece = dict(_fields(message))
            text, score, kind = piece[1].decode(), struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0, piece.get(3, 1)
            i = len(self.pieces)
            self.pieces.append(text)
            if kind in (1, 4):
                self.score[text], self.ids[text] = score, i
            elif kind == 6:
                self.bytes[int(text[3:5], 16)] = i
            elif kind == 2:
                self.unknown = i
            else:
                self.control.add(i)
        trainer = dict(_fields(next((m for n, m in model if n == 2), b"")))
        if trainer.get(3, 1) != 2:
            raise ValueError("not a merge-type model")
        rules = dict(_fields(next((m for n, m in model if n == 3), b"")))
        if rules.get(2) or rules.get(4, 1):
            raise ValueError("this normaliser isn't supported")
        self.dummy = bool(rules.get(3, 1))
        self.apart = not any(re.search(f"[^{_META}]{_META}", p) for p in self.ids)
        self.chars = {p for p in self.ids if len(p) == 1}
        self.line_end = self._unknown("\n") if "\n" not in "".join(self.ids) else None
        self.shorter: dict[str, str | None] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.find = ahocorasick.Automaton()
        for p in self.ids:
            if self.merge(p) == [p]:
                self.find.add_word(p, p)
        self.find.make_automaton()
        for p in self.find:
            self.shorter[p] = next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in self.find), None)
        self.plain, self.marked = _Known(self, ""), _Known(self, _META)
        raw = {i: bytes([b]) for b, i in self.bytes.items()}
        self.text = [raw.get(i, b"" if i in self.control else " ⁇ ".encode() if i == self.unknown else p.replace(_META, " ").encode()) for i, p in enumerate(self.pieces)]

    def _unknown(self, c: str) -> list[int]:
        return [self.bytes[b] for b in c.encode()] if self.bytes else [self.unknown]

    def merge(self, text: str) -> list[str]:
        """The pieces of a text by plain merging: again and again the best pair, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fit(self, left: str, right: str) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= 600_000:
                self.pairs.clear()
            known = self.pairs[left, right] = self.merge(left + right) == [left, right]
        return known

    def backtrack(self, text: str) -> list[str]:
        """The pieces of a text whose characters all are pieces."""
        longest: list[str | None] = [None] * len(text)
        for end, piece in self.find.iter(text):
            start = end + 1 - len(piece)
            if longest[start] is None or len(piece) > len(longest[start]):
                longest[start] = piece
        out: list[str] = []
        blocked, at, n = 0, 0, len(text)
        piece = longest[0]
        fit, shorter = self.fit, self.shorter
        while at < n or not out:
            while piece is not None:
                end = at + len(piece)
                if not blocked >> end & 1 and (not out or fit(out[-1], piece)):
                    out.append(piece)
                    at = end
                    piece = longest[at] if at < n else None
                    break
                piece = shorter[piece]
            else:
                if not out:
                    raise ValueError(f"{text!r} can't be encoded")
                blocked |= 1 << at
                piece = out.pop()
                at -= len(piece)
                continue
        return out

    def unit(self, text: str) -> list[int]:
        """The ids of a unit; runs of characters that no piece has come between."""
        out: list[int] = []
        start = 0
        for i, c in enumerate(text):
            if c not in self.chars:
                if i > start:
                    out += [self.ids[p] for p in self.backtrack(text[start:i])]
                out += self._unknown(c)
                start = i + 1
        if start < len(text):
            out += [self.ids[p] for p in self.backtrack(text[start:])]
        return out

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        if not self.apart:
            return np.array(self.unit((_META if self.dummy else "") + text.replace(" ", _META)), np.int32)
        if "▁" in text:
            text = text.replace(_META, " ")
        lines = text.split("\n") if self.line_end else [text]
        end = np.array(self.line_end or [], np.int32).tobytes()
        plain, marked = self.plain, self.marked
        out = []
        for k, line in enumerate(lines):
            words = line.split(" ")
            mark = self.dummy and not k
            if "" in words:
                joined = (_META if mark else "") + _META.join(words)
                out.append(b"".join([plain[u] for u in re.findall(f"{_META}*[^{_META}]+|{_META}+", joined)]))
            else:
                first = (marked if mark else plain)[words[0]]
                out.append(first + b"".join([marked[w] for w in words[1:]]))
        return np.frombuffer(end.join(out), np.int32)

    def decode(self, ids) -> str:
        """The text of ids; a blank that the model puts before texts is taken off again."""
        got = b"".join(map(self.text.__getitem__, ids)).decode("utf-8", "replace")
        return got[1:] if self.dummy and got.startswith(" ") else got


class _Known(dict):
    def __init__(self, model: PieceModel, before: str):
        self.model, self.before = model, before

    def __missing__(self, word: str) -> bytes:
        ids = np.array(self.model.unit(self.before + word), np.int32).tobytes()
        if len(self) >= _KNOWN:
            self.clear()
        self[word] = ids
        return ids


@functools.lru_cache(2)
def model(path: str = MODEL) -> PieceModel:
    return PieceModel(path)


def encode_pieces(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """``doc_id, n_pieces, piece_ids`` and ``round_trip``, whether decoding gives the text back."""

    def run(batches):
        m = model(path)
        for b in batches:
            texts = b.column(1).to_pylist()
            ids = [None if t is None else m.encode(t) for t in texts]
            sizes = np.array([0, *(0 if x is None else len(x) for x in ids)])
            flat = np.concatenate([x for x in ids if x is not None and len(x)] or [np.empty(0, np.int32)])
            null = np.array([x is None for x in ids])
            offsets = np.cumsum(sizes).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()), mask=pa.array(null)) if null.any() else pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
            back = [None if t is None else m.decode(x.tolist()) == t for t, x in zip(texts, ids)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([None if x is None else len(x) for x in ids], pa.int64()), lists, pa.array(back, pa.bool_())], names=["doc_id", "n_pieces", "piece_ids", "round_trip"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id bigint, n_pieces bigint, piece_ids array<int>, round_trip boolean")


def decode_pieces(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """``doc_id, text`` from ``doc_id, piece_ids``."""

    def run(batches):
        m = model(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([None if x is None else m.decode(x) for x in b.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "piece_ids").mapInArrow(run, "doc_id bigint, text string")
