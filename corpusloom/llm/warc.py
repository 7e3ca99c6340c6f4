"""WARC records as a table of chunks.

:func:`write_warc` turns rows of (identifier, url, payload) into gzipped WARC 1.1 files with Spark's text writer; the
records are built by column expressions. :func:`read_warc` streams WARC files, plain or gzipped (one member or many),
block by block into rows of (record_id, chunk_no): a payload of any length is cut every ``chunk_bytes`` bytes, each
row has the SHA-256 of the payload up to its end, and neither a file nor a record is ever held in memory.

Identifiers and urls that a header line can't hold as they are (line breaks, blanks at an end) are percent-encoded, and
a header of its own says so; :func:`read_warc` gives them back as they were and leaves all other values alone.

Null payloads and payloads without bytes give one empty chunk 0. A null url leaves out WARC-Target-URI and is read as
null. Null identifiers give the record id ``<urn:page:>``. Rows that repeat an identifier give their own chunks each.
An empty table gives no files' worth of records and no chunks. A truncated file raises ValueError, and so does a
header without Content-Length. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import urllib.parse
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import fresh_path

CHUNK_BYTES, BLOCK = 16_384, 1 << 18
CHUNKS = "record_id string, url string, chunk_no bigint, byte_start bigint, n_bytes bigint, payload binary, digest string, is_last boolean"


_ENCODED = "x-percent-encoded"


def _encoded(value: Column) -> Column:
    out = value
    for c, code in (("%", "%25"), ("\r", "%0D"), ("\n", "%0A")):
        out = F.replace(out, F.lit(c), F.lit(code))
    for pattern, code in (("^ ", "%20"), ("^\t", "%09"), (" $", "%20"), ("\t$", "%09")):
        out = F.regexp_replace(out, pattern, code)
    return out


def write_warc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html") -> None:
    """Write a gzipped WARC file for each partition of ``pages`` into the folder ``path``."""
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    i, u = F.coalesce(F.col(key).cast("string"), F.lit("")), F.col(url).cast("string")
    odd = i.rlike("[\r\n]") | F.coalesce(u.rlike("[\r\n]|^[ \t]|[ \t]$"), F.lit(False))
    head = lambda i, u, extra: F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), i, F.lit(f">\r\n{extra}"), F.when(u.isNull(), F.lit("")).otherwise(F.concat(F.lit("WARC-Target-URI: "), u, F.lit("\r\n")))
    )
    record = F.concat(
        F.when(odd, head(_encoded(i), _encoded(u), f"{_ENCODED}: 1\r\n")).otherwise(head(i, u, "")),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body,
    )
    pages.select(record.alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


class _Stream:
    """Bytes of a file, unpacked as they are asked for."""

    def __init__(self, file, packed: bool):
        self.file, self.packed, self.rest = file, packed, b""
        self.unpack = zlib.decompressobj(31) if packed else None
        self.waiting, self.fed = b"", False

    def _more(self) -> bytes:
        if not self.packed:
            return self.file.read(BLOCK)
        while True:
            raw = self.waiting or self.file.read(BLOCK)
            self.waiting = b""
            if not raw:
                out = self.unpack.flush() if self.fed and not self.unpack.eof else b""
                if self.fed and not self.unpack.eof:
                    raise ValueError("a gzip member ends early")
                return out
            self.fed = True
            if self.unpack.eof:
                raw = raw.lstrip(b"\0")
                if not raw:
                    continue
                self.unpack = zlib.decompressobj(31)
            out = self.unpack.decompress(raw, BLOCK * 4)
            self.waiting = self.unpack.unconsumed_tail or self.unpack.unused_data
            if out:
                return out

    def line(self) -> bytes | None:
        while (at := self.rest.find(b"\n")) < 0:
            if not (more := self._more()):
                if self.rest:
                    raise ValueError("a header ends early")
                return None
            self.rest += more
        line, self.rest = self.rest[: at + 1], self.rest[at + 1 :]
        return line.rstrip(b"\r\n")

    def some(self, n: int) -> bytes:
        if not self.rest:
            self.rest = self._more()
            if not self.rest:
                raise ValueError("a payload ends early")
        out, self.rest = self.rest[:n], self.rest[n:]
        return out


def chunks(file, packed: bool, chunk_bytes: int) -> Iterator[tuple]:
    """The chunk rows of one open file."""
    stream = _Stream(file, packed)
    while (line := stream.line()) is not None:
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        head: dict[str, str] = {}
        while line := stream.line():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            head[name.strip().lower()] = value.strip(" \t")
        if "content-length" not in head:
            raise ValueError("a record has no Content-Length")
        names = [head.get("warc-record-id"), head.get("warc-target-uri")]
        if _ENCODED in head:
            names = [x and urllib.parse.unquote(x) for x in names]
        left, no, start, digest = int(head["content-length"]), 0, 0, hashlib.sha256()
        while left or not no:
            parts, size = [], 0
            while size < chunk_bytes and left:
                parts.append(stream.some(min(chunk_bytes - size, left)))
                size += len(parts[-1])
                left -= len(parts[-1])
                digest.update(parts[-1])
            yield *names, no, start, size, b"".join(parts), digest.hexdigest(), not left
            no, start = no + 1, start + size


def _reader(chunk_bytes: int, batch_bytes: int = 4 << 20):
    kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.bool_())
    names = CHUNKS.replace(",", "").split()[::2]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches):
        for b in batches:
            for path in b.column(0).to_pylist():
                fs, inner = pyarrow.fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
                rows, size = [], 0
                with fs.open_input_stream(inner, compression=None) as file:
                    for row in chunks(file, path.endswith(".gz"), chunk_bytes):
                        rows.append(row)
                        size += row[4] + 200
                        if size >= batch_bytes:
                            yield batch(rows)
                            rows, size = [], 0
                if rows:
                    yield batch(rows)

    return run


def read_warc(spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunk rows of all ``*.warc``, ``*.txt`` and ``.gz`` files in ``path``; a task takes a file."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{warc,warc.gz,txt,txt.gz}").option("recursiveFileLookup", True).load(path).select("path")
    n = max(1, files.count())
    return files.repartitionByRange(n, "path").mapInArrow(_reader(chunk_bytes), CHUNKS)


def warc_chunks(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """``pages`` written as WARC into the shared folder and read again as chunk rows."""
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write_warc(pages, path, key, url, payload)
    return read_warc(spark, path, chunk_bytes)
