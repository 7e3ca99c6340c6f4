"""Fuzzy search for short licence notices.

A notice may occur with up to ``errors`` edits (inserted, dropped or changed characters), whatever its case and white
space. A match with e edits leaves one of any e + 1 pieces of the notice untouched (pigeonhole), so the pieces are exact
seeds: each text is searched for them, and the ``regex`` library verifies the surroundings of the hits with bounded errors
and gives the span.

Of all matches of a notice the one with fewest edits is taken, the leftmost of several, then the best of those that don't
overlap it, and so on; so the spans of one notice never overlap. Every hit of a seed is verified in its own surroundings,
not much longer than the notice, so the work is linear in the hits however densely they lie. Where spans of different
notices overlap, the one with fewer edits stays (the leftmost, then the longest, then the first in the table). Spans are
character positions in the original text. White space runs count as one blank; case is folded character by character
where that keeps the length.

Null and empty texts have no matches. Repeated rows give their matches each. Notices shorter than ``errors`` + 1
characters aren't allowed. Other columns of the input are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_right

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ERRORS = 3
_GNU = "licensed under the GNU {}General Public License, version {}"
NOTICES = {
    "MIT": "Released under the MIT License",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "GPL-3.0": _GNU.format("", "3"),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "BSD-3-Clause": "Redistribution and use in source and binary forms",
    "MPL-2.0": "subject to the terms of the Mozilla Public License, v. 2.0",
    "ISC": "Permission to use, copy, modify, and/or distribute this software",
    "Unlicense": "free and unencumbered software released into the public domain",
    "All-Rights-Reserved": "All rights reserved",
    # kinds and versions within a few edits of those above, so that none is taken for its neighbour
    **{f"CC-{kind}-{v}": f"Licensed under CC {kind} {v}" for v in ("4.0", "3.0", "2.5", "2.0", "1.0") for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")},
    "CC0-1.0": "Licensed under CC0 1.0",
    "GPL-2.0": _GNU.format("", "2"),
    "GPL-1.0": _GNU.format("", "1"),
    "LGPL-3.0": _GNU.format("Lesser ", "3"),
    "LGPL-2.1": _GNU.format("Lesser ", "2.1"),
    "LGPL-2.0": _GNU.format("Lesser ", "2"),
    "LGPL-2.0-Library": _GNU.format("Library ", "2"),
    "AGPL-3.0": _GNU.format("Affero ", "3"),
    "AGPL-1.0": _GNU.format("Affero ", "1"),
    "Apache-1.1": "Licensed under the Apache License, Version 1.1",
    "Apache-1.0": "Licensed under the Apache License, Version 1.0",
    "MPL-1.1": "subject to the terms of the Mozilla Public License, v. 1.1",
    "MPL-1.0": "subject to the terms of the Mozilla Public License, v. 1.0",
}
MATCHES = "doc_id bigint, license string, span_start int, span_end int, n_edits int, matched string"
_SPACE = re.compile(r"\s+")
_WIDE = re.compile(r"\s{2,}|[^\S ]")


def _folded(text: str) -> tuple[str, list[int] | None]:
    """Lower case with single blanks, and the original position of each character (None: the same)."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    if not _WIDE.search(low):
        return low, None
    out, at, end = [], [], 0
    for m in _SPACE.finditer(low):
        out += [low[end : m.start()], " "]
        at += [*range(end, m.start()), m.start()]
        end = m.end()
    out.append(low[end:])
    at += range(end, len(low))
    return "".join(out), at


def _positions(folded: str, seed: str) -> list[int]:
    out, at = [], folded.find(seed)
    while at >= 0:
        out.append(at)
        at = folded.find(seed, at + 1)
    return out


class Notice:
    def __init__(self, name: str, text: str, errors: int):
        self.name, self.text, self.errors = name, _SPACE.sub(" ", text.lower()).strip(), errors
        if len(self.text) <= errors:
            raise ValueError(f"{name}: shorter than errors + 1 characters")
        cuts = [len(self.text) * i // (errors + 1) for i in range(errors + 2)]
        self.seeds = [(a, self.text[a:b]) for a, b in zip(cuts, cuts[1:])]
        self.pattern = regex.compile(f"(?b)(?:{regex.escape(self.text, special_only=True)}){{e<={errors}}}")

    def matches(self, folded: str, hits: dict[str, list[int]] | None = None) -> list[tuple[int, int, int]]:
        """(start, end, edits) of the matches; ``hits`` keeps the seeds' positions in this text for notices that have the same ones."""
        hits = {} if hits is None else hits
        windows = set()
        for a, seed in self.seeds:
            if seed not in hits:
                hits[seed] = _positions(folded, seed)
            windows.update([(max(0, at - a - self.errors), min(len(folded), at - a + len(self.text) + self.errors)) for at in hits[seed]])
        if not windows:
            return []
        found: list[tuple[int, int, int, int, int]] = []
        for a, b in windows:
            self._verify(folded, a, b, found)
        heapq.heapify(found)
        starts: list[int] = []
        taken: list[tuple[int, int, int]] = []
        while found:
            edits, s, e, a, b = heapq.heappop(found)
            # what others have taken of this window since it was searched
            i = bisect_right(starts, a)
            before = taken[i - 1][1] if i else 0
            i0 = i
            while i < len(taken) and taken[i][0] < b:
                i += 1
            cuts = [(max(a, before), max(a, before)), *[(x, y) for x, y, _ in taken[i0:i]], (b, b)]
            if before <= a and i == i0:
                at = bisect_right(starts, s)
                starts.insert(at, s)
                taken.insert(at, (s, e, edits))
                cuts = [(a, a), (s, e), (b, b)]
            for (_, x), (y, _) in zip(cuts, cuts[1:]):
                free: list[tuple[int, int, int, int, int]] = []
                self._verify(folded, x, y, free)
                for m in free:
                    heapq.heappush(found, m)
        return taken

    def _verify(self, folded: str, a: int, b: int, out: list[tuple[int, int, int, int, int]]) -> None:
        if b - a >= len(self.text) - self.errors and (m := self.pattern.search(folded[a:b])):
            out.append((sum(m.fuzzy_counts), a + m.start(), a + m.end(), a, b))


def find_notices(text: str | None, notices: list[Notice]) -> list[tuple[str, int, int, int, str]]:
    """(licence, start, end, edits, matched text) of one text."""
    if not text:
        return []
    folded, at = _folded(text)
    out = []
    hits: dict[str, list[int]] = {}
    order = {n.name: i for i, n in enumerate(notices)}
    for n in notices:
        for s, e, edits in n.matches(folded, hits):
            x, y = (s, e) if at is None else (at[s], at[e - 1] + 1)
            out.append((n.name, x, y, edits, text[x:y]))
    taken: list[tuple[int, int]] = []  # in order; they don't overlap
    stay = []
    for m in sorted(out, key=lambda m: (m[3], m[1], -m[2], order[m[0]])):
        i = bisect_right(taken, (m[1], m[2]))
        if (not i or taken[i - 1][1] <= m[1]) and (i == len(taken) or m[2] <= taken[i][0]):
            taken.insert(i, (m[1], m[2]))
            stay.append(m)
    return sorted(stay, key=lambda m: (m[1], m[2], m[0]))


def scan_licenses(docs: DataFrame, notices: dict[str, str] | None = None, errors: int = ERRORS) -> DataFrame:
    """A row ``doc_id, license, span_start, span_end, n_edits, matched`` for each notice found."""
    texts = NOTICES if notices is None else notices
    names = MATCHES.replace(",", "").split()[::2]
    kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string())
    [Notice(k, v, errors) for k, v in texts.items()]

    def run(batches):
        compiled = [Notice(k, v, errors) for k, v in texts.items()]
        for b in batches:
            rows = [(i, *m) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for m in find_notices(t, compiled)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, MATCHES)
