"""Search for license notices that tolerates typing errors.

Words are lower-cased and joined by single spaces.  A notice may differ by k edits; split into
k + 1 pieces, one of them must stand in the text unchanged.  One automaton finds all pieces; only
around a piece found does the ``regex`` library match the notice with bounded errors, which gives
the span and its edits.  Base phrases are looked up exactly.

Defined cases: a null or empty text has no words and no labels; repeated rows and null ids are
scanned like others; no rows give no rows.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Exact phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Notices by label, as words; a match may have an edit for each EDIT_EVERY characters.
NOTICES = [
    ("apache", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification"),
    ("cc-by", "creative commons attribution"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("gpl", "licensed under the gnu general public license"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "released under the mit license"),
    ("mpl", "subject to the terms of the mozilla public license"),
    ("public-domain", "released into the public domain"),
    ("reserved", "all rights reserved"),
]
EDIT_EVERY = 10

# A-Z to a-z; other ASCII characters but digits and letters to spaces.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

_worker: dict = {}


def pieces_of(notice: str, edits: int) -> list[tuple[int, str]]:
    """``edits`` + 1 pieces that make up the notice, with their places."""
    cuts = [round(i * len(notice) / (edits + 1)) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class NoticeSearch:
    def __init__(self, notices=None, edit_every: int = EDIT_EVERY):
        import ahocorasick
        import regex

        self.notices, seeds = [], {}
        for label, notice in NOTICES if notices is None else notices:
            edits = len(notice) // edit_every
            n = len(self.notices)
            self.notices.append((label, len(notice), edits, regex.compile(
                rf"(?<![^ ])(?:{regex.escape(notice)}){{e<={edits}}}(?![^ ])",
                regex.BESTMATCH)))
            for at, piece in pieces_of(notice, edits):
                seeds.setdefault(piece, []).append((n, at))
        self.seeds = ahocorasick.Automaton()
        for piece, places in seeds.items():
            self.seeds.add_word(piece, (len(piece), places))
        self.seeds.make_automaton()

    def windows(self, line: str) -> dict[int, list[list[int]]]:
        """Stretches of ``line`` by notice in which it may stand; overlapping ones are joined."""
        found: dict[int, list[list[int]]] = {}
        for last, (size, places) in self.seeds.iter(line):
            for n, at in places:
                _, length, edits, _ = self.notices[n]
                begin = last + 1 - size - at - edits
                mine = found.setdefault(n, [])
                mine.append([max(0, begin - 1), begin + length + 2 * edits + 1])
        for n, mine in found.items():
            mine.sort()
            joined = mine[:1]
            for begin, end in mine[1:]:
                if begin <= joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], end)
                else:
                    joined.append([begin, end])
            found[n] = joined
        return found

    def notices_in(self, line: str) -> list[tuple[str, int, int, int, float]]:
        """(label, start, end, edits, likeness) of every notice found, in order."""
        out = []
        for n, stretches in self.windows(line).items():
            label, length, most, pattern = self.notices[n]
            parts = [(begin, min(end, len(line))) for begin, end in stretches]
            while parts:
                at, end = parts.pop()
                for m in pattern.finditer(line, at, end):
                    edits = sum(m.fuzzy_counts)
                    out.append((label, m.start(), m.end(), edits, 1 - edits / length))
                    # The best match comes first: worse ones may stand before it.
                    if m.start() - at >= length - most:
                        parts.append((at, m.start()))
                    at = m.end()
        return sorted(out)

    def scan(self, text: str) -> dict:
        words = text.encode("utf-8", "surrogatepass").translate(_FOLD).split()
        line = b" ".join(words).decode("utf-8", "surrogatepass")
        padded = f" {line} "
        base = []
        for phrase, label in BASE.items():
            at = padded.find(f" {phrase} ")
            while at >= 0:
                base.append((padded.count(" ", 0, at), label))
                at = padded.find(f" {phrase} ", at + 1)
        near = self.notices_in(line)
        starts = [w for w, _ in base]
        spans = []
        if base or near:
            where = [m.span() for m in _WORD.finditer(text)]
            for phrase_at, label in base:
                size = next(p.count(" ") for p, name in BASE.items() if name == label)
                spans.append((where[phrase_at][0], where[phrase_at + size][1], label, 0))
            for label, begin, end, edits, _ in near:
                first = line.count(" ", 0, begin + (line[begin] == " "))
                last = line.count(" ", 0, end - (line[end - 1] == " "))
                spans.append((where[first][0], where[last][1], label, edits))
        base_labels = {label for _, label in base}
        return {
            "n_words": len(words), "n_base": len(base),
            "first_word": min(starts, default=None), "last_word": max(starts, default=None),
            "base_labels": ",".join(sorted(base_labels)),
            "labels": ",".join(sorted(base_labels | {x[0] for x in near})),
            "score": 1.0 if base else max((x[4] for x in near), default=0.0),
            "spans": [{"start": a, "end": b, "label": c, "edits": d}
                      for a, b, c, d in sorted(set(spans))],
        }


_SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, "
           "base_labels string, labels string, score double, "
           "spans array<struct<start: int, end: int, label: string, edits: int>>")
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()),
    ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()),
    ("labels", pa.string()), ("score", pa.float64()),
    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()),
                                  ("label", pa.string()), ("edits", pa.int32())])))])


def scan_notices(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Labels, places and spans (code points of the text, end exclusive) for every row."""
    def work(batches):
        if "search" not in _worker:
            _worker["search"] = NoticeSearch()
        search = _worker["search"]
        for batch in batches:
            rows = [{"doc_id": d} | search.scan(t.as_py() or "")
                    for d, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)]
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return docs.select(F.col(id_col).cast("long"), F.col(text).cast("string")).mapInArrow(
        work, _SCHEMA)
