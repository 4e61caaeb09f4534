"""License scans: exact seeds of pigeonhole-split notices, then bounded-error matching."""

from __future__ import annotations

import bisect
import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from .arrow import ALNUM, FOLD, with_columns, words

#: Label, words of the notice, edits (of characters, spaces included) that a match may have.
BASE = (
    ("cc-by", "cc by", 0),
    ("gpl", "general public license", 0),
    ("reserved", "all rights reserved", 0),
)
MORE = (
    ("agpl-notice", "gnu affero general public license", 3),
    ("apache-notice", "licensed under the apache license version 2 0", 4),
    ("bsd-notice", "redistribution and use in source and binary forms", 4),
    ("cc-notice", "licensed under a creative commons", 3),
    ("cc-by-nc-notice", "licensed under cc by nc 4 0", 2),
    ("copyright-notice", "copyright c", 0),
    ("gpl-notice", "licensed under the gnu general public license", 4),
    ("lgpl-notice", "gnu lesser general public license", 3),
    ("mit-notice", "released under the mit license", 3),
    ("mit-grant", "permission is hereby granted free of charge", 4),
    ("mpl-notice", "mozilla public license", 2),
    ("public-domain", "dedicated to the public domain", 3),
    ("reserved-notice", "all rights reserved", 2),
    ("unlicense", "free and unencumbered software", 3),
)


@dataclass(frozen=True)
class Notice:
    label: str
    phrase: str
    edits: int

    @property
    def seeds(self) -> list[tuple[str, int]]:
        """``edits + 1`` parts and where they begin: an occurrence with that many edits leaves one of them intact."""
        cuts = [round(i * len(self.phrase) / (self.edits + 1)) for i in range(self.edits + 2)]
        return [(self.phrase[a:b], a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _whole_words(text: str, lo: int, hi: int) -> bool:
    return text[lo - 1] == " " and text[hi] == " "


class Scanner:
    """Finds notices in texts whose words are joined, and surrounded, by single spaces."""

    def __init__(self, notices: tuple[tuple[str, str, int], ...]) -> None:
        self.notices = [Notice(*n) for n in notices]
        # the first word may be cut by an edit only at its own place, so a match begins and ends at words
        self._patterns = {n: regex.compile(f"(?b)(?<= )(?P<m>{regex.escape(n.phrase, literal_spaces=True)}){{e<={n.edits}}}(?= )") for n in self.notices}

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """``(start, end, notice, edits)``, by start; matches of one notice do not overlap but for exact ones."""
        out = []
        for k, n in enumerate(self.notices):
            if n.edits == 0:
                at = text.find(n.phrase)
                while at >= 0:
                    if _whole_words(text, at, at + len(n.phrase)):
                        out.append((at, at + len(n.phrase), k, 0))
                    at = text.find(n.phrase, at + 1)
                continue
            places = set()
            for seed, place in n.seeds:
                at = text.find(seed)
                while at >= 0:
                    # a match begins within ``edits`` of where the seed puts it, and ends likewise
                    places.add((max(at - place - n.edits - 1, 0), min(at - place + len(n.phrase) + n.edits + 1, len(text))))
                    at = text.find(seed, at + 1)
            out += [(s, e, k, x) for s, e, x in self._near(n, text, places)]
        return sorted(out)

    def _near(self, n: Notice, text: str, places: set[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """Best matches first; where one is taken, what lies before and behind it in a place is searched again."""
        heap: list[tuple[int, int, int, int, int]] = []
        taken: list[tuple[int, int, int]] = []

        def search(lo: int, hi: int) -> None:
            if hi - lo >= len(n.phrase) - n.edits + 2 and (m := self._patterns[n].search(text, lo, hi)):
                heapq.heappush(heap, (sum(m.fuzzy_counts), m.start("m"), m.end("m"), lo, hi))

        for lo, hi in places:
            search(lo, hi)
        while heap:
            edits, start, end, lo, hi = heapq.heappop(heap)
            at = bisect.bisect_left(taken, (end,)) - 1
            if at >= 0 and taken[at][1] > start:
                start, end, _ = taken[at]
            else:
                taken.insert(at + 1, (start, end, edits))
            search(lo, min(start, hi))
            search(max(end, lo), hi)
        return taken


_FIELDS = [
    StructField("n_words", LongType()),
    StructField("n_base", LongType()),
    StructField("first_word", LongType()),
    StructField("last_word", LongType()),
    StructField("base_labels", StringType()),
    StructField("labels", StringType()),
    StructField("score", DoubleType()),
    StructField("spans", ArrayType(StructType([StructField("label", StringType()), StructField("start", LongType()), StructField("end", LongType()), StructField("edits", IntegerType())]))),
]


def licenses(docs: DataFrame, base: tuple = BASE, more: tuple = MORE, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words, n_base, first_word, last_word, base_labels, labels, score, spans``.

    Words are runs of ASCII letters (folded) and digits and of everything beyond ASCII. A base
    notice stands where its words follow one another; the others may differ by a few characters.
    ``spans`` lists every match with its first and last-plus-one byte in the text and its edits,
    by place. ``score`` is the best match's share of unchanged characters, 0.0 without a match.

    Null, empty and wordless texts have no words, no places (null first and last), empty labels.
    Overlapping and equal places count each. Repeated rows give equal results; columns of these
    names are replaced, others stay. Whole texts are scanned where they are read.
    """

    def make():  # noqa: ANN202
        scanner = Scanner((*base, *more))
        n_base = len(base)
        seeds = sorted({s for n in scanner.notices for s, _ in n.seeds}, key=len)
        seeds = [s.encode() for i, s in enumerate(seeds) if not any(t in s for t in seeds[:i])]

        def call(batch: pa.RecordBatch, data: np.ndarray, offs: np.ndarray) -> list[pa.Array]:
            starts, ends, first = words(data, offs, ALNUM)
            folded = FOLD[data]
            rows = []
            for d in range(batch.num_rows):
                lo, hi = int(first[d]), int(first[d + 1])
                n = hi - lo
                if not n:
                    rows.append((0, 0, None, None, "", "", 0.0, []))
                    continue
                # words joined by spaces, one byte for each byte of the text
                a, b = starts[lo:hi], ends[lo:hi]
                length = b - a
                at = np.cumsum(length + 1) - length
                body = np.full(int(at[-1] + length[-1]) + 1, 0x20, np.uint8)
                pos = np.repeat(at - (np.cumsum(length) - length), length) + np.arange(length.sum())
                body[pos] = folded[np.repeat(a - (np.cumsum(length) - length), length) + np.arange(length.sum())]
                raw = body.tobytes()
                if not any(s in raw for s in seeds):
                    rows.append((n, 0, None, None, "", "", 0.0, []))
                    continue
                found = scanner.find(raw.decode("utf-8"))
                if found and not raw.isascii():  # places of characters to places of bytes
                    byte = np.append(np.flatnonzero((body & 0xC0) != 0x80), len(body)).tolist()
                    found = [(byte[s], byte[e], k, x) for s, e, k, x in found]
                w0 = np.searchsorted(at, [f[0] for f in found], "right") - 1
                w1 = np.searchsorted(at, [f[1] - 1 for f in found], "right") - 1
                spans = [{"label": scanner.notices[k].label, "start": int(a[i] + max(0, s - at[i]) - offs[d]), "end": int(a[j] + min(e - at[j], length[j]) - offs[d]), "edits": x} for (s, e, k, x), i, j in zip(found, w0.tolist(), w1.tolist(), strict=True)]
                places = [i for (_, _, k, _), i in zip(found, w0.tolist(), strict=True) if k < n_base]
                own = {scanner.notices[k].label for _, _, k, _ in found if k < n_base}
                every = {scanner.notices[k].label for _, _, k, _ in found}
                score = max((1 - x / len(scanner.notices[k].phrase) for _, _, k, x in found), default=0.0)
                rows.append((n, len(places), min(places, default=None), max(places, default=None), ",".join(sorted(own)), ",".join(sorted(every)), score, spans))
            return [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32())]))))]

        return call

    return with_columns(docs, text, _FIELDS, make)
