"""Fill-in-middle: texts cut at two places between units and put into another order between marks.

A unit is a run of white space with the word behind it. The matcher goes over a text twice: it counts
the units, then walks a lazy iterator of matches to the two places. Neither pass keeps units, so a
text of any length needs its own bytes and no more.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .arrow import releasing, small_batches

#: A word with the white space before it, or white space that no word follows.
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


@dataclass(frozen=True)
class Infill:
    """Marks that enclose nothing of each other, like ``<P>``; shares in hundredths; the seed of all draws."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    plain_percent: int = 50
    spm_percent: int = 80
    seed: int = 42

    def draws(self, doc_id: int | None) -> list[int]:
        """Four 32-bit numbers that depend on the seed and the id alone; a null id is drawn for as an empty one."""
        key = f"{self.seed}:{'' if doc_id is None else doc_id}"
        digest = hashlib.sha256(key.encode()).digest()
        return [int.from_bytes(digest[4 * k : 4 * k + 4], "big") for k in range(4)]


def count_units(text: str) -> int:
    """First pass: matches are counted as they come, one is kept."""
    last = deque(enumerate(UNIT.finditer(text), 1), maxlen=1)
    return last[0][0] if last else 0


def unit_ends(text: str, low: int, high: int) -> tuple[int, int]:
    """Second pass: the places after ``low`` and after ``high`` units (``low <= high``), by one lazy iterator."""
    matches = UNIT.finditer(text)
    first = next(islice(matches, low - 1, None)).end() if low else 0
    if high == low:
        return first, first
    return first, next(islice(matches, high - low - 1, None)).end()


def transform(text: str, doc_id: int | None, rule: Infill) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, characters of prefix and middle, and the output of one text."""
    n = count_units(text)
    h1, h2, h3, h4 = rule.draws(doc_id)
    if not text or any(mark in text for mark in (rule.prefix, rule.suffix, rule.middle)) or h3 % 100 >= 100 - rule.plain_percent:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = unit_ends(text, low, high)
    if h4 % 100 < rule.spm_percent:
        return n, "spm", a, b - a, "".join((rule.suffix, text[b:], rule.prefix, text[:a], rule.middle, text[a:b]))
    return n, "psm", a, b - a, "".join((rule.prefix, text[:a], rule.suffix, text[b:], rule.middle, text[a:b]))


def infill(docs: DataFrame, rule: Infill = Infill(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output``, one row for each row of ``docs``.

    ``form`` is ``plain`` (the text as it is), ``psm`` or ``spm``; lengths are code points, null where plain.

    A null text counts as empty; an empty text and one that holds a mark stay plain. Null ids are all
    drawn for alike. Repeated rows give repeated results; other columns are ignored, whatever their
    names; an empty table gives an empty result. Nothing is shuffled, and a lost task is made again
    with the same draws.
    """
    small_batches(docs.sparkSession)
    fields = [StructField("n", LongType()), StructField("form", StringType()), StructField("prefix_chars", LongType()), StructField("middle_chars", LongType()), StructField("output", StringType())]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    schema = StructType([StructField("doc_id", LongType()), *fields])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            # a row at a time: long texts are not held twice as Python strings
            rows = [transform(texts[k].as_py() or "", ids[k].as_py(), rule) for k in range(batch.num_rows)]
            cols = [pa.array([r[k] for r in rows], kinds[k]) for k in range(len(kinds))]
            yield pa.RecordBatch.from_arrays([ids, *cols], names=schema.names)

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(lambda it: releasing(run(it)), schema)


def restored(output: Column, form: Column, rule: Infill = Infill()) -> Column:
    """The text that an output was made of: marks are found from the left, none occurs within a part."""
    marks = {"psm": (rule.prefix, rule.suffix, rule.middle), "spm": (rule.suffix, rule.prefix, rule.middle)}

    def parts(first: str, second: str, third: str) -> tuple[Column, Column, Column]:
        body = F.substring(output, F.lit(len(first) + 1), F.length(output))
        one = F.substring_index(body, second, 1)
        rest = F.substring(body, F.length(one) + len(second) + 1, F.length(body))
        two = F.substring_index(rest, third, 1)
        return one, two, F.substring(rest, F.length(two) + len(third) + 1, F.length(rest))

    p, s, m = parts(*marks["psm"])
    s2, p2, m2 = parts(*marks["spm"])
    return F.when(form == "psm", F.concat(p, m, s)).when(form == "spm", F.concat(p2, m2, s2)).otherwise(output)
