"""UTF-8 bytes of Arrow text columns as numpy arrays: words, hashes, row chunks.

Every helper works on the whole text of a chunk of rows at once: ``data`` holds the bytes of
all rows one after the other, ``offs`` the place where each row begins (one more entry than
rows). A null text has no bytes.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

#: Bytes of text that are worked on at once; one longer text makes a chunk of its own.
CHUNK_BYTES = 2 << 20

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32

#: Words between ASCII white space.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False

#: Words of ASCII digits, letters and everything beyond ASCII, after folding.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
#: Powers of the base and its inverse are kept for chunks of so many bytes; longer ones are made and forgotten.
_KEPT_POWERS = 1 << 22
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: Words of more bytes are hashed one by one.
_WORD_BYTES = 64


#: Bytes of a batch that a Python worker is sent at once; Spark's own bound is eight times that.
BATCH_BYTES = "8m"


def small_batches(spark: SparkSession) -> None:
    """Bounds what a worker holds of long texts. The setting is of the session, read when a plan starts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def release() -> None:
    """Gives memory that a task no longer needs back to the system; workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def releasing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``batches``, and ``release`` at their end."""
    try:
        yield from batches
    finally:
        release()


def released(work: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """``work`` on one group, and ``release`` after it."""

    def run(t: pa.Table) -> pa.Table:
        try:
            return work(t)
        finally:
            release()

    return run


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, values = col.buffers()
    offs = np.frombuffer(offsets, np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(values, np.uint8)[offs[0] : offs[-1]] if values else np.zeros(0, np.uint8)
    return data, offs - offs[0]


def row_chunks(offs: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``limit`` bytes together, one row at least."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def text_chunks(batches: Iterable[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        data, offs = buffers(batch.column(text))
        for lo, hi in row_chunks(offs, limit):
            yield batch.slice(lo, hi - lo), data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]


def _power_table(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.cumprod(p)


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > _KEPT_POWERS:
        return _power_table(_BASE, n), _power_table(_INVERSE, n)
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            _powers[k] = _power_table(base, max(n, 1 << 16))
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Hasher:
    """Hashes of windows of one chunk, from prefix sums of a polynomial modulo 2**64.

    Different windows may be made to agree on purpose, so equal hashes only say where to compare bytes.
    """

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        powers, self._inverse = _grown(n + 1)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLE[data] * powers[:n], out=self._sums[1:])

    def windows(self, width: int) -> np.ndarray:
        """Of the ``width`` bytes from each place on."""
        s = self._sums
        if len(s) <= width:
            return np.zeros(0, np.uint64)
        return mix((s[width:] - s[:-width]) * self._inverse[: len(s) - width])


def words(data: np.ndarray, offs: np.ndarray, inside: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last-plus-one byte of each word, and the first word of each row."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    lut = inside[FOLD] if fold else inside
    word = lut[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], before[1:] = False, word[:-1]
    after[-1], after[:-1] = False, word[1:]
    before &= ~edge[:-1]
    after &= ~edge[1:]
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


@dataclass
class Words:
    """The words of a chunk: bytes ``start`` to ``end`` of ``folded`` (A-Z folded, eight bytes longer), a hash of each; row r has the words from ``first[r]`` on."""

    folded: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray


def _eights(folded: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number."""
    return np.ndarray((len(folded) - 7,), "<u8", np.ascontiguousarray(folded).data, strides=(1,))


def _low_bytes(n: np.ndarray) -> np.ndarray:
    return np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * np.minimum(n, 8).astype(np.uint64))


def word_table(data: np.ndarray, offs: np.ndarray, inside: np.ndarray) -> Words:
    """Eight bytes at a time are mixed into a word's hash by bijections, longer words go to BLAKE2b:
    no sum or polynomial of the letters decides, so words cannot be paired up by their structure."""
    starts, ends, first = words(data, offs, inside)
    folded = np.concatenate([FOLD[data], np.zeros(8, np.uint8)])
    eight, length = _eights(folded), ends - starts
    h = mix(length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    live = np.flatnonzero(length <= _WORD_BYTES)
    for i in range(0, _WORD_BYTES, 8):
        live = live[length[live] > i]
        if not len(live):
            break
        h[live] = mix(h[live] * np.uint64(0x9FB21C651E98DF25) + (eight[starts[live] + i] & _low_bytes(length[live] - i)))
    for k in np.flatnonzero(length > _WORD_BYTES).tolist():
        h[k] = int.from_bytes(hashlib.blake2b(folded[starts[k] : ends[k]], digest_size=8).digest(), "little")
    return Words(folded, starts, ends, first, h)


def word_hashes(data: np.ndarray, offs: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word, A-Z folded, and the first word of each row."""
    w = word_table(data, offs, inside)
    return w.hash, w.first


def same_words(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """Whether the words ``i`` of ``a`` are, byte by byte, the words ``j`` of ``b``."""
    p, q, length = a.start[i].astype(np.int64), b.start[j].astype(np.int64), (a.end[i] - a.start[i]).astype(np.int64)
    same = length == b.end[j] - b.start[j]
    x, y, at, live = _eights(a.folded), _eights(b.folded), 0, np.flatnonzero(same)
    while len(live):
        differ = ((x[p[live] + at] ^ y[q[live] + at]) & _low_bytes(length[live] - at)) != 0
        same[live[differ]] = False
        at += 8
        live = live[~differ]
        live = live[length[live] > at]
    return same


def chain(hashes: list[np.ndarray]) -> np.ndarray:
    """One hash for each row of equally long columns of hashes; order matters."""
    h = mix(hashes[0] + np.uint64(len(hashes)))
    for x in hashes[1:]:
        h = mix(h * np.uint64(0x9FB21C651E98DF25) + x)
    return h


def shingles(hashes: np.ndarray, first: np.ndarray, n: int) -> list[np.ndarray]:
    """Of each row the sorted distinct hashes of its n-word shingles; with fewer words one of them all."""
    count = len(hashes)
    joined = chain([hashes[i : count - n + 1 + i] for i in range(n)]) if count >= n else np.zeros(0, np.uint64)
    out = []
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if hi - lo >= n:
            out.append(np.unique(joined[lo : hi - n + 1]))
        else:
            out.append(chain([hashes[i : i + 1] for i in range(lo, hi)]) if hi > lo else joined[:0])
    return out


def ragged(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offs = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offs[1:])
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(flat).cast(kind))


def with_columns(df: DataFrame, text: str, fields: list[StructField], make: Callable[[], Callable[[pa.RecordBatch, np.ndarray, np.ndarray], list[pa.Array]]], limit: int = CHUNK_BYTES) -> DataFrame:
    """``df`` with columns made from its texts, chunk by chunk, without a shuffle.

    Columns of the same names in ``df`` give way to the new ones. ``make`` is called once in
    each task and returns what is called for each chunk.
    """
    small_batches(df.sparkSession)
    new = [f.name for f in fields]
    base = df.drop(*[n for n in new if n.lower() != text.lower()])
    keep = [c for c in base.columns if c.lower() not in {n.lower() for n in new}]
    schema = StructType([base.schema[c] for c in keep] + fields)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = make()
        for batch, data, offs in text_chunks(batches, text, limit):
            cols = call(batch, data, offs)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + cols, names=keep + new)

    return base.mapInArrow(lambda it: releasing(run(it)), schema)
