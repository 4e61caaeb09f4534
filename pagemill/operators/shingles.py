"""Runs of words as 64-bit hashes, many texts at once."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text that are worked on at once; a longer text makes a chunk of its own.
CHUNK_BYTES = 4 << 20
#: Longer words are hashed one by one.
LONG = 64

_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B)]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _spread(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _word_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Eight bytes of each word at a time; no sum of letters decides, so no two words of up to eight letters are mixed up."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))
    out = _spread(lengths.astype(np.uint64))
    for at in range(0, LONG, 8):
        more = np.flatnonzero((lengths > at) & (lengths <= LONG))
        if not len(more):
            break
        unused = np.uint64(8) * (np.uint64(8) - np.minimum(lengths[more] - at, 8).astype(np.uint64))
        letters = (eight[starts[more] + at] << unused) >> unused
        out[more] = _spread((out[more] + _STEP) ^ letters)
    for k in np.flatnonzero(lengths > LONG).tolist():
        out[k] = int.from_bytes(hashlib.blake2b(data[starts[k] : starts[k] + lengths[k]].tobytes(), digest_size=8).digest(), "little")
    return out


def _chained(hashes: np.ndarray, n: int) -> np.ndarray:
    """One hash for each run of ``n`` words."""
    out = np.full(max(len(hashes) - n + 1, 0), n, np.uint64)
    for k in range(n):
        out = _spread(out * _STEP + hashes[k : k + len(out)])
    return out


def _chunk(data: np.ndarray, offs: np.ndarray, n: int) -> list[np.ndarray]:
    """Of each text its distinct runs; of a shorter text one of all its words, of a text without words none."""
    word = _WORD[data]
    edge = np.ones(len(data) + 1, bool)
    edge[:-1] = False
    edge[offs] = True
    begins = word & np.concatenate([[True], ~word[:-1] | edge[1:-1]]) if len(data) else word
    ends = word & np.concatenate([~word[1:] | edge[1:-1], [True]]) if len(data) else word
    starts = np.flatnonzero(begins)
    hashes = _word_hashes(data, starts, np.flatnonzero(ends) + 1 - starts)
    runs, first, out = _chained(hashes, n), np.searchsorted(starts, offs), []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(runs[a : b - n + 1]))
        else:
            out.append(_chained(hashes[a:b], b - a) if b > a else runs[:0])
    return out


def _hashed(batches: Iterable[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column("text").cast(pa.large_string())
        _, offsets, values = text.buffers()
        offs = np.frombuffer(offsets, np.int64)[text.offset : text.offset + len(text) + 1]
        data = np.frombuffer(values, np.uint8) if values else np.zeros(0, np.uint8)
        lo = 0
        while lo < len(text):
            hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + CHUNK_BYTES, "right")) - 1)
            rows = _chunk(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo], n)
            cuts = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(rows).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("key").slice(lo, hi - lo), lists], names=["key", "sh"])
            lo = hi


def hashed_shingles(rows: DataFrame, key: str, text: str, n: int = 8) -> DataFrame:
    """``key, sh``: distinct runs of ``n`` words of each text, a word being ASCII letters and digits, in lower case.

    Shorter texts have one run of all their words; texts without a word, and null, have none. Runs are known by
    64-bit hashes of hashes: that two different ones among a thousand million agree somewhere has a chance of one in forty.
    """
    kind = rows.schema[key].dataType.simpleString()
    low = rows.select(F.col(key).alias("key"), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("text"))
    return low.mapInArrow(lambda it: _hashed(it, n), f"key {kind}, sh array<bigint>")
