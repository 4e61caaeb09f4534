"""Best-fit packing of tokenised documents into fixed-length sequences by sums of squares."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from operator import attrgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrow import releasing, text_chunks
from .staging import Staging

CAPACITY = 2048
#: Pieces that are packed together in one task, about; more pieces make more groups alike.
GROUP_PIECES = 50_000
#: Tokens of so many distinct words are a generation in a worker's memory; what neither the latest nor the one before it has
#: is forgotten. Rare words fill a generation within a chunk or two of texts, so frequent ones must outlive it.
CACHE_WORDS = 60_000

#: The vocabulary's own pattern of words.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


#: Each is a word of its own behind letters.
_MARKS = frozenset(",.;:!?)")
_ID = attrgetter("id")
#: Bytes of Latin-1 that no text goes to the library for.
_PLAIN = bytes([9, 10, 13, *range(0x20, 0x7F), *range(0xA1, 0x100)])

#: Byte-level vocabularies write each byte as a character: itself if it is printable, else the next one from U+0100 on.
_LETTER_OF_BYTE = {b: 256 + k for k, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255))}


class _Remembered(dict):
    """What ``make`` gives for a string: kept in this generation, taken over from the one before it."""

    def __init__(self, make: Callable[[str], bytes], before: dict[str, bytes]) -> None:
        self.make, self.before = make, before

    def __missing__(self, key: str) -> bytes:
        ids = self.before.get(key)
        if ids is None:
            ids = self.make(key)
        self[key] = ids
        return ids

    def aged(self) -> _Remembered:
        """This generation, or the next one if it is full."""
        if len(self) <= CACHE_WORDS:
            return self
        self.before = {}
        return _Remembered(self.make, self)


class Encoder:
    """Ids of whole texts, as bytes of little-endian 32-bit numbers, equal to the library's.

    The vocabulary folds case, composes and splits texts into words, never over white space,
    before it merges, so the ids of what stands between white space depend on it alone; they and
    those of its words are remembered. A text with a character beyond U+02FF (but the general
    punctuation), where folding and composing could reach further, or with the opening of a
    special token, goes to the library whole.
    """

    _odd = re.compile("[^\t\n\r -~\u00A1-\u012F\u0131-\u02FF\u2010-\u201F\u2026]|<\\|")
    _word = regex.compile(WORD)

    def __init__(self, vocabulary: str) -> None:
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(vocabulary)
        self._merge = self._tokenizer.model.tokenize
        self._words = _Remembered(self._found, {})
        self._chunks = _Remembered(self._chunk_ids, {})

    def _whole(self, text: str) -> bytes:
        return array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _word_ids(self, word: str) -> bytes:
        letters = word if word.isascii() else word.encode().decode("latin-1").translate(_LETTER_OF_BYTE)
        return array("I", map(_ID, self._merge(letters))).tobytes()

    def _found(self, word: str) -> bytes:
        """Ids of a word in a chunk: it may have stood alone before."""
        ids = self._chunks.get(word)
        if ids is None:
            ids = self._chunks.before.get(word)
        return self._word_ids(word) if ids is None else ids

    def _chunk_ids(self, chunk: str) -> bytes:
        if chunk.isalpha():  # a word, remembered as a chunk
            return self._word_ids(chunk)
        head, words = chunk[:-1], self._words
        if chunk[-1] in _MARKS and head.isalpha():
            return words[head] + words[chunk[-1]]
        return b"".join(map(words.__getitem__, self._word.findall(chunk)))

    def _strange(self, text: str) -> bool:
        """``_odd`` at the speed of bytes, where a character is one."""
        try:
            return bool(text.encode("latin-1").translate(None, _PLAIN)) or "<|" in text
        except UnicodeEncodeError:
            return self._odd.search(text) is not None

    def many(self, texts: list[str]) -> list[bytes]:
        self._words, self._chunks = self._words.aged(), self._chunks.aged()
        get, odd = self._chunks.__getitem__, self._strange
        return [self._whole(t) if odd(t) else b"".join(map(get, t.lower().split())) for t in texts]


@lru_cache(1)
def _encoder(vocabulary: str) -> Encoder:
    """One for each worker, so that what one task has encoded serves the next."""
    return Encoder(vocabulary)


def pack(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece: longest first (ties in the order given), each into the open
    sequence that leaves the least sum, over residual gaps, of squared counts of open sequences.

    A sequence is opened only where no open one has room. Of equal sums the smallest gap wins.
    """
    counts = np.zeros(capacity + 1, np.int64)  # by gap; a full sequence counts nowhere
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    seq, off = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    made = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        gaps = np.flatnonzero(counts[size:]) + size
        if len(gaps):
            change = counts[gaps - size] - counts[gaps] + 1
            if gaps[0] == size:
                change[0] = -counts[size]
            gap = int(gaps[change.argmin()])
            counts[gap] -= 1
            s = stacks[gap].pop()
        else:
            gap, s, made = capacity, made, made + 1
        seq[i], off[i] = s, capacity - gap
        if gap > size:
            counts[gap - size] += 1
            stacks[gap - size].append(s)
    return seq, off


def _pieces(batches: Iterable[pa.RecordBatch], vocabulary: str, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    encoder, end, task, seen = _encoder(vocabulary), np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId(), 0
    for batch, _, _ in text_chunks(batches, "text"):
        rows = []
        texts = [t or "" for t in batch.column("text").to_pylist()]
        for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.many(texts), strict=True):
            ids += end
            for piece, lo in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[lo : lo + 4 * capacity]
                rows.append((doc_id, piece, lo // 4, len(part) // 4, zlib.crc32(part), task << 36 | seen))
                seen += 1
        if rows:
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32", "uid"])


def packed(spark: SparkSession, docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = 0, group_pieces: int = GROUP_PIECES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``, one row for each piece.

    A document is the ids of its whole text and ``end_id``; one longer than ``capacity`` is cut
    into pieces of that length, the last may be shorter. Null and empty texts are ``end_id`` alone.
    Null ids and repeated rows are packed like others; other columns are ignored. An empty table
    gives an empty result.

    Texts are tokenised where they are read; only rows of numbers are shuffled. The pieces of
    each length are dealt evenly to groups of about ``group_pieces``, so each group has the whole
    table's mixture of lengths and loses one partly filled sequence or so; the number of groups
    follows the number of pieces, and no group depends on a key of the data.
    """
    stage = Staging(spark, "packing")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    pieces = stage.write(rows.mapInArrow(lambda it: releasing(_pieces(it, vocabulary, capacity, end_id)), "doc_id long, piece int, start long, length long, ids_crc32 long, uid long"), "pieces")
    groups = max(1, round(pieces.count() / group_pieces))

    def place(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "uid"], ascending=[False, True], ignore_index=True)
        seq, part["offset"] = pack(part["length"].to_numpy(), capacity)
        part["sequence_id"] = (part["g"].to_numpy(np.int64) << 32) + seq
        return part[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]].astype({"doc_id": "Int64"})

    dealt = pieces.withColumn("g", F.pmod(F.xxhash64("uid"), F.lit(groups)))
    return dealt.groupBy("g").applyInPandas(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
