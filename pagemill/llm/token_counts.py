"""Token counts by a two-tier lookup of pre-token lengths."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField

from .arrow import with_columns

#: Pre-tokens in the broadcast table, whatever the input.
FREQUENT = 1 << 15
#: Pre-tokens that one task proposes for it.
PROPOSED = 1 << 13
#: Pre-tokens that a counting or encoding worker remembers before it starts afresh.
CACHE_WORDS = 300_000
#: A longer pre-token is encoded and not remembered.
REMEMBERED_CHARS = 64
LIMIT = 4096

_RUN = regex.compile(r" *[^ ]+| +$")


def pre_tokens(text: str) -> list[str]:
    """Parts that the vocabulary never merges over: a word with the spaces before it, less one space.

    The text is taken with the space that the library puts before it. No piece of the vocabulary
    has a space after another character, so merges stay within a part.
    """
    parts = text.split(" ")
    return parts if "" not in parts else [p[1:] for p in _RUN.findall(" " + text)]


class Counting(dict):
    """Pre-token to number of tokens: the broadcast table first, then what this worker has encoded."""

    def __init__(self, vocabulary: str, frequent: dict[str, int]) -> None:
        from sentencepiece import SentencePieceProcessor

        super().__init__(frequent)
        self._frequent = frequent
        self._model = SentencePieceProcessor(model_file=vocabulary)

    def __missing__(self, part: str) -> int:
        # an empty part stands for the space alone, which the library would not add to an empty text
        n = len(self._model.encode(part)) if part else 1
        if len(part) <= REMEMBERED_CHARS:
            if len(self) >= CACHE_WORDS + len(self._frequent):
                self.clear()
                self.update(self._frequent)
            self[part] = n
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        if "▁" in text:
            return len(self._model.encode(text))
        return sum(map(self.__getitem__, pre_tokens(text)))


def _proposed(batches: Iterable[pa.RecordBatch], proposed: int) -> Iterator[pa.RecordBatch]:
    seen: Counter[str] = Counter()
    for batch in batches:
        for text in batch.column("text").to_pylist():
            seen.update(p for p in (text or "").split(" ") if 0 < len(p) <= REMEMBERED_CHARS)
            if len(seen) > CACHE_WORDS:
                seen = Counter(dict(seen.most_common(CACHE_WORDS // 2)))
    top = seen.most_common(proposed)
    yield pa.RecordBatch.from_arrays([pa.array([t[0] for t in top], pa.string()), pa.array([t[1] for t in top], pa.int64())], names=["part", "n"])


def frequent_parts(docs: DataFrame, text: str, size: int = FREQUENT) -> list[str]:
    """The pre-tokens that the tasks' most frequent ones put first; ``size`` of them at most.

    Only these summaries are shuffled, never the pre-tokens themselves.
    """
    rows = docs.select(F.col(text).alias("text")).mapInArrow(lambda it: _proposed(it, PROPOSED), "part string, n long")
    return [r["part"] for r in rows.groupBy("part").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "part").limit(size).collect()]


def token_counts(spark: SparkSession, docs: DataFrame, vocabulary: str, limit: int = LIMIT, text: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes, n_tokens, over_limit``, as the library counts the whole texts.

    Null and empty texts have no tokens; blank texts count as the library has it. Repeated rows
    give equal counts. Columns of these names are replaced, others stay. The counts do not depend
    on the broadcast table, whose size is bounded; it saves most workers most encoding. A word
    that is not in it is encoded and kept in a cache of bounded size.
    """
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=vocabulary)
    parts = frequent_parts(docs, text)
    table = spark.sparkContext.broadcast(dict(zip(parts, map(len, model.encode(parts)), strict=True)) if parts else {})

    def make():  # noqa: ANN202
        counting = Counting(vocabulary, table.value)

        def call(batch: pa.RecordBatch, data: np.ndarray, offs: np.ndarray) -> list[pa.Array]:
            n = np.array([counting.count(t) if t else 0 for t in batch.column(text).to_pylist()], np.int64)
            return [pa.array(np.diff(offs)), pa.array(n), pa.array(n > limit)]

        return call

    return with_columns(docs, text, [StructField("n_bytes", LongType()), StructField("n_tokens", LongType()), StructField("over_limit", BooleanType())], make)
