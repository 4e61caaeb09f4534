"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from .arrow import mix, text_chunks, with_columns

UNKNOWN = "und"
ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
SMOOTHING = 0.5
#: Above about so many labelled documents each language learns from its share of them, taken by a hash of the text:
#: all of its documents where they are fewer than what the others leave it, and LANG_DOCS of them in any case.
TRAIN_DOCS = 40_000
LANG_DOCS = 1_000
#: Cells of the matrix at most (128 MB); of more languages than fit with BUCKETS, each has fewer buckets, none is left out.
CELLS = 1 << 24
#: Bytes of text that are scored by one product.
SCORED_BYTES = 1 << 18
#: Products of counts and log-probabilities that are in memory at once.
_AT_ONCE = 1 << 22

_LETTER = regex.compile(r"\p{L}")
_BETWEEN = regex.compile(r"[\s\d\p{P}\p{S}\p{C}]")
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]


@lru_cache(1)
def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Of every code point whether it stands between words, and whether it is a letter."""
    every = "".join(map(chr, range(0x110000)))
    out = []
    for pattern in (_BETWEEN, _LETTER):
        mask = np.zeros(0x110000, bool)
        mask[[m.start() for m in pattern.finditer(every)]] = True
        out.append(mask)
    return out[0], out[1]


def table(texts: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``row, bucket, count`` of the hashed n-grams of all texts, by row, and which rows have a letter.

    Texts are lower-cased; runs of anything but letters and marks count as one space, and so do a text's ends.
    """
    between, letter = _classes()
    low = [t.lower() for t in texts]
    sizes = np.fromiter(map(len, low), np.int64, len(low))
    points = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    # a space before and behind each text
    first = np.cumsum(sizes + 2) - sizes - 2
    at = np.arange(len(points)) + 2 * np.repeat(np.arange(len(low)), sizes) + 1
    chars = np.full(len(points) + 2 * len(low), 0x20, np.uint32)
    chars[at] = points
    row = np.repeat(np.arange(len(low)), sizes + 2)
    space = np.ones(len(chars), bool)
    space[at] = between[points]
    has_letter = np.bincount(row[at][letter[points]], minlength=len(low)) > 0 if len(points) else np.zeros(len(low), bool)
    keep = np.ones(len(chars), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    keep[first] = True
    chars, row = np.where(space, np.uint32(0x20), chars)[keep].astype(np.uint64), row[keep]
    keys = []
    for n in ORDERS:
        m = len(chars) - n + 1
        if m <= 0:
            continue
        h = np.full(m, n, np.uint64)
        for i in range(n):
            h = h * _ODD[0] + chars[i : m + i] * _ODD[1]
        own = row[:m] == row[n - 1 :]
        keys.append(row[:m][own].astype(np.uint64) * np.uint64(buckets) + mix(h[own]) % np.uint64(buckets))
    key = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
    if len(low) * buckets <= 1 << 32:
        key = key.astype(np.uint32)  # sorts much faster
    key.sort()
    new = np.flatnonzero(np.concatenate([np.ones(min(len(key), 1), bool), key[1:] != key[:-1]]))
    count = np.diff(np.append(new, len(key)))
    key = key[new].astype(np.int64)
    return key // buckets, key % buckets, count, has_letter


@dataclass
class Model:
    """``log_probs``: one row for each bucket, one column for each language."""

    langs: list[str]
    log_prior: np.ndarray
    log_probs: np.ndarray

    def score(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Of each text the language and its posterior: one sparse product of the texts' counts with the matrix."""
        if not self.langs or not texts:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        row, bucket, count, known = table([t or "" for t in texts], len(self.log_probs))
        total = np.tile(self.log_prior, (len(texts), 1))
        step = max(_AT_ONCE // len(self.langs), 1)
        for lo in range(0, len(row), step):
            r = row[lo : lo + step]
            starts = np.flatnonzero(np.append(True, r[1:] != r[:-1]))
            total[r[starts]] += np.add.reduceat(self.log_probs[bucket[lo : lo + step]] * count[lo : lo + step, None], starts, axis=0)
        best = total.argmax(axis=1)
        posterior = 1 / np.exp(total - total[np.arange(len(texts)), best][:, None]).sum(axis=1)
        return [self.langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)], np.where(known, posterior, 0.0)


def _counted(batches: Iterable[pa.RecordBatch], index: dict[str, int], buckets: int) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(len(index) * buckets, np.int64)
    for batch, _, _ in text_chunks(batches, "text", SCORED_BYTES):
        lang = np.array([index.get(x, -1) for x in batch.column("lang").to_pylist()], np.int64)
        row, bucket, count, known = table([t or "" for t in batch.column("text").to_pylist()], buckets)
        use = known[row] & (lang[row] >= 0)
        np.add.at(counts, lang[row[use]] * buckets + bucket[use], count[use])
    k = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array((k // buckets).astype(np.int32)), pa.array((k % buckets).astype(np.int32)), pa.array(counts[k])], names=["k", "bucket", "n"])


def _quota(counts: list[int], total: int) -> int:
    """The most that each may have so that all together have no more than ``total``."""
    left = total
    for i, n in enumerate(sorted(counts)):
        if n * (len(counts) - i) > left:
            return left // (len(counts) - i)
        left -= n
    return max(counts)


def train(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang", train_docs: int = TRAIN_DOCS, buckets: int = BUCKETS, cells: int = CELLS, lang_docs: int = LANG_DOCS) -> Model:
    """Learns from the labelled rows for which ``learn`` holds, about ``train_docs`` of them or ``lang_docs`` of each language.

    The quota is one for all languages: a language with fewer rows is learned from all of them, a
    larger one from a hash share. A language without a single letter in its rows is left out, no other is. The
    driver receives counts of at most ``cells`` cells, whatever the input: with more than ``cells /
    buckets`` languages the number of buckets is halved until they fit. Rows with null text or label
    are passed over; no rows at all give a model that answers ``und``.
    """
    rows = docs.where(learn).select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    per_lang = rows.groupBy("lang").count().collect()  # a row for each language
    langs = sorted(r["lang"] for r in per_lang)
    index, total = {x: i for i, x in enumerate(langs)}, sum(r["count"] for r in per_lang)
    if not langs:
        return Model([], np.zeros(0), np.zeros((buckets, 0)))
    while buckets * len(langs) > cells and buckets > 256:
        buckets //= 2
    quota = max(lang_docs, _quota([r["count"] for r in per_lang], train_docs))
    shares = [F.lit(x) for r in per_lang if r["count"] > quota for x in (r["lang"], int(quota / r["count"] * (1 << 30)))]
    if shares:
        share = F.coalesce(F.create_map(*shares)[F.col("lang")], F.lit(1 << 30))
        rows = rows.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < share)
    counts = np.zeros((len(langs), buckets))
    cells = rows.mapInArrow(lambda it: _counted(it, index, buckets), "k int, bucket int, n long").groupBy("k", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts[cells["k"].to_numpy(), cells["bucket"].to_numpy()] = cells["n"].to_numpy()
    known = counts.sum(axis=1) > 0
    langs, counts = [x for x, k in zip(langs, known, strict=True) if k], counts[known]
    prior = np.array([{r["lang"]: r["count"] for r in per_lang}[x] for x in langs], float)
    probs = np.log(counts + SMOOTHING) - np.log(counts.sum(axis=1, keepdims=True) + SMOOTHING * buckets)
    return Model(langs, np.log(prior / prior.sum()), np.ascontiguousarray(probs.T))


def identify(spark: SparkSession, docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (the posterior of that language).

    Null text and text without a letter give ``und`` and 0.0, at any length. Whole texts are
    scored; equal posteriors go to the first language by name. Repeated rows give equal answers.
    Columns of the same two names are replaced. The matrix sent to the executors has
    ``buckets * languages`` cells and does not grow with the data; nothing is shuffled.
    """
    sent = spark.sparkContext.broadcast(model)

    def make():  # noqa: ANN202
        m = sent.value

        def call(batch: pa.RecordBatch, data: np.ndarray, offs: np.ndarray) -> list[pa.Array]:
            langs, score = m.score(batch.column(text).to_pylist())
            return [pa.array(langs, pa.string()), pa.array(score)]

        return call

    return with_columns(docs, text, [StructField("lang_pred", StringType()), StructField("score", DoubleType())], make, SCORED_BYTES)


def held_out(doc_id: str = "doc_id", mod: int = 5, rest: int = 0) -> Column:
    """Whether a document is kept from learning; a null id is."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % mod == rest, F.lit(True))


def language_id(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return identify(spark, docs.withColumn("held_out", held_out()), train(docs, ~held_out()))
