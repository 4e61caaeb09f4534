"""Toxicity by compression distance: windows under zstandard dictionaries of toxic and ordinary text."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField

from .arrow import with_columns

#: Bytes of a window at most; windows end at white space where there is any.
WINDOW = 48
LEVEL = 6
#: Labelled documents of each class that are learned from, at most; their texts are whole.
TRAIN_DOCS = 3000
#: And bytes of their texts, in each class: the driver learns from them.
TRAIN_BYTES = 64 << 20
ORDINARY_BYTES = 32 << 10
#: Sizes of the toxic dictionary that are tried.
TOXIC_BYTES = (4096, 2048, 1024, 512, 256)
#: Bytes of the strings whose document counts tell toxic passages from others, and toxic texts that must have one.
GRAM = 6
LEAST_TEXTS = 3
#: Bytes of toxic text whose strings are counted at once.
PART_BYTES = 8 << 20
THRESHOLD = 0.3

_WINDOWS = re.compile(rb"[\s\S]{1,%d}(?=\s|\Z)|[\s\S]{%d}" % (WINDOW - 1, WINDOW))
#: A saving of so many bytes makes a window one of its feature's.
_STEPS = (1, 2, 3, 4)


def windows(text: str) -> list[bytes]:
    return _WINDOWS.findall(text.lower().encode("utf-8", "replace"))


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False, write_checksum=False)


@dataclass
class Model:
    """``ordinary`` and ``toxic`` dictionary contents; weights of the features, the constant last."""

    ordinary: bytes
    toxic: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray


class Distance:
    """Bytes that a window is shorter by when the toxic dictionary is at hand in front of the ordinary one.

    Both dictionaries are trained apart. A window is compressed with the ordinary one alone and with both:
    a toxic dictionary alone would lose to the ordinary one on the ordinary words that toxic text has too,
    by amounts that say more of the text's language than of its toxicity.
    """

    def __init__(self, ordinary: bytes, toxic: bytes) -> None:
        self._without, self._with = _compressor(ordinary), _compressor(toxic + ordinary)

    def savings(self, parts: list[bytes]) -> np.ndarray:
        without, beside = self._without.compress, self._with.compress
        return np.array([len(without(w)) - len(beside(w)) for w in parts], np.int64)

    def features(self, text: str) -> np.ndarray:
        x = self.savings(windows(text)) if text else np.zeros(0, np.int64)
        if not len(x):
            x = np.zeros(1, np.int64)
        top = np.sort(x)[-3:]
        counts = [(x >= s).sum() for s in _STEPS]
        return np.array([x.max(), top.mean(), x.mean(), *(c / len(x) for c in counts), *(np.log1p(c) for c in counts), np.log1p(len(x))])


def _trained(size: int, samples: list[bytes]) -> bytes:
    """The best segments of the samples; of too few of them, the samples themselves."""
    try:
        return zstandard.train_dictionary(size + 512, samples, k=24 if size > 4096 else 12, d=6).as_bytes()[-size:]
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Newton steps for a ridge-penalised logistic regression on standardised features."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    penalty = np.diag([1.0] * x.shape[1] + [1e-6])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (p - y) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, w


def _grams(text: bytes) -> np.ndarray:
    """Each ``GRAM`` bytes from every place on, as one number."""
    x = np.frombuffer(text, np.uint8).astype(np.uint64)
    n = len(x) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(GRAM):
        out = (out << np.uint64(8)) | x[i : n + i]
    return out


def _among(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each of ``x`` is one of the sorted ``known``."""
    if not len(known):
        return np.zeros(len(x), bool)
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


def _document_counts(texts: list[bytes], part: int, parts: int, among: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of one residue and in how many texts each is; of those in the sorted ``among`` only, if given."""
    grams, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    held: list[np.ndarray] = []
    for k, t in enumerate(texts):
        g = np.unique(_grams(t))
        g = g[g % np.uint64(parts) == part] if parts > 1 else g
        held.append(g if among is None else g[_among(g, among)])
        if sum(map(len, held)) > 1 << 22 or k == len(texts) - 1:
            new, n = np.unique(np.concatenate(held), return_counts=True)
            grams, which = np.unique(np.concatenate([grams, new]), return_inverse=True)
            counts = np.bincount(which, np.concatenate([counts, n])).astype(np.int64)
            held = []
    return grams, counts


def telling(toxic: list[bytes], ordinary: list[bytes]) -> np.ndarray:
    """Sorted grams that more toxic texts have than their share: by the likelihood ratio of the two document counts, beyond chance for as many grams as there are.

    Grams are counted one residue after the other, so that memory does not grow with the texts.
    """
    parts = max(1, -(-sum(map(len, toxic)) // PART_BYTES))
    found = []
    for part in range(parts):
        grams, a = _document_counts(toxic, part, parts)
        grams, a = grams[a >= LEAST_TEXTS], a[a >= LEAST_TEXTS]
        seen, n = _document_counts(ordinary, part, parts, grams)
        b = np.zeros(len(grams), np.int64)
        b[np.searchsorted(grams, seen)] = n
        found.append((grams, a, b))
    grams, a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    p, q, both = a / len(toxic), b / len(ordinary), (a + b) / (len(toxic) + len(ordinary))

    def fit_of(k: np.ndarray, m: int, share: np.ndarray) -> np.ndarray:
        share = np.clip(share, 1e-12, 1 - 1e-12)
        return k * np.log(share) + (m - k) * np.log(1 - share)

    ratio = 2 * (fit_of(a, len(toxic), p) + fit_of(b, len(ordinary), q) - fit_of(a, len(toxic), both) - fit_of(b, len(ordinary), both))
    return np.sort(grams[(p > q) & (ratio > 2 * np.log(max(len(grams), 2)) + 10)])


def _passages(texts: list[bytes], grams: np.ndarray) -> list[bytes]:
    """Stretches of the texts that telling grams cover."""
    out = []
    for t in texts:
        at = np.flatnonzero(_among(_grams(t), grams))
        for run in np.split(at, np.flatnonzero(np.diff(at) > GRAM) + 1) if len(at) else []:
            out.append(t[run[0] : run[-1] + GRAM])
    return out


def fit(toxic: list[str], ordinary: list[str], share: float) -> Model:
    """``share``: of toxic documents among all labelled ones, for calibration.

    Two thirds of the texts make the dictionaries. The ordinary one is trained on ordinary windows.
    The toxic one is trained on passages of toxic texts that tell the classes apart: stretches of
    ``GRAM``-byte strings that occur in more toxic texts than chance allows, so what any text has is not
    in it; where there are none, on the toxic windows as they are. The last third of the texts, which no
    dictionary has seen, chooses the size of the toxic dictionary and calibrates the score.
    """
    rng = np.random.default_rng(17)
    folded = [[t.lower().encode("utf-8", "replace") for k in (0, 1) for t in texts[k::3]] for texts in (toxic, ordinary)]

    def shuffled(parts: list[bytes]) -> list[bytes]:
        return [parts[i] for i in rng.permutation(len(parts))]

    plain = shuffled(sorted({w for t in ordinary[::3] for w in windows(t)}))
    passages = shuffled(_passages(folded[0], telling(*folded))) or shuffled(sorted({w for t in toxic[::3] for w in windows(t)}))
    unseen = [toxic[2::3] or toxic, ordinary[2::3] or ordinary]
    y = np.repeat([1.0, 0.0], [len(u) for u in unseen])
    base = _trained(ORDINARY_BYTES, plain or [b" "])
    best = None
    for size in TOXIC_BYTES:
        own = _trained(size, passages or [b" "])
        now = Distance(base, own)
        x = np.array([now.features(t) for u in unseen for t in u])
        mean, scale, w = _logistic(x, y)
        p = np.clip(1 / (1 + np.exp(-((x - mean) / scale @ w[:-1] + w[-1]))), 1e-9, 1 - 1e-9)
        loss = -(y * np.log(p)).sum() / y.sum() - ((1 - y) * np.log(1 - p)).sum() / (1 - y).sum()
        if best is None or loss < best[0]:
            best = loss, own, mean, scale, w
    _, own, mean, scale, w = best
    taken = y.mean()
    w[-1] += np.log(share / (1 - share)) - np.log(taken / (1 - taken))
    return Model(base, own, mean, scale, w)


def train(docs: DataFrame, labels: DataFrame, learn: Column, train_docs: int = TRAIN_DOCS, train_bytes: int = TRAIN_BYTES, doc_id: str = "doc_id", text: str = "text") -> Model | None:
    """Learns from the whole texts of at most ``train_docs`` documents and ``train_bytes`` of each class, in the order of a hash of the
    text; of two documents whatever their size.

    Null texts, ids and labels are passed over; with less than two documents of a class there is
    no model. The share of toxic ones is that of all labelled documents.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IN (0, 1)")
    rows = docs.where(learn).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("text IS NOT NULL AND text <> ''")
    counts = {r["toxic"]: r["n"] for r in rows.select("doc_id").join(known, "doc_id").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if min(counts.get(0, 0), counts.get(1, 0)) < 2:
        return None
    picked = {}
    for k in (0, 1):
        share = F.lit(min(1 << 30, int(2 * train_docs / counts[k] * (1 << 30)) + 1))
        # ids first, then the texts of the few: no text is shuffled
        keys = rows.select("doc_id", F.xxhash64("text").alias("h"), F.octet_length("text").alias("bytes")).where(F.pmod("h", F.lit(1 << 30)) < share)
        keys = keys.join(known.where(F.col("toxic") == k).select("doc_id").distinct(), "doc_id", "left_semi").groupBy("h").agg(F.min(F.struct("doc_id", "bytes")).alias("r"))
        first = keys.orderBy("h").limit(train_docs).select("r.*").collect()
        within = np.cumsum([r["bytes"] for r in first]) <= train_bytes
        ids = [r["doc_id"] for n, (r, fits) in enumerate(zip(first, within, strict=True)) if fits or n < 2]
        texts = rows.where(F.col("doc_id").isin(ids)).select("text", F.xxhash64("text").alias("h")).collect()
        picked[k] = [t for _, t in sorted({r["h"]: r["text"] for r in texts}.items())]
    if min(map(len, picked.values())) < 2:
        return None
    return fit(picked[1], picked[0], counts[1] / (counts[0] + counts[1]))


def score(spark: SparkSession, docs: DataFrame, model: Model | None, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 if the score is at least ``threshold``).

    Whole texts are scored, window by window, where they are read. Null and empty texts score as
    a text in which nothing is found; without a model every score is 0.0. Repeated rows score
    alike; columns of these names are replaced, others stay. The broadcast model has a fixed size.
    """
    sent = spark.sparkContext.broadcast(model)

    def make():  # noqa: ANN202
        m = sent.value
        distance = Distance(m.ordinary, m.toxic) if m else None

        def call(batch: pa.RecordBatch, data: np.ndarray, offs: np.ndarray) -> list[pa.Array]:
            if m is None:
                p = np.zeros(batch.num_rows)
            else:
                x = np.array([distance.features(t) for t in batch.column(text).to_pylist()]).reshape(batch.num_rows, -1)
                p = 1 / (1 + np.exp(-np.clip((x - m.mean) / m.scale @ m.weights[:-1] + m.weights[-1], -30, 30)))
            return [pa.array(p), pa.array((p >= threshold).astype(np.int32))]

        return call

    return with_columns(docs, text, [StructField("score", DoubleType()), StructField("predicted", IntegerType())], make)


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learns from the documents that ``held_out`` (crc32 of the id as text, modulo 4, is 2; or a null id) leaves, scores all."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(True))
    return score(spark, docs.withColumn("held_out", held), train(docs, labels, ~held))
