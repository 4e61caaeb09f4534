"""Near-duplicates: universal-hash minima, banding, signature and full-set checks, components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrow import SPACED, buffers, chain, ragged, releasing, shingles, text_chunks, word_hashes
from .components import components
from .staging import Staging

#: A pair at the threshold 0.8 shares none of 28 bands of 4 with probability 4e-7.
BANDS, ROWS = 28, 4
#: Pairs estimated so far below the threshold are not verified: a pair at 0.8 has fewer than 67 of 112 equal minima with probability 3e-7.
SLACK = 0.21
#: Counters of shingles, by their hash, that put rare shingles first: one table of fixed size, whatever the input.
RARITY_CELLS = 1 << 20

_rng = np.random.default_rng(7919)
_A = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_BLOCK = 256
#: Least sizes of classes of sets, each about 8 % above the last.
_CLASS_STARTS = np.unique((1.08 ** np.arange(420)).astype(np.int64))


def minima(shingle_set: np.ndarray) -> np.ndarray:
    """The upper 32 bits of the least a*x+b over the set, for each (a, b)."""
    least = np.full(len(_A), np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(shingle_set), _BLOCK):
        np.minimum(least, (shingle_set[lo : lo + _BLOCK, None] * _A + _B).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def _signed(batches: Iterable[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch, data, offs in text_chunks(batches, "text"):
        sets = shingles(*word_hashes(data, offs, SPACED), n)
        full = [len(s) > 0 for s in sets]
        sig = np.stack([minima(s) for s in sets])
        parts = sig.reshape(len(sets), BANDS, ROWS).astype(np.uint64)
        keys = chain([np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2]), *(parts[:, :, i] for i in range(ROWS))]).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if f else None for s, f in zip(sets, full, strict=True)], pa.binary()),
                ragged([k if f else k[:0] for k, f in zip(keys, full, strict=True)], pa.int64()),
                pa.array([s.tobytes() if f else None for s, f in zip(sig, full, strict=True)], pa.binary()),
            ],
            names=["doc_id", "n_shingles", "digest", "bands", "sig"],
        )


def _likely(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures do not rule the link out."""
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(batch.num_rows, -1) for c in ("sig_a", "sig_b"))
        part = batch.filter(pa.array((a == b).mean(axis=1) * 100 >= percent - 100 * SLACK))
        yield pa.RecordBatch.from_arrays([part.column("src"), part.column("dst")], names=["src", "dst"])


def _verified(batches: Iterable[pa.RecordBatch], n: int, percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            sig = [[np.frombuffer(x, np.uint32) for x in part.column(c).to_pylist()] for c in ("sig_a", "sig_b")]
            likely = np.array([(x == y).mean() * 100 >= percent - 100 * SLACK for x, y in zip(*sig, strict=True)], bool)
            part = part.filter(pa.array(likely))
            texts = [part.column(c).to_pylist() for c in ("text_a", "text_b")]
            distinct = list(dict.fromkeys(texts[0] + texts[1]))
            known = dict(zip(distinct, shingles(*word_hashes(*buffers(pa.array(distinct, pa.large_string())), SPACED), n), strict=True))
            sets = [[known[t] for t in column] for column in texts]
            linked = []
            for x, y in zip(*sets, strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            part = part.filter(pa.array(linked, pa.bool_()))
            yield pa.RecordBatch.from_arrays([part.column("src"), part.column("dst")], names=["src", "dst"])


def _rarity(batches: Iterable[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(RARITY_CELLS, np.int64)
    for _, data, offs in text_chunks(batches, "text"):
        for s in shingles(*word_hashes(data, offs, SPACED), n):
            np.add.at(counts, (s % np.uint64(RARITY_CELLS)).astype(np.int64), 1)
    k = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(counts[k])], names=["k", "n"])


def _size_class(size: np.ndarray | int) -> np.ndarray:
    return np.searchsorted(_CLASS_STARTS, size, "right") - 1


def _prefixes(batches: Iterable[pa.RecordBatch], n: int, percent: int, rarity: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Of each set the rarest shingles that a partner must meet, as the smaller set of a pair and as the larger one.

    Two sets of a and b shingles that are linked have ``need = percent * (a + b) / (100 + percent)``
    in common, so the first ``a - need + 1`` of one and ``b - need + 1`` of the other, in one order of
    all shingles, have one in common. The smaller set's partners are at least as large as itself;
    the larger one's are told apart by classes of size.
    """
    for batch, data, offs in text_chunks(batches, "text"):
        out: list[tuple[np.ndarray, ...]] = []
        ids, roots = batch.column("doc_id").to_numpy(), batch.column("root").to_numpy()
        for d, s in enumerate(shingles(*word_hashes(data, offs, SPACED), n)):
            size = len(s)
            if not size:
                continue
            least = -(-percent * size // 100)
            order = s[np.lexsort((s, rarity[(s % np.uint64(RARITY_CELLS)).astype(np.int64)]))].view(np.int64)

            def take(partner: int, kind: int, large: bool) -> None:
                k = size - -(-percent * (partner + size) // (100 + percent)) + 1
                part = order[:k]
                out.append((part, np.full(k, kind), np.full(k, ids[d]), np.full(k, roots[d]), np.full(k, size), np.arange(k), np.full(k, large)))  # noqa: B023

            take(size, int(_size_class(size)), False)
            for kind in range(int(_size_class(least)), int(_size_class(size)) + 1):
                take(max(least, int(_CLASS_STARTS[kind])), kind, True)
        if out:
            token, kind, doc, root, size, at, large = (np.concatenate(c) for c in zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(token), pa.array(kind.astype(np.int32)), pa.array(doc), pa.array(root), pa.array(size), pa.array(at), pa.array(large)],
                names=["token", "kind", "doc_id", "root", "n", "at", "large"],
            )


def near_duplicates(spark: SparkSession, docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row for each row of ``docs``.

    A document's set holds its distinct ``words``-word shingles (ASCII letters folded, words
    between ASCII white space), of fewer words the whole sequence; two are linked where 100 times
    the common part is at least ``percent`` times the union. ``component_id`` is the smallest id
    reachable over links, itself included; ``kept`` says that it is the document's own.

    Null, empty and blank texts have an empty set, link with nothing and are kept. A null id
    links with nothing: its component is null, it is kept. Rows of one id are one document;
    repeated rows give repeated results. Other columns are ignored. Empty input, empty result.

    Equal sets are joined by digest first, so a group of copies goes on as one. Within a band's
    bucket each member is held against the most central one only. Where a bucket's members then
    still lie in several components, they may be alike across components: of such documents only
    those meet that share one of their rarest shingles, as two linked sets must (prefix filter
    with bounds of length and place), so a passage that a whole bucket has makes no pairs.
    Candidates are ids only; signatures decide first, then the whole sets, from the texts.
    """
    stage = Staging(spark, "minhash")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = stage.write(rows.mapInArrow(lambda it: releasing(_signed(it, words)), "doc_id long, n_shingles long, digest binary, bands array<long>, sig binary"), "signed")
    known = signed.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    classes = stage.write(known.groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes")
    first = classes.select("digest", F.col("rep").alias("doc_id"))
    reps = known.join(first, ["digest", "doc_id"]).dropDuplicates(["digest", "doc_id"])
    slots = reps.select("doc_id", F.explode("bands").alias("band"))
    shared = slots.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    crowded = stage.write(slots.join(shared, "band"), "crowded")
    # the middle of a group of copies shares the most buckets with the most others
    weight = crowded.groupBy("doc_id").agg(F.sum("n").alias("weight"))
    weighed = crowded.drop("n").join(weight, "doc_id")
    leaders = weighed.groupBy("band").agg(F.max_by("doc_id", F.struct("weight", -F.col("doc_id"))).alias("leader"))
    buckets = stage.write(crowded.drop("n").join(leaders, "band"), "buckets")
    near = buckets.select("doc_id").distinct()
    texts = rows.where("doc_id IS NOT NULL").join(near, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    texts = stage.write(texts.join(reps.select("doc_id", "sig"), "doc_id"), "texts")

    def confirmed(pairs: DataFrame) -> DataFrame:
        a = texts.select(F.col("doc_id").alias("src"), F.col("text").alias("text_a"), F.col("sig").alias("sig_a"))
        b = texts.select(F.col("doc_id").alias("dst"), F.col("text").alias("text_b"), F.col("sig").alias("sig_b"))
        both = pairs.join(a, "src").join(b, "dst")
        return both.mapInArrow(lambda it: releasing(_verified(it, words, percent)), "src long, dst long")

    def pair(a: str, b: str) -> list:
        return [F.greatest(a, b).alias("src"), F.least(a, b).alias("dst")]

    links = stage.write(confirmed(buckets.where("doc_id <> leader").select(*pair("doc_id", "leader")).distinct()), "links")
    roots = components(links, stage, "first")

    placed = buckets.join(roots, buckets["doc_id"] == roots["node"], "left").select("band", "doc_id", F.coalesce("root", "doc_id").alias("root"))
    split = placed.groupBy("band").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a < b").select("band")
    open_ = placed.join(split, "band", "left_semi").select("doc_id", "root").distinct()
    open_ = stage.write(texts.join(open_, "doc_id"), "open")
    cells = open_.mapInArrow(lambda it: releasing(_rarity(it, words)), "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    rarity = np.zeros(RARITY_CELLS, np.int64)
    rarity[cells["k"].to_numpy()] = cells["n"].to_numpy()
    sent = spark.sparkContext.broadcast(rarity)
    prefixes = open_.mapInArrow(lambda it: releasing(_prefixes(it, words, percent, sent.value)), "token long, kind int, doc_id long, root long, n long, at long, large boolean")
    prefixes = stage.write(prefixes, "prefixes")
    x, y = prefixes.where("NOT large").alias("x"), prefixes.where("large").alias("y")
    ordered = f"(x.n < y.n OR (x.n = y.n AND x.doc_id < y.doc_id)) AND 100 * x.n >= {percent} * y.n"
    enough = f"{100 + percent} * least(x.n - x.at, y.n - y.at) >= {percent} * (x.n + y.n)"
    across = x.join(y, F.expr(f"x.token = y.token AND x.kind = y.kind AND x.root <> y.root AND {ordered} AND {enough}")).select(*pair("x.doc_id", "y.doc_id")).distinct()
    sig = open_.select("doc_id", "sig")
    signatures = across.join(sig.select(F.col("doc_id").alias("src"), F.col("sig").alias("sig_a")), "src").join(sig.select(F.col("doc_id").alias("dst"), F.col("sig").alias("sig_b")), "dst")
    likely = stage.write(signatures.mapInArrow(lambda it: _likely(it, percent), "src long, dst long").distinct(), "likely")
    more = stage.write(confirmed(likely), "more")
    if not more.isEmpty():
        roots = components(roots.select(F.col("node").alias("src"), F.col("root").alias("dst")).union(more), stage, "last")
    stage.drop("crowded", "buckets", "texts", "open", "prefixes", "likely", "links", "more")

    of_class = classes.join(roots, classes["rep"] == roots["node"], "left").select("digest", F.coalesce("root", "rep").alias("class_root"))
    out = signed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest")).join(of_class, "digest", "left")
    component = F.coalesce("class_root", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
