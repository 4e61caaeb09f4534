"""Near-duplicate vectors: spherical-cap filters of random product codes, joined and verified."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrow import ragged, releasing
from .components import components
from .staging import Staging

COSINE = 0.98
#: A filter is a direction made of one code word for each of two halves of the (rotated) coordinates.
WORDS = 128
#: A vector passes the filters whose cosine with it is CAP / sqrt(dimension) or more, and its LEAST best ones in any case.
CAP = 3.3
LEAST = 16
#: Vectors of one bucket that are compared at once; larger buckets are compared block against block.
BLOCK = 1024
#: Rows, and filters, of a block that are multiplied at once.
_ROWS, _COLUMNS = 512, 4096


@lru_cache(8)
def code(dim: int) -> tuple[np.ndarray, list[np.ndarray], list[slice]]:
    """A random rotation and, for each half of the coordinates, unit code words; the same in every worker."""
    rng = np.random.default_rng(40961 + dim)
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    halves = [slice(0, -(-dim // 2)), slice(-(-dim // 2), dim)] if dim > 1 else [slice(0, 1)]
    words = [rng.standard_normal((WORDS, len(range(dim)[h]))) for h in halves]
    return rotation, [w / np.linalg.norm(w, axis=1, keepdims=True) for w in words], halves


def decode(unit: np.ndarray) -> list[np.ndarray]:
    """For each unit vector the filters that it passes, ascending.

    The score of a filter is the sum of two halves' scores; sorted halves give every pair over
    the threshold without a look at the others.
    """
    dim = unit.shape[1]
    rotation, words, halves = code(dim)
    turned = unit @ rotation
    scores = [turned[:, h] @ w.T / np.sqrt(len(halves)) for h, w in zip(halves, words, strict=True)]
    if len(scores) == 1:
        scores.append(np.zeros((len(unit), 1)))
    out = []
    for a, b in zip(*scores, strict=True):
        order = np.argsort(b)
        sorted_b = b[order]
        # the LEAST-th best of all sums is among the sums of the best of each half
        best_a, best_b = np.sort(a)[-LEAST:], sorted_b[-LEAST:]
        sums = np.sort((best_a[:, None] + best_b).ravel())
        need = min(CAP / np.sqrt(dim), sums[-min(LEAST, len(sums))]) - 1e-12
        first = np.searchsorted(sorted_b, need - a)
        many = len(b) - first
        i = np.repeat(np.arange(len(a)), many)
        j = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
        out.append(np.sort(i * len(b) + order[j]))
    return out


def _coded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vecs = batch.column("vec").to_pylist()
        raw = [np.frombuffer(v, "<f8") for v in vecs]
        filters: list[np.ndarray] = [np.zeros(0, np.int64)] * len(raw)
        for dim in {len(v) for v in raw}:
            at = [k for k, v in enumerate(raw) if len(v) == dim]
            x = np.stack([raw[k] for k in at])
            for k, f in zip(at, decode(x / np.linalg.norm(x, axis=1, keepdims=True)), strict=True):
                filters[k] = f
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("vec_id", "label", "vec", "copies")), ragged(filters, pa.int32())], names=["vec_id", "label", "vec", "copies", "filters"])


def _clean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors that can link as bytes of doubles, without negative zeros; null for the others."""
    for batch in batches:
        vecs = []
        for vec_id, label, v in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "label", "vec")), strict=True):
            x = np.array(v if v and None not in v and vec_id is not None and label is not None else [0.0], "<f8") + 0.0
            top = np.abs(x).max()
            usable = np.isfinite(top) and top > 0
            vecs.append((x if 1e-100 < top < 1e100 else x / top).tobytes() if usable else None)
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(vecs, pa.binary())], names=["vec_id", "label", "vec"])


def _linked(unit: np.ndarray, passes: list[np.ndarray], filter_: int, across: np.ndarray | None, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs are linked, and which of those count here: all filters that both pass are at or after ``filter_``.

    ``across`` gives the side of each vector if only pairs of different sides are compared.
    """
    n = len(unit)
    # earlier filters of each vector, as a matrix of zeros and ones: its product tells who shares one
    early = [p[: np.searchsorted(p, filter_)] for p in passes]
    names, column = np.unique(np.concatenate(early), return_inverse=True)
    row = np.repeat(np.arange(n), [len(e) for e in early])
    linked, counts = np.zeros((n, n), bool), np.zeros((n, n), bool)
    for lo in range(0, n, _ROWS):
        hi = min(lo + _ROWS, n)
        now = unit[lo:hi] @ unit.T >= least
        now[np.arange(hi - lo), np.arange(lo, hi)] = False
        if across is not None:
            now &= across[lo:hi, None] != across
        linked[lo:hi] = counts[lo:hi] = now
    if len(names) and linked.any():
        for c in range(0, len(names), _COLUMNS):
            part = np.zeros((n, min(_COLUMNS, len(names) - c)), np.float32)
            here = (column >= c) & (column < c + _COLUMNS)
            part[row[here], column[here] - c] = 1
            for lo in range(0, n, _ROWS):
                counts[lo : lo + _ROWS] &= part[lo : lo + _ROWS] @ part.T == 0
    return linked, counts


def _forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is joined: fewer than there are vectors."""
    left, child, parent = np.ones(len(linked), bool), [], []
    for start in np.flatnonzero(linked.any(axis=1)).tolist():
        todo = [start] if left[start] else []
        left[start] = False
        while todo:
            v = todo.pop()
            new = np.flatnonzero(linked[v] & left)
            left[new] = False
            child.append(new)
            parent.append(np.full(len(new), v))
            todo.extend(new.tolist())
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *child]), np.concatenate([empty, *parent])


def _ends(col: pa.Array) -> np.ndarray:
    """Where each row of a binary or list column begins in its values, and where the last ends."""
    return np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1]


class _Rows:
    """Columns of the vectors of some buckets, taken out of Arrow once for all of them."""

    def __init__(self, t: pa.Table) -> None:
        t = t.combine_chunks()
        col = lambda c: t.column(c).chunk(0) if t.num_rows else t.column(c).combine_chunks()
        self.ids, self.side, self.copies, self.lo, self.hi, self.filter = (t.column(c).to_numpy() for c in ("vec_id", "side", "copies", "lo", "hi", "filter"))
        self.label = t.column("label").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        vec, passes = col("vec"), col("filters")
        self.vec_ends, self.pass_ends = _ends(vec), _ends(passes)
        self.size = np.diff(self.vec_ends)
        self._bytes = memoryview(vec.buffers()[2])
        self._passes = passes.values.to_numpy()
        self._unit = self._of(np.arange(t.num_rows)) if len(set(self.size.tolist())) == 1 else None

    def _of(self, at: np.ndarray) -> np.ndarray:
        whole = b"".join(self._bytes[a:b] for a, b in zip(self.vec_ends[at].tolist(), self.vec_ends[at + 1].tolist(), strict=True))
        x = np.frombuffer(whole, "<f8").reshape(len(at), -1)
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    def unit(self, at: np.ndarray) -> np.ndarray:
        return self._of(at) if self._unit is None else self._unit[at]

    def passes(self, at: np.ndarray) -> list[np.ndarray]:
        return [self._passes[a:b] for a, b in zip(self.pass_ends[at].tolist(), self.pass_ends[at + 1].tolist(), strict=True)]

    def groups(self, a: int, b: int) -> list[np.ndarray]:
        """A bucket is known by a hash: its rows of one label, filter and dimension each."""
        at = np.arange(a, b)
        key = np.stack([self.label[a:b], self.filter[a:b], self.size[a:b]], axis=1)
        if (key == key[0]).all():
            return [at]
        _, which = np.unique(key, axis=0, return_inverse=True)
        return [at[which.ravel() == k] for k in range(int(which.max()) + 1)]


def _compared(batches: Iterable[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Of each block, in order of the rows: how many rows each vector is linked to (``a``, ``b``), and links ``a > b`` that join what is linked.

    Linear in the vectors of a block, however many of them are linked. A pair counts in the first filter that both pass only.
    """

    def results(t: pa.Table, cuts: list[int]) -> Iterator[pa.RecordBatch]:
        rows, out = _Rows(t), []
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            for at in rows.groups(lo, hi) if hi - lo > 1 else ():
                if len(at) < 2:
                    continue
                across = rows.side[at] if rows.lo[lo] != rows.hi[lo] else None
                x = rows.unit(at)
                if len(at) <= 64 and np.count_nonzero(x @ x.T >= least) <= len(at):
                    continue  # nothing but each vector with itself
                linked, counts = _linked(x, rows.passes(at), int(rows.filter[at[0]]), across, least)
                n = counts @ rows.copies[at]
                some = np.flatnonzero(n)
                child, parent = (rows.ids[at[e]] for e in _forest(linked))
                out.append((np.repeat([False, True], [len(some), len(child)]), np.concatenate([rows.ids[at[some]], np.maximum(child, parent)]), np.concatenate([n[some], np.minimum(child, parent)])))
        if out:
            is_link, a, b = (np.concatenate(c) for c in zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(is_link), pa.array(a), pa.array(b)], names=["is_link", "a", "b"])

    rest = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = (pa.concat_tables([rest, t]) if rest is not None else t).combine_chunks()
        keys = np.stack([t.column(c).to_numpy() for c in ("bucket", "lo", "hi")], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist()]
        if len(cuts) > 1:
            yield from results(t.slice(0, cuts[-1]), cuts)
        rest = t.slice(cuts[-1])
    if rest is not None and rest.num_rows:
        yield from results(rest, [0, rest.num_rows])


def near_duplicates(spark: SparkSession, vectors: DataFrame, least: float = COSINE, block: int = BLOCK, vec_id: str = "vec_id", vec: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept``, one row for each row of ``vectors``.

    Two vectors are linked where their labels are equal and not null, their dimensions equal, and
    their cosine, in double precision, is at least ``least``. A vector that is null, empty, zero
    or holds null or non-finite numbers, or whose id is null, links with nothing (its component
    is its id, it is kept). ``n_links`` counts the other rows linked; repeated rows count as
    vectors of their own in one component. Other columns are ignored; an empty table gives an
    empty result.

    Equal vectors go on as one, with their number. A bucket holds the vectors of one label that
    pass one filter; one with more than ``block`` is compared by pairs of blocks, so no task
    gathers it. A block gives counts and a spanning forest of its links, never the pairs. A pair is
    found if any filter is common: of 24,000 pairs of cosine 0.98 in 64 and 256 dimensions all share
    one of their 16 best filters (one in 12,000 shares none of 12, ten share none of 8).
    """
    stage = Staging(spark, "caps")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vec).cast("array<double>").alias("vec"))
    kind = rows.schema["label"].dataType.simpleString()
    every = stage.write(rows.mapInArrow(_clean, f"vec_id long, label {kind}, vec binary"), "clean")
    clean = every.where("vec IS NOT NULL")
    classes = stage.write(clean.groupBy("label", "vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "classes")
    reps = classes.select(F.col("rep").alias("vec_id"), "label", "vec", "copies")
    coded = stage.write(reps.mapInArrow(_coded, f"vec_id long, label {kind}, vec binary, copies long, filters array<int>"), "coded")
    placed = coded.select("vec_id", "label", "vec", "copies", "filters", F.explode("filters").alias("filter")).withColumn("bucket", F.xxhash64("label", "filter"))
    large = placed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").withColumn("parts", F.ceil(F.col("n") / block).cast("int")).drop("n")
    side = F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")
    parted = placed.join(large, "bucket").withColumn("side", side).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    parted = parted.select("bucket", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"), "side", "label", "filter", "vec_id", "vec", "copies", "filters")
    dealt = parted.repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")
    found = stage.write(dealt.mapInArrow(lambda it: releasing(_compared(it, least)), "is_link boolean, a long, b long"), "found")
    roots = components(found.where("is_link").select(F.col("a").alias("src"), F.col("b").alias("dst")), stage)

    others = found.where("NOT is_link").groupBy("a").agg(F.sum("b").alias("others"))
    of_class = classes.join(others, classes["rep"] == others["a"], "left").join(roots, classes["rep"] == roots["node"], "left")
    of_class = of_class.select("label", "vec", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "rep").alias("component_id"))
    linked = clean.join(of_class, ["label", "vec"]).select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
    rest = every.where("vec IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    return linked.unionByName(rest)
