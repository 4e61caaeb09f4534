"""Sharding: the smallest capacity for which ordered groups fit into so many contiguous shards."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .staging import Staging

SHARDS = 16
#: Atomic groups: texts of one hash slot, so equal texts are in one group. 2 MB of sizes on the driver, whatever the input.
SLOTS = 1 << 18


def cuts_within(sizes: np.ndarray, capacity: int) -> list[int]:
    """Ends of the shards that a greedy walk over the groups fills up to ``capacity``."""
    ends, total, at = np.cumsum(sizes), 0, 0
    out = []
    while at < len(sizes):
        nxt = int(np.searchsorted(ends, total + capacity, "right"))
        if nxt == at:
            return []
        out.append(nxt)
        at, total = nxt, int(ends[nxt - 1])
    return out


def minimax_cuts(sizes: np.ndarray, shards: int) -> tuple[list[int], int]:
    """Ends of at most ``shards`` contiguous runs of groups whose largest sum is least, and that sum."""
    total = int(sizes.sum())
    if not total:
        return [len(sizes)], 0
    lo, hi = max(int(sizes.max()), -(-total // shards)), total
    while lo < hi:
        mid = (lo + hi) // 2
        if len(cuts_within(sizes, mid)) <= shards:
            hi = mid
        else:
            lo = mid + 1
    return cuts_within(sizes, lo), lo


def _numbered(batches: Iterable[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    task, seen = TaskContext.get().partitionId(), np.zeros(shards, np.int64)
    for batch in batches:
        shard = batch.column("shard").to_numpy()
        order = np.argsort(shard, kind="stable")
        counts = np.bincount(shard, minlength=shards)
        at = np.empty(len(shard), np.int64)
        at[order] = np.arange(len(shard)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(seen, counts)
        seen += counts
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(shard), task, np.int32)), pa.array(at)], names=[*batch.schema.names, "task", "at"])


def shard(spark: SparkSession, docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``, one row for each row of ``docs``.

    The law is ``bytes``: sizes (UTF-8 bytes and one) near equal. Atomic groups are the texts of one of ``slots`` hash slots,
    in the order of the slots; the smallest capacity that lets them fit into ``shards`` contiguous
    runs is found by binary search with a greedy check, and the cuts are made there. Equal texts
    share a shard. A group larger than an even share makes its own capacity; fewer runs than
    ``shards`` may then be left, the other shards are empty.

    Null text counts as empty (size 1). Null ids and repeated rows are kept like others; other
    columns are ignored; an empty table gives an empty result. Slots number a shard's rows from 0.

    One grouped sum is shuffled (a row for each slot and task at most). Rows are then numbered
    where they are read, and the tasks' first numbers come from a table of tasks and shards, so
    a shard is never sorted or gathered.
    """
    stage = Staging(spark, "sharding")
    body = F.coalesce(F.col(text), F.lit(""))
    slot: Column = F.pmod(F.xxhash64(body), F.lit(slots))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), slot.alias("g"))
    sums = rows.groupBy("g").agg(F.sum("size").alias("size")).toArrow()
    sizes = np.zeros(slots, np.int64)
    sizes[sums["g"].to_numpy()] = sums["size"].to_numpy()
    ends, _ = minimax_cuts(sizes, shards)
    which = sum(((F.col("g") >= e).cast("int") for e in ends[:-1]), F.lit(0))
    cut = rows.select("doc_id", "size", "text_crc32", which.alias("shard"))
    numbered = stage.write(cut.mapInArrow(lambda it: _numbered(it, shards), "doc_id long, size long, text_crc32 long, shard int, task int, at long"), "rows")
    counts = numbered.groupBy("task", "shard").count()
    first = counts.select("task", "shard", (F.sum("count").over(Window.partitionBy("shard").orderBy("task")) - F.col("count")).alias("first"))
    joined = numbered.join(first, ["task", "shard"])
    return joined.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("first") + F.col("at")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
