"""Mixing sources to target weights by weighted fair queueing.

A source is a queue of its documents in shuffled order, repeated a few times. A document's virtual
finish time is what its source has served up to its end, divided by the source's weight: queues are
served at rates that are as their weights. All documents are sorted by that time over the whole
cluster, and the order ends where the budget is used up. Built-in expressions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .staging import Staging

WEIGHTS = (1, 2, 3)
#: A source is read so many times at most.
REPEATS = 3
SEED = 42
#: Rows that one task sorts where a source is split by the first digits of its documents' draws.
SLOT_ROWS = 1 << 14
#: Digits at least: 4,096 slots of a source.
SLOT_DIGITS = 3


@dataclass
class Mixture:
    """``documents``: a row for each input row with its place in its source's queue; ``order``: what is taken, a row for each
    document and turn; ``budget``: all words that may be taken."""

    documents: DataFrame
    order: DataFrame
    budget: int

    def taken(self) -> DataFrame:
        """``doc_id, size, source, source_size, target, taken``, one row for each input row."""
        per_row = self.order.groupBy("queue", "slot", "place").agg(F.sum("words").alias("taken"))
        return self.documents.join(per_row, ["queue", "slot", "place"], "left").select("doc_id", "size", "source", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def _running(stage: Staging, df: DataFrame, order: Sequence[str], amount: Column, name: str) -> DataFrame:
    """``df`` sorted over the cluster by ``order``, and ``name``: the sum of ``amount`` over all rows before a row.

    Rows are dealt out by range and written with the number of their range; a window goes over each
    range, and what lies before it comes from one row for each range: a table that the number of
    partitions bounds.
    """
    dealt = stage.write(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).withColumn("_amount", amount), f"{name}-ranges")
    sums = dealt.groupBy("_range").agg(F.sum("_amount").alias("_sum"))
    before = sums.select("_range", (F.sum("_sum").over(Window.orderBy("_range")) - F.col("_sum")).alias("_before"))
    within = F.sum("_amount").over(Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) - F.col("_amount")
    return dealt.withColumn("_within", within).join(F.broadcast(before), "_range").withColumn(name, F.col("_before") + F.col("_within")).drop("_range", "_amount", "_sum", "_before", "_within")


def _level(sources: DataFrame, budget: int) -> float | None:
    """Words for each unit of weight, so that targets share the budget and none is above its source's limit.

    Sources above their limit get it, and what is left is shared anew until none is. A round brings
    one row to the driver. None where all sources reach their limits.
    """
    level, limited = None, -1
    while True:
        over = F.lit(False) if level is None else F.col("weight") * F.lit(level) > F.col("limit")
        row = sources.agg(F.sum(F.when(over, F.col("limit")).otherwise(0)).alias("limits"), F.sum(F.when(over, 0).otherwise(F.col("weight"))).alias("weights"), F.sum(over.cast("long")).alias("n")).first()
        if not row.weights:
            return None
        if row.n == limited:
            return level
        level, limited = (budget - row.limits) / row.weights, row.n


def mix(
    spark: SparkSession,
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = 1.0,
    repeats: int = REPEATS,
    seed: int = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> Mixture:
    """The mixture of all ``docs``: sources, in the order of their code points and null last, have ``weights`` in turn.

    The budget is ``share`` of all words; a source gets ``repeats`` times its words at most, what it
    cannot use goes to the others by weight. ``order`` has ``doc_id, source, turn, finish, words,
    offset``: its rows in the order of ``offset`` are the mixture, ``words`` is what is taken from the start of
    the document in that turn. The budget ends at one virtual time for all queues: what is being served
    then is cut there, so each source's words are its target rounded down.

    Shuffling is by SHA-256 of the seed, the id and the MD5 of the text, so reruns agree whatever the
    partitions. Null texts, and texts without a word, have size 0 and nothing is taken of them; null ids and repeated rows are
    documents like others; rows alike in all columns may stand for each other. An empty table, or one without words, gives an
    empty order. Columns of other names are ignored.

    A source is split by the first digits of its draws, in as many slots as rows need: no task sorts a
    source, and one that holds all rows is split like many small ones. What follows a slot is a sum over slots.
    """
    stage = Staging(spark, "mixing")
    body = F.coalesce(F.col(text), F.lit(""))
    size = F.regexp_count(body, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), F.md5(body))
    # a queue's key sorts like its source, null last
    queue = F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("t"))
    rows = stage.write(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).alias("source"), queue.alias("queue"), size.alias("size"), F.substring(F.sha2(key, 256), 1, 16).alias("draw")), "rows")

    sums = rows.groupBy("queue").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    ranked = _running(stage, sums, ["queue"], F.lit(1), "rank")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    sources = stage.write(ranked.select("queue", "source_size", "n", weight.cast("long").alias("weight"), (F.col("source_size") * repeats).alias("limit")), "sources")
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("words"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    budget = int(total.words * share) if share != 1.0 else total.words
    level = _level(sources, budget) if total.n else None
    free = F.lit(None).cast("double") if level is None else F.col("weight") * F.lit(level)
    target = F.least(F.col("limit").cast("double"), free)
    sources = sources.select("queue", "source_size", "weight", target.alias("target"), F.least("limit", F.floor(target)).alias("cut"))

    digits = SLOT_DIGITS
    while total.n > SLOT_ROWS * 16**digits and digits < 16:
        digits += 1
    slotted = rows.withColumn("slot", F.substring("draw", 1, digits))
    slots = slotted.groupBy("queue", "slot").agg(F.sum("size").alias("slot_size"))
    slots = slots.withColumn("before", F.sum("slot_size").over(Window.partitionBy("queue").orderBy("slot")) - F.col("slot_size")).join(sources, "queue")
    queued = Window.partitionBy("queue", "slot").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = slotted.withColumn("start", F.sum("size").over(queued) - F.col("size")).withColumn("place", F.count("*").over(queued)).join(slots, ["queue", "slot"])
    documents = stage.write(placed.select("doc_id", "source", "queue", "slot", "place", "draw", "size", "source_size", "weight", "target", "cut", (F.col("before") + F.col("start")).alias("start")), "documents")
    stage.drop("rows")

    turns = documents.where("size > 0").withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    turns = turns.withColumn("start", F.col("turn") * F.col("source_size") + F.col("start")).where("start < cut")
    turns = turns.withColumn("end", F.least(F.col("start") + F.col("size"), F.col("cut")))
    served = turns.select("doc_id", "source", "queue", "slot", "place", "draw", "turn", (F.col("end") / F.col("weight")).alias("finish"), (F.col("end") - F.col("start")).alias("words"))
    ordered = _running(stage, served, ["finish", "draw", "doc_id", "turn"], F.col("words"), "offset")
    order = ordered.withColumn("words", F.least("words", F.lit(budget) - F.col("offset"))).where("words > 0")
    return Mixture(documents, order, budget)
