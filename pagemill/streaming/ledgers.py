"""Ledgers and quotas as streams. Each query takes a streaming frame and gives one; sinks are the caller's."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read(spark: SparkSession, folder: str, name: str, schema: StructType, files: int = 1000) -> DataFrame:
    """New parquet files of one table as they come, so many at a time."""
    return spark.readStream.schema(schema).option("pathGlobFilter", name).option("maxFilesPerTrigger", files).parquet(folder)


def daily(events: DataFrame, ts: str, key: str, late: str = "1 day") -> DataFrame:
    """Calls of each key and day; a day is closed once ``late`` has passed over it."""
    timed = events.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    return timed.groupBy(F.window("_ts", "1 day"), key).agg(F.count("*").alias("calls")).select(key, F.to_date("window.start").alias("day"), "calls")


def sliding(events: DataFrame, ts: str, key: str, length: str, step: str, late: str = "1 hour") -> DataFrame:
    timed = events.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    return timed.groupBy(F.window("_ts", length, step), key).agg(F.count("*").alias("calls")).select(key, F.col("window.start").alias("start"), "calls")


def sessions(events: DataFrame, ts: str, key: str, gap: str, late: str = "1 hour") -> DataFrame:
    timed = events.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    return timed.groupBy(F.session_window("_ts", gap), key).agg(F.count("*").alias("calls")).select(key, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "calls")


def latest(events: DataFrame, key: str, seq: str, value: str) -> DataFrame:
    """The last row of each key so far; in complete or update mode."""
    return events.groupBy(key).agg(F.max(F.struct(seq, value)).alias("r")).select(key, "r.*")


def once_per(events: DataFrame, ts: str, signature: list[str], late: str = "1 hour") -> DataFrame:
    """The first event of each signature while the watermark remembers it."""
    return events.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late).dropDuplicatesWithinWatermark(signature)


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder where it is unset, in a local session only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="pagemill-")
    return base.rstrip("/")


def _folders(spark: SparkSession, root: str) -> list[str]:
    """Names in a folder of the shared store, those with a success mark: what was written whole."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    return [f.getPath().getName() for f in fs.listStatus(path) if f.isDirectory() and fs.exists(jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))]


def drained(stream: DataFrame, mode: str, name: str) -> DataFrame:
    """All that the stream has now, as a table in the shared folder, with its state beside it: nothing is gathered on the driver.

    In complete mode each batch replaces the table, in the others it is added. A batch has a folder by
    its number: one that is tried again after a failure replaces what it wrote, so a stream that was killed and is started again under
    its name gives each row once.
    """
    spark = stream.sparkSession
    root = f"{shared_folder(spark)}/{name}"
    part = lambda k: f"{root}/table/{'all' if mode == 'complete' else f'batch-{k}'}"
    spark.createDataFrame([], stream.schema).write.mode("ignore").parquet(f"{root}/table/none")
    sink = stream.writeStream.outputMode(mode).foreachBatch(lambda batch, k: batch.write.mode("overwrite").parquet(part(k)))
    sink.option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/table/*")


def upserted(stream: DataFrame, key: str, seq: str, name: str) -> DataFrame:
    """The row with the greatest ``seq`` of each ``key``, over all that the stream has had, as a table in the shared folder.

    Each batch writes a version of its number from the one before and its own rows; readers take the
    last that was written whole. A batch that is tried again starts from the version before it, not from its own, so
    it may be repeated; equal rows of one ``seq`` may stand for each other. All versions stay until the folder is cleared.
    """
    spark = stream.sparkSession
    root = f"{shared_folder(spark)}/{name}"
    number = lambda folder: int(folder.removeprefix("v-"))

    def whole() -> list[int]:
        return sorted(number(f) for f in _folders(spark, f"{root}/table") if f.startswith("v-"))

    def version(k: int | None) -> DataFrame:
        return spark.createDataFrame([], stream.schema) if k is None else spark.read.schema(stream.schema).parquet(f"{root}/table/v-{k}")

    def step(batch: DataFrame, k: int) -> None:
        before = max((v for v in whole() if v < k), default=None)
        row = F.struct(*[F.col(f"`{c}`") for c in stream.columns])
        every = version(before).unionByName(batch.select(stream.columns))
        every.groupBy(key).agg(F.max_by(row, seq).alias("r")).select("r.*").write.mode("overwrite").parquet(f"{root}/table/v-{k}")

    sink = stream.writeStream.outputMode("append").foreachBatch(step)
    sink.option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start().awaitTermination()
    return version(max(whole(), default=None))


def judged(decisions: DataFrame, items: DataFrame, key: str, fp: str) -> DataFrame:
    """Decisions (with ``action``) as they come, each with ``state`` by the table of items as it is then: stale:action where the item's
    fingerprint is another one by now, decided:action where it is the same, gone where no item has the key. A stream meets a table."""
    now = items.select(key, F.col(fp).alias("_now"), F.lit(True).alias("_there"))
    state = F.when(F.col("_there").isNull(), F.lit("gone")).when(F.col(fp).eqNullSafe(F.col("_now")), F.concat(F.lit("decided:"), F.col("action"))).otherwise(F.concat(F.lit("stale:"), F.col("action")))
    return decisions.join(now, key, "left").withColumn("state", state).drop("_now", "_there")
