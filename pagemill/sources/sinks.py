"""Writes: partitioned splits, append-only ledgers, purges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PARTS = ("subject", "chapter_id")


def write_split(frames: dict[str, DataFrame], completeness: DataFrame, root: str) -> None:
    """Each table partitioned by subject and chapter; completeness last, as the marker of a whole write.

    Chapters that are written anew lose their marker first, so that one which fails half way counts as not written.
    """
    spark = completeness.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for row in completeness.select(*PARTS).distinct().toLocalIterator():
        p = jvm.org.apache.hadoop.fs.Path("/".join([f"{root}/completeness", *[f"{c}={row[c]}" for c in PARTS]]))
        p.getFileSystem(conf).delete(p, True)
    for name, df in [*frames.items(), ("completeness", completeness)]:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTS).json(f"{root}/{name}")


def whole_chapters(rows: DataFrame, completeness: DataFrame) -> DataFrame:
    """Rows of chapters that have their marker."""
    return rows.join(completeness.select(*PARTS).distinct(), list(PARTS), "left_semi")


def append_ledger(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def upsert(old: DataFrame, new: DataFrame, key: str, seq: str) -> DataFrame:
    """``new`` rows in place of ``old`` ones of the same key, of several new ones the last by ``seq``; keys keep no order."""
    last = new.groupBy(key).agg(F.max_by(F.struct(*new.columns), seq).alias("r")).select("r.*")
    return old.join(last.select(key), key, "left_anti").unionByName(last)


def ledger_subject(subject: str = "subject", key: str = "key") -> Column:
    """A ledger row's subject: its field, or else what stands before the first bar of its key, in capitals."""
    return F.upper(F.coalesce(F.nullif(F.col(subject), F.lit("")), F.split_part(F.col(key), F.lit("|"), F.lit(1))))


def purged(rows: DataFrame, subject: str) -> DataFrame:
    """A ledger without one subject's rows."""
    own = ledger_subject() if "subject" in rows.columns else F.upper(F.split_part("key", F.lit("|"), F.lit(1)))
    return rows.where(~own.eqNullSafe(F.lit(subject.upper())))


def purge_subject(spark: SparkSession, root: str, subject: str, tables: tuple[str, ...]) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in tables:
        p = jvm.org.apache.hadoop.fs.Path(f"{root}/{name}/subject={subject}")
        p.getFileSystem(conf).delete(p, True)
