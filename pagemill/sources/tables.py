"""Scans with explicit schemas; an absent source is an empty table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def exists(spark: SparkSession, path: str) -> bool:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(conf).globStatus(p)
    return found is not None and len(found) > 0


def json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of a JSON Lines file or folder; none if it is absent. Hive-style folders give their columns."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def ledger(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """An append-only ledger; lines that are no JSON are passed over."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    read = spark.read.schema(StructType([*schema.fields, StructField(CORRUPT, StringType())])).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    # the corrupt column alone is not stored by the reader: keep it beside the others
    return read.json(path).where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def page_text(spark: SparkSession, path: str) -> DataFrame | None:
    """``subject, page, text`` of all books, or None where no page texts were kept: absent evidence is not empty evidence."""
    if not exists(spark, path):
        return None
    return spark.read.schema("subject string, page int, text string").json(path)


def first_root(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row for each key, from the root that comes first."""
    return rows.groupBy(key).agg(F.min_by(F.struct(*rows.columns), order).alias("r")).select("r.*")
