"""Tables written between the stages of one operator, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from .arrow import small_batches


class Staging:
    """Writes tables under ``spark.checkpoint.dir``; lineage ends there, so lost executors cost nothing.

    Where the setting is unset (a local session, as in tests) a temporary folder serves. ``drop``
    deletes tables that no later step reads; those of a returned plan stay.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        small_batches(spark)
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            base = tempfile.mkdtemp(prefix="pagemill-")
        self.root = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(conf).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
