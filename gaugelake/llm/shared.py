"""Tables written to the folder that driver and executors share, to cut long plans."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from gaugelake.session import shared_folder


def importable(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this library from where the driver has it, whatever their working folder.

    On a cluster the library has to be installed there or shipped with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *paths]))
    return spark


#: Texts of 10,000 rows, Spark's usual batch, are some 35 MB, which the JVM holds outside its heap in vectors that grow by doubling.
_BATCH_BYTES = 2 * 1024 * 1024


def small_batches(spark: SparkSession) -> SparkSession:
    """Rows go to Python workers in batches of bounded bytes, from now on in this session."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", _BATCH_BYTES)
    return spark


class Scratch:
    """A fresh subfolder of the shared folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/gaugelake-{name}-{uuid.uuid4().hex}"
        self._count = 0

    def save(self, df: DataFrame, compression: str = "zstd") -> DataFrame:
        """The frame written as Parquet and read back: its plan is a scan, its rows are fixed."""
        self._count += 1
        path = f"{self.path}/{self._count}"
        df.write.option("compression", compression).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
