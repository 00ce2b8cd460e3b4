"""Session settings the operators rely on, and the shared folder of the cluster."""

from __future__ import annotations

import os
import tempfile
from functools import cache

from pyspark.sql import SparkSession

# Runtime SQL settings. The number of shuffle partitions is the cluster's to set, once, for its
# largest input: adaptive execution merges what turns out small. Hot keys are split by AQE where a join has to shuffle, and
# sides are broadcast only when their measured size is under Spark's threshold.
_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def importable(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this library from where the driver has it, whatever their working folder.

    On a cluster the library has to be installed there or shipped with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *paths]))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session that names none gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="gaugelake-")
