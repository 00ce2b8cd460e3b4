"""Partitioned Parquet tables: append, full refresh, pruned reads and retention."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from datetime import UTC, date, datetime, timedelta

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from gaugelake.functions.clock import Moment, moment, moment_like
from gaugelake.schemas import FORECASTS, READINGS, RUN_LOG, conform, enforce_not_null

log = logging.getLogger(__name__)

PARTITION = "p_date"
BATCH = "p_batch"
RETENTION_DAYS = 30


class TableSpec:
    """Where a table lives and how it is laid out.

    With ``by_batch`` every date holds a folder per appended batch, named by the batch, so a batch that is
    appended again replaces itself. All appends to such a table name their batch.
    """

    def __init__(
        self,
        path: str,
        schema: StructType,
        time_column: str,
        cluster_by: Sequence[str] = (),
        by_batch: bool = False,
    ):
        self.path = path
        self.schema = schema
        self.time_column = time_column
        self.cluster_by = tuple(cluster_by)
        self.by_batch = by_batch


def readings_table(path: str, by_batch: bool = False) -> TableSpec:
    return TableSpec(path, READINGS, "period_from_utc", ("station_id", "pollutant"), by_batch)


def forecasts_table(path: str, by_batch: bool = False) -> TableSpec:
    return TableSpec(path, FORECASTS, "valid_time", ("station_id",), by_batch)


def run_log_table(path: str) -> TableSpec:
    return TableSpec(path, RUN_LOG, "run_started_at")


def _laid_out(df: DataFrame, table: TableSpec) -> DataFrame:
    """Rows with their partition date, gathered by date and sorted by the cluster columns.

    ``rebalance`` gathers small dates into few files and splits a large date over many
    tasks. The sort gives each row group a narrow range of stations, which scans skip by.
    """
    dated = df.withColumn(PARTITION, F.to_date(table.time_column))
    return dated.hint("rebalance", F.col(PARTITION)).sortWithinPartitions(PARTITION, *table.cluster_by)


def observed(seen: Observation) -> dict:
    """Metrics of a finished write, none of them where Spark knew a frame to be empty and reports none."""
    try:
        return seen.get
    except Py4JError:
        return {}


def _observed(seen: Observation, df: DataFrame, **when_empty) -> dict:
    """Metrics of a finished write. Spark reports none for a frame it knows to be empty."""
    try:
        return seen.get
    except Py4JError:
        if df.isEmpty():
            return when_empty
        raise


def append(df: DataFrame, table: TableSpec, batch: str | None = None) -> dict:
    """Append rows under the table's schema; returns their count, the range of their time and their dates.

    ``days`` has one entry per touched partition, None for rows without a time. A row without a required value fails the append, and nothing is added. An empty frame adds no file and counts 0.
    ``batch`` names the rows of a table that is laid out by batch: given again, they replace those of the first time.
    """
    if table.by_batch != (batch is not None):
        raise ValueError("a batch is named for tables laid out by batch, and for those alone")
    seen = Observation()
    ts = F.col(table.time_column)
    counted = enforce_not_null(conform(df, table.schema), table.schema).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.min(ts).alias("first"), F.max(ts).alias("last"),
        F.collect_set(F.to_date(ts)).alias("days"), F.count_if(ts.isNull()).alias("undated"),
    )
    laid = _laid_out(counted, table)
    if batch is None:
        laid.write.mode("append").partitionBy(PARTITION).parquet(table.path)
    else:
        (
            laid.withColumn(BATCH, F.lit(batch))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(PARTITION, BATCH)
            .parquet(table.path)
        )
    found = dict(_observed(seen, counted, rows=0, first=None, last=None, days=[], undated=0))
    return found | {"days": [*found["days"], *([None] if found["undated"] else [])]}


def append_once(df: DataFrame, table: TableSpec, batch: str) -> list[date | None]:
    """Append a named batch unless it is in ``table`` as a whole; returns its dates as :func:`append` gives them.

    A batch is recorded beside the rows when all of them are in place. One that broke off before has no record
    and replaces what it left.
    """
    spark, record = df.sparkSession, f"{table.path}/_{BATCH}/{batch}"
    known = _recorded(spark, record)
    if known is None:
        known = append(df, table, batch)["days"]
        days = F.array(*[F.lit(day) for day in known]).cast("array<date>")
        spark.range(1, numPartitions=1).select(days.alias("days")).write.mode("overwrite").parquet(record)
    return known


def _recorded(spark: SparkSession, record: str) -> list[date | None] | None:
    """Dates of a batch that was recorded. A record that broke off is a folder without a row."""
    path = spark._jvm.org.apache.hadoop.fs.Path(record)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    row = spark.read.schema("days array<date>").parquet(record).first()
    return row and row["days"]


def overwrite(df: DataFrame, path: str) -> int:
    """Full refresh of an unpartitioned table; returns its row count."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return _observed(seen, df, rows=0)["rows"]


def append_run_log(row: DataFrame, table: TableSpec) -> bool:
    """Append to the run log. A failure is logged and reported, never raised."""
    try:
        append(row, table)
        return True
    except Exception:
        log.exception("could not write the run log")
        return False


def read_table(
    spark: SparkSession, table: TableSpec, since: Moment = None, until: Moment = None, keep_date: bool = False
) -> DataFrame:
    """The table, with its declared schema; bounds (inclusive) also prune partitions.

    Parquet cannot derive the partition date from a filter on the time column, so both
    filters are given.
    """
    folders = [StructField(PARTITION, DateType()), *([StructField(BATCH, StringType())] if table.by_batch else [])]
    df = spark.read.schema(StructType([*table.schema.fields, *folders])).parquet(table.path).drop(BATCH)
    kind = table.schema[table.time_column].dataType
    if since is not None:
        low = moment(since, kind)
        df = df.filter((F.col(PARTITION) >= F.to_date(low)) & (F.col(table.time_column) >= low))
    if until is not None:
        high = moment(until, kind)
        df = df.filter((F.col(PARTITION) <= F.to_date(high)) & (F.col(table.time_column) <= high))
    return df if keep_date else df.drop(PARTITION)


def retain_days(df: DataFrame, time_column: str, days: int = RETENTION_DAYS, as_of: Moment = None) -> DataFrame:
    """Rows whose partition date is not expired; the read-side twin of :func:`expire_partitions`.

    A date expires when it is ``days`` or more before ``as_of``. The first date that is
    not is a constant, so the filter reaches the scan. Rows without a time never expire.
    """
    expired = F.to_date(F.timestamp_add("DAY", F.lit(-days), moment_like(df, time_column, as_of)))
    first_kept = F.date_add(expired, 1).cast(df.schema[time_column].dataType)
    return df.filter((F.col(time_column) >= first_kept) | F.col(time_column).isNull())


def partition_dates(spark: SparkSession, path: str) -> dict[date, str]:
    """Partition directories of a table by date. This lists directories and reads no data."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return {}
    found = {}
    for status in fs.listStatus(root):
        name, _, value = status.getPath().getName().partition("=")
        if name == PARTITION and value and not value.startswith("__"):
            found[date.fromisoformat(value)] = status.getPath().toString()
    return found


def expire_partitions(
    spark: SparkSession, table: TableSpec, days: int = RETENTION_DAYS, as_of: datetime | None = None
) -> list[date]:
    """Drop the partitions whose date is ``days`` or more before ``as_of`` (UTC, default now)."""
    now = as_of or datetime.now(UTC).replace(tzinfo=None)
    dropped = []
    for day, location in sorted(partition_dates(spark, table.path).items()):
        if datetime.combine(day, datetime.min.time()) + timedelta(days=days) <= now:
            target = spark._jvm.org.apache.hadoop.fs.Path(location)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
            dropped.append(day)
    return dropped
