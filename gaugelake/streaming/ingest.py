"""Streaming twins of the ingest runs, and a materialised table of newest versions.

Deliveries overlap and may repeat, so the raw table only ever appends and the newest
version is chosen afterwards. A dropped-duplicates stream would keep the first
version, which is the wrong one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import Future

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugelake.operators.forecasts import dedup_latest_forecasts
from gaugelake.operators.readings import dedup_latest_readings
from gaugelake.sources.payloads import (
    LANDED_FORECASTS,
    LANDED_READINGS,
    flatten_forecast_batch,
    flatten_hourly_readings,
)
from gaugelake.sources.tables import PARTITION, TableSpec, append, append_once, read_table


FILES_PER_BATCH = 1_000


def landed_stream(
    spark: SparkSession, landing: str, schema: str, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """Landed requests (``LANDED_READINGS`` or ``LANDED_FORECASTS``) as they arrive.

    ``files_per_batch`` bounds a micro-batch, also when a backlog is worked off.
    """
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(landing)


def reading_stream(
    spark: SparkSession,
    landing: str,
    sensors: DataFrame,
    enforce_complete_hours: bool = True,
    files_per_batch: int = FILES_PER_BATCH,
) -> DataFrame:
    """Reading rows from a folder of landed JSON lines, as they arrive."""
    landed = landed_stream(spark, landing, LANDED_READINGS, files_per_batch)
    return flatten_hourly_readings(
        landed,
        sensors,
        F.col("ingested_at"),
        F.col("run_id"),
        F.col("window_end"),
        enforce_complete_hours,
    )


def forecast_stream(spark: SparkSession, landing: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Forecast rows from a folder of landed JSON lines, as they arrive."""
    landed = landed_stream(spark, landing, LANDED_FORECASTS, files_per_batch)
    return flatten_forecast_batch(landed, F.col("ingested_at"), F.col("run_id"))


def refresh_latest(
    spark: SparkSession,
    raw: TableSpec,
    latest: TableSpec,
    days: Sequence,
    dedup: Callable[[DataFrame], DataFrame],
) -> None:
    """Rebuild the given dates of the newest-version table from the raw table.

    It never reads what it writes, so a repeated or interrupted refresh is simply run again.
    """
    if not days:
        return
    dated = [day for day in days if day is not None]
    touched = F.col(PARTITION).isin(*dated) if dated else F.lit(False)
    if None in days:
        touched = touched | F.col(PARTITION).isNull()
    rows = read_table(spark, raw, keep_date=True).filter(touched).drop(PARTITION)
    dated = dedup(rows).withColumn(PARTITION, F.to_date(latest.time_column))
    (
        dated.hint("rebalance", F.col(PARTITION))
        .sortWithinPartitions(PARTITION, *latest.cluster_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION)
        .parquet(latest.path)
    )


def start_ingest(
    rows: DataFrame,
    raw: TableSpec,
    checkpoint: str,
    latest: TableSpec | None = None,
    dedup: Callable[[DataFrame], DataFrame] | None = None,
    typed: Callable[[DataFrame], DataFrame] | None = None,
    **trigger,
) -> StreamingQuery:
    """Append each micro-batch to ``raw`` and refresh the touched dates of ``latest``.

    By default all landed files are taken and the query ends. The touched dates, None for rows
    without a time, are observed while the batch is written. A batch that is repeated after a failure is
    not appended again to a ``raw`` table laid out by batch if it is there as a whole, else it replaces what is there of
    it; in any other table its rows are appended again, which dedup resolves.

    ``typed`` makes the rows of ``raw`` from a micro-batch of ``rows``. Spark runs the shuffles of a stream's own plan
    before a micro-batch is handed over; those of ``typed`` run only if its rows are appended.
    """
    stream: Future[str] = Future()

    def write(batch: DataFrame, number: int) -> None:
        # The id of a query is kept in its checkpoint, so a restarted stream repeats the name of its batch
        # and a stream of another checkpoint never takes it.
        name = f"{stream.result()}-{number}"
        made = batch if typed is None else typed(batch)
        days = append_once(made, raw, name) if raw.by_batch else append(made, raw)["days"]
        if latest is not None:
            refresh_latest(batch.sparkSession, raw, latest, days, dedup)

    query = (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    stream.set_result(query.id)
    return query


def newest_readings(rows: DataFrame) -> DataFrame:
    return dedup_latest_readings(rows, stable_key=True)


def newest_forecasts(rows: DataFrame) -> DataFrame:
    return dedup_latest_forecasts(rows)


def request_buckets(
    requests: DataFrame,
    by: Sequence[str],
    ts: str = "started_at",
    bucket_seconds: int = 10,
    lateness: str = "1 minute",
) -> DataFrame:
    """Requests per tumbling bucket of a request stream. Empty buckets do not appear in a stream."""
    timed = requests.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)
    return (
        timed.groupBy(*by, F.window(ts, f"{bucket_seconds} seconds").alias("bucket"))
        .agg(F.count(F.lit(1)).alias("requests"))
        .select(*by, F.col("bucket.start").alias("bucket_start"), "requests")
    )
