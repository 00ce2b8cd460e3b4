"""One ingest run: flatten landed payloads, append, and log the run whatever its outcome."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gaugelake.functions.clock import moment
from gaugelake.operators.catalogue import build_sensor_rows, build_station_rows, catalogue_summary, select_stations
from gaugelake.operators.runs import run_log_row, run_summary
from gaugelake.schemas import RUN_LOG
from gaugelake.sources.payloads import (
    flatten_forecast_batch,
    flatten_hourly_readings,
    forecast_outcomes,
    parse_catalogue,
    reading_outcomes,
)
from gaugelake.sources.catalog import SwitchedTables
from gaugelake.sources.tables import TableSpec, append, append_run_log, observed, overwrite, read_table

_INSTANT = RUN_LOG["run_started_at"].dataType


def _run(
    spark: SparkSession,
    rows: Callable[[Observation], DataFrame],
    outcomes: Callable[[bool], DataFrame],
    target: TableSpec,
    run_log: TableSpec,
    run_id: str,
    source: str,
    started: datetime,
    window: tuple[datetime, datetime] | None,
    by_station: bool,
) -> dict:
    failure = written = None
    unread, answered = Observation(), False
    try:
        written = append(rows(unread), target)
        # Where the write met no unreadable answer, the accounting need not read the answers again.
        answered = observed(unread).get("unread") == 0
    except Exception as problem:
        failure = f"{type(problem).__name__}: {problem}"
    if failure is None and written["rows"]:
        # Only the partitions just written are read back for the distinct counts.
        landed = read_table(spark, target, written["first"], written["last"])
        data = landed.filter(F.col("run_id") == run_id)
    else:
        data = spark.createDataFrame([], target.schema)
    unit = "station_id" if by_station else "openaq_sensor_id"
    start, end = window or (None, None)

    def account(requests: DataFrame, problem: str | None):
        failures = spark.createDataFrame(
            [(run_id, None, problem)], "run_id string, unhandled_error string, write_error string"
        )
        return run_log_row(
            run_summary(data, requests, failures, target.time_column, unit),
            source,
            moment(started, _INSTANT),
            moment(datetime.now(UTC), _INSTANT),
            window_start=None if start is None else moment(start, _INSTANT),
            window_end=None if end is None else moment(end, _INSTANT),
            by_station=by_station,
        ).first()

    try:
        fetched = account(outcomes(answered), failure)
    except Exception as problem:
        # The payloads themselves cannot be read: the run is still logged.
        none = spark.createDataFrame([], f"run_id string, {unit} string, ok boolean")
        fetched = account(none, failure or f"{type(problem).__name__}: {problem}")
    append_run_log(spark.createDataFrame([fetched], RUN_LOG), run_log)
    return fetched.asDict()


def ingest_readings(
    spark: SparkSession,
    payloads: DataFrame,
    sensors: DataFrame,
    target: TableSpec,
    run_log: TableSpec,
    run_id: str,
    started: datetime,
    lookback_hours: int = 3,
    enforce_complete_hours: bool = True,
    source: str = "openaq",
) -> dict:
    """Readings run over landed pages; returns its run-log row."""
    window_end = started.replace(minute=0, second=0, microsecond=0)
    window = (window_end - timedelta(hours=lookback_hours), window_end)
    return _run(
        spark,
        lambda unread: flatten_hourly_readings(
            payloads, sensors, started, run_id, window_end, enforce_complete_hours, unread
        ),
        lambda answered: reading_outcomes(payloads, run_id, answered),
        target,
        run_log,
        run_id,
        source,
        started,
        window,
        by_station=False,
    )


def ingest_forecasts(
    spark: SparkSession,
    payloads: DataFrame,
    target: TableSpec,
    run_log: TableSpec,
    run_id: str,
    started: datetime,
    source: str = "open-meteo",
) -> dict:
    """Forecast run over landed batches; returns its run-log row."""
    return _run(
        spark,
        lambda unread: flatten_forecast_batch(payloads, started, run_id, unread),
        lambda answered: forecast_outcomes(payloads, run_id, answered),
        target,
        run_log,
        run_id,
        source,
        started,
        None,
        by_station=True,
    )


CATALOGUE_TABLES = ("stations", "sensors")


def _kept(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    kept, reasons = select_stations(parse_catalogue(pages))
    if kept.isEmpty():
        raise ValueError("no catalogue item passed the filters")
    return kept, reasons


def refresh_catalogue(
    pages: DataFrame, stations_path: str, sensors_path: str, loaded_at: datetime | None = None
) -> tuple[DataFrame, DataFrame]:
    """Full refresh of stations and sensors; returns ``(summary, reason_counts)``.

    A catalogue of which nothing is kept leaves the tables as they are. The two tables are
    replaced one after the other; :func:`switch_catalogue` replaces them together.
    """
    kept, reasons = _kept(pages)
    overwrite(build_station_rows(kept, loaded_at), stations_path)
    overwrite(build_sensor_rows(kept, loaded_at), sensors_path)
    spark = pages.sparkSession
    return catalogue_summary(spark.read.parquet(stations_path), spark.read.parquet(sensors_path)), reasons


def switch_catalogue(
    pages: DataFrame, tables: SwitchedTables, loaded_at: datetime | None = None
) -> tuple[DataFrame, DataFrame]:
    """Full refresh of stations and sensors in one switch; returns ``(summary, reason_counts)``.

    ``tables`` are :data:`CATALOGUE_TABLES`. A refresh that fails, or of which nothing is kept, leaves
    both as they are, and no reader sees the stations of one refresh with the sensors of another.
    """
    kept, reasons = _kept(pages)
    stations, sensors = CATALOGUE_TABLES
    tables.load({stations: build_station_rows(kept, loaded_at), sensors: build_sensor_rows(kept, loaded_at)})
    return catalogue_summary(tables.table(stations), tables.table(sensors)), reasons
