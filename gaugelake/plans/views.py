"""The views under their SQL names, and the frames of the dashboard pages."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from gaugelake.functions.clock import Moment
from gaugelake.operators import catalogue, dashboard, forecasts, readings, runs
from gaugelake.schemas import REQUIRED_POLLUTANTS


def views(
    raw_readings: DataFrame,
    raw_forecasts: DataFrame,
    stations: DataFrame,
    run_log: DataFrame,
    reference_ts: Moment = None,
    stable_key: bool = False,
    required: Sequence[str] = REQUIRED_POLLUTANTS,
) -> dict[str, DataFrame]:
    """All views as lazy frames by SQL name. Nothing is computed or stored.

    Where a relation has a long and a wide form, the wide one is the ``v_`` view.
    """
    combined = forecasts.station_hourly_combined(raw_readings, raw_forecasts, required, stable_key)
    return {
        "v_openaq_deduped": readings.dedup_latest_readings(raw_readings, stable_key),
        "v_weather_deduped": forecasts.dedup_latest_forecasts(raw_forecasts),
        "v_station_latest_pollutants": readings.station_latest_pollutants(
            raw_readings, stations, required, stable_key
        ),
        "v_station_hourly_wide": readings.station_hourly_wide(raw_readings, required, stable_key),
        "v_station_hourly_combined": combined,
        "v_station_current_outlook": forecasts.station_current_outlook(
            raw_readings, raw_forecasts, stations, pollutants=required, stable_key=stable_key
        ),
        "v_station_dispersion_outlook": forecasts.station_dispersion_outlook(
            raw_readings, raw_forecasts, stations, reference_ts, stable_key
        ),
        "v_station_freshness": readings.station_freshness(
            raw_readings, stations, reference_ts, stable_key=stable_key
        ),
        "v_ingestion_overview": runs.ingestion_overview(run_log, reference_ts),
        "ingestion_freshness": runs.source_freshness(run_log, reference_ts),
        "station_freshness": dashboard.station_two_source_freshness(
            raw_readings, raw_forecasts, stations, reference_ts, required, stable_key=stable_key
        ),
        "hourly_combined": readings.unpivot_pollutants(combined, required),
        "daily_ingestion_stats": runs.daily_ingestion_stats(run_log, limit=None),
        "eligible_stations": catalogue.eligible_stations(stations, required),
    }


def register_views(spark: SparkSession, frames: dict[str, DataFrame]) -> None:
    """Make the views available to ``spark.sql``."""
    for name, frame in frames.items():
        if frame.sparkSession is not spark:
            raise ValueError(f"{name} belongs to another session")
        frame.createOrReplaceTempView(name)


def fetch(df: DataFrame, most: int | None = None) -> pd.DataFrame:
    """The rows of a page as a local frame; more than ``most`` of them are an error, never cut."""
    page = (df if most is None else df.limit(most + 1)).toPandas()
    if most is not None and len(page) > most:
        raise ValueError(f"the page has more than {most} rows")
    return page
