"""Operators over hourly forecasts (one row per issued version of a station-hour)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugelake.functions import scores
from gaugelake.functions.clock import Moment, hour_slot, moment_like, shift
from gaugelake.operators.latest import dedup_latest
from gaugelake.operators.readings import (
    station_hour_values,
    station_latest_pollutants,
    station_time_series,
    unpivot_pollutants,
)
from gaugelake.schemas import FORECAST_VARIABLES, REQUIRED_POLLUTANTS

# The hour leads the key: it is the cheaper sort prefix.
_KEYS = ("valid_time", "station_id")

# Version order. A narrow caller takes a prefix, so every caller picks the same row.
_VERSION_ORDER = ("ingested_at", "run_id", *FORECAST_VARIABLES, "latitude", "longitude")


def dedup_latest_forecasts(forecasts: DataFrame) -> DataFrame:
    """Newest ``ingested_at`` per station and valid hour; every column is kept."""
    rest = [c for c in forecasts.columns if c not in {*_VERSION_ORDER, *_KEYS}]
    return dedup_latest(forecasts, _KEYS, _VERSION_ORDER[:1], [*_VERSION_ORDER[1:], *rest])


def _current(forecasts: DataFrame, needed: Sequence[str]) -> DataFrame:
    """Deduplicated forecasts with the key and the ``needed`` columns only."""
    depth = 1 + max(_VERSION_ORDER.index(c) for c in needed)
    order = _VERSION_ORDER[:depth]
    narrow = forecasts.select(*_KEYS, *order)
    return dedup_latest(narrow, _KEYS, order[:1], order[1:]).select("station_id", "valid_time", *needed)


def station_hourly_combined(
    readings: DataFrame,
    forecasts: DataFrame,
    pollutants: Sequence[str] = REQUIRED_POLLUTANTS,
    stable_key: bool = False,
) -> DataFrame:
    """Pollutants per station, location and hour with the forecast of the same station-hour.

    With a stable key both sides arrive laid out by hour and station, so the join itself
    shuffles nothing.
    Two locations of a station give two rows, although the location is not an output.
    """
    weather_columns = [c for c in FORECAST_VARIABLES if c != "surface_pressure"]
    weather = _current(forecasts, weather_columns).withColumnRenamed("valid_time", "hour_utc")
    values = station_hour_values(readings, pollutants, stable_key)
    return values.join(weather, ["hour_utc", "station_id"], "left").select(
        "station_id", "hour_utc", *[f"{p}_value" for p in pollutants], *weather_columns
    )


def station_pollutant_series(
    readings: DataFrame,
    forecasts: DataFrame,
    station_id: str | None,
    pollutant: str,
    days: int,
    reference_ts: Moment = None,
    stable_key: bool = False,
) -> DataFrame:
    """:func:`station_time_series` from the raw tables.

    With a stable key all versions of a reading are of one station and pollutant, so both
    filters are put before the dedup and reach the scan.
    """
    pollutants = [pollutant] if stable_key else list(REQUIRED_POLLUTANTS)
    if stable_key:
        readings = readings.filter(F.col("pollutant") == pollutant)
        if station_id is not None:
            readings = readings.filter(F.col("station_id") == station_id)
            forecasts = forecasts.filter(F.col("station_id") == station_id)
    wide = station_hourly_combined(readings, forecasts, pollutants, stable_key)
    return station_time_series(unpivot_pollutants(wide, pollutants), station_id, pollutant, days, reference_ts)


def latest_issue_times(forecasts: DataFrame) -> DataFrame:
    """Newest ``ingested_at`` per station.

    The newest issue of a station is the newest of one of its hours, so it survives
    dedup and need not wait for it.
    """
    return forecasts.groupBy("station_id").agg(F.max("ingested_at").alias("latest_weather_ingested_at"))


def forecast_window(forecasts: DataFrame, horizon_hours: int = 3) -> DataFrame:
    """Forecast aggregates over ``(t, t + horizon]``, t being the station's newest issue time.

    A station without a forecast in the window stays, with NULL aggregates and 0 hours.

    The window is spelled out as clock hours, so the match is an equality join on
    (station, hour): the few matching rows are picked out of the raw table first and only
    those are deduplicated. A station with very many rows is spread over its hours.

    The scan is bounded by the oldest and the newest issue time of any station, as scalar
    subqueries of the plan: they are computed whenever the frame runs, so a view over it
    follows the table. How the issue times are joined is left to adaptive execution.
    """
    # A station id is never NULL; saying so lets both uses of the aggregate share its shuffle.
    issued = latest_issue_times(forecasts.filter(F.col("station_id").isNotNull()))
    start = F.col("latest_weather_ingested_at")
    slots = issued.select(
        "station_id",
        "latest_weather_ingested_at",
        F.explode(F.sequence(hour_slot(start), hour_slot(shift(start, "HOUR", horizon_hours)))).alias("slot"),
    )
    columns = (
        "temperature_2m",
        "relative_humidity_2m",
        "wind_speed_10m",
        "precipitation",
        "cloud_cover",
        "boundary_layer_height",
    )
    order = [c for c in _VERSION_ORDER if c in {"ingested_at", "run_id", "surface_pressure", *columns}]
    raw = forecasts.select(*_KEYS, *order, hour_slot(F.col("valid_time")).alias("slot"))
    oldest = issued.agg(F.min(start)).scalar()
    newest_issue = issued.agg(F.max(start)).scalar()
    valid = F.col("valid_time")
    raw = raw.filter((valid > oldest) & (valid <= shift(newest_issue, "HOUR", horizon_hours)))
    hits = (
        raw.join(slots, ["station_id", "slot"])
        .filter(
            (start < F.col("valid_time")) & (F.col("valid_time") <= shift(start, "HOUR", horizon_hours))
        )
        .select(*_KEYS, *order)
    )
    totals = (
        dedup_latest(hits, _KEYS, order[:1], order[1:])
        .groupBy("station_id")
        .agg(
            F.avg("temperature_2m").alias("avg_temperature_2m"),
            F.avg("relative_humidity_2m").alias("avg_relative_humidity_2m"),
            F.avg("cloud_cover").alias("avg_cloud_cover"),
            F.avg("boundary_layer_height").alias("avg_boundary_layer_height"),
            F.sum("precipitation").alias("total_precipitation"),
            F.max("wind_speed_10m").alias("max_wind_speed_10m"),
            F.count("valid_time").alias("forecast_hours_count"),
        )
    )
    return issued.join(totals, "station_id", "left").withColumn(
        "forecast_hours_count", F.coalesce("forecast_hours_count", F.lit(0).cast("bigint"))
    )


def station_current_outlook(
    readings: DataFrame,
    forecasts: DataFrame,
    stations: DataFrame,
    horizon_hours: int = 3,
    pollutants: Sequence[str] = REQUIRED_POLLUTANTS,
    stable_key: bool = False,
) -> DataFrame:
    """Newest pollutants per station with the forecast of the next hours.

    Only stations with readings appear; those without forecasts show 0 forecast hours.
    """
    now = station_latest_pollutants(readings, None, pollutants, stable_key)
    outlook = forecast_window(forecasts, horizon_hours)
    names = ("station_name", "locality", "country_code", "latitude", "longitude")
    return (
        now.join(outlook, "station_id", "left")
        .join(stations.select("station_id", *names), "station_id", "left")
        .select(
            "station_id",
            *[f"{p}_value" for p in pollutants],
            "latest_reading_time",
            "latest_weather_ingested_at",
            "avg_temperature_2m",
            "avg_relative_humidity_2m",
            "avg_cloud_cover",
            "avg_boundary_layer_height",
            "total_precipitation",
            "max_wind_speed_10m",
            *names,
            F.coalesce("forecast_hours_count", F.lit(0).cast("bigint")).alias("forecast_hours_count"),
        )
    )


def dispersion_scores(forecasts: DataFrame, reference_ts: Moment = None) -> DataFrame:
    """Newest forecast of each future station-hour with its dispersion score and category.

    The reference hour itself is not future. The filter is on the dedup key, so it
    reaches the scan.
    """
    reference = moment_like(forecasts, "valid_time", reference_ts)
    future = forecasts.filter(F.col("valid_time") > reference)
    scored = _current(future, ("latitude", "longitude", *FORECAST_VARIABLES)).withColumns(
        {
            "blh_score": scores.clamp_score(F.col("boundary_layer_height"), scores.FULL_BOUNDARY_LAYER_M),
            "wind_score": scores.clamp_score(F.col("wind_speed_10m"), scores.FULL_WIND_SPEED),
            "precip_score": scores.clamp_score(F.col("precipitation"), scores.FULL_PRECIPITATION_MM),
        }
    )
    raw_score = scores.dispersion(F.col("blh_score"), F.col("wind_score"), F.col("precip_score"))
    return scored.withColumns(
        {
            "dispersion_score": scores.round_half_up(raw_score, 2),
            "outlook_category": scores.category(raw_score),
        }
    )


def station_dispersion_outlook(
    readings: DataFrame,
    forecasts: DataFrame,
    stations: DataFrame,
    reference_ts: Moment = None,
    stable_key: bool = False,
) -> DataFrame:
    """Scored future forecast hours with the station's newest PM2.5 and names.

    PM2.5 and names are first put together per station, which is small work, so the
    large forecast side meets a single join: broadcast when the measured size allows,
    else one shuffle join whose hot stations AQE can split.
    """
    pm = station_latest_pollutants(readings, None, ("pm25",), stable_key).select(
        "station_id",
        F.col("pm25_value").alias("latest_pm25"),
        "pm25_unit",
        F.col("pm25_time").alias("latest_pm25_time"),
    )
    names = ("station_name", "locality", "country_code")
    about = pm.join(stations.select("station_id", *names), "station_id", "full")
    return dispersion_scores(forecasts, reference_ts).join(about, "station_id", "left").select(
        "station_id",
        "valid_time",
        "latitude",
        "longitude",
        *FORECAST_VARIABLES,
        "blh_score",
        "wind_score",
        "precip_score",
        "dispersion_score",
        "outlook_category",
        "latest_pm25",
        "pm25_unit",
        "latest_pm25_time",
        *names,
    )


def station_worst_outlook(dispersion_outlook: DataFrame) -> DataFrame:
    """Worst category of each station over its future hours, with its newest PM2.5."""
    worst = F.min(scores.severity_rank(F.col("outlook_category")))
    return (
        dispersion_outlook.groupBy("station_id")
        .agg(worst.alias("worst"), F.max("latest_pm25").alias("latest_pm25"))
        .select(
            "station_id",
            scores.category_of_rank(F.col("worst")).alias("worst_category"),
            "latest_pm25",
        )
    )
