"""Operators over hourly pollutant readings (one row per delivered version of a sensor-hour).

``stable_key=True`` declares what the payload flattener guarantees: ``dedup_key``
names one sensor and one hour, hence also one station and one pollutant. Filters
on those columns then reach the scan, and operators that only need a newest value
skip the dedup shuffle, because the newest version per key survives it anyway.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugelake.functions.clock import Moment, moment_like, whole_hours
from gaugelake.operators.latest import dedup_latest, newest
from gaugelake.schemas import REQUIRED_POLLUTANTS, STATION_COLUMNS

# Columns one dedup_key determines. The hour leads: it is the cheapest sort prefix,
# and grouping by (hour, station) afterwards finds its rows already sorted.
_DETERMINED = ("period_from_utc", "station_id", "pollutant", "dedup_key")

# Version order. A narrow caller takes a prefix, so every caller picks the same row.
_VERSION_ORDER = (
    "ingested_at",
    "run_id",
    "value",
    "unit",
    "period_from_utc",
    "pollutant",
    "station_id",
    "openaq_location_id",
    "openaq_sensor_id",
)


def dedup_latest_readings(readings: DataFrame, stable_key: bool = False) -> DataFrame:
    """Newest ``ingested_at`` per ``dedup_key``; every column is kept."""
    keys = _DETERMINED if stable_key else ("dedup_key",)
    lead = [c for c in _VERSION_ORDER if c not in keys]
    rest = [c for c in readings.columns if c not in {*lead, *keys}]
    return dedup_latest(readings, keys, lead[:1], [*lead[1:], *rest])


def _current(readings: DataFrame, needed: Sequence[str], stable_key: bool) -> DataFrame:
    """Deduplicated readings with the ``needed`` columns only."""
    keys = _DETERMINED if stable_key else ("dedup_key",)
    depth = 1 + max((_VERSION_ORDER.index(c) for c in needed if c not in keys), default=0)
    order = [c for c in _VERSION_ORDER[:depth] if c not in keys]
    narrow = readings.select(*dict.fromkeys([*keys, *order, *needed]))
    return dedup_latest(narrow, keys, order[:1], order[1:]).select(*needed)


def tracked(readings: DataFrame, pollutants: Sequence[str]) -> DataFrame:
    return readings.filter(F.col("pollutant").isin(*pollutants))


def _max_of(pollutant: str, column: str) -> Column:
    return F.max(F.when(F.col("pollutant") == pollutant, F.col(column)))


def station_latest_pollutants(
    readings: DataFrame,
    stations: DataFrame | None,
    pollutants: Sequence[str] = REQUIRED_POLLUTANTS,
    stable_key: bool = False,
) -> DataFrame:
    """Newest reading of each pollutant per station, one row per station.

    The newest reading is the latest hour, then the latest delivery. With several
    sensors of one pollutant in that hour and delivery, the highest sensor id wins.
    ``stations=None`` leaves the station columns out.
    """
    order = ("period_from_utc", "ingested_at", "openaq_sensor_id", "run_id", "value", "unit")
    needed = ("station_id", "pollutant", *order)
    source = readings.select(*needed) if stable_key else _current(readings, needed, False)
    per_station = (
        tracked(source, pollutants)
        .groupBy("station_id")
        .agg(*[newest(order, F.col("pollutant") == p).alias(p) for p in pollutants])
    )
    columns = []
    for p in pollutants:
        columns += [
            F.col(f"{p}.value").alias(f"{p}_value"),
            F.col(f"{p}.unit").alias(f"{p}_unit"),
            F.col(f"{p}.period_from_utc").alias(f"{p}_time"),
        ]
    times = [F.col(f"{p}.period_from_utc") for p in pollutants]
    latest_time = F.greatest(*times) if len(times) > 1 else times[0]
    wide = per_station.select("station_id", *columns, latest_time.alias("latest_reading_time"))
    if stations is None:
        return wide
    return wide.join(stations.select("station_id", *STATION_COLUMNS), "station_id", "left")


def station_hourly_wide(
    readings: DataFrame,
    pollutants: Sequence[str] = REQUIRED_POLLUTANTS,
    stable_key: bool = False,
) -> DataFrame:
    """Value and unit of each pollutant per station and hour; absent pollutants are NULL."""
    needed = ("station_id", "period_from_utc", "pollutant", "value", "unit", "ingested_at")
    current = tracked(_current(readings, needed, stable_key), pollutants)
    columns = []
    for p in pollutants:
        columns += [_max_of(p, "value").alias(f"{p}_value"), _max_of(p, "unit").alias(f"{p}_unit")]
    wide = current.groupBy(F.col("period_from_utc").alias("hour_utc"), "station_id").agg(
        *columns, F.max("ingested_at").alias("latest_ingested_at")
    )
    names = [f"{p}_{part}" for p in pollutants for part in ("value", "unit")]
    return wide.select("station_id", "hour_utc", *names, "latest_ingested_at")


def station_hour_values(
    readings: DataFrame,
    pollutants: Sequence[str] = REQUIRED_POLLUTANTS,
    stable_key: bool = False,
) -> DataFrame:
    """Pollutant values per station, location and hour.

    With a stable key, dedup leaves one row per sensor of a station-hour. Those few rows
    are moved to their station-hour once, then grouped and joined in place. With any other
    key a station-hour may hold many rows, so they are combined before they move.
    """
    needed = ("station_id", "openaq_location_id", "period_from_utc", "pollutant", "value")
    current = tracked(_current(readings, needed, stable_key), pollutants).withColumnRenamed(
        "period_from_utc", "hour_utc"
    )
    if stable_key:
        current = current.repartition("hour_utc", "station_id")
    return current.groupBy("station_id", "openaq_location_id", "hour_utc").agg(
        *[_max_of(p, "value").alias(f"{p}_value") for p in pollutants]
    )


def newest_reading_times(readings: DataFrame, stable_key: bool = False) -> DataFrame:
    """Newest data hour and newest delivery per station."""
    needed = ("station_id", "period_from_utc", "ingested_at")
    source = readings if stable_key else _current(readings, needed, False)
    return source.groupBy("station_id").agg(
        F.max("period_from_utc").alias("latest_hour_utc"),
        F.max("ingested_at").alias("latest_ingested_at"),
    )


def station_freshness(
    readings: DataFrame,
    stations: DataFrame,
    reference_ts: Moment = None,
    data_stale_hours: int = 2,
    ingestion_stale_hours: int = 4,
    stable_key: bool = False,
) -> DataFrame:
    """Whole hours since the newest data hour and the newest delivery, with stale flags."""
    now = moment_like(readings, "period_from_utc", reference_ts)
    seen = moment_like(readings, "ingested_at", reference_ts)
    aged = newest_reading_times(readings, stable_key).select(
        "station_id",
        "latest_hour_utc",
        "latest_ingested_at",
        whole_hours(now, F.col("latest_hour_utc")).alias("hours_since_data"),
        whole_hours(seen, F.col("latest_ingested_at")).alias("hours_since_ingestion"),
    )
    joined = aged.join(stations.select("station_id", *STATION_COLUMNS), "station_id", "left")
    return joined.select(
        *aged.columns,
        *STATION_COLUMNS,
        F.coalesce(F.col("hours_since_data") > data_stale_hours, F.lit(False)).alias("is_data_stale"),
        F.coalesce(F.col("hours_since_ingestion") > ingestion_stale_hours, F.lit(False)).alias(
            "is_ingestion_stale"
        ),
    )


def unpivot_pollutants(wide: DataFrame, pollutants: Sequence[str] = REQUIRED_POLLUTANTS) -> DataFrame:
    """Long form of a wide frame: one row per present ``<pollutant>_value``."""
    values = [f"{p}_value" for p in pollutants]
    parts = {part for p in pollutants for part in (f"{p}_value", f"{p}_unit")}
    ids = [c for c in wide.columns if c not in parts]
    named = wide.select(*ids, *[F.col(v).alias(p) for v, p in zip(values, pollutants)])
    return named.unpivot(ids, list(pollutants), "pollutant", "pollutant_value").filter(
        F.col("pollutant_value").isNotNull()
    )


def station_pollutants(readings_long: DataFrame, station_id: str | None = None) -> DataFrame:
    """Pollutants of one station, in order; of every station if none is named, unordered."""
    pairs = readings_long.select("station_id", "pollutant")
    if station_id is None:
        return pairs.distinct()
    return pairs.filter(F.col("station_id") == station_id).distinct().orderBy("pollutant")


def station_time_series(
    combined_long: DataFrame,
    station_id: str | None,
    pollutant: str,
    days: int,
    reference_ts: Moment = None,
) -> DataFrame:
    """One pollutant with its weather over the last ``days`` days, in time order.

    ``station_id=None`` gives the series of every station, unordered.
    """
    since = F.timestamp_add("DAY", F.lit(-days), moment_like(combined_long, "hour_utc", reference_ts))
    series = combined_long.filter((F.col("pollutant") == pollutant) & (F.col("hour_utc") >= since)).select(
        "station_id",
        "hour_utc",
        "pollutant_value",
        "temperature_2m",
        "wind_speed_10m",
        "boundary_layer_height",
    )
    if station_id is None:
        return series
    return series.filter(F.col("station_id") == station_id).orderBy("hour_utc")
