"""Station map and detail: the age of both sources per station, with labels and flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugelake.functions.clock import Moment, age_hours, moment_like, utc_label
from gaugelake.functions.labels import age_label, has_all_tokens, newest_source, severity_class
from gaugelake.operators.catalogue import latest_station_metadata
from gaugelake.operators.forecasts import latest_issue_times
from gaugelake.operators.readings import newest_reading_times
from gaugelake.schemas import REQUIRED_POLLUTANTS


def station_two_source_freshness(
    readings: DataFrame,
    forecasts: DataFrame,
    stations: DataFrame,
    reference_ts: Moment = None,
    required: Sequence[str] = REQUIRED_POLLUTANTS,
    readings_stale_hours: float = 2.0,
    forecasts_stale_hours: float = 12.0,
    stable_key: bool = False,
) -> DataFrame:
    """Age of the newest reading hour and forecast issue of each located, eligible station.

    A source without data is not flagged stale; its age is NULL and its label says so.
    """
    metadata = stations.select(
        "station_id",
        "station_name",
        "latitude",
        "longitude",
        "pollutants_available",
        "loaded_at",
        "datetime_last_utc",
    )
    located = (
        latest_station_metadata(metadata)
        .filter(F.col("latitude").isNotNull() & has_all_tokens(F.col("pollutants_available"), required))
        .select("station_id", "station_name", "latitude", "longitude")
    )
    read = newest_reading_times(readings, stable_key).select(
        "station_id", F.col("latest_hour_utc").alias("last_openaq_utc")
    )
    issued = latest_issue_times(forecasts).withColumnRenamed("latest_weather_ingested_at", "last_weather_utc")
    now_read = moment_like(readings, "period_from_utc", reference_ts)
    now_issued = moment_like(forecasts, "ingested_at", reference_ts)
    aged = (
        located.join(read, "station_id", "left")
        .join(issued, "station_id", "left")
        .withColumns(
            {
                "openaq_age_hours": age_hours(now_read, F.col("last_openaq_utc")),
                "weather_age_hours": age_hours(now_issued, F.col("last_weather_utc")),
            }
        )
        .withColumns(
            {
                "openaq_stale": F.coalesce(
                    F.col("openaq_age_hours") > readings_stale_hours, F.lit(False)
                ),
                "weather_stale": F.coalesce(
                    F.col("weather_age_hours") > forecasts_stale_hours, F.lit(False)
                ),
                "last_data_update_utc": F.greatest("last_openaq_utc", "last_weather_utc"),
                "last_data_update_age_hours": F.least("openaq_age_hours", "weather_age_hours"),
            }
        )
        .withColumn("overall_stale", F.col("openaq_stale") | F.col("weather_stale"))
    )
    return aged.select(
        "station_id",
        "station_name",
        "latitude",
        "longitude",
        "openaq_age_hours",
        "weather_age_hours",
        "openaq_stale",
        "weather_stale",
        "overall_stale",
        "last_openaq_utc",
        "last_weather_utc",
        "last_data_update_utc",
        "last_data_update_age_hours",
        age_label(F.col("last_data_update_age_hours")).alias("last_data_update_label"),
        newest_source(F.col("openaq_age_hours"), F.col("weather_age_hours")).alias("last_data_update_source"),
        utc_label(F.col("last_data_update_utc")).alias("last_data_update_utc_label"),
        severity_class(F.col("openaq_stale"), F.col("weather_stale"), F.col("overall_stale")).alias(
            "severity_class"
        ),
    )


def station_detail(freshness: DataFrame) -> DataFrame:
    """Detail table, oldest readings first, stations without readings last."""
    return freshness.select(
        "station_id",
        "station_name",
        "openaq_age_hours",
        "weather_age_hours",
        "openaq_stale",
        "weather_stale",
    ).orderBy(F.desc_nulls_last("openaq_age_hours"), "station_id")


def map_center(freshness: DataFrame) -> DataFrame:
    """Mean position of the stations shown."""
    return freshness.agg(F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"))
