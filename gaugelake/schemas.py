"""Table and payload schemas: the data contract every operator works against.

Spark does not enforce ``nullable=False`` when it reads files, so the flag is
used here as the declaration that :func:`split_not_null` checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Pollutants the catalogue keeps, the ones a station must report
# to be polled, and the forecast variables, in the order the tables list them.
TARGET_POLLUTANTS = ("pm25", "pm10", "o3", "no2", "so2")
REQUIRED_POLLUTANTS = ("pm25", "pm10", "no2")
FORECAST_VARIABLES = (
    "temperature_2m",
    "relative_humidity_2m",
    "surface_pressure",
    "wind_speed_10m",
    "wind_direction_10m",
    "precipitation",
    "cloud_cover",
    "boundary_layer_height",
)
STANDARD_UNIT = "µg/m³"


def _table(*columns: tuple) -> StructType:
    return StructType([StructField(name, kind, not required) for name, kind, required in columns])


_S, _L, _D, _B, _T = StringType(), LongType(), DoubleType(), BooleanType(), TimestampType()

STATIONS = _table(
    ("station_id", _S, True),
    ("openaq_location_id", _L, True),
    ("station_name", _S, False),
    ("locality", _S, False),
    ("country_code", _S, False),
    ("country_name", _S, False),
    ("latitude", _D, False),
    ("longitude", _D, False),
    ("timezone", _S, False),
    ("is_mobile", _B, False),
    ("is_monitor", _B, False),
    ("provider_id", _L, False),
    ("provider_name", _S, False),
    ("owner_id", _L, False),
    ("owner_name", _S, False),
    ("datetime_first_utc", _T, False),
    ("datetime_last_utc", _T, False),
    ("pollutants_available", _S, False),
    ("sensor_count", _L, False),
    ("raw_json", _S, False),
    ("loaded_at", _T, False),
)

SENSORS = _table(
    ("station_id", _S, True),
    ("openaq_location_id", _L, True),
    ("openaq_sensor_id", _L, True),
    ("parameter_id", _L, False),
    ("parameter_name", _S, False),
    ("parameter_display_name", _S, False),
    ("parameter_units", _S, False),
    ("loaded_at", _T, False),
)

READINGS = _table(
    ("ingested_at", _T, True),
    ("run_id", _S, True),
    ("station_id", _S, True),
    ("openaq_location_id", _L, True),
    ("openaq_sensor_id", _L, True),
    ("pollutant", _S, True),
    ("value", _D, False),
    ("unit", _S, False),
    ("period_from_utc", _T, False),
    ("period_to_utc", _T, False),
    ("period_from_local", _S, False),
    ("period_label", _S, False),
    ("period_interval", _S, False),
    ("coverage_expected", _L, False),
    ("coverage_observed", _L, False),
    ("coverage_pct", _D, False),
    ("dedup_key", _S, True),
)

FORECASTS = _table(
    ("station_id", _S, True),
    ("run_id", _S, True),
    ("latitude", _D, True),
    ("longitude", _D, True),
    ("valid_time", _T, True),
    *((name, _D, False) for name in FORECAST_VARIABLES),
    ("ingested_at", _T, True),
    ("dedup_key", _S, True),
)

RUN_LOG = _table(
    ("run_id", _S, True),
    ("source", _S, True),
    ("status", _S, True),
    ("run_started_at", _T, True),
    ("run_finished_at", _T, True),
    ("duration_seconds", _D, False),
    ("records_written", _L, False),
    ("sensors_queried", _L, False),
    ("sensors_failed", _L, False),
    ("stations_polled", _L, False),
    ("stations_failed", _L, False),
    ("api_calls", _L, False),
    ("api_errors", _L, False),
    ("window_start_utc", _T, False),
    ("window_end_utc", _T, False),
    ("error_message", _S, False),
    ("failed_sensor_ids", _S, False),
    ("failed_station_ids", _S, False),
    ("ingested_at", _T, True),
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


_MOMENT = _struct(utc=_S, local=_S)
_ENTITY = _struct(id=_L, name=_S)

READING_ITEM = _struct(
    period=_struct(datetimeFrom=_MOMENT, datetimeTo=_MOMENT, label=_S, interval=_S),
    coverage=_struct(expectedCount=_L, observedCount=_L, percentComplete=_D),
    value=_D,
)
READING_PAGE = _struct(results=ArrayType(READING_ITEM))

FORECAST_ITEM = _struct(
    latitude=_D,
    longitude=_D,
    hourly=_struct(time=ArrayType(_S), **{name: ArrayType(_D) for name in FORECAST_VARIABLES}),
)
FORECAST_BATCH = ArrayType(FORECAST_ITEM)

CATALOGUE_ITEM = _struct(
    id=_L,
    name=_S,
    locality=_S,
    isMobile=_B,
    isMonitor=_B,
    coordinates=_struct(latitude=_D, longitude=_D),
    country=_struct(code=_S, name=_S),
    timezone=_S,
    provider=_ENTITY,
    owner=_ENTITY,
    datetimeFirst=_MOMENT,
    datetimeLast=_MOMENT,
    sensors=ArrayType(_struct(id=_L, parameter=_struct(id=_L, name=_S, displayName=_S, units=_S))),
)
# Each element is kept as its own JSON text, so that a row can carry its source object.
CATALOGUE_PAGE = _struct(results=ArrayType(_S))

STATION_COLUMNS = ("station_name", "locality", "country_code", "latitude", "longitude")


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: its columns, order and types; absent columns are NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def required_columns(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]


def any_null(columns: list[str]) -> Column:
    missing = F.lit(False)
    for name in columns:
        missing = missing | F.col(name).isNull()
    return missing


def enforce_not_null(df: DataFrame, schema: StructType) -> DataFrame:
    """The same rows; the job fails on a row that lacks a required column."""

    def required(name: str) -> Column:
        kind = schema[name].dataType
        return F.coalesce(F.col(name), F.raise_error(F.lit(f"{name} is required")).cast(kind))

    return df.withColumns({name: required(name) for name in required_columns(schema)})


def split_not_null(df: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)`` rows under the schema's required columns. Both stay lazy."""
    missing = any_null(required_columns(schema))
    return df.filter(~missing), df.filter(missing)
