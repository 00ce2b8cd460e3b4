"""Station catalogue: selection, row building, summary, and the queries that read it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugelake.functions.clock import Moment, moment, parse_utc
from gaugelake.functions.labels import has_all_tokens
from gaugelake.operators.latest import dedup_latest
from gaugelake.schemas import (
    REQUIRED_POLLUTANTS,
    SENSORS,
    STANDARD_UNIT,
    STATIONS,
    TARGET_POLLUTANTS,
    conform,
)

# The bounding box of the development subset, degrees.
SUBSET_BOX = {"latitude": (43.5, 46.0), "longitude": (4.0, 5.5)}

# Version order of metadata rows. A narrow caller takes a prefix, so every caller picks the same row.
_VERSION_ORDER = (
    "loaded_at",
    "datetime_last_utc",
    "station_name",
    "pollutants_available",
    "latitude",
    "longitude",
)


def latest_station_metadata(stations: DataFrame) -> DataFrame:
    """Newest metadata row per station, by load time and then by the last data time."""
    order = [c for c in _VERSION_ORDER if c in stations.columns]
    rest = [c for c in stations.columns if c not in {*order, "station_id"}]
    return dedup_latest(stations, ["station_id"], order[:2], [*order[2:], *rest])


def eligible_stations(stations: DataFrame, required: Sequence[str] = REQUIRED_POLLUTANTS) -> DataFrame:
    """Stations whose newest metadata lists every required pollutant, by name."""
    narrow = stations.select(
        "station_id", "station_name", "pollutants_available", "loaded_at", "datetime_last_utc"
    )
    return (
        latest_station_metadata(narrow)
        .filter(has_all_tokens(F.col("pollutants_available"), required))
        .select("station_id", "station_name")
        .orderBy("station_name", "station_id")
    )


def sensor_worklist(
    sensors: DataFrame,
    required: Sequence[str] = REQUIRED_POLLUTANTS,
    station_ids: Sequence[str] | DataFrame | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Sensors to poll: those of stations that have all required parameters, in order.

    ``station_ids`` narrows them to some stations; a long list is better given as a frame
    with a ``station_id`` column. ``limit`` keeps the first sensors in that order.
    """
    wanted = sensors.filter(F.col("parameter_name").isin(*required))
    has_all = F.lit(True)
    for name in dict.fromkeys(required):
        has_all = has_all & F.bool_or(F.col("parameter_name") == name)
    complete = wanted.groupBy("station_id").agg(has_all.alias("complete")).filter("complete")
    work = wanted.join(complete, "station_id", "left_semi")
    if isinstance(station_ids, DataFrame):
        work = work.join(station_ids.select("station_id"), "station_id", "left_semi")
    elif station_ids:
        work = work.filter(F.col("station_id").isin(*station_ids))
    work = work.select(
        "station_id",
        "openaq_location_id",
        "openaq_sensor_id",
        F.col("parameter_name").alias("pollutant"),
        F.col("parameter_units").alias("unit"),
    ).orderBy("station_id", "pollutant", "openaq_sensor_id")
    return work if limit is None else work.limit(limit)


def station_locations(stations: DataFrame) -> DataFrame:
    """Stations with both coordinates."""
    return (
        stations.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
        .select("station_id", "latitude", "longitude")
        .orderBy("station_id")
    )


def _target_names(targets: Sequence[str]) -> Column:
    """Distinct target pollutants of a catalogue item, sorted."""
    names = F.transform(F.col("sensors"), lambda s: s["parameter"]["name"])
    return F.array_sort(F.array_distinct(F.filter(names, lambda n: n.isin(*targets))))


def _skip_reason(targets: Sequence[str]) -> Column:
    """First failed condition, NULL for a kept item.

    A missing ``isMobile`` counts as mobile, but an explicit null as not mobile. Both
    parse to NULL, so the key is looked up in the source text, for those items only.
    """
    named = F.array_contains(F.json_object_keys("raw_json"), "isMobile")
    mobile = F.when(F.col("isMobile").isNull(), ~F.coalesce(named, F.lit(False))).otherwise(F.col("isMobile"))
    located = F.col("coordinates.latitude").isNotNull() & F.col("coordinates.longitude").isNotNull()
    return (
        F.when(mobile, "mobile")
        .when(~F.coalesce(F.col("isMonitor"), F.lit(False)), "not_monitor")
        .when(~located, "no_coords")
        .when(F.coalesce(F.size(_target_names(targets)), F.lit(0)) == 0, "no_target_pollutant")
    )


def select_stations(
    catalogue: DataFrame, targets: Sequence[str] = TARGET_POLLUTANTS
) -> tuple[DataFrame, DataFrame]:
    """``(kept, reason_counts)``: stationary monitors with coordinates and a target pollutant."""
    judged = catalogue.withColumn("skip_reason", _skip_reason(targets))
    kept = judged.filter(F.col("skip_reason").isNull()).drop("skip_reason")
    counts = (
        judged.filter(F.col("skip_reason").isNotNull())
        .groupBy("skip_reason")
        .agg(F.count(F.lit(1)).alias("stations"))
    )
    return kept, counts


def _station_id(prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.col("id").cast("string"))


def build_station_rows(
    kept: DataFrame,
    loaded_at: Moment = None,
    targets: Sequence[str] = TARGET_POLLUTANTS,
    id_prefix: str = "openaq:",
) -> DataFrame:
    """Catalogue items as station rows; absent nested objects give NULLs."""
    row = kept.select(
        _station_id(id_prefix).alias("station_id"),
        F.col("id").alias("openaq_location_id"),
        F.col("name").alias("station_name"),
        "locality",
        F.col("country.code").alias("country_code"),
        F.col("country.name").alias("country_name"),
        "coordinates.latitude",
        "coordinates.longitude",
        "timezone",
        F.col("isMobile").alias("is_mobile"),
        F.col("isMonitor").alias("is_monitor"),
        F.col("provider.id").alias("provider_id"),
        F.col("provider.name").alias("provider_name"),
        F.col("owner.id").alias("owner_id"),
        F.col("owner.name").alias("owner_name"),
        parse_utc(F.col("datetimeFirst.utc")).alias("datetime_first_utc"),
        parse_utc(F.col("datetimeLast.utc")).alias("datetime_last_utc"),
        F.coalesce(F.array_join(_target_names(targets), ","), F.lit("")).alias("pollutants_available"),
        F.coalesce(F.size("sensors"), F.lit(0)).alias("sensor_count"),
        "raw_json",
        moment(loaded_at, STATIONS["loaded_at"].dataType).alias("loaded_at"),
    )
    return conform(row, STATIONS)


def build_sensor_rows(
    kept: DataFrame,
    loaded_at: Moment = None,
    targets: Sequence[str] = TARGET_POLLUTANTS,
    id_prefix: str = "openaq:",
) -> DataFrame:
    """One row per target sensor of the catalogue items."""
    row = (
        kept.select(_station_id(id_prefix).alias("station_id"), "id", F.explode("sensors").alias("sensor"))
        .filter(F.col("sensor.parameter.name").isin(*targets))
        .select(
            "station_id",
            F.col("id").alias("openaq_location_id"),
            F.col("sensor.id").alias("openaq_sensor_id"),
            F.col("sensor.parameter.id").alias("parameter_id"),
            F.col("sensor.parameter.name").alias("parameter_name"),
            F.col("sensor.parameter.displayName").alias("parameter_display_name"),
            F.col("sensor.parameter.units").alias("parameter_units"),
            moment(loaded_at, SENSORS["loaded_at"].dataType).alias("loaded_at"),
        )
    )
    return conform(row, SENSORS)


def _in_box(box: dict[str, tuple[float, float]]) -> Column:
    inside = F.lit(True)
    for column, (low, high) in box.items():
        inside = inside & F.col(column).between(low, high)
    return F.coalesce(inside, F.lit(False))


def subset_stations(stations: DataFrame, box: dict[str, tuple[float, float]] = SUBSET_BOX) -> DataFrame:
    """Stations inside the bounding box, edges included."""
    return stations.filter(_in_box(box)).select("station_id", "station_name", "pollutants_available")


def catalogue_summary(
    stations: DataFrame,
    sensors: DataFrame,
    targets: Sequence[str] = TARGET_POLLUTANTS,
    box: dict[str, tuple[float, float]] = SUBSET_BOX,
    unit: str = STANDARD_UNIT,
) -> DataFrame:
    """Figures of the catalogue as rows ``metric, item, stations_or_sensors, needs_conversion``.

    Stations: total, per target pollutant (zero where none has it), with all targets,
    with four or more, inside the box. Sensors: total, and per pollutant whether any
    unit differs from the standard one.
    """
    tags = F.split("pollutants_available", ",")
    figures = {
        ("stations", "total"): F.count(F.lit(1)),
        **{("stations_with", p): F.count_if(F.array_contains(tags, p)) for p in sorted(targets)},
        ("stations", "all_pollutants"): F.count_if(F.size(tags) == len(set(targets))),
        ("stations", "four_or_more"): F.count_if(F.size(tags) >= 4),
        ("stations", "in_box"): F.count_if(_in_box(box)),
    }
    totals = stations.agg(*[agg.alias(f"f{i}") for i, agg in enumerate(figures.values())])
    rows = F.array(
        *[
            F.struct(
                F.lit(metric).alias("metric"),
                F.lit(item).alias("item"),
                F.col(f"f{i}").alias("stations_or_sensors"),
                F.lit(None).cast("boolean").alias("needs_conversion"),
            )
            for i, (metric, item) in enumerate(figures)
        ]
    )
    by_unit = sensors.groupBy("parameter_name").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.col("parameter_units").eqNullSafe(unit)).alias("standard")
    )
    per_pollutant = by_unit.select(
        F.lit("sensors_of").alias("metric"),
        F.col("parameter_name").alias("item"),
        F.col("n").alias("stations_or_sensors"),
        (~F.col("standard")).alias("needs_conversion"),
    )
    total_sensors = sensors.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("sensors").alias("metric"),
        F.lit("total").alias("item"),
        F.col("n").alias("stations_or_sensors"),
        F.lit(None).cast("boolean").alias("needs_conversion"),
    )
    return totals.select(F.inline(rows)).unionByName(total_sensors).unionByName(per_pollutant)


def units_by_pollutant(sensors: DataFrame) -> DataFrame:
    """The distinct units each parameter is reported in."""
    return sensors.select("parameter_name", "parameter_units").distinct().orderBy(
        "parameter_name", "parameter_units"
    )
