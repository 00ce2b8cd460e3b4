"""Landed JSON payloads to typed rows. Everything here is narrow except the sensor lookup.

Time, run and window arguments are either values for the whole frame or columns of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from gaugelake.functions.clock import Moment, moment, parse_utc
from gaugelake.schemas import (
    CATALOGUE_ITEM,
    CATALOGUE_PAGE,
    FORECAST_BATCH,
    FORECAST_VARIABLES,
    FORECASTS,
    READING_PAGE,
    READINGS,
    conform,
)

_BROKEN = "_corrupt_record"
_INSTANT = TimestampType()

# A landed request: what was asked for, its JSON answer, and the run it belongs to.
LANDED_READINGS = "openaq_sensor_id bigint, payload string, ingested_at timestamp, run_id string, window_end timestamp"
LANDED_FORECASTS = (
    "payload string, stations array<struct<station_id:string,latitude:double,longitude:double>>, "
    "ingested_at timestamp, run_id string"
)
# Requests in a landed file at most.
LANDED_ROWS = 50_000


def _text(value: str | Column) -> Column:
    return F.lit(value) if isinstance(value, str) else value


def _reading_page(payload: Column) -> Column:
    with_flag = StructType([*READING_PAGE.fields, StructField(_BROKEN, StringType())])
    return F.from_json(payload, with_flag, {"columnNameOfCorruptRecord": _BROKEN})


def reading_outcomes(payloads: DataFrame, run_id: str | Column, answered: bool = False) -> DataFrame:
    """One row per request: an unreadable or missing answer is a failure. ``answered``: there is known to be none."""
    page = _reading_page(F.col("payload"))
    ok = F.lit(True) if answered else F.col("payload").isNotNull() & page[_BROKEN].isNull()
    return payloads.select(_text(run_id).alias("run_id"), "openaq_sensor_id", ok.alias("ok"))


def _judged_readings(
    payloads: DataFrame,
    ingested_at: Moment,
    run_id: str | Column,
    window_end: Moment,
    enforce_complete_hours: bool,
    unread: Observation | None,
) -> DataFrame:
    """Every reading of the pages with what its page alone says against it, before its sensor is looked up."""
    pages = payloads.select(
        "openaq_sensor_id",
        moment(ingested_at, _INSTANT).alias("ingested_at"),
        _text(run_id).alias("run_id"),
        moment(window_end, _INSTANT).alias("window_end"),
        _reading_page(F.col("payload")).alias("page"),
        F.col("payload").isNull().alias("absent"),
    )
    if unread is not None:
        failed = F.col("absent") | F.col(f"page.{_BROKEN}").isNotNull()
        pages = pages.observe(unread, F.count_if(failed).alias("unread"))
    items = pages.select(
        "openaq_sensor_id",
        "ingested_at",
        "run_id",
        "window_end",
        F.col(f"page.{_BROKEN}").isNotNull().alias("broken"),
        F.explode("page.results").alias("item"),
    )
    # The optimizer carries no filter past a generator, so each time is read once, also where rows are filtered by it.
    times = F.struct(
        parse_utc(F.col("item.period.datetimeFrom.utc")).alias("start"),
        parse_utc(F.col("item.period.datetimeTo.utc")).alias("end"),
    )
    typed = items.select("*", F.explode(F.array(times)).alias("times")).select(
        "openaq_sensor_id",
        "ingested_at",
        "run_id",
        "window_end",
        "broken",
        F.col("item.value").alias("value"),
        F.col("item.period.datetimeFrom.utc").alias("from_text"),
        F.col("times.start").alias("period_from_utc"),
        F.col("item.period.datetimeTo.utc").alias("to_text"),
        F.col("times.end").alias("period_to_utc"),
        F.col("item.period.datetimeFrom.local").alias("period_from_local"),
        F.col("item.period.label").alias("period_label"),
        F.col("item.period.interval").alias("period_interval"),
        F.col("item.coverage.expectedCount").alias("coverage_expected"),
        F.col("item.coverage.observedCount").alias("coverage_observed"),
        F.col("item.coverage.percentComplete").alias("coverage_pct"),
    )
    malformed = F.col("from_text").isNull() | F.col("to_text").isNull() | F.col("value").isNull()
    unreadable = F.col("period_from_utc").isNull() | F.col("period_to_utc").isNull()
    reason = F.when(F.col("broken"), "broken_page").when(malformed, "malformed").when(unreadable, "unreadable_time")
    if enforce_complete_hours:
        reason = reason.when(F.col("period_to_utc") > F.col("window_end"), "incomplete_hour")
    return typed.select(
        "*",
        F.concat(F.col("openaq_sensor_id").cast("string"), F.lit("|"), F.col("from_text")).alias("dedup_key"),
        reason.alias("reject_reason"),
    ).drop("window_end", "from_text", "to_text", "broken")


_WORKLIST = ("openaq_sensor_id", "station_id", "openaq_location_id", "pollutant", "unit")


def reading_candidates(
    payloads: DataFrame,
    sensors: DataFrame,
    ingested_at: Moment,
    run_id: str | Column,
    window_end: Moment,
    enforce_complete_hours: bool = True,
    unread: Observation | None = None,
) -> DataFrame:
    """Every reading of the pages with a ``reject_reason``, NULL for a good one.

    A page that does not fit the schema counts as a failed request, so its readable items
    are rejected too (``broken_page``). A sensor outside the worklist keeps its rows, with
    the reason ``unknown_sensor`` and no station. ``payloads`` has ``openaq_sensor_id`` and ``payload``; ``sensors`` is the worklist
    (station, location, sensor, pollutant, unit). Pages are opened before the lookup,
    so a lookup that has to shuffle moves typed rows and no JSON. ``unread`` observes the number of
    failed requests.
    """
    judged = _judged_readings(payloads, ingested_at, run_id, window_end, enforce_complete_hours, unread)
    lookup = sensors.select(*_WORKLIST, F.lit(True).alias("known"))
    unknown = F.when(F.col("known").isNull(), "unknown_sensor")
    return (
        judged.join(lookup, "openaq_sensor_id", "left")
        .withColumn("reject_reason", F.coalesce("reject_reason", unknown))
        .drop("known")
    )


def flatten_hourly_readings(
    payloads: DataFrame,
    sensors: DataFrame,
    ingested_at: Moment,
    run_id: str | Column,
    window_end: Moment,
    enforce_complete_hours: bool = True,
    unread: Observation | None = None,
) -> DataFrame:
    """Pages of hourly readings to reading rows, without malformed and incomplete hours.

    These are the :func:`reading_candidates` without a reason; what the page already rejects never meets the lookup.
    """
    judged = _judged_readings(payloads, ingested_at, run_id, window_end, enforce_complete_hours, unread)
    good = judged.filter(F.col("reject_reason").isNull())
    return conform(good.join(sensors.select(*_WORKLIST), "openaq_sensor_id"), READINGS)


def _forecast_results(payload: Column) -> Column:
    """A single location comes as an object, several as a list of objects."""
    text = F.ltrim(payload)
    listed = F.when(F.startswith(text, F.lit("[")), text).otherwise(F.concat(F.lit("["), text, F.lit("]")))
    return F.from_json(listed, FORECAST_BATCH)


def forecast_outcomes(payloads: DataFrame, run_id: str | Column, answered: bool = False) -> DataFrame:
    """One row per request: the batch was answered with readable JSON or not, and for which stations.

    ``station_id`` is the array of the stations asked for. ``answered``: all are known to be readable.
    """
    ok = F.lit(True) if answered else _forecast_results(F.col("payload")).isNotNull()
    return payloads.select(
        _text(run_id).alias("run_id"), ok.alias("ok"), F.col("stations.station_id").alias("station_id")
    )


def forecast_candidates(
    payloads: DataFrame, ingested_at: Moment, run_id: str | Column, unread: Observation | None = None
) -> DataFrame:
    """Every forecast hour of the batches with a ``reject_reason``, NULL for a good one.

    ``payloads`` has ``payload`` and the requested ``stations`` in request order, an array
    of station_id, latitude, longitude. The i-th result belongs to the i-th station. A batch
    that cannot be read (``malformed``) or has another number of results
    (``length_mismatch``) gives one rejected row; an hour whose time cannot be read is
    rejected as ``unreadable_time``. A value array shorter than the times, or absent, gives
    NULLs; a longer one adds nothing. ``unread`` observes the number of batches that cannot be read.
    """
    # The parsed results are used three times, so the optimizer leaves their projection alone: each JSON text is
    # read once. A station meets its result, and a time its values, before they are opened: a row carries its own
    # values and no array of them.
    results = F.col("results")
    fits = F.size(results) == F.size("stations")
    batches = payloads.select(
        "stations",
        moment(ingested_at, _INSTANT).alias("ingested_at"),
        _text(run_id).alias("run_id"),
        _forecast_results(F.col("payload")).alias("results"),
    )
    if unread is not None:
        batches = batches.observe(unread, F.count_if(results.isNull()).alias("unread"))
    batches = batches.select(
        "stations",
        "ingested_at",
        "run_id",
        F.when(results.isNull(), "malformed").when(~F.coalesce(fits, F.lit(False)), "length_mismatch").alias("why"),
        F.when(fits, results).alias("results"),
    )
    located = batches.select(
        "ingested_at",
        "run_id",
        "why",
        F.explode_outer(F.when(F.col("why").isNull(), F.arrays_zip("stations", "results"))).alias("pair"),
    )
    # An absent array is an empty one. The longest array gives the number of hours, those after the last time are no rows.
    none = F.array().cast("array<double>")
    timed = located.select(
        F.col("pair.stations").alias("station"),
        "ingested_at",
        "run_id",
        "why",
        F.col("pair.results.hourly.time").alias("time"),
        F.size("pair.results.hourly.time").alias("times"),
        *[F.coalesce(f"pair.results.hourly.{v}", none).alias(v) for v in FORECAST_VARIABLES],
    )
    hours = timed.select(
        "station",
        "ingested_at",
        "run_id",
        "why",
        "times",
        F.posexplode_outer(F.arrays_zip("time", *FORECAST_VARIABLES)).alias("hour", "at"),
    ).filter(F.col("why").isNotNull() | (F.col("hour") < F.col("times")))
    time = F.col("at.time")
    short = F.length(time) == 16
    # Z is UTC as +00:00 is, and is read in half the time. The optimizer carries no filter past a generator, so
    # each time is read once.
    read = parse_utc(F.when(short, F.concat(time, F.lit(":00Z"))).otherwise(time))
    hours = hours.select("*", F.explode(F.array(read)).alias("valid_time"))
    valid_time = F.col("valid_time")
    text = F.when(short, F.concat(time, F.lit(":00+00:00"))).otherwise(time)
    return hours.select(
        F.col("station.station_id").alias("station_id"),
        "run_id",
        F.col("station.latitude").alias("latitude"),
        F.col("station.longitude").alias("longitude"),
        "valid_time",
        *[F.col(f"at.{v}").alias(v) for v in FORECAST_VARIABLES],
        "ingested_at",
        F.concat(F.col("station.station_id"), F.lit("|"), text).alias("dedup_key"),
        F.when(F.col("why").isNotNull(), F.col("why")).when(valid_time.isNull(), "unreadable_time").alias("reject_reason"),
    )


def flatten_forecast_batch(
    payloads: DataFrame, ingested_at: Moment, run_id: str | Column, unread: Observation | None = None
) -> DataFrame:
    """Batches of parallel-array forecasts to one row per location and hour, without the rejected ones."""
    rows = forecast_candidates(payloads, ingested_at, run_id, unread)
    return conform(rows.filter(F.col("reject_reason").isNull()), FORECASTS)


def parse_catalogue(pages: DataFrame) -> DataFrame:
    """Catalogue pages (``payload``) to one typed row per item, with its own JSON as ``raw_json``."""
    items = pages.select(F.explode(F.from_json("payload", CATALOGUE_PAGE)["results"]).alias("raw_json"))
    return items.select(F.from_json("raw_json", CATALOGUE_ITEM).alias("item"), "raw_json").select(
        "item.*", "raw_json"
    )


def read_catalogue_pages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Landed catalogue pages, one JSON document per file."""
    paths = [path] if isinstance(path, str) else path
    return spark.read.text(paths, wholetext=True).withColumnRenamed("value", "payload")


def read_landed(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """Landed requests as JSON lines (``LANDED_READINGS`` or ``LANDED_FORECASTS``)."""
    return spark.read.schema(schema).json(path)


def write_landed(requests: DataFrame, path: str) -> None:
    """Requests as JSON lines that :func:`read_landed` gives back, their times to the microsecond.

    Files are compressed, which JSON repays several times over. As a compressed file is read by one task, none
    holds more than :data:`LANDED_ROWS`.
    """
    (
        requests.write.mode("append")
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .option("compression", "lz4")
        .option("maxRecordsPerFile", LANDED_ROWS)
        .json(path)
    )
