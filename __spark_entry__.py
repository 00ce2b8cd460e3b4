"""

Every query runs over whole tables. The test tables are given the shape of readings,
forecasts, stations and runs by ``gaugelake.bindings``.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from datetime import UTC, datetime

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.errors import StreamingQueryException  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from gaugelake import bindings, oracles  # noqa: E402
from gaugelake.functions import clock, labels, scores  # noqa: E402
from gaugelake.functions.scores import round_half_up  # noqa: E402
from gaugelake.operators import catalogue, dashboard, forecasts, quality, readings, runs  # noqa: E402
from gaugelake.plans.cache import ResultCache  # noqa: E402
from gaugelake.plans.ingest import (  # noqa: E402
    CATALOGUE_TABLES,
    ingest_forecasts,
    ingest_readings,
    refresh_catalogue,
    switch_catalogue,
)
from gaugelake.schemas import READINGS, TARGET_POLLUTANTS, any_null, conform, split_not_null  # noqa: E402
from gaugelake.session import shared_folder, tune  # noqa: E402
from gaugelake.sources import catalog, layout, payloads, tables, variants  # noqa: E402
from gaugelake.streaming import ingest as streams  # noqa: E402
from gaugelake.streaming import stateful  # noqa: E402

try:
    import corpus_pipeline  # noqa: E402
    from gaugelake.llm import queries as llm  # noqa: E402
except ImportError:  # a copy of the library without that subpackage, or a machine without what it needs
    llm = None

Query = Callable[[SparkSession, str], DataFrame]

_NTZ = "timestamp_ntz"


class _Inputs:
    """The bound frames of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        self._dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return bindings.table(self.spark, self._dir, name)

    @property
    def readings(self) -> DataFrame:
        return bindings.readings_of(self.table("events"))

    @property
    def forecasts(self) -> DataFrame:
        return bindings.forecasts_of(self.table("lineitem"))

    @property
    def stations(self) -> DataFrame:
        return bindings.stations_of(self.table("supplier"), self.table("nation"))

    @property
    def station_loads(self) -> DataFrame:
        return bindings.stations_of(self.table("supplier"), self.table("nation"), loads=2)

    @property
    def sensors(self) -> DataFrame:
        return bindings.sensors_of(self.table("events"))

    @property
    def worklist(self) -> DataFrame:
        return self.sensors.withColumnsRenamed({"parameter_name": "pollutant", "parameter_units": "unit"})

    @property
    def run_log(self) -> DataFrame:
        return bindings.run_log_of(self.table("orders"))

    @property
    def requests(self) -> DataFrame:
        return bindings.requests_of(self.table("events"))

    @property
    def catalogue(self) -> DataFrame:
        pages = bindings.catalogue_pages_of(self.table("supplier"), self.table("nation"))
        return payloads.parse_catalogue(pages)

    @property
    def reading_pages(self) -> DataFrame:
        return bindings.reading_pages_of(self.table("events"))

    @property
    def forecast_batches(self) -> DataFrame:
        return bindings.forecast_batches_of(self.table("lineitem"))

    def scratch(self) -> str:
        return f"{shared_folder(self.spark)}/gaugelake-{uuid.uuid4().hex}"


def _without_zone(df: DataFrame) -> DataFrame:
    """TIMESTAMP columns as TIMESTAMP_NTZ, the kind the SQL twins return."""
    return df.select(
        *[F.col(n).cast(_NTZ).alias(n) if kind == "timestamp" else F.col(n) for n, kind in df.dtypes]
    )


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Sums of doubles to six places: their last bits depend on the order of addition."""
    return df.withColumns({c: round_half_up(F.col(c), 6) for c in columns})


# --- readings and forecasts -------------------------------------------------------


def _dedup_latest_readings(x: _Inputs) -> DataFrame:
    return readings.dedup_latest_readings(x.readings)


def _dedup_latest_forecasts(x: _Inputs) -> DataFrame:
    return forecasts.dedup_latest_forecasts(x.forecasts)


def _station_latest_pollutants(x: _Inputs) -> DataFrame:
    return readings.station_latest_pollutants(x.readings, x.stations, stable_key=True)


def _station_hourly_wide(x: _Inputs) -> DataFrame:
    return readings.station_hourly_wide(x.readings, stable_key=True)


def _station_hourly_combined(x: _Inputs) -> DataFrame:
    return forecasts.station_hourly_combined(x.readings, x.forecasts, stable_key=True)


def _station_hourly_long(x: _Inputs) -> DataFrame:
    return readings.unpivot_pollutants(_station_hourly_combined(x))


def _station_current_outlook(x: _Inputs) -> DataFrame:
    outlook = forecasts.station_current_outlook(x.readings, x.forecasts, x.stations, stable_key=True)
    return _rounded(
        outlook,
        "avg_temperature_2m",
        "avg_relative_humidity_2m",
        "avg_cloud_cover",
        "avg_boundary_layer_height",
        "total_precipitation",
    )


def _station_dispersion_outlook(x: _Inputs) -> DataFrame:
    return forecasts.station_dispersion_outlook(
        x.readings, x.forecasts, x.stations, oracles.OUTLOOK_TS, stable_key=True
    )


def _station_worst_outlook(x: _Inputs) -> DataFrame:
    return forecasts.station_worst_outlook(_station_dispersion_outlook(x))


def _station_freshness(x: _Inputs) -> DataFrame:
    return readings.station_freshness(x.readings, x.stations, oracles.FRESHNESS_TS, stable_key=True)


def _station_pollutants(x: _Inputs) -> DataFrame:
    return readings.station_pollutants(_station_hourly_long(x))


def _station_time_series(x: _Inputs) -> DataFrame:
    return forecasts.station_pollutant_series(
        x.readings, x.forecasts, None, "pm25", oracles.SERIES_DAYS, oracles.FRESHNESS_TS, stable_key=True
    )


# The same consumer queries for the one station a page opens with, the one that reported PM2.5 last.


def _station_shown(x: _Inputs) -> str:
    newest = F.max(F.struct("period_from_utc", "station_id")).alias("newest")
    return x.readings.filter(F.col("pollutant") == "pm25").agg(newest).first().newest.station_id


def _station_pollutants_one(x: _Inputs) -> DataFrame:
    return readings.station_pollutants(_station_hourly_long(x), _station_shown(x))


def _station_time_series_one(x: _Inputs) -> DataFrame:
    return forecasts.station_pollutant_series(
        x.readings, x.forecasts, _station_shown(x), "pm25", oracles.SERIES_DAYS, oracles.FRESHNESS_TS, stable_key=True
    )


# The same views for a key that need not name one sensor and hour.


def _station_latest_pollutants_any_key(x: _Inputs) -> DataFrame:
    return readings.station_latest_pollutants(x.readings, x.stations)


def _station_hourly_wide_any_key(x: _Inputs) -> DataFrame:
    return readings.station_hourly_wide(x.readings)


def _station_hourly_combined_any_key(x: _Inputs) -> DataFrame:
    return forecasts.station_hourly_combined(x.readings, x.forecasts)


def _station_dispersion_outlook_any_key(x: _Inputs) -> DataFrame:
    return forecasts.station_dispersion_outlook(x.readings, x.forecasts, x.stations, oracles.OUTLOOK_TS)


def _station_freshness_any_key(x: _Inputs) -> DataFrame:
    return readings.station_freshness(x.readings, x.stations, oracles.FRESHNESS_TS)


def _station_time_series_any_key(x: _Inputs) -> DataFrame:
    return readings.station_time_series(
        readings.unpivot_pollutants(_station_hourly_combined_any_key(x)),
        None,
        "pm25",
        oracles.SERIES_DAYS,
        oracles.FRESHNESS_TS,
    )


# --- dashboard --------------------------------------------------------------------


def _station_two_source_freshness(x: _Inputs) -> DataFrame:
    return dashboard.station_two_source_freshness(
        x.readings, x.forecasts, x.station_loads, oracles.TWO_SOURCE_TS, stable_key=True
    )


def _station_detail(x: _Inputs) -> DataFrame:
    return dashboard.station_detail(_station_two_source_freshness(x))


def _map_center(x: _Inputs) -> DataFrame:
    return _rounded(dashboard.map_center(_station_two_source_freshness(x)), "latitude", "longitude")


# --- run log ----------------------------------------------------------------------


def _ingestion_overview(x: _Inputs) -> DataFrame:
    return runs.ingestion_overview(x.run_log, oracles.RUNS_TS)


def _source_freshness(x: _Inputs) -> DataFrame:
    return runs.source_freshness(x.run_log, oracles.RUNS_TS)


def _daily_ingestion_stats(x: _Inputs) -> DataFrame:
    return runs.daily_ingestion_stats(x.run_log)


def _run_summary(x: _Inputs) -> DataFrame:
    return runs.run_summary(x.readings, bindings.outcomes_of(x.table("events")))


def _run_log_row(x: _Inputs) -> DataFrame:
    started = F.to_timestamp_ntz(F.substring("run_id", 5, 8), F.lit("yyyyMMdd")).cast("timestamp")
    finished = F.timestamp_add("SECOND", F.pmod(F.col("record_count"), F.lit(900)).cast("int"), started)
    rows = runs.run_log_row(_run_summary(x), "openaq", started, finished)
    return _without_zone(
        rows.select(
            "run_id",
            "source",
            "status",
            "run_started_at",
            "run_finished_at",
            "duration_seconds",
            "records_written",
            "sensors_queried",
            "sensors_failed",
            "api_calls",
            "api_errors",
            "failed_sensor_ids",
            "ingested_at",
        )
    )


def _request_rate_audit(x: _Inputs) -> DataFrame:
    return runs.request_rate_audit(x.requests, ["run_date"], window_seconds=oracles.AUDIT_WINDOW_SECONDS)


def _request_timeline(x: _Inputs) -> DataFrame:
    return _without_zone(
        runs.request_timeline(x.requests, ["run_date"], bucket_seconds=oracles.AUDIT_BUCKET_SECONDS)
    )


def _request_status_breakdown(x: _Inputs) -> DataFrame:
    return runs.request_status_breakdown(x.requests, ["run_date"])


# --- catalogue --------------------------------------------------------------------


def _latest_station_metadata(x: _Inputs) -> DataFrame:
    return catalogue.latest_station_metadata(x.station_loads)


def _eligible_stations(x: _Inputs) -> DataFrame:
    return catalogue.eligible_stations(x.station_loads)


def _sensor_worklist(x: _Inputs) -> DataFrame:
    return catalogue.sensor_worklist(x.sensors)


def _sensor_worklist_first(x: _Inputs) -> DataFrame:
    """The first sensors to poll of the eligible stations, which are the allow list."""
    return catalogue.sensor_worklist(x.sensors, station_ids=_eligible_stations(x), limit=oracles.FIRST_SENSORS)


def _station_locations(x: _Inputs) -> DataFrame:
    return catalogue.station_locations(x.stations)


def _catalogue_variants(x: _Inputs) -> DataFrame:
    pages = bindings.catalogue_pages_of(x.table("supplier"), x.table("nation"))
    items = variants.parse_catalogue_variants(pages)
    return items.select(
        "id",
        "name",
        "isMobile",
        "isMonitor",
        F.col("coordinates.latitude").alias("latitude"),
        F.col("country.code").alias("country_code"),
        F.size("sensors").cast("long").alias("sensors"),
        F.col("sensors")[2]["parameter"]["name"].alias("third"),
        "raw_json",
        F.size("unknown_fields").cast("long").alias("unknown"),
    )


def _select_stations(x: _Inputs) -> DataFrame:
    kept, _ = catalogue.select_stations(x.catalogue)
    sensor_text = F.transform(
        "sensors",
        lambda s: F.concat_ws(
            "/",
            s["id"].cast("string"),
            s["parameter"]["id"].cast("string"),
            s["parameter"]["name"],
            s["parameter"]["displayName"],
            s["parameter"]["units"],
        ),
    )
    return kept.select(
        "id",
        "name",
        "locality",
        "timezone",
        "isMobile",
        "isMonitor",
        F.col("country.code").alias("country_code"),
        F.col("country.name").alias("country_name"),
        F.col("provider.id").alias("provider_id"),
        F.col("provider.name").alias("provider_name"),
        F.col("owner.id").alias("owner_id"),
        F.col("owner.name").alias("owner_name"),
        F.col("coordinates.latitude").alias("latitude"),
        F.col("coordinates.longitude").alias("longitude"),
        F.col("datetimeFirst.utc").alias("first_utc"),
        F.col("datetimeLast.utc").alias("last_utc"),
        F.array_join(sensor_text, ";").alias("sensors"),
        "raw_json",
    )


def _select_stations_reasons(x: _Inputs) -> DataFrame:
    _, reasons = catalogue.select_stations(x.catalogue)
    return reasons


def _station_rows(x: _Inputs) -> DataFrame:
    kept, _ = catalogue.select_stations(x.catalogue)
    return catalogue.build_station_rows(kept, oracles.LOADED_AT)


def _sensor_rows(x: _Inputs) -> DataFrame:
    kept, _ = catalogue.select_stations(x.catalogue)
    return catalogue.build_sensor_rows(kept, oracles.LOADED_AT)


def _build_station_rows(x: _Inputs) -> DataFrame:
    return _without_zone(_station_rows(x))


def _build_sensor_rows(x: _Inputs) -> DataFrame:
    return _without_zone(_sensor_rows(x))


def _catalogue_summary(x: _Inputs) -> DataFrame:
    return catalogue.catalogue_summary(_station_rows(x), _sensor_rows(x))


def _refresh_catalogue(x: _Inputs) -> DataFrame:
    folder = x.scratch()
    pages = bindings.catalogue_pages_of(x.table("supplier"), x.table("nation"))
    summary, _ = refresh_catalogue(pages, f"{folder}/stations", f"{folder}/sensors", oracles.LOADED_AT)
    return summary


def _switched(x: _Inputs) -> catalog.SwitchedTables:
    return catalog.SwitchedTables(x.spark, f"catalogue_{uuid.uuid4().hex}", CATALOGUE_TABLES, x.scratch())


def _switch_catalogue(x: _Inputs) -> DataFrame:
    """A refresh, and one that breaks after its stations are written: both tables are those of the first."""
    both = _switched(x)
    pages = bindings.catalogue_pages_of(x.table("supplier"), x.table("nation"))
    switch_catalogue(pages, both, oracles.LOADED_AT)
    first = both.current()
    stations, sensors = (both.table(name) for name in CATALOGUE_TABLES)
    broken = sensors.withColumn("parameter_units", F.raise_error(F.lit("half-way")).cast("string"))
    try:
        both.load({"stations": stations.withColumn("station_name", F.lit("later")), "sensors": broken})
    except Exception:
        if both.current() != first:
            raise
    return (
        both.table("stations")
        .select("station_id", "station_name", "sensor_count")
        .join(both.table("sensors").select("station_id", "openaq_sensor_id", "parameter_units"), "station_id")
    )


def _subset_stations(x: _Inputs) -> DataFrame:
    return catalogue.subset_stations(_station_rows(x))


def _units_by_pollutant(x: _Inputs) -> DataFrame:
    return catalogue.units_by_pollutant(x.sensors)


# --- payloads, tables, streams ----------------------------------------------------


def _flatten_hourly_readings(x: _Inputs) -> DataFrame:
    return _without_zone(
        payloads.flatten_hourly_readings(
            x.reading_pages, x.worklist, F.col("ingested_at"), F.col("run_id"), F.col("window_end")
        )
    )


def _reading_rejects(x: _Inputs) -> DataFrame:
    judged = payloads.reading_candidates(
        x.reading_pages, x.worklist, F.col("ingested_at"), F.col("run_id"), F.col("window_end")
    )
    return (
        judged.filter(F.col("reject_reason").isNotNull())
        .groupBy("station_id", "reject_reason")
        .agg(F.count(F.lit(1)).alias("rejected"))
    )


def _reading_rejects_unknown(x: _Inputs) -> DataFrame:
    known = x.worklist.filter(F.col("pollutant") != "so2")
    judged = payloads.reading_candidates(
        x.reading_pages, known, F.col("ingested_at"), F.col("run_id"), F.col("window_end")
    )
    outcome = F.coalesce("reject_reason", F.lit("accepted")).alias("outcome")
    return judged.groupBy(outcome).agg(F.count(F.lit(1)).alias("items"))


def _forecast_rejects(x: _Inputs) -> DataFrame:
    judged = payloads.forecast_candidates(x.forecast_batches, F.col("ingested_at"), F.col("run_id"))
    outcome = F.coalesce("reject_reason", F.lit("accepted")).alias("outcome")
    return judged.groupBy(outcome).agg(F.count(F.lit(1)).alias("items"))


def _flatten_forecast_batch(x: _Inputs) -> DataFrame:
    return _without_zone(
        payloads.flatten_forecast_batch(x.forecast_batches, F.col("ingested_at"), F.col("run_id"))
    )


def _complete_hour_window(x: _Inputs) -> DataFrame:
    events = x.table("events")
    start, end = clock.complete_hour_window(F.col("ts"), 3, events.schema["ts"].dataType)
    return events.select("event_id", start.alias("window_start"), end.alias("window_end"))


def _time_functions(x: _Inputs) -> DataFrame:
    ts = F.col("ts")
    reference = clock.moment_like(x.table("events"), "ts", oracles.TWO_SOURCE_TS)
    return _without_zone(
        x.table("events").select(
            "event_id",
            clock.format_utc(ts).alias("rfc3339"),
            clock.parse_utc(clock.format_utc(ts)).alias("parsed"),
            clock.run_stamp(ts, F.col("user_id").cast("string")).alias("run_stamp"),
            clock.utc_label(ts).alias("utc_label"),
            clock.whole_hours(reference, ts).alias("whole_hours"),
            clock.age_hours(reference, ts).alias("age_hours"),
            clock.seconds_between(reference, ts).alias("seconds"),
            clock.minutes_between(reference, ts).alias("minutes"),
        )
    )


def _label_functions(x: _Inputs) -> DataFrame:
    hours = F.when(F.col("event_id") % 5 != 0, F.col("value") - F.lit(5.0))
    other = F.when(F.col("event_id") % 3 != 0, F.lit(10.0))
    stale, old = F.coalesce(hours > 2, F.lit(False)), F.coalesce(other > F.col("event_id") % 20, F.lit(False))
    return x.table("events").select(
        "event_id",
        labels.age_label(hours).alias("age_label"),
        labels.newest_source(hours, other).alias("source"),
        labels.freshness_band(hours * F.lit(10.0)).alias("band"),
        labels.severity_class(stale, old, stale | old).alias("severity"),
        labels.has_token(F.col("props"), "k").alias("has_token"),
        scores.clamp_score(hours, 40.0).alias("score"),
        scores.category(scores.clamp_score(hours, 40.0)).alias("category"),
        round_half_up(scores.clamp_score(hours, 40.0), 2).alias("rounded"),
    )


def _landed_readings(x: _Inputs) -> DataFrame:
    """Readings of requests that were landed as JSON lines."""
    folder = x.scratch() + "/landing"
    payloads.write_landed(x.reading_pages, folder)
    landed = payloads.read_landed(x.spark, folder, payloads.LANDED_READINGS)
    return _without_zone(
        payloads.flatten_hourly_readings(
            landed, x.worklist, F.col("ingested_at"), F.col("run_id"), F.col("window_end")
        )
    )


def _landed_forecasts(x: _Inputs) -> DataFrame:
    """Forecasts of requests that were landed as JSON lines."""
    folder = x.scratch() + "/landing"
    payloads.write_landed(x.forecast_batches, folder)
    landed = payloads.read_landed(x.spark, folder, payloads.LANDED_FORECASTS)
    return _without_zone(payloads.flatten_forecast_batch(landed, F.col("ingested_at"), F.col("run_id")))


def _stream_landed_readings(x: _Inputs) -> DataFrame:
    """A stream of landed pages whose first batch breaks once after it was appended: its rows are there once."""
    folder = x.scratch()
    payloads.write_landed(x.reading_pages, folder + "/landing")
    raw = tables.readings_table(folder + "/raw", by_batch=True)
    latest = tables.readings_table(folder + "/latest")

    def ingest(dedup: Callable[[DataFrame], DataFrame]) -> None:
        arriving = streams.landed_stream(x.spark, folder + "/landing", payloads.LANDED_READINGS)
        streams.start_ingest(arriving, raw, folder + "/checkpoint", latest, dedup, typed).awaitTermination()

    def typed(pages: DataFrame) -> DataFrame:
        return payloads.flatten_hourly_readings(
            pages, x.worklist, F.col("ingested_at"), F.col("run_id"), F.col("window_end")
        )

    def broken(rows: DataFrame) -> DataFrame:
        raise RuntimeError("half-way")

    try:
        ingest(broken)
    except StreamingQueryException as problem:
        if "half-way" not in str(problem):
            raise
    ingest(streams.newest_readings)
    return _without_zone(tables.read_table(x.spark, raw))


_STARTED = datetime.fromisoformat(oracles.INGEST_TS).replace(tzinfo=UTC)


def _readings_ingested(x: _Inputs) -> tuple[tables.TableSpec, tables.TableSpec]:
    folder = x.scratch()
    target, log = tables.readings_table(folder + "/readings"), tables.run_log_table(folder + "/log")
    ingest_readings(x.spark, x.reading_pages, x.worklist, target, log, "run-all", _STARTED)
    return target, log


def _forecasts_ingested(x: _Inputs) -> tuple[tables.TableSpec, tables.TableSpec]:
    folder = x.scratch()
    target, log = tables.forecasts_table(folder + "/forecasts"), tables.run_log_table(folder + "/log")
    ingest_forecasts(x.spark, x.forecast_batches, target, log, "run-all", _STARTED)
    return target, log


def _logged(x: _Inputs, log: tables.TableSpec) -> DataFrame:
    """The log without the times at which this run of it ended."""
    clocked = ("run_finished_at", "duration_seconds", "ingested_at")
    return _without_zone(tables.read_table(x.spark, log).drop(*clocked))


def _ingest_readings_run(x: _Inputs) -> DataFrame:
    return _logged(x, _readings_ingested(x)[1])


def _ingest_forecasts_run(x: _Inputs) -> DataFrame:
    return _logged(x, _forecasts_ingested(x)[1])


def _ingest_readings_rows(x: _Inputs) -> DataFrame:
    return _without_zone(tables.read_table(x.spark, _readings_ingested(x)[0]))


def _ingest_forecasts_rows(x: _Inputs) -> DataFrame:
    return _without_zone(tables.read_table(x.spark, _forecasts_ingested(x)[0]))


def _stream_request_buckets(x: _Inputs) -> DataFrame:
    folder = x.scratch()
    arriving = x.spark.readStream.schema(x.table("events").schema).parquet(f"{x._dir}/events*.parquet")
    counts = streams.request_buckets(
        bindings.requests_of(arriving), ["run_date"], bucket_seconds=oracles.AUDIT_BUCKET_SECONDS, lateness="0 seconds"
    )

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/counts/{number}")

    # Update mode drops the state of buckets behind the watermark; a bucket's last count is its largest.
    query = (
        counts.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    written = x.spark.read.option("recursiveFileLookup", "true").parquet(f"{folder}/counts")
    return _without_zone(written.groupBy("run_date", "bucket_start").agg(F.max("requests").alias("requests")))


def _retain_days(x: _Inputs) -> DataFrame:
    return tables.retain_days(x.readings, "period_from_utc", 30, oracles.RETENTION_TS)


def _expire_dates(x: _Inputs) -> DataFrame:
    """What a table has left after its old partitions are dropped through the catalogue."""
    database = f"readings_{uuid.uuid4().hex}"
    catalog.open_database(x.spark, database, x.scratch())
    name = f"{database}.readings"
    catalog.create_table(x.spark, name, READINGS)
    catalog.insert(x.readings, name, READINGS, "period_from_utc")
    catalog.expire_dates(x.spark, name, 30, datetime.fromisoformat(oracles.RETENTION_TS))
    return _without_zone(x.spark.table(name).drop(tables.PARTITION))


def _rewrite_along_curve(x: _Inputs) -> DataFrame:
    """One pollutant of a table laid out by station, pollutant and hour at once."""
    target = tables.readings_table(x.scratch() + "/readings")
    columns = ["station_id", "pollutant", "period_from_utc"]
    layout.rewrite_along_curve(conform(x.readings, READINGS), target, columns, rows_per_file=1_000_000)
    return _without_zone(tables.read_table(x.spark, target).filter(F.col("pollutant") == "so2"))


def _cached_page(x: _Inputs) -> DataFrame:
    """The daily statistics as a page shows them: first, within its time and after it, while the log grows."""
    now, log = [0.0], tables.run_log_table(x.scratch() + "/log")
    cache = ResultCache(300.0, clock=lambda: now[0])
    odd = F.col("api_calls") % 2 == 1
    shown = []
    tables.append(x.run_log.filter(odd), log)
    for seen, seconds in (("first", 0.0), ("within", 299.0), ("after", 300.0)):
        now[0] = seconds
        page = cache.fetch(runs.daily_ingestion_stats(tables.read_table(x.spark, log), limit=None))
        shown.append(page.assign(seen=seen))
        if seen == "first":
            tables.append(x.run_log.filter(~odd), log)
    pages = [x.spark.createDataFrame(p, "run_date date, source string, total_records long, successes long, errors long, seen string") for p in shown]
    return pages[0].unionByName(pages[1]).unionByName(pages[2])


def _append_and_read(x: _Inputs) -> DataFrame:
    target = tables.readings_table(x.scratch() + "/readings")
    tables.append(x.readings, target)
    return _without_zone(tables.read_table(x.spark, target))


def _stream_latest_readings(x: _Inputs) -> DataFrame:
    folder = x.scratch()
    raw = tables.readings_table(folder + "/raw")
    latest = tables.readings_table(folder + "/latest")
    arriving = x.spark.readStream.schema(x.table("events").schema).parquet(f"{x._dir}/events*.parquet")
    query = streams.start_ingest(
        bindings.readings_of(arriving), raw, folder + "/checkpoint", latest, streams.newest_readings
    )
    query.awaitTermination()
    return _without_zone(tables.read_table(x.spark, latest))


def _stream_newest_versions(x: _Inputs) -> DataFrame:
    folder = x.scratch()
    latest = tables.readings_table(folder + "/latest")
    arriving = x.spark.readStream.schema(x.table("events").schema).parquet(f"{x._dir}/events*.parquet")
    stateful.start_newest(bindings.readings_of(arriving), latest, folder + "/checkpoint", ["dedup_key"]).awaitTermination()
    return _without_zone(streams.newest_readings(tables.read_table(x.spark, latest)))


def _finished_requests(x: _Inputs, folder: str) -> DataFrame:
    """The requests as a stream, and a row without a run a day later, so that time passes the last of them."""
    events = x.table("events")
    requests = bindings.requests_of(events)
    later = requests.agg(F.timestamp_add("DAY", F.lit(1), F.max("started_at")).alias("started_at"))
    beat = later.select(F.lit(None).cast("date").alias("run_date"), "started_at", F.lit(None).cast("int").alias("status_code"))
    beat.write.parquet(folder + "/beat")
    arriving = x.spark.readStream.schema(events.schema).parquet(f"{x._dir}/events*.parquet")
    return bindings.requests_of(arriving).unionByName(x.spark.readStream.schema(requests.schema).parquet(folder + "/beat"))


def _all_written(x: _Inputs, rows: DataFrame, folder: str) -> DataFrame:
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/rows/{number}")

    query = (
        rows.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return x.spark.read.option("recursiveFileLookup", "true").parquet(f"{folder}/rows")


def _stream_request_timeline(x: _Inputs) -> DataFrame:
    folder = x.scratch()
    timeline = stateful.stream_timeline(
        _finished_requests(x, folder), ["run_date"], bucket_seconds=oracles.AUDIT_BUCKET_SECONDS, lateness="0 seconds"
    )
    return _without_zone(_all_written(x, timeline, folder))


def _stream_rate_audit(x: _Inputs) -> DataFrame:
    folder = x.scratch()
    audit = stateful.stream_rate_audit(
        _finished_requests(x, folder), ["run_date"], window_seconds=oracles.AUDIT_WINDOW_SECONDS, lateness="0 seconds"
    )
    rows = _all_written(x, audit, folder)
    return rows.groupBy("run_date").agg(*[F.max(c).alias(c) for c in rows.columns if c != "run_date"])


# --- data quality -----------------------------------------------------------------


def _not_null_rejects(x: _Inputs) -> DataFrame:
    gaps = x.readings.withColumn("run_id", F.when(F.col("coverage_observed") != 7, F.col("run_id")))
    return split_not_null(gaps, READINGS)[1]


def _dq_unique(x: _Inputs) -> DataFrame:
    return quality.assert_unique(x.readings, ["dedup_key"], "readings_unique")


def _dq_row_count(x: _Inputs) -> DataFrame:
    targets = readings.tracked(x.worklist, TARGET_POLLUTANTS)
    return quality.assert_row_count(targets, ["station_id"], 5, "five_sensors")


def _dq_expected(x: _Inputs) -> DataFrame:
    latest = readings.dedup_latest_readings(x.readings, stable_key=True)
    return quality.assert_expected(
        latest,
        x.readings.select("dedup_key", "coverage_observed", "unit"),
        ["dedup_key"],
        "delivered_is_latest",
        tolerance=3.0,
    )


def _dq_null(x: _Inputs) -> DataFrame:
    wide = readings.station_hourly_wide(x.readings, stable_key=True)
    return quality.assert_null(
        wide, ["pm10_unit", "no2_unit"], ["station_id", "hour_utc"], "pm25_alone", F.col("pm25_unit").isNotNull()
    )


def _dq_not_null(x: _Inputs) -> DataFrame:
    latest = readings.station_latest_pollutants(x.readings, x.stations, stable_key=True)
    return quality.assert_not_null(
        latest, ["station_name", "locality"], ["station_id"], "metadata_present", x.sensors.select("station_id").distinct()
    )


def _dq_no_rows(x: _Inputs) -> DataFrame:
    return quality.assert_no_rows(
        forecasts.dispersion_scores(x.forecasts, oracles.OUTLOOK_TS),
        F.col("outlook_category") == "poor",
        ["station_id", "valid_time"],
        "no_poor_hour",
        actual=F.col("outlook_category"),
    )


def _dq_members(x: _Inputs) -> DataFrame:
    return quality.assert_members(x.run_log, "status", ["success", "partial_success"], "run_ok", ["run_id"])


def _report(x: _Inputs) -> DataFrame:
    checks = {
        "five_sensors": lambda: _dq_row_count(x),
        "metadata_present": lambda: _dq_not_null(x),
        "no_poor_hour": lambda: _dq_no_rows(x),
        "readings_unique": lambda: _dq_unique(x),
    }
    run_checks = [
        quality.members_check("no_such_column", [1], "missing_column"),
        quality.members_check("status", ["success", "partial_success"], "run_ok", ["run_id"]),
    ]
    reading_checks = [quality.no_rows_check(any_null(["value"]), ["dedup_key"], "positive_value")]
    return quality.dq_report(x.spark, checks, tables=[(x.run_log, run_checks), (x.readings, reading_checks)])


def _shown(report: DataFrame) -> DataFrame:
    shown = F.transform("samples", lambda v: F.concat_ws("|", *[F.coalesce(v[c], F.lit("")) for c in quality.VIOLATION_COLUMNS[1:]]))
    return report.select(
        "test_name",
        "status",
        "violations",
        F.coalesce(F.array_join(shown, "; "), F.lit("")).alias("samples"),
        F.regexp_extract("error_message", r"^\[([A-Z_]+)", 1).alias("error_class"),
    )


def _dq_report(x: _Inputs) -> DataFrame:
    return _shown(_report(x))


def _dq_totals(x: _Inputs) -> DataFrame:
    return quality.dq_totals(_report(x))


def _dq_one_scan(x: _Inputs) -> DataFrame:
    """Four checks of the readings' rows, answered by one scan."""
    observed = F.col("coverage_observed")
    checks = [
        quality.members_check("unit", ["ppm"], "unit_is_ppm", ["dedup_key", "run_id"]),
        quality.no_rows_check(observed < 2, ["dedup_key", "run_id"], "observed", "2 or more", observed),
        quality.null_check(["value"], ["dedup_key", "run_id"], "no_value_unobserved", observed == 0),
        quality.not_null_check(["value", "unit"], ["dedup_key", "run_id"], "complete"),
    ]
    return _shown(quality.dq_report(x.spark, {}, tables=[(x.readings, checks)]))


_QUERIES: dict[str, Callable[[_Inputs], DataFrame]] = {
    "dedup_latest_readings": _dedup_latest_readings,
    "dedup_latest_forecasts": _dedup_latest_forecasts,
    "station_latest_pollutants": _station_latest_pollutants,
    "station_hourly_wide": _station_hourly_wide,
    "station_hourly_combined": _station_hourly_combined,
    "station_latest_pollutants_any_key": _station_latest_pollutants_any_key,
    "station_hourly_wide_any_key": _station_hourly_wide_any_key,
    "station_hourly_combined_any_key": _station_hourly_combined_any_key,
    "station_dispersion_outlook_any_key": _station_dispersion_outlook_any_key,
    "station_freshness_any_key": _station_freshness_any_key,
    "station_time_series_any_key": _station_time_series_any_key,
    "station_hourly_long": _station_hourly_long,
    "station_current_outlook": _station_current_outlook,
    "station_dispersion_outlook": _station_dispersion_outlook,
    "station_worst_outlook": _station_worst_outlook,
    "station_freshness": _station_freshness,
    "station_pollutants": _station_pollutants,
    "station_time_series": _station_time_series,
    "station_pollutants_one": _station_pollutants_one,
    "station_time_series_one": _station_time_series_one,
    "station_two_source_freshness": _station_two_source_freshness,
    "station_detail": _station_detail,
    "map_center": _map_center,
    "ingestion_overview": _ingestion_overview,
    "source_freshness": _source_freshness,
    "daily_ingestion_stats": _daily_ingestion_stats,
    "run_summary": _run_summary,
    "run_log_row": _run_log_row,
    "request_rate_audit": _request_rate_audit,
    "request_timeline": _request_timeline,
    "request_status_breakdown": _request_status_breakdown,
    "latest_station_metadata": _latest_station_metadata,
    "eligible_stations": _eligible_stations,
    "sensor_worklist": _sensor_worklist,
    "sensor_worklist_first": _sensor_worklist_first,
    "station_locations": _station_locations,
    "catalogue_variants": _catalogue_variants,
    "select_stations": _select_stations,
    "select_stations_reasons": _select_stations_reasons,
    "build_station_rows": _build_station_rows,
    "build_sensor_rows": _build_sensor_rows,
    "catalogue_summary": _catalogue_summary,
    "refresh_catalogue": _refresh_catalogue,
    "switch_catalogue": _switch_catalogue,
    "subset_stations": _subset_stations,
    "units_by_pollutant": _units_by_pollutant,
    "flatten_hourly_readings": _flatten_hourly_readings,
    "reading_rejects": _reading_rejects,
    "reading_rejects_unknown": _reading_rejects_unknown,
    "forecast_rejects": _forecast_rejects,
    "flatten_forecast_batch": _flatten_forecast_batch,
    "complete_hour_window": _complete_hour_window,
    "time_functions": _time_functions,
    "label_functions": _label_functions,
    "ingest_readings_run": _ingest_readings_run,
    "ingest_forecasts_run": _ingest_forecasts_run,
    "ingest_readings_rows": _ingest_readings_rows,
    "ingest_forecasts_rows": _ingest_forecasts_rows,
    "landed_readings": _landed_readings,
    "landed_forecasts": _landed_forecasts,
    "stream_landed_readings": _stream_landed_readings,
    "stream_request_buckets": _stream_request_buckets,
    "retain_days": _retain_days,
    "expire_dates": _expire_dates,
    "rewrite_along_curve": _rewrite_along_curve,
    "cached_page": _cached_page,
    "append_and_read": _append_and_read,
    "stream_latest_readings": _stream_latest_readings,
    "stream_newest_versions": _stream_newest_versions,
    "stream_request_timeline": _stream_request_timeline,
    "stream_rate_audit": _stream_rate_audit,
    "not_null_rejects": _not_null_rejects,
    "dq_unique": _dq_unique,
    "dq_row_count": _dq_row_count,
    "dq_expected": _dq_expected,
    "dq_null": _dq_null,
    "dq_not_null": _dq_not_null,
    "dq_no_rows": _dq_no_rows,
    "dq_members": _dq_members,
    "dq_report": _dq_report,
    "dq_totals": _dq_totals,
    "dq_one_scan": _dq_one_scan,
}


def _registered(query: Callable[[_Inputs], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(_Inputs(spark, sf_dir))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the dispersion outlook of every station's future forecast hours."""
    return queries()["station_dispersion_outlook"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    found = {name: _registered(query) for name, query in _QUERIES.items()}
    if llm:
        found |= llm.QUERIES | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    found = oracles.sql()
    if llm:
        found |= llm.ORACLE_SQL
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
