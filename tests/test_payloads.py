"""Flattening of landed JSON: readings, forecasts and the catalogue."""

import copy
import json
from collections import Counter
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from gaugelake.operators import catalogue as cat
from gaugelake.plans import ingest
from gaugelake.schemas import FORECASTS, READINGS, SENSORS, STATIONS
from gaugelake.sources import payloads as pl
from gaugelake.sources import tables

END = datetime(2024, 1, 15, 10, tzinfo=UTC)
INGESTED = datetime(2024, 1, 15, 10, 5, tzinfo=UTC)

HOUR = {
    "period": {
        "datetimeFrom": {"utc": "2024-01-15T08:00:00Z", "local": "2024-01-15T09:00:00+01:00"},
        "datetimeTo": {"utc": "2024-01-15T09:00:00Z", "local": "2024-01-15T10:00:00+01:00"},
        "label": "raw",
        "interval": "01:00:00",
    },
    "coverage": {"expectedCount": 12, "observedCount": 9, "percentComplete": 75.0},
    "value": 7.25,
}


def hour(**changes):
    item = copy.deepcopy(HOUR)
    for path, value in changes.items():
        target, *rest = path.split("__")
        if rest:
            item[target][rest[0]] = value
        else:
            item[target] = value
    return item


def pages(spark, *texts):
    return spark.createDataFrame([(77, t) for t in texts], "openaq_sensor_id bigint, payload string")


def worklist(spark):
    return spark.createDataFrame(
        [("quay", 31, 77, "pm10", "µg/m³")],
        "station_id string, openaq_location_id bigint, openaq_sensor_id bigint, pollutant string, unit string",
    )


def flatten(spark, *items, enforce=True):
    page = pages(spark, json.dumps({"results": list(items)}))
    return pl.flatten_hourly_readings(page, worklist(spark), INGESTED, "night-7", END, enforce)


def test_valid_reading(spark):
    df = flatten(spark, HOUR)
    assert df.columns == READINGS.fieldNames() and [f.dataType for f in df.schema] == [f.dataType for f in READINGS]
    [row] = df.collect()
    assert (row.station_id, row.openaq_location_id, row.openaq_sensor_id, row.pollutant) == ("quay", 31, 77, "pm10")
    assert (row.value, row.unit, row.period_label, row.period_interval) == (7.25, "µg/m³", "raw", "01:00:00")
    assert row.period_from_utc == datetime(2024, 1, 15, 8) and row.period_to_utc == datetime(2024, 1, 15, 9)
    assert row.period_from_local == "2024-01-15T09:00:00+01:00"
    assert (row.coverage_expected, row.coverage_observed, row.coverage_pct) == (12, 9, 75.0)
    assert row.dedup_key == "77|2024-01-15T08:00:00Z"
    assert row.ingested_at == datetime(2024, 1, 15, 10, 5) and row.run_id == "night-7"


LATE = {"utc": "2024-01-15T11:00:00Z"}


@pytest.mark.parametrize("item,enforce,reason", [
    (hour(value=None), True, "malformed"),
    (hour(period__datetimeFrom={}), True, "malformed"),
    (hour(period__datetimeTo={}), True, "malformed"),
    (hour(period__datetimeFrom={"utc": "yesterday"}), True, "unreadable_time"),
    (hour(period__datetimeTo=LATE), True, "incomplete_hour"),
    (hour(period__datetimeTo=LATE), False, None),
    (hour(), True, None),
])
def test_reject_reasons(spark, item, enforce, reason):
    page = pages(spark, json.dumps({"results": [item]}))
    args = (page, worklist(spark), INGESTED, "night-7", END, enforce)
    [judged] = pl.reading_candidates(*args).collect()
    assert judged.reject_reason == reason
    assert pl.flatten_hourly_readings(*args).count() == (reason is None)


def test_broken_and_empty_pages(spark):
    page = pages(spark, "{not json", None, '{"results": []}', '{"found": 0}', json.dumps({"results": [HOUR]}))
    assert pl.flatten_hourly_readings(page, worklist(spark), INGESTED, "r", END).count() == 1
    assert [r.ok for r in pl.reading_outcomes(page, "r").collect()] == [False, False, True, True, True]


def test_every_item_is_read_or_rejected(spark):
    good, wrong = json.dumps({"results": [HOUR]}), json.dumps({"results": [HOUR, hour(value="seven")]})
    known = pages(spark, good, wrong)
    other = known.limit(1).withColumn("openaq_sensor_id", F.lit(123456789).cast("bigint"))
    args = (known.unionByName(other), worklist(spark), INGESTED, "r", END)
    judged = [(r.reject_reason, r.station_id is None) for r in pl.reading_candidates(*args).collect()]
    assert Counter(judged) == {(None, False): 1, ("broken_page", False): 2, ("unknown_sensor", True): 1}
    assert pl.flatten_hourly_readings(*args).count() == 1
    assert Counter(r.ok for r in pl.reading_outcomes(args[0], "r").collect()) == {True: 2, False: 1}


def test_every_forecast_batch_is_read_or_rejected(spark):
    def reasons(payload, *stations):
        df = spark.createDataFrame(
            [(payload if isinstance(payload, str) else json.dumps(payload), [(s, 1.0, 2.0) for s in stations])],
            "payload string, stations array<struct<station_id:string,latitude:double,longitude:double>>",
        )
        return Counter(r.reject_reason for r in pl.forecast_candidates(df, INGESTED, "r").collect())

    assert reasons([result()], "1", "2") == {"length_mismatch": 1}
    assert reasons("{oops", "1") == {"malformed": 1}
    assert reasons(result(["2024-01-15T09:00", "noon"]), "1") == {None: 1, "unreadable_time": 1}
    assert reasons([result(), result()], "1", "2") == {None: 4}


VARIABLES = {
    "temperature_2m": [3.5, 4.0], "relative_humidity_2m": [91, 88], "surface_pressure": [990, 991],
    "wind_speed_10m": [1.5, 2.5], "wind_direction_10m": [10, 350], "precipitation": [0.2, 0.0],
    "cloud_cover": [100, 5], "boundary_layer_height": [320, 410],
}


def result(times=("2024-01-15T09:00", "2024-01-15T10:00"), **changes):
    return {"latitude": 48.8, "longitude": 2.3, "hourly": {"time": list(times), **VARIABLES, **changes}}


def batch(spark, payload, *station_ids):
    stations = [(s, 1.0 + i, 2.0 + i) for i, s in enumerate(station_ids)]
    df = spark.createDataFrame(
        [(payload if isinstance(payload, str) else json.dumps(payload), stations)],
        "payload string, stations array<struct<station_id:string,latitude:double,longitude:double>>",
    )
    return pl.flatten_forecast_batch(df, INGESTED, "night-7")


def test_single_object_forecast(spark):
    df = batch(spark, result(), "1")
    assert df.columns == FORECASTS.fieldNames()
    first, second = df.orderBy("valid_time").collect()
    assert (first.station_id, first.temperature_2m, first.relative_humidity_2m) == ("1", 3.5, 91.0)
    assert first.valid_time == datetime(2024, 1, 15, 9) and second.valid_time == datetime(2024, 1, 15, 10)
    assert first.dedup_key == "1|2024-01-15T09:00:00+00:00" and (first.latitude, first.longitude) == (1.0, 2.0)


def test_positional_match_of_results_and_stations(spark):
    rows = batch(spark, [result(["2024-01-15T09:00"]), result(["2024-01-15T08:00"])], "1", "2").collect()
    assert {(r.station_id, r.valid_time.hour, r.latitude) for r in rows} == {("1", 9, 1.0), ("2", 8, 2.0)}


def test_mismatched_counts_drop_the_batch(spark):
    assert batch(spark, [result()], "1", "2").count() == 0
    assert batch(spark, [result(), result()], "1").count() == 0
    assert batch(spark, "{oops", "1").count() == 0


def test_value_arrays_of_other_lengths(spark):
    rows = batch(spark, result(temperature_2m=[1.0], precipitation=[1.0, 2.0, 3.0]), "1").orderBy("valid_time").collect()
    assert [r.temperature_2m for r in rows] == [1.0, None] and [r.precipitation for r in rows] == [1.0, 2.0]
    bare = {"latitude": 1.0, "longitude": 1.0, "hourly": {"time": ["2024-01-15T09:00"]}}
    [row] = batch(spark, [bare], "1").collect()
    assert row.temperature_2m is None and row.boundary_layer_height is None


def test_preformatted_time_is_kept(spark):
    [row] = batch(spark, result(["2024-01-15T09:00:00+00:00"]), "1").collect()
    assert row.dedup_key == "1|2024-01-15T09:00:00+00:00" and row.valid_time == datetime(2024, 1, 15, 9)


def sensor(number, code, name, units="µg/m³"):
    return {"id": number, "parameter": {"id": code, "name": name, "displayName": name.upper(), "units": units}}


ITEM = {
    "id": 8, "name": "Old Harbour", "locality": "Marseille", "isMobile": False, "isMonitor": True,
    "coordinates": {"latitude": 43.6, "longitude": 5.25}, "country": {"code": "FR", "name": "France"},
    "timezone": "Europe/Paris", "provider": {"id": 21, "name": "P"}, "owner": {"id": 22, "name": "O"},
    "datetimeFirst": {"utc": "2019-05-04T03:00:00Z"}, "datetimeLast": {"utc": "2024-02-03T01:00:00Z"},
    "sensors": [sensor(81, 1, "pm25"), sensor(82, 2, "pm10"), sensor(83, 3, "no2"), sensor(84, 9, "co")],
}
GONE = object()


def item(**changes):
    changed = {**copy.deepcopy(ITEM), **changes}
    return {k: v for k, v in changed.items() if v is not GONE}


def parsed(spark, *items):
    page = json.dumps({"results": list(items), "meta": {"found": len(items)}})
    return pl.parse_catalogue(spark.createDataFrame([(page,)], "payload string"))


@pytest.mark.parametrize("change,reason", [
    ({}, None),
    ({"isMobile": True}, "mobile"),
    ({"isMobile": GONE}, "mobile"),
    ({"isMobile": None}, None),
    ({"isMonitor": False}, "not_monitor"),
    ({"isMonitor": GONE}, "not_monitor"),
    ({"isMonitor": None}, "not_monitor"),
    ({"coordinates": {}}, "no_coords"),
    ({"coordinates": GONE}, "no_coords"),
    ({"coordinates": {"latitude": 1.0}}, "no_coords"),
    ({"sensors": [sensor(1, 9, "co")]}, "no_target_pollutant"),
    ({"sensors": GONE}, "no_target_pollutant"),
    ({"isMobile": True, "sensors": GONE}, "mobile"),
])
def test_selection(spark, change, reason):
    kept, reasons = cat.select_stations(parsed(spark, item(**change)))
    assert kept.count() == (reason is None)
    assert [tuple(r) for r in reasons.collect()] == ([] if reason is None else [(reason, 1)])


def test_station_rows(spark):
    kept, _ = cat.select_stations(parsed(spark, item(), item(id=9, isMobile=True)))
    df = cat.build_station_rows(kept, INGESTED)
    assert df.columns == STATIONS.fieldNames()
    [row] = df.collect()
    assert (row.station_id, row.openaq_location_id, row.station_name) == ("openaq:8", 8, "Old Harbour")
    assert (row.country_code, row.latitude, row.provider_name, row.owner_id) == ("FR", 43.6, "P", 22)
    assert (row.pollutants_available, row.sensor_count) == ("no2,pm10,pm25", 4)
    assert row.is_mobile is False and row.is_monitor is True
    assert row.datetime_first_utc == datetime(2019, 5, 4, 3) and row.loaded_at == datetime(2024, 1, 15, 10, 5)
    assert json.loads(row.raw_json) == ITEM


def test_station_rows_with_missing_objects(spark):
    bare = parsed(spark, {"id": 7, "name": "bare"})
    [row] = cat.build_station_rows(bare, INGESTED).collect()
    assert row.country_code is None and row.latitude is None and row.provider_name is None
    assert row.datetime_first_utc is None and row.sensor_count == 0 and row.pollutants_available == ""


def test_sensor_rows(spark):
    df = cat.build_sensor_rows(parsed(spark, item()), INGESTED)
    assert df.columns == SENSORS.fieldNames()
    rows = {r.openaq_sensor_id: r for r in df.collect()}
    assert set(rows) == {81, 82, 83}
    assert (rows[81].station_id, rows[81].parameter_id, rows[81].parameter_name) == ("openaq:8", 1, "pm25")
    assert (rows[81].parameter_display_name, rows[81].parameter_units) == ("PM25", "µg/m³")


def test_summary(spark):
    five = [sensor(i, i, n) for i, n in enumerate(("pm25", "pm10", "o3", "no2", "so2"))]
    kept, _ = cat.select_stations(parsed(
        spark, item(id=1, sensors=five), item(id=2, sensors=five[:4]),
        item(id=3, sensors=[sensor(9, 1, "pm25", "ppm")], coordinates={"latitude": 43.5, "longitude": 5.6}),
    ))
    stations, sensors = cat.build_station_rows(kept, INGESTED), cat.build_sensor_rows(kept, INGESTED)
    rows = {(r.metric, r.item): (r.stations_or_sensors, r.needs_conversion)
            for r in cat.catalogue_summary(stations, sensors).collect()}
    assert rows == {
        ("stations", "total"): (3, None), ("stations", "all_pollutants"): (1, None),
        ("stations", "four_or_more"): (2, None), ("stations", "in_box"): (2, None),
        ("stations_with", "pm25"): (3, None), ("stations_with", "pm10"): (2, None), ("stations_with", "o3"): (2, None),
        ("stations_with", "no2"): (2, None), ("stations_with", "so2"): (1, None), ("sensors", "total"): (10, None),
        ("sensors_of", "pm25"): (3, True), ("sensors_of", "pm10"): (2, False), ("sensors_of", "o3"): (2, False),
        ("sensors_of", "no2"): (2, False), ("sensors_of", "so2"): (1, False),
    }
    assert {r.station_id for r in cat.subset_stations(stations).collect()} == {"openaq:1", "openaq:2"}
    empty = cat.catalogue_summary(stations.filter(F.lit(False)), sensors.filter(F.lit(False))).collect()
    assert {(r.item, r.stations_or_sensors) for r in empty if r.metric == "stations_with"} == {
        (p, 0) for p in ("pm25", "pm10", "o3", "no2", "so2")}


def test_forecast_hours_carry_their_own_values_and_times_are_read_once(spark):
    batches = spark.createDataFrame(
        [('{"latitude":1.0,"hourly":{"time":["2024-01-15T10:00"],"cloud_cover":[1.0,2.0]}}',
          [("s", 1.0, 2.0)], datetime(2024, 1, 15), "r")], pl.LANDED_FORECASTS)
    rows = pl.flatten_forecast_batch(batches, F.col("ingested_at"), F.col("run_id"))
    assert [(r.cloud_cover, r.temperature_2m, r.dedup_key) for r in rows.collect()] == [(1.0, None, "s|2024-01-15T10:00:00+00:00")]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "hourly#" not in plan and plan.count("as timestamp)") == 1


def test_landed_files_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pl, "LANDED_ROWS", 3)
    ids = spark.range(0, 10, 1, 2).withColumnRenamed("id", "openaq_sensor_id")
    requests = ids.selectExpr(
        "openaq_sensor_id", "repeat('{}', 500) AS payload", "timestamp'2024-01-15 01:02:03.000004' AS ingested_at",
        "'r' AS run_id", "timestamp'2024-01-15' AS window_end")
    pl.write_landed(requests, str(tmp_path / "landing"))
    files = list((tmp_path / "landing").glob("part-*"))
    assert len(files) == 4 and all(f.suffix == ".lz4" and f.stat().st_size < 1000 for f in files)
    landed = pl.read_landed(spark, str(tmp_path / "landing"), pl.LANDED_READINGS)
    assert sorted(landed.collect()) == sorted(requests.collect())


@pytest.mark.parametrize("payload, failed", [('{"hourly":{"time":["2024-01-15T10:00"]}}', 0), ("no answer", 1)])
def test_answers_are_read_again_only_where_one_is_unreadable(spark, tmp_path, monkeypatch, payload, failed):
    asked = []
    outcomes = ingest.forecast_outcomes
    monkeypatch.setattr(ingest, "forecast_outcomes", lambda *args: asked.append(args[2]) or outcomes(*args))
    good = '{"hourly":{"time":["2024-01-15T11:00"]}}'
    batches = spark.createDataFrame(
        [(p, [(s, 1.0, 2.0)], None, None) for p, s in ((good, "a"), (payload, "b"))], pl.LANDED_FORECASTS)
    target, log = tables.forecasts_table(str(tmp_path / "f")), tables.run_log_table(str(tmp_path / "log"))
    row = ingest.ingest_forecasts(spark, batches, target, log, "r", INGESTED)
    assert asked == [not failed]
    assert (row["records_written"], row["stations_polled"], row["stations_failed"]) == (2 - failed, 2, failed)
    assert "json" not in outcomes(batches, "r", True)._jdf.queryExecution().optimizedPlan().toString()


def test_rejected_readings_never_meet_the_lookup(spark):
    page = pages(spark, json.dumps({"results": [HOUR, hour(value=None), hour(period__datetimeTo=LATE)]}))
    rows = pl.flatten_hourly_readings(page, worklist(spark), INGESTED, "r", END)
    assert [r.dedup_key for r in rows.collect()] == ["77|2024-01-15T08:00:00Z"]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("Filter CASE WHEN broken")  # the filter is below the join
    assert plan.count("datetimeFrom.utc as timestamp)") == plan.count("datetimeTo.utc as timestamp)") == 1
