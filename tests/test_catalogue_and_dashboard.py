"""Catalogue queries and the two-source station page."""

import fixture as fx
from fixture import NOW, at

from gaugelake.operators import catalogue as cat
from gaugelake.operators import dashboard as dash
from gaugelake.schemas import SENSORS, STATIONS, split_not_null


def metadata(spark):
    def row(station, name, pollutants, loaded, last=None, **extra):
        return {"station_id": station, "openaq_location_id": 1, "station_name": name, "loaded_at": loaded,
                "pollutants_available": pollutants, "datetime_last_utc": last, "latitude": 1.0, **extra}

    return fx.frame(spark, [
        row("gained", "old", "pm25", at(8)), row("gained", "Z", "no2,pm10,pm25", at(9)),
        row("lost", "old", "no2,pm10,pm25", at(8)), row("lost", "new", "no2,pm25", at(9)),
        row("tied", "early", "no2", at(9), at(1)), row("tied", "A", "NO2,PM10,PM25", at(9), at(2)),
        row("close", "x", "no2,pm10,pm255", at(9)), row("none", "x", None, at(9)),
        row("nowhere", "B", "no2,pm10,pm25", at(9), latitude=None),
    ], STATIONS)


def test_eligible_stations(spark):
    rows = [(r.station_id, r.station_name) for r in cat.eligible_stations(metadata(spark)).collect()]
    assert rows == [("tied", "A"), ("nowhere", "B"), ("gained", "Z")]
    assert cat.latest_station_metadata(metadata(spark)).count() == 6


def test_worklist(spark):
    extra = fx.frame(spark, [
        {"station_id": "c", "openaq_location_id": 3, "openaq_sensor_id": i, "parameter_name": p}
        for i, p in ((1, "pm25"), (2, "pm10"), (3, "pm10"), (4, "o3"))
    ], SENSORS)
    sensors = fx.sensors(spark).unionByName(extra)
    rows = cat.sensor_worklist(sensors).collect()
    assert [r.openaq_sensor_id for r in rows] == [103, 102, 101, 203, 202, 201]
    assert rows[0].asDict() == {"station_id": "station_a", "openaq_location_id": 1, "openaq_sensor_id": 103,
                                "pollutant": "no2", "unit": fx.UNIT}
    assert [r.openaq_sensor_id for r in cat.sensor_worklist(sensors, limit=2).collect()] == [103, 102]
    assert {r.station_id for r in cat.sensor_worklist(sensors, station_ids=["station_b"]).collect()} == {"station_b"}
    as_frame = spark.createDataFrame([("station_b",)], "station_id string")
    assert {r.station_id for r in cat.sensor_worklist(sensors, station_ids=as_frame).collect()} == {"station_b"}
    assert cat.sensor_worklist(sensors, ["pm25", "pm10"]).count() == 7


def test_locations(spark):
    assert [r.station_id for r in cat.station_locations(fx.stations(spark)).collect()] == ["station_a", "station_b", "station_c"]
    assert cat.station_locations(metadata(spark)).count() == 0


def test_not_null_contract(spark):
    broken = fx.frame(spark, [{"station_id": "a", "openaq_location_id": 1}, {"station_id": "b"}], STATIONS)
    good, bad = split_not_null(broken, STATIONS)
    assert [r.station_id for r in good.collect()] == ["a"] and [r.station_id for r in bad.collect()] == ["b"]


def test_two_source_freshness(spark):
    found = {r.station_id: r for r in dash.station_two_source_freshness(
        fx.readings(spark), fx.forecasts(spark), fx.stations(spark), at(10, 30)).collect()}
    assert set(found) == {"station_a", "station_b"}
    a, b = found["station_a"], found["station_b"]
    assert (a.openaq_age_hours, a.weather_age_hours, a.last_data_update_source) == (0.5, 0.5, "OpenAQ")
    assert (a.last_data_update_label, a.last_data_update_utc_label) == ("30m ago", "2026-03-22 10:00 UTC")
    assert a.severity_class == "green" and a.overall_stale is False
    assert b.weather_age_hours is None and b.weather_stale is False and b.last_data_update_source == "OpenAQ"
    late = {r.station_id: r for r in dash.station_two_source_freshness(
        fx.readings(spark), fx.forecasts(spark), fx.stations(spark), at(23)).collect()}
    assert late["station_a"].severity_class == "red" and late["station_b"].severity_class == "yellow"
    midday = {r.station_id: r for r in dash.station_two_source_freshness(
        fx.readings(spark), fx.forecasts(spark), fx.stations(spark), NOW).collect()}
    assert midday["station_a"].openaq_stale and not midday["station_a"].weather_stale


def test_station_without_any_data(spark):
    [row] = dash.station_two_source_freshness(
        fx.readings(spark).limit(0), fx.forecasts(spark).limit(0), fx.stations(spark).filter("station_id = 'station_b'"), NOW
    ).collect()
    assert row.last_data_update_label == "No data yet" and row.last_data_update_source == "No data"
    assert row.last_data_update_utc_label == "No data" and row.severity_class == "green"


def test_detail_and_center(spark):
    shown = dash.station_two_source_freshness(
        fx.readings(spark).filter("station_id = 'station_b'"), fx.forecasts(spark), fx.stations(spark), NOW)
    assert [r.station_id for r in dash.station_detail(shown).collect()] == ["station_b", "station_a"]
    center = dash.map_center(shown).first()
    assert abs(center.latitude - (53.1 + 54.05) / 2) < 1e-9
