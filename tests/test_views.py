"""Known values and boundaries of the station views, for both timestamp kinds and both dedup modes."""

from datetime import datetime

import fixture as fx
import pytest
from fixture import NOW, at
from pyspark.sql import functions as F

from gaugelake.operators import forecasts as fc
from gaugelake.operators import readings as rd
from gaugelake.schemas import FORECASTS, READINGS


def by(df, *keys):
    rows = df.collect()
    found = {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in rows}
    assert len(found) == len(rows), "keys are not unique"
    return found


def clock(ts):
    """Both timestamp kinds come back as naive datetimes of the UTC session."""
    return ts.replace(tzinfo=None)


@pytest.fixture(params=["timestamp", "timestamp_ntz"])
def ntz(request):
    return request.param == "timestamp_ntz"


@pytest.fixture(params=[False, True], ids=["any_key", "stable_key"])
def stable(request):
    return request.param


def test_dedup_readings_keeps_newest_version(spark, stable):
    rows = rd.dedup_latest_readings(fx.readings(spark), stable)
    assert rows.columns == READINGS.fieldNames()
    found = by(rows, "dedup_key")
    assert len(found) == 14
    assert [r.value for k, r in found.items() if k.startswith("101|") and "T10" in k] == [22.0]


def test_dedup_forecasts_keeps_newest_version(spark):
    rows = fc.dedup_latest_forecasts(fx.forecasts(spark))
    assert rows.columns == FORECASTS.fieldNames()
    found = by(rows, "station_id", "valid_time")
    assert len(found) == 14
    assert found["station_a", clock(at(11))].temperature_2m == 10.0


def test_dedup_does_not_assume_what_the_key_means(spark):
    """Without stable_key the newest version wins even if its station differs."""
    moved = fx.frame(spark, [
        fx.reading("station_a", 1, 7, "pm25", 9, 1.0, at(9), dedup_key="k"),
        fx.reading("station_b", 2, 7, "pm25", 9, 2.0, at(10), dedup_key="k"),
    ], READINGS)
    assert [r.station_id for r in rd.station_hourly_wide(moved).collect()] == ["station_b"]
    assert [r.station_id for r in rd.newest_reading_times(moved).collect()] == ["station_b"]
    assert [r.station_id for r in rd.station_latest_pollutants(moved, None).collect()] == ["station_b"]


def test_latest_pollutants(spark, ntz, stable):
    found = by(rd.station_latest_pollutants(fx.readings(spark, ntz), fx.stations(spark), stable_key=stable), "station_id")
    assert set(found) == {"station_a", "station_b"}
    a = found["station_a"]
    assert (a.pm25_value, a.pm10_value, a.no2_value) == (22.0, 30.0, 45.0)
    assert a.pm25_unit == fx.UNIT and clock(a.latest_reading_time) == clock(at(10))
    assert (a.station_name, a.locality, a.country_code, a.latitude, a.longitude) == (
        "Quay Street", "Aldport", "IE", 53.1, -6.25)


def test_latest_pollutants_two_sensors_and_missing_metadata(spark, stable):
    rows = fx.frame(spark, [
        fx.reading("x", 1, 1, "pm25", 9, 5.0),
        fx.reading("x", 1, 2, "pm25", 9, 4.0),
        fx.reading("x", 1, 2, "o3", 11, 4.0),
    ], READINGS)
    found = by(rd.station_latest_pollutants(rows, fx.stations(spark), stable_key=stable), "station_id")
    assert found["x"].pm25_value == 4.0 and found["x"].no2_value is None and found["x"].station_name is None
    assert clock(found["x"].latest_reading_time) == clock(at(9))


def test_hourly_wide(spark, ntz, stable):
    wide = rd.station_hourly_wide(fx.readings(spark, ntz), stable_key=stable)
    assert wide.columns == ["station_id", "hour_utc", "pm25_value", "pm25_unit", "pm10_value", "pm10_unit",
                            "no2_value", "no2_unit", "latest_ingested_at"]
    found = by(wide, "station_id", "hour_utc")
    assert len(found) == 7
    a = found["station_a", clock(at(10))]
    assert (a.pm25_value, a.pm10_value, a.no2_value) == (22.0, 30.0, 45.0)
    b = found["station_b", clock(at(8))]
    assert (b.pm25_value, b.pm10_value, b.no2_value, b.no2_unit) == (12.0, None, None, None)


def test_hourly_combined(spark, ntz, stable):
    both = fc.station_hourly_combined(fx.readings(spark, ntz), fx.forecasts(spark, ntz), stable_key=stable)
    assert both.columns == ["station_id", "hour_utc", "pm25_value", "pm10_value", "no2_value", "temperature_2m",
                            "relative_humidity_2m", "wind_speed_10m", "wind_direction_10m", "precipitation",
                            "cloud_cover", "boundary_layer_height"]
    found = by(both, "station_id", "hour_utc")
    a = found["station_a", clock(at(10))]
    assert (a.pm25_value, a.pm10_value, a.no2_value) == (22.0, 30.0, 45.0)
    assert (a.temperature_2m, a.wind_speed_10m, a.boundary_layer_height) == (9.0, 4.5, 550.0)
    early = found["station_a", clock(at(7))]
    assert early.pm25_value == 50.0 and early.temperature_2m is None and early.boundary_layer_height is None


def test_hourly_combined_keeps_a_row_per_location(spark, stable):
    rows = fx.frame(spark, [
        fx.reading("x", 1, 1, "pm25", 9, 5.0), fx.reading("x", 2, 2, "pm25", 9, 6.0),
    ], READINGS)
    both = fc.station_hourly_combined(rows, fx.forecasts(spark), stable_key=stable)
    assert sorted(r.pm25_value for r in both.collect()) == [5.0, 6.0]


def test_current_outlook(spark, ntz, stable):
    outlook = fc.station_current_outlook(
        fx.readings(spark, ntz), fx.forecasts(spark, ntz), fx.stations(spark), stable_key=stable)
    found = by(outlook, "station_id")
    assert set(found) == {"station_a", "station_b"}
    a = found["station_a"]
    assert (a.avg_temperature_2m, a.avg_relative_humidity_2m, a.avg_cloud_cover) == (12.0, 60.0, 30.0)
    assert (a.avg_boundary_layer_height, a.total_precipitation, a.max_wind_speed_10m) == (600.0, 6.0, 7.0)
    assert a.forecast_hours_count == 3 and clock(a.latest_weather_ingested_at) == clock(at(10))
    b = found["station_b"]
    assert b.forecast_hours_count == 0 and b.avg_temperature_2m is None and b.pm25_value == 16.0
    assert outlook.columns[-1] == "forecast_hours_count"


def test_outlook_window_is_open_closed_and_not_hour_aligned(spark):
    issue = at(10, 30)
    rows = fx.frame(spark, [fx.forecast("x", h, [h] * 8, issue) for h in (10, 11, 12, 13, 14)]
                    + [{**fx.forecast("x", 13, [50] * 8, issue), "valid_time": at(13, 30)},
                       {**fx.forecast("x", 13, [60] * 8, issue), "valid_time": at(13, 31)},
                       {**fx.forecast("x", 13, [70] * 8, issue), "valid_time": issue}], FORECASTS)
    [row] = fc.forecast_window(rows).collect()
    assert row.forecast_hours_count == 4 and row.max_wind_speed_10m == 50.0


def test_station_without_forecast_in_window_stays(spark):
    rows = fx.frame(spark, [fx.forecast("x", 1, [1] * 8, at(10))], FORECASTS)
    [row] = fc.forecast_window(rows).collect()
    assert row.forecast_hours_count == 0 and row.total_precipitation is None


def test_dispersion_outlook(spark, ntz, stable):
    outlook = fc.station_dispersion_outlook(
        fx.readings(spark, ntz), fx.forecasts(spark, ntz), fx.stations(spark), NOW, stable_key=stable)
    found = by(outlook, "station_id", "valid_time")
    assert {(s, t.hour) for s, t in found} == {
        ("station_a", 15), ("station_a", 16), ("station_a", 17), ("station_c", 15), ("station_c", 16)}
    expected = {15: (0.133, 0.12, 0.0, 0.095, "poor"), 16: (0.8, 0.6, 0.667, 0.697, "good"),
                17: (0.533, 0.32, 0.167, 0.367, "fair")}
    for hour, (blh, wind, rain, score, name) in expected.items():
        row = found["station_a", clock(at(hour))]
        assert row.blh_score == pytest.approx(blh, abs=0.01) and row.wind_score == pytest.approx(wind, abs=0.01)
        assert row.precip_score == pytest.approx(rain, abs=0.01)
        assert row.dispersion_score == pytest.approx(score, abs=0.01) and row.outlook_category == name
        assert row.latest_pm25 == 22.0 and row.station_name == "Quay Street"
    c = found["station_c", clock(at(16))]
    assert c.latest_pm25 is None and c.locality == "Cairnholt" and c.outlook_category == "fair"


def test_dispersion_null_weather_scores_zero(spark):
    rows = fx.frame(spark, [{**fx.forecast("x", 15, [1] * 8), "boundary_layer_height": None,
                             "wind_speed_10m": None, "precipitation": -4.0}], FORECASTS)
    [row] = fc.dispersion_scores(rows, NOW).collect()
    assert (row.blh_score, row.wind_score, row.precip_score, row.dispersion_score) == (0.0, 0.0, 0.0, 0.0)
    assert row.outlook_category == "poor"


def test_worst_outlook(spark):
    outlook = fc.station_dispersion_outlook(
        fx.readings(spark), fx.forecasts(spark), fx.stations(spark), "2026-03-22 14:00:00")
    found = by(fc.station_worst_outlook(outlook), "station_id")
    assert (found["station_a"].worst_category, found["station_a"].latest_pm25) == ("poor", 22.0)
    assert (found["station_c"].worst_category, found["station_c"].latest_pm25) == ("fair", None)


def test_freshness(spark, ntz, stable):
    found = by(rd.station_freshness(fx.readings(spark, ntz), fx.stations(spark), NOW, stable_key=stable), "station_id")
    a = found["station_a"]
    assert (a.hours_since_data, a.hours_since_ingestion) == (4, 4)
    assert a.is_data_stale is True and a.is_ingestion_stale is False
    later = by(rd.station_freshness(fx.readings(spark, ntz), fx.stations(spark), at(15, 59), stable_key=stable), "station_id")
    assert later["station_a"].hours_since_ingestion == 5 and later["station_a"].is_ingestion_stale is True


def test_duplicate_dimension_rows_fan_out(spark):
    twice = fx.stations(spark).unionByName(fx.stations(spark))
    assert rd.station_freshness(fx.readings(spark), twice, NOW).count() == 4
    outlook = fc.station_dispersion_outlook(fx.readings(spark), fx.forecasts(spark), twice, NOW)
    assert outlook.count() == 10


def test_long_form_and_series(spark):
    long = rd.unpivot_pollutants(fc.station_hourly_combined(fx.readings(spark), fx.forecasts(spark)))
    assert long.count() == 14
    assert [r.pollutant for r in rd.station_pollutants(long, "station_b").collect()] == ["no2", "pm10", "pm25"]
    since = datetime(2026, 3, 23, 8)  # one day back is exactly hour 8: included
    series = rd.station_time_series(long, "station_a", "pm25", 1, since).collect()
    assert [r.hour_utc.hour for r in series] == [8, 9, 10]
    assert series[0].temperature_2m is None and series[2].boundary_layer_height == 550.0
    assert rd.station_time_series(long, None, "pm25", 1, since).select("station_id").distinct().count() == 2


def test_reference_time_defaults_to_now(spark):
    rows = rd.station_freshness(fx.readings(spark), fx.stations(spark))
    now = spark.sql("SELECT current_timestamp() AS t").first().t
    expected = int(abs((now - clock(at(10))).total_seconds()) // 3600) * (1 if now > clock(at(10)) else -1)
    assert abs(rows.filter(F.col("station_id") == "station_a").first().hours_since_data - expected) <= 1
