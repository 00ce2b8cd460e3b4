"""The views under their SQL names, queried the way the dashboard queries them."""

import fixture as fx
import pytest
from fixture import NOW

from gaugelake.plans.views import fetch, register_views, views


@pytest.fixture(scope="module", autouse=True)
def registered(spark):
    register_views(spark, views(fx.readings(spark), fx.forecasts(spark), fx.stations(spark), fx.run_log(spark), NOW))


def test_dashboard_statements(spark):
    cards = spark.sql("SELECT source, status, records_written, duration_seconds, minutes_since_last_success FROM ingestion_freshness")
    assert {r.source for r in cards.collect()} == {"openaq", "open-meteo"}
    listed = spark.sql("SELECT DISTINCT station_id, station_name FROM eligible_stations ORDER BY station_name")
    assert [r.station_id for r in listed.collect()] == ["station_b", "station_a"]
    found = spark.sql("SELECT DISTINCT pollutant FROM hourly_combined WHERE station_id = 'station_b' ORDER BY pollutant")
    assert [r.pollutant for r in found.collect()] == ["no2", "pm10", "pm25"]
    series = spark.sql("""SELECT hour_utc, pollutant_value, temperature_2m, wind_speed_10m, boundary_layer_height
        FROM hourly_combined WHERE station_id = 'station_a' AND pollutant = 'pm25' ORDER BY hour_utc""")
    assert [r.pollutant_value for r in series.collect()] == [50.0, 15.0, 18.0, 22.0]
    daily = spark.sql("SELECT * FROM daily_ingestion_stats ORDER BY run_date DESC LIMIT 30")
    assert sorted(fetch(daily)["total_records"]) == [96, 400, 500]
    mapped = spark.sql("SELECT sf.* FROM station_freshness sf JOIN eligible_stations es ON sf.station_id = es.station_id")
    assert mapped.count() == 2


def test_all_views_can_be_counted(spark):
    counts = {name: spark.table(name).count() for name in views(
        fx.readings(spark), fx.forecasts(spark), fx.stations(spark), fx.run_log(spark), NOW)}
    assert counts["v_openaq_deduped"] == 14 and counts["v_weather_deduped"] == 14
    assert counts["v_station_dispersion_outlook"] == 5 and counts["v_ingestion_overview"] == 2
    assert all(counts.values())
    every = fetch(spark.table("v_openaq_deduped"))
    assert len(every) == spark.table("v_openaq_deduped").count() > 3
    with pytest.raises(ValueError, match="more than 3 rows"):
        fetch(spark.table("v_openaq_deduped"), 3)
