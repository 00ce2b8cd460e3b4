"""The checks, and the suite of view assertions run as one report."""

import fixture as fx
from fixture import NOW, at
import pytest
from pyspark.sql import functions as F

from gaugelake.operators import forecasts as fc
from gaugelake.operators import quality as dq
from gaugelake.operators import readings as rd
from gaugelake.operators import runs


def rows_of(df):
    assert tuple(df.columns) == dq.VIOLATION_COLUMNS
    return {r.entity_id: (r.expected_value, r.actual_value) for r in df.collect()}


def test_each_check_reports_violations(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 1, 1.0), ("b", 2, None), ("c", None, 3.0)], "k string, n int, v double")
    assert rows_of(dq.assert_unique(df, ["k", "n"], "t")) == {"a:1": ("1", "2")}
    assert rows_of(dq.assert_row_count(df, ["k"], 2, "t")) == {"b": ("2", "1"), "c": ("2", "1")}
    assert rows_of(dq.assert_null(df, ["n"], ["k"], "t", F.col("k") != "a")) == {"b": ("n=NULL", "n:2")}
    entities = spark.createDataFrame([("a",), ("b",), ("z",)], "k string")
    assert rows_of(dq.assert_not_null(df, ["n", "v"], ["k"], "t", entities)) == {
        "b": ("not NULL", "n:2,v:NULL"), "z": ("not NULL", "missing")}
    assert set(rows_of(dq.assert_not_null(df, ["n"], ["k"], "t"))) == {"c"}
    assert rows_of(dq.assert_no_rows(df, F.col("v") > 2, ["k"], "t")) == {"c": ("no rows", "present")}
    assert set(rows_of(dq.assert_members(df, "k", ["a", "b"], "t"))) == {"c"}


def test_expected_values(spark):
    df = spark.createDataFrame([("a", 1.0, "x"), ("b", 2.0, "y"), ("c", None, "z")], "k string, v double, s string")

    def failing(tolerance, *expected):
        want = spark.createDataFrame(list(expected), "k string, v double, s string")
        return set(rows_of(dq.assert_expected(df, want, ["k"], "t", tolerance)))

    assert failing(None, ("a", 1.0, "x"), ("c", None, "z")) == set()
    assert failing(None, ("a", 1.005, "x")) == {"a"}
    assert failing(0.01, ("a", 1.005, "x"), ("b", 2.02, "y")) == {"b"}
    assert failing(0.01, ("a", 1.0, "other"), ("c", 0.0, "z"), ("d", 1.0, "x")) == {"a", "c", "d"}
    assert failing(0.01, ("b", None, "y")) == {"b"}


def view_checks(spark, readings=None):
    raw = fx.readings(spark) if readings is None else readings
    weather, stations, log = fx.forecasts(spark), fx.stations(spark), fx.run_log(spark)
    clean, clean_weather = rd.dedup_latest_readings(raw), fc.dedup_latest_forecasts(weather)
    latest = rd.station_latest_pollutants(raw, stations)
    wide = rd.station_hourly_wide(raw)
    outlook = fc.station_current_outlook(raw, weather, stations)
    dispersion = fc.station_dispersion_outlook(raw, weather, stations, NOW)
    fresh = rd.station_freshness(raw, stations, NOW)
    overview = runs.ingestion_overview(log, NOW)

    def want(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    hour = "station_id string, hour_utc timestamp, pm25_value double, pm10_value double, no2_value double"
    return {
        "readings_unique": dq.assert_unique(clean, ["openaq_sensor_id", "period_from_utc"], "readings_unique"),
        "forecasts_unique": dq.assert_unique(clean_weather, ["station_id", "valid_time"], "forecasts_unique"),
        "latest_unique": dq.assert_unique(latest, ["station_id"], "latest_unique"),
        "wide_unique": dq.assert_unique(wide, ["station_id", "hour_utc"], "wide_unique"),
        "outlook_unique": dq.assert_unique(outlook, ["station_id"], "outlook_unique"),
        "freshness_unique": dq.assert_unique(fresh, ["station_id"], "freshness_unique"),
        "overview_unique": dq.assert_unique(overview, ["source"], "overview_unique"),
        "wide_values": dq.assert_expected(wide, want(hour, ("station_a", at(10), 22.0, 30.0, 45.0)), ["station_id", "hour_utc"], "wide_values"),
        "wide_missing": dq.assert_null(wide, ["pm10_value", "no2_value"], ["station_id", "hour_utc"], "wide_missing",
                                       (F.col("station_id") == "station_b") & (F.hour("hour_utc") == 8)),
        "outlook_values": dq.assert_expected(
            outlook, want("station_id string, avg_temperature_2m double, total_precipitation double, max_wind_speed_10m double",
                          ("station_a", 12.0, 6.0, 7.0)), ["station_id"], "outlook_values", 0.1),
        "outlook_members": dq.assert_members(outlook, "station_id", ["station_a", "station_b"], "outlook_members"),
        "metadata_present": dq.assert_not_null(latest, ["station_name", "locality", "latitude"], ["station_id"], "metadata_present",
                                               stations.filter("station_id != 'station_c'")),
        "only_future": dq.assert_no_rows(dispersion, F.col("valid_time") <= F.lit(NOW), ["station_id", "valid_time"], "only_future"),
        "three_hours": dq.assert_row_count(dispersion.filter("station_id = 'station_a'"), ["station_id"], 3, "three_hours"),
        "flags": dq.assert_expected(fresh, want("station_id string, is_data_stale boolean, is_ingestion_stale boolean, hours_since_data bigint",
                                                ("station_a", True, False, 4)), ["station_id"], "flags"),
        "day": dq.assert_expected(overview, want("source string, runs_24h bigint, total_records_24h bigint",
                                                 ("openaq", 2, 500), ("open-meteo", 1, 96)), ["source"], "day"),
    }


def test_view_suite_passes_as_one_report(spark):
    report = dq.run_checks(spark, view_checks(spark))
    assert len(report) == 16
    assert {r["status"] for r in report} == {"passed"}


def test_report_of_failures_and_errors(spark):
    many = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    checks = {
        "a_fails": dq.assert_no_rows(many, F.lit(True), ["k"], "a_fails"),
        "b_breaks": lambda: dq.assert_unique(many, ["no_such_column"], "b_breaks"),
        "c_passes": dq.assert_unique(many, ["k"], "c_passes"),
    }
    report = dq.dq_report(spark, checks)
    rows = {r.test_name: r for r in report.collect()}
    assert [rows[n].status for n in sorted(rows)] == ["failed", "error", "passed"]
    assert rows["a_fails"].violations == 1000 and len(rows["a_fails"].samples) == 5
    assert "no_such_column" in rows["b_breaks"].error_message
    totals = dq.dq_totals(report).first()
    assert (totals.tests_total, totals.passed, totals.failed, totals.errors, totals.status) == (3, 1, 1, 1, "failed")
    assert [r["test_name"] for r in dq.run_checks(spark, checks, only="c_*")] == ["c_passes"]
    assert [r["status"] for r in dq.run_checks(spark, checks, stop_on_first_failure=True)] == ["failed"]
    assert {r["status"] for r in dq.run_checks(spark, {"b_breaks": checks["b_breaks"]})} == {"error"}


@pytest.mark.parametrize("n", [1, 2, 5, 6, 40])
def test_samples_are_the_first_violations_duplicates_included(spark, n):
    df = spark.createDataFrame([(f"k{i // 2:02}",) for i in range(n)], "k string")
    checks = {f"check_{i}": dq.assert_no_rows(df, F.lit(True), ["k"], f"check_{i}") for i in range(4)}
    for row in dq.dq_report(spark, checks).collect():
        assert row.violations == n
        assert [s.entity_id for s in row.samples] == [f"k{i // 2:02}" for i in range(min(5, n))]


def test_runtime_error_lands_on_its_check(spark):
    df = spark.createDataFrame([("1",), ("x",)], "k string")
    checks = {
        "bad_cast": dq.assert_no_rows(df, F.col("k").cast("int") > 5, ["k"], "bad_cast"),
        "fine": dq.assert_unique(df, ["k"], "fine"),
    }
    assert {r["test_name"]: r["status"] for r in dq.run_checks(spark, checks)} == {"bad_cast": "error", "fine": "passed"}


def test_checks_of_one_table_take_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, None if i % 3 else float(i), "ppm" if i % 4 else "x") for i in range(200)]
    spark.createDataFrame(rows, "id long, value double, unit string").repartition(4).write.parquet(path)
    df = spark.read.parquet(path)
    checks = [
        dq.null_check(["value"], ["id"], "null"),
        dq.not_null_check(["value"], ["id"], "not_null"),
        dq.members_check("unit", ["ppm"], "unit", ["id"]),
        dq.no_rows_check(F.col("id") > 500, ["id"], "large"),
        dq.members_check("none", [1], "broken"),
    ]
    report = dq.dq_report(spark, {}, tables=[(lambda: df, checks)])
    plan = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1
    found = {r.test_name: r for r in report.collect()}
    assert {n: (r.status, r.violations) for n, r in found.items()} == {
        "null": ("failed", 67), "not_null": ("failed", 133), "unit": ("failed", 50), "large": ("passed", 0), "broken": ("error", 0)}
    # The first five as text, whatever task they came from.
    assert [v.entity_id for v in found["null"].samples] == sorted(str(i) for i in range(0, 200, 3))[:5]
    assert "none" in found["broken"].error_message and found["large"].samples is None
    only = dq.dq_report(spark, {}, "nu*", tables=[(df, checks)]).collect()
    assert [r.test_name for r in only] == ["null"]
    with pytest.raises(ValueError, match="one name"):
        dq.dq_report(spark, {"null": dq.assert_null(df, ["value"], ["id"], "null")}, tables=[(df, checks)])
