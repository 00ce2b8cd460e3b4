"""Run log, run summaries and the request audit (against brute force)."""

import random
from collections import Counter
from datetime import datetime, timedelta

import fixture as fx
import pytest
from fixture import NOW, at
from pyspark.sql import functions as F

from gaugelake.operators import runs
from gaugelake.schemas import RUN_LOG


def test_overview(spark):
    found = {r.source: r for r in runs.ingestion_overview(fx.run_log(spark), NOW).collect()}
    assert set(found) == {"openaq", "open-meteo"}
    a, w = found["openaq"], found["open-meteo"]
    assert (a.latest_run_id, a.latest_run_status, a.latest_run_records_written) == ("run_1", "success", 500)
    assert a.latest_run_started_at == datetime(2026, 3, 22, 10) and a.latest_run_error_message is None
    assert (a.runs_24h, a.successes_24h, a.errors_24h, a.partials_24h, a.total_records_24h) == (2, 1, 1, 0, 500)
    assert (a.total_api_calls_24h, a.total_api_errors_24h) == (11, 1)
    assert (w.latest_run_id, w.runs_24h, w.total_records_24h) == ("weather_run_1", 1, 96)


def test_overview_day_is_strict_and_zero_filled(spark):
    [row] = runs.ingestion_overview(fx.run_log(spark).filter("run_id = 'run_1'"), at(10, day=23)).collect()
    assert (row.runs_24h, row.total_records_24h, row.latest_run_id) == (0, 0, "run_1")
    [row] = runs.ingestion_overview(fx.run_log(spark).filter("run_id = 'run_1'"), at(9, 59, 23)).collect()
    assert row.runs_24h == 1


def test_source_freshness(spark):
    found = {r.source: r for r in runs.source_freshness(fx.run_log(spark), at(11, 30)).collect()}
    assert found["openaq"].minutes_since_last_success == 85.0 and found["openaq"].freshness_band == "green"
    later = {r.source: r for r in runs.source_freshness(fx.run_log(spark), NOW).collect()}
    assert later["openaq"].minutes_since_last_success == 235.0 and later["openaq"].freshness_band == "yellow"
    failed = fx.run_log(spark).filter("status = 'error'")
    [row] = runs.source_freshness(failed, NOW).collect()
    assert row.minutes_since_last_success is None and row.freshness_band == "red" and row.status == "error"


def test_daily_stats(spark):
    rows = [(str(r.run_date), r.source, r.total_records, r.successes, r.errors)
            for r in runs.daily_ingestion_stats(fx.run_log(spark)).collect()]
    assert rows == [("2026-03-22", "open-meteo", 96, 1, 0), ("2026-03-22", "openaq", 500, 1, 1),
                    ("2026-03-21", "openaq", 400, 1, 0)]
    assert runs.daily_ingestion_stats(fx.run_log(spark), 1).count() == 1


def outcomes(spark, *rows):
    return spark.createDataFrame(list(rows), "run_id string, openaq_sensor_id bigint, ok boolean")


def test_run_summary_status_precedence(spark):
    rows = fx.frame(spark, [
        fx.reading("a", 1, 11, "pm25", 9, 1.0, run="good"), fx.reading("a", 1, 11, "pm25", 8, 1.0, run="good"),
        fx.reading("b", 1, 12, "pm25", 9, 1.0, run="partial"),
        fx.reading("b", 1, 12, "pm25", 9, 1.0, run="unwritten"),
    ], fx.readings(spark).schema)
    asked = outcomes(spark, ("good", 11, True), ("partial", 12, True), ("partial", 9, False), ("partial", 13, None),
                     ("all_failed", 11, False), ("nothing", 11, True), ("unwritten", 12, True), ("crashed", 1, True))
    broken = spark.createDataFrame([("unwritten", None, "W: no space"), ("crashed", "E: boom", "W: later"),
                                    ("never_started", "E: config", None), ("good", None, None)],
                                   "run_id string, unhandled_error string, write_error string")
    found = {r.run_id: r for r in runs.run_summary(rows, asked, broken).collect()}
    assert {k: r.status for k, r in found.items()} == {
        "good": "success", "partial": "partial_success", "all_failed": "empty", "nothing": "empty",
        "unwritten": "error", "crashed": "error", "never_started": "error"}
    good, partial = found["good"], found["partial"]
    assert (good.record_count, good.stations_with_data, good.sensors_with_data, good.failed_ids) == (2, 1, 1, None)
    assert (good.data_timestamp_min.hour, good.data_timestamp_max.hour) == (8, 9)
    assert (partial.units_queried, partial.units_failed, partial.api_calls, partial.api_errors) == (3, 2, 1, 2)
    assert partial.failed_ids == '["13","9"]'
    assert found["crashed"].error_message == "E: boom" and found["unwritten"].error_message == "W: no space"
    assert found["unwritten"].record_count == 0


def test_requests_for_several_stations_count_once(spark):
    asked = spark.createDataFrame(
        [("r", ["a", "b", "c"], True), ("r", ["d", "e"], False), ("s", ["a"], None), ("t", [], False)],
        "run_id string, station_id array<string>, ok boolean",
    )
    rows = fx.frame(spark, [fx.reading("a", 1, 11, "pm25", 9, 1.0, run="r")], fx.readings(spark).schema)
    found = {r.run_id: r for r in runs.run_summary(rows, asked, unit_column="station_id").collect()}
    r = found["r"]
    assert (r.api_calls, r.api_errors, r.units_queried, r.units_failed) == (1, 1, 5, 2)
    assert r.failed_ids == '["d","e"]' and r.status == "partial_success"
    assert (found["s"].api_calls, found["s"].api_errors, found["s"].failed_ids) == (0, 1, '["a"]')
    assert (found["t"].api_calls, found["t"].api_errors, found["t"].units_queried) == (0, 1, 0)


def test_run_log_row(spark):
    summary = runs.run_summary(fx.readings(spark), outcomes(spark, ("run_1", 101, True), ("run_1", 9, False)))
    start, end = F.lit("2026-03-22 10:00:00").cast("timestamp"), F.lit("2026-03-22 10:30:00.5").cast("timestamp")
    df = runs.run_log_row(summary, "openaq", start, end, window_start=start, window_end=end)
    assert df.columns == RUN_LOG.fieldNames()
    row = df.filter("run_id = 'run_1'").first()
    assert (row.duration_seconds, row.records_written, row.status) == (1800.5, 14, "partial_success")
    assert (row.sensors_queried, row.sensors_failed, row.failed_sensor_ids) == (2, 1, '["9"]')
    assert row.stations_polled is None and row.failed_station_ids is None
    assert row.ingested_at == row.run_finished_at and row.window_start_utc == datetime(2026, 3, 22, 10)
    twin = runs.run_log_row(summary, "open-meteo", start, end, by_station=True).filter("run_id = 'run_1'").first()
    assert (twin.stations_polled, twin.stations_failed, twin.failed_station_ids) == (2, 1, '["9"]')
    assert twin.sensors_queried is None and twin.window_start_utc is None


def brute_force(times, window_us, bucket_us):
    times = sorted(times)
    peak = max(sum(1 for u in times if t - window_us < u <= t) for t in times)
    gap = max((b - a for a, b in zip(times, times[1:])), default=0) / 1e6
    counts = Counter((t - times[0]) // bucket_us for t in times)
    return peak, gap, [counts.get(i, 0) for i in range((times[-1] - times[0]) // bucket_us + 1)]


@pytest.mark.parametrize("seed", range(6))
def test_audit_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    base = datetime(2024, 1, 1, 23, 59, 50)
    runs_of = {}
    for run in range(4):
        n = rng.choice([1, 2, 40, 120])
        spread = rng.choice([1, 3_000_000, 90_000_000, 4_000_000_000])
        grain = rng.choice([1, 500_000, 1_000_000])
        runs_of[f"r{run}"] = [rng.randrange(spread) // grain * grain for _ in range(n)]
    rows = [(r, base + timedelta(microseconds=t), rng.choice([200, 429, 500, None])) for r, ts in runs_of.items() for t in ts]
    df = spark.createDataFrame(rows, "run_id string, started_at timestamp, status_code int")
    audit = {r.run_id: r for r in runs.request_rate_audit(df, ["run_id"]).collect()}
    timeline = {}
    for r in runs.request_timeline(df, ["run_id"]).orderBy("run_id", "bucket").collect():
        timeline.setdefault(r.run_id, []).append(r.requests)
    for run, times in runs_of.items():
        peak, gap, buckets = brute_force(times, 60_000_000, 10_000_000)
        assert (audit[run].max_requests_in_window, audit[run].longest_gap_seconds) == (peak, gap)
        assert timeline[run] == buckets
        codes = [c for r, _, c in rows if r == run]
        assert audit[run].total_requests == len(codes)
        assert audit[run].status_200 == codes.count(200) and audit[run].status_429 == codes.count(429)
        assert audit[run].other_errors == codes.count(500) + codes.count(None)
    labels = {(r.run_id, r.status): r.requests for r in runs.request_status_breakdown(df, ["run_id"]).collect()}
    assert labels == Counter((r, "error" if c is None else str(c)) for r, _, c in rows)


def test_window_is_strictly_shorter_than_its_length(spark):
    times = [datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 1), datetime(2024, 1, 1, 0, 1, 59, 999999)]
    df = spark.createDataFrame([("r", t, 200) for t in times], "run_id string, started_at timestamp, status_code int")
    [row] = runs.request_rate_audit(df, ["run_id"]).collect()
    assert row.max_requests_in_window == 2


def test_a_run_of_ten_years(spark, monkeypatch):
    monkeypatch.setattr(runs, "_BUCKETS_AT_ONCE", 1000)
    rng, start = random.Random(9), datetime(2014, 1, 1)
    seconds = 10 * 365 * 86_400
    times = sorted({0, seconds, *(rng.randrange(seconds) for _ in range(1500)), *(5_000_000 + i * 7 for i in range(400))})
    df = spark.createDataFrame([("r", start + timedelta(seconds=t), 200) for t in times], "run_id string, started_at timestamp, status_code int")
    peak, gap, buckets = brute_force([t * 1_000_000 for t in times], 60_000_000, 3_600_000_000)
    [row] = runs.request_rate_audit(df, ["run_id"]).collect()
    assert (row.max_requests_in_window, row.longest_gap_seconds) == (peak, gap)
    timeline = runs.request_timeline(df, ["run_id"], bucket_seconds=3600)
    assert [r.requests for r in timeline.orderBy("bucket").collect()] == buckets and len(buckets) > 80_000
    # The spans of the run, not its seconds, meet in one task.
    spans = {t // runs._SPAN_SECONDS for t in times} | {(t + 60) // runs._SPAN_SECONDS for t in times}
    assert len(spans) < seconds / 1000
