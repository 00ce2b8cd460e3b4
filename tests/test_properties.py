"""Properties: dedup is idempotent and order-insensitive, both modes agree, flatten inverts packing."""

import json
import random
from datetime import UTC, datetime, timedelta

import fixture as fx
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugelake.operators import forecasts as fc
from gaugelake.operators import readings as rd
from gaugelake.schemas import FORECASTS, READINGS
from gaugelake.sources import payloads as pl

DAY = datetime(2026, 3, 22, tzinfo=UTC)
few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

version = st.tuples(
    st.integers(0, 2),  # station
    st.sampled_from(["pm25", "pm10", "no2", "o3"]),
    st.integers(0, 4),  # hour
    st.integers(0, 3),  # ingest hour
    st.one_of(st.none(), st.sampled_from([0.0, 1.0, 2.5])),
    st.sampled_from(["r1", "r2"]),
)


def reading_rows(versions):
    codes = {"pm25": 1, "pm10": 2, "no2": 3, "o3": 4}
    return [
        fx.reading(f"s{s}", s, s * 10 + codes[p], p, h, v, DAY + timedelta(hours=i), run)
        for s, p, h, i, v, run in versions
    ]


def texts(df):
    return sorted(map(str, df.collect()))


@few
@given(st.lists(version, min_size=1, max_size=40), st.randoms(use_true_random=False))
def test_dedup_readings(spark, versions, rng):
    rows = reading_rows(versions)
    shuffled = rng.sample(rows, len(rows)) + rng.sample(rows, len(rows) // 2)
    once = rd.dedup_latest_readings(fx.frame(spark, rows, READINGS))
    assert texts(once) == texts(rd.dedup_latest_readings(once))
    assert texts(once) == texts(rd.dedup_latest_readings(fx.frame(spark, shuffled, READINGS).repartition(5)))
    assert texts(once) == texts(rd.dedup_latest_readings(fx.frame(spark, shuffled, READINGS), stable_key=True))
    newest = {}
    for r in rows:
        newest[r["dedup_key"]] = max(newest.get(r["dedup_key"], DAY), r["ingested_at"])
    assert {r.dedup_key: r.ingested_at for r in once.collect()} == {k: v.replace(tzinfo=None) for k, v in newest.items()}


@few
@given(st.lists(version, min_size=1, max_size=40))
def test_views_agree_in_both_modes(spark, versions):
    df = fx.frame(spark, reading_rows(versions), READINGS).repartition(4)
    weather = fx.forecasts(spark)
    for view in (
        lambda k: rd.station_latest_pollutants(df, None, stable_key=k),
        lambda k: rd.station_hourly_wide(df, stable_key=k),
        lambda k: rd.newest_reading_times(df, stable_key=k),
        lambda k: fc.station_hourly_combined(df, weather, stable_key=k),
    ):
        assert texts(view(False)) == texts(view(True))


@few
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 30), st.integers(0, 20), st.integers(0, 90)), min_size=1, max_size=60))
def test_forecast_window_matches_its_definition(spark, versions):
    rows = [
        {**fx.forecast(f"s{s}", 0, [v] * 8, DAY + timedelta(hours=i)), "valid_time": DAY + timedelta(hours=h), "run_id": f"r{v}"}
        for s, h, i, v in versions
    ]
    found = {r.station_id: (r.latest_weather_ingested_at, r.forecast_hours_count, r.total_precipitation)
             for r in fc.forecast_window(fx.frame(spark, rows, FORECASTS)).collect()}
    expected = {}
    for station in {r["station_id"] for r in rows}:
        own = [r for r in rows if r["station_id"] == station]
        t = max(r["ingested_at"] for r in own)
        current = {}
        for r in own:
            best = current.get(r["valid_time"])
            if best is None or (r["ingested_at"], r["run_id"]) > (best["ingested_at"], best["run_id"]):
                current[r["valid_time"]] = r
        inside = [r["precipitation"] for h, r in current.items() if t < h <= t + timedelta(hours=3)]
        expected[station] = (t.replace(tzinfo=None), len(inside), sum(inside) if inside else None)
    assert found == expected


def test_flatten_inverts_packing(spark):
    rng = random.Random(3)
    rows = {}
    for _ in range(60):
        sensor, hour = rng.randrange(5), rng.randrange(40)
        rows[sensor, hour] = round(rng.uniform(0, 90), 3)

    def text(hour):
        return (DAY + timedelta(hours=hour)).strftime("%Y-%m-%dT%H:%M:%SZ")

    pages = {}
    for (sensor, hour), value in rows.items():
        pages.setdefault((sensor, hour % 3), []).append({
            "period": {"datetimeFrom": {"utc": text(hour)}, "datetimeTo": {"utc": text(hour + 1)}}, "coverage": {}, "value": value})
    landed = spark.createDataFrame(
        [(s, json.dumps({"results": items})) for (s, _), items in pages.items()], "openaq_sensor_id bigint, payload string")
    sensors = spark.range(5).select(
        F.col("id").alias("openaq_sensor_id"), F.concat(F.lit("st"), "id").alias("station_id"),
        F.col("id").alias("openaq_location_id"), F.lit("pm25").alias("pollutant"), F.lit("u").alias("unit"))
    flat = pl.flatten_hourly_readings(landed, sensors, DAY, "r", DAY + timedelta(hours=100))
    back = {(r.openaq_sensor_id, int((r.period_from_utc - DAY.replace(tzinfo=None)).total_seconds() // 3600)): r.value for r in flat.collect()}
    assert back == rows
