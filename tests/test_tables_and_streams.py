"""Partitioned tables, whole ingest runs, and streams that must equal their batch twins."""

import json
from datetime import UTC, date, datetime, timedelta

import fixture as fx
import pytest
from pyspark.sql import functions as F

from gaugelake.operators.catalogue import sensor_worklist
from gaugelake.operators.forecasts import dedup_latest_forecasts
from gaugelake.operators.readings import dedup_latest_readings
from gaugelake.plans import ingest
from gaugelake.schemas import READINGS
from gaugelake.sources import payloads, tables
from gaugelake.streaming import ingest as streams

DAY = datetime(2024, 1, 15, tzinfo=UTC)


def rows(*hours, run="r1"):
    """Readings at the given hours after DAY."""
    return [
        {"ingested_at": DAY, "run_id": run, "station_id": f"s{h % 3}", "openaq_location_id": 1, "openaq_sensor_id": h % 3,
         "pollutant": "pm25", "value": float(h), "period_from_utc": DAY + timedelta(hours=h), "dedup_key": f"{h % 3}|{h}"}
        for h in hours
    ]


def values(df):
    return sorted(tuple(r) for r in df.select("value", "run_id").collect())


def test_append_and_pruned_read(spark, tmp_path):
    table = tables.readings_table(str(tmp_path / "t"))
    first = tables.append(fx.frame(spark, rows(0, 1, 30), READINGS), table)
    assert first["rows"] == 3 and first["last"].replace(tzinfo=None) == datetime(2024, 1, 16, 6)
    assert tables.append(fx.frame(spark, rows(50, run="r2"), READINGS), table)["rows"] == 1
    assert tables.append(fx.frame(spark, [], READINGS), table)["rows"] == 0
    df = tables.read_table(spark, table)
    assert df.columns == READINGS.fieldNames()
    assert values(df) == [(0.0, "r1"), (1.0, "r1"), (30.0, "r1"), (50.0, "r2")]
    later = tables.read_table(spark, table, since=DAY + timedelta(hours=1), until=DAY + timedelta(hours=30))
    assert values(later) == [(1.0, "r1"), (30.0, "r1")]
    plan = later._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p_date" in plan and "PushedFilters: [IsNotNull(period_from_utc)" in plan


def test_append_refuses_rows_without_required_values(spark, tmp_path):
    table = tables.readings_table(str(tmp_path / "t"))
    with pytest.raises(Exception, match="run_id is required"):
        tables.append(fx.frame(spark, [*rows(0, 1), {**rows(2)[0], "run_id": None}], READINGS), table)
    assert not list((tmp_path / "t").rglob("*.parquet"))
    assert tables.append(fx.frame(spark, [{**rows(2)[0], "value": None}], READINGS), table)["rows"] == 1


def test_rows_are_sorted_within_files(spark, tmp_path):
    table = tables.readings_table(str(tmp_path / "t"))
    tables.append(fx.frame(spark, rows(*range(24)), READINGS), table)
    files = [str(p) for p in (tmp_path / "t").rglob("*.parquet")]
    assert len(files) == 1
    assert [r.station_id for r in spark.read.parquet(files[0]).collect()] == sorted(f"s{h % 3}" for h in range(24))


def test_a_large_date_is_written_by_several_tasks(spark, tmp_path):
    table = tables.readings_table(str(tmp_path / "t"))
    spread = spark.range(0, 60_000, numPartitions=8).selectExpr(
        "timestamp '2024-01-15' AS ingested_at", "uuid() AS run_id", "uuid() AS station_id", "id AS openaq_location_id",
        "id AS openaq_sensor_id", "'pm25' AS pollutant", "rand() AS value", "uuid() AS dedup_key",
        "timestamp '2024-01-15' + make_dt_interval(0, cast(if(id % 100 = 0, 30, 1) AS int)) AS period_from_utc")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        assert tables.append(spread, table)["rows"] == 60_000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = {d.name: len(list(d.glob("*.parquet"))) for d in (tmp_path / "t").glob("p_date=*")}
    assert files["p_date=2024-01-15"] > 2 and files["p_date=2024-01-16"] == 1


def test_retention(spark, tmp_path):
    table = tables.readings_table(str(tmp_path / "t"))
    df = fx.frame(spark, rows(0, 24, 48, 72), READINGS)
    tables.append(df, table)
    as_of = datetime(2024, 1, 17)
    kept = tables.retain_days(df, "period_from_utc", 1, as_of)
    assert tables.expire_partitions(spark, table, 1, as_of) == [date(2024, 1, 15), date(2024, 1, 16)]
    assert values(tables.read_table(spark, table)) == values(kept) == [(48.0, "r1"), (72.0, "r1")]
    assert tables.expire_partitions(spark, tables.readings_table(str(tmp_path / "none")), 1, as_of) == []


def test_rows_without_a_time_stay(spark, tmp_path):
    table = tables.readings_table(str(tmp_path / "t"))
    df = fx.frame(spark, rows(0, 72), READINGS)
    undated = df.limit(1).withColumn("period_from_utc", F.lit(None).cast(df.schema["period_from_utc"].dataType))
    every = df.unionByName(undated)
    written = tables.append(every, table)
    assert written["rows"] == 3 and set(written["days"]) == {date(2024, 1, 15), date(2024, 1, 18), None}
    kept = tables.retain_days(every, "period_from_utc", 1, datetime(2024, 1, 17))
    tables.expire_partitions(spark, table, 1, datetime(2024, 1, 17))
    assert values(tables.read_table(spark, table)) == values(kept) and kept.count() == 2
    latest = tables.readings_table(str(tmp_path / "latest"))
    streams.refresh_latest(spark, table, latest, [None, date(2024, 1, 18)], streams.newest_readings)
    assert tables.read_table(spark, latest).count() == streams.newest_readings(kept).count() == 2


def test_full_refresh(spark, tmp_path):
    path = str(tmp_path / "stations")
    assert tables.overwrite(fx.stations(spark), path) == 3
    assert tables.overwrite(fx.stations(spark).limit(1), path) == 1
    assert spark.read.parquet(path).count() == 1


def test_run_log_failure_is_tolerated(spark, tmp_path):
    good, blocked = tmp_path / "log", tmp_path / "file"
    blocked.write_text("not a folder")
    assert tables.append_run_log(fx.run_log(spark), tables.run_log_table(str(good)))
    assert tables.read_table(spark, tables.run_log_table(str(good))).count() == 4
    assert not tables.append_run_log(fx.run_log(spark), tables.run_log_table(str(blocked)))


def reading_page(sensor, *hours, value=1.0):
    def text(h):
        return (DAY + timedelta(hours=h)).strftime("%Y-%m-%dT%H:%M:%SZ")

    items = [{"period": {"datetimeFrom": {"utc": text(h)}, "datetimeTo": {"utc": text(h + 1)}, "label": "l", "interval": "1"},
              "coverage": {"expectedCount": 1}, "value": value} for h in hours]
    return sensor, json.dumps({"results": items})


def worklist(spark):
    return sensor_worklist(fx.sensors(spark))


def pages(spark, *found):
    return spark.createDataFrame(list(found), "openaq_sensor_id bigint, payload string")


def test_readings_run(spark, tmp_path):
    target, log = tables.readings_table(str(tmp_path / "t")), tables.run_log_table(str(tmp_path / "log"))
    started = DAY + timedelta(hours=10, minutes=5)
    landed = pages(spark, reading_page(101, 7, 8, 9, 10), reading_page(102, 9), (103, None))
    row = ingest.ingest_readings(spark, landed, worklist(spark), target, log, "run_a", started)
    assert (row["status"], row["records_written"], row["sensors_queried"], row["sensors_failed"]) == ("partial_success", 4, 3, 1)
    assert (row["api_calls"], row["api_errors"], row["failed_sensor_ids"]) == (2, 1, '["103"]')
    assert row["window_start_utc"].hour == 7 and row["window_end_utc"].hour == 10
    ok = ingest.ingest_readings(spark, pages(spark, reading_page(101, 8, value=2.0)), worklist(spark), target, log, "run_b", started)
    assert (ok["status"], ok["records_written"]) == ("success", 1)
    none = ingest.ingest_readings(spark, pages(spark, (101, "{}")), worklist(spark), target, log, "run_c", started)
    assert (none["status"], none["records_written"]) == ("empty", 0)
    (tmp_path / "blocked").write_text("not a folder")
    bad = ingest.ingest_readings(spark, landed, worklist(spark), tables.readings_table(str(tmp_path / "blocked")), log, "run_d", started)
    assert (bad["status"], bad["records_written"], bad["sensors_queried"]) == ("error", 0, 3) and bad["error_message"]
    unreadable = spark.read.schema(payloads.LANDED_READINGS).json(str(tmp_path / "log")).withColumn(
        "payload", F.raise_error("gone").cast("string"))
    lost = ingest.ingest_readings(spark, unreadable, worklist(spark), target, log, "run_e", started)
    assert lost["status"] == "error"
    logged = {r.run_id: r.status for r in tables.read_table(spark, log).collect()}
    assert logged == {"run_a": "partial_success", "run_b": "success", "run_c": "empty", "run_d": "error", "run_e": "error"}
    assert tables.read_table(spark, target).count() == 5


def forecast_batch(*stations, hours=2, value=1.0):
    times = [(DAY + timedelta(hours=h)).strftime("%Y-%m-%dT%H:%M") for h in range(hours)]
    items = [{"latitude": 1.0, "longitude": 1.0, "hourly": {"time": times, "temperature_2m": [value] * hours}} for _ in stations]
    return json.dumps(items), [(s, 1.0, 2.0) for s in stations]


def test_forecast_run(spark, tmp_path):
    target, log = tables.forecasts_table(str(tmp_path / "t")), tables.run_log_table(str(tmp_path / "log"))
    landed = spark.createDataFrame(
        [forecast_batch("a", "b"), ("[broken", [("c", 1.0, 2.0)])],
        "payload string, stations array<struct<station_id:string,latitude:double,longitude:double>>")
    row = ingest.ingest_forecasts(spark, landed, target, log, "fc_a", DAY)
    assert (row["status"], row["records_written"], row["stations_polled"], row["stations_failed"]) == ("partial_success", 4, 3, 1)
    assert row["failed_station_ids"] == '["c"]' and row["sensors_queried"] is None and row["source"] == "open-meteo"


def test_catalogue_refresh(spark, tmp_path):
    item = {"id": 1, "name": "n", "isMobile": False, "isMonitor": True, "coordinates": {"latitude": 44.0, "longitude": 5.0},
            "sensors": [{"id": 5, "parameter": {"id": 1, "name": "pm25", "displayName": "PM", "units": "ppm"}}]}
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "1.json").write_text(json.dumps({"results": [item, {**item, "id": 2}]}, indent=1))
    (tmp_path / "pages" / "2.json").write_text(json.dumps({"results": [{**item, "id": 3, "isMobile": True}]}))
    landed = payloads.read_catalogue_pages(spark, str(tmp_path / "pages"))
    stations, sensors = str(tmp_path / "stations"), str(tmp_path / "sensors")
    summary, reasons = ingest.refresh_catalogue(landed, stations, sensors, DAY)
    assert spark.read.parquet(stations).count() == 2 and spark.read.parquet(sensors).count() == 2
    assert [tuple(r) for r in reasons.collect()] == [("mobile", 1)]
    assert summary.filter("metric = 'sensors_of'").first().needs_conversion is True
    with pytest.raises(ValueError):
        ingest.refresh_catalogue(landed.filter(F.lit(False)), stations, sensors, DAY)
    assert spark.read.parquet(stations).count() == 2


def land(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(line) for line in lines))


def reading_line(run, ingested, sensor, *hours, value):
    _, page = reading_page(sensor, *hours, value=value)
    return {"openaq_sensor_id": sensor, "payload": page, "ingested_at": ingested.isoformat(), "run_id": run,
            "window_end": (DAY + timedelta(hours=48)).isoformat()}


def test_reading_stream_equals_batch(spark, tmp_path):
    landing, raw = tmp_path / "landing", tables.readings_table(str(tmp_path / "raw"))
    latest, checkpoint = tables.readings_table(str(tmp_path / "latest")), str(tmp_path / "cp")

    def run():
        rows = streams.reading_stream(spark, str(landing), worklist(spark), files_per_batch=1)
        streams.start_ingest(rows, raw, checkpoint, latest, streams.newest_readings).awaitTermination()

    land(landing, "1.json", [reading_line("r1", DAY, 101, 1, 2, 30, value=1.0), reading_line("r1", DAY, 102, 1, value=5.0)])
    run()
    assert tables.read_table(spark, latest).count() == 4
    # A newer and an older delivery of the same hours, then a rerun without news.
    land(landing, "2.json", [reading_line("r3", DAY + timedelta(hours=2), 101, 2, 3, value=3.0),
                             reading_line("r0", DAY - timedelta(hours=2), 102, 1, value=9.0)])
    run()
    run()
    landed = payloads.read_landed(spark, str(landing), payloads.LANDED_READINGS)
    batch = payloads.flatten_hourly_readings(landed, worklist(spark), F.col("ingested_at"), F.col("run_id"), F.col("window_end"))
    assert sorted(map(str, tables.read_table(spark, raw).collect())) == sorted(map(str, batch.collect()))
    expected = dedup_latest_readings(batch)
    assert sorted(map(str, tables.read_table(spark, latest).collect())) == sorted(map(str, expected.collect()))
    assert values(expected) == [(1.0, "r1"), (1.0, "r1"), (3.0, "r3"), (3.0, "r3"), (5.0, "r1")]


def test_forecast_stream_equals_batch(spark, tmp_path):
    landing, raw = tmp_path / "landing", tables.forecasts_table(str(tmp_path / "raw"))
    latest = tables.forecasts_table(str(tmp_path / "latest"))
    lines = []
    for i in range(3):
        payload, stations = forecast_batch("a", "b", hours=3 + i, value=float(i))
        lines.append({"payload": payload, "stations": [dict(zip(("station_id", "latitude", "longitude"), s)) for s in stations],
                      "ingested_at": (DAY + timedelta(hours=i)).isoformat(), "run_id": f"r{i}"})
    land(landing, "1.json", lines)
    streams.start_ingest(streams.forecast_stream(spark, str(landing)), raw, str(tmp_path / "cp"), latest,
                         streams.newest_forecasts).awaitTermination()
    landed = payloads.read_landed(spark, str(landing), payloads.LANDED_FORECASTS)
    batch = payloads.flatten_forecast_batch(landed, F.col("ingested_at"), F.col("run_id"))
    assert batch.count() == 24
    expected = dedup_latest_forecasts(batch)
    assert sorted(map(str, tables.read_table(spark, latest).collect())) == sorted(map(str, expected.collect()))
    assert {r.temperature_2m for r in expected.collect()} == {2.0}


def test_request_buckets_in_a_stream(spark, tmp_path):
    lines = [{"run_id": "r", "started_at": (DAY + timedelta(seconds=s)).isoformat()} for s in (0, 1, 9, 10, 35)]
    land(tmp_path / "requests", "1.json", lines)
    stream = spark.readStream.schema("run_id string, started_at timestamp").json(str(tmp_path / "requests"))
    query = (streams.request_buckets(stream, ["run_id"]).writeStream.format("memory").queryName("buckets")
             .outputMode("complete").trigger(availableNow=True).start())
    query.awaitTermination()
    found = {r.bucket_start.second: r.requests for r in spark.table("buckets").collect()}
    assert found == {0: 3, 10: 1, 30: 1}
