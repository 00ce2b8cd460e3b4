"""Streams with processors against their batch twins, with rows out of order and over several batches."""

import json
import os
import random
import time
from datetime import UTC, datetime, timedelta

import fixture as fx
import pytest
from pyspark.sql import functions as F

from gaugelake.operators import runs
from gaugelake.operators.readings import dedup_latest_readings
from gaugelake.schemas import READINGS
from gaugelake.sources import tables
from gaugelake.streaming import stateful

DAY = datetime(2024, 1, 15, tzinfo=UTC)
REQUESTS = "run_id string, started_at timestamp, status_code int"


def _land(folder, number, lines):
    folder.mkdir(exist_ok=True)
    (folder / f"{number:03}.json").write_text("\n".join(json.dumps(line) for line in lines))


def _stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))


def _written(spark, df, folder):
    def write(batch, number):
        batch.write.mode("overwrite").parquet(f"{folder}/out/{number}")

    query = (df.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{folder}/cp")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{folder}/out")


def _requests(rng, hours=2, late=20):
    """Requests of three runs in files by time, each up to ``late`` seconds out of place, with repeated instants and pauses."""
    found = []
    for run in ("a", "b", "c"):
        at = rng.uniform(0, 600)
        while at < hours * 3600:
            found += [(at, run, rng.choice([200, 200, 429, 503, None]))] * rng.choice([1, 1, 1, 2])
            at += rng.choice([0.25, 3, 7.5, 60, 400]) * rng.random()
    return sorted(found, key=lambda r: r[0] + rng.uniform(0, late))


def _landed(folder, requests, files=6):
    size = -(-len(requests) // files)
    for n in range(files):
        _land(folder, n, [{"run_id": r, "started_at": (DAY + timedelta(seconds=s)).isoformat(), "status_code": c}
                          for s, r, c in requests[n * size : (n + 1) * size]])


@pytest.mark.parametrize("seed", [1, 2])
def test_streamed_audit_and_timeline_equal_the_batch(spark, tmp_path, seed):
    landing = tmp_path / "landing"
    _landed(landing, _requests(random.Random(seed)))
    # A row without a run moves the time on, so that the last requests are passed.
    _land(landing, 90, [{"run_id": None, "started_at": (DAY + timedelta(days=1)).isoformat()}])
    batch = spark.read.schema(REQUESTS).json(str(landing)).filter("run_id IS NOT NULL")
    stream = _stream(spark, landing, REQUESTS)
    timeline = _written(spark, stateful.stream_timeline(stream, ["run_id"], lateness="30 seconds"), tmp_path / "t")
    want = runs.request_timeline(batch, ["run_id"])
    rows = lambda df: sorted(tuple(r) for r in df.select("run_id", "bucket", "bucket_start", "requests").collect())
    assert rows(timeline) == rows(want) and timeline.filter("requests = 0").count() > 0
    audit = _written(spark, stateful.stream_rate_audit(stream, ["run_id"], lateness="30 seconds"), tmp_path / "a")
    assert audit.count() > 3
    last = audit.groupBy("run_id").agg(*[F.max(c).alias(c) for c in audit.columns if c != "run_id"])
    assert sorted(map(tuple, last.collect())) == sorted(
        map(tuple, runs.request_rate_audit(batch, ["run_id"]).select(*last.columns).collect()))


def test_rows_behind_the_watermark_are_left_out(spark, tmp_path):
    landing = tmp_path / "landing"
    at = lambda s: (DAY + timedelta(seconds=s)).isoformat()
    _land(landing, 0, [{"run_id": "a", "started_at": at(s), "status_code": 200} for s in (5, 12, 3)])
    _land(landing, 1, [{"run_id": "a", "started_at": at(500), "status_code": 200}])
    _land(landing, 2, [{"run_id": None, "started_at": at(600)}])
    _land(landing, 3, [{"run_id": "a", "started_at": at(7), "status_code": 200}, {"run_id": None, "started_at": at(5000)}])
    found = _written(spark, stateful.stream_timeline(_stream(spark, landing, REQUESTS), ["run_id"], lateness="30 seconds"), tmp_path / "t")
    assert {r.bucket: r.requests for r in found.collect()} == {0: 3} | {b: 0 for b in range(1, 49)} | {49: 1}


def _readings(rng, n, keys=12):
    out = []
    for _ in range(n):
        k = rng.randrange(keys)
        out.append({"ingested_at": (DAY + timedelta(hours=rng.randrange(5))).isoformat(), "run_id": rng.choice("xyz"),
                    "station_id": f"s{k % 3}", "openaq_location_id": k % 3, "openaq_sensor_id": k, "pollutant": "pm25",
                    "value": rng.choice([None, 1.5, 2.5, -1.0]), "unit": rng.choice([None, "ppm"]),
                    "period_from_utc": (DAY + timedelta(hours=k)).isoformat(), "coverage_observed": rng.randrange(3), "dedup_key": str(k)})
    return out


def test_newest_versions_equal_the_batch(spark, tmp_path):
    landing, latest = tmp_path / "landing", tables.readings_table(str(tmp_path / "latest"))
    rng = random.Random(4)
    for n in range(3):
        _land(landing, n, _readings(rng, 60))
    batch = spark.read.schema(READINGS).json(str(landing))

    def run():
        stream = _stream(spark, landing, READINGS)
        stateful.start_newest(stream, latest, str(tmp_path / "cp"), ["dedup_key"]).awaitTermination()
        return tables.read_table(spark, latest)

    def newest(df):
        return sorted(map(str, dedup_latest_readings(df).collect()))

    versions = run()
    assert newest(versions) == newest(batch) and versions.count() <= 36
    files = {str(p) for p in (tmp_path / "latest").rglob("*.parquet")}
    # One newer version adds one row; an older one adds nothing; no file is written anew.
    newer = {**_readings(rng, 1)[0], "dedup_key": "5", "ingested_at": (DAY + timedelta(days=1)).isoformat()}
    older = {**newer, "dedup_key": "6", "ingested_at": (DAY - timedelta(days=9)).isoformat()}
    count = versions.count()
    _land(landing, 7, [newer, older])
    versions = run()
    assert versions.count() == count + 1 and newest(versions) == newest(spark.read.schema(READINGS).json(str(landing)))
    now = {str(p) for p in (tmp_path / "latest").rglob("*.parquet")}
    assert files < now and len(now - files) == 1


def test_newest_versions_run_without_python_per_key_and_forget_over_lives(spark, tmp_path):
    landing = tmp_path / "landing"
    row = {"k": "a", "at": 5, "note": None}
    for n, line in enumerate([row, {**row, "k": "b"}, row, {**row, "at": 4}, {**row, "note": "x"}]):
        _land(landing, n, [line])
        os.utime(landing / f"{n:03}.json", (n, n))  # files come in the order of their times

    def run(days, pause=0.0):
        out = []

        def write(batch, number):
            out.append([tuple(r) for r in batch.collect()])
            time.sleep(pause)

        stream = stateful.newest_versions(_stream(spark, landing, "k string, at int, note string"), ["k"], ["at"], days)
        query = (stream.writeStream.outputMode("update").foreachBatch(write)
                 .option("checkpointLocation", str(tmp_path / f"cp{pause}")).trigger(availableNow=True).start())
        query.awaitTermination()
        plan = query._jsq.explainInternal(False)
        return [rows for rows in out if rows], [p.stateOperators[0].numRowsTotal for p in query.recentProgress], plan

    rows, held, plan = run(30)
    # A copy and an older version add nothing, a tie goes to the larger rest.
    assert rows == [[("a", 5, None)], [("b", 5, None)], [("a", 5, "x")]]
    assert max(held) == 4 and "Python" not in plan and "TransformWithState" not in plan
    # Five batches of which each falls into two lives of two seconds: those that are over have gone.
    rows, held, _ = run(1 / 86_400, pause=1.1)
    assert rows[0] == [("a", 5, None)] and ("a", 5, "x") in rows[-1] and held[-1] <= 6


def test_versions_order_as_in_spark():
    rank = stateful._rank
    assert sorted([float("nan"), 1.0, None, -2.0], key=rank)[:3] == [None, -2.0, 1.0]


def test_stateful_session(spark):
    fx.readings(spark)
    assert stateful.stateful(spark).conf.get("spark.sql.streaming.stateStore.providerClass").endswith("RocksDBStateStoreProvider")
