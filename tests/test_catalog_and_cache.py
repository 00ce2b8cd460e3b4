"""Catalogue tables, tables that switch together, and the cache of page results."""

from datetime import date, datetime
from uuid import uuid4

import fixture as fx
import pytest
from pyspark.sql import functions as F

from gaugelake.plans.cache import ResultCache
from gaugelake.schemas import READINGS, SENSORS, STATIONS, conform
from gaugelake.sources import catalog, tables


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{uuid4().hex}"
    catalog.open_database(spark, name, str(tmp_path / "db"))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def _dated(spark, *days):
    rows = [{"ingested_at": datetime(2024, 1, 1), "run_id": "r", "station_id": "s", "openaq_location_id": 1, "openaq_sensor_id": 1,
             "pollutant": "pm25", "value": float(i), "period_from_utc": None if d is None else datetime(2024, 1, d, 5), "dedup_key": str(i)}
            for i, d in enumerate(days)]
    return fx.frame(spark, rows, READINGS)


def test_dates_are_dropped_through_the_catalogue(spark, database, tmp_path):
    name = f"{database}.readings"
    catalog.create_table(spark, name, READINGS)
    catalog.create_table(spark, name, READINGS)
    rows = _dated(spark, 1, 2, 2, 3, 9, None)
    catalog.insert(rows, name, READINGS, "period_from_utc")
    assert catalog.table_dates(spark, name) == [date(2024, 1, d) for d in (1, 2, 3, 9)]
    as_of = datetime(2024, 1, 12, 3)
    assert catalog.expire_dates(spark, name, 9, as_of) == [date(2024, 1, d) for d in (1, 2, 3)]
    assert catalog.expire_dates(spark, name, 9, as_of) == []
    left = spark.table(name).drop(tables.PARTITION)
    kept = tables.retain_days(rows, "period_from_utc", 9, as_of)
    assert sorted(map(str, left.collect())) == sorted(map(str, kept.collect())) and left.count() == 2
    assert not [p for d in (1, 2, 3) for p in (tmp_path / "db").rglob(f"*p_date=2024-01-0{d}")]


def test_many_dates_are_dropped(spark, database, monkeypatch):
    monkeypatch.setattr(catalog, "_DROPPED_AT_ONCE", 3)
    name = f"{database}.readings"
    catalog.create_table(spark, name, READINGS)
    catalog.insert(_dated(spark, *range(1, 21)), name, READINGS, "period_from_utc")
    assert len(catalog.expire_dates(spark, name, 1, datetime(2024, 1, 19))) == 18
    assert spark.table(name).count() == 2


def test_insert_refuses_rows_without_required_values(spark, database):
    name = f"{database}.readings"
    catalog.create_table(spark, name, READINGS)
    with pytest.raises(Exception, match="run_id is required"):
        catalog.insert(_dated(spark, 1).withColumn("run_id", F.lit(None)), name, READINGS, "period_from_utc")
    assert spark.table(name).count() == 0
    with pytest.raises(ValueError):
        catalog.table_dates(spark, "x; DROP TABLE y")


def _load(spark, n):
    stations = conform(fx.stations(spark), STATIONS).withColumn("locality", F.lit(str(n)))
    sensors = conform(fx.sensors(spark), SENSORS).withColumn("parameter_units", F.lit(str(n)))
    return {"stations": stations, "sensors": sensors}


def _seen(both):
    return {r[0] for name, c in (("stations", "locality"), ("sensors", "parameter_units")) for r in both.table(name).select(c).collect()}


def test_tables_switch_together(spark, database, tmp_path):
    both = catalog.SwitchedTables(spark, database, ("stations", "sensors"), str(tmp_path / "db"))
    assert both.current() is None
    broken = _load(spark, 0) | {"sensors": _load(spark, 0)["sensors"].withColumn("parameter_units", F.raise_error(F.lit("gone")).cast("string"))}
    with pytest.raises(Exception, match="gone"):
        both.load(broken)
    assert both.current() is None
    first = both.load(_load(spark, 1))
    held = both.table("stations")
    assert _seen(both) == {"1"} and held.columns == STATIONS.fieldNames()
    with pytest.raises(Exception, match="gone"):
        both.load(broken)
    assert both.current() == first and _seen(both) == {"1"} and both.table("stations").count() == 3
    # A crash before the switch leaves rows that no reader sees and the next load removes.
    both._write({n: f for n, f in _load(spark, 7).items()}, "crashed")
    assert _seen(both) == {"1"} and "crashed" in both._loads()
    frames = _load(spark, 2)
    both.load(frames | {"sensors": frames["sensors"].select(*reversed(frames["sensors"].columns))})
    assert _seen(both) == {"2"} and "crashed" not in both._loads() and held.columns == both.table("stations").columns
    third = both.load({n: f.limit(0) for n, f in _load(spark, 3).items()})
    assert both.current() == third and both.table("stations").count() == both.table("sensors").count() == 0
    assert first not in both._loads()
    with pytest.raises(KeyError):
        both.table("current_load")


def test_a_reader_reads_one_load(spark, database, tmp_path):
    both = catalog.SwitchedTables(spark, database, ("stations", "sensors"), str(tmp_path / "db"))
    both.load(_load(spark, 1))
    both.load(_load(spark, 2))
    plan = both.table("stations")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_id" in plan or "LocalTableScan" in plan


class _Clock:
    now = 0.0

    def __call__(self):
        return self.now


def _jobs(spark, run):
    """How many jobs a call starts."""
    group = uuid4().hex
    spark.sparkContext.setJobGroup(group, "")
    try:
        out = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_pages_are_kept_for_their_time(spark, tmp_path):
    path, clock = str(tmp_path / "t"), _Clock()
    cache = ResultCache(300, clock=clock)

    def page(least=0):
        return spark.read.parquet(path).filter(F.col("id") >= least).groupBy((F.col("id") % 2).alias("odd")).count().orderBy("odd")

    spark.range(10).write.parquet(path)
    first, jobs = _jobs(spark, lambda: cache.fetch(page()))
    assert list(first["count"]) == [5, 5] and jobs > 0
    first["count"] = 0
    spark.range(10, 30).write.mode("append").parquet(path)
    clock.now = 299.9
    asked = page()  # listing files and reading a schema are no part of the fetch
    again, jobs = _jobs(spark, lambda: cache.fetch(asked))
    assert list(again["count"]) == [5, 5] and jobs == 0
    assert list(cache.fetch(page(20))["count"]) == [5, 5] and len(cache) == 2
    clock.now = 300.0
    fresh, jobs = _jobs(spark, lambda: cache.fetch(page()))
    assert list(fresh["count"]) == [15, 15] and jobs > 0
    clock.now = 1000.0
    assert list(cache.fetch(page(20))["count"]) == [5, 5] and len(cache) == 1


def test_pages_are_bounded(spark):
    cache = ResultCache(most=5, entries=3)
    with pytest.raises(ValueError, match="more than 5 rows"):
        cache.fetch(spark.range(6))
    for n in range(1, 6):
        cache.fetch(spark.range(n))
    assert len(cache) == 3
    cache.clear()
    assert len(cache) == 0


def test_frames_are_persisted_for_their_time(spark, tmp_path):
    path, clock = str(tmp_path / "t"), _Clock()
    cache = ResultCache(300, clock=clock)
    spark.range(10).write.parquet(path)
    held = cache.frame(spark.read.parquet(path).filter("id > 1"))
    assert held.storageLevel.useMemory and held.count() == 8
    spark.range(10, 20).write.mode("append").parquet(path)
    assert cache.frame(spark.read.parquet(path).filter("id > 1")) is held
    assert cache.frame(spark.read.parquet(path).filter("id > 2")) is not held
    clock.now = 301.0
    fresh = cache.frame(spark.read.parquet(path).filter("id > 1"))
    assert fresh.count() == 18 and fresh is not held
    cache.clear()
    assert not fresh.storageLevel.useMemory
