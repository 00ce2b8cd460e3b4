"""Physical plans: what is pushed down, how often rows move, and what happens to hot keys."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from fixture import frame
from gaugelake.operators import forecasts as fc
from gaugelake.operators import readings as rd
from gaugelake.schemas import FORECASTS, STATIONS
from gaugelake.sources import tables

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The bound readings and forecasts as partitioned tables."""
    folder = tmp_path_factory.mktemp("stored")
    bound = registered._Inputs(spark, SF)
    readings, forecasts = tables.readings_table(f"{folder}/r"), tables.forecasts_table(f"{folder}/f")
    tables.append(bound.readings, readings)
    tables.append(bound.forecasts, forecasts)
    return readings, forecasts


def test_no_query_uses_python_or_cross_joins(spark):
    for name, query in registered.queries().items():
        text = plan(query(spark, SF))
        for word in ("Python", "ArrowEval", "MapInPandas", "CartesianProduct", "NestedLoopJoin"):
            assert word not in text, f"{word} in {name}"


def test_dedup_limits_each_key_before_the_shuffle(spark, stored):
    text = plan(rd.dedup_latest_readings(tables.read_table(spark, stored[0])))
    assert re.search(r"WindowGroupLimit.*Final[\s\S]*Exchange hash[\s\S]*WindowGroupLimit.*Partial", text)
    assert text.count("Exchange hash") == 1


def test_future_filter_reaches_the_scan(spark, stored):
    forecasts = tables.read_table(spark, stored[1])
    text = plan(fc.dispersion_scores(forecasts, "2024-01-25 00:00:00"))
    assert re.search(r"PushedFilters: \[IsNotNull\(valid_time\), GreaterThan\(valid_time", text)


def test_filters_on_determined_columns_reach_the_scan(spark, stored):
    wide = rd.station_hourly_wide(tables.read_table(spark, stored[0]), stable_key=True)
    text = plan(wide.filter((F.col("station_id") == "7") & (F.col("hour_utc") >= F.lit("2024-01-20").cast("timestamp"))))
    for pushed in ("EqualTo(station_id,7)", "GreaterThanOrEqual(period_from_utc", "In(pollutant"):
        assert pushed in text
    loose = plan(rd.station_hourly_wide(tables.read_table(spark, stored[0])))
    assert "In(pollutant" not in loose


def test_series_and_retention_filters_reach_the_scans(spark, stored):
    readings, forecasts = (tables.read_table(spark, t) for t in stored)
    long = rd.unpivot_pollutants(fc.station_hourly_combined(readings, forecasts, stable_key=True))
    text = plan(rd.station_time_series(long, "7", "pm25", 3, "2024-01-31 00:00:00"))
    scans = set(re.findall(r"PushedFilters: (.*?), ReadSchema", text))
    assert len(scans) == 2 and all("EqualTo(station_id,7)" in scan for scan in scans)
    for column in ("period_from_utc", "valid_time"):
        assert any(f"GreaterThanOrEqual({column},2024-01-28" in scan for scan in scans)
    kept = tables.retain_days(readings, "period_from_utc", 30, "2024-02-10 00:00:00")
    assert "GreaterThanOrEqual(period_from_utc,2024-01-12" in plan(kept)


def test_only_needed_columns_are_read(spark, stored):
    readings, forecasts = (tables.read_table(spark, t) for t in stored)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan(rd.newest_reading_times(readings, stable_key=True))).group(1)
    assert schema == "ingested_at:timestamp,station_id:string,period_from_utc:timestamp"
    wide = re.search(r"ReadSchema: struct<([^>]*)>", plan(rd.station_hourly_wide(readings, stable_key=True))).group(1)
    assert "coverage" not in wide and "sensor" not in wide
    assert "dedup_key" not in plan(fc.station_current_outlook(readings, forecasts, readings.limit(0).select(
        "station_id", *[F.lit(None).cast("string").alias(c) for c in ("station_name", "locality", "country_code")],
        *[F.lit(None).cast("double").alias(c) for c in ("latitude", "longitude")]), stable_key=True))


def test_shuffles_per_view(spark, stored):
    readings, forecasts = (tables.read_table(spark, t) for t in stored)
    stations = spark.createDataFrame([], STATIONS)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
        assert exchanges(rd.newest_reading_times(readings, stable_key=True)) == 1
        assert exchanges(rd.station_latest_pollutants(readings, None, stable_key=True)) == 1
        assert exchanges(rd.station_hourly_wide(readings, stable_key=True)) == 2
        # Readings: dedup, then layout by station-hour. Forecasts: dedup, already in that layout. Join: none.
        assert exchanges(fc.station_hourly_combined(readings, forecasts, stable_key=True)) == 3
        # Forecasts: dedup, then the one join. Per station: newest PM2.5, stations, and both together.
        assert exchanges(fc.station_dispersion_outlook(readings, forecasts, stations, None, stable_key=True)) == 5


def test_outlook_window_follows_the_table_at_any_size(spark, stored, tmp_path):
    table = tables.forecasts_table(str(tmp_path / "forecasts"))
    first = tables.read_table(spark, stored[1])
    tables.append(first, table)
    for threshold in ("10", "10485760"):
        with settings(spark, spark__sql__autoBroadcastJoinThreshold=threshold):
            view = fc.forecast_window(tables.read_table(spark, table))
            view.createOrReplaceTempView(f"window_{threshold}")
            assert view.filter("forecast_hours_count > 0").count() == fc.forecast_window(first).filter(
                "forecast_hours_count > 0"
            ).count()
    later = F.expr("interval 30 days")
    newer = first.withColumns({c: F.col(c) + later for c in ("ingested_at", "valid_time")})
    tables.append(newer, table)
    want = sorted(map(str, fc.forecast_window(first.unionByName(newer)).collect()))
    assert any("forecast_hours_count=0" not in row for row in want)
    for threshold in ("10", "10485760"):
        with settings(spark, spark__sql__autoBroadcastJoinThreshold=threshold):
            # The same view text, its files listed anew.
            assert sorted(map(str, fc.forecast_window(tables.read_table(spark, table)).collect())) == want
    assert fc.forecast_window(first.limit(0)).count() == 0


def test_outlook_window_reads_the_forecasts_twice(spark, stored):
    window = fc.forecast_window(tables.read_table(spark, stored[1]))
    window.collect()
    final = window._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" in final and "ReusedExchange" in final


def test_series_filters_the_pollutant_at_the_scan(spark, stored):
    readings, forecasts = (tables.read_table(spark, t) for t in stored)
    one = fc.station_pollutant_series(readings, forecasts, None, "pm25", 30, "2024-02-10 00:00:00", stable_key=True)
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(pollutant,pm25\)", plan(one))


def test_station_hours_move_once_with_a_stable_key_only(spark, stored):
    readings = tables.read_table(spark, stored[0])
    assert "REPARTITION_BY_COL" in plan(rd.station_hour_values(readings, stable_key=True))
    loose = plan(rd.station_hour_values(readings))
    assert "REPARTITION_BY_COL" not in loose and re.search(r"Exchange[\s\S]*partial_max", loose)


def test_grouping_finds_dedup_output_sorted(spark, stored):
    wide = rd.station_hourly_wide(tables.read_table(spark, stored[0]), stable_key=True)
    text = plan(wide)
    partial = text[: text.index("Window [")] if "Window [" in text else text
    assert partial.count("Sort [") == 1, "only the final aggregation sorts above the dedup"


def hot_forecasts(spark, tmp_path):
    """A third of all forecast hours belong to one station, the rest to many."""
    hours = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 500)).alias("station_id"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("valid_time"),
        F.lit("2024-01-01").cast("timestamp").alias("ingested_at"),
    )
    doubles = [f.name for f in FORECASTS if f.dataType.typeName() == "double"]
    values = [F.rand(seed).alias(name) for seed, name in enumerate(doubles)]
    df = hours.select("*", *values, F.lit("r").alias("run_id"), F.lit("k").alias("dedup_key"))
    path = str(tmp_path / "hot")
    df.select(*FORECASTS.fieldNames()).repartition(8).write.parquet(path)
    return spark.read.parquet(path)


def final_plan(df):
    df.collect()
    return plan(df)


def test_hot_station_is_split_when_the_join_shuffles(spark, tmp_path):
    forecasts = hot_forecasts(spark, tmp_path)
    readings = forecasts.select("station_id").distinct().select(
        F.lit("2024-01-01").cast("timestamp").alias("ingested_at"), F.lit("r").alias("run_id"), "station_id",
        F.lit(1).cast("bigint").alias("openaq_location_id"), F.lit(1).cast("bigint").alias("openaq_sensor_id"),
        F.lit("pm25").alias("pollutant"), F.lit(1.0).alias("value"), F.lit("u").alias("unit"),
        F.lit("2024-01-01").cast("timestamp").alias("period_from_utc"), F.col("station_id").alias("dedup_key"))
    stations = frame(spark, [{"station_id": "hot", "station_name": "Hot"}, {"station_id": "s1"}], STATIONS)
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20k",
        spark__sql__shuffle__partitions="20",
    ):
        outlook = fc.station_dispersion_outlook(readings, forecasts, stations, "2023-01-01 00:00:00", stable_key=True)
        text = final_plan(outlook)
        assert "skew=true" in text
        assert outlook.count() == 30_000
        assert outlook.filter("latest_pm25 = 1.0").count() == 30_000


def test_copies_of_one_key_collapse_on_the_map_side(spark, tmp_path):
    path = str(tmp_path / "copies")
    copies = spark.range(80_000).select(
        F.when(F.col("id") % 3 == 0, "1|h").otherwise(F.concat(F.col("id"), F.lit("|h"))).alias("dedup_key"),
        F.timestamp_seconds("id").alias("ingested_at"), F.lit("r").alias("run_id"), F.col("id").cast("double").alias("value"),
        F.lit("s").alias("station_id"), F.lit("u").alias("unit"), F.lit("pm25").alias("pollutant"),
        F.lit("2024-01-01").cast("timestamp").alias("period_from_utc"),
        F.lit(1).cast("bigint").alias("openaq_location_id"), F.lit(1).cast("bigint").alias("openaq_sensor_id"))
    copies.repartition(8).write.parquet(path)
    df = rd.dedup_latest_readings(spark.read.parquet(path))
    rows = df.filter("dedup_key = '1|h'").collect()
    assert [r.value for r in rows] == [79_998.0]
    assert df.count() == spark.read.parquet(path).select("dedup_key").distinct().count()
