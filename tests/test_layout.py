"""Files along a curve: the same rows, and narrower limits in every column."""

from datetime import date, datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gaugelake.sources import layout, tables

DAY = datetime(2024, 1, 15)


def _readings(spark, n=40_000):
    pollutants = F.array(*[F.lit(p) for p in ("pm25", "pm10", "no2", "o3", "so2")])
    return spark.range(0, n, numPartitions=8).select(
        F.lit(DAY).alias("ingested_at"), F.lit("r").alias("run_id"), F.format_string("s%04d", F.pmod(F.xxhash64("id"), F.lit(300))).alias("station_id"),
        F.lit(1).cast("long").alias("openaq_location_id"), F.col("id").alias("openaq_sensor_id"),
        F.element_at(pollutants, (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5)) + 1).cast("int")).alias("pollutant"),
        F.rand(3).alias("value"), F.timestamp_add("HOUR", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(24)).cast("int"), F.lit(DAY)).alias("period_from_utc"),
        F.col("id").cast("string").alias("dedup_key"))


def _groups(folder, column, value):
    """Row groups whose limits leave room for a value, and all."""
    some = every = 0
    for path in folder.rglob("*.parquet"):
        meta = pq.ParquetFile(path).metadata
        at = meta.schema.names.index(column)
        for i in range(meta.num_row_groups):
            limits = meta.row_group(i).column(at).statistics
            every += 1
            some += limits.min <= value <= limits.max
    return some, every


def test_a_filter_on_any_column_reads_fewer_row_groups(spark, tmp_path):
    df = _readings(spark)
    df = df.select([F.col(c) for c in df.columns]).cache()
    columns = ["station_id", "pollutant", "period_from_utc"]
    by_station = df.repartitionByRange(16, "station_id", "pollutant").sortWithinPartitions("station_id", "pollutant")
    by_station.write.option("maxRecordsPerFile", 625).parquet(str(tmp_path / "s"))
    layout.along_curve(df, columns, bits=4, partitions=16).write.option("maxRecordsPerFile", 625).parquet(str(tmp_path / "z"))
    got = spark.read.parquet(str(tmp_path / "z"))
    assert got.count() == df.count() and got.exceptAll(df).isEmpty()
    for column, value in (("pollutant", "so2"), ("station_id", "s0123")):
        some, every = _groups(tmp_path / "z", column, value)
        plain, of = _groups(tmp_path / "s", column, value)
        assert every >= 64 and of >= 64
        if column == "pollutant":
            assert some < 0.45 * every and some < 0.6 * plain
        else:
            assert some < 0.45 * every
    df.unpersist()


def test_rewrite_replaces_the_dates_of_its_rows(spark, tmp_path):
    table = tables.readings_table(str(tmp_path / "t"))
    df = _readings(spark, 3000)
    tables.append(df.limit(100).withColumn("period_from_utc", F.lit(DAY + timedelta(days=3))), table)
    tables.append(df, table)
    compact = spark.read.parquet(table.path).filter(F.col("p_date") == date(2024, 1, 15)).drop("p_date")
    compact = spark.createDataFrame(compact.collect(), compact.schema)
    layout.rewrite_along_curve(compact, table, ["station_id", "pollutant"], rows_per_file=500)
    read = tables.read_table(spark, table)
    assert read.count() == 3100 and read.filter(F.col("period_from_utc") > DAY + timedelta(days=2)).count() == 100


def test_numbers_order_as_values_do(spark):
    words = ["", "a", "ab", "abc", "b", "é", "z" * 30, "z" * 30 + "y", "\x7f"]
    df = spark.createDataFrame([(w, DAY + timedelta(seconds=i), date(2024, 1, 1 + i), float(-i)) for i, w in enumerate(sorted(words, key=str.encode))] + [(None,) * 4],
                               "w string, t timestamp, d date, x double")
    rows = df.select("w", *[layout.ordered_number(df, c).alias(f"n_{c}") for c in "wtdx"]).collect()
    known = [r for r in rows if r.w is not None]
    assert all(a.n_w <= b.n_w and a.n_t < b.n_t and a.n_d < b.n_d and a.n_x > b.n_x for a, b in zip(known, known[1:]))
    assert [r.n_w for r in rows if r.w is None] == [None]
    with pytest.raises(TypeError):
        layout.ordered_number(spark.range(1).select(F.array("id").alias("a")), "a")
    with pytest.raises(ValueError):
        layout.along_curve(df, ["w", "t", "d", "x"], bits=16)


def test_columns_of_one_value_and_of_none(spark):
    df = spark.range(50).select("id", F.lit("x").alias("same"), F.lit(None).cast("string").alias("none"))
    assert layout.along_curve(df, ["same", "none", "id"], bits=3).count() == 50
    assert layout.along_curve(df.limit(0), ["same", "id"]).count() == 0
