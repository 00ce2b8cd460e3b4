"""Tables laid out by batch: a batch that comes again replaces itself."""

from datetime import timedelta

import fixture as fx
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from gaugelake.schemas import READINGS
from gaugelake.sources import tables
from gaugelake.streaming import ingest as streams


def rows(*hours):
    """Readings so many hours after the first midnight; their values are those hours."""
    found = []
    for hour in hours:
        start = fx.at(0) + timedelta(hours=hour)
        row = fx.reading("s", 1, 10, "pm25", 0, float(hour), start)
        found.append(row | {"period_from_utc": start, "period_to_utc": start + timedelta(hours=1), "dedup_key": f"10|{hour}"})
    return found


def test_repeated_batch_replaces_itself(spark, tmp_path):
    table = tables.readings_table(str(tmp_path / "t"), by_batch=True)
    both = fx.frame(spark, rows(0, 30), READINGS)  # two dates
    for _ in range(3):
        assert tables.append(both, table, "a-0")["rows"] == 2
    assert tables.append(fx.frame(spark, rows(1, 2), READINGS), table, "a-1")["rows"] == 2
    found = tables.read_table(spark, table)
    assert found.columns == READINGS.fieldNames()
    assert sorted(r.value for r in found.collect()) == [0.0, 1.0, 2.0, 30.0]
    assert len(tables.read_table(spark, table, keep_date=True).select(tables.PARTITION).distinct().collect()) == 2


def test_a_batch_is_named_where_it_counts(spark, tmp_path):
    df = fx.frame(spark, rows(0), READINGS)
    with pytest.raises(ValueError):
        tables.append(df, tables.readings_table(str(tmp_path / "t"), by_batch=True))
    with pytest.raises(ValueError):
        tables.append(df, tables.readings_table(str(tmp_path / "t")), "a-0")


def test_dates_of_batches_expire(spark, tmp_path):
    table = tables.readings_table(str(tmp_path / "t"), by_batch=True)
    tables.append(fx.frame(spark, rows(0, 24 * 40), READINGS), table, "a-0")
    late = fx.at(0) + timedelta(days=41)
    assert len(tables.expire_partitions(spark, table, 30, late.replace(tzinfo=None))) == 1
    assert [r.value for r in tables.read_table(spark, table).collect()] == [960.0]


@pytest.mark.parametrize("by_batch, times", [(True, 1), (False, 2)])
def test_stream_broken_after_its_append(spark, tmp_path, by_batch, times):
    source = str(tmp_path / "source")
    fx.frame(spark, rows(0, 1, 30), READINGS).write.parquet(source)
    raw = tables.readings_table(str(tmp_path / "raw"), by_batch)
    latest = tables.readings_table(str(tmp_path / "latest"))

    def ingest(dedup):
        arriving = spark.readStream.schema(READINGS).parquet(source)
        streams.start_ingest(arriving, raw, str(tmp_path / "cp"), latest, dedup).awaitTermination()

    def broken(_):
        raise RuntimeError("half-way")

    with pytest.raises(StreamingQueryException):
        ingest(broken)
    ingest(streams.newest_readings)
    counts = tables.read_table(spark, raw).groupBy("dedup_key").agg(F.count("*").alias("n")).collect()
    assert [r.n for r in counts] == [times] * 3
    assert tables.read_table(spark, latest).count() == 3
    # A stream of another checkpoint has other names for its batches.
    arriving = spark.readStream.schema(READINGS).parquet(source)
    streams.start_ingest(arriving, raw, str(tmp_path / "other")).awaitTermination()
    assert tables.read_table(spark, raw).count() == 3 * times + 3


def test_a_whole_batch_is_not_appended_again(spark, tmp_path, monkeypatch):
    source = str(tmp_path / "source")
    undated = rows(2)[0] | {"period_from_utc": None}
    fx.frame(spark, [*rows(0, 30), undated], READINGS).write.parquet(source)
    raw, latest = (tables.readings_table(str(tmp_path / name), name == "raw") for name in ("raw", "latest"))
    appended, append = [], tables.append

    def counted(df, table, batch=None):
        found = append(df, table, batch)
        appended.append(batch)
        if len(appended) == 1:
            raise RuntimeError("before it was recorded")
        return found

    def ingest(dedup):
        arriving = spark.readStream.schema(READINGS).parquet(source)
        streams.start_ingest(arriving, raw, str(tmp_path / "cp"), latest, dedup).awaitTermination()

    def broken(_):
        raise RuntimeError("half-way")

    monkeypatch.setattr(tables, "append", counted)
    monkeypatch.setattr(streams, "append", counted)
    for _ in range(3):  # without a record, then twice with it
        with pytest.raises(StreamingQueryException):
            ingest(broken)
    ingest(streams.newest_readings)
    assert len(appended) == 2 and len(set(appended)) == 1
    for table in (raw, latest):
        found = tables.read_table(spark, table, keep_date=True).collect()
        assert sorted(r.value for r in found) == [0.0, 2.0, 30.0] and sum(r[tables.PARTITION] is None for r in found) == 1


def test_a_record_that_broke_off_counts_for_nothing(spark, tmp_path):
    table = tables.readings_table(str(tmp_path / "t"), by_batch=True)
    (tmp_path / "t" / f"_{tables.BATCH}" / "a-0").mkdir(parents=True)
    df = fx.frame(spark, rows(0, 30), READINGS)
    days = tables.append_once(df, table, "a-0")
    assert len(days) == 2 and sorted(tables.append_once(df, table, "a-0")) == sorted(days)
    assert tables.append_once(df.limit(0), table, "a-1") == tables.append_once(df.limit(0), table, "a-1") == []
    assert sorted(r.value for r in tables.read_table(spark, table).collect()) == [0.0, 30.0]
