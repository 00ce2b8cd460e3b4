"""Column expressions: time, labels and scores."""

from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from gaugelake.functions import clock, labels, scores


def one(spark, expression, **values):
    columns = [F.lit(v).alias(n) for n, v in values.items()] or [F.lit(1).alias("x")]
    return spark.range(1).select(*columns).select(expression.alias("out")).first().out


def ts(text, kind="timestamp"):
    return F.lit(text).cast(kind)


@pytest.mark.parametrize("kind", [TimestampType(), TimestampNTZType()])
@pytest.mark.parametrize("value", [
    datetime(2026, 3, 22, 14), datetime(2026, 3, 22, 14, tzinfo=UTC), "2026-03-22 14:00:00", "2026-03-22T14:00:00Z",
    "2026-03-22T16:00:00+02:00",
])
def test_moment(spark, kind, value):
    df = spark.range(1).select(clock.moment(value, kind).alias("out"))
    assert df.schema["out"].dataType == kind
    assert df.first().out == datetime(2026, 3, 22, 14)


@pytest.mark.parametrize("now,hours,start,end", [
    ("2024-01-15 10:05:00", 3, datetime(2024, 1, 15, 7), datetime(2024, 1, 15, 10)),
    ("2024-01-15 00:15:00", 2, datetime(2024, 1, 14, 22), datetime(2024, 1, 15)),
])
@pytest.mark.parametrize("kind", [TimestampType(), TimestampNTZType()])
def test_complete_hour_window(spark, now, hours, start, end, kind):
    low, high = clock.complete_hour_window(clock.moment(now, kind), hours, kind)
    df = spark.range(1).select(low.alias("low"), high.alias("high"))
    assert {f.dataType for f in df.schema} == {kind}
    assert tuple(df.first()) == (start, end)


@pytest.mark.parametrize("text,expected", [
    ("2024-01-15T10:30:00Z", datetime(2024, 1, 15, 10, 30)),
    ("2024-01-15T10:30:00+00:00", datetime(2024, 1, 15, 10, 30)),
    ("2024-06-15T12:00:00+02:00", datetime(2024, 6, 15, 10)),
    ("", None), (None, None), ("soon", None),
])
def test_parse_utc(spark, text, expected):
    assert one(spark, clock.parse_utc(F.lit(text).cast("string"))) == expected


def test_format_and_run_stamp(spark):
    assert one(spark, clock.format_utc(ts("2024-01-15 10:30:00"))) == "2024-01-15T10:30:00Z"
    assert one(spark, clock.format_utc(ts("2024-01-15 10:30:00.25"))) == "2024-01-15T10:30:00.250000Z"
    assert one(spark, clock.run_stamp(ts("2024-01-15 10:30:00"), "a1b2c3d4")) == "20240115T103000Z_a1b2c3d4"
    assert one(spark, clock.utc_label(ts("2024-01-15 10:30:59"))) == "2024-01-15 10:30 UTC"
    assert one(spark, clock.utc_label(F.lit(None).cast("timestamp"))) == "No data"


def test_elapsed(spark):
    late, early = ts("2024-01-01 03:59:59"), ts("2024-01-01 00:00:00")
    assert one(spark, clock.whole_hours(late, early)) == 3
    assert one(spark, clock.whole_hours(early, late)) == -3
    assert one(spark, clock.age_hours(ts("2024-01-01 01:30:00"), early)) == 1.5
    assert one(spark, clock.seconds_between(ts("2024-01-01 00:00:01.5"), early)) == 1.5


@pytest.mark.parametrize("hours,label", [
    (None, "No data yet"), (-2.0, "0m ago"), (0.0, "0m ago"), (0.5, "30m ago"), (1.0, "1h 0m ago"),
    (3.99, "3h 59m ago"), (27.5, "1d 3h ago"), (48.0, "2d 0h ago"),
    (0.5 / 60, "0m ago"), (1.5 / 60, "2m ago"), (2.5 / 60, "2m ago"),
])
def test_age_label(spark, hours, label):
    assert one(spark, labels.age_label(F.lit(hours).cast("double"))) == label


@pytest.mark.parametrize("minutes,band", [(0, "green"), (89.9, "green"), (90, "yellow"), (359, "yellow"), (360, "red"), (None, "red")])
def test_freshness_band(spark, minutes, band):
    assert one(spark, labels.freshness_band(F.lit(minutes).cast("double"))) == band


@pytest.mark.parametrize("a,b,source", [
    (None, None, "No data"), (1.0, None, "OpenAQ"), (None, 1.0, "Weather"), (1.0, 1.0, "OpenAQ"),
    (2.0, 1.0, "Weather"), (1.0, 2.0, "OpenAQ"),
])
def test_newest_source(spark, a, b, source):
    assert one(spark, labels.newest_source(F.lit(a).cast("double"), F.lit(b).cast("double"))) == source


@pytest.mark.parametrize("csv,found", [
    ("no2,pm10,pm25", True), ("NO2; PM25 / PM10", True), ("no2,pm10,pm255", False), ("xno2,pm10,pm25", False),
    ("", False), (None, False),
])
def test_has_all_tokens(spark, csv, found):
    assert bool(one(spark, labels.has_all_tokens(F.lit(csv).cast("string"), ["pm25", "pm10", "no2"]))) is found


@pytest.mark.parametrize("score,name", [(0.0, "poor"), (0.2999, "poor"), (0.30, "fair"), (0.55, "fair"), (0.5501, "good"), (1.0, "good")])
def test_category(spark, score, name):
    assert one(spark, scores.category(F.lit(score))) == name


def test_rounding_and_clamping(spark):
    assert [one(spark, scores.round_half_up(F.lit(x), 2)) for x in (0.125, 0.375, 0.694)] == [0.13, 0.38, 0.69]
    assert one(spark, scores.clamp_score(F.lit(3000.0), 1500.0)) == 1.0
    assert one(spark, scores.clamp_score(F.lit(None).cast("double"), 1500.0)) == 0.0
    ranks = [one(spark, scores.category_of_rank(scores.severity_rank(F.lit(n)))) for n in scores.CATEGORIES_WORST_FIRST]
    assert ranks == ["poor", "fair", "good"]
