"""Time expressions. They accept TIMESTAMP and TIMESTAMP_NTZ and keep the input's kind."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType

Moment = datetime | str | Column | None

_MICROS_PER_HOUR = 3.6e9


def moment(value: Moment, kind: DataType) -> Column:
    """A reference time as a column of type ``kind``; None means now.

    Naive datetimes and zone-less texts are UTC.
    """
    if value is None:
        return F.current_timestamp().cast(kind)
    if isinstance(value, Column):
        return value.cast(kind)
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            value = value.astimezone(timezone.utc).replace(tzinfo=None)
        value = value.isoformat(sep=" ")
    elif not isinstance(kind, TimestampNTZType):
        return F.lit(value).cast(kind)
    else:
        parsed = datetime.fromisoformat(value.replace("Z", "+00:00"))
        return moment(parsed, kind)
    text = value if isinstance(kind, TimestampNTZType) else value + "+00:00"
    return F.lit(text).cast(kind)


def moment_like(df: DataFrame, column: str, value: Moment) -> Column:
    """A reference time of the same kind as ``df[column]``."""
    return moment(value, df.schema[column].dataType)


def shift(ts: Column, unit: str, amount: int | Column) -> Column:
    return F.timestamp_add(unit, F.lit(amount) if isinstance(amount, int) else amount, ts)


def floor_hour(ts: Column, kind: DataType) -> Column:
    """``date_trunc`` turns TIMESTAMP_NTZ into TIMESTAMP, hence the cast back."""
    return F.date_trunc("hour", ts).cast(kind)


def hour_slot(ts: Column) -> Column:
    """Number of the clock hour, as BIGINT: an equality key for hour-wide ranges."""
    return F.floor(F.unix_seconds(ts.cast("timestamp")) / F.lit(3600)).cast("bigint")


def whole_hours(later: Column, earlier: Column) -> Column:
    """Elapsed whole hours, cut towards zero (3 h 59 min is 3)."""
    return F.timestamp_diff("HOUR", earlier, later)


def age_hours(later: Column, earlier: Column) -> Column:
    """Elapsed hours with fraction."""
    return F.timestamp_diff("MICROSECOND", earlier, later) / F.lit(_MICROS_PER_HOUR)


def seconds_between(later: Column, earlier: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", earlier, later) / F.lit(1e6)


def minutes_between(later: Column, earlier: Column) -> Column:
    return F.timestamp_diff("SECOND", earlier, later) / F.lit(60.0)


def parse_utc(text: Column) -> Column:
    """RFC 3339 text to TIMESTAMP; empty, missing or unreadable text is NULL."""
    return F.try_to_timestamp(F.when(F.length(text) > 0, text))


def format_utc(ts: Column) -> Column:
    """RFC 3339 text with ``Z``; the fraction appears only when there is one."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.concat(whole, F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(""), F.lit("Z"))


def run_stamp(ts: Column, suffix: Column | str) -> Column:
    """Run id ``20240115T103000Z_<suffix>``; the caller draws the suffix when it starts the run."""
    tail = F.lit(suffix) if isinstance(suffix, str) else suffix
    return F.concat(F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'"), F.lit("_"), tail)


def complete_hour_window(now: Column, lookback_hours: int, kind: DataType) -> tuple[Column, Column]:
    """``[start, end)`` of the last complete clock hours before ``now``."""
    end = floor_hour(now, kind)
    return shift(end, "HOUR", -lookback_hours), end


def utc_label(ts: Column) -> Column:
    return F.coalesce(F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm"), F.lit(" UTC")), F.lit("No data"))
