"""Streams with state of their own per key: newest versions, complete timelines, and request audits.

Newest versions are an aggregate that Spark holds per key. Processors of timelines and audits take rows in
event-time order: rows wait until the watermark has passed them, so that what is emitted is final although
rows arrive out of order. What waits is bounded by the lateness the watermark allows. State is kept in RocksDB and checkpointed with the query.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor
from pyspark.sql.types import LongType, StructField, StructType

from gaugelake.schemas import conform
from gaugelake.session import importable
from gaugelake.sources.tables import TableSpec, append

_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_DAY_SECONDS = 86_400


def stateful(spark: SparkSession) -> SparkSession:
    """Sets what queries with processors need before they start."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _PROVIDER)
    return importable(spark)


# --- newest versions --------------------------------------------------------------------


def _rank(value) -> tuple:
    """Orders values as Spark does: NULL lowest, NaN highest. For checks of the order in Python."""
    if value is None:
        return (0, 0)
    return (2, 0) if value != value else (1, value)


_SEEN, _LIFE, _NEWEST = "__seen", "__life", "__newest"


def newest_versions(rows: DataFrame, keys: Sequence[str], newest_by: Sequence[str], days: float = 30) -> DataFrame:
    """Rows of a stream that are newer than any before of their key.

    The order is that of ``dedup_latest``: ``newest_by``, then all other columns. A late version costs a look at its
    key. The state is an aggregate of Spark's own, one row per key and life. Lives of twice ``days`` begin every ``days``,
    so each version falls into two, and the older one, which knows at least the last ``days``, tells whether it is new.
    A life that is over goes; a version that comes later still counts as new and is settled when the table is read.
    """
    stateful(rows.sparkSession)
    order = [*newest_by, *[c for c in rows.columns if c not in (*keys, *newest_by)]]
    # The time of a micro-batch is the same wherever its plan names it, also when the batch is repeated.
    now, seconds = F.current_timestamp(), round(days * _DAY_SECONDS)
    lives = F.window(_SEEN, f"{2 * seconds} seconds", f"{seconds} seconds").alias(_LIFE)
    # Of equal versions the one seen first counts.
    version = F.struct(*order, (-F.unix_micros(_SEEN)).alias(_SEEN))
    held = (
        rows.withColumn(_SEEN, now)
        .withWatermark(_SEEN, "0 seconds")
        .groupBy(*keys, lives)
        .agg(F.max(version).alias(_NEWEST))
    )
    older = F.col(f"{_LIFE}.end") <= F.timestamp_add("SECOND", F.lit(seconds), now)
    changed = F.col(f"{_NEWEST}.{_SEEN}") == -F.unix_micros(now)
    return held.filter(older & changed).select(
        *[F.col(c) if c in keys else F.col(f"{_NEWEST}.{c}").alias(c) for c in rows.columns]
    )


def start_newest(
    rows: DataFrame,
    latest: TableSpec,
    checkpoint: str,
    keys: Sequence[str],
    newest_by: Sequence[str] = ("ingested_at", "run_id"),
    days: float = 30,
    **trigger,
) -> StreamingQuery:
    """Append each new newest version to ``latest``; read it through ``dedup_latest``, which has few versions left to settle.

    By default all that has arrived is taken and the query ends. A late row adds one row; no date is written anew.
    """
    changed = newest_versions(conform(rows, latest.schema), keys, newest_by, days)
    writer = (
        changed.writeStream.foreachBatch(lambda batch, _: append(batch, latest) and None)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    # A batch without data would go through the whole state to drop what is over, which the next batch does
    # too. A query keeps the settings it starts with.
    conf, name = rows.sparkSession.conf, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = conf.get(name, "true")
    conf.set(name, "false")
    try:
        return writer.start()
    finally:
        conf.set(name, before)


# --- requests in the order of their time ------------------------------------------------

_PENDING = "at long, status int"


class _InOrder(StatefulProcessor):
    """Keeps rows (at, in microseconds, and status) until the watermark has passed them."""

    def init(self, handle) -> None:
        self._handle = handle
        self._pending = handle.getListState("pending", _PENDING)

    def _due(self, rows: list[tuple[int, int | None]]) -> int | None:
        """When to look again, in microseconds, with these rows waiting."""
        raise NotImplementedError

    def _take(self, key, rows: list[tuple[int, int | None]], passed: int) -> tuple[list[Row], list]:
        """What to emit now that the watermark stands at ``passed``, and the rows that go on waiting."""
        raise NotImplementedError

    def _arm(self, rows: list) -> None:
        due = self._due(rows)
        if due is not None:
            # Timers count whole milliseconds.
            self._handle.registerTimer(-(-due // 1000))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if all(part is not None for part in key):
            fresh = [(row.at, row.status) for row in rows]
            self._pending.appendList(fresh)
            self._arm([min(fresh, key=lambda x: x[0])])
        else:
            for _ in rows:
                pass
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        waiting = sorted(((r[0], r[1]) for r in self._pending.get()), key=lambda x: x[0])
        out, rest = self._take(key, waiting, timerValues.getCurrentWatermarkInMs() * 1000)
        if len(rest) < len(waiting):
            self._pending.clear()
            if rest:
                self._pending.put(rest)
        if rest:
            self._arm(rest)
        yield from out

    def close(self) -> None:
        pass


class Buckets(_InOrder):
    """Requests per bucket from a run's first request on. A bucket is emitted once it is over, an empty one
    once a later one has a request."""

    def __init__(self, names: Sequence[str], width: int):
        self._names, self._width = list(names), width

    def init(self, handle) -> None:
        super().init(handle)
        self._state = handle.getValueState("place", "first_at long, next long")

    def _due(self, rows):
        first, _ = self._state.get() if self._state.exists() else (rows[0][0], 0)
        return first + ((rows[0][0] - first) // self._width + 1) * self._width

    def _take(self, key, rows, passed):
        if not rows:
            return [], rows
        first, at = self._state.get() if self._state.exists() else (rows[0][0], 0)
        counts: dict[int, int] = {}
        for moment, _ in rows:
            bucket = (moment - first) // self._width
            counts[bucket] = counts.get(bucket, 0) + 1
        end = min((passed - first) // self._width, max(counts) + 1)
        if end <= at:
            return [], rows
        self._state.update((first, end))
        out = (
            Row(**dict(zip(self._names, key, strict=True)), bucket=b, first_at=first, requests=counts.get(b, 0))
            for b in range(at, end)
        )
        return out, [r for r in rows if (r[0] - first) // self._width >= end]


class Pace(_InOrder):
    """Requests by outcome, the busiest sliding window and the longest gap of a run, so far."""

    def __init__(self, names: Sequence[str], width: int):
        self._names, self._width = list(names), width

    def init(self, handle) -> None:
        super().init(handle)
        self._inside = handle.getListState("inside", "at long")
        self._state = handle.getValueState(
            "sums", "total long, ok long, throttled long, other long, peak long, gap long, last_at long"
        )

    def _due(self, rows):
        return rows[0][0] + 1

    def _take(self, key, rows, passed):
        ready = [r for r in rows if r[0] < passed]
        if not ready:
            return [], rows
        inside = [r[0] for r in self._inside.get()]
        total, ok, throttled, other, peak, gap, last = (
            self._state.get() if self._state.exists() else (0, 0, 0, 0, 0, 0, ready[0][0])
        )
        low = 0
        for place, (at, status) in enumerate(ready):
            total += 1
            ok += status == 200
            throttled += status == 429
            other += status is None or status >= 400 and status != 429
            gap, last = max(gap, at - last), at
            inside.append(at)
            if place + 1 < len(ready) and ready[place + 1][0] == at:
                continue  # requests of one instant count together
            while inside[low] <= at - self._width:
                low += 1
            peak = max(peak, len(inside) - low)
        self._inside.clear()
        self._inside.put([(at,) for at in inside[low:]])
        self._state.update((total, ok, throttled, other, peak, gap, last))
        row = Row(
            **dict(zip(self._names, key, strict=True)),
            total_requests=total,
            status_200=ok,
            status_429=throttled,
            other_errors=other,
            max_requests_in_window=peak,
            longest_gap_micros=gap,
        )
        return [row], rows[len(ready) :]


def _timed(requests: DataFrame, by: Sequence[str], ts: str, lateness: str, status: str | None) -> DataFrame:
    at = F.col(ts).cast("timestamp")
    code = F.lit(None).cast("int") if status is None else F.col(status).cast("int")
    return requests.select(
        *by, at.alias("event_time"), F.unix_micros(at).alias("at"), code.alias("status")
    ).withWatermark("event_time", lateness)


def _processed(timed: DataFrame, by: Sequence[str], processor: Callable, longs: Sequence[str]) -> DataFrame:
    stateful(timed.sparkSession)
    keys = [StructField(name, timed.schema[name].dataType) for name in by]
    schema = StructType([*keys, *[StructField(name, LongType()) for name in longs]])
    return timed.groupBy(*by).transformWithState(processor, schema, "update", "eventTime")


def stream_timeline(
    requests: DataFrame,
    by: Sequence[str],
    ts: str = "started_at",
    bucket_seconds: float = 10.0,
    lateness: str = "1 minute",
) -> DataFrame:
    """Requests per bucket of each run of a stream, empty buckets included; the twin of ``request_timeline``.

    Each bucket is emitted once, when the watermark has passed its end. Rows without a run (a NULL in
    ``by``) are no requests, they only move the time on. Rows later than the watermark are left out.
    """
    width = int(bucket_seconds * 1_000_000)
    found = _processed(
        _timed(requests, by, ts, lateness, None), by, Buckets(by, width), ("bucket", "first_at", "requests")
    )
    start = F.timestamp_micros(F.col("first_at") + F.col("bucket") * F.lit(width))
    return found.select(*by, "bucket", start.alias("bucket_start"), "requests")


def stream_rate_audit(
    requests: DataFrame,
    by: Sequence[str],
    ts: str = "started_at",
    window_seconds: float = 60.0,
    lateness: str = "1 minute",
    status: str = "status_code",
) -> DataFrame:
    """Counts by outcome, busiest sliding window and longest gap of each run of a stream; the twin of ``request_rate_audit``.

    A row holds a run up to the watermark and is emitted anew when requests were added; all its numbers only
    grow, so the last one is the largest. A run's state is the requests of one window and those that wait for the watermark.
    Rows without a run only move the time on.
    """
    longs = ("total_requests", "status_200", "status_429", "other_errors", "max_requests_in_window", "longest_gap_micros")
    found = _processed(
        _timed(requests, by, ts, lateness, status), by, Pace(by, int(window_seconds * 1_000_000)), longs
    )
    return found.select(
        *by, *longs[:-1], (F.col("longest_gap_micros") / F.lit(1e6)).alias("longest_gap_seconds")
    )
