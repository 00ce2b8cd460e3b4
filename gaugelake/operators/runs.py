"""Run accounting: the run log, its summaries and the audit of request rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from gaugelake.functions.clock import Moment, minutes_between, moment_like, seconds_between, shift
from gaugelake.functions.labels import freshness_band
from gaugelake.operators.latest import newest
from gaugelake.schemas import RUN_LOG, conform


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def _or_zero(total: Column) -> Column:
    return F.coalesce(total, _zero())


def ingestion_overview(run_log: DataFrame, reference_ts: Moment = None) -> DataFrame:
    """Newest run per source and totals of the last 24 hours, zero where there were none.

    A run exactly 24 hours old is out. Newest run and totals come from one aggregation,
    combined on the map side, so a source may hold any share of the log.
    """
    since = shift(moment_like(run_log, "run_started_at", reference_ts), "HOUR", -24)
    recent = F.col("run_started_at") > since
    status = F.col("status")
    latest = (
        "run_started_at",
        "run_id",
        "status",
        "run_finished_at",
        "duration_seconds",
        "records_written",
        "error_message",
    )

    def total(column: str) -> Column:
        return _or_zero(F.sum(F.when(recent, F.col(column))))

    summed = run_log.groupBy("source").agg(
        newest(latest).alias("run"),
        F.count_if(recent).alias("runs_24h"),
        F.count_if(recent & (status == "success")).alias("successes_24h"),
        F.count_if(recent & (status == "error")).alias("errors_24h"),
        F.count_if(recent & (status == "partial_success")).alias("partials_24h"),
        total("records_written").alias("total_records_24h"),
        total("api_calls").alias("total_api_calls_24h"),
        total("api_errors").alias("total_api_errors_24h"),
    )
    return summed.select(
        "source",
        F.col("run.run_id").alias("latest_run_id"),
        F.col("run.status").alias("latest_run_status"),
        F.col("run.run_started_at").alias("latest_run_started_at"),
        F.col("run.run_finished_at").alias("latest_run_finished_at"),
        F.col("run.duration_seconds").alias("latest_run_duration_seconds"),
        F.col("run.records_written").alias("latest_run_records_written"),
        F.col("run.error_message").alias("latest_run_error_message"),
        *summed.columns[2:],
    )


def source_freshness(run_log: DataFrame, reference_ts: Moment = None) -> DataFrame:
    """Newest run per source, minutes since its last success, and the freshness band."""
    now = moment_like(run_log, "run_finished_at", reference_ts)
    latest = ("run_started_at", "run_id", "status", "records_written", "duration_seconds")
    summed = run_log.groupBy("source").agg(
        newest(latest).alias("run"),
        F.max(F.when(F.col("status") == "success", F.col("run_finished_at"))).alias("last_success"),
    )
    minutes = minutes_between(now, F.col("last_success"))
    return summed.select(
        "source",
        F.col("run.status").alias("status"),
        F.col("run.records_written").alias("records_written"),
        F.col("run.duration_seconds").alias("duration_seconds"),
        minutes.alias("minutes_since_last_success"),
        freshness_band(minutes).alias("freshness_band"),
    )


def daily_ingestion_stats(run_log: DataFrame, limit: int | None = 30) -> DataFrame:
    """Records, successes and errors per day and source, newest days first."""
    stats = (
        run_log.groupBy(F.to_date("run_started_at").alias("run_date"), "source")
        .agg(
            F.sum("records_written").alias("total_records"),
            F.count_if(F.col("status") == "success").alias("successes"),
            F.count_if(F.col("status") == "error").alias("errors"),
        )
        .orderBy(F.desc_nulls_last("run_date"), "source")
    )
    return stats if limit is None else stats.limit(limit)


def run_status(
    failure: Column, records: Column, failed: Column
) -> Column:
    """``error`` for a failed run, then ``empty``, ``partial_success``, ``success``.

    A run in which every request failed has no rows and is ``empty``.
    """
    return (
        F.when(failure.isNotNull(), "error")
        .when(records == 0, "empty")
        .when(failed > 0, "partial_success")
        .otherwise("success")
    )


def run_summary(
    rows: DataFrame,
    request_outcomes: DataFrame,
    failures: DataFrame | None = None,
    data_time: str = "period_from_utc",
    unit_column: str = "openaq_sensor_id",
) -> DataFrame:
    """Accounting of each run, from its rows and the outcomes of its requests.

    ``request_outcomes`` has one row per request: ``run_id``, ``ok`` and the requested unit, a
    sensor, or for forecasts the array of a batch's stations. Calls and errors count
    requests, the failed units those that any failed request asked for. ``failures`` names the runs that broke, with ``run_id``,
    ``unhandled_error`` and ``write_error``; the former takes precedence.

    Rows are first reduced to one per run, station and unit, so the distinct counts
    never expand the raw rows and a run may hold any share of them.
    """
    per_unit = (
        rows.withColumn("__unit", F.col(unit_column).cast("string"))
        .groupBy("run_id", "station_id", "__unit")
        .agg(
            F.count(F.lit(1)).alias("__rows"),
            F.min(data_time).alias("__min"),
            F.max(data_time).alias("__max"),
        )
    )
    data = per_unit.groupBy("run_id").agg(
        F.sum("__rows").alias("record_count"),
        F.count_distinct("station_id").alias("stations_with_data"),
        F.count_distinct("__unit").alias("sensors_with_data"),
        F.min("__min").alias("data_timestamp_min"),
        F.max("__max").alias("data_timestamp_max"),
    )
    asked = F.col(unit_column)
    if not isinstance(request_outcomes.schema[unit_column].dataType, ArrayType):
        asked = F.array(asked)
    good = F.coalesce(F.col("ok"), F.lit(False))
    # The first unit of a request stands for it in the count of calls.
    requested = (
        request_outcomes.select(
            "run_id", good.alias("__good"), F.posexplode_outer(asked.cast("array<string>")).alias("__place", "__unit")
        )
        .withColumn("__call", F.coalesce(F.col("__place"), F.lit(0)) == 0)
        .groupBy("run_id", "__unit")
        .agg(
            F.count_if(F.col("__call") & F.col("__good")).alias("__ok"),
            F.count_if(F.col("__call") & ~F.col("__good")).alias("__errors"),
            F.count_if(~F.col("__good")).alias("__failed"),
        )
    )
    failed_ids = F.sort_array(F.collect_list(F.when(F.col("__failed") > 0, F.col("__unit"))))
    requests = requested.groupBy("run_id").agg(
        F.count("__unit").alias("units_queried"),
        F.count_if((F.col("__failed") > 0) & F.col("__unit").isNotNull()).alias("units_failed"),
        F.sum("__ok").alias("api_calls"),
        F.sum("__errors").alias("api_errors"),
        failed_ids.alias("__failed_ids"),
    )
    joined = requests.join(data, "run_id", "full")
    if failures is None:
        failure = F.lit(None).cast("string")
    else:
        joined = joined.join(
            failures.select("run_id", "unhandled_error", "write_error"), "run_id", "full"
        )
        failure = F.coalesce("unhandled_error", "write_error")
    records = F.when(failure.isNotNull(), _zero()).otherwise(_or_zero(F.col("record_count")))
    return joined.select(
        "run_id",
        records.alias("record_count"),
        _or_zero(F.col("stations_with_data")).alias("stations_with_data"),
        _or_zero(F.col("sensors_with_data")).alias("sensors_with_data"),
        "data_timestamp_min",
        "data_timestamp_max",
        _or_zero(F.col("units_queried")).alias("units_queried"),
        _or_zero(F.col("units_failed")).alias("units_failed"),
        _or_zero(F.col("api_calls")).alias("api_calls"),
        _or_zero(F.col("api_errors")).alias("api_errors"),
        F.when(F.size("__failed_ids") > 0, F.to_json("__failed_ids")).alias("failed_ids"),
        run_status(failure, _or_zero(F.col("record_count")), _or_zero(F.col("units_failed"))).alias("status"),
        failure.alias("error_message"),
    )


def run_log_row(
    summary: DataFrame,
    source: str | Column,
    started: Column,
    finished: Column,
    logged: Column | None = None,
    window_start: Column | None = None,
    window_end: Column | None = None,
    by_station: bool = False,
) -> DataFrame:
    """Run-log rows of a :func:`run_summary`.

    ``by_station`` is for forecast runs, whose requests count as stations, not sensors.
    """
    counted = (F.col("units_queried"), F.col("units_failed"), F.col("failed_ids"))
    names = (
        ("stations_polled", "stations_failed", "failed_station_ids")
        if by_station
        else ("sensors_queried", "sensors_failed", "failed_sensor_ids")
    )
    row = summary.withColumns(
        {
            "source": F.lit(source) if isinstance(source, str) else source,
            "run_started_at": started,
            "run_finished_at": finished,
            "duration_seconds": seconds_between(finished, started),
            "records_written": F.col("record_count"),
            "window_start_utc": F.lit(None) if window_start is None else window_start,
            "window_end_utc": F.lit(None) if window_end is None else window_end,
            "ingested_at": finished if logged is None else logged,
            **dict(zip(names, counted)),
        }
    )
    return conform(row, RUN_LOG)


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def _quotient(value: Column, by: int) -> Column:
    """Whole quotient of BIGINTs; the division is exact because the remainder is taken off first."""
    return ((value - F.pmod(value, F.lit(by))) / F.lit(by)).cast("bigint")


def request_counts(requests: DataFrame, by: Sequence[str]) -> DataFrame:
    """Requests per run by outcome; no status code is a network error."""
    code = F.col("status_code")
    other = code.isNull() | ((code >= 400) & (code != 429))
    return requests.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.count_if(code == 200).alias("status_200"),
        F.count_if(code == 429).alias("status_429"),
        F.count_if(other).alias("other_errors"),
    )


def request_status_breakdown(requests: DataFrame, by: Sequence[str]) -> DataFrame:
    label = F.coalesce(F.col("status_code").cast("string"), F.lit("error"))
    return requests.groupBy(*by, label.alias("status")).agg(F.count(F.lit(1)).alias("requests"))


def _joined(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Neighbouring stretches of time as one, per ``keys``; the result has the form of the rows.

    A stretch has the ``change`` of the running count over it, the highest count (``peak``) if it starts
    at zero, the longest ``gap`` between its requests, and its first and last request.
    """
    earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.withColumns(
        {
            "carry": F.coalesce(F.sum("change").over(earlier), _zero()),
            "before": F.max("last_at").over(earlier),
        }
    )
    return carried.groupBy(*keys).agg(
        F.sum("change").alias("change"),
        F.max(F.col("carry") + F.col("peak")).alias("peak"),
        F.max(F.greatest(F.col("gap"), F.col("first_at") - F.col("before"))).alias("gap"),
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
    )


#: Seconds that one task puts together; the next step has a row for each such span of a run.
_SPAN_SECONDS = 4096


def request_pace(
    requests: DataFrame, by: Sequence[str], ts: str = "started_at", window_seconds: float = 60.0
) -> DataFrame:
    """Most requests in any sliding window, and the longest gap, per run.

    Each request counts +1 when it starts and -1 one window later; the running sum is
    the number of requests in ``(t - window, t]``. To keep a busy or a long run out of one task,
    instants are put together to seconds, seconds to spans and spans to the run: a task
    holds the distinct microseconds of a second, the seconds of a span, or one row per span of a
    run (some 80,000 for ten years).
    """
    width = int(window_seconds * 1_000_000)
    at = _micros(F.col(ts))
    changes = F.array(
        F.struct(at.alias("at"), F.lit(1).cast("bigint").alias("change"), at.alias("request_at")),
        F.struct(
            (at + F.lit(width)).alias("at"),
            F.lit(-1).cast("bigint").alias("change"),
            F.lit(None).cast("bigint").alias("request_at"),
        ),
    )
    instants = (
        requests.select(*by, F.inline(changes))
        .groupBy(*by, "at")
        .agg(F.sum("change").alias("change"), F.max("request_at").alias("first_at"))
        .select(
            "*",
            F.col("change").alias("peak"),
            F.lit(None).cast("bigint").alias("gap"),
            F.col("first_at").alias("last_at"),
            _quotient(F.col("at"), 1_000_000).alias("second"),
        )
    )
    seconds = _joined(instants, [*by, "second"], "at")
    spans = _joined(seconds.withColumn("span", _quotient(F.col("second"), _SPAN_SECONDS)), [*by, "span"], "second")
    whole = _joined(spans, by, "span")
    return whole.select(
        *by,
        F.col("peak").alias("max_requests_in_window"),
        F.coalesce(F.col("gap") / F.lit(1e6), F.lit(0.0)).alias("longest_gap_seconds"),
    )


def request_rate_audit(
    requests: DataFrame, by: Sequence[str], ts: str = "started_at", window_seconds: float = 60.0
) -> DataFrame:
    """Counts by outcome, busiest sliding window and longest gap, one row per run."""
    return request_counts(requests, by).join(request_pace(requests, by, ts, window_seconds), list(by))


#: Buckets that one task makes at a time.
_BUCKETS_AT_ONCE = 65_536


def request_timeline(
    requests: DataFrame, by: Sequence[str], ts: str = "started_at", bucket_seconds: float = 10.0
) -> DataFrame:
    """Requests per bucket from a run's first request to its last, empty buckets included.

    The buckets of a run are made in ranges that are dealt over the tasks, so a run may last long,
    or seem to by a stray time.
    """
    width = int(bucket_seconds * 1_000_000)
    instants = requests.groupBy(*by, _micros(F.col(ts)).alias("at")).agg(F.count(F.lit(1)).alias("requests"))
    span = requests.groupBy(*by).agg(
        F.min(_micros(F.col(ts))).alias("first_at"), F.max(_micros(F.col(ts))).alias("last_at")
    )
    position = _quotient(F.col("at") - F.col("first_at"), width)
    counted = (
        instants.join(span, list(by))
        .groupBy(*by, position.alias("bucket"))
        .agg(F.sum("requests").alias("requests"))
    )
    last = _quotient(F.col("last_at") - F.col("first_at"), width)
    most = F.lit(_BUCKETS_AT_ONCE).cast("bigint")
    ranges = (
        span.select(*by, "first_at", last.alias("last"))
        .select("*", F.explode(F.sequence(_zero(), _quotient(F.col("last"), _BUCKETS_AT_ONCE))).alias("range"))
        .repartition(*by, "range")
    )
    low = F.col("range") * most
    buckets = ranges.select(*by, "first_at", F.explode(F.sequence(low, F.least("last", low + most - 1))).alias("bucket"))
    return buckets.join(counted, [*by, "bucket"], "left").select(
        *by,
        "bucket",
        F.timestamp_micros(F.col("first_at") + F.col("bucket") * F.lit(width)).alias("bucket_start"),
        _or_zero(F.col("requests")).alias("requests"),
    )
