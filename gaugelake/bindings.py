"""Sensor-shaped frames derived from the general test tables.

The test tables hold orders, line items, suppliers and events. Each function here is a
narrow projection of whole tables (plus one dimension lookup), so the work of a query
grows with its input. ``DUCKDB`` states the same derivations as SQL, for the checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugelake.schemas import FORECAST_VARIABLES

# Event types as pollutants: (event type, code, pollutant, unit).
EVENT_POLLUTANTS = (
    ("click", 1, "pm25", "µg/m³"),
    ("view", 2, "pm10", "µg/m³"),
    ("purchase", 3, "no2", "µg/m³"),
    ("signup", 4, "o3", "µg/m³"),
    ("error", 5, "so2", "ppm"),
)
EPOCH = "TIMESTAMP_NTZ '2024-01-01 00:00:00'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _by_event(position: int) -> Column:
    choice = F.lit(None)
    for entry in EVENT_POLLUTANTS:
        choice = F.when(F.col("event_type") == entry[0], F.lit(entry[position])).otherwise(choice)
    return choice


def readings_of(events: DataFrame) -> DataFrame:
    """Events as reading versions: user = station, (user, type) = sensor, arrival = event time."""
    sensor = (F.col("user_id") * 10 + _by_event(1)).cast("bigint")
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    observed = F.pmod("event_id", F.lit(61)).cast("bigint")
    return events.select(
        F.col("ts").alias("ingested_at"),
        F.concat(
            F.lit("run-"),
            F.date_format("ts", "yyyyMMdd"),
            F.lit("-"),
            F.expr("user_id div 1000").cast("string"),
        ).alias("run_id"),
        F.col("user_id").cast("string").alias("station_id"),
        F.col("user_id").alias("openaq_location_id"),
        sensor.alias("openaq_sensor_id"),
        _by_event(2).alias("pollutant"),
        F.col("value"),
        _by_event(3).alias("unit"),
        hour.alias("period_from_utc"),
        F.timestamp_add("HOUR", F.lit(1), hour).alias("period_to_utc"),
        F.date_format(hour, "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("period_from_local"),
        F.concat(F.lit("H"), F.date_format(hour, "HH")).alias("period_label"),
        F.lit("1").alias("period_interval"),
        F.lit(60).cast("bigint").alias("coverage_expected"),
        observed.alias("coverage_observed"),
        (observed * F.lit(100.0) / F.lit(60.0)).alias("coverage_pct"),
        F.concat(sensor.cast("string"), F.lit("|"), hour.cast("string")).alias("dedup_key"),
    )


def _hours_after_epoch(hours: str) -> Column:
    return F.expr(f"timestampadd(HOUR, cast({hours} as int), {EPOCH})")


def forecasts_of(lineitem: DataFrame) -> DataFrame:
    """Line items as forecast versions: supplier = station, order and part give the times."""
    valid = _hours_after_epoch("(l_orderkey * 7 + l_linenumber) % 720")
    return lineitem.select(
        F.col("l_suppkey").cast("string").alias("station_id"),
        F.concat_ws("-", F.lit("fc"), "l_orderkey", "l_linenumber", "l_partkey").alias("run_id"),
        F.expr("cast(l_suppkey % 90 as double)").alias("latitude"),
        F.expr("cast(l_suppkey % 180 as double)").alias("longitude"),
        valid.alias("valid_time"),
        F.expr("(l_partkey % 400) / 10.0D - 5.0D").alias("temperature_2m"),
        F.expr("cast(l_partkey % 101 as double)").alias("relative_humidity_2m"),
        F.expr("980.0D + l_partkey % 60").alias("surface_pressure"),
        F.col("l_quantity").alias("wind_speed_10m"),
        F.expr("cast(l_partkey % 360 as double)").alias("wind_direction_10m"),
        F.expr("l_discount * 50.0D").alias("precipitation"),
        F.expr("l_tax * 1000.0D").alias("cloud_cover"),
        F.expr("l_extendedprice / 50.0D").alias("boundary_layer_height"),
        _hours_after_epoch("(l_orderkey + l_partkey) % 700").alias("ingested_at"),
        F.concat(F.col("l_suppkey").cast("string"), F.lit("|"), valid.cast("string")).alias("dedup_key"),
    )


def stations_of(supplier: DataFrame, nation: DataFrame, loads: int = 1) -> DataFrame:
    """Suppliers as stations; ``loads`` metadata versions each, the later ones loaded later."""
    version = F.explode(F.sequence(F.lit(0), F.lit(loads - 1))).alias("load")
    named = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey, "left").select("*", version)
    available = F.expr(
        """CASE (s_suppkey + load) % 4 WHEN 0 THEN 'no2,pm10,pm25' WHEN 1 THEN 'no2,o3,pm10,pm25'
           WHEN 2 THEN 'no2,pm25' ELSE 'no2,pm10,pm255' END"""
    )
    return named.select(
        F.col("s_suppkey").cast("string").alias("station_id"),
        F.col("s_suppkey").alias("openaq_location_id"),
        F.concat("s_name", F.lit("/"), F.col("load").cast("string")).alias("station_name"),
        F.concat(F.lit("Locality "), F.expr("cast(s_suppkey % 17 as string)")).alias("locality"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("country_code"),
        F.col("n_name").alias("country_name"),
        F.expr("CASE WHEN s_suppkey % 10 = 3 THEN NULL ELSE 43.0D + (s_suppkey % 40) / 10.0D END").alias(
            "latitude"
        ),
        F.expr("4.0D + (s_suppkey % 25) / 10.0D").alias("longitude"),
        F.lit("UTC").alias("timezone"),
        F.expr("s_suppkey % 11 = 0").alias("is_mobile"),
        F.expr("s_suppkey % 13 <> 0").alias("is_monitor"),
        F.col("s_nationkey").cast("bigint").alias("provider_id"),
        F.col("n_name").alias("provider_name"),
        F.expr("s_suppkey % 5").alias("owner_id"),
        F.concat(F.lit("Owner "), F.expr("cast(s_suppkey % 5 as string)")).alias("owner_name"),
        F.expr("TIMESTAMP_NTZ '2020-01-01 00:00:00'").alias("datetime_first_utc"),
        _hours_after_epoch("s_suppkey % 600").alias("datetime_last_utc"),
        available.alias("pollutants_available"),
        F.lit(3).cast("bigint").alias("sensor_count"),
        F.lit(None).cast("string").alias("raw_json"),
        _hours_after_epoch("load * 24").alias("loaded_at"),
    )


def sensors_of(events: DataFrame) -> DataFrame:
    """Distinct (user, event type) pairs as sensors; every third station lacks an NO2 sensor."""
    parameter = F.when(
        (F.col("user_id") % 3 == 0) & (F.col("event_type") == "purchase"), F.lit("co")
    ).otherwise(_by_event(2))
    return (
        events.select("user_id", "event_type")
        .distinct()
        .select(
            F.col("user_id").cast("string").alias("station_id"),
            F.col("user_id").alias("openaq_location_id"),
            (F.col("user_id") * 10 + _by_event(1)).cast("bigint").alias("openaq_sensor_id"),
            _by_event(1).cast("bigint").alias("parameter_id"),
            parameter.alias("parameter_name"),
            F.upper(parameter).alias("parameter_display_name"),
            _by_event(3).alias("parameter_units"),
            F.expr(EPOCH).alias("loaded_at"),
        )
    )


def run_log_of(orders: DataFrame) -> DataFrame:
    """Orders as runs: priority = source, status letter = status, order date = start."""
    status = F.expr("CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'error' ELSE 'partial_success' END")
    seconds = F.expr("cast(o_custkey % 900 as int)")
    finished = F.timestamp_add("SECOND", seconds, F.col("o_orderdate"))
    none = F.lit(None)
    return orders.select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.col("o_orderpriority").alias("source"),
        status.alias("status"),
        F.col("o_orderdate").alias("run_started_at"),
        finished.alias("run_finished_at"),
        seconds.cast("double").alias("duration_seconds"),
        F.floor("o_totalprice").cast("bigint").alias("records_written"),
        none.cast("bigint").alias("sensors_queried"),
        none.cast("bigint").alias("sensors_failed"),
        none.cast("bigint").alias("stations_polled"),
        none.cast("bigint").alias("stations_failed"),
        F.expr("o_custkey % 50").alias("api_calls"),
        F.expr("o_custkey % 3").alias("api_errors"),
        none.cast("timestamp_ntz").alias("window_start_utc"),
        none.cast("timestamp_ntz").alias("window_end_utc"),
        F.when(status == "error", F.concat(F.lit("E"), F.expr("cast(o_custkey % 7 as string)"))).alias(
            "error_message"
        ),
        none.cast("string").alias("failed_sensor_ids"),
        none.cast("string").alias("failed_station_ids"),
        finished.alias("ingested_at"),
    )


def requests_of(events: DataFrame) -> DataFrame:
    """Events as requests of the run of their day; the type gives the status code."""
    code = F.expr(
        """CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 200
           WHEN event_type = 'signup' THEN 429 WHEN event_id % 2 = 0 THEN 503 END"""
    )
    return events.select(
        F.to_date("ts").alias("run_date"), F.col("ts").alias("started_at"), code.alias("status_code")
    )


def outcomes_of(events: DataFrame) -> DataFrame:
    """Events as request outcomes of the runs of :func:`readings_of`; every seventh one failed."""
    return readings_of(events.filter(F.col("ts").isNotNull()).withColumn("value", F.col("event_id") % 7)).select(
        "run_id", "station_id", "openaq_sensor_id", (F.col("value") != 0).alias("ok")
    )


def reading_pages_of(events: DataFrame) -> DataFrame:
    """A page of JSON per event: its hour, the next hour at twice the value, and a malformed one."""
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")

    def text(offset: int) -> Column:
        return F.date_format(F.timestamp_add("HOUR", F.lit(offset), hour), "yyyy-MM-dd'T'HH:mm:ss'Z'")

    def item(offset: int, value: Column) -> Column:
        return F.struct(
            F.struct(
                F.struct(text(offset).alias("utc")).alias("datetimeFrom"),
                F.struct(text(offset + 1).alias("utc")).alias("datetimeTo"),
                F.lit("hour").alias("label"),
                F.lit("1").alias("interval"),
            ).alias("period"),
            F.struct(
                F.lit(60).alias("expectedCount"), F.pmod("event_id", F.lit(61)).alias("observedCount")
            ).alias("coverage"),
            value.alias("value"),
        )

    page = F.struct(
        F.array(
            item(0, F.col("value")), item(1, F.col("value") * 2.0), item(2, F.lit(None).cast("double"))
        ).alias("results")
    )
    return events.select(
        (F.col("user_id") * 10 + _by_event(1)).cast("bigint").alias("openaq_sensor_id"),
        F.col("ts").cast("timestamp").alias("ingested_at"),
        F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("run_id"),
        F.timestamp_add("HOUR", (1 + F.col("event_id") % 2).cast("int"), hour).cast("timestamp").alias("window_end"),
        F.to_json(page).alias("payload"),
    )


def forecast_batches_of(lineitem: DataFrame) -> DataFrame:
    """A batch of JSON per line item.

    Line 1 is a single location sent as an object. The others list two locations, with
    three hours, a value array that is too short and one that is too long. Line 7 lacks
    a result, so its batch is dropped.
    """
    start = _hours_after_epoch("(l_orderkey * 7 + l_linenumber) % 720")

    times = [F.date_format(F.timestamp_add("HOUR", F.lit(i), start), "yyyy-MM-dd'T'HH:mm") for i in range(3)]
    times[2] = F.concat(times[2], F.lit(":00+00:00"))
    hourly = F.struct(
        F.array(*times).alias("time"),
        F.array("l_quantity", "l_tax").alias("wind_speed_10m"),
        F.array("l_discount", "l_discount", "l_discount", "l_discount").alias("precipitation"),
        F.array("l_extendedprice", F.lit(None).cast("double"), "l_quantity").alias("boundary_layer_height"),
    )
    # The hours of both locations are the same text, written once.
    hours = F.to_json(F.struct(hourly.alias("hourly"))).alias("hours")

    def location(key: Column) -> Column:
        latitude = F.concat(F.lit('"latitude":'), key.cast("double").cast("string"), F.lit(","))
        return F.concat(F.lit("{"), F.coalesce(latitude, F.lit("")), F.substr("hours", F.lit(2)))

    first, second = F.col("l_suppkey"), F.col("l_partkey")
    single = location(first)
    pair = F.concat(F.lit("["), location(first), F.lit(","), location(second), F.lit("]"))
    lacking = F.concat(F.lit("["), location(first), F.lit("]"))

    def station(key: Column, kind: str) -> Column:
        return F.struct(
            F.concat(F.lit(kind), key.cast("string")).alias("station_id"),
            (key % 90).cast("double").alias("latitude"),
            (key % 180).cast("double").alias("longitude"),
        )

    line = F.col("l_linenumber")
    return lineitem.select("*", hours).select(
        F.when(line == 1, single).when(line == 7, lacking).otherwise(pair).alias("payload"),
        F.when(line == 1, F.array(station(first, "s"))).otherwise(
            F.array(station(first, "s"), station(second, "p"))
        ).alias("stations"),
        F.expr(EPOCH).cast("timestamp").alias("ingested_at"),
        F.concat_ws("-", F.lit("fc"), "l_orderkey", "l_linenumber", "l_partkey").alias("run_id"),
    )


def catalogue_pages_of(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """A catalogue page of JSON per supplier, with gaps: no coordinates, no flags, other sensors."""
    key = F.col("s_suppkey")

    def sensor(code: int, name: Column, unit: str) -> Column:
        return F.struct(
            (key * 10 + code).alias("id"),
            F.struct(
                F.lit(code).alias("id"),
                name.alias("name"),
                F.upper(name).alias("displayName"),
                F.lit(unit).alias("units"),
            ).alias("parameter"),
        )

    sensors = F.array(
        sensor(1, F.when(key % 9 == 4, "co").otherwise("pm25"), "µg/m³"),
        sensor(2, F.when(key % 3 == 0, "pm10").otherwise("co"), "µg/m³"),
        sensor(3, F.when(key % 2 == 0, "o3").otherwise("co"), "ppm"),
    )
    item = F.struct(
        key.alias("id"),
        F.col("s_name").alias("name"),
        F.when(key % 7 != 5, key % 7 == 3).alias("isMobile"),
        F.when(key % 17 != 0, True).alias("isMonitor"),
        F.when(
            key % 10 != 3,
            F.struct(
                (F.lit(43.0) + (key % 40) / F.lit(10.0)).alias("latitude"),
                (F.lit(4.0) + (key % 25) / F.lit(10.0)).alias("longitude"),
            ),
        ).alias("coordinates"),
        F.struct(
            F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("code"), F.col("n_name").alias("name")
        ).alias("country"),
        F.struct(F.lit("2020-01-01T00:00:00Z").alias("utc")).alias("datetimeFirst"),
        sensors.alias("sensors"),
    )
    named = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey, "left")
    return named.select(F.to_json(F.struct(F.array(item).alias("results"))).alias("payload"))


def _case_sql(position: int) -> str:
    arms = " ".join(
        f"WHEN '{e[0]}' THEN {e[position] if position == 1 else repr(e[position])}" for e in EVENT_POLLUTANTS
    )
    return f"CASE event_type {arms} END"


_HOUR = "date_trunc('hour', ts)::TIMESTAMP"
_VALID = "(TIMESTAMP '2024-01-01' + to_hours(((l_orderkey * 7 + l_linenumber) % 720)::INT))"

# The same derivations for DuckDB, as common table expressions.
DUCKDB = {
    "readings": f"""readings AS (
  SELECT ts AS ingested_at,
    'run-' || strftime(ts, '%Y%m%d') || '-' || (user_id // 1000)::VARCHAR AS run_id,
    user_id::VARCHAR AS station_id, user_id AS openaq_location_id,
    (user_id * 10 + {_case_sql(1)})::BIGINT AS openaq_sensor_id,
    {_case_sql(2)} AS pollutant, value, {_case_sql(3)} AS unit,
    {_HOUR} AS period_from_utc, {_HOUR} + INTERVAL 1 HOUR AS period_to_utc,
    strftime({_HOUR}, '%Y-%m-%dT%H:%M:%S+00:00') AS period_from_local,
    'H' || strftime({_HOUR}, '%H') AS period_label, '1' AS period_interval,
    60::BIGINT AS coverage_expected, (event_id % 61)::BIGINT AS coverage_observed,
    (event_id % 61)::DOUBLE * 100.0::DOUBLE / 60.0::DOUBLE AS coverage_pct,
    (user_id * 10 + {_case_sql(1)})::VARCHAR || '|' || ({_HOUR})::VARCHAR AS dedup_key
  FROM events)""",
    "forecasts": f"""forecasts AS (
  SELECT l_suppkey::VARCHAR AS station_id,
    'fc-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey AS run_id,
    (l_suppkey % 90)::DOUBLE AS latitude, (l_suppkey % 180)::DOUBLE AS longitude,
    {_VALID} AS valid_time,
    (l_partkey % 400)::DOUBLE / 10.0::DOUBLE - 5.0::DOUBLE AS temperature_2m,
    (l_partkey % 101)::DOUBLE AS relative_humidity_2m,
    980.0::DOUBLE + (l_partkey % 60)::DOUBLE AS surface_pressure,
    l_quantity AS wind_speed_10m, (l_partkey % 360)::DOUBLE AS wind_direction_10m,
    l_discount * 50.0::DOUBLE AS precipitation, l_tax * 1000.0::DOUBLE AS cloud_cover,
    l_extendedprice / 50.0::DOUBLE AS boundary_layer_height,
    TIMESTAMP '2024-01-01' + to_hours(((l_orderkey + l_partkey) % 700)::INT) AS ingested_at,
    l_suppkey::VARCHAR || '|' || {_VALID}::VARCHAR AS dedup_key
  FROM lineitem)""",
    "station_loads": """station_loads AS (
  SELECT s_suppkey::VARCHAR AS station_id, s_suppkey AS openaq_location_id,
    s_name || '/' || load AS station_name, 'Locality ' || (s_suppkey % 17) AS locality,
    'N' || n_nationkey AS country_code, n_name AS country_name,
    CASE WHEN s_suppkey % 10 = 3 THEN NULL
         ELSE 43.0::DOUBLE + (s_suppkey % 40)::DOUBLE / 10.0::DOUBLE END AS latitude,
    4.0::DOUBLE + (s_suppkey % 25)::DOUBLE / 10.0::DOUBLE AS longitude,
    TIMESTAMP '2024-01-01' + to_hours((s_suppkey % 600)::INT) AS datetime_last_utc,
    CASE (s_suppkey + load) % 4 WHEN 0 THEN 'no2,pm10,pm25' WHEN 1 THEN 'no2,o3,pm10,pm25'
      WHEN 2 THEN 'no2,pm25' ELSE 'no2,pm10,pm255' END AS pollutants_available,
    TIMESTAMP '2024-01-01' + to_hours((load * 24)::INT) AS loaded_at, load
  FROM (SELECT *, unnest([0, 1]) AS load FROM supplier)
  LEFT JOIN nation ON s_nationkey = n_nationkey)""",
    "stations": "stations AS (SELECT * FROM station_loads WHERE load = 0)",
    "sensors": f"""sensors AS (
  SELECT user_id::VARCHAR AS station_id, user_id AS openaq_location_id,
    (user_id * 10 + {_case_sql(1)})::BIGINT AS openaq_sensor_id,
    CASE WHEN user_id % 3 = 0 AND event_type = 'purchase' THEN 'co' ELSE {_case_sql(2)} END AS parameter_name,
    {_case_sql(3)} AS parameter_units
  FROM (SELECT DISTINCT user_id, event_type FROM events))""",
    "run_log": """run_log AS (
  SELECT o_orderkey::VARCHAR AS run_id, o_orderpriority AS source,
    CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'error' ELSE 'partial_success' END AS status,
    o_orderdate AS run_started_at, o_orderdate + to_seconds((o_custkey % 900)::INT) AS run_finished_at,
    (o_custkey % 900)::DOUBLE AS duration_seconds, floor(o_totalprice)::BIGINT AS records_written,
    (o_custkey % 50)::BIGINT AS api_calls, (o_custkey % 3)::BIGINT AS api_errors,
    CASE WHEN o_orderstatus = 'O' THEN 'E' || (o_custkey % 7) END AS error_message
  FROM orders)""",
    "requests": """requests AS (
  SELECT ts::DATE AS run_date, ts AS started_at,
    CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 200
         WHEN event_type = 'signup' THEN 429 WHEN event_id % 2 = 0 THEN 503 END AS status_code
  FROM events)""",
    "outcomes": f"""outcomes AS (
  SELECT 'run-' || strftime(ts, '%Y%m%d') || '-' || (user_id // 1000)::VARCHAR AS run_id,
    user_id::VARCHAR AS station_id, (user_id * 10 + {_case_sql(1)})::BIGINT AS openaq_sensor_id,
    event_id % 7 <> 0 AS ok
  FROM events)""",
    "dedup_readings": """dedup_readings AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY ingested_at DESC NULLS LAST,
      run_id DESC NULLS LAST, value DESC NULLS LAST, unit DESC NULLS LAST, coverage_observed DESC) AS rn
    FROM readings) WHERE rn = 1)""",
    "dedup_forecasts": f"""dedup_forecasts AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY station_id, valid_time ORDER BY ingested_at DESC NULLS LAST,
      run_id DESC NULLS LAST, {", ".join(f"{v} DESC NULLS LAST" for v in FORECAST_VARIABLES)}) AS rn
    FROM forecasts) WHERE rn = 1)""",
    "latest_metadata": """latest_metadata AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY station_id
      ORDER BY loaded_at DESC NULLS LAST, datetime_last_utc DESC NULLS LAST) AS rn
    FROM station_loads) WHERE rn = 1)""",
}


def ctes(*names: str) -> str:
    """``WITH`` clause of the named derivations and what they build on."""
    needs = {
        "stations": ("station_loads",),
        "dedup_readings": ("readings",),
        "dedup_forecasts": ("forecasts",),
        "latest_metadata": ("station_loads",),
    }
    ordered: dict[str, None] = {}
    for name in names:
        for base in (*needs.get(name, ()), name):
            ordered[base] = None
    return "WITH " + ",\n".join(DUCKDB[name] for name in ordered)
