"""SQL twins of the registered queries, for DuckDB over the same test tables.

They are written from the meaning of each query, not from its Spark plan: plain
ranking, joins and aggregates, without the shortcuts the operators take.
"""

from __future__ import annotations

from gaugelake.bindings import _HOUR, _case_sql, ctes

# Reference times of the registered queries.
OUTLOOK_TS = "2024-01-25 00:00:00"
FRESHNESS_TS = "2024-01-31 00:00:00"
TWO_SOURCE_TS = "2024-01-30 12:00:00"
RUNS_TS = "2001-08-01 12:00:00"
RETENTION_TS = "2024-02-10 00:00:00"
LOADED_AT = "2024-02-01 00:00:00"
INGEST_TS = "2024-02-01 00:20:00"
SERIES_DAYS = 14
AUDIT_WINDOW_SECONDS = 600
AUDIT_BUCKET_SECONDS = 3600
FIRST_SENSORS = 30

_TRACKED = "('pm25', 'pm10', 'no2')"


def _r6(column: str) -> str:
    return f"floor(({column}) * 1000000.0::DOUBLE + 0.5::DOUBLE) / 1000000.0::DOUBLE"


def _ranked_latest(pollutants: str = _TRACKED) -> str:
    return f"""ranked AS (
  SELECT *, row_number() OVER (PARTITION BY station_id, pollutant
    ORDER BY period_from_utc DESC, ingested_at DESC, openaq_sensor_id DESC) AS rn
  FROM dedup_readings WHERE pollutant IN {pollutants}),
latest AS (
  SELECT station_id, {", ".join(
      f"max(CASE WHEN pollutant = '{p}' THEN {c} END) AS {p}_{n}"
      for p in ("pm25", "pm10", "no2")
      for n, c in (("value", "value"), ("unit", "unit"), ("time", "period_from_utc"))
  )}, max(period_from_utc) AS latest_reading_time
  FROM ranked WHERE rn = 1 GROUP BY station_id)"""


_COMBINED = f"""hour_values AS (
  SELECT station_id, openaq_location_id, period_from_utc AS hour_utc,
    {", ".join(f"max(CASE WHEN pollutant = '{p}' THEN value END) AS {p}_value" for p in ("pm25", "pm10", "no2"))}
  FROM dedup_readings WHERE pollutant IN {_TRACKED} GROUP BY ALL),
combined AS (
  SELECT h.station_id, h.hour_utc, h.pm25_value, h.pm10_value, h.no2_value, w.temperature_2m,
    w.relative_humidity_2m, w.wind_speed_10m, w.wind_direction_10m, w.precipitation, w.cloud_cover,
    w.boundary_layer_height
  FROM hour_values h LEFT JOIN dedup_forecasts w
    ON h.station_id = w.station_id AND h.hour_utc = w.valid_time)"""

_LONG = """long AS (
  SELECT station_id, hour_utc, temperature_2m, relative_humidity_2m, wind_speed_10m, wind_direction_10m,
    precipitation, cloud_cover, boundary_layer_height, p.pollutant, p.pollutant_value
  FROM (SELECT *, unnest([{'pollutant': 'pm25', 'pollutant_value': pm25_value},
    {'pollutant': 'pm10', 'pollutant_value': pm10_value},
    {'pollutant': 'no2', 'pollutant_value': no2_value}]) AS p FROM combined)
  WHERE p.pollutant_value IS NOT NULL)"""


def _clamped(column: str, full: float) -> str:
    return f"CASE WHEN {column} IS NULL THEN 0.0::DOUBLE ELSE least(greatest({column} / {full}::DOUBLE, 0.0::DOUBLE), 1.0::DOUBLE) END"


_OUTLOOK = f"""scored AS (
  SELECT *, {_clamped("boundary_layer_height", 1500.0)} AS blh_score,
    {_clamped("wind_speed_10m", 25.0)} AS wind_score, {_clamped("precipitation", 3.0)} AS precip_score
  FROM dedup_forecasts WHERE valid_time > TIMESTAMP '{OUTLOOK_TS}'),
summed AS (
  SELECT *, 0.40::DOUBLE * blh_score + 0.35::DOUBLE * wind_score + 0.25::DOUBLE * precip_score AS raw_score
  FROM scored),
outlook AS (
  SELECT d.station_id, d.valid_time, d.latitude, d.longitude, d.temperature_2m, d.relative_humidity_2m,
    d.surface_pressure, d.wind_speed_10m, d.wind_direction_10m, d.precipitation, d.cloud_cover,
    d.boundary_layer_height, d.blh_score, d.wind_score, d.precip_score,
    floor(raw_score * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE AS dispersion_score,
    CASE WHEN raw_score < 0.30::DOUBLE THEN 'poor' WHEN raw_score <= 0.55::DOUBLE THEN 'fair'
      ELSE 'good' END AS outlook_category,
    p.pm25_value AS latest_pm25, p.pm25_unit, p.pm25_time AS latest_pm25_time,
    m.station_name, m.locality, m.country_code
  FROM summed d LEFT JOIN latest p ON d.station_id = p.station_id
    LEFT JOIN stations m ON d.station_id = m.station_id)"""

_TWO_SOURCE = f"""eligible AS (
  SELECT * FROM latest_metadata
  WHERE latitude IS NOT NULL AND list_has_all(string_split(lower(pollutants_available), ','), ['pm25', 'pm10', 'no2'])),
read AS (SELECT station_id, max(period_from_utc) AS last_openaq_utc FROM dedup_readings GROUP BY station_id),
issued AS (SELECT station_id, max(ingested_at) AS last_weather_utc FROM dedup_forecasts GROUP BY station_id),
aged AS (
  SELECT e.station_id, e.station_name, e.latitude, e.longitude, r.last_openaq_utc, i.last_weather_utc,
    date_sub('microsecond', r.last_openaq_utc, TIMESTAMP '{TWO_SOURCE_TS}')::DOUBLE / 3600000000.0::DOUBLE AS openaq_age_hours,
    date_sub('microsecond', i.last_weather_utc, TIMESTAMP '{TWO_SOURCE_TS}')::DOUBLE / 3600000000.0::DOUBLE AS weather_age_hours
  FROM eligible e LEFT JOIN read r ON e.station_id = r.station_id LEFT JOIN issued i ON e.station_id = i.station_id),
flagged AS (
  SELECT *, coalesce(openaq_age_hours > 2, false) AS openaq_stale, coalesce(weather_age_hours > 12, false) AS weather_stale,
    greatest(last_openaq_utc, last_weather_utc) AS last_data_update_utc,
    least(openaq_age_hours, weather_age_hours) AS last_data_update_age_hours FROM aged),
minuted AS (
  SELECT *, openaq_stale OR weather_stale AS overall_stale,
    greatest(round_even(last_data_update_age_hours * 60, 0), 0)::BIGINT AS mins FROM flagged),
two_source AS (
  SELECT station_id, station_name, latitude, longitude, openaq_age_hours, weather_age_hours, openaq_stale,
    weather_stale, overall_stale, last_openaq_utc, last_weather_utc, last_data_update_utc,
    last_data_update_age_hours,
    CASE WHEN last_data_update_age_hours IS NULL THEN 'No data yet'
      WHEN mins >= 1440 THEN (mins // 1440) || 'd ' || ((mins % 1440) // 60) || 'h ago'
      WHEN mins >= 60 THEN (mins // 60) || 'h ' || (mins % 60) || 'm ago'
      ELSE mins || 'm ago' END AS last_data_update_label,
    CASE WHEN openaq_age_hours IS NULL AND weather_age_hours IS NULL THEN 'No data'
      WHEN weather_age_hours IS NULL OR (openaq_age_hours IS NOT NULL AND openaq_age_hours <= weather_age_hours)
      THEN 'OpenAQ' ELSE 'Weather' END AS last_data_update_source,
    coalesce(strftime(last_data_update_utc, '%Y-%m-%d %H:%M UTC'), 'No data') AS last_data_update_utc_label,
    CASE WHEN openaq_stale AND weather_stale THEN 'red' WHEN overall_stale THEN 'yellow' ELSE 'green' END AS severity_class
  FROM minuted)"""

_RUN_SUMMARY = """data AS (
  SELECT run_id, count(*)::BIGINT AS record_count, count(DISTINCT station_id)::BIGINT AS stations_with_data,
    count(DISTINCT openaq_sensor_id)::BIGINT AS sensors_with_data,
    min(period_from_utc) AS data_timestamp_min, max(period_from_utc) AS data_timestamp_max
  FROM readings GROUP BY run_id),
asked AS (
  SELECT run_id, count(DISTINCT openaq_sensor_id)::BIGINT AS units_queried,
    count(DISTINCT CASE WHEN NOT ok THEN openaq_sensor_id END)::BIGINT AS units_failed,
    count(*) FILTER (WHERE ok)::BIGINT AS api_calls, count(*) FILTER (WHERE NOT ok)::BIGINT AS api_errors,
    list_sort(list(DISTINCT openaq_sensor_id::VARCHAR) FILTER (WHERE NOT ok)) AS ids
  FROM outcomes GROUP BY run_id),
summary AS (
  SELECT coalesce(a.run_id, d.run_id) AS run_id, coalesce(record_count, 0)::BIGINT AS record_count,
    coalesce(stations_with_data, 0)::BIGINT AS stations_with_data,
    coalesce(sensors_with_data, 0)::BIGINT AS sensors_with_data, data_timestamp_min, data_timestamp_max,
    coalesce(units_queried, 0)::BIGINT AS units_queried, coalesce(units_failed, 0)::BIGINT AS units_failed,
    coalesce(api_calls, 0)::BIGINT AS api_calls, coalesce(api_errors, 0)::BIGINT AS api_errors,
    '["' || array_to_string(ids, '","') || '"]' AS failed_ids,
    CASE WHEN coalesce(record_count, 0) = 0 THEN 'empty' WHEN units_failed > 0 THEN 'partial_success'
      ELSE 'success' END AS status,
    NULL::VARCHAR AS error_message
  FROM asked a FULL JOIN data d ON a.run_id = d.run_id)"""

_CATALOGUE = """items AS (
  SELECT s_suppkey AS id, s_name AS name, CASE WHEN s_suppkey % 7 <> 5 THEN s_suppkey % 7 = 3 END AS is_mobile,
    CASE WHEN s_suppkey % 17 <> 0 THEN true END AS is_monitor,
    CASE WHEN s_suppkey % 10 <> 3 THEN 43.0::DOUBLE + (s_suppkey % 40)::DOUBLE / 10.0::DOUBLE END AS latitude,
    CASE WHEN s_suppkey % 10 <> 3 THEN 4.0::DOUBLE + (s_suppkey % 25)::DOUBLE / 10.0::DOUBLE END AS longitude,
    'N' || n_nationkey AS country_code, n_name AS country_name,
    [CASE WHEN s_suppkey % 9 = 4 THEN 'co' ELSE 'pm25' END, CASE WHEN s_suppkey % 3 = 0 THEN 'pm10' ELSE 'co' END,
     CASE WHEN s_suppkey % 2 = 0 THEN 'o3' ELSE 'co' END] AS sensor_names
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey),
targeted AS (
  SELECT *, list_sort(list_distinct(list_filter(sensor_names, lambda n: n IN ('pm25', 'pm10', 'o3', 'no2', 'so2')))) AS targets
  FROM items),
judged AS (
  SELECT *, CASE WHEN coalesce(is_mobile, true) THEN 'mobile' WHEN NOT coalesce(is_monitor, false) THEN 'not_monitor'
    WHEN latitude IS NULL OR longitude IS NULL THEN 'no_coords' WHEN len(targets) = 0 THEN 'no_target_pollutant'
    END AS skip_reason FROM targeted),
kept AS (
  SELECT *, array_to_string(targets, ',') AS pollutants_available, '{"id":' || id || ',"name":"' || name || '"'
      || coalesce(',"isMobile":' || is_mobile, '') || coalesce(',"isMonitor":' || is_monitor, '')
      || coalesce(',"coordinates":{"latitude":' || latitude || ',"longitude":' || longitude || '}', '')
      || ',"country":{"code":"' || country_code || '","name":"' || country_name
      || '"},"datetimeFirst":{"utc":"2020-01-01T00:00:00Z"},"sensors":['
      || array_to_string(list_transform([1, 2, 3], lambda i: '{"id":' || (id * 10 + i) || ',"parameter":{"id":' || i
        || ',"name":"' || sensor_names[i] || '","displayName":"' || upper(sensor_names[i]) || '","units":"'
        || ['µg/m³', 'µg/m³', 'ppm'][i] || '"}}'), ',') || ']}' AS raw_json
  FROM judged WHERE skip_reason IS NULL),
kept_sensors AS (
  SELECT 'openaq:' || id AS station_id, id AS openaq_location_id, (id * 10 + code)::BIGINT AS openaq_sensor_id,
    code::BIGINT AS parameter_id, sensor_names[code] AS parameter_name,
    upper(sensor_names[code]) AS parameter_display_name,
    CASE WHEN code = 3 THEN 'ppm' ELSE 'µg/m³' END AS parameter_units
  FROM (SELECT *, unnest([1, 2, 3]) AS code FROM kept)
  WHERE sensor_names[code] IN ('pm25', 'pm10', 'o3', 'no2', 'so2'))"""

_PAGES = f"""page_items AS (
  SELECT (user_id * 10 + {_case_sql(1)})::BIGINT AS openaq_sensor_id, ts AS ingested_at, 'run-' || event_id AS run_id,
    {_HOUR} + to_hours((1 + event_id % 2)::INT) AS window_end, event_id, value AS base, k,
    {_HOUR} + to_hours(k::INT) AS period_from_utc, {_HOUR} + to_hours((k + 1)::INT) AS period_to_utc
  FROM (SELECT *, unnest([0, 1, 2]) AS k FROM events)),
judged_items AS (
  SELECT p.*, s.station_id, s.openaq_location_id, s.parameter_name AS pollutant, s.parameter_units AS unit,
    CASE WHEN k = 2 OR base IS NULL THEN 'malformed' WHEN p.period_to_utc > p.window_end THEN 'incomplete_hour'
      END AS reject_reason
  FROM page_items p JOIN sensors s ON p.openaq_sensor_id = s.openaq_sensor_id)"""

_BATCHES = """batches AS (
  SELECT *, TIMESTAMP '2024-01-01' + to_hours(((l_orderkey * 7 + l_linenumber) % 720)::INT) AS start_time,
    'fc-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey AS run_id,
    CASE WHEN l_linenumber = 1 THEN [{'kind': 's', 'key': l_suppkey}]
         ELSE [{'kind': 's', 'key': l_suppkey}, {'kind': 'p', 'key': l_partkey}] END AS places
  FROM lineitem WHERE l_linenumber <> 7),
batch_stations AS (SELECT *, unnest(places) AS place FROM batches),
batch_hours AS (SELECT *, unnest([0, 1, 2]) AS j FROM batch_stations)"""


_SHOWN = """shown AS (
  SELECT station_id FROM readings WHERE pollutant = 'pm25'
  ORDER BY period_from_utc DESC NULLS LAST, station_id DESC LIMIT 1)"""


def _violations(name: str, entity: str, expected: str, actual: str, reason: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS test_name, {entity} AS entity_id, {expected} AS expected_value, "
        f"{actual} AS actual_value, '{reason}' AS reason FROM {source}"
    )


_UNIQUE = _violations(
    "readings_unique", "dedup_key", "'1'", "n::VARCHAR", "Duplicate key",
    "(SELECT dedup_key, count(*) AS n FROM readings GROUP BY dedup_key HAVING count(*) > 1)",
)
_ROW_COUNT = _violations(
    "five_sensors", "station_id", "'5'", "n::VARCHAR", "Unexpected number of rows",
    "(SELECT station_id, count(*) AS n FROM sensors WHERE parameter_name <> 'co' GROUP BY 1 HAVING count(*) <> 5)",
)
_MEMBERS = _violations(
    "run_ok", "run_id", "'success,partial_success'", "status", "Value is not allowed",
    "run_log WHERE status NOT IN ('success', 'partial_success')",
)
_NO_ROWS = _violations(
    "no_poor_hour", "station_id || ':' || valid_time::VARCHAR", "'no rows'", "outlook_category",
    "Rows should not exist", "outlook WHERE outlook_category = 'poor'",
)
_NOT_NULL = _violations(
    "metadata_present", "e.station_id", "'not NULL'",
    """CASE WHEN l.station_id IS NULL THEN 'missing' ELSE
      'station_name:' || coalesce(m.station_name, 'NULL') || ',locality:' || coalesce(m.locality, 'NULL') END""",
    "Row should exist with non-NULL values",
    """(SELECT DISTINCT station_id FROM sensors) e LEFT JOIN latest l ON e.station_id = l.station_id
    LEFT JOIN stations m ON l.station_id = m.station_id
    WHERE l.station_id IS NULL OR m.station_name IS NULL OR m.locality IS NULL""",
)

_READING_COLUMNS = """ingested_at, run_id, station_id, openaq_location_id, openaq_sensor_id, pollutant, value, unit,
  period_from_utc, period_to_utc, period_from_local, period_label, period_interval, coverage_expected,
  coverage_observed, coverage_pct, dedup_key"""


def sql() -> dict[str, str]:
    two_source = ctes("dedup_readings", "dedup_forecasts", "latest_metadata") + ",\n" + _TWO_SOURCE
    combined = ctes("dedup_readings", "dedup_forecasts") + ",\n" + _COMBINED
    long = combined + ",\n" + _LONG
    outlook = ctes("dedup_readings", "dedup_forecasts", "stations") + ",\n" + _ranked_latest() + ",\n" + _OUTLOOK
    run_summary = ctes("readings", "outcomes") + ",\n" + _RUN_SUMMARY
    items = "WITH " + _CATALOGUE
    pages = ctes("sensors") + ",\n" + _PAGES
    window_us = AUDIT_WINDOW_SECONDS * 1_000_000 - 1
    bucket_us = AUDIT_BUCKET_SECONDS * 1_000_000
    units = "{0}_unit".format
    report = f"""{ctes("dedup_readings", "dedup_forecasts", "stations", "sensors", "run_log")},
{_ranked_latest()},
{_OUTLOOK},
found AS (
  {_UNIQUE} UNION ALL {_ROW_COUNT} UNION ALL {_MEMBERS} UNION ALL {_NO_ROWS} UNION ALL {_NOT_NULL}
  UNION ALL SELECT 'positive_value', dedup_key, '', '', '' FROM readings WHERE value IS NULL),
names AS (SELECT unnest(['five_sensors', 'metadata_present', 'missing_column', 'no_poor_hour', 'positive_value',
  'readings_unique', 'run_ok']) AS test_name),
placed AS (SELECT *, row_number() OVER (PARTITION BY test_name ORDER BY entity_id NULLS FIRST,
  expected_value NULLS FIRST, actual_value NULLS FIRST, reason NULLS FIRST) AS place FROM found)
SELECT n.test_name, CASE WHEN n.test_name = 'missing_column' THEN 'error' WHEN count(f.test_name) > 0 THEN 'failed'
  ELSE 'passed' END AS status, count(f.test_name) AS violations,
  coalesce(string_agg(coalesce(entity_id, '') || '|' || coalesce(expected_value, '') || '|' || coalesce(actual_value, '')
    || '|' || coalesce(reason, ''), '; ' ORDER BY place) FILTER (WHERE place <= 5), '') AS samples,
  CASE WHEN n.test_name = 'missing_column' THEN 'UNRESOLVED_COLUMN' END AS error_class
FROM names n LEFT JOIN placed f ON n.test_name = f.test_name GROUP BY n.test_name"""
    found = {
        "dedup_latest_readings": f"{ctes('dedup_readings')} SELECT * FROM dedup_readings",
        "dedup_latest_forecasts": f"{ctes('dedup_forecasts')} SELECT * FROM dedup_forecasts",
        "station_latest_pollutants": f"""{ctes("dedup_readings", "stations")},
{_ranked_latest()}
SELECT l.*, m.station_name, m.locality, m.country_code, m.latitude, m.longitude
FROM latest l LEFT JOIN stations m ON l.station_id = m.station_id""",
        "station_hourly_wide": f"""{ctes("dedup_readings")}
SELECT station_id, period_from_utc AS hour_utc,
  {", ".join(f"max(CASE WHEN pollutant = '{p}' THEN {c} END) AS {p}_{c}" for p in ("pm25", "pm10", "no2") for c in ("value", "unit"))},
  max(ingested_at) AS latest_ingested_at
FROM dedup_readings WHERE pollutant IN {_TRACKED} GROUP BY station_id, period_from_utc""",
        "station_hourly_combined": f"{combined} SELECT * FROM combined",
        "station_hourly_long": f"{long} SELECT * FROM long",
        "station_current_outlook": f"""{ctes("dedup_readings", "dedup_forecasts", "stations")},
{_ranked_latest()},
basis AS (SELECT station_id, max(ingested_at) AS t FROM dedup_forecasts GROUP BY station_id),
ow AS (
  SELECT b.station_id, b.t, avg(w.temperature_2m) AS a1, avg(w.relative_humidity_2m) AS a2,
    avg(w.cloud_cover) AS a3, avg(w.boundary_layer_height) AS a4, sum(w.precipitation) AS a5,
    max(w.wind_speed_10m) AS a6, count(w.valid_time) AS hours
  FROM basis b LEFT JOIN dedup_forecasts w ON b.station_id = w.station_id AND b.t < w.valid_time
    AND w.valid_time <= b.t + INTERVAL 3 HOUR
  GROUP BY b.station_id, b.t)
SELECT l.station_id, l.pm25_value, l.pm10_value, l.no2_value, l.latest_reading_time,
  o.t AS latest_weather_ingested_at, {_r6("o.a1")} AS avg_temperature_2m,
  {_r6("o.a2")} AS avg_relative_humidity_2m, {_r6("o.a3")} AS avg_cloud_cover,
  {_r6("o.a4")} AS avg_boundary_layer_height, {_r6("o.a5")} AS total_precipitation,
  o.a6 AS max_wind_speed_10m, m.station_name, m.locality, m.country_code, m.latitude, m.longitude,
  coalesce(o.hours, 0)::BIGINT AS forecast_hours_count
FROM latest l LEFT JOIN ow o ON l.station_id = o.station_id LEFT JOIN stations m ON l.station_id = m.station_id""",
        "station_dispersion_outlook": f"{outlook} SELECT * FROM outlook",
        "station_worst_outlook": f"""{outlook}
SELECT station_id, CASE min(CASE outlook_category WHEN 'poor' THEN 0 WHEN 'fair' THEN 1 ELSE 2 END)
  WHEN 0 THEN 'poor' WHEN 1 THEN 'fair' ELSE 'good' END AS worst_category, max(latest_pm25) AS latest_pm25
FROM outlook GROUP BY station_id""",
        "station_freshness": f"""{ctes("dedup_readings", "stations")},
newest AS (
  SELECT station_id, max(period_from_utc) AS latest_hour_utc, max(ingested_at) AS latest_ingested_at
  FROM dedup_readings GROUP BY station_id),
aged AS (
  SELECT *, date_sub('hour', latest_hour_utc, TIMESTAMP '{FRESHNESS_TS}') AS hours_since_data,
    date_sub('hour', latest_ingested_at, TIMESTAMP '{FRESHNESS_TS}') AS hours_since_ingestion FROM newest)
SELECT a.*, m.station_name, m.locality, m.country_code, m.latitude, m.longitude,
  coalesce(hours_since_data > 2, false) AS is_data_stale,
  coalesce(hours_since_ingestion > 4, false) AS is_ingestion_stale
FROM aged a LEFT JOIN stations m ON a.station_id = m.station_id""",
        "station_pollutants": f"{long} SELECT DISTINCT station_id, pollutant FROM long",
        "station_time_series": f"""{long}
SELECT station_id, hour_utc, pollutant_value, temperature_2m, wind_speed_10m, boundary_layer_height
FROM long WHERE pollutant = 'pm25' AND hour_utc >= TIMESTAMP '{FRESHNESS_TS}' - INTERVAL {SERIES_DAYS} DAY""",
        "station_pollutants_one": f"""{long},
{_SHOWN}
SELECT DISTINCT station_id, pollutant FROM long JOIN shown USING (station_id)""",
        "station_time_series_one": f"""{long},
{_SHOWN}
SELECT station_id, hour_utc, pollutant_value, temperature_2m, wind_speed_10m, boundary_layer_height
FROM long JOIN shown USING (station_id)
WHERE pollutant = 'pm25' AND hour_utc >= TIMESTAMP '{FRESHNESS_TS}' - INTERVAL {SERIES_DAYS} DAY""",
        "station_two_source_freshness": f"{two_source} SELECT * FROM two_source",
        "station_detail": f"""{two_source}
SELECT station_id, station_name, openaq_age_hours, weather_age_hours, openaq_stale, weather_stale FROM two_source""",
        "map_center": f"""{two_source}
SELECT {_r6("avg(latitude)")} AS latitude, {_r6("avg(longitude)")} AS longitude FROM two_source""",
        "ingestion_overview": f"""{ctes("run_log")},
latest_runs AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY run_started_at DESC, run_id DESC) AS rn FROM run_log),
day AS (
  SELECT source, count(*) AS runs, count(*) FILTER (WHERE status = 'success') AS ok,
    count(*) FILTER (WHERE status = 'error') AS bad, count(*) FILTER (WHERE status = 'partial_success') AS part,
    sum(records_written) AS records, sum(api_calls) AS calls, sum(api_errors) AS errors
  FROM run_log WHERE run_started_at > TIMESTAMP '{RUNS_TS}' - INTERVAL 24 HOUR GROUP BY source)
SELECT l.source, run_id AS latest_run_id, status AS latest_run_status, run_started_at AS latest_run_started_at,
  run_finished_at AS latest_run_finished_at, duration_seconds AS latest_run_duration_seconds,
  records_written AS latest_run_records_written, error_message AS latest_run_error_message,
  coalesce(runs, 0)::BIGINT AS runs_24h, coalesce(ok, 0)::BIGINT AS successes_24h,
  coalesce(bad, 0)::BIGINT AS errors_24h, coalesce(part, 0)::BIGINT AS partials_24h,
  coalesce(records, 0)::BIGINT AS total_records_24h, coalesce(calls, 0)::BIGINT AS total_api_calls_24h,
  coalesce(errors, 0)::BIGINT AS total_api_errors_24h
FROM latest_runs l LEFT JOIN day d ON l.source = d.source WHERE rn = 1""",
        "source_freshness": f"""{ctes("run_log")},
latest_runs AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY run_started_at DESC, run_id DESC) AS rn FROM run_log),
good AS (SELECT source, max(run_finished_at) AS at FROM run_log WHERE status = 'success' GROUP BY source),
aged AS (
  SELECT l.source, status, records_written, duration_seconds,
    date_sub('second', g.at, TIMESTAMP '{RUNS_TS}')::DOUBLE / 60.0::DOUBLE AS minutes_since_last_success
  FROM latest_runs l LEFT JOIN good g ON l.source = g.source WHERE rn = 1)
SELECT *, CASE WHEN minutes_since_last_success < 90 THEN 'green' WHEN minutes_since_last_success < 360 THEN 'yellow'
  ELSE 'red' END AS freshness_band FROM aged""",
        "daily_ingestion_stats": f"""{ctes("run_log")}
SELECT run_started_at::DATE AS run_date, source, sum(records_written)::BIGINT AS total_records,
  count(*) FILTER (WHERE status = 'success') AS successes, count(*) FILTER (WHERE status = 'error') AS errors
FROM run_log GROUP BY ALL ORDER BY run_date DESC, source LIMIT 30""",
        "run_summary": f"{run_summary} SELECT * FROM summary",
        "run_log_row": f"""{run_summary},
timed AS (
  SELECT *, strptime(substr(run_id, 5, 8), '%Y%m%d')::TIMESTAMP AS run_started_at FROM summary)
SELECT run_id, 'openaq' AS source, status, run_started_at,
  run_started_at + to_seconds((record_count % 900)::INT) AS run_finished_at,
  (record_count % 900)::DOUBLE AS duration_seconds, record_count AS records_written,
  units_queried AS sensors_queried, units_failed AS sensors_failed, api_calls, api_errors,
  failed_ids AS failed_sensor_ids, run_started_at + to_seconds((record_count % 900)::INT) AS ingested_at
FROM timed""",
        "request_rate_audit": f"""{ctes("requests")},
paced AS (
  SELECT *, epoch_us(started_at) AS us,
    count(*) OVER (PARTITION BY run_date ORDER BY epoch_us(started_at) RANGE BETWEEN {window_us} PRECEDING AND CURRENT ROW) AS busy,
    epoch_us(started_at) - lag(epoch_us(started_at)) OVER (PARTITION BY run_date ORDER BY started_at) AS gap
  FROM requests)
SELECT run_date, count(*) AS total_requests, count(*) FILTER (WHERE status_code = 200) AS status_200,
  count(*) FILTER (WHERE status_code = 429) AS status_429,
  count(*) FILTER (WHERE status_code IS NULL OR (status_code >= 400 AND status_code <> 429)) AS other_errors,
  max(busy) AS max_requests_in_window, coalesce(max(gap)::DOUBLE / 1000000.0::DOUBLE, 0.0::DOUBLE) AS longest_gap_seconds
FROM paced GROUP BY run_date""",
        "request_timeline": f"""{ctes("requests")},
span AS (
  SELECT run_date, min(epoch_us(started_at)) AS first_at, max(epoch_us(started_at)) AS last_at
  FROM requests GROUP BY run_date),
buckets AS (SELECT run_date, first_at, unnest(range((last_at - first_at) // {bucket_us} + 1)) AS bucket FROM span),
counted AS (
  SELECT r.run_date, (epoch_us(started_at) - first_at) // {bucket_us} AS bucket, count(*) AS n
  FROM requests r JOIN span s ON r.run_date = s.run_date GROUP BY ALL)
SELECT b.run_date, b.bucket, make_timestamp(b.first_at + b.bucket * {bucket_us}) AS bucket_start,
  coalesce(n, 0)::BIGINT AS requests
FROM buckets b LEFT JOIN counted c ON b.run_date = c.run_date AND b.bucket = c.bucket""",
        "request_status_breakdown": f"""{ctes("requests")}
SELECT run_date, coalesce(status_code::VARCHAR, 'error') AS status, count(*) AS requests FROM requests GROUP BY ALL""",
        "latest_station_metadata": f"""{ctes("latest_metadata")}
SELECT station_id, openaq_location_id, station_name, locality, country_code, country_name, latitude, longitude,
  'UTC' AS timezone, openaq_location_id % 11 = 0 AS is_mobile, openaq_location_id % 13 <> 0 AS is_monitor,
  s_nationkey::BIGINT AS provider_id, country_name AS provider_name, openaq_location_id % 5 AS owner_id,
  'Owner ' || (openaq_location_id % 5) AS owner_name, TIMESTAMP '2020-01-01' AS datetime_first_utc, datetime_last_utc,
  pollutants_available, 3::BIGINT AS sensor_count, NULL::VARCHAR AS raw_json, loaded_at
FROM latest_metadata JOIN supplier ON s_suppkey = openaq_location_id""",
        "eligible_stations": f"""{ctes("latest_metadata")}
SELECT station_id, station_name FROM latest_metadata
WHERE {" AND ".join(f"list_contains(regexp_split_to_array(lower(pollutants_available), '[^a-z0-9]+'), '{p}')" for p in ("pm25", "pm10", "no2"))}""",
        "sensor_worklist": f"""{ctes("sensors")}
SELECT station_id, openaq_location_id, openaq_sensor_id, parameter_name AS pollutant, parameter_units AS unit
FROM sensors WHERE parameter_name IN {_TRACKED} AND station_id IN (
  SELECT station_id FROM sensors WHERE parameter_name IN {_TRACKED}
  GROUP BY station_id HAVING count(DISTINCT parameter_name) = 3)""",
        "sensor_worklist_first": f"""{ctes("sensors", "latest_metadata")}
SELECT station_id, openaq_location_id, openaq_sensor_id, parameter_name AS pollutant, parameter_units AS unit
FROM sensors WHERE parameter_name IN {_TRACKED} AND station_id IN (
  SELECT station_id FROM sensors WHERE parameter_name IN {_TRACKED}
  GROUP BY station_id HAVING count(DISTINCT parameter_name) = 3)
AND station_id IN (SELECT station_id FROM latest_metadata
  WHERE len(list_filter(regexp_split_to_array(lower(pollutants_available), '[^a-z0-9]+'), lambda t: t IN {_TRACKED})) = 3)
ORDER BY station_id, pollutant, openaq_sensor_id LIMIT {FIRST_SENSORS}""",
        "station_locations": f"""{ctes("stations")}
SELECT station_id, latitude, longitude FROM stations WHERE latitude IS NOT NULL AND longitude IS NOT NULL""",
        "catalogue_variants": """
WITH items AS (
  SELECT s_suppkey AS k, s_name, n_nationkey, n_name,
    CASE WHEN s_suppkey % 7 <> 5 THEN s_suppkey % 7 = 3 END AS mobile, CASE WHEN s_suppkey % 17 <> 0 THEN true END AS monitor,
    CASE WHEN s_suppkey % 10 <> 3 THEN 43.0::DOUBLE + (s_suppkey % 40)::DOUBLE / 10.0::DOUBLE END AS lat,
    4.0::DOUBLE + (s_suppkey % 25)::DOUBLE / 10.0::DOUBLE AS lon,
    [CASE WHEN s_suppkey % 9 = 4 THEN 'co' ELSE 'pm25' END, CASE WHEN s_suppkey % 3 = 0 THEN 'pm10' ELSE 'co' END,
     CASE WHEN s_suppkey % 2 = 0 THEN 'o3' ELSE 'co' END] AS names
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey),
texts AS (
  SELECT *, list_transform([1, 2, 3], lambda i: '{"id":' || (k * 10 + i) || ',"parameter":{"displayName":"' || upper(names[i])
    || '","id":' || i || ',"name":"' || names[i] || '","units":"' || ['µg/m³', 'µg/m³', 'ppm'][i] || '"}}') AS sensors_text
  FROM items)
SELECT k AS id, s_name AS name, mobile AS "isMobile", monitor AS "isMonitor", lat AS latitude,
  'N' || n_nationkey AS country_code, 3::BIGINT AS sensors, names[3] AS third,
  '{' || CASE WHEN lat IS NOT NULL THEN '"coordinates":{"latitude":' || regexp_replace(lat::VARCHAR, '\\.0$', '')
    || ',"longitude":' || regexp_replace(lon::VARCHAR, '\\.0$', '') || '},' ELSE '' END
    || '"country":{"code":"N' || n_nationkey || '","name":"' || n_name || '"},"datetimeFirst":{"utc":"2020-01-01T00:00:00Z"},"id":' || k
    || CASE WHEN mobile IS NOT NULL THEN ',"isMobile":' || mobile ELSE '' END
    || CASE WHEN monitor THEN ',"isMonitor":true' ELSE '' END || ',"name":"' || s_name
    || '","sensors":[' || array_to_string(sensors_text, ',') || ']}' AS raw_json, 0::BIGINT AS unknown
FROM texts""",
        "select_stations": f"""{items}
SELECT id, name, NULL::VARCHAR AS locality, NULL::VARCHAR AS timezone, is_mobile AS "isMobile",
  is_monitor AS "isMonitor", country_code, country_name, NULL::BIGINT AS provider_id, NULL::VARCHAR AS provider_name,
  NULL::BIGINT AS owner_id, NULL::VARCHAR AS owner_name, latitude, longitude, '2020-01-01T00:00:00Z' AS first_utc,
  NULL::VARCHAR AS last_utc, array_to_string(list_transform([1, 2, 3], lambda i: (id * 10 + i) || '/' || i || '/'
    || sensor_names[i] || '/' || upper(sensor_names[i]) || '/' || ['µg/m³', 'µg/m³', 'ppm'][i]), ';') AS sensors, raw_json
FROM kept""",
        "select_stations_reasons": f"""{items}
SELECT skip_reason, count(*) AS stations FROM judged WHERE skip_reason IS NOT NULL GROUP BY skip_reason""",
        "build_station_rows": f"""{items}
SELECT 'openaq:' || id AS station_id, id AS openaq_location_id, name AS station_name, NULL::VARCHAR AS locality,
  country_code, country_name, latitude, longitude, NULL::VARCHAR AS timezone, is_mobile, is_monitor,
  NULL::BIGINT AS provider_id, NULL::VARCHAR AS provider_name, NULL::BIGINT AS owner_id, NULL::VARCHAR AS owner_name,
  TIMESTAMP '2020-01-01' AS datetime_first_utc, NULL::TIMESTAMP AS datetime_last_utc, pollutants_available,
  3::BIGINT AS sensor_count, raw_json, TIMESTAMP '{LOADED_AT}' AS loaded_at FROM kept""",
        "build_sensor_rows": f"{items} SELECT *, TIMESTAMP '{LOADED_AT}' AS loaded_at FROM kept_sensors",
        "catalogue_summary": f"""{items}
SELECT 'stations' AS metric, 'total' AS item, count(*) AS stations_or_sensors, NULL::BOOLEAN AS needs_conversion FROM kept
UNION ALL SELECT 'stations_with', p, count(*) FILTER (WHERE list_contains(targets, p)), NULL
  FROM kept RIGHT JOIN (SELECT unnest(['no2', 'o3', 'pm10', 'pm25', 'so2']) AS p) ON true GROUP BY p
UNION ALL SELECT 'stations', 'all_pollutants', count(*) FILTER (WHERE len(targets) = 5), NULL FROM kept
UNION ALL SELECT 'stations', 'four_or_more', count(*) FILTER (WHERE len(targets) >= 4), NULL FROM kept
UNION ALL SELECT 'stations', 'in_box', count(*) FILTER (WHERE latitude BETWEEN 43.5 AND 46.0
  AND longitude BETWEEN 4.0 AND 5.5), NULL FROM kept
UNION ALL SELECT 'sensors', 'total', count(*), NULL FROM kept_sensors
UNION ALL SELECT 'sensors_of', parameter_name, count(*), bool_or(parameter_units <> 'µg/m³')
  FROM kept_sensors GROUP BY parameter_name""",
        "switch_catalogue": f"""{items}
SELECT 'openaq:' || id AS station_id, name AS station_name, 3::BIGINT AS sensor_count, openaq_sensor_id, parameter_units
FROM kept JOIN kept_sensors s ON s.station_id = 'openaq:' || id""",
        "subset_stations": f"""{items}
SELECT 'openaq:' || id AS station_id, name AS station_name, pollutants_available FROM kept
WHERE latitude BETWEEN 43.5 AND 46.0 AND longitude BETWEEN 4.0 AND 5.5""",
        "units_by_pollutant": f"{ctes('sensors')} SELECT DISTINCT parameter_name, parameter_units FROM sensors",
        "flatten_hourly_readings": f"""{pages}
SELECT ingested_at, run_id, station_id, openaq_location_id, openaq_sensor_id, pollutant,
  base * CASE WHEN k = 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS value, unit, period_from_utc, period_to_utc,
  NULL::VARCHAR AS period_from_local, 'hour' AS period_label, '1' AS period_interval,
  60::BIGINT AS coverage_expected, (event_id % 61)::BIGINT AS coverage_observed, NULL::DOUBLE AS coverage_pct,
  openaq_sensor_id || '|' || strftime(period_from_utc, '%Y-%m-%dT%H:%M:%SZ') AS dedup_key
FROM judged_items WHERE reject_reason IS NULL""",
        "reading_rejects": f"""{pages}
SELECT station_id, reject_reason, count(*) AS rejected FROM judged_items
WHERE reject_reason IS NOT NULL GROUP BY ALL""",
        "reading_rejects_unknown": f"""{pages}
SELECT CASE WHEN reject_reason IS NOT NULL THEN reject_reason WHEN pollutant = 'so2' THEN 'unknown_sensor'
  ELSE 'accepted' END AS outcome, count(*) AS items FROM judged_items GROUP BY ALL""",
        "forecast_rejects": f"""WITH {_BATCHES}
SELECT 'accepted' AS outcome, count(*) AS items FROM batch_hours
UNION ALL SELECT 'length_mismatch', count(*) FROM lineitem WHERE l_linenumber = 7 HAVING count(*) > 0""",
        "flatten_forecast_batch": f"""WITH {_BATCHES}
SELECT place.kind || place.key AS station_id, run_id, (place.key % 90)::DOUBLE AS latitude,
  (place.key % 180)::DOUBLE AS longitude, start_time + to_hours(j::INT) AS valid_time,
  NULL::DOUBLE AS temperature_2m, NULL::DOUBLE AS relative_humidity_2m, NULL::DOUBLE AS surface_pressure,
  [l_quantity, l_tax, NULL][j + 1] AS wind_speed_10m, NULL::DOUBLE AS wind_direction_10m,
  l_discount AS precipitation, NULL::DOUBLE AS cloud_cover,
  [l_extendedprice, NULL, l_quantity][j + 1] AS boundary_layer_height, TIMESTAMP '2024-01-01' AS ingested_at,
  place.kind || place.key || '|' || strftime(start_time + to_hours(j::INT), '%Y-%m-%dT%H:%M:%S+00:00') AS dedup_key
FROM batch_hours""",
        "complete_hour_window": f"""SELECT event_id, {_HOUR} - INTERVAL 3 HOUR AS window_start, {_HOUR} AS window_end FROM events""",
        "time_functions": f"""
SELECT event_id,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 <> 0
    THEN '.' || lpad((microsecond(ts) % 1000000)::VARCHAR, 6, '0') ELSE '' END || 'Z' AS rfc3339,
  ts AS parsed, strftime(ts, '%Y%m%dT%H%M%SZ') || '_' || user_id AS run_stamp,
  strftime(ts, '%Y-%m-%d %H:%M UTC') AS utc_label,
  date_sub('hour', ts, TIMESTAMP '{TWO_SOURCE_TS}') AS whole_hours,
  date_sub('microsecond', ts, TIMESTAMP '{TWO_SOURCE_TS}')::DOUBLE / 3600000000.0::DOUBLE AS age_hours,
  date_sub('microsecond', ts, TIMESTAMP '{TWO_SOURCE_TS}')::DOUBLE / 1000000.0::DOUBLE AS seconds,
  date_sub('second', ts, TIMESTAMP '{TWO_SOURCE_TS}')::DOUBLE / 60.0::DOUBLE AS minutes
FROM events""",
        "label_functions": """
WITH given AS (
  SELECT event_id, props, CASE WHEN event_id % 5 <> 0 THEN value - 5.0::DOUBLE END AS hours,
    CASE WHEN event_id % 3 <> 0 THEN 10.0::DOUBLE END AS other FROM events),
flagged AS (
  SELECT *, greatest(round_even(hours * 60, 0), 0)::BIGINT AS mins, coalesce(hours > 2, false) AS stale,
    coalesce(other > event_id % 20, false) AS old,
    CASE WHEN hours IS NULL THEN 0.0::DOUBLE
      ELSE least(greatest(hours / 40.0::DOUBLE, 0.0::DOUBLE), 1.0::DOUBLE) END AS score FROM given)
SELECT event_id,
  CASE WHEN hours IS NULL THEN 'No data yet'
    WHEN mins >= 1440 THEN (mins // 1440) || 'd ' || ((mins % 1440) // 60) || 'h ago'
    WHEN mins >= 60 THEN (mins // 60) || 'h ' || (mins % 60) || 'm ago' ELSE mins || 'm ago' END AS age_label,
  CASE WHEN hours IS NULL AND other IS NULL THEN 'No data'
    WHEN other IS NULL OR (hours IS NOT NULL AND hours <= other) THEN 'OpenAQ' ELSE 'Weather' END AS source,
  CASE WHEN hours * 10 < 90 THEN 'green' WHEN hours * 10 < 360 THEN 'yellow' ELSE 'red' END AS band,
  CASE WHEN stale AND old THEN 'red' WHEN stale OR old THEN 'yellow' ELSE 'green' END AS severity,
  list_contains(regexp_split_to_array(lower(props), '[^a-z0-9]+'), 'k') AS has_token, score,
  CASE WHEN score < 0.30::DOUBLE THEN 'poor' WHEN score <= 0.55::DOUBLE THEN 'fair' ELSE 'good' END AS category,
  floor(score * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE AS rounded
FROM flagged""",
        "ingest_readings_run": f"""
SELECT 'run-all' AS run_id, 'openaq' AS source, 'success' AS status, TIMESTAMP '{INGEST_TS}' AS run_started_at,
  (2 * count(value))::BIGINT AS records_written, count(DISTINCT user_id || event_type)::BIGINT AS sensors_queried,
  0::BIGINT AS sensors_failed, count(*)::BIGINT AS api_calls, 0::BIGINT AS api_errors,
  date_trunc('hour', TIMESTAMP '{INGEST_TS}')::TIMESTAMP - INTERVAL 3 HOUR AS window_start_utc,
  date_trunc('hour', TIMESTAMP '{INGEST_TS}')::TIMESTAMP AS window_end_utc,
  NULL::BIGINT AS stations_polled, NULL::BIGINT AS stations_failed, NULL::VARCHAR AS error_message,
  NULL::VARCHAR AS failed_sensor_ids, NULL::VARCHAR AS failed_station_ids
FROM events""",
        "ingest_forecasts_run": f"""WITH {_BATCHES},
asked AS (
  SELECT 's' || l_suppkey AS station_id FROM lineitem
  UNION SELECT 'p' || l_partkey FROM lineitem WHERE l_linenumber <> 1)
SELECT 'run-all' AS run_id, 'open-meteo' AS source, 'success' AS status, (SELECT count(*) FROM batch_hours) AS records_written,
  (SELECT count(*) FROM asked) AS stations_polled, 0::BIGINT AS stations_failed,
  (SELECT count(*) FROM lineitem) AS api_calls, 0::BIGINT AS api_errors, NULL::VARCHAR AS failed_station_ids,
  TIMESTAMP '{INGEST_TS}' AS run_started_at, NULL::BIGINT AS sensors_queried, NULL::BIGINT AS sensors_failed,
  NULL::TIMESTAMP AS window_start_utc, NULL::TIMESTAMP AS window_end_utc, NULL::VARCHAR AS error_message,
  NULL::VARCHAR AS failed_sensor_ids""",
        "stream_request_buckets": f"""{ctes("requests")}
SELECT run_date, time_bucket(INTERVAL {AUDIT_BUCKET_SECONDS} SECOND, started_at, TIMESTAMP '1970-01-01') AS bucket_start,
  count(*) AS requests FROM requests GROUP BY ALL""",
        "retain_days": f"""{ctes("readings")}
SELECT * FROM readings WHERE period_from_utc::DATE + INTERVAL 30 DAY > TIMESTAMP '{RETENTION_TS}'""",
        "expire_dates": f"""{ctes("readings")}
SELECT {_READING_COLUMNS} FROM readings WHERE period_from_utc::DATE + INTERVAL 30 DAY > TIMESTAMP '{RETENTION_TS}'""",
        "rewrite_along_curve": f"""{ctes("readings")}
SELECT {_READING_COLUMNS} FROM readings WHERE pollutant = 'so2'""",
        "cached_page": f"""{ctes("run_log")},
seen AS (
  SELECT unnest(['first', 'within', 'after']) AS seen, unnest([1, 1, 0]) AS least),
shown AS (SELECT * FROM run_log JOIN seen ON api_calls % 2 >= least)
SELECT seen, run_started_at::DATE AS run_date, source, sum(records_written)::BIGINT AS total_records,
  count(*) FILTER (WHERE status = 'success') AS successes, count(*) FILTER (WHERE status = 'error') AS errors
FROM shown GROUP BY ALL""",
        "append_and_read": f"""{ctes("readings")}
SELECT {_READING_COLUMNS} FROM readings""",
        "stream_latest_readings": f"{ctes('dedup_readings')} SELECT {_READING_COLUMNS} FROM dedup_readings",
        "not_null_rejects": f"""{ctes("readings")}
SELECT * REPLACE (NULL::VARCHAR AS run_id) FROM readings WHERE coverage_observed = 7""",
        "dq_unique": f"{ctes('readings')} {_UNIQUE}",
        "dq_row_count": f"{ctes('sensors')} {_ROW_COUNT}",
        "dq_expected": f"""{ctes("dedup_readings")} {_violations(
            "delivered_is_latest", "r.dedup_key",
            "'coverage_observed:' || r.coverage_observed || ',unit:' || r.unit",
            "'coverage_observed:' || d.coverage_observed || ',unit:' || d.unit",
            "Values do not match expected",
            '''readings r JOIN dedup_readings d ON r.dedup_key = d.dedup_key
            WHERE abs(r.coverage_observed - d.coverage_observed) > 3 OR r.unit <> d.unit''',
        )}""",
        "dq_null": f"""{ctes("dedup_readings")},
wide AS (
  SELECT station_id, period_from_utc AS hour_utc, {", ".join(
      f"max(CASE WHEN pollutant = '{p}' THEN unit END) AS {units(p)}" for p in ("pm25", "pm10", "no2"))}
  FROM dedup_readings WHERE pollutant IN {_TRACKED} GROUP BY ALL)
{_violations(
    "pm25_alone", "station_id || ':' || hour_utc::VARCHAR", "'pm10_unit=NULL,no2_unit=NULL'",
    "'pm10_unit:' || coalesce(pm10_unit, 'NULL') || ',no2_unit:' || coalesce(no2_unit, 'NULL')",
    "Columns should be NULL",
    "wide WHERE pm25_unit IS NOT NULL AND (pm10_unit IS NOT NULL OR no2_unit IS NOT NULL)")}""",
        "dq_not_null": f"""{ctes("dedup_readings", "stations", "sensors")},
{_ranked_latest()}
{_NOT_NULL}""",
        "dq_no_rows": f"{outlook} {_NO_ROWS}",
        "dq_members": f"{ctes('run_log')} {_MEMBERS}",
        "dq_report": report,
        "dq_totals": f"""WITH report AS ({report})
SELECT count(*) AS tests_total, count(*) FILTER (WHERE status = 'passed') AS passed,
  count(*) FILTER (WHERE status = 'failed') AS failed, count(*) FILTER (WHERE status = 'error') AS errors,
  CASE WHEN count(*) FILTER (WHERE status <> 'passed') > 0 THEN 'failed' ELSE 'passed' END AS status FROM report""",
        "dq_one_scan": f"""{ctes("readings")},
found AS (
  SELECT 'unit_is_ppm' AS test_name, dedup_key || ':' || run_id AS entity_id, 'ppm' AS want, unit AS got,
    'Value is not allowed' AS reason FROM readings WHERE unit <> 'ppm'
  UNION ALL SELECT 'observed', dedup_key || ':' || run_id, '2 or more', coverage_observed::VARCHAR, 'Rows should not exist'
  FROM readings WHERE coverage_observed < 2
  UNION ALL SELECT 'no_value_unobserved', dedup_key || ':' || run_id, 'value=NULL', 'value:' || value::VARCHAR,
    'Columns should be NULL' FROM readings WHERE coverage_observed = 0 AND value IS NOT NULL),
placed AS (SELECT *, row_number() OVER (PARTITION BY test_name ORDER BY entity_id, want, got, reason) AS place FROM found),
names AS (SELECT unnest(['complete', 'no_value_unobserved', 'observed', 'unit_is_ppm']) AS test_name)
SELECT n.test_name, CASE WHEN count(f.test_name) > 0 THEN 'failed' ELSE 'passed' END AS status,
  count(f.test_name) AS violations, coalesce(string_agg(entity_id || '|' || want || '|' || got || '|' || reason, '; '
    ORDER BY place) FILTER (WHERE place <= 5), '') AS samples, NULL::VARCHAR AS error_class
FROM names n LEFT JOIN placed f ON n.test_name = f.test_name GROUP BY n.test_name""",
    }
    # The views do not depend on what the key is known to be; a refresh ends in the same summary.
    for name in (
        "station_latest_pollutants",
        "station_hourly_wide",
        "station_hourly_combined",
        "station_dispersion_outlook",
        "station_freshness",
        "station_time_series",
    ):
        found[f"{name}_any_key"] = found[name]
    found["refresh_catalogue"] = found["catalogue_summary"]
    # Landed files hold the same requests; a run judges them all by its own time and window.
    for name in ("landed_readings", "stream_landed_readings"):
        found[name] = found["flatten_hourly_readings"]
    found["landed_forecasts"] = found["flatten_forecast_batch"]
    of_run = f"""TIMESTAMP '{INGEST_TS}' AS ingested_at, 'run-all' AS run_id"""
    found["ingest_readings_rows"] = f"""{pages}
SELECT {of_run}, station_id, openaq_location_id, openaq_sensor_id, pollutant,
  base * CASE WHEN k = 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS value, unit, period_from_utc, period_to_utc,
  NULL::VARCHAR AS period_from_local, 'hour' AS period_label, '1' AS period_interval,
  60::BIGINT AS coverage_expected, (event_id % 61)::BIGINT AS coverage_observed, NULL::DOUBLE AS coverage_pct,
  openaq_sensor_id || '|' || strftime(period_from_utc, '%Y-%m-%dT%H:%M:%SZ') AS dedup_key
FROM judged_items
WHERE k < 2 AND base IS NOT NULL AND period_to_utc <= date_trunc('hour', TIMESTAMP '{INGEST_TS}')"""
    found["ingest_forecasts_rows"] = f"""WITH flat AS ({found["flatten_forecast_batch"]})
SELECT * REPLACE (TIMESTAMP '{INGEST_TS}' AS ingested_at, 'run-all' AS run_id) FROM flat"""
    # Streams end in what their batch twins give.
    found["stream_newest_versions"] = found["stream_latest_readings"]
    found["stream_request_timeline"] = found["request_timeline"]
    found["stream_rate_audit"] = found["request_rate_audit"]
    return found
