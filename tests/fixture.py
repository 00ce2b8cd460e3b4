"""Deterministic input rows. Reference time 2026-03-22 14:00 UTC; places and texts are invented."""

from datetime import UTC, datetime

from pyspark.sql import functions as F

from gaugelake.schemas import FORECAST_VARIABLES, FORECASTS, READINGS, RUN_LOG, SENSORS, STATIONS, conform

NOW = datetime(2026, 3, 22, 14, tzinfo=UTC)
UNIT = "µg/m³"


def at(hour, minute=0, day=22):
    return datetime(2026, 3, day, hour, minute, tzinfo=UTC)


# The numbers the expected results of the view tests rest on.
# station, sensor, pollutant, {hour: value}
_SERIES = [
    ("station_a", 1, 101, "pm25", {7: 50.0, 8: 15.0, 9: 18.0, 10: 22.0}),
    ("station_a", 1, 102, "pm10", {9: 25.0, 10: 30.0}),
    ("station_a", 1, 103, "no2", {9: 40.0, 10: 45.0}),
    ("station_b", 2, 201, "pm25", {8: 12.0, 9: 14.0, 10: 16.0}),
    ("station_b", 2, 202, "pm10", {9: 20.0, 10: 22.0}),
    ("station_b", 2, 203, "no2", {10: 35.0}),
]

# station: latitude, longitude, {hour: temperature, humidity, pressure, wind, direction, precipitation, cloud, boundary layer}
_WEATHER = {
    "station_a": (53.1, -6.25, {
        9: (8.5, 68, 1013, 4, 180, 0.5, 25, 450),
        10: (9, 65, 1012, 4.5, 190, 0.5, 20, 550),
        11: (10, 65, 1013, 5, 180, 1, 20, 500),
        12: (12, 60, 1012, 7, 190, 2, 30, 600),
        13: (14, 55, 1011, 6, 200, 3, 40, 700),
        14: (99, 99, 999, 50, 270, 100, 99, 999),
        15: (15, 55, 1010, 3, 200, 0, 50, 200),
        16: (18, 45, 1009, 15, 220, 2, 30, 1200),
        17: (17, 50, 1009, 8, 210, 0.5, 35, 800),
    }),
    "station_c": (51.9, -7.75, {
        11: (8, 70, 1015, 4, 160, 0.5, 15, 400),
        12: (10, 65, 1014, 5, 170, 1, 20, 450),
        13: (12, 60, 1013, 6, 180, 1.5, 25, 500),
        15: (14, 55, 1010, 5, 170, 0, 20, 1000),
        16: (15, 50, 1009, 7, 180, 0, 15, 1200),
    }),
}


def reading(station, location, sensor, pollutant, hour, value, ingested=None, run="run_1", **extra):
    return {
        "ingested_at": ingested or at(10), "run_id": run, "station_id": station, "openaq_location_id": location,
        "openaq_sensor_id": sensor, "pollutant": pollutant, "value": value, "unit": UNIT,
        "period_from_utc": at(hour), "period_to_utc": at(hour + 1), "dedup_key": f"{sensor}|{at(hour).isoformat()}",
        **extra,
    }


def forecast(station, hour, values, ingested=None, run="weather_run_1", place=(0.0, 0.0)):
    return {
        "station_id": station, "run_id": run, "latitude": place[0], "longitude": place[1], "valid_time": at(hour),
        **{n: float(v) for n, v in zip(FORECAST_VARIABLES, values)},
        "ingested_at": ingested or at(10), "dedup_key": f"{station}|{at(hour).isoformat()}",
    }


def frame(spark, rows, schema):
    """Rows given as dicts; columns left out are NULL."""
    full = [tuple(row.get(f.name) for f in schema.fields) for row in rows]
    relaxed = type(schema)([type(f)(f.name, f.dataType, True) for f in schema.fields])
    return spark.createDataFrame(full, relaxed)


def readings(spark, ntz=False):
    rows = [reading(s, l, k, p, h, v) for s, l, k, p, hours in _SERIES for h, v in hours.items()]
    rows.append(reading("station_a", 1, 101, "pm25", 10, 99.0, at(9), "run_0"))
    return _kind(frame(spark, rows, READINGS), ntz)


def forecasts(spark, ntz=False):
    rows = [
        forecast(s, h, v, place=(lat, lon)) for s, (lat, lon, hours) in _WEATHER.items() for h, v in hours.items()
    ]
    rows.append(forecast("station_a", 11, (-99, 0, 0, 0, 0, 0, 0, 0), at(9), "weather_run_0", (53.1, -6.25)))
    return _kind(frame(spark, rows, FORECASTS), ntz)


def stations(spark):
    places = [
        ("station_a", 1, "Quay Street", "Aldport", 53.1, -6.25, "no2,pm10,pm25"),
        ("station_b", 2, "Mill Lane", "Brineford", 54.05, -8.5, "no2,pm10,pm25"),
        ("station_c", 3, "Hilltop", "Cairnholt", 51.9, -7.75, None),
    ]
    rows = [
        {"station_id": i, "openaq_location_id": n, "station_name": name, "locality": town, "country_code": "IE",
         "country_name": "Ireland", "latitude": lat, "longitude": lon, "timezone": "Europe/Dublin",
         "is_mobile": False, "is_monitor": True, "pollutants_available": has, "loaded_at": at(10)}
        for i, n, name, town, lat, lon, has in places
    ]
    return frame(spark, rows, STATIONS)


def sensors(spark):
    rows = [
        {"station_id": s, "openaq_location_id": l, "openaq_sensor_id": k, "parameter_id": k % 100,
         "parameter_name": p, "parameter_display_name": p.upper(), "parameter_units": UNIT, "loaded_at": at(10)}
        for s, l, k, p, _ in _SERIES
    ]
    return frame(spark, rows, SENSORS)


def run_log(spark):
    def run(run_id, source, status, start, end, seconds, records, calls, errors, message=None):
        return {"run_id": run_id, "source": source, "status": status, "run_started_at": start,
                "run_finished_at": end, "duration_seconds": seconds, "records_written": records,
                "api_calls": calls, "api_errors": errors, "error_message": message, "ingested_at": end}

    return frame(spark, [
        run("run_1", "openaq", "success", at(10), at(10, 5), 300.0, 500, 10, 0),
        run("run_error", "openaq", "error", at(9), at(9, 1), 60.0, 0, 1, 1, "quota spent"),
        run("run_old", "openaq", "success", at(8, day=21), at(8, 5, 21), 300.0, 400, 8, 0),
        run("weather_run_1", "open-meteo", "success", at(10), at(10, 2), 120.0, 96, 2, 0),
    ], RUN_LOG)


def _kind(df, ntz):
    if not ntz:
        return df
    return df.select(*[
        F.col(n).cast("timestamp_ntz").alias(n) if kind == "timestamp" else F.col(n) for n, kind in df.dtypes
    ])


__all__ = ["NOW", "at", "conform", "forecast", "forecasts", "frame", "reading", "readings", "run_log", "sensors", "stations"]
