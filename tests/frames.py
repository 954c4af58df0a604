"""Input frames of the unit tests: invented stations, each row written as what differs
from a plain default row."""

import datetime as dt

from pyspark.sql import types as T

from pluvia import presets as P

DAY = dt.date(2030, 3, 10)
TEXT = {"date", "city_name", "country", "country_code", "region", "timezone", "sunrise", "sunset"}
PLAIN = {
    "date": DAY.isoformat(), "city_name": "Aldora", "country": "Northland", "country_code": "NL",
    "region": "Hills", "latitude": 51.5, "longitude": 4.25, "timezone": "UTC",
    "temperature_max": 11.0, "temperature_min": 3.0, "temperature_mean": 7.5, "precipitation_sum": 0.4,
    "precipitation_hours": 1.0, "wind_speed_max": 33.0, "wind_direction": 270.0, "humidity_max": 95.0,
    "humidity_min": 52.0, "uv_index_max": 2.5, "weather_code": 3, "sunrise": "06:40", "sunset": "18:20",
}


def _type(name, value_types):
    if name in value_types:
        return value_types[name]
    return T.StringType() if name in TEXT else T.LongType() if name == "weather_code" else T.DoubleType()


def observations(spark, *changes, **value_types):
    """One observation row for each dict of changes to the plain row."""
    schema = T.StructType([T.StructField(c, _type(c, value_types)) for c in P.OBSERVATION_COLUMNS])
    return spark.createDataFrame([tuple({**PLAIN, **c}[n] for n in schema.names) for c in changes], schema)


CHECKED = ["date", "city_name", "country_code", "latitude", "longitude", "temperature_max",
           "temperature_min", "precipitation_sum"]


def checked(spark, *changes):
    """Rows with the fields the quality checks require; the date is a DATE."""
    schema = T.StructType([T.StructField(c, T.DateType() if c == "date" else _type(c, {})) for c in CHECKED])
    plain = {**PLAIN, "date": DAY}
    return spark.createDataFrame([tuple({**plain, **c}[n] for n in CHECKED) for c in changes], schema)


def stations(n, **change):
    """Changes for ``n`` rows that differ in their station."""
    return [{"city_name": f"Station {i:02d}", **change} for i in range(n)]
