"""Explicit schemas for every layer: nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

D, S, L, B = T.DoubleType(), T.StringType(), T.LongType(), T.BooleanType()


# Names of the database objects.
DATABASE, FACT_TABLE = "weather", "fact_weather"


def _arr(t):
    return T.ArrayType(t, True)


CITY = T.StructType([
    T.StructField("name", S), T.StructField("country", S),
    T.StructField("country_code", S), T.StructField("region", S),
    T.StructField("latitude", D), T.StructField("longitude", D),
    T.StructField("timezone", S),
])

# The variables of a payload are read as text: a cell that is no number then reaches the
# coercion as it is, instead of emptying its whole array in the reader.
DAILY = T.StructType([T.StructField(name, _arr(S)) for name in (
    "time", "temperature_2m_max", "temperature_2m_min", "temperature_2m_mean",
    "precipitation_sum", "precipitation_hours", "wind_speed_10m_max",
    "wind_direction_10m_dominant", "relative_humidity_2m_max", "relative_humidity_2m_min",
    "uv_index_max", "weather_code", "sunrise", "sunset")])

CITY_RESPONSE = T.StructType([
    T.StructField("daily", DAILY),
    T.StructField("_city_meta", CITY),
])

RAW_PAYLOAD = T.StructType([
    T.StructField("extraction_timestamp", S),
    T.StructField("total_cities_requested", L),
    T.StructField("total_cities_successful", L),
    T.StructField("total_cities_failed", L),
    T.StructField("failed_cities", _arr(S)),
    T.StructField("data", _arr(CITY_RESPONSE)),
])

OBSERVATION = T.StructType([
    T.StructField("date", S), T.StructField("city_name", S),
    T.StructField("country", S), T.StructField("country_code", S),
    T.StructField("region", S), T.StructField("latitude", D),
    T.StructField("longitude", D), T.StructField("timezone", S),
    T.StructField("temperature_max", D), T.StructField("temperature_min", D),
    T.StructField("temperature_mean", D), T.StructField("precipitation_sum", D),
    T.StructField("precipitation_hours", D), T.StructField("wind_speed_max", D),
    T.StructField("wind_direction", D), T.StructField("humidity_max", D),
    T.StructField("humidity_min", D), T.StructField("uv_index_max", D),
    T.StructField("weather_code", L), T.StructField("sunrise", S),
    T.StructField("sunset", S),
])

# Fact table: required fields are marked non-nullable.
FACT = T.StructType([
    T.StructField("date", T.DateType(), False),
    T.StructField("city_name", S, False),
    T.StructField("country", S), T.StructField("country_code", S),
    T.StructField("region", S), T.StructField("latitude", D),
    T.StructField("longitude", D), T.StructField("timezone", S),
    T.StructField("temperature_max", D), T.StructField("temperature_min", D),
    T.StructField("temperature_mean", D), T.StructField("temperature_range", D),
    T.StructField("precipitation_sum", D), T.StructField("precipitation_hours", D),
    T.StructField("precipitation_category", S), T.StructField("wind_speed_max", D),
    T.StructField("wind_direction", D), T.StructField("humidity_max", D),
    T.StructField("humidity_min", D), T.StructField("humidity_mean", D),
    T.StructField("uv_index_max", D), T.StructField("weather_code", L),
    T.StructField("weather_description", S), T.StructField("temperature_category", S),
    T.StructField("sunrise", S), T.StructField("sunset", S),
    T.StructField("loaded_at", T.TimestampType()),
])

# Clean (silver) rows as written to CSV: the fact layout minus loaded_at.
CLEAN = T.StructType([f if f.name != "date" else T.StructField("date", T.DateType())
                      for f in FACT.fields if f.name != "loaded_at"])

CHECK = T.StructType([
    T.StructField("name", S), T.StructField("passed", B),
    T.StructField("detail", S), T.StructField("affected_rows", L),
])

REPORT = T.StructType([
    T.StructField("extraction_date", S),
    T.StructField("total_rows", L),
    T.StructField("valid_rows", L),
    T.StructField("invalid_rows", L),
    T.StructField("null_percentage", D),
    T.StructField("duplicate_count", L),
    T.StructField("overall_passed", B),
    T.StructField("checks", T.ArrayType(CHECK, True)),
])
