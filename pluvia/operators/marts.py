"""The three models: staging view, daily summary, per-entity statistics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvia import presets as P
from pluvia.functions import scalars as S

STAGING_COLUMNS = [
    "date", "city_name", "country", "country_code", "region", "latitude", "longitude",
    "timezone", "temperature_max", "temperature_min", "temperature_mean",
    "temperature_range", "temperature_category", "precipitation_sum",
    "precipitation_hours", "precipitation_category", "wind_speed_max", "wind_direction",
    "humidity_max", "humidity_min", "humidity_mean", "uv_index_max", "weather_code",
    "weather_description", "loaded_at",
]

DAILY_COLUMNS = [
    "date", "city_name", "country", "country_code", "region", "latitude", "longitude",
    "temperature_max", "temperature_min", "temperature_mean", "temperature_range",
    "temperature_category", "precipitation_sum", "precipitation_hours",
    "precipitation_category", "wind_speed_max", "humidity_mean", "uv_index_max",
    "weather_description",
]

CITY_KEYS = ["city_name", "country", "country_code", "region", "latitude", "longitude"]


def staging(fact: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Staging view: required keys present, coordinates to 4 places, rain 0-filled.

    Lazy on purpose: Catalyst inlines it into whatever reads it, so filters
    and column pruning reach the table scan.
    """
    cols = []
    for c in STAGING_COLUMNS:
        if c not in fact.columns:
            continue
        if c in ("latitude", "longitude"):
            cols.append(F.round(c, 4).alias(c))
        elif c in ("precipitation_sum", "precipitation_hours"):
            cols.append(F.coalesce(F.col(c), F.lit(0.0)).alias(c))
        else:
            cols.append(F.col(c))
    cols += [F.col(c) for c in extra]
    return fact.where(F.col("date").isNotNull() & F.col("city_name").isNotNull()).select(*cols)


def daily_summary(stg: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """One row per staged row plus the three alert flags (NULL -> FALSE)."""
    return stg.select(
        *DAILY_COLUMNS, *extra,
        S.threshold_flag("precipitation_sum", P.HEAVY_RAIN_MM).alias("heavy_rain_day"),
        S.threshold_flag("temperature_max", P.HEAT_ALERT_C).alias("heat_alert_day"),
        S.threshold_flag("wind_speed_max", P.WIND_ALERT_KMH).alias("wind_alert_day"),
    )


@dataclass(frozen=True)
class StatsColumns:
    """Columns of the per-entity statistics, and the decimals of their values."""
    mean: str = "temperature_mean"
    high: str = "temperature_max"
    low: str = "temperature_min"
    amount: str = "precipitation_sum"
    wind: str = "wind_speed_max"
    humidity: str = "humidity_mean"
    uv: str = "uv_index_max"
    heavy: str = "heavy_rain_day"
    heat: str = "heat_alert_day"
    scale: int = 1


def partial_measures(m: StatsColumns) -> list[Column]:
    """The mergeable aggregates from which the statistics are made (see :func:`merged`)."""
    def u(c):
        return S.units(c, m.scale)

    v = S.nan_to_null  # NaN is missing, never a maximum
    out = [F.count(F.lit(1)).alias("n")]
    for c in dict.fromkeys([m.mean, m.wind, m.humidity, m.uv]):
        out += [F.sum(u(c)).alias(f"s_{c}"), F.count(u(c)).alias(f"c_{c}")]
    return out + [
        F.max(v(m.high)).alias("mx_t"), F.min(v(m.low)).alias("mn_t"),
        F.sum(u(m.amount)).alias("s_p"),
        F.count_if(v(m.amount) > 0).alias("rainy"),
        F.max(v(m.wind)).alias("mx_w"),
        F.count_if(F.col(m.heavy)).alias("heavy"),
        F.count_if(F.col(m.heat)).alias("heat"),
    ]


def merged(partials: DataFrame, by: Sequence[str], m: StatsColumns) -> DataFrame:
    """Partial measures of several parts (dates, loads) as those of their union."""
    def again(c):
        how = F.max if c.startswith("mx_") else F.min if c.startswith("mn_") else F.sum
        return how(c).alias(c)

    own = [c for c in partials.columns if c in ("n", "mx_t", "mn_t", "s_p", "rainy", "mx_w", "heavy", "heat")
           or c in {f"{x}_{y}" for x in "sc" for y in (m.mean, m.wind, m.humidity, m.uv)}]
    return partials.groupBy(*by).agg(*[again(c) for c in own])


def stats_of_measures(level1: DataFrame, keys: Sequence[str], picks: list[Column], m: StatsColumns) -> DataFrame:
    """The per-entity statistics from the measures of (entity, label) groups."""
    def mean(c):
        return S.mean_units(F.sum(f"s_{c}"), F.sum(f"c_{c}"), m.scale)

    stats = level1.groupBy(*keys).agg(
        mean(m.mean).alias("avg_temperature"),
        F.round(F.max("mx_t"), 1).alias("max_temperature"),
        F.round(F.min("mn_t"), 1).alias("min_temperature"),
        (F.sum("s_p") / F.lit(10.0 ** m.scale)).alias("total_precipitation"),
        F.sum("rainy").cast("bigint").alias("rainy_days"),
        F.sum("n").cast("bigint").alias("total_days"),
        mean(m.wind).alias("avg_wind_speed"),
        F.round(F.max("mx_w"), 1).alias("max_wind_speed"),
        mean(m.humidity).alias("avg_humidity"),
        mean(m.uv).alias("avg_uv_index"),
        F.sum("heavy").cast("bigint").alias("heavy_rain_days"),
        F.sum("heat").cast("bigint").alias("heat_alert_days"),
        *picks,
    )
    return (stats.withColumnRenamed("_pick", "most_common_weather")
            .withColumn("rain_percentage",
                        S.safe_percentage(F.col("rainy_days"), F.col("total_days"), 1)))


def most_frequent(label: str) -> Column:
    """The label with the largest count, the smallest one on ties."""
    return F.min(F.struct((-F.col("n")).alias("neg_n"), F.col(label).alias("v"))).getField("v").alias("_pick")


def city_stats(daily: DataFrame, keys: Sequence[str] = tuple(CITY_KEYS),
               window_days: int | None = None, as_of: dt.date | str | None = None,
               mode_col: str = "weather_description", mode: str = "exact",
               measures: StatsColumns | None = None, max_items: int = 10000) -> DataFrame:
    """Per-entity statistics of the daily mart, in no particular order.

    ``mode="exact"`` (default) picks the most frequent label exactly
    (smallest on ties); ``mode="approx"`` uses the ``approx_top_k`` sketch, which
    tracks ``max_items`` labels a group (exact up to so many, an estimate beyond), and
    returns its estimated count as ``most_common_count``.
    ``window_days=None`` reads all history; ``window_days=30`` keeps dates on
    or after ``as_of - 30``.  Means and sums are exact for values of
    ``measures.scale`` decimals, so results are independent of
    partitioning.  One chain of shuffles: (keys, mode value) partial
    aggregates, then per-key totals plus the mode pick, no join.
    """
    keys, m = list(keys), measures or StatsColumns()
    df = daily
    if window_days is not None:
        start = F.date_sub(F.lit(as_of).cast("date"), window_days)
        df = df.where(F.col("date") >= start)

    partial = partial_measures(m)
    if mode == "approx":
        # One shuffle by key: the measures as above, the mode from the
        # mergeable approx_top_k sketch (ties unspecified, NULL counted).  The
        # per-key pass below then runs on data already partitioned by key.
        top = F.call_function("approx_top_k", F.col(mode_col), F.lit(1), F.lit(max_items))
        level1 = df.groupBy(*keys).agg(*partial, top.alias("_approx"))
        picks = [F.first(F.col("_approx")[0]["item"]).alias("_pick"),
                 F.first(F.col("_approx")[0]["count"]).alias("most_common_count")]
    elif mode == "exact":
        level1 = df.groupBy(*keys, mode_col).agg(*partial)
        picks = [most_frequent(mode_col)]
    else:
        raise ValueError(f"unknown mode {mode!r}")

    return stats_of_measures(level1, keys, picks, m)
