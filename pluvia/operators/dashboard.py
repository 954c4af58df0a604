"""Reporting queries over the clean rows: slices, windows, top-k, KPIs.

Every "current" value (latest date, hottest entity, default range) is a
scalar subquery (``DataFrame.scalar()``), evaluated by Spark before the
outer scan, so no value is collected to the driver and date bounds reach
the Parquet scan as pushed filters.  Top-k and arg-max use ``orderBy +
limit`` (TakeOrderedAndProject: every task keeps only its top rows).
Ties are broken by the listed ``tie`` columns so results are deterministic.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvia import presets as P
from pluvia.functions import scalars as S

DATE, CITY = "date", "city_name"


def _asc(cols: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in cols]


def _desc(cols: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in cols]


# --- F: filters -------------------------------------------------------------

def latest_date(df: DataFrame, date: str = DATE, as_of=None) -> Column:
    """The latest date: ``as_of`` where the caller knows it (a literal prunes the scan's
    partitions and costs no job), else ``max(date)`` as a scalar subquery."""
    if as_of is not None:
        return F.lit(as_of).cast("date")
    return df.select(F.max(date)).scalar()


def latest_slice(df: DataFrame, date: str = DATE, as_of=None) -> DataFrame:
    """Rows of the latest date."""
    return df.where(F.col(date) == latest_date(df, date, as_of))


def trailing_from_latest(df: DataFrame, days: int = 30, date: str = DATE, as_of=None) -> DataFrame:
    """Rows on or after ``max(date) - days`` (``days + 1`` dates)."""
    return df.where(F.col(date) >= F.date_sub(latest_date(df, date, as_of), days))


def window_days_back(df: DataFrame, as_of, days: int = P.DAYS_BACK, date: str = DATE) -> DataFrame:
    """Rows in ``[as_of - days, as_of]``, both ends included."""
    end = F.lit(as_of if isinstance(as_of, str) else as_of.isoformat()).cast("date")
    return df.where(F.col(date).between(F.date_sub(end, days), end))


def default_range(df: DataFrame, days: int = 29, date: str = DATE) -> DataFrame:
    """``[max(min_d, max_d - days), max_d]`` as one row."""
    return df.agg(F.min(date).alias("min_date"), F.max(date).alias("end_date")) \
        .select(F.greatest("min_date", F.date_sub("end_date", days)).alias("start_date"),
                "end_date")


def key_range_filter(df: DataFrame, key_col: str, key, start, end, date: str = DATE,
                     tie: Sequence[str] = ()) -> DataFrame:
    """Rows of one key with ``start <= date <= end``, oldest first."""
    k = key if isinstance(key, Column) else F.lit(key)
    s = start if isinstance(start, Column) else F.lit(start).cast("date")
    e = end if isinstance(end, Column) else F.lit(end).cast("date")
    return (df.where((F.col(key_col) == k) & (F.col(date) >= s) & (F.col(date) <= e))
              .orderBy(F.col(date).asc(), *_asc(tie)))


def pick_key(df: DataFrame, key_col: str = CITY, preferred: str | None = None) -> Column:
    """``preferred`` when present, else the smallest key (scalar subquery)."""
    hit = F.max(F.when(F.col(key_col) == F.lit(preferred), F.col(key_col))) if preferred \
        else F.lit(None)
    return df.select(F.coalesce(hit, F.min(key_col))).scalar()


def default_period(df: DataFrame, key_col: str = CITY, preferred: str | None = "Lima",
                   days: int = 29, date: str = DATE, tie: Sequence[str] = (), as_of=None,
                   keys: DataFrame | None = None) -> DataFrame:
    """The selected key's rows in the default range (the period view).

    With ``as_of`` the range ends there and no subquery looks for its ends (a start
    before the first row changes nothing).  ``keys``: a small table that holds every
    key (a dimension or the per-entity mart), so the facts are not read for the choice.
    """
    end = latest_date(df, date, as_of)
    start = F.date_sub(end, days) if as_of is not None else \
        df.select(F.greatest(F.min(date), F.date_sub(F.max(date), days))).scalar()
    chosen = pick_key(df if keys is None else keys, key_col, preferred)
    return key_range_filter(df, key_col, chosen, start, end, date, tie)


# --- A / L / W: aggregates, ordering ------------------------------------------

def headline_kpis(df: DataFrame, days: int = 30, date: str = DATE, key: str = CITY,
                  value: str = "temperature_mean", amount: str = "precipitation_sum",
                  scale: int = 1, as_of=None) -> DataFrame:
    """Latest date, entities on it, their mean value, and the window's total.

    One scan of the trailing window; the latest slice is a conditional
    aggregate inside the same pass.  ``scale``: decimals of ``value`` and ``amount``.
    """
    mx = latest_date(df, date, as_of)
    recent = df.where(F.col(date) >= F.date_sub(mx, days))
    on_latest = F.col(date) == mx
    return recent.agg(
        F.max(date).alias("latest_date"),
        F.count_distinct(F.when(on_latest, F.col(key))).alias("n_cities"),
        S.mean_units(F.sum(F.when(on_latest, S.units(value, scale))),
                     F.count(F.when(on_latest, S.units(value, scale))), scale, half_even=True)
        .alias("avg_temperature"),
        (S.ratio_round_half_even(F.coalesce(F.sum(S.units(amount, scale)), F.lit(0)),
                                 F.lit(10 ** scale)).cast("double")).alias("rain_30d"),
    )


def arg_max_row(df: DataFrame, value: str, tie: Sequence[str] = (CITY,),
                largest: bool = True) -> DataFrame:
    """The row holding the largest (or smallest) non-missing ``value``.

    First on ties in ``tie`` order; missing (NULL or NaN) values are skipped
    and an all-missing input gives no row.
    """
    v = S.nan_to_null(value)
    order = v.desc() if largest else v.asc()
    return df.where(v.isNotNull()).orderBy(order, *_asc(tie)).limit(1)


def selected_card(df: DataFrame, tie: Sequence[str] = (CITY,), as_of=None) -> DataFrame:
    """The hottest latest-date row as a display card (rounded values)."""
    row = arg_max_row(latest_slice(df, as_of=as_of), "temperature_max", tie)
    hum = S.col_or_default(row, "humidity_mean", 60)
    return row.select(
        CITY, "country", "weather_description",
        S.round_half_even("temperature_mean", 1).alias("temp"),
        S.round_half_even("temperature_max", 1).alias("temp_max"),
        S.round_half_even("temperature_min", 1).alias("temp_min"),
        S.round_half_even(hum, 0).alias("humidity"),
        S.round_half_even("wind_speed_max", 0).alias("wind"),
        S.round_half_even("uv_index_max", 1).alias("uv"),
        S.round_half_even(S.col_or_default(row, "precipitation_sum", 0), 1).alias("rain"),
    )


def top_k(df: DataFrame, value: str, k: int, tie: Sequence[str] = (CITY,)) -> DataFrame:
    """``k`` rows with the largest ``value`` (missing, NULL or NaN, last)."""
    return df.orderBy(S.nan_to_null(value).desc_nulls_last(), *_asc(tie)).limit(k)


def top_cities(df: DataFrame, k: int = 8, tie: Sequence[str] = (CITY,), as_of=None) -> DataFrame:
    """Top-k list of the latest date with its display rounding."""
    return top_k(latest_slice(df, as_of=as_of), "temperature_mean", k, tie).select(
        F.col(CITY).alias("name"), F.col("country_code").alias("country"),
        S.round_half_even("temperature_mean", 1).alias("temp"),
        F.col("weather_description").alias("condition"),
        S.round_half_even("precipitation_sum", 1).alias("rain"),
        S.round_half_even("longitude", 2).alias("lon"),
        S.round_half_even("latitude", 2).alias("lat"),
    )


def last_n(df: DataFrame, n: int, date: str = DATE, tie: Sequence[str] = ()) -> DataFrame:
    """The ``n`` newest rows of a frame."""
    return df.orderBy(F.col(date).desc(), *_desc(tie)).limit(n)


def last_n_per_key(df: DataFrame, key: str, n: int, date: str = DATE,
                   tie: Sequence[str] = ()) -> DataFrame:
    """The ``n`` newest rows of every key.

    ``row_number() <= n`` lets Spark insert a partial group limit before the
    shuffle, so each map task ships at most ``n`` rows per key even when
    one key holds a large share of the data.
    """
    w = Window.partitionBy(key).orderBy(F.col(date).desc(), *_desc(tie))
    return df.withColumn("rn", F.row_number().over(w).cast("bigint")).where(F.col("rn") <= n)


def since_of_last(df: DataFrame, key: str, value, n: int, as_of: dt.date, date: str = DATE) -> dt.date:
    """A date from which the ``n`` newest rows of one key up to ``as_of`` lie, whatever
    days are missing: the range is widened fourfold until it holds them or reaches the
    first date.  Every step reads the partitions of its range and at most ``n`` rows."""
    days, first = n - 1, None
    while True:
        since = as_of - dt.timedelta(days=days)
        held = df.where(F.col(date).between(F.lit(since), F.lit(as_of)) & (F.col(key) == F.lit(value)))
        if held.limit(n).count() >= n:
            return since
        if first is None:
            first = df.agg(F.min(date)).first()[0] or as_of
        if since <= first:
            return since
        days = min(4 * days + 3, (as_of - first).days)


def trend_of_top_key(df: DataFrame, n: int = 8, tie: Sequence[str] = (), as_of=None,
                     since=None) -> DataFrame:
    """The hottest latest-date entity's last ``n`` rows, oldest first.

    ``since``: a date from which those rows are known to lie (see :func:`since_of_last`);
    without it the entity's whole history is read.
    """
    hot = arg_max_row(latest_slice(df, as_of=as_of), "temperature_max", (CITY, *tie)).select(CITY).scalar()
    own = df if since is None else df.where(F.col(DATE) >= F.lit(since).cast("date"))
    rows = last_n(own.where(F.col(CITY) == hot), n, DATE, tie)
    return rows.select(
        DATE, CITY, S.date_label(DATE).alias("label"),
        S.round_half_even("temperature_max", 1).alias("temp_max"),
        S.round_half_even("temperature_min", 1).alias("temp_min"),
        S.round_half_even("temperature_mean", 1).alias("temp_mean"),
        S.round_half_even("precipitation_sum", 1).alias("rain"),
        F.col("weather_description").alias("condition"), *tie,
    ).orderBy(DATE, *tie)


def latest_points(df: DataFrame, as_of=None) -> DataFrame:
    """Map points of the latest date: coordinates, value, ``city, country`` label."""
    return latest_slice(df, as_of=as_of).select(
        CITY, S.round_half_even("latitude", 4).alias("lat"),
        S.round_half_even("longitude", 4).alias("lon"),
        S.round_half_even("temperature_mean", 1).alias("temp"),
        F.concat_ws(", ", F.col(CITY), F.col("country")).alias("label"),
    )


def top_groups_share(df: DataFrame, group: str = "country", amount: str = "precipitation_sum",
                     k: int = 6, days: int = 30, scale: int = 1, date: str = DATE,
                     as_of=None) -> DataFrame:
    """Top-k groups by trailing-window total with their share of the largest.

    Totals are exact for values of ``scale`` decimals.  The largest total is taken over
    the k result rows with a window: its input is bounded by the limit, so the
    aggregation is not run a second time (a zero maximum counts as 1).
    """
    one = 10 ** scale
    recent = trailing_from_latest(df, days, date, as_of)
    sums = recent.groupBy(group).agg(F.coalesce(F.sum(S.units(amount, scale)), F.lit(0)).alias("_t"))
    top = sums.orderBy(F.col("_t").desc(), F.col(group).asc()).limit(k)
    mx = F.max("_t").over(Window.partitionBy())
    den = F.when(mx == 0, F.lit(one)).otherwise(mx)
    return top.select(
        F.col(group).alias("name"),
        S.ratio_round_half_even(F.col("_t"), F.lit(one)).cast("double").alias("val"),
        S.ratio_round_half_even(F.col("_t") * 100, den).cast("double").alias("pct"),
    )


def latest_min_max(df: DataFrame, value: str = "temperature_mean", as_of=None) -> DataFrame:
    v = S.nan_to_null(value)
    return latest_slice(df, as_of=as_of).agg(S.round_half_even(F.min(v), 1).alias("min_value"),
                                S.round_half_even(F.max(v), 1).alias("max_value"))


def group_mean_remap(df: DataFrame, group: str, value: str, mapping: Mapping[str, str],
                     mapped: str = "iso3", scale: int = 1, as_of=None) -> DataFrame:
    """Mean per group on the latest date, group code remapped, unmatched dropped."""
    u = S.units(value, scale)
    means = latest_slice(df, as_of=as_of).groupBy(group).agg(
        S.mean_units(F.sum(u), F.count(u), scale, half_even=True).alias(value))
    return (means.withColumn(mapped, S.code_lookup(group, mapping, None))
                 .na.drop(subset=[mapped]))


def distinct_sorted(df: DataFrame, col: str = CITY) -> DataFrame:
    return df.select(col).distinct().orderBy(col)


def date_bounds(df: DataFrame, date: str = DATE, days: int = 29) -> DataFrame:
    return df.agg(F.min(date).alias("min_date"), F.max(date).alias("max_date")).withColumn(
        "default_start", F.greatest("min_date", F.date_sub("max_date", days)))


def period_kpis(period: DataFrame) -> DataFrame:
    """Max, min, total, rainy days, mean humidity, max UV of a period."""
    v = S.nan_to_null
    return period.agg(
        S.round_half_even(F.max(v("temperature_max")), 1).alias("max_temperature"),
        S.round_half_even(F.min(v("temperature_min")), 1).alias("min_temperature"),
        S.ratio_round_half_even(F.coalesce(F.sum(S.tenths("precipitation_sum")), F.lit(0)),
                                F.lit(10)).cast("double").alias("total_precipitation"),
        F.count_if(v("precipitation_sum") > 0).alias("rainy_days"),
        S.ratio_round_half_even(F.sum(S.tenths("humidity_mean")),
                                F.count(S.tenths("humidity_mean")) * 10).cast("double")
        .alias("avg_humidity"),
        S.round_half_even(F.max(v("uv_index_max")), 1).alias("max_uv"),
    )


def last_row_gauges(period: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """The period's last row with the four gauge fills in [0, 1]."""
    last = last_n(period, 1, DATE, tie)
    hum = S.col_or_default(last, "humidity_mean", 60)
    rain = S.col_or_default(last, "precipitation_sum", 0)
    sc = P.GAUGE_SCALES
    return last.select(
        DATE, CITY, F.col("temperature_mean").alias("temp"), hum.alias("humidity"),
        F.col("wind_speed_max").alias("wind"), F.col("uv_index_max").alias("uv"),
        rain.alias("rain"),
        S.clamped_ratio(hum, sc["humidity_mean"]).alias("humidity_fill"),
        S.clamped_ratio("wind_speed_max", sc["wind_speed_max"]).alias("wind_fill"),
        S.clamped_ratio("uv_index_max", sc["uv_index_max"]).alias("uv_fill"),
        S.clamped_ratio(rain, sc["precipitation_sum"]).alias("rain_fill"),
    )


PERIOD_TABLE = ["date", "temperature_max", "temperature_min", "precipitation_sum",
                "wind_speed_max", "humidity_mean", "uv_index_max", "weather_description"]


def sorted_period(period: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """Period table, newest first (missing values last)."""
    return period.select(*PERIOD_TABLE, *tie).orderBy(F.col(DATE).desc_nulls_last(),
                                                      *_desc(tie))
