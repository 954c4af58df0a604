"""DuckDB oracle building blocks: the same definitions written as plain SQL.

Each registered query has its own SQL statement over the raw test tables; these helpers
assemble the repeated CTEs (``obs``, ``silver``) and exact rounding.  The fixture's
column expressions, the label tables and thresholds are the same values on both sides.
"""

from __future__ import annotations

import math

from pluvia import presets as P
from pluvia.plans.fixtures import OBS_SQL


def r1(x: str) -> str:
    """Half-to-even rounding to one decimal on the binary value."""
    return f"(round_even(({x}) * 10.0, 0) / 10.0)"


def bins(x: str, edges, labels) -> str:
    parts = []
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        cond = f"{x} > CAST('{lo}' AS DOUBLE)" if math.isinf(lo) else f"{x} > CAST({lo} AS DOUBLE)"
        if not (math.isinf(hi) and hi > 0):
            cond += f" AND {x} <= CAST({hi} AS DOUBLE)"
        parts.append(f"WHEN {cond} THEN '{label}'")
    return "CASE " + " ".join(parts) + " END"


def code_case(x: str) -> str:
    whens = " ".join(f"WHEN {k} THEN '{v}'" for k, v in P.WEATHER_CODES.items())
    return f"COALESCE(CASE {x} {whens} END, '{P.UNKNOWN_CODE_LABEL}')"


def half_up(num: str, den: str) -> str:
    """round(num/den) half away from zero for integers, den > 0."""
    return (f"(CASE WHEN ({den}) > 0 THEN (CASE WHEN ({num}) < 0 THEN -1 ELSE 1 END) * "
            f"((2 * abs({num}) + ({den})) // (2 * ({den}))) END)")


def half_even(num: str, den: str) -> str:
    q = f"(abs({num}) // ({den}))"
    r = f"(abs({num}) - {q} * ({den}))"
    return (f"(CASE WHEN ({den}) > 0 THEN (CASE WHEN ({num}) < 0 THEN -1 ELSE 1 END) * "
            f"({q} + CASE WHEN 2 * {r} > ({den}) OR (2 * {r} = ({den}) AND {q} % 2 = 1) "
            f"THEN 1 ELSE 0 END) END)")


def tenths(x: str) -> str:
    return f"CAST(round_even(({x}) * 10.0, 0) AS BIGINT)"


def mean1(x: str, even: bool = False) -> str:
    s, n = f"SUM({tenths(x)})", f"COUNT({x})"
    f = half_even if even else half_up
    return f"CAST({f(s, n)} AS DOUBLE) / 10.0"


OBS_CTE = f"obs AS ({OBS_SQL})"

_SILVER_INNER = (
    "SELECT *, COALESCE(temperature_mean, (temperature_max + temperature_min) / 2.0) AS _tmean, "
    "COALESCE(precipitation_sum, 0.0) AS _psum, COALESCE(precipitation_hours, 0.0) AS _phours "
    "FROM obs"
)

SILVER_SELECT = f"""SELECT date, city_name, country, country_code, region, latitude, longitude, timezone,
  {r1('temperature_max')} AS temperature_max, {r1('temperature_min')} AS temperature_min,
  {r1('_tmean')} AS temperature_mean, {r1('_psum')} AS precipitation_sum,
  _phours AS precipitation_hours, {r1('wind_speed_max')} AS wind_speed_max, wind_direction,
  {r1('humidity_max')} AS humidity_max, {r1('humidity_min')} AS humidity_min,
  {r1('uv_index_max')} AS uv_index_max, weather_code,
  {code_case('weather_code')} AS weather_description,
  {r1('temperature_max - temperature_min')} AS temperature_range,
  {r1('(humidity_max + humidity_min) / 2.0')} AS humidity_mean,
  {bins('_psum', P.PRECIPITATION_EDGES, P.PRECIPITATION_LABELS)} AS precipitation_category,
  {bins('_tmean', P.TEMPERATURE_EDGES, P.TEMPERATURE_LABELS)} AS temperature_category,
  src_id
FROM ({_SILVER_INNER}) t"""

SILVER_CTE = f"{OBS_CTE}, silver AS ({SILVER_SELECT})"

STG_SELECT = """SELECT date, city_name, country, country_code, region, round(latitude, 4) AS latitude,
  round(longitude, 4) AS longitude, timezone, temperature_max, temperature_min, temperature_mean,
  temperature_range, temperature_category, COALESCE(precipitation_sum, 0) AS precipitation_sum,
  COALESCE(precipitation_hours, 0) AS precipitation_hours, precipitation_category, wind_speed_max,
  wind_direction, humidity_max, humidity_min, humidity_mean, uv_index_max, weather_code,
  weather_description, src_id
FROM silver WHERE date IS NOT NULL AND city_name IS NOT NULL"""

DAILY_SELECT = f"""SELECT date, city_name, country, country_code, region, latitude, longitude,
  temperature_max, temperature_min, temperature_mean, temperature_range, temperature_category,
  precipitation_sum, precipitation_hours, precipitation_category, wind_speed_max, humidity_mean,
  uv_index_max, weather_description, src_id,
  COALESCE(precipitation_sum > {P.HEAVY_RAIN_MM}, FALSE) AS heavy_rain_day,
  COALESCE(temperature_max > {P.HEAT_ALERT_C}, FALSE) AS heat_alert_day,
  COALESCE(wind_speed_max > {P.WIND_ALERT_KMH}, FALSE) AS wind_alert_day
FROM stg"""

MART_CTE = f"{SILVER_CTE}, stg AS ({STG_SELECT}), daily AS ({DAILY_SELECT})"


def city_stats_sql(where: str = "") -> str:
    keys = "city_name, country, country_code, region, latitude, longitude"
    return f"""WITH {MART_CTE},
base AS (SELECT * FROM daily {where}),
agg AS (
  SELECT {keys},
    {mean1('temperature_mean')} AS avg_temperature,
    round(MAX(temperature_max), 1) AS max_temperature,
    round(MIN(temperature_min), 1) AS min_temperature,
    CAST(SUM({tenths('precipitation_sum')}) AS DOUBLE) / 10.0 AS total_precipitation,
    CAST(COUNT(*) FILTER (WHERE precipitation_sum > 0) AS BIGINT) AS rainy_days,
    CAST(COUNT(*) AS BIGINT) AS total_days,
    {mean1('wind_speed_max')} AS avg_wind_speed,
    round(MAX(wind_speed_max), 1) AS max_wind_speed,
    {mean1('humidity_mean')} AS avg_humidity,
    {mean1('uv_index_max')} AS avg_uv_index,
    CAST(COUNT(*) FILTER (WHERE heavy_rain_day) AS BIGINT) AS heavy_rain_days,
    CAST(COUNT(*) FILTER (WHERE heat_alert_day) AS BIGINT) AS heat_alert_days
  FROM base GROUP BY {keys}),
mode AS (
  SELECT {keys}, weather_description AS most_common_weather FROM (
    SELECT {keys}, weather_description,
      ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY COUNT(*) DESC, weather_description ASC) AS rn
    FROM base GROUP BY {keys}, weather_description) m WHERE rn = 1)
SELECT agg.*, mode.most_common_weather,
  CAST({half_up('agg.rainy_days * 1000', 'agg.total_days')} AS DOUBLE) / 10.0 AS rain_percentage
FROM agg JOIN mode USING ({keys})"""


def rd(x: str, digits: int) -> str:
    """Half-to-even rounding to ``digits`` on the binary value."""
    scale = f"{float(10 ** digits)}"
    return f"(round_even(({x}) * {scale}, 0) / {scale})"


def title(x: str) -> str:
    """Title-case words split on spaces (``_`` read as a space)."""
    return (f"array_to_string(list_transform(string_split(replace({x}, '_', ' '), ' '), "
            f"lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ')")


OBS_COLS_NO_ID = ["date", "city_name", "country", "country_code", "region", "latitude",
                  "longitude", "timezone", "temperature_max", "temperature_min",
                  "temperature_mean", "precipitation_sum", "precipitation_hours",
                  "wind_speed_max", "wind_direction", "humidity_max", "humidity_min",
                  "uv_index_max", "weather_code"]


def dq_sql(as_of: str, batch: str | None = None, report: bool = False) -> str:
    """Seven checks (or the report) over ``obs`` without its id column."""
    r = P.RULES
    lo, hi = r["temperature"]["min"], r["temperature"]["max"]
    phi = r["precipitation"]["max"]
    mx = r["thresholds"]["max_null_percentage"]
    ncols = len(OBS_COLS_NO_ID)
    nulls = " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in OBS_COLS_NO_ID)
    bsel = "batch, " if batch else ""
    bgrp = "GROUP BY batch" if batch else ""
    bexpr = f"{batch} AS batch, " if batch else ""
    checks = [
        ("required_fields", "TRUE", f"'{P.TEXT_REQUIRED_OK}'", "CAST(0 AS BIGINT)"),
        ("temperature_range", "bad_t = 0",
         f"CASE WHEN bad_t = 0 THEN '{P.TEXT_TEMPERATURE_OK}' ELSE "
         f"'{P.TEXT_TEMPERATURE_BAD.format(lo=lo, hi=hi)}' END", "bad_t"),
        ("precipitation_range", "bad_p = 0",
         f"CASE WHEN bad_p = 0 THEN '{P.TEXT_PRECIPITATION_OK}' ELSE "
         f"'{P.TEXT_PRECIPITATION_BAD.format(hi=phi)}' END", "bad_p"),
        ("no_future_dates", "future = 0",
         f"CASE WHEN future = 0 THEN '{P.TEXT_FUTURE_OK}' ELSE '{P.TEXT_FUTURE_BAD}' END",
         "future"),
        ("no_duplicates", "dup_rows = 0",
         f"CASE WHEN dup_rows = 0 THEN '{P.TEXT_DUPLICATES_OK}' ELSE "
         f"CAST(dup_rows AS VARCHAR) || ' filas duplicadas encontradas' END", "dup_rows"),
        ("null_percentage", f"cells = 0 OR null_cells * 100.0 <= {mx} * cells",
         "'Nulos: ' || CAST(pct_t // 10 AS VARCHAR) || '.' || CAST(pct_t % 10 AS VARCHAR) || "
         f"'% (máximo permitido: {mx}%)'", "null_cells"),
        ("temperature_consistency", "bad_c = 0",
         f"CASE WHEN bad_c = 0 THEN '{P.TEXT_CONSISTENCY_OK}' ELSE '{P.TEXT_CONSISTENCY_BAD}' END",
         "bad_c"),
    ]
    unions = "\nUNION ALL ".join(
        f"SELECT {bsel}{i + 1} AS check_order, '{n}' AS name, ({p}) AS passed, {d} AS detail, "
        f"CAST({a} AS BIGINT) AS affected_rows FROM c"
        for i, (n, p, d, a) in enumerate(checks))
    cols = ", ".join(OBS_COLS_NO_ID)
    body = f"""WITH {OBS_CTE},
b AS (SELECT {bexpr}{cols} FROM obs),
l1 AS (SELECT {bsel}city_name, date, COUNT(*) AS n, SUM({nulls}) AS nulls,
  COUNT(*) FILTER (WHERE temperature_max < {lo} OR temperature_max > {hi}
                   OR temperature_min < {lo} OR temperature_min > {hi}) AS bad_t,
  COUNT(*) FILTER (WHERE precipitation_sum < 0 OR precipitation_sum > {phi}) AS bad_p,
  COUNT(*) FILTER (WHERE date > DATE '{as_of}') AS future,
  COUNT(*) FILTER (WHERE temperature_min > temperature_max) AS bad_c
  FROM b GROUP BY {bsel}city_name, date),
c0 AS (SELECT {bsel}CAST(SUM(n) AS BIGINT) AS total_rows, CAST(COALESCE(SUM(nulls), 0) AS BIGINT) AS null_cells,
  CAST(SUM(bad_t) AS BIGINT) AS bad_t, CAST(SUM(bad_p) AS BIGINT) AS bad_p,
  CAST(SUM(future) AS BIGINT) AS future, CAST(SUM(bad_c) AS BIGINT) AS bad_c,
  CAST(COALESCE(SUM(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS dup_rows,
  CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS dup_extra
  FROM l1 {bgrp}),
c AS (SELECT *, total_rows * {ncols} AS cells,
  COALESCE({half_even('null_cells * 1000', f'total_rows * {ncols}')}, 0) AS pct_t,
  COALESCE({half_even('null_cells * 10000', f'total_rows * {ncols}')}, 0) AS pct_h FROM c0),
checks AS ({unions})"""
    if not report:
        return body + "\nSELECT * FROM checks"
    label = "batch" if batch else f"'{as_of}'"
    join = "JOIN f USING (batch)" if batch else ", f"
    return body + f""",
f AS (SELECT {bsel}COALESCE(MAX(CASE WHEN NOT passed THEN affected_rows END), 0) AS invalid_rows,
  bool_and(passed) AS overall_passed FROM checks {bgrp})
SELECT {label} AS extraction_date, total_rows, CAST(total_rows - invalid_rows AS BIGINT) AS valid_rows,
  CAST(invalid_rows AS BIGINT) AS invalid_rows, CAST(pct_h AS DOUBLE) / 100.0 AS null_percentage,
  dup_extra AS duplicate_count, overall_passed
FROM c {join}"""
