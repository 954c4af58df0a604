"""Registered queries: name -> (spark, sf_dir) -> DataFrame, plus oracle SQL.

Every query reads the given test tables (or data Spark derives from them)
in full; nothing is sampled, capped or filtered by id.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvia import presets as P
from pluvia import schemas as SC
from pluvia.functions import scalars as S
from pluvia.operators import aggregates as A
from pluvia.operators import clean as C
from pluvia.operators import dashboard as B
from pluvia.operators import flatten as N
from pluvia.operators import joins as J
from pluvia.operators import marts as M
from pluvia.operators import quality as DQ
from pluvia.plans import fixtures as X
from pluvia.plans import sqlparts as Q
from pluvia.session import work_dir
from pluvia.sources import files as FS
from pluvia.sources import warehouse as WH

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Fixed run dates: the test data spans 1995-01-01 .. 2001-08-01.
AS_OF = dt.date(2001, 8, 1)
AS_OF_EARLY = dt.date(2000, 12, 31)


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.clean(X.obs(spark, sf_dir))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.daily_summary(M.staging(silver(spark, sf_dir), extra=["src_id"]), extra=["src_id"])


@register("silver_clean", f"WITH {Q.SILVER_CTE} SELECT * FROM silver")
def q_silver_clean(spark, sf_dir):
    return silver(spark, sf_dir)


@register("mart_city_stats", Q.city_stats_sql())
def q_mart_city_stats(spark, sf_dir):
    return M.city_stats(daily(spark, sf_dir))


@register("city_stats_30d", Q.city_stats_sql(
    f"WHERE date >= CAST(DATE '{AS_OF}' - INTERVAL 30 DAY AS DATE)"))
def q_city_stats_30d(spark, sf_dir):
    return M.city_stats(daily(spark, sf_dir), window_days=30, as_of=AS_OF)


# ---------------------------------------------------------------------------
# Shared pieces.
# ---------------------------------------------------------------------------

TIE = ("city_name", "src_id")
SILVER = f"WITH {Q.SILVER_CTE} "
LATEST = "(SELECT max(date) FROM silver)"
WINDOW_START = f"CAST(DATE '{AS_OF}' - INTERVAL {P.DAYS_BACK} DAY AS DATE)"


def r1(c):
    return S.round_half_even(c, 1)


# ---------------------------------------------------------------------------
# P: projections and scalar functions.
# ---------------------------------------------------------------------------

@register("parse_date", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS date "
          "FROM orders")
def q_parse_date(spark, sf_dir):
    o = X.table(spark, sf_dir, "orders")
    return o.select("o_orderkey",
                    S.parse_date(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"))


@register("coerce_numeric", "SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) "
          "AS priority_num, TRY_CAST(o_orderpriority AS DOUBLE) AS priority_text FROM orders")
def q_coerce_numeric(spark, sf_dir):
    o = X.table(spark, sf_dir, "orders")
    return o.select("o_orderkey",
                    S.coerce_double(F.substring("o_orderpriority", 1, 1)).alias("priority_num"),
                    S.coerce_double("o_orderpriority").alias("priority_text"))


@register("coerce_integer", "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS quantity "
          "FROM lineitem")
def q_coerce_integer(spark, sf_dir):
    li = X.table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     S.coerce_integer("l_quantity", "l_quantity").alias("quantity"))


@register("impute_midpoint", f"WITH {Q.OBS_CTE} SELECT src_id, COALESCE(temperature_mean, "
          "(temperature_max + temperature_min) / 2.0) AS temperature_mean FROM obs")
def q_impute_midpoint(spark, sf_dir):
    return C.fill_missing(X.obs(spark, sf_dir)).select("src_id", "temperature_mean")


@register("fill_zero", f"WITH {Q.OBS_CTE} SELECT src_id, COALESCE(precipitation_sum, 0.0) AS "
          "precipitation_sum, COALESCE(precipitation_hours, 0.0) AS precipitation_hours, "
          "temperature_max FROM obs")
def q_fill_zero(spark, sf_dir):
    df = X.obs(spark, sf_dir)
    return df.na.fill(0.0, P.ZERO_FILL_COLUMNS).select(
        "src_id", "precipitation_sum", "precipitation_hours", "temperature_max")


@register("code_lookup", f"WITH {Q.OBS_CTE} SELECT src_id, weather_code, "
          f"{Q.code_case('weather_code')} AS weather_description FROM obs")
def q_code_lookup(spark, sf_dir):
    return C.add_code_label(X.obs(spark, sf_dir)).select(
        "src_id", "weather_code", "weather_description")


@register("derived_range", f"WITH {Q.OBS_CTE} SELECT src_id, "
          f"{Q.r1('temperature_max - temperature_min')} AS temperature_range FROM obs")
def q_derived_range(spark, sf_dir):
    return C.add_derived(X.obs(spark, sf_dir)).select("src_id", "temperature_range")


@register("derived_midpoint", f"WITH {Q.OBS_CTE} SELECT src_id, "
          f"{Q.r1('(humidity_max + humidity_min) / 2.0')} AS humidity_mean FROM obs")
def q_derived_midpoint(spark, sf_dir):
    return C.add_derived(X.obs(spark, sf_dir)).select("src_id", "humidity_mean")


@register("bin_precipitation", f"{SILVER} SELECT src_id, precipitation_category FROM silver")
def q_bin_precipitation(spark, sf_dir):
    return silver(spark, sf_dir).select("src_id", "precipitation_category")


@register("bin_temperature", f"{SILVER} SELECT src_id, temperature_category FROM silver")
def q_bin_temperature(spark, sf_dir):
    return silver(spark, sf_dir).select("src_id", "temperature_category")


PRICE_EDGES = [0.0, 1000.0, 10000.0, 50000.0, float("inf")]
PRICE_LABELS = ["small", "medium", "large", "very large"]


@register("bin_price", "SELECT l_orderkey, l_linenumber, l_extendedprice, "
          f"{Q.bins('l_extendedprice', PRICE_EDGES, PRICE_LABELS)} AS price_band FROM lineitem")
def q_bin_price(spark, sf_dir):
    li = X.table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_extendedprice",
                     S.bin_right_closed("l_extendedprice", PRICE_EDGES, PRICE_LABELS)
                     .alias("price_band"))


@register("round_columns", f"WITH {Q.OBS_CTE} SELECT src_id, "
          + ", ".join(f"{Q.r1(c)} AS {c}" for c in P.ROUNDED_COLUMNS) + " FROM obs")
def q_round_columns(spark, sf_dir):
    return C.round_columns(X.obs(spark, sf_dir)).select("src_id", *P.ROUNDED_COLUMNS)


@register("threshold_flags", f"WITH {Q.MART_CTE} SELECT src_id, heavy_rain_day, heat_alert_day, "
          "wind_alert_day FROM daily")
def q_threshold_flags(spark, sf_dir):
    return daily(spark, sf_dir).select("src_id", "heavy_rain_day", "heat_alert_day",
                                       "wind_alert_day")


@register("safe_percentage", f"""{SILVER}
SELECT country, CAST(COUNT(*) FILTER (WHERE precipitation_sum > 0) AS BIGINT) AS rainy_days,
  CAST(COUNT(*) AS BIGINT) AS total_days,
  CAST({Q.half_up('COUNT(*) FILTER (WHERE precipitation_sum > 0) * 1000', 'COUNT(*)')} AS DOUBLE) / 10.0
  AS rain_percentage
FROM silver GROUP BY country""")
def q_safe_percentage(spark, sf_dir):
    g = silver(spark, sf_dir).groupBy("country").agg(
        F.count_if(F.col("precipitation_sum") > 0).alias("rainy_days"),
        F.count(F.lit(1)).alias("total_days"))
    return g.withColumn("rain_percentage",
                        S.safe_percentage(F.col("rainy_days"), F.col("total_days"), 1))


@register("share_of_max", f"""{SILVER},
t AS (SELECT country, SUM({Q.tenths('precipitation_sum')}) AS s FROM silver GROUP BY country)
SELECT country, CAST(s AS DOUBLE) / 10.0 AS total_precipitation,
  CAST(s AS DOUBLE) / CAST(COALESCE(NULLIF((SELECT max(s) FROM t), 0), 1) AS DOUBLE) * 100.0 AS share
FROM t""")
def q_share_of_max(spark, sf_dir):
    sums = silver(spark, sf_dir).groupBy("country").agg(
        F.sum(S.tenths("precipitation_sum")).alias("s"))
    mx = sums.select(F.max("s")).scalar()
    return sums.select("country", (F.col("s") / F.lit(10.0)).alias("total_precipitation"),
                       S.share_of_max(F.col("s").cast("double"), mx.cast("double"))
                       .alias("share"))


def gauge_sql(x: str, scale: float) -> str:
    """What a gauge shows of a value that may be NULL or NaN."""
    return f"CASE WHEN {x} IS NULL OR isnan({x}) OR {x} <= 0 THEN 0.0 WHEN {x} >= {scale} THEN 1.0 ELSE {x} / {scale} END"


# Columns with NULLs, values below zero and above the scale, and (odd) with NaN.
GAUGED = {"precipitation_sum": 50.0, "precipitation_hours": 20.0, "temperature_max": 30.0, "odd": 40.0}


@register("clamped_ratio", f"""WITH {Q.OBS_CTE}, g AS (SELECT *,
  CASE WHEN src_id % 19 = 0 THEN CAST('NaN' AS DOUBLE) ELSE temperature_min END AS odd FROM obs)
SELECT src_id, {', '.join(f"{gauge_sql(c, v)} AS {c}_fill" for c, v in GAUGED.items())} FROM g""")
def q_clamped_ratio(spark, sf_dir):
    g = X.obs(spark, sf_dir).withColumn("odd", F.when(
        F.col("src_id") % 19 == 0, F.lit(float("nan"))).otherwise(F.col("temperature_min")))
    return g.select("src_id", *[S.clamped_ratio(c, v).alias(f"{c}_fill") for c, v in GAUGED.items()])


@register("string_labels", f"""SELECT n_nationkey, n_name || ', ' || r_name AS label,
  {Q.title('lower(r_name)')} AS region_title, {Q.title('lower(n_name)')} AS nation_title
FROM nation JOIN region ON n_regionkey = r_regionkey""")
def q_string_labels(spark, sf_dir):
    d = X.nation_region(spark, sf_dir)
    return d.select("n_nationkey", F.concat_ws(", ", "n_name", "r_name").alias("label"),
                    S.title_label(F.lower("r_name")).alias("region_title"),
                    S.title_label(F.lower("n_name")).alias("nation_title"))


@register("date_label", "SELECT o_orderkey, strftime(o_orderdate, '%d %b') AS label FROM orders")
def q_date_label(spark, sf_dir):
    o = X.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", S.date_label(F.to_date("o_orderdate")).alias("label"))


@register("json_scalar_parse", "SELECT event_id, event_type, "
          "CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def q_json_scalar_parse(spark, sf_dir):
    ev = X.table(spark, sf_dir, "events")
    return ev.select("event_id", "event_type", S.json_field("props", "k BIGINT", "k").alias("k"))


# ---------------------------------------------------------------------------
# F: filters.
# ---------------------------------------------------------------------------

@register("window_days_back", f"{SILVER} SELECT src_id, date, city_name FROM silver "
          f"WHERE date BETWEEN {WINDOW_START} AND DATE '{AS_OF}'")
def q_window_days_back(spark, sf_dir):
    return B.window_days_back(silver(spark, sf_dir), AS_OF).select("src_id", "date", "city_name")


@register("trailing_from_latest", f"{SILVER} SELECT src_id, date, city_name, precipitation_sum "
          f"FROM silver WHERE date >= CAST({LATEST} - INTERVAL 30 DAY AS DATE)")
def q_trailing_from_latest(spark, sf_dir):
    return B.trailing_from_latest(silver(spark, sf_dir), 30).select(
        "src_id", "date", "city_name", "precipitation_sum")


@register("latest_slice", f"{SILVER} SELECT src_id, date, city_name, temperature_mean "
          f"FROM silver WHERE date = {LATEST}")
def q_latest_slice(spark, sf_dir):
    return B.latest_slice(silver(spark, sf_dir)).select(
        "src_id", "date", "city_name", "temperature_mean")


@register("default_range", f"{SILVER} SELECT greatest(min(date), CAST(max(date) - INTERVAL 29 DAY "
          "AS DATE)) AS start_date, max(date) AS end_date FROM silver")
def q_default_range(spark, sf_dir):
    return B.default_range(silver(spark, sf_dir))


PERIOD_SQL = f"""{SILVER},
sel AS (SELECT COALESCE(max(CASE WHEN city_name = 'Lima' THEN city_name END), min(city_name)) AS k,
  greatest(min(date), CAST(max(date) - INTERVAL 29 DAY AS DATE)) AS s, max(date) AS e FROM silver),
period AS (SELECT silver.* FROM silver, sel WHERE city_name = sel.k AND date >= sel.s AND date <= sel.e)
"""


def period(spark, sf_dir):
    return B.default_period(silver(spark, sf_dir), preferred="Lima", tie=("src_id",))


@register("key_range_filter", PERIOD_SQL + "SELECT date, city_name, temperature_max, temperature_min, "
          "temperature_mean, precipitation_sum, wind_speed_max, src_id FROM period")
def q_key_range_filter(spark, sf_dir):
    return period(spark, sf_dir).select(
        "date", "city_name", "temperature_max", "temperature_min", "temperature_mean",
        "precipitation_sum", "wind_speed_max", "src_id")


# ---------------------------------------------------------------------------
# J: joins.
# ---------------------------------------------------------------------------

@register("coverage_gap", f"""SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (
  SELECT 1 FROM orders WHERE o_custkey = c_custkey
    AND CAST(o_orderdate AS DATE) BETWEEN {WINDOW_START} AND DATE '{AS_OF}')""")
def q_coverage_gap(spark, sf_dir):
    cust = X.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    got = B.window_days_back(
        X.table(spark, sf_dir, "orders").select(
            F.col("o_custkey").alias("c_custkey"), F.to_date("o_orderdate").alias("date")),
        AS_OF)
    return J.coverage_gap(cust, got, "c_custkey")


@register("attach_dimension", """SELECT c_custkey, c_name, n_name AS city_name, r_name AS country,
  upper(substr(r_name, 1, 2)) AS country_code
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def q_attach_dimension(spark, sf_dir):
    cust = X.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    dims = X.nation_region(spark, sf_dir)
    return J.attach_dimension(cust, dims, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_name", F.col("n_name").alias("city_name"), F.col("r_name").alias("country"),
        F.upper(F.substring("r_name", 1, 2)).alias("country_code"))


@register("scan_dimension", """SELECT n_name AS name, r_name AS country,
  upper(substr(r_name, 1, 2)) AS country_code, concat('Z', CAST(n_nationkey % 4 AS VARCHAR)) AS region,
  CAST(n_nationkey * 3 - 40 AS DOUBLE) AS latitude, CAST(-30 - n_nationkey * 3 AS DOUBLE) AS longitude,
  'Etc/UTC' AS timezone
FROM nation JOIN region ON n_regionkey = r_regionkey""")
def q_scan_dimension(spark, sf_dir):
    d = X.nation_region(spark, sf_dir)
    return d.selectExpr(
        "n_name AS name", "r_name AS country", "upper(substr(r_name, 1, 2)) AS country_code",
        "concat('Z', CAST(n_nationkey % 4 AS STRING)) AS region",
        "CAST(n_nationkey * 3 - 40 AS DOUBLE) AS latitude",
        "CAST(-30 - n_nationkey * 3 AS DOUBLE) AS longitude", "'Etc/UTC' AS timezone")


@register("run_summary", f"""WITH req AS (
  SELECT c_custkey, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey),
got AS (SELECT DISTINCT o_custkey FROM orders
  WHERE CAST(o_orderdate AS DATE) BETWEEN {WINDOW_START} AND DATE '{AS_OF}')
SELECT r_name, CAST(COUNT(*) AS BIGINT) AS total_requested,
  CAST(COUNT(got.o_custkey) AS BIGINT) AS total_successful,
  CAST(COUNT(*) - COUNT(got.o_custkey) AS BIGINT) AS total_failed
FROM req LEFT JOIN got ON req.c_custkey = got.o_custkey GROUP BY r_name""")
def q_run_summary(spark, sf_dir):
    cust = X.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    dims = X.nation_region(spark, sf_dir).select("n_nationkey", "r_name")
    req = J.attach_dimension(cust, dims, F.col("c_nationkey") == F.col("n_nationkey"))
    got = B.window_days_back(
        X.table(spark, sf_dir, "orders").select(
            F.col("o_custkey").alias("c_custkey"), F.to_date("o_orderdate").alias("date")),
        AS_OF)
    return A.run_summary(req.select("c_custkey", "r_name"), got, ["c_custkey"], batch=["r_name"])


# ---------------------------------------------------------------------------
# A / W / L: aggregates, windows, ordering.
# ---------------------------------------------------------------------------

@register("conditional_counts", f"""WITH {Q.MART_CTE}
SELECT city_name, CAST(COUNT(*) FILTER (WHERE precipitation_sum > 0) AS BIGINT) AS rainy_days,
  CAST(COUNT(*) FILTER (WHERE heavy_rain_day) AS BIGINT) AS heavy_rain_days,
  CAST(COUNT(*) FILTER (WHERE heat_alert_day) AS BIGINT) AS heat_alert_days,
  CAST(COUNT(*) FILTER (WHERE wind_alert_day) AS BIGINT) AS wind_alert_days,
  CAST(COUNT(*) FILTER (WHERE temperature_max > 60) AS BIGINT) AS hot_unknown
FROM daily GROUP BY city_name""")
def q_conditional_counts(spark, sf_dir):
    return daily(spark, sf_dir).groupBy("city_name").agg(
        F.count_if(F.col("precipitation_sum") > 0).alias("rainy_days"),
        F.count_if("heavy_rain_day").alias("heavy_rain_days"),
        F.count_if("heat_alert_day").alias("heat_alert_days"),
        F.count_if("wind_alert_day").alias("wind_alert_days"),
        # NULL comparisons are not counted.
        F.count_if(F.col("temperature_max") > 60).alias("hot_unknown"))


@register("most_frequent", f"""{SILVER}
SELECT city_name, weather_description AS most_common_weather FROM (
  SELECT city_name, weather_description,
    ROW_NUMBER() OVER (PARTITION BY city_name ORDER BY COUNT(*) DESC, weather_description) AS rn
  FROM silver GROUP BY city_name, weather_description) t WHERE rn = 1""")
def q_most_frequent(spark, sf_dir):
    return A.most_frequent(silver(spark, sf_dir), ["city_name"], "weather_description",
                           "most_common_weather")


@register("most_frequent_approx", f"""{SILVER}
SELECT city_name, CAST(max(n) AS BIGINT) AS most_common_weather_count FROM (
  SELECT city_name, weather_description, COUNT(*) AS n FROM silver GROUP BY ALL) t GROUP BY city_name""")
def q_most_frequent_approx(spark, sf_dir):
    """The winning count: at a tie the sketch may name another label of that count."""
    return A.most_frequent_approx(silver(spark, sf_dir), ["city_name"], "weather_description",
                                  "most_common_weather").drop("most_common_weather")


@register("distinct_sorted", f"{SILVER} SELECT DISTINCT city_name FROM silver")
def q_distinct_sorted(spark, sf_dir):
    return B.distinct_sorted(silver(spark, sf_dir))


@register("date_bounds", f"{SILVER} SELECT min(date) AS min_date, max(date) AS max_date, "
          "greatest(min(date), CAST(max(date) - INTERVAL 29 DAY AS DATE)) AS default_start FROM silver")
def q_date_bounds(spark, sf_dir):
    return B.date_bounds(silver(spark, sf_dir))


DUP_SQL = f"""WITH {Q.OBS_CTE}, k AS (SELECT city_name, date, COUNT(*) AS n FROM obs GROUP BY city_name, date)
SELECT CAST(COALESCE(SUM(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS duplicate_rows,
  CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicate_extra FROM k"""


@register("duplicate_rows", DUP_SQL.replace(
    "AS duplicate_rows,\n  CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicate_extra", "AS duplicate_rows"))
def q_duplicate_rows(spark, sf_dir):
    return A.duplicate_counts(X.obs(spark, sf_dir), P.KEY).select("duplicate_rows")


@register("duplicate_extra", DUP_SQL.replace(
    "CAST(COALESCE(SUM(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS duplicate_rows,\n  ", ""))
def q_duplicate_extra(spark, sf_dir):
    return A.duplicate_counts(X.obs(spark, sf_dir), P.KEY).select("duplicate_extra")


@register("last_n_per_key", f"""{SILVER}
SELECT city_name, date, src_id, rn FROM (
  SELECT city_name, date, src_id,
    ROW_NUMBER() OVER (PARTITION BY city_name ORDER BY date DESC, src_id DESC) AS rn FROM silver) t
WHERE rn <= 8""")
def q_last_n_per_key(spark, sf_dir):
    return B.last_n_per_key(silver(spark, sf_dir).select("city_name", "date", "src_id"),
                            "city_name", 8, tie=("src_id",))


# ---------------------------------------------------------------------------
# B: dashboard queries.
# ---------------------------------------------------------------------------

@register("headline_kpis", f"""{SILVER},
w AS (SELECT * FROM silver WHERE date >= CAST({LATEST} - INTERVAL 30 DAY AS DATE)),
l AS (SELECT * FROM silver WHERE date = {LATEST})
SELECT (SELECT max(date) FROM w) AS latest_date,
  (SELECT CAST(COUNT(DISTINCT city_name) AS BIGINT) FROM l) AS n_cities,
  (SELECT CAST({Q.half_even(f"SUM({Q.tenths('temperature_mean')})", 'COUNT(temperature_mean)')} AS DOUBLE) / 10.0
     FROM l) AS avg_temperature,
  (SELECT CAST({Q.half_even(f"COALESCE(SUM({Q.tenths('precipitation_sum')}), 0)", '10')} AS DOUBLE) FROM w)
    AS rain_30d""")
def q_headline_kpis(spark, sf_dir):
    return B.headline_kpis(silver(spark, sf_dir))


LATEST_ROWS = f"(SELECT * FROM silver WHERE date = {LATEST})"


@register("arg_max_row", f"""{SILVER}
SELECT city_name, country, weather_description, {Q.r1('temperature_mean')} AS temp,
  {Q.r1('temperature_max')} AS temp_max, {Q.r1('temperature_min')} AS temp_min,
  {Q.rd('humidity_mean', 0)} AS humidity, {Q.rd('wind_speed_max', 0)} AS wind,
  {Q.r1('uv_index_max')} AS uv, {Q.r1('precipitation_sum')} AS rain
FROM {LATEST_ROWS} t WHERE temperature_max IS NOT NULL
ORDER BY temperature_max DESC, city_name, src_id LIMIT 1""")
def q_arg_max_row(spark, sf_dir):
    return B.selected_card(silver(spark, sf_dir), TIE)


@register("arg_min_row", f"""{SILVER}
SELECT city_name, country, temperature_min, src_id FROM {LATEST_ROWS} t
WHERE temperature_min IS NOT NULL ORDER BY temperature_min ASC, city_name, src_id LIMIT 1""")
def q_arg_min_row(spark, sf_dir):
    return B.arg_max_row(B.latest_slice(silver(spark, sf_dir)), "temperature_min", TIE,
                         largest=False).select("city_name", "country", "temperature_min", "src_id")


@register("top_k", f"""{SILVER}
SELECT city_name AS name, country_code AS country, {Q.r1('temperature_mean')} AS temp,
  weather_description AS condition, {Q.r1('precipitation_sum')} AS rain,
  {Q.rd('longitude', 2)} AS lon, {Q.rd('latitude', 2)} AS lat
FROM {LATEST_ROWS} t ORDER BY temperature_mean DESC NULLS LAST, city_name, src_id LIMIT 8""")
def q_top_k(spark, sf_dir):
    return B.top_cities(silver(spark, sf_dir), 8, TIE)


@register("trend_of_top_key", f"""{SILVER},
hot AS (SELECT city_name FROM {LATEST_ROWS} t WHERE temperature_max IS NOT NULL
        ORDER BY temperature_max DESC, city_name, src_id LIMIT 1)
SELECT date, city_name, strftime(date, '%d %b') AS label, {Q.r1('temperature_max')} AS temp_max,
  {Q.r1('temperature_min')} AS temp_min, {Q.r1('temperature_mean')} AS temp_mean,
  {Q.r1('precipitation_sum')} AS rain, weather_description AS condition, src_id
FROM (SELECT * FROM silver WHERE city_name = (SELECT city_name FROM hot)
      ORDER BY date DESC, src_id DESC LIMIT 8) t""")
def q_trend_of_top_key(spark, sf_dir):
    return B.trend_of_top_key(silver(spark, sf_dir), 8, tie=("src_id",))


@register("latest_points", f"""{SILVER}
SELECT city_name, {Q.rd('latitude', 4)} AS lat, {Q.rd('longitude', 4)} AS lon,
  {Q.r1('temperature_mean')} AS temp, city_name || ', ' || country AS label FROM {LATEST_ROWS} t""")
def q_latest_points(spark, sf_dir):
    return B.latest_points(silver(spark, sf_dir))


@register("top_groups_share", f"""{SILVER},
s AS (SELECT country, COALESCE(SUM({Q.tenths('precipitation_sum')}), 0) AS t FROM silver
      WHERE date >= CAST({LATEST} - INTERVAL 30 DAY AS DATE) GROUP BY country),
top AS (SELECT * FROM s ORDER BY t DESC, country LIMIT 6),
m AS (SELECT CASE WHEN max(t) = 0 THEN 10 ELSE max(t) END AS d FROM top)
SELECT country AS name, CAST({Q.half_even('t', '10')} AS DOUBLE) AS val,
  CAST({Q.half_even('t * 100', 'm.d')} AS DOUBLE) AS pct FROM top, m""")
def q_top_groups_share(spark, sf_dir):
    return B.top_groups_share(silver(spark, sf_dir))


@register("latest_min_max", f"""{SILVER} SELECT {Q.r1('min(temperature_mean)')} AS min_value,
  {Q.r1('max(temperature_mean)')} AS max_value FROM {LATEST_ROWS} t""")
def q_latest_min_max(spark, sf_dir):
    return B.latest_min_max(silver(spark, sf_dir))


# Test mapping for the obs codes (AF/AM/AS/EU mapped, MI left unmatched).
REMAP = {"AF": "AFR", "AM": "AMR", "AS": "ASI", "EU": "EUR"}


@register("group_mean_remap", f"""{SILVER}
SELECT country_code, CAST({Q.half_even(f"SUM({Q.tenths('temperature_mean')})", 'COUNT(temperature_mean)')}
  AS DOUBLE) / 10.0 AS temperature_mean,
  CASE country_code {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in REMAP.items())} END AS iso3
FROM {LATEST_ROWS} t GROUP BY country_code HAVING iso3 IS NOT NULL""")
def q_group_mean_remap(spark, sf_dir):
    return B.group_mean_remap(silver(spark, sf_dir), "country_code", "temperature_mean", REMAP)


@register("period_kpis", PERIOD_SQL + f"""SELECT {Q.r1('max(temperature_max)')} AS max_temperature,
  {Q.r1('min(temperature_min)')} AS min_temperature,
  CAST({Q.half_even(f"COALESCE(SUM({Q.tenths('precipitation_sum')}), 0)", '10')} AS DOUBLE) AS total_precipitation,
  CAST(COUNT(*) FILTER (WHERE precipitation_sum > 0) AS BIGINT) AS rainy_days,
  CAST({Q.half_even(f"SUM({Q.tenths('humidity_mean')})", 'COUNT(humidity_mean) * 10')} AS DOUBLE) AS avg_humidity,
  {Q.r1('max(uv_index_max)')} AS max_uv FROM period""")
def q_period_kpis(spark, sf_dir):
    return B.period_kpis(period(spark, sf_dir))


@register("last_row_gauges", PERIOD_SQL + """SELECT date, city_name, temperature_mean AS temp,
  humidity_mean AS humidity, wind_speed_max AS wind, uv_index_max AS uv, precipitation_sum AS rain,
  """ + ", ".join(f"{gauge_sql(c, v)} AS {n}_fill" for n, c, v in (
    ("humidity", "humidity_mean", 100.0), ("wind", "wind_speed_max", 120.0),
    ("uv", "uv_index_max", 12.0), ("rain", "precipitation_sum", 50.0))) + """
FROM period ORDER BY date DESC, src_id DESC LIMIT 1""")
def q_last_row_gauges(spark, sf_dir):
    return B.last_row_gauges(period(spark, sf_dir), tie=("src_id",))


@register("sorted_period", PERIOD_SQL + """SELECT date, temperature_max, temperature_min,
  precipitation_sum, wind_speed_max, humidity_mean, uv_index_max, weather_description, src_id
FROM period""")
def q_sorted_period(spark, sf_dir):
    return B.sorted_period(period(spark, sf_dir), tie=("src_id",))


# ---------------------------------------------------------------------------
# M: models.
# ---------------------------------------------------------------------------

@register("stg_observations", f"WITH {Q.SILVER_CTE}, stg AS ({Q.STG_SELECT}) SELECT * FROM stg")
def q_stg_observations(spark, sf_dir):
    return M.staging(silver(spark, sf_dir), extra=["src_id"])


@register("mart_daily_summary", f"WITH {Q.MART_CTE} SELECT * FROM daily")
def q_mart_daily_summary(spark, sf_dir):
    return daily(spark, sf_dir)


# ---------------------------------------------------------------------------
# Q: data quality.
# ---------------------------------------------------------------------------

def batch_rows(spark, sf_dir):
    """``obs`` as flattened batches: the 19 observation columns."""
    return X.observations(spark, sf_dir)


@register("dq_all_checks", Q.dq_sql(str(AS_OF)))
def q_dq_all_checks(spark, sf_dir):
    return DQ.run_all_checks(batch_rows(spark, sf_dir), AS_OF)


def _one(name, as_of=AS_OF):
    sql = f"SELECT name, passed, detail, affected_rows FROM ({Q.dq_sql(str(as_of))}) x WHERE name = '{name}'"

    def fn(spark, sf_dir):
        return DQ.single_check(batch_rows(spark, sf_dir), name, as_of)
    return sql, fn


for _key, _name, _asof in [
        ("dq_required_fields", "required_fields", AS_OF),
        ("dq_range_temperature", "temperature_range", AS_OF),
        ("dq_range_precipitation", "precipitation_range", AS_OF),
        ("dq_future_dates", "no_future_dates", AS_OF_EARLY),
        ("dq_duplicates", "no_duplicates", AS_OF),
        ("dq_null_percentage", "null_percentage", AS_OF),
        ("dq_consistency", "temperature_consistency", AS_OF)]:
    _sql, _fn = _one(_name, _asof)
    register(_key, _sql)(_fn)

YEAR_BATCH_SQL = "CAST(year(date) AS VARCHAR) || '-12-31'"


def year_batches(spark, sf_dir):
    df = batch_rows(spark, sf_dir)
    return df.withColumn("extraction_date",
                         F.concat(F.year("date").cast("string"), F.lit("-12-31")))


def reports(spark, sf_dir):
    return DQ.quality_report(year_batches(spark, sf_dir), AS_OF, batch=["extraction_date"],
                             batch_label="extraction_date")


@register("quality_report", Q.dq_sql(str(AS_OF), YEAR_BATCH_SQL, report=True))
def q_quality_report(spark, sf_dir):
    return reports(spark, sf_dir).drop("checks")


@register("dq_not_null", f"""{SILVER}
SELECT 'date' AS column_name, CAST(COUNT(*) FILTER (WHERE date IS NULL) AS BIGINT) AS null_rows FROM silver
UNION ALL SELECT 'city_name', CAST(COUNT(*) FILTER (WHERE city_name IS NULL) AS BIGINT) FROM silver
UNION ALL SELECT 'country_code', CAST(COUNT(*) FILTER (WHERE country_code IS NULL) AS BIGINT) FROM silver
UNION ALL SELECT 'temperature_mean', CAST(COUNT(*) FILTER (WHERE temperature_mean IS NULL) AS BIGINT) FROM silver""")
def q_dq_not_null(spark, sf_dir):
    return DQ.not_null_tests(silver(spark, sf_dir),
                             ["date", "city_name", "country_code", "temperature_mean"]) \
        .select("column_name", "null_rows")


# ---------------------------------------------------------------------------
# S: sources and sinks (written under the session's checkpoint folder).
# ---------------------------------------------------------------------------

REPORTS_CTE = f"WITH rep AS ({Q.dq_sql(str(AS_OF), YEAR_BATCH_SQL, report=True)})"


def report_history(spark, sf_dir):
    """Write one report per batch (S8), read the history back (S9)."""
    path = FS.write_reports(reports(spark, sf_dir), work_dir(spark, "quality"))
    return FS.read_reports(spark, path)


@register("report_latest", f"""{REPORTS_CTE}
SELECT extraction_date, overall_passed AS run_ok, valid_rows, total_rows,
  CASE WHEN total_rows = 0 THEN 0.0
       ELSE CAST({Q.half_even('valid_rows * 1000', 'total_rows')} AS DOUBLE) / 10.0 END AS quality_pct
FROM rep ORDER BY extraction_date DESC LIMIT 1""")
def q_report_latest(spark, sf_dir):
    hist = report_history(spark, sf_dir)
    n = batch_rows(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))
    return DQ.report_status(hist, n)


_CHECKS_SQL = Q.dq_sql(str(AS_OF), YEAR_BATCH_SQL)


@register("report_checks", f"""SELECT batch AS extraction_date, check_order, name, {Q.title('name')} AS label,
  passed, detail, affected_rows
FROM (SELECT *, max(batch) OVER () AS mb FROM ({_CHECKS_SQL}) x) y WHERE batch = mb""")
def q_report_checks(spark, sf_dir):
    return DQ.checks_of_reports(FS.latest_report(report_history(spark, sf_dir)))


@register("quality_percentage", f"""{REPORTS_CTE}
SELECT extraction_date, valid_rows, total_rows,
  CASE WHEN total_rows = 0 THEN 0.0
       ELSE CAST({Q.half_even('valid_rows * 1000', 'total_rows')} AS DOUBLE) / 10.0 END AS quality_pct
FROM rep""")
def q_quality_percentage(spark, sf_dir):
    hist = report_history(spark, sf_dir)
    return hist.select("extraction_date", "valid_rows", "total_rows",
                       DQ.quality_pct(F.col("valid_rows"), F.col("total_rows")).alias("quality_pct"))


@register("concat_runs", f"""{SILVER}
SELECT src_id, date, city_name, timezone, 'a' AS run FROM silver WHERE date <= DATE '1998-12-31'
UNION ALL
SELECT src_id, date, city_name, CAST(NULL AS VARCHAR) AS timezone, 'b' AS run FROM silver
WHERE date >= DATE '1998-01-01'""")
def q_concat_runs(spark, sf_dir):
    s = silver(spark, sf_dir).select("src_id", "date", "city_name", "timezone")
    run_a = s.where(F.col("date") <= F.lit("1998-12-31").cast("date")).withColumn("run", F.lit("a"))
    run_b = (s.where(F.col("date") >= F.lit("1998-01-01").cast("date")).drop("timezone")
             .withColumn("run", F.lit("b")))
    return FS.concat_runs(run_a, run_b)


LOAD_TS1 = dt.datetime(2001, 8, 2, 6, 0, 0)
# The test data holds a few rows per day over six years: one folder per month.
GRAIN = "month"
LOAD_TS2 = dt.datetime(2001, 8, 3, 6, 0, 0)


def _table(spark):
    return WH.new_table_path(work_dir(spark, "warehouse"))


@register("load_append_twice", f"""{SILVER}
SELECT date, city_name, CAST(2 * COUNT(*) AS BIGINT) AS n_rows, CAST(2 AS BIGINT) AS n_loads
FROM silver GROUP BY date, city_name""")
def q_load_append_twice(spark, sf_dir):
    root = _table(spark)
    s = silver(spark, sf_dir)
    WH.load(s, root, "append", LOAD_TS1, grain=GRAIN)
    WH.load(s, root, "append", LOAD_TS2, grain=GRAIN)
    return WH.read_table(spark, root).groupBy("date", "city_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("loaded_at").alias("n_loads"))


@register("load_metrics", f"""{SILVER}
SELECT CAST(1 AS BIGINT) AS load_seq, CAST(COUNT(*) AS BIGINT) AS rows_loaded,
  CAST(COUNT(*) AS BIGINT) AS table_total_rows FROM silver
UNION ALL SELECT 2, CAST(COUNT(*) AS BIGINT), CAST(2 * COUNT(*) AS BIGINT) FROM silver""")
def q_load_metrics(spark, sf_dir):
    root = _table(spark)
    s = silver(spark, sf_dir)
    m1 = WH.load(s, root, "append", LOAD_TS1, grain=GRAIN)
    m2 = WH.load(s, root, "append", LOAD_TS2, grain=GRAIN)
    rows = [(1, m1["rows_loaded"], m1["table_total_rows"]),
            (2, m2["rows_loaded"], m2["table_total_rows"])]
    return spark.createDataFrame(rows, "load_seq bigint, rows_loaded bigint, table_total_rows bigint")


@register("load_replace_partitions", f"""{SILVER},
t AS (SELECT *, CASE WHEN region = 'Z0' AND date >= CAST({LATEST} - INTERVAL {P.DAYS_BACK} DAY AS DATE)
       THEN TIMESTAMP '{LOAD_TS2}' ELSE TIMESTAMP '{LOAD_TS1}' END AS loaded_at FROM silver)
SELECT date, city_name, strftime(loaded_at, '%Y-%m-%d %H:%M:%S') AS loaded_at,
  CAST(COUNT(*) AS BIGINT) AS n_rows FROM t GROUP BY ALL""")
def q_load_replace_partitions(spark, sf_dir):
    root = _table(spark)
    s = silver(spark, sf_dir)
    WH.load(s, root, "append", LOAD_TS1, grain=GRAIN)
    recent = s.where(F.col("date") >= F.date_sub(B.latest_date(s), P.DAYS_BACK))
    WH.load(recent.where(F.col("region") == "Z0"), root, "replace_partitions", LOAD_TS2,
            grain=GRAIN)
    return (WH.read_table(spark, root)
            .groupBy("date", "city_name",
                     F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss").alias("loaded_at"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


@register("enforce_schema", f"""{SILVER}
SELECT date, city_name, country, country_code, region, latitude, longitude, timezone,
  temperature_max, temperature_min, temperature_mean, temperature_range, precipitation_sum,
  precipitation_hours, precipitation_category, wind_speed_max, wind_direction, humidity_max,
  humidity_min, humidity_mean, uv_index_max, weather_code, weather_description, temperature_category,
  CAST(NULL AS VARCHAR) AS sunrise, CAST(NULL AS VARCHAR) AS sunset, CAST(NULL AS TIMESTAMP) AS loaded_at
FROM silver""")
def q_enforce_schema(spark, sf_dir):
    return WH.enforce_schema(silver(spark, sf_dir))


# ---------------------------------------------------------------------------
# N: nested data.
# ---------------------------------------------------------------------------

@register("flatten_parallel_arrays", """SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS value,
  CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos, label FROM embeddings""")
def q_flatten_parallel_arrays(spark, sf_dir):
    emb = X.table(spark, sf_dir, "embeddings")
    flat = N.flatten_parallel(emb.select("vec_id", "label", F.struct("embedding").alias("s")),
                              "s", "embedding", {}, keep=["vec_id", "label"],
                              index_alias="value", position_alias="pos")
    return flat.withColumn("value", F.col("value").cast("double"))


@register("array_safe_get", """SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS first_value,
  CAST(embedding[len(embedding)] AS DOUBLE) AS last_value, CAST(embedding[65] AS DOUBLE) AS past_end
FROM embeddings""")
def q_array_safe_get(spark, sf_dir):
    emb = X.table(spark, sf_dir, "embeddings")
    return emb.select("vec_id",
                      N.safe_get("embedding", 0).cast("double").alias("first_value"),
                      N.safe_get("embedding", F.size("embedding") - 1).cast("double")
                      .alias("last_value"),
                      N.safe_get("embedding", 64).cast("double").alias("past_end"))


@register("flatten_obs_roundtrip", f"WITH {Q.OBS_CTE} SELECT * FROM obs")
def q_flatten_obs_roundtrip(spark, sf_dir):
    return N.roundtrip_payload(X.obs(spark, sf_dir))


# ---------------------------------------------------------------------------
# Generic operators on other tables / optional checks.
# ---------------------------------------------------------------------------

def _extra_sql():
    parts = []
    for i, (name, c, lo, hi) in enumerate(P.EXTRA_RANGES):
        bad = f"COUNT(*) FILTER (WHERE {c} < {lo} OR {c} > {hi})"
        parts.append(
            f"SELECT {8 + i} AS check_order, '{name}' AS name, ({bad} = 0) AS passed, "
            f"CASE WHEN {bad} = 0 THEN '{P.TEXT_RANGE_OK.format(col=c)}' "
            f"ELSE '{P.TEXT_RANGE_BAD.format(col=c, lo=lo, hi=hi)}' END AS detail, "
            f"CAST({bad} AS BIGINT) AS affected_rows FROM obs")
    return f"WITH {Q.OBS_CTE} " + " UNION ALL ".join(parts)


@register("dq_extra_ranges", _extra_sql())
def q_dq_extra_ranges(spark, sf_dir):
    spec = DQ.QualitySpec(extra_ranges=P.EXTRA_RANGES)
    return DQ.run_all_checks(batch_rows(spark, sf_dir), AS_OF, spec).where(F.col("check_order") > 7)


@register("events_trailing_daily", """WITH e AS (SELECT CAST(ts AS DATE) AS date, event_type, value FROM events)
SELECT date, event_type, CAST(COUNT(*) AS BIGINT) AS n_events,
  CAST(SUM(CAST(round_even(value * 100.0, 0) AS BIGINT)) AS DOUBLE) / 100.0 AS total_value
FROM e WHERE date >= CAST((SELECT max(date) FROM e) - INTERVAL 7 DAY AS DATE) GROUP BY date, event_type""")
def q_events_trailing_daily(spark, sf_dir):
    ev = X.table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("date"), "event_type", "value")
    return (B.trailing_from_latest(ev, 7)
            .groupBy("date", "event_type")
            .agg(F.count(F.lit(1)).alias("n_events"),
                 (F.sum(F.rint(F.col("value") * 100.0).cast("bigint")) / F.lit(100.0))
                 .alias("total_value")))


@register("lineitem_top_k", """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 10""")
def q_lineitem_top_k(spark, sf_dir):
    li = X.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return B.top_k(li, "l_extendedprice", 10, ("l_orderkey", "l_linenumber"))


@register("lineitem_flag_stats", f"""SELECT l_returnflag, l_linestatus, CAST(COUNT(*) AS BIGINT) AS n,
  CAST({Q.half_up('SUM(CAST(round_even(l_quantity * 10.0, 0) AS BIGINT))', 'COUNT(l_quantity)')} AS DOUBLE) / 10.0
    AS avg_quantity,
  CAST(COUNT(*) FILTER (WHERE l_discount > CAST(0.05 AS DOUBLE)) AS BIGINT) AS discounted,
  CAST({Q.half_up('COUNT(*) FILTER (WHERE l_discount > CAST(0.05 AS DOUBLE)) * 1000', 'COUNT(*)')} AS DOUBLE) / 10.0 AS discounted_pct
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def q_lineitem_flag_stats(spark, sf_dir):
    li = X.table(spark, sf_dir, "lineitem")
    g = li.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"),
        S.mean_tenths(F.sum(S.tenths("l_quantity")), F.count("l_quantity")).alias("avg_quantity"),
        F.count_if(F.col("l_discount") > 0.05).alias("discounted"))
    return g.withColumn("discounted_pct", S.safe_percentage(F.col("discounted"), F.col("n"), 1))


# Test mapping for the generic lookup on another table; 'N' is left unmapped
# so the default label is exercised.
FLAG_LABELS = {"A": "accepted", "R": "returned"}


@register("code_lookup_flag", "SELECT l_orderkey, l_linenumber, l_returnflag, "
          "COALESCE(CASE l_returnflag " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FLAG_LABELS.items())
          + " END, 'other') AS flag_label FROM lineitem")
def q_code_lookup_flag(spark, sf_dir):
    li = X.table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_returnflag",
                     S.code_lookup("l_returnflag", FLAG_LABELS, "other").alias("flag_label"))


@register("mart_city_stats_approx", f"""WITH m AS ({Q.city_stats_sql()}), {Q.SILVER_CTE},
c AS (SELECT city_name, country, country_code, region, max(n) AS n FROM (
  SELECT city_name, country, country_code, region, weather_description, COUNT(*) AS n FROM silver GROUP BY ALL) t
  GROUP BY ALL)
SELECT m.* EXCLUDE (most_common_weather), CAST(c.n AS BIGINT) AS most_common_count
FROM m JOIN c USING (city_name, country, country_code, region)""")
def q_mart_city_stats_approx(spark, sf_dir):
    """The mart with the sketch-based mode: its count, since ties may name another label."""
    return M.city_stats(daily(spark, sf_dir), mode="approx").drop("most_common_weather")


# ---------------------------------------------------------------------------
# Two-decimal totals; I/O round trips; catalog tables.
# ---------------------------------------------------------------------------

@register("group_totals_share", """WITH t AS (SELECT l_suppkey, SUM(CAST(l_extendedprice AS DECIMAL(18, 2))) AS t
  FROM lineitem WHERE CAST(l_shipdate AS DATE) >= CAST((SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem) - INTERVAL 365 DAY AS DATE)
  GROUP BY l_suppkey),
top AS (SELECT * FROM t ORDER BY t DESC, l_suppkey LIMIT 5)
SELECT l_suppkey AS name, CAST(round_even(t, 0) AS DOUBLE) AS val,
  CAST(round_even(CAST(t * 100 AS DOUBLE) / CAST((SELECT max(t) FROM top) AS DOUBLE), 0) AS DOUBLE) AS pct FROM top""")
def q_group_totals_share(spark, sf_dir):
    li = X.table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("shipped"), "l_suppkey", "l_extendedprice")
    return B.top_groups_share(li, "l_suppkey", "l_extendedprice", k=5, days=365, scale=2, date="shipped")


# Source ids of one payload document, a multiple of the ids of one response.
PAYLOAD_IDS, RESPONSE_IDS = 1 << 18, 1 << 16


def payload_responses(spark, sf_dir, ids=PAYLOAD_IDS):
    """``obs`` as per-entity responses of a month: parallel arrays beside the entity, and the
    ``bucket`` (range of ``ids`` source ids) they are from."""
    o = X.obs(spark, sf_dir).withColumns({
        "time": F.col("date").cast("string"), "month": F.date_format("date", "yyyy-MM"),
        "sunrise": F.lit(None).cast("string"), "sunset": F.lit(None).cast("string"),
        "bucket": F.call_function("div", F.col("src_id") - F.pmod("src_id", F.lit(ids)), F.lit(ids))})
    fields = {"time": "time"} | {dst: src for src, dst in P.RAW_VARIABLES.items()}
    packed = N.to_parallel_arrays(o, ["month", "bucket", *P.DIMENSION_COLUMNS], "src_id", fields,
                                  chunk_size=min(ids, RESPONSE_IDS))
    meta = F.struct(F.col("city_name").alias("name"), *P.DIMENSION_COLUMNS[1:])
    return packed.select("month", "bucket", "daily", meta.alias("_city_meta"))


def payload_documents(spark, sf_dir, ids=PAYLOAD_IDS):
    """Payload documents of a month: one for each range of ``ids`` source ids, so none holds
    more rows than that, however large the month."""
    return payload_responses(spark, sf_dir, ids).groupBy("month", "bucket").agg(
        F.collect_list(F.struct("daily", "_city_meta")).alias("data"))


SILVER_ROWS = f"{SILVER} SELECT silver.* EXCLUDE (src_id) FROM silver"


@register("raw_payload_roundtrip", SILVER_ROWS)
def q_raw_payload_roundtrip(spark, sf_dir):
    """obs -> payload documents of a month and a range of ids -> read -> flatten -> clean."""
    root = work_dir(spark, "payload")
    docs = payload_documents(spark, sf_dir)
    docs.drop("bucket").write.option("maxRecordsPerFile", 1).partitionBy("month").json(root)
    flat = N.flatten_payload(FS.city_responses(FS.read_raw(spark, root)))
    return C.clean(flat).drop("sunrise", "sunset")


@register("landed_roundtrip", SILVER_ROWS + " WHERE date >= DATE '1999-01-01'")
def q_landed_roundtrip(spark, sf_dir):
    """Two landed runs of lines; the first is landed again with other rows."""
    root, r = work_dir(spark, "landed"), payload_responses(spark, sf_dir)
    none = spark.createDataFrame([], FS.FAILED)
    for day, rows in ((1, r.where("month < '1999-01'")), (2, r.where("month >= '2000-01'")),
                      (1, r.where("month >= '1999-01' and month < '2000-01'"))):
        out = FS.land_raw(rows.drop("month", "bucket"), none, root, dt.date(2001, 8, day), LOAD_TS1)
    return C.clean(N.flatten_payload(FS.read_landed(spark, out["data"]))).drop("sunrise", "sunset")


@register("landing_header", f"""WITH req AS (SELECT COUNT(*) AS n FROM customer),
got AS (SELECT COUNT(DISTINCT o_custkey) AS n FROM orders)
SELECT DATE '2001-08-01' AS run_date, '{LOAD_TS1.isoformat()}' AS extraction_timestamp, CAST(req.n AS BIGINT) AS total_cities_requested,
  CAST(got.n AS BIGINT) AS total_cities_successful, CAST(req.n - got.n AS BIGINT) AS total_cities_failed,
  CAST(req.n - got.n AS BIGINT) AS failed_names FROM req, got
UNION ALL SELECT DATE '2001-08-02', '{LOAD_TS2.isoformat()}', CAST(got.n AS BIGINT), CAST(got.n AS BIGINT), 0, 0 FROM got""")
def q_landing_header(spark, sf_dir):
    """Two runs: the second is landed twice, the last time without failures."""
    root = work_dir(spark, "landing")
    cust = X.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("name"))
    answered = X.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    failed = J.coverage_gap(cust, answered, "c_custkey").select("name")
    ok = cust.join(answered.distinct(), "c_custkey", "left_semi").select("name")
    FS.land_raw(ok, failed, root, dt.date(2001, 8, 1), LOAD_TS1)
    FS.land_raw(ok, failed, root, dt.date(2001, 8, 2), LOAD_TS1)
    out = FS.land_raw(ok, failed.where("false"), root, dt.date(2001, 8, 2), LOAD_TS2)
    names = (FS.read_landed(spark, out["failed"], schema=FS.FAILED).groupBy(FS.RUN_DATE)
             .agg(F.count(F.lit(1)).alias("failed_names")))
    return (FS.read_landed(spark, out["header"], schema=FS.HEADER).join(names, FS.RUN_DATE, "left")
            .na.fill(0, ["failed_names"]))


@register("clean_csv_roundtrip", f"""{SILVER}
SELECT silver.* EXCLUDE (src_id, timezone, weather_description),
  CASE WHEN src_id % 5 = 0 THEN NULL ELSE timezone END AS timezone,
  CASE WHEN src_id % 7 = 0 THEN NULL ELSE weather_description END AS weather_description,
  CAST(NULL AS VARCHAR) AS sunrise, CAST(NULL AS VARCHAR) AS sunset FROM silver""")
def q_clean_csv_roundtrip(spark, sf_dir):
    """Two runs as CSV, some cells holding texts for a missing value; read back together."""
    root = work_dir(spark, "clean-csv")
    s = silver(spark, sf_dir)
    marked = s.withColumns({
        "timezone": F.when(F.col("src_id") % 5 == 0, F.lit("NA")).otherwise(F.col("timezone")),
        "weather_description": F.when(F.col("src_id") % 7 == 0, F.lit("None"))
        .otherwise(F.col("weather_description"))})
    FS.write_clean_csv(marked, root, dt.date(2001, 8, 1))  # replaced by the next two
    FS.write_clean_csv(marked.where("date < '1998-01-01'"), root, dt.date(2001, 8, 1))
    FS.write_clean_csv(marked.where("date >= '1998-01-01'"), root, dt.date(2001, 8, 2))
    return FS.read_clean_csv(spark, root)


@register("report_status_no_reports", f"""WITH {Q.OBS_CTE}
SELECT CAST(NULL AS VARCHAR) AS extraction_date, TRUE AS run_ok, CAST(COUNT(*) AS BIGINT) AS valid_rows,
  CAST(COUNT(*) AS BIGINT) AS total_rows, 100.0 AS quality_pct FROM obs""")
def q_report_status_no_reports(spark, sf_dir):
    none = FS.read_reports(spark, work_dir(spark, "no-reports"))
    return DQ.report_status(none, batch_rows(spark, sf_dir).agg(F.count(F.lit(1)).alias("n")))


@register("load_replace_overlap", f"""{SILVER},
d AS (SELECT date, city_name, 1 AS run FROM silver WHERE date < DATE '1998-06-01'
  UNION ALL SELECT date, city_name, 2 FROM silver WHERE date >= DATE '1998-01-01'),
w AS (SELECT date, city_name, max(run) AS run FROM d GROUP BY ALL)
SELECT date, city_name, strftime(CASE run WHEN 2 THEN TIMESTAMP '{LOAD_TS2}' ELSE TIMESTAMP '{LOAD_TS1}' END,
  '%Y-%m-%d %H:%M:%S') AS loaded_at, CAST(COUNT(*) AS BIGINT) AS n_rows
FROM d JOIN w USING (date, city_name, run) GROUP BY ALL""")
def q_load_replace_overlap(spark, sf_dir):
    """Two deliveries that overlap by five months, both loaded by replacement."""
    root, s = _table(spark), silver(spark, sf_dir)
    WH.load(s.where("date < '1998-06-01'"), root, "replace_partitions", LOAD_TS1, grain=GRAIN)
    WH.load(s.where("date >= '1998-01-01'"), root, "replace_partitions", LOAD_TS2, grain=GRAIN)
    return (WH.read_table(spark, root)
            .groupBy("date", "city_name", F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss").alias("loaded_at"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


def _catalog_table(spark, sf_dir):
    """The fact table, loaded, in a database of its own under the work folder."""
    base = work_dir(spark, "catalog")
    name = f"{SC.DATABASE}_{base.rsplit('-', 1)[1]}"
    WH.ensure_database(spark, name, base)
    table, root = f"{name}.{SC.FACT_TABLE}", f"{base}/{SC.FACT_TABLE}"
    for _ in range(2):  # creating what exists changes nothing
        WH.ensure_table(spark, root, grain=GRAIN, name=table)
    WH.load(silver(spark, sf_dir), root, "append", LOAD_TS1, grain=GRAIN)
    return name, WH.refresh_table(spark, table)


@register("table_catalog_load", f"""{SILVER} SELECT date, city_name, CAST(COUNT(*) AS BIGINT) AS n_rows,
  strftime(date, '%Y-%m') AS date_month FROM silver GROUP BY date, city_name""")
def q_table_catalog_load(spark, sf_dir):
    _, fact = _catalog_table(spark, sf_dir)
    return fact.groupBy("date", "city_name", "date_month").agg(F.count(F.lit(1)).alias("n_rows"))


@register("mart_tables_rebuilt", Q.city_stats_sql())
def q_mart_tables_rebuilt(spark, sf_dir):
    """Staging view and mart tables in the catalog, built twice."""
    from pluvia.plans.daily import materialise_models
    database, fact = _catalog_table(spark, sf_dir)
    for _ in range(2):
        names = materialise_models(spark, fact, database)
    return spark.table(names[-1])


@register("absent_column_default", f"""{SILVER},
l AS (SELECT * FROM {LATEST_ROWS} t WHERE temperature_max IS NOT NULL ORDER BY temperature_max DESC, city_name, src_id LIMIT 1)
SELECT city_name, 60.0 AS humidity, 0.0 AS rain FROM l""")
def q_absent_column_default(spark, sf_dir):
    """The card over rows that have neither humidity nor rain: the defaults."""
    bare = silver(spark, sf_dir).drop("humidity_mean", "precipitation_sum")
    return B.selected_card(bare, TIE).select("city_name", "humidity", "rain")


# ---------------------------------------------------------------------------
# Denser inputs for limits: more rows than k, ties inside it.
# ---------------------------------------------------------------------------

@register("top_k_whole_history", f"""{SILVER}
SELECT city_name, date, temperature_mean, src_id FROM silver
ORDER BY temperature_mean DESC NULLS LAST, city_name, src_id LIMIT 8""")
def q_top_k_whole_history(spark, sf_dir):
    return B.top_k(silver(spark, sf_dir), "temperature_mean", 8, TIE).select(
        "city_name", "date", "temperature_mean", "src_id")


@register("top_groups_share_limited", f"""{SILVER},
s AS (SELECT city_name, COALESCE(SUM(CAST(precipitation_sum AS DECIMAL(18, 1))), 0) AS t FROM silver
      WHERE date >= CAST({LATEST} - INTERVAL 365 DAY AS DATE) GROUP BY city_name),
top AS (SELECT * FROM s ORDER BY t DESC, city_name LIMIT 6)
SELECT city_name AS name, CAST(round_even(CAST(t AS DOUBLE), 0) AS DOUBLE) AS val,
  CAST(round_even(CAST(t * 100 AS DOUBLE) / CAST((SELECT max(t) FROM top) AS DOUBLE), 0) AS DOUBLE) AS pct FROM top""")
def q_top_groups_share_limited(spark, sf_dir):
    return B.top_groups_share(silver(spark, sf_dir), "city_name", days=365)


@register("latest_points_as_of", f"""{SILVER}
SELECT city_name, {Q.rd('latitude', 4)} AS lat, {Q.rd('longitude', 4)} AS lon, {Q.r1('temperature_mean')} AS temp,
  city_name || ', ' || country AS label FROM silver WHERE date = DATE '1998-06-15'""")
def q_latest_points_as_of(spark, sf_dir):
    """The map points as of a day in the middle of the history."""
    return B.latest_points(silver(spark, sf_dir), as_of=dt.date(1998, 6, 15))


# The queries over stored forms register themselves here.
from pluvia.plans import catalog_storage  # noqa: E402, F401
