"""Registered queries over stored forms: split payloads, incremental marts, model graph,
prefix tables, open fields.  Same rules as in :mod:`pluvia.plans.catalog`."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from pluvia import presets as P
from pluvia import schemas as SC
from pluvia.operators import aggregates as A
from pluvia.operators import clean as C
from pluvia.operators import dashboard as B
from pluvia.operators import flatten as N
from pluvia.operators import joins as J
from pluvia.operators import ranges as R
from pluvia.plans import catalog as K
from pluvia.plans import fixtures as X
from pluvia.plans import incremental as I
from pluvia.plans import sqlparts as Q
from pluvia.plans.catalog import register
from pluvia.session import work_dir
from pluvia.sources import files as FS
from pluvia.sources import layouts as LY
from pluvia.sources import open_fields as OF
from pluvia.sources import payload as PL
from pluvia.sources import warehouse as WH
from pluvia.sources.dimension import read_dimension
from pluvia.streaming import dedupe as D

# Bytes of a range of a document, small enough that test documents have several; a task reads
# ranges of several documents, and a document is read by several tasks.
SPLIT_BYTES = 128 << 10


@register("raw_payload_split", K.SILVER_ROWS)
def q_raw_payload_split(spark, sf_dir):
    """obs -> payload documents, several in a month's folder -> each read by several tasks
    -> flatten -> clean."""
    root = work_dir(spark, "payload-split")
    docs = K.payload_documents(spark, sf_dir).drop("bucket")
    docs.write.option("maxRecordsPerFile", 1).partitionBy("month").json(root)
    most = FS.size_of(spark, root) // (4 * spark.sparkContext.defaultParallelism)
    rows = PL.read_responses(spark, root, range_bytes=SPLIT_BYTES, task_bytes=min(most, PL.RANGE_BYTES))
    return C.clean(N.flatten_payload(rows)).drop("sunrise", "sunset")


DIMENSION_SQL = ("SELECT n_name AS name, r_name AS country, upper(substr(r_name, 1, 2)) AS country_code, "
                 "CASE WHEN n_nationkey % 2 = 0 THEN 'even' ELSE 'odd' END AS region, "
                 "CAST(n_nationkey * 3 - 40 AS DOUBLE) AS latitude, CAST(-30 - n_nationkey * 3 AS DOUBLE) AS longitude, "
                 "'Etc/UTC' AS timezone FROM nation JOIN region ON n_regionkey = r_regionkey")


@register("dimension_formats", f"WITH d AS ({DIMENSION_SQL}) SELECT fmt, d.* FROM d, "
          "(SELECT unnest(['csv', 'json', 'parquet']) AS fmt) f")
def q_dimension_formats(spark, sf_dir):
    """The entity list written in each format and read with its fixed schema."""
    root, out = work_dir(spark, "dimension"), None
    d = X.nation_region(spark, sf_dir)
    even = F.when(F.col("n_nationkey") % 2 == 0, "even").otherwise("odd")
    cities = d.select(F.col("n_name").alias("name"), F.col("r_name").alias("country"),
                      F.upper(F.substring("r_name", 1, 2)).alias("country_code"), even.alias("region"),
                      (F.col("n_nationkey") * 3 - 40).cast("double").alias("latitude"),
                      (-30 - F.col("n_nationkey") * 3).cast("double").alias("longitude"), F.lit("Etc/UTC").alias("timezone"))
    for fmt in ("csv", "json", "parquet"):
        writer = cities.write.option("header", True) if fmt == "csv" else cities.write
        writer.format(fmt).save(os.path.join(root, fmt))
        got = read_dimension(spark, os.path.join(root, fmt), fmt).select(F.lit(fmt).alias("fmt"), "*")
        out = got if out is None else out.unionByName(got)
    return out


@register("raw_run_dates", f"{K.SILVER} SELECT make_date(year(date), 12, 31) AS run_date, city_name, date, "
          "CAST(COUNT(*) AS BIGINT) AS n_rows FROM silver GROUP BY ALL")
def q_raw_run_dates(spark, sf_dir):
    """Payloads in the run folder of their year's last day; every run is found by its date
    and read with the date of its folder."""
    root = work_dir(spark, "raw-runs")
    docs = FS.stage(K.payload_documents(spark, sf_dir).withColumn("year", F.substring("month", 1, 4)), root, ("year",))[0]
    days = [dt.date(int(r[0]), 12, 31) for r in docs.select("year").distinct().collect()]
    for day in days:
        (docs.where(F.col("year") == str(day.year)).select("data").write.option("maxRecordsPerFile", 1)
         .json(os.path.join(root, day.strftime("%Y/%m/%d"))))
    paths = [FS.run_partition_path(spark, root, day, file_name="") for day in days]
    raw = FS.read_raw(spark, paths, run_date=True)
    flat = N.flatten_payload(FS.city_responses(raw, keep=(FS.RUN_DATE,)), keep=(FS.RUN_DATE,))
    return (flat.groupBy(FS.RUN_DATE, "city_name", F.to_date("date").alias("date"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


@register("mart_incremental", Q.city_stats_sql())
def q_mart_incremental(spark, sf_dir):
    """Three overlapping loads, the marts refreshed for their partitions only: old values
    of five months are replaced, and a month is delivered again."""
    base, s = work_dir(spark, "incremental"), K.silver(spark, sf_dir)
    fact, marts = os.path.join(base, "fact"), os.path.join(base, "marts")
    first = s.where("date < '1998-06-01'").withColumn("temperature_mean", F.when(
        F.col("date") >= "1998-01-01", F.col("temperature_mean") + 5).otherwise(F.col("temperature_mean")))
    I.load_and_refresh(first, fact, marts, "append", K.GRAIN, loaded_at=K.LOAD_TS1)
    for rows, ts in ((s.where("date >= '1998-01-01'"), K.LOAD_TS2),
                     (s.where("date >= '1996-03-01' and date < '1996-04-01'"), K.LOAD_TS2)):
        I.load_and_refresh(rows, fact, marts, "replace_partitions", K.GRAIN, loaded_at=ts)
    return I.city_stats(spark, marts)


@register("models_from_graph", Q.city_stats_sql())
def q_models_from_graph(spark, sf_dir):
    """M1 -> M2 -> M3 in the order of the declared graph, in the catalog."""
    from pluvia.plans.models import daily_models
    database, fact = K._catalog_table(spark, sf_dir)
    return spark.table(daily_models().run(spark, database, {"fact_weather": f"{database}.{SC.FACT_TABLE}"})[-1])


PERIODS_SQL = """SELECT c_custkey AS period_id, n_name AS city_name,
  CAST(DATE '1994-12-01' + CAST((c_custkey * 37) % 2400 AS INTEGER) AS DATE) AS "start",
  CAST(DATE '1994-12-01' + CAST((c_custkey * 37) % 2400 + (c_custkey * 13) % 900 - 5 AS INTEGER) AS DATE) AS "end"
FROM customer JOIN nation ON c_nationkey = n_nationkey"""


@register("period_kpis_ranges", f"""{K.SILVER}, q AS ({PERIODS_SQL})
SELECT period_id, {Q.r1('max(temperature_max)')} AS max_temperature, {Q.r1('min(temperature_min)')} AS min_temperature,
  CAST({Q.half_even(f"COALESCE(SUM({Q.tenths('precipitation_sum')}), 0)", '10')} AS DOUBLE) AS total_precipitation,
  CAST(COUNT(*) FILTER (WHERE precipitation_sum > 0) AS BIGINT) AS rainy_days,
  CAST({Q.half_even(f"SUM({Q.tenths('humidity_mean')})", 'NULLIF(COUNT(humidity_mean), 0) * 10')} AS DOUBLE) AS avg_humidity,
  {Q.r1('max(uv_index_max)')} AS max_uv
FROM q LEFT JOIN silver s ON s.city_name = q.city_name AND s.date BETWEEN q."start" AND q."end" GROUP BY period_id""")
def q_period_kpis_ranges(spark, sf_dir):
    """One period a customer, of up to 900 days (some empty), from the stored prefix table."""
    path = os.path.join(work_dir(spark, "prefix"), "table")
    R.prefix_table(K.silver(spark, sf_dir)).write.parquet(path)
    day = F.lit("1994-12-01").cast("date")
    begin = (F.col("c_custkey") * 37 % 2400).cast("int")
    length = (F.col("c_custkey") * 13 % 900 - 5).cast("int")
    periods = (X.table(spark, sf_dir, "customer").join(X.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
               .select(F.col("c_custkey").alias("period_id"), F.col("n_name").alias("city_name"),
                       F.date_add(day, begin).alias("start"), F.date_add(day, begin + length).alias("end")))
    return R.period_kpis_of(spark.read.parquet(path), periods)


@register("open_fields_roundtrip", """SELECT event_id, event_type,
  TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS missing FROM events""")
def q_open_fields_roundtrip(spark, sf_dir):
    """Events kept with their properties as VARIANT; a field outside the fixed columns is
    extracted after a round trip through a table."""
    path = os.path.join(work_dir(spark, "open-fields"), "events")
    e = X.table(spark, sf_dir, "events").select("event_id", "event_type", "props")
    OF.with_record(e, "props").drop("props").write.parquet(path)
    return spark.read.parquet(path).select("event_id", "event_type", *OF.fields(
        {"k": ("$.k", "bigint"), "missing": ("$.no.such", "string")}))


@register("open_fields_unknown", """SELECT 'k' AS field, 'BIGINT' AS kind, CAST(COUNT(*) AS BIGINT) AS n
FROM events WHERE json_extract(props, '$.k') IS NOT NULL HAVING COUNT(*) > 0""")
def q_open_fields_unknown(spark, sf_dir):
    """The fields of the events' properties that no schema names."""
    e = X.table(spark, sf_dir, "events").select("event_id", "props")
    return OF.unknown_fields(OF.with_record(e, "props"), ())


@register("coverage_gap_bucketed", K.ORACLE["coverage_gap"])
def q_coverage_gap_bucketed(spark, sf_dir):
    """The coverage gap between two tables in buckets of the entity."""
    requested, answered = bucketed_tables(spark, sf_dir)
    return J.coverage_gap(requested, answered, "c_custkey").select("c_custkey", "c_name")


def _database(spark, kind):
    """A database of the query's own, under the work folder."""
    base = work_dir(spark, kind)
    name = f"{kind}_{base.rsplit('-', 1)[1]}"
    WH.ensure_database(spark, name, base)
    return name


def bucketed_tables(spark, sf_dir, buckets=8):
    name = _database(spark, "buckets")
    got = B.window_days_back(X.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.to_date("o_orderdate").alias("date")), K.AS_OF)
    return (LY.save_bucketed(X.table(spark, sf_dir, "customer"), f"{name}.requested", ["c_custkey"], buckets),
            LY.save_bucketed(got, f"{name}.answered", ["c_custkey"], buckets))


@register("replace_bucketed", """SELECT o_orderkey, o_custkey,
  CASE WHEN o_custkey % 3 = 0 THEN 'replaced' ELSE o_orderstatus END AS o_orderstatus FROM orders""")
def q_replace_bucketed(spark, sf_dir):
    """Orders in buckets, those of a third of the customers delivered again."""
    name = f"{_database(spark, 'replaced')}.orders"
    orders, key = X.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), ["o_custkey", "o_orderkey"]
    LY.save_bucketed(orders, name, key, 8)
    again = orders.where("o_custkey % 3 = 0").withColumn("o_orderstatus", F.lit("replaced"))
    return LY.replace_bucketed(spark, name, again, key, 8)


@register("look_up_range", """WITH one AS (SELECT o_custkey FROM orders GROUP BY o_custkey ORDER BY count(*) DESC, o_custkey LIMIT 1)
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders
WHERE o_custkey = (SELECT o_custkey FROM one) AND o_orderdate BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'""")
def q_look_up_range(spark, sf_dir):
    """The orders of the busiest customer in two years, from a table in Z order."""
    path = os.path.join(work_dir(spark, "look-up"), "orders")
    orders = X.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("date"))
    LY.write_for_look_ups(orders, path, "o_custkey", "date")
    busiest = orders.groupBy("o_custkey").count().orderBy(F.desc("count"), "o_custkey").first()
    return LY.look_up(spark.read.parquet(path), "o_custkey", busiest["o_custkey"], "date", dt.date(1996, 1, 1),
                      dt.date(1997, 12, 31)).select("o_orderkey", "date")


WINDOWS = (1, 30, 365)


@register("distinct_in_windows", f"""WITH o AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS date FROM orders), w AS (SELECT unnest({list(WINDOWS)}) AS days)
SELECT CAST(days AS INTEGER) AS days, CAST(COUNT(DISTINCT o_custkey) AS BIGINT) AS n, TRUE AS estimate_within_error FROM w
LEFT JOIN o ON date > CAST(DATE '{K.AS_OF}' - days AS DATE) AND date <= DATE '{K.AS_OF}' GROUP BY days""")
def q_distinct_in_windows(spark, sf_dir):
    """Exact distinct customers of three windows, and whether the estimate from the stored
    day sketches lies within four standard errors (and one) of it."""
    path = os.path.join(work_dir(spark, "sketches"), "days")
    orders = X.table(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("date"))
    A.daily_sketches(orders, "o_custkey").write.parquet(path)
    estimate = A.distinct_in_windows(spark.read.parquet(path), K.AS_OF, WINDOWS)
    exact = A.exact_in_windows(orders, "o_custkey", K.AS_OF, WINDOWS)
    near = F.abs(F.col("estimate") - F.col("n")) <= F.col("n") * (4 * A.relative_error()) + 1
    return exact.join(estimate, "days").select("days", "n", near.alias("estimate_within_error"))


@register("duplicate_members", f"""WITH {Q.OBS_CTE} SELECT src_id, city_name, date FROM obs
QUALIFY COUNT(*) OVER (PARTITION BY city_name, date) > 1""")
def q_duplicate_members(spark, sf_dir):
    """The observations that share their city and date with another one."""
    return A.duplicate_members(X.obs(spark, sf_dir), P.KEY).select("src_id", "city_name", "date")


@register("stream_first_deliveries", "SELECT event_id, user_id, event_type FROM events")
def q_stream_first_deliveries(spark, sf_dir):
    """Events delivered in two runs, the second with the first one's last days again; the
    stream is started after each run and keeps every event once."""
    root = work_dir(spark, "deliveries")
    e = X.table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type").withColumn(
        "ts", F.col("ts").cast("timestamp"))
    first, last = e.agg(F.min("ts"), F.max("ts")).first()
    middle = first + (last - first) / 2
    for i, rows in enumerate((e.where(F.col("ts") <= F.lit(middle)), e.where(F.col("ts") > F.lit(middle - dt.timedelta(days=5))))):
        rows.write.parquet(os.path.join(root, "in", f"run={i}"))
        D.start_dedupe(spark, os.path.join(root, "in"), e.schema, os.path.join(root, "out"), os.path.join(root, "state"),
                       ["event_id"], "ts", f"{(last - first).days + 2} days").awaitTermination()
    return spark.read.schema(e.schema).parquet(os.path.join(root, "out")).drop("ts")
