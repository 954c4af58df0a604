"""The daily batch job end to end, and the mart rebuild.

``run_daily``: raw payload -> landed lines (a large document is read by several tasks;
all later steps split) -> flattened rows kept as Parquet -> quality report -> clean rows
(CSV as an export) -> fact table load -> marts rebuilt.  Every step is a Spark job over the
whole batch; nothing is collected.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvia import schemas as SC
from pluvia.operators import marts as M
from pluvia.operators.clean import clean
from pluvia.operators.flatten import flatten_payload
from pluvia.operators.quality import quality_report
from pluvia.sources import files as FS
from pluvia.sources import payload as PL
from pluvia.sources import warehouse as WH


def paths(out_root: str) -> dict[str, str]:
    names = ("landed", "flat", "quality", "clean", "fact_weather", "mart_daily_summary",
             "mart_city_stats", "marts")
    return {n: os.path.join(out_root, n) for n in names}


def land_run(spark: SparkSession, raw_path: str, landed_dir: str, run_date: dt.date,
             extracted_at: dt.datetime | None = None, split_from: int = PL.RANGE_BYTES) -> DataFrame:
    """Land one run's payload and return its responses as splittable lines.

    A document of over ``split_from`` bytes is read by several tasks, with the same rows.
    A run in which no entity answered raises.
    """
    if FS.size_of(spark, raw_path) > split_from:
        responses = PL.read_responses(spark, raw_path, range_bytes=split_from)
        header = PL.read_headers(spark, raw_path, range_bytes=split_from)
    else:
        header = FS.read_raw(spark, raw_path)
        responses = FS.city_responses(header)
    failed = header.select(F.explode("failed_cities").alias("name"))
    out = FS.land_raw(responses, failed, landed_dir, run_date,
                      extracted_at or dt.datetime.combine(run_date, dt.time()))
    ok = FS.read_landed(spark, out["header"], run_date, FS.HEADER).first()["total_cities_successful"]
    if not ok:
        raise RuntimeError(f"no entity answered in the run of {run_date}")
    return FS.read_landed(spark, out["data"], run_date).drop(FS.RUN_DATE)


def land_flat(responses: DataFrame, flat_dir: str, run_date: dt.date) -> DataFrame:
    """Flatten one run's responses and keep them as Parquet in the run's folder."""
    path = FS.run_folder(flat_dir, run_date)
    flat = flatten_payload(responses)
    flat.write.mode("overwrite").parquet(path)
    return responses.sparkSession.read.schema(flat.schema).parquet(path)


def build_marts(spark: SparkSession, fact_root: str, daily_dir: str, stats_dir: str,
                window_days: int | None = None, as_of=None) -> dict[str, int]:
    """Rebuild both mart tables from the fact table (overwrite each run)."""
    daily = M.daily_summary(M.staging(WH.read_table(spark, fact_root)))
    daily.write.mode("overwrite").parquet(daily_dir)
    stats = M.city_stats(spark.read.parquet(daily_dir), window_days=window_days, as_of=as_of)
    stats.write.mode("overwrite").parquet(stats_dir)
    return {"mart_daily_summary": spark.read.parquet(daily_dir).count(),
            "mart_city_stats": spark.read.parquet(stats_dir).count()}


def run_daily(spark: SparkSession, raw_path: str, out_root: str, run_date: dt.date,
              load_mode: str = "replace_partitions", grain: str = "day",
              loaded_at: dt.datetime | None = None, marts: str = "rebuild") -> dict:
    """One daily run; returns the load metrics, report status and mart sizes.

    ``marts="incremental"`` rewrites only the marts' partitions that the run touched (and
    those a lost run left stale) and merges the statistics from stored measures, instead
    of reading the whole fact table again; the daily mart then lies, partitioned like the
    facts, in ``paths(out_root)["marts"]``.

    ``run_date`` is the run's date (report name, future-date check).  The
    validation does not gate the load, as in the source job: a failing
    report is written and the run goes on.
    """
    p = paths(out_root)
    rows = land_flat(land_run(spark, raw_path, p["landed"], run_date, loaded_at), p["flat"], run_date)
    report = quality_report(rows, run_date)
    FS.write_reports(report, p["quality"])
    status = FS.read_reports(spark, p["quality"]).where(
        F.col("extraction_date") == run_date.isoformat()).select(
        "total_rows", "valid_rows", "overall_passed").first()
    silver = clean(rows)
    FS.write_clean_csv(silver, p["clean"], run_date)
    metrics = WH.load(silver, p["fact_weather"], load_mode, loaded_at=loaded_at, grain=grain)
    if marts == "incremental":
        sizes = follow_marts(spark, p, metrics["partitions"], grain)
    elif marts == "rebuild":
        sizes = build_marts(spark, p["fact_weather"], p["mart_daily_summary"], p["mart_city_stats"])
    else:
        raise ValueError(f"unknown way to build the marts: {marts!r}")
    return {**metrics, "report": status.asDict(), **sizes}


def follow_marts(spark: SparkSession, p: dict[str, str], partitions: list[str], grain: str) -> dict[str, int]:
    """Refresh the marts' touched and stale partitions; the statistics from the measures."""
    from pluvia.plans import incremental as I

    stale = I.stale_partitions(spark, p["fact_weather"], p["marts"], grain)
    I.refresh(spark, p["fact_weather"], p["marts"], sorted({*partitions, *stale}), grain)
    I.city_stats(spark, p["marts"]).write.mode("overwrite").parquet(p["mart_city_stats"])
    daily = spark.read.parquet(I.mart_paths(p["marts"])["daily_summary"])
    return {"mart_daily_summary": daily.count(), "mart_city_stats": spark.read.parquet(p["mart_city_stats"]).count()}


def materialise_models(spark: SparkSession, fact: DataFrame, database: str,
                       window_days: int | None = None, as_of=None) -> list[str]:
    """The models in the catalog: staging as a view, the marts as tables rebuilt whole."""
    M.staging(fact).createOrReplaceTempView("stg_weather")
    daily, stats = f"{database}.mart_daily_summary", f"{database}.mart_city_stats"
    M.daily_summary(spark.table("stg_weather")).write.mode("overwrite").saveAsTable(daily)
    M.city_stats(spark.table(daily), window_days=window_days, as_of=as_of) \
        .write.mode("overwrite").saveAsTable(stats)
    return ["stg_weather", daily, stats]


def report_tables(rows: DataFrame, as_of: dt.date | None, history: DataFrame,
                  keys: DataFrame | None = None, preferred_key: str | None = "Lima",
                  top_n: int = 8, top_groups: int = 6) -> dict[str, DataFrame]:
    """Every reporting result table (B1-B16) as of one date.

    All but the date bounds, the city list (both from ``keys`` where given) and the
    status counts read only the partitions of their window.
    """
    from pluvia import presets as P
    from pluvia.operators import dashboard as B
    from pluvia.operators import quality as DQ

    period = B.default_period(rows, preferred=preferred_key, as_of=as_of, keys=keys)
    since = None
    if as_of is not None:
        hot = B.arg_max_row(B.latest_slice(rows, as_of=as_of), "temperature_max").select(B.CITY).first()
        since = B.since_of_last(rows, B.CITY, hot[0], 8, as_of) if hot else as_of
    return {
        "headline_kpis": B.headline_kpis(rows, as_of=as_of),
        "hottest_card": B.selected_card(rows, as_of=as_of),
        "coldest": B.arg_max_row(B.latest_slice(rows, as_of=as_of), "temperature_min", largest=False)
                    .select("city_name", "country", "temperature_min"),
        "top_cities": B.top_cities(rows, top_n, as_of=as_of),
        "trend": B.trend_of_top_key(rows, 8, as_of=as_of, since=since),
        "latest_points": B.latest_points(rows, as_of=as_of),
        "top_groups_share": B.top_groups_share(rows, k=top_groups, as_of=as_of),
        "latest_min_max": B.latest_min_max(rows, as_of=as_of),
        "country_means": B.group_mean_remap(rows, "country_code", "temperature_mean",
                                            P.ISO2_TO_ISO3, as_of=as_of),
        "cities": B.distinct_sorted(rows if keys is None else keys),
        "date_bounds": B.date_bounds(rows.select("date")),
        "period_series": period.select("date", "city_name", "temperature_max", "temperature_min",
                                       "temperature_mean", "precipitation_sum", "wind_speed_max"),
        "period_kpis": B.period_kpis(period),
        "conditions": B.last_row_gauges(period),
        "period_table": B.sorted_period(period),
        "report_status": DQ.report_status(history, rows.agg(F.count(F.lit(1)).alias("n"))),
        "report_checks": DQ.checks_of_reports(FS.latest_report(history)),
    }


def build_report_tables(spark: SparkSession, fact_root: str, reports_dir: str, out_dir: str,
                        preferred_key: str | None = "Lima", top_n: int = 8, top_groups: int = 6,
                        grain: str = "day", stats_dir: str | None = None) -> dict[str, int]:
    """Every reporting result table (B1-B16), written under ``out_dir``.

    The latest date is read once, from the table's folders, and given to every table as a
    literal that prunes the scan.  ``stats_dir``: the per-entity mart, from which the
    city list and the selected city come; without it the facts are read for them.
    No report folder yet counts as no report.
    """
    as_of = WH.latest_loaded_date(spark, fact_root, grain)
    full = SC.FACT if grain == "day" else T.StructType(
        SC.FACT.fields + [T.StructField(WH.partition_column(grain), T.StringType())])
    rows = spark.read.schema(full).parquet(fact_root)
    keys = spark.read.parquet(stats_dir).select("city_name") if stats_dir else None
    tables = report_tables(rows, as_of, FS.read_reports(spark, reports_dir), keys, preferred_key,
                           top_n, top_groups)
    sizes = {}
    for name, df in tables.items():
        path = os.path.join(out_dir, name)
        df.write.mode("overwrite").parquet(path)
        sizes[name] = spark.read.parquet(path).count()
    return sizes
