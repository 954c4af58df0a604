"""Sinks and sources on temp folders: CSV, reports, fact table, landing."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvia import presets as P
from pluvia import schemas as SC
from pluvia.operators import clean as C
from pluvia.operators import quality as DQ
from pluvia.sources import files as FS
from pluvia.sources import warehouse as WH
from tests.frames import DAY, checked, observations, stations


def two_towns(spark):
    """A dry day and, a day later, a rainy one with a code of its own."""
    return observations(spark, {"precipitation_sum": None, "weather_code": 0},
                        {"date": "2030-03-11", "city_name": "Brisk", "precipitation_sum": 23.6, "weather_code": 65})


def test_clean_csv_round_trip(spark, tmp):
    out = FS.write_clean_csv(C.clean(two_towns(spark)), os.path.join(tmp, "clean"), DAY)
    back = FS.read_clean_csv(spark, out).orderBy("date").collect()
    assert [r.weather_description for r in back] == [P.WEATHER_CODES[0], P.WEATHER_CODES[65]]
    assert [r.precipitation_category for r in back] == [P.PRECIPITATION_LABELS[0], P.PRECIPITATION_LABELS[3]]


def test_csv_rerun_without_rows_leaves_none(spark, tmp):
    rows = C.clean(two_towns(spark))
    for df in (rows, rows.limit(0)):
        out = FS.write_clean_csv(df, os.path.join(tmp, "clean"), DAY)
    assert FS.read_clean_csv(spark, out).count() == 0
    assert FS.read_clean_csv(spark, os.path.join(tmp, "never")).count() == 0


@pytest.mark.parametrize("cell,value", [(t, None) for t in FS.MISSING_TEXTS] + [("Nan", "Nan"), ("x", "x")])
def test_texts_for_a_missing_value(spark, tmp, cell, value):
    with open(os.path.join(tmp, "c.csv"), "w", encoding="utf-8") as f:
        f.write(f"date,city_name\n2030-03-10,{cell}\n")
    schema = T.StructType([T.StructField("date", T.DateType()), T.StructField("city_name", T.StringType())])
    assert FS.read_clean_csv(spark, tmp, schema).first().city_name == value


@pytest.mark.parametrize("line", ["2030-03-10", "2030-03-10,a,b", "soon,a"])
def test_malformed_csv_raises(spark, tmp, line):
    with open(os.path.join(tmp, "c.csv"), "w", encoding="utf-8") as f:
        f.write(f"date,city_name\n{line}\n")
    schema = T.StructType([T.StructField("date", T.DateType()), T.StructField("city_name", T.StringType())])
    with pytest.raises(Exception):
        FS.read_clean_csv(spark, tmp, schema).collect()


def test_concat_runs_keeps_duplicates(spark):
    a = checked(spark, *stations(3))
    out = FS.concat_runs(a, a.drop("latitude"))
    assert out.count() == 6 and out.where(F.col("latitude").isNull()).count() == 3


def test_reports_write_and_read(spark, tmp):
    df = checked(spark, *stations(3))
    d = os.path.join(tmp, "quality")
    assert FS.read_reports(spark, d).count() == 0  # no report yet
    FS.write_reports(DQ.quality_report(df, "2030-03-11"), d)
    FS.write_reports(DQ.quality_report(df.union(df), "2030-03-12"), d)
    FS.write_reports(DQ.quality_report(df, "2030-03-12"), d)  # rerun replaces the day
    hist = FS.read_reports(spark, d)
    latest = FS.latest_report(hist).first()
    assert hist.count() == 2
    assert latest["extraction_date"] == "2030-03-12" and latest["overall_passed"]
    checks = DQ.checks_of_reports(FS.latest_report(hist)).collect()
    assert checks[0]["label"] == "Required Fields" and len(checks) == 7
    status = DQ.report_status(hist, df.agg(F.count(F.lit(1)).alias("n"))).first()
    assert status["run_ok"] and status["quality_pct"] == 100.0


def test_report_status_without_reports(spark):
    empty = spark.createDataFrame([], SC.REPORT)
    n = checked(spark, *stations(3)).agg(F.count(F.lit(1)).alias("n"))
    r = DQ.report_status(empty, n).first()
    assert r["run_ok"] and r["total_rows"] == 3 and r["valid_rows"] == 3


def fact_rows(spark):
    return C.clean(two_towns(spark))


def test_enforce_schema_required(spark):
    df = fact_rows(spark).withColumn("city_name", F.lit(None).cast("string"))
    with pytest.raises(Exception):
        WH.enforce_schema(df).collect()
    assert WH.enforce_schema(fact_rows(spark)).columns == SC.FACT.fieldNames()


@pytest.mark.parametrize("grain", ["day", "month", "year"])
def test_load_append_and_replace(spark, tmp, grain):
    root = os.path.join(tmp, "fact")
    ts1, ts2 = dt.datetime(2030, 3, 12, 6), dt.datetime(2030, 3, 13, 6)
    m1 = WH.load(fact_rows(spark), root, "append", ts1, grain=grain)
    assert m1["rows_loaded"] == 2 and m1["table_total_rows"] == 2
    # One town's day comes again; the other's row is kept, in the same partition or not.
    redo = fact_rows(spark).where("city_name = 'Brisk'").withColumn("temperature_max", F.lit(30.0))
    m2 = WH.load(redo, root, "replace_partitions", ts2, grain=grain)
    assert m2["rows_loaded"] == 1 and m2["table_total_rows"] == 2
    table = {r["city_name"]: r for r in WH.read_table(spark, root).collect()}
    assert table["Brisk"]["temperature_max"] == 30.0 and table["Brisk"]["loaded_at"] == ts2
    assert table["Aldora"]["loaded_at"] == ts1
    m3 = WH.load(fact_rows(spark), root, "append", ts2, grain=grain)
    assert m3["table_total_rows"] == 4  # plain append duplicates a re-delivery
    assert WH.latest_loaded_date(spark, root, grain) == dt.date(2030, 3, 11)
    assert not [f for f in os.listdir(os.path.join(root, "_staging")) if not f.startswith(".")]
    empty = WH.load(redo.limit(0), root, "replace_partitions", ts2, grain=grain)
    assert (empty["rows_loaded"], empty["table_total_rows"]) == (0, 4)


@pytest.mark.parametrize("grain", ["day", "month", "year"])
def test_replace_reads_the_batch_dates_only(spark, tmp, grain):
    root = os.path.join(tmp, "fact")
    WH.load(fact_rows(spark), root, "append", dt.datetime(2030, 3, 12), grain=grain)
    stored = WH.stored_between(spark, root, SC.FACT, grain, DAY, DAY)
    assert [r.city_name for r in stored.where(F.col("date") == DAY).collect()] == ["Aldora"]
    plan = stored._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    part = WH.partition_column(grain)
    assert f"{part}#" in filters and ">=" in filters and "<=" in filters


def test_older_version_never_wins(spark, tmp):
    root = os.path.join(tmp, "fact")
    schema = T.StructType(SC.FACT.fields + [T.StructField("run", T.IntegerType())])
    for run, value in ((5, 25.0), (3, 11.0), (5, 26.0)):
        rows = fact_rows(spark).withColumns({"temperature_max": F.lit(value), "run": F.lit(run)})
        WH.load(rows, root, "replace_partitions", dt.datetime(2030, 3, 12), schema=schema, version="run")
    got = WH.read_table(spark, root, schema).collect()
    assert {(r.temperature_max, r.run) for r in got} == {(26.0, 5)} and len(got) == 2


def test_null_key_is_refused_not_lost(spark, tmp):
    rows = fact_rows(spark).withColumn("run", F.lit(1)).withColumn(
        "city_name", F.when(F.col("city_name") == "Brisk", F.col("city_name")))
    newest = WH.latest_delivery(rows, ("city_name", "date"), "run")
    assert newest.count() == 2
    with pytest.raises(Exception):
        WH.load(newest.drop("run"), os.path.join(tmp, "fact"), "replace_partitions")


def test_cluster_session_needs_a_shared_folder(spark, monkeypatch):
    from pluvia import session

    class Context:
        master = "local-cluster[2,1,1024]"

        def getConf(self):
            return {}

    class Session:
        conf, sparkContext = {}, Context()

    with pytest.raises(ValueError):
        session.checkpoint_root(Session())


def test_landing(spark, tmp):
    names = spark.createDataFrame([("Aldora",), ("Brisk",)], "name string")
    failed = spark.createDataFrame([("Corvel",)], "name string")
    out = FS.land_raw(names, failed, tmp, DAY, dt.datetime(2030, 3, 10, 5))
    head = FS.read_landed(spark, out["header"], DAY, FS.HEADER).first()
    assert (head.total_cities_requested, head.total_cities_successful, head.total_cities_failed,
            head.extraction_timestamp) == (3, 2, 1, "2030-03-10T05:00:00")
    FS.land_raw(names.limit(1), failed.limit(0), tmp, DAY, dt.datetime(2030, 3, 10, 7))  # same-day rerun
    assert FS.read_landed(spark, out["data"], schema=FS.FAILED).count() == 1
    assert FS.read_landed(spark, out["failed"], schema=FS.FAILED).count() == 0


def test_dimension_read(spark, tmp):
    from pluvia.sources.dimension import read_dimension
    p = os.path.join(tmp, "cities.json")
    with open(p, "w", encoding="utf-8") as f:
        f.write('{"name": "Aldora", "country": "Northland", "country_code": "NL", "region": "Hills", '
                '"latitude": 51.5, "longitude": 4.25, "timezone": "UTC"}\n')
    d = read_dimension(spark, p)
    assert d.first()["country_code"] == "NL" and d.schema == SC.CITY


def test_report_tables_read_their_windows_only(spark, tmp):
    """No scan of the fact table without a partition filter, but for the two tables
    that need all dates."""
    from pluvia.plans.daily import report_tables
    root = os.path.join(tmp, "fact")
    WH.load(fact_rows(spark), root, "append", dt.datetime(2030, 3, 12))
    as_of = WH.latest_loaded_date(spark, root)
    keys = spark.createDataFrame([("Aldora",), ("Brisk",)], "city_name string")
    tables = report_tables(WH.read_table(spark, root), as_of, FS.read_reports(spark, tmp + "/none"), keys)
    for name, df in tables.items():
        if name in ("date_bounds", "report_status", "cities", "report_checks"):
            continue
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        scans = [p.split("]")[0] for p in plan.split("PartitionFilters: [")[1:]]
        assert scans and all("date#" in p for p in scans), name
