"""Declared models: order, failures, building, and marts refreshed by partition."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from pluvia.operators import marts as M
from pluvia.plans import catalog as K
from pluvia.plans import incremental as I
from pluvia.plans.models import Model, ModelGraph, daily_models, staging_sql
from pluvia.sources import warehouse as WH

SF = "/root/testdata/sf0.001"


def test_order_follows_the_references():
    assert daily_models().order(["fact_weather"]) == ["stg_weather", "mart_daily_summary", "mart_city_stats"]
    assert daily_models().order(["fact_weather"], ["stg_weather"]) == ["stg_weather"]
    assert daily_models().downstream(["fact_weather"]) == {"stg_weather", "mart_daily_summary", "mart_city_stats"}
    assert daily_models().downstream(["mart_daily_summary"]) == {"mart_city_stats"}


@pytest.mark.parametrize("models,message", [
    ([Model("a", sql="SELECT * FROM {b}"), Model("b", sql="SELECT * FROM {a}")], "read each other"),
    ([Model("a", sql="SELECT * FROM {a}")], "read each other"),
    ([Model("a", sql="SELECT * FROM {nowhere}")], "nowhere"),
])
def test_cycles_and_missing_sources_raise(models, message):
    with pytest.raises(ValueError, match=message):
        ModelGraph(models).order(["fact"])


def test_ill_declared_models_raise():
    for bad in ([Model("a")], [Model("a", sql="x", build=lambda: None)], [Model("a", build=lambda: None, kind="view")],
                [Model("a", sql="x"), Model("a", sql="y")]):
        with pytest.raises(ValueError):
            ModelGraph(bad)
    with pytest.raises(ValueError, match="no model"):
        daily_models().order(["fact_weather"], ["other"])


def test_built_in_the_catalog(spark):
    database, fact = K._catalog_table(spark, SF)
    sources = {"fact_weather": f"{database}.fact_weather"}
    for _ in range(2):
        built = daily_models().run(spark, database, sources)
    assert built == [f"{database}.{n}" for n in ("stg_weather", "mart_daily_summary", "mart_city_stats")]
    # The view is the catalog's, not the session's, and equals the DataFrame model.
    view = spark.newSession().table(built[0])
    want = M.staging(fact)
    assert view.columns == want.columns and view.exceptAll(want).isEmpty() and want.exceptAll(view).isEmpty()
    assert "coalesce(`precipitation_sum`, 0.0D)" in staging_sql()


def rebuilt(spark, fact):
    return M.city_stats(M.daily_summary(M.staging(WH.read_table(spark, fact))))


def same(a, b):
    assert sorted(map(repr, a.select(*b.columns).collect())) == sorted(map(repr, b.collect()))


def test_incremental_marts_equal_a_rebuild_after_every_load(spark, tmp):
    s, ts = K.silver(spark, SF), dt.datetime(2024, 1, 1)
    fact, marts = os.path.join(tmp, "fact"), os.path.join(tmp, "marts")
    loads = [("append", s.where("date < '1997-01-01'")), ("append", s.where("date between '1996-06-01' and '1997-02-01'")),
             ("replace_partitions", s.where("date between '1996-06-10' and '1998-01-01'").withColumn(
                 "weather_description", F.lit("replaced"))), ("append", s.where("false"))]
    for i, (mode, rows) in enumerate(loads):
        done = I.load_and_refresh(rows, fact, marts, mode, "month", loaded_at=ts + dt.timedelta(days=i))
        same(I.city_stats(spark, marts), rebuilt(spark, fact))
        assert I.stale_partitions(spark, fact, marts, "month") == []
        daily = spark.read.parquet(I.mart_paths(marts)["daily_summary"])
        assert daily.count() == WH.read_table(spark, fact).count()
    assert done["partitions"] == []
    # A period of partitions.
    some = M.city_stats(M.daily_summary(M.staging(WH.read_table(spark, fact).where("date >= '1997-05-01'"))))
    same(I.city_stats(spark, marts, since="1997-05", grain="month"), some)


def test_a_lost_refresh_is_found_and_made_good(spark, tmp):
    s = K.silver(spark, SF).where("date < '1995-06-01'")
    fact, marts = os.path.join(tmp, "fact"), os.path.join(tmp, "marts")
    WH.load(s.where("date < '1995-03-01'"), fact, "append", dt.datetime(2024, 1, 1), grain="month")
    assert I.stale_partitions(spark, fact, marts, "month") == ["1995-01", "1995-02"]
    I.refresh(spark, fact, marts, ["1995-01", "1995-02"], "month")
    WH.load(s, fact, "replace_partitions", dt.datetime(2024, 1, 2), grain="month")
    stale = I.stale_partitions(spark, fact, marts, "month")
    assert stale == [f"1995-0{m}" for m in range(1, 6)]
    I.refresh(spark, fact, marts, stale, "month")
    same(I.city_stats(spark, marts), rebuilt(spark, fact))


def test_only_touched_partitions_are_read_and_written(spark, tmp):
    s, fact, marts = K.silver(spark, SF), os.path.join(tmp, "fact"), os.path.join(tmp, "marts")
    I.load_and_refresh(s.where("date < '1996-01-01'"), fact, marts, "append", "month")
    path = I.mart_paths(marts)["stats_partials"]
    before = {f: os.path.getmtime(os.path.join(path, f)) for f in os.listdir(path) if f.startswith("date_month")}
    I.load_and_refresh(s.where("date between '1995-12-01' and '1996-01-31'"), fact, marts, "replace_partitions", "month")
    files = lambda f: os.path.getmtime(os.path.join(path, f))
    assert {f for f in before if files(f) != before[f]} == {"date_month=1995-12"}
    assert os.path.exists(os.path.join(path, "date_month=1996-01"))
    facts = I._facts(spark, fact, "month", I.SC.FACT).where(I._within("date_month", ["1995-12"], "month"))
    assert all("1995-12" in f for f in facts.inputFiles()) or "PartitionFilters: [" in (
        facts._jdf.queryExecution().executedPlan().toString())
    scan = facts._jdf.queryExecution().executedPlan().toString()
    assert "1995-12" in scan.split("PartitionFilters: [")[1].split("]")[0]


def test_day_grain_and_a_partition_that_loses_all_its_rows(spark, tmp):
    fact, marts = os.path.join(tmp, "fact"), os.path.join(tmp, "marts")
    rows = [("A", dt.date(2024, 1, d), 1.0 * d, "rain") for d in range(1, 6)]
    df = spark.createDataFrame(rows, "city_name string, date date, temperature_mean double, weather_description string")
    I.load_and_refresh(df, fact, marts, "append")
    assert I.city_stats(spark, marts).first().total_days == 5
    import shutil
    shutil.rmtree(os.path.join(fact, "date=2024-01-03"))
    assert I.stale_partitions(spark, fact, marts) == ["2024-01-03"]
    I.refresh(spark, fact, marts, ["2024-01-03"])
    assert I.city_stats(spark, marts).first().total_days == 4
