"""The daily job end to end on generated payloads."""

import datetime as dt
import os

from pluvia.plans.daily import paths, run_daily
from pluvia.sources import warehouse as WH
from tests.test_nested import write_payload


def test_two_daily_runs(spark, tmp):
    raw = write_payload(tmp, "2024/01/17")
    out = os.path.join(tmp, "out")
    m1 = run_daily(spark, os.path.join(raw, "2024/01/17/weather_raw.json"), out,
                   dt.date(2024, 1, 17), loaded_at=dt.datetime(2024, 1, 17, 6))
    assert m1["rows_loaded"] == 5 and m1["table_total_rows"] == 5
    assert m1["report"]["total_rows"] == 5
    assert m1["mart_daily_summary"] == 5 and m1["mart_city_stats"] == 3
    # The next day's run re-delivers the same days: replaced, not duplicated.
    raw2 = write_payload(tmp, "2024/01/18")
    m2 = run_daily(spark, os.path.join(raw2, "2024/01/18/weather_raw.json"), out,
                   dt.date(2024, 1, 18), loaded_at=dt.datetime(2024, 1, 18, 6))
    assert m2["table_total_rows"] == 5
    table = WH.read_table(spark, paths(out)["fact_weather"])
    assert {r["loaded_at"] for r in table.select("loaded_at").collect()} == {dt.datetime(2024, 1, 18, 6)}
    assert spark.read.json(paths(out)["quality"]).count() == 2
    # Appending instead keeps both deliveries (what a plain append does).
    m3 = run_daily(spark, os.path.join(raw2, "2024/01/18/weather_raw.json"), out,
                   dt.date(2024, 1, 18), load_mode="append")
    assert m3["table_total_rows"] == 10


def test_rerun_without_any_city_raises_and_keeps_the_table(spark, tmp):
    import json

    import pytest
    raw = os.path.join(write_payload(tmp), "2024/01/17/weather_raw.json")
    out, day = os.path.join(tmp, "out"), dt.date(2024, 1, 17)
    run_daily(spark, raw, out, day, loaded_at=dt.datetime(2024, 1, 17, 6))
    with open(raw, "w", encoding="utf-8") as f:
        json.dump({"failed_cities": ["Gone"], "data": []}, f)
    with pytest.raises(RuntimeError):
        run_daily(spark, raw, out, day, loaded_at=dt.datetime(2024, 1, 17, 9))
    kept = WH.read_table(spark, paths(out)["fact_weather"]).collect()
    assert len(kept) == 5 and {r.loaded_at for r in kept} == {dt.datetime(2024, 1, 17, 6)}


def test_report_tables(spark, tmp):
    from pluvia.plans.daily import build_report_tables
    raw = write_payload(tmp, "2024/01/17")
    out = os.path.join(tmp, "out")
    run_daily(spark, os.path.join(raw, "2024/01/17/weather_raw.json"), out, dt.date(2024, 1, 17))
    p = paths(out)
    sizes = build_report_tables(spark, p["fact_weather"], p["quality"], os.path.join(tmp, "tables"),
                                stats_dir=p["mart_city_stats"])
    assert sizes["cities"] == 3 and sizes["headline_kpis"] == 1
    assert sizes["report_status"] == 1 and sizes["report_checks"] == 7
    assert sizes["top_cities"] == 2  # the latest date (2024-01-16) has two cities
    assert sizes["period_table"] >= 1 and sizes["conditions"] == 1
    status = spark.read.parquet(os.path.join(tmp, "tables", "report_status")).first()
    assert status["total_rows"] == 5


def test_trend_keeps_eight_rows_of_an_entity_with_missing_days(spark):
    """A row every other day, one with a gap of a year, one with few rows at all."""
    from pluvia.operators import dashboard as B
    as_of = dt.date(2024, 3, 1)
    days = {"Every other": [as_of - dt.timedelta(days=2 * i) for i in range(40)],
            "Gap": [as_of] + [as_of - dt.timedelta(days=365 + i) for i in range(30)],
            "Few": [as_of, as_of - dt.timedelta(days=9)]}
    rows = [(c, d, 20.0 + i) for c, ds in days.items() for i, d in enumerate(ds)]
    df = spark.createDataFrame(rows, "city_name string, date date, temperature_max double")
    for city, ds in days.items():
        since = B.since_of_last(df, "city_name", city, 8, as_of)
        assert sum(d >= since for d in ds) >= min(8, len(ds))


def test_report_trend_with_gaps(spark, tmp):
    from pluvia.plans.daily import build_report_tables
    as_of = dt.date(2024, 3, 1)
    rows = [("A", as_of - dt.timedelta(days=2 * i), 30.0 + i) for i in range(20)] + [("B", as_of, 1.0)]
    df = spark.createDataFrame(rows, "city_name string, date date, temperature_max double")
    root = os.path.join(tmp, "fact")
    m = WH.load(df, root, "append", loaded_at=dt.datetime(2024, 3, 1))
    assert m["rows_loaded"] == m["table_total_rows"] == 21
    sizes = build_report_tables(spark, root, os.path.join(tmp, "none"), os.path.join(tmp, "tables"))
    assert sizes["trend"] == 8
    trend = spark.read.parquet(os.path.join(tmp, "tables", "trend")).orderBy("date").collect()
    assert [r.date for r in trend] == [as_of - dt.timedelta(days=2 * i) for i in range(7, -1, -1)]


def test_append_evaluates_its_batch_once(spark, tmp):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.createDataFrame([("A", dt.date(2024, 1, i), 1.0) for i in range(1, 21)],
                               "city_name string, date date, temperature_max double")
    WH.load(df.mapInArrow(count, df.schema), os.path.join(tmp, "once"), "append")
    assert seen.value == 20


def test_a_large_document_lands_the_same_rows(spark, tmp):
    from pluvia.plans.daily import land_run
    raw = os.path.join(write_payload(tmp), "2024/01/17/weather_raw.json")
    day = dt.date(2024, 1, 17)
    whole = land_run(spark, raw, os.path.join(tmp, "a"), day)
    split = land_run(spark, raw, os.path.join(tmp, "b"), day, split_from=100)
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, split.collect()))
    names = [sorted(r.name for r in spark.read.json(os.path.join(tmp, x, "failed")).collect()) for x in "ab"]
    assert names[0] == names[1] == ["Gone"]


def test_daily_runs_with_incremental_marts(spark, tmp):
    import pytest
    out, rebuilt = os.path.join(tmp, "out"), os.path.join(tmp, "rebuilt")
    for day in (17, 18):
        raw = os.path.join(write_payload(tmp, f"2024/01/{day}"), f"2024/01/{day}/weather_raw.json")
        m = run_daily(spark, raw, out, dt.date(2024, 1, day), loaded_at=dt.datetime(2024, 1, day, 6), marts="incremental")
        run_daily(spark, raw, rebuilt, dt.date(2024, 1, day), loaded_at=dt.datetime(2024, 1, day, 6))
        assert m["mart_daily_summary"] == 5 and m["mart_city_stats"] == 3
    a, b = (spark.read.parquet(paths(x)["mart_city_stats"]) for x in (out, rebuilt))
    assert sorted(map(repr, a.select(*b.columns).collect())) == sorted(map(repr, b.collect()))
    with pytest.raises(ValueError):
        run_daily(spark, raw, out, dt.date(2024, 1, 18), marts="other")
