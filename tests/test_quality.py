"""Quality checks: a table of cases around every bound, and the report."""

import copy
import datetime as dt

import pytest
from pyspark.sql import functions as F

from pluvia import presets as P
from pluvia.operators import quality as DQ
from tests.frames import CHECKED, DAY, checked, stations

NAN = float("nan")
SPAN = "temperature_range", P.TEXT_TEMPERATURE_OK, P.TEXT_TEMPERATURE_BAD.format(lo=-80.0, hi=60.0)
RAIN = "precipitation_range", P.TEXT_PRECIPITATION_OK, P.TEXT_PRECIPITATION_BAD.format(hi=500.0)
ORDER = "temperature_consistency", P.TEXT_CONSISTENCY_OK, P.TEXT_CONSISTENCY_BAD
FUTURE = "no_future_dates", P.TEXT_FUTURE_OK, P.TEXT_FUTURE_BAD
TOMORROW = DAY + dt.timedelta(days=1)


@pytest.mark.parametrize("check,change,rows", [
    (SPAN, {"temperature_max": 60.0}, 0), (SPAN, {"temperature_max": 60.1}, 1),
    (SPAN, {"temperature_max": -80.0, "temperature_min": -80.0}, 0), (SPAN, {"temperature_min": -80.1}, 1),
    (SPAN, {"temperature_min": 71.0}, 1), (SPAN, {"temperature_max": None, "temperature_min": None}, 0),
    (SPAN, {"temperature_max": NAN}, 0), (SPAN, {"temperature_max": -200.0, "temperature_min": 200.0}, 1),
    (RAIN, {"precipitation_sum": 0.0}, 0), (RAIN, {"precipitation_sum": 500.0}, 0),
    (RAIN, {"precipitation_sum": -0.1}, 1), (RAIN, {"precipitation_sum": 500.1}, 1),
    (RAIN, {"precipitation_sum": None}, 0), (RAIN, {"precipitation_sum": NAN}, 0),
    (ORDER, {"temperature_max": 3.0, "temperature_min": 3.0}, 0),
    (ORDER, {"temperature_max": 3.0, "temperature_min": 3.1}, 1),
    (ORDER, {"temperature_max": None}, 0), (ORDER, {"temperature_min": NAN}, 0),
    (FUTURE, {"date": DAY}, 0), (FUTURE, {"date": TOMORROW}, 1), (FUTURE, {"date": None}, 0),
])
def test_row_checks_at_their_bounds(spark, check, change, rows):
    name, ok, bad = check
    # The changed row stands twice, beside rows that are always valid.
    df = checked(spark, *stations(5), *stations(2, **change))
    got = DQ.single_check(df, name, DAY).first()
    assert (got.name, got.passed, got.affected_rows) == (name, rows == 0, 2 * rows)
    assert got.detail == (bad if rows else ok)


@pytest.mark.parametrize("copies,rows", [(1, 0), (2, 2), (5, 5)])
def test_duplicates_count_every_copy(spark, copies, rows):
    df = checked(spark, *stations(4), *[{"city_name": "Brisk"}] * copies)
    got = DQ.single_check(df, "no_duplicates", DAY).first()
    assert (got.passed, got.affected_rows) == (rows == 0, rows)
    assert got.detail == (P.TEXT_DUPLICATES_BAD.format(n=rows) if rows else P.TEXT_DUPLICATES_OK)


def test_same_station_on_other_days_is_no_duplicate(spark):
    days = [{"date": DAY - dt.timedelta(days=d)} for d in range(6)]
    assert DQ.single_check(checked(spark, *days), "no_duplicates", DAY).first().passed


@pytest.mark.parametrize("missing,of", [(0, 10), (8, 10), (9, 10)])
def test_share_of_missing_cells(spark, missing, of):
    # One missing cell of the eight in each of ``missing`` rows, NULL and NaN in turn.
    rows = [{"temperature_min": NAN if i % 2 else None} if i < missing else {} for i in range(of)]
    df = checked(spark, *[{**s, **r} for s, r in zip(stations(of), rows)])
    rules = copy.deepcopy(P.RULES)
    rules["required_fields"] = CHECKED
    got = {r.name: r for r in DQ.run_all_checks(df, DAY, DQ.QualitySpec(rules=rules)).collect()}["null_percentage"]
    share = 100 * missing / (8 * of)
    assert got.passed == (share <= 10.0) and got.affected_rows == missing
    assert got.detail == P.TEXT_NULLS.format(pct=round(share, 1), max_pct=10.0)


def test_absent_columns_are_named(spark):
    df = checked(spark, *stations(3)).drop("latitude", "precipitation_sum")
    rep = DQ.quality_report(df, DAY).first()
    first = rep.checks[0]
    assert not first.passed and not rep.overall_passed and first.affected_rows == 3
    assert "latitude" in first.detail and "precipitation_sum" in first.detail and "longitude" not in first.detail


def test_report_counts_and_order(spark):
    df = checked(spark, *stations(7), {"city_name": "Brisk"}, {"city_name": "Brisk"}, {"city_name": "Brisk"},
                 {"city_name": "Corvel", "temperature_max": 75.0})
    rep = DQ.quality_report(df, DAY).first()
    assert rep.extraction_date == DAY.isoformat()
    assert [c.name for c in rep.checks] == P.CHECK_NAMES
    assert (rep.total_rows, rep.duplicate_count, rep.overall_passed) == (11, 2, False)
    # Invalid is what the check with the most affected rows says: the three copies.
    assert (rep.valid_rows, rep.invalid_rows) == (8, 3)


def test_clean_batch(spark):
    rep = DQ.quality_report(checked(spark, *stations(40)), DAY).first()
    assert rep.overall_passed and (rep.total_rows, rep.valid_rows, rep.invalid_rows) == (40, 40, 0)
    assert [c.detail for c in rep.checks] == [
        P.TEXT_REQUIRED_OK, P.TEXT_TEMPERATURE_OK, P.TEXT_PRECIPITATION_OK, P.TEXT_FUTURE_OK,
        P.TEXT_DUPLICATES_OK, P.TEXT_NULLS.format(pct=0.0, max_pct=10.0), P.TEXT_CONSISTENCY_OK]


def test_one_report_for_each_batch(spark):
    df = checked(spark, *stations(6, date=DAY), *stations(4, date=TOMORROW)).withColumn("run", F.col("date").cast("string"))
    got = {r.extraction_date: (r.total_rows, r.overall_passed) for r in
           DQ.quality_report(df, DAY, batch=["run"], batch_label="run").collect()}
    assert got == {DAY.isoformat(): (6, True), TOMORROW.isoformat(): (4, False)}


def test_no_rows(spark):
    df = checked(spark, {}).limit(0)
    assert all(r.passed and r.affected_rows == 0 for r in DQ.run_all_checks(df, DAY).collect())
    rep = DQ.quality_report(df, DAY).first()
    assert (rep.total_rows, rep.null_percentage) == (0, 0.0)


def test_not_null_counts(spark):
    df = checked(spark, {"country_code": None}, {"country_code": None, "date": None}, {})
    got = {r.column_name: r.null_rows for r in DQ.not_null_tests(df, ["date", "city_name", "country_code"]).collect()}
    assert got == {"date": 1, "city_name": 0, "country_code": 2}


def test_fixture_counts_at_sf001(spark):
    """The counts FIXTURES.md records for ``obs`` at sf0.01."""
    from pluvia.plans import fixtures as X
    obs = X.observations(spark, "/root/testdata/sf0.01")
    rep = DQ.quality_report(obs, dt.date(2001, 8, 1)).first()
    found = {c.name: c.affected_rows for c in rep.checks}
    assert (found["temperature_range"], found["precipitation_range"], found["no_duplicates"],
            found["temperature_consistency"]) == (1029, 14, 3286, 471)
    assert (rep.total_rows, rep.duplicate_count) == (15000, 1717)
