"""The prefix table against the plain period key figures."""

import datetime as dt
import random

import pytest

from pluvia.operators import dashboard as B
from pluvia.operators import ranges as R

DAY0 = dt.date(2023, 1, 1)


def observations(spark, seed=0, days=60):
    rng, rows = random.Random(seed), []
    for city, share in (("Hot", 1.0), ("Gaps", 0.3), ("Late", 0.8)):
        for i in range(days):
            if city == "Late" and i < 20 or rng.random() > share:
                continue
            for _ in range(rng.choice([1, 1, 2]) * (5 if city == "Hot" else 1)):
                v = lambda a, b: rng.choice([None, *[round(rng.uniform(a, b), 1)] * 4])
                rows.append((city, DAY0 + dt.timedelta(days=i), v(-10, 40), v(-20, 30), v(0, 90), v(10, 99), v(0, 14)))
    return spark.createDataFrame(rows, "city_name string, date date, temperature_max double, temperature_min double, "
                                       "precipitation_sum double, humidity_mean double, uv_index_max double")


def plain(df, city, start, end):
    return tuple(B.period_kpis(df.where((df.city_name == city) & df.date.between(start, end))).first())


@pytest.mark.parametrize("max_level", [R.MAX_LEVEL, 2])
def test_any_range_equals_the_plain_key_figures(spark, monkeypatch, max_level):
    monkeypatch.setattr(R, "MAX_LEVEL", max_level)
    df = observations(spark)
    rng, asked = random.Random(1), []
    for i in range(25):
        a = rng.randint(-5, 62)
        asked.append((i, rng.choice(["Hot", "Gaps", "Late", "Nobody"]), DAY0 + dt.timedelta(days=a),
                      DAY0 + dt.timedelta(days=a + rng.choice([-2, 0, 1, 3, 7, 8, 30, 90]))))
    prefix = R.prefix_table(df, max_level=max_level)
    got = R.period_kpis_of(prefix, spark.createDataFrame(asked, "period_id int, city_name string, start date, end date"))
    found = {r.period_id: tuple(r)[1:] for r in got.collect()}
    assert len(found) == len(asked)
    for i, city, start, end in asked:
        assert found[i] == plain(df, city, start, end), (city, start, end)


def test_one_row_a_day_and_arrays_of_fitting_levels(spark):
    prefix = R.prefix_table(observations(spark)).where("city_name = 'Hot'").orderBy("date").collect()
    assert [r.date for r in prefix] == [prefix[0].date + dt.timedelta(days=i) for i in range(len(prefix))]
    assert [len(r.hi) for r in prefix[-4:]] == [3, 2, 2, 1]
    assert prefix[-1].sum_n == 5 * (len(prefix) + 0) or prefix[-1].sum_n >= 5 * len(prefix)


def test_empty_inputs(spark):
    df = observations(spark)
    none = R.prefix_table(df.where("false"))
    assert none.count() == 0
    asked = spark.createDataFrame([(1, "Hot", DAY0, DAY0)], "period_id int, city_name string, start date, end date")
    assert R.period_kpis_of(none, asked).first().total_precipitation == 0
    assert R.period_kpis_of(R.prefix_table(df), asked.where("false")).count() == 0


def test_all_levels_use_one_sorting(spark):
    plan = R.prefix_table(observations(spark))._jdf.queryExecution().executedPlan().toString()
    lines = [x.strip(" +-:*()0123456789") for x in plan.splitlines()]
    windows = [i for i, x in enumerate(lines) if x.startswith("Window [")]
    assert len(windows) > R.MAX_LEVEL / 2
    below = [next(x for x in lines[i + 1:] if not x.startswith(("Window [", "Project ["))) for i in windows]
    assert len(set(below)) == 1 and below[0].startswith("Sort [city_name")
