"""Duplicate members and distinct counts over windows."""

import datetime as dt
import random

import pytest

from pluvia.operators import aggregates as A

AS_OF = dt.date(2024, 6, 30)


def test_duplicate_members_are_all_rows_of_a_repeated_key(spark):
    rows = [("a", 1, "x"), ("a", 1, "y"), ("a", 2, "z"), (None, 1, "n"), (None, 1, "m"), ("b", 1, "x"), ("a", 1, "x")]
    df = spark.createDataFrame(rows, "c string, d int, v string")
    got = sorted(map(tuple, A.duplicate_members(df, ["c", "d"]).collect()), key=str)
    assert got == sorted([r for r in rows if r[:2] in (("a", 1), (None, 1))], key=str)
    assert A.duplicate_members(df, ["c"], batch=["v"]).count() == 2
    assert A.duplicate_members(df.where("false"), ["c"]).count() == 0


@pytest.mark.parametrize("n", [50, 20_000])
def test_windows_from_day_sketches_lie_within_the_stated_error(spark, n):
    rng = random.Random(n)
    rows = [(None if i % 97 == 0 else rng.randrange(n), AS_OF - dt.timedelta(days=rng.randrange(-3, 400))) for i in range(2 * n)]
    df = spark.createDataFrame(rows, "key long, date date").repartition(4)
    days = [1, 7, 30, 365]
    want = {d: len({k for k, x in rows if k is not None and AS_OF - dt.timedelta(days=d) < x <= AS_OF}) for d in days}
    assert {r.days: r.n for r in A.exact_in_windows(df, "key", AS_OF, days).collect()} == want
    sketches = A.daily_sketches(df, "key")
    got = {r.days: r.estimate for r in A.distinct_in_windows(sketches, AS_OF, days).collect()}
    assert set(got) == set(days)
    for d in days:
        assert abs(got[d] - want[d]) <= 4 * A.relative_error() * want[d] + 1


def test_windows_without_a_day_count_nothing(spark):
    df = spark.createDataFrame([(1, AS_OF - dt.timedelta(days=50))], "key long, date date")
    sketches = A.daily_sketches(df, "key")
    assert [(r.days, r.estimate) for r in A.distinct_in_windows(sketches, AS_OF, [30]).collect()] == [(30, 0)]
    assert [(r.days, r.n) for r in A.exact_in_windows(df, "key", AS_OF, [30, 51]).orderBy("days").collect()] == [(30, 0), (51, 1)]
