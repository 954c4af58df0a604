"""Exact rounding helpers against Python's Fraction arithmetic."""

from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pluvia.functions import scalars as S

PAIRS = st.lists(st.tuples(st.integers(-10**12, 10**12), st.integers(1, 10**6)),
                 min_size=1, max_size=40)


def half_up(n, d):
    q = Fraction(abs(n), d)
    r = int(q + Fraction(1, 2)) if (q - int(q)) >= Fraction(1, 2) else int(q)
    return r if n >= 0 else -r


def half_even(n, d):
    return round(Fraction(n, d))


@settings(max_examples=15, deadline=None)
@given(PAIRS)
def test_ratio_rounding_is_exact(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, d long")
    rows = df.select("n", "d", S.ratio_round_half_up(F.col("n"), F.col("d")).alias("up"),
                     S.ratio_round_half_even(F.col("n"), F.col("d")).alias("even")).collect()
    for r in rows:
        assert r["up"] == half_up(r["n"], r["d"])
        assert r["even"] == half_even(r["n"], r["d"])


def test_ties(spark):
    df = spark.createDataFrame([(5, 2), (-5, 2), (7, 2), (15, 10), (25, 10)], "n long, d long")
    rows = df.select(S.ratio_round_half_up(F.col("n"), F.col("d")).alias("up"),
                     S.ratio_round_half_even(F.col("n"), F.col("d")).alias("even")).collect()
    assert [(r["up"], r["even"]) for r in rows] == [(3, 2), (-3, -2), (4, 4), (2, 2), (3, 2)]


def test_safe_percentage_zero_denominator(spark):
    df = spark.createDataFrame([(1, 0), (1, 3), (2, 3)], "a long, b long")
    out = [r[0] for r in df.select(S.safe_percentage(F.col("a"), F.col("b"), 1)).collect()]
    assert out == [None, 33.3, 66.7]


def test_fixed_one_decimal(spark):
    df = spark.createDataFrame([(0,), (5,), (125,), (1000,)], "t long")
    out = [r[0] for r in df.select(S.fixed_one_decimal(F.col("t"))).collect()]
    assert out == ["0.0", "0.5", "12.5", "100.0"]


def test_code_lookup_default_and_null(spark):
    df = spark.createDataFrame([(0,), (999,), (None,)], "c long")
    out = [r[0] for r in df.select(S.code_lookup("c", {0: "a"}, "?")).collect()]
    assert out == ["a", "?", "?"]


def test_col_or_default_only_when_absent(spark):
    df = spark.createDataFrame([(None,)], "humidity_mean double")
    assert df.select(S.col_or_default(df, "humidity_mean", 60)).first()[0] is None
    assert df.select(S.col_or_default(df, "other", 60)).first()[0] == 60


def test_clamped_ratio(spark):
    df = spark.createDataFrame([(-5.0,), (60.0,), (500.0,)], "x double")
    assert [r[0] for r in df.select(S.clamped_ratio("x", 120)).collect()] == [0.0, 0.5, 1.0]
    missing = spark.createDataFrame([(None,), (float("nan"),), (0.0,)], "x double")
    assert [r[0] for r in missing.select(S.clamped_ratio("x", 120)).collect()] == [0.0, 0.0, 0.0]


def test_two_decimal_sums_are_exact(spark):
    df = spark.createDataFrame([(1.24,)] * 3, "x double")
    total = F.sum(S.units("x", 2))
    got = df.select(total, S.mean_units(total, F.count("x"), 2, digits=2)).first()
    assert tuple(got) == (372, 1.24)


def test_scale_settings_follow_the_input():
    from pluvia.session import scale_settings
    assert scale_settings(10 ** 6)["spark.sql.shuffle.partitions"] == "1"
    assert scale_settings(100 * 2 ** 40)["spark.sql.shuffle.partitions"] == "409600"
    assert scale_settings(1024 * 2 ** 30)["spark.sql.shuffle.partitions"] == "4096"


def test_nan_is_missing_in_bins_and_flags(spark):
    df = spark.createDataFrame([(float("nan"),), (30.0,), (None,)], "x double")
    out = df.select(S.bin_right_closed("x", [0.0, 10.0, float("inf")], ["lo", "hi"]).alias("b"),
                    S.threshold_flag("x", 20).alias("f")).collect()
    assert [(r["b"], r["f"]) for r in out] == [(None, False), ("hi", True), (None, False)]
