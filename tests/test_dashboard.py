"""Dashboard operators: ties, windows, defaults, shares."""

import datetime as dt

from pyspark.sql import functions as F

from pluvia.operators import dashboard as B
from pluvia.operators.aggregates import duplicate_counts, most_frequent

D = dt.date


def frame(spark):
    rows = [(D(2024, 1, d), c, "X" if c < "M" else "Y", t, p, i)
            for i, (d, c, t, p) in enumerate([
                (1, "Lima", 20.0, 1.0), (2, "Lima", 25.0, 0.0), (3, "Lima", 22.0, 2.0),
                (3, "Quito", 22.0, 0.0), (3, "Bogotá", 18.0, None), (2, "Quito", 30.0, 4.0)])]
    return spark.createDataFrame(
        rows, "date date, city_name string, country string, temperature_max double, "
              "precipitation_sum double, src_id long")


def test_latest_slice_and_argmax_ties(spark):
    df = frame(spark)
    assert B.latest_slice(df).count() == 3
    top = B.arg_max_row(B.latest_slice(df), "temperature_max", ("city_name",)).first()
    assert top["city_name"] == "Lima"  # tie 22.0 with Quito: first in key order


def test_top_k_missing_last(spark):
    df = frame(spark)
    out = B.top_k(df, "precipitation_sum", 6, ("city_name", "src_id")).collect()
    assert out[0]["precipitation_sum"] == 4.0 and out[-1]["precipitation_sum"] is None


def test_last_n_per_key(spark):
    out = B.last_n_per_key(frame(spark), "city_name", 2, tie=("src_id",)) \
        .where(F.col("city_name") == "Lima").orderBy("rn").collect()
    assert [r["date"] for r in out] == [D(2024, 1, 3), D(2024, 1, 2)]


def test_default_range_clamped_to_data(spark):
    r = B.default_range(frame(spark)).first()
    assert r["start_date"] == D(2024, 1, 1) and r["end_date"] == D(2024, 1, 3)


def test_trailing_window(spark):
    assert B.trailing_from_latest(frame(spark), 1).count() == 5


def test_top_groups_share(spark):
    out = {r["name"]: (r["val"], r["pct"]) for r in B.top_groups_share(frame(spark)).collect()}
    assert out == {"X": (3.0, 75.0), "Y": (4.0, 100.0)}


def test_duplicates_and_mode(spark):
    df = frame(spark)
    dup = duplicate_counts(df.union(df.limit(1)), ["city_name", "date"]).first()
    assert (dup["duplicate_rows"], dup["duplicate_extra"]) == (2, 1)
    m = {r["country"]: r["most_common_city"] for r in
         most_frequent(df, ["country"], "city_name", "most_common_city").collect()}
    assert m == {"X": "Lima", "Y": "Quito"}


def test_pick_key_fallback(spark):
    df = frame(spark)
    assert df.select(B.pick_key(df, "city_name", "Lima")).first()[0] == "Lima"
    assert df.select(B.pick_key(df, "city_name", "Paris")).first()[0] == "Bogotá"


def test_nan_is_skipped_like_pandas(spark):
    df = frame(spark).withColumn(
        "temperature_max",
        F.when(F.col("city_name") == "Quito", F.lit(float("nan"))).otherwise(F.col("temperature_max")))
    top = B.arg_max_row(B.latest_slice(df), "temperature_max").first()
    assert top["city_name"] == "Lima"  # NaN (Quito) is not a maximum
    order = [r["city_name"] for r in B.top_k(B.latest_slice(df), "temperature_max", 3).collect()]
    assert order == ["Lima", "Bogotá", "Quito"]  # missing last


def test_city_stats_approx_mode_keeps_exact_measures(spark):
    from pluvia.plans import catalog
    sf = "/root/testdata/sf0.001"
    exact = catalog.q_mart_city_stats(spark, sf).drop("most_common_weather")
    approx = catalog.q_mart_city_stats_approx(spark, sf)
    assert approx.count() == exact.count()
    assert approx.drop("most_common_count").exceptAll(exact).count() == 0
