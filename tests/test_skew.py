"""One key holding a third of the rows: results stay exact (pandas brute force)."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pluvia.operators import aggregates as A
from pluvia.operators import dashboard as B
from pluvia.operators import quality as DQ


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(7)
    n = 3000
    city = np.where(np.arange(n) % 3 == 0, "Hot", rng.choice(["A", "B", "C", "D", "E"], n))
    day = rng.integers(0, 20, n)
    pdf = pd.DataFrame({
        "date": [dt.date(2024, 1, 1) + dt.timedelta(days=int(d)) for d in day],
        "city_name": city,
        "temperature_max": np.round(rng.normal(20, 15, n), 1),
        "temperature_min": np.round(rng.normal(10, 15, n), 1),
        "precipitation_sum": np.where(rng.random(n) < 0.1, np.nan, np.round(rng.gamma(1, 8, n), 1)),
        "src_id": np.arange(n),
    })
    df = spark.createDataFrame(pdf).withColumn(
        "precipitation_sum", F.nanvl("precipitation_sum", F.lit(None).cast("double")))
    return df.repartition(8), pdf


def test_duplicates_on_hot_key(skewed):
    df, pdf = skewed
    dup = A.duplicate_counts(df, ["city_name", "date"]).first()
    assert dup["duplicate_rows"] == int(pdf.duplicated(["city_name", "date"], keep=False).sum())
    assert dup["duplicate_extra"] == int(pdf.duplicated(["city_name", "date"]).sum())


def test_quality_counts_on_hot_key(skewed):
    df, pdf = skewed
    rep = {r["name"]: r for r in DQ.run_all_checks(df, dt.date(2024, 1, 10)).collect()}
    t = pdf[["temperature_max", "temperature_min"]]
    bad_t = ((t < -80) | (t > 60)).any(axis=1).sum()
    assert rep["temperature_range"]["affected_rows"] == bad_t
    assert rep["no_future_dates"]["affected_rows"] == (pdf["date"] > dt.date(2024, 1, 10)).sum()
    assert rep["temperature_consistency"]["affected_rows"] == \
        (pdf["temperature_min"] > pdf["temperature_max"]).sum()
    assert rep["null_percentage"]["affected_rows"] == int(pdf.drop(columns=[]).isnull().sum().sum())


def test_last_n_per_hot_key(skewed):
    df, pdf = skewed
    got = (B.last_n_per_key(df, "city_name", 5, tie=("src_id",))
           .where(F.col("city_name") == "Hot").orderBy("rn").select("src_id").collect())
    want = pdf[pdf.city_name == "Hot"].sort_values(["date", "src_id"], ascending=False).head(5)
    assert [r[0] for r in got] == list(want["src_id"])


def test_mode_on_hot_key(skewed):
    df, pdf = skewed
    label = F.when(F.col("temperature_max") > 20, "warm").otherwise("cold")
    got = {r["city_name"]: r["m"] for r in
           A.most_frequent(df.withColumn("label", label), ["city_name"], "label", "m").collect()}
    pdf = pdf.assign(label=np.where(pdf.temperature_max > 20, "warm", "cold"))
    for c, g in pdf.groupby("city_name"):
        counts = g["label"].value_counts()
        best = sorted(counts[counts == counts.max()].index)[0]
        assert got[c] == best
