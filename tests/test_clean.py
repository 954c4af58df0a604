"""Cleaning steps, as tables of input cell -> output cell."""

import datetime as dt

import numpy as np
import pytest

from pluvia import presets as P
from pluvia.functions import bin_right_closed, round_half_even
from pluvia.functions import scalars as S
from pluvia.operators import clean as C
from tests.frames import observations

NAN, INF = float("nan"), float("inf")


def cells(df, column):
    return [r[0] for r in df.select(column).collect()]


@pytest.mark.parametrize("text,value", [
    ("4", 4.0), ("-0.25", -0.25), ("7e2", 700.0), ("  8.5\t", 8.5), ("inf", INF), ("-inf", -INF), ("Infinity", INF),
    ("nan", None), ("seven", None), ("3d", None), ("3.5f", None), ("", None), (None, None)])
def test_text_to_number(spark, text, value):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(S.coerce_double("x")).first()[0] == value


@pytest.mark.parametrize("text,value", [
    ("3", 3), ("3.0", 3), ("-12", -12), ("2e1", 20), ("9007199254740993", 2**53 + 1),
    (str(2**63 - 1), 2**63 - 1), (str(-2**63), -2**63), ("none", None), (None, None)])
def test_text_to_integer_keeps_every_digit(spark, text, value):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(S.coerce_integer("x")).first()[0] == value


@pytest.mark.parametrize("text", ["3.5", "0.1", "inf", "1e40"])
def test_what_is_no_integer_raises(spark, text):
    with pytest.raises(Exception):
        spark.createDataFrame([(text,)], "x string").select(S.coerce_integer("x")).collect()


def test_decimal_to_integer_keeps_every_digit(spark):
    df = spark.sql("SELECT CAST('9007199254740993' AS DECIMAL(38, 0)) AS x")
    assert df.select(S.coerce_integer("x", dtype="decimal(38,0)")).first()[0] == 2**53 + 1


def test_types_after_coercion(spark):
    out = C.clean_types(observations(spark, {}))
    types = dict(out.dtypes)
    assert types["date"] == "date" and types["weather_code"] == "bigint"
    assert {types[c] for c in P.NUMERIC_COLUMNS} == {"double"}
    assert cells(out, "date") == [dt.date(2030, 3, 10)]


def test_bad_date_raises(spark):
    with pytest.raises(Exception):
        C.clean_types(observations(spark, {"date": "10/03/2030"})).collect()


@pytest.mark.parametrize("mean,high,low,want", [
    (None, 9.0, 4.0, 6.5), (5.0, 9.0, 4.0, 5.0), (None, None, 4.0, None), (None, 9.0, None, None)])
def test_missing_mean_is_the_midpoint(spark, mean, high, low, want):
    df = observations(spark, {"temperature_mean": mean, "temperature_max": high, "temperature_min": low})
    assert cells(C.fill_missing(df), "temperature_mean") == [want]


def test_zero_fill_touches_its_columns_only(spark):
    df = observations(spark, {"precipitation_sum": None, "precipitation_hours": None, "wind_speed_max": None})
    out = C.fill_missing(df).first()
    assert (out.precipitation_sum, out.precipitation_hours, out.wind_speed_max) == (0.0, 0.0, None)


def test_every_code_and_unknown_ones(spark):
    codes = [*P.WEATHER_CODES, 4, -1, None]
    out = C.add_code_label(observations(spark, *[{"weather_code": c} for c in codes]))
    assert cells(out, "weather_description") == [*P.WEATHER_CODES.values()] + [P.UNKNOWN_CODE_LABEL] * 3


@pytest.mark.parametrize("high,low,damp_high,damp_low,span,damp", [
    (11.0, 3.25, 90.0, 45.5, 7.8, 67.8), (-4.0, -9.5, 60.0, 60.0, 5.5, 60.0), (None, 1.0, None, 40.0, None, None)])
def test_span_and_midpoint(spark, high, low, damp_high, damp_low, span, damp):
    out = C.add_derived(observations(spark, {"temperature_max": high, "temperature_min": low,
                                             "humidity_max": damp_high, "humidity_min": damp_low})).first()
    assert (out.temperature_range, out.humidity_mean) == (span, damp)


@pytest.mark.parametrize("edges,labels", [
    (P.PRECIPITATION_EDGES, P.PRECIPITATION_LABELS), (P.TEMPERATURE_EDGES, P.TEMPERATURE_LABELS)])
def test_bins_hold_their_upper_edge(spark, edges, labels):
    inner = [e for e in edges[1:] if e != INF]
    values = [*inner, *(e + 0.01 for e in inner), edges[0], NAN, None]
    want = [*labels[:len(inner)], *labels[1:len(inner) + 1], None, None, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert cells(df, bin_right_closed("x", edges, labels)) == want


def test_bins_see_the_value_before_rounding(spark):
    out = C.clean(observations(spark, {"precipitation_sum": 20.03, "temperature_mean": 10.04})).first()
    assert (out.precipitation_sum, out.temperature_mean) == (20.0, 10.0)
    assert out.precipitation_category == P.PRECIPITATION_LABELS[3]
    assert out.temperature_category == P.TEMPERATURE_LABELS[2]


def test_rounding_like_numpy(spark):
    values = [0.05, 0.15, 0.25, 1.45, -2.55, 1234567.85, 1e15, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert cells(df, round_half_even("x", 1)) == [float(np.round(v, 1)) for v in values]


def test_whole_chain_keeps_rows_and_adds_columns(spark):
    df = observations(spark, {}, {}, {"temperature_max": None, "temperature_mean": None}, {"weather_code": None})
    out = C.clean(df)
    assert out.count() == 4
    assert set(out.columns) == set(df.columns) | set(P.DERIVED_COLUMNS)
