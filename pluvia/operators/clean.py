"""Cleaning and enrichment: typed, imputed, labelled, binned, rounded.

One narrow stage: every step is a projection, so the whole chain fuses into
a single whole-stage-codegen span and the row count never changes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia import presets as P
from pluvia.functions import scalars as S


@dataclass(frozen=True)
class CleanSpec:
    """Column names and parameters of the cleaning chain."""
    date: str = "date"
    numeric: Sequence[str] = tuple(P.NUMERIC_COLUMNS)
    code: str = "weather_code"
    code_map: Mapping[int, str] = field(default_factory=lambda: dict(P.WEATHER_CODES))
    code_default: str = P.UNKNOWN_CODE_LABEL
    code_label: str = "weather_description"
    mean: str = "temperature_mean"
    hi: str = "temperature_max"
    lo: str = "temperature_min"
    zero_fill: Sequence[str] = tuple(P.ZERO_FILL_COLUMNS)
    range_col: str = "temperature_range"
    mid_hi: str = "humidity_max"
    mid_lo: str = "humidity_min"
    mid_col: str = "humidity_mean"
    bins: Sequence[tuple] = (
        ("precipitation_sum", "precipitation_category",
         tuple(P.PRECIPITATION_EDGES), tuple(P.PRECIPITATION_LABELS)),
        ("temperature_mean", "temperature_category",
         tuple(P.TEMPERATURE_EDGES), tuple(P.TEMPERATURE_LABELS)),
    )
    rounded: Sequence[str] = tuple(P.ROUNDED_COLUMNS)
    digits: int = 1


WEATHER = CleanSpec()


def _replace(df: DataFrame, values: dict) -> DataFrame:
    return df.withColumns(values) if values else df


def clean_types(df: DataFrame, spec: CleanSpec = WEATHER) -> DataFrame:
    """Date to DATE, measures to DOUBLE (bad -> NULL), code to BIGINT."""
    types = dict(df.dtypes)
    out = {}
    if spec.date in df.columns and types[spec.date] != "date":
        out[spec.date] = S.parse_date(spec.date)
    for c in spec.numeric:
        if c in df.columns:
            out[c] = S.coerce_double(c, types[c])
    if spec.code in df.columns and types[spec.code] != "bigint":
        out[spec.code] = S.coerce_integer(spec.code, spec.code, types[spec.code])
    return _replace(df, out)


def fill_missing(df: DataFrame, spec: CleanSpec = WEATHER) -> DataFrame:
    """Mean from (max+min)/2 where missing; listed columns filled with 0."""
    out = {spec.mean: S.impute_midpoint(spec.mean, spec.hi, spec.lo)}
    for c in spec.zero_fill:
        out[c] = S.zero_fill(c)
    return _replace(df, out)


def add_code_label(df: DataFrame, spec: CleanSpec = WEATHER) -> DataFrame:
    return df.withColumn(spec.code_label,
                         S.code_lookup(spec.code, spec.code_map, spec.code_default))


def add_derived(df: DataFrame, spec: CleanSpec = WEATHER) -> DataFrame:
    """Range and midpoint (rounded), then the binned categories.

    Bins read the unrounded values: rounding happens after this step.
    """
    out = {
        spec.range_col: S.round_half_even(F.col(spec.hi) - F.col(spec.lo), spec.digits),
        spec.mid_col: S.round_half_even((F.col(spec.mid_hi) + F.col(spec.mid_lo)) / 2.0,
                                        spec.digits),
    }
    for source, target, edges, labels in spec.bins:
        out[target] = S.bin_right_closed(source, edges, labels)
    return _replace(df, out)


def round_columns(df: DataFrame, spec: CleanSpec = WEATHER) -> DataFrame:
    return _replace(df, {c: S.round_half_even(c, spec.digits)
                         for c in spec.rounded if c in df.columns})


def clean(df: DataFrame, spec: CleanSpec = WEATHER) -> DataFrame:
    """The full chain, in the fixed order: types, fill, label, derive, round."""
    return (df.transform(clean_types, spec)
              .transform(fill_missing, spec)
              .transform(add_code_label, spec)
              .transform(add_derived, spec)
              .transform(round_columns, spec))
