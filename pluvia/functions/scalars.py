"""Scalar column functions.

Rounding follows two conventions of the source job: values computed on
the Python side round half to even on the binary value (``rint(x*10)/10``),
the SQL models round half away from zero.  Means and percentages of counts
are computed from exact integers so that the result does not depend on how
the data is partitioned or on the engine.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = [
    "col_of", "round_half_even", "coerce_double", "coerce_integer",
    "parse_date", "impute_midpoint", "zero_fill", "code_lookup",
    "bin_right_closed", "threshold_flag", "tenths", "ratio_round_half_up",
    "ratio_round_half_even", "mean_tenths", "safe_percentage",
    "share_of_max", "clamped_ratio", "title_label", "date_label",
    "col_or_default", "fixed_one_decimal", "json_field", "nan_to_null",
]


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_even(c: str | Column, digits: int = 1) -> Column:
    """Round half to even on the binary value, as numpy does."""
    scale = float(10 ** digits)
    return F.rint(col_of(c) * F.lit(scale)) / F.lit(scale)


NUMERIC_TYPES = ("double", "float", "bigint", "int", "smallint", "tinyint")
INTEGRAL_TYPES = ("bigint", "int", "smallint", "tinyint")


def coerce_double(c: str | Column, dtype: str | None = None) -> Column:
    """Numeric coercion where anything unparsable becomes NULL.

    Text is guarded against the Java-only float suffixes (``1d``, ``2f``)
    that ``try_cast`` would accept; NaN is folded into NULL because NaN is
    not missing in Spark.  With a known numeric ``dtype`` only the cast and
    the NaN fold remain (no text round trip).
    """
    x = col_of(c)
    if dtype in NUMERIC_TYPES or (dtype or "").startswith("decimal"):
        return F.nanvl(col_of(x).cast("double"), F.lit(None).cast("double"))
    text = F.trim(x.cast("string"))
    guarded = F.when(~text.rlike(r"[0-9.][dDfF]$"), text)
    return F.nanvl(guarded.try_cast("double"), F.lit(None).cast("double"))


def coerce_integer(c: str | Column, name: str = "value", dtype: str | None = None) -> Column:
    """Nullable 64-bit integer; a non-integral value raises (no truncation).

    Text and decimals go through DECIMAL, so every 64-bit integer keeps its value.
    """
    if dtype in INTEGRAL_TYPES:
        return col_of(c).cast("bigint")
    x = coerce_double(c, dtype)
    exact = F.trim(col_of(c).cast("string")).try_cast("decimal(38,18)")
    return (F.when(x.isNull(), F.lit(None).cast("bigint"))
            .when(exact == F.floor(exact), exact.cast("bigint"))
            .when(exact.isNull() & (x == F.floor(x)), x.cast("bigint"))
            .otherwise(F.raise_error(F.concat(
                F.lit(f"cannot safely cast non-integral {name} to integer: "),
                x.cast("string"))).cast("bigint")))


def parse_date(c: str | Column) -> Column:
    """ISO ``yyyy-MM-dd`` text (or date/timestamp) to DATE; bad text raises."""
    return F.to_date(col_of(c))


def impute_midpoint(mean: str, hi: str, lo: str) -> Column:
    """Keep ``mean``; where missing use ``(hi + lo) / 2`` (NULL if either is)."""
    return F.coalesce(F.col(mean), (F.col(hi) + F.col(lo)) / F.lit(2.0))


def zero_fill(c: str | Column) -> Column:
    return F.coalesce(col_of(c), F.lit(0.0))


def code_lookup(c: str | Column, mapping: Mapping, default: str | None) -> Column:
    """Map a code through a literal map; unknown or NULL codes get ``default``.

    The map is a literal inside the expression, so no join or shuffle runs.
    """
    table = F.map_from_arrays(F.lit(list(mapping.keys())), F.lit(list(mapping.values())))
    found = F.try_element_at(table, col_of(c))
    return found if default is None else F.coalesce(found, F.lit(default))


def bin_right_closed(c: str | Column, edges: Sequence[float],
                     labels: Sequence[str]) -> Column:
    """Label ``x`` with ``labels[i]`` when ``edges[i] < x <= edges[i+1]``.

    Infinite edges are allowed; a value at or below the first edge, NULL or
    NaN gets no label (Spark orders NaN above every number, so it is folded
    into NULL first).
    """
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    x = nan_to_null(col_of(c))
    expr = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        # x > -inf still excludes -inf itself; x <= +inf is always true.
        cond = x > F.lit(float(lo))
        if not (math.isinf(hi) and hi > 0):
            cond = cond & (x <= F.lit(float(hi)))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def nan_to_null(x: str | Column) -> Column:
    """The value as DOUBLE with NaN folded into NULL."""
    return F.nanvl(col_of(x).cast("double"), F.lit(None).cast("double"))


def threshold_flag(c: str | Column, threshold: float) -> Column:
    """``x > threshold``; a missing value (NULL or NaN) is FALSE."""
    return F.coalesce(nan_to_null(col_of(c)) > F.lit(threshold), F.lit(False))


def units(c: str | Column, scale: int = 1) -> Column:
    """A value of ``scale`` decimals as an exact count of its last decimal (NaN -> NULL)."""
    return F.rint(nan_to_null(c) * F.lit(10.0 ** scale)).cast("bigint")


def tenths(c: str | Column) -> Column:
    """A one-decimal value as an exact integer count of tenths (NaN -> NULL)."""
    return units(c, 1)


def _idiv(a: Column, b: Column) -> Column:
    """Integer division (``a div b``), never through floating point."""
    return F.call_function("div", a, b)


def _sign(num: Column) -> Column:
    return F.when(num < 0, F.lit(-1)).otherwise(F.lit(1)).cast("bigint")


def ratio_round_half_up(num: Column, den: Column) -> Column:
    """round(num / den) half away from zero, exactly, for integers (den > 0)."""
    num, den = num.cast("bigint"), den.cast("bigint")
    q = _idiv(F.abs(num) * 2 + den, den * 2)
    return F.when(den > 0, _sign(num) * q)


def ratio_round_half_even(num: Column, den: Column) -> Column:
    """round(num / den) half to even, exactly, for integers (den > 0)."""
    num, den = num.cast("bigint"), den.cast("bigint")
    a = F.abs(num)
    q = _idiv(a, den)
    r = a - q * den
    up = (r * 2 > den) | ((r * 2 == den) & (F.pmod(q, F.lit(2)) == 1))
    mag = q + F.when(up, F.lit(1)).otherwise(F.lit(0))
    return F.when(den > 0, _sign(num) * mag)


def mean_units(total: Column, n: Column, scale: int, digits: int = 1,
               half_even: bool = False) -> Column:
    """Mean rounded to ``digits`` decimals, from an exact sum of :func:`units`."""
    num, den = total * F.lit(10 ** digits), n * F.lit(10 ** scale)
    r = ratio_round_half_even(num, den) if half_even else ratio_round_half_up(num, den)
    return F.when(n > 0, r / F.lit(10.0 ** digits))


def mean_tenths(sum_tenths: Column, n: Column, half_even: bool = False) -> Column:
    """Mean of one-decimal values, rounded to one decimal, from an exact sum."""
    r = ratio_round_half_even(sum_tenths, n) if half_even else ratio_round_half_up(sum_tenths, n)
    return F.when(n > 0, r / F.lit(10.0))


def safe_percentage(num: Column, den: Column, digits: int = 1,
                    half_even: bool = False) -> Column:
    """``round(num / nullif(den, 0) * 100, digits)`` for integer counts."""
    scale = 10 ** digits
    scaled = num.cast("bigint") * F.lit(100 * scale)
    r = ratio_round_half_even(scaled, den.cast("bigint")) if half_even \
        else ratio_round_half_up(scaled, den.cast("bigint"))
    return F.when(den != 0, r / F.lit(float(scale)))


def share_of_max(c: str | Column, max_c: str | Column) -> Column:
    """``value / max * 100`` with a zero maximum treated as 1."""
    m = F.coalesce(F.nullif(col_of(max_c), F.lit(0)), F.lit(1))
    return col_of(c) / m * F.lit(100.0)


def clamped_ratio(c: str | Column, scale: float) -> Column:
    """Gauge fill ``min(value / scale, 1)``; zero or less, NULL or NaN draws nothing."""
    v = nan_to_null(c)
    return F.when(v > 0, F.least(v / F.lit(float(scale)), F.lit(1.0))).otherwise(F.lit(0.0))


def title_label(c: str | Column) -> Column:
    """``snake_case`` -> ``Title Case``."""
    return F.initcap(F.replace(col_of(c), F.lit("_"), F.lit(" ")))


def date_label(c: str | Column) -> Column:
    """``15 Jan`` style day label."""
    return F.date_format(col_of(c), "dd MMM")


def col_or_default(df: DataFrame, name: str, default) -> Column:
    """The column when the frame has it, else a literal default.

    Only an absent column gets the default; NULL values stay NULL.
    """
    return F.col(name) if name in df.columns else F.lit(default).alias(name)


def fixed_one_decimal(tenths_col: Column) -> Column:
    """Format a non-negative count of tenths as ``X.Y`` text."""
    t = tenths_col.cast("bigint")
    return F.concat(_idiv(t, F.lit(10)).cast("string"), F.lit("."),
                    F.pmod(t, F.lit(10)).cast("string"))


def json_field(c: str | Column, ddl: str, name: str) -> Column:
    """One typed field of a JSON text column (``from_json`` with a DDL schema)."""
    return F.from_json(col_of(c), ddl)[name]
