"""Data-quality checks and the per-batch quality report.

Every check yields (name, passed, detail, affected_rows).  The fused
:func:`run_all_checks` computes all seven in one pass: a partial
aggregation by (batch, key) — which also gives the duplicate counts — and a
second aggregation by batch.  No window, no join, no collect: a batch of any
size, or one hot key holding a third of the rows, is combined map-side.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvia import presets as P
from pluvia.functions import scalars as S


@dataclass(frozen=True)
class QualitySpec:
    key: Sequence[str] = tuple(P.KEY)
    date: str = "date"
    hi: str = "temperature_max"
    lo: str = "temperature_min"
    precip: str = "precipitation_sum"
    rules: dict = field(default_factory=lambda: P.RULES)
    # Optional extra checks (name, column, lo, hi) appended after the seven;
    # off by default, as in the source job.
    extra_ranges: Sequence[tuple] = ()


WEATHER = QualitySpec()


def _lit_date(as_of) -> Column:
    """``as_of`` as a DATE: a literal, or a column (e.g. each batch's run date)."""
    if isinstance(as_of, Column):
        return as_of.cast("date")
    return F.lit(as_of if isinstance(as_of, str) else as_of.isoformat()).cast("date")


def _check(name: str, passed: Column, detail: Column, affected: Column) -> Column:
    return F.struct(F.lit(name).alias("name"), passed.alias("passed"),
                    detail.alias("detail"), affected.cast("bigint").alias("affected_rows"))


def _pick(passed: Column, bad: str, ok: str) -> Column:
    return F.when(passed, F.lit(ok)).otherwise(F.lit(bad))


def _missing_sql(c: str, dtype: str) -> str:
    """Missing in the pandas sense: NULL, or NaN for floating columns."""
    q = f"`{c}`"
    return f"({q} IS NULL OR isnan({q}))" if dtype in ("double", "float") else f"({q} IS NULL)"


def _null_cells(df: DataFrame, columns: Sequence[str]) -> Column:
    """Missing cells of a row, as one SQL expression (one call, however wide)."""
    if not columns:
        return F.lit(0)
    types = dict(df.dtypes)
    return F.expr(" + ".join(f"CAST({_missing_sql(c, types[c])} AS INT)" for c in columns))


# ---------------------------------------------------------------------------
# Row predicates: NULL and NaN never fail a comparison, like pandas (Spark
# alone orders NaN above every number, so it is folded into NULL first).
# ---------------------------------------------------------------------------

_v = S.nan_to_null


def temperature_out_of_range(spec: QualitySpec = WEATHER) -> Column:
    lo, hi = spec.rules["temperature"]["min"], spec.rules["temperature"]["max"]
    a, b = _v(spec.hi), _v(spec.lo)
    return (a < lo) | (a > hi) | (b < lo) | (b > hi)


def precipitation_out_of_range(spec: QualitySpec = WEATHER) -> Column:
    hi = spec.rules["precipitation"]["max"]
    p = _v(spec.precip)
    return (p < 0) | (p > hi)


def future_date(as_of, spec: QualitySpec = WEATHER) -> Column:
    """Dates from ``as_of + 1`` on; ``as_of`` itself is fine."""
    return F.col(spec.date).cast("date") > _lit_date(as_of)


def range_violation(c: str, lo, hi) -> Column:
    """``c`` outside ``[lo, hi]``; NULL never fails."""
    return (_v(c) < lo) | (_v(c) > hi)


def range_check(name: str, c: str, lo, hi, bad_rows: Column) -> Column:
    return _count_check(name, bad_rows, P.TEXT_RANGE_BAD.format(col=c, lo=_fmt(lo), hi=_fmt(hi)),
                        P.TEXT_RANGE_OK.format(col=c))


def inconsistent(spec: QualitySpec = WEATHER) -> Column:
    return _v(spec.lo) > _v(spec.hi)


# ---------------------------------------------------------------------------
# Check structs from aggregated counts.
# ---------------------------------------------------------------------------

def _fmt(v) -> str:
    return str(v)


def required_fields_check(df: DataFrame, required: Sequence[str], n_rows: Column) -> Column:
    """Presence of columns (a schema test, decided on the driver)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        return _check("required_fields", F.lit(False),
                      F.lit(P.TEXT_REQUIRED_MISSING.format(missing=missing)), n_rows)
    return _check("required_fields", F.lit(True), F.lit(P.TEXT_REQUIRED_OK), F.lit(0))


def _count_check(name: str, bad_rows: Column, bad_text: str, ok_text: str) -> Column:
    passed = bad_rows == 0
    return _check(name, passed, _pick(passed, bad_text, ok_text), bad_rows)


def temperature_range_check(bad_rows: Column, spec: QualitySpec = WEATHER) -> Column:
    t = spec.rules["temperature"]
    return _count_check("temperature_range", bad_rows,
                        P.TEXT_TEMPERATURE_BAD.format(lo=_fmt(t["min"]), hi=_fmt(t["max"])),
                        P.TEXT_TEMPERATURE_OK)


def precipitation_check(bad_rows: Column, spec: QualitySpec = WEATHER) -> Column:
    return _count_check("precipitation_range", bad_rows,
                        P.TEXT_PRECIPITATION_BAD.format(hi=_fmt(spec.rules["precipitation"]["max"])),
                        P.TEXT_PRECIPITATION_OK)


def future_dates_check(bad_rows: Column) -> Column:
    return _count_check("no_future_dates", bad_rows, P.TEXT_FUTURE_BAD, P.TEXT_FUTURE_OK)


def duplicates_check(dup_rows: Column) -> Column:
    passed = dup_rows == 0
    detail = F.when(passed, F.lit(P.TEXT_DUPLICATES_OK)).otherwise(
        F.concat(dup_rows.cast("string"), F.lit(P.TEXT_DUPLICATES_BAD.format(n=""))))
    return _check("no_duplicates", passed, detail, dup_rows)


def null_pct_tenths(null_cells: Column, cells: Column) -> Column:
    """Null share in tenths of a percent, exact half-to-even (0 when empty)."""
    return F.coalesce(S.ratio_round_half_even(null_cells * 1000, cells), F.lit(0).cast("bigint"))


def null_percentage_check(null_cells: Column, cells: Column,
                          spec: QualitySpec = WEATHER) -> Column:
    max_pct = spec.rules["thresholds"]["max_null_percentage"]
    passed = (cells == 0) | (null_cells.cast("double") * 100.0 <= F.lit(float(max_pct)) * cells)
    head, tail = P.TEXT_NULLS.split("{pct}")
    detail = F.concat(F.lit(head), S.fixed_one_decimal(null_pct_tenths(null_cells, cells)),
                      F.lit(tail.format(max_pct=_fmt(max_pct))))
    return _check("null_percentage", passed, detail, null_cells)


def consistency_check(bad_rows: Column) -> Column:
    return _count_check("temperature_consistency", bad_rows,
                        P.TEXT_CONSISTENCY_BAD, P.TEXT_CONSISTENCY_OK)


# ---------------------------------------------------------------------------
# Fused pass.
# ---------------------------------------------------------------------------

def batch_counts(df: DataFrame, as_of, spec: QualitySpec = WEATHER,
                 batch: Sequence[str] = (), columns: Sequence[str] | None = None,
                 duplicates: bool = True) -> DataFrame:
    """All counts the seven checks need, one row per batch.

    ``columns``: the frame's cells for the null share (default: every
    non-batch column).  With ``duplicates`` the rows are first combined per
    (batch, key) — which gives the duplicate counts in the same pass —
    otherwise one aggregation by batch suffices (no shuffle by key).
    """
    batch = list(batch)
    columns = [c for c in (columns if columns is not None else df.columns) if c not in batch]
    present = set(df.columns)

    def count_if(pred_fn, needed):
        if not set(needed) <= present:
            return F.lit(0).cast("bigint")
        return F.count_if(pred_fn())

    extras = [count_if((lambda c=c, lo=lo, hi=hi: range_violation(c, lo, hi)), [c])
              .alias(f"bad_x{i}") for i, (_, c, lo, hi) in enumerate(spec.extra_ranges)]
    counts = [
        *extras,
        F.count(F.lit(1)).alias("n"),
        F.sum(_null_cells(df, columns)).alias("nulls"),
        count_if(lambda: temperature_out_of_range(spec), [spec.hi, spec.lo]).alias("bad_t"),
        count_if(lambda: precipitation_out_of_range(spec), [spec.precip]).alias("bad_p"),
        count_if(lambda: future_date(as_of, spec), [spec.date]).alias("future"),
        count_if(lambda: inconsistent(spec), [spec.hi, spec.lo]).alias("bad_c"),
    ]

    def total(c):
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    if duplicates:
        # Partial aggregation per (batch, key), then per batch: hot keys
        # are combined map-side and the key counts give the duplicates.
        level1 = df.groupBy(*batch, *spec.key).agg(*counts)
        dup = [total(F.when(F.col("n") > 1, F.col("n"))).alias("duplicate_rows"),
               total(F.col("n") - 1).alias("duplicate_extra")]
        out = level1.groupBy(*batch).agg(
            total("n").alias("total_rows"), total("nulls").alias("null_cells"),
            total("bad_t").alias("bad_temperature"), total("bad_p").alias("bad_precipitation"),
            total("future").alias("future_rows"), total("bad_c").alias("inconsistent_rows"),
            *dup, *[total(f"bad_x{i}").alias(f"bad_x{i}") for i in range(len(spec.extra_ranges))])
    else:
        # Count-only checks: one aggregation by batch, no shuffle by key.
        out = df.groupBy(*batch).agg(*counts).select(
            *batch, F.col("n").cast("bigint").alias("total_rows"),
            F.coalesce(F.col("nulls"), F.lit(0)).cast("bigint").alias("null_cells"),
            F.col("bad_t").cast("bigint").alias("bad_temperature"),
            F.col("bad_p").cast("bigint").alias("bad_precipitation"),
            F.col("future").cast("bigint").alias("future_rows"),
            F.col("bad_c").cast("bigint").alias("inconsistent_rows"),
            F.lit(None).cast("bigint").alias("duplicate_rows"),
            F.lit(None).cast("bigint").alias("duplicate_extra"),
            *[F.col(f"bad_x{i}").cast("bigint") for i in range(len(spec.extra_ranges))])
    return out.withColumn("cells", F.col("total_rows") * F.lit(len(columns)))


def _checks_array(df: DataFrame, spec: QualitySpec) -> Column:
    return F.array(
        required_fields_check(df, spec.rules["required_fields"], F.col("total_rows")),
        temperature_range_check(F.col("bad_temperature"), spec),
        precipitation_check(F.col("bad_precipitation"), spec),
        future_dates_check(F.col("future_rows")),
        duplicates_check(F.col("duplicate_rows")),
        null_percentage_check(F.col("null_cells"), F.col("cells"), spec),
        consistency_check(F.col("inconsistent_rows")),
        *[range_check(name, c, lo, hi, F.col(f"bad_x{i}"))
          for i, (name, c, lo, hi) in enumerate(spec.extra_ranges)],
    )


def quality_report(df: DataFrame, as_of, spec: QualitySpec = WEATHER,
                   batch: Sequence[str] = (), columns: Sequence[str] | None = None,
                   batch_label: str | None = None) -> DataFrame:
    """One report row per batch (the report document as a nested row).

    ``batch_label``: the batch column that becomes ``extraction_date``;
    without one the label is ``as_of``.
    """
    counts = batch_counts(df, as_of, spec, batch, columns)
    checks = _checks_array(df, spec)
    failed = F.filter(checks, lambda c: ~c["passed"])
    invalid = F.coalesce(F.array_max(F.transform(failed, lambda c: c["affected_rows"])),
                         F.lit(0).cast("bigint"))
    if batch_label:
        label = F.col(batch_label).cast("string")
    elif isinstance(as_of, Column):
        raise ValueError("a column as_of needs a batch_label")
    else:
        label = F.lit(as_of if isinstance(as_of, str) else as_of.isoformat())
    pct_hundredths = F.coalesce(
        S.ratio_round_half_even(F.col("null_cells") * 10000, F.col("cells")),
        F.lit(0).cast("bigint"))
    return counts.select(
        *[c for c in batch if c != batch_label],
        label.alias("extraction_date"),
        F.col("total_rows"),
        (F.col("total_rows") - invalid).alias("valid_rows"),
        invalid.alias("invalid_rows"),
        (pct_hundredths / F.lit(100.0)).alias("null_percentage"),
        F.col("duplicate_extra").alias("duplicate_count"),
        F.forall(checks, lambda c: c["passed"]).alias("overall_passed"),
        checks.alias("checks"),
    )


def run_all_checks(df: DataFrame, as_of, spec: QualitySpec = WEATHER,
                   batch: Sequence[str] = (), columns: Sequence[str] | None = None,
                   duplicates: bool = True) -> DataFrame:
    """The seven checks in run order, one row per (batch, check)."""
    counts = batch_counts(df, as_of, spec, batch, columns, duplicates)
    return (counts.select(*batch, F.posexplode(_checks_array(df, spec))
                          .alias("check_order", "c"))
            .select(*batch, (F.col("check_order") + 1).alias("check_order"), "c.*"))


def single_check(df: DataFrame, name: str, as_of, spec: QualitySpec = WEATHER,
                 batch: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """One named check; the shuffle by key runs only for the duplicate check."""
    return run_all_checks(df, as_of, spec, batch, columns, duplicates=(name == "no_duplicates")) \
        .where(F.col("name") == name).drop("check_order")


def not_null_tests(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Model-style not-null tests: one row per column, from one aggregation."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(columns)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"),
                               F.col(f"_{i}").cast("bigint").alias("null_rows"))
                      for i, c in enumerate(columns)])
    return (agg.select(F.inline(pairs))
            .withColumn("passed", F.col("null_rows") == 0))


def checks_of_reports(reports: DataFrame) -> DataFrame:
    """Explode a report table into its check list, with display labels."""
    return (reports.select("extraction_date", F.posexplode("checks").alias("pos", "c"))
            .select("extraction_date", (F.col("pos") + 1).alias("check_order"),
                    F.col("c.name").alias("name"), S.title_label(F.col("c.name")).alias("label"),
                    F.col("c.passed").alias("passed"), F.col("c.detail").alias("detail"),
                    F.col("c.affected_rows").alias("affected_rows")))


def quality_pct(valid: Column, total: Column) -> Column:
    """valid / total * 100 to one decimal (half to even); 0 when total is 0."""
    return F.when(total == 0, F.lit(0.0)).otherwise(
        S.safe_percentage(valid, total, 1, half_even=True))



def report_status(history: DataFrame, row_count: DataFrame) -> DataFrame:
    """Run status from the newest report; with no report: passed, all rows valid.

    ``row_count``: one row with column ``n`` (rows of the current data).
    """
    latest = history.select("extraction_date", F.col("overall_passed").alias("run_ok"),
                            "valid_rows", "total_rows", F.lit(0).alias("_p"))
    fallback = row_count.select(F.lit(None).cast("string").alias("extraction_date"),
                                F.lit(True).alias("run_ok"),
                                F.col("n").cast("bigint").alias("valid_rows"),
                                F.col("n").cast("bigint").alias("total_rows"), F.lit(1).alias("_p"))
    pick = latest.unionByName(fallback).orderBy("_p", F.col("extraction_date").desc()).limit(1)
    return pick.select("extraction_date", "run_ok", "valid_rows", "total_rows",
                       quality_pct(F.col("valid_rows"), F.col("total_rows")).alias("quality_pct"))
