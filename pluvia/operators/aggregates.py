"""Aggregation operators: mode (exact and approximate), duplicates, run summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def most_frequent(df: DataFrame, keys: Sequence[str], value: str,
                  alias: str | None = None) -> DataFrame:
    """Most frequent ``value`` per group, exact and deterministic.

    Ties go to the smallest value; NULL counts as a value.  Two partial
    aggregations: (keys, value) counts are combined map-side, so a hot group
    ships one row per map task; the pick is ``min(struct(-count, value))``.
    """
    alias = alias or f"most_common_{value}"
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return (counts.groupBy(*keys)
            .agg(F.min(F.struct((-F.col("_n")).alias("neg_n"), F.col(value).alias("v")))
                 .alias("_top"))
            .select(*keys, F.col("_top.v").alias(alias)))


def most_frequent_approx(df: DataFrame, keys: Sequence[str], value: str,
                         alias: str | None = None, max_items: int = 10000) -> DataFrame:
    """Approximate most frequent value, with its estimated count as ``{alias}_count``.

    ``max_items`` is the number of labels the ``approx_top_k`` sketch tracks in a group:
    up to so many distinct labels the count is exact, beyond them it is an estimate.
    :func:`most_frequent` is the exact operator.
    """
    alias = alias or f"most_common_{value}"
    top = F.col("_top")[0]
    return (df.groupBy(*keys)
            .agg(F.call_function("approx_top_k", F.col(value), F.lit(1), F.lit(max_items))
                 .alias("_top"))
            .select(*keys, top["item"].alias(alias), top["count"].alias(f"{alias}_count")))


def duplicate_counts(df: DataFrame, key: Sequence[str],
                     batch: Sequence[str] = ()) -> DataFrame:
    """Rows sharing ``key``: all members and all but the first, per batch.

    NULL keys compare equal, as in a pandas ``duplicated``.  Partial
    aggregation first, so no window sorts a hot key.
    """
    per_key = df.groupBy(*batch, *key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.groupBy(*batch).agg(
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).cast("bigint")
        .alias("duplicate_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicate_extra"),
    )


def duplicate_members(df: DataFrame, key: Sequence[str], batch: Sequence[str] = ()) -> DataFrame:
    """The rows themselves that share ``key`` with another row (of their batch), all columns.

    Repeated keys are counted with a partial aggregation and joined back (NULL keys compare
    equal), so a key with very many rows is no group of one task: AQE may split its join.
    """
    keys = [*batch, *key]
    repeated = (df.groupBy(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)])
                .agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & df[k].eqNullSafe(repeated[f"_key_{i}"])
    return df.join(repeated, same, "left_semi")


def run_summary(requested: DataFrame, responses: DataFrame, on: Sequence[str],
                batch: Sequence[str] = ()) -> DataFrame:
    """Requested, successful and failed entity counts (per batch).

    A left join marks each requested entity as answered or not; the
    failed names themselves are the :func:`coverage_gap` rows.
    """
    answered = responses.select(*on).distinct().withColumn("_hit", F.lit(True))
    marked = requested.join(answered, list(on), "left")
    return marked.groupBy(*batch).agg(
        F.count(F.lit(1)).alias("total_requested"),
        F.count_if(F.col("_hit").isNotNull()).alias("total_successful"),
        F.count_if(F.col("_hit").isNull()).alias("total_failed"),
    )


# --- distinct entities over many windows ------------------------------------------

# log2 of a sketch's buckets; its relative standard error is 1.04 / sqrt(2 ** LG_BUCKETS).
LG_BUCKETS = 12


def relative_error(lg_buckets: int = LG_BUCKETS) -> float:
    """One standard error of an estimate, as a share of the true count."""
    return 1.04 / 2 ** (lg_buckets / 2)


def daily_sketches(df: DataFrame, key: str, date: str = "date", lg_buckets: int = LG_BUCKETS) -> DataFrame:
    """(date, sketch, n_rows): one mergeable sketch of the day's distinct keys, of at most
    2 ** ``lg_buckets`` bytes.  Days can be added and rewritten one by one."""
    return df.where(F.col(date).isNotNull()).groupBy(date).agg(
        F.hll_sketch_agg(F.col(key), F.lit(lg_buckets)).alias("sketch"), F.count(F.lit(1)).alias("n_rows"))


def distinct_in_windows(sketches: DataFrame, as_of, days: Sequence[int], date: str = "date") -> DataFrame:
    """(days, estimate): distinct keys of the last ``days`` days up to ``as_of``, for every
    window asked, from one pass over the day table; a window without a day counts 0."""
    end = F.lit(as_of).cast("date")
    asked = sketches.sparkSession.createDataFrame([(int(d),) for d in days], "days int")
    recent = sketches.where(F.col(date).between(F.date_sub(end, max(days) - 1), end)).select(
        "sketch", F.explode(F.filter(F.array(*[F.lit(int(d)) for d in days]),
                                     lambda d: F.col(date) > F.date_sub(end, d))).alias("days"))
    merged = recent.groupBy("days").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
    return asked.join(merged, "days", "left").select("days", F.coalesce("estimate", F.lit(0)).alias("estimate"))


def exact_in_windows(df: DataFrame, key: str, as_of, days: Sequence[int], date: str = "date") -> DataFrame:
    """(days, n): the exact counts.  A key's last day decides in which windows it is, so the
    rows are read once and each key is shuffled once, whatever number of windows."""
    end = F.lit(as_of).cast("date")
    asked = df.sparkSession.createDataFrame([(int(d),) for d in days], "days int")
    last = (df.where(F.col(date).between(F.date_sub(end, max(days) - 1), end) & F.col(key).isNotNull())
            .groupBy(key).agg(F.max(date).alias("_last")))
    inside = last.select(F.explode(F.filter(F.array(*[F.lit(int(d)) for d in days]),
                                            lambda d: F.col("_last") > F.date_sub(end, d))).alias("days"))
    counted = inside.groupBy("days").agg(F.count(F.lit(1)).alias("n"))
    return asked.join(counted, "days", "left").select("days", F.coalesce("n", F.lit(0)).alias("n"))
