"""Marts that follow the fact table by its touched partitions.

The daily mart and the partial measures of every (entity, label) are kept per partition of
the fact table.  A load that touches some partitions rewrites those of the marts, from
those of the facts, whether it appended rows or replaced them; the statistics are merged
from the partial measures, which are few however many facts there are.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvia import schemas as SC
from pluvia.operators import marts as M
from pluvia.sources import files as FS
from pluvia.sources import warehouse as WH

LABEL = "weather_description"


def mart_paths(root: str) -> dict[str, str]:
    return {n: os.path.join(root, n) for n in ("daily_summary", "stats_partials")}


def _facts(spark: SparkSession, fact_root: str, grain: str, schema: T.StructType) -> DataFrame:
    part = WH.partition_column(grain)
    full = schema if part in schema.fieldNames() else T.StructType(
        schema.fields + [T.StructField(part, T.StringType())])
    return spark.read.schema(full).parquet(fact_root)


def _within(part: str, values: Sequence, grain: str):
    """Literal partition values, which prune the scan."""
    values = [v.isoformat() if isinstance(v, dt.date) else v for v in values]
    literals = [F.lit(v).cast("date") if grain == "day" else F.lit(v) for v in values]
    return F.col(part).isin(*literals)


def partials_of(daily: DataFrame, part: str, keys: Sequence[str] = tuple(M.CITY_KEYS), label: str = LABEL,
                measures: M.StatsColumns | None = None) -> DataFrame:
    """Partial measures of each (partition, entity, label)."""
    return daily.groupBy(part, *keys, label).agg(
        *M.partial_measures(measures or M.StatsColumns()), F.max("loaded_at").alias("built_from"))


def refresh(spark: SparkSession, fact_root: str, mart_root: str, partitions: Sequence, grain: str = "day",
            keys: Sequence[str] = tuple(M.CITY_KEYS), schema: T.StructType = SC.FACT) -> None:
    """Rewrite both marts' ``partitions`` (values of the partition column) from the facts.

    Only these partitions are read and written; running it again changes nothing, so a
    run that was lost between load and refresh is made good by the next one (see
    :func:`stale_partitions`).  A partition without facts has none in the marts.
    """
    if not partitions:
        return
    part, p = WH.partition_column(grain), mart_paths(mart_root)
    facts = _facts(spark, fact_root, grain, schema).where(_within(part, partitions, grain))
    extra = ["loaded_at"] if part == "date" else ["loaded_at", part]
    daily = M.daily_summary(M.staging(facts, [c for c in extra if c not in M.STAGING_COLUMNS]), extra)
    present = {str(r[0]) for r in daily.select(part).distinct().collect()}
    for path in p.values():
        for value in {str(v) for v in partitions} - present:
            FS.remove(spark, os.path.join(path, f"{part}={value}"))
    _replace(daily, p["daily_summary"], part)
    stored = _stored(spark, p["daily_summary"], daily.schema).where(_within(part, partitions, grain))
    _replace(partials_of(stored, part, keys), p["stats_partials"], part)


def _replace(df: DataFrame, path: str, part: str) -> None:
    """Overwrite the folders of the partitions that ``df`` has rows of."""
    (df.repartitionByRange(part, *[c for c in ("country_code", "city_name") if c in df.columns])
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path))


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def load_and_refresh(df: DataFrame, fact_root: str, mart_root: str, mode: str = "replace_partitions",
                     grain: str = "day", **options) -> dict:
    """Load a batch and bring the marts' touched partitions up to date; the load's metrics,
    and the touched partitions under ``partitions``."""
    metrics = WH.load(df, fact_root, mode, grain=grain, **options)
    touched = metrics["partitions"]
    refresh(df.sparkSession, fact_root, mart_root, touched, grain, schema=options.get("schema", SC.FACT))
    return metrics


def partials(spark: SparkSession, mart_root: str) -> DataFrame:
    return spark.read.parquet(mart_paths(mart_root)["stats_partials"])


def city_stats(spark: SparkSession, mart_root: str, keys: Sequence[str] = tuple(M.CITY_KEYS), label: str = LABEL,
               since=None, grain: str = "day", measures: M.StatsColumns | None = None) -> DataFrame:
    """The per-entity statistics, merged from the stored measures: what a full rebuild
    gives.  ``since`` (a partition value) keeps the partitions from there on."""
    m, rows = measures or M.StatsColumns(), partials(spark, mart_root)
    if since is not None:
        part = WH.partition_column(grain)
        rows = rows.where(F.col(part) >= F.lit(since).cast(rows.schema[part].dataType))
    level1 = M.merged(rows, [*keys, label], m)
    return M.stats_of_measures(level1, keys, [M.most_frequent(label)], m)


def stale_partitions(spark: SparkSession, fact_root: str, mart_root: str, grain: str = "day",
                     schema: T.StructType = SC.FACT) -> list:
    """Partitions whose facts are not those the marts were built from: another number of
    rows or another load.  Reads three columns of the facts; for use after a lost run."""
    part = WH.partition_column(grain)
    facts = (M.staging(_facts(spark, fact_root, grain, schema), [] if part == "date" else [part])
             .groupBy(part).agg(F.count(F.lit(1)).alias("n"), F.max("loaded_at").alias("at")))
    path = mart_paths(mart_root)["stats_partials"]
    if not FS.exists(spark, path):
        return sorted(str(r[0]) for r in facts.select(part).collect())
    built = partials(spark, mart_root).groupBy(F.col(part).cast(facts.schema[part].dataType).alias(part)).agg(
        F.sum("n").alias("n"), F.max("built_from").alias("at"))
    odd = facts.exceptAll(built).select(part).union(built.exceptAll(facts).select(part)).distinct()
    return sorted(str(r[0]) for r in odd.collect())
