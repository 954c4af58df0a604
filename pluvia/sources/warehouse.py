"""The date-partitioned fact table: create, enforce schema, load, metrics.

Parquet partitioned by ``date`` (or a coarser grain of it) and clustered (sorted inside
files) by ``country_code, city_name`` so Parquet min/max statistics skip row groups for
entity filters and the partition column prunes date filters.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvia import schemas as SC
from pluvia.session import app_id
from pluvia.sources import files as FS

PARTITION = "date"
CLUSTER = ("country_code", "city_name")


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def ensure_table(spark: SparkSession, root: str, schema: T.StructType = SC.FACT,
                 grain: str = "day", name: str | None = None) -> str:
    """Create the partitioned table at ``root`` unless it exists.

    ``name`` (``database.table``) also registers it in the catalog of the session.
    """
    empty = _with_partition(spark.createDataFrame([], schema), grain)
    empty.write.mode("ignore").partitionBy(partition_column(grain)).parquet(root)
    if name:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in empty.schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
                  f"PARTITIONED BY (`{partition_column(grain)}`) LOCATION '{root}'")
    return root


def refresh_table(spark: SparkSession, name: str) -> DataFrame:
    """The catalog's table after a load: new partition folders registered."""
    spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def _required(c: Column, name: str) -> Column:
    return F.when(c.isNull(), F.raise_error(F.lit(f"required field {name} is NULL"))).otherwise(c)


def enforce_schema(df: DataFrame, schema: T.StructType = SC.FACT) -> DataFrame:
    """Project onto ``schema``: field order, types, absent fields NULL.

    Non-nullable (REQUIRED) fields raise on NULL instead of loading it.
    """
    cols = []
    for f in schema.fields:
        c = F.col(f.name).cast(f.dataType) if f.name in df.columns \
            else F.lit(None).cast(f.dataType)
        if not f.nullable:
            c = _required(c, f.name)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _clustered(df: DataFrame, partition: str, cluster: Sequence[str]) -> DataFrame:
    """Range-partition by (partition, cluster, row hash), sorted inside tasks.

    The row hash as the last range key lets a single hot date (or entity)
    spread over several tasks instead of one.
    """
    keys = [partition, *[c for c in cluster if c in df.columns]]
    h = F.xxhash64(*[F.col(c) for c in df.columns])
    return (df.withColumn("_h", h).repartitionByRange(*keys, "_h")
            .sortWithinPartitions(*keys).drop("_h"))


GRAINS = {"day": None, "month": "yyyy-MM", "year": "yyyy"}


def partition_column(grain: str, date: str = PARTITION) -> str:
    return date if GRAINS[grain] is None else f"{date}_{grain}"


def _partition_value(grain: str, date: Column) -> Column:
    return date if GRAINS[grain] is None else F.date_format(date, GRAINS[grain])


def _with_partition(df: DataFrame, grain: str, date: str = PARTITION) -> DataFrame:
    return df if GRAINS[grain] is None else df.withColumn(
        partition_column(grain, date), _partition_value(grain, F.col(date)))


def stored_between(spark: SparkSession, root: str, schema: T.StructType, grain: str,
                   first: dt.date, last: dt.date) -> DataFrame:
    """The table's rows in the partitions from ``first``'s to ``last``'s, by a literal
    range on the partition column, which the scan prunes at every grain."""
    part = partition_column(grain)
    full = schema if GRAINS[grain] is None else T.StructType(
        schema.fields + [T.StructField(part, T.StringType())])
    lo, hi = (_partition_value(grain, F.lit(d).cast("date")) for d in (first, last))
    return spark.read.schema(full).parquet(root).where(F.col(part).between(lo, hi))


def load(df: DataFrame, root: str, mode: str = "append", loaded_at: dt.datetime | None = None,
         key: Sequence[str] = ("city_name", "date"), grain: str = "day",
         cluster: Sequence[str] = CLUSTER, schema: T.StructType = SC.FACT,
         version: str | None = None) -> dict:
    """Load a batch; returns ``rows_loaded``, ``table_total_rows``, ``job_id`` and the
    values of the ``partitions`` it touched.

    ``grain``: folder per ``day`` (at scale) or per ``month``/``year`` when a
    day holds few rows.  ``mode="append"`` adds rows (a re-delivered day is
    duplicated, as a plain append does).  ``mode="replace_partitions"``
    rewrites only the partitions the batch touches: stored rows there whose
    key the batch does not carry are kept, the rest are replaced by the
    batch's rows.  With ``version`` (a column of ``schema``, such as a run date) the
    larger version of a key wins whatever the order of loading; at a tie the batch does.

    The batch is evaluated once, into a staging folder under the table; in replacement the
    merged partitions are staged as well, since a job cannot overwrite what it reads.
    """
    spark = df.sparkSession
    loaded_at = loaded_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    part = partition_column(grain)
    # Through text so the instant reads back the same in any session time zone.
    ts = F.lit(loaded_at.isoformat(sep=" ")).cast("timestamp")
    batch = _with_partition(enforce_schema(df.withColumn("loaded_at", ts), schema), grain)
    ensure_table(spark, root, schema, grain)
    staged = []
    if mode not in ("append", "replace_partitions"):
        raise ValueError(f"unknown load mode {mode!r}")
    # The write samples its input for its ranges, so the batch is evaluated before it.
    observed, path = FS.stage(batch, root)
    staged.append(path)
    # One row for each partition the batch touches.
    sizes = observed.groupBy(part).agg(F.count(F.lit(1)).alias("n"), F.min(PARTITION).alias("first"),
                                       F.max(PARTITION).alias("last")).collect()
    if not sizes:
        FS.remove(spark, path)
        return {"rows_loaded": 0, "table_total_rows": read_table(spark, root, schema).count(),
                "job_id": f"{app_id(spark)}-empty", "partitions": []}
    if mode == "append":
        merged, write_mode = observed, "append"
    else:
        first, last = min(r["first"] for r in sizes), max(r["last"] for r in sizes)
        touched = stored_between(spark, root, schema, grain, first, last).join(
            observed.select(part).distinct(), part, "left_semi").select(observed.columns)
        if version is None:
            kept = touched.join(observed.select(*key).distinct(), list(key), "left_anti")
            merged = observed.unionByName(kept.select(observed.columns))
        else:
            both = observed.withColumn("_new", F.lit(1)).unionByName(touched.withColumn("_new", F.lit(0)))
            ranked = both.withColumn("_rank", F.struct(version, "_new"))
            merged = latest_delivery(ranked, key, "_rank").drop("_rank", "_new")
        merged, path = FS.stage(merged, root)
        staged.append(path)
        write_mode = "overwrite"
    job = f"load-{uuid.uuid4().hex[:8]}"
    (_clustered(merged, part, cluster).write.mode(write_mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy(part).parquet(root))
    for path in staged:
        FS.remove(spark, path)
    total = read_table(spark, root, schema).count()
    return {"rows_loaded": sum(r["n"] for r in sizes), "table_total_rows": int(total),
            "job_id": f"{app_id(spark)}-{job}", "partitions": sorted(str(r[0]) for r in sizes)}


def latest_delivery(df: DataFrame, key: Sequence[str], run_col: str) -> DataFrame:
    """Rows of the latest ``run_col`` per key: later runs replace earlier ones.

    A partial aggregation finds each key's latest run and an equi-join keeps
    its rows, so no window sorts a hot key (AQE splits a skewed join side).  NULL keys
    compare equal and are kept, for the load to refuse.
    """
    latest = df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in key]).agg(F.max(run_col).alias("_latest_run"))
    same = F.lit(True)
    for k in key:
        same = same & df[k].eqNullSafe(latest[f"_key_{k}"])
    joined = df.join(latest, same & df[run_col].eqNullSafe(latest["_latest_run"]))
    return joined.select(*[df[c] for c in df.columns])


def read_table(spark: SparkSession, root: str, schema: T.StructType = SC.FACT) -> DataFrame:
    """The table with its fixed schema (a coarser partition column is dropped)."""
    return spark.read.schema(schema).parquet(root).select(*schema.fieldNames())


def latest_loaded_date(spark: SparkSession, root: str, grain: str = "day") -> dt.date | None:
    """The table's latest date: the newest partition folder, by the folder listing alone
    at grain ``day``, else the maximum inside that one partition."""
    part = partition_column(grain)
    values = sorted(n.split("=", 1)[1] for n in FS.children(spark, root) if n.startswith(f"{part}="))
    if not values:
        return None
    if grain == "day":
        return dt.date.fromisoformat(values[-1])
    full = T.StructType(SC.FACT.fields + [T.StructField(part, T.StringType())])
    newest = spark.read.schema(full).parquet(root).where(F.col(part) == values[-1])
    return newest.agg(F.max(PARTITION)).first()[0]


def new_table_path(base: str, name: str = "fact_weather") -> str:
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:8]}")
