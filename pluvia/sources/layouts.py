"""Table layouts for joins without a shuffle and for look-ups that read little.

Bucketed tables keep rows with equal keys in files of the same number, so joins and
aggregations on that key need no exchange.  Tables in space-filling order keep rows near
in (entity, date) in the same row groups, whose statistics and Bloom filters let a point
look-up skip the others.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS = 16  # of each coordinate in a space-filling order


def save_bucketed(df: DataFrame, name: str, key: Sequence[str], buckets: int, mode: str = "overwrite") -> DataFrame:
    """Save ``df`` as a catalog table of ``buckets`` buckets by ``key``, sorted inside.

    The rows are dealt by the bucket first, so a bucket is one file.  ``buckets`` is chosen
    for the table's final size (some 256 MB a bucket); tables that are joined have the same.
    """
    (df.repartition(buckets, *key).write.mode(mode).bucketBy(buckets, *key).sortBy(*key).saveAsTable(name))
    return df.sparkSession.table(name)


def replace_bucketed(spark: SparkSession, name: str, batch: DataFrame, key: Sequence[str], buckets: int) -> DataFrame:
    """Replace the stored rows whose key the batch carries by the batch's rows.

    The batch is saved with the table's own buckets, so finding the stored rows to keep
    moves none of them.  The result is written beside the table and swapped in by name;
    until then readers see the old one.
    """
    part = uuid.uuid4().hex[:8]
    staged = save_bucketed(batch, f"{name}_batch_{part}", key, buckets)
    merged = surviving(spark.table(name), staged, key).unionByName(staged)
    save_bucketed(merged, f"{name}_next_{part}", key, buckets)
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"ALTER TABLE {name}_next_{part} RENAME TO {name}")
    spark.sql(f"DROP TABLE {name}_batch_{part}")
    return spark.table(name)


def surviving(stored: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """Stored rows whose key the batch does not carry."""
    return stored.join(batch.select(*key).distinct(), list(key), "left_anti")


def coordinate(df: DataFrame, name: str, bits: int = BITS) -> Column:
    """A column as an integer of ``bits`` bits: numbers and dates by their place between the
    table's smallest and largest value (one aggregation, two values), texts by a hash."""
    kind = df.schema[name].dataType.typeName()
    if kind in ("string", "binary"):
        return F.pmod(F.xxhash64(name), F.lit(1 << bits))
    value = F.datediff(F.col(name).cast("date"), F.lit("1970-01-01").cast("date")) if kind.startswith(("date", "timestamp")) \
        else F.col(name)
    low, high = df.agg(F.min(value), F.max(value)).first()
    if low is None or low == high:
        return F.lit(0).cast("long")
    share = (value - F.lit(low)) / (F.lit(high) - F.lit(low))
    return F.coalesce(F.least(F.floor(share * (1 << bits)), F.lit((1 << bits) - 1)), F.lit(0)).cast("long")


def interleaved(coordinates: Sequence[Column], bits: int = BITS) -> Column:
    """The place in Z order: the coordinates' bits in turn, the highest first."""
    out = F.lit(0).cast("long")
    for b in range(bits):
        for i, c in enumerate(coordinates):
            bit = F.shiftright(c.cast("long"), b).bitwiseAND(F.lit(1).cast("long"))
            out = out.bitwiseOR(F.shiftleft(bit, b * len(coordinates) + len(coordinates) - 1 - i))
    return out


def write_for_look_ups(df: DataFrame, path: str, entity: str, date: str, bits: int = BITS,
                       row_group_bytes: int = 32 << 20, files: int | None = None, mode: str = "overwrite") -> str:
    """Write ``df`` in Z order of (entity, date), with a Bloom filter on the entity in every
    row group.  Ranges of that order are the files, so a hot entity spreads over several."""
    z = interleaved([coordinate(df, entity, bits), coordinate(df, date, bits)], bits)
    rows = df.withColumn("_z", z)
    ordered = rows.repartitionByRange(files, "_z") if files else rows.repartitionByRange("_z")
    (ordered.sortWithinPartitions("_z", entity, date).drop("_z").write.mode(mode)
     .option(f"parquet.bloom.filter.enabled#{entity}", "true").option("parquet.block.size", str(row_group_bytes))
     .parquet(path))
    return path


def look_up(table: DataFrame, entity: str, value, date: str, first, last) -> DataFrame:
    """One entity's rows of a range of dates, by literals that reach the row groups."""
    return table.where((F.col(entity) == F.lit(value)) & F.col(date).between(F.lit(first), F.lit(last)))
