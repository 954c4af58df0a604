"""Fields outside the fixed schema: whole records kept as VARIANT beside the fixed columns.

A payload gains fields over time.  The fixed columns are what the jobs read; the record
itself stays next to them as VARIANT, so a field that no schema names survives every copy
and is extracted later by a typed path.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvia import schemas as SC

RECORD = "record"


def with_record(df: DataFrame, json_col: str, name: str = RECORD) -> DataFrame:
    """``df`` with the JSON text of ``json_col`` as VARIANT (null stays null, text that is
    no JSON raises)."""
    return df.withColumn(name, F.parse_json(json_col))


def fields(paths: Mapping[str, tuple[str, str]], record: str = RECORD, strict: bool = False) -> list[Column]:
    """Columns of name -> (path, type), extracted from the record.

    A path that a record lacks is null.  A value that is not of the type is null, or
    raises with ``strict``.
    """
    get = F.variant_get if strict else F.try_variant_get
    return [get(F.col(record), path, kind).alias(name) for name, (path, kind) in paths.items()]


def schema_of(df: DataFrame, record: str = RECORD) -> str:
    """The merged schema of all records, from one aggregation."""
    return df.agg(F.schema_of_variant_agg(record)).first()[0]


def unknown_fields(df: DataFrame, known: Sequence[str], record: str = RECORD) -> DataFrame:
    """(field, kind, n): the records' top-level fields that are not among ``known``, the
    kinds of value they have, and in how many records."""
    # A record's top-level entries, one row each.
    spread = df.select(F.col(record)).lateralJoin(
        df.sparkSession.tvf.variant_explode(F.col(record).outer()))
    return (spread.where(F.col("key").isNotNull() & ~F.col("key").isin(*known))
            .groupBy(F.col("key").alias("field"), F.schema_of_variant("value").alias("kind"))
            .agg(F.count(F.lit(1)).alias("n")))


def read_open_responses(spark: SparkSession, path, **options) -> DataFrame:
    """The payload's responses with the fixed columns and the whole response as VARIANT."""
    from pluvia.sources import payload

    rows = payload.record_texts(spark, path, **options)
    parsed = F.when(F.col("record") != "null", F.from_json("record", SC.CITY_RESPONSE, {"mode": "FAILFAST"}))
    return rows.select(parsed.alias("r"), F.parse_json("record").alias(RECORD)).select("r.*", RECORD)
