"""The entity dimension (city list): read with a fixed schema, kept small."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pluvia import schemas as SC


def read_dimension(spark: SparkSession, path: str, fmt: str = "json",
                   schema=SC.CITY) -> DataFrame:
    """Read the entity list (JSON lines, CSV with header, or Parquet)."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)
