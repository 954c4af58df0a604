"""Duplicates across runs, as a stream with a keyed state that expires."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def first_deliveries(stream: DataFrame, key: Sequence[str], event_time: str, horizon: str) -> DataFrame:
    """The first row of every key, in a stream.

    A key is remembered until the watermark (the latest ``event_time`` seen, less
    ``horizon``) passes the time its state was given, so a redelivery within the horizon
    gives no second row and the state holds a horizon's keys.  Rows older than the
    watermark are late and dropped, as rows without a time are.  A null in the key is a value like others.
    """
    timed = stream.where(F.col(event_time).isNotNull())
    return timed.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark(list(key))


def start_dedupe(spark: SparkSession, in_dir: str, schema: T.StructType | str, out_dir: str, checkpoint: str,
                 key: Sequence[str], event_time: str, horizon: str, files_per_batch: int = 100) -> StreamingQuery:
    """Append the first deliveries among all files of ``in_dir`` not yet seen, then stop.

    The files seen, the state and the written files are tracked in ``checkpoint`` and the
    output's own log, so starting again after a loss neither repeats nor loses a row.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(in_dir)
    return (first_deliveries(stream, key, event_time, horizon).writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out_dir))
