"""Incremental ingest of landed raw payloads with Structured Streaming.

``trigger(availableNow=True)`` processes every payload file not yet seen (tracked in the
checkpoint) and stops.  Each micro-batch is flattened once, checked, cleaned and merged
into the fact table by run date, so that a repeated batch changes nothing and an older
run that arrives late never replaces a newer one's rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pluvia import schemas as SC
from pluvia.operators.clean import clean
from pluvia.operators.flatten import flatten_payload
from pluvia.operators.quality import quality_report
from pluvia.sources import files as FS
from pluvia.sources import warehouse as WH

# The fact row with the run that delivered it.
FACT_RUNS = T.StructType(SC.FACT.fields + [T.StructField(FS.RUN_DATE, T.DateType())])


def payload_stream(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Stream of whole payload documents (one per landed file) with the run
    date taken from each file's ``YYYY/MM/DD`` folder; a malformed one raises."""
    return FS.parse_payloads(spark.readStream.option("recursiveFileLookup", True).text(raw_dir, wholetext=True),
                             run_date=True)


def start_ingest(spark: SparkSession, raw_dir: str, table_root: str, report_dir: str,
                 checkpoint: str, grain: str = "day",
                 loaded_at: dt.datetime | None = None) -> StreamingQuery:
    """Run the ingest over all unseen payloads, then stop (availableNow).

    ``checkpoint``: the stream's own folder, the same one at every call.  Each run date
    found among the new files gets its own quality report (future dates judged against
    that run date), all in one aggregation.
    """
    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        flat = flatten_payload(FS.city_responses(batch, keep=(FS.RUN_DATE,)), keep=(FS.RUN_DATE,))
        rows, path = FS.stage(flat, table_root)
        report = quality_report(rows, F.col(FS.RUN_DATE), batch=[FS.RUN_DATE],
                                batch_label=FS.RUN_DATE)
        FS.write_reports(report, report_dir)
        # Several runs may arrive together: the latest run of a key is loaded.
        newest = WH.latest_delivery(clean(rows), ("city_name", "date"), FS.RUN_DATE)
        WH.load(newest, table_root, "replace_partitions", loaded_at=loaded_at, grain=grain,
                schema=FACT_RUNS, version=FS.RUN_DATE)
        FS.remove(spark, path)

    return (payload_stream(spark, raw_dir).writeStream.foreachBatch(per_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
