"""availableNow ingest: payload files -> checked, cleaned, loaded."""

import datetime as dt
import os

from pluvia.sources import warehouse as WH
from pluvia.streaming.ingest import start_ingest
from tests.test_nested import write_payload


def test_available_now_ingest(spark, tmp):
    raw = write_payload(tmp, "2024/01/17")
    write_payload(tmp, "2024/01/18")  # the next run re-delivers the same days
    table, reports = os.path.join(tmp, "fact"), os.path.join(tmp, "quality")
    ckpt = os.path.join(tmp, "ckpt")
    q = start_ingest(spark, raw, table, reports, checkpoint=ckpt,
                     loaded_at=dt.datetime(2024, 1, 18, 6))
    q.awaitTermination(300)
    # Both runs in one pass: overlapping days replaced, not duplicated.
    assert WH.read_table(spark, table).count() == 5
    # One report per run date, each judged against its own date.
    from pluvia.sources.files import read_reports
    got = {r["extraction_date"]: r["total_rows"] for r in read_reports(spark, reports).collect()}
    assert got == {"2024-01-17": 5, "2024-01-18": 5}
    # Nothing new: a second run reads no file and changes nothing.
    q = start_ingest(spark, raw, table, reports, checkpoint=ckpt)
    q.awaitTermination(300)
    assert WH.read_table(spark, table).count() == 5


def test_older_run_that_arrives_late_changes_nothing(spark, tmp):
    table, reports, ckpt = (os.path.join(tmp, x) for x in ("fact", "quality", "ckpt"))
    for day in ("2024/01/18", "2024/01/17"):
        raw = write_payload(tmp, day)
        start_ingest(spark, raw, table, reports, checkpoint=ckpt).awaitTermination(300)
    from pluvia.streaming.ingest import FACT_RUNS
    runs = {str(r.run_date) for r in WH.read_table(spark, table, FACT_RUNS).collect()}
    assert runs == {"2024-01-18"} and WH.read_table(spark, table).count() == 5


def test_a_redelivered_day_gives_no_second_row(spark, tmp):
    """Within the horizon nothing repeats, also over restarts; beyond it the state is gone
    and what comes is late."""
    import datetime as dt
    import os

    from pluvia.streaming.dedupe import start_dedupe

    schema = "city string, date date, at timestamp, v int"
    src, out, state = (os.path.join(tmp, x) for x in ("in", "out", "state"))

    def deliver(run, rows):
        data = [(c, dt.date(2024, 1, d), dt.datetime(2024, 1, d), v) for c, d, v in rows]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(os.path.join(src, f"run={run}"))
        start_dedupe(spark, src, schema, out, state, ["city", "date"], "at", "5 days").awaitTermination()
        return sorted(((r.city, r.date.day, r.v) for r in spark.read.schema(schema).parquet(out).collect()), key=str)

    got = deliver(1, [("A", 1, 1), ("B", 1, 2), ("A", 1, 3), (None, 2, 4)])
    assert len(got) == 3 and ("B", 1, 2) in got
    again = deliver(2, [("A", 1, 9), ("B", 1, 9), (None, 2, 9), ("A", 3, 5)])
    assert again == sorted([*got, ("A", 3, 5)], key=str)
    # A restart without new files changes nothing.
    start_dedupe(spark, src, schema, out, state, ["city", "date"], "at", "5 days").awaitTermination()
    assert spark.read.schema(schema).parquet(out).count() == 4
    after = deliver(3, [("A", 20, 6)])
    assert len(after) == 5
    assert len(deliver(4, [("A", 20, 7), ("A", 1, 8), ("B", 21, 9)])) == 6  # day 1 is late by now
