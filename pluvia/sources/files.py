"""File sources and sinks: raw payloads, landing, clean CSV, quality reports.

Reads use explicit schemas and fail on malformed input; a run's output is the folder of
its run date, overwritten as a whole, so that a rerun without rows leaves none behind.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvia import schemas as SC

RUN_DATE = "run_date"
_RUN_FOLDER = r"(\d{4})/(\d{2})/(\d{2})/[^/]*$"

# Texts that a CSV cell may hold for a missing value.
MISSING_TEXTS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
                 "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def run_folder(root: str, run_date) -> str:
    return os.path.join(root, f"{RUN_DATE}={_iso(run_date)}")


def _iso(run_date) -> str:
    return run_date if isinstance(run_date, str) else run_date.isoformat()


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, in whatever file system its scheme (or default) names."""
    fs, p = _fs(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder (none if there is no folder)."""
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes under a path."""
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength()


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def stage(df: DataFrame, root: str, by: tuple[str, ...] = ()) -> tuple[DataFrame, str]:
    """``df`` written once under ``root`` (in a folder readers of ``root`` skip), partitioned
    ``by`` columns if it is read a part at a time."""
    path = os.path.join(root, "_staging", uuid.uuid4().hex[:12])
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _read_or_empty(read, spark: SparkSession, schema: T.StructType) -> DataFrame:
    """What ``read`` gives, or no rows where the folder does not exist (yet)."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


# --- S2 / S4: raw payload -------------------------------------------------

def run_date_of(path: Column) -> Column:
    """The run date in a file's ``YYYY/MM/DD`` folder."""
    return F.to_date(F.concat_ws("-", *[F.regexp_extract(path, _RUN_FOLDER, i) for i in (1, 2, 3)]))


def with_run_date(df: DataFrame) -> DataFrame:
    """The run date of each file's ``YYYY/MM/DD`` folder as a column."""
    return df.withColumn(RUN_DATE, run_date_of(F.col("_metadata.file_path")))


def read_raw(spark: SparkSession, path: str | list[str], run_date: bool = False) -> DataFrame:
    """Whole payloads (one JSON object a file, UTF-8), one row per file, explicit schema.

    A truncated or malformed document raises; a missing file raises; a blank file has no
    row.  Each file is read as one text and parsed from memory, where a number's exact text
    is at hand, so a file is one task: :func:`pluvia.sources.payload.read_responses` reads
    one large document with many.  ``run_date`` adds the date of the file's folder.
    """
    return parse_payloads(spark.read.text(path, wholetext=True), run_date)


def parse_payloads(files: DataFrame, run_date: bool = False) -> DataFrame:
    """Whole texts of files (``value``, batch or stream) as payloads."""
    files = with_run_date(files) if run_date else files
    parsed = F.from_json("value", SC.RAW_PAYLOAD, {"mode": "FAILFAST"})
    extra = [RUN_DATE] if run_date else []
    return (files.where(F.col("value").rlike(r"\S")).select(parsed.alias("payload"), *extra)
            .select("payload.*", *extra))


def city_responses(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``raw["data"]``: one row per entity response."""
    return raw.select(*keep, F.explode("data").alias("r")).select(*keep, "r.*")


def run_partition_path(spark: SparkSession, root: str, run_date, layout: str = "%Y/%m/%d",
                       file_name: str = "weather_raw.json") -> str:
    """File of one run date; raises when it does not exist (nothing to do)."""
    path = os.path.join(root, run_date.strftime(layout), file_name)
    if not exists(spark, path):
        raise FileNotFoundError(f"raw file not found: {path}")
    return path


# --- S3: landing -----------------------------------------------------------

def land_raw(responses: DataFrame, failed: DataFrame, out_dir: str, run_date,
             extracted_at: dt.datetime) -> dict[str, str]:
    """Land one run: per-entity responses, the failed entity names, a header of counts.

    Each part is the run's own folder, overwritten as a whole: a rerun replaces that run
    only, and one without failures leaves no failed name.  Failed names stay rows (never
    one array built in a single task).  ``extracted_at`` is the run's own timestamp.
    """
    out = {x: os.path.join(out_dir, x) for x in ("data", "failed", "header")}
    responses.write.mode("overwrite").json(run_folder(out["data"], run_date))
    failed.write.mode("overwrite").json(run_folder(out["failed"], run_date))
    tagged = (responses.select(F.lit(1).alias("ok"), F.lit(0).alias("bad"))
              .unionByName(failed.select(F.lit(0).alias("ok"), F.lit(1).alias("bad"))))
    header = tagged.agg(
        F.lit(extracted_at.isoformat()).alias("extraction_timestamp"),
        F.count(F.lit(1)).alias("total_cities_requested"),
        F.coalesce(F.sum("ok"), F.lit(0)).cast("bigint").alias("total_cities_successful"),
        F.coalesce(F.sum("bad"), F.lit(0)).cast("bigint").alias("total_cities_failed"))
    header.coalesce(1).write.mode("overwrite").json(run_folder(out["header"], run_date))
    return out


HEADER = T.StructType([f for f in SC.RAW_PAYLOAD.fields if f.name.startswith(("extraction", "total"))])
FAILED = T.StructType([T.StructField("name", T.StringType())])


def read_landed(spark: SparkSession, data_dir: str, run_date=None,
                schema: T.StructType = SC.CITY_RESPONSE) -> DataFrame:
    """Landed rows (JSON lines, splittable) with their run date, one run or all.

    ``schema``: per-entity responses by default; :data:`HEADER` and :data:`FAILED` for
    the other two parts.  A run date filter prunes to that folder; malformed lines
    raise; no folder gives no rows.
    """
    full = T.StructType(schema.fields + [T.StructField(RUN_DATE, T.DateType())])
    df = _read_or_empty(lambda: spark.read.schema(full).option("mode", "FAILFAST").json(data_dir),
                        spark, full)
    return df if run_date is None else df.where(F.col(RUN_DATE) == F.lit(run_date).cast("date"))


# --- S5 / S6 / S7: clean CSV ----------------------------------------------

# A quoted cell may hold a line feed, so a file is read by one task: files stay this small.
ROWS_PER_CSV = 500_000


def conform(df: DataFrame, schema=SC.CLEAN) -> DataFrame:
    """Project onto a fixed layout: field order and types, absent fields NULL."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None))
                       .cast(f.dataType).alias(f.name) for f in schema.fields])


def write_clean_csv(df: DataFrame, out_dir: str, run_date, schema=SC.CLEAN) -> str:
    """Clean rows as headed UTF-8 CSV in the run's folder, overwritten as a whole."""
    (conform(df, schema).write.mode("overwrite").option("header", True)
     .option("encoding", "UTF-8").option("maxRecordsPerFile", ROWS_PER_CSV).csv(run_folder(out_dir, run_date)))
    return out_dir


def read_clean_csv(spark: SparkSession, path: str, schema=SC.CLEAN) -> DataFrame:
    """Clean CSV, one run's folder or all of them, with the fixed schema.

    The usual texts for a missing value (:data:`MISSING_TEXTS`) are NULL.  A row with too
    few or too many cells and a cell that is not of its type raise.  No folder gives no rows.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    rows = _read_or_empty(
        lambda: (spark.read.schema(text).option("header", True).option("mode", "FAILFAST")
                 .option("multiLine", True).option("recursiveFileLookup", True).csv(path)), spark, text)
    return rows.select(*[F.when(~F.col(f.name).isin(*MISSING_TEXTS), F.col(f.name))
                         .cast(f.dataType).alias(f.name) for f in schema.fields])


def concat_runs(*frames: DataFrame) -> DataFrame:
    """Stack run outputs by column name; duplicates are kept, absent columns NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


# --- S8 / S9: quality reports ---------------------------------------------

def write_reports(reports: DataFrame, out_dir: str) -> str:
    """One JSON document per ``extraction_date`` partition, replaced on rerun."""
    (reports.repartition("extraction_date")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("extraction_date").json(out_dir))
    return out_dir


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """Report history with the fixed schema; no folder gives no report."""
    return _read_or_empty(lambda: spark.read.schema(SC.REPORT).option("mode", "FAILFAST").json(path),
                          spark, SC.REPORT)


def latest_report(reports: DataFrame) -> DataFrame:
    """The newest report (largest ``extraction_date``)."""
    return reports.orderBy(F.col("extraction_date").desc()).limit(1)
