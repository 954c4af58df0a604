"""Nested ingest: parallel arrays to one row per (entity, position)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia import presets as P
from pluvia.functions import scalars as S


def flatten_parallel(df: DataFrame, struct_col: str, index_field: str,
                     fields: Mapping[str, str], keep: Sequence = (),
                     index_alias: str = "date", position_alias: str | None = None) -> DataFrame:
    """Element *i* of every array in ``struct_col`` becomes row *i*.

    The row count is the length of ``index_field``: longer arrays are cut,
    shorter or absent ones give NULL (``get`` never raises).  Rows whose
    struct or index array is missing produce nothing.  Pure generator +
    projection: no shuffle, so it scales with the input splits.
    """
    pos = position_alias or "_pos"
    base = df.where(F.col(struct_col).isNotNull() & F.col(f"{struct_col}.{index_field}").isNotNull())
    exploded = base.select(*keep, F.col(struct_col).alias("_s"),
                           F.posexplode(f"{struct_col}.{index_field}").alias(pos, index_alias))
    present = set(exploded.schema["_s"].dataType.fieldNames())
    values = [
        (F.get(F.col(f"_s.{src}"), F.col(pos)) if src in present else F.lit(None)).alias(dst)
        for src, dst in fields.items()
    ]
    out = exploded.select(*keep, index_alias, *values, pos)
    return out if position_alias else out.drop(pos)


def flatten_payload(responses: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Per-entity responses (``daily`` + ``_city_meta``) to observation rows.

    Each element is coerced by itself: text that is no number is one missing value, a
    code like ``3.0`` is 3, and a code that is no integer raises.

    ``keep``: extra columns carried through (e.g. the run date).
    """
    meta = [F.col(f"_city_meta.{src}").alias(dst) for src, dst in (
        ("name", "city_name"), ("country", "country"), ("country_code", "country_code"),
        ("region", "region"), ("latitude", "latitude"), ("longitude", "longitude"),
        ("timezone", "timezone"))]
    flat = flatten_parallel(responses.select(*keep, *meta, "daily"), "daily", "time",
                            P.RAW_VARIABLES, keep=[*keep, *P.DIMENSION_COLUMNS])
    flat = flat.withColumns({c: S.coerce_double(c) for c in P.NUMERIC_COLUMNS}
                            | {"weather_code": S.coerce_integer("weather_code", "weather_code")})
    return flat.select(*P.OBSERVATION_COLUMNS, *keep)


def safe_get(arr: str, index) -> F.Column:
    """Element ``index`` (0-based) or NULL when past the end."""
    return F.get(F.col(arr), index if not isinstance(index, int) else F.lit(index))


def _field_of(name: str):
    # One-argument lambda: a two-argument one would be read as (element, index).
    return lambda r: r[name]


def to_parallel_arrays(df: DataFrame, group: Sequence[str], order_col: str,
                       fields: Mapping[str, str], chunk_size: int = 64,
                       struct_col: str = "daily") -> DataFrame:
    """Pack rows into parallel-array payloads (the inverse of flattening).

    A payload row is a chunk: the rows of a group whose ``order_col`` falls into one
    range of ``chunk_size`` consecutive integers, so a long series becomes several
    chunks and no collected array grows with a group.  ``order_col`` must be a unique
    integer key (a source id): a chunk holds at most ``chunk_size`` rows only then.
    ``fields`` maps column -> array name.
    """
    o = F.col(order_col).cast("bigint")
    size = F.lit(chunk_size).cast("bigint")
    b = df.withColumn("_bucket", F.call_function("div", o - F.pmod(o, size), size))
    items = F.struct(F.col(order_col).alias("_o"), *[F.col(c).alias(a) for c, a in fields.items()])
    packed = b.groupBy(*group, "_bucket").agg(F.array_sort(F.collect_list(items)).alias("_rows"))
    arrays = F.struct(*[F.transform("_rows", _field_of(a)).alias(a) for a in fields.values()])
    return packed.select(*group, arrays.alias(struct_col))


def roundtrip_payload(obs: DataFrame, id_col: str = "src_id") -> DataFrame:
    """Observation rows -> per-entity parallel arrays -> observation rows."""
    to_raw = {dst: src for src, dst in P.RAW_VARIABLES.items() if dst in obs.columns}
    fields = {"_date_text": "time", **to_raw, id_col: id_col}
    dims = [c for c in P.DIMENSION_COLUMNS if c in obs.columns]
    packed = to_parallel_arrays(obs.withColumn("_date_text", F.col("date").cast("string")),
                                dims, id_col, fields)
    back = {a: c for c, a in fields.items() if a != "time"}
    flat = flatten_parallel(packed, "daily", "time", back, keep=dims, index_alias="_date_text")
    cols = [c for c in obs.columns if c != "date"]
    return flat.select(F.to_date("_date_text").alias("date"), *cols)
