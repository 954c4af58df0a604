"""Bucketed tables join without a shuffle; look-ups in Z order read few rows."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from pluvia.operators import joins as J
from pluvia.plans import catalog_storage as K
from pluvia.sources import layouts as LY

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def executed(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_coverage_gap_of_bucketed_tables_has_no_exchange(spark, no_broadcast):
    requested, answered = K.bucketed_tables(spark, SF)
    rows, plan = executed(J.coverage_gap(requested, answered, "c_custkey"))
    assert rows and "SortMergeJoin" in plan and "Exchange" not in plan
    assert "Exchange" in executed(J.coverage_gap(requested.where("true").repartition(3), answered, "c_custkey"))[1]


def test_replacement_moves_no_stored_row(spark, no_broadcast):
    name = f"replace_{uuid.uuid4().hex[:8]}"
    rows = [(f"city {i % 7}", dt.date(2024, 1, 1 + i % 20), i) for i in range(200)]
    key = ["city", "date"]
    LY.save_bucketed(spark.createDataFrame(rows, "city string, date date, v int"), name, key, 4)
    batch = [("city 1", dt.date(2024, 1, 2), -1), ("city 9", dt.date(2024, 1, 2), -2), ("city 1", dt.date(2024, 1, 2), -3)]
    staged = LY.save_bucketed(spark.createDataFrame(batch, "city string, date date, v int"), name + "_b", key, 4)
    plan = executed(LY.surviving(spark.table(name), staged, key))[1]
    assert "LeftAnti" in plan and "Exchange" not in plan
    got = LY.replace_bucketed(spark, name, spark.createDataFrame(batch, "city string, date date, v int"), key, 4)
    keys = {b[:2] for b in batch}
    assert sorted(map(tuple, got.collect())) == sorted([r for r in rows if r[:2] not in keys] + batch)


def test_interleaving_and_coordinates(spark):
    df = spark.createDataFrame([(0b101, 0b011)], "a int, b int")
    assert df.select(LY.interleaved([F.col("a"), F.col("b")], 3)).first()[0] == 0b100111
    days = spark.createDataFrame([(dt.date(2024, 1, 1 + i), "x" if i else None, float(i), 7) for i in range(16)],
                                 "d date, s string, f double, c int")
    got = days.select(LY.coordinate(days, "d", 3).alias("d"), LY.coordinate(days, "f", 3).alias("f"),
                      LY.coordinate(days, "s", 3).alias("s"), LY.coordinate(days, "c", 3).alias("c")).collect()
    assert [r.d for r in got] == [r.f for r in got] == [min(7, i * 8 // 15) for i in range(16)]
    assert all(0 <= r.s < 8 and r.c == 0 for r in got)


def scanned_rows(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_point_look_up_reads_a_small_share(spark, tmp):
    """600 entities of 400 days each, one with a third of all rows."""
    base = spark.range(240_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.pmod(F.xxhash64("id"), F.lit(600))).cast("long").alias("entity"),
        F.date_add(F.lit("2023-01-01").cast("date"), F.pmod(F.xxhash64("id", F.lit("day")), F.lit(400)).cast("int")).alias("date"), F.col("id").alias("v"))
    ordered = LY.write_for_look_ups(base, os.path.join(tmp, "z"), "entity", "date", row_group_bytes=64 << 10, files=8)
    base.repartition(8).write.option("parquet.block.size", str(64 << 10)).parquet(os.path.join(tmp, "plain"))
    for value, share in ((500, 0.05), (7, 0.3)):
        want = sorted(r.v for r in LY.look_up(base, "entity", value, "date", dt.date(2023, 3, 1), dt.date(2023, 4, 1)).collect())
        found = LY.look_up(spark.read.parquet(ordered), "entity", value, "date", dt.date(2023, 3, 1), dt.date(2023, 4, 1))
        assert sorted(r.v for r in found.collect()) == want and want
        read = scanned_rows(found)
        plain = scanned_rows(LY.look_up(spark.read.parquet(os.path.join(tmp, "plain")), "entity", value, "date",
                                        dt.date(2023, 3, 1), dt.date(2023, 4, 1)))
        assert read <= share * 240_000 < plain, (value, read, plain)


def test_texts_are_found_by_the_bloom_filter(spark, tmp):
    """A text inside every row group's range but in few of them."""
    base = spark.range(60_000).select(F.concat(F.lit("e"), F.md5(((F.col("id") * 7919) % 3000).cast("string"))).alias("entity"),
                                      F.lit("2024-01-01").cast("date").alias("date"), F.col("id").alias("v"))
    path = LY.write_for_look_ups(base, os.path.join(tmp, "t"), "entity", "date", row_group_bytes=64 << 10, files=4)
    value = base.first().entity
    found = LY.look_up(spark.read.parquet(path), "entity", value, "date", dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    assert found.count() == 20 and scanned_rows(found) <= 15_000


def test_empty_table(spark, tmp):
    none = spark.createDataFrame([], "entity string, date date")
    path = LY.write_for_look_ups(none, os.path.join(tmp, "e"), "entity", "date")
    assert spark.read.schema(none.schema).parquet(path).count() == 0
