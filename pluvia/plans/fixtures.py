"""Loading the test tables and the observation-shaped ``obs`` projection.

``obs`` maps ``orders ⋈ customer ⋈ nation ⋈ region`` onto the daily
observation layout (one row per order, so (city, date) repeats).  The column
expressions below are the fixture's definition; the DuckDB oracle uses the
same text, which keeps both sides bound to one specification.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvia.operators.joins import attach_dimension

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


# Explicit schemas of the tables that most queries read: without them every scan starts
# with a job that reads a footer for its schema.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A lazy scan of one test table."""
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(os.path.join(sf_dir, f"{name}.parquet"))


OBS_COLUMNS = [
    "CAST(o_orderdate AS DATE) AS date",
    "n_name AS city_name",
    "r_name AS country",
    "upper(substr(r_name, 1, 2)) AS country_code",
    "concat('Z', CAST(n_nationkey % 4 AS VARCHAR(2))) AS region",
    "CAST(n_nationkey * 3 - 40 AS DOUBLE) AS latitude",
    "CAST(-30 - n_nationkey * 3 AS DOUBLE) AS longitude",
    "'Etc/UTC' AS timezone",
    "CASE WHEN o_orderkey % 29 <> 0 THEN CAST((o_orderkey * 7919) % 700 - 50 AS DOUBLE) / 10 END AS temperature_max",
    "CASE WHEN o_orderkey % 31 <> 0 THEN CAST((o_orderkey * 7919) % 700 - 45 - (o_orderkey * 37) % 150 AS DOUBLE) / 10 END AS temperature_min",
    "CASE WHEN o_orderkey % 7 <> 0 THEN CAST((o_orderkey * 7919) % 700 - 48 - (o_orderkey * 37) % 75 AS DOUBLE) / 10 END AS temperature_mean",
    "CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 997 = 0 THEN CAST(600 AS DOUBLE) "
    "ELSE CAST(greatest((o_orderkey * 4729) % 1200 - 500, 0) AS DOUBLE) / 10 END AS precipitation_sum",
    "CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderkey % 25 AS DOUBLE) END AS precipitation_hours",
    "CAST((o_orderkey * 613) % 900 AS DOUBLE) / 10 AS wind_speed_max",
    "CAST((o_orderkey * 17) % 360 AS DOUBLE) AS wind_direction",
    "CAST(50 + (o_orderkey * 19) % 51 AS DOUBLE) AS humidity_max",
    "CAST((o_orderkey * 23) % 50 AS DOUBLE) AS humidity_min",
    "CAST((o_orderkey * 41) % 150 AS DOUBLE) / 10 AS uv_index_max",
    "CASE WHEN o_orderkey % 17 = 0 THEN CAST(NULL AS BIGINT) "
    "ELSE CASE (o_orderkey * 3) % 8 WHEN 0 THEN CAST(0 AS BIGINT) WHEN 1 THEN CAST(3 AS BIGINT) "
    "WHEN 2 THEN CAST(45 AS BIGINT) WHEN 3 THEN CAST(61 AS BIGINT) WHEN 4 THEN CAST(80 AS BIGINT) "
    "WHEN 5 THEN CAST(95 AS BIGINT) WHEN 6 THEN CAST(4 AS BIGINT) ELSE CAST(61 AS BIGINT) END END AS weather_code",
    "o_orderkey AS src_id",
]

OBS_FROM = ("FROM orders JOIN customer ON o_custkey = c_custkey "
            "JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")

OBS_SQL = "SELECT " + ",\n  ".join(OBS_COLUMNS) + "\n" + OBS_FROM


def nation_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation ⋈ region."""
    return attach_dimension(table(spark, sf_dir, "nation"), table(spark, sf_dir, "region"),
                            F.col("n_regionkey") == F.col("r_regionkey"))


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observation-shaped fact rows over the TPC-H-like tables.

    Every join is left to the planner: the two dimension tables are far below its
    broadcast threshold, orders ⋈ customer sorts and merges at scale.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    dims = nation_region(spark, sf_dir).select("n_nationkey", "n_name", "r_name")
    facts = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    joined = attach_dimension(facts, dims, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.selectExpr(*OBS_COLUMNS)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``obs`` without the fixture key: the 20 columns of a flattened batch."""
    return obs(spark, sf_dir).drop("src_id")
