"""The domain on the driver's tables: the same views as DataFrames and as SQL.

Inventory sources, pixels, cells, facilities and reports are read from the order tables with
integer and double arithmetic that gives equal values in Spark and DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import dealt, hinted

POLLUTANTS = ("nox", "co", "pm10", "nh3")
N_LON, N_LAT = 25, 5
#: The nation table is broadcast up to this many rows; rows that a task makes pixels of.
NATION_ROWS, PIXEL_ROWS = 1000, 500_000


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def sources(spark: SparkSession, sf: str) -> DataFrame:
    li = t(spark, sf, "lineitem")
    lon = F.lit(-10.0) + (F.col("l_partkey") % 2000) * F.lit(0.02)
    lat = F.lit(35.0) + (F.col("l_suppkey") % 100) * F.lit(0.25)
    return li.select(
        lon.alias("lon"), lat.alias("lat"), F.col("l_linenumber").alias("category"), F.when(F.col("l_linestatus") == "O", 1).otherwise(2).alias("source_type"),
        (F.col("l_suppkey") % 28 + 1).cast("int").alias("country"), F.col("l_quantity").alias("nox"), F.col("l_extendedprice").alias("co"),
        F.col("l_discount").alias("pm10"), F.col("l_tax").alias("nh3"),
        (F.floor((lat - 35.0) / 5.0) * 25 + F.floor((lon + 10.0) / 2.0)).cast("long").alias("cell_id"),
    )


SOURCES = """sources AS (
  SELECT lon, lat, category, source_type, country, nox, co, pm10, nh3, CAST(floor((lat - 35e0) / 5e0) * 25 + floor((lon + 10e0) / 2e0) AS BIGINT) AS cell_id
  FROM (SELECT -10e0 + (l_partkey % 2000) * 0.02e0 AS lon, 35e0 + (l_suppkey % 100) * 0.25e0 AS lat, l_linenumber AS category,
          CASE WHEN l_linestatus = 'O' THEN 1 ELSE 2 END AS source_type, CAST(l_suppkey % 28 + 1 AS INT) AS country,
          l_quantity AS nox, l_extendedprice AS co, l_discount AS pm10, l_tax AS nh3 FROM lineitem))"""


def pixels(spark: SparkSession, sf: str) -> DataFrame:
    li = dealt(t(spark, sf, "lineitem"), PIXEL_ROWS, "l_partkey", "l_suppkey")
    cell = ((F.col("l_suppkey") % 20) * 25 + F.col("l_partkey") % 25).cast("long")
    sig = F.sum(F.when(F.col("l_discount") > 0.05, F.col("l_quantity")).otherwise(0.0))
    p = li.groupBy("l_partkey", "l_suppkey").agg(sig.alias("signal"), F.sum("l_tax").alias("other"))
    return p.select(F.col("l_partkey").cast("int").alias("row"), F.col("l_suppkey").cast("int").alias("col"), cell.alias("cell_id"), "signal", "other")


PIXELS = """pixels AS (
  SELECT CAST(l_partkey AS INT) AS "row", CAST(l_suppkey AS INT) AS col, CAST((l_suppkey % 20) * 25 + l_partkey % 25 AS BIGINT) AS cell_id,
         sum(CASE WHEN l_discount > 0.05e0 THEN l_quantity ELSE 0 END) AS signal, sum(l_tax) AS other
  FROM lineitem GROUP BY 1, 2, 3)"""


def pixel_mass(spark: SparkSession, sf: str) -> DataFrame:
    li = t(spark, sf, "lineitem").where(F.col("l_linestatus") == "O")
    cell = ((F.col("l_suppkey") % 20) * 25 + F.col("l_partkey") % 25).cast("long")
    return li.groupBy(cell.alias("cell_id")).agg(F.sum("l_extendedprice").alias("mass"))


PIXEL_MASS = """pixel_mass AS (
  SELECT CAST((l_suppkey % 20) * 25 + l_partkey % 25 AS BIGINT) AS cell_id, sum(l_extendedprice) AS mass FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1)"""


def facilities(spark: SparkSession, sf: str) -> DataFrame:
    return t(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("facility_id"), F.col("s_nationkey").cast("long").alias("cell_id"),
        F.element_at(F.array(*map(F.lit, "ABC")), (F.col("s_suppkey") % 3 + 1).cast("int")).alias("f_gnfr"),
        (F.lit(-10.0) + F.col("s_nationkey") * 2 + (F.col("s_suppkey") % 10) * F.lit(0.2)).alias("f_lon"), (F.lit(35.0) + (F.col("s_suppkey") % 20) * F.lit(0.25)).alias("f_lat"),
        F.greatest(F.col("s_acctbal"), F.lit(0.0)).alias("r_nox"), F.when(F.col("s_suppkey") % 2 == 0, F.greatest(F.col("s_acctbal"), F.lit(0.0))).otherwise(0.0).alias("r_co"),
    )


FACILITIES = """facilities AS (
  SELECT s_suppkey AS facility_id, CAST(s_nationkey AS BIGINT) AS cell_id, substr('ABC', CAST(s_suppkey % 3 + 1 AS INT), 1) AS f_gnfr,
         -10e0 + s_nationkey * 2 + (s_suppkey % 10) * 0.2e0 AS f_lon, 35e0 + (s_suppkey % 20) * 0.25e0 AS f_lat,
         greatest(s_acctbal, 0e0) AS r_nox, CASE WHEN s_suppkey % 2 = 0 THEN greatest(s_acctbal, 0e0) ELSE 0e0 END AS r_co FROM supplier)"""


def points(spark: SparkSession, sf: str) -> DataFrame:
    """Point sources: one for each customer, in its nation's cell."""
    return t(spark, sf, "customer").select(
        F.col("c_custkey").alias("source_id"), F.col("c_nationkey").cast("long").alias("cell_id"),
        F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit("C"), F.lit("")), (F.col("c_custkey") % 4 + 1).cast("int")).alias("gnfr"),
        (F.lit(-10.0) + F.col("c_nationkey") * 2 + (F.col("c_custkey") % 20) * F.lit(0.1)).alias("lon"), (F.lit(35.0) + (F.col("c_custkey") % 50) * F.lit(0.1)).alias("lat"),
        F.abs("c_acctbal").alias("nox"), (F.abs("c_acctbal") / 10).alias("co"),
    )


POINTS = """points AS (
  SELECT c_custkey AS source_id, CAST(c_nationkey AS BIGINT) AS cell_id, CASE c_custkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' ELSE '' END AS gnfr,
         -10e0 + c_nationkey * 2 + (c_custkey % 20) * 0.1e0 AS lon, 35e0 + (c_custkey % 50) * 0.1e0 AS lat, abs(c_acctbal) AS nox, abs(c_acctbal) / 10 AS co FROM customer)"""


def reported(spark: SparkSession, sf: str) -> DataFrame:
    o, c, n = t(spark, sf, "orders"), t(spark, sf, "customer"), t(spark, sf, "nation")
    j = o.join(c, o["o_custkey"] == c["c_custkey"]).join(hinted(n, NATION_ROWS), F.col("c_nationkey") == F.col("n_nationkey"))
    return j.select(F.col("n_name").alias("country"), F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("sector"), F.col("c_mktsegment").alias("pollutant"), F.col("o_totalprice").alias("total"))


REPORTED = """reported AS (
  SELECT n_name AS country, CAST(year(o_orderdate) AS INT) AS year, o_orderpriority AS sector, c_mktsegment AS pollutant, o_totalprice AS total
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def groups(spark: SparkSession) -> DataFrame:
    rows = [("1-URGENT", "g1"), ("2-HIGH", "g1"), ("3-MEDIUM", "g2"), ("4-NOT SPECIFIED", "g3")]
    return spark.createDataFrame(rows, "sector string, group string")


GROUPS = """groups(sector, "group") AS (VALUES ('1-URGENT', 'g1'), ('2-HIGH', 'g1'), ('3-MEDIUM', 'g2'), ('4-NOT SPECIFIED', 'g3'))"""


def tags(spark: SparkSession, sf: str) -> DataFrame:
    p = t(spark, sf, "part")
    m = F.create_map(F.lit("type"), "p_type", F.lit("brand"), "p_brand", F.lit("size"), F.col("p_size").cast("string"), F.lit("name"), "p_name")
    return p.select(F.col("p_partkey").alias("id"), m.alias("tags"), F.element_at(F.array(F.lit("node"), F.lit("area_way")), (F.col("p_partkey") % 2 + 1).cast("int")).alias("elem_kind"), "p_size", "p_retailprice")


def fires(spark: SparkSession, sf: str) -> DataFrame:
    return t(spark, sf, "events").select("event_id", "ts", (F.col("user_id") % 25).alias("cell"), "value", "event_type")


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
