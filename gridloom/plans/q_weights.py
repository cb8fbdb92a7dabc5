"""Normalisation, scores and downscaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.ranking import quantiles
from ..operators import export, lines, normalize
from . import domain as d
from .registry import query

_W = """w AS (SELECT *, CASE WHEN sum(signal) OVER c > 0 THEN signal / sum(signal) OVER c ELSE 1e0 / count(*) OVER c END AS weight FROM pixels WINDOW c AS (PARTITION BY cell_id))"""


def _weighted(spark, sf):
    return normalize.weights(d.pixels(spark, sf), "signal", ["cell_id"])


@query("wn01_ratio_to_report", d.with_(d.PIXELS, _W) + 'SELECT "row", col, cell_id, round(weight, 8) AS weight FROM w')
def wn01(spark, sf):
    return _weighted(spark, sf).select("row", "col", "cell_id", F.round("weight", 8).alias("weight"))


@query("wn02_renormalised", d.with_(d.PIXELS) + """
SELECT "row", col, round(coalesce(CASE WHEN signal > 20 THEN signal ELSE 0 END / nullif(sum(CASE WHEN signal > 20 THEN signal ELSE 0 END) OVER (PARTITION BY cell_id), 0), 0), 8) AS weight FROM pixels""")
def wn02(spark, sf):
    p = d.pixels(spark, sf).withColumn("weight", F.when(F.col("signal") > 20, F.col("signal")).otherwise(0.0))
    return normalize.weights(p, "weight", ["cell_id"], uniform=False).select("row", "col", F.round("weight", 8).alias("weight"))


_FUSE = d.with_(d.PIXELS) + """
, g AS (SELECT "row", col, cell_id, 'g1' AS grp, CASE WHEN sum(signal) OVER c > 0 THEN signal / sum(signal) OVER c ELSE 1e0 / count(*) OVER c END AS w FROM pixels WINDOW c AS (PARTITION BY cell_id)
  UNION ALL SELECT "row", col, cell_id, 'g2', CASE WHEN sum(other) OVER c > 0 THEN other / sum(other) OVER c ELSE 1e0 / count(*) OVER c END FROM pixels WINDOW c AS (PARTITION BY cell_id)),
a(pollutant, grp, alpha) AS (VALUES ('nox', 'g1', 0.7e0), ('nox', 'g2', 0.3e0), ('co', 'g2', 1e0)),
m AS (SELECT pollutant, cell_id, "row", col, sum(alpha * w) AS s FROM g JOIN a USING (grp) GROUP BY 1, 2, 3, 4)
SELECT pollutant, cell_id, "row", col, round(CASE WHEN sum(s) OVER c > 0 THEN s / sum(s) OVER c ELSE 1e0 / count(*) OVER c END, 8) AS weight FROM m WINDOW c AS (PARTITION BY pollutant, cell_id)"""


@query("wn03_alpha_fusion", _FUSE)
def wn03(spark, sf):
    alpha = spark.createDataFrame([("nox", "g1", 0.7), ("nox", "g2", 0.3), ("co", "g1", 0.0), ("co", "g2", 1.0)], "pollutant string, group string, alpha double")
    signals = {"g1": F.col("signal"), "g2": F.col("other")}
    return normalize.fused(d.pixels(spark, sf), signals, alpha, ["row", "col"]).select("pollutant", "cell_id", "row", "col", F.round("weight", 8).alias("weight"))


@query("wn04_cell_score", d.with_(d.PIXELS) + """
, v AS (SELECT *, CASE WHEN signal > 0 THEN signal END AS x FROM pixels)
SELECT "row", col, round(CASE WHEN x IS NULL THEN 0 WHEN max(x) OVER c > min(x) OVER c THEN (x - min(x) OVER c) / (max(x) OVER c - min(x) OVER c) ELSE 1 END, 8) AS score FROM v WINDOW c AS (PARTITION BY cell_id)""")
def wn04(spark, sf):
    return normalize.cell_score(d.pixels(spark, sf), "signal", "score").select("row", "col", F.round("score", 8).alias("score"))


_Z = """, cap AS (SELECT quantile_cont(signal, 0.99) AS cap FROM pixels), v AS (SELECT *, least(signal, cap) AS x FROM pixels, cap),
s AS (SELECT avg(x) AS m, stddev_pop(x) AS sd, min(x) AS lo, max(x) AS hi FROM v)"""


@query("wn05_clipped_z", d.with_(d.PIXELS) + _Z + 'SELECT "row", col, round(CASE WHEN sd > 0 THEN (x - lo) / (hi - lo) ELSE 1 END, 6) AS z FROM v, s')
def wn05(spark, sf):
    return normalize.clipped_z(d.pixels(spark, sf), "signal", "z").select("row", "col", F.round("z", 6).alias("z"))


@query("ag33_z_statistics", d.with_(d.PIXELS) + _Z + "SELECT round((SELECT cap FROM cap), 6) AS cap, round(m, 6) AS mean, round(sd, 6) AS sd, round(lo, 6) AS low FROM s")
def ag33(spark, sf):
    p = d.pixels(spark, sf)
    cap = quantiles(p, [], "signal", {"cap": 0.99})
    v = p.crossJoin(F.broadcast(cap)).withColumn("x", F.least("signal", "cap"))
    return v.agg(F.round(F.max("cap"), 6).alias("cap"), F.round(F.avg("x"), 6).alias("mean"), F.round(F.stddev_pop("x"), 6).alias("sd"), F.round(F.min("x"), 6).alias("low"))


@query("wn06_max_scaled", d.with_(d.PIXELS) + 'SELECT "row", col, round(signal / (max(signal) OVER () + 1e-12), 8) AS scaled FROM pixels')
def wn06(spark, sf):
    return normalize.max_scaled(d.pixels(spark, sf), "signal", "scaled").select("row", "col", F.round("scaled", 8).alias("scaled"))


@query("wn07_region_target", """
SELECT c_custkey AS id, round(CASE WHEN sum(greatest(c_acctbal, 0)) OVER r > 0 THEN greatest(c_acctbal, 0) * (1000e0 + c_nationkey) / sum(greatest(c_acctbal, 0)) OVER r ELSE 0 END, 5) AS scaled
FROM customer WINDOW r AS (PARTITION BY c_nationkey)""")
def wn07(spark, sf):
    c = d.t(spark, sf, "customer").withColumn("v", F.greatest(F.col("c_acctbal"), F.lit(0.0))).withColumn("target", F.col("c_nationkey") + 1000.0)
    return normalize.to_target(c, "v", "c_nationkey", "target", "scaled").select(F.col("c_custkey").alias("id"), F.round("scaled", 5).alias("scaled"))


@query("wn12_line_correction", """
WITH l AS (SELECT c_mktsegment AS pollutant, c_custkey AS id, abs(c_acctbal) AS x FROM customer), t AS (SELECT c_mktsegment AS pollutant, sum(c_nationkey) * 10e0 AS total FROM customer GROUP BY 1)
SELECT id, round(x * total / sum(x) OVER (PARTITION BY pollutant), 5) AS x FROM l JOIN t USING (pollutant)""")
def wn12(spark, sf):
    c = d.t(spark, sf, "customer")
    l = c.select(F.col("c_mktsegment").alias("pollutant"), F.col("c_custkey").alias("id"), F.abs("c_acctbal").alias("x"))
    t = c.groupBy(F.col("c_mktsegment").alias("pollutant")).agg((F.sum("c_nationkey") * 10.0).alias("total"))
    return lines.correct_mass(l, t, "x").select("id", F.round("x", 5).alias("x"))


@query("wn13_line_shares", """
WITH l AS (SELECT c_custkey AS id, c_nationkey AS cell_id, CASE c_mktsegment WHEN 'BUILDING' THEN 'motorway' WHEN 'MACHINERY' THEN 'primary' WHEN 'FURNITURE' THEN 'secondary' END AS g, abs(c_acctbal) AS len FROM customer),
w AS (SELECT *, CASE g WHEN 'motorway' THEN 10e0 ELSE 2e0 END AS w FROM l WHERE g IS NOT NULL AND len > 0),
s AS (SELECT cell_id, sum(w) AS sw FROM (SELECT DISTINCT cell_id, g, w FROM w) GROUP BY 1)
SELECT id, round(len / sum(len) OVER (PARTITION BY cell_id, g) * w / sw * 120, 6) AS line_mass FROM w JOIN s USING (cell_id)""")
def wn13(spark, sf):
    g = F.when(F.col("c_mktsegment") == "BUILDING", "motorway").when(F.col("c_mktsegment") == "MACHINERY", "primary").when(F.col("c_mktsegment") == "FURNITURE", "secondary")
    l = d.t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("cell_id"), g.alias("group"), F.abs("c_acctbal").alias("len"), F.lit(120.0).alias("mass"))
    return lines.line_shares(l, "len", "mass").select("id", F.round("line_mass", 6).alias("line_mass"))


@query("ag04_weighted_cell_sum", d.with_(d.PIXELS) + "SELECT cell_id, count(*) AS n, round(sum(signal * other), 4) AS total FROM pixels GROUP BY 1")
def ag04(spark, sf):
    return d.pixels(spark, sf).groupBy("cell_id").agg(F.count("*").alias("n"), F.round(F.sum(F.col("signal") * F.col("other")), 4).alias("total"))


@query("ag05_weight_sums", d.with_(d.PIXELS, _W) + "SELECT cell_id, round(sum(weight), 6) AS s FROM w GROUP BY 1")
def ag05(spark, sf):
    return _weighted(spark, sf).groupBy("cell_id").agg(F.round(F.sum("weight"), 6).alias("s"))


@query("dc19_downscale", d.with_(d.PIXELS, d.PIXEL_MASS, _W) + """
SELECT CAST(floor("row" / 100e0) AS INT) AS r, CAST(floor(col / 10e0) AS INT) AS c, count(*) AS n, round(sum(weight * mass), 1) AS emission FROM w JOIN pixel_mass USING (cell_id) GROUP BY 1, 2""")
def dc19(spark, sf):
    from ..functions.numeric import floor_index

    e = export.downscale(_weighted(spark, sf), d.pixel_mass(spark, sf))
    return e.groupBy(floor_index(F.col("row"), 0.0, 100.0).alias("r"), floor_index(F.col("col"), 0.0, 10.0).alias("c")).agg(F.count("*").alias("n"), F.round(F.sum("emission"), 1).alias("emission"))


@query("dc19_weight_check", d.with_(d.PIXELS, _W) + """
, s AS (SELECT cell_id, sum(CASE WHEN col > 90 THEN weight * 0.5e0 ELSE weight END) AS s FROM w GROUP BY 1)
SELECT count(*) AS cells_checked, count(*) FILTER (abs(s - 1) > 5e-2) AS failures, count(*) FILTER (abs(s - 1) > 1e-6 AND abs(s - 1) <= 5e-2) AS repairs, count(*) FILTER (abs(s - 1) > 5e-2) = 0 AS passed FROM s""")
def dc19_check(spark, sf):
    w = _weighted(spark, sf).withColumn("weight", F.when(F.col("col") > 90, F.col("weight") * 0.5).otherwise(F.col("weight")))
    return normalize.check_weights(w, [])


@query("dc19_clip_log", d.with_(d.PIXELS, _W) + """
SELECT cell_id, round(sum(weight), 6) AS full_sum, round(sum(CASE WHEN col <= 60 THEN weight ELSE 0 END), 6) AS in_domain, round(1 - sum(CASE WHEN col <= 60 THEN weight ELSE 0 END) / sum(weight), 6) AS clipped
FROM w GROUP BY 1 HAVING sum(CASE WHEN col <= 60 THEN weight ELSE 0 END) > 0 AND sum(CASE WHEN col <= 60 THEN weight ELSE 0 END) < 1 - 1.5e-2""")
def dc19_clip(spark, sf):
    c = export.clip_log(_weighted(spark, sf), [], F.col("col") <= 60)
    return c.select("cell_id", F.round("full", 6).alias("full_sum"), F.round("in_domain", 6).alias("in_domain"), F.round("clipped", 6).alias("clipped"))


@query("jn04_mass_lookup", d.with_(d.PIXELS, d.PIXEL_MASS) + "SELECT cell_id, count(*) AS n, round(max(mass), 2) AS mass FROM pixels JOIN pixel_mass USING (cell_id) GROUP BY 1")
def jn04(spark, sf):
    return d.pixels(spark, sf).join(d.pixel_mass(spark, sf), "cell_id").groupBy("cell_id").agg(F.count("*").alias("n"), F.round(F.max("mass"), 2).alias("mass"))


@query("dc20_roads_by_category", d.with_(d.PIXELS, """cat AS (SELECT 'F' || CAST(col % 4 + 1 AS VARCHAR) AS category, * FROM pixels)""", """rw AS (
  SELECT *, CASE WHEN sum(signal) OVER c > 0 THEN signal / sum(signal) OVER c ELSE 1e0 / count(*) OVER c END AS weight FROM cat WINDOW c AS (PARTITION BY category, cell_id))""", d.PIXEL_MASS) + """
SELECT category, count(*) AS n, round(sum(weight * mass / 4), 0) AS emission FROM rw JOIN pixel_mass USING (cell_id) GROUP BY 1""")
def dc20(spark, sf):
    p = d.pixels(spark, sf).withColumn("category", F.concat(F.lit("F"), (F.col("col") % 4 + 1).cast("string")))
    w = normalize.weights(p, "signal", ["category", "cell_id"])
    e = export.downscale(w, d.pixel_mass(spark, sf).withColumn("mass", F.col("mass") / 4))
    return e.groupBy("category").agg(F.count("*").alias("n"), F.round(F.sum("emission"), 0).alias("emission"))


@query("ag25_city_area", d.with_(d.PIXELS) + """
, e AS (SELECT 'nox' AS pollutant, signal AS emission, "row", col FROM pixels UNION ALL SELECT 'co', other, "row", col FROM pixels)
SELECT 7 AS snap, CAST(floor(col / 10e0) * 10 AS BIGINT) AS x, CAST(floor("row" / 100e0) * 100 AS BIGINT) AS y, round(coalesce(sum(CASE pollutant WHEN 'nox' THEN emission END), 0), 4) AS nox,
       round(coalesce(sum(CASE pollutant WHEN 'co' THEN emission END), 0), 4) AS co, 0e0 AS nh3 FROM e GROUP BY 1, 2, 3""")
def ag25(spark, sf):
    p = d.pixels(spark, sf)
    long = p.select(F.lit(7).alias("snap"), "row", "col", F.col("signal").alias("nox"), F.col("other").alias("co")).unpivot(["snap", "row", "col"], ["nox", "co"], "pollutant", "emission")
    a = export.city_area(long.withColumn("x", F.floor(F.col("col") / 10) * 10).withColumn("y", F.floor(F.col("row") / 100) * 100), 10, ["nox", "co", "nh3"])
    return a.select("snap", F.col("xcor_sw").cast("long").alias("x"), F.col("ycor_sw").cast("long").alias("y"), F.round("nox", 4).alias("nox"), F.round("co", 4).alias("co"), "nh3")


@query("rs01_pivot", "SELECT c_nationkey AS cell, round(coalesce(sum(CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal END), 0), 3) AS building, 0e0 AS absent FROM customer GROUP BY 1")
def rs01(spark, sf):
    c = d.t(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("cell")).pivot("c_mktsegment", ["BUILDING", "NONE"]).agg(F.sum("c_acctbal")).fillna(0.0)
    return c.select("cell", F.round("BUILDING", 3).alias("building"), F.col("NONE").alias("absent"))


@query("rs02_unpivot", d.with_(d.SOURCES) + "SELECT pollutant, count(*) AS n, round(sum(mass), 2) AS mass FROM (SELECT 'nox' AS pollutant, nox AS mass FROM sources UNION ALL SELECT 'co', co FROM sources) GROUP BY 1")
def rs02(spark, sf):
    from ..operators.cells import unpivot_mass

    return unpivot_mass(d.sources(spark, sf), ["cell_id"], ["nox", "co"]).groupBy("pollutant").agg(F.count("*").alias("n"), F.round(F.sum("mass"), 2).alias("mass"))


@query("rs04_dense", "SELECT r_regionkey AS r, n_regionkey IS NOT NULL AS present, count(n_nationkey) AS n FROM region LEFT JOIN nation ON n_regionkey = r_regionkey AND n_nationkey % 2 = 0 GROUP BY 1, 2")
def rs04(spark, sf):
    n = d.t(spark, sf, "nation").where(F.col("n_nationkey") % 2 == 0)
    j = d.t(spark, sf, "region").join(n, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return j.groupBy(F.col("r_regionkey").alias("r"), F.col("n_regionkey").isNotNull().alias("present")).agg(F.count("n_nationkey").alias("n"))


@query("rs05_wide_sum", "SELECT c_nationkey AS cell, round(sum(CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal ELSE 0 END), 3) AS b, round(sum(CASE WHEN c_mktsegment = 'FURNITURE' THEN c_acctbal ELSE 0 END), 3) AS f FROM customer GROUP BY 1")
def rs05(spark, sf):
    c = d.t(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("cell")).pivot("c_mktsegment", ["BUILDING", "FURNITURE"]).sum("c_acctbal").fillna(0.0)
    return c.select("cell", F.round("BUILDING", 3).alias("b"), F.round("FURNITURE", 3).alias("f"))
