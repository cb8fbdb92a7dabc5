"""Analytics, sorts and service answers."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import analytics, export
from . import domain as d
from .registry import query


def _e(spark, sf):
    return d.t(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", F.abs("c_acctbal").alias("v"))


_E = "WITH e AS (SELECT c_custkey, c_nationkey, c_mktsegment, abs(c_acctbal) AS v FROM customer)\n"


@query("ag27_composition", _E + """, r AS (SELECT c_mktsegment AS pollutant, c_nationkey AS sector, sum(v) AS total, CAST(grouping(c_mktsegment, c_nationkey) AS BIGINT) AS level FROM e GROUP BY ROLLUP (c_mktsegment, c_nationkey)),
t AS (SELECT pollutant, total FROM r WHERE level = 1)
SELECT r.pollutant, sector, round(r.total, 3) AS total, level, round(CASE level WHEN 3 THEN 100e0 ELSE 100 * r.total / t.total END, 5) AS percent FROM r LEFT JOIN t ON r.pollutant = t.pollutant""")
def ag27(spark, sf):
    c = analytics.composition(_e(spark, sf), "c_mktsegment", "c_nationkey", "v")
    return c.select(F.col("c_mktsegment").alias("pollutant"), F.col("c_nationkey").alias("sector"), F.round("total", 3).alias("total"), F.col("level").cast("long").alias("level"), F.round("percent", 5).alias("percent"))


@query("ag28_pollutant_totals", _E + "SELECT c_mktsegment AS pollutant, count(*) AS n, round(sum(v), 3) AS total, round(max(v), 3) AS top FROM e GROUP BY 1")
def ag28(spark, sf):
    return _e(spark, sf).groupBy(F.col("c_mktsegment").alias("pollutant")).agg(F.count("*").alias("n"), F.round(F.sum("v"), 3).alias("total"), F.round(F.max("v"), 3).alias("top"))


_RANK = _E + ", k AS (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY v, c_custkey) AS i, row_number() OVER (PARTITION BY c_mktsegment ORDER BY v DESC, c_custkey) AS j, count(*) OVER (PARTITION BY c_mktsegment) AS n, sum(v) OVER (PARTITION BY c_mktsegment) AS t, sum(v) OVER (PARTITION BY c_mktsegment ORDER BY v DESC, c_custkey ROWS UNBOUNDED PRECEDING) AS cum FROM e WHERE v > 0)"


@query("ag29_gini", _RANK + " SELECT c_mktsegment AS pollutant, round(2 * sum(i * v) / (max(n) * sum(v)) - (max(n) + 1e0) / max(n), 8) AS gini FROM k GROUP BY 1")
def ag29(spark, sf):
    return analytics.gini(_e(spark, sf), ["c_mktsegment"], "v").select(F.col("c_mktsegment").alias("pollutant"), F.round("gini", 8).alias("gini"))


@query("ag30_lorenz", _RANK + """, p AS (SELECT c_mktsegment, CAST(q * 10 AS INT) AS p, greatest(1, least(n, CAST(round_even(q * n / 10, 0) AS BIGINT))) AS place FROM (SELECT DISTINCT c_mktsegment, n FROM k), range(1, 11) g(q))
SELECT c_mktsegment AS pollutant, p, round(100 * cum / t, 6) AS share FROM p JOIN k USING (c_mktsegment) WHERE j = place""")
def ag30(spark, sf):
    return analytics.lorenz(_e(spark, sf), ["c_mktsegment"], "v").select(F.col("c_mktsegment").alias("pollutant"), F.col("p").cast("int").alias("p"), F.round("share", 6).alias("share"))


@query("ag30_reaching_90", _RANK + " SELECT c_mktsegment AS pollutant, round(100e0 * min(CASE WHEN 100 * cum / t >= 90 THEN j END) / max(n), 6) AS reach FROM k GROUP BY 1")
def ag30b(spark, sf):
    return analytics.reaching(_e(spark, sf), ["c_mktsegment"], "v").select(F.col("c_mktsegment").alias("pollutant"), F.round("reach", 6).alias("reach"))


@query("ag31_histogram", _E + ", m AS (SELECT min(v) AS lo, max(v) AS hi FROM e) SELECT CAST(least(floor((v - lo) / ((hi - lo) / 24)), 23) AS INT) AS bin, count(*) AS n FROM e, m GROUP BY 1")
def ag31(spark, sf):
    return analytics.histogram(_e(spark, sf), "v", 24)


@query("ag31_log_histogram", _E + ", l AS (SELECT log10(v) AS x FROM e WHERE v > 0), m AS (SELECT min(x) AS lo, max(x) AS hi FROM l) SELECT CAST(least(floor((x - lo) / ((hi - lo) / 30)), 29) AS INT) AS bin, count(*) AS n FROM l, m GROUP BY 1")
def ag31b(spark, sf):
    return analytics.histogram(_e(spark, sf), "v", 30, log=True)


@query("ag32_percentile_scale", _E + """SELECT c_mktsegment AS pollutant, round(quantile_cont(log10(v + 0.01e0), 0.05), 6) AS log_p5, round(quantile_cont(log10(v + 0.01e0), 0.95), 6) AS log_p95,
round(quantile_cont(v, 0.25), 5) AS p25, round(quantile_cont(v, 0.5), 5) AS p50, round(quantile_cont(v, 0.75), 5) AS p75, round(quantile_cont(v, 0.98), 5) AS p98 FROM e WHERE v > 0 GROUP BY 1""")
def ag32(spark, sf):
    s = analytics.scale(_e(spark, sf), ["c_mktsegment"], "v")
    return s.select(F.col("c_mktsegment").alias("pollutant"), *[F.round(c, 6).alias(c) for c in ("log_p5", "log_p95")], *[F.round(c, 5).alias(c) for c in ("p25", "p50", "p75", "p98")])


@query("ag35_sector_sum", d.with_(d.PIXELS) + 'SELECT "row", col, round(sum(e), 4) AS total FROM (SELECT "row", col, signal AS e FROM pixels UNION ALL SELECT "row", col, other FROM pixels) GROUP BY 1, 2')
def ag35(spark, sf):
    p = d.pixels(spark, sf)
    both = p.select("row", "col", F.col("signal").alias("e")).unionByName(p.select("row", "col", F.col("other").alias("e")))
    return both.groupBy("row", "col").agg(F.round(F.sum("e"), 4).alias("total"))


@query("ag36_median_ratio", _E + ", m AS (SELECT c_mktsegment, quantile_cont(v, 0.5) AS med FROM e GROUP BY 1) SELECT c_custkey AS id, round(v / med, 6) AS ratio FROM e JOIN m USING (c_mktsegment)")
def ag36(spark, sf):
    return analytics.median_ratio(_e(spark, sf), ["c_mktsegment"], "v").select(F.col("c_custkey").alias("id"), F.round("ratio", 6).alias("ratio"))


@query("ag37_viewport", _E + """, s AS (SELECT c_nationkey % 5 AS cell, c_mktsegment AS sector, sum(v) AS s FROM e WHERE v BETWEEN 100 AND 5000 GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY s DESC, sector) AS rn FROM s)
SELECT cell, max(CASE WHEN rn = 1 THEN sector END) AS dominant, round(max(s), 3) AS top, round(sum(s), 3) AS total FROM k GROUP BY 1""")
def ag37(spark, sf):
    e = _e(spark, sf).where(F.col("v").between(100, 5000)).withColumn("cell", F.col("c_nationkey") % 5)
    return analytics.dominant(e, ["cell"], "c_mktsegment", "v").select("cell", "dominant", F.round("top", 3).alias("top"), F.round("total", 3).alias("total"))


@query("ag39_country_report", d.with_(d.SOURCES) + """SELECT country, CAST(grouping(country) AS INT) AS is_total, round(sum(CASE WHEN source_type = 1 THEN nox ELSE 0 END), 3) AS area, round(sum(CASE WHEN source_type = 2 THEN nox ELSE 0 END), 3) AS point FROM sources GROUP BY GROUPING SETS ((country), ())""")
def ag39(spark, sf):
    s, k = d.sources(spark, sf), F.col("source_type")
    r = s.rollup("country").agg(F.grouping("country").cast("int").alias("is_total"), F.sum(F.when(k == 1, F.col("nox")).otherwise(0.0)).alias("area"), F.sum(F.when(k == 2, F.col("nox")).otherwise(0.0)).alias("point"))
    return r.select("country", "is_total", F.round("area", 3).alias("area"), F.round("point", 3).alias("point"))


@query("ag40_coverage", d.with_(d.SOURCES) + """, s AS (SELECT DISTINCT CAST(category AS INT) AS sector, cell_id FROM sources WHERE nox > 40 AND country < 4), z AS (SELECT sector, count(*) AS n_cells FROM s GROUP BY 1),
b AS (SELECT sector FROM z ORDER BY n_cells DESC, sector LIMIT 1)
SELECT z.sector, n_cells, (SELECT count(*) FROM s WHERE s.sector = z.sector AND cell_id NOT IN (SELECT cell_id FROM s WHERE sector = (SELECT sector FROM b))) AS outside FROM z""")
def ag40(spark, sf):
    s = d.sources(spark, sf).where("nox > 40 and country < 4").select(F.col("category").cast("int").alias("sector"), "cell_id")
    return analytics.coverage(s, "sector", "cell_id")


@query("ag41_point_buckets", d.with_(d.FACILITIES) + "SELECT round(f_lon, 1) AS lon, round(f_lat, 1) AS lat, CAST(count(DISTINCT f_gnfr) AS INT) AS n_sectors, string_agg(DISTINCT f_gnfr, ',' ORDER BY f_gnfr) AS sectors, round(sum(r_nox), 4) AS total FROM facilities GROUP BY 1, 2")
def ag41(spark, sf):
    f = d.facilities(spark, sf)
    g = f.groupBy(F.round("f_lon", 1).alias("lon"), F.round("f_lat", 1).alias("lat")).agg(F.array_sort(F.collect_set("f_gnfr")).alias("s"), F.round(F.sum("r_nox"), 4).alias("total"))
    return g.select("lon", "lat", F.size("s").alias("n_sectors"), F.array_join("s", ",").alias("sectors"), "total")


@query("ag44_fire_grid", "SELECT CAST(floor(user_id / 10e0) AS INT) AS r, CAST(floor(value / 50) AS INT) AS c, count(*) AS n, round(sum(value), 4) AS frp FROM events GROUP BY 1, 2")
def ag44(spark, sf):
    e = d.t(spark, sf, "events")
    return e.groupBy(F.floor(F.col("user_id") / 10).cast("int").alias("r"), F.floor(F.col("value") / 50).cast("int").alias("c")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("frp"))


@query("wn08_latest_row", "SELECT o_custkey AS id, round(arg_max(o_totalprice, (o_orderdate, o_orderkey)), 2) AS price FROM orders GROUP BY 1")
def wn08(spark, sf):
    o = d.t(spark, sf, "orders")
    return o.groupBy(F.col("o_custkey").alias("id")).agg(F.round(F.max_by("o_totalprice", F.struct("o_orderdate", "o_orderkey")), 2).alias("price"))


@query("wn09_keep_first", "SELECT c_nationkey AS k, min(c_custkey) AS id FROM customer GROUP BY 1")
def wn09(spark, sf):
    w = Window.partitionBy("c_nationkey").orderBy("c_custkey")
    return d.t(spark, sf, "customer").withColumn("n", F.row_number().over(w)).where("n = 1").select(F.col("c_nationkey").alias("k"), F.col("c_custkey").alias("id"))


@query("wn10_running_share", _RANK + " SELECT c_custkey AS id, round(100 * cum / t, 6) AS share FROM k")
def wn10(spark, sf):
    return analytics.running_share(_e(spark, sf), ["c_mktsegment"], "v", "c_custkey").select(F.col("c_custkey").alias("id"), F.round("share", 6).alias("share"))


@query("wn11_grid_spacing", "WITH c AS (SELECT DISTINCT p_size AS x FROM part), g AS (SELECT x - lag(x) OVER (ORDER BY x) AS g FROM c) SELECT CAST(quantile_cont(g, 0.5) AS DOUBLE) AS spacing FROM g WHERE g IS NOT NULL")
def wn11(spark, sf):
    return analytics.spacing(d.t(spark, sf, "part").select(F.col("p_size").alias("x")), "x")


@query("wn15_primary_facility", d.with_(d.FACILITIES) + "SELECT cell_id, arg_min(facility_id, (CASE f_gnfr WHEN 'B' THEN 0 WHEN 'A' THEN 1 ELSE 2 END, facility_id)) AS facility_id FROM facilities GROUP BY 1")
def wn15(spark, sf):
    order = F.when(F.col("f_gnfr") == "B", 0).when(F.col("f_gnfr") == "A", 1).otherwise(2)
    return d.facilities(spark, sf).groupBy("cell_id").agg(F.min_by("facility_id", F.struct(order, F.col("facility_id"))).alias("facility_id"))


@query("st01_sectors_by_value", _E + "SELECT c_mktsegment AS sector, round(sum(v), 3) AS total, row_number() OVER (ORDER BY sum(v) DESC) AS place FROM e GROUP BY 1")
def st01(spark, sf):
    s = _e(spark, sf).groupBy(F.col("c_mktsegment").alias("sector")).agg(F.sum("v").alias("t"))
    return s.select("sector", F.round("t", 3).alias("total"), F.row_number().over(Window.orderBy(F.desc("t"))).cast("long").alias("place"))


@query("st03_argmax", _E + "SELECT c_nationkey AS cell, arg_max(c_custkey, (v, -c_custkey)) AS id FROM e GROUP BY 1")
def st03(spark, sf):
    return _e(spark, sf).groupBy(F.col("c_nationkey").alias("cell")).agg(F.max_by("c_custkey", F.struct(F.col("v"), -F.col("c_custkey"))).alias("id"))


@query("st05_sector_order", "SELECT DISTINCT o_orderpriority AS sector, CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '1-URGENT' THEN 1 ELSE 2 END AS ordinal FROM orders")
def st05(spark, sf):
    p = F.col("o_orderpriority")
    return d.t(spark, sf, "orders").select(p.alias("sector"), F.when(p == "5-LOW", 0).when(p == "1-URGENT", 1).otherwise(2).alias("ordinal")).distinct()


@query("st06_first_rows", "SELECT p_partkey AS id, p_name AS name FROM part ORDER BY p_partkey LIMIT 20")
def st06(spark, sf):
    return d.t(spark, sf, "part").orderBy("p_partkey").limit(20).select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))


@query("st07_clamp", "SELECT c_custkey AS id, round(least(1e0, greatest(0e0, c_acctbal / 5000)), 8) AS v FROM customer")
def st07(spark, sf):
    from ..functions.numeric import clip01

    return d.t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.round(clip01(F.col("c_acctbal") / 5000), 8).alias("v"))


@query("dc23_bundle", _E + "SELECT c_mktsegment AS pollutant, 'total' AS measure, round(sum(v), 3) AS value FROM e GROUP BY 1 UNION ALL SELECT c_mktsegment, 'median', round(quantile_cont(v, 0.5), 3) FROM e GROUP BY 1 UNION ALL SELECT c_mktsegment, 'cells', count(DISTINCT c_nationkey) FROM e GROUP BY 1")
def dc23(spark, sf):
    g = _e(spark, sf).groupBy(F.col("c_mktsegment").alias("pollutant")).agg(F.round(F.sum("v"), 3).alias("total"), F.round(F.median("v"), 3).alias("median"), F.count_distinct("c_nationkey").cast("double").alias("cells"))
    return g.unpivot(["pollutant"], ["total", "median", "cells"], "measure", "value")


@query("lr05_mass_balance", d.with_(d.PIXELS, d.PIXEL_MASS) + ", b AS (SELECT cell_id % 5 AS k, sum(mass) AS before FROM pixel_mass GROUP BY 1), a AS (SELECT cell_id % 5 AS k, sum(signal) AS after FROM pixels GROUP BY 1) SELECT k, round(before, 2) AS before, round(after, 2) AS after, round(after - before, 2) AS difference FROM a JOIN b USING (k)")
def lr05(spark, sf):
    b = d.pixel_mass(spark, sf).select((F.col("cell_id") % 5).alias("k"), F.col("mass").alias("v"))
    a = d.pixels(spark, sf).select((F.col("cell_id") % 5).alias("k"), F.col("signal").alias("v"))
    return analytics.mass_balance(b, a, ["k"], "v").select("k", *[F.round(c, 2).alias(c) for c in ("before", "after", "difference")])


@query("sk02_link_raster", d.with_(d.POINTS) + "SELECT CAST(floor(lat) AS INT) AS r, CAST(floor(lon) AS INT) AS c, round(sum(nox), 3) AS mass FROM points GROUP BY 1, 2")
def sk02(spark, sf):
    return d.points(spark, sf).groupBy(F.floor("lat").cast("int").alias("r"), F.floor("lon").cast("int").alias("c")).agg(F.round(F.sum("nox"), 3).alias("mass"))


@query("sk04_grid_rows", d.with_(d.PIXELS) + """SELECT 'nox' AS pollutant, col + 0.5e0 AS x, "row" + 0.5e0 AS y, round(signal, 4) AS emission FROM pixels WHERE signal > 0""")
def sk04(spark, sf):
    return d.pixels(spark, sf).where("signal > 0").select(F.lit("nox").alias("pollutant"), (F.col("col") + 0.5).alias("x"), (F.col("row") + 0.5).alias("y"), F.round("signal", 4).alias("emission"))


@query("sk08_geojson", "SELECT n_nationkey AS id, '{\"type\":\"Feature\",\"geometry\":{\"type\":\"Point\",\"coordinates\":[' || n_nationkey || ',' || n_regionkey || ']},\"properties\":{\"name\":\"' || n_name || '\"}}' AS feature FROM nation")
def sk08(spark, sf):
    n = d.t(spark, sf, "nation")
    return n.select(F.col("n_nationkey").alias("id"), export.feature("Point", F.array("n_nationkey", "n_regionkey"), {"name": F.col("n_name")}).alias("feature"))


@query("sk09_tile_values", _E + "SELECT c_custkey AS id, round(least(1e0, greatest(0e0, (log10(v + 0.01e0) - 1) / 3)), 8) AS norm FROM e")
def sk09(spark, sf):
    from ..functions.numeric import clip01

    return _e(spark, sf).select(F.col("c_custkey").alias("id"), F.round(clip01((F.log10(F.col("v") + 0.01) - 1) / 3), 8).alias("norm"))


@query("h08_total_raster", d.with_(d.PIXELS) + 'SELECT cell_id, round(sum(signal) + sum(other), 4) AS total FROM pixels GROUP BY 1')
def h08(spark, sf):
    return d.pixels(spark, sf).groupBy("cell_id").agg(F.round(F.sum("signal") + F.sum("other"), 4).alias("total"))


@query("h09_scale_cascade", "SELECT n_nationkey AS id, coalesce(CASE WHEN n_nationkey % 5 = 0 THEN 1e0 END, CASE WHEN n_nationkey % 2 = 0 THEN 2e0 END, 3e0) AS scale FROM nation")
def h09(spark, sf):
    k = F.col("n_nationkey")
    return d.t(spark, sf, "nation").select(k.alias("id"), F.coalesce(F.when(k % 5 == 0, 1.0), F.when(k % 2 == 0, 2.0), F.lit(3.0)).alias("scale"))


@query("h26_debug_pivot", "SELECT n_regionkey AS region, min(CASE WHEN n_nationkey % 2 = 0 THEN n_name END) AS even, min(CASE WHEN n_nationkey % 2 = 1 THEN n_name END) AS odd FROM nation GROUP BY 1")
def h26(spark, sf):
    n = d.t(spark, sf, "nation").withColumn("k", F.when(F.col("n_nationkey") % 2 == 0, "even").otherwise("odd"))
    return n.groupBy(F.col("n_regionkey").alias("region")).pivot("k", ["even", "odd"]).agg(F.min("n_name"))
