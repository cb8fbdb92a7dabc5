"""Sector signals, the older method, detections and driver-side tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import export, legacy, lines, normalize, signals
from ..streaming import detections
from . import domain as d
from .registry import query

_SIG = """sig AS (SELECT c_custkey AS id, abs(c_acctbal) / 1e4 AS a, c_nationkey / 25e0 AS b, (c_custkey % 10) / 10e0 AS c, (c_custkey % 7) / 5e0 AS e FROM customer),
k AS (SELECT id, a, b, c, e, least(1, greatest(0, a)) AS a1, least(1, greatest(0, b)) AS b1, least(1, greatest(0, c)) AS c1, least(1, greatest(0, e)) AS e1 FROM sig)"""


def _sig(spark, sf):
    k = F.col("c_custkey")
    return d.t(spark, sf, "customer").select(k.alias("id"), (F.abs("c_acctbal") / 1e4).alias("a"), (F.col("c_nationkey") / 25.0).alias("b"), ((k % 10) / 10.0).alias("c"), ((k % 7) / 5.0).alias("e"))





def _signal(name, sql, make):
    @query(name, d.with_(_SIG) + f"SELECT id, round({sql}, 8) AS s FROM k")
    def f(spark, sf):
        s = _sig(spark, sf)
        return s.select("id", F.round(make(*[F.col(c) for c in "abce"]), 8).alias("s"))

    return f


_signal("dc01_public_power", "0.4e0 * greatest(a, 0) + 0.6e0 * b1 * greatest(a, 0)", lambda a, b, c, e: signals.public_power(a, b))
_signal("dc02_industry", "0.7e0 * (0.6e0 * a1 + 0.4e0 * b1) + 0.3e0 * c1", lambda a, b, c, e: signals.industry(a, b, c, 0.3, 0.6, 0.4))
_signal("dc03_shipping", "0.3e0 * a1 + 0.6e0 * b1 + 0.1e0 * c1", lambda a, b, c, e: signals.shipping(a, b, c))
_signal("dc04_waste_solid", "0.55e0 * a1 + 0.15e0 * b1 + 0.3e0 * c1", lambda a, b, c, e: signals.waste_solid(a, b, c))
_signal("dc04_waste_water", "0.35e0 * a1 + 0.35e0 * b1 + 0.05e0 * c1 + 0.25e0 * e1", lambda a, b, c, e: signals.waste_water(a, b, c, e))
_signal("dc04_waste_residual", "0.4e0 * least(1, greatest(0, 1 - c)) + 0.5e0 * b1 + 0.1e0 * e1", lambda a, b, c, e: signals.waste_residual(c, b, e, F.lit(1.0)))
_signal("dc10a_livestock", "b1 * a + (1 - b1) * c", lambda a, b, c, e: b * a + (1 - b) * c)


@query("dc05_solvents", d.with_(_SIG) + """, act AS (SELECT id, 'paint' AS activity, 0.5e0 * a1 + 0.5e0 * b1 AS s FROM k UNION ALL SELECT id, 'print', c1 FROM k), beta(grp, activity, beta) AS (VALUES ('g1', 'paint', 0.8e0), ('g1', 'print', 0.2e0), ('g2', 'print', 1e0))
SELECT id, grp, round(sum(beta * s), 8) AS signal FROM act JOIN beta USING (activity) GROUP BY 1, 2""")
def dc05(spark, sf):
    s = _sig(spark, sf)
    paint = s.select("id", F.lit("paint").alias("activity"), normalize.mixture([(0.5, F.col("a")), (0.5, F.col("b"))]).alias("signal"))
    act = paint.unionByName(s.select("id", F.lit("print").alias("activity"), normalize.mixture([(1.0, F.col("c"))]).alias("signal")))
    beta = spark.createDataFrame([("g1", "paint", 0.8), ("g1", "print", 0.2), ("g2", "paint", 0.0), ("g2", "print", 1.0)], "group string, activity string, beta double")
    return signals.activities_to_groups(act, beta, ["id"]).select("id", F.col("group").alias("grp"), F.round("signal", 8).alias("signal"))


def _grouped(name, parts):
    sql = " UNION ALL ".join(f"SELECT id, '{g}' AS grp, round({' + '.join(f'{w}e0 * {c}1' for w, c in p)}, 8) AS signal FROM k" for g, p in parts.items())

    @query(name, d.with_(_SIG) + sql)
    def f(spark, sf):
        m = signals.grouped({g: [(w, F.col(c)) for w, c in p] for g, p in parts.items()})
        return _sig(spark, sf).select("id", F.explode(m).alias("grp", "v")).select("id", "grp", F.round("v", 8).alias("signal"))

    return f


_grouped("dc06_fugitive", {"coal": [(0.6, "a"), (0.4, "b")], "oil": [(0.5, "a"), (0.2, "c"), (0.75, "e")], "other": [(1.0, "c")]})
_grouped("dc07_offroad", {"rail": [(0.9, "a"), (0.1, "c")], "agri": [(0.7, "b"), (0.3, "e")], "house": [(1.0, "a")]})
_grouped("dc10e_plain_signals", {"pasture": [(1.0, "a")], "buildings": [(1.0, "b")], "broad": [(0.5, "a"), (0.5, "c")]})


@query("dc08_other_combustion", d.with_(_SIG) + """, x AS (SELECT id, 'home' AS k, a * b AS x FROM k UNION ALL SELECT id, 'office', c * e FROM k), m(p, k, m) AS (VALUES ('nox', 'home', 2e0), ('nox', 'office', 3e0), ('co', 'home', 5e0))
SELECT id, p, round(sum(x * m), 8) AS u FROM x JOIN m USING (k) GROUP BY 1, 2""")
def dc08(spark, sf):
    from ..operators.alpha import product_sum

    s = _sig(spark, sf)
    x = s.select("id", (F.col("a") * F.col("b")).alias("home"), (F.col("c") * F.col("e")).alias("office")).unpivot(["id"], ["home", "office"], "k", "x")
    m = spark.createDataFrame([("nox", "home", 2.0), ("nox", "office", 3.0), ("co", "home", 5.0)], "p string, k string, m double")
    return product_sum(x, m, ["k"], ["id", "p"], "x", "m", "u").select("id", "p", F.round("u", 8).alias("u"))


@query("dc09_road_weights", """
WITH r AS (SELECT c_custkey AS id, c_nationkey AS cell_id, c_mktsegment AS road, abs(c_acctbal) AS aadt FROM customer), ef(road, cat, m) AS (VALUES ('BUILDING', 'F1', 2e0), ('BUILDING', 'F4', 1e0), ('MACHINERY', 'F1', 0.5e0)),
s AS (SELECT cat, cell_id, id, sum(aadt * m) AS s FROM r JOIN ef USING (road) GROUP BY 1, 2, 3)
SELECT cat, id, round(CASE WHEN sum(s) OVER c > 0 THEN s / sum(s) OVER c ELSE 1e0 / count(*) OVER c END, 8) AS weight FROM s WINDOW c AS (PARTITION BY cat, cell_id)""")
def dc09(spark, sf):
    from ..operators.alpha import product_sum

    r = d.t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("cell_id"), F.col("c_mktsegment").alias("road"), F.abs("c_acctbal").alias("aadt"))
    ef = spark.createDataFrame([("BUILDING", "F1", 2.0), ("BUILDING", "F4", 1.0), ("MACHINERY", "F1", 0.5)], "road string, cat string, m double")
    s = product_sum(r, ef, ["road"], ["cat", "cell_id", "id"], "aadt", "m", "s")
    return normalize.weights(s, "s", ["cat", "cell_id"]).select("cat", "id", F.round("weight", 8).alias("weight"))


@query("dc10_agriculture", d.with_(_SIG) + """, r AS (SELECT id, id % 9 AS cell_id, a, c FROM k), g AS (SELECT id, cell_id, 'g1' AS grp, CASE WHEN sum(a) OVER w > 0 THEN a / sum(a) OVER w ELSE 1e0 / count(*) OVER w END AS wt FROM r WINDOW w AS (PARTITION BY cell_id)
 UNION ALL SELECT id, cell_id, 'g2', CASE WHEN sum(c) OVER w > 0 THEN c / sum(c) OVER w ELSE 1e0 / count(*) OVER w END FROM r WINDOW w AS (PARTITION BY cell_id)),
m AS (SELECT id, cell_id, sum(CASE grp WHEN 'g1' THEN 0.25e0 ELSE 0.75e0 END * wt) AS s FROM g GROUP BY 1, 2) SELECT id, round(s / sum(s) OVER (PARTITION BY cell_id), 8) AS weight FROM m""")
def dc10(spark, sf):
    r = _sig(spark, sf).withColumn("cell_id", F.col("id") % 9)
    both = normalize.weights(r, "a", ["cell_id"]).withColumn("group", F.lit("g1")).unionByName(normalize.weights(r, "c", ["cell_id"]).withColumn("group", F.lit("g2")))
    alpha = spark.createDataFrame([("nh3", "g1", 0.25), ("nh3", "g2", 0.75)], "pollutant string, group string, alpha double")
    return normalize.fuse(both, alpha, ["id"]).select("id", F.round("weight", 8).alias("weight"))


@query("dc10b_manure", """
WITH p AS (SELECT c_custkey AS id, c_nationkey AS nuts, abs(c_acctbal) * CASE c_mktsegment WHEN 'BUILDING' THEN 1e0 WHEN 'MACHINERY' THEN 0.75e0 ELSE 0.1e0 END AS s FROM customer), t AS (SELECT s_nationkey AS nuts, sum(abs(s_acctbal)) AS n FROM supplier GROUP BY 1)
SELECT id, round(s * n / sum(s) OVER (PARTITION BY nuts), 5) AS n FROM p JOIN t USING (nuts)""")
def dc10b(spark, sf):
    from ..functions.text import lookup

    rate = lookup(F.col("c_mktsegment"), {"BUILDING": 1.0, "MACHINERY": 0.75}, 0.1)
    p = d.t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nuts"), (F.abs("c_acctbal") * rate).alias("s"))
    t = d.t(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("nuts")).agg(F.sum(F.abs("s_acctbal")).alias("target"))
    return normalize.to_target(p.join(t, "nuts"), "s", "nuts", "target", "n").select("id", F.round("n", 5).alias("n"))


@query("dc10c_rate_surface", """
WITH l AS (SELECT s_nationkey AS px, avg(s_acctbal) AS r FROM supplier WHERE s_suppkey % 2 = 0 GROUP BY 1), v AS (SELECT n_nationkey AS px, coalesce(l.r, n_regionkey * 100e0) * 0.01e0 AS v FROM nation LEFT JOIN l ON l.px = n_nationkey) SELECT px, round(v / (max(v) OVER () + 1e-12), 8) AS v FROM v""")
def dc10c(spark, sf):
    l = d.t(spark, sf, "supplier").where("s_suppkey % 2 = 0").groupBy(F.col("s_nationkey").alias("px")).agg(F.avg("s_acctbal").alias("r"))
    n = d.t(spark, sf, "nation").select(F.col("n_nationkey").alias("px"), "n_regionkey")
    v = n.join(l, "px", "left").select("px", (F.coalesce("r", F.col("n_regionkey") * 100.0) * 0.01).alias("v"))
    return normalize.max_scaled(v, "v", "s").select("px", F.round("s", 8).alias("v"))


@query("lr01_nearest_axis", d.with_(d.SOURCES) + "SELECT CAST(greatest(0, least(19, ceil((lon + 9e0) / 2e0 - 0.5e0))) AS INT) AS i, count(*) AS n FROM sources GROUP BY 1")
def lr01(spark, sf):
    return d.sources(spark, sf).groupBy(legacy.nearest_axis(F.col("lon"), -9.0, 2.0, 20).alias("i")).agg(F.count("*").alias("n"))


@query("lr02_sparse_weights", """
WITH p AS (SELECT c_custkey AS id, c_nationkey AS cell_id, CASE WHEN c_nationkey % 5 = 0 THEN 0e0 WHEN c_nationkey % 5 = 1 THEN 1e0 WHEN c_nationkey % 5 = 2 THEN CASE WHEN c_custkey % 40 = 0 THEN abs(c_acctbal) ELSE 0 END ELSE greatest(c_acctbal, 0) END AS p FROM customer),
s AS (SELECT *, count(CASE WHEN p > 0 THEN 1 END) OVER w AS nz, count(*) OVER w AS n, sum(p) OVER w AS t, min(CASE WHEN p > 0 THEN p END) OVER w AS lo, max(CASE WHEN p > 0 THEN p END) OVER w AS hi FROM p WINDOW w AS (PARTITION BY cell_id)),
q AS (SELECT *, nz / 70e0 AS cover, CASE WHEN nz = 0 OR lo = hi THEN 0e0 WHEN nz <= 3 THEN least(nz / 10e0, 0.3e0) WHEN nz / 70e0 < 0.05e0 THEN 1 - least(1 - nz / 70e0 / 0.05e0, 0.8e0) ELSE 1e0 END AS pp FROM s),
m AS (SELECT *, CASE WHEN cover < 0.8e0 THEN pp * greatest(cover, 0.2e0) ELSE pp END AS f FROM q), x AS (SELECT *, f * CASE WHEN t > 0 THEN p / t ELSE 0 END + (1 - f) / n AS mx FROM m)
SELECT id, round(mx / sum(mx) OVER (PARTITION BY cell_id), 8) AS weight FROM x""")
def lr02(spark, sf):
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    p = F.when(n % 5 == 0, 0.0).when(n % 5 == 1, 1.0).when(n % 5 == 2, F.when(k % 40 == 0, F.abs("c_acctbal")).otherwise(0.0)).otherwise(F.greatest(F.col("c_acctbal"), F.lit(0.0)))
    c = d.t(spark, sf, "customer").select(k.alias("id"), n.alias("cell_id"), p.alias("p"))
    return legacy.sparse_weights(c, "p", 70).select("id", F.round("weight", 8).alias("weight"))


@query("lr03_distribution", "SELECT c_custkey AS id, round(sum(abs(c_acctbal)) OVER (PARTITION BY c_nationkey) * (c_custkey % 10) / 10e0, 4) AS top_down, round(abs(c_acctbal) * (c_custkey % 10) / 10e0, 4) AS own FROM customer")
def lr03(spark, sf):
    c = d.t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("cell_id"), F.abs("c_acctbal").alias("value"), ((F.col("c_custkey") % 10) / 10.0).alias("weight"))
    return c.select("id", F.round(legacy.distribute(c, "top_down"), 4).alias("top_down"), F.round(legacy.distribute(c, "coarse_cells"), 4).alias("own"))


@query("lr04_closed_bounds", d.with_(d.FACILITIES) + """, c AS (SELECT CAST(n_nationkey AS BIGINT) AS cell_id, -10e0 + 2 * n_nationkey AS w, -8e0 + 2 * n_nationkey AS e FROM nation), f AS (SELECT facility_id, f_gnfr, c.cell_id FROM facilities JOIN c ON f_lon >= w AND f_lon <= e)
SELECT cell_id, f_gnfr AS sector, count(*) AS n FROM f GROUP BY 1, 2""")
def lr04(spark, sf):
    n = F.col("n_nationkey")
    cells = d.t(spark, sf, "nation").select(n.cast("long").alias("cell_id"), (n * 2 - 10.0).alias("west"), (n * 2 - 8.0).alias("east"), F.lit(0.0).alias("south"), F.lit(90.0).alias("north"))
    f = d.facilities(spark, sf).select("facility_id", F.col("f_gnfr").alias("sector"), "f_lon", "f_lat")
    s = cells.select("cell_id").crossJoin(spark.createDataFrame([("A",), ("B",), ("C",)], "sector string"))
    j = legacy.closed_candidates(s, f, cells).where(F.col("facility_id").isNotNull())
    return j.groupBy("cell_id", "sector").agg(F.count("*").alias("n"))


_MAPPED = "WITH e AS (SELECT substr('ABCDEGHIJKL', CAST(c_custkey % 11 + 1 AS INT), 1) AS sector, abs(c_acctbal) AS v FROM customer), m(sector, snap, f) AS (VALUES {}) SELECT CAST(snap AS INT) AS snap, round(sum(v * f), 3) AS emission FROM e JOIN m USING (sector) GROUP BY 1"


def _values(table):
    return ", ".join(f"('{s}', {k}, {f}e0)" for s, parts in table.items() for k, f in parts)


def _mapped(spark, sf, table):
    e = d.t(spark, sf, "customer").select(F.substring(F.lit("ABCDEGHIJKL"), F.col("c_custkey").cast("int") % 11 + 1, F.lit(1)).alias("sector"), F.abs("c_acctbal").alias("emission"))
    return export.map_sectors(e, table).groupBy("snap").agg(F.round(F.sum("emission"), 3).alias("emission"))


@query("lr07_sector_recode", _MAPPED.format(_values(legacy.AREA_SNAP)))
def lr07(spark, sf):
    return _mapped(spark, sf, legacy.AREA_SNAP)


@query("lr07_point_recode", _MAPPED.format(_values(legacy.POINT_SNAP)))
def lr07b(spark, sf):
    return _mapped(spark, sf, legacy.POINT_SNAP)


@query("lr06_unmatched_to_raster", "SELECT k AS cell, round(sum(v), 3) AS v FROM (SELECT c_nationkey AS k, abs(c_acctbal) AS v FROM customer UNION ALL SELECT s_nationkey, abs(s_acctbal) FROM supplier) GROUP BY 1")
def lr06(spark, sf):
    a = d.t(spark, sf, "customer").select(F.col("c_nationkey").alias("cell_id"), F.lit("nox").alias("pollutant"), F.abs("c_acctbal").alias("mass"))
    b = d.t(spark, sf, "supplier").select(F.col("s_nationkey").alias("cell_id"), F.lit("nox").alias("pollutant"), F.abs("s_acctbal").alias("mass"))
    from ..operators.allocate import burn_unmatched

    return burn_unmatched(a, b).select(F.col("cell_id").alias("cell"), F.round("mass", 3).alias("v"))


@query("lr08_urban_core", "SELECT c_custkey AS id, round(CASE WHEN c_custkey % 4 > 0 THEN 3 * abs(c_acctbal) ELSE abs(c_acctbal) END, 4) AS v FROM customer")
def lr08(spark, sf):
    v = legacy.urban_core(F.abs("c_acctbal"), (F.col("c_custkey") % 4).cast("double"))
    return d.t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.round(v, 4).alias("v"))


@query("lr09_clipped_line_shares", """
WITH l AS (SELECT s_suppkey AS id, CAST(s_suppkey % 10 AS DOUBLE) AS x1, s_nationkey + 0.5e0 AS x2, CASE s_suppkey % 3 WHEN 0 THEN 'motorway' WHEN 1 THEN 'tertiary' ELSE 'primary' END AS g FROM supplier),
s AS (SELECT id, g, c AS cell_id, least(greatest(x1, x2), c + 1) - greatest(least(x1, x2), c) AS len FROM l, range(0, 30) b(c) WHERE least(x1, x2) < c + 1 AND greatest(x1, x2) > c),
w AS (SELECT *, CASE g WHEN 'motorway' THEN 10e0 WHEN 'tertiary' THEN 1e0 ELSE 2e0 END AS w FROM s WHERE len > 0), t AS (SELECT cell_id, sum(w) AS sw FROM (SELECT DISTINCT cell_id, g, w FROM w) GROUP BY 1),
x AS (SELECT id, len / sum(len) OVER (PARTITION BY cell_id, g) * w / sw * 100 AS m FROM w JOIN t USING (cell_id)) SELECT id, round(sum(m), 6) AS m FROM x GROUP BY 1""")
def lr09(spark, sf):
    g = F.element_at(F.array(F.lit("motorway"), F.lit("tertiary"), F.lit("primary")), (F.col("s_suppkey") % 3 + 1).cast("int"))
    s = d.t(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), (F.col("s_suppkey") % 10).cast("double").alias("x1"), (F.col("s_nationkey") + 0.5).alias("x2"), g.alias("group"), F.lit(0.5).alias("y1"), F.lit(0.5).alias("y2"))
    k = lines.segments_in_cells(s, 1.0).withColumn("cell_id", F.col("c")).withColumn("mass", F.lit(100.0))
    return lines.line_shares(k, "inside", "mass", lines.WEIGHT_WITH_TERTIARY).groupBy("id").agg(F.round(F.sum("line_mass"), 6).alias("m"))


@query("st_tumbling_peak", "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS start, user_id % 25 AS cell, round(max(value), 4) AS peak, count(*) AS n FROM events GROUP BY 1, 2")
def st_tumbling(spark, sf):
    t = detections.tumbling_max(d.fires(spark, sf))
    return t.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "cell", F.round("peak", 4).alias("peak"), "n")


@query("st_sliding_total", """
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS start, cell, round(sum(value), 4) AS total FROM (SELECT user_id % 25 AS cell, value, date_trunc('day', ts) - k * INTERVAL 1 DAY AS w FROM events, range(0, 7) r(k)) GROUP BY 1, 2""")
def st_sliding(spark, sf):
    return detections.sliding_sum(d.fires(spark, sf)).select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "cell", F.round("total", 4).alias("total"))


@query("st_episodes", """
WITH e AS (SELECT user_id % 25 AS cell, ts, value, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 12 HOUR THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id % 25 ORDER BY ts)),
g AS (SELECT *, sum(new) OVER (PARTITION BY cell ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e) SELECT cell, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n, round(sum(value), 4) AS total FROM g GROUP BY cell, k""")
def st_episodes(spark, sf):
    return detections.episodes(d.fires(spark, sf)).select("cell", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n", F.round("total", 4).alias("total"))


@query("st_deduplicated", "SELECT count(DISTINCT event_id) AS n FROM events")
def st_dedup(spark, sf):
    f = d.fires(spark, sf)
    return detections.deduplicated(f.unionByName(f)).agg(F.count("*").alias("n"))
