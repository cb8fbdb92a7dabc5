"""Raster and vector operators on long tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo, numeric
from ..operators import lines, raster
from . import domain as d
from .registry import query

_MASK = 'mask AS (SELECT DISTINCT CAST(s_suppkey % 25 AS INT) AS "row", CAST(s_nationkey AS INT) AS col FROM supplier)'


def _mask(spark, sf):
    return d.t(spark, sf, "supplier").select((F.col("s_suppkey") % 25).cast("int").alias("row"), F.col("s_nationkey").cast("int").alias("col")).distinct()


@query("rv01_pixel_centres", "SELECT n_nationkey AS i, -10e0 + (n_nationkey + 0.5e0) * 2 AS x FROM nation")
def rv01(spark, sf):
    n = d.t(spark, sf, "nation")
    return n.select(F.col("n_nationkey").alias("i"), numeric.pixel_centre(F.col("n_nationkey"), -10.0, 2.0).alias("x"))


_SRC = 'src AS (SELECT CAST(s_suppkey % 10 AS INT) AS "row", CAST(s_nationkey % 10 AS INT) AS col, sum(s_acctbal) AS value FROM supplier GROUP BY 1, 2)'
_TGT = "tgt AS (SELECT r * 7 + c AS id, 0.3e0 + c * 1.4e0 AS x, 0.2e0 + r * 1.4e0 AS y FROM range(0, 7) a(r), range(0, 7) b(c))"


def _src(spark, sf):
    return d.t(spark, sf, "supplier").groupBy((F.col("s_suppkey") % 10).cast("int").alias("row"), (F.col("s_nationkey") % 10).cast("int").alias("col")).agg(F.sum("s_acctbal").alias("value"))


def _tgt(spark):
    r, c = F.floor(F.col("id") / 7), F.col("id") % 7
    return spark.range(49).select("id", (0.3 + c * 1.4).alias("x"), (0.2 + r * 1.4).alias("y"))


@query("rv02_nearest", d.with_(_SRC, _TGT) + 'SELECT id, round(value, 4) AS value FROM tgt LEFT JOIN src ON "row" = floor(y) AND col = floor(x)')
def rv02(spark, sf):
    return raster.resample_nearest(_src(spark, sf), _tgt(spark), 0.0, 0.0, 1.0, 1.0).select("id", F.round("value", 4).alias("value"))


@query("rv02_bilinear", d.with_(_SRC, _TGT) + """, k AS (SELECT id, y - 0.5e0 AS v, x - 0.5e0 AS u, a, b FROM tgt, range(0, 2) p(a), range(0, 2) q(b)),
w AS (SELECT id, CASE a WHEN 1 THEN v - floor(v) ELSE 1 - (v - floor(v)) END * CASE b WHEN 1 THEN u - floor(u) ELSE 1 - (u - floor(u)) END AS w, floor(v) + a AS r, floor(u) + b AS c FROM k)
SELECT id, round(sum(w * value) / sum(CASE WHEN value IS NOT NULL THEN w END), 4) AS value FROM w LEFT JOIN src ON "row" = r AND col = c WHERE w > 0 GROUP BY 1""")
def rv02b(spark, sf):
    return raster.resample_bilinear(_src(spark, sf), _tgt(spark), 0.0, 0.0, 1.0, 1.0).select("id", F.round("value", 4).alias("value"))


@query("rv03_disk_pixels", """
WITH p AS (SELECT s_suppkey AS id, s_suppkey % 13 + 0.25e0 AS x, s_nationkey + 0.75e0 AS y FROM supplier)
SELECT id, count(*) AS n FROM p, range(-5, 40) a(r), range(-5, 40) b(c) WHERE pow(greatest(c - x, x - (c + 1), 0), 2) + pow(greatest(r - y, y - (r + 1), 0), 2) <= 4 GROUP BY 1""")
def rv03(spark, sf):
    p = d.t(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), (F.col("s_suppkey") % 13 + 0.25).alias("x"), (F.col("s_nationkey") + 0.75).alias("y"))
    return raster.disk_pixels(p, F.lit(2.0), 1.0).groupBy("id").agg(F.count("*").alias("n"))


@query("rv05_region_ids", "SELECT CAST(c AS INT) AS col, max(n_nationkey) AS region FROM range(0, 60) b(c) LEFT JOIN nation ON c + 0.5e0 >= 2 * n_nationkey AND c + 0.5e0 < 2 * n_nationkey + 3 GROUP BY 1")
def rv05(spark, sf):
    from ..operators.cells import range_join

    axis = d.t(spark, sf, "nation").select("n_nationkey", (F.col("n_nationkey") * 2.0).alias("low"), (F.col("n_nationkey") * 2.0 + 3).alias("high"))
    p = spark.range(60).select(F.col("id").cast("int").alias("col"), (F.col("id") + 0.5).alias("x"))
    return range_join(p, "x", axis, "low", "high", 3.0, "left").groupBy("col").agg(F.max("n_nationkey").alias("region"))


@query("rv06_dilation", d.with_(_MASK) + 'SELECT DISTINCT CAST("row" + a AS INT) AS "row", CAST(col + b AS INT) AS col FROM mask, range(-2, 3) p(a), range(-2, 3) q(b) WHERE a * a + b * b <= 4')
def rv06(spark, sf):
    return raster.dilate(_mask(spark, sf), 2)


@query("rv07_patches", """WITH RECURSIVE """ + _MASK.replace("SELECT DISTINCT", "SELECT DISTINCT") + """,
m AS (SELECT "row" AS r, col AS c, "row" * 1000 + col AS id FROM mask WHERE ("row" + col) % 3 = 0), l AS (SELECT a.id AS a, b.id AS b FROM m a JOIN m b ON abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1 AND a.id <> b.id),
t AS (SELECT id, id AS root FROM m UNION SELECT l.b, t.root FROM t JOIN l ON l.a = t.id), k AS (SELECT id, min(root) AS root FROM t GROUP BY 1)
SELECT root // 1000 AS r, root % 1000 AS c, count(*) AS n, round(avg(m.r), 6) AS mean_r, round(avg(m.c), 6) AS mean_c FROM k JOIN m USING (id) GROUP BY 1, 2 HAVING count(*) >= 2""")
def rv07(spark, sf):
    p = raster.patches(_mask(spark, sf).where("(row + col) % 3 = 0"), 2)
    r = F.floor(F.col("patch") / 2147483648)
    return p.select(r.cast("int").alias("r"), (F.col("patch") % 2147483648).cast("int").alias("c"), "n", F.round("row", 6).alias("mean_r"), F.round("col", 6).alias("mean_c"))


@query("rv08_clip_lines", """
WITH s AS (SELECT s_suppkey AS id, CAST(s_suppkey % 10 AS DOUBLE) AS x1, s_nationkey + 0.5e0 AS x2, abs(s_acctbal) AS m FROM supplier)
SELECT id, round(m * greatest(0, least(greatest(x1, x2), 12e0) - greatest(least(x1, x2), 3e0)) / abs(x2 - x1), 5) AS m FROM s""")
def rv08(spark, sf):
    s = d.t(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), (F.col("s_suppkey") % 10).cast("double").alias("x1"), (F.col("s_nationkey") + 0.5).alias("x2"), F.abs("s_acctbal").alias("m"))
    y, box = F.lit(1.0), (F.lit(3.0), F.lit(0.0), F.lit(12.0), F.lit(2.0))
    return s.select("id", F.round(F.col("m") * geo.clip_length_share(F.col("x1"), y, F.col("x2"), y, box), 5).alias("m"))


@query("rv09_buffer_distance", "SELECT count(*) AS n FROM customer WHERE abs(c_acctbal) / 100 <= 20 AND c_nationkey BETWEEN 3 AND 12")
def rv09(spark, sf):
    c = d.t(spark, sf, "customer")
    x, y = F.col("c_nationkey").cast("double"), F.abs("c_acctbal") / 100
    dist = geo.segment_distance(x, y, F.lit(3.0), F.lit(0.0), F.lit(12.0), F.lit(0.0))
    return c.where((dist <= 20) & x.between(3, 12)).agg(F.count("*").alias("n"))


@query("rv11_output_grid", d.with_(d.FACILITIES) + """, g AS (SELECT floor((min(f_lon) + 20) / 0.5e0) * 0.5e0 - 20 AS w, ceil((max(f_lon) + 20) / 0.5e0) * 0.5e0 - 20 AS e, 60 - floor((60 - max(f_lat)) / 0.5e0) * 0.5e0 AS n, 60 - ceil((60 - min(f_lat)) / 0.5e0) * 0.5e0 AS s FROM facilities),
z AS (SELECT w, n, CAST(round((n - s) / 0.5e0) AS INT) AS h, CAST(round((e - w) / 0.5e0) AS INT) AS v FROM g)
SELECT h AS height, v AS width, CAST(h AS BIGINT) * v AS n, round(h * (v * w + 0.5e0 * v * v / 2), 4) AS sx FROM z""")
def rv11(spark, sf):
    b = d.facilities(spark, sf).agg(F.min("f_lon").alias("w"), F.min("f_lat").alias("s"), F.max("f_lon").alias("e"), F.max("f_lat").alias("n")).first()
    west, north, h, w = raster.output_grid(b["w"], b["s"], b["e"], b["n"], 0.25, 0.5, (-20.0, 60.0))
    return raster.grid(spark, h, w, west, north, 0.5, -0.5).agg(F.lit(h).alias("height"), F.lit(w).alias("width"), F.count("*").alias("n"), F.round(F.sum("x"), 4).alias("sx"))


@query("rv12_table_to_raster", d.with_(d.SOURCES) + 'SELECT CAST(floor((lat - 35e0) / 0.5e0) AS INT) AS "row", CAST(floor((lon + 10e0) / 0.5e0) AS INT) AS col, round(sum(nox), 4) AS value FROM sources GROUP BY 1, 2')
def rv12(spark, sf):
    s = d.sources(spark, sf)
    return s.groupBy(numeric.floor_index(F.col("lat"), 35.0, 0.5).alias("row"), numeric.floor_index(F.col("lon"), -10.0, 0.5).alias("col")).agg(F.round(F.sum("nox"), 4).alias("value"))


@query("rv13_bbox_transform", "SELECT n_nationkey AS id, round(radians(-10e0 + 2 * n_nationkey) * 6378137e0, 3) AS west, round(radians(-8e0 + 2 * n_nationkey) * 6378137e0, 3) AS east FROM nation")
def rv13(spark, sf):
    n = d.t(spark, sf, "nation")
    w = F.col("n_nationkey") * 2 - 10.0
    corners = [geo.to_mercator(x, y) for x in (w, w + 2) for y in (F.lit(35.0), F.lit(40.0))]
    west, _, east, _ = geo.corner_box([c[0] for c in corners], [c[1] for c in corners])
    return n.select(F.col("n_nationkey").alias("id"), F.round(west, 3).alias("west"), F.round(east, 3).alias("east"))


@query("rv14_painted_over", """
WITH a AS (SELECT CAST(s_suppkey AS INT) AS "row", 0 AS col, 'lucas' AS g FROM supplier WHERE s_suppkey % 3 = 0), b AS (SELECT CAST(s_suppkey AS INT) AS "row", 0 AS col, 'cover' AS g FROM supplier WHERE s_suppkey % 2 = 0)
SELECT coalesce(a."row", b."row") AS "row", 0 AS col, coalesce(a.g, b.g) AS g FROM a FULL JOIN b ON a."row" = b."row\"""")
def rv14(spark, sf):
    s = d.t(spark, sf, "supplier").select(F.col("s_suppkey").cast("int").alias("row"), F.lit(0).alias("col"))
    return raster.painted_over(s.where("row % 3 = 0").withColumn("g", F.lit("lucas")), s.where("row % 2 = 0").withColumn("g", F.lit("cover")), "g")


@query("rv15_unique_facility_ids", "SELECT s_suppkey AS id, 'n' || s_nationkey || CASE WHEN row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) > 1 THEN '_' || row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) ELSE '' END AS fid FROM supplier WHERE s_acctbal > 0")
def rv15(spark, sf):
    from pyspark.sql import Window

    k = F.row_number().over(Window.partitionBy("s_nationkey").orderBy("s_suppkey"))
    s = d.t(spark, sf, "supplier").where("s_acctbal > 0").withColumn("k", k)
    suffix = F.when(F.col("k") > 1, F.concat(F.lit("_"), F.col("k").cast("string"))).otherwise("")
    return s.select(F.col("s_suppkey").alias("id"), F.concat(F.lit("n"), F.col("s_nationkey").cast("string"), suffix).alias("fid"))


@query("ag07_zonal_area", "SELECT c_nationkey AS region, c_mktsegment AS crop, round(sum(c_custkey * 0.01e0), 4) AS area FROM customer GROUP BY 1, 2")
def ag07(spark, sf):
    return d.t(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("region"), F.col("c_mktsegment").alias("crop")).agg(F.round(F.sum(F.col("c_custkey") * 0.01), 4).alias("area"))


@query("ag11_pixel_max", d.with_(d.SOURCES) + "SELECT cell_id, max(co) AS top FROM sources GROUP BY 1")
def ag11(spark, sf):
    return d.sources(spark, sf).groupBy("cell_id").agg(F.max("co").alias("top"))


@query("ag12_buffered_mean", """
WITH p AS (SELECT s_suppkey % 13 + 0.25e0 AS x, s_nationkey + 0.75e0 AS y, s_acctbal AS v FROM supplier)
SELECT CAST(r AS INT) AS "row", CAST(c AS INT) AS col, round(avg(v), 6) AS v FROM p, range(-5, 40) a(r), range(-5, 40) b(c) WHERE pow(greatest(c - x, x - (c + 1), 0), 2) + pow(greatest(r - y, y - (r + 1), 0), 2) <= 4 GROUP BY 1, 2""")
def ag12(spark, sf):
    p = d.t(spark, sf, "supplier").select((F.col("s_suppkey") % 13 + 0.25).alias("x"), (F.col("s_nationkey") + 0.75).alias("y"), F.col("s_acctbal").alias("v"))
    return raster.disk_pixels(p, F.lit(2.0), 1.0).groupBy("row", "col").agg(F.round(F.avg("v"), 6).alias("v"))


@query("h11_group_masks", """
WITH p AS (SELECT CASE s_suppkey % 2 WHEN 0 THEN 'low' ELSE 'high' END AS g, s_suppkey % 13 + 0.25e0 AS x, s_nationkey + 0.75e0 AS y FROM supplier)
SELECT g, count(*) AS n FROM (SELECT DISTINCT g, r, c FROM p, range(-5, 40) a(r), range(-5, 40) b(c) WHERE pow(greatest(c - x, x - (c + 1), 0), 2) + pow(greatest(r - y, y - (r + 1), 0), 2) <= 1) GROUP BY 1""")
def h11(spark, sf):
    p = d.t(spark, sf, "supplier").select(F.when(F.col("s_suppkey") % 2 == 0, "low").otherwise("high").alias("g"), (F.col("s_suppkey") % 13 + 0.25).alias("x"), (F.col("s_nationkey") + 0.75).alias("y"))
    return raster.disk_pixels(p, F.lit(1.0), 1.0).select("g", "row", "col").distinct().groupBy("g").agg(F.count("*").alias("n"))


@query("dc10d_burning", "SELECT r, c, round(max(v), 4) AS frp FROM (SELECT CAST(user_id % 25 AS INT) AS r, CAST(floor(value / 50) AS INT) AS c, value AS v FROM events) e WHERE EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = r) GROUP BY 1, 2")
def dc10d(spark, sf):
    e = d.t(spark, sf, "events").select((F.col("user_id") % 25).cast("int").alias("r"), F.floor(F.col("value") / 50).cast("int").alias("c"), F.col("value").alias("v"))
    crop = d.t(spark, sf, "supplier").select(F.col("s_nationkey").alias("r")).distinct()
    return e.join(crop, "r", "left_semi").groupBy("r", "c").agg(F.round(F.max("v"), 4).alias("frp"))


@query("dc21_city_lines", """
WITH l AS (SELECT s_suppkey AS id, s_nationkey AS cell_id, CASE s_suppkey % 3 WHEN 0 THEN 'motorway' WHEN 1 THEN 'primary' ELSE 'secondary' END AS g, 1e0 + s_suppkey % 7 AS len FROM supplier),
w AS (SELECT *, CASE g WHEN 'motorway' THEN 10e0 ELSE 2e0 END AS w FROM l), s AS (SELECT cell_id, sum(w) AS sw FROM (SELECT DISTINCT cell_id, g, w FROM w) GROUP BY 1)
SELECT id, CASE g WHEN 'motorway' THEN 20e0 ELSE 12e0 END AS width, round(len / sum(len) OVER (PARTITION BY cell_id, g) * w / sw * 1000 * (1000e0 / (365 * 24 * 3600)), 9) AS g_per_s FROM w JOIN s USING (cell_id)""")
def dc21(spark, sf):
    g = F.element_at(F.array(F.lit("motorway"), F.lit("primary"), F.lit("secondary")), (F.col("s_suppkey") % 3 + 1).cast("int"))
    l = d.t(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("cell_id"), g.alias("group"), (F.col("s_suppkey") % 7 + 1.0).alias("len"), F.lit(1000.0).alias("mass"))
    from ..functions.text import lookup

    s = lines.line_shares(l, "len", "mass")
    return s.select("id", lookup(F.col("group"), lines.WIDTH).alias("width"), F.round(lines.grams_per_second(F.col("line_mass")), 9).alias("g_per_s"))
