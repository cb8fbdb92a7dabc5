"""Factor tables, layers, rasters of plants and regions, round trips through writers."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import geo
from ..operators import allocate, cells, cube, export, joins, normalize, raster, rules
from ..sources import readers, writers
from ..sources.shared import shared_folder
from . import domain as d
from .q_points import _BASE
from .q_rules import _LAYERS, _TAGS
from .registry import query


def _folder(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("sc34_factor_lines", """
WITH l AS (SELECT p_partkey AS "order", string_split(lower(p_type), ' ') AS classes, lower(p_brand) AS fuel, p_size * CASE WHEN p_size % 2 = 0 THEN 1e0 ELSE 1000e0 END AS ef FROM part WHERE p_size % 5 <> 0)
SELECT class, fuel, count(*) AS n, round(sum(ef), 3) AS ef, min("order") AS first FROM (SELECT UNNEST(classes) AS class, * FROM l) WHERE class <> '' GROUP BY 1, 2""")
def sc34(spark, sf):
    size = F.col("p_size")
    unit, ef = F.when(size % 2 == 0, "g/GJ").otherwise("kg/GJ"), F.when(size % 5 != 0, size.cast("string")).otherwise("n.a")
    lines = d.t(spark, sf, "part").select(F.col("p_partkey").alias("at"), F.concat_ws(";", F.replace("p_type", F.lit(" "), F.lit(" , ")), "p_brand", unit, ef, "p_name").alias("value"))
    f = readers.factor_table(lines)
    long = f.select(F.explode("classes").alias("class"), F.col("fuels"), "ef", "order").withColumn("fuel", F.explode("fuels"))
    return long.groupBy("class", "fuel").agg(F.count("*").alias("n"), F.round(F.sum("ef"), 3).alias("ef"), F.min("order").alias("first"))


@query("sc32_lines_of_segments", """
WITH c AS (SELECT c_custkey AS k, c_mktsegment AS f, c_nationkey AS n FROM customer)
SELECT f AS fuel, 'a' || k AS appliance, round(n / 1e2, 4) AS share FROM c WHERE n > 0 AND k % 3 <> 0""")
def sc32(spark, sf):
    c = d.t(spark, sf, "customer")
    k, n = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    body = c.select(k.alias("at"), F.concat_ws(",", "c_mktsegment", F.concat(F.lit("a"), k.cast("string")), F.lit("x"), F.lit("7"), F.when(k % 3 == 0, "n.a").otherwise(n)).alias("value"))
    head = spark.createDataFrame([(-2, "title"), (-1, "fuel,appliance,[% of fuel input],2015,2020")], "at long, value string")
    s = readers.share_lines(head.unionByName(body), "2020")
    return s.select("fuel", "appliance", F.round("share", 4).alias("share"))


@query("sc34_factor_table", "SELECT lower(p_brand) AS fuel, count(*) AS n, round(max(p_size * CASE WHEN p_size % 2 = 0 THEN 1e0 ELSE 1000e0 END), 3) AS ef FROM part WHERE p_size % 5 <> 0 GROUP BY 1")
def sc34_table(spark, sf):
    size = F.col("p_size")
    unit, ef = F.when(size % 2 == 0, "g/GJ").otherwise("kg/GJ"), F.when(size % 5 != 0, size.cast("string")).otherwise("n.a")
    lines = d.t(spark, sf, "part").select(F.col("p_partkey").alias("at"), F.concat_ws(";", F.lit("f1"), "p_brand", unit, ef, "p_name").alias("value"))
    long = readers.factor_table(lines).withColumn("fuel", F.explode("fuels"))
    return long.groupBy("fuel").agg(F.count("*").alias("n"), F.round(F.max("ef"), 3).alias("ef"))


@query("sc32_share_lines", "SELECT c_mktsegment AS fuel, count(*) AS n, round(sum((c_custkey % 40 + 1) / 1e2), 4) AS share FROM customer GROUP BY 1")
def sc32_shares(spark, sf):
    k = F.col("c_custkey")
    body = d.t(spark, sf, "customer").select(k.alias("at"), F.concat_ws(",", "c_mktsegment", F.concat(F.lit("a"), k.cast("string")), F.lit("x"), (k % 40 + 1).cast("string"), F.lit("n.a")).alias("value"))
    head = spark.createDataFrame([(-2, "title"), (-1, "fuel,appliance,[% of fuel input],2015,2020")], "at long, value string")
    s = readers.share_lines(head.unionByName(body), "2015")
    return s.groupBy("fuel").agg(F.count("*").alias("n"), F.round(F.sum("share"), 4).alias("share"))


_CUBE_SQL = "WITH s AS (SELECT n_nationkey AS nation, s_suppkey % 4 AS g, s_suppkey % 3 AS f, sum(abs(s_acctbal)) AS v FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2, 3)"


def _cubes(spark, sf):
    """One cube a nation: geo x fuel, its values dense or sparse, built from the suppliers."""
    s = d.t(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("nation"), (F.col("s_suppkey") % 4).alias("g"), (F.col("s_suppkey") % 3).alias("f")).agg(F.sum(F.abs("s_acctbal")).alias("v"))
    at = (F.col("g") * 3 + F.col("f")).cast("int")
    held = s.groupBy("nation").agg(F.map_from_entries(F.collect_list(F.struct(at.cast("string").alias("k"), F.col("v").alias("v")))).alias("m"))
    dense = F.to_json(F.transform(F.sequence(F.lit(0), F.lit(11)), lambda i: F.try_element_at("m", i.cast("string"))), {"ignoreNullFields": "false"})
    value = F.when(F.col("nation") % 2 == 0, F.to_json("m")).otherwise(dense)
    index = lambda p, n: F.create_map(*[x for i in range(n) for x in (F.lit(f"{p}{i}"), F.lit(i))])
    category = lambda p, n: F.struct(F.lit(p).alias("label"), F.struct(index(p, n).alias("index"), F.create_map(F.lit(p), F.lit(p)).alias("label")).alias("category"))
    text = held.select("nation", F.to_json(F.struct(F.array(F.lit("geo"), F.lit("fuel")).alias("id"), F.array(F.lit(4), F.lit(3)).alias("size"), value.alias("value"), F.create_map(F.lit("geo"), category("g", 4), F.lit("fuel"), category("f", 3)).alias("dimension"))).alias("j"))
    return text.select("nation", F.from_json("j", cube.SCHEMA).alias("c")).select("nation", "c.*")


@query("sc33_cubes_of_nations", _CUBE_SQL + " SELECT nation, 'g' || g AS geo, 'f' || f AS fuel, round(v, 4) AS value FROM s")
def sc33(spark, sf):
    return cube.unroll(_cubes(spark, sf), ["geo", "fuel"], ["nation"]).select("nation", "geo", "fuel", F.round("value", 4).alias("value"))


@query("fn19_cube_unroll", _CUBE_SQL + " SELECT 'g' || g AS geo, 'f' || f AS fuel, count(*) AS n FROM s GROUP BY 1, 2")
def fn19(spark, sf):
    return cube.unroll(_cubes(spark, sf), ["geo", "fuel"]).groupBy("geo", "fuel").agg(F.count("*").alias("n"))


@query("fn20_value_block", _CUBE_SQL + """ SELECT nation, CAST(g * 3 + f AS BIGINT) AS "at", round(v, 4) AS value FROM s""")
def fn20(spark, sf):
    return cube.values(_cubes(spark, sf).select("nation", "value"), "value").select("nation", "at", F.round("value", 4).alias("value"))


@query("h16_cube_observation", _CUBE_SQL + " SELECT round(max(v), 4) AS value FROM s WHERE g = 1 AND f = 2")
def h16(spark, sf):
    return cube.observation(cube.unroll(_cubes(spark, sf), ["geo", "fuel"]), geo="g1", fuel="f2").select(F.round("value", 4).alias("value"))


@query("sc33_cube_read", _CUBE_SQL + " SELECT 'g' || g AS geo, round(sum(v), 4) AS total FROM s GROUP BY 1")
def sc33_read(spark, sf):
    return cube.unroll(_cubes(spark, sf), ["geo"]).groupBy("geo").agg(F.round(F.sum("value"), 4).alias("total"))


@query("h03_rules_run", _TAGS + """, a AS (SELECT id, 'eleven' AS layer, 0 AS p FROM t WHERE brand = 'Brand#11' UNION ALL SELECT id, 'small', 1 FROM t WHERE kind = 'node' AND size IN ('1', '2', '3'))
SELECT 'classify' AS mode, id, layer FROM a UNION ALL SELECT 'rules', id, arg_min(layer, p) FROM a GROUP BY id""")
def h03(spark, sf):
    run = lambda mode: rules.run_sector(d.tags(spark, sf), _LAYERS, "tags", ["id"], mode).select(F.lit(mode).alias("mode"), "id", "layer")
    return run("classify").unionByName(run("rules"))


@query("h07_layer_grid", d.with_(d.SOURCES) + """, g AS (SELECT cell_id, CASE source_type WHEN 1 THEN 'area' ELSE 'point' END AS layer, sum(nox) AS nox FROM sources GROUP BY 1, 2)
SELECT 'separate' AS run, layer, cell_id, round(nox, 3) AS nox FROM g UNION ALL SELECT 'merged', 'area', cell_id, round(sum(nox), 3) FROM g GROUP BY cell_id""")
def h07(spark, sf):
    g = d.sources(spark, sf).withColumn("layer", F.when(F.col("source_type") == 1, "area").otherwise("point"))
    parts = [export.layer_grid(g, "nox", merged).select(F.lit(run).alias("run"), "layer", "cell_id", F.round("nox", 3).alias("nox")) for run, merged in (("separate", False), ("merged", True))]
    return parts[0].unionByName(parts[1])


@query("h13_plant_rasters", """
WITH p AS (SELECT s_suppkey AS plant, (s_suppkey % 37) * 0.9e0 AS x, (s_suppkey % 23) * 1.3e0 AS y, abs(s_acctbal) AS load, (s_suppkey % 4) * 0.8e0 AS rad FROM supplier),
o AS (SELECT *, CAST(floor(y) AS INT) AS r, CAST(floor(x) AS INT) AS c FROM p),
k AS (SELECT plant, load, CAST(a.r AS INT) AS r, CAST(b.c AS INT) AS c FROM p, range(-5, 40) a(r), range(-5, 45) b(c) WHERE pow(x - (b.c + 0.5e0), 2) + pow(y - (a.r + 0.5e0), 2) <= pow(rad, 2)),
al AS (SELECT * FROM k UNION ALL SELECT plant, load, r, c FROM o WHERE plant NOT IN (SELECT plant FROM k)), n AS (SELECT plant, count(*) AS n FROM al GROUP BY 1)
SELECT 'plants' AS layer, r AS "row", c AS col, round(sum(load), 7) AS value FROM o GROUP BY 2, 3 UNION ALL SELECT 'agglomerations', r, c, round(sum(load / n), 7) FROM al JOIN n USING (plant) GROUP BY 2, 3""")
def h13(spark, sf):
    k = F.col("s_suppkey")
    p = d.t(spark, sf, "supplier").select(k.alias("plant"), ((k % 37) * F.lit(0.9)).alias("x"), ((k % 23) * F.lit(1.3)).alias("y"), F.abs("s_acctbal").alias("load"), ((k % 4) * F.lit(0.8)).alias("rad"))
    return raster.plant_rasters(p, 1.0, (F.col("plant") % 4) * F.lit(0.8)).select("layer", "row", "col", F.round("value", 7).alias("value"))


@query("h15_region_plane", """
WITH g AS (SELECT CAST(a.r AS INT) AS "row", CAST(b.c AS INT) AS col, b.c + 0.5e0 AS x, a.r + 0.5e0 AS y FROM range(0, 20) a(r), range(0, 60) b(c)),
b AS (SELECT n_nationkey AS region, 2e0 * n_nationkey AS w, 2e0 * n_nationkey + 3 AS e, n_regionkey * 2e0 AS s, n_regionkey * 2e0 + 8 AS n FROM nation)
SELECT "row", col, coalesce(max(region), -1) AS region FROM g LEFT JOIN b ON x >= w AND x < e AND y >= s AND y < n GROUP BY 1, 2""")
def h15(spark, sf):
    n, r = F.col("n_nationkey"), F.col("n_regionkey")
    boxes = d.t(spark, sf, "nation").select(n.alias("region"), (n * 2.0).alias("west"), (n * 2.0 + 3).alias("east"), (r * 2.0).alias("south"), (r * 2.0 + 8).alias("north"))
    return raster.region_plane(raster.grid(spark, 20, 60, 0.0, 0.0, 1.0, 1.0).select("row", "col", "x", "y"), boxes, 3.0).select("row", "col", "region")


@query("h19_airport_patches", """
WITH RECURSIVE m AS (SELECT DISTINCT CAST(s_suppkey % 41 AS INT) AS r, CAST(s_suppkey % 29 AS INT) AS c, (s_suppkey % 41) * 1000 + s_suppkey % 29 AS id FROM supplier WHERE s_suppkey % 41 <= 35 AND s_suppkey % 29 <= 25 AND s_suppkey % 41 >= 2),
l AS (SELECT a.id AS a, b.id AS b FROM m a JOIN m b ON abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1 AND a.id <> b.id), t AS (SELECT id, id AS root FROM m UNION SELECT l.b, t.root FROM t JOIN l ON l.a = t.id),
k AS (SELECT id, min(root) AS root FROM t GROUP BY 1), p AS (SELECT root, count(*) AS n, avg(c) + 0.5e0 AS x, avg(r) + 0.5e0 AS y FROM k JOIN m USING (id) GROUP BY 1)
SELECT n, round(x, 6) AS x, round(y, 6) AS y FROM p WHERE x > 1.1e0 AND y > 2.2e0 AND x / 30.1e0 + y / 40.2e0 < 1""")
def h19(spark, sf):
    k = F.col("s_suppkey")
    mask = d.t(spark, sf, "supplier").select((k % 41).cast("int").alias("row"), (k % 29).cast("int").alias("col")).distinct()
    corner = lambda x, y: F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"))
    # the corners where x / 30.1 + y / 40.2 = 1 meets the other two sides
    ring = F.array(corner(1.1, 2.2), corner(30.1 * (1 - 2.2 / 40.2), 2.2), corner(1.1, 40.2 * (1 - 1.1 / 30.1)))
    p = raster.clipped_patches(mask, 1, (0.0, 2.0, 26.0, 36.0), ring, 1.0)
    return p.select("n", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query("h21_height_lookup", "SELECT c_custkey AS id, CAST(CASE WHEN c_nationkey % 3 = 0 THEN 10 WHEN c_nationkey % 3 = 1 THEN 50 ELSE 120 END AS DOUBLE) AS height FROM customer")
def h21(spark, sf):
    c = d.t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_nationkey") % 3).cast("int").alias("snap"))
    heights = spark.createDataFrame([(0, 10.0), (1, 50.0), (2, 120.0)], "snap int, height double")
    return joins.required(c, heights, "snap", "height").select("id", "height")


@query("sk01_weights_round_trip", d.with_(d.PIXELS) + """, w AS (SELECT *, CASE WHEN sum(signal) OVER c > 0 THEN signal / sum(signal) OVER c ELSE 1e0 / count(*) OVER c END AS weight FROM pixels WINDOW c AS (PARTITION BY cell_id))
SELECT cell_id, count(*) AS n, round(sum(weight), 6) AS total FROM w WHERE col % 2 = 1 GROUP BY 1""")
def sk01(spark, sf):
    path = _folder(spark, "weights")
    w = normalize.weights(d.pixels(spark, sf), "signal", ["cell_id"])
    writers.weight_table(w.select(F.when(F.col("col") % 2 == 1, "A").otherwise("B").alias("sector"), F.lit("nox").alias("pollutant"), "row", "col", "cell_id", "weight"), path)
    back = spark.read.parquet(path).where((F.col("sector") == "A") & (F.col("pollutant") == "nox"))
    return back.groupBy("cell_id").agg(F.count("*").alias("n"), F.round(F.sum("weight"), 6).alias("total"))


@query("sk05_city_round_trip", d.with_(d.POINTS) + "SELECT gnfr, count(*) AS n, round(sum(nox), 3) AS nox, round(sum(co), 3) AS co FROM points WHERE gnfr <> '' GROUP BY 1")
def sk05(spark, sf):
    path = _folder(spark, "city")
    columns = ["source_id", "gnfr", "lon", "lat", "nox", "co"]
    writers.table_csv(d.points(spark, sf).where("gnfr <> ''"), path, columns)
    back = readers.csv(spark, path, "source_id long, gnfr string, lon double, lat double, nox double, co double", columns=["gnfr", "nox", "co"])
    return back.groupBy("gnfr").agg(F.count("*").alias("n"), F.round(F.sum("nox"), 3).alias("nox"), F.round(F.sum("co"), 3).alias("co"))


@query("rv10_clip_points", d.with_(d.POINTS) + "SELECT source_id FROM points WHERE lon > -9.95e0 AND lat > 35.05e0 AND (lon + 9.95e0) / 60 + (lat - 35.05e0) / 5 < 1")
def rv10(spark, sf):
    corner = lambda x, y: F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"))
    ring = F.array(corner(-9.95, 35.05), corner(50.05, 35.05), corner(-9.95, 40.05))
    return d.points(spark, sf).where(geo.in_ring(F.col("lon"), F.col("lat"), ring)).select("source_id")


@query("so07_dissolved", """
WITH m AS (SELECT DISTINCT l_linenumber AS grp, CAST(l_partkey % 50 AS INT) AS r, CAST(l_suppkey % 30 AS INT) AS c FROM lineitem),
e AS (SELECT grp, k, r + a AS r, c + b AS c, count(*) AS n FROM m, (VALUES (0, 0, 0), (0, 1, 0), (1, 0, 0), (1, 0, 1)) v(k, a, b) GROUP BY 1, 2, 3, 4)
SELECT grp, (SELECT count(*) FROM m WHERE m.grp = e.grp) AS cells, count(*) AS outline FROM e WHERE n = 1 GROUP BY grp""")
def so07(spark, sf):
    li = d.t(spark, sf, "lineitem").select(F.col("l_linenumber").alias("grp"), (F.col("l_partkey") % 50).cast("int").alias("row"), (F.col("l_suppkey") % 30).cast("int").alias("col"))
    return cells.dissolve(li, "grp")


@query("st02_by_distance", _BASE + " SELECT source_id, facility_id, row_number() OVER (PARTITION BY source_id ORDER BY km, facility_id) AS place FROM cand WHERE facility_id IS NOT NULL")
def st02(spark, sf):
    return allocate.by_distance(d.points(spark, sf), d.facilities(spark, sf))
