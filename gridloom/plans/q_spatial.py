"""Polygons, lines and grids in the plane and on the sphere: burning, clipping, point-in-polygon, nearest, distances, warps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo
from ..operators import aviation, cells, export, joins, layers, lines, nearest, raster, rules, spatial, tiles
from ..streaming import running
from . import domain as d
from .q_points import _KM
from .q_rules import _LAYERS, _TAGS
from .registry import query

#: Corners of a shape in units of its size: an outer ring against the clock and a hole with it.
_OUTER = ((-1.0, -0.6), (0.9, -1.0), (1.1, 0.8), (0.1, 0.35), (-0.7, 1.0))
_HOLE = ((-0.2, -0.1), (0.05, 0.2), (0.3, -0.2))
_CORNERS = [(*a, *b) for r in (_OUTER, _HOLE) for a, b in zip(r, r[1:] + r[:1])]
_CO = "co(ux, uy, vx, vy) AS (VALUES " + ", ".join("(" + ", ".join(f"{v}e0" for v in c) + ")" for c in _CORNERS) + ")"


def _edges_sql(name: str, of: str) -> str:
    return f"{name} AS (SELECT id, cx + r * ux AS x1, cy + r * uy AS y1, cx + r * vx AS x2, cy + r * vy AS y2 FROM ({of}), co)"


_SUPPLIERS = _edges_sql("ed", "SELECT s_suppkey AS id, (s_suppkey % 37) * 0.91e0 + 0.313e0 AS cx, s_nationkey * 1.27e0 + 0.217e0 AS cy, 1 + (s_suppkey % 5) * 0.7e0 AS r FROM supplier")
_NATIONS = _edges_sql("bo", "SELECT n_nationkey AS id, (n_nationkey % 5) * 8.1e0 + 1.7e0 AS cx, (n_nationkey // 5) * 7.3e0 + 2.9e0 AS cy, 4.3e0 AS r FROM nation")
_PARTS = _edges_sql("ed", "SELECT p_partkey AS id, (p_partkey % 97) * 0.401e0 + 0.137e0 AS cx, (p_partkey % 61) * 0.557e0 + 0.083e0 AS cy, 0.2e0 + (p_size % 7) * 0.11e0 AS r FROM part")


def _rings(df):
    """Edges of shapes (id, cx, cy, r), by way of their rings."""
    corner = lambda x, y: F.struct((F.col("cx") + F.col("r") * x).alias("x"), (F.col("cy") + F.col("r") * y).alias("y"))
    rings = F.array(*[F.array(*[corner(x, y) for x, y in ring]) for ring in (_OUTER, _HOLE)])
    return spatial.ring_edges(df.select("id", F.explode(rings).alias("ring")), "ring")


def _suppliers(spark, sf):
    k = F.col("s_suppkey")
    return _rings(d.t(spark, sf, "supplier").select(k.alias("id"), ((k % 37) * 0.91 + 0.313).alias("cx"), (F.col("s_nationkey") * 1.27 + 0.217).alias("cy"), (1 + (k % 5) * 0.7).alias("r")))


def _nations(spark, sf):
    k = F.col("n_nationkey")
    return _rings(d.t(spark, sf, "nation").select(k.alias("id"), ((k % 5) * 8.1 + 1.7).alias("cx"), (F.floor(k / 5) * 7.3 + 2.9).alias("cy"), F.lit(4.3).alias("r")))


def _parts(spark, sf):
    k = F.col("p_partkey")
    return _rings(d.t(spark, sf, "part").select(k.alias("id"), ((k % 97) * 0.401 + 0.137).alias("cx"), ((k % 61) * 0.557 + 0.083).alias("cy"), (0.2 + (F.col("p_size") % 7) * 0.11).alias("r")))


# --- burning ------------------------------------------------------------------------------

_SIDES = ", ".join(f"(x2 - x1) * ({y} - y1) - (y2 - y1) * ({x} - x1)" for x in ("c", "c + 1") for y in ("r", "r + 1"))
_TOUCH = f"(least(x1, x2) <= c + 1 AND greatest(x1, x2) >= c AND least(y1, y2) <= r + 1 AND greatest(y1, y2) >= r AND least({_SIDES}) <= 0 AND greatest({_SIDES}) >= 0)"
_CROSS = "((y1 > r + 0.5e0) <> (y2 > r + 0.5e0) AND c + 0.5e0 < (x2 - x1) * (r + 0.5e0 - y1) / nullif(y2 - y1, 0) + x1)"
_BOXES = """bb AS (SELECT id, floor(min(least(x1, x2))) AS c0, floor(max(greatest(x1, x2))) AS c1, floor(min(least(y1, y2))) AS r0, floor(max(greatest(y1, y2))) AS r1 FROM ed GROUP BY 1),
px AS (SELECT id, r, c FROM bb, range(0, 40) a(r), range(0, 40) b(c) WHERE r BETWEEN r0 AND r1 AND c BETWEEN c0 AND c1)"""
_GRID = ((0, 39), (0, 39))


@query("rv04_touched_polygons", d.with_(_CO, _SUPPLIERS, _BOXES) + f""", b AS (SELECT id, r, c FROM px JOIN ed USING (id) GROUP BY 1, 2, 3 HAVING bool_or({_TOUCH}) OR count(*) FILTER ({_CROSS}) % 2 = 1)
SELECT CAST(r AS INT) AS "row", CAST(c AS INT) AS col, count(*) AS n, max(id) AS last FROM b GROUP BY 1, 2""")
def rv04_touched(spark, sf):
    burnt = spatial.burn(_suppliers(spark, sf), 1.0, *_GRID).withColumn("last", F.col("id"))
    top = spatial.rasterised(burnt, ["id"], "last")
    return burnt.groupBy("row", "col").agg(F.count("*").alias("n")).join(top, ["row", "col"])


@query("rv04_polygon_pixels", d.with_(_CO, _SUPPLIERS, _BOXES) + f""", b AS (SELECT id, r, c FROM px JOIN ed USING (id) GROUP BY 1, 2, 3 HAVING count(*) FILTER ({_CROSS}) % 2 = 1)
SELECT id, count(*) AS n, CAST(min(r * 1000 + c) AS BIGINT) AS first FROM b GROUP BY 1""")
def rv04_centres(spark, sf):
    burnt = spatial.burn(_suppliers(spark, sf), 1.0, *_GRID, touched=False)
    return burnt.groupBy("id").agg(F.count("*").alias("n"), F.min(F.col("row").cast("long") * 1000 + F.col("col")).alias("first"))


_LINES = "li AS (SELECT c_custkey AS id, (c_custkey % 331) * 0.103e0 + 0.0071e0 AS x1, (c_custkey % 197) * 0.171e0 + 0.0033e0 AS y1, (c_custkey % 89) * 0.377e0 + 0.011e0 AS x2, c_nationkey * 1.31e0 + 0.057e0 AS y2 FROM customer)"


def _lines(spark, sf):
    k = F.col("c_custkey")
    x1, y1, x2, y2 = (k % 331) * 0.103 + 0.0071, (k % 197) * 0.171 + 0.0033, (k % 89) * 0.377 + 0.011, F.col("c_nationkey") * 1.31 + 0.057
    return d.t(spark, sf, "customer").select(k.alias("id"), x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


@query("rv03_touched_lines", d.with_(_LINES) + f"""SELECT CAST(r AS INT) AS "row", CAST(c AS INT) AS col, count(*) AS n FROM li, range(0, 40) a(r), range(0, 40) b(c) WHERE {_TOUCH} GROUP BY 1, 2""")
def rv03_lines(spark, sf):
    return spatial.burn(_lines(spark, sf), 1.0, *_GRID, filled=False).groupBy("row", "col").agg(F.count("*").alias("n"))


@query("jn14_slanted_lines", d.with_(_LINES) + """, k AS (SELECT r, c, x1, y1, x2 - x1 AS dx, y2 - y1 AS dy FROM li, range(0, 40) a(r), range(0, 40) b(c)
  WHERE least(x1, x2) <= c + 1 AND greatest(x1, x2) >= c AND least(y1, y2) <= r + 1 AND greatest(y1, y2) >= r),
t AS (SELECT r, c, sqrt(dx * dx + dy * dy) AS len, greatest(0e0, least((c - x1) / nullif(dx, 0), (c + 1 - x1) / nullif(dx, 0)), least((r - y1) / nullif(dy, 0), (r + 1 - y1) / nullif(dy, 0))) AS a,
  least(1e0, greatest((c - x1) / nullif(dx, 0), (c + 1 - x1) / nullif(dx, 0)), greatest((r - y1) / nullif(dy, 0), (r + 1 - y1) / nullif(dy, 0))) AS b FROM k)
SELECT CAST(r AS INT) AS r, CAST(c AS INT) AS c, round(sum(len * (b - a)), 6) AS length FROM t WHERE b > a GROUP BY 1, 2 HAVING sum(len * (b - a)) > 1e-6""")
def jn14_slanted(spark, sf):
    g = lines.segments_in_cells(_lines(spark, sf), 1.0).groupBy("r", "c").agg(F.sum("inside").alias("length"))
    return g.where(F.col("r").between(0, 39) & F.col("c").between(0, 39) & (F.col("length") > 1e-6)).select("r", "c", F.round("length", 6).alias("length"))


# --- points, polygons and lines in polygons -----------------------------------------------


@query("jn15_points_in_polygons", d.with_(_CO, _SUPPLIERS, _LINES) + """, k AS (SELECT li.id AS p, ed.id AS polygon FROM li JOIN ed ON (ed.y1 > li.y1) <> (ed.y2 > li.y1) AND li.x1 < (ed.x2 - ed.x1) * (li.y1 - ed.y1) / (ed.y2 - ed.y1) + ed.x1 GROUP BY 1, 2 HAVING count(*) % 2 = 1)
SELECT polygon, count(*) AS n, min(p) AS first FROM k GROUP BY 1""")
def jn15_polygons(spark, sf):
    points = _lines(spark, sf).select("id", F.col("x1").alias("x"), F.col("y1").alias("y"))
    return spatial.points_inside(points, _suppliers(spark, sf), 2.0)


def _common_area_sql(a: str, b: str) -> str:
    """Area that shapes a and b share, in strips between all heights where something begins, ends or crosses: in a strip it is its middle width times its height."""
    cross = "((p.x2 - p.x1) * (q.y2 - q.y1) - (p.y2 - p.y1) * (q.x2 - q.x1))"
    t = f"((q.x1 - p.x1) * (q.y2 - q.y1) - (q.y1 - p.y1) * (q.x2 - q.x1)) / nullif({cross}, 0)"
    at = lambda s, k: f"SELECT st.a, st.b, st.y, st.h, {k} AS k, ({s}.x2 - {s}.x1) * (st.y - {s}.y1) / ({s}.y2 - {s}.y1) + {s}.x1 AS x FROM st JOIN {s} ON {s}.id = st.{'a' if k == 0 else 'b'} AND ({s}.y1 > st.y) <> ({s}.y2 > st.y)"
    return f"""pr AS (SELECT DISTINCT p.id AS a, q.id AS b FROM (SELECT id, min(x1) AS w, max(x1) AS e, min(y1) AS s, max(y1) AS n FROM {a} GROUP BY 1) p, (SELECT id, min(x1) AS w, max(x1) AS e, min(y1) AS s, max(y1) AS n FROM {b} GROUP BY 1) q
  WHERE p.w < q.e AND q.w < p.e AND p.s < q.n AND q.s < p.n),
ev AS (SELECT a, b, y1 AS y FROM pr JOIN {a} ON id = a UNION SELECT a, b, y1 FROM pr JOIN {b} ON id = b
  UNION SELECT a, b, p.y1 + {t} * (p.y2 - p.y1) FROM pr JOIN {a} p ON p.id = a JOIN {b} q ON q.id = b WHERE {t} BETWEEN 0 AND 1),
st AS (SELECT a, b, (y + n) / 2 AS y, n - y AS h FROM (SELECT *, lead(y) OVER (PARTITION BY a, b ORDER BY y) AS n FROM ev WHERE y IS NOT NULL) WHERE n > y),
xs AS ({at(a, 0)} UNION ALL {at(b, 1)}),
iv AS (SELECT a, b, h, lead(x) OVER w - x AS len, sum(1 - k) OVER w % 2 AS ina, sum(k) OVER w % 2 AS inb FROM xs WINDOW w AS (PARTITION BY a, b, y ORDER BY x)),
ar AS (SELECT a, b, sum(h * len) AS area FROM iv WHERE ina = 1 AND inb = 1 GROUP BY 1, 2)"""


@query("rv10_clip_polygons", d.with_(_CO, _SUPPLIERS, _NATIONS, _common_area_sql("ed", "bo")) + "SELECT a AS id, b AS polygon, round(area, 6) AS area FROM ar WHERE area > 1e-4")
def rv10_polygons(spark, sf):
    common = spatial.clip_polygons(_suppliers(spark, sf), _nations(spark, sf), 3.0)
    return spatial.area(common, ["id", "polygon"]).where(F.col("area") > 1e-4).select("id", "polygon", F.round("area", 6).alias("area"))


@query("rv08_clip_polylines", d.with_(_CO, _NATIONS, _LINES) + """, k AS (SELECT li.id, bo.id AS b, bo.x1 - li.x1 AS px, bo.y1 - li.y1 AS py, bo.x2 - bo.x1 AS ex, bo.y2 - bo.y1 AS ey, li.x2 - li.x1 AS dx, li.y2 - li.y1 AS dy FROM li, bo),
ts AS (SELECT id, b, (px * ey - py * ex) / nullif(dx * ey - dy * ex, 0) AS t FROM k WHERE (px * dy - py * dx) / nullif(dx * ey - dy * ex, 0) BETWEEN 0 AND 1),
br AS (SELECT id, b, t FROM ts WHERE t > 0 AND t < 1 UNION SELECT li.id, n_nationkey, v.t FROM li, nation, (VALUES (0e0), (1e0)) v(t)),
pc AS (SELECT *, lead(t) OVER (PARTITION BY id, b ORDER BY t) AS u FROM br),
mid AS (SELECT pc.*, x1 + (t + u) / 2 * (x2 - x1) AS x, y1 + (t + u) / 2 * (y2 - y1) AS y, (u - t) * sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2)) AS len FROM pc JOIN li USING (id) WHERE u > t),
ins AS (SELECT m.id, m.b, m.t, any_value(len) AS len FROM mid m JOIN bo ON bo.id = m.b AND (bo.y1 > m.y) <> (bo.y2 > m.y) AND m.x < (bo.x2 - bo.x1) * (m.y - bo.y1) / (bo.y2 - bo.y1) + bo.x1 GROUP BY 1, 2, 3 HAVING count(*) % 2 = 1)
SELECT id, b AS polygon, round(sum(len), 6) AS len FROM ins GROUP BY 1, 2 HAVING sum(len) > 1e-6""")
def rv08_polylines(spark, sf):
    parts = spatial.clip_lines(_lines(spark, sf), _nations(spark, sf), 3.0).withColumn("len", spatial.length())
    return parts.groupBy("id", "polygon").agg(F.sum("len").alias("len")).where(F.col("len") > 1e-6).select("id", "polygon", F.round("len", 6).alias("len"))


# --- the rule engine with its geometry ----------------------------------------------------

@query("dc22_layers_in_boundary", _TAGS.rstrip() + ",\n" + ",\n".join((_CO, _PARTS, _NATIONS, _common_area_sql("ed", "bo"))) + """
, l AS (SELECT 'eleven' AS layer, id FROM t WHERE brand = 'Brand#11' UNION ALL SELECT 'small', id FROM t WHERE kind = 'node' AND size IN ('1', '2', '3')),
f AS (SELECT layer, id, sum(area) AS area FROM l JOIN ar ON a = id WHERE area > 1e-9 GROUP BY 1, 2)
SELECT layer, id, round(area, 6) AS area FROM f WHERE area >= 0.05e0""")
def dc22_layers(spark, sf):
    found = layers.vector_layers(d.tags(spark, sf), _LAYERS, "tags", "id", _parts(spark, sf), _nations(spark, sf), 3.0, least_area=0.05)
    return found.select("layer", "id", "area").distinct().select("layer", "id", F.round("area", 6).alias("area"))


@query("dc22_buffered_layers", _TAGS.rstrip() + ",\n" + ",\n".join((_CO, _PARTS)) + """
, l AS (SELECT 'eleven' AS layer, id FROM t WHERE brand = 'Brand#11' UNION ALL SELECT 'small', id FROM t WHERE kind = 'node' AND size IN ('1', '2', '3')),
e AS (SELECT layer, id, x1, y1, x2, y2 FROM l JOIN ed USING (id)),
bb AS (SELECT id, floor(min(y1)) - 2 AS r0, floor(max(y1)) + 2 AS r1, floor(min(x1)) - 2 AS c0, floor(max(x1)) + 2 AS c1 FROM ed GROUP BY 1),
k AS (SELECT layer, id, r, c, least(1e0, greatest(0e0, ((c + 0.5e0 - x1) * (x2 - x1) + (r + 0.5e0 - y1) * (y2 - y1)) / (pow(x2 - x1, 2) + pow(y2 - y1, 2)))) AS u, x1, y1, x2, y2 FROM e JOIN bb USING (id), range(0, 40) a(r), range(0, 40) b(c)
  WHERE r BETWEEN r0 AND r1 AND c BETWEEN c0 AND c1),
h AS (SELECT layer, r, c, id, count(*) FILTER ((y1 > r + 0.5e0) <> (y2 > r + 0.5e0) AND c + 0.5e0 < (x2 - x1) * (r + 0.5e0 - y1) / nullif(y2 - y1, 0) + x1) AS n,
  min(pow(c + 0.5e0 - x1 - u * (x2 - x1), 2) + pow(r + 0.5e0 - y1 - u * (y2 - y1), 2)) AS d2 FROM k GROUP BY 1, 2, 3, 4)
SELECT layer, CAST(r AS INT) AS "row", count(DISTINCT c) AS n FROM h WHERE n % 2 = 1 OR d2 <= CASE layer WHEN 'eleven' THEN pow(1.37e0, 2) ELSE 0e0 END GROUP BY 1, 2""")
def dc22_buffered(spark, sf):
    found = rules.classify(d.tags(spark, sf), _LAYERS, "tags", ["id"]).select("layer", "id")
    found = joins.shuffled(found, _parts(spark, sf), "id")
    return layers.buffered(found, {"eleven": 1.37}, 1.0, *_GRID).groupBy("layer", "row").agg(F.count("*").alias("n"))


# --- nearest, distances -------------------------------------------------------------------


@query("jn12_nearest_anywhere", d.with_(d.POINTS, d.FACILITIES) + ", pr AS (SELECT p.source_id, f.facility_id, " + _KM.format(a="p.", b="f.f_") + """ AS km FROM points p, facilities f),
k AS (SELECT source_id, km, row_number() OVER (PARTITION BY source_id ORDER BY km) AS place FROM pr) SELECT source_id, CAST(place AS INT) AS place, round(km, 5) AS km FROM k WHERE place <= 3""")
def jn12_anywhere(spark, sf):
    p = d.points(spark, sf).select("source_id", "lon", "lat")
    near = nearest.nearest(p, d.facilities(spark, sf).select("facility_id", "f_lon", "f_lat"), 3)
    return near.select("source_id", "place", F.round("distance_km", 5).alias("km"))


@query("rv06_distances", """
WITH m AS (SELECT DISTINCT s_suppkey % 211 AS r, s_nationkey * 7 + s_suppkey % 5 AS c FROM supplier),
o AS (SELECT a, b, a * a + b * b AS d2 FROM range(-9, 10) p(a), range(-9, 10) q(b) WHERE a * a + b * b <= 81)
SELECT r + a AS "row", c + b AS col, min(d2) AS d2 FROM m, o GROUP BY 1, 2""")
def rv06_distances(spark, sf):
    k = F.col("s_suppkey")
    mask = d.t(spark, sf, "supplier").select((k % 211).alias("row"), (F.col("s_nationkey") * 7 + k % 5).alias("col"))
    return raster.distances(mask, 9)


# --- coordinate systems -------------------------------------------------------------------

@query("rv13_densified_boxes")
def rv13_boxes(spark, sf):
    """Bounds in the equal-area plane of each nation's cell, with densified sides, and how far four corners alone fall short."""
    n = F.col("n_nationkey")
    box = ((n % 5) * 5.0 - 9.7, F.floor(n / 5) * 6.0 + 35.3, (n % 5) * 5.0 - 4.9, F.floor(n / 5) * 6.0 + 41.1)
    moved = geo.moved_box(box, geo.to_laea)
    corners = [geo.to_laea(x, y) for x in (box[0], box[2]) for y in (box[1], box[3])]
    bare = geo.corner_box([c[0] for c in corners], [c[1] for c in corners])
    cols = [F.round(a, 2).alias(k) for k, a in zip(("west", "south", "east", "north"), moved)]
    return d.t(spark, sf, "nation").select(n.alias("id"), *cols, F.round(moved[3] - bare[3], 2).alias("more_north"))


@query("rv13_round_trips", d.with_(d.SOURCES) + "SELECT cell_id, count(*) AS n, 0 AS laea_off, 0 AS utm_off FROM sources GROUP BY 1")
def rv13_trips(spark, sf):
    """Sources to a plane and back: how many places move by more than 1e-11 degrees (a micrometre)."""
    s = d.sources(spark, sf).select("cell_id", "lon", "lat", (F.col("lon") % 6).alias("near"))  # within six degrees of a zone's middle
    there = [c.alias(n) for c, n in zip((*geo.to_laea(F.col("lon"), F.col("lat")), *geo.to_utm(F.col("near"), F.col("lat"), 31)), ("e", "n", "ue", "un"))]
    s = s.select("*", *there)
    back = [c.alias(n) for c, n in zip((*geo.from_laea(F.col("e"), F.col("n")), *geo.from_utm(F.col("ue"), F.col("un"), 31)), "abxy")]
    s = s.select("*", *back)
    a, b, x, y, near = (F.col(c) for c in ("a", "b", "x", "y", "near"))
    off = lambda p, q, r, t: F.sum(((F.abs(p - q) > 1e-11) | (F.abs(r - t) > 1e-11)).cast("int"))
    return s.groupBy("cell_id").agg(F.count("*").alias("n"), off(a, F.col("lon"), b, F.col("lat")).alias("laea_off"), off(x, near, y, F.col("lat")).alias("utm_off"))


def _source(spark, sf):
    """The pixels as a raster in degrees: 0.25 by 0.25 from 12 W, 30 N."""
    p = d.pixels(spark, sf)
    return p.groupBy((F.col("row") % 140).cast("int").alias("row"), (F.col("col") % 200).cast("int").alias("col")).agg(F.sum("other").alias("value"))


@query("rv02_warped_equal_mass")
def rv02_warped(spark, sf):
    """Pixels in degrees on a 50 km grid of the equal-area plane, by nearest pixel: number and sum of each row."""
    target = raster.grid(spark, 60, 60, 2_600_000.0, 4_400_000.0, 50_000.0, -50_000.0)
    got = raster.warp(_source(spark, sf), target, geo.from_laea, -12.0, 30.0, 0.25, 0.25)
    return got.groupBy("row").agg(F.count("value").alias("n"), F.round(F.sum("value"), 6).alias("total"))


# --- match points, airports, cells, tiles -------------------------------------------------

_AERO = _edges_sql("ed", "SELECT s_suppkey AS id, (s_suppkey % 37) * 910e0 + 313 AS cx, s_nationkey * 1270e0 + 217 AS cy, 300 + (s_suppkey % 5) * 400e0 AS r FROM supplier").replace("r * ux", "r * ux * w").replace("r * vx", "r * vx * w").replace("FROM (SELECT", "FROM (SELECT CASE s_suppkey % 3 WHEN 0 THEN 2e0 ELSE 1e0 END AS w,")
_MASS = """ms AS (SELECT id, sum((x1 - mx) * (y2 - my) - (x2 - mx) * (y1 - my)) AS m, sum((x1 + x2 - 2 * mx) * ((x1 - mx) * (y2 - my) - (x2 - mx) * (y1 - my))) AS sx, sum((y1 + y2 - 2 * my) * ((x1 - mx) * (y2 - my) - (x2 - mx) * (y1 - my))) AS sy, any_value(mx) AS mx, any_value(my) AS my, any_value(half) AS half
  FROM ed JOIN (SELECT id, min(x1) AS mx, min(y1) AS my, (min(y1) + max(y1)) / 2 AS half FROM ed GROUP BY 1) USING (id) GROUP BY 1),
ct AS (SELECT id, m / 2 AS area, mx + sx / (3 * m) AS cx, my + sy / (3 * m) AS cy, half FROM ms),
ins AS (SELECT id, count(*) FILTER ((y1 > cy) <> (y2 > cy) AND cx < (x2 - x1) * (cy - y1) / nullif(y2 - y1, 0) + x1) % 2 = 1 AS inside FROM ct JOIN ed USING (id) GROUP BY 1),
cr AS (SELECT id, (x2 - x1) * (half - y1) / (y2 - y1) + x1 AS x FROM ct JOIN ed USING (id) WHERE (y1 > half) <> (y2 > half)),
ch AS (SELECT id, x, lead(x) OVER w AS n, row_number() OVER w AS k FROM cr WINDOW w AS (PARTITION BY id ORDER BY x)),
wd AS (SELECT id, (x + n) / 2 AS x, row_number() OVER (PARTITION BY id ORDER BY n - x DESC, x) AS k FROM ch WHERE k % 2 = 1),
mp AS (SELECT ct.id, CASE WHEN inside THEN cx ELSE wd.x END AS x, CASE WHEN inside THEN cy ELSE half END AS y, area FROM ct JOIN ins USING (id) LEFT JOIN wd ON wd.id = ct.id AND wd.k = 1)"""


def _aerodromes(spark, sf):
    """Aerodromes of the suppliers in metres; every third one is stretched, with its hole over its centre of mass."""
    k = F.col("s_suppkey")
    shape = d.t(spark, sf, "supplier").select(k.alias("id"), ((k % 37) * 910.0 + 313).alias("cx"), (F.col("s_nationkey") * 1270.0 + 217).alias("cy"), (300 + (k % 5) * 400.0).alias("r"), F.when(k % 3 == 0, 2.0).otherwise(1.0).alias("w"))
    edge = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("ux", "uy", "vx", "vy"), c)]) for c in _CORNERS])
    e = shape.withColumn("_e", F.explode(edge))
    at = lambda n, axis, w: F.col(f"c{axis}") + F.col("r") * F.col(f"_e.{n}{axis}") * w
    return e.select("id", at("u", "x", F.col("w")).alias("x1"), at("u", "y", F.lit(1.0)).alias("y1"), at("v", "x", F.col("w")).alias("x2"), at("v", "y", F.lit(1.0)).alias("y2"))


@query("rv07_match_points", d.with_(_CO, _AERO, _MASS) + "SELECT id, round(x, 4) AS x, round(y, 4) AS y, round(area, 3) AS area FROM mp")
def rv07_points(spark, sf):
    return spatial.match_points(_aerodromes(spark, sf)).select("id", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"), F.round("area", 3).alias("area"))


@query("rv15_airport_facilities", d.with_(_CO, _AERO, _MASS) + """, p AS (SELECT s_suppkey AS id, CASE s_suppkey % 4 WHEN 0 THEN 'aerodrome' WHEN 1 THEN 'Landuse_aerodrome' WHEN 2 THEN 'military_airfield' ELSE 'heliport' END AS family, s_suppkey % 40 AS number FROM supplier WHERE s_suppkey % 7 <> 3),
f AS (SELECT id, number, x, y, area FROM p JOIN mp USING (id) WHERE lower(family) IN ('aerodrome', 'landuse_aerodrome') AND area >= 0.5e6)
SELECT id, 'osm:way:' || number || CASE WHEN row_number() OVER (PARTITION BY number ORDER BY id) > 1 THEN ':r' || id ELSE '' END AS facility_id, 'X' || id AS icao, round(x, 4) AS x, round(y, 4) AS y, round(area / 1e6, 6) AS area_km2 FROM f""")
def rv15_airports(spark, sf):
    k = F.col("s_suppkey")
    family = F.element_at(F.array(*map(F.lit, ("aerodrome", "Landuse_aerodrome", "military_airfield", "heliport"))), (k % 4 + 1).cast("int"))
    tags = F.when(k % 7 == 3, F.create_map(F.lit("military"), F.lit("yes"))).otherwise(F.create_map(F.lit("icao"), F.concat(F.lit(" x"), k.cast("string"))))
    p = d.t(spark, sf, "supplier").select(k.alias("id"), family.alias("family"), F.lit(None).cast("string").alias("element_type"), (k % 40).alias("element_id"), F.lit("").alias("name"), tags.alias("tags"))
    f = aviation.facilities(p, _aerodromes(spark, sf), None, 2000.0)
    return f.select("id", "facility_id", "icao", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"), F.round("area_km2", 6).alias("area_km2"))


@query("h17_cells_geojson", d.with_(d.SOURCES) + """, c AS (SELECT DISTINCT cell_id FROM sources WHERE country = 7 AND nox > 0), b AS (SELECT cell_id, (cell_id % 25) * 2e0 - 10 AS w, (cell_id // 25) * 5e0 + 35 AS s FROM c)
SELECT cell_id, 'Polygon' AS kind, CAST(5 AS INT) AS corners, w, s + 5 AS n FROM b WHERE NOT (w + 2 < -4e0 OR w > 20e0 OR s + 5 < 41e0 OR s > 52e0)""")
def h17_geojson(spark, sf):
    """Cells of a country's sources within an envelope as GeoJSON features, read back from their text."""
    own = cells.select_sources(d.sources(spark, sf), country=7, positive=["nox"]).select("cell_id").distinct()
    west, south = (F.col("cell_id") % 25) * 2.0 - 10, F.floor(F.col("cell_id") / 25) * 5.0 + 35
    text = export.cells_geojson(own.select("cell_id", west.alias("west"), south.alias("south"), (west + 2).alias("east"), (south + 5).alias("north")), (-4.0, 41.0, 20.0, 52.0))
    back = text.select(F.from_json("feature", "id long, properties struct<cell_id:long>, geometry struct<type:string, coordinates:array<array<array<double>>>>").alias("f"))
    ring = F.get("f.geometry.coordinates", F.lit(0))
    at = lambda k, best: best(F.transform(ring, lambda p: F.get(p, F.lit(k))))
    return back.select(F.col("f.properties.cell_id").alias("cell_id"), F.col("f.geometry.type").alias("kind"), F.size(ring).alias("corners"), at(0, F.array_min).alias("w"), at(1, F.array_max).alias("n"))


@query("sk09_map_tiles", d.with_(d.PIXELS) + """, s AS (SELECT CAST("row" % 140 AS INT) AS r, CAST(col % 200 AS INT) AS c, sum(other) AS value FROM pixels GROUP BY 1, 2),
t AS (SELECT z, x, y, pr, pc, (x + (pc + 0.5e0) / 64) / 16 * 360 - 180 AS lon, degrees(atan(sinh(pi() * (1 - 2 * (y + (pr + 0.5e0) / 64) / 16)))) AS lat FROM (SELECT 4 AS z), range(7, 10) a(x), range(4, 8) b(y), range(0, 64) k(pr), range(0, 64) l(pc)),
v AS (SELECT z, x, y, value, greatest(0, least(1, (log10(value + 1e-12) + 3) / 4)) AS norm FROM t JOIN s ON r = floor((lat - 30) / 0.25e0) AND c = floor((lon + 12) / 0.25e0) WHERE value > 0)
SELECT CAST(x AS INT) AS x, CAST(y AS INT) AS y, count(*) AS n, CAST(sum(floor(norm * 255)) AS BIGINT) AS shade, round(sum(CASE WHEN value < 0.03e0 THEN 0.08e0 ELSE greatest(0.42e0, least(0.9e0, 0.42e0 + norm * 0.48e0)) END), 5) AS alpha FROM v GROUP BY 1, 2""")
def sk09_tiles(spark, sf):
    src = _source(spark, sf)
    e = src.agg(F.min("row").alias("r0"), F.max("row").alias("r1"), F.min("col").alias("c0"), F.max("col").alias("c1")).first()
    if e["r0"] is None:
        wanted = spark.createDataFrame([], "z int, x int, y int")
    else:
        xs, ys = tiles.covering(e["c0"] * 0.25 - 12, e["r0"] * 0.25 + 30, (e["c1"] + 1) * 0.25 - 12, (e["r1"] + 1) * 0.25 + 30, 4)
        wanted = spark.createDataFrame([(4, x, y) for x in xs for y in ys], "z int, x int, y int")
    shades = tiles.shaded(tiles.sampled(src, wanted, -12.0, 30.0, 0.25, 0.25, 64), -3.0, 1.0, 0.03)
    return shades.groupBy("x", "y").agg(F.count("*").alias("n"), F.sum("shade").alias("shade"), F.round(F.sum("alpha"), 5).alias("alpha"))


# --- streams ------------------------------------------------------------------------------


@query("st_running_statistics", "SELECT user_id % 25 AS cell, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS deviation FROM events GROUP BY 1")
def st_running(spark, sf):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", running.PROVIDER)
    rows = running.running_statistics(d.fires(spark, sf)).where(~F.col("closed"))
    return rows.select("cell", "n", F.round("mean", 6).alias("mean"), F.round("deviation", 6).alias("deviation"))
