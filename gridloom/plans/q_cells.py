"""Scans, filters, cell lookup, footprints, cell mass and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo, numeric
from ..operators import cells
from ..sources import readers
from . import domain as d
from .registry import query


@query("sc01_inventory_scan", """
SELECT CAST((l_suppkey % 5) * 7 + l_linenumber - 1 AS BIGINT) AS cell_id, count(*) AS n, round(sum(l_quantity), 4) AS nox FROM lineitem GROUP BY 1""")
def sc01(spark, sf):
    # one axis counts from one up to its size and is shifted, the other from zero and is not
    s = d.t(spark, sf, "lineitem").select(F.col("l_linenumber").alias("lon_idx"), (F.col("l_suppkey") % 5).cast("int").alias("lat_idx"), F.col("l_quantity").alias("nox"))
    return readers.inventory(s, ["nox"], 7, 6).groupBy("cell_id").agg(F.count("*").alias("n"), F.round(F.sum("nox"), 4).alias("nox"))


@query("sc02_positive_sources", d.with_(d.SOURCES) + "SELECT category, count(*) AS n FROM sources WHERE pm10 > 0 GROUP BY 1")
def sc02(spark, sf):
    return cells.select_sources(d.sources(spark, sf), positive=["pm10"]).groupBy("category").agg(F.count("*").alias("n"))


@query("sc03_point_scan", d.with_(d.SOURCES) + """
SELECT substr('ABCDEFG', CAST(category AS INT), 1) AS gnfr, cell_id, count(*) AS n FROM sources WHERE source_type = 2 GROUP BY 1, 2""")
def sc03(spark, sf):
    return readers.point_inventory(d.sources(spark, sf), "ABCDEFG").groupBy("gnfr", "cell_id").agg(F.count("*").alias("n"))


@query("sc04_point_scan_plain", d.with_(d.SOURCES) + "SELECT round(lon, 2) AS lon, round(lat, 2) AS lat, round(sum(nox), 3) AS nox FROM sources WHERE source_type = 2 GROUP BY 1, 2")
def sc04(spark, sf):
    s = d.sources(spark, sf).where(F.col("source_type") == 2)
    return s.groupBy(F.round("lon", 2).alias("lon"), F.round("lat", 2).alias("lat")).agg(F.round(F.sum("nox"), 3).alias("nox"))


@query("sc05_grid_axes", """
SELECT 'lon' AS axis, n_nationkey AS idx, -10e0 + 2 * n_nationkey AS low, -8e0 + 2 * n_nationkey AS high FROM nation
UNION ALL SELECT 'lat', r_regionkey, 35e0 + 5 * r_regionkey, 40e0 + 5 * r_regionkey FROM region""")
def sc05(spark, sf):
    n, r = d.t(spark, sf, "nation"), d.t(spark, sf, "region")
    lon = n.select(F.lit("lon").alias("axis"), F.col("n_nationkey").alias("idx"), (F.col("n_nationkey") * 2 - 10.0).alias("low"), (F.col("n_nationkey") * 2 - 8.0).alias("high"))
    return lon.unionByName(r.select(F.lit("lat").alias("axis"), F.col("r_regionkey").alias("idx"), (F.col("r_regionkey") * 5 + 35.0).alias("low"), (F.col("r_regionkey") * 5 + 40.0).alias("high")))


@query("sc06_raster_window", d.with_(d.PIXELS) + 'SELECT "row", col, round(signal, 4) AS signal FROM pixels WHERE "row" BETWEEN 100 AND 140 AND col BETWEEN 10 AND 60')
def sc06(spark, sf):
    return readers.window(d.pixels(spark, sf), (100, 140), (10, 60)).select("row", "col", F.round("signal", 4).alias("signal"))


@query("sc07_land_cover_mask", """
WITH p AS (SELECT p_partkey, p_size % 44 + 1 AS idx FROM part),
c AS (SELECT i AS idx, CAST(111 + (i - 1) % 5 * 100 + (i - 1) // 5 AS INT) AS l3 FROM range(1, 45) r(i))
SELECT l3, count(*) AS n, CAST(sum(CASE WHEN l3 IN (111, 211, 311) THEN 1 ELSE 0 END) AS BIGINT) AS inside FROM p JOIN c USING (idx) GROUP BY 1""")
def sc07(spark, sf):
    from ..operators import raster

    p = d.t(spark, sf, "part").select((F.col("p_size") % 44 + 1).alias("idx"))
    codes = spark.range(1, 45).select(F.col("id").cast("int").alias("idx"), (111 + (F.col("id") - 1) % 5 * 100 + F.floor((F.col("id") - 1) / 5)).cast("int").alias("l3"))
    return raster.classes(p, codes, [111, 211, 311]).groupBy("l3").agg(F.count("*").alias("n"), F.sum("mask").alias("inside"))


@query("sc08_weighted_cover", """
SELECT CAST(p_partkey % 50 AS INT) AS "row", CAST(p_partkey % 7 AS INT) AS col, round(sum(CASE p_size % 4 WHEN 1 THEN 0.5e0 WHEN 2 THEN 2e0 ELSE 0 END), 6) AS value FROM part GROUP BY 1, 2""")
def sc08(spark, sf):
    from ..operators import raster

    p = d.t(spark, sf, "part").select((F.col("p_partkey") % 50).cast("int").alias("row"), (F.col("p_partkey") % 7).cast("int").alias("col"), (F.col("p_size") % 4).alias("l3"))
    return raster.weighted_classes(p, {1: 0.5, 2: 2.0, 3: 0.0}).select("row", "col", F.round("value", 6).alias("value"))


@query("sc09_painted_groups", """
SELECT CASE WHEN p_size % 7 = 0 THEN 'fodder' WHEN p_size % 5 = 0 THEN 'high' WHEN p_size % 3 = 0 THEN 'medium' WHEN p_size % 2 = 0 THEN 'low' END AS crop, count(*) AS n FROM part GROUP BY 1""")
def sc09(spark, sf):
    from ..operators import raster

    s = F.col("p_size")
    crop = raster.painted([("low", s % 2 == 0), ("medium", s % 3 == 0), ("high", s % 5 == 0), ("fodder", s % 7 == 0)])
    return d.t(spark, sf, "part").select(crop.alias("crop")).groupBy("crop").agg(F.count("*").alias("n"))


def _raster_rule(name, spark_value, sql_value):
    @query(name, f"SELECT s_nationkey AS cell_id, round(sum(coalesce({sql_value}, 0)), 4) AS total, count({sql_value}) AS n FROM supplier GROUP BY 1")
    def f(spark, sf):
        v = d.t(spark, sf, "supplier").withColumn("v", spark_value(F.col("s_acctbal")))
        return v.groupBy(F.col("s_nationkey").alias("cell_id")).agg(F.round(F.sum(F.coalesce("v", F.lit(0.0))), 4).alias("total"), F.count("v").alias("n"))

    return f


_raster_rule("sc10_population", lambda v: F.greatest(v, F.lit(0.0)), "greatest(s_acctbal, 0e0)")
_raster_rule("sc11_heat_demand", lambda v: F.when(v >= 0, v), "CASE WHEN s_acctbal >= 0 THEN s_acctbal END")
_raster_rule("sc12_imperviousness", lambda v: F.coalesce(F.when(v != 255, v), F.lit(0.0)), "coalesce(CASE WHEN s_acctbal <> 255 THEN s_acctbal END, 0e0)")
_raster_rule("sc13_settlement_class", lambda v: (F.floor(v) % 10).isin(1, 2, 3).cast("double"), "CASE WHEN CAST(floor(s_acctbal) AS BIGINT) % 10 IN (1, 2, 3) THEN 1e0 ELSE 0e0 END")
_raster_rule("sc14_vessel_density", lambda v: F.greatest(F.coalesce(numeric.clean(v), F.lit(0.0)), F.lit(0.0)), "greatest(coalesce(s_acctbal, 0e0), 0e0)")


@query("sc15_facility_wide", d.with_(d.FACILITIES) + """
SELECT facility_id, CAST((r_nox > 0)::INT + (r_co > 0)::INT AS INT) AS n, round(r_nox + r_co, 4) AS total FROM facilities""")
def sc15(spark, sf):
    f = d.facilities(spark, sf).select("facility_id", F.col("r_nox").cast("string").alias("NOX"), F.col("r_co").cast("string").alias("CO"))
    m = readers.facilities_wide(f, "facility_id", {"NOX": "nox", "CO": "co"})
    return m.select("facility_id", F.size("pollutants").alias("n"), F.round(numeric.map_total(F.col("pollutants")), 4).alias("total"))


@query("sc16_latest_facility", """
SELECT o_custkey AS id, CAST(max(year(o_orderdate)) AS INT) AS year, count(*) AS n FROM orders GROUP BY 1""")
def sc16(spark, sf):
    o = d.t(spark, sf, "orders").select(F.col("o_custkey").alias("id"), F.year("o_orderdate").alias("year"), F.col("o_totalprice").alias("lon"), F.col("o_totalprice").alias("lat"))
    n = o.groupBy("id").agg(F.count("*").alias("n"))
    return readers.latest_facilities(o, "id", "year", "lon", "lat").select("id", "year").join(n, "id")


@query("sc17_latest_plant", """
SELECT s_nationkey AS plant, round(arg_min(s_acctbal, s_suppkey), 2) AS value FROM supplier GROUP BY 1""")
def sc17(spark, sf):
    s = d.t(spark, sf, "supplier").select(F.col("s_nationkey").alias("plant"), F.lit(2020).alias("year"), "s_suppkey", "s_acctbal")
    return cells.latest_per_key(s, "plant", "year", "s_suppkey").select("plant", F.round("s_acctbal", 2).alias("value"))


@query("sc18_power_units", """
SELECT lower(p_type) AS kind, count(*) AS n, round(sum(p_retailprice), 4) AS capacity FROM part WHERE lower(p_type) IN (SELECT DISTINCT lower(p_type) FROM part WHERE p_size > 45) AND p_size >= 10 GROUP BY 1""")
def sc18(spark, sf):
    p = d.t(spark, sf, "part")
    kinds = p.where(F.col("p_size") > 45).select(F.lower("p_type").alias("kind")).distinct()
    u = p.where(F.col("p_size") >= 10).withColumn("kind", F.lower("p_type")).join(kinds, "kind", "left_semi")
    return u.groupBy("kind").agg(F.count("*").alias("n"), F.round(F.sum(F.coalesce("p_retailprice", F.lit(0.0))), 4).alias("capacity"))


@query("sc19_survey_scan", "SELECT c_mktsegment AS lc1, count(*) AS n FROM customer WHERE c_nationkey = 7 GROUP BY 1")
def sc19(spark, sf):
    return d.t(spark, sf, "customer").select("c_nationkey", "c_mktsegment").where(F.col("c_nationkey") == 7).groupBy(F.col("c_mktsegment").alias("lc1")).agg(F.count("*").alias("n"))


@query("sc20_fire_scan", "SELECT CAST(user_id % 25 AS BIGINT) AS cell, count(*) AS n, round(sum(value), 4) AS frp FROM events WHERE value BETWEEN 10 AND 200 GROUP BY 1")
def sc20(spark, sf):
    return d.fires(spark, sf).where(F.col("value").between(10, 200)).groupBy(F.col("cell").cast("long").alias("cell")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("frp"))


@query("sc21_night_fires", """
SELECT round(CAST(user_id % 25 AS DOUBLE) / 7, 5) AS lat, round(CAST(user_id AS DOUBLE) / 7, 5) AS lon, round(max(value), 4) AS rhi FROM events WHERE value > 0 AND value < 9e5 GROUP BY 1, 2""")
def sc21(spark, sf):
    e = d.t(spark, sf, "events").where((F.col("value") > 0) & (F.col("value") < 9e5))
    return e.groupBy(F.round((F.col("user_id") % 25).cast("double") / 7, 5).alias("lat"), F.round(F.col("user_id").cast("double") / 7, 5).alias("lon")).agg(F.round(F.max("value"), 4).alias("rhi"))


@query("sc22_mines", """
SELECT p_partkey AS id, round(sqrt(p_size * 1e6 / pi()) * 1.5e0, 4) AS radius, CASE WHEN p_type LIKE '%A%' THEN 1e0 ELSE 0.5e0 END AS weight FROM part WHERE lower(trim(p_brand)) = 'brand#11'""")
def sc22(spark, sf):
    p = d.t(spark, sf, "part").where(F.lower(F.trim("p_brand")) == "brand#11")
    return p.select(F.col("p_partkey").alias("id"), F.round(numeric.radius_from_area(F.col("p_size"), 1.5), 4).alias("radius"), F.when(F.col("p_type").contains("A"), 1.0).otherwise(0.5).alias("weight"))


@query("sc23_fields", "SELECT CASE WHEN p_size % 2 = 0 THEN 5000 ELSE 1500 END AS buffer_m, count(*) AS n FROM part WHERE lower(trim(p_brand)) IN ('brand#11', 'brand#12') GROUP BY 1")
def sc23(spark, sf):
    p = d.t(spark, sf, "part").where(F.lower(F.trim("p_brand")).isin("brand#11", "brand#12"))
    return p.groupBy(F.when(F.col("p_size") % 2 == 0, 5000).otherwise(1500).alias("buffer_m")).agg(F.count("*").alias("n"))


@query("sc24_livestock", """
SELECT n_regionkey AS nuts, round(sum(CASE WHEN c_mktsegment = 'BUILDING' THEN abs(c_acctbal) ELSE 0 END), 3) AS bovine,
       round(sum(CASE WHEN c_mktsegment = 'MACHINERY' THEN abs(c_acctbal) ELSE 0 END), 3) AS pigs FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def sc24(spark, sf):
    c = d.t(spark, sf, "customer").join(d.t(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    species = F.when(F.col("c_mktsegment") == "BUILDING", "bovine").when(F.col("c_mktsegment") == "MACHINERY", "pigs")
    wide = c.withColumn("species", species).groupBy(F.col("n_regionkey").alias("nuts")).pivot("species", ["bovine", "pigs"]).agg(F.sum(F.abs("c_acctbal"))).fillna(0.0)
    return wide.select("nuts", F.round("bovine", 3).alias("bovine"), F.round("pigs", 3).alias("pigs"))


@query("sc25_region_outline", "SELECT n_regionkey AS region, count(*) AS parts, min(n_name) AS first FROM nation GROUP BY 1")
def sc25(spark, sf):
    return d.t(spark, sf, "nation").groupBy(F.col("n_regionkey").alias("region")).agg(F.count("*").alias("parts"), F.min("n_name").alias("first"))


@query("sc26_treatment_plants", "SELECT s_suppkey AS id, coalesce(nullif(trim(CASE WHEN s_suppkey % 3 = 0 THEN ' ' ELSE s_name END), ''), 'plant-' || s_suppkey) AS name FROM supplier WHERE s_acctbal > 0")
def sc26(spark, sf):
    from ..functions.text import blank_to_null

    s = d.t(spark, sf, "supplier").where(F.col("s_acctbal") > 0)
    name = F.when(F.col("s_suppkey") % 3 == 0, " ").otherwise(F.col("s_name"))
    return s.select(F.col("s_suppkey").alias("id"), F.coalesce(blank_to_null(name), F.concat(F.lit("plant-"), F.col("s_suppkey").cast("string"))).alias("name"))


@query("sc27_layer_stack", "SELECT 'nation:' || n_nationkey AS id, n_name AS name, 'nation' AS source FROM nation UNION ALL SELECT 'region:' || r_regionkey, r_name, 'region' FROM region")
def sc27(spark, sf):
    n = d.t(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    return cells.unite({"nation": n, "region": d.t(spark, sf, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))}, "id")


@query("sc28_kind_filter", "SELECT CASE p_partkey % 2 WHEN 0 THEN 'node' ELSE 'area_way' END AS kind, count(*) AS n FROM part WHERE p_partkey % 2 = 1 GROUP BY 1")
def sc28(spark, sf):
    return d.tags(spark, sf).where(F.col("elem_kind").isin("area_way", "area_rel")).groupBy(F.col("elem_kind").alias("kind")).agg(F.count("*").alias("n"))


@query("sc30_road_scan", "SELECT c_custkey AS id, round(c_acctbal, 2) AS flow FROM customer WHERE c_nationkey = 3")
def sc30(spark, sf):
    return d.t(spark, sf, "customer").where(F.col("c_nationkey") == 3).select(F.col("c_custkey").alias("id"), F.round("c_acctbal", 2).alias("flow"))


@query("sc31_workbook", d.with_(d.REPORTED) + "SELECT country, year, sector, round(sum(total), 2) AS total FROM reported GROUP BY 1, 2, 3")
def sc31(spark, sf):
    r = d.reported(spark, sf)
    one = r.select(F.concat_ws(";", "country", F.col("year").cast("string"), "sector", "pollutant", F.lit("kt"), F.col("total").cast("string")).alias("all"))
    return readers.workbook(one).groupBy(F.col("COUNTRY").alias("country"), F.col("YEAR").alias("year"), F.col("SECTOR").alias("sector")).agg(F.round(F.sum("TOTAL"), 2).alias("total"))


@query("sc35_weight_read", d.with_(d.PIXELS) + 'SELECT cell_id, count(*) AS n, round(sum(greatest(signal, 0)), 4) AS total FROM pixels WHERE signal > 0 GROUP BY 1')
def sc35(spark, sf):
    return d.pixels(spark, sf).where(F.col("signal") > 0).groupBy("cell_id").agg(F.count("*").alias("n"), F.round(F.sum("signal"), 4).alias("total"))


@query("sc36_sidecar_read", "SELECT CAST(CAST(json_extract(props, '$.k') AS BIGINT) AS INT) AS k, count(*) AS n FROM events GROUP BY 1")
def sc36(spark, sf):
    e = d.t(spark, sf, "events").select(F.from_json("props", "k int").alias("p"))
    return e.groupBy(F.col("p.k").alias("k")).agg(F.count("*").alias("n"))


@query("sc37_result_read", d.with_(d.SOURCES) + "SELECT cell_id, round(sum(nox), 4) AS emission FROM sources WHERE nox > 25 GROUP BY 1")
def sc37(spark, sf):
    return d.sources(spark, sf).where(F.col("nox") > 25).groupBy("cell_id").agg(F.round(F.sum("nox"), 4).alias("emission"))


@query("sc38_feature_scan", "SELECT count(*) AS n FROM part WHERE p_type IS NOT NULL AND p_partkey % 2 = 0")
def sc38(spark, sf):
    return d.tags(spark, sf).where(F.map_contains_key("tags", "type") & (F.col("elem_kind") == "node")).agg(F.count("*").alias("n"))


@query("sc39_mosaic", """
WITH a AS (SELECT CAST(s_suppkey AS INT) AS "row", 0 AS col, s_acctbal AS value FROM supplier WHERE s_suppkey < 60),
b AS (SELECT CAST(s_suppkey AS INT) AS "row", 0 AS col, -1e0 AS value FROM supplier WHERE s_suppkey >= 40)
SELECT "row", col, value FROM a UNION ALL SELECT "row", col, value FROM b WHERE "row" NOT IN (SELECT "row" FROM a)""")
def sc39(spark, sf):
    s = d.t(spark, sf, "supplier").select(F.col("s_suppkey").cast("int").alias("row"), F.lit(0).alias("col"), F.col("s_acctbal").alias("value"))
    return readers.mosaic([s.where(F.col("row") < 60), s.where(F.col("row") >= 40).withColumn("value", F.lit(-1.0))])


@query("pf01_source_filter", d.with_(d.SOURCES) + "SELECT cell_id, count(*) AS n FROM sources WHERE category IN (1, 2, 3) AND source_type = 1 AND country = 5 AND greatest(pm10, nh3) > 0 GROUP BY 1")
def pf01(spark, sf):
    return cells.select_sources(d.sources(spark, sf), categories=[1, 2, 3], types=[1], country=5, positive=["pm10", "nh3"]).groupBy("cell_id").agg(F.count("*").alias("n"))


@query("pf02_domain_rectangle", d.with_(d.PIXELS) + 'SELECT count(*) AS n FROM pixels WHERE "row" + 0.5e0 BETWEEN 100.5e0 AND 900.5e0 AND col + 0.5e0 BETWEEN 10.5e0 AND 50.5e0')
def pf02(spark, sf):
    p = d.pixels(spark, sf)
    inside = geo.in_box(numeric.pixel_centre(F.col("col"), 0.0, 1.0), numeric.pixel_centre(F.col("row"), 0.0, 1.0), (10.5, 100.5, 50.5, 900.5))
    return p.where(inside).agg(F.count("*").alias("n"))


@query("pf03_bbox", d.with_(d.SOURCES) + "SELECT count(*) AS n FROM sources WHERE lon BETWEEN 0 AND 10 AND lat BETWEEN 40 AND 50")
def pf03(spark, sf):
    return d.sources(spark, sf).where(geo.in_box(F.col("lon"), F.col("lat"), (0.0, 40.0, 10.0, 50.0))).agg(F.count("*").alias("n"))


@query("pf04_envelopes_meet", "SELECT n_nationkey AS id FROM nation WHERE NOT (-8e0 + 2 * n_nationkey < 3 OR -10e0 + 2 * n_nationkey > 12)")
def pf04(spark, sf):
    n = d.t(spark, sf, "nation")
    w = F.col("n_nationkey") * 2 - 10.0
    return n.where(geo.boxes_meet((w, F.lit(0.0), w + 2, F.lit(1.0)), (3.0, 0.5, 12.0, 2.0))).select(F.col("n_nationkey").alias("id"))


@query("pf05_rows_inside", d.with_(d.PIXELS) + """
SELECT CAST(floor(col / 10e0) * 10 AS BIGINT) AS xcor_sw, CAST(floor("row" / 10e0) * 10 AS BIGINT) AS ycor_sw, round(sum(signal), 4) AS emission FROM pixels GROUP BY 1, 2
HAVING CAST(floor(col / 10e0) * 10 AS BIGINT) >= 20 AND CAST(floor("row" / 10e0) * 10 AS BIGINT) >= 100 AND CAST(floor(col / 10e0) * 10 AS BIGINT) + 10 <= 80 AND CAST(floor("row" / 10e0) * 10 AS BIGINT) + 10 <= 500""")
def pf05(spark, sf):
    from ..operators import export

    p = d.pixels(spark, sf).withColumn("xcor_sw", numeric.snap(F.col("col"), 10).cast("long")).withColumn("ycor_sw", numeric.snap(F.col("row"), 10).cast("long"))
    g = p.groupBy("xcor_sw", "ycor_sw").agg(F.round(F.sum("signal"), 4).alias("emission")).withColumn("xcor_ne", F.col("xcor_sw") + 10).withColumn("ycor_ne", F.col("ycor_sw") + 10)
    return export.inside_rows(g, (20, 100, 80, 500)).select("xcor_sw", "ycor_sw", "emission")


@query("pf06_pixels_in_cells", d.with_(d.PIXELS) + 'SELECT count(*) AS n FROM pixels WHERE EXISTS (SELECT 1 FROM nation WHERE col >= 4 * n_nationkey AND col < 4 * n_nationkey + 2)')
def pf06(spark, sf):
    p, n = d.pixels(spark, sf), d.t(spark, sf, "nation")
    cols = n.select(F.explode(F.sequence(F.col("n_nationkey") * 4, F.col("n_nationkey") * 4 + 1)).alias("col")).distinct()
    return p.join(cols, "col", "left_semi").agg(F.count("*").alias("n"))


@query("pf07_country_restriction", d.with_(d.PIXELS) + "SELECT CASE WHEN cell_id IN (SELECT n_nationkey * 7 FROM nation) THEN cell_id ELSE -1 END AS cell_id, count(*) AS n FROM pixels GROUP BY 1")
def pf07(spark, sf):
    c = d.t(spark, sf, "nation").select((F.col("n_nationkey") * 7).cast("long").alias("cell_id"))
    return cells.restrict(d.pixels(spark, sf), c).groupBy(F.col("cell_id").cast("long").alias("cell_id")).agg(F.count("*").alias("n"))


@query("pf13_fire_filter", "SELECT event_type, count(*) AS n FROM events WHERE event_type IN ('click', 'view') AND value >= 1 GROUP BY 1")
def pf13(spark, sf):
    return d.fires(spark, sf).where(F.lower("event_type").isin("click", "view") & (F.col("value") >= 1)).groupBy("event_type").agg(F.count("*").alias("n"))


@query("pf17_least_area", "SELECT p_partkey AS id, p_size * p_size / 2e0 AS area FROM part WHERE p_size * p_size / 2e0 >= 200")
def pf17(spark, sf):
    p = d.t(spark, sf, "part")
    s, z = F.col("p_size").cast("double"), F.lit(0.0)
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    area = geo.shoelace_area(F.array(point(z, z), point(s, z), point(z, s)))
    return p.select(F.col("p_partkey").alias("id"), area.alias("area")).where(F.col("area") >= 200)


@query("pf19_mask_membership", "SELECT c_custkey AS id FROM customer WHERE floor(abs(c_acctbal) / 100) IN (SELECT floor(abs(s_acctbal) / 100) FROM supplier)")
def pf19(spark, sf):
    m = d.t(spark, sf, "supplier").select(F.floor(F.abs("s_acctbal") / 100).alias("i")).distinct()
    return d.t(spark, sf, "customer").withColumn("i", F.floor(F.abs("c_acctbal") / 100)).join(m, "i", "left_semi").select(F.col("c_custkey").alias("id"))


_AXIS = "SELECT c, count(*) AS n FROM (SELECT coalesce(n_nationkey, -1) AS c FROM {p} LEFT JOIN nation ON v >= -10e0 + 2 * n_nationkey AND v < -8e0 + 2 * n_nationkey) GROUP BY 1"


@query("jn01_range_join", d.with_(d.SOURCES, "shifted AS (SELECT lon * 1.5e0 - 5 AS v FROM sources)") + _AXIS.format(p="shifted"))
def jn01(spark, sf):
    axis = d.t(spark, sf, "nation").select("n_nationkey", (F.col("n_nationkey") * 2 - 10.0).alias("low"), (F.col("n_nationkey") * 2 - 8.0).alias("high"))
    s = d.sources(spark, sf).select((F.col("lon") * 1.5 - 5).alias("v"))
    return cells.range_join(s, "v", axis, "low", "high", 2.0, "left").groupBy(F.coalesce("n_nationkey", F.lit(-1)).alias("c")).agg(F.count("*").alias("n"))


@query("jn02_strict_lookup", """
WITH p AS (SELECT c_custkey AS id, abs(c_acctbal) % 60 AS v FROM customer), axis AS (SELECT n_nationkey AS i, 2e0 * n_nationkey AS low, 2e0 * n_nationkey + 3 AS high FROM nation),
h AS (SELECT id, count(i) AS k, min(i) AS i FROM p LEFT JOIN axis ON v >= low AND v < high GROUP BY id)
SELECT CASE WHEN k = 1 THEN i ELSE -1 END AS i, count(*) AS n FROM h GROUP BY 1""")
def jn02(spark, sf):
    axis = d.t(spark, sf, "nation").select(F.col("n_nationkey").alias("i"), (F.col("n_nationkey") * 2.0).alias("low"), (F.col("n_nationkey") * 2.0 + 3).alias("high"))
    p = d.t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), (F.abs("c_acctbal") % 60).alias("v"))
    return cells.strict_lookup(p, "id", "v", axis, "i", "low", "high", 3.0).groupBy("i").agg(F.count("*").alias("n"))


@query("jn03_pixel_cells", d.with_(d.SOURCES) + "SELECT cell_id, count(*) AS n FROM sources GROUP BY 1")
def jn03(spark, sf):
    s = d.sources(spark, sf).drop("cell_id")
    return s.groupBy(cells.regular_cell(F.col("lon"), F.col("lat"), -10.0, 35.0, 2.0, 5.0, 25, 5).alias("cell_id")).agg(F.count("*").alias("n"))


@query("jn14_lines_in_cells", """
WITH s AS (SELECT s_suppkey AS id, CAST(s_suppkey % 10 AS DOUBLE) AS x1, CAST(s_nationkey AS DOUBLE) AS x2, s_suppkey % 7 + 0.5e0 AS y1 FROM supplier),
e AS (SELECT id, x1, x2, CAST(floor(y1) AS INT) AS r, c FROM s, range(0, 30) g(c) WHERE least(x1, x2) < c + 1 AND greatest(x1, x2) > c)
SELECT r, CAST(c AS INT) AS c, round(sum(least(greatest(x1, x2), c + 1) - greatest(least(x1, x2), c)), 6) AS length FROM e GROUP BY 1, 2""")
def jn14(spark, sf):
    from ..operators import lines

    s = d.t(spark, sf, "supplier").select((F.col("s_suppkey") % 10).cast("double").alias("x1"), F.col("s_nationkey").cast("double").alias("x2"), (F.col("s_suppkey") % 7 + 0.5).alias("y1"))
    g = lines.segments_in_cells(s.withColumn("y2", F.col("y1")), 1.0)
    return g.groupBy("r", "c").agg(F.round(F.sum("inside"), 6).alias("length"))


@query("jn15_points_in_polygon", """
SELECT count(*) AS n FROM (SELECT DISTINCT x, y FROM (SELECT abs(c_acctbal) / 100 AS x, CAST(c_nationkey AS DOUBLE) AS y FROM customer)) WHERE x + y < 60 AND x > 10 AND y > 2.5e0""")
def jn15(spark, sf):
    c = d.t(spark, sf, "customer").select((F.abs("c_acctbal") / 100).alias("x"), F.col("c_nationkey").cast("double").alias("y")).distinct()
    corner = lambda x, y: F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"))
    ring = F.array(corner(10.0, 2.5), corner(57.5, 2.5), corner(10.0, 50.0))
    return c.where(geo.in_ring(F.col("x"), F.col("y"), ring)).agg(F.count("*").alias("n"))


@query("ag01_footprint", d.with_(d.SOURCES) + "SELECT DISTINCT cell_id FROM sources WHERE pm10 > 0.05e0")
def ag01(spark, sf):
    s = d.sources(spark, sf).withColumn("pm10", F.when(F.col("pm10") > 0.05, F.col("pm10")).otherwise(0.0))
    return cells.footprint(s, ["pm10"])


@query("ag02_cell_mass", d.with_(d.SOURCES) + """
, fp AS (SELECT DISTINCT cell_id FROM sources WHERE nox > 0), m AS (SELECT cell_id, sum(nox) AS nox, sum(co) AS co FROM sources WHERE source_type = 1 AND category = 2 GROUP BY 1)
SELECT fp.cell_id, round(coalesce(nox, 0), 4) AS nox, round(coalesce(co, 0), 2) AS co FROM fp LEFT JOIN m USING (cell_id)""")
def ag02(spark, sf):
    s = d.sources(spark, sf)
    m = cells.cell_mass(cells.select_sources(s, types=[1], categories=[2]), ["nox", "co"], cells.footprint(s, ["nox"]))
    return m.select("cell_id", F.round("nox", 4).alias("nox"), F.round("co", 2).alias("co"))


@query("ag03_shipping_mass", d.with_(d.SOURCES) + """
, e AS (SELECT DISTINCT cell_id FROM sources WHERE nox > 0), own AS (SELECT DISTINCT cell_id FROM sources WHERE country = 3 AND nox > 0),
sea AS (SELECT CAST(n_nationkey AS BIGINT) AS cell_id FROM nation), fp AS (SELECT cell_id FROM own UNION (SELECT cell_id FROM sea INTERSECT SELECT cell_id FROM e))
SELECT fp.cell_id, round(sum(nox), 4) AS nox FROM fp JOIN sources USING (cell_id) GROUP BY 1""")
def ag03(spark, sf):
    sea = d.t(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("cell_id"))
    return cells.shipping_mass(d.sources(spark, sf), 3, sea, ["nox"]).select("cell_id", F.round("nox", 4).alias("nox"))


@query("ag06_regrid", d.with_(d.PIXELS) + 'SELECT CAST(floor("row" / 100e0) AS INT) AS r, CAST(floor(col / 10e0) AS INT) AS c, round(sum(signal), 4) AS signal FROM pixels GROUP BY 1, 2')
def ag06(spark, sf):
    p = d.pixels(spark, sf)
    return p.groupBy(numeric.floor_index(F.col("row"), 0.0, 100.0).alias("r"), numeric.floor_index(F.col("col"), 0.0, 10.0).alias("c")).agg(F.round(F.sum("signal"), 4).alias("signal"))


@query("ag45_domain_bounds", "SELECT min(-10e0 + 2 * n_nationkey) AS west, 35e0 AS south, max(-8e0 + 2 * n_nationkey) AS east, 60e0 AS north FROM nation")
def ag45(spark, sf):
    n = d.t(spark, sf, "nation").select((F.col("n_nationkey") * 2 - 10.0).alias("west"), (F.col("n_nationkey") * 2 - 8.0).alias("east"), F.lit(35.0).alias("south"), F.lit(60.0).alias("north"))
    return cells.bounds(n)


@query("ag46_covered_area", "SELECT round(sum(2e0 * 5 * 111 * 111 * cos(radians(37.5e0 + 5 * n_regionkey))), 2) AS km2 FROM nation")
def ag46(spark, sf):
    w, s = F.col("n_nationkey") * 2 - 10.0, F.col("n_regionkey") * 5 + 35.0
    n = d.t(spark, sf, "nation").select(w.alias("west"), (w + 2).alias("east"), s.alias("south"), (s + 5).alias("north"))
    return cells.covered_km2(n).select(F.round("km2", 2).alias("km2"))


@query("ag47_distinct_pollutants", "SELECT DISTINCT c_mktsegment AS pollutant FROM customer")
def ag47(spark, sf):
    return d.t(spark, sf, "customer").select(F.col("c_mktsegment").alias("pollutant")).distinct()


_SETS = d.with_(d.SOURCES, "a AS (SELECT DISTINCT cell_id FROM sources WHERE country = 3)", "b AS (SELECT DISTINCT cell_id FROM sources WHERE country = 7)")


def _set(name, how):
    word = {"union": "UNION", "intersect": "INTERSECT", "subtract": "EXCEPT"}[how]

    @query(name, _SETS + f"SELECT cell_id FROM a {word} SELECT cell_id FROM b")
    def f(spark, sf):
        s = d.sources(spark, sf)
        a, b = (s.where(F.col("country") == k).select("cell_id") for k in (3, 7))
        out = getattr(a, how)(b)
        return out.distinct() if how == "union" else out

    return f


_set("so01_cell_union", "union")
_set("so02_cell_intersect", "intersect")
_set("so03_cell_except", "subtract")


@query("so04_facility_union", "SELECT 'jrc:' || s_suppkey AS facility_id, 'jrc' AS source, s_name AS name, NULL AS kind FROM supplier UNION ALL SELECT 'lcp:' || n_nationkey, 'lcp', NULL, n_name FROM nation")
def so04(spark, sf):
    a = d.t(spark, sf, "supplier").select(F.col("s_suppkey").alias("facility_id"), F.col("s_name").alias("name"))
    b = d.t(spark, sf, "nation").select(F.col("n_nationkey").alias("facility_id"), F.col("n_name").alias("kind"))
    return cells.unite({"jrc": a, "lcp": b}, "facility_id").select("facility_id", "source", "name", "kind")


@query("so05_union_all", "SELECT 1 AS part, n_regionkey AS k FROM nation UNION ALL SELECT 2, r_regionkey FROM region")
def so05(spark, sf):
    a = d.t(spark, sf, "nation").select(F.lit(1).alias("part"), F.col("n_regionkey").alias("k"))
    return a.unionByName(d.t(spark, sf, "region").select(F.lit(2).alias("part"), F.col("r_regionkey").alias("k")))


@query("so06_first_wins", "SELECT n_regionkey AS cell, min(n_nationkey) AS first FROM nation GROUP BY 1")
def so06(spark, sf):
    n = d.t(spark, sf, "nation")
    return n.groupBy(F.col("n_regionkey").alias("cell")).agg(F.min_by("n_nationkey", "n_nationkey").alias("first"))


@query("h04_point_cells", d.with_(d.SOURCES) + "SELECT DISTINCT cell_id, 0e0 AS mass FROM sources WHERE source_type = 2")
def h04(spark, sf):
    return d.sources(spark, sf).where(F.col("source_type") == 2).select("cell_id").distinct().withColumn("mass", F.lit(0.0))


@query("h17_inventory_filters", "SELECT DISTINCT l_returnflag AS sector, l_linestatus AS kind FROM lineitem")
def h17(spark, sf):
    return d.t(spark, sf, "lineitem").select(F.col("l_returnflag").alias("sector"), F.col("l_linestatus").alias("kind")).dropDuplicates()


@query("h18_cell_centres", "SELECT CAST(r_regionkey * 25 + n_nationkey AS BIGINT) AS cell_id, -9e0 + 2 * n_nationkey AS lon, 37.5e0 + 5 * r_regionkey AS lat FROM nation, region")
def h18(spark, sf):
    axes = sc05(spark, sf)
    lon = axes.where(F.col("axis") == "lon").select(F.col("idx").alias("lon_idx"), F.col("low").alias("west"), F.col("high").alias("east"))
    lat = axes.where(F.col("axis") == "lat").select(F.col("idx").alias("lat_idx"), F.col("low").alias("south"), F.col("high").alias("north"))
    return cells.cell_centres(lon, lat, 25)
