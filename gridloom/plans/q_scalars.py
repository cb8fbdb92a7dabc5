"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo, numeric, text
from . import domain as d
from .registry import query


def _on(name, table, key, sql, make, digits=None):
    """Register a function of one row: (id, v)."""
    value = f"round({sql}, {digits})" if digits is not None else sql

    @query(name, f"SELECT {key} AS id, {value} AS v FROM {table}")
    def f(spark, sf):
        c = make()
        return d.t(spark, sf, table).select(F.col(key).alias("id"), (F.round(c, digits) if digits is not None else c).alias("v"))

    return f


_H = "2 * 6371e0 * atan2(sqrt({a}), sqrt(1 - {a}))".format(a="(pow(sin(radians(38e0 - s_nationkey) / 2), 2) + cos(radians(s_nationkey)) * cos(radians(38e0)) * pow(sin(radians(23.7e0 - s_suppkey % 20) / 2), 2))")
_on("fn01_haversine", "supplier", "s_suppkey", _H, lambda: geo.haversine_km((F.col("s_suppkey") % 20).cast("double"), F.col("s_nationkey").cast("double"), F.lit(23.7), F.lit(38.0)), 6)
_on("fn02_sector_token", "orders", "o_orderkey", "regexp_replace(upper(trim(o_orderpriority)), '[^A-Z0-9]', '', 'g')", lambda: text.sector_token(F.lower("o_orderpriority")))
_on("fn03_pollutant_alias", "nation", "n_nationkey", "CASE WHEN n_nationkey % 2 = 0 THEN 'sox' ELSE 'pm2_5' END", lambda: text.label_or_fail(F.when(F.col("n_nationkey") % 2 == 0, "SO2").otherwise("PM25"), {"SO2": "sox", "SOX": "sox", "PM25": "pm2_5"}))
_on("fn04_country_alias", "nation", "n_nationkey", "CASE WHEN n_nationkey < 5 THEN 'EU27' ELSE n_name END", lambda: F.when(F.col("n_nationkey") < 5, text.lookup(F.lit("EU27"), {"EU27": "EU27", "EU11": "EU11"})).otherwise(F.col("n_name")))
_on("fn05_dict_key", "part", "p_partkey", "replace(lower(p_brand || '.A'), '.', '_')", lambda: text.dict_key(F.concat("p_brand", F.lit(".A"))))
_on("fn06_country_list", "nation", "n_nationkey", "CAST(CASE WHEN n_nationkey % 2 = 0 THEN 2 ELSE 1 END AS INT)", lambda: F.size(text.country_list(F.when(F.col("n_nationkey") % 2 == 0, "GRC; ita,xx1").otherwise("fra,")))) 
_on("fn07_cover_code", "part", "p_partkey", "regexp_replace(upper(p_name), '\\s+', ' ', 'g')", lambda: text.cover_code(F.concat(F.lit("'"), F.replace("p_name", F.lit(" "), F.lit("   ")), F.lit("\""))))
_on("fn08_number", "customer", "c_custkey", "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey / 4e0 END", lambda: text.number(F.when(F.col("c_custkey") % 3 == 0, "n.a").otherwise(F.replace((F.col("c_custkey") / 4).cast("string"), F.lit("."), F.lit(",")))))
_on("fn09_token_overlap", "part", "p_partkey", "CAST(len(list_distinct(list_intersect(regexp_extract_all(lower(p_name), '[a-z0-9]+'), regexp_extract_all(lower(p_type || ' ' || p_name), '[a-z0-9]+')))) AS INT)", lambda: text.token_overlap(F.upper("p_name"), F.concat_ws(" ", "p_type", "p_name")))
_on("fn10_road_group", "customer", "c_custkey", "CASE c_custkey % 4 WHEN 0 THEN 'motorway' WHEN 1 THEN 'primary' WHEN 2 THEN NULL ELSE 'trunk' END", lambda: text.road_group(F.element_at(F.array(*map(F.lit, ("Motorway_link", "primary", "living_street", "TRUNK"))), (F.col("c_custkey") % 4 + 1).cast("int"))))
_on("fn11_season", "orders", "o_orderkey", "CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'winter' WHEN month(o_orderdate) < 6 THEN 'spring' WHEN month(o_orderdate) < 9 THEN 'summer' ELSE 'autumn' END", lambda: text.season(F.month("o_orderdate")))
_on("fn12_snap", "customer", "c_custkey", "CAST(floor(c_acctbal / 250e0) * 250 AS BIGINT)", lambda: numeric.snap(F.col("c_acctbal"), 250.0).cast("long"))
_on("fn13_grams_per_second", "customer", "c_custkey", "abs(c_acctbal) * 1000e0 / (365 * 24 * 3600)", lambda: F.abs("c_acctbal") * numeric.KG_PER_YEAR_TO_G_PER_S, 9)
_on("fn14_scientific", "nation", "n_nationkey", "CASE WHEN n_nationkey = 0 THEN '0' ELSE CAST(CAST(round(n_nationkey * 1e3 / pow(10, floor(log10(n_nationkey * 1e3))), 1) AS DECIMAL(10, 1)) AS VARCHAR) || '×10^' || CAST(CAST(floor(log10(n_nationkey * 1e3)) AS INT) AS VARCHAR) END", lambda: text.scientific(F.col("n_nationkey") * 1e3))
_on("fn15_colour", "nation", "n_nationkey", "printf('#%02x%02x%02x', CAST(round_even(255e0 * n_nationkey / 24, 0) AS BIGINT), CAST(round_even(100 - 100e0 * n_nationkey / 24, 0) AS BIGINT), CAST(0 AS BIGINT))", lambda: text.blend(F.col("n_nationkey") / 24.0, (0, 100, 0), (255, 0, 0)))
_on("fn16_tile_west", "nation", "n_nationkey", "n_nationkey / 32e0 * 360 - 180", lambda: geo.tile_bounds(F.lit(5), F.col("n_nationkey"), F.lit(3))[0], 8)
_on("fn16_tile_north", "nation", "n_nationkey", "degrees(atan(sinh(pi() * (1 - 2 * n_nationkey / 32e0))))", lambda: geo.tile_bounds(F.lit(5), F.lit(0), F.col("n_nationkey"))[3], 8)
_on("fn16_mercator_pixel", "nation", "n_nationkey", "(0.5e0 - ln((1 + sin(radians(n_nationkey))) / (1 - sin(radians(n_nationkey)))) / (4 * pi())) * 8192", lambda: geo.mercator_pixel(F.lit(0.0), F.col("n_nationkey").cast("double"), 5)[1], 6)
_on("fn16_zoom", "customer", "c_custkey", "CAST(greatest(0, least(18, floor(log2(1440 / (c_custkey * 0.07e0))))) AS INT)", lambda: geo.zoom_for(F.col("c_custkey") * 0.07))
_on("fn17_pig_split", "nation", "n_nationkey", "CASE n_nationkey % 3 WHEN 0 THEN 0.75e0 WHEN 1 THEN 0.5e0 ELSE 0.25e0 END", lambda: __import__("gridloom.operators.signals", fromlist=["pig_split"]).pig_split(F.element_at(F.array(F.lit("NLD"), F.lit("DEU"), F.lit("GRC")), (F.col("n_nationkey") % 3 + 1).cast("int"))))
_on("fn18_pixel_area", "nation", "n_nationkey", "n_nationkey * 100e0 * 100 / 1e4", lambda: F.col("n_nationkey") * 100.0 * 100.0 / 1e4)
_on("fn19_linear_index", "nation", "n_nationkey", "CAST((n_regionkey * 25 + n_nationkey) * 7 + 3 AS INT)", lambda: numeric.linear_index([F.col("n_regionkey"), F.col("n_nationkey"), F.lit(3)], [5, 25, 7]).cast("int"))
_on("fn19_unravel", "customer", "c_custkey", "CAST(c_custkey // 7 % 25 AS INT)", lambda: numeric.unravel(F.col("c_custkey"), [500, 25, 7])[1])
_on("fn21_tag_json", "events", "event_id", "CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(json_extract(props, '$.k') AS VARCHAR) END", lambda: F.try_element_at(text.tag_map(F.when(F.col("event_id") % 5 == 0, "{bad").otherwise(F.col("props"))), F.lit("k")))
_on("fn22_template", "part", "p_partkey", "'railway_' || p_type || '_' || '!'", lambda: text.template("railway_{type}_{none}!", F.create_map(F.lit("type"), F.col("p_type"))))
_on("fn23_flat_tag", "part", "p_partkey", "p_type", lambda: text.flat_tag(F.when(F.col("p_partkey") % 2 == 0, F.create_map(F.lit("plant:source"), F.col("p_type"))).otherwise(F.create_map(F.lit("plant_source"), F.col("p_type"))), "plant:source"))
_on("fn25_truncated_index", "customer", "c_custkey", "CAST(trunc((c_acctbal - 100) / 250e0) AS INT)", lambda: numeric.truncated_index(F.col("c_acctbal"), 100.0, 250.0))
_on("fn26_positive_total", "customer", "c_custkey", "greatest(c_acctbal, 0) + c_nationkey", lambda: numeric.map_total(numeric.positive_map(F.create_map(F.lit("a"), F.col("c_acctbal"), F.lit("b"), F.col("c_nationkey").cast("double")))), 4)
_on("fn27_jitter_angle", "nation", "n_nationkey", "CAST(list_sum(list_transform(string_split(n_name, ''), lambda x: ascii(x))) % 360 AS INT)", lambda: text.jitter_angle(F.col("n_name")))
_on("fn29_threshold", "customer", "c_custkey", "CASE c_mktsegment WHEN 'BUILDING' THEN 1e0 WHEN 'MACHINERY' THEN 0.5e0 ELSE 0e0 END", lambda: text.lookup(F.col("c_mktsegment"), {"BUILDING": 1.0, "MACHINERY": 0.5}, 0.0))
_on("fn30_label_fallback", "nation", "n_nationkey", "CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE 'unknown' END", lambda: F.element_at(F.map_concat(F.create_map(F.lit("other"), F.lit("x")), F.create_map(F.lit("name"), F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).otherwise("unknown"))), "name"))


@query("fn24_display_scale", "SELECT c_custkey AS id, round(greatest(abs(c_acctbal) / max(abs(c_acctbal)) OVER (PARTITION BY c_nationkey), 0.05e0), 8) AS v FROM customer")
def fn24(spark, sf):
    from ..operators.normalize import max_scaled

    c = d.t(spark, sf, "customer").withColumn("a", F.abs("c_acctbal"))
    return max_scaled(c, "a", "v", ["c_nationkey"], eps=0.0).select(F.col("c_custkey").alias("id"), F.round(F.greatest("v", F.lit(0.05)), 8).alias("v"))


@query("geo_laea", None)
def geo_laea(spark, sf):
    x, y = geo.to_laea(F.col("f_lon"), F.col("f_lat"))
    return d.facilities(spark, sf).select("facility_id", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@query("geo_utm", None)
def geo_utm(spark, sf):
    x, y = geo.to_utm(F.col("f_lon"), F.col("f_lat"), 34)
    return d.facilities(spark, sf).select("facility_id", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))
