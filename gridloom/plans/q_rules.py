"""Compiled rules over tags and texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rules
from . import domain as d
from .registry import query

_TAGS = "WITH t AS (SELECT p_partkey AS id, p_type AS type, p_brand AS brand, CAST(p_size AS VARCHAR) AS size, p_name AS name, CASE p_partkey % 2 WHEN 0 THEN 'node' ELSE 'area_way' END AS kind FROM part)\n"
_RULE = {
    "all_of": [
        {"tag": {"key": "size", "in": ["1", "2", "3", "4", "5", "6", "7", "8"]}},
        {"any_of": [{"tag": {"key": "brand", "equals": "Brand#11"}}, {"name_regex": "^[a-m]"}]},
        {"not": {"tag": {"key": "military", "exists": True}}},
    ]
}
_WHERE = "size IN ('1','2','3','4','5','6','7','8') AND (brand = 'Brand#11' OR regexp_matches(lower(name), '^[a-m]'))"


@query("pf08_tag_rule", _TAGS + f"SELECT id FROM t WHERE {_WHERE}")
def pf08(spark, sf):
    return d.tags(spark, sf).where(rules.tag_rule(_RULE, F.col("tags"))).select("id")


@query("pf09_kind_guard", _TAGS + "SELECT count(*) AS n FROM t WHERE kind IN ('area_way', 'area_rel')")
def pf09(spark, sf):
    return d.tags(spark, sf).where(F.col("elem_kind").isin("area_way", "area_rel")).agg(F.count("*").alias("n"))


@query("pf10_rule_index", _TAGS + f"SELECT (SELECT count(*) FROM t WHERE {_WHERE}) AS with_keys, CAST(0 AS BIGINT) AS without_keys")
def pf10(spark, sf):
    t = d.tags(spark, sf)
    return t.agg(F.count_if(rules.indexed_rule(_RULE, F.col("tags"))).alias("with_keys"), F.count_if(rules.indexed_rule(None, F.col("tags"))).alias("without_keys"))


@query("pf11_survey_rule", "SELECT c_custkey AS id FROM customer WHERE (upper(trim(c_mktsegment)) = 'BUILDING' AND c_nationkey IN (1, 2, 3)) OR c_nationkey = 7")
def pf11(spark, sf):
    c = d.t(spark, sf, "customer")
    rule = {"match_any": [{"lc": " building ", "n": [1, 2, 3]}, {"n": 7}]}
    return c.where(rules.survey_rule(rule, {"lc": F.col("c_mktsegment"), "n": F.col("c_nationkey")})).select(F.col("c_custkey").alias("id"))


@query("pf12_text_rule", "SELECT p_partkey AS id FROM part WHERE (lower(p_name) LIKE '%a%' OR lower(p_name) LIKE '%x%') AND lower(p_type) LIKE '%e%' AND NOT lower(p_type) LIKE '%q%'")
def pf12(spark, sf):
    rule = {"fuel_contains_any": ["A", "x"], "appliance_contains": "E", "appliance_contains_none": ["q"]}
    return d.t(spark, sf, "part").where(rules.text_rule(rule, {"fuel": F.col("p_name"), "appliance": F.col("p_type")})).select(F.col("p_partkey").alias("id"))


@query("pf15_eligible_codes", "SELECT c_custkey AS id FROM customer WHERE substr(c_mktsegment, 1, 1) = 'B' OR c_nationkey = 10 OR (c_nationkey = 20 AND c_custkey % 3 = 0)")
def pf15(spark, sf):
    lc = F.when(F.col("c_nationkey") == 10, "E10").when(F.col("c_nationkey") == 20, "E20").otherwise(F.upper("c_mktsegment"))
    lu = F.when(F.col("c_custkey") % 3 == 0, "U111").otherwise("U120")
    code = (F.substring("c_mktsegment", 1, 1) == "B") | (lc == "E10") | ((lc == "E20") & (lu == "U111"))
    return d.t(spark, sf, "customer").where(code).select(F.col("c_custkey").alias("id"))


@query("pf18_label_projection", "SELECT n_nationkey AS id, CASE n_nationkey % 3 WHEN 0 THEN 'sox' WHEN 1 THEN 'sox' ELSE 'pm2_5' END AS key FROM nation")
def pf18(spark, sf):
    from ..functions.text import lookup

    label = F.element_at(F.array(F.lit("SO2"), F.lit("SOx"), F.lit("PM2.5")), (F.col("n_nationkey") % 3 + 1).cast("int"))
    return d.t(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), lookup(label, {"SO2": "sox", "SOx": "sox", "PM2.5": "pm2_5"}).alias("key"))


@query("pf20_rural_mask", "SELECT count(*) AS n FROM customer WHERE c_nationkey % 2 = 1 AND NOT (c_custkey % 5 = 0) AND NOT (c_custkey % 7 = 0)")
def pf20(spark, sf):
    from ..operators.signals import rural

    r = rural((F.col("c_nationkey") % 2).cast("double"), (F.col("c_custkey") % 5 == 0).cast("double"), (F.col("c_custkey") % 7 == 0).cast("double"))
    return d.t(spark, sf, "customer").where(r).agg(F.count("*").alias("n"))


@query("sc29_filtered_layer", _TAGS + "SELECT (SELECT count(*) FROM t WHERE lower(type) IN ('promo', 'economy')) AS by_column, (SELECT count(*) FROM t WHERE (lower(brand) = 'brand#11') OR (size = '7' AND length(trim(name)) > 0)) AS by_tags")
def sc29(spark, sf):
    t = d.tags(spark, sf)
    a = rules.values_or_tags(F.col("tags")["type"], ["Promo", "ECONOMY"], None, F.col("tags"))
    b = rules.values_or_tags(F.lit(None), None, [{"brand": "BRAND#11"}, {"size": "7", "name": "*"}], F.col("tags"))
    return t.agg(F.count_if(a).alias("by_column"), F.count_if(b).alias("by_tags"))


def _ordered():
    s = F.col("p_size")
    return [("large", s > 40), ("even", s % 2 == 0), ("third", s % 3 == 0)]


@query("wn14_first_match", "SELECT CASE WHEN p_size > 40 THEN 'large' WHEN p_size % 2 = 0 THEN 'even' WHEN p_size % 3 = 0 THEN 'third' ELSE 'other' END AS c, count(*) AS n FROM part GROUP BY 1")
def wn14(spark, sf):
    return d.t(spark, sf, "part").groupBy(rules.first_match(_ordered(), "other").alias("c")).agg(F.count("*").alias("n"))


@query("wn14_all_matches", "SELECT CAST((p_size > 40)::INT + (p_size % 2 = 0)::INT + (p_size % 3 = 0)::INT AS INT) AS k, count(*) AS n FROM part GROUP BY 1")
def wn14b(spark, sf):
    return d.t(spark, sf, "part").groupBy(F.size(rules.all_matches(_ordered())).alias("k")).agg(F.count("*").alias("n"))


@query("h01_augment", "SELECT p_partkey AS id, CASE WHEN p_size > 40 THEN 'big_' || p_brand WHEN p_size % 2 = 0 THEN 'even' ELSE 'part_' || p_size END AS v, nullif(array_to_string(list_sort(list_filter(['e', 'l', 't'], lambda x: (x = 'l' AND p_size > 40) OR (x = 'e' AND p_size % 2 = 0) OR (x = 't' AND p_size % 3 = 0))), ','), '') AS all_ FROM part")
def h01(spark, sf):
    t, s = d.tags(spark, sf), F.col("p_size")
    v = rules.augment(F.col("tags"), [("big_{brand}", s > 40), ("even", s % 2 == 0)], "part_{size}")
    return t.select("id", v.alias("v"), rules.joined_matches([("l", s > 40), ("e", s % 2 == 0), ("t", s % 3 == 0)]).alias("all_"))


@query("h02_class_bucket", "SELECT CASE WHEN lower(p_type) LIKE '%o%' AND lower(p_name) LIKE '%a%' THEN 'stove/home' WHEN lower(p_type) LIKE '%e%' THEN 'boiler/plant' END AS k, count(*) AS n FROM part GROUP BY 1")
def h02(spark, sf):
    cols = {"fuel": F.col("p_type"), "appliance": F.col("p_name")}
    k = rules.first_match([("stove/home", rules.text_rule({"fuel_contains": "o", "appliance_contains": "a"}, cols)), ("boiler/plant", rules.text_rule({"fuel_contains": "e"}, cols))])
    return d.t(spark, sf, "part").groupBy(k.alias("k")).agg(F.count("*").alias("n"))


_LAYERS = {
    "eleven": {"kinds": ["node", "area_way"], "match": {"tag": {"key": "brand", "equals": "Brand#11"}}},
    "small": {"kinds": ["node"], "match": {"tag": {"key": "size", "in": [1, 2, 3]}}},
    "off": {"kinds": ["node"], "match": {"tag": {"key": "size", "exists": True}}, "when": False},
}


@query("dc22_rule_engine", _TAGS + "SELECT 'eleven' AS layer, id FROM t WHERE brand = 'Brand#11' UNION ALL SELECT 'small', id FROM t WHERE kind = 'node' AND size IN ('1', '2', '3')")
def dc22(spark, sf):
    return rules.classify(d.tags(spark, sf), _LAYERS, "tags", ["id"]).select("layer", "id")


@query("pf14_active_rules", _TAGS + "SELECT 'brand' AS rule, count(*) AS n FROM t WHERE brand = 'Brand#11' HAVING count(*) > 0 UNION ALL SELECT 'size', count(*) FROM t WHERE size IN ('1', '2') HAVING count(*) > 0")
def pf14(spark, sf):
    brand, size = ({"tag": {"key": k, "in": v}} for k, v in (("brand", ["Brand#11"]), ("size", ["1", "2"])))
    kept = rules.activated([{"id": "brand", "match": brand}, {"id": "off", "when": "x", "match": size}, {"id": "size", "when": "y", "match": size}], {"y": True})
    hits = rules.all_matches([(r["id"], rules.tag_rule(r["match"], F.col("tags"))) for r in kept])
    return d.tags(spark, sf).select(F.explode(hits).alias("rule")).groupBy("rule").agg(F.count("*").alias("n"))


@query("sk06_layer_package", _TAGS + "SELECT layer, count(*) AS n FROM (SELECT 'eleven' AS layer FROM t WHERE brand = 'Brand#11' UNION ALL SELECT 'small' FROM t WHERE kind = 'node' AND size IN ('1', '2', '3')) GROUP BY 1")
def sk06(spark, sf):
    return rules.classify(d.tags(spark, sf), _LAYERS, "tags", ["id"]).groupBy("layer").agg(F.count("*").alias("n"))


@query("h10_policy_text", "SELECT s_suppkey AS id, CASE WHEN s_suppkey % 3 = 0 THEN 'at facility' WHEN s_suppkey % 3 = 1 AND s_nationkey > 10 THEN 'at source' ELSE 'in area' END AS policy FROM supplier")
def h10(spark, sf):
    k = F.col("s_suppkey") % 3
    p = rules.first_match([("at facility", k == 0), ("at source", (k == 1) & (F.col("s_nationkey") > 10))], "in area")
    return d.t(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), p.alias("policy"))


@query("h20_nullable_text", "SELECT c_custkey AS id, nullif(upper(trim(CASE WHEN c_custkey % 4 = 0 THEN '  ' ELSE lower(c_mktsegment) END)), '') AS code FROM customer")
def h20(spark, sf):
    from ..functions.text import code_or_null

    c = F.when(F.col("c_custkey") % 4 == 0, "  ").otherwise(F.lower("c_mktsegment"))
    return d.t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), code_or_null(c).alias("code"))


@query("h28_header_lookup", "SELECT count(*) AS n FROM nation WHERE lower(trim(n_name)) = 'nation_1'")
def h28(spark, sf):
    return d.t(spark, sf, "nation").where(F.lower(F.trim("n_name")) == "nation_1").agg(F.count("*").alias("n"))
