"""Alpha matrices, fuel splits, cubes and sums of products."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import alpha, lines, signals
from . import domain as d
from .registry import query

_E = d.with_(d.REPORTED, d.GROUPS) + """, e AS (SELECT country, pollutant, "group" AS g, sum(total) AS E FROM reported JOIN groups USING (sector) WHERE year = 1997 AND NOT (country LIKE '%1' AND pollutant = 'BUILDING') GROUP BY 1, 2, 3),
dn AS (SELECT k.country, k.pollutant, gg.g, coalesce(e.E, 0) AS E FROM (SELECT DISTINCT country, pollutant FROM e) k CROSS JOIN (SELECT DISTINCT "group" AS g FROM groups) gg LEFT JOIN e ON e.country = k.country AND e.pollutant = k.pollutant AND e.g = gg.g),
nat AS (SELECT *, CASE WHEN sum(E) OVER w > 0 THEN E / sum(E) OVER w END AS a FROM dn WINDOW w AS (PARTITION BY country, pollutant)),
mean AS (SELECT pollutant, g, avg(a) AS m FROM nat WHERE a IS NOT NULL GROUP BY 1, 2), pool AS (SELECT pollutant, g, m / sum(m) OVER (PARTITION BY pollutant) AS a FROM mean)"""


def _emissions(spark, sf):
    r = d.reported(spark, sf).where("year = 1997").where(~(F.col("country").like("%1") & (F.col("pollutant") == "BUILDING")))
    return alpha.group_emissions(r, d.groups(spark))


def _dense(spark, sf):
    return alpha.dense(_emissions(spark, sf), d.groups(spark))


@query("jn07_sector_groups", d.with_(d.REPORTED, d.GROUPS) + 'SELECT "group" AS g, count(*) AS n FROM reported JOIN groups USING (sector) GROUP BY 1')
def jn07(spark, sf):
    from ..functions.text import sector_token

    g = d.groups(spark).withColumn("tok", sector_token(F.col("sector"))).select("tok", "group")
    r = d.reported(spark, sf).withColumn("tok", sector_token(F.lower("sector")))
    return r.join(g, "tok").groupBy(F.col("group").alias("g")).agg(F.count("*").alias("n"))


@query("ag08_emission_vector", _E + " SELECT pollutant, round(sum(CASE g WHEN 'g1' THEN E END), 2) AS g1, round(sum(CASE g WHEN 'g2' THEN E END), 2) AS g2, round(sum(CASE g WHEN 'g3' THEN E END), 2) AS g3 FROM dn WHERE country = (SELECT min(country) FROM dn) GROUP BY 1")
def ag08(spark, sf):
    e = _dense(spark, sf)
    first = e.agg(F.min("country").alias("country"))
    v = e.join(F.broadcast(first), "country", "left_semi").groupBy("pollutant").pivot("group", ["g1", "g2", "g3"]).agg(F.sum("E"))
    return v.select("pollutant", *[F.round(c, 2).alias(c) for c in ("g1", "g2", "g3")])


@query("ag09_group_emissions", _E + " SELECT country, pollutant, g, round(E, 2) AS E FROM e")
def ag09(spark, sf):
    return _emissions(spark, sf).select("country", "pollutant", F.col("group").alias("g"), F.round("E", 2).alias("E"))


@query("ag10_pool_mean", _E + " SELECT pollutant, g, round(a, 8) AS alpha FROM pool")
def ag10(spark, sf):
    return alpha.pool(_dense(spark, sf)).select("pollutant", F.col("group").alias("g"), F.round("alpha", 8).alias("alpha"))


_METHODS = [("AUTOMOBILE", 0), ("BUILDING", 0), ("FURNITURE", 1), ("HOUSEHOLD", 2), ("MACHINERY", 3)]


@query("dc11_alpha_matrix", _E + """, m(pollutant, method) AS (VALUES ('AUTOMOBILE', 0), ('BUILDING', 0), ('FURNITURE', 1), ('HOUSEHOLD', 2), ('MACHINERY', 3)),
fx(g, w) AS (VALUES ('g1', 0.25e0), ('g2', 0.75e0), ('g3', 0e0))
SELECT nat.pollutant, nat.g, CAST(m.method AS INT) AS method, round(coalesce(CASE m.method WHEN 0 THEN coalesce(nat.a, pool.a) WHEN 1 THEN pool.a WHEN 2 THEN fx.w WHEN 3 THEN 1e0 / 3 END, 1e0 / 3), 8) AS alpha
FROM nat JOIN m USING (pollutant) LEFT JOIN pool ON pool.pollutant = nat.pollutant AND pool.g = nat.g LEFT JOIN fx ON fx.g = nat.g WHERE country = 'NATION_1'""")
def dc11(spark, sf):
    m = spark.createDataFrame(_METHODS, "pollutant string, method int")
    given = spark.createDataFrame([("HOUSEHOLD", g, w) for g, w in (("g1", 1.0), ("g2", 3.0), ("g3", 0.0))], "pollutant string, group string, weight double")
    a = alpha.alpha_matrix(_dense(spark, sf), m, "NATION_1", given)
    return a.select("pollutant", F.col("group").alias("g"), "method", F.round("alpha", 8).alias("alpha"))


@query("ag14_fleet_share", """
SELECT c_mktsegment AS road, round(sum(abs(c_acctbal)) / sum(abs(c_acctbal) + c_nationkey), 8) AS a, round(sum(c_nationkey) / sum(abs(c_acctbal) + c_nationkey), 8) AS b FROM customer GROUP BY 1""")
def ag14(spark, sf):
    c = d.t(spark, sf, "customer").select(F.col("c_mktsegment").alias("road"), F.abs("c_acctbal").alias("a"), F.col("c_nationkey").cast("double").alias("b"), F.lit(0.0).alias("all"))
    return lines.fleet_share(c, ["road"], ["a", "b"], "all").select("road", F.round("a", 8).alias("a"), F.round("b", 8).alias("b"))


@query("ag13_weighted_flow", "SELECT c_nationkey AS pixel, round(sum(c_acctbal * c_custkey) / sum(c_custkey), 5) AS flow FROM customer WHERE c_custkey % 5 > 0 GROUP BY 1")
def ag13(spark, sf):
    c = d.t(spark, sf, "customer").select(F.col("c_nationkey").alias("pixel"), F.col("c_acctbal").alias("flow"), F.when(F.col("c_custkey") % 5 > 0, F.col("c_custkey")).otherwise(0).alias("len"))
    return lines.weighted_flow(c, ["pixel"], "flow", "len").select("pixel", F.round("flow", 5).alias("flow"))


@query("ag15_regional_mean", """
WITH c AS (SELECT c_nationkey AS r, n_regionkey AS p, c_acctbal AS v FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 3 = 0), a AS (SELECT r, p, avg(v) AS m, count(*) AS n FROM c GROUP BY 1, 2), b AS (SELECT p, avg(v) AS m, count(*) AS n FROM c GROUP BY 1)
SELECT a.r, round(CASE WHEN a.n >= 20 THEN a.m WHEN b.n >= 100 THEN b.m ELSE (SELECT avg(v) FROM c) END, 5) AS mean, CAST(CASE WHEN a.n >= 20 THEN 0 WHEN b.n >= 100 THEN 1 ELSE 2 END AS INT) AS level FROM a JOIN b USING (p)""")
def ag15(spark, sf):
    c = d.t(spark, sf, "customer").where("c_custkey % 3 = 0").join(d.t(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    m = alpha.regional_mean(c, "c_nationkey", "n_regionkey", "c_acctbal", 20, 100)
    return m.select(F.col("c_nationkey").alias("r"), F.round("mean", 5).alias("mean"), "level")


_STOCK = "stock AS (SELECT s_nationkey AS region, CASE s_suppkey % 5 WHEN 0 THEN 'bovine' WHEN 1 THEN 'pigs' WHEN 2 THEN 'poultry' WHEN 3 THEN 'sheep' ELSE 'goats' END AS species, s_acctbal AS heads, 100e0 + s_suppkey AS lw, 0.5e0 AS n_rate, (s_suppkey % 10) / 10e0 AS housed FROM supplier)"


def _stock(spark, sf):
    k = F.col("s_suppkey")
    species = F.element_at(F.array(*map(F.lit, ("bovine", "pigs", "poultry", "sheep", "goats"))), (k % 5 + 1).cast("int"))
    return d.t(spark, sf, "supplier").select(F.col("s_nationkey").alias("region"), species.alias("species"), F.col("s_acctbal").alias("heads"), (k + 100.0).alias("live_weight"), F.lit(0.5).alias("n_rate"), ((k % 10) / 10.0).alias("housed"))


@query("ag16_housing_factor", d.with_(_STOCK) + "SELECT region, round(coalesce(sum(CASE WHEN heads > 0 THEN heads * lw * n_rate * housed ELSE 0 END) / nullif(sum(CASE WHEN heads > 0 THEN heads * lw * n_rate ELSE 0 END), 0), 0.6e0), 8) AS factor FROM stock GROUP BY 1")
def ag16(spark, sf):
    return signals.housing_factor(_stock(spark, sf), "region").select("region", F.round("factor", 8).alias("factor"))


@query("ag17_manure_pools", d.with_(_STOCK) + """, s AS (SELECT *, CASE WHEN region = 1 THEN 0.75e0 WHEN region < 5 THEN 0.5e0 ELSE 0.25e0 END AS g FROM stock)
SELECT region, round(sum(CASE WHEN species IN ('bovine', 'sheep', 'goats') THEN heads WHEN species = 'pigs' THEN g * heads ELSE 0 END), 4) AS fodder, round(sum(CASE WHEN species = 'pigs' THEN (1 - g) * heads WHEN species = 'poultry' THEN heads ELSE 0 END), 4) AS other FROM s GROUP BY 1""")
def ag17(spark, sf):
    country = F.when(F.col("region") == 1, "NLD").when(F.col("region") < 5, "DEU").otherwise("GRC")
    p = signals.manure_pools(_stock(spark, sf).withColumn("country", country).withColumn("nitrogen", F.col("heads")), "region", "country")
    return p.select("region", F.round("fodder", 4).alias("fodder"), F.round("other", 4).alias("other"))


@query("ag18_class_bucket_shares", """
WITH g AS (SELECT p_brand AS bucket, p_type AS class, sum(p_retailprice) AS w FROM part GROUP BY 1, 2) SELECT bucket, class, round(w / sum(w) OVER (PARTITION BY bucket), 8) AS f FROM g""")
def ag18(spark, sf):
    g = d.t(spark, sf, "part").groupBy(F.col("p_brand").alias("bucket"), F.col("p_type").alias("class")).agg(F.sum("p_retailprice").alias("w"))
    return alpha.share_of(g, ["bucket"], "w", "f").select("bucket", "class", F.round("f", 8).alias("f"))


_COUNTS = """counts AS (SELECT n_regionkey % 3 AS cl, n_name AS country, CASE s_suppkey % 4 WHEN 0 THEN 'diesel' WHEN 1 THEN 'gasoline' WHEN 2 THEN 'TOTAL' ELSE 'electric' END AS fuel, s_acctbal AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey),
good AS (SELECT * FROM counts WHERE n >= 0 AND fuel <> 'TOTAL')"""


def _counts(spark, sf):
    s = d.t(spark, sf, "supplier").join(d.t(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    fuel = F.element_at(F.array(*map(F.lit, ("diesel", "gasoline", "TOTAL", "electric"))), (F.col("s_suppkey") % 4 + 1).cast("int"))
    return s.select((F.col("n_regionkey") % 3).alias("class"), F.col("n_name").alias("country"), fuel.alias("fuel"), F.col("s_acctbal").alias("n"))


@query("ag19_fuel_counts", d.with_(_COUNTS) + "SELECT cl, fuel, round(sum(n), 3) AS n FROM good GROUP BY 1, 2")
def ag19(spark, sf):
    g = _counts(spark, sf).where((F.col("n") >= 0) & (F.col("fuel") != "TOTAL"))
    return g.groupBy(F.col("class").alias("cl"), "fuel").agg(F.round(F.sum("n"), 3).alias("n"))


@query("ag20_union_total", d.with_(_COUNTS) + "SELECT fuel, round(sum(n), 3) AS n FROM good GROUP BY 1")
def ag20(spark, sf):
    return _counts(spark, sf).where((F.col("n") >= 0) & (F.col("fuel") != "TOTAL")).groupBy("fuel").agg(F.round(F.sum("n"), 3).alias("n"))


@query("dc13_fuel_split", d.with_(_COUNTS) + """, k AS (SELECT * FROM (VALUES (0), (1), (2), (9)) v(cl) CROSS JOIN (SELECT DISTINCT fuel FROM good) f),
o AS (SELECT cl, fuel, sum(n) / sum(sum(n)) OVER (PARTITION BY cl) AS s FROM good WHERE country = 'NATION_1' GROUP BY 1, 2), a AS (SELECT cl, fuel, sum(n) / sum(sum(n)) OVER (PARTITION BY cl) AS s FROM good GROUP BY 1, 2)
SELECT CAST(k.cl AS INT) AS cl, k.fuel, round(CASE WHEN k.cl IN (SELECT cl FROM o) THEN coalesce(o.s, 0) WHEN k.cl IN (SELECT cl FROM a) THEN coalesce(a.s, 0) WHEN k.fuel = 'gasoline' THEN 1 ELSE 0 END, 8) AS share
FROM k LEFT JOIN o ON o.cl = k.cl AND o.fuel = k.fuel LEFT JOIN a ON a.cl = k.cl AND a.fuel = k.fuel""")
def dc13(spark, sf):
    classes = spark.createDataFrame([(0,), (1,), (2,), (9,)], "class int")
    return alpha.split_with_cascade(_counts(spark, sf), classes, "NATION_1", "gasoline").select(F.col("class").alias("cl"), "fuel", F.round("share", 8).alias("share"))


@query("ag21_m_matrix", """
WITH r AS (SELECT p_brand AS p, p_type AS k, p_size / 50e0 AS f FROM part), ef AS (SELECT DISTINCT p_type AS k, length(p_type) * 1e0 AS ef FROM part) SELECT p, k, round(sum(f * ef), 5) AS m FROM r JOIN ef USING (k) GROUP BY 1, 2""")
def ag21(spark, sf):
    p = d.t(spark, sf, "part")
    r = p.select(F.col("p_brand").alias("p"), F.col("p_type").alias("k"), (F.col("p_size") / 50.0).alias("f"))
    ef = p.select(F.col("p_type").alias("k"), F.length("p_type").cast("double").alias("ef")).distinct()
    return alpha.product_sum(r, ef, ["k"], ["p", "k"], "f", "ef", "m").select("p", "k", F.round("m", 5).alias("m"))


@query("ag22_u_matrix", """
WITH x AS (SELECT c_nationkey AS px, c_mktsegment AS k, sum(abs(c_acctbal)) AS x FROM customer GROUP BY 1, 2), m AS (SELECT DISTINCT c_mktsegment AS k, length(c_mktsegment) * 1e0 AS m FROM customer) SELECT px, round(sum(x * m), 3) AS u FROM x JOIN m USING (k) GROUP BY 1""")
def ag22(spark, sf):
    c = d.t(spark, sf, "customer")
    x = c.groupBy(F.col("c_nationkey").alias("px"), F.col("c_mktsegment").alias("k")).agg(F.sum(F.abs("c_acctbal")).alias("x"))
    m = c.select(F.col("c_mktsegment").alias("k"), F.length("c_mktsegment").cast("double").alias("m")).distinct()
    return alpha.product_sum(x, m, ["k"], ["px"], "x", "m", "u").select("px", F.round("u", 3).alias("u"))


@query("ag23_road_tensor", d.with_(_COUNTS) + ", pi AS (SELECT n_nationkey AS r, n_regionkey % 3 AS cl, 0.1e0 * (n_nationkey + 1) AS pi FROM nation), f AS (SELECT cl, fuel, sum(n) AS f FROM good GROUP BY 1, 2) SELECT r, fuel, round(sum(pi * f), 4) AS x FROM pi JOIN f USING (cl) GROUP BY 1, 2")
def ag23(spark, sf):
    pi = d.t(spark, sf, "nation").select(F.col("n_nationkey").alias("r"), (F.col("n_regionkey") % 3).alias("class"), ((F.col("n_nationkey") + 1) * 0.1).alias("pi"))
    f = _counts(spark, sf).where((F.col("n") >= 0) & (F.col("fuel") != "TOTAL")).groupBy("class", "fuel").agg(F.sum("n").alias("f"))
    return alpha.product_sum(pi, f, ["class"], ["r", "fuel"], "pi", "f", "x").select("r", "fuel", F.round("x", 4).alias("x"))


@query("jn19_class_product", "SELECT n_regionkey AS cl, count(*) AS n, round(sum(0.1e0 * n_nationkey * r_regionkey), 6) AS s FROM nation JOIN region ON r_regionkey = n_regionkey GROUP BY 1")
def jn19(spark, sf):
    a = d.t(spark, sf, "nation").select(F.col("n_regionkey").alias("cl"), (F.col("n_nationkey") * 0.1).alias("x"), F.lit(1).alias("one"))
    b = d.t(spark, sf, "region").select(F.col("r_regionkey").alias("cl"), F.col("r_regionkey").alias("y"))
    return a.join(b, "cl").groupBy("cl").agg(F.count("*").alias("n"), F.round(F.sum(F.col("x") * F.col("y")), 6).alias("s"))


@query("jn18_factor_lookup", """
WITH r AS (SELECT p_partkey AS row_id, p_type AS cl, p_brand AS fu, p_name AS txt FROM part WHERE p_partkey <= 300), f AS (SELECT p_partkey AS ord, p_type AS cl, p_brand AS fu, p_name AS ft, p_retailprice AS ef FROM part WHERE p_partkey > 300),
j AS (SELECT row_id, ef, ord, len(list_intersect(string_split(lower(txt), ' '), string_split(lower(ft), ' '))) AS k FROM r JOIN f USING (cl, fu)), b AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY k DESC, ord) AS rn FROM j)
SELECT row_id, round(ef, 2) AS ef, ord, CAST(k AS INT) AS overlap FROM b WHERE rn = 1""")
def jn18(spark, sf):
    p = d.t(spark, sf, "part")
    r = p.where("p_partkey <= 300").select(F.col("p_partkey").alias("row_id"), F.col("p_type").alias("class"), F.col("p_brand").alias("fuel"), F.col("p_name").alias("txt"))
    f = p.where("p_partkey > 300").select(F.array("p_type").alias("classes"), F.array("p_brand").alias("fuels"), F.col("p_name").alias("ft"), F.col("p_partkey").alias("ord"), F.col("p_retailprice").alias("ef"))
    return alpha.best_factor(r, f, "txt", "ft", "ord").select("row_id", F.round("ef", 2).alias("ef"), "ord", "overlap")


@query("dc12_end_use_fractions", """
WITH b AS (SELECT p_brand AS bucket, p_type AS metric, sum(p_retailprice) AS v FROM part WHERE p_size < 40 GROUP BY 1, 2) SELECT bucket, round(coalesce(sum(CASE WHEN metric LIKE 'P%' THEN v END) / nullif(sum(v), 0), 0.5e0), 8) AS fraction FROM b GROUP BY 1""")
def dc12(spark, sf):
    b = d.t(spark, sf, "part").where("p_size < 40").groupBy(F.col("p_brand").alias("bucket"), F.col("p_type").alias("metric")).agg(F.sum("p_retailprice").alias("v"))
    part = F.sum(F.when(F.col("metric").like("P%"), F.col("v"))) / F.nullif(F.sum("v"), F.lit(0.0))
    return b.groupBy("bucket").agg(part.alias("f")).select("bucket", F.round(F.coalesce("f", F.lit(0.5)), 8).alias("fraction"))


@query("h12_road_bundle", "SELECT c_mktsegment AS road, count(*) AS n, round(sum(c_acctbal * c_custkey) / sum(c_custkey), 5) AS flow FROM customer GROUP BY 1")
def h12(spark, sf):
    c = d.t(spark, sf, "customer").select(F.col("c_mktsegment").alias("road"), F.col("c_acctbal").alias("flow"), F.col("c_custkey").alias("len"))
    n = c.groupBy("road").agg(F.count("*").alias("n"))
    return lines.weighted_flow(c, ["road"], "flow", "len").join(n, "road").select("road", "n", F.round("flow", 5).alias("flow"))
