"""Sector composites from layers on pixels to weights of all pollutants."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import alpha, composites, normalize
from ..operators.signals import housing_factor
from . import domain as d
from . import q_alpha
from .registry import query


def _layers(spark, sf):
    li = d.t(spark, sf, "lineitem")
    cell = F.when(F.col("l_suppkey") % 20 == 19, -1).otherwise((F.col("l_suppkey") % 20) * 25 + F.col("l_partkey") % 25).cast("long")
    some = lambda cond, x: F.sum(F.when(cond, x).otherwise(0.0))
    layers = li.groupBy(F.col("l_partkey").cast("int").alias("row"), F.col("l_suppkey").cast("int").alias("col"), cell.alias("cell_id")).agg(
        F.sum("l_quantity").alias("pop"), (some(F.col("l_linenumber") <= 3, 1.0) / F.count("*")).alias("cover"),
        (some(F.col("l_returnflag") == "R", F.col("l_extendedprice")) / 5e4).alias("osm"), (F.sum("l_discount") * 5).alias("sealed"),
        (F.sum("l_tax") * 4).alias("density"), (some(F.col("l_tax") < 0.04, 1.0) / F.count("*")).alias("rural"),
    )
    return composites.scored(layers.withColumn("plants", F.when(F.col("row") % 7 == 0, 1.0).otherwise(0.0)))


_LAYERS = """ly AS (SELECT CAST(l_partkey AS INT) AS "row", CAST(l_suppkey AS INT) AS col, CASE WHEN l_suppkey % 20 = 19 THEN -1 ELSE (l_suppkey % 20) * 25 + l_partkey % 25 END AS cell_id,
  sum(l_quantity) AS pop, sum(CASE WHEN l_linenumber <= 3 THEN 1e0 ELSE 0 END) / count(*) AS cover, sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END) / 5e4 AS osm,
  sum(l_discount) * 5 AS sealed, sum(l_tax) * 4 AS density, sum(CASE WHEN l_tax < 0.04e0 THEN 1e0 ELSE 0 END) / count(*) AS rural, CASE WHEN l_partkey % 7 = 0 THEN 1e0 ELSE 0e0 END AS plants
  FROM lineitem GROUP BY l_partkey, l_suppkey),
zz AS (SELECT *, CASE WHEN pop <= 0 THEN 0e0 WHEN max(CASE WHEN pop > 0 THEN pop END) OVER c > min(CASE WHEN pop > 0 THEN pop END) OVER c
  THEN (pop - min(CASE WHEN pop > 0 THEN pop END) OVER c) / (max(CASE WHEN pop > 0 THEN pop END) OVER c - min(CASE WHEN pop > 0 THEN pop END) OVER c) ELSE 1e0 END AS zpop FROM ly WINDOW c AS (PARTITION BY cell_id)),
sc AS (SELECT *, max(zpop) OVER () AS top, least(1e0, greatest(0e0, cover)) AS cv, least(1e0, greatest(0e0, osm)) AS om, least(1e0, greatest(0e0, sealed)) AS sl,
  least(1e0, greatest(0e0, density)) AS de, least(1e0, greatest(0e0, rural)) AS ru, least(1e0, greatest(0e0, zpop)) AS zp FROM zz)"""
_ALPHA = """, mth(pollutant, method) AS (VALUES ('AUTOMOBILE', 0), ('BUILDING', 0), ('FURNITURE', 1), ('HOUSEHOLD', 2), ('MACHINERY', 3)), fx(g, w) AS (VALUES ('g1', 0.25e0), ('g2', 0.75e0), ('g3', 0e0)),
al AS (SELECT nat.pollutant, nat.g, coalesce(CASE mth.method WHEN 0 THEN coalesce(nat.a, pool.a) WHEN 1 THEN pool.a WHEN 2 THEN fx.w WHEN 3 THEN 1e0 / 3 END, 1e0 / 3) AS a
  FROM nat JOIN mth USING (pollutant) LEFT JOIN pool ON pool.pollutant = nat.pollutant AND pool.g = nat.g LEFT JOIN fx ON fx.g = nat.g WHERE country = 'NATION_1'),
aw AS (SELECT pollutant, coalesce(max(CASE g WHEN 'g1' THEN a END), 0) AS a1, coalesce(max(CASE g WHEN 'g2' THEN a END), 0) AS a2, coalesce(max(CASE g WHEN 'g3' THEN a END), 0) AS a3 FROM al GROUP BY 1), """
_BLOCKS = """SELECT pollutant, CAST(floor("row" / 100e0) AS INT) AS r, CAST(floor(col / 10e0) AS INT) AS c, count(*) AS n, round(sum(weight), 6) AS weight FROM fin GROUP BY 1, 2, 3"""
_FINAL = """fin AS (SELECT pollutant, "row", col, CASE WHEN cell_id < 0 THEN 0e0 WHEN sum(s) OVER c > 0 THEN s / sum(s) OVER c ELSE 1e0 / count(*) OVER c END AS weight FROM mx WINDOW c AS (PARTITION BY pollutant, cell_id))
"""


def _blocks(weights):
    r, c = F.floor(F.col("row") / 100.0).cast("int").alias("r"), F.floor(F.col("col") / 10.0).cast("int").alias("c")
    return weights.groupBy("pollutant", r, c).agg(F.count("*").alias("n"), F.round(F.sum("weight"), 6).alias("weight"))


def _alpha(spark, sf):
    methods = spark.createDataFrame(q_alpha._METHODS, "pollutant string, method int")
    given = spark.createDataFrame([("HOUSEHOLD", g, w) for g, w in (("g1", 1.0), ("g2", 3.0), ("g3", 0.0))], "pollutant string, group string, weight double")
    return alpha.alpha_matrix(q_alpha._dense(spark, sf), methods, "NATION_1", given).select("pollutant", "group", "alpha")


def _composite(name, make, *sql, extra="", source="sc", prepare=None):
    """Register the blocks of a sector's weights; ``sql`` gives the signals of its groups g1, g2, ..."""
    n = range(1, len(sql) + 1)
    shares = ", ".join(f"CASE WHEN sum(s{i}) OVER c > 0 THEN s{i} / sum(s{i}) OVER c ELSE 1e0 / count(*) OVER c END AS w{i}" for i in n)
    text = (
        q_alpha._E + _ALPHA + _LAYERS + extra
        + f', sg AS (SELECT "row", col, cell_id, {", ".join(f"{s} AS s{i}" for i, s in zip(n, sql))} FROM {source}),\n'
        + f'ws AS (SELECT "row", col, cell_id, {shares} FROM sg WINDOW c AS (PARTITION BY cell_id)),\n'
        + f'mx AS (SELECT pollutant, "row", col, cell_id, {" + ".join(f"a{i} * w{i}" for i in n)} AS s FROM ws CROSS JOIN aw),\n' + _FINAL + _BLOCKS
    )

    @query(name, text)
    def f(spark, sf):
        layers = _layers(spark, sf)
        if prepare:
            layers = prepare(spark, sf, layers)
        columns = {c: F.col(c) for c in layers.columns}
        return _blocks(composites.sector_weights(layers, make(columns), _alpha(spark, sf)))

    return f


_composite("dc01_power_weights", composites.power, "0.4e0 * greatest(pop, 0) + 0.6e0 * cv * greatest(pop, 0)")
_composite(
    "dc02_industry_weights", composites.industry, "0.7e0 * (0.6e0 * om + 0.4e0 * cv) + 0.3e0 * zp", "0.9e0 * (0.5e0 * om + 0.5e0 * sl) + 0.1e0 * zp", "CASE WHEN cover >= 0.5e0 THEN om ELSE 0e0 END"
)
_composite("dc03_shipping_weights", composites.shipping, "0.3e0 * de + 0.6e0 * om + 0.1e0 * cv")
_composite(
    "dc04_waste_weights", composites.waste, "0.55e0 * cv + 0.15e0 * om + 0.3e0 * zp", "0.35e0 * plants + 0.35e0 * cv + 0.05e0 * zp + 0.25e0 * sl",
    "0.4e0 * least(1, greatest(0, top - zpop)) + 0.5e0 * CASE WHEN rural >= 0.5e0 AND cover < 0.5e0 THEN 1e0 ELSE 0e0 END + 0.1e0 * sl",
)
_BETA = {"g1": {"home": 0.8, "trade": 0.2}, "g2": {"trade": 0.5, "plant": 0.5}, "g3": {"roads": 1.0}}
_composite("dc05_solvent_weights", lambda l: composites.solvents(l, _BETA), "0.8e0 * zp + 0.2e0 * (0.5e0 * om + 0.5e0 * sl)", "0.5e0 * (0.5e0 * om + 0.5e0 * sl) + 0.5e0 * (0.7e0 * cv + 0.3e0 * om)", "de")
_composite("dc06_fugitive_weights", composites.fugitive, "CASE WHEN cover > 0 THEN 0.6e0 * om + 0.4e0 * cv ELSE 0e0 END", "0.5e0 * om + 0.2e0 * sl + 0.3e0 * zp", "0.75e0 * zp + 0.25e0 * cv")
_composite("dc07_offroad_weights", composites.offroad, "0.9e0 * om + 0.1e0 * sl", "CASE WHEN rural >= 0.5e0 THEN 0.7e0 * cv + 0.3e0 * ru ELSE 0e0 END", "zp")
_composite("dc10e_pasture_weights", composites.pastures, "ru", "sl", "0.5e0 * ru + 0.5e0 * cv")


def _with_housing(spark, sf, layers):
    s = d.t(spark, sf, "supplier")
    stock = s.select(
        (F.col("s_nationkey") % 20).cast("int").alias("region"), (F.col("s_suppkey") % 9).cast("double").alias("heads"), F.abs("s_acctbal").alias("live_weight"),
        F.lit(0.5).alias("n_rate"), ((F.col("s_suppkey") % 4) / 4.0).alias("housed"),
    )
    factor = housing_factor(stock.where("region < 15"), "region")
    joined = layers.withColumn("region", (F.col("col") % 20).cast("int")).join(factor, "region", "left")
    return joined.withColumn("housed", F.coalesce("factor", F.lit(0.6)))


_composite(
    "dc10a_livestock_weights", lambda l: composites.livestock(l, l["housed"]), "housed * sl + (1 - housed) * ru", prepare=_with_housing, source="hs",
    extra=""", hf AS (SELECT s_nationkey % 20 AS region, coalesce(sum((s_suppkey % 9) * abs(s_acctbal) * 0.5e0 * (s_suppkey % 4) / 4e0) / nullif(sum((s_suppkey % 9) * abs(s_acctbal) * 0.5e0), 0), 0.6e0) AS factor
  FROM supplier WHERE s_nationkey % 20 < 15 GROUP BY 1), hs AS (SELECT sc.*, coalesce(hf.factor, 0.6e0) AS housed FROM sc LEFT JOIN hf ON hf.region = sc.col % 20)""",
)

_M = [("nox", "stove", 0.5), ("nox", "boiler", 2.0), ("nox", "office", 1.5), ("nox", "other", 0.25), ("pm", "stove", 4.0), ("pm", "fireplace", 6.0), ("pm", "heater", 1.0), ("co", "school", 1.0), ("co", "heater", 3.0)]


@query("dc08_combustion_weights", "WITH " + _LAYERS + """, x AS (SELECT "row", col, cell_id, UNNEST(['stove', 'boiler', 'fireplace', 'heater', 'office', 'school', 'other']) AS k,
  UNNEST([zpop * (1 - cover), 2e0 * zpop * cover, 0.5e0 * zpop, zpop * zpop, sealed * cover, 0.2e0 * sealed, cover]) AS x FROM sc),
m(pollutant, k, m) AS (VALUES """ + ", ".join(f"('{p}', '{k}', {m}e0)" for p, k, m in _M) + """),
mx AS (SELECT pollutant, "row", col, cell_id, sum(x * m) AS s FROM x JOIN m USING (k) GROUP BY 1, 2, 3, 4),
""" + _FINAL + _BLOCKS)
def dc08(spark, sf):
    layers = _layers(spark, sf)
    loads = composites.stock_loads({c: F.col(c) for c in layers.columns})
    m = spark.createDataFrame(_M, "pollutant string, k string, m double")
    return _blocks(normalize.loaded(layers, loads, m, ["row", "col"]))


_GROUPS = ("livestock", "manure", "grazed_pastures", "farm_buildings", "inorganic_n", "crop_nmvoc", "broad_agricultural", "biomass_burning")
_CLASSES = {0: (1.0, 80.0, 0.5), 1: (0.6, 40.0, 1.5), 2: (0.3, 0.0, 2.0), 3: (0.0, 10.0, 0.0)}
_Z = "CASE WHEN {v} IS NULL OR {v} <= 0 THEN 0e0 WHEN max(CASE WHEN {v} > 0 THEN {v} END) OVER c > min(CASE WHEN {v} > 0 THEN {v} END) OVER c THEN ({v} - min(CASE WHEN {v} > 0 THEN {v} END) OVER c) / (max(CASE WHEN {v} > 0 THEN {v} END) OVER c - min(CASE WHEN {v} > 0 THEN {v} END) OVER c) ELSE 1e0 END"
_SHARES = ", ".join(f"CASE WHEN sum(s{i}) OVER c > 0 THEN s{i} / sum(s{i}) OVER c ELSE 1e0 / count(*) OVER c END AS w{i}" for i in range(8))


@query("dc10_agriculture_weights", "WITH " + _LAYERS + """,
cl(class, w, nr, cr) AS (VALUES """ + ", ".join(f"({k}, {a}e0, {b}e0, {c}e0)" for k, (a, b, c) in _CLASSES.items()) + """),
rg AS (SELECT s_nationkey AS region, sum((s_suppkey % 9) * abs(s_acctbal) * (s_suppkey % 4) / 4e0) / nullif(sum((s_suppkey % 9) * abs(s_acctbal)), 0) AS housed, sum(abs(s_acctbal)) AS manure FROM supplier WHERE s_nationkey < 15 GROUP BY 1),
pt AS (SELECT CAST(l_partkey AS INT) AS "row", CAST(l_suppkey AS INT) AS col, avg(l_quantity) AS n, avg(l_discount * 20) AS c FROM lineitem WHERE l_linenumber = 2 GROUP BY 1, 2),
fi AS (SELECT CAST(l_partkey AS INT) AS "row", CAST(l_suppkey AS INT) AS col, max(l_extendedprice) AS p FROM lineitem WHERE l_returnflag = 'A' AND l_extendedprice > 0 GROUP BY 1, 2),
j AS (SELECT sc."row", sc.col, sc.cell_id, sc.col % 20 AS region, ru, sl, coalesce(housed, 0.6e0) AS housed, coalesce(manure, 0e0) AS target, w, w * pop AS crop, coalesce(pt.n, cl.nr) * pop AS nr, coalesce(pt.c, cl.cr) * pop AS cr, CASE WHEN w > 0 THEN p END AS fire
  FROM sc JOIN cl ON cl.class = sc."row" % 4 LEFT JOIN rg ON rg.region = sc.col % 20 LEFT JOIN pt ON pt."row" = sc."row" AND pt.col = sc.col LEFT JOIN fi ON fi."row" = sc."row" AND fi.col = sc.col),
mn AS (SELECT *, CASE WHEN sum(crop) OVER (PARTITION BY region) > 0 THEN crop * target / sum(crop) OVER (PARTITION BY region) ELSE 0e0 END AS kg FROM j),
sg AS (SELECT "row", col, cell_id, housed * sl + (1 - housed) * ru AS s0, """ + _Z.format(v="kg") + """ AS s1, ru AS s2, sl AS s3, nr / (max(nr) OVER () + 1e-12) AS s4, cr / (max(cr) OVER () + 1e-12) AS s5, w / (max(w) OVER () + 1e-12) AS s6, """ + _Z.format(v="fire") + """ AS s7 FROM mn WINDOW c AS (PARTITION BY cell_id)),
ws AS (SELECT "row", col, cell_id, """ + _SHARES + """ FROM sg WINDOW c AS (PARTITION BY cell_id)),
ap AS (SELECT c_mktsegment AS pollutant, c_nationkey % 8 AS g, sum(abs(c_acctbal)) AS v FROM customer GROUP BY 1, 2),
aw AS (SELECT pollutant, """ + ", ".join(f"coalesce(sum(CASE g WHEN {i} THEN v END) / sum(v), 0) AS a{i}" for i in range(8)) + """ FROM ap GROUP BY 1),
mx AS (SELECT pollutant, "row", col, cell_id, """ + " + ".join(f"a{i} * w{i}" for i in range(8)) + """ AS s FROM ws CROSS JOIN aw),
""" + _FINAL + _BLOCKS)
def dc10_weights(spark, sf):
    """All eight signals on the pixels, shared out in cells and mixed for each pollutant."""
    li, s, c = (d.t(spark, sf, n) for n in ("lineitem", "supplier", "customer"))
    layers = _layers(spark, sf).withColumns({"region": (F.col("col") % 20).cast("int"), "class": (F.col("row") % 4).cast("int"), "area": F.col("pop")})
    heads = (F.col("s_suppkey") % 9) * F.abs("s_acctbal")
    housed = F.sum(heads * (F.col("s_suppkey") % 4) / 4.0) / F.nullif(F.sum(heads), F.lit(0.0))
    regions = s.where("s_nationkey < 15").groupBy(F.col("s_nationkey").cast("int").alias("region")).agg(housed.alias("housed"), F.sum(F.abs("s_acctbal")).alias("manure"))
    pixel = [F.col("l_partkey").cast("int").alias("row"), F.col("l_suppkey").cast("int").alias("col")]
    points = li.where("l_linenumber = 2").select(*pixel, F.col("l_quantity").alias("n"), (F.col("l_discount") * 20).alias("c"))
    fires = li.where(F.col("l_returnflag") == "A").select(*pixel, F.col("l_extendedprice").alias("power"))
    whole = composites.agriculture_layers(layers, regions, points, _CLASSES, fires)
    by_group = c.groupBy(F.col("c_mktsegment").alias("pollutant"), F.element_at(F.array(*map(F.lit, _GROUPS)), (F.col("c_nationkey") % 8 + 1).cast("int")).alias("group")).agg(F.sum(F.abs("c_acctbal")).alias("v"))
    mix = normalize.weights(by_group, "v", ["pollutant"], "alpha").select("pollutant", "group", "alpha")
    return _blocks(composites.sector_weights(whole, composites.agriculture({k: F.col(k) for k in whole.columns}), mix))
