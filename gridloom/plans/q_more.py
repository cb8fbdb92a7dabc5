"""Helpers with their own semantics: shared labels, layers, components, merged bands."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo, text
from ..operators import allocate, normalize
from . import domain as d
from .registry import query

#: Inventory and facility labels of one pollutant meet under one key.
_LABELS = {"SO2": "sox", "SOX": "sox", "NO2": "nox", "NOX": "nox"}


@query("jn22_shared_label", """
WITH a AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN 'sox' ELSE 'nox' END AS label, sum(abs(c_acctbal)) AS mass FROM customer GROUP BY 1),
b AS (SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'nox' ELSE 'sox' END AS label, sum(abs(s_acctbal)) AS reported FROM supplier GROUP BY 1)
SELECT label, round(mass, 2) AS mass, round(reported, 2) AS reported FROM a JOIN b USING (label)""")
def jn22(spark, sf):
    a = d.t(spark, sf, "customer").select(text.lookup(F.when(F.col("c_custkey") % 2 == 0, "SO2").otherwise("NO2"), _LABELS).alias("label"), F.abs("c_acctbal").alias("v"))
    b = d.t(spark, sf, "supplier").select(text.lookup(F.when(F.col("s_suppkey") % 3 == 0, "NOX").otherwise("SOX"), _LABELS).alias("label"), F.abs("s_acctbal").alias("v"))
    mass, reported = a.groupBy("label").agg(F.sum("v").alias("mass")), b.groupBy("label").agg(F.sum("v").alias("reported"))
    return mass.join(reported, "label").select("label", F.round("mass", 2).alias("mass"), F.round("reported", 2).alias("reported"))


@query("h06_coordinates", d.with_(d.POINTS) + """, s AS (SELECT source_id, lon + 0.01e0 AS f_lon FROM points WHERE source_id % 3 = 0), m AS (SELECT source_id, lon + 0.02e0 AS f_lon FROM points WHERE source_id % 2 = 0)
SELECT p.source_id, round(nox, 4) AS nox, round(coalesce(s.f_lon, m.f_lon), 6) AS f_lon FROM points p LEFT JOIN s USING (source_id) LEFT JOIN m USING (source_id)""")
def h06(spark, sf):
    p = d.points(spark, sf)
    sidecar = p.select("source_id", F.when(F.col("source_id") % 3 == 0, F.col("lon") + 0.01).alias("f_lon"))
    matched = p.where(F.col("source_id") % 2 == 0).select("source_id", (F.col("lon") + 0.02).alias("f_lon"))
    placed = allocate.coalesce_matches(sidecar, matched, "source_id", ["f_lon"])
    return p.select("source_id", "nox").join(placed, "source_id").select("source_id", F.round("nox", 4).alias("nox"), F.round("f_lon", 6).alias("f_lon"))


@query("h14_component_layers", d.with_(d.PIXELS) + """
SELECT "row", col, round(signal / (max(signal) OVER () + 1e-12), 8) AS housing, round(other / (max(other) OVER () + 1e-12), 8) AS pasture, 0e0 AS cover FROM pixels""")
def h14(spark, sf):
    p = d.pixels(spark, sf).withColumn("none", F.lit(0.0))
    for value, out in (("signal", "housing"), ("other", "pasture"), ("none", "cover")):
        p = normalize.max_scaled(p, value, out)
    return p.select("row", "col", *(F.round(c, 8).alias(c) for c in ("housing", "pasture", "cover")))


@query("h31_facility_in_domain", d.with_(d.FACILITIES) + "SELECT facility_id, f_lon BETWEEN -6 AND 12 AND f_lat BETWEEN 36 AND 39 AS inside FROM facilities")
def h31(spark, sf):
    inside = geo.in_box(F.col("f_lon"), F.col("f_lat"), (-6.0, 36.0, 12.0, 39.0))
    return d.facilities(spark, sf).select("facility_id", inside.alias("inside"))


@query("h32_merged_bands", d.with_(d.SOURCES) + """
SELECT cell_id, band, round(sum(v), 3) AS v FROM (SELECT cell_id, 'nox' AS band, nox AS v FROM sources WHERE source_type = 1
  UNION ALL SELECT cell_id, 'co', co FROM sources WHERE source_type = 1 UNION ALL SELECT cell_id, 'nox', nox FROM sources WHERE source_type = 2) GROUP BY 1, 2""")
def h32(spark, sf):
    s = d.sources(spark, sf)
    layers = [s.where(F.col("source_type") == kind).select("cell_id", F.lit(band).alias("band"), F.col(band).alias("v")) for kind, band in ((1, "nox"), (1, "co"), (2, "nox"))]
    merged = layers[0].unionByName(layers[1]).unionByName(layers[2])
    return merged.groupBy("cell_id", "band").agg(F.round(F.sum("v"), 3).alias("v"))
