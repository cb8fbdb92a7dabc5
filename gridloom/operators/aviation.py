"""Airport facilities from aerodrome polygons."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import spatial

#: The families of polygons that are airports, and the family that never is.
FAMILIES, MILITARY = ("aerodrome", "landuse_aerodrome"), "military_airfield"


def facilities(polygons: DataFrame, edges: DataFrame, aprons: DataFrame | None, size: float, least_km2: float = 0.5) -> DataFrame:
    """facility_id, id, x, y, area_km2, name, icao, iata of aerodromes that can be matched.

    ``polygons``: id, family, element_type, element_id, name, tags (map).  ``edges`` (id, x1, y1, x2, y2) are in metres, directed.
    Military airfields, by family or by a tag ``military``, other families and polygons below ``least_km2`` are left out.
    The place is that of the aprons (edges, not overlapping) clipped to the polygon where it has some, else
    the polygon's own, and always inside.  Codes come from the tags, in capitals.  Of polygons of one element all but the
    first by id get ``:r`` and their id behind their name.  A missing element type is a way, a missing number the id.
    """
    tag = lambda k: F.nullif(F.trim(F.try_element_at("tags", F.lit(k))), F.lit(""))
    family = F.lower(F.trim(F.coalesce("family", F.lit(""))))
    kept = polygons.where((family != MILITARY) & tag("military").isNull() & family.isin(*FAMILIES))
    own = edges.join(kept.select("id"), "id", "left_semi")
    points = spatial.match_points(own).where(F.col("area") >= least_km2 * 1e6)
    if aprons is not None:
        inner = spatial.clip_polygons(aprons, own, size).select(F.col("polygon").alias("id"), "x1", "y1", "x2", "y2")
        at = spatial.match_points(inner).select("id", F.col("x").alias("_ax"), F.col("y").alias("_ay"))
        points = points.join(at, "id", "left").select("id", F.coalesce("_ax", "x").alias("x"), F.coalesce("_ay", "y").alias("y"), "area")
    rows = kept.join(points, "id")
    kind, number = F.coalesce(F.nullif(F.trim("element_type"), F.lit("")), F.lit("way")), F.coalesce(F.col("element_id").cast("long"), F.col("id").cast("long"))
    first = F.row_number().over(Window.partitionBy("_kind", "_number").orderBy("id")) == 1
    rows = rows.withColumns({"_kind": kind, "_number": number})
    base = F.concat(F.lit("osm:"), "_kind", F.lit(":"), F.col("_number").cast("string"))
    code = lambda k: F.coalesce(F.upper(tag(k)), F.lit(""))
    name = F.coalesce(F.nullif(F.trim("name"), F.lit("")), tag("name"), F.lit("aerodrome"))
    return rows.select(
        F.when(first, base).otherwise(F.concat(base, F.lit(":r"), F.col("id").cast("string"))).alias("facility_id"), "id", "x", "y",
        (F.col("area") / 1e6).alias("area_km2"), name.alias("name"), code("icao").alias("icao"), code("iata").alias("iata"),
    )
