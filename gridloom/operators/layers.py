"""Vector layers of the rule engine: elements that rules pick, clipped to a boundary, filtered by area, buffered."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import segment_distance
from . import rules, spatial


def vector_layers(
    elements: DataFrame, layers: Mapping[str, Mapping[str, Any]], tags: str, key: str, edges: DataFrame, boundary: DataFrame, size: float, least_area: float = 0.0
) -> DataFrame:
    """Edges (layer, id, area, polygon, x1, y1, x2, y2) of the layers' elements inside the polygons of ``boundary``.

    Rules pick the elements of each layer, once for each ``key``; their edges (id, x1, y1, x2, y2) are clipped, and elements of which
    less than ``least_area`` is left are dropped.  ``area`` is that of all of an element inside the boundary, whose polygons must not overlap.
    """
    found = rules.classify(elements, layers, tags, [key]).select("layer", F.col(key).alias("id"))
    own = edges.join(found.select("id").distinct(), "id", "left_semi")
    cut = spatial.clip_polygons(own, boundary, size).checkpoint()
    left = spatial.area(cut, ["id"]).where((F.col("area") >= least_area) & (F.col("area") > 0))
    return found.join(cut.join(left, "id"), "id").select("layer", "id", "area", "polygon", "x1", "y1", "x2", "y2")


def buffered(edges: DataFrame, radii: Mapping[str, float], step: float, rows: tuple[int, int], cols: tuple[int, int]) -> DataFrame:
    """(layer, row, col): pixels whose centre lies in an element (layer, id, edges) or within its layer's radius of one.

    Edges are dealt row by row over the pixels that they can reach.
    """
    radius: Column = F.lit(0.0)
    for name, r in radii.items():
        radius = F.when(F.col("layer") == name, float(r)).otherwise(radius)
    inner = edges.select("layer", F.struct("layer", "id").alias("id"), "x1", "y1", "x2", "y2")
    inner = spatial.runs_inside(inner, step, rows, cols).select(F.col("id.layer").alias("layer"), "row", F.explode(F.sequence("first", "last")).alias("col"))
    reach = _reached(edges.withColumn("_r", radius).where(F.col("_r") > 0), step, rows, cols)
    return inner.unionByName(reach).distinct()


def _reached(edges: DataFrame, step: float, rows: tuple[int, int], cols: tuple[int, int]) -> DataFrame:
    def span(a: str, b: str, ends: Sequence[int]) -> Column:
        low = F.greatest(F.floor((F.least(a, b) - F.col("_r")) / step), F.lit(ends[0]))
        high = F.least(F.floor((F.greatest(a, b) + F.col("_r")) / step), F.lit(ends[1]))
        return F.when(low <= high, F.sequence(low.cast("int"), high.cast("int")))

    e = edges.withColumn("row", F.explode(span("y1", "y2", rows))).withColumn("col", F.explode(span("x1", "x2", cols)))
    x, y = (F.col("col") + 0.5) * step, (F.col("row") + 0.5) * step
    near = segment_distance(x, y, F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")) <= F.col("_r")
    return e.where(near).select("layer", "row", "col")
