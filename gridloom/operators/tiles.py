"""Map tiles sampled from rasters: values, shades and opacities of their pixels."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import floor_index

TILE = 256


def pixels(tiles: DataFrame, size: int = TILE) -> DataFrame:
    """``tiles`` (z, x, y) with every pixel (row, col from the north-west) and its centre lon, lat."""
    p = tiles.withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(size - 1)))).withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(size - 1))))
    n = F.pow(F.lit(2.0), F.col("z"))
    lon = (F.col("x") + (F.col("col") + 0.5) / size) / n * 360.0 - 180.0
    lat = F.degrees(F.atan(F.sinh(F.lit(math.pi) * (1 - 2 * (F.col("y") + (F.col("row") + 0.5) / size) / n))))
    return p.withColumns({"lon": lon, "lat": lat})


def covering(west: float, south: float, east: float, north: float, zoom: int) -> tuple[range, range]:
    """Columns and rows of the tiles of a zoom level that a box in degrees meets."""
    n = 2**zoom
    row = lambda lat: (1 - math.asinh(math.tan(math.radians(max(-85.0511, min(85.0511, lat))))) / math.pi) / 2 * n
    clamp = lambda v: max(0, min(n - 1, math.floor(v)))
    return range(clamp((west + 180) / 360 * n), clamp((east + 180) / 360 * n) + 1), range(clamp(row(north)), clamp(row(south)) + 1)


def sampled(raster: DataFrame, tiles: DataFrame, x0: float, y0: float, dx: float, dy: float, size: int = TILE) -> DataFrame:
    """(z, x, y, row, col, value): pixels of tiles over a raster (row, col, value) in degrees, by nearest pixel; those without a positive value give no row."""
    p = pixels(tiles, size).withColumns({"_r": floor_index(F.col("lat"), y0, dy), "_c": floor_index(F.col("lon"), x0, dx)})
    s = raster.where(F.col("value") > 0).select(F.col("row").alias("_r"), F.col("col").alias("_c"), "value")
    return p.join(s, ["_r", "_c"]).select("z", "x", "y", "row", "col", "value")


def shaded(values: DataFrame, low: float, high: float, threshold: float, eps: float = 1e-12) -> DataFrame:
    """``values`` with ``shade`` (0 to 255 on a logarithmic scale from ``low`` to ``high``) and ``alpha``: 0.08 below the threshold, 0.42 to 0.9 by shade above it."""
    norm = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.log10(F.greatest(F.col("value"), F.lit(0.0)) + eps) - low) / max(high - low, 1e-9)))
    visible: Column = F.greatest(F.lit(0.42), F.least(F.lit(0.9), 0.42 + norm * 0.48))
    return values.withColumns({"shade": F.floor(norm * 255).cast("int"), "alpha": F.when(F.col("value") < threshold, 0.08).otherwise(visible)})
