"""Exact nearest facilities on the sphere: a descent through a quadtree of longitude and latitude."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import EARTH_KM, haversine_km
from ..sources.shared import shared_folder
from .joins import hinted

#: Facilities of a leaf cell before it is split, times the globe is quartered at most and at once, cells that are broadcast.
LEAF, QUARTERINGS, STRIDE, NODE_ROWS = 64, 20, 2, 20_000
_CELL = ("level", "row", "col")


def _filed(facilities: DataFrame) -> DataFrame:
    """``facilities`` with a row for each level of the tree and their cell there."""
    levels = F.array(*[F.lit(k) for k in range(0, QUARTERINGS + 1, STRIDE)])
    at = facilities.withColumn("level", F.explode(levels))
    n = F.pow(F.lit(2.0), F.col("level"))
    # the north pole belongs to the row south of it
    row = F.least(F.floor((F.col("f_lat") + 90) / (180 / n)), n - 1)
    return at.withColumns({"row": row.cast("int"), "col": F.floor((F.col("f_lon") + 180) / (360 / n)).cast("int")})


def _tree(facilities: DataFrame, leaf: int) -> tuple[DataFrame, DataFrame]:
    """Cells (level, row, col, n, leaf, and the cell above as _r, _c) below cells with more than ``leaf`` facilities, and the facilities with their leaf cells."""
    filed = _filed(facilities)
    counted = filed.groupBy(*_CELL).agg(F.count("*").alias("n")).checkpoint()
    whole = 1 << STRIDE
    counted = counted.withColumns({"_r": F.floor(F.col("row") / whole).cast("int"), "_c": F.floor(F.col("col") / whole).cast("int")})
    full = counted.where(F.col("n") > leaf).select((F.col("level") + STRIDE).alias("level"), F.col("row").alias("_r"), F.col("col").alias("_c"))
    below = counted.join(full, ["level", "_r", "_c"], "left_semi").select(*_CELL, "n", "_r", "_c")
    nodes = counted.where(F.col("level") == 0).select(*_CELL, "n", "_r", "_c").unionByName(below)
    nodes = nodes.withColumn("leaf", (F.col("n") <= leaf) | (F.col("level") + STRIDE > QUARTERINGS)).checkpoint()
    placed = filed.join(hinted(nodes.where("leaf").select(*_CELL), NODE_ROWS), list(_CELL)).select("facility_id", "f_lon", "f_lat", *_CELL)
    return nodes, placed.checkpoint()


def _bounds(level: Column) -> tuple[Column, Column]:
    """Least and greatest distance in km that a facility in a cell can have from the point (_lon, _lat)."""
    lon, lat = F.col("_lon"), F.col("_lat")
    tall, wide = (F.lit(x) / F.pow(F.lit(2.0), level) for x in (180.0, 360.0))
    south, west = F.col("row") * tall - 90, F.col("col") * wide - 180
    ahead = F.pmod(lon - west, F.lit(360.0))  # degrees eastward from the western edge
    gap = F.when(ahead <= wide, 0.0).otherwise(F.least(ahead - wide, 360.0 - ahead))
    turn = lambda d: F.least(F.pmod(d, F.lit(360.0)), 360.0 - F.pmod(d, F.lit(360.0)))
    opposite = F.pmod(lon + 180.0 - west, F.lit(360.0)) <= wide
    far = F.when(opposite, 180.0).otherwise(F.greatest(turn(ahead), turn(ahead - wide)))
    up = F.greatest(south - lat, lat - south - tall, F.lit(0.0))
    far_up = F.greatest(F.abs(lat - south), F.abs(lat - south - tall))
    # not nearer than its parallel nor than the great circle of its meridian; not farther than along parallel and meridian
    meridian = F.asin(F.cos(F.radians(lat)) * F.sin(F.radians(F.least(gap, F.lit(90.0)))))
    low = EARTH_KM * F.greatest(F.radians(up), meridian)
    high = EARTH_KM * (F.radians(far_up) + F.cos(F.radians(lat)) * F.radians(far))
    return low * (1 - 1e-9) - 1e-9, high * (1 + 1e-9) + 1e-9


def nearest(points: DataFrame, facilities: DataFrame, k: int = 1, leaf: int = LEAF) -> DataFrame:
    """The k nearest facilities of each point: the columns of ``points`` (source_id, lon, lat, ...), facility_id, distance_km, place (from 1).

    Ties go to the lesser facility_id.  All facilities come out where there are fewer than k.  Longitudes are any within a turn;
    the antimeridian and the poles are no borders.  Rows with null coordinates match nothing; ``source_id`` is unique.

    All points go down the tree level by level.  At each level counts and farthest corners of the cells met bound the k-th
    distance from above, and cells that begin beyond it are left, so that a point keeps a handful of cells
    whether facilities are near, far or heaped; only those in the leaves kept at the end are measured.
    """
    spark = points.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    turn = lambda c: F.pmod(F.col(c) + 180.0, F.lit(360.0)) - 180.0
    f = facilities.where(F.col("f_lon").isNotNull() & F.col("f_lat").isNotNull()).select("facility_id", turn("f_lon").alias("f_lon"), F.col("f_lat").cast("double").alias("f_lat"))
    # of the facilities at one place only the k of the least ids can come out
    same = Window.partitionBy("f_lon", "f_lat").orderBy("facility_id")
    f = f.withColumn("_r", F.row_number().over(same)).where(F.col("_r") <= k).drop("_r").checkpoint()
    nodes, placed = _tree(f, leaf)
    whole, deepest = placed.count(), nodes.agg(F.max("level")).first()[0] or 0
    start = points.where(F.col("lon").isNotNull() & F.col("lat").isNotNull()).select("source_id", turn("lon").alias("_lon"), F.col("lat").cast("double").alias("_lat"))
    met = start.withColumns({"level": F.lit(0), "row": F.lit(0), "col": F.lit(0), "n": F.lit(whole).cast("long"), "leaf": F.lit(whole <= leaf), "_bound": F.lit(float("inf"))})
    if not whole:
        met = met.limit(0)
    columns = ["source_id", "_lon", "_lat", *_CELL, "n", "leaf", "_bound"]
    for level in range(STRIDE, deepest + 1, STRIDE):
        # a cell asks for those below it by its own row and column
        lower = hinted(nodes.where(F.col("level") == level), NODE_ROWS)
        down = met.where(~F.col("leaf")).select("source_id", "_lon", "_lat", "_bound", F.col("row").alias("_r"), F.col("col").alias("_c"))
        down = down.join(lower, ["_r", "_c"]).select(*columns)
        low, high = _bounds(F.col("level"))
        now = met.where("leaf").select(*columns).unionByName(down).withColumns({"_low": low, "_high": high})
        now = now.where(F.col("_low") <= F.col("_bound"))  # the bound of the level above holds below it
        nearer = Window.partitionBy("source_id").orderBy("_high", *_CELL).rowsBetween(Window.unboundedPreceding, 0)
        enough = F.when(F.sum("n").over(nearer) >= min(k, whole), F.col("_high"))
        now = now.withColumn("_enough", enough).withColumn("_bound", F.min("_enough").over(Window.partitionBy("source_id")))
        met = now.where(F.col("_low") <= F.col("_bound")).select(*columns).checkpoint()
    pairs = met.join(placed, list(_CELL))
    pairs = pairs.select("source_id", "facility_id", haversine_km(F.col("_lon"), F.col("_lat"), F.col("f_lon"), F.col("f_lat")).alias("distance_km"))
    order = Window.partitionBy("source_id").orderBy("distance_km", "facility_id")
    best = pairs.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    return points.join(best, "source_id")
