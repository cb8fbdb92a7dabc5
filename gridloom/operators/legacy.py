"""The older allocation method: sparse-cell rules, closed bounds, sector splits, urban weighting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import beside

#: Cells are filed under bins, at most BINS for each axis of their extent.
BINS = 1000


def nearest_axis(value: Column, origin: float, step: float, n: int) -> Column:
    """Index of the nearest axis centre."""
    return F.greatest(F.lit(0), F.least(F.lit(n - 1), F.ceil((value - origin) / step - 0.5))).cast("int")


def sparse_weights(df: DataFrame, proxy: str, cell_pixels: int) -> DataFrame:
    """Weights in coarse cells with rules against sparse proxies.

    All non-zero values equal: even shares of the whole cell.  One to three non-zero pixels:
    the proxy counts min(n / 10, 0.3), the rest is even.  Coverage under 5 %: the even part is
    min(1 - coverage / 0.05, 0.8).  Coverage under 80 % scales the proxy part by it.
    Everything is normalised again at the end.
    """
    p = F.greatest(F.coalesce(F.col(proxy), F.lit(0.0)), F.lit(0.0))
    some = F.when(p > 0, p)
    df = beside(
        df, ["cell_id"], F.count(some).alias("_nz"), F.count("*").alias("_n"), F.sum(p).alias("_total"), F.min(some).alias("_low"), F.max(some).alias("_high")
    )
    nz, n, total, low, high = (F.col(c) for c in ("_nz", "_n", "_total", "_low", "_high"))
    cover = nz / F.lit(float(cell_pixels))
    share = F.when(total > 0, p / total).otherwise(0.0)
    even = 1.0 / n
    proxy_part = (
        F.when((nz == 0) | (low == high), 0.0)
        .when(nz <= 3, F.least(nz / 10.0, F.lit(0.3)))
        .when(cover < 0.05, 1 - F.least(1 - cover / 0.05, F.lit(0.8)))
        .otherwise(1.0)
    )
    proxy_part = F.when(cover < 0.8, proxy_part * F.greatest(cover, F.lit(0.2))).otherwise(proxy_part)
    mixed = df.withColumn("_m", proxy_part * share + (1 - proxy_part) * even).drop("_nz", "_n", "_total", "_low", "_high")
    return beside(mixed, ["cell_id"], F.sum("_m").alias("_all")).withColumn("weight", F.col("_m") / F.col("_all")).drop("_m", "_all")


def capped(df: DataFrame, weight: str, cap: Column) -> DataFrame:
    """Weights cut at a cap; what is cut off is shared evenly among the others of the cell."""
    under = F.col(weight) < cap
    both = beside(df, ["cell_id"], F.sum(F.greatest(F.col(weight) - cap, F.lit(0.0))).alias("_over"), F.count(F.when(under, 1)).alias("_free"))
    more = F.when(under, F.col("_over") / F.col("_free")).otherwise(0.0)
    return both.withColumn(weight, F.least(F.col(weight), cap) + more).drop("_over", "_free")


def distribute(df: DataFrame, mode: str) -> Column:
    """top_down: the cell's total times the proxy; coarse_cells: the row's own value times it."""
    if mode == "top_down":
        return F.sum("value").over(Window.partitionBy("cell_id")) * F.col("weight")
    if mode == "coarse_cells":
        return F.col("value") * F.col("weight")
    raise ValueError(mode)


def closed_candidates(sources: DataFrame, facilities: DataFrame, cells: DataFrame) -> DataFrame:
    """Sources and facilities of a cell with both bounds closed; on a shared edge both cells count.  Facilities meet the cells of their bin."""
    inside = lambda p, c: (p["f_lon"] >= c["west"]) & (p["f_lon"] <= c["east"]) & (p["f_lat"] >= c["south"]) & (p["f_lat"] <= c["north"])
    p, c = _binned(facilities, cells)
    f = p.join(c, (p["_bx"] == c["_bx"]) & (p["_by"] == c["_by"]) & inside(p, c))
    return sources.join(f.select(*[facilities[x] for x in facilities.columns], "cell_id"), ["cell_id", "sector"], "left")


def _binned(facilities: DataFrame, cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Facilities under the bin (_bx, _by) they lie in, cells under each bin they touch; bins are as wide as the mean cell."""
    wide = lambda a, b: F.greatest(F.avg(F.col(b) - F.col(a)), (F.max(b) - F.min(a)) / BINS)
    size = cells.agg(wide("west", "east").alias("x"), wide("south", "north").alias("y")).first()
    dx, dy = (v if v and v > 0 else 1.0 for v in (size["x"], size["y"]))
    touched = lambda a, b, d: F.explode(F.sequence(F.floor(F.col(a) / d), F.floor(F.col(b) / d)))
    # a cell whose bounds are the wrong way round holds nothing
    right = cells.where((F.col("west") <= F.col("east")) & (F.col("south") <= F.col("north")))
    c = right.withColumn("_bx", touched("west", "east", dx)).withColumn("_by", touched("south", "north", dy))
    return facilities.withColumn("_bx", F.floor(F.col("f_lon") / dx)).withColumn("_by", F.floor(F.col("f_lat") / dy)), c


#: Sector splits of the older method, area and point sources.
AREA_SNAP = {
    "A": [(1, 1.0)], "B": [(3, 0.8), (4, 0.2)], "C": [(2, 1.0)], "D": [(5, 1.0)], "E": [(6, 1.0)], "F1": [(7, 1.0)], "F2": [(7, 1.0)], "F3": [(7, 1.0)],
    "F4": [(7, 1.0)], "G": [(8, 1.0)], "H": [(11, 1.0)], "I": [(11, 1.0)], "J": [(9, 1.0)], "K": [(10, 1.0)], "L": [(10, 1.0)],
}
POINT_SNAP = AREA_SNAP | {"C": [(3, 1.0)], "D": [(4, 1.0)]}


def urban_core(value: Column, mask: Column, factor: float = 3.0) -> Column:
    """Upweighting inside a mask; mass isn't kept."""
    return F.when(F.coalesce(mask, F.lit(0.0)) > 0, value * factor).otherwise(value)
