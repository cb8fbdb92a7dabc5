"""Grid cells: lookup of points, footprints, cell mass, regridding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import clean, floor_index
from .joins import hinted

#: An axis of at most so many intervals is broadcast.
AXIS_ROWS = 100_000


def regular_cell(lon: Column, lat: Column, west: float, south: float, dx: float, dy: float, n_lon: int, n_lat: int) -> Column:
    """Cell id of a point on a regular grid, half-open bounds, -1 outside."""
    i, j = floor_index(lon, west, dx), floor_index(lat, south, dy)
    inside = i.between(0, n_lon - 1) & j.between(0, n_lat - 1)
    return F.when(inside, j.cast("long") * n_lon + i).otherwise(F.lit(-1).cast("long"))


def range_join(points: DataFrame, value: str, axis: DataFrame, low: str, high: str, bin_width: float, how: str = "inner") -> DataFrame:
    """Join points to the intervals low <= value < high of an axis.

    Intervals are filed under every bin of ``bin_width`` they touch, so the join is an
    equi-join on the bin with the bounds as a residual condition.
    """
    bins = axis.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(low) / bin_width), F.floor(F.col(high) / bin_width))))
    p = points.withColumn("_bin", F.floor(F.col(value) / bin_width))
    within = (p["_bin"] == bins["_bin"]) & (p[value] >= bins[low]) & (p[value] < bins[high])
    return p.join(bins, within, how).drop("_bin")


def strict_lookup(points: DataFrame, key: str, value: str, axis: DataFrame, index: str, low: str, high: str, bin_width: float) -> DataFrame:
    """(key, index): the one interval that holds a value, -1 where none or several do."""
    hits = range_join(points.select(key, value), value, axis.select(index, low, high), low, high, bin_width, "left")
    found = hits.groupBy(key).agg(F.count(index).alias("_n"), F.min(index).alias("_i"))
    return found.select(key, F.when(F.col("_n") == 1, F.col("_i")).otherwise(-1).alias(index))


def shift_to_zero(df: DataFrame, index: str, size: int) -> DataFrame:
    """Index columns that count from one (their maximum reaches ``size``) are moved to zero, then cut to the axis."""
    top = df.agg(F.max(index).alias("_top"))
    shifted = df.join(F.broadcast(top)).withColumn(index, F.col(index) - F.when(F.col("_top") >= size, 1).otherwise(0))
    return shifted.withColumn(index, F.greatest(F.lit(0), F.least(F.lit(size - 1), F.col(index)))).drop("_top")


def select_sources(df: DataFrame, *, categories: Sequence[int] = (), types: Sequence[int] = (), country: int | None = None, positive: Sequence[str] = ()) -> DataFrame:
    """Sources with finite coordinates and the wanted categories, types and country; with
    ``positive`` at least one of these pollutants must be above zero."""
    keep = clean(F.col("lon")).isNotNull() & clean(F.col("lat")).isNotNull()
    if categories:
        keep &= F.col("category").isin(*categories)
    if types:
        keep &= F.col("source_type").isin(*types)
    if country is not None:
        keep &= F.col("country") == country
    if positive:
        keep &= F.coalesce(F.greatest(*[clean(F.col(c)) for c in positive], F.lit(0.0)), F.lit(0.0)) > 0
    return df.where(keep)


def footprint(df: DataFrame, pollutants: Sequence[str]) -> DataFrame:
    """Distinct cells that hold some pollutant."""
    return select_sources(df, positive=pollutants).select("cell_id").distinct()


def cell_mass(df: DataFrame, pollutants: Sequence[str], cells: DataFrame | None = None) -> DataFrame:
    """Mass of each pollutant per cell; cells of ``cells`` without a source have 0."""
    mass = df.groupBy("cell_id").agg(*[F.sum(F.coalesce(clean(F.col(c)), F.lit(0.0))).alias(c) for c in pollutants])
    if cells is None:
        return mass
    return cells.select("cell_id").join(mass, "cell_id", "left").fillna(0.0, list(pollutants))


def unpivot_mass(df: DataFrame, keys: Sequence[str], pollutants: Sequence[str]) -> DataFrame:
    return df.unpivot(list(keys), list(pollutants), "pollutant", "mass")


def shipping_mass(df: DataFrame, country: int, maritime: DataFrame, pollutants: Sequence[str]) -> DataFrame:
    """Footprint: the country's cells and those maritime cells that emit; mass from all countries."""
    emitting = footprint(df, pollutants)
    own = footprint(df.where(F.col("country") == country), pollutants)
    cells = own.union(maritime.select("cell_id").intersect(emitting)).distinct()
    return cell_mass(df.join(cells, "cell_id", "left_semi"), pollutants, cells)


def restrict(pixels: DataFrame, cells: DataFrame) -> DataFrame:
    """cell_id becomes -1 where it is none of ``cells``."""
    marked = pixels.join(cells.select("cell_id", F.lit(1).alias("_in")).distinct(), "cell_id", "left")
    return marked.withColumn("cell_id", F.when(F.col("_in") == 1, F.col("cell_id")).otherwise(F.lit(-1))).drop("_in")


def regrid(df: DataFrame, keys: Sequence[str], value: str, step: float, x: str = "x", y: str = "y", origin: tuple[float, float] = (0.0, 0.0)) -> DataFrame:
    """Sum fine values into coarse cells by floor."""
    return df.groupBy(*keys, floor_index(F.col(y), origin[1], step).alias("r"), floor_index(F.col(x), origin[0], step).alias("c")).agg(F.sum(value).alias(value))


def bounds(cells: DataFrame) -> DataFrame:
    return cells.agg(F.min("west").alias("west"), F.min("south").alias("south"), F.max("east").alias("east"), F.max("north").alias("north"))


def covered_km2(cells: DataFrame) -> DataFrame:
    """Rough area of cells: width and height in degrees, 111 km each, width shrunk by latitude."""
    mid = (F.col("south") + F.col("north")) / 2
    part = (F.col("east") - F.col("west")) * (F.col("north") - F.col("south")) * 111.0 * 111.0 * F.cos(F.radians(mid))
    return cells.agg(F.sum(part).alias("km2"))


def cell_centres(lon_axis: DataFrame, lat_axis: DataFrame, n_lon: int) -> DataFrame:
    """Every cell of two axis tables with its centre; the result is as large as the grid."""
    both = lat_axis.crossJoin(hinted(lon_axis, AXIS_ROWS))
    return both.select(
        (F.col("lat_idx").cast("long") * n_lon + F.col("lon_idx")).alias("cell_id"),
        ((F.col("west") + F.col("east")) / 2).alias("lon"),
        ((F.col("south") + F.col("north")) / 2).alias("lat"),
    )


def latest_per_key(df: DataFrame, key: str, year: str, *ties: str) -> DataFrame:
    """The row of the latest year of each key; ties by the given columns, ascending."""
    columns = [c for c in df.columns if c != key]
    order = F.struct(-F.col(year), *[F.col(c) for c in ties])
    picked = df.groupBy(key).agg(F.min_by(F.struct(*columns), order).alias("_r"))
    return picked.select(key, "_r.*")


def unite(sources: dict[str, DataFrame], key: str) -> DataFrame:
    """Union of tables with keys made distinct by a source prefix; missing columns are null."""
    out: DataFrame | None = None
    for name, df in sources.items():
        own = df.withColumn(key, F.concat_ws(":", F.lit(name), F.col(key).cast("string"))).withColumn("source", F.lit(name))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    if out is None:
        raise ValueError("no tables")
    return out


def dissolve(cells: DataFrame, by: str) -> DataFrame:
    """Union of the cells (row, col) of each group: cells, and edges of the outline, which are those no two of its cells share."""
    own = cells.select(by, "row", "col").distinct()
    sides = F.array(*[F.struct(F.lit(k).alias("k"), (F.col("row") + a).alias("r"), (F.col("col") + b).alias("c")) for k, a, b in ((0, 0, 0), (0, 1, 0), (1, 0, 0), (1, 0, 1))])
    edges = own.select(by, F.explode(sides).alias("e")).groupBy(by, "e").agg(F.count("*").alias("_n")).where(F.col("_n") == 1)
    return own.groupBy(by).agg(F.count("*").alias("cells")).join(edges.groupBy(by).agg(F.count("*").alias("outline")), by)
