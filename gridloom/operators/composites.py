"""Sector composites: layers on pixels to weights of every pollutant in the inventory's cells."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written
from . import signals
from .joins import beside, beside_written, hinted
from .normalize import cell_score, fused, mixture, to_target

PIXEL = ("row", "col")
#: Regions that are broadcast.
REGION_ROWS = 100_000


def scored(layers: DataFrame) -> DataFrame:
    """Layers with ``zpop``, the population's score in its cell, and ``top``, the highest score."""
    # read for the scores, for the sums of signals and for the weights: made once, and written
    z = cell_score(written(layers, "layers"), "pop", "zpop", beside=beside_written)
    return beside(z, [], F.max("zpop").alias("top"))


def sector_weights(layers: DataFrame, groups: Mapping[str, Column], alpha: DataFrame) -> DataFrame:
    """(pollutant, row, col, cell_id, weight): group signals shared out in cells, mixed by alpha, shared out again."""
    return fused(layers, groups, alpha, PIXEL).drop("signal")


def power(l: Mapping[str, Column]) -> dict[str, Column]:
    return {"g1": signals.public_power(l["pop"], l["cover"])}


def industry(l: Mapping[str, Column]) -> dict[str, Column]:
    return {
        "g1": signals.industry(l["osm"], l["cover"], l["zpop"], 0.3, 0.6, 0.4),
        "g2": signals.industry(l["osm"], l["sealed"], l["zpop"], 0.1, 0.5, 0.5),
        "g3": signals.masked(signals.industry(l["osm"], l["cover"], l["zpop"], 0.0, 1.0, 0.0), l["cover"] >= 0.5),
    }


def shipping(l: Mapping[str, Column]) -> dict[str, Column]:
    return {"g1": signals.shipping(l["density"], l["osm"], l["cover"])}


def waste(l: Mapping[str, Column]) -> dict[str, Column]:
    rural = signals.rural(l["rural"], l["cover"]).cast("double")
    return {
        "g1": signals.waste_solid(l["cover"], l["osm"], l["zpop"]),
        "g2": signals.waste_water(l["plants"], l["cover"], l["zpop"], l["sealed"]),
        "g3": signals.waste_residual(l["zpop"], rural, l["sealed"], l["top"]),
    }


def solvents(l: Mapping[str, Column], beta: Mapping[str, Mapping[str, float]]) -> dict[str, Column]:
    """Four activities, mixed to the groups by ``beta`` (group to activity to weight)."""
    activities = {
        "home": mixture([(1.0, l["zpop"])]),
        "trade": mixture([(0.5, l["osm"]), (0.5, l["sealed"])]),
        "plant": mixture([(0.7, l["cover"]), (0.3, l["osm"])]),
        "roads": mixture([(1.0, l["density"])]),
    }
    return {g: mixture([(w, activities[a]) for a, w in row.items()], unit=False) for g, row in beta.items()}


def fugitive(l: Mapping[str, Column]) -> dict[str, Column]:
    return {
        "g1": signals.masked(mixture([(0.6, l["osm"]), (0.4, l["cover"])]), l["cover"] > 0),
        "g2": mixture([(0.5, l["osm"]), (0.2, l["sealed"]), (0.3, l["zpop"])]),
        "g3": mixture([(0.75, l["zpop"]), (0.25, l["cover"])]),
    }


def offroad(l: Mapping[str, Column]) -> dict[str, Column]:
    return {
        "g1": mixture([(0.9, l["osm"]), (0.1, l["sealed"])]),
        "g2": signals.masked(mixture([(0.7, l["cover"]), (0.3, l["rural"])]), l["rural"] >= 0.5),
        "g3": mixture([(1.0, l["zpop"])]),
    }


def livestock(l: Mapping[str, Column], housed: Column) -> dict[str, Column]:
    """Housing and pasture by the share ``housed`` of the region."""
    return {"g1": housed * mixture([(1.0, l["sealed"])]) + (1 - housed) * mixture([(1.0, l["rural"])])}


def agriculture(l: Mapping[str, Column]) -> dict[str, Column]:
    """The eight signals of agriculture, from layers that :func:`agriculture_layers` has completed."""
    return {
        "livestock": livestock(l, l["housed"])["g1"],
        "manure": l["z_manure"],
        "grazed_pastures": mixture([(1.0, l["rural"])]),
        "farm_buildings": mixture([(1.0, l["sealed"])]),
        "inorganic_n": l["n_rate"],
        "crop_nmvoc": l["c_rate"],
        "broad_agricultural": l["broad"],
        "biomass_burning": l["z_fire"],
    }


def agriculture_layers(layers: DataFrame, regions: DataFrame, points: DataFrame, classes: Mapping[int, tuple[float, float, float]], fires: DataFrame) -> DataFrame:
    """``layers`` (pixel, cell_id, region, class, area, rural, sealed) with what the agriculture signals need.

    ``regions`` (region, housed, manure): share of stock that is housed, manure to be spread.  ``points`` (row, col, n, c): surveyed rates of
    fertiliser and of crop emissions.  ``classes``: weight, fertiliser and crop rate of land-cover classes, for pixels without a survey.
    ``fires`` (row, col, power).  Manure follows the weighted area of crops up to its region's amount and is scored in its cell.  Rates times area
    and the class weights are scaled by their maxima.  Of fires on pixels with a class weight the strongest counts, scored in its cell.
    """
    rate = lambda k: F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for c, w in classes.items() for x in (c, w[k])]), F.col("class")), F.lit(0.0))
    surveyed = points.groupBy(*PIXEL).agg(F.avg("n").alias("_n"), F.avg("c").alias("_c"))
    strongest = fires.where(F.col("power") > 0).groupBy(*PIXEL).agg(F.max("power").alias("_p"))
    d = layers.join(hinted(written(regions, "regions"), REGION_ROWS), "region", "left").join(surveyed, list(PIXEL), "left").join(strongest, list(PIXEL), "left")
    d = d.withColumns({"_w": rate(0), "_crop": rate(0) * F.col("area"), "_target": F.coalesce("manure", F.lit(0.0))})
    d = d.withColumns({"_nr": F.coalesce("_n", rate(1)) * F.col("area"), "_cr": F.coalesce("_c", rate(2)) * F.col("area"), "_fire": F.when(F.col("_w") > 0, F.col("_p"))})
    # aggregates are joined back several times, each to a written table and not to all that made it
    d = to_target(written(d, "agriculture"), "_crop", "region", "_target", "_manure", beside_written)
    some = {v: F.when(F.col(v) > 0, F.col(v)) for v in ("_manure", "_fire")}
    ends = [f(c).alias(f"{v}{n}") for v, c in some.items() for n, f in (("_lo", F.min), ("_hi", F.max))]
    tops = d.agg(*[F.max(v).alias(f"{v}_top") for v in ("_nr", "_cr", "_w")])
    d = beside_written(d, ["cell_id"], *ends).crossJoin(F.broadcast(tops))
    for out, v in (("n_rate", "_nr"), ("c_rate", "_cr"), ("broad", "_w")):
        d = d.withColumn(out, F.col(v) / (F.col(f"{v}_top") + 1e-12))
    for out, v in (("z_manure", "_manure"), ("z_fire", "_fire")):
        low, high = F.col(f"{v}_lo"), F.col(f"{v}_hi")
        d = d.withColumn(out, F.when(some[v].isNull(), 0.0).when(high > low, (some[v] - low) / (high - low)).otherwise(1.0))
    d = d.withColumn("housed", F.coalesce("housed", F.lit(0.6)))
    return d.drop("manure", *[c for c in d.columns if c.startswith("_")])


def pastures(l: Mapping[str, Column]) -> dict[str, Column]:
    return {"g1": mixture([(1.0, l["rural"])]), "g2": mixture([(1.0, l["sealed"])]), "g3": mixture([(0.5, l["rural"]), (0.5, l["cover"])])}


def stock_loads(l: Mapping[str, Column]) -> dict[str, Column]:
    """Stock times load of seven classes of appliances: homes and offices by kind, and the rest."""
    z, c, s = (F.coalesce(l[x], F.lit(0.0)) for x in ("zpop", "cover", "sealed"))
    return {
        "stove": z * (1 - c), "boiler": 2.0 * z * c, "fireplace": 0.5 * z, "heater": z * z,
        "office": s * c, "school": 0.2 * s, "other": c,
    }
