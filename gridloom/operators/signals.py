"""Sector signals: weighted mixtures of spatial signals as Columns, and their composites."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import clip01
from .normalize import mixture

#: Mixing weights of the sectors.
POWER = (0.4, 0.6)
SHIPPING = (0.3, 0.6, 0.1)
WASTE = {"solid": (0.55, 0.15, 0.30), "water": (0.35, 0.35, 0.05, 0.25), "residual": (0.4, 0.5, 0.1)}


def public_power(population: Column, cover: Column, w: tuple[float, float] = POWER) -> Column:
    p = F.greatest(F.coalesce(population, F.lit(0.0)), F.lit(0.0))
    return w[0] * p + w[1] * clip01(cover) * p


def industry(osm: Column, cover: Column, population: Column, w_pop: float, w_osm: float, w_cover: float) -> Column:
    return (1 - w_pop) * (w_osm * clip01(osm) + w_cover * clip01(cover)) + w_pop * clip01(population)


def shipping(density: Column, osm: Column, port: Column, w: tuple[float, float, float] = SHIPPING) -> Column:
    return mixture([(w[0], density), (w[1], osm), (w[2], port)])


def waste_solid(cover: Column, osm: Column, population: Column) -> Column:
    a = WASTE["solid"]
    return mixture([(a[0], cover), (a[1], osm), (a[2], population)])


def waste_water(plants: Column, agglomerations: Column, population: Column, sealed: Column) -> Column:
    b = WASTE["water"]
    return mixture([(b[0], plants), (b[1], agglomerations), (b[2], population), (b[3], sealed)])


def waste_residual(population: Column, rural: Column, sealed: Column, top: Column) -> Column:
    """Where few people live: the population score turned round by its maximum."""
    c = WASTE["residual"]
    return mixture([(c[0], top - population), (c[1], rural), (c[2], sealed)])


def activities_to_groups(activities: DataFrame, beta: DataFrame, pixel: list[str]) -> DataFrame:
    """Solvent sub-sectors: activity signals (pixel, activity, signal) mixed by beta(group, activity, beta)."""
    return activities.join(beta.where(F.col("beta") != 0), "activity").groupBy(*pixel, "group").agg(F.sum(F.col("beta") * F.col("signal")).alias("signal"))


def grouped(parts: Mapping[str, list[tuple[float, Column]]]) -> Column:
    """Signals of several groups as map group -> signal, to be exploded to long form."""
    return F.create_map(*[x for name, p in parts.items() for x in (F.lit(name), mixture(p))])


def masked(signal: Column, mask: Column) -> Column:
    """Signal where a mask holds, 0 elsewhere."""
    return F.when(F.coalesce(mask, F.lit(False)), F.coalesce(signal, F.lit(0.0))).otherwise(0.0)


def rural(is_rural: Column, *urban: Column) -> Column:
    """Rural and none of the urban masks at one half or more."""
    out = F.coalesce(is_rural, F.lit(0.0)) >= 0.5
    for u in urban:
        out = out & (F.coalesce(u, F.lit(0.0)) < 0.5)
    return out


def housing_factor(stock: DataFrame, by: str, default: float = 0.6) -> DataFrame:
    """Share of excreted nitrogen that falls in houses: sum(h * lw * n * f) / sum(h * lw * n) over species.

    stock: ``by``, heads, live_weight, n_rate, housed.  Regions without animals take the default.
    """
    n = F.when(F.col("heads") > 0, F.col("heads") * F.col("live_weight") * F.col("n_rate")).otherwise(0.0)
    return stock.groupBy(by).agg((F.sum(n * F.col("housed")) / F.nullif(F.sum(n), F.lit(0.0))).alias("_r")).select(by, F.coalesce("_r", F.lit(default)).alias("factor"))


def pig_split(country: Column) -> Column:
    """Share of pig manure that goes to fodder crops."""
    half = ("DNK", "DEU", "FRA", "ITA", "ESP", "IRL", "LUX", "AUT", "SVN", "CYP")
    return F.when(country.isin("BEL", "NLD"), 0.75).when(country.isin(*half), 0.5).otherwise(0.25)


def manure_pools(stock: DataFrame, region: str, country: str) -> DataFrame:
    """Nitrogen for fodder and other crops.  stock: region, country, species, nitrogen."""
    g, sp, n = pig_split(F.col(country)), F.col("species"), F.col("nitrogen")
    fodder = F.when(sp.isin("bovine", "sheep", "goats"), n).when(sp == "pigs", g * n).otherwise(0.0)
    other = F.when(sp == "pigs", (1 - g) * n).when(sp == "poultry", n).otherwise(0.0)
    return stock.groupBy(region).agg(F.sum(fodder).alias("fodder"), F.sum(other).alias("other"))


def with_default(df: DataFrame, table: DataFrame, key: str, value: str, default: float) -> DataFrame:
    """Value map join: a table's value for a key, a default elsewhere."""
    return df.join(table.select(key, value), key, "left").withColumn(value, F.coalesce(value, F.lit(default)))
