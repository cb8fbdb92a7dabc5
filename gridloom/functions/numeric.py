"""Numeric expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KG_PER_YEAR_TO_G_PER_S = 1000.0 / (365 * 24 * 3600)


def clean(c: Column) -> Column:
    """NaN and infinities become null."""
    d = c.cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) != float("inf")), d)


def clip01(c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(c, F.lit(0.0))))


def rounded(v: Column, digits: int) -> Column:
    """A double rounded half away from zero as SQL engines and C do, in double arithmetic; ``F.round`` goes through decimals, which takes several times
    as long.  What is beyond 2^52 once scaled, NaN and infinities stay as they are."""
    scale = 10.0**digits
    a = F.abs(v) * scale
    low = F.floor(a).cast("double")
    r = F.when(a - low >= 0.5, low + 1.0).otherwise(low) / scale
    return F.when(a < 2.0**52, F.when(v < 0, -r).otherwise(r)).otherwise(v)


def snap(v: Column, step: float) -> Column:
    """South-west corner of the step a value lies in; a true floor for negatives."""
    return F.floor(v / step) * step


def truncated_index(v: Column, origin: float, step: float) -> Column:
    """Index by truncation toward zero: up to one step before the origin still gives 0."""
    return ((v - origin) / step).cast("int")


def floor_index(v: Column, origin: float, step: float) -> Column:
    return F.floor((v - origin) / step).cast("int")


def pixel_centre(index: Column, origin: float, step: float) -> Column:
    return origin + (index + 0.5) * step


def linear_index(parts: list[Column], sizes: list[int]) -> Column:
    """Row-major index of an n-dimensional place, last dimension fastest."""
    at = F.lit(0)
    for p, n in zip(parts, sizes):
        at = at * n + p
    return at


def unravel(index: Column, sizes: list[int]) -> list[Column]:
    """The place that a row-major index stands for."""
    out: list[Column] = []
    for n in reversed(sizes):
        out.append((index % n).cast("int"))
        index = F.floor(index / n)
    return out[::-1]


def positive_map(m: Column) -> Column:
    return F.map_filter(m, lambda _, v: v > 0)


def map_total(m: Column) -> Column:
    return F.aggregate(F.map_values(m), F.lit(0.0), lambda a, v: a + v)


def radius_from_area(km2: Column, scale: float = 1.0) -> Column:
    return F.sqrt(km2 * 1e6 / F.pi()) * scale
