"""Distances, projections and tile arithmetic as Column expressions.

Fixed values: the GRS80 / WGS84 ellipsoids, the parameters of ETRS89-LAEA Europe and of
UTM, the radius of the spherical Mercator projection, a mean Earth radius of 6371 km.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0
MERCATOR_M = 6378137.0
_A, _F = 6378137.0, 1 / 298.257222101
_E2 = _F * (2 - _F)
_E = math.sqrt(_E2)
_LAT0, _LON0, _FE, _FN = math.radians(52), math.radians(10), 4321000.0, 3210000.0


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance in km, arctangent form."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    a = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_KM * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def _q_column(sin_lat: Column) -> Column:
    return (1 - _E2) * (sin_lat / (1 - _E2 * sin_lat * sin_lat) - F.log((1 - _E * sin_lat) / (1 + _E * sin_lat)) / (2 * _E))


def _q(s: float) -> float:
    return (1 - _E2) * (s / (1 - _E2 * s * s) - math.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))


def to_laea(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Easting and northing in ETRS89-LAEA Europe (ellipsoidal equal-area formula)."""
    qp = _q(1.0)
    beta0 = math.asin(_q(math.sin(_LAT0)) / qp)
    rq = _A * math.sqrt(qp / 2)
    d = _A * math.cos(_LAT0) / (math.sqrt(1 - _E2 * math.sin(_LAT0) ** 2) * rq * math.cos(beta0))
    beta = F.asin(_q_column(F.sin(F.radians(lat))) / qp)
    dl = F.radians(lon) - _LON0
    b = rq * F.sqrt(2 / (1 + math.sin(beta0) * F.sin(beta) + math.cos(beta0) * F.cos(beta) * F.cos(dl)))
    x = _FE + b * d * F.cos(beta) * F.sin(dl)
    y = _FN + (b / d) * (math.cos(beta0) * F.sin(beta) - math.sin(beta0) * F.cos(beta) * F.cos(dl))
    return x, y


def to_utm(lon: Column, lat: Column, zone: int) -> tuple[Column, Column]:
    """Easting and northing in a northern UTM zone (series in the third flattening)."""
    n = _F / (2 - _F)
    big_a = _A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    c = 2 * math.sqrt(n) / (1 + n)
    s = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(s) - c * F.atanh(c * s))
    dl = F.radians(lon - (zone * 6 - 183))
    xi, eta = F.atan2(t, F.cos(dl)), F.atanh(F.sin(dl) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for j, a in enumerate(alpha, 1):
        east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return 500000 + 0.9996 * big_a * east, 0.9996 * big_a * north


def _settled(start: Column, step: Callable[[Column], Column], times: int) -> Column:
    """``step`` applied so many times to a struct; its fields are bound to names, so the expression doesn't grow with the steps."""
    return F.aggregate(F.array(*[F.lit(0)] * times), start, lambda value, _: step(value))


def from_laea(x: Column, y: Column) -> tuple[Column, Column]:
    """Longitude and latitude of a point in ETRS89-LAEA Europe, the inverse of :func:`to_laea` (Newton's method on the authalic latitude)."""
    qp = _q(1.0)
    beta0 = math.asin(_q(math.sin(_LAT0)) / qp)
    rq = _A * math.sqrt(qp / 2)
    d = _A * math.cos(_LAT0) / (math.sqrt(1 - _E2 * math.sin(_LAT0) ** 2) * rq * math.cos(beta0))
    east, north = (x - _FE) / d, (y - _FN) * d
    rho = F.sqrt(east * east + north * north)
    c = 2 * F.asin(F.least(F.lit(1.0), rho / (2 * rq)))
    # at the centre itself the direction does not matter
    along = F.coalesce(north / F.nullif(rho, F.lit(0.0)), F.lit(0.0))
    sin_beta = F.cos(c) * math.sin(beta0) + along * F.sin(c) * math.cos(beta0)

    def step(p: Column) -> Column:
        phi, s = p["phi"], F.sin(p["phi"])
        w = 1 - _E2 * s * s
        better = phi + w * w / (2 * F.cos(phi)) * (p["beta"] * (qp / (1 - _E2)) - s / w + F.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))
        return F.struct(better.alias("phi"), p["beta"].alias("beta"))

    # the authalic latitude itself is a first guess
    sine = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), sin_beta))
    lat = _settled(F.struct(F.asin(sine).alias("phi"), sine.alias("beta")), step, 5)["phi"]
    lon = F.atan2(east * F.sin(c), rho * math.cos(beta0) * F.cos(c) - north * math.sin(beta0) * F.sin(c))
    return F.degrees(lon) + math.degrees(_LON0), F.degrees(lat)


def from_utm(east: Column, north: Column, zone: int) -> tuple[Column, Column]:
    """Longitude and latitude of a point in a northern UTM zone, the inverse of :func:`to_utm` (its series undone by iteration)."""
    n = _F / (2 - _F)
    big_a = _A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    c = 2 * math.sqrt(n) / (1 + n)
    xi, eta = north / (0.9996 * big_a), (east - 500000) / (0.9996 * big_a)

    def step(p: Column) -> Column:
        a, b = p["x0"], p["e0"]
        for j, k in enumerate(alpha, 1):
            a = a - k * F.sin(2 * j * p["xi"]) * F.cosh(2 * j * p["eta"])
            b = b - k * F.cos(2 * j * p["xi"]) * F.sinh(2 * j * p["eta"])
        # the sine of the conformal latitude of the step before is as good once they rest
        tangent = F.sin(p["xi"]) / F.sqrt(F.pow(F.sinh(p["eta"]), 2) + F.pow(F.cos(p["xi"]), 2))
        return fields(a, b, p["x0"], p["e0"], F.tanh(F.asinh(tangent)), F.asinh(tangent), F.atan2(F.sinh(p["eta"]), F.cos(p["xi"])))

    def fields(*values: Column) -> Column:
        return F.struct(*[v.alias(n) for n, v in zip(("xi", "eta", "x0", "e0", "s", "q", "dl"), values)])

    # terms shrink by about 0.002 a time, below by 0.007
    zero = F.lit(0.0)
    plane = _settled(fields(xi, eta, xi, eta, zero, zero, zero), step, 8)
    last = _settled(plane, lambda v: fields(v["xi"], v["eta"], v["x0"], v["e0"], F.tanh(v["q"] + c * F.atanh(c * v["s"])), v["q"], v["dl"]), 9)
    return F.degrees(last["dl"]) + (zone * 6 - 183), F.degrees(F.asin(last["s"]))


def moved_box(box: tuple[Column, Column, Column, Column], move: Callable[[Column, Column], tuple[Column, Column]], points: int = 21) -> tuple[Column, Column, Column, Column]:
    """Bounds in another coordinate system of a box (west, south, east, north): of ``points`` places along each of its sides, as sides become curves."""
    west, south, east, north = box
    steps = F.sequence(F.lit(0), F.lit(points - 1))
    t = lambda i: i / float(points - 1)
    between = lambda a, b, i: a + (b - a) * t(i)
    pair = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    sides = F.concat(
        F.transform(steps, lambda i: pair(between(west, east, i), south)), F.transform(steps, lambda i: pair(between(west, east, i), north)),
        F.transform(steps, lambda i: pair(west, between(south, north, i))), F.transform(steps, lambda i: pair(east, between(south, north, i))),
    )
    along = lambda k: F.transform(sides, lambda p: move(p["x"], p["y"])[k])
    xs, ys = along(0), along(1)
    return F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)


def to_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    return F.radians(lon) * MERCATOR_M, MERCATOR_M * F.asinh(F.tan(F.radians(lat)))


def tile_bounds(z: Column, x: Column, y: Column) -> tuple[Column, Column, Column, Column]:
    """West, south, east and north of a web map tile in degrees."""
    n = F.pow(F.lit(2.0), z)

    def north(row: Column) -> Column:
        return F.degrees(F.atan(F.sinh(F.lit(math.pi) * (1 - 2 * row / n))))

    return x / n * 360.0 - 180.0, north(y + 1), (x + 1) / n * 360.0 - 180.0, north(y)


def mercator_pixel(lon: Column, lat: Column, zoom: int, size: int = 256) -> tuple[Column, Column]:
    """Pixel of a point in the world image at a zoom level."""
    scale = float(size * 2**zoom)
    s = F.sin(F.radians(lat))
    return (lon + 180) / 360 * scale, (0.5 - F.log((1 + s) / (1 - s)) / (4 * math.pi)) * scale


def zoom_for(span_degrees: Column, pixels: int = 1024, size: int = 256, highest: int = 18) -> Column:
    """Largest zoom at which a span of longitude fits into so many pixels; the highest for no span."""
    z = F.floor(F.log2(F.try_divide(F.lit(360.0 * pixels / size), span_degrees)))
    return F.greatest(F.lit(0), F.least(F.lit(highest), z)).cast("int")


def in_box(x: Column, y: Column, box: tuple[float, float, float, float]) -> Column:
    """Closed on all sides."""
    west, south, east, north = box
    return x.between(west, east) & y.between(south, north)


def boxes_meet(a: tuple[Column, Column, Column, Column], b: tuple[float, float, float, float]) -> Column:
    west, south, east, north = a
    return ~((east < b[0]) | (west > b[2]) | (north < b[1]) | (south > b[3]))


def corner_box(xs: list[Column], ys: list[Column]) -> tuple[Column, Column, Column, Column]:
    """Bounding box of transformed corners."""
    return F.least(*xs), F.least(*ys), F.greatest(*xs), F.greatest(*ys)


def shoelace_area(ring: Column) -> Column:
    """Area of a ring, an array of struct(x, y), closed or not."""
    n = F.size(ring)
    cross = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.get(ring, i)["x"] * F.get(ring, (i + 1) % n)["y"] - F.get(ring, (i + 1) % n)["x"] * F.get(ring, i)["y"],
    )
    return F.when(n >= 3, F.abs(F.aggregate(cross, F.lit(0.0), lambda a, v: a + v)) / 2).otherwise(0.0)


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Even-odd rule: whether a point lies inside a ring (array of struct(x, y))."""
    n = F.size(ring)

    def crosses(i: Column) -> Column:
        a, b = F.get(ring, i), F.get(ring, (i + 1) % n)
        spans = (a["y"] > y) != (b["y"] > y)
        at = (b["x"] - a["x"]) * (y - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"]
        return (spans & F.coalesce(x < at, F.lit(False))).cast("int")

    hits = F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), crosses), F.lit(0), lambda a, v: a + v)
    return F.coalesce((n >= 3) & (hits % 2 == 1), F.lit(False))


def segment_distance(x: Column, y: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Distance of a point to a segment."""
    dx, dy = x2 - x1, y2 - y1
    t = F.coalesce(((x - x1) * dx + (y - y1) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0)), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    return F.sqrt(F.pow(x - x1 - t * dx, 2) + F.pow(y - y1 - t * dy, 2))


def clip_length_share(x1: Column, y1: Column, x2: Column, y2: Column, box: tuple[Column, Column, Column, Column]) -> Column:
    """Part of a segment's length inside a box, 0 to 1 (parametric clipping)."""
    west, south, east, north = box
    low, high = F.lit(0.0), F.lit(1.0)
    inside = F.lit(True)
    for p, q in ((x1 - x2, x1 - west), (x2 - x1, east - x1), (y1 - y2, y1 - south), (y2 - y1, north - y1)):
        t = q / F.nullif(p, F.lit(0.0))
        low = F.when(p < 0, F.greatest(low, t)).otherwise(low)
        high = F.when(p > 0, F.least(high, t)).otherwise(high)
        inside = inside & ~((p == 0) & (q < 0))
    return F.when(inside & (high > low), high - low).otherwise(0.0)
