"""Coordinate systems there and back, densified boxes, warps."""

import math

import pytest
from pyspark.sql import functions as F

from gridloom.functions import geo
from gridloom.operators import raster


def test_planes_and_back(spark):
    """Within a micrometre, over the whole of the plane's use."""
    places = [(lon / 1.0, lat / 1.0) for lon in range(-24, 45, 7) for lat in range(28, 72, 5)] + [(10.0, 52.0)]
    df = spark.createDataFrame(places, "lon double, lat double")
    x, y = geo.to_laea(F.col("lon"), F.col("lat"))
    u, v = geo.to_utm(F.col("lon") / 10 + 3, F.col("lat"), 31)
    df = df.select("lon", "lat", x.alias("x"), y.alias("y"), u.alias("u"), v.alias("v"))
    a, b = geo.from_laea(F.col("x"), F.col("y"))
    c, d = geo.from_utm(F.col("u"), F.col("v"), 31)
    for r in df.select("lon", "lat", a.alias("a"), b.alias("b"), c.alias("c"), d.alias("d")).collect():
        assert r.a == pytest.approx(r.lon, abs=1e-11) and r.b == pytest.approx(r.lat, abs=1e-11)
        assert r.c == pytest.approx(r.lon / 10 + 3, abs=1e-11) and r.d == pytest.approx(r.lat, abs=1e-11)


def test_densified_box_holds_its_inside(spark):
    """Every place of a box lies in the moved box, which four corners alone don't give."""
    box = (-5.0, 55.0, 25.0, 65.0)
    one = spark.createDataFrame([box], "w double, s double, e double, n double")
    got = one.select(*[c.alias(k) for k, c in zip("abcd", geo.moved_box(tuple(F.col(c) for c in "wsen"), geo.to_laea, 61))]).first()
    inside = spark.range(31 * 31).select((F.col("id") % 31 - 5.0).alias("lon"), (F.floor(F.col("id") / 31) / 3 + 55).alias("lat"))
    x, y = geo.to_laea(F.col("lon"), F.col("lat"))
    m = inside.select(x.alias("x"), y.alias("y")).agg(F.min("x"), F.min("y"), F.max("x"), F.max("y")).first()
    assert got.a <= m[0] + 1e-6 and got.b <= m[1] + 300 and got.c >= m[2] - 1e-6 and got.d >= m[3] - 300
    corners = [geo.to_laea(F.lit(x), F.lit(y))[1] for x in box[::2] for y in box[1::2]]
    lowest = spark.range(1).select(F.least(*corners)).first()[0]
    assert got.b < lowest - 1000


def test_warp_reads_a_window(spark, tmp_path):
    """A constant gradient comes through, and the bounds of the window reach the scan."""
    src = raster.grid(spark, 200, 300, -20.0, 30.0, 0.2, 0.2).select("row", "col", (F.col("x") + 100 * F.col("y")).alias("value"))
    src.write.parquet(f"{tmp_path}/source")
    source = spark.read.parquet(f"{tmp_path}/source")
    target = raster.grid(spark, 20, 30, 4_000_000.0, 3_200_000.0, 10_000.0, -10_000.0)
    for bilinear in (False, True):
        out = raster.warp(source, target, geo.from_laea, -20.0, 30.0, 0.2, 0.2, bilinear)
        plan = out._sc._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
        assert "GreaterThanOrEqual(row" in plan and "LessThanOrEqual(col" in plan
        lon, lat = geo.from_laea(F.col("x"), F.col("y"))
        rows = out.select("value", lon.alias("lon"), lat.alias("lat")).collect()
        assert len(rows) == 600
        for r in rows:
            cell = (math.floor((r.lon + 20) / 0.2) + 0.5) * 0.2 - 20, (math.floor((r.lat - 30) / 0.2) + 0.5) * 0.2 + 30
            want = r.lon + 100 * r.lat if bilinear else cell[0] + 100 * cell[1]
            assert r.value == pytest.approx(want, rel=1e-9)
    assert raster.warp(source, target.limit(0), geo.from_laea, -20.0, 30.0, 0.2, 0.2).count() == 0
