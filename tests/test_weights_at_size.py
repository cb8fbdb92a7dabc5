"""Weights of pollutants in cells: as by windows over all pixels, without a pixel in a window or a shuffle of its own."""

import random

import pytest
from pyspark.sql import functions as F

from gridloom.operators import alpha, normalize
from gridloom.plans import domain


@pytest.fixture(scope="module")
def pixels(spark):
    rng = random.Random(3)
    value = lambda: rng.choice([0.0, None, rng.random() * 10])
    rows = [(i, i % 7, rng.choice([-1, 0, 1, 2, 3]), value(), value(), value()) for i in range(400)]
    rows += [(500 + i, i, 9, 0.0, None, 0.0) for i in range(5)]  # a cell without any signal
    return spark.createDataFrame(rows, "row int, col int, cell_id long, a double, b double, c double")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def weights_of(df):
    return {(r.pollutant, r.row, r.col): (r.cell_id, r.weight) for r in df.collect()}


def same(got, want):
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1], rel=1e-12, abs=1e-15) for k in got)


def test_loads_are_mixed_where_their_pixels_are(spark, pixels):
    factors = spark.createDataFrame([("nox", "a", 0.5), ("nox", "b", 2.0), ("pm", "c", 4.0), ("co", "a", 1.0), ("co", "c", 3.0)], "pollutant string, k string, m double")
    loads = {k: F.coalesce(F.col(k), F.lit(0.0)) for k in "abc"}
    long = pixels.select("row", "col", "cell_id", F.explode(F.create_map(*[v for k, load in loads.items() for v in (F.lit(k), load)])).alias("k", "x"))
    u = alpha.product_sum(long, factors, ["k"], ["pollutant", "row", "col", "cell_id"], "x", "m", "u")
    want = weights_of(normalize.weights(u, "u", ["pollutant", "cell_id"]))
    got = normalize.loaded(pixels, loads, factors, ["row", "col"])
    same(weights_of(got), want)
    assert "Window" not in plan_of(got) and "SortMergeJoin" not in plan_of(got)


def test_shares_are_fused_without_windows(spark, pixels):
    mix = spark.createDataFrame([("nox", "g1", 0.7), ("nox", "g2", 0.3), ("nox", "g3", 0.0), ("co", "g2", 1.0), ("so2", "g3", 0.2), ("so2", "g1", 0.2)], "pollutant string, group string, alpha double")
    signals = {"g1": F.col("a"), "g2": F.col("b"), "g3": F.col("c")}
    filled = pixels.fillna(0.0, ["a", "b", "c"])
    shares = [normalize.weights(filled, c, ["cell_id"]).select("row", "col", "cell_id", "weight").withColumn("group", F.lit(g)) for g, c in zip(("g1", "g2", "g3"), "abc")]
    want = weights_of(normalize.fuse(shares[0].unionByName(shares[1]).unionByName(shares[2]), mix, ["row", "col"]))
    got = normalize.fused(pixels, signals, mix, ["row", "col"])
    same(weights_of(got), want)
    assert "Window" not in plan_of(got) and "SortMergeJoin" not in plan_of(got)


def test_pixels_are_made_by_tasks_of_bounded_size(spark, sf, monkeypatch):
    whole = sorted(tuple(r) for r in domain.pixels(spark, sf).collect())
    monkeypatch.setattr(domain, "PIXEL_ROWS", 500)
    rows = domain.t(spark, sf, "lineitem").count()
    p = domain.pixels(spark, sf)
    assert p.rdd.getNumPartitions() == rows // 500 + 1
    again = sorted(tuple(r) for r in p.collect())
    assert [r[:3] for r in again] == [r[:3] for r in whole] and all(a[3:] == pytest.approx(b[3:]) for a, b in zip(again, whole))
