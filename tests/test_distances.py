"""Dilation and exact distances against all pairs."""

import random

import pytest

from gridloom.operators import raster


def pixels(seed, n, size, at=0):
    rng = random.Random(seed)
    return sorted({(rng.randrange(size) + at, rng.randrange(size) + at) for _ in range(n)} | {(at + 3, at + c) for c in range(5)})


def brute(mask, radius):
    r = int(radius)
    out = {}
    for a, b in mask:
        for x in range(a - r, a + r + 1):
            for y in range(b - r, b + r + 1):
                d = (x - a) ** 2 + (y - b) ** 2
                if d <= radius * radius:
                    out[x, y] = min(d, out.get((x, y), d))
    return out


@pytest.mark.parametrize("radius", [0, 1, 2, 2.5, 7, 31])
def test_dilation(spark, radius):
    mask = pixels(1, 30, 60, -20)
    got = [tuple(r) for r in raster.dilate(spark.createDataFrame(mask * 2, "row int, col int"), radius).collect()]
    assert len(got) == len(set(got)) and set(got) == set(brute(mask, radius))


@pytest.mark.parametrize("radius, strip, n", [(0, 64, 20), (3, 8, 40), (9, 16, 200), (40, 4096, 12)])
def test_distances(spark, monkeypatch, radius, strip, n):
    monkeypatch.setattr(raster, "STRIP", strip)
    mask = pixels(2, n, 50, -25)
    got = [tuple(r) for r in raster.distances(spark.createDataFrame(mask * 2, "row int, col int"), radius).collect()]
    assert len(got) == len(set(got))
    assert {(a, b): d for a, b, d in got} == brute(mask, radius)


def test_no_mask(spark):
    empty = spark.createDataFrame([], "row int, col int")
    assert raster.dilate(empty, 3).count() == 0 and raster.distances(empty, 3).count() == 0
