"""Exact ranks and quantiles, statistics beside rows, distance joins round the globe, lookups that must hit."""

import math
import random

import numpy as np
import pytest

from gridloom.operators import allocate, analytics, joins, normalize, ranking
from gridloom.sources import shared


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(3)
    rows = [(g, float(rng.choice([7, 7, 7, rng.randrange(1000), rng.gauss(50, 9)]))) for g in ("a", "b", None) for _ in range(900)]
    rows += [("one", 4.0), ("two", 1.0), ("two", 2.0), ("flat", 5.0), ("flat", 5.0), ("a", None)]
    return rows, spark.createDataFrame(rows, "g string, v double")


def groups(rows):
    out = {}
    for g, v in rows:
        if v is not None:
            out.setdefault(g, []).append(v)
    return out


def test_quantiles_are_exact(numbers):
    rows, df = numbers
    parts = {"q0": 0.0, "q1": 0.01, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q99": 0.99, "q100": 1.0}
    got = {r.g: r for r in ranking.quantiles(df, ["g"], "v", parts).collect()}
    want = {g: v for g, v in groups(rows).items() if g is not None}
    assert set(got) == set(want)
    for g, v in want.items():
        assert [got[g][n] for n in parts] == pytest.approx([np.quantile(v, p) for p in parts.values()], rel=1e-12), g
    every = ranking.quantiles(df, [], "v", {"m": 0.5}).first()
    assert every.m == pytest.approx(np.quantile([v for _, v in rows if v is not None], 0.5))


@pytest.mark.parametrize("down", [False, True])
def test_ranks_and_running_sums(numbers, down):
    rows, df = numbers
    got = {(r.g, r.v): r for r in ranking.ranked(df, ["g"], "v", down).collect()}
    for g, v in groups(rows).items():
        for x in set(v):
            before = [y for y in v if (y > x if down else y < x)]
            r = got[g, x]
            assert (r.times, r.rows_before, r.n) == (v.count(x), len(before), len(v))
            assert math.isclose(r.sum_before, sum(before), rel_tol=1e-9, abs_tol=1e-6) and math.isclose(r.total, sum(v))


def test_spacing(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 1, 2, 4, 8, 8)], "x double")
    assert analytics.spacing(df, "x").first().spacing == 1.5


def test_statistics_beside_rows(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 4.0), (None, 3.0), (None, 5.0)], "g int, v double")
    from pyspark.sql import functions as F

    got = sorted((r.g or 0, r.v, r.s) for r in joins.beside(df, ["g"], F.sum("v").alias("s")).collect())
    assert got == [(0, 3.0, 8.0), (0, 5.0, 8.0), (1, 2.0, 6.0), (1, 4.0, 6.0)]


def test_rows_of_no_cell_weigh_nothing_and_spread(spark):
    rows = [(-1 if i % 2 else i % 6, i, float(i % 5)) for i in range(600)]
    df = spark.createDataFrame(rows, "cell_id long, px long, s double")
    w = {r.px: r.weight for r in normalize.weights(df, "s", ["cell_id"]).collect()}
    assert all(w[i] == 0 for c, i, _ in rows if c < 0)
    for cell in (0, 2, 4):
        assert sum(w[i] for c, i, _ in rows if c == cell) == pytest.approx(1)
    assert df.select(normalize._spread(df).alias("k")).where("k > 0").distinct().count() > 100


def test_pairs_within_distance_anywhere(spark):
    rng = random.Random(8)
    near = [(rng.uniform(-180, 180), rng.choice([rng.uniform(-90, 90), rng.uniform(84, 90), rng.uniform(-90, -85)])) for _ in range(150)]
    near += [(179.99, 10.0), (-179.99, 10.0), (180.0, 10.01), (-180.0, 10.0), (0.0, 90.0), (120.0, 89.99), (10.0, -90.0), (-170.0, -89.9)]
    a = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(near)], "i int, lon double, lat double")
    b = spark.createDataFrame([(i, x + 0.3 if x < 179 else x, y) for i, (x, y) in enumerate(near)], "j int, f_lon double, f_lat double")

    def km(p, q):
        f, g = math.radians(p[1]), math.radians(q[1])
        h = math.sin((g - f) / 2) ** 2 + math.cos(f) * math.cos(g) * math.sin(math.radians(q[0] - p[0]) / 2) ** 2
        return 2 * 6371 * math.atan2(math.sqrt(h), math.sqrt(1 - h))

    for most in (40.0, 700.0):
        want = {(i, j) for i, p in enumerate(near) for j, q in enumerate(near) if km(p, (q[0] + 0.3 if q[0] < 179 else q[0], q[1])) <= most}
        got = [(r.i, r.j) for r in allocate.within_distance(a, b, most).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_lookup_that_must_hit(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    table = spark.createDataFrame([(1, 10.0), (2, None)], "k int, h double")
    assert [r.h for r in joins.required(df, table, "k", "h").orderBy("k").collect()] == [10.0, None]
    with pytest.raises(Exception, match="no h for k 3"):
        joins.required(df.union(spark.createDataFrame([(3,)], "k int")), table, "k", "h").collect()


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, name, default):
            return default

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077"})

    with pytest.raises(RuntimeError, match="checkpoint"):
        shared.shared_folder(Session())


def test_lines_without_a_target_stay(spark):
    from gridloom.operators import lines

    l = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "pollutant string, x double")
    t = spark.createDataFrame([("a", 8.0)], "pollutant string, total double")
    assert sorted(tuple(r) for r in lines.correct_mass(l, t, "x").collect()) == [("a", 2.0), ("a", 6.0), ("b", 5.0)]
