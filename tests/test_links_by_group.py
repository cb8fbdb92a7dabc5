"""Links, orders and totals of sources that are made by groups and places: equal to those of all pairs, and no pair is made without need."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gridloom.functions.numeric import rounded
from gridloom.operators import allocate, export

from .test_pairs_at_size import _shuffled, copy  # noqa: F401


@pytest.fixture(scope="module")
def tables(spark):
    p = [(i, i % 3, "AB"[i % 2] if i % 5 else "", float(i % 7), 1.0 + i % 2, float(i), 2.0 * i) for i in range(300)]
    p += [(300, None, "A", 0.0, 0.0, 1.0, 1.0), (301, 9, "", 0.0, 0.0, 3.0, 1.0), (302, 1, None, 0.5, 0.0, 5.0, 1.0), (303, 4, "", 0.0, 0.0, 7.0, 1.0), (304, 5, "A", 0.0, 0.0, 9.0, 1.0)]
    f = [(i, i % 3, "ABC"[i % 4 % 3], float(i % 4), float(i % 2), float(i % 6), float(i % 5)) for i in range(120)]
    f += [(120, 4, "A", 1.0, 0.0, 0.0, 0.0), (121, 4, "", 0.5, 0.0, 0.0, None), (122, 5, "A", 0.0, 1.0, 0.0, 2.0), (123, 5, "A", 0.0, 0.5, None, 3.0), (124, None, "A", 0.0, 0.0, 1.0, 1.0)]
    return (
        spark.createDataFrame(p, "source_id long, cell_id long, gnfr string, lon double, lat double, nox double, co double"),
        spark.createDataFrame(f, "facility_id long, cell_id long, f_gnfr string, f_lon double, f_lat double, r_nox double, r_co double"),
    )


POLLUTANTS = {"nox": ("nox", "r_nox"), "co": ("co", "r_co")}
BOUNDS = [(4_000_000, 500_000, 8), (50, 500_000, 8), (1_000_000, 10, 8), (50, 10, 8), (50, 500_000, 1000), (50, 10, 1000)]


def bounded(monkeypatch, bounds):
    for name, n in zip(("TASK_PAIRS", "FACILITY_ROWS", "FEW"), bounds):
        monkeypatch.setattr(allocate, name, n)


@pytest.mark.parametrize("bounds", BOUNDS)
def test_links_are_the_candidates(tables, monkeypatch, bounds):
    want = {r.source_id: r.links for r in export.sidecar(allocate.candidates(*tables).withColumn("pollutant", F.lit("nox")).withColumn("attributed", F.col("nox"))).collect()}
    bounded(monkeypatch, bounds)
    link = lambda f: F.struct(f["facility_id"], allocate.distance_to(f).alias("distance_km"), F.lit("nox"), F.col("nox"))
    got = export.nested(allocate.linked(*tables), link).collect()
    assert len(got) == 305 and {r.source_id: [tuple(x) for x in r.links] for r in got} == {k: [tuple(x) for x in v] for k, v in want.items()}
    again = {r.source_id: [tuple(x) for x in r.links] for r in allocate.links_with_distance(*tables).collect()}
    assert again == {k: [tuple(x[:2]) for x in v] for k, v in want.items()}
    assert all(r.n_links == len(r.links) and (r.matched == "yes") == (r.n_links > 0) for r in got)


@pytest.mark.parametrize("bounds", BOUNDS)
def test_order_by_distance(tables, monkeypatch, bounds):
    want: dict = {}
    for r in allocate.candidates(*tables).where("facility_id is not null").orderBy("source_id", "distance_km", "facility_id").collect():
        want.setdefault(r.source_id, []).append(r.facility_id)
    want = sorted((s, f, i + 1) for s, ids in want.items() for i, f in enumerate(ids))
    bounded(monkeypatch, bounds)
    assert sorted(tuple(r) for r in allocate.by_distance(*tables).collect()) == want


def test_totals_without_pairs(spark, tables):
    want: dict = {}
    for r in allocate.proportional_pairs(*tables, POLLUTANTS).collect():
        want[r.source_id, r.pollutant] = want.get((r.source_id, r.pollutant), 0.0) + r.attributed
    rows = allocate.distributed(*tables, POLLUTANTS).collect()
    got = {(r.source_id, p): r[f"got_{p}"] for r in rows for p in POLLUTANTS if r.facility_id is not None}
    assert len(rows) == 305 and got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-9, abs_tol=1e-9) for k in want)


@pytest.mark.parametrize("name", ["lr05_allocation_balance", "rs03_nest_links"])
def test_no_pairs_are_made(spark, copy, name):  # noqa: F811
    from gridloom.plans import registry

    text = registry.queries()[name](spark, copy)._jdf.queryExecution().optimizedPlan().toString()
    assert "ATAN2" not in text


def test_rounding_is_that_of_c(spark):
    rng = random.Random(1)
    v = [0.0, 0.5, 2.5, 1.000005, 0.000005, 0.0000049999999, 1e15, 1e300, 123456.785, -0.5, -1.000005, None, float("nan"), float("inf"), 600.64875] + [rng.uniform(-1e4, 1e4) for _ in range(500)]
    got = [r.r for r in spark.createDataFrame([(i, x) for i, x in enumerate(v)], "i int, v double").orderBy("i").select(rounded(F.col("v"), 5).alias("r")).collect()]
    for x, r in zip(v, got):
        if x is None or not math.isfinite(x) or abs(x) > 1e10:
            assert r is x or r == x or math.isnan(r)
        else:
            a = abs(x) * 1e5
            assert r == math.copysign((math.floor(a) + (a - math.floor(a) >= 0.5)) / 1e5, x)
