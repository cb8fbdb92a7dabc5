"""Queries over sources and their facilities on repeated tables: right by their SQL, and no pair is shuffled or made without need."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from gridloom.operators import allocate, assign
from gridloom.plans import domain, registry

from .compare import check, connect

#: Rows shuffled at most; the copy has 6000 sources, 400 facilities and about 48,000 pairs.
MOST = 30_000
NAMES = [
    "ag24_mean_shares",
    "dc15_closest_only",
    "dc15_proportional",
    "dc17_gap_fill",
    "dc18_deposit_separate",
    "lr05_allocation_balance",
    "rs03_links_and_back",
    "rs03_nest_links",
    "sk03_sidecar_json",
    "sk03_sidecar_round_trip",
    "jn12_nearest",
    "st02_by_distance",
    "dc16_domain_classes",
    "jn08_facility_candidates",
    "h27_any_matched",
    "dc14_two_stage",
    "jn09_unmatched",
    "dc18_deposit_facility_or_drop",
    "ag38_match_statistics",
    "jn10_within_distance",
    "h22_register_or_none",
]


@pytest.fixture(scope="module")
def copy(tmp_path_factory):
    """sf0.01 with customers and suppliers four times."""
    src, out = "/root/testdata/sf0.01", tmp_path_factory.mktemp("copy")
    for f in os.listdir(src):
        os.symlink(f"{src}/{f}", out / f)
    for t, k, n in (("customer", "c_custkey", 1500), ("supplier", "s_suppkey", 100)):
        (out / f"{t}.parquet").unlink()
        duckdb.sql(f"COPY (SELECT * REPLACE ({k} + i * {n} AS {k}) FROM '{src}/{t}.parquet', range(4) r(i)) TO '{out}/{t}.parquet' (FORMAT parquet)")
    return str(out)


def _shuffled(spark, seen):
    """Rows written to shuffles by stages not seen before."""
    sc = spark.sparkContext
    found = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
    new = [s for s in (found.apply(i) for i in range(found.size())) if s.stageId() not in seen]
    seen.update(s.stageId() for s in new)
    return sum(s.shuffleWriteRecords() for s in new)


@pytest.mark.parametrize("name", NAMES)
def test_pairs_stay_where_they_are(spark, copy, monkeypatch, name):
    monkeypatch.setattr(allocate, "TASK_PAIRS", 20_000, raising=False)
    check(registry.queries()[name](spark, copy), connect(copy), registry.oracle_sql()[name])
    seen = set()
    _shuffled(spark, seen)
    registry.queries()[name](spark, copy).write.format("noop").mode("overwrite").save()
    assert _shuffled(spark, seen) < MOST


def test_places_make_few_pairs(spark):
    p = [(i, i % 3, "A" if i % 2 else "", float(i % 5), 1.0, 2.0) for i in range(600)] + [(600, None, "A", 0.0, 0.0, 1.0), (601, 9, "", 0.0, 0.0, 1.0)]
    f = [(i, i % 3, "ABC"[i % 3], float(i % 4), float(i % 2)) for i in range(300)]
    p = spark.createDataFrame(p, "source_id long, cell_id long, gnfr string, lon double, lat double, nox double")
    f = spark.createDataFrame(f, "facility_id long, cell_id long, f_gnfr string, f_lon double, f_lat double")
    assert allocate.place_pairs(p, f, "nox").count() < 200
    near = {r.source_id: (r.facility_id, r.distance_km) for r in allocate.nearest_candidate(p, f).collect()}
    n = {r.source_id: r.n_links for r in allocate.counted(p, f).collect()}
    best, many = dict.fromkeys(range(602), (None, None)), dict.fromkeys(range(602), 0)
    for r in allocate.candidates(p, f).where("facility_id is not null").collect():
        many[r.source_id] += 1
        was = best[r.source_id]
        if was[0] is None or (r.distance_km, r.facility_id) < (was[1], was[0]):
            best[r.source_id] = (r.facility_id, r.distance_km)
    assert near == best and n == many


def test_facilities_beyond_the_broadcast(spark, copy, monkeypatch):
    monkeypatch.setattr(allocate, "TASK_PAIRS", 20_000)
    monkeypatch.setattr(allocate, "FACILITY_ROWS", 10)
    check(registry.queries()["dc15_proportional"](spark, copy), connect(copy), registry.oracle_sql()["dc15_proportional"])


@pytest.mark.parametrize("name", ["jn11_assignment", "jn11_assignment_by_distance"])
def test_assignment_of_places_costs_as_much_as_of_points(spark, copy, name):
    p, f = domain.points(spark, copy), domain.facilities(spark, copy)
    group, most = ("cell_id", 150.0) if name == "jn11_assignment" else (None, 25.0)
    pairs = allocate.candidates(p, f) if group else allocate.within_distance(p, f.drop("cell_id"), most)
    pairs = pairs.where("facility_id IS NOT NULL").withColumn("cost", F.round("distance_km", 9))
    cost = {(r.source_id, r.facility_id): r.cost for r in pairs.collect()}
    want, got = assign.assign(pairs, group, most).collect(), registry.queries()[name](spark, copy).collect()
    assert len({r.source_id for r in got}) == len({r.facility_id for r in got}) == len(got) == len(want)
    assert sum(cost[r.source_id, r.facility_id] for r in got) == pytest.approx(sum(r.cost for r in want), rel=1e-6)
