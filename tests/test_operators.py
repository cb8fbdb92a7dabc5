"""Hand-computed cases and invariants of the operators."""

import itertools
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridloom.functions import geo, numeric, text
from gridloom.operators import allocate, alpha, analytics, assign, cells, cube, export, legacy, lines, normalize, raster, rules, signals
from gridloom.plans import domain
from gridloom.sources import readers, writers
from gridloom.streaming import detections


def one(spark, *columns):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def test_cell_lookup_is_half_open(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.5), (2.0, 0.5), (0.5, 1.5), (-0.1, 0.0)], "lon double, lat double")
    got = [r.c for r in df.select(cells.regular_cell(F.col("lon"), F.col("lat"), 0.0, 0.0, 1.0, 1.0, 2, 2).alias("c")).collect()]
    assert got == [0, 1, -1, 2, -1]


def test_weights_micro(spark):
    rows = [(7, 1.0), (7, 3.0), (7, None), (8, 0.0), (8, 0.0), (-1, 9.0), (9, None)]
    got = normalize.weights(spark.createDataFrame(rows, "cell_id long, s double"), "s", ["cell_id"]).collect()
    by = sorted((r.cell_id, r.weight) for r in got)
    assert by == [(-1, 0.0), (7, 0.0), (7, 0.25), (7, 0.75), (8, 0.5), (8, 0.5), (9, 0.0)]


def test_cell_score_micro(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 4.0), (1, 6.0), (2, 5.0), (3, 3.0), (3, 3.0), (3, 0.0)], "cell_id long, v double")
    got = sorted((r.cell_id, r.v, r.z) for r in normalize.cell_score(df, "v", "z").collect())
    assert got == [(1, 2.0, 0.0), (1, 4.0, 0.5), (1, 6.0, 1.0), (2, 5.0, 1.0), (3, 0.0, 0.0), (3, 3.0, 1.0), (3, 3.0, 1.0)]


def _links(reports):
    return [("s", f, d, p, m, r) for f, d, p, m, r in reports]


SCHEMA = "source_id string, facility_id string, distance_km double, pollutant string, mass double, reported double"


def test_proportional_micro(spark):
    rows = _links([("F1", 1.0, "nox", 100.0, 30.0), ("F2", 2.0, "nox", 100.0, 10.0), ("F1", 1.0, "co", 10.0, 0.0), ("F2", 2.0, "co", 10.0, None)])
    got = {(r.facility_id, r.pollutant): (r.attributed, r.flag) for r in allocate.proportional(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[("F1", "nox")] == (75.0, None) and got[("F2", "nox")] == (25.0, None)
    assert got[("F1", "co")] == (7.5, "zero_facility_total_co") and got[("F2", "co")][0] == 2.5
    rows = _links([("F1", 1.0, "nox", 100.0, 0.0), ("F2", 2.0, "nox", 100.0, 0.0)])
    got = {r.facility_id: r.attributed for r in allocate.proportional(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {"F1": 100.0, "F2": 0.0}


def test_proportional_conserves_mass(spark):
    rng = np.random.default_rng(1)
    rows = [(f"s{i}", f"f{j}", float(rng.random()), p, m, float(rng.choice([0.0, 5.0, 9.0]))) for i in range(20) for p, m in (("a", 3.0 + i), ("b", 1.0)) for j in range(1 + i % 4)]
    got = allocate.proportional(spark.createDataFrame(rows, SCHEMA)).groupBy("source_id", "pollutant").agg(F.sum("attributed").alias("s"), F.max("mass").alias("m")).collect()
    assert all(math.isclose(r.s, r.m) for r in got)


def test_gini_and_lorenz(spark):
    df = spark.createDataFrame([("a", i, 1.0) for i in range(4)] + [("b", 0, 0.0), ("b", 1, 1.0), ("b", 2, 3.0)], "g string, i int, v double")
    got = {r.g: r.gini for r in analytics.gini(df, ["g"], "v").collect()}
    assert math.isclose(got["a"], 0, abs_tol=1e-12) and math.isclose(got["b"], 0.25)
    df = spark.createDataFrame([("c", 0, 8.0), ("c", 1, 1.0), ("c", 2, 1.0)], "g string, i int, v double")
    assert math.isclose(analytics.reaching(df, ["g"], "v").first().reach, 200 / 3)


def test_line_shares_micro(spark):
    df = spark.createDataFrame([(1, "motorway", 1.0), (1, "motorway", 3.0), (1, "primary", 2.0), (1, None, 5.0)], "cell_id int, group string, len double").withColumn("mass", F.lit(120.0))
    assert sorted(round(r.line_mass, 9) for r in lines.line_shares(df, "len", "mass").collect()) == [20.0, 25.0, 75.0]


def test_snap_and_truncation(spark):
    r = one(spark, numeric.snap(F.lit(1999.9), 1000), numeric.snap(F.lit(-1.0), 1000), numeric.truncated_index(F.lit(-0.5), 0.0, 1.0), numeric.floor_index(F.lit(-0.5), 0.0, 1.0))
    assert (r.c0, r.c1, r.c2, r.c3) == (1000, -1000, 0, -1)


def test_projections(spark):
    x, y = geo.to_laea(F.lit(5.0), F.lit(50.0))
    e, n = geo.to_utm(F.lit(21.0), F.lit(0.0), 34)
    r = one(spark, x, y, e, n, geo.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0)))
    # published check values of the projection
    assert abs(r.c0 - 3962799.45) < 0.01 and abs(r.c1 - 2999718.85) < 0.01
    assert abs(r.c2 - 500000) < 1e-6 and abs(r.c3) < 1e-6
    assert math.isclose(r.c4, 6371 * math.pi / 2)


def test_rules(spark):
    rows = [({"landuse": "industrial", "name": "Raffinerie X"}, True), ({"landuse": "industrial"}, False), ({}, False)]
    df = spark.createDataFrame(rows, "tags map<string,string>, want boolean")
    rule = {"all_of": [{"tag": {"key": "landuse", "equals": "industrial"}}, {"name_regex": "refinery|raffinerie"}]}
    assert all(r.want == r.got for r in df.withColumn("got", rules.tag_rule(rule, F.col("tags"))).collect())
    rail = {"all_of": [{"tag": {"key": "railway", "in": ["rail"]}}, {"not": {"any_of": [{"tag": {"key": "electrified", "in": [True]}}]}}]}
    df = spark.createDataFrame([({"railway": "rail"}, True), ({"railway": "rail", "electrified": "yes"}, False)], "tags map<string,string>, want boolean")
    assert all(r.want == r.got for r in df.withColumn("got", rules.tag_rule(rail, F.col("tags"))).collect())
    empty = spark.createDataFrame([({"military": ""},)], "tags map<string,string>")
    assert not empty.select(rules.tag_rule({"tag": {"key": "military", "exists": True}}, F.col("tags")).alias("x")).first().x
    assert empty.select(rules.tag_rule(None, F.col("tags")).alias("a"), rules.candidate(None, F.col("tags")).alias("b")).first()[:] == (True, False)
    with pytest.raises(ValueError):
        rules.tag_rule({"odd": 1}, F.col("tags"))


def test_cube_micro(spark):
    text_ = '{"id":["a","b"],"size":[2,3],"value":{"4":9.0},"dimension":{"a":{"category":{"index":{"x":0,"y":1}}},"b":{"category":{"index":{"p":0,"q":1,"r":2}}}}}'
    df = spark.createDataFrame([(text_,)], "j string").select(F.from_json("j", cube.SCHEMA).alias("c")).select("c.*")
    assert [tuple(r) for r in cube.unroll(df, ["a", "b"]).collect()] == [("y", "q", 9.0)]


def test_alpha_methods(spark):
    e = spark.createDataFrame([("A", "p", "g1", 3.0), ("A", "p", "g2", 1.0), ("B", "p", "g1", 1.0), ("B", "p", "g2", 0.0), ("C", "p", "g1", 1.0), ("C", "p", "g2", 1.0), ("D", "p", "g1", 0.0), ("D", "p", "g2", 0.0)], "country string, pollutant string, group string, E double")

    def got(method, country, members=None):
        m = spark.createDataFrame([("p", method)], "pollutant string, method int")
        return {r.group: r.alpha for r in alpha.alpha_matrix(e, m, country, members=members).collect()}

    assert got(0, "A") == {"g1": 0.75, "g2": 0.25}
    assert got(3, "A") == {"g1": 0.5, "g2": 0.5}
    assert got(1, "A", ["B", "C"]) == {"g1": 0.75, "g2": 0.25}
    assert math.isclose(sum(got(0, "D").values()), 1)
    with pytest.raises(Exception, match="no such alpha method"):
        got(4, "A")


def test_housing_factor(spark):
    df = spark.createDataFrame([("r", 10.0, 100.0, 1.0, 0.5), ("r", 10.0, 100.0, 1.0, 1.0), ("s", 0.0, 100.0, 1.0, 1.0)], "k string, heads double, live_weight double, n_rate double, housed double")
    assert {r.k: r.factor for r in signals.housing_factor(df, "k").collect()} == {"r": 0.75, "s": 0.6}


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 5), st.integers(0, 3), st.integers(0, 10_000))
def test_assignment_is_optimal(n, more, seed):
    cost = np.random.default_rng(seed).integers(0, 30, (n, n + more)).astype(float)
    got = assign.solve(cost)
    assert len(set(got)) == n
    best = min(cost[np.arange(n), list(p)].sum() for p in itertools.permutations(range(n + more), n))
    assert cost[np.arange(n), got].sum() == best


def test_assignment_skips_far_pairs(spark):
    df = spark.createDataFrame([(1, "a", "x", 1.0), (1, "b", "x", 2.0), (1, "b", "y", 99.0)], "cell long, source_id string, facility_id string, cost double")
    assert [tuple(r) for r in assign.assign(df, "cell", 10.0).collect()] == [(1, "a", "x", 1.0)]


def test_assignment_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = {(g, s, f): float(rng.integers(0, 14)) for g in (1, 2, None) for s in range(6) for f in range(5) if rng.random() < 0.45}
    rows |= {(3, 0, 0): 10.0, (3, 1, 0): 10.5}
    schema = "cell long, source_id long, facility_id long, cost double"
    odd = [(1, None, 1, 1.0), (1, 1, None, 1.0), (2, 1, 1, None), (4, 9, 9, 99.0)]
    twice = [(*k, c) for k, c in rows.items()] * 2
    got = assign.assign(spark.createDataFrame(twice + odd, schema), "cell", 10.0).collect()
    assert all(rows[r.cell, r.source_id, r.facility_id] == r.cost <= 10 for r in got)
    for g in (1, 2, 3, None):
        mine = [r for r in got if r.cell == g]
        sources = sorted({s for h, s, _ in rows if h == g})
        assert len({r.source_id for r in mine}) == len(mine) == len({r.facility_id for r in mine})
        total = sum(r.cost for r in mine) + 11 * (len(sources) - len(mine))
        ways = _ways(len(sources), 5)
        best = min(sum(11 if f is None else c if (c := rows.get((g, s, f), 1e9)) <= 10 else 1e9 for s, f in zip(sources, p)) for p in ways)
        assert total == best
    assert {r.cell for r in got} == {1, 2, 3, None}
    whole = assign.assign(spark.createDataFrame([(s, f, c) for (g, s, f), c in rows.items() if g == 1], "source_id long, facility_id long, cost double"), None, 10.0)
    assert sum(r.cost for r in whole.collect()) == sum(r.cost for r in got if r.cell == 1)
    assert assign.assign(spark.createDataFrame([], schema), "cell", 10.0).count() == 0


def _ways(sources, facilities):
    """Every choice of different facilities or None for so many sources."""
    if not sources:
        return [()]
    return [(*w, f) for w in _ways(sources - 1, facilities) for f in (None, *range(facilities)) if f is None or f not in w]


def test_raster(spark):
    src = spark.createDataFrame([(0, 0, 1.0), (0, 1, 3.0), (1, 0, 5.0)], "row int, col int, value double")
    at = spark.createDataFrame([(1.0, 1.0), (9.0, 9.0)], "x double, y double")
    got = {(r.x, r.y): r.value for r in raster.resample_bilinear(src, at, 0.0, 0.0, 1.0, 1.0).collect()}
    assert got == {(1.0, 1.0): 3.0, (9.0, 9.0): None}
    mask = spark.createDataFrame([(0, 0), (0, 1), (1, 2), (3, 3), (5, 5), (5, 6), (5, 5)], "row int, col int")
    got = sorted((r.n, r.row, r.col) for r in raster.patches(mask, 2).collect())
    assert got == [(2, 5.0, 5.5), (3, 1 / 3, 1.0)]
    assert raster.dilate(spark.createDataFrame([(0, 0)], "row int, col int"), 1).count() == 5
    assert raster.output_grid(0.5, 0.5, 9.5, 9.5, 1.0, 5.0, (0.0, 10.0)) == (0.0, 10.0, 2, 2)


def test_polygons(spark):
    p = lambda x, y: F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"))
    ring = F.array(p(0, 0), p(4, 0), p(4, 4), p(0, 4))
    box = (F.lit(1.0), F.lit(0.0), F.lit(3.0), F.lit(1.0))
    r = one(spark, geo.shoelace_area(ring), geo.in_ring(F.lit(1.0), F.lit(1.0), ring), geo.in_ring(F.lit(5.0), F.lit(1.0), ring), geo.clip_length_share(F.lit(0.0), F.lit(0.5), F.lit(4.0), F.lit(0.5), box), geo.segment_distance(F.lit(2.0), F.lit(3.0), F.lit(0.0), F.lit(0.0), F.lit(4.0), F.lit(0.0)))
    assert r[:] == (16.0, True, False, 0.5, 3.0)


def test_domain_classes(spark):
    t, f, n = F.lit(True), F.lit(False), F.lit(None).cast("boolean")
    r = one(spark, *[allocate.domain_class(a, b) for a, b in ((t, t), (t, f), (f, t), (f, f), (t, n), (f, n))])
    assert r[:] == ("matched_appointed", "matched_not_appointed", "matched_not_appointed", None, "unmatched", None)


def test_downscale_conserves_mass(spark):
    rng = np.random.default_rng(2)
    px = spark.createDataFrame([(int(c), float(v)) for c, v in zip(rng.integers(0, 5, 200), rng.random(200))], "cell_id long, s double")
    mass = spark.createDataFrame([(c, 10.0 + c) for c in range(5)], "cell_id long, mass double")
    total = export.downscale(normalize.weights(px, "s", ["cell_id"]), mass).agg(F.sum("emission")).first()[0]
    assert math.isclose(total, sum(10.0 + c for c in range(5)), rel_tol=1e-9)


def test_sector_recode_keeps_mass(spark):
    df = spark.createDataFrame([(s, 10.0) for s in legacy.AREA_SNAP], "sector string, emission double")
    assert math.isclose(export.map_sectors(df, legacy.AREA_SNAP).agg(F.sum("emission")).first()[0], 10.0 * len(legacy.AREA_SNAP))


def test_text_helpers(spark):
    r = one(spark, text.number(F.lit("1,5")), text.number(F.lit("n.a")), text.scientific(F.lit(2340.0)), text.blend(F.lit(2.0), (0, 0, 0), (255, 16, 0)), text.road_group(F.lit("Trunk_Link")))
    assert r[:] == (1.5, None, "2.3×10^3", "#ff1000", "trunk")


def test_files(spark, tmp_path):
    df = spark.createDataFrame([("A", "nox", 1, 2, 0.5), ("B", "co", 3, 4, 0.25)], "sector string, pollutant string, row int, col int, weight double")
    writers.weight_table(df, f"{tmp_path}/w")
    back = spark.read.parquet(f"{tmp_path}/w").where("sector = 'A'")
    assert [r.weight for r in back.collect()] == [0.5]
    e = spark.createDataFrame([("nox", 1.0, 2.0, 3.0), ("nox", 1.0, 2.0, 0.0)], "pollutant string, x double, y double, emission double")
    writers.grid_csv(e, f"{tmp_path}/g")
    assert readers.csv(spark, f"{tmp_path}/g", "pollutant string, x double, y double, emission double").count() == 1
    with pytest.raises(ValueError):
        writers.layers(spark.createDataFrame([], "layer string, id int"), f"{tmp_path}/l")


def test_stream_equals_batch(spark, tmp_path, sf):
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "ts", (F.col("user_id") % 25).alias("cell"), "value")
    events.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 3).parquet(f"{tmp_path}/in")
    q = detections.tumbling_max(stream, late="60 days").writeStream.outputMode("complete").format("memory").queryName("peaks").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/c").start()
    q.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.sql("SELECT * FROM peaks").collect())
    assert got == sorted(tuple(r) for r in detections.tumbling_max(events).collect())


def test_shift_and_latest(spark):
    df = spark.createDataFrame([(1,), (3,)], "i int")
    assert sorted(r.i for r in cells.shift_to_zero(df, "i", 3).collect()) == [0, 2]
    df = spark.createDataFrame([("a", 2019, 1), ("a", 2020, 5), ("a", 2020, 4)], "k string, y int, v int")
    assert cells.latest_per_key(df, "k", "y", "v").first()[:] == ("a", 2020, 4)


def test_tables_beyond_the_broadcast_bound_stay_whole(spark, monkeypatch):
    for module, name in ((legacy, "CELL_ROWS"), (lines, "TARGET_ROWS"), (raster, "CODE_ROWS"), (cells, "AXIS_ROWS")):
        assert hasattr(module, name)
        monkeypatch.setattr(module, name, 3)
    # closed bounds: cells of one by one, a wide one over all, one of no width; facilities on edges and corners
    boxes = [(10 * r + c, float(c - 2), float(r - 2), float(c - 1), float(r - 1)) for r in range(4) for c in range(4)]
    boxes += [(90, -2.0, -2.0, 2.0, 2.0), (91, 0.5, -9.0, 0.5, 9.0), (92, 1.0, 0.0, -1.0, 2.0), (93, None, 0.0, 1.0, 1.0)]
    places = [(i, "A", x / 2, y / 2) for i, (x, y) in enumerate(itertools.product(range(-5, 6), repeat=2))] + [(999, "A", None, 0.0)]
    f = spark.createDataFrame(places, "facility_id int, sector string, f_lon double, f_lat double")
    s = spark.createDataFrame([(b[0], "A") for b in boxes], "cell_id int, sector string")
    c = spark.createDataFrame(boxes, "cell_id int, west double, south double, east double, north double")
    got = sorted((r.cell_id, r.facility_id) for r in legacy.closed_candidates(s, f, c).where("facility_id is not null").collect())
    known = [(b, p) for b, p in itertools.product(boxes, places) if None not in b and p[2] is not None]
    assert got == sorted((b[0], p[0]) for b, p in known if b[1] <= p[2] <= b[3] and b[2] <= p[3] <= b[4])
    # lines of more pollutants than the bound
    rows = spark.range(20).select(F.col("id").cast("string").alias("pollutant"), F.lit(2.0).alias("x"))
    target = spark.range(20).select(F.col("id").cast("string").alias("pollutant"), F.col("id").cast("double").alias("total"))
    assert sorted(r.x for r in lines.correct_mass(rows, target, "x").collect()) == [float(i) for i in range(20)]
    codes = spark.range(20).select(F.col("id").cast("int").alias("idx"), (F.col("id") + 100).cast("int").alias("l3"))
    assert sorted(r.l3 for r in raster.classes(spark.range(20).select(F.col("id").cast("int").alias("idx")), codes).collect()) == list(range(100, 120))
    lon = spark.range(20).select(F.col("id").cast("int").alias("lon_idx"), F.col("id").cast("double").alias("west"), (F.col("id") + 1.0).alias("east"))
    lat = spark.range(2).select(F.col("id").cast("int").alias("lat_idx"), F.col("id").cast("double").alias("south"), (F.col("id") + 1.0).alias("north"))
    assert sorted(r.cell_id for r in cells.cell_centres(lon, lat, 20).collect()) == list(range(40))


def test_reported_view_with_more_nations_than_the_bound(spark, sf, monkeypatch):
    monkeypatch.setattr(domain, "NATION_ROWS", 3)
    assert domain.reported(spark, sf).count() == domain.t(spark, sf, "orders").count()


def test_sparse_assignment_equals_dense():
    rng = np.random.default_rng(8)
    for n, m, share in ((1, 1, 1.0), (6, 4, 0.5), (30, 20, 0.2), (40, 60, 0.1), (25, 25, 1.0), (5, 3, 0.0)):
        for whole in (True, False):
            cost = rng.integers(0, 30, (n, m)).astype(float) if whole else rng.random((n, m)) * 30
            pairs = rng.random((n, m)) < share
            dense = np.full((n, m + n), 1e9)
            dense[:, :m][pairs] = cost[pairs]
            dense[np.arange(n), m + np.arange(n)] = 21.0
            row, col = np.nonzero(pairs)
            got = assign.solve_sparse(np.searchsorted(row, np.arange(n + 1)), col, cost[pairs], 21.0, m)
            used = got[got >= 0]
            assert len(set(used.tolist())) == len(used) and all(pairs[i, j] for i, j in enumerate(got) if j >= 0)
            total = sum(cost[i, j] if j >= 0 else 21.0 for i, j in enumerate(got))
            best = dense[np.arange(n), assign.solve(dense)].sum()
            assert abs(total - best) < 1e-9


def test_large_part_is_solved_on_its_pairs():
    """20,000 sources that all hang together, near facilities on a line: a dense matrix would take 6.4 GB."""
    rng = np.random.default_rng(9)
    n = 20_000
    at, to = np.sort(rng.random(n)) * n, np.sort(rng.random(n)) * n
    low = np.searchsorted(to, at - 4)
    high = np.searchsorted(to, at + 4)
    first = np.concatenate(([0], np.cumsum(high - low)))
    cols = np.concatenate([np.arange(a, b) for a, b in zip(low, high)])
    cost = np.abs(np.repeat(at, high - low) - to[cols])
    got = assign.solve_sparse(first, cols, cost, 5.0, n)
    assert (got >= 0).mean() > 0.7 and len(set(got[got >= 0].tolist())) == (got >= 0).sum()
