"""Edges, covers, clipping and nearest facilities against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gridloom.operators import nearest, spatial

EDGE = "id long, x1 double, y1 double, x2 double, y2 double"


def star(rng, x, y, r, n, turned=False):
    """Corners of a star-shaped ring, against the clock unless turned."""
    at = [(k + 0.8 * rng.random()) * 2 * math.pi / n for k in range(n)]
    ring = [(x + math.cos(a) * r * (0.4 + 0.6 * rng.random()), y + math.sin(a) * r * (0.4 + 0.6 * rng.random())) for a in at]
    return ring[::-1] if turned else ring


def edges(i, ring):
    return [(i, *map(float, (*a, *b))) for a, b in zip(ring, ring[1:] + ring[:1])]


def shapes(rng, n, size, corners):
    """Polygons, some with a hole or a second part, as rows of edges."""
    out = []
    for i in range(n):
        x, y = rng.random() * size, rng.random() * size
        ring = [(x + math.cos(2 * math.pi * k / corners) * 4, y + math.sin(2 * math.pi * k / corners) * (3 + k % 2)) for k in range(corners)]
        out += edges(i, ring)
        if i % 2:
            out += edges(i, star(rng, x, y, 1.5, 7, turned=True))
        if i % 3 == 0:
            out += edges(i, star(rng, x + 9.3, y + 1.7, 3, 9))
    return out


def holds(own, x, y):
    return sum((y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 for _, x1, y1, x2, y2 in own) % 2 == 1


def meets(e, west, south, east, north):
    """Whether a segment meets a box, by clipping it."""
    _, x1, y1, x2, y2 = e
    low, high = 0.0, 1.0
    for p, q in ((x1 - x2, x1 - west), (x2 - x1, east - x1), (y1 - y2, y1 - south), (y2 - y1, north - y1)):
        if p == 0:
            if q < 0:
                return False
        elif p < 0:
            low = max(low, q / p)
        else:
            high = min(high, q / p)
    return low <= high


def by_id(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


@pytest.mark.parametrize("step", [1.0, 0.37])
def test_burning_equals_box_tests(spark, step):
    rows = shapes(random.Random(1), 8, 20, 11)
    n = int(30 / step)
    got = {tuple(r) for r in spatial.burn(spark.createDataFrame(rows, EDGE), step, (-2, n), (-3, n)).collect()}
    want = {
        (i, r, c) for i, own in by_id(rows).items() for r in range(-2, n + 1) for c in range(-3, n + 1)
        if holds(own, (c + 0.5) * step, (r + 0.5) * step) or any(meets(e, c * step, r * step, (c + 1) * step, (r + 1) * step) for e in own)
    }
    assert got == want
    centres = {tuple(r) for r in spatial.burn(spark.createDataFrame(rows, EDGE), step, (-2, n), (-3, n), touched=False).collect()}
    assert centres == {(i, r, c) for i, own in by_id(rows).items() for r in range(-2, n + 1) for c in range(-3, n + 1) if holds(own, (c + 0.5) * step, (r + 0.5) * step)}


def test_rings_and_layers(spark):
    rings = [(1, [(0.1, 0.1), (2.9, 0.2), (2.8, 2.9)]), (2, [(1.1, 1.1), (1.9, 1.2), (1.8, 1.9), (1.1, 1.1)]), (3, [(5.5, 0.5)]), (4, []), (5, None)]
    e = spatial.ring_edges(spark.createDataFrame(rings, "id long, ring array<struct<x:double,y:double>>"), "ring")
    assert sorted(r.id for r in e.collect()) == [1, 1, 1, 2, 2, 2]
    burnt = spatial.burn(e, 1.0, (0, 9), (0, 9)).withColumn("value", F.col("id") * 1.0)
    got = {(r.row, r.col): r.value for r in spatial.rasterised(burnt, ["id"], "value").collect()}
    assert got[1, 1] == 2.0 and got[0, 0] == 1.0 and (2, 0) not in got
    foot = spark.createDataFrame([(0, 0), (0, 0), (7, 7)], "row int, col int")
    assert [tuple(r) for r in spatial.rasterised(burnt, ["id"], "value", foot).collect()] == [(0, 0, 1.0)]


@pytest.mark.parametrize("size, most", [(8.0, 3), (2.0, 64), (100.0, 5)])
def test_polygons_of_points(spark, size, most):
    rng = random.Random(2)
    rows = shapes(rng, 12, 30, 40)
    cover = spatial.Cover(spark.createDataFrame(rows, EDGE), size, most)
    pts = [(k, rng.uniform(-8, 45), rng.uniform(-8, 45)) for k in range(1500)]
    got = {(r.k, r.polygon) for r in spatial.polygons_of(spark.createDataFrame(pts, "k int, x double, y double"), cover).collect()}
    assert got == {(k, i) for i, own in by_id(rows).items() for k, x, y in pts if holds(own, x, y)}
    assert len(got) > 100
    if size == 8.0:  # the leaves are small and no cell is in two levels
        assert cover.cells.agg(F.max(F.size("edges"))).first()[0] <= 3 or max(cover.levels) == spatial.MOST_LEVELS
        assert len(cover.levels) > 2


def test_empty_cover(spark):
    cover = spatial.Cover(spark.createDataFrame([], EDGE), 1.0)
    assert spatial.polygons_of(spark.createDataFrame([(1.0, 1.0)], "x double, y double"), cover).count() == 0
    line = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 1.0)], EDGE)
    assert spatial.clip_lines(line, spark.createDataFrame([], EDGE), 1.0).count() == 0


def common_area(a, b):
    """Area that two polygons share, exact: between two heights at which nothing begins, ends or crosses it grows evenly."""
    ys = {y for _, _, y1, _, y2 in a + b for y in (y1, y2)}
    for _, x1, y1, x2, y2 in a + b:
        for _, x3, y3, x4, y4 in a + b:
            d = (x2 - x1) * (y4 - y3) - (y2 - y1) * (x4 - x3)
            if abs(d) > 1e-15:
                t = ((x3 - x1) * (y4 - y3) - (y3 - y1) * (x4 - x3)) / d
                if 0 <= t <= 1:
                    ys.add(y1 + t * (y2 - y1))
    ys, total = sorted(ys), 0.0
    for low, high in zip(ys, ys[1:]):
        y = (low + high) / 2
        cross = lambda own: sorted((x2 - x1) * (y - y1) / (y2 - y1) + x1 for _, x1, y1, x2, y2 in own if (y1 > y) != (y2 > y))  # noqa: B023, E731
        ca, cb = cross(a), cross(b)
        for p in range(0, len(ca), 2):
            for q in range(0, len(cb), 2):
                total += max(0.0, min(ca[p + 1], cb[q + 1]) - max(ca[p], cb[q])) * (high - low)
    return total


@pytest.mark.parametrize("size, most", [(5.0, 64), (40.0, 6)])
def test_clipped_area(spark, monkeypatch, size, most):
    monkeypatch.setattr(spatial, "MOST_EDGES", most)
    rng = random.Random(3)
    a, b = shapes(rng, 10, 20, 9), shapes(rng, 4, 20, 21)
    # within another, around another, and a hole as large as what is cut
    a += edges(90, [(100, 100), (110, 100), (110, 110), (100, 110)]) + edges(91, [(102.5, 102.5), (103, 102.5), (103, 103), (102.5, 103)])
    b += edges(80, [(102, 102), (108, 101), (107, 108)]) + edges(80, [(104, 103), (104.5, 105), (106, 104)])
    A, B = spark.createDataFrame(a, EDGE), spark.createDataFrame(b, EDGE)
    got = {(r.id, r.polygon): r.area for r in spatial.area(spatial.clip_polygons(A, B, size), ["id", "polygon"]).collect()}
    want = {(i, j): s for i, x in by_id(a).items() for j, y in by_id(b).items() if (s := common_area(x, y)) > 1e-9}
    assert {k for k, v in got.items() if abs(v) > 1e-9} == set(want)
    for k, v in want.items():
        assert got[k] == pytest.approx(v, rel=1e-9)


def test_clipped_area_along_common_edges(spark):
    """Boxes of a grid against boxes that share sides and corners with them."""
    box = lambda i, w, s, e, n: edges(i, [(w, s), (e, s), (e, n), (w, n)])
    a = [r for k in range(9) for r in box(k, k % 3 * 2.0, k // 3 * 2.0, k % 3 * 2.0 + 2, k // 3 * 2.0 + 2)]
    b = box(0, 0.0, 0.0, 4.0, 6.0) + box(1, 2.0, 2.0, 4.0, 4.0) + box(2, 1.0, 0.0, 3.0, 2.0)
    A, B = spark.createDataFrame(a, EDGE), spark.createDataFrame(b, EDGE)
    got = {(r.id, r.polygon): r.area for r in spatial.area(spatial.clip_polygons(A, B, 3.0), ["id", "polygon"]).collect()}
    want = {(k, 0): 4.0 for k in (0, 1, 3, 4, 6, 7)} | {(4, 1): 4.0, (0, 2): 2.0, (1, 2): 2.0}
    assert {k: pytest.approx(v) for k, v in got.items() if abs(v) > 1e-12} == want


def test_clipped_lines(spark):
    rng = random.Random(4)
    b = shapes(rng, 5, 20, 13)
    lines = [(k, rng.uniform(-5, 30), rng.uniform(-5, 30), rng.uniform(-5, 30), rng.uniform(-5, 30)) for k in range(60)]
    cut = spatial.clip_lines(spark.createDataFrame(lines, EDGE), spark.createDataFrame(b, EDGE), 6.0)
    got = {(r.id, r.polygon): r.s for r in cut.withColumn("s", spatial.length()).groupBy("id", "polygon").agg(F.sum("s").alias("s")).collect()}
    want = {}
    for e in lines:
        k, x1, y1, x2, y2 = e
        for j, own in by_id(b).items():
            ts = {0.0, 1.0}
            for _, x3, y3, x4, y4 in own:
                d = (x2 - x1) * (y4 - y3) - (y2 - y1) * (x4 - x3)
                if abs(d) > 1e-15:
                    t, u = ((x3 - x1) * (y4 - y3) - (y3 - y1) * (x4 - x3)) / d, ((x3 - x1) * (y2 - y1) - (y3 - y1) * (x2 - x1)) / d
                    if 0 < t < 1 and 0 <= u <= 1:
                        ts.add(t)
            ts = sorted(ts)
            s = sum((q - p) for p, q in zip(ts, ts[1:]) if holds(own, x1 + (p + q) / 2 * (x2 - x1), y1 + (p + q) / 2 * (y2 - y1))) * math.hypot(x2 - x1, y2 - y1)
            if s > 1e-9:
                want[k, j] = s
    assert set(got) == set(want) and len(want) > 20
    for k, v in want.items():
        assert got[k] == pytest.approx(v, rel=1e-9)


def km(a, b, c, d):
    p, q = math.radians(b), math.radians(d)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(c - a) / 2) ** 2
    return 2 * 6371.0 * math.atan2(math.sqrt(h), math.sqrt(1 - h))


@pytest.mark.parametrize("k", [1, 5])
def test_nearest(spark, k):
    rng = random.Random(5)
    pts = [(i, rng.uniform(-180, 180), rng.uniform(-90, 90), "x") for i in range(150)]
    pts += [(1000, 179.99, 0.0, "x"), (1001, -180.0, 10.0, "x"), (1002, 180.0, 10.0, "x"), (1003, 12.0, 90.0, "x"), (1004, 0.0, -90.0, "x"), (1005, 359.0, 5.0, "x"), (1006, None, 5.0, "x")]
    fac = [(i, rng.gauss(179, 3), rng.gauss(10, 4)) for i in range(120)] + [(200 + i, rng.uniform(-180, 180), rng.uniform(-90, 90)) for i in range(40)]
    # a heap at one place, a tight cluster, the poles, and rows without a place
    fac += [(300 + i, 50.0, 50.0) for i in range(30)] + [(400 + i, 20 + i * 1e-2, 45 + i % 7 * 1e-2) for i in range(100)] + [(600, 100.0, 90.0), (601, 5.0, -90.0), (602, None, 1.0)]
    P = spark.createDataFrame(pts, "source_id long, lon double, lat double, row string")
    got = nearest.nearest(P, spark.createDataFrame(fac, "facility_id long, f_lon double, f_lat double"), k, leaf=8)
    assert got.columns == ["source_id", "lon", "lat", "row", "facility_id", "distance_km", "place"]
    found = {}
    for r in sorted(got.collect(), key=lambda r: (r.source_id, r.place)):
        found.setdefault(r.source_id, []).append((r.facility_id, r.distance_km))
    assert set(found) == {p[0] for p in pts} - {1006}
    for i, lon, lat, _ in pts:
        if lon is None:
            continue
        want = sorted((km(lon, lat, c, d), f) for f, c, d in fac if c is not None)[:k]
        assert [d for _, d in found[i]] == pytest.approx([d for d, _ in want], rel=1e-9, abs=1e-6)
        if len({round(d, 5) for d, _ in want}) == k:
            assert [f for f, _ in found[i]] == [f for _, f in want]


def test_fewer_facilities_than_asked_for(spark):
    P = spark.createDataFrame([(1, 0.0, 0.0), (2, 100.0, 10.0)], "source_id long, lon double, lat double")
    f = spark.createDataFrame([(7, 1.0, 1.0), (8, 2.0, 2.0)], "facility_id long, f_lon double, f_lat double")
    assert sorted((r.source_id, r.facility_id, r.place) for r in nearest.nearest(P, f, 5).collect()) == [(1, 7, 1), (1, 8, 2), (2, 7, 2), (2, 8, 1)]
    assert nearest.nearest(P, f.limit(0), 5).count() == 0 and nearest.nearest(P.limit(0), f, 5).count() == 0


def test_points_in_copies_of_shapes_are_counted_without_their_pairs(spark, monkeypatch):
    """Many points at few places and many copies of few shapes; one lacks a part, one has its edges twice, one none with a length."""
    rng = random.Random(21)
    base = shapes(rng, 4, 20.0, 9)
    own = {i: [e for e in base if e[0] == i % 4] for i in range(80)}
    rows = [(i, *e[1:]) for i, es in own.items() for e in rng.sample(es, len(es))]
    rows += [(90, *e[1:]) for e in own[0][:9]] + [(91, *e[1:]) for e in own[1] * 2] + [(92, 1.0, 1.0, None, 1.0)]
    places = [(rng.random() * 20, rng.random() * 20) for _ in range(50)]
    points = [(i, *places[i % 50]) for i in range(1000)] + [(1000, None, 3.0)]
    e, p = spark.createDataFrame(rows, EDGE), spark.createDataFrame(points, "id long, x double, y double")
    alike = {r.id: r.shape for r in spatial.alike(e).collect()}
    assert alike == {i: i % 4 for i in range(80)} | {90: 90, 91: 91, 92: 92}
    met = []
    inner = spatial.polygons_of
    monkeypatch.setattr(spatial, "polygons_of", lambda *a, **k: met.append(inner(*a, **k)) or met[-1])
    got = {r.polygon: (r.n, r.first) for r in spatial.points_inside(p, e, 5.0).collect()}
    want = {}
    for i in {r[0] for r in rows} - {92}:
        ids = [k for k, x, y in points if x is not None and holds([r for r in rows if r[0] == i], x, y)]
        if ids:
            want[i] = (len(ids), min(ids))
    assert got == want
    assert met[0].count() <= 50 * 7


def test_lines_of_one_file_are_dealt_before_they_are_clipped(spark, monkeypatch):
    monkeypatch.setattr(spatial, "TASK_ROWS", 20)
    seen = []
    inner = spatial.parts_inside
    monkeypatch.setattr(spatial, "parts_inside", lambda s, *a: seen.append(s.rdd.getNumPartitions()) or inner(s, *a))
    rows = [(i, 0.5, i / 10, 9.5, i / 10 + 0.01) for i in range(90)]
    lines = spark.createDataFrame(rows, EDGE).coalesce(1)
    box = spark.createDataFrame(edges(7, [(1, 2), (8, 2), (8, 5), (1, 5)]), EDGE)
    got = spatial.clip_lines(lines, box, 3.0).collect()
    assert seen == [5] and sorted(r.id for r in got) == list(range(20, 50))
    assert all(r.polygon == 7 and abs(r.x1 - 1) < 1e-9 and abs(r.x2 - 8) < 1e-9 for r in got if 20 < r.id < 49)
