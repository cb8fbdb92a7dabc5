"""Match points, airports, layers and tiles on small cases worked out by hand."""

from gridloom.operators import aviation, export, layers, lines, spatial, tiles
from gridloom.plans import registry

from .compare import check, connect

EDGE = "id long, x1 double, y1 double, x2 double, y2 double"


def box(i, w, s, e, n, turned=False):
    ring = [(w, s), (e, s), (e, n), (w, n)]
    ring = ring[::-1] if turned else ring
    return [(i, *map(float, (*a, *b))) for a, b in zip(ring, ring[1:] + ring[:1])]


def shape(i, ring):
    return [(i, *map(float, (*a, *b))) for a, b in zip(ring, ring[1:] + ring[:1])]


def test_match_points(spark):
    """A box: its middle.  A frame, and a horseshoe whose middle is open: the widest chord at half height.  A line: nothing."""
    horseshoe = shape(3, [(0, 0), (10, 0), (10, 10), (7, 10), (7, 2), (2, 2), (2, 10), (0, 10)])
    rows = box(1, 0, 0, 4, 2) + box(2, 0, 0, 10, 10) + box(2, 2, 2, 9, 9, turned=True) + horseshoe + shape(4, [(0, 0), (5, 5)])
    got = {r.id: (r.x, r.y, r.area) for r in spatial.match_points(spark.createDataFrame(rows, EDGE)).collect()}
    assert got[1] == (2.0, 1.0, 8.0) and got[2] == (1.0, 5.0, 51.0) and got[3] == (8.5, 5.0, 60.0) and set(got) == {1, 2, 3}


def test_airports(spark):
    names = "id long, family string, element_type string, element_id long, name string, tags map<string,string>"
    rows = [
        (1, "Aerodrome", "way", 7, " ", {"icao": " abcd ", "name": "North"}), (2, "landuse_aerodrome", None, 7, "South", None), (3, "military_airfield", "way", 8, "x", {}),
        (4, "aerodrome", "way", 9, "x", {"military": "yes"}), (5, "aerodrome", "relation", None, None, {"iata": "xy"}), (6, "heliport", "way", 1, "x", {}), (7, "aerodrome", "way", 2, "small", {}),
    ]
    edges = [e for i in range(1, 7) for e in box(i, i * 3000, 0, i * 3000 + 1000, 1000)] + box(7, 0, 9000, 100, 9100)
    aprons = box(1, 3100, 100, 3300, 200) + box(2, 90_000, 0, 90_100, 100)
    P, E, A = spark.createDataFrame(rows, names), spark.createDataFrame(edges, EDGE), spark.createDataFrame(aprons, EDGE)
    got = {r.id: r for r in aviation.facilities(P, E, A, 1000.0).collect()}
    assert set(got) == {1, 2, 5}
    assert (got[1].facility_id, got[1].x, got[1].y, got[1].icao, got[1].name) == ("osm:way:7", 3200.0, 150.0, "ABCD", "North")
    assert (got[2].facility_id, got[2].x, got[2].y, got[2].name) == ("osm:way:7:r2", 6500.0, 500.0, "South")
    assert (got[5].facility_id, got[5].iata, got[5].name, got[5].area_km2) == ("osm:relation:5", "XY", "aerodrome", 1.0)
    assert {r.id for r in aviation.facilities(P, E, None, 1000.0, least_km2=0.001).collect()} == {1, 2, 5, 7}


def test_layers_in_a_boundary(spark):
    spec = {"a": {"kinds": ["area_way"], "match": {"tag": {"key": "k", "equals": "a"}}}, "b": {"kinds": ["area_way"], "match": {"tag": {"key": "k", "exists": True}}}}
    elements = spark.createDataFrame([(1, {"k": "a"}, "area_way"), (1, {"k": "a"}, "area_way"), (2, {"k": "x"}, "area_way"), (3, {"k": "a"}, "node"), (4, {"k": "a"}, "area_way")], "id long, tags map<string,string>, elem_kind string")
    edges = spark.createDataFrame(box(1, 0, 0, 4, 4) + box(2, 9, 0, 11, 1) + box(4, 20, 20, 21, 21), EDGE)
    boundary = spark.createDataFrame(box(1, 1, 1, 10, 10) + box(1, 2, 2, 3, 3, turned=True) + box(2, 9.5, 0, 12, 1), EDGE)
    got = layers.vector_layers(elements, spec, "tags", "id", edges, boundary, 2.0, least_area=0.5)
    assert {(r.layer, r.id, round(r.area, 9)) for r in got.collect()} == {("a", 1, 8.0), ("b", 1, 8.0), ("b", 2, 1.5)}
    assert {r.id for r in layers.vector_layers(elements, spec, "tags", "id", edges, boundary, 2.0, least_area=2.0).collect()} == {1}
    near = layers.buffered(got.select("layer", "id", "x1", "y1", "x2", "y2"), {"a": 1.0}, 1.0, (0, 9), (0, 9))
    rows = {(r.row, r.col) for r in near.where("layer = 'a'").collect()}
    assert (0, 1) in rows and (2, 2) in rows and (0, 0) in rows and (5, 5) not in rows
    bare = {(r.row, r.col) for r in near.where("layer = 'b'").collect()}
    assert bare == {(1, 1), (1, 2), (1, 3), (2, 1), (2, 3), (3, 1), (3, 2), (3, 3), (0, 9)}


def test_tiles(spark):
    xs, ys = tiles.covering(-10.0, 40.0, 10.0, 50.0, 5)
    assert list(xs) == [15, 16] and list(ys) == [10, 11, 12]
    raster = spark.createDataFrame([(0, 0, 5.0), (0, 1, 0.001), (1, 0, -1.0)], "row int, col int, value double")
    tile = spark.createDataFrame([(0, 0, 0)], "z int, x int, y int")
    got = tiles.shaded(tiles.sampled(raster, tile, -180.0, 0.0, 90.0, 80.0, 4), -3.0, 1.0, 0.01).collect()
    # a column of pixels lies in each source column; the two northern rows of pixels have their centres at 79.2 and 40.9 degrees
    assert {(r.row, r.col, r.value) for r in got} == {(0, 0, 5.0), (1, 0, 5.0), (0, 1, 0.001), (1, 1, 0.001)}
    assert {round(r.alpha, 6) for r in got if r.value < 0.01} == {0.08} and all(0.42 <= r.alpha <= 0.9 for r in got if r.value > 1)


def test_cells_in_an_envelope(spark):
    cells = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 1.0), (2, 5.0, 5.0, 6.0, 6.0)], "cell_id long, west double, south double, east double, north double")
    assert [r.cell_id for r in export.cells_geojson(cells, (1.0, 1.0, 2.0, 2.0)).collect()] == [1]
    text = {r.cell_id: r.feature for r in export.cells_geojson(cells).collect()}
    assert '"coordinates":[[[5.0,5.0],[6.0,5.0],[6.0,6.0],[5.0,6.0],[5.0,5.0]]]' in text[2]


def test_exploded_edges_are_not_broadcast(spark, sf):
    plan = registry.queries()["dc22_buffered_layers"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan


def test_touched_polygons_equal_their_sql(spark):
    # at sf0.1 four pixels were taken whose corner an edge passes within rounding
    name, con = "rv04_touched_polygons", connect("/root/testdata/sf0.1")
    check(registry.queries()[name](spark, "/root/testdata/sf0.1"), con, registry.oracle_sql()[name])


def test_many_segments_are_dealt_and_pixels_stay(spark, monkeypatch):
    monkeypatch.setattr(spatial, "TASK_ROWS", 100, raising=False)
    s = spark.range(1000).selectExpr("id", "id % 7 + 0.2D AS x1", "id % 5 + 0.3D AS y1", "id % 9 + 0.7D AS x2", "id % 8 + 0.1D AS y2")
    few = spatial.burn(s, 1.0, (0, 9), (0, 9), filled=False)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_NUM" in plan
    monkeypatch.setattr(spatial, "TASK_ROWS", 10_000)
    assert sorted(few.collect()) == sorted(spatial.burn(s, 1.0, (0, 9), (0, 9), filled=False).collect())


def test_slanted_segments_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(spatial, "TASK_ROWS", 100, raising=False)
    s = spark.range(0, 1000, 1, 1).selectExpr("id", "id % 7 + 0.2D AS x1", "id % 5 + 0.3D AS y1", "id % 9 + 0.7D AS x2", "id % 8 + 0.1D AS y2")
    assert lines.segments_in_cells(s, 1.0).rdd.getNumPartitions() == 11
