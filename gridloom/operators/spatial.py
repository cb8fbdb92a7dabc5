"""Polygons and lines as tables of edges: burning, covers, point-in-polygon joins, clipping.

A polygon is the bag of its edges (id, x1, y1, x2, y2): outer rings and holes alike, by the even-odd
rule, so no row ever holds a whole shape and a large one is spread over tasks.  Edges of no length do no harm.
Directions matter to areas only: outer rings against the clock, holes with it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import shared_folder

#: Edges that a cell of a cover holds before it is split, times a cell is halved at most; cells that are broadcast, with so many edges in all.
MOST_EDGES, MOST_LEVELS, CELL_ROWS, CELL_EDGES = 64, 16, 100_000, 500_000
#: Segments or points that a task begins with, pairs of points and cells that it makes.
TASK_ROWS, TASK_PAIRS = 50_000, 500_000
#: Where the point of a cell lies at which it is known to be in or out; odd fractions, so that no corner of a grid falls on it.
_AT = (0.487312945, 0.513774181)
#: Points nearer to an edge than this part of the largest coordinate lie on it.
_ON = 1e-12

_EDGE = ("x1", "y1", "x2", "y2")


def ring_edges(df: DataFrame, ring: str) -> DataFrame:
    """``df`` with a row for each edge of an array of struct(x, y), closed or not; fewer than two corners give none."""
    n = F.size(ring)
    pair = lambda i: F.struct(F.get(ring, i).alias("a"), F.get(ring, (i + 1) % n).alias("b"))
    pairs = F.when(n >= 2, F.transform(F.sequence(F.lit(0), n - 1), pair))
    out = df.withColumn("_e", F.explode(pairs)).drop(ring)
    for name, (end, axis) in zip(_EDGE, (("a", "x"), ("a", "y"), ("b", "x"), ("b", "y"))):
        out = out.withColumn(name, F.col("_e")[end][axis].cast("double"))
    return out.where((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2"))).drop("_e")


def _span(low: Column, high: Column, ends: tuple[int, int] | None) -> Column:
    if ends:
        low, high = F.greatest(low, F.lit(ends[0])), F.least(high, F.lit(ends[1]))
    return F.when(low <= high, F.sequence(low.cast("int"), high.cast("int")))


def dealt(df: DataFrame, *key: str) -> DataFrame:
    """``df`` over so many tasks by ``key`` that each begins with about TASK_ROWS rows, since their rows grow in the task; few rows stay as they are."""
    n = df.count()
    return df if n <= TASK_ROWS else df.repartition(n // TASK_ROWS + 1, *key)


def walk(segments: DataFrame, step: float, rows: tuple[int, int] | None = None, cols: tuple[int, int] | None = None, slack: float = 0.0) -> DataFrame:
    """``segments`` with row and col of every pixel that a segment touches, within closed bounds of rows and cols.

    A segment is cut by rows first; what it covers of a row gives a run of columns.  Pixels are half open;
    ``slack`` (in pixels) adds those that it passes as near as that.
    """
    x1, y1, x2, y2 = map(F.col, _EDGE)
    low, high = F.least(y1, y2), F.greatest(y1, y2)
    s = segments.withColumn("row", F.explode(_span(F.floor(low / step - slack), F.floor(high / step + slack), rows)))
    slope = (x2 - x1) / F.nullif(y2 - y1, F.lit(0.0))
    west, east = F.least(x1, x2), F.greatest(x1, x2)
    at = lambda y: F.greatest(west, F.least(east, x1 + (y - y1) * slope))
    a, b = at(F.greatest(low, F.col("row") * step)), at(F.least(high, (F.col("row") + 1) * step))
    flat = y1 == y2
    first, last = F.when(flat, west).otherwise(F.least(a, b)), F.when(flat, east).otherwise(F.greatest(a, b))
    return s.withColumn("col", F.explode(_span(F.floor(first / step), F.floor(last / step), cols)))


def runs_inside(edges: DataFrame, step: float, rows: tuple[int, int] | None = None, cols: tuple[int, int] | None = None, at: tuple[float, float] = (0.5, 0.5)) -> DataFrame:
    """(id, row, first, last): runs of pixels whose point ``at`` (by default the centre) lies inside a polygon.

    Each edge gives its crossing with the rows it spans; the crossings of one polygon with one row are sorted
    and every second gap is inside.  A polygon is dealt by rows.
    """
    x1, y1, x2, y2 = map(F.col, _EDGE)
    first_row, end_row = (F.ceil(f(y1, y2) / step - at[1]) for f in (F.least, F.greatest))
    e = edges.withColumn("row", F.explode(_span(first_row, end_row - 1, rows)))
    y = (F.col("row") + at[1]) * step
    e = e.select("id", "row", ((x2 - x1) * (y - y1) / (y2 - y1) + x1).alias("x"))
    order = Window.partitionBy("id", "row").orderBy("x")
    gaps = e.select("id", "row", "x", F.lead("x").over(order).alias("end"), F.row_number().over(order).alias("k")).where(F.col("k") % 2 == 1)
    first, last = F.ceil(F.col("x") / step - at[0]), F.ceil(F.col("end") / step - at[0]) - 1
    if cols:
        first, last = F.greatest(first, F.lit(cols[0])), F.least(last, F.lit(cols[1]))
    return gaps.select("id", "row", first.cast("int").alias("first"), last.cast("int").alias("last")).where(F.col("first") <= F.col("last"))


def burn(edges: DataFrame, step: float, rows: tuple[int, int], cols: tuple[int, int], touched: bool = True, filled: bool = True) -> DataFrame:
    """(id, row, col): the pixels of a grid that each shape covers.

    ``filled`` takes pixels whose centre a polygon holds, ``touched`` those that an edge meets; a line has only the latter.
    """
    edges = dealt(edges, "id")
    parts = []
    if touched:
        # the walk's quotients round; whether an edge meets a pixel is settled by the sides that its corners lie on
        near = walk(edges.select("id", *_EDGE), step, rows, cols, 1e-9)
        box = (F.col("col") * step, F.col("row") * step, (F.col("col") + 1) * step, (F.col("row") + 1) * step)
        parts.append(near.where(_touches({c: F.col(c) for c in _EDGE}, *box)).select("id", "row", "col"))
    if filled:
        parts.append(runs_inside(edges, step, rows, cols).select("id", "row", F.explode(F.sequence("first", "last")).alias("col")))
    if not parts:
        raise ValueError("neither touched nor filled")
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.distinct()


def rasterised(burnt: DataFrame, order: Sequence[str], value: str, footprint: DataFrame | None = None) -> DataFrame:
    """(row, col, value) of burnt shapes: the shape last in ``order`` (columns, ties by value) wins; with ``footprint`` (row, col) only pixels in it."""
    if footprint is not None:
        burnt = burnt.join(footprint.select("row", "col").distinct(), ["row", "col"], "left_semi")
    return burnt.groupBy("row", "col").agg(F.max_by(value, F.struct(*order, value)).alias(value))


# --- covers -------------------------------------------------------------------------------


def _point(level: Column | int, row: Column, col: Column, size: float) -> tuple[Column, Column]:
    unit = F.lit(size) / F.pow(F.lit(2.0), F.lit(level) if isinstance(level, int) else level)
    return (col + _AT[0]) * unit, (row + _AT[1]) * unit


def _crossings(x0: Column, y0: Column, x: Column, y: Column, e: Column) -> Column:
    """How often the path from (x0, y0) up or down to y and then along to (x, y) crosses an edge: 0, 1 or 2."""
    x1, y1, x2, y2 = (e[c] for c in _EDGE)
    there = (y2 - y1) * (x0 - x1) / F.nullif(x2 - x1, F.lit(0.0)) + y1
    up = ((x1 > x0) != (x2 > x0)) & F.coalesce((there > y0) != (there > y), F.lit(False))
    at = (x2 - x1) * (y - y1) / F.nullif(y2 - y1, F.lit(0.0)) + x1
    along = ((y1 > y) != (y2 > y)) & F.coalesce((x0 < at) != (x < at), F.lit(False))
    return up.cast("int") + along.cast("int")


def _touches(e: Column, west: Column, south: Column, east: Column, north: Column) -> Column:
    """Whether a segment meets a closed box: their bounds meet, and corners lie on both sides of its line."""
    x1, y1, x2, y2 = (e[c] for c in _EDGE)
    meet = (F.least(x1, x2) <= east) & (F.greatest(x1, x2) >= west) & (F.least(y1, y2) <= north) & (F.greatest(y1, y2) >= south)
    sides = [(x2 - x1) * (y - y1) - (y2 - y1) * (x - x1) for x in (west, east) for y in (south, north)]
    return meet & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)


class Cover:
    """Cells of a quadtree for every polygon of a table: whole cells inside, and border cells with their edges.

    ``cells``: id, level, row, col (at size / 2**level), inside (of the cell's point), edges (empty in an inner cell).  The cells
    of a polygon do not overlap.  A border cell with more than MOST_EDGES edges is split into quarters, up to MOST_LEVELS times.
    """

    def __init__(self, edges: DataFrame, size: float, most: int = MOST_EDGES, levels: int = MOST_LEVELS):
        spark = edges.sparkSession
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(shared_folder(spark))
        self.size = float(size)
        key = ["id", "row", "col"]
        e = edges.select("id", *[F.col(c).cast("double").alias(c) for c in _EDGE])
        inner = runs_inside(e, self.size, at=_AT).select("id", "row", F.explode(F.sequence("first", "last")).alias("col"), F.lit(True).alias("inside"))
        border = walk(e, self.size).select(*key, F.struct(*_EDGE).alias("e"))
        whole = inner.join(border.select(*key).distinct(), key, "left_anti")
        done = [whole.select("id", F.lit(0).alias("level"), "row", "col", "inside", F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>").alias("edges"))]
        border = border.join(inner, key, "left").withColumn("inside", F.coalesce("inside", F.lit(False)))
        for level in range(levels + 1):
            border = border.checkpoint()
            number = border.groupBy(*key).agg(F.count("*").alias("_n"))
            full = number.where(F.col("_n") > most)
            last = level == levels or full.isEmpty()
            leaves = border if last else border.join(number.where(F.col("_n") <= most), key, "left_semi")
            done.append(leaves.groupBy(*key, "inside").agg(F.collect_list("e").alias("edges")).select("id", F.lit(level).alias("level"), "row", "col", "inside", "edges"))
            if last:
                break
            border, more = self._split(border.join(full, key, "left_semi"), level)
            done.append(more)
        out = done[0]
        for d in done[1:]:
            out = out.unionByName(d)
        self.cells = out.checkpoint()
        found = self.cells.groupBy("level").agg(F.count("*").alias("n"), F.sum(F.size("edges")).alias("e")).collect()
        self.levels = sorted(r.level for r in found)
        self.few = sum(r.n for r in found) <= CELL_ROWS and sum(r.e for r in found) <= CELL_EDGES

    def _split(self, border: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
        """Border rows of the quarters of cells, and quarters without an edge that lie inside."""
        quarters = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1)])
        k = border.withColumn("_q", F.explode(quarters))
        row, col = F.col("row") * 2 + F.col("_q.a"), F.col("col") * 2 + F.col("_q.b")
        x0, y0 = _point(level, F.col("row"), F.col("col"), self.size)
        x, y = _point(level + 1, row, col, self.size)
        unit = self.size / 2 ** (level + 1)
        met = _touches(F.col("e"), col * unit, row * unit, (col + 1) * unit, (row + 1) * unit)
        k = k.select("id", row.alias("row"), col.alias("col"), "inside", "e", _crossings(x0, y0, x, y, F.col("e")).alias("_c"), met.alias("_met"))
        k = k.checkpoint()
        state = k.groupBy("id", "row", "col").agg(((F.sum("_c") + F.max(F.col("inside").cast("int"))) % 2 == 1).alias("_in"), F.max("_met").alias("_any"))
        empty = state.where(~F.col("_any") & F.col("_in")).select("id", F.lit(level + 1).alias("level"), "row", "col", F.lit(True).alias("inside"), F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>").alias("edges"))
        kept = k.where("_met").select("id", "row", "col", "e").join(state.select("id", "row", "col", F.col("_in").alias("inside")), ["id", "row", "col"])
        return kept.select("id", "row", "col", "e", "inside"), empty

    def _keys(self, x: Column, y: Column) -> Column:
        key = lambda k: F.struct(F.lit(k).alias("level"), *[F.floor(v / (self.size / 2**k)).cast("int").alias(n) for n, v in (("row", y), ("col", x))])
        return F.array(*map(key, self.levels))


def polygons_of(points: DataFrame, cover: Cover, x: str = "x", y: str = "y", on: bool = False) -> DataFrame:
    """``points`` with ``polygon``, a row for each polygon that holds the point; with ``on`` also those on whose edge it lies.

    A point asks for its cell at each level by equal keys.  An inner cell answers at once, a border cell by the crossings of a path
    from its own point with at most its edges.  With ``on`` the column ``side`` is 0 inside, and 1 or -1 on an edge, with the
    direction (``_dx``, ``_dy``, to be columns of ``points``) of the point's own edge or against it.
    A few cells are broadcast; else both sides are shuffled, and adaptive execution splits a cell with very many points.
    """
    cells = cover.cells.where(F.lit(bool(cover.levels)))
    cells = (F.broadcast(cells) if cover.few else cells).select(F.col("id").alias("polygon"), *[F.col(c).alias(f"_{c}") for c in ("level", "row", "col", "inside", "edges")])
    p = points.withColumn("_k", F.explode(cover._keys(F.col(x), F.col(y)))) if cover.levels else points.withColumn("_k", F.lit(None).cast("struct<level:int,row:int,col:int>"))
    met = p.join(cells, (F.col("_k.level") == F.col("_level")) & (F.col("_k.row") == F.col("_row")) & (F.col("_k.col") == F.col("_col")))
    x0, y0 = _point(F.col("_level"), F.col("_row"), F.col("_col"), cover.size)
    px, py = F.col(x), F.col(y)
    n = F.aggregate("_edges", F.lit(0), lambda a, e: a + _crossings(x0, y0, px, py, e))
    inside = (n + F.col("_inside").cast("int")) % 2 == 1
    tools = ["_k", "_level", "_row", "_col", "_inside", "_edges"]
    if not on:
        return met.where(inside).drop(*tools)

    def beside(a: Column, e: Column) -> Column:
        dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
        t = ((px - e["x1"]) * dx + (py - e["y1"]) * dy) / (dx * dx + dy * dy)
        gap = F.greatest(F.abs(px - e["x1"] - t * dx), F.abs(py - e["y1"] - t * dy))
        size = F.greatest(*[F.abs(e[c]) for c in _EDGE])
        along = dx * F.col("_dx") + dy * F.col("_dy")
        return F.when((t >= 0) & (t <= 1) & (gap <= size * _ON * 100), F.when(along > 0, 1).otherwise(-1)).otherwise(a)

    side = F.aggregate("_edges", F.lit(0), beside)
    return met.withColumn("side", side).where((F.col("side") != 0) | inside).drop(*tools)


def alike(edges: DataFrame) -> DataFrame:
    """(id, shape): for each polygon the least id of those with the same edges.

    Candidates come from sums of edge hashes and are confirmed edge by edge, so no row holds a whole shape.
    """
    e = edges.select("id", *_EDGE)
    sums = []
    for seed in (0, 1):
        h = F.xxhash64(F.lit(seed), *_EDGE)
        sums += [F.sum(F.shiftright(h, 32)).alias(f"_h{seed}"), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias(f"_l{seed}")]
    digest = e.groupBy("id").agg(F.count("*").alias("_n"), *sums)
    key = [c for c in digest.columns if c != "id"]
    found = digest.join(digest.groupBy(*key).agg(F.min("id").alias("shape")), key).select("id", "shape", "_n")
    times = e.join(found.select("id", "shape"), "id").groupBy("id", "shape", *_EDGE).agg(F.count("*").alias("_times"))
    of_shape = times.where(F.col("id") == F.col("shape")).drop("id")
    same = times.join(of_shape, ["shape", *_EDGE, "_times"]).groupBy("id").agg(F.sum("_times").alias("_same"))
    shape = F.when(F.col("_same") == F.col("_n"), F.col("shape")).otherwise(F.col("id"))
    return found.join(same, "id", "left").select("id", shape.alias("shape"))


def points_inside(points: DataFrame, edges: DataFrame, size: float) -> DataFrame:
    """(polygon, n, first): how many of ``points`` (id, x, y) each polygon that holds any holds, and the least id among them.

    Places are met with shapes, not points with polygons, so that many points at few places and many copies of a shape make few pairs.
    """
    spark = edges.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    shapes = alike(edges).checkpoint()
    one_each = edges.join(shapes.where(F.col("id") == F.col("shape")).select("id"), "id", "left_semi")
    places = points.where(F.col("x").isNotNull() & F.col("y").isNotNull()).groupBy("x", "y").agg(F.count("*").alias("n"), F.min("id").alias("first")).checkpoint()
    cover = Cover(one_each, size)
    # few places make many pairs: they are dealt by the pairs, which are counted by cell first
    asked = places.select(F.explode(cover._keys(F.col("x"), F.col("y"))).alias("_k")).groupBy("_k.level", "_k.row", "_k.col").agg(F.count("*").alias("_a"))
    held = cover.cells.groupBy("level", "row", "col").agg(F.count("*").alias("_b"))
    pairs = asked.join(held, ["level", "row", "col"]).agg(F.sum(F.col("_a") * F.col("_b"))).first()[0] or 0
    met = polygons_of(places.repartition(pairs // TASK_PAIRS + 1, "x", "y"), cover).groupBy(F.col("polygon").alias("shape")).agg(F.sum("n").alias("n"), F.min("first").alias("first"))
    return shapes.join(met, "shape").select(F.col("id").alias("polygon"), "n", "first")


# --- clipping -----------------------------------------------------------------------------


def _cuts(x1: Column, y1: Column, x2: Column, y2: Column, e: Column) -> Column:
    """Places between 0 and 1 of a segment where an edge meets it: one, or the two ends of a common stretch."""
    ax, ay, bx, by = (e[c] for c in _EDGE)
    dx, dy, ex, ey = x2 - x1, y2 - y1, bx - ax, by - ay
    cross = dx * ey - dy * ex
    size = F.sqrt((dx * dx + dy * dy) * (ex * ex + ey * ey))
    flat = F.abs(cross) <= size * 1e-12
    t = ((ax - x1) * ey - (ay - y1) * ex) / F.nullif(cross, F.lit(0.0))
    u = ((ax - x1) * dy - (ay - y1) * dx) / F.nullif(cross, F.lit(0.0))
    one = F.when((u >= -1e-12) & (u <= 1 + 1e-12), F.array(t))
    apart = F.abs((ax - x1) * dy - (ay - y1) * dx) / F.nullif(F.sqrt(dx * dx + dy * dy), F.lit(0.0))
    scale = F.greatest(F.abs(x1), F.abs(y1), F.abs(x2), F.abs(y2), F.abs(ax), F.abs(ay))
    place = lambda x, y: ((x - x1) * dx + (y - y1) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0))
    two = F.when(apart <= scale * _ON * 10, F.array(place(ax, ay), place(bx, by)))
    return F.filter(F.coalesce(F.when(flat, two).otherwise(one), F.array().cast("array<double>")), lambda v: (v > 0) & (v < 1))


def parts_inside(segments: DataFrame, cover: Cover, keep: Sequence[int] = (0,)) -> DataFrame:
    """The parts of segments (x1, y1, x2, y2 and any columns, among them a unique ``sid``) inside each polygon, with ``polygon``.

    A segment is cut where the edges in the cells it passes meet it, and a part is kept by where its middle lies: 0 inside,
    1 and -1 on an edge of the same or the other direction.
    """
    x1, y1, x2, y2 = map(F.col, _EDGE)
    cells = cover.cells.where(F.size("edges") > 0).select(F.col("id").alias("polygon"), F.col("level").alias("_level"), "row", "col", "edges")
    bare = segments.select("sid", *_EDGE)
    met = None
    for k in cover.levels:
        at = walk(bare, cover.size / 2**k).withColumn("_level", F.lit(k))
        met = at if met is None else met.unionByName(at)
    rest = [c for c in segments.columns if c not in _EDGE]
    middle = lambda s: s.withColumns({"_mx": (x1 + x2) / 2, "_my": (y1 + y2) / 2, "_dx": x2 - x1, "_dy": y2 - y1})
    inside = lambda s: polygons_of(middle(s), cover, "_mx", "_my", on=True).where(F.col("side").isin(*keep)).drop("_mx", "_my", "_dx", "_dy", "side")
    if met is None:
        return inside(segments)
    found = met.join(F.broadcast(cells) if cover.few else cells, ["_level", "row", "col"]).withColumn("_e", F.explode("edges"))
    found = found.select("sid", "polygon", *_EDGE, F.explode(_cuts(x1, y1, x2, y2, F.col("_e"))).alias("t"))
    cut = found.groupBy("sid", "polygon").agg(F.sort_array(F.collect_set("t")).alias("_t")).checkpoint()
    # segments that no edge of a polygon meets lie in it as a whole or not at all
    whole = inside(segments).join(cut.select("sid", "polygon"), ["sid", "polygon"], "left_anti")
    ends = F.concat(F.array(F.lit(0.0)), "_t", F.array(F.lit(1.0)))
    parts = segments.join(cut.withColumnRenamed("polygon", "_own"), "sid").withColumn("_i", F.explode(F.sequence(F.lit(0), F.size("_t"))))
    a, b = F.get(ends, F.col("_i")), F.get(ends, F.col("_i") + 1)
    point = lambda t, p, q: F.when(t == 1.0, q).otherwise(p + t * (q - p))
    parts = parts.select(*rest, "_own", point(a, x1, x2).alias("x1"), point(a, y1, y2).alias("y1"), point(b, x1, x2).alias("x2"), point(b, y1, y2).alias("y2"))
    pieces = inside(parts).where(F.col("polygon") == F.col("_own")).drop("_own")
    return whole.select(*rest, *_EDGE, "polygon").unionByName(pieces.select(*rest, *_EDGE, "polygon"))


def clip_polygons(edges: DataFrame, clip: DataFrame, size: float) -> DataFrame:
    """Edges (id, polygon, x1, y1, x2, y2) of what polygons have in common with those of ``clip``, for each pair that has.

    The common part is bounded by the edges of each inside the other; where both run along one line, the one edge is
    kept if both have their inside on the same side.  Holes and several parts need no care of their own.
    """
    left = edges.select("id", *_EDGE).withColumn("sid", F.monotonically_increasing_id()).checkpoint()
    right = clip.select("id", *_EDGE).withColumn("sid", F.monotonically_increasing_id()).checkpoint()
    mine = parts_inside(left, Cover(right, size), (0, 1)).select("id", "polygon", *_EDGE)
    theirs = parts_inside(right, Cover(left, size), (0,)).select(F.col("polygon").alias("id"), F.col("id").alias("polygon"), *_EDGE)
    return mine.unionByName(theirs)


def clip_lines(lines: DataFrame, clip: DataFrame, size: float) -> DataFrame:
    """Parts of segments (x1, y1, x2, y2 and any columns) inside or along the edges of each polygon of ``clip``, with ``polygon``."""
    s = dealt(lines, *_EDGE).withColumn("sid", F.monotonically_increasing_id()).checkpoint()
    return parts_inside(s, Cover(clip, size), (0, 1, -1)).drop("sid")


def area(edges: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by`` and the area within directed edges.  Coordinates are taken from a corner of each group, for exactness."""
    near = edges.groupBy(*by).agg(F.min("x1").alias("_x"), F.min("y1").alias("_y"))
    e = edges.join(near, list(by))
    twice = (F.col("x1") - F.col("_x")) * (F.col("y2") - F.col("_y")) - (F.col("x2") - F.col("_x")) * (F.col("y1") - F.col("_y"))
    return e.groupBy(*by).agg((F.sum(twice) / 2).alias("area"))


def length() -> Column:
    return F.sqrt(F.pow(F.col("x2") - F.col("x1"), 2) + F.pow(F.col("y2") - F.col("y1"), 2))


# --- match points -------------------------------------------------------------------------


def match_points(edges: DataFrame) -> DataFrame:
    """(id, x, y, area): a point inside each polygon of directed edges, its centre of mass where that lies inside, else the middle of the
    widest inner chord at half its height (the western one of equals).  Polygons without area are left out."""
    e = edges.select("id", *[F.col(c).cast("double").alias(c) for c in _EDGE])
    x1, y1, x2, y2 = map(F.col, _EDGE)
    near = e.groupBy("id").agg(F.min("x1").alias("_x"), F.min("y1").alias("_y"), ((F.min("y1") + F.max("y1")) / 2).alias("_half"))
    own = e.join(near, "id")
    a, b, c, d = x1 - F.col("_x"), y1 - F.col("_y"), x2 - F.col("_x"), y2 - F.col("_y")
    cross = a * d - c * b
    mass = own.groupBy("id", "_x", "_y", "_half").agg(F.sum(cross).alias("_m"), F.sum((a + c) * cross).alias("_mx"), F.sum((b + d) * cross).alias("_my"))
    mass = mass.where(F.col("_m") != 0).select(
        "id", "_half", (F.col("_m") / 2).alias("area"), (F.col("_x") + F.col("_mx") / (3 * F.col("_m"))).alias("_cx"), (F.col("_y") + F.col("_my") / (3 * F.col("_m"))).alias("_cy")
    )
    met = e.join(mass, "id")
    at = lambda y: (x2 - x1) * (y - y1) / F.nullif(y2 - y1, F.lit(0.0)) + x1
    spans = lambda y: (y1 > y) != (y2 > y)
    right = F.sum((spans(F.col("_cy")) & F.coalesce(F.col("_cx") < at(F.col("_cy")), F.lit(False))).cast("int"))
    inside = met.groupBy("id").agg((right % 2 == 1).alias("_inside"))
    order = Window.partitionBy("id").orderBy("_at")
    chords = met.where(spans(F.col("_half"))).select("id", at(F.col("_half")).alias("_at"))
    chords = chords.select("id", "_at", F.lead("_at").over(order).alias("_end"), F.row_number().over(order).alias("_k")).where(F.col("_k") % 2 == 1)
    widest = chords.groupBy("id").agg(F.max_by(F.struct("_at", "_end"), F.struct((F.col("_end") - F.col("_at")).alias("w"), (-F.col("_at")).alias("x"))).alias("_c"))
    out = mass.join(inside, "id").join(widest, "id", "left")
    x = F.when(F.col("_inside"), F.col("_cx")).otherwise((F.col("_c._at") + F.col("_c._end")) / 2)
    return out.select("id", x.alias("x"), F.when(F.col("_inside"), F.col("_cy")).otherwise(F.col("_half")).alias("y"), F.abs("area").alias("area"))
