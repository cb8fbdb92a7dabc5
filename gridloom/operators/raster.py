"""Rasters as long tables (row, col, value)."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.geo import in_box, moved_box, segment_distance
from ..functions.numeric import floor_index, pixel_centre
from ..sources.shared import shared_folder
from .cells import range_join
from .joins import hinted

#: A table of class codes is broadcast up to this many rows.
CODE_ROWS = 1000
#: Columns of a strip of a distance transform.
STRIP = 4096


def grid(spark: SparkSession, height: int, width: int, x0: float, y0: float, dx: float, dy: float) -> DataFrame:
    """Every pixel with its centre; dy is negative for north-up rasters."""
    i = spark.range(height * width)
    g = i.select((F.col("id") / width).cast("int").alias("row"), (F.col("id") % width).cast("int").alias("col"))
    return g.withColumn("x", pixel_centre(F.col("col"), x0, dx)).withColumn("y", pixel_centre(F.col("row"), y0, dy))


def output_grid(xmin: float, ymin: float, xmax: float, ymax: float, native: float, step: float, origin: tuple[float, float]) -> tuple[float, float, int, int]:
    """West edge, north edge, height and width of the output grid.

    At the native step sizes are rounded up from the domain; a coarser grid, whose step must be a
    multiple, is anchored to the native origin.
    """
    if step % native:
        raise ValueError("the output step must be a multiple of the native one")
    if step == native:
        return xmin, ymax, math.ceil((ymax - ymin) / step), math.ceil((xmax - xmin) / step)
    west = origin[0] + math.floor((xmin - origin[0]) / step) * step
    east = origin[0] + math.ceil((xmax - origin[0]) / step) * step
    north = origin[1] - math.floor((origin[1] - ymax) / step) * step
    south = origin[1] - math.ceil((origin[1] - ymin) / step) * step
    return west, north, round((north - south) / step), round((east - west) / step)


def classes(df: DataFrame, codes: DataFrame, wanted: Sequence[int] | None = None) -> DataFrame:
    """Land-cover codes of class indices (idx, l3), and with ``wanted`` a 0/1 mask."""
    out = df.join(hinted(codes, CODE_ROWS), "idx", "left")
    return out if wanted is None else out.withColumn("mask", F.coalesce(F.col("l3").isin(*wanted), F.lit(False)).cast("int"))


def weighted_classes(df: DataFrame, weights: Mapping[int, float]) -> DataFrame:
    """Sum of the weights of a pixel's classes, 0 for those without."""
    pairs = F.create_map(*[F.lit(x) for k, v in weights.items() if v for x in (k, float(v))])
    return df.groupBy("row", "col").agg(F.sum(F.coalesce(F.try_element_at(pairs, F.col("l3")), F.lit(0.0))).alias("value"))


def painted(groups: Sequence[tuple[str, Column]]) -> Column:
    """The last group painted over a pixel wins (order: low to high priority)."""
    out = F.lit(None).cast("string")
    for name, cond in groups:
        out = F.when(F.coalesce(cond, F.lit(False)), F.lit(name)).otherwise(out)
    return out


def resample_nearest(source: DataFrame, target: DataFrame, x0: float, y0: float, dx: float, dy: float) -> DataFrame:
    """Value of the source pixel in which each target centre (x, y) lies; null outside."""
    t = target.withColumn("_r", floor_index(F.col("y"), y0, dy)).withColumn("_c", floor_index(F.col("x"), x0, dx))
    s = source.select(F.col("row").alias("_r"), F.col("col").alias("_c"), "value")
    return t.join(s, ["_r", "_c"], "left").drop("_r", "_c")


def resample_bilinear(source: DataFrame, target: DataFrame, x0: float, y0: float, dx: float, dy: float) -> DataFrame:
    """Four-neighbour interpolation; the weights of missing neighbours go to the others."""
    t = target.withColumn("_v", (F.col("y") - y0) / dy - 0.5).withColumn("_u", (F.col("x") - x0) / dx - 0.5)
    corners = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1)])
    t = t.withColumn("_k", F.explode(corners))
    fv, fu = F.col("_v") - F.floor("_v"), F.col("_u") - F.floor("_u")
    w = F.when(F.col("_k.a") == 1, fv).otherwise(1 - fv) * F.when(F.col("_k.b") == 1, fu).otherwise(1 - fu)
    t = t.withColumn("_w", w).withColumn("_r", (F.floor("_v") + F.col("_k.a")).cast("int")).withColumn("_c", (F.floor("_u") + F.col("_k.b")).cast("int"))
    s = source.select(F.col("row").alias("_r"), F.col("col").alias("_c"), "value")
    j = t.where(F.col("_w") > 0).join(s, ["_r", "_c"], "left")
    used = F.when(F.col("value").isNotNull(), F.col("_w"))
    return j.groupBy(*target.columns).agg((F.sum(F.col("_w") * F.col("value")) / F.sum(used)).alias("value"))


def window(box: tuple[float, float, float, float], x0: float, y0: float, dx: float, dy: float, margin: int = 0) -> tuple[int, int, int, int]:
    """First and last row and first and last column of the pixels that a box (west, south, east, north) meets, and ``margin`` more on each side."""
    rows = sorted(math.floor((y - y0) / dy) for y in (box[1], box[3]))
    cols = sorted(math.floor((x - x0) / dx) for x in (box[0], box[2]))
    return rows[0] - margin, rows[1] + margin, cols[0] - margin, cols[1] + margin


def in_window(source: DataFrame, w: tuple[int, int, int, int]) -> DataFrame:
    """The pixels of a window; bounds are literals, so that they reach the scan."""
    return source.where(F.col("row").between(w[0], w[1]) & F.col("col").between(w[2], w[3]))


def warp(
    source: DataFrame, target: DataFrame, move: Callable[[Column, Column], tuple[Column, Column]], x0: float, y0: float, dx: float, dy: float, bilinear: bool = False
) -> DataFrame:
    """``target`` (row, col and its centre x, y in its own coordinate system) with the value of a source raster (row, col, value) in another.

    ``move`` takes a target point to the source's system.  The bounds of the target, moved with densified sides, give
    the window of the source that is read.  Pixels outside the source have a null value.
    """
    b = target.agg(*[f(c).alias(n) for n, f, c in (("w", F.min, "x"), ("s", F.min, "y"), ("e", F.max, "x"), ("n", F.max, "y"))])
    # names of their own, as names in a lambda would be taken for those given in the same select
    moved = b.select(*[c.alias(f"moved_{n}") for n, c in zip("wsen", moved_box(tuple(F.col(c) for c in "wsen"), move))]).first()
    if moved["moved_w"] is None:
        return target.withColumn("value", F.lit(None).cast("double"))
    # a side may bend a little more between two places than at them
    west, south, east, north = moved
    slack_x, slack_y = (abs(b - a) / 100 + abs(d) for a, b, d in ((west, east, dx), (south, north, dy)))
    box = (west - slack_x, south - slack_y, east + slack_x, north + slack_y)
    near = in_window(source, window(box, x0, y0, dx, dy, 1))
    x, y = move(F.col("x"), F.col("y"))
    t = target.withColumns({"_tx": F.col("x"), "_ty": F.col("y")}).withColumns({"x": x, "y": y})
    got = resample_bilinear(near, t, x0, y0, dx, dy) if bilinear else resample_nearest(near, t, x0, y0, dx, dy)
    return got.withColumns({"x": F.col("_tx"), "y": F.col("_ty")}).drop("_tx", "_ty")


def disk_pixels(points: DataFrame, radius: Column, step: float, all_touched: bool = True) -> DataFrame:
    """Pixels (row, col) of disks around points (x, y): those a disk touches, or whose centre it holds."""
    p = points.withColumn("_rad", radius)
    span = lambda c: F.sequence(F.floor((F.col(c) - F.col("_rad")) / step).cast("int"), F.floor((F.col(c) + F.col("_rad")) / step).cast("int"))
    p = p.withColumn("row", F.explode(span("y"))).withColumn("col", F.explode(span("x")))

    def gap(c: str, k: str) -> Column:
        low = F.col(k) * step
        if not all_touched:
            return F.col(c) - (low + step / 2)
        return F.greatest(low - F.col(c), F.col(c) - (low + step), F.lit(0.0))

    inside = F.pow(gap("x", "col"), 2) + F.pow(gap("y", "row"), 2) <= F.pow(F.col("_rad"), 2)
    return p.where(inside).drop("_rad")


def dilate(mask: DataFrame, radius: float) -> DataFrame:
    """Pixels within ``radius`` pixels of a mask pixel, any radius.

    A run of mask pixels in a row reaches, so many rows up or down, over a longer run; overlapping runs of a row become one.
    So a run costs 2 * radius + 1 rows, and no pixel is made twice.
    """
    order = Window.partitionBy("row").orderBy("col")
    m = mask.select("row", "col").distinct()
    start = (F.col("col") - F.lag("col").over(order) != 1) | F.lag("col").over(order).isNull()
    runs = m.withColumn("_k", F.sum(start.cast("int")).over(order)).groupBy("row", "_k").agg(F.min("col").alias("lo"), F.max("col").alias("hi"))
    tall = int(radius)
    reach = runs.withColumn("_d", F.explode(F.sequence(F.lit(-tall), F.lit(tall))))
    wide = F.floor(F.sqrt(F.lit(float(radius * radius)) - F.col("_d") * F.col("_d"))).cast("int")
    reach = reach.select((F.col("row") + F.col("_d")).alias("row"), (F.col("lo") - wide).alias("lo"), (F.col("hi") + wide).alias("hi"))
    past = Window.partitionBy("row").orderBy("lo", "hi")
    ended = F.max("hi").over(past.rowsBetween(Window.unboundedPreceding, -1))
    apart = ended.isNull() | (F.col("lo") > ended + 1)
    joined = reach.withColumn("_new", apart.cast("int")).withColumn("_k", F.sum("_new").over(past.rowsBetween(Window.unboundedPreceding, 0)))
    whole = joined.groupBy("row", "_k").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return whole.select("row", F.explode(F.sequence("lo", "hi")).alias("col"))


def distances(mask: DataFrame, radius: int) -> DataFrame:
    """(row, col, d2): the squared distance to the nearest mask pixel of all pixels within ``radius`` of one, exact.

    First each mask pixel takes the pixels of its column that are nearer to it than to those above and below.  Then
    these heights are swept along rows: the lower envelope of their parabolas gives the least distance.  Rows are cut into
    strips with a margin of ``radius`` on both sides, so a task holds one strip of one row at a time.
    """
    m = mask.select(F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col")).distinct()
    column = Window.partitionBy("col").orderBy("row")
    up, down = F.lag("row").over(column), F.lead("row").over(column)
    # rows half-way between two mask pixels belong to the upper one
    first = F.greatest(F.col("row") - radius, F.coalesce(F.floor((F.col("row") + up) / 2) + 1, F.col("row") - radius))
    last = F.least(F.col("row") + radius, F.coalesce(F.floor((F.col("row") + down) / 2), F.col("row") + radius))
    tall = m.withColumns({"_a": first, "_b": last}).withColumn("r", F.explode(F.sequence("_a", "_b")))
    tall = tall.select(F.col("r").alias("row"), "col", F.pow(F.col("row") - F.col("r"), 2).cast("long").alias("g2"))
    width = max(STRIP, 2 * radius)
    near = F.array_distinct(F.array(*[F.floor((F.col("col") + k) / width) for k in (-radius, 0, radius)]))
    dealt = tall.withColumn("strip", F.explode(near)).repartition("row", "strip").sortWithinPartitions("row", "strip", "col")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out(part: np.ndarray) -> pa.RecordBatch:
            row, strip = part[0, 0], part[0, 3]
            cols, least = lower_envelope(part[:, 1], part[:, 2], max(strip * width, part[0, 1] - radius), min(strip * width + width - 1, part[-1, 1] + radius))
            keep = least <= radius * radius
            return pa.RecordBatch.from_arrays([pa.array(np.full(int(keep.sum()), row)), pa.array(cols[keep]), pa.array(least[keep])], ["row", "col", "d2"])

        for batch in batches:
            rows = np.stack([batch.column(k).to_numpy() for k in range(4)], 1)
            if not len(rows):
                continue
            cuts = np.flatnonzero((np.diff(rows[:, 0]) != 0) | (np.diff(rows[:, 3]) != 0)) + 1
            parts = np.split(rows, cuts)
            if held and (held[0][0, 0], held[0][0, 3]) != (rows[0, 0], rows[0, 3]):
                yield out(np.concatenate(held))
                held = []
            for part in parts[:-1]:
                yield out(np.concatenate([*held, part]))
                held = []
            held.append(parts[-1])
        if held:
            yield out(np.concatenate(held))

    return dealt.select("row", "col", "g2", "strip").mapInArrow(run, "row long, col long, d2 long")


def lower_envelope(places: np.ndarray, heights: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns first .. last and the least of (column - place)^2 + height over ascending places, in integers."""
    stack: list[int] = []  # parabolas of the envelope
    begins: list[int] = []  # first column where each is the least
    for k in range(len(places)):
        p, g, begin = int(places[k]), int(heights[k]), first
        while stack:
            q, h = int(places[stack[-1]]), int(heights[stack[-1]])
            # the first column in which the new one is lower
            begin = (p * p - q * q + g - h) // (2 * (p - q)) + 1
            if begin > begins[-1]:
                break
            stack.pop()
            begins.pop()
            begin = first
        if begin <= last:
            stack.append(k)
            begins.append(max(begin, first))
    cols = np.arange(first, last + 1)
    own = np.array(stack)[np.searchsorted(np.array(begins), cols, "right") - 1]
    return cols, (cols - places[own]) ** 2 + heights[own]


def patches(mask: DataFrame, least: int = 1) -> DataFrame:
    """Connected patches (8 neighbours) of mask pixels: patch (least pixel number), n, mean row and col.

    Runs of a row are numbered first; the labels of runs then spread over touching runs of the
    next row until they rest, halving paths by taking over the label of a label.
    """
    order = Window.partitionBy("row").orderBy("col")
    m = mask.select("row", "col").distinct()
    new = (F.col("col") - F.lag("col").over(order) != 1) | F.lag("col").over(order).isNull()
    runs = m.withColumn("_k", F.sum(new.cast("int")).over(order)).groupBy("row", "_k").agg(F.min("col").alias("lo"), F.max("col").alias("hi"))
    runs = runs.select("row", "lo", "hi", (F.col("row").cast("long") * (1 << 31) + F.col("lo")).alias("id"))
    below = runs.select((F.col("row") - 1).alias("row"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"), F.col("id").alias("id2"))
    edges = runs.join(below, "row").where((F.col("lo2") <= F.col("hi") + 1) & (F.col("hi2") >= F.col("lo") - 1)).select("id", "id2")
    labels = spread_labels(runs.select("id"), edges)
    t = runs.join(labels, "id")
    n = F.col("hi") - F.col("lo") + 1
    out = t.groupBy(F.col("label").alias("patch")).agg(
        F.sum(n).alias("n"), (F.sum(F.col("row") * n) / F.sum(n)).alias("row"), (F.sum((F.col("lo") + F.col("hi")) / 2 * n) / F.sum(n)).alias("col")
    )
    return out.where(F.col("n") >= least)


def spread_labels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, label): the least id each node hangs together with, by hooking and path halving; cut by checkpoints."""
    spark = nodes.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    both = edges.toDF("id", "id2").union(edges.select("id2", "id")).distinct().checkpoint()
    labels = nodes.select("id", F.col("id").alias("label")).checkpoint()
    while True:
        near = both.join(labels.withColumnRenamed("id", "id2"), "id2").groupBy("id").agg(F.min("label").alias("near"))
        hooked = labels.join(near, "id", "left").select("id", F.least("label", F.coalesce("near", "label")).alias("label"), F.col("label").alias("old"))
        root = labels.select(F.col("id").alias("label"), F.col("label").alias("root"))
        nxt = hooked.join(root, "label").select("id", F.least("label", "root").alias("label"), "old").checkpoint()
        changed = nxt.where(F.col("label") != F.col("old")).limit(1).count()
        labels = nxt.select("id", "label")
        if not changed:
            return labels


def painted_over(upper: DataFrame, lower: DataFrame, value: str) -> DataFrame:
    """Upper values where there are some, lower ones elsewhere."""
    return upper.select("row", "col", F.col(value).alias("_u")).join(lower.select("row", "col", F.col(value).alias("_l")), ["row", "col"], "full_outer").select("row", "col", F.coalesce("_u", "_l").alias(value))


def plant_rasters(plants: DataFrame, step: float, radius: Column) -> DataFrame:
    """Waste-water layers of plants (x, y, load): ``plants``, the load in the pixel of each plant, and ``agglomerations``,
    the load dealt evenly over the pixels whose centres the plant's disk holds (its own where there is none)."""
    own = plants.withColumns({"row": floor_index(F.col("y"), 0.0, step), "col": floor_index(F.col("x"), 0.0, step)})
    point = own.groupBy("row", "col").agg(F.sum("load").alias("value")).withColumn("layer", F.lit("plants"))
    disks = disk_pixels(plants.select("plant", "x", "y", "load"), radius, step, all_touched=False).select("plant", "row", "col", "load")
    bare = own.select("plant", "row", "col", "load").join(disks.select("plant").distinct(), "plant", "left_anti")
    all_ = disks.unionByName(bare)
    n = all_.groupBy("plant").agg(F.count("*").alias("_n"))
    area = all_.join(n, "plant").groupBy("row", "col").agg(F.sum(F.col("load") / F.col("_n")).alias("value")).withColumn("layer", F.lit("agglomerations"))
    return point.unionByName(area).select("layer", "row", "col", "value")


def region_plane(pixels: DataFrame, regions: DataFrame, width: float) -> DataFrame:
    """Pixels (row, col, x, y) with the region whose box (west, east, south, north, half open) holds the centre: the
    greatest id where boxes overlap, -1 where there is none.  ``width`` is about that of a box."""
    met = range_join(pixels, "x", regions, "west", "east", width).where((F.col("y") >= F.col("south")) & (F.col("y") < F.col("north")))
    found = met.groupBy("row", "col").agg(F.max("region").alias("region"))
    return pixels.join(found, ["row", "col"], "left").withColumn("region", F.coalesce("region", F.lit(-1)))


def clipped_patches(mask: DataFrame, least: int, box: tuple[float, float, float, float], ring: Column, step: float) -> DataFrame:
    """Patches of a mask inside a box (west, south, east, north) whose centre a ring holds: patch, n, x, y."""
    from ..functions.geo import in_ring

    x, y = (F.col("col") + 0.5) * step, (F.col("row") + 0.5) * step
    inside = mask.where((x >= box[0]) & (x <= box[2]) & (y >= box[1]) & (y <= box[3]))
    p = patches(inside, least).select("patch", "n", x.alias("x"), y.alias("y"))
    return p.where(in_ring(F.col("x"), F.col("y"), ring))


def buffered_pixels(segments: DataFrame, radius: float, step: float, box: tuple[float, float, float, float]) -> DataFrame:
    """Pixels (row, col) of a box (west, south, east, north) whose centres lie within ``radius`` of a segment (x1, y1, x2, y2).

    Each segment is dealt row by row over the pixels its bounds can reach, so that no row of the table grows beyond one line of pixels.
    """
    west, south, east, north = box
    low = lambda a, b, end: F.floor((F.greatest(F.least(a, b) - radius, F.lit(end))) / step).cast("int")
    high = lambda a, b, end: F.floor((F.least(F.greatest(a, b) + radius, F.lit(end))) / step).cast("int")
    span = lambda lo, hi: F.when(lo <= hi, F.sequence(lo, hi))
    s = segments.withColumn("row", F.explode(span(low("y1", "y2", south), high("y1", "y2", north))))
    s = s.withColumn("col", F.explode(span(low("x1", "x2", west), high("x1", "x2", east))))
    x, y = (F.col("col") + 0.5) * step, (F.col("row") + 0.5) * step
    near = segment_distance(x, y, F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")) <= radius
    return s.where(near & in_box(x, y, box)).select("row", "col").distinct()


def zonal_area(plane: DataFrame, crops: DataFrame) -> DataFrame:
    """Area of each crop in each region: plane (row, col, region) against crops (row, col, crop, area); region -1 is none."""
    met = crops.join(plane.where(F.col("region") >= 0), ["row", "col"])
    return met.groupBy("region", "crop").agg(F.sum("area").alias("area"))
