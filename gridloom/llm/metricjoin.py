"""Exact metric range join of embeddings, within labels.

On unit vectors cosine >= c is Euclidean distance <= r with r = sqrt(2 - 2c).  Pivots
(some of the vectors, chosen by hash) split each label into cells of vectors nearest
to one pivot.  For a vector y of cell q and another pivot p, every x of cell p has
distance at least (d(y,p)^2 - d(y,q)^2) / (2 d(p,q)) from y, which follows from
d(x,p) <= d(x,q) and the triangle inequality for the bisecting plane; and at least
d(y,p) - R for the radius R of cell p.  Where either bound exceeds r, y isn't needed in cell p;
elsewhere a copy of it goes there.  Cells are then joined independently, large ones
in blocks.

Equal vectors are joined once, with their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import cut

#: Vectors to a cell that is aimed at, the most pivots in all (they go to every task) and of one group of vectors
#: (their distances among each other go too: at most MOST_PIVOTS * GROUP_PIVOTS numbers, 16 MB).
CELL_ROWS, MOST_PIVOTS, GROUP_PIVOTS = 1000, 8192, 256
#: A group of so many vectors has about LEAST_PIVOTS of them at least.
GROUP_ROWS, LEAST_PIVOTS = 32, 4
#: Rows compared with all pivots of their group at once.
SLICE = 512
#: Rows of a cell on either side of one task's join.
BLOCK = 2048
#: A table of cells of at most so many rows is broadcast.
BROADCAST_CELLS = 200_000
#: Slack of the bounds, so that rounding can't lose a pair.
_EPS = 1e-6


def _valid() -> F.Column:
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(e.isNotNull() & F.col("label").isNotNull() & (F.size(e) > 0) & finite & F.exists(e, lambda x: x != 0), F.lit(False))


def _stack(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows of a list column by length: (row numbers, matrix of doubles)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    first = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    return [(rows := np.flatnonzero(sizes == d), flat[first[rows][:, None] + np.arange(d)]) for d in np.unique(sizes) if d]


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component near 1, which alters no cosine but for under- and overflow."""
    _, exponent = np.frexp(np.abs(x).max(axis=1))
    # in two steps, as one factor may itself be out of range
    half = exponent // 2
    return np.ldexp(np.ldexp(x, -half[:, None]), (half - exponent)[:, None])


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


class Pivots:
    """Pivots of groups (label, length), their distances among each other, and cell numbers in the group."""

    def __init__(self, keys: list, vectors: list[np.ndarray]):
        rows: dict = {}
        for key, v in zip(keys, vectors):
            rows.setdefault((key, len(v)), []).append(v)
        self.groups = {}
        for key, own in rows.items():
            m = _unit(np.array(own, float))
            self.groups[key] = (m, np.sqrt(np.maximum(0, 2 - 2 * (m @ m.T))))

    def assign(self, label, x: np.ndarray, r: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, cell, inner, distance to the cell's pivot) of each vector and each copy; a group without pivots is one cell."""
        if (label, x.shape[1]) not in self.groups:
            n = len(x)
            return np.arange(n), np.zeros(n, np.int64), np.ones(n, bool), np.zeros(n)
        m, between = self.groups[label, x.shape[1]]
        found = []
        for at in range(0, len(x), SLICE):
            d = np.sqrt(np.maximum(0, 2 - 2 * (_unit(x[at:at + SLICE]) @ m.T)))
            own = d.argmin(axis=1)
            near = d[np.arange(len(d)), own]
            apart = between[own]
            with np.errstate(divide="ignore", invalid="ignore"):
                bound = np.where(apart > 1e-6, (d * d - (near * near)[:, None]) / (2 * apart), 0)
            needed = bound <= r + _EPS
            needed[np.arange(len(d)), own] = True
            row, col = np.nonzero(needed)
            found.append((row + at, col, own[row] == col, d[row, col]))
        return tuple(np.concatenate(c) for c in zip(*found))


def range_join(vectors: DataFrame, least_cosine: float = 0.98) -> DataFrame:
    """Links of ``vectors`` (vec_id, label, embedding array).

    One row per row of ``vectors``: vec_id, n_links (other vectors linked directly),
    component_id (smallest vec_id reachable, itself included), kept.

    Only vectors of one label and length link.  A null, zero, empty or non-finite
    vector and a null label link with nothing.  Equal vectors link, rows repeated in
    full too.  A null vec_id counts as a link of others but has no component and is kept.
    """
    r = float(np.sqrt(2 - 2 * least_cosine))
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    v = v.withColumn("ok", _valid())
    own = v.where("ok")
    classes = own.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("times"))
    # a vector that no row names is numbered behind all ids, so that chains through it hold and never take its number
    top = F.lit(own.agg(F.greatest(F.max("vec_id"), F.lit(0))).first()[0] or 0)
    classes = cut(classes.withColumn("cid", F.coalesce("rep", top + 1 + F.monotonically_increasing_id())), "classes")
    pivots = _pivots(classes)
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(pivots)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p: Pivots = shared.value
        for batch in batches:
            labels = np.array(batch.column(1).to_pylist(), object)
            for rows, x in _stack(batch.column(2)):
                for label in set(labels[rows].tolist()):
                    pick = np.flatnonzero(labels[rows] == label)
                    for at in range(0, len(pick), 8 * SLICE):
                        part = pick[at:at + 8 * SLICE]
                        row, cell, inner, dist = p.assign(label, x[part], r)
                        take = pa.array(rows[part[row]])
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(1).take(take), pa.array(np.full(len(row), x.shape[1], np.int32)), pa.array(cell.astype(np.int32)), pa.array(inner), pa.array(dist),
                             batch.column(0).take(take), batch.column(3).take(take), batch.column(2).take(take)],
                            ["label", "dim", "cell", "inner", "dist", "cid", "times", "embedding"],
                        )

    element, name = (classes.schema[c].dataType.simpleString() for c in ("embedding", "label"))
    dealt = classes.select("cid", "label", "embedding", "times").mapInArrow(
        deal, f"label {name}, dim int, cell int, inner boolean, dist double, cid long, times long, embedding {element}"
    )
    dealt = cut(dealt, "cells")
    cell = ["label", "dim", "cell"]
    cells = dealt.groupBy(*cell).agg(
        F.count(F.when(F.col("inner"), 1)).alias("n_in"), F.count("*").alias("n_all"), F.max(F.when(F.col("inner"), F.col("dist"))).alias("radius")
    )
    few = cells.limit(BROADCAST_CELLS + 1).count() <= BROADCAST_CELLS
    dealt = dealt.join(F.broadcast(cells) if few else cells, cell).where(F.col("inner") | (F.col("dist") <= F.col("radius") + r + _EPS))
    mine, all_ = F.ceil(F.col("n_in") / BLOCK).cast("int"), F.ceil(F.col("n_all") / BLOCK).cast("int")
    some = lambda n: F.pmod(F.xxhash64("cid"), n).cast("int")
    left = dealt.where("inner").withColumn("i", some(mine)).withColumn("j", F.explode(F.sequence(F.lit(0), all_ - 1)))
    right = dealt.withColumn("j", some(all_)).withColumn("i", F.explode(F.sequence(F.lit(0), mine - 1)))
    rows = left.withColumn("side", F.lit(0)).unionByName(right.withColumn("side", F.lit(1)))

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        if not len(a) or not len(b):
            return pd.DataFrame({"cid": [], "n": [], "root": []}).astype(np.int64)
        x, y = (_scaled(np.array(f["embedding"].tolist(), float)) for f in (a, b))
        ia, ib, times = a["cid"].to_numpy(), b["cid"].to_numpy(), b["times"].to_numpy()
        linked = (x @ y.T) >= (least_cosine * np.sqrt((x * x).sum(axis=1)))[:, None] * np.sqrt((y * y).sum(axis=1))[None, :]
        linked &= ia[:, None] != ib[None, :]
        n = linked.astype(np.int64) @ times
        have = n > 0
        both = np.concatenate([np.stack([ia[have], n[have], ia[have]], 1), _labels(linked, ia, ib)])
        return pd.DataFrame(both, columns=["cid", "n", "root"])

    joined = cut(
        rows.select(*cell, "i", "j", "side", "cid", "times", "embedding").groupBy(*cell, "i", "j").applyInPandas(join, "cid long, n long, root long"), "links"
    )
    counts = joined.groupBy("cid").agg(F.sum("n").alias("n"))
    comps = components(joined.select(F.col("cid").alias("a"), F.col("root").alias("b")).distinct())
    table = classes.join(counts, "cid", "left").join(comps.withColumnRenamed("id", "cid"), "cid", "left")
    # the least of a component is a vec_id but where no row of it has one; such rows have no component
    table = cut(table.select("label", "embedding", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("component", "cid").alias("component")), "table")
    out = v.join(table.withColumn("ok", F.lit(True)), ["label", "embedding", "ok"], "left")
    group = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), group.alias("component_id"), F.coalesce(F.col("vec_id") == group, F.lit(True)).alias("kept")
    )


def _labels(linked: np.ndarray, ia: np.ndarray, ib: np.ndarray) -> np.ndarray:
    """Rows (cid, 0, root): every linked row and partner of a block with the least cid that it
    hangs together with there.  Labels spread over rows and partners until they rest."""
    rows, cols = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    if not len(rows):
        return np.zeros((0, 3), np.int64)
    sub = linked[np.ix_(rows, cols)]
    top = np.iinfo(np.int64).max
    col = ib[cols].copy()
    while True:
        row = np.minimum(ia[rows], np.where(sub, col[None, :], top).min(axis=1))
        new = np.minimum(col, np.where(sub, row[:, None], top).min(axis=0))
        if (new == col).all():
            break
        col = new
    return np.stack([np.concatenate([ia[rows], ib[cols]]), np.zeros(len(rows) + len(cols), np.int64), np.concatenate([row, col])], 1)


def _pivots(classes: DataFrame) -> Pivots:
    """Of every (label, length) with GROUP_ROWS vectors or more about one in a cell's worth, LEAST_PIVOTS at least and
    GROUP_PIVOTS at most.  Where that would be more than MOST_PIVOTS in all, cells are larger, and groups
    of less than two of them have none: those are compared as one cell."""
    dim = F.size("embedding").alias("dim")
    sizes = classes.groupBy("label", dim).agg(F.count("*").alias("n"))
    some = F.col("n") >= GROUP_ROWS
    total, groups = sizes.agg(F.sum("n"), F.count(F.when(some, 1))).first()
    room = MOST_PIVOTS - (groups or 0) * LEAST_PIVOTS
    step = max(CELL_ROWS, -(-(total or 0) // max(room, MOST_PIVOTS // 2)))
    large = cut(sizes.where(some if room >= MOST_PIVOTS // 2 else F.col("n") > 2 * step), "groups")
    chance = F.least(F.greatest(F.lit(1.0 / step), F.lit(float(LEAST_PIVOTS)) / F.col("n")), F.lit(float(GROUP_PIVOTS)) / F.col("n"))
    marked = classes.select("cid", "label", "embedding", dim).join(F.broadcast(large), ["label", "dim"])
    chosen = marked.where(F.pmod(F.xxhash64("label", "embedding"), F.lit(1 << 30)) < chance * F.lit(float(1 << 30)))
    rows = chosen.select("label", "embedding").toPandas()
    return Pivots(rows["label"].tolist(), [np.asarray(e, float) for e in rows["embedding"]])


def op6(vectors: DataFrame) -> DataFrame:
    return range_join(vectors.select("vec_id", "label", "embedding"))


OP6_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL),
n AS (SELECT *, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v),
l AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM n x JOIN n y ON x.label = y.label AND x.vec_id <> y.vec_id
  WHERE x.norm > 0 AND y.norm > 0 AND list_dot_product(x.e, y.e) >= 98e-2 * x.norm * y.norm),
r AS (SELECT vec_id AS id, vec_id AS root FROM embeddings UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.id),
c AS (SELECT id, min(root) AS root FROM r GROUP BY id),
k AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT c.id AS vec_id, CAST(coalesce(k.n, 0) AS BIGINT) AS n_links, c.root AS component_id, c.id = c.root AS kept
FROM c LEFT JOIN k ON k.a = c.id
"""
