"""Connected components by hooking to the least neighbour and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import cut


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) of integers to (id, component): for every node with an edge to
    another the smallest node reachable, itself included.

    A round takes the least smaller neighbour ``m`` of each node, hangs the node's other
    smaller neighbours below ``m`` and moves every edge that ends in a node with such an
    ``m`` on to it.  Edges only ever lead to nodes known to hang together, and the depth
    halves, so the rounds grow with the logarithm of the longest path.  Rounds are written
    to the shared folder.  Null ends and loops are dropped; no edges give no rows.
    """
    apart = F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))
    e = cut(edges.where(apart).select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).distinct(), "edges")
    before = None
    while True:
        state = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)")).alias("h")).first()
        if not state["n"] or state == before:
            break
        before = state
        # written, so that joins with it can split a hot side
        low = cut(e.groupBy(F.col("x").alias("u")).agg(F.min("y").alias("m")), "low")
        hung = e.join(low, F.col("x") == F.col("u")).where(F.col("y") != F.col("m")).select(F.col("y").alias("x"), F.col("m").alias("y"))
        hung = hung.union(low.select(F.col("u").alias("x"), F.col("m").alias("y")))
        onward = low.select(F.col("u").alias("y"), F.col("m").alias("next"))
        moved = hung.join(onward, "y", "left").select("x", F.coalesce("next", "y").alias("y"))
        e = cut(moved.where(F.col("x") > F.col("y")).distinct(), "edges")
    roots = e.select(F.col("y").alias("id"), F.col("y").alias("component")).distinct()
    return e.select(F.col("x").alias("id"), F.col("y").alias("component")).unionByName(roots)


def extend(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` (id, component) as :func:`components` gives them, with more ``edges`` (a, b) taken in.

    Only the components that the new edges touch are worked on.
    """
    if edges.isEmpty():
        return labels
    new = edges
    for end in ("a", "b"):
        root = labels.select(F.col("id").alias(end), F.col("component").alias("_root"))
        new = new.join(root, end, "left").withColumn(f"_{end}", F.coalesce("_root", end)).drop("_root")
    new = cut(new, "joining")
    merged = components(new.select(F.col("_a").alias("a"), F.col("_b").alias("b")))
    merged = merged.select(F.col("id").alias("component"), F.col("component").alias("_to"))
    ends = new.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("_a").alias("component")), F.struct(F.col("b").alias("id"), F.col("_b").alias("component")))).alias("n"))
    all_ = labels.unionByName(ends.select("n.*")).distinct()
    return cut(all_.join(merged, "component", "left").select("id", F.coalesce("_to", "component").alias("component")), "labels")
