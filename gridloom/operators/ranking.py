"""Exact ranks, running sums and quantiles of groups that need not fit into one task.

Equal values are counted first, with partial sums before the shuffle.  The distinct values of a
group are then dealt into SLICES ranges at approximate quantiles, ranked inside each
range, and moved on by what lies in the ranges before it.  The approximate quantiles
only decide how evenly the work is dealt, never a rank.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of values for each group.
SLICES = 64
#: Rank error of approximate quantiles: at most one part in so many of the rows.
ACCURACY = 10_000
_ONE = "_all"


def ranked(df: DataFrame, by: Sequence[str], value: str, descending: bool = False) -> DataFrame:
    """by, value, times, rows_before and sum_before of every distinct value of a group, n and total of the group.

    ``before`` means smaller values, or larger ones with ``descending``.  Rows with a null
    value are left out; a null key is a group.
    """
    keys = list(by) or [_ONE]
    rows = df if by else df.withColumn(_ONE, F.lit(0))
    counted = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("times"))
    cuts = counted.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        F.percentile_approx(value, [i / SLICES for i in range(1, SLICES)], 1000).alias("_cuts")
    )
    at = [counted[k].eqNullSafe(cuts[f"_k{i}"]) for i, k in enumerate(keys)]
    dealt = counted.join(cuts, at).withColumn("_slice", F.size(F.filter("_cuts", lambda c: c < F.col(value)))).select(*keys, value, "times", "_slice")
    order = F.desc(value) if descending else F.asc(value)
    mass = F.col(value) * F.col("times")
    earlier = Window.partitionBy(*keys, "_slice").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    inside = dealt.withColumn("_n0", F.coalesce(F.sum("times").over(earlier), F.lit(0))).withColumn("_s0", F.coalesce(F.sum(mass).over(earlier), F.lit(0.0)))
    slices = dealt.groupBy(*keys, "_slice").agg(F.sum("times").alias("_n"), F.sum(mass).alias("_s"))
    # at most SLICES rows for each group
    group = Window.partitionBy(*keys)
    past = group.orderBy(F.desc("_slice") if descending else F.asc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    moved = slices.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_slice").alias("_of"), F.coalesce(F.sum("_n").over(past), F.lit(0)).alias("_n1"),
        F.coalesce(F.sum("_s").over(past), F.lit(0.0)).alias("_s1"), F.sum("_n").over(group).alias("n"), F.sum("_s").over(group).alias("total"),
    )
    same = [inside[k].eqNullSafe(moved[f"_k{i}"]) for i, k in enumerate(keys)]
    return inside.join(moved, [*same, inside["_slice"] == moved["_of"]]).select(
        *by, value, "times", (F.col("_n0") + F.col("_n1")).alias("rows_before"), (F.col("_s0") + F.col("_s1")).alias("sum_before"), "n", "total"
    )


def quantiles(df: DataFrame, by: Sequence[str], value: str, parts: Mapping[str, float]) -> DataFrame:
    """Exact quantiles of each group, interpolated between neighbours: by and one column for each name in ``parts``.

    Approximate quantiles, whose error in rank is bounded, bracket each one; a second pass counts the
    rows outside the bracket and ranks only the values inside.  Groups are joined by equal keys, so
    a null key is left out.
    """
    keys = list(by) or [_ONE]
    rows = (df if by else df.withColumn(_ONE, F.lit(0))).where(F.col(value).isNotNull()).select(*keys, value)
    inner = {name: p for name, p in parts.items() if 0 < p < 1}
    slack = 2 / ACCURACY
    ends = [x for p in inner.values() for x in (max(0.0, p - slack), min(1.0, p + slack))]
    # the ends of the range are aggregates of the first pass and go along with every bracket
    range_ = [F.min(value).cast("double").alias("_least"), F.max(value).cast("double").alias("_greatest")]
    if not inner:
        return rows.groupBy(*keys).agg(*range_).select(*by, *[F.col("_greatest" if p else "_least").alias(name) for name, p in parts.items()])
    guess = rows.groupBy(*keys).agg(F.percentile_approx(value, ends, ACCURACY).alias("_e"), F.count("*").alias("_n"), *range_)
    brackets = [
        F.struct(F.lit(i).alias("i"), F.get("_e", F.lit(2 * i)).alias("low"), F.get("_e", F.lit(2 * i + 1)).alias("high"), (F.lit(float(p)) * (F.col("_n") - 1)).alias("spot"))
        for i, p in enumerate(inner.values())
    ]
    met = rows.join(guess.select(*keys, "_least", "_greatest", F.explode(F.array(*brackets)).alias("_q")), keys)
    v, low, high = F.col(value), F.col("_q.low"), F.col("_q.high")
    side = F.when(v < low, -1).when(v > high, 1).otherwise(0)
    # what lies below a bracket is one row, known by its largest value, and what lies above one by its smallest:
    # a neighbour of the place sought is at most one row outside
    same = [F.first(c).alias(c) for c in ("_least", "_greatest")]
    counted = met.groupBy(*keys, F.col("_q.i").alias("_i"), F.col("_q.spot").alias("_spot"), side.alias("_side"), F.when(side == 0, v).alias("_in")).agg(
        F.count("*").alias("_c"), F.when(F.first(side) < 0, F.max(v)).otherwise(F.min(v)).alias("_v"), *same
    )
    order = Window.partitionBy(*keys, "_i").orderBy("_side", "_in")
    placed = counted.withColumn("_end", F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, 0)))

    def at(place: Column) -> Column:
        return F.max(F.when((F.col("_end") - F.col("_c") <= place) & (place < F.col("_end")), F.col("_v")))

    low, high, spot = at(F.floor("_spot")), at(F.ceil("_spot")), F.max("_spot")
    found = placed.groupBy(*keys, "_i").agg((low + (high - low) * (spot - F.floor(spot))).cast("double").alias("_x"), *same)
    place = {name: i for i, name in enumerate(inner)}
    out = {name: F.max(F.when(F.col("_i") == place[name], F.col("_x"))) if name in place else F.first("_greatest" if p else "_least") for name, p in parts.items()}
    return found.groupBy(*keys).agg(*[c.alias(name) for name, c in out.items()]).select(*by, *parts)
