"""Questions about emission tables: composition, concentration, distribution, scales."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ranking import quantiles, ranked


def composition(df: DataFrame, outer: str, inner: str, value: str) -> DataFrame:
    """Totals by outer and inner, per outer and overall (null keys), with the percentage of the outer total."""
    r = df.rollup(outer, inner).agg(F.sum(value).alias("total"), F.grouping_id().alias("level"))
    top = F.max(F.when(F.col("level") > 0, F.col("total"))).over(Window.partitionBy(outer, F.col("level") == 3))
    return r.withColumn("percent", F.when(top > 0, 100 * F.col("total") / top).otherwise(0.0))


def gini(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Gini coefficient of the positive values of each group."""
    r = ranked(df.where(F.col(value) > 0), by, value)
    # the ranks of equal values follow each other, so their sum stands for them
    ranks = F.col("times") * F.col("rows_before") + F.col("times") * (F.col("times") + 1) / 2
    n = F.max("n")
    return r.groupBy(*by).agg((2 * F.sum(ranks * F.col(value)) / (n * F.max("total")) - (n + 1) / n).alias("gini"))


def lorenz(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Cumulative share of the largest values at each tenth of the rows: (p, share), in percent.

    The row at tenth p is max(1, min(n, round(p * n))), half to even.
    """
    r = ranked(df.where(F.col(value) > 0), by, value, descending=True).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(10))))
    at = F.greatest(F.lit(1), F.least(F.col("n"), F.bround(F.col("k") * F.col("n") / 10).cast("long")))
    here = (F.col("rows_before") < at) & (at <= F.col("rows_before") + F.col("times"))
    share = 100 * (F.col("sum_before") + F.col(value) * (at - F.col("rows_before"))) / F.col("total")
    return r.where(here).select(*by, (F.col("k") * 10).alias("p"), share.alias("share"))


def reaching(df: DataFrame, by: Sequence[str], value: str, percent: float = 90.0) -> DataFrame:
    """Percentage of rows, largest first, that first reach ``percent`` of the total."""
    r = ranked(df.where(F.col(value) > 0), by, value, descending=True)
    share = lambda rows: 100 * (F.col("sum_before") + F.col(value) * rows) / F.col("total")
    # so many of the equal rows are wanted at least; rounding may want one more
    rows = F.greatest(F.lit(1), F.ceil((F.lit(percent) * F.col("total") / 100 - F.col("sum_before")) / F.col(value)))
    rows = F.when(share(rows) >= percent, rows).otherwise(rows + 1)
    first = F.min(F.when(rows <= F.col("times"), F.col("rows_before") + rows))
    return r.groupBy(*by).agg((100.0 * first / F.max("n")).alias("reach"))


def running_share(df: DataFrame, by: Sequence[str], value: str, tie: str, out: str = "share") -> DataFrame:
    """Positive rows with the percentage of their group's total down to them, largest first, ties by ``tie``."""
    rows = df.where(F.col(value) > 0).withColumn("_i", F.row_number().over(Window.partitionBy(*by, value).orderBy(tie)))
    r = ranked(df.where(F.col(value) > 0), by, value, descending=True).select(*by, value, "sum_before", "total")
    return rows.join(r, [*by, value]).withColumn(out, 100 * (F.col("sum_before") + F.col(value) * F.col("_i")) / F.col("total")).drop("_i", "sum_before", "total")


def histogram(df: DataFrame, value: str, bins: int, log: bool = False) -> DataFrame:
    """Equal-width counts (bin, n); the last bin is closed.  With ``log`` over log10 of positive values."""
    v = F.log10(value) if log else F.col(value)
    d = df.where(F.col(value) > 0 if log else F.col(value).isNotNull()).select(v.alias("_v"))
    ends = d.agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    place = F.when(width > 0, F.least(F.floor((F.col("_v") - F.col("_lo")) / width), F.lit(bins - 1))).otherwise(0)
    return d.crossJoin(F.broadcast(ends)).groupBy(place.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def scale(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Colour scale: log10(v + 0.01) at 5 and 95 %, raw values at 25, 50, 75 and 98 %, all exact."""
    good = df.where(F.col(value) > 0)
    raw = quantiles(good, by, value, {f"p{p}": p / 100 for p in (25, 50, 75, 98)})
    logs = quantiles(good.select(*by, F.log10(F.col(value) + 0.01).alias("_log")), by, "_log", {"log_p5": 0.05, "log_p95": 0.95})
    return raw.join(logs, list(by)).select(*by, "log_p5", "log_p95", *[f"p{p}" for p in (25, 50, 75, 98)])


def median_ratio(df: DataFrame, by: Sequence[str], value: str, out: str = "ratio") -> DataFrame:
    """Each value over the exact median of its group."""
    return df.join(quantiles(df, by, value, {"_median": 0.5}), list(by)).withColumn(out, F.col(value) / F.col("_median")).drop("_median")


def dominant(df: DataFrame, by: Sequence[str], label: str, value: str) -> DataFrame:
    """Label with the largest sum in each group (ties: least label), its sum and the group's."""
    sums = df.groupBy(*by, label).agg(F.sum(value).alias("_s"))
    return sums.groupBy(*by).agg(F.min_by(label, F.struct(-F.col("_s"), F.col(label))).alias("dominant"), F.max("_s").alias("top"), F.sum("_s").alias("total"))


def spacing(df: DataFrame, coordinate: str) -> DataFrame:
    """Median gap between neighbouring distinct coordinates."""
    r = ranked(df.select(coordinate).distinct(), [], coordinate).select(coordinate, "rows_before")
    after = r.select(F.col(coordinate).alias("_next"), (F.col("rows_before") - 1).alias("rows_before"))
    gaps = r.join(after, "rows_before").select((F.col("_next") - F.col(coordinate)).alias("_g"))
    return quantiles(gaps, [], "_g", {"spacing": 0.5})


def coverage(df: DataFrame, group: str, cell: str) -> DataFrame:
    """Cells of each group, and how many of them the largest group (ties: least name) lacks."""
    sizes = df.groupBy(group).agg(F.count_distinct(cell).alias("n_cells"))
    best = sizes.agg(F.min_by(group, F.struct(-F.col("n_cells"), F.col(group))).alias("_g"))
    base = df.join(F.broadcast(best), df[group] == best["_g"]).select(F.col(cell).alias("_cell")).distinct()
    outside = df.select(group, cell).distinct().join(base, F.col(cell) == F.col("_cell"), "left_anti").groupBy(group).agg(F.count("*").alias("outside"))
    return sizes.join(outside, group, "left").fillna(0, ["outside"])


def mass_balance(before: DataFrame, after: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    a = before.groupBy(*by).agg(F.sum(value).alias("before"))
    b = after.groupBy(*by).agg(F.sum(value).alias("after"))
    return a.join(b, list(by), "full_outer").fillna(0.0, ["before", "after"]).withColumn("difference", F.col("after") - F.col("before"))


def allocation_balance(sources: DataFrame, links: DataFrame, by: Sequence[str]) -> DataFrame:
    """What became of the mass of sources: total, distributed over facilities, unmatched, difference and that in percent.

    sources: source_id, mass; links: source_id, facility_id (null: unmatched), mass of the source and attributed;
    the attributed parts of a source may be summed before.
    """
    total = sources.groupBy(*by).agg(F.sum("mass").alias("total"))
    met = F.col("facility_id").isNotNull()
    parts = links.groupBy(*by).agg(F.sum(F.when(met, F.col("attributed"))).alias("distributed"), F.sum(F.when(~met, F.col("mass"))).alias("unmatched"))
    out = total.join(parts, list(by), "left").fillna(0.0, ["distributed", "unmatched"])
    out = out.withColumn("difference", F.col("total") - F.col("distributed") - F.col("unmatched"))
    return out.withColumn("percent", F.when(F.col("total") > 0, F.col("difference") / F.col("total") * 100).otherwise(0.0))
