"""Weights within cells and scores: ratio to report, z-scores, scaling."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import clip01
from .joins import beside, beside_written, hinted
from .ranking import quantiles

#: Pollutants with their mix of groups are broadcast up to this many.
ALPHA_ROWS = 10_000
#: Stored weights: a cell fails above, is repaired above, and is noted as clipped below these.
FAIL, REPAIR, CLIP = 5e-2, 1e-6, 1.5e-2


def weights(df: DataFrame, signal: str, by: Sequence[str], out: str = "weight", uniform: bool = True) -> DataFrame:
    """Share of each row in its cell; a cell without signal is shared evenly (or gets 0).

    A null signal has weight 0 and counts neither in the sum nor in the even share; rows with
    cell_id -1 have weight 0.
    """
    used = F.col(signal).isNotNull()
    keys = list(by)
    if "cell_id" in by:
        used = used & (F.col("cell_id") >= 0)
        keys.append("_spread")
        df = df.withColumn("_spread", _spread(df))
    w = Window.partitionBy(*keys)
    total, n = F.sum(signal).over(w), F.count(signal).over(w)
    share = F.when(total > 0, F.col(signal) / total).otherwise(F.try_divide(F.lit(1.0), n) if uniform else F.lit(0.0))
    return df.withColumn(out, F.when(used, share).otherwise(0.0)).drop("_spread")


def _spread(df: DataFrame) -> Column:
    """0 inside the grid; for the rows of no cell, which have weight 0 whatever their sum, one of 1024 numbers,
    so that they are dealt over tasks.  A cell itself holds no more pixels than fit into it."""
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() != "map"]
    return F.when(F.col("cell_id") >= 0, 0).otherwise(F.pmod(F.xxhash64(*plain), F.lit(1024))).cast("int")


def fuse(df: DataFrame, alpha: DataFrame, pixel: Sequence[str]) -> DataFrame:
    """Mix group weights by alpha(pollutant, group, alpha) and normalise again per cell.

    Input rows: pixel columns, cell_id, group, weight.
    """
    mixed = df.join(alpha.where(F.col("alpha") != 0), "group")
    mixed = mixed.groupBy("pollutant", "cell_id", *pixel).agg(F.sum(F.col("alpha") * F.col("weight")).alias("signal"))
    return weights(mixed, "signal", ["pollutant", "cell_id"])


def fused(df: DataFrame, signals: Mapping[str, Column], alpha: DataFrame, pixel: Sequence[str]) -> DataFrame:
    """Weights of every pollutant from one row a pixel: pollutant, cell_id, pixel columns, signal, weight.

    ``signals`` gives the signal of each group.  Each is shared out in its cell, mixed by
    alpha(pollutant, group, alpha) and shared out again.  alpha has a row for each pollutant and group.

    Only the sums of signals in each cell are shuffled.  The shares of a group sum to 1 in a cell, so a mix of them sums to its alphas.
    """
    names, n, cell = list(signals), F.col("_n"), F.col("cell_id")
    rows = _summed(df, signals, pixel)
    for i in range(len(names)):
        rows = rows.withColumn(f"_w{i}", F.when(F.col(f"_t{i}") > 0, F.col(f"_s{i}") / F.col(f"_t{i}")).otherwise(1.0 / n))
    table = _mixes(alpha.where(F.col("alpha") != 0), "group", "alpha", names)
    signal, total = _mixed("_w", names), sum((F.coalesce(f"_m{i}", F.lit(0.0)) for i in range(len(names))), F.lit(0.0))
    mixed = rows.crossJoin(hinted(table, ALPHA_ROWS)).select("pollutant", *pixel, "cell_id", signal.alias("signal"), total.alias("_all"), "_n")
    share = F.when(F.col("_all") > 0, F.col("signal") / F.col("_all")).otherwise(1.0 / n)
    return mixed.withColumn("weight", F.when(cell >= 0, share).otherwise(0.0)).drop("_all", "_n")


def loaded(df: DataFrame, loads: Mapping[str, Column], factors: DataFrame, pixel: Sequence[str]) -> DataFrame:
    """Weights of every pollutant from one row a pixel: pollutant, cell_id, pixel columns, signal, weight.

    The signal is the sum of ``loads`` times factors(pollutant, k, m), shared out in its cell; as for :func:`fused` only sums in cells are shuffled.
    """
    names = list(loads)
    table = _mixes(factors, "k", "m", names)
    mixed = _summed(df, loads, pixel).crossJoin(hinted(table, ALPHA_ROWS))
    mixed = mixed.select("pollutant", *pixel, "cell_id", _mixed("_s", names).alias("signal"), _mixed("_t", names).alias("_all"), "_n")
    share = F.when(F.col("_all") > 0, F.col("signal") / F.col("_all")).otherwise(1.0 / F.col("_n"))
    return mixed.withColumn("weight", F.when(F.col("cell_id") >= 0, share).otherwise(0.0)).drop("_all", "_n")


def _summed(df: DataFrame, signals: Mapping[str, Column], pixel: Sequence[str]) -> DataFrame:
    """Pixel columns, cell_id, the signals as _s0, _s1, ... (null: 0), their sums in the cell as _t0, ... and its rows as _n."""
    rows = df.select(*pixel, "cell_id", *[F.coalesce(c, F.lit(0.0)).alias(f"_s{i}") for i, c in enumerate(signals.values())])
    return beside_written(rows, ["cell_id"], F.count("*").alias("_n"), *[F.sum(f"_s{i}").alias(f"_t{i}") for i in range(len(signals))])


def _mixes(table: DataFrame, name: str, value: str, names: Sequence[str]) -> DataFrame:
    """One row a pollutant with the values of ``names`` as _m0, _m1, ..."""
    return table.groupBy("pollutant").agg(*[F.sum(F.when(F.col(name) == g, F.col(value))).alias(f"_m{i}") for i, g in enumerate(names)])


def _mixed(prefix: str, names: Sequence[str]) -> Column:
    parts = (F.when(F.col(f"_m{i}") != 0, F.col(f"_m{i}") * F.col(f"{prefix}{i}")).otherwise(0.0) for i in range(len(names)))
    return sum(parts, F.lit(0.0))


def check_weights(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group of weights: cells checked, those off by more than FAIL, those to repair, passed."""
    sums = df.groupBy(*by, "cell_id").agg(F.sum("weight").alias("s"))
    off = F.abs(F.col("s") - 1)
    return sums.groupBy(*by).agg(
        F.count("*").alias("cells_checked"),
        F.count(F.when(off > FAIL, 1)).alias("failures"),
        F.count(F.when((off > REPAIR) & (off <= FAIL), 1)).alias("repairs"),
    ).withColumn("passed", F.col("failures") == 0)


def clipped_z(df: DataFrame, value: str, out: str, by: Sequence[str] = (), quantile: float = 0.99) -> DataFrame:
    """z-score of values capped at an exact quantile, scaled to 0..1; 1 where all are equal.

    Scaling takes mean and deviation out again: what is left is the place between the least and
    the greatest capped value.  Both come with the quantile and are joined back, one row for each group.
    """
    ends = quantiles(df, by, value, {"_lo": 0.0, "_cap": quantile, "_hi": 1.0})
    both = df.join(ends, list(by)) if by else df.crossJoin(F.broadcast(ends))
    v, low, high = F.least(F.col(value), F.col("_cap")), F.col("_lo"), F.least("_hi", "_cap")
    scaled = F.when(high > low, (v - low) / (high - low)).otherwise(F.lit(1.0))
    return both.withColumn(out, F.when(F.col(value).isNotNull(), scaled)).drop("_lo", "_cap", "_hi")


def cell_score(df: DataFrame, value: str, out: str, by: Sequence[str] = ("cell_id",), beside: Callable[..., DataFrame] = beside) -> DataFrame:
    """Per cell z-score scaled to 0..1 over values above 0; 1 for a single or flat value, 0 for the rest."""
    v = F.when(F.col(value) > 0, F.col(value))
    low, high = F.col("_low"), F.col("_high")
    both = beside(df, by, F.min(v).alias("_low"), F.max(v).alias("_high"))
    return both.withColumn(out, F.when(v.isNull(), 0.0).when(high > low, (v - low) / (high - low)).otherwise(1.0)).drop("_low", "_high")


def max_scaled(df: DataFrame, value: str, out: str, by: Sequence[str] = (), eps: float = 1e-12) -> DataFrame:
    """value / (max + eps), over all rows or per group."""
    return beside(df, by, F.max(value).alias("_top")).withColumn(out, F.col(value) / (F.col("_top") + eps)).drop("_top")


def to_target(df: DataFrame, value: str, region: str, target: str, out: str, beside: Callable[..., DataFrame] = beside) -> DataFrame:
    """Rescale values so that each region sums to its target; nothing to scale gives 0."""
    both = beside(df, [region], F.sum(value).alias("_total"))
    return both.withColumn(out, F.when(F.col("_total") > 0, F.col(value) * F.col(target) / F.col("_total")).otherwise(0.0)).drop("_total")


def mixture(parts: Sequence[tuple[float, Column]], unit: bool = True) -> Column:
    """Weighted sum of signals, each cut to 0..1 first unless ``unit`` is False."""
    total: Column = F.lit(0.0)
    for weight, signal in parts:
        if weight:
            total = total + weight * (clip01(signal) if unit else F.coalesce(signal, F.lit(0.0)))
    return total
