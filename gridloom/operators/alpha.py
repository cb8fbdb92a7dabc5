"""Splitting national totals over groups: alpha matrices, fuel splits, sums of products."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import hinted

#: Tables of groups and fuels are broadcast up to this many rows.
GROUP_ROWS = 10_000


def group_emissions(reported: DataFrame, groups: DataFrame) -> DataFrame:
    """Emissions by (country, pollutant, group); codes of no group are dropped.

    reported: country, pollutant, sector, total; groups: sector, group (a code in one group only).
    """
    mapped = reported.join(groups, "sector")
    return mapped.groupBy("country", "pollutant", "group").agg(F.sum("total").alias("E"))


def ambiguous_codes(groups: DataFrame) -> DataFrame:
    """Codes that stand in more than one group: an error in the configuration."""
    return groups.groupBy("sector").agg(F.count_distinct("group").alias("n")).where(F.col("n") > 1)


def dense(e: DataFrame, groups: DataFrame) -> DataFrame:
    """A row for each (country, pollutant) and every group, 0 where nothing is reported."""
    keys = e.select("country", "pollutant").distinct().crossJoin(hinted(groups.select("group").distinct(), GROUP_ROWS))
    return keys.join(e, ["country", "pollutant", "group"], "left").fillna(0.0, ["E"])


def national(e: DataFrame) -> DataFrame:
    """Method 0: each group's share of the country's sum; null where that is 0."""
    total = F.sum("E").over(Window.partitionBy("country", "pollutant"))
    return e.withColumn("alpha", F.when(total > 0, F.col("E") / total))


def pool(e: DataFrame, members: Sequence[str] | None = None) -> DataFrame:
    """Method 1: mean of the members' normalised vectors, countries that sum to 0 left out, normalised again."""
    own = national(e).where(F.col("alpha").isNotNull())
    if members is not None:
        own = own.where(F.col("country").isin(*members))
    mean = own.groupBy("pollutant", "group").agg(F.avg("alpha").alias("_m"))
    total = F.sum("_m").over(Window.partitionBy("pollutant"))
    return mean.select("pollutant", "group", (F.col("_m") / total).alias("alpha"))


def fixed(given: DataFrame) -> DataFrame:
    """Method 2: configured weights (pollutant, group, weight), normalised; uniform if they sum to 0."""
    w = Window.partitionBy("pollutant")
    total = F.sum(F.greatest(F.col("weight"), F.lit(0.0))).over(w)
    share = F.when(total > 0, F.greatest(F.col("weight"), F.lit(0.0)) / total).otherwise(1.0 / F.count("*").over(w))
    return given.select("pollutant", "group", share.alias("alpha"))


def uniform(keys: DataFrame) -> DataFrame:
    """Method 3: the same for every group of a pollutant."""
    return keys.select("pollutant", "group").distinct().withColumn("alpha", 1.0 / F.count("*").over(Window.partitionBy("pollutant")))


def alpha_matrix(e: DataFrame, methods: DataFrame, country: str, given: DataFrame | None = None, members: Sequence[str] | None = None) -> DataFrame:
    """alpha(pollutant, group, alpha, method) of a country.

    ``e`` is dense; methods: pollutant, method 0-3.  A country without emissions takes the
    pool, and what is still open is uniform.
    """
    own = e.where(F.col("country") == country)
    t = own.select("pollutant", "group", "E").join(methods, "pollutant")
    t = t.join(national(own).select("pollutant", "group", F.col("alpha").alias("_a0")), ["pollutant", "group"], "left")
    t = t.join(pool(e, members).withColumnRenamed("alpha", "_a1"), ["pollutant", "group"], "left")
    two = fixed(given).withColumnRenamed("alpha", "_a2") if given is not None else None
    t = t.join(two, ["pollutant", "group"], "left") if two is not None else t.withColumn("_a2", F.lit(None).cast("double"))
    n = F.count("*").over(Window.partitionBy("pollutant"))
    even = 1.0 / n
    chosen = (
        F.when(F.col("method") == 0, F.coalesce("_a0", "_a1"))
        .when(F.col("method") == 1, F.col("_a1"))
        .when(F.col("method") == 2, F.col("_a2"))
        .when(F.col("method") == 3, even)
        .otherwise(F.raise_error(F.lit("no such alpha method")).cast("double"))
    )
    return t.select("pollutant", "group", "E", "method", F.coalesce(chosen, even).alias("alpha"))


def product_sum(a: DataFrame, b: DataFrame, on: Sequence[str], keep: Sequence[str], x: str, y: str, out: str) -> DataFrame:
    """Contraction of two long tensors: join on shared dimensions, sum of products over the rest."""
    return a.join(b, list(on)).groupBy(*keep).agg(F.sum(F.col(x) * F.col(y)).alias(out))


def share_of(df: DataFrame, by: Sequence[str], value: str, out: str) -> DataFrame:
    """Ratio to report; null where the total is 0."""
    total = F.sum(value).over(Window.partitionBy(*by))
    return df.withColumn(out, F.when(total > 0, F.col(value) / total))


def split_with_cascade(counts: DataFrame, classes: DataFrame, country: str, default: str) -> DataFrame:
    """Fuel shares per class: of the country, else of all countries, else everything to ``default``.

    counts: country, class, fuel, n (negative and null counts are skipped); classes: class.
    """
    good = counts.where((F.col("n") >= 0) & (F.upper("fuel") != "TOTAL"))
    own = share_of(good.where(F.col("country") == country).groupBy("class", "fuel").agg(F.sum("n").alias("n")), ["class"], "n", "own")
    every = share_of(good.groupBy("class", "fuel").agg(F.sum("n").alias("n")), ["class"], "n", "every")
    fuels = good.select("fuel").distinct().union(classes.sparkSession.createDataFrame([(default,)], "fuel string")).distinct()
    grid = classes.crossJoin(hinted(fuels, GROUP_ROWS))
    t = grid.join(own.select("class", "fuel", "own"), ["class", "fuel"], "left").join(every.select("class", "fuel", "every"), ["class", "fuel"], "left")
    w = Window.partitionBy("class")
    has_own, has_every = F.max(F.col("own").isNotNull()).over(w), F.max(F.col("every").isNotNull()).over(w)
    zero = F.lit(0.0)
    share = F.when(has_own, F.coalesce("own", zero)).when(has_every, F.coalesce("every", zero)).otherwise((F.col("fuel") == default).cast("double"))
    return t.select("class", "fuel", share.alias("share"))


def regional_mean(df: DataFrame, region: str, parent: str, value: str, least: int, least_parent: int) -> DataFrame:
    """Mean of each region if it has ``least`` values, else of its parent, else of all: (region, mean, level)."""
    a = df.groupBy(region, parent).agg(F.avg(value).alias("_m"), F.count(value).alias("_n"))
    b = df.groupBy(parent).agg(F.avg(value).alias("_pm"), F.count(value).alias("_pn"))
    c = df.agg(F.avg(value).alias("_all"))
    t = a.join(b, parent).crossJoin(F.broadcast(c))
    own, up = F.col("_n") >= least, F.col("_pn") >= least_parent
    mean = F.when(own, F.col("_m")).when(up, F.col("_pm")).otherwise(F.col("_all"))
    return t.select(region, mean.alias("mean"), F.when(own, 0).when(up, 1).otherwise(2).alias("level"))


def best_factor(rows: DataFrame, factors: DataFrame, text: str, factor_text: str, order: str) -> DataFrame:
    """For each row the factor of its class and fuel whose text shares most tokens (ties: least ``order``).

    rows: row_id, class, fuel, ``text``; factors: classes array, fuels array, ``factor_text``, ``order``, ef.
    """
    from ..functions.text import token_overlap

    f = factors.withColumn("class", F.explode("classes")).withColumn("fuel", F.explode("fuels"))
    j = rows.join(f, ["class", "fuel"]).withColumn("_k", token_overlap(F.col(text), F.col(factor_text)))
    picked = j.groupBy("row_id").agg(F.min_by(F.struct("ef", order, "_k"), F.struct(-F.col("_k"), F.col(order))).alias("_r"))
    return picked.select("row_id", F.col("_r.ef").alias("ef"), F.col(f"_r.{order}").alias(order), F.col("_r._k").alias("overlap"))
