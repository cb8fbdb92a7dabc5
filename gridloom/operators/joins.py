"""Broadcast hints for tables that are counted first, and aggregates beside their rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written

#: Groups whose aggregates are broadcast.
GROUP_ROWS = 100_000


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether a table has at most so many rows; a job that counts no further than that."""
    return df.limit(rows + 1).count() <= rows


def hinted(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, else as it is, for a shuffled join."""
    return F.broadcast(df) if at_most(df, rows) else df


def dealt(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """``df`` over so many tasks by ``key`` that each has about ``rows`` rows, however large the table; fewer rows stay as they are."""
    n = df.count()
    return df if n <= rows else df.repartition(n // rows + 1, *key)


def shuffled(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """An inner join that is never a broadcast: the planner takes the size of an exploded table for that of its files."""
    return left.hint("merge").join(right.hint("merge"), on)


def beside(df: DataFrame, by: Sequence[str], *aggregates: Column) -> DataFrame:
    """``df`` with the named aggregates of its group beside each row; null keys are a group.

    The aggregates are combined before they are shuffled and joined back, so that no group,
    however large, has to be in one task as for a window.
    """
    if not by:
        return df.crossJoin(F.broadcast(df.agg(*aggregates)))
    stats = df.groupBy(*by).agg(*aggregates)
    keys = {k: f"_by{i}" for i, k in enumerate(by)}
    stats = stats.withColumnsRenamed(keys)
    same = [df[k].eqNullSafe(stats[name]) for k, name in keys.items()]
    return df.join(stats, same).drop(*keys.values())


def beside_written(df: DataFrame, by: Sequence[str], *aggregates: Column) -> DataFrame:
    """As :func:`beside` for a table that is cheap to read twice: the aggregates are written first, and up to GROUP_ROWS groups are
    broadcast, so that the rows are not shuffled."""
    stats = written(df.groupBy(*by).agg(*aggregates), "stats").withColumnsRenamed({k: f"_by{i}" for i, k in enumerate(by)})
    same = [df[k].eqNullSafe(stats[f"_by{i}"]) for i, k in enumerate(by)]
    return df.join(hinted(stats, GROUP_ROWS), same).drop(*[f"_by{i}" for i in range(len(by))])


def required(df: DataFrame, table: DataFrame, key: str, value: str) -> DataFrame:
    """``df`` with the value of a lookup table; a key that the table lacks is an error."""
    known = table.select(key, F.col(value).alias("_value"), F.lit(True).alias("_known"))
    missing = F.raise_error(F.concat(F.lit(f"no {value} for {key} "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    checked = F.when(F.col("_known"), F.col("_value")).otherwise(missing.cast(table.schema[value].dataType))
    return df.join(known, key, "left").withColumn(value, checked).drop("_value", "_known")
