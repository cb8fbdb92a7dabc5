"""Road lines: shares within cells, clipping and mass correction."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import clip_length_share
from ..functions.numeric import KG_PER_YEAR_TO_G_PER_S
from .joins import at_most
from .spatial import dealt, walk

#: Factors are broadcast if the target has at most so many rows.
TARGET_ROWS = 10_000

#: Weight and width of road classes.
WEIGHT = {"motorway": 10.0, "trunk": 5.0, "primary": 2.0, "secondary": 2.0}
WIDTH = {"motorway": 20.0, "trunk": 16.0, "primary": 12.0, "secondary": 12.0}
WEIGHT_WITH_TERTIARY = WEIGHT | {"tertiary": 1.0}
WIDTH_WITH_TERTIARY = WIDTH | {"tertiary": 8.0}


def segments_in_cells(segments: DataFrame, step: float) -> DataFrame:
    """Every cell (r, c) that a segment (x1, y1, x2, y2) passes through, with the length inside.

    A segment gives a row for each cell it touches, which is then clipped exactly.
    """
    s = walk(dealt(segments), step).withColumnsRenamed({"row": "r", "col": "c"})
    box = (F.col("c") * step, F.col("r") * step, (F.col("c") + 1) * step, (F.col("r") + 1) * step)
    share = clip_length_share(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"), box)
    length = F.sqrt(F.pow(F.col("x2") - F.col("x1"), 2) + F.pow(F.col("y2") - F.col("y1"), 2))
    return s.withColumn("inside", share * length).where(F.col("inside") > 0)


def line_shares(df: DataFrame, length: str, mass: str, weights: Mapping[str, float] = WEIGHT) -> DataFrame:
    """Mass of each line in its cell: first by weight over the road groups present, then by length in the group.

    Columns cell_id, group (null or unknown groups are left out), ``length``, ``mass`` of the cell.
    """
    table = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
    d = df.withColumn("_w", F.try_element_at(table, F.col("group"))).where(F.col("_w").isNotNull() & (F.col(length) > 0))
    own = Window.partitionBy("cell_id", "group")
    first = F.row_number().over(own.orderBy(length)) == 1
    d = d.withColumn("_one", F.when(first, F.col("_w")).otherwise(0.0))
    share = F.col(length) / F.sum(length).over(own) * F.col("_w") / F.sum("_one").over(Window.partitionBy("cell_id"))
    return d.withColumn("line_mass", share * F.col(mass)).drop("_w", "_one")


def correct_mass(lines: DataFrame, target: DataFrame, value: str) -> DataFrame:
    """Scale lines so that they sum to the target (pollutant, total) of each pollutant; without a target they stay."""
    have = lines.groupBy("pollutant").agg(F.sum(value).alias("_have"))
    factor = have.join(target, "pollutant").select("pollutant", (F.col("total") / F.nullif("_have", F.lit(0.0))).alias("_f"))
    # there are no more factors than target rows
    return lines.join(F.broadcast(factor) if at_most(target, TARGET_ROWS) else factor, "pollutant", "left").withColumn(value, F.col(value) * F.coalesce("_f", F.lit(1.0))).drop("_f")


def grams_per_second(c: Column) -> Column:
    return c * KG_PER_YEAR_TO_G_PER_S


def weighted_flow(df: DataFrame, by: list[str], flow: str, length: str) -> DataFrame:
    """Length-weighted mean, lines of no length left out."""
    d = df.where(F.col(length) > 0)
    return d.groupBy(*by).agg((F.sum(F.col(flow) * F.col(length)) / F.sum(length)).alias(flow))


def fleet_share(df: DataFrame, by: list[str], classes: list[str], total: str) -> DataFrame:
    """Share of each vehicle class in the total, or in the sum of classes where that is 0; both 0 is an error."""
    sums = df.groupBy(*by).agg(*[F.sum(c).alias(c) for c in classes], F.sum(total).alias("_t"))
    every = sum((F.col(c) for c in classes[1:]), F.col(classes[0]))
    base = F.coalesce(F.nullif("_t", F.lit(0.0)), F.nullif(every, F.lit(0.0)))
    base = F.when(base.isNull(), F.raise_error(F.lit("no traffic"))).otherwise(base).cast("double")
    return sums.select(*by, *[(F.col(c) / base).alias(c) for c in classes])
