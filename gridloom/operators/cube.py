"""Statistical cubes in JSON-stat form as long tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = (
    "id array<string>, size array<int>, value string, "
    "dimension map<string, struct<label:string, category:struct<index:map<string,int>, label:map<string,string>>>>"
)


def values(df: DataFrame, column: str) -> DataFrame:
    """Explode the value block, a dense list or a sparse object: adds at, value.  Nulls are left out."""
    text = F.trim(F.col(column))
    sparse = F.from_json(text, "map<string,double>")
    listed = F.from_json(text, "array<double>")
    as_map = F.when(text.startswith("["), F.map_from_arrays(F.transform(F.sequence(F.lit(0), F.size(listed) - 1), lambda i: i.cast("string")), listed)).otherwise(sparse)
    rest = [c for c in df.columns if c != column]
    out = df.select(*rest, F.explode(as_map).alias("_k", "_v"))
    return out.select(*rest, F.col("_k").cast("long").alias("at"), F.col("_v").alias("value")).where(F.col("value").isNotNull())


def unroll(cube: DataFrame, dims: list[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row for each observation: the columns to ``keep`` of its cube, the codes of ``dims`` and value.

    ``cube`` has the columns of SCHEMA.  The place is row-major over ``id``, last dimension fastest.
    """
    v = values(cube, "value")
    n = F.size("id")

    def stride(i):
        later = F.slice("size", i + 2, n)
        return F.aggregate(later, F.lit(1).cast("long"), lambda a, s: a * s)

    place = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.floor(F.col("at") / stride(i)) % F.get("size", i))
    v = v.withColumn("_place", place)

    def code(dim: str):
        i = F.array_position("id", dim).cast("int") - 1
        index = F.element_at(F.col("dimension"), dim)["category"]["index"]
        swapped = F.map_from_entries(F.transform(F.map_entries(index), lambda e: F.struct(e["value"].alias("k"), e["key"].alias("v"))))
        return F.element_at(swapped, F.get("_place", i).cast("int"))

    return v.select(*keep, *[code(d).alias(d) for d in dims], "value")


def observation(long: DataFrame, **codes: str) -> DataFrame:
    """The value at one place, null if it is missing or negative: always one row."""
    hit = F.lit(True)
    for dim, c in codes.items():
        hit = hit & (F.col(dim) == c)
    v = F.max(F.when(hit, F.col("value")))
    return long.agg(F.when(v >= 0, v).alias("value"))
