"""Readers with declared schemas; missing markers become null at the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import in_box
from ..functions.numeric import clean, positive_map
from ..functions.text import number
from ..operators.cells import latest_per_key, shift_to_zero


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def csv(spark: SparkSession, path: str, schema: str | None = None, sep: str = ",", columns: Sequence[str] = ()) -> DataFrame:
    """CSV with a header, as text unless a schema is given; ``columns`` prunes the scan."""
    reader = spark.read.option("header", True).option("sep", sep)
    df = (reader.schema(schema) if schema else reader).csv(path)
    return df.select(*columns) if columns else df


def inventory(df: DataFrame, pollutants: Sequence[str], n_lon: int, n_lat: int) -> DataFrame:
    """Clean an inventory: masses without NaN, indices from zero, cell_id."""
    df = df.withColumns({c: F.coalesce(clean(F.col(c)), F.lit(0.0)) for c in pollutants})
    df = shift_to_zero(shift_to_zero(df, "lon_idx", n_lon), "lat_idx", n_lat)
    return df.withColumn("cell_id", F.col("lat_idx").cast("long") * n_lon + F.col("lon_idx"))


def point_inventory(df: DataFrame, codes: Sequence[str]) -> DataFrame:
    """Point sources with their sector code (categories count from one)."""
    return df.where(F.col("source_type") == 2).withColumn("gnfr", F.try_element_at(F.array(*map(F.lit, codes)), F.col("category").cast("int")))


def facilities_wide(df: DataFrame, key: str, pollutants: dict[str, str]) -> DataFrame:
    """Facilities with a map of their positive pollutants; the mapping renames columns to labels."""
    pairs = F.create_map(*[x for col, label in pollutants.items() for x in (F.lit(label), number(F.col(col)))])
    return df.select(F.col(key).alias("facility_id"), positive_map(pairs).alias("pollutants"))


def latest_facilities(df: DataFrame, key: str, year: str, lon: str, lat: str) -> DataFrame:
    """Latest year of each facility; rows without id or coordinates are dropped."""
    good = df.where(F.col(key).isNotNull() & number(F.col(lon)).isNotNull() & number(F.col(lat)).isNotNull())
    good = good.withColumn(lon, number(F.col(lon))).withColumn(lat, number(F.col(lat)))
    return latest_per_key(good, key, year, lon, lat)


def workbook(df: DataFrame) -> DataFrame:
    """Reported emissions in either header dialect: six columns, or one column parted by semicolons."""
    names = ["COUNTRY", "YEAR", "SECTOR", "POLLUTANT", "UNIT", "TOTAL"]
    if len(df.columns) == 1:
        parts = F.split(F.col(f"`{df.columns[0]}`"), ";", 6)
        df = df.select(*[F.get(parts, i).alias(n) for i, n in enumerate(names)])
    else:
        df = df.withColumnsRenamed({"VALUE": "TOTAL", "NFR": "SECTOR"})
    return df.select("COUNTRY", F.col("YEAR").try_cast("int").alias("YEAR"), "SECTOR", "POLLUTANT", "UNIT", number(F.col("TOTAL")).alias("TOTAL"))


def share_lines(lines: DataFrame, year: str, marker: str = "[% of fuel input]") -> DataFrame:
    """Share table in text form (at, value): the header line holds ``marker``; the column of a year in parts of one.

    n.a counts as nothing, shares of nothing are dropped: fuel, appliance, share.
    """
    head = lines.where(F.contains("value", F.lit(marker))).agg(F.min_by("value", "at").alias("_head"), F.min("at").alias("_at"))
    rows = lines.crossJoin(F.broadcast(head)).where(F.col("at") > F.col("_at"))
    names = F.transform(F.split("_head", ","), lambda c: F.trim(c))
    cells = F.split("value", ",")
    at = F.array_position(names, F.lit(year)).cast("int")
    text = F.replace(F.trim(F.try_element_at(cells, at)), F.lit(";"), F.lit("."))
    share = F.coalesce(text.try_cast("double"), F.lit(0.0)) / 100
    return rows.select(F.trim(F.get(cells, F.lit(0))).alias("fuel"), F.trim(F.get(cells, F.lit(1))).alias("appliance"), share.alias("share")).where(F.col("share") > 0)


def mosaic(tiles: Sequence[DataFrame]) -> DataFrame:
    """Tiles (row, col, value) as one raster; where they overlap the first wins."""
    out = None
    for k, t in enumerate(tiles):
        own = t.select("row", "col", "value").withColumn("_k", F.lit(k))
        out = own if out is None else out.unionByName(own)
    if out is None:
        raise ValueError("no tiles")
    return out.groupBy("row", "col").agg(F.min_by("value", "_k").alias("value"))


def window(df: DataFrame, rows: tuple[int, int], cols: tuple[int, int]) -> DataFrame:
    """A raster window; the bounds are pushed down to the scan."""
    return df.where(F.col("row").between(*rows) & F.col("col").between(*cols))


def factor_table(lines: DataFrame) -> DataFrame:
    """Emission factors in text lines ``classes;fuels;unit;factor;text`` in a column value, to order, classes, fuels, ef, text.

    Classes and fuels are lists parted by commas, in lower case; factors in kg are brought to g.
    Lines without a factor of 0 or more are dropped; ``order`` is the column at of the line.
    """
    part = F.split("value", ";", 5)
    listed = lambda i: F.filter(F.transform(F.split(F.get(part, i), ","), lambda c: F.lower(F.trim(c))), lambda c: c != "")
    ef = number(F.get(part, 3)) * F.when(F.lower(F.trim(F.get(part, 2))).startswith("kg"), 1000.0).otherwise(1.0)
    rows = lines.select(F.col("at").alias("order"), listed(0).alias("classes"), listed(1).alias("fuels"), ef.alias("ef"), F.get(part, 4).alias("text"))
    return rows.where(F.col("ef") >= 0)


def fires(df: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Active fires (lon, lat, frp, type, as text or numbers) in a closed box; an frp that is no number is null."""
    typed = df.withColumns({"frp": number(F.col("frp")).cast("float"), "type": F.col("type").try_cast("smallint")})
    return typed.where(in_box(F.col("lon").cast("double"), F.col("lat").cast("double"), box))


def country_outlines(regions: DataFrame) -> DataFrame:
    """The rows that make up each country (country, level): those of level 0, or those of level 2 where it has none."""
    r = regions.where(F.col("level").isin(0, 2)).withColumn("country", F.upper(F.trim("country")))
    top = r.groupBy("country").agg(F.min("level").alias("level"))
    return r.join(top, ["country", "level"], "left_semi")


def weight_stack(spark: SparkSession, path: str, sector: str, pollutants: Sequence[str] = (), nodata: float | None = None) -> DataFrame:
    """Written weights of a sector, read from its folders alone; nodata, NaN and infinity count as 0."""
    df = spark.read.parquet(path).where(F.col("sector") == sector)
    if pollutants:
        df = df.where(F.col("pollutant").isin(*pollutants))
    weight = F.coalesce(clean(F.col("weight")), F.lit(0.0))
    return df.withColumn("weight", weight if nodata is None else F.when(weight == nodata, 0.0).otherwise(weight))


def grid_csv(spark: SparkSession, path: str, pollutant: str) -> DataFrame:
    """Positive pixels of a pollutant out of a written grid table: x, y, emission."""
    df = spark.read.option("header", True).schema("pollutant string, x string, y string, emission string").csv(path)
    own = df.where(F.col("pollutant") == pollutant)
    return own.select(number(F.col("x")).alias("x"), number(F.col("y")).alias("y"), number(F.col("emission")).alias("emission")).where(F.col("emission") > 0)


def plane_points(plane: DataFrame, box: tuple[float, float, float, float], height: int, width: int) -> DataFrame:
    """Positive cells of a plane (row from the north, col, emission), placed by the domain and the shape alone."""
    west, south, east, north = box
    x = west + (F.col("col") + 0.5) * ((east - west) / width)
    y = north - (F.col("row") + 0.5) * ((north - south) / height)
    return plane.where(F.col("emission") > 0).select(x.alias("x"), y.alias("y"), "emission")


def named_column(df: DataFrame, *words: str) -> str | None:
    """The first column whose name, in lower case with line breaks as spaces, is a word or holds all of them."""
    plain = {c: " ".join(c.lower().split()) for c in df.columns}
    exact = [c for c, name in plain.items() if len(words) == 1 and name == words[0]]
    held = [c for c, name in plain.items() if len(words) > 1 and all(w in name for w in words)]
    return next(iter(exact + held), None)


def features(df: DataFrame, box: tuple[float, float, float, float], keys: Sequence[str]) -> DataFrame:
    """Map features (lon, lat, tags) in a closed box that carry one of the keys."""
    carried = F.arrays_overlap(F.map_keys("tags"), F.array(*map(F.lit, keys)))
    return df.where(in_box(F.col("lon"), F.col("lat"), box) & carried)
