"""Text, token and label expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def sector_token(c: Column) -> Column:
    """Upper case, letters and digits only."""
    return F.regexp_replace(F.upper(F.trim(c)), "[^A-Z0-9]", "")


def dict_key(c: Column) -> Column:
    return F.replace(F.lower(c), F.lit("."), F.lit("_"))


def cover_code(c: Column) -> Column:
    """Survey code: quotes stripped, upper case, blanks collapsed."""
    return F.trim(F.regexp_replace(F.upper(F.regexp_replace(c, "[\"']", "")), r"\s+", " "))


def number(c: Column) -> Column:
    """Double, null where the text is no number; a decimal comma is allowed."""
    return F.replace(F.trim(c.cast("string")), F.lit(","), F.lit(".")).try_cast("double")


def tokens(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), F.lit(0)))


def token_overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(tokens(a), tokens(b)))


def lookup(c: Column, table: Mapping[str, object], default=None) -> Column:
    """Map a value by a literal table."""
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    found = F.element_at(pairs, c)
    return found if default is None else F.coalesce(found, F.lit(default))


def label_or_fail(c: Column, table: Mapping[str, object]) -> Column:
    """As lookup, but an unknown label ends the query with an error."""
    found = lookup(c, table)
    return F.coalesce(found, F.raise_error(F.concat(F.lit("unknown label: "), F.coalesce(c, F.lit("null")))).cast("string"))


def country_list(c: Column) -> Column:
    """Three-letter codes of a list parted by ; or ,"""
    parts = F.transform(F.split(c, "[;,]"), lambda x: F.upper(F.trim(x)))
    return F.filter(parts, lambda x: x.rlike("^[A-Z]{3}$"))


def road_group(c: Column, groups: Sequence[str] = ("motorway", "trunk", "primary", "secondary")) -> Column:
    """Road class without its link suffix, null if it is none of the groups."""
    base = F.regexp_replace(F.lower(F.trim(c)), "_link$", "")
    return F.when(base.isin(*groups), base)


def season(month: Column) -> Column:
    return (
        F.when(month.isin(12, 1, 2), "winter").when(month.isin(3, 4, 5), "spring").when(month.isin(6, 7, 8), "summer").when(month.isin(9, 10, 11), "autumn")
    )


def scientific(v: Column) -> Column:
    """m.m x 10^e; 0 for zero and null."""
    e = F.floor(F.log10(F.abs(v))).cast("int")
    return F.when(v.isNull() | (v == 0), "0").otherwise(
        F.concat(F.round(v / F.pow(F.lit(10.0), e), 1).cast("decimal(10,1)").cast("string"), F.lit("×10^"), e.cast("string"))
    )


def blend(t: Column, low: tuple[int, int, int], high: tuple[int, int, int]) -> Column:
    """Colour between two, as #rrggbb; t is cut to 0..1."""
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    parts = [F.lpad(F.lower(F.hex(F.bround(a + (b - a) * t).cast("long"))), 2, "0") for a, b in zip(low, high)]
    return F.concat(F.lit("#"), *parts)


def tag_map(json_text: Column) -> Column:
    """Tags from JSON text; bad or missing JSON gives none."""
    return F.coalesce(F.from_json(json_text, "map<string,string>"), F.from_json(F.lit("{}"), "map<string,string>"))


def template(pattern: str, tags: Column) -> Column:
    """Fill {key} places of a pattern from a tag map; missing keys are empty."""
    parts, rest = [], pattern
    while "{" in rest:
        head, _, tail = rest.partition("{")
        key, _, rest = tail.partition("}")
        parts += [F.lit(head), F.coalesce(F.try_element_at(tags, F.lit(key)), F.lit(""))]
    return F.concat(*parts, F.lit(rest))


def flat_tag(tags: Column, key: str) -> Column:
    """A tag under its own name or with : written as _."""
    return F.coalesce(F.try_element_at(tags, F.lit(key)), F.try_element_at(tags, F.lit(key.replace(":", "_"))))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def code_or_null(c: Column) -> Column:
    return F.nullif(F.upper(F.trim(c)), F.lit(""))


def jitter_angle(c: Column) -> Column:
    """Sum of character codes modulo 360, a steady angle for a label."""
    codes = F.transform(F.filter(F.split(c, ""), lambda x: x != ""), F.ascii)
    return F.aggregate(codes, F.lit(0), lambda a, v: a + v) % 360
