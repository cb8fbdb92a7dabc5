"""Rules compiled to Columns: tag predicates, text rules, first and all matches, value templates."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import flat_tag, template


def _sure(c: Column) -> Column:
    """Two-valued: unknown is false."""
    return F.coalesce(c, F.lit(False))


def _all(parts: Sequence[Column]) -> Column:
    return functools.reduce(lambda a, b: a & b, parts, F.lit(True))


def _any(parts: Sequence[Column]) -> Column:
    return functools.reduce(lambda a, b: a | b, parts, F.lit(False))


def tag_rule(spec: Mapping[str, Any] | None, tags: Column) -> Column:
    """Compile a rule tree over a tag map.

    all_of and any_of take lists, not a rule, name_regex a pattern for the tag name (any
    case), tag a mapping with key and one of equals, in or exists.  No rule is true; an
    unknown node is an error.  True and false in ``equals`` and ``in`` stand for yes and no.
    """
    if not spec:
        return F.lit(True)
    parts = []
    for node, arg in spec.items():
        if node == "all_of":
            parts.append(_all([tag_rule(x, tags) for x in arg]))
        elif node == "any_of":
            parts.append(_any([tag_rule(x, tags) for x in arg]))
        elif node == "not":
            parts.append(~tag_rule(arg, tags))
        elif node == "name_regex":
            parts.append(_sure(F.try_element_at(tags, F.lit("name")).rlike(f"(?i){arg}")))
        elif node == "tag":
            parts.append(_tag_test(arg, tags))
        else:
            raise ValueError(f"unknown rule node {node!r}")
    return _all(parts)


def _plain(v: Any) -> str:
    return {True: "yes", False: "no"}.get(v, str(v)) if isinstance(v, bool) else str(v)


def _tag_test(arg: Mapping[str, Any], tags: Column) -> Column:
    value = F.try_element_at(tags, F.lit(arg["key"]))
    if "equals" in arg:
        return _sure(value == _plain(arg["equals"]))
    if "in" in arg:
        return _sure(value.isin(*[_plain(v) for v in arg["in"]]))
    present = _sure(F.length(F.trim(value)) > 0)
    return present if arg.get("exists", True) else ~present


def rule_keys(spec: Mapping[str, Any] | None) -> set[str]:
    """Tag keys that a rule looks at."""
    found: set[str] = set()
    for node, arg in (spec or {}).items():
        if node in ("all_of", "any_of"):
            for x in arg:
                found |= rule_keys(x)
        elif node == "not":
            found |= rule_keys(arg)
        elif node == "name_regex":
            found.add("name")
        elif node == "tag":
            found.add(arg["key"])
    return found


def candidate(spec: Mapping[str, Any] | None, tags: Column) -> Column:
    """Index pre-filter: some key of the rule is present; a rule without keys has no candidates."""
    keys = sorted(rule_keys(spec))
    return _sure(F.arrays_overlap(F.map_keys(tags), F.array(*map(F.lit, keys)))) if keys else F.lit(False)


def indexed_rule(spec: Mapping[str, Any] | None, tags: Column) -> Column:
    return candidate(spec, tags) & tag_rule(spec, tags)


def values_or_tags(column: Column, values: Sequence[str] | None, any_of: Sequence[Mapping[str, Any]] | None, tags: Column) -> Column:
    """Layer filter: either a column in values, or one of several tag sets; ``*`` stands for any text, case is ignored."""
    if (values is None) == (any_of is None):
        raise ValueError("exactly one of values and any_of")
    if values is not None:
        return _sure(F.lower(column).isin(*[v.lower() for v in values]))

    def one(key: str, want: Any) -> Column:
        have = F.try_element_at(tags, F.lit(key))
        if want is True or want == "*":
            return _sure(F.length(F.trim(have)) > 0)
        wanted = want if isinstance(want, (list, tuple)) else [want]
        return _sure(F.lower(have).isin(*[_plain(w).lower() for w in wanted]))

    return _any([_all([one(k, v) for k, v in group.items()]) for group in any_of or []])


def survey_rule(rule: Mapping[str, Any], columns: Mapping[str, Column]) -> Column:
    """match: all conditions; match_any: one group of conditions.  Numbers compare as numbers, texts trimmed and upper case."""

    def test(name: str, want: Any) -> Column:
        wanted = want if isinstance(want, (list, tuple)) else [want]
        if all(isinstance(w, (int, float)) and not isinstance(w, bool) for w in wanted):
            return _sure(columns[name].try_cast("double").isin(*map(float, wanted)))
        return _sure(F.upper(F.trim(columns[name].cast("string"))).isin(*[str(w).strip().upper() for w in wanted]))

    def group(g: Mapping[str, Any]) -> Column:
        return _all([test(k, v) for k, v in g.items()])

    if "match_any" in rule:
        return _any([group(g) for g in rule["match_any"]])
    return group(rule.get("match", {}))


def text_rule(rule: Mapping[str, Any], columns: Mapping[str, Column]) -> Column:
    """Substring conditions ``<column>_<test>`` with tests equals, contains, contains_any, contains_all,
    contains_none, starts_with and ends_with, case ignored; all must hold."""
    parts = []
    for key, arg in rule.items():
        name = next((n for n in columns if key.startswith(n + "_")), None)
        if name is None:
            raise ValueError(f"unknown condition {key!r}")
        text, test = F.lower(F.coalesce(columns[name], F.lit(""))), key[len(name) + 1:]
        items = [str(a).lower() for a in (arg if isinstance(arg, (list, tuple)) else [arg])]
        has = [text.contains(a) for a in items]
        tests = {
            "equals": lambda: text == items[0], "contains": lambda: has[0], "contains_any": lambda: _any(has), "contains_all": lambda: _all(has),
            "contains_none": lambda: ~_any(has), "starts_with": lambda: text.startswith(items[0]), "ends_with": lambda: text.endswith(items[0]),
        }
        if test not in tests:
            raise ValueError(f"unknown test {test!r}")
        parts.append(tests[test]())
    return _all(parts)


def first_match(rules: Sequence[tuple[Any, Column]], default: Any = None) -> Column:
    """Value of the first rule that holds."""
    out: Column | None = None
    for value, cond in rules:
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def all_matches(rules: Sequence[tuple[Any, Column]]) -> Column:
    """Values of all rules that hold, in order."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(value)) for value, cond in rules]))


def joined_matches(rules: Sequence[tuple[str, Column]]) -> Column:
    """Distinct values of the rules that hold, sorted and joined by commas; null if none."""
    found = F.array_sort(F.array_distinct(all_matches(rules)))
    return F.when(F.size(found) > 0, F.array_join(found, ","))


def augment(tags: Column, rules: Sequence[tuple[str, Column]], default: str | None = None) -> Column:
    """First rule's value, a template over the tags; the default, a template too, where none holds."""
    out: Column | None = None
    for pattern, cond in rules:
        value = template(pattern, tags)
        out = F.when(cond, value) if out is None else out.when(cond, value)
    last = template(default, tags) if default is not None else F.lit(None).cast("string")
    return last if out is None else out.otherwise(last)


def classify(df: DataFrame, layers: Mapping[str, Mapping[str, Any]], tags: str, key: Sequence[str]) -> DataFrame:
    """Rows of every layer whose rule and element kinds fit, once for each key (least kind first)."""
    hits = [
        (name, _sure(F.col("elem_kind").isin(*spec["kinds"])) & indexed_rule(spec.get("match"), F.col(tags)))
        for name, spec in layers.items()
        if spec.get("when", True)
    ]
    rows = df.withColumn("layer", F.explode(all_matches(hits)))
    w = Window.partitionBy("layer", *key).orderBy("elem_kind")
    return rows.withColumn("_n", F.row_number().over(w)).where(F.col("_n") == 1).drop("_n")


def run_sector(df: DataFrame, layers: Mapping[str, Mapping[str, Any]], tags: str, key: Sequence[str], mode: str = "rules", prefilter: bool | None = None) -> DataFrame:
    """A sector's layers over tagged elements, one row for each key and layer (``classify``) or for each key (``rules``).

    In mode ``rules`` an element belongs to the first layer that fits.  The prefilter keeps elements that
    hold any key a rule asks for; by default it is on where every active layer has a rule.
    """
    if mode not in ("rules", "classify"):
        raise ValueError(mode)
    active = {n: s for n, s in layers.items() if s.get("when", True)}
    if prefilter is None:
        prefilter = all(s.get("match") for s in active.values())
    if prefilter:
        df = df.where(_any([candidate(s.get("match"), F.col(tags)) for s in active.values()]))
    rows = classify(df, active, tags, key)
    if mode == "classify":
        return rows
    place = F.element_at(F.create_map(*[x for i, n in enumerate(active) for x in (F.lit(n), F.lit(i))]), F.col("layer"))
    w = Window.partitionBy(*key).orderBy(place)
    return rows.withColumn("_n", F.row_number().over(w)).where(F.col("_n") == 1).drop("_n")


def activated(rules: Sequence[Mapping[str, Any]], flags: Mapping[str, bool]) -> list[Mapping[str, Any]]:
    """Rules whose ``when`` flag is set or that have none."""
    return [r for r in rules if "when" not in r or flags.get(r["when"], False)]


__all__ = ["activated", "all_matches", "augment", "candidate", "classify", "first_match", "flat_tag", "indexed_rule", "joined_matches", "run_sector", "survey_rule", "tag_rule", "text_rule", "values_or_tags"]
