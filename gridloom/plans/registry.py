"""All registered queries of the library with their DuckDB SQL."""

from __future__ import annotations

import functools
import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}
_MODULES = ("q_cells", "q_weights", "q_points", "q_analytics", "q_alpha", "q_rules", "q_raster", "q_sectors", "q_composites", "q_scalars", "q_more", "q_rest", "q_scans", "q_spatial")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with SQL for the same rows where there is such."""

    def add(f: Query) -> Query:
        if name in _queries:
            raise ValueError(f"query {name} is registered twice")
        _queries[name] = f
        if sql is not None:
            _sql[name] = sql
        return f

    return add


@functools.cache
def _load() -> None:
    for m in _MODULES:
        importlib.import_module(f"gridloom.plans.{m}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_sql)
