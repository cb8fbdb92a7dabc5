"""Optimal one-to-one assignment of sources to facilities, one problem in each connected part of a group."""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .raster import spread_labels

#: Feasible pairs of a connected part at most: about 5 GB in its task.
MOST_PAIRS = 20_000_000


def solve(cost: np.ndarray) -> np.ndarray:
    """Column of each row in the cheapest assignment (rows <= columns), by shortest augmenting paths."""
    n, m = cost.shape
    u, v, owner = np.zeros(n), np.zeros(m), np.full(m, -1)
    for i in range(n):
        least, back, done = np.full(m, np.inf), np.full(m, -1), np.zeros(m, bool)
        row, col, low = i, -1, 0.0
        while True:
            open_ = ~done
            new = low + cost[row] - u[row] - v
            better = open_ & (new < least)
            least[better], back[better] = new[better], col
            col = int(np.where(open_, least, np.inf).argmin())
            low = least[col]
            done[col] = True
            if owner[col] < 0:
                break
            row = owner[col]
        u[i] += low
        for j in np.flatnonzero(done):
            if j != col:
                u[owner[j]] += low - least[j]
                v[j] -= low - least[j]
        while col >= 0:
            prev = back[col]
            owner[col] = owner[prev] if prev >= 0 else i
            col = prev
    out = np.full(n, -1)
    out[owner[owner >= 0]] = np.flatnonzero(owner >= 0)
    return out


def solve_sparse(first: np.ndarray, columns: np.ndarray, cost: np.ndarray, alone: float, n_columns: int) -> np.ndarray:
    """Column of each row in the cheapest assignment over given pairs, -1 for rows that stay alone at a cost of ``alone``.

    Pairs of row i are ``first[i]`` to ``first[i + 1]`` of ``columns`` and ``cost``.  Shortest augmenting paths with
    potentials, each found by a search that ends where the first free column or row to be left alone is reached; memory grows with the pairs.
    """
    n = len(first) - 1
    u, v = [0.0] * n, [0.0] * n_columns
    owner, match = [-1] * n_columns, [-1] * n
    for i in range(n):
        dist: dict[int, float] = {}
        back: dict[int, int] = {}
        done: set[int] = set()
        heap: list[tuple[float, int]] = []
        row, low, end, end_row, last = i, 0.0, np.inf, -1, -1
        while True:
            base, a, b = low - u[row], int(first[row]), int(first[row + 1])
            if base + alone < end:
                end, end_row = base + alone, row
            for c, w in zip(columns[a:b].tolist(), cost[a:b].tolist()):
                d = base + w - v[c]
                if d < end and d < dist.get(c, np.inf) and c not in done:
                    dist[c], back[c] = d, row
                    heapq.heappush(heap, (d, c))
            while heap and (heap[0][1] in done or heap[0][0] > dist[heap[0][1]]):
                heapq.heappop(heap)
            if not heap or heap[0][0] >= end:
                low = end
                break
            low, c = heapq.heappop(heap)
            done.add(c)
            if owner[c] < 0:
                last = c
                break
            row = owner[c]
        u[i] += low
        for c in done:
            if c != last:
                u[owner[c]] += low - dist[c]
                v[c] -= low - dist[c]
        if last < 0:
            # a row of the path is left alone, which frees its column
            if end_row == i:
                continue
            last, match[end_row] = match[end_row], -1
        c = last
        while True:
            row = back[c]
            before, owner[c], match[row] = match[row], row, c
            if row == i:
                break
            c = before
    return np.array(match, np.int64)


def solve_flow(first: np.ndarray, columns: np.ndarray, cost: np.ndarray, supply: np.ndarray, capacity: np.ndarray, alone: float) -> list[tuple[int, int, int]]:
    """(row, column, amount) of the cheapest assignment as in :func:`solve_sparse`, where row i stands for ``supply[i]`` equal rows and column j for ``capacity[j]`` equal columns.

    Every path takes as much as it can carry, so that the work does not grow with the numbers of equal rows.
    """
    n, m = len(supply), len(capacity)
    u, v, free = [0.0] * n, [0.0] * m, [int(c) for c in capacity]
    flow: list[dict[int, int]] = [{} for _ in range(m)]  # of each column: amounts by row
    for i in range(n):
        left = int(supply[i])
        while left:
            dist: dict[int, float] = {}
            back: dict[int, int] = {}
            via: dict[int, int] = {i: -1}  # column over which a row was reached
            reached: dict[int, float] = {i: 0.0}
            done: set[int] = set()
            heap: list[tuple[float, int]] = []
            new, low, end, end_row, last = [i], 0.0, np.inf, -1, -1
            while True:
                for row in new:
                    base, a, b = low - u[row], int(first[row]), int(first[row + 1])
                    if base + alone < end:
                        end, end_row = base + alone, row
                    for c, w in zip(columns[a:b].tolist(), cost[a:b].tolist()):
                        d = base + w - v[c]
                        if d < end and d < dist.get(c, np.inf) and c not in done:
                            dist[c], back[c] = d, row
                            heapq.heappush(heap, (d, c))
                while heap and (heap[0][1] in done or heap[0][0] > dist[heap[0][1]]):
                    heapq.heappop(heap)
                if not heap or heap[0][0] >= end:
                    low = end
                    break
                low, c = heapq.heappop(heap)
                done.add(c)
                if free[c]:
                    last = c
                    break
                new = [r for r in flow[c] if r not in via]
                for r in new:
                    via[r], reached[r] = c, low
            for r, d in reached.items():
                u[r] += low - d
            for c in done:
                v[c] -= low - dist[c]
            # the path backwards: from its last column, or from the row that is left alone
            steps, amount = [], left
            if last >= 0:
                amount, row = min(amount, free[last]), back[last]
                steps.append((last, row, 1))
            else:
                row = end_row
            while row != i:
                c = via[row]
                amount = min(amount, flow[c][row])
                steps += [(c, row, -1), (c, back[c], 1)]
                row = back[c]
            for c, row, sign in steps:
                flow[c][row] = flow[c].get(row, 0) + sign * amount
                if not flow[c][row]:
                    del flow[c][row]
            if last >= 0:
                free[last] -= amount
            left -= amount
    return [(r, c, k) for c, rows in enumerate(flow) for r, k in rows.items()]


def alike(df: DataFrame, key: str, place: Sequence[str]) -> DataFrame:
    """(key, _least, _i): the least ``key`` of the rows at the same ``place``, and the number of a row there from 0."""
    at = Window.partitionBy(*place)
    return df.select(key, F.min(key).over(at).alias("_least"), (F.row_number().over(at.orderBy(key)) - 1).cast("long").alias("_i"))


def assign_alike(pairs: DataFrame, sources: DataFrame, facilities: DataFrame, group: str | None, most: float) -> DataFrame:
    """:func:`assign` for sources and facilities of which many are alike: the columns of the group, source_id, facility_id, cost.

    pairs: (group, source_id, facility_id, cost, n_sources, n_facilities), one for each pair of kinds, which are named by their least ids;
    sources and facilities: :func:`alike`.  What is solved is a flow between kinds, which is then dealt out to the
    members of a kind by number, so a task holds the pairs of kinds only.
    """
    by = [group] if group else []
    named = pairs.where((F.col("cost") <= most) & F.col("source_id").isNotNull() & F.col("facility_id").isNotNull()).select(
        *by, "source_id", "facility_id", F.col("cost").cast("double").alias("cost"), "n_sources", "n_facilities",
        F.xxhash64(*by, F.lit("source"), "source_id").alias("_s"), F.xxhash64(*by, F.lit("facility"), "facility_id").alias("_f"),
    )
    nodes = named.select(F.col("_s").alias("id")).union(named.select("_f")).distinct()
    parts = spread_labels(nodes, named.select(F.col("_s").alias("id"), F.col("_f").alias("id2"))).select(F.col("id").alias("_s"), F.col("label").alias("_part"))

    def match(pdf: pd.DataFrame) -> pd.DataFrame:
        if len(pdf) > MOST_PAIRS:
            raise ValueError(f"a connected part has {len(pdf)} feasible pairs, more than {MOST_PAIRS}: lower `most`")
        pdf = pdf.sort_values(["source_id", "facility_id"])
        s, at, row = np.unique(pdf["source_id"], return_index=True, return_inverse=True)
        f, f_at, column = np.unique(pdf["facility_id"], return_index=True, return_inverse=True)
        cost = pdf["cost"].to_numpy(float)
        got = solve_flow(np.searchsorted(row, np.arange(len(s) + 1)), column, cost, pdf["n_sources"].to_numpy()[at], pdf["n_facilities"].to_numpy()[f_at], most + 1)
        price = {(r, c): w for r, c, w in zip(row.tolist(), column.tolist(), cost.tolist())}
        given, taken, out = [0] * len(s), [0] * len(f), []
        for r, c, k in sorted(got):
            out.append((s[r], f[c], price[r, c], k, given[r], taken[c]))
            given[r] += k
            taken[c] += k
        flow = pd.DataFrame(out, columns=["_s", "_f", "cost", "_amount", "_given", "_taken"])
        return flow.assign(**{k: pdf[k].iloc[0] for k in by})[[*by, *flow.columns]]

    kinds = dict(pairs.dtypes)
    schema = ", ".join([f"`{k}` {kinds[k]}" for k in by] + [f"_s {kinds['source_id']}, _f {kinds['facility_id']}, cost double, _amount long, _given long, _taken long"])
    flow = named.drop("_f").join(parts, "_s").drop("_s").groupBy(*by, "_part").applyInPandas(match, schema)
    s = sources.withColumnsRenamed({"_least": "_s"}).join(flow, "_s").where((F.col("_i") >= F.col("_given")) & (F.col("_i") < F.col("_given") + F.col("_amount")))
    s = s.select(*by, "source_id", "cost", "_f", (F.col("_i") - F.col("_given") + F.col("_taken")).alias("_i"))
    return s.join(facilities.withColumnsRenamed({"_least": "_f"}), ["_f", "_i"]).select(*by, "source_id", "facility_id", "cost")


def assign(pairs: DataFrame, group: str | None, most: float) -> DataFrame:
    """Best matching of pairs (group, source_id, facility_id, cost): at most one partner each.

    Every source may also stay alone, at a cost of ``most`` + 1; pairs above ``most`` are
    infeasible, as are those with a null id or cost.  Of all matchings the one of least total
    cost is taken, in each group by itself or, where ``group`` is None, in the whole table.

    Sources and facilities that no chain of feasible pairs connects do not influence each other, so
    the problems solved are the connected parts of a group, each in one task that holds its pairs; a part of
    more than MOST_PAIRS pairs is an error.  Parts are named by a hash: two that
    share a name are solved together, with the same matching.
    """
    by = [group] if group else []
    feasible = pairs.where((F.col("cost") <= most) & F.col("source_id").isNotNull() & F.col("facility_id").isNotNull())
    named = feasible.select(
        *by, "source_id", "facility_id", F.col("cost").cast("double").alias("cost"),
        F.xxhash64(*by, F.lit("source"), "source_id").alias("_s"), F.xxhash64(*by, F.lit("facility"), "facility_id").alias("_f"),
    )
    nodes = named.select(F.col("_s").alias("id")).union(named.select("_f")).distinct()
    parts = spread_labels(nodes, named.select(F.col("_s").alias("id"), F.col("_f").alias("id2"))).select(F.col("id").alias("_s"), F.col("label").alias("_part"))

    def match(pdf: pd.DataFrame) -> pd.DataFrame:
        if len(pdf) > MOST_PAIRS:
            raise ValueError(f"a connected part has {len(pdf)} feasible pairs, more than {MOST_PAIRS}: lower `most`")
        s, row = np.unique(pdf["source_id"], return_inverse=True)
        f, column = np.unique(pdf["facility_id"], return_inverse=True)
        cost = pdf["cost"].to_numpy(float)
        order = np.lexsort((cost, column, row))
        row, column, cost = row[order], column[order], cost[order]
        # of pairs told more than once the cheapest
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (column[1:] != column[:-1])
        row, column, cost = row[new], column[new], cost[new]
        got = solve_sparse(np.searchsorted(row, np.arange(len(s) + 1)), column, cost, most + 1, len(f))
        hit = np.flatnonzero(got >= 0)
        at = np.searchsorted(row * len(f) + column, hit * len(f) + got[hit])
        keys = {k: pdf[k].iloc[0] for k in by}
        return pd.DataFrame({**keys, "source_id": s[hit], "facility_id": f[got[hit]], "cost": cost[at]})

    kinds = dict(pairs.dtypes)
    schema = ", ".join([f"`{k}` {kinds[k]}" for k in (*by, "source_id", "facility_id")] + ["cost double"])
    return named.drop("_f").join(parts, "_s").drop("_s").groupBy(*by, "_part").applyInPandas(match, schema)
