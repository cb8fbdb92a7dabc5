"""Running statistics of a cell's detections, with state of its own for each cell."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .detections import _timed

SCHEMA = "cell long, n long, mean double, deviation double, late long, closed boolean"
_STATE = "n long, mean double, m2 double, last long, late long"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def merged(n: int, mean: float, m2: float, values: np.ndarray) -> tuple[int, float, float]:
    """Count, mean and sum of squared deviations with more values taken in (Welford's update for whole batches)."""
    k = len(values)
    if not k:
        return n, mean, m2
    own = float(values.mean())
    apart = own - mean
    return n + k, mean + apart * k / (n + k), m2 + float(((values - own) ** 2).sum()) + apart * apart * n * k / (n + k)


class RunningStatistics(StatefulProcessor):
    """Count, mean and deviation of each cell, kept until no row of it has come for ``idle_ms`` of event time.

    A row that is more than ``late_ms`` older than the newest row its cell had in earlier batches is left out and counted.
    Rows with a null time or value are left out.  A cell gives a row for each batch in which it has rows, and a closed one
    when its state goes.
    """

    def __init__(self, late_ms: int, idle_ms: int):
        self.late_ms, self.idle_ms = late_ms, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("statistics", _STATE)

    def _row(self, cell: int, n: int, mean: float, m2: float, late: int, closed: bool) -> pd.DataFrame:
        spread = float(np.sqrt(m2 / n)) if n else None
        return pd.DataFrame({"cell": [cell], "n": [n], "mean": [mean if n else None], "deviation": [spread], "late": [late], "closed": [closed]})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, mean, m2, last, late = self.state.get() if self.state.exists() else (0, 0.0, 0.0, None, 0)
        oldest = None if last is None else last - self.late_ms
        for part in rows:
            part = part[part["value"].notna() & part["ts"].notna()]
            at = part["ts"].to_numpy("datetime64[ms]").astype(np.int64)
            fresh = np.ones(len(at), bool) if oldest is None else at >= oldest
            late += int((~fresh).sum())
            n, mean, m2 = merged(n, mean, m2, part["value"].to_numpy(float)[fresh])
            if fresh.any():
                newest = int(at[fresh].max())
                last = newest if last is None else max(last, newest)
        self.state.update((n, mean, m2, last, late))
        if last is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(last + self.idle_ms)
        yield self._row(key[0], n, mean, m2, late, False)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.state.exists():
            n, mean, m2, _, late = self.state.get()
            self.state.clear()
            yield self._row(key[0], n, mean, m2, late, True)

    def close(self) -> None:
        pass


def running_statistics(df: DataFrame, late: str = "1 day", late_ms: int = 86_400_000, idle_ms: int = 30 * 86_400_000) -> DataFrame:
    """A stream of (event_id, ts, cell, value) to rows of SCHEMA, in update mode; ``late`` is the watermark that lets idle cells go.

    The session has to use the RocksDB state store (PROVIDER).  On a batch the state lives for the batch: one row for each cell.
    """
    _ = df.sparkSession.streams.active  # the first use starts what keeps track of the states, for a batch too
    rows = _timed(df, late).where(F.col("cell").isNotNull()).select(F.col("cell").cast("long").alias("cell"), "ts", F.col("value").cast("double").alias("value"))
    return rows.groupBy("cell").transformWithStateInPandas(RunningStatistics(late_ms, idle_ms), SCHEMA, "Update", "EventTime")
