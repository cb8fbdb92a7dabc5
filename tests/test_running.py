"""Stateful streaming: equal to the batch, restarted from a checkpoint, late rows counted, idle cells closed."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.streaming import running

SCHEMA = "event_id long, ts timestamp, cell long, value double"
T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(autouse=True)
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", running.PROVIDER)
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def feed(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def run(spark, folder, where, **how):
    """All there is in ``folder`` through the stream; rows come to ``where``/out."""
    df = running.running_statistics(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder), **how)

    def keep(part, k):
        part.withColumn("batch", F.lit(k)).write.mode("append").parquet(f"{where}/out")

    q = df.writeStream.outputMode("update").option("checkpointLocation", f"{where}/checkpoint").foreachBatch(keep).trigger(availableNow=True).start()
    q.awaitTermination(300)
    return spark.read.parquet(f"{where}/out").collect()


def latest(rows):
    out = {}
    for r in sorted(rows, key=lambda r: r.batch):
        out[r.cell] = r
    return out


def test_stream_equals_batch_over_restarts(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(i, T0 + dt.timedelta(minutes=i), int(rng.integers(0, 6)), None if i % 50 == 3 else float(rng.normal(100, 5))) for i in range(900)]
    rows.append((901, T0, None, 1.0))
    for part in (rows[:300], rows[300:500]):
        feed(spark, f"{tmp_path}/in", part)
    first = run(spark, f"{tmp_path}/in", str(tmp_path))
    assert {r.batch for r in first} == {0, 1}
    feed(spark, f"{tmp_path}/in", rows[500:])
    got = latest(run(spark, f"{tmp_path}/in", str(tmp_path)))  # from the checkpoint of the first run
    for cell in range(6):
        v = np.array([r[3] for r in rows if r[2] == cell and r[3] is not None])
        r = got[cell]
        assert r.n == len(v) and r.late == 0 and not r.closed
        assert r.mean == pytest.approx(v.mean(), rel=1e-12) and r.deviation == pytest.approx(v.std(), rel=1e-9)
    assert set(got) == set(range(6))


def test_late_rows_and_idle_cells(spark, tmp_path):
    hour, day = dt.timedelta(hours=1), dt.timedelta(days=1)
    how = {"late": "1 hour", "late_ms": 7_200_000, "idle_ms": 86_400_000}
    feed(spark, f"{tmp_path}/in", [(1, T0 + 5 * hour, 1, 10.0), (2, T0 + 4 * hour, 1, 20.0), (3, T0, 2, 7.0), (4, T0, 3, None)])
    run(spark, f"{tmp_path}/in", str(tmp_path), **how)
    # 3.5 hours before the newest row is late, 1.5 is not; cell 2 goes with the days that pass
    feed(spark, f"{tmp_path}/in", [(5, T0 + 4 * hour + hour / 2, 1, 30.0), (6, T0 + 5 * day, 9, 1.0)])
    run(spark, f"{tmp_path}/in", str(tmp_path), **how)
    feed(spark, f"{tmp_path}/in", [(7, T0 + 6 * day, 9, 3.0)])
    rows = run(spark, f"{tmp_path}/in", str(tmp_path), **how)
    closed = {r.cell: (r.n, r.mean) for r in rows if r.closed}
    assert closed[2] == (1, 7.0) and closed[1][0] == 3
    assert latest(rows)[9].n == 2 and latest(rows)[9].mean == 2.0


def test_late_row_is_counted(spark, tmp_path):
    hour = dt.timedelta(hours=1)
    how = {"late": "10 days", "late_ms": 3_600_000}
    feed(spark, f"{tmp_path}/in", [(1, T0 + 9 * hour, 1, 10.0)])
    run(spark, f"{tmp_path}/in", str(tmp_path), **how)
    feed(spark, f"{tmp_path}/in", [(2, T0 + 7 * hour, 1, 99.0), (3, T0 + 8 * hour, 1, 20.0)])
    r = latest(run(spark, f"{tmp_path}/in", str(tmp_path), **how))[1]
    assert (r.n, r.mean, r.late) == (2, 15.0, 1)


def test_merging_parts_is_welford():
    rng = np.random.default_rng(2)
    v = rng.normal(1e6, 1, 1000)
    state = (0, 0.0, 0.0)
    for part in np.split(v, [1, 1, 10, 500]):
        state = running.merged(*state, part)
    assert state[0] == 1000 and state[1] == pytest.approx(v.mean()) and state[2] / 1000 == pytest.approx(v.var(), rel=1e-9)
