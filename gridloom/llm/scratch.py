"""Intermediate tables in the cluster's shared checkpoint folder.

``cut`` writes a DataFrame there and reads it back, so that a lost executor costs
a re-read and not a re-computation.
"""

from __future__ import annotations

import contextlib
import contextvars
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from ..sources.shared import shared_folder

_noted: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("_noted", default=None)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and return the table read back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if (notes := _noted.get()) is not None:
        notes.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def noting() -> Iterator[list[str]]:
    """The paths of the tables that the caller's thread writes inside the block."""
    notes: list[str] = []
    token = _noted.set(notes)
    try:
        yield notes
    finally:
        _noted.reset(token)


def delete(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
