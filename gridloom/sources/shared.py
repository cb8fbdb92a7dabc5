"""The folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; where that is unset a folder of its own in local mode, an error elsewhere."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="gridloom-"))
    return "file://" + _own[0]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back, for what is read several times."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
