"""A corpus pipeline over ``documents``.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame that is to be written before the next one is called with it: a stage deletes
the scratch tables of the one before, if that was called by the same thread for the same sf_dir.
All but the last return the columns of documents.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import decontaminate, langid, mixing, neardup, scratch, tokens

_Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Scratch tables of the stage called last by a thread for a folder, with its place.
_last: dict[tuple[int, str], tuple[int, list[str]]] = {}


def _language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.with_language(docs, langid.learned(docs))


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.drop_duplicates(docs)


def _decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_corpus(docs)


def _tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokens.op4(docs)


def _stage(k: int, f: _Stage) -> _Stage:
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        who = (threading.get_ident(), sf_dir)
        before, tables = _last.pop(who, (-1, []))
        if before == k - 1:
            scratch.delete(spark, tables)
        with scratch.noting() as tables:
            out = f(spark, docs, sf_dir)
        _last[who] = (k, tables)
        return out

    return run_stage


STAGES: list[tuple[str, _Stage]] = [
    (name, _stage(k, f))
    for k, (name, f) in enumerate(
        [
            ("language identification", _language),
            ("near-duplicates", _near_duplicates),
            ("benchmark decontamination", _decontaminate),
            ("mixing sources", _mix),
            ("token files", _tokens),
        ]
    )
]

#: SQL has no tokenizer; the result is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = scratch.cut(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
