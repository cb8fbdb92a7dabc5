"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import chat, decontaminate, infill, langid, metricjoin, mixing, neardup, packing, pagetext, spelling, suffixdedup, tokens, urlfilter


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op1(_documents(spark, sf_dir))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.op2(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.op3(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.op4(_documents(spark, sf_dir))


def op5_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.op5(_documents(spark, sf_dir))


def op6_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metricjoin.op6(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op7_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagetext.op7(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.op8(_documents(spark, sf_dir))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.op9(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.op10(_documents(spark, sf_dir))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.op11(_documents(spark, sf_dir))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.op12(_documents(spark, sf_dir))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.op13(_documents(spark, sf_dir))


_ALL = (
    op1_mixing, op2_url_filters, op3_chat_format, op4_token_files, op5_repeated_strings, op6_embedding_links, op7_page_text, op8_near_duplicates,
    op9_decontamination, op10_language_id, op11_spelling, op12_fill_in_middle, op13_packing,
)
QUERIES = {f.__name__: f for f in _ALL}
SQL = {
    "op1_mixing": mixing.OP1_SQL, "op2_url_filters": urlfilter.OP2_SQL, "op3_chat_format": chat.OP3_SQL, "op6_embedding_links": metricjoin.OP6_SQL,
    "op8_near_duplicates": neardup.OP8_SQL, "op9_decontamination": decontaminate.OP9_SQL, "op12_fill_in_middle": infill.OP12_SQL,
}
