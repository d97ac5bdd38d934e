"""From documents to packed sequences: quality, exact and near duplicates, mixture, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from balcao.llm import exact_dedup, frames, mixing, packing, quality_rules, queries, simhash
from balcao.session import tune


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.filtered(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicated(docs, keep="largest")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicated(docs, shingle=4, distance=4)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), queries.TARGETS, least=1.0)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, queries.tokenizer_path())


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact_duplicates),
    ("near dedup", near_duplicates),
    ("mixing", mixture),
    ("packing", pack),
]

#: Language posteriors, rates and tokenizer ids are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; between stages the rows are written to the shared folder and read again."""
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = frames.stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
