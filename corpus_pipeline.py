"""The corpus pipeline: five filters and a mixture over the documents table, each written and reread."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vitrine.llm import decontaminate, mixing, quality, simhash, toxicity
from vitrine.llm.common import stored
from vitrine.session import ship_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose highest window scores a half or more go."""
    return toxicity.drop_toxic(docs, _table(spark, sf_dir, "labels"))


def low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling doesn't draw go."""
    return quality.drop_low_quality(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id stays of each group."""
    ship_package(spark)
    return simhash.drop_near_duplicates(docs)


def leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak an item of the benchmark go."""
    return decontaminate.drop_leaks(docs, _table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as drawn, in global random order, with copy and rate."""
    return mixing.mix_sources(docs)


STAGES = [("toxicity", toxic), ("quality", low_quality), ("near_duplicates", near_duplicates),
          ("decontamination", leaked), ("mixing", mixed)]

# A recurrent network, resampling by fitted models, and tiling can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each stage's rows written to the shared folder and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
