"""The corpus pipeline: quality rules, near-duplicates, decontamination, mixing, shards.

Each stage reads what its predecessor wrote. All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import decontaminate, mixing, near_dup, quality_rules, sharding
from gridloom.llm.common import table
from gridloom.session import materialize

SHARDS = 24


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current rule policy keeps."""
    return quality_rules.keep_good(docs)


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return near_dup.keep_one(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once at least, those of small sources again up to their weight."""
    return mixing.mix(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every row."""
    return sharding.shard_by_bytes(docs, SHARDS)


STAGES = [("quality_rules", quality), ("near_dedup", unique), ("decontamination", clean),
          ("mixing", mixed), ("sharding", sharded)]

#: Alignment, edit verification and the exponent's bisection are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
