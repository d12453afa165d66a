"""The training-data pipeline: quality, near-duplicates, decontamination, mixing, sharding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemart.llm import decontamination, mixing, quality, sharding, simhash
from tidemart.llm.text import stored

SHARDS = 40


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.filter_documents(docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontamination.drop_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    return mixing.mix_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of each document copy."""
    return sharding.shard_documents(docs, SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each is stored, and the next reads what it stored."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *filters, (_, last) = STAGES
    for name, stage in filters:
        docs = stored(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)


#: Sketches, XXH64 and CRC-32 have no form in the SQL dialect; a brute-force version checks the rows.
ORACLE_SQL = None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
