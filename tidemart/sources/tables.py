"""Config and dimension tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemart.functions.scalar import camel_columns


def config_table(
    spark: SparkSession, table: str, fmt: str = "jdbc", camel: bool = True, **options: str
) -> DataFrame:
    """A whole config table; names become camelCase on request."""
    if fmt == "jdbc":
        df = spark.read.format("jdbc").options(dbtable=table, **options).load()
    else:
        df = spark.read.format(fmt).options(**options).load(table)
    return camel_columns(df) if camel else df


def as_dim(df: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """A dictionary-shaped dimension: text row key and a struct of text fields."""
    return df.select(
        F.col(key).cast("string").alias("rowkey"),
        F.struct(*(F.col(f).cast("string").alias(f) for f in fields)).alias("info"),
    )


def dim_table(
    spark: SparkSession, name: str, key: str, fields: Sequence[str] | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """A dimension read by path, as row key and `info` struct."""
    df = spark.read.format(fmt).load(name)
    return as_dim(df, key, fields or [c for c in df.columns if c != key])
