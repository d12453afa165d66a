"""A change log that is parsed once, however many jobs and tables are picked from it.

Each batch of messages is parsed in one scan and committed, a folder per source table; unreadable messages have a
folder of their own.  A job reads the columns of the tables it asks for and nothing else: its filters on `table` choose
folders, and no JSON is read again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemart.functions.scalar import epoch_to_timestamp
from tidemart.operators.changes import placed
from tidemart.operators.parse import parse_tagged
from tidemart.schemas import CHANGE
from tidemart.sinks import versioned

#: The folder of messages without a table; no table has an empty name.
NO_TABLE = ""


def land_changes(messages: DataFrame, path: str, batch_id: int = 0) -> None:
    """Parse and commit a batch of messages; repeating it changes nothing."""
    rows = parse_tagged(messages, CHANGE, keep=placed(messages))
    source = F.coalesce("table", F.lit(NO_TABLE)).alias("source_table")
    versioned.commit(rows.select("*", source).drop("table"), path, batch_id, ["source_table"])


def landing_writer(path: str) -> Callable[[DataFrame, int], None]:
    """`foreachBatch` form of `land_changes`."""
    return lambda df, batch_id: land_changes(df, path, batch_id)


def _landed(spark: SparkSession, path: str, version: versioned.Version | None) -> DataFrame:
    found = versioned.read_version(spark, path, version or versioned.current_version(spark, path))
    if found is None:
        raise ValueError(f"nothing was landed at {path}")
    # an empty name is a null folder
    return found.withColumn("table", F.col("source_table").cast("string"))


def landed_changes(
    spark: SparkSession, path: str, tables: Sequence[str] | None = None, version: versioned.Version | None = None
) -> DataFrame:
    """The readable changes as of a version, by default the last commit, with event time (from seconds).

    All jobs of one run should be given one version, so that they see the same messages.
    """
    rows = _landed(spark, path, version).where(F.col("unreadable").isNull())
    if tables is not None:
        rows = rows.where(F.col("source_table").isin(*tables))
    rows = rows.withColumn("row_time", epoch_to_timestamp("ts", "s"))
    return rows.select(*CHANGE.fieldNames(), "row_time", *placed(rows))


def unreadable_messages(spark: SparkSession, path: str, version: versioned.Version | None = None) -> DataFrame:
    """The raw text of the messages that are no change."""
    return _landed(spark, path, version).where(F.col("unreadable").isNotNull()).select(F.col("unreadable").alias("value"))
