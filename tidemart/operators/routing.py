"""Config-driven routing of change rows.

Changes name few tables, so shuffling them by table would leave a handful of tasks with all
the work.  A config table whose size the planner knows to be small is broadcast.  One of unknown size (local rows,
JDBC) is stored first, by its executors and at any size, since the changes would otherwise be written to a shuffle before its
size shows; the planner then broadcasts it below its threshold, and else splits the crowded tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.operators.aggregates import latest_per_key
from tidemart.operators.changes import placed
from tidemart.operators.joins import checked_broadcast, planned_bytes
from tidemart.session import scratch_dir

#: The planner gives tables it knows nothing of sizes beyond any real config.
_UNKNOWN_BYTES = 1 << 50


def _targets(config: DataFrame) -> DataFrame:
    """The config as the planner can judge it."""
    if config.isStreaming or planned_bytes(config) < _UNKNOWN_BYTES:
        return checked_broadcast(config)
    spark, where = config.sparkSession, scratch_dir(config.sparkSession, "config")
    config.write.parquet(where)
    return spark.read.schema(config.schema).parquet(where)


def as_insert(change_type: Column | str) -> Column:
    """`bootstrap-insert` counts as `insert`."""
    c = F.col(change_type) if isinstance(change_type, str) else change_type
    return F.when(c == "bootstrap-insert", "insert").otherwise(c)


def config_state(config_changes: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """The config in force: the latest change per key, the last to arrive of those of one time, without deleted keys."""
    latest = latest_per_key(config_changes, keys, [ts, *placed(config_changes)])
    return latest.where(F.col("op").isNull() | (F.col("op") != "d"))


def route_dim(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Attach the dimension config by table name; rows without one are dropped."""
    targets = _targets(config.select("source_table", "sink_table", "sink_columns", "sink_row_key"))
    return changes.join(targets, changes["table"] == targets["source_table"]).drop("source_table")


def route_fact(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Attach the fact config by table and change type, both sides normalised."""
    targets = _targets(config.select(
        "source_table", as_insert("source_type").alias("source_type"), "sink_table", "sink_columns"
    ))
    rows = changes.withColumn("_type", as_insert("type"))
    on = (rows["table"] == targets["source_table"]) & (rows["_type"] == targets["source_type"])
    return rows.join(targets, on).drop("_type", "source_table", "source_type")


def route_by_op(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Before/after images of configured tables to destination `op_table`; deletes skipped."""
    tables = _targets(config.select("source_table").distinct())
    live = changes.where(F.col("op") != "d").withColumn("_table", F.col("source")["table"])
    return live.join(tables, live["_table"] == tables["source_table"], "left_semi").select(
        F.concat_ws("_", "op", "_table").alias("topic"), F.col("after").alias("data")
    )
