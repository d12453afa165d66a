"""Config-driven jobs: dimension loads, fact splits, log split and relays."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemart.operators import changes as C, flags, logs as L, parse as P, routing as R
from tidemart.schemas import LOG
from tidemart.sinks.messages import payload_messages
from tidemart.streaming import state


def dim_rows(changes: DataFrame, config: DataFrame, database: str) -> DataFrame:
    """Dimension puts and deletes: destination, row key, the configured payload keys and the place in the log."""
    routed = _with_row_key(R.route_dim(C.etl_changes(changes, database), config))
    return routed.select("sink_table", "rowkey", "data", "type", "ts", *C.placed(changes))


def dim_rows_debezium(changes: DataFrame, config: DataFrame) -> DataFrame:
    """The same for before/after images; deletes are skipped."""
    live = C.clean_change(changes.where(F.col("op") != "d"))
    routed = _with_row_key(R.route_dim(live, config))
    return routed.select(
        "sink_table", "rowkey", "data", F.col("op").alias("type"), F.col("ts_ms").alias("ts"),
        *C.placed(changes),
    )


def _with_row_key(routed: DataFrame) -> DataFrame:
    # the key is read before the payload is cut, so filters on it do not repeat the cutting
    keyed = routed.withColumn("rowkey", F.col("data")[F.col("sink_row_key")])
    return C.project_config_columns(keyed)


def fact_messages(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Configured changes as (topic, value), the payload cut to its configured keys."""
    routed = C.project_config_columns(R.route_fact(C.with_payload(changes), config))
    return payload_messages(routed, "sink_table")


def op_messages(changes: DataFrame, config: DataFrame) -> DataFrame:
    return payload_messages(R.route_by_op(changes, config), "topic")


def clean_log(messages: DataFrame, strict: bool = True) -> DataFrame:
    """Parsed log records with a device and a time, and their event time."""
    parse = P.parse_strict if strict else P.parse_lenient
    log = parse(messages, LOG).where((F.col("common.mid") != "") & F.col("ts").isNotNull())
    return L.with_event_time(log)


def repaired_log(log: DataFrame) -> DataFrame:
    """The log with `common.is_new` corrected per device."""
    rows = log.withColumn("_mid", F.col("common.mid"))
    repair = state.repair_new_flag if log.isStreaming else flags.repair_new_flag
    fixed = repair(rows, "_mid", ts="row_time", is_new=F.col("common.is_new"), out="_fixed")
    common = F.col("common").withField("is_new", F.col("_fixed"))
    return fixed.withColumn("common", common).drop("_mid", "_fixed")


def log_split(messages: DataFrame, strict: bool = True, delay: str = "20 seconds") -> DataFrame:
    """Raw log to (topic, value) rows of the five log topics."""
    log = clean_log(messages, strict)
    if log.isStreaming:
        log = log.withWatermark("row_time", delay)
    return L.log_messages(repaired_log(log).drop("row_time"))


def flat_changes(changes: DataFrame, key: str = "id") -> DataFrame:
    """Change log as flat text rows, for `write_changelog_flat`."""
    return C.flatten_change(changes, key)
