"""Sources and sinks: written to the scratch folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F, types as T

from tidemart.catalogue.registry import query
from tidemart.catalogue.stand_ins import CARTS, DB, DETAILS, FLAT_CARTS, ORDER_CHANGES
from tidemart.functions.scalar import DATETIME
from tidemart.plans.routes import dim_rows, flat_changes
from tidemart.schemas import CHANGE, DEBEZIUM, ORDER_DETAIL
from tidemart.session import scratch_dir, shuffles_freed
from tidemart.sinks import keyed, messages as M
from tidemart.sources import messages as S
from tidemart.sources.tables import config_table, dim_table
from tidemart.streaming.job import run_to_end, stream_settings

EVENT_JSON = """'{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}'"""


def event_messages(t):
    return t.events.select(F.to_json(F.struct("event_id", "user_id", "event_type")).alias("value"))


def time_text(c: str):
    return F.date_format(c, DATETIME).alias(c)


def round_trip(t, df, name, position=False):
    """Write message values as text files and read them as a batch of messages."""
    where = scratch_dir(t.spark, name)
    with shuffles_freed(t.spark):
        df.select("value").write.options(**M.TEXT_LOG).text(where)
    return S.read_messages(t.spark, where, "text", stream=False, position=position)


@query("s1_read_messages", f"SELECT {EVENT_JSON} AS value FROM events")
def _(t):
    return round_trip(t, event_messages(t), "s1")


@query("s2_change_stream", f"""WITH {ORDER_CHANGES}
SELECT '{DB}' AS "database", 'order_info' AS "table", type, ts, id, order_status, old_status,
  strftime(make_timestamp(ts * 1000000), '%Y-%m-%d %H:%M:%S') AS row_time FROM order_changes""")
def _(t):
    values = t.order_changes.select(F.to_json(F.struct(*CHANGE.fieldNames())).alias("value"))
    rows = S.change_stream(round_trip(t, values, "s2"))
    data, old = F.col("data"), F.col("old")
    return rows.select(
        "database", "table", "type", "ts", data["id"].alias("id"), data["order_status"].alias("order_status"),
        old["order_status"].alias("old_status"), time_text("row_time"),
    )


@query("s3_debezium_stream", f"""WITH {CARTS}
SELECT CASE type WHEN 'insert' THEN 'c' WHEN 'update' THEN 'u' WHEN 'bootstrap-insert' THEN 'r' ELSE 'd' END AS op,
  'cart_info' AS source_table, CASE WHEN type <> 'delete' THEN id END AS after_id,
  CASE WHEN type = 'delete' THEN id END AS before_id, ts * 1000 AS ts_ms,
  strftime(make_timestamp(ts * 1000000), '%Y-%m-%d %H:%M:%S') AS row_time FROM carts""")
def _(t):
    values = t.cart_debezium.select(F.to_json(F.struct(*DEBEZIUM.fieldNames())).alias("value"))
    rows = S.debezium_stream(round_trip(t, values, "s3"))
    return rows.select(
        "op", F.col("source")["table"].alias("source_table"), F.col("after")["id"].alias("after_id"),
        F.col("before")["id"].alias("before_id"), "ts_ms", time_text("row_time"),
    )


@query("s4_fact_stream", f"""WITH {DETAILS}
SELECT id, order_id, sku_id, split_total_amount, ts,
  strftime(make_timestamp(ts * 1000000), '%Y-%m-%d %H:%M:%S') AS row_time FROM details""")
def _(t):
    present = [c for c in ORDER_DETAIL.fieldNames() if c in t.details.columns]
    values = t.details.select(F.to_json(F.struct(*present)).alias("value"))
    rows = S.fact_stream(round_trip(t, values, "s4"), ORDER_DETAIL)
    return rows.select("id", "order_id", "sku_id", "split_total_amount", "ts", time_text("row_time"))


@query("s5_config_table", """SELECT n_nationkey AS "nNationkey", n_name AS "nName", n_regionkey AS "nRegionkey" FROM nation""")
def _(t):
    return config_table(t.spark, t.path("nation"), "parquet")


@query("s6_dim_table", "SELECT CAST(c_custkey AS VARCHAR) AS rowkey, c_name, c_mktsegment FROM customer")
def _(t):
    dim = dim_table(t.spark, t.path("customer"), "c_custkey", ["c_name", "c_mktsegment"])
    return dim.select("rowkey", "info.*")


@query("s7_log_files", f"SELECT {EVENT_JSON} AS value FROM events")
def _(t):
    """Two runs over one folder: the second picks up only the lines written since."""
    folder, out, at = (scratch_dir(t.spark, n) for n in ("s7-in", "s7-out", "s7-at"))
    early = F.col("event_type") == "click"
    lines = F.to_json(F.struct("event_id", "user_id", "event_type")).alias("value")
    for part in (early, ~early):
        t.events.where(part).select(lines).write.mode("append").text(folder)
        run_to_end(S.log_files(t.spark, folder), checkpoint=at, path=out)
    return t.spark.read.parquet(out)


@query("k1_write_messages", "SELECT event_id, user_id, event_type, value FROM events")
def _(t):
    where = scratch_dir(t.spark, "k1")
    M.write_messages(t.events.select("event_id", "user_id", "event_type", "value"), "events", where)
    back = S.read_messages(t.spark, f"{where}/topic=events", "text", stream=False)
    row = F.from_json("value", "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE")
    return back.select(row.alias("r")).select("r.*")


@query("k2_exactly_once", """SELECT 'users_' || user_id % 2 AS topic, CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS ts, event_type, count(*) AS n
FROM events GROUP BY ALL""")
def _(t):
    """A micro-batch is delivered twice, in another order the second time; equal messages that were sent are all read, each once."""
    hour = F.unix_seconds(F.date_trunc("hour", F.col("ts")).cast("timestamp"))
    sent = t.events.select(hour.alias("ts"), "event_type", F.concat(F.lit("users_"), F.col("user_id") % 2).alias("topic"))
    half = sent.agg(F.percentile_approx("ts", 0.5)).first()[0]
    routed = sent.select("ts", "topic", F.to_json(F.struct("ts", "event_type")).alias("value"))
    early, late = routed.where(F.col("ts") <= half), routed.where(F.col("ts") > half)
    where, at, out = (scratch_dir(t.spark, n) for n in ("k2-once", "k2-once-at", "k2-once-read"))
    write = M.once_writer(where, "k2", fmt="text")
    stream_settings(t.spark)
    for batch_id, rows in ((0, early), (1, late), (1, late.repartition(3, F.rand(1)))):
        write(rows, batch_id)
        topics = []
        for topic in ("users_0", "users_1"):
            messages = S.read_messages(t.spark, f"{where}/topic={topic}", "text", message_id=True)
            facts = S.fact_stream(messages, T.StructType().add("ts", "long").add("event_type", "string"))
            topics.append(S.drop_repeats(facts).select(F.lit(topic).alias("topic"), "ts", "event_type"))
        run_to_end(topics[0].unionByName(topics[1]), checkpoint=at, path=out, state_partitions=2)
    return t.spark.read.schema("topic string, ts long, event_type string").parquet(out).groupBy("topic", "ts", "event_type").agg(
        F.count(F.lit(1)).alias("n"))


@query("k2_write_routed", "SELECT 'dwd_' || event_type AS topic, event_id, value FROM events")
def _(t):
    where = scratch_dir(t.spark, "k2")
    routed = t.events.select(
        F.concat(F.lit("dwd_"), "event_type").alias("sink"), F.to_json(F.struct("event_id", "value")).alias("value")
    )
    M.write_routed(routed, "sink", where)
    back = t.spark.read.text(where)
    row = F.from_json("value", "event_id BIGINT, value DOUBLE")
    return back.select("topic", row.alias("r")).select("topic", "r.*")


ALL_LINE = "l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus"


@query("k3_upsert", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_returnflag
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
  {', '.join(c.strip() + ' DESC' for c in ALL_LINE.split(','))}) AS rn FROM lineitem) WHERE rn = 1""")
def _(t):
    where, keys, order = scratch_dir(t.spark, "k3"), ["l_orderkey", "l_linenumber"], ALL_LINE.split(", ")
    rows, half = t.lineitem, F.col("l_suppkey") % 2 == 0
    keyed.upsert(rows.where(half), keys, order, where, 0)
    keyed.upsert(rows.where(~half), keys, order, where, 1)
    keyed.upsert(rows.where(~half), keys, order, where, 1)  # a repeated batch changes nothing
    return keyed.read_upserts(t.spark, where, keys, order).select(
        *keys, "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag")


@query("k4_dim_upsert", """WITH c AS (SELECT CAST(o_custkey AS VARCHAR) AS rowkey,
    epoch(o_orderdate) * 1000000 + o_orderkey AS moment, o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AS deleted,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status,
    CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS priority FROM orders),
  gone AS (SELECT rowkey, max(moment) AS gone FROM c WHERE deleted GROUP BY rowkey)
SELECT c.rowkey, arg_max(status, moment) FILTER (WHERE status IS NOT NULL) AS status,
  arg_max(priority, moment) FILTER (WHERE priority IS NOT NULL) AS priority
FROM c LEFT JOIN gone ON gone.rowkey = c.rowkey WHERE NOT deleted AND (gone IS NULL OR moment > gone) GROUP BY c.rowkey""")
def _(t):
    where = scratch_dir(t.spark, "k4")
    gone = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    seconds = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    routed = t.orders.select(
        F.lit("dim_customer").alias("sink_table"), F.col("o_custkey").cast("string").alias("rowkey"),
        F.create_map(
            F.lit("status"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")),
            F.lit("priority"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")),
        ).alias("data"),
        F.when(gone, "delete").otherwise("update").alias("type"),
        (seconds * 1_000_000 + F.col("o_orderkey")).alias("ts"), "o_orderkey",
    )
    half = F.col("o_orderkey") % 2 == 0
    keyed.dim_upsert(routed.where(half), where, 0)
    keyed.dim_upsert(routed.where(~half), where, 1)
    return keyed.read_dim(t.spark, where, "dim_customer", ["status", "priority"])


@query("k5_dim_lifecycle", """SELECT 'dim_n' || n_nationkey AS sink_table, 'id,name' AS columns FROM nation WHERE n_nationkey % 4 <> 3""")
def _(t):
    """Tables named by the nation keys: created, recreated or dropped by their config rows."""
    database, where = f"life_{uuid.uuid4().hex[:8]}", scratch_dir(t.spark, "k5")
    key = F.col("n_nationkey")
    op = F.element_at(F.array(*map(F.lit, "crud")), (key % 4 + 1).cast("int"))
    config = t.nation.select(
        F.concat(F.lit("dim_n"), key).alias("sink_table"), F.lit("id,name").alias("sink_columns"),
        F.when(op == "d", "d").otherwise(op).alias("op"), key.cast("bigint").alias("ts"),
    )
    t.spark.sql(f"CREATE DATABASE {database} LOCATION '{where}/db'")
    try:
        keyed.dim_lifecycle(config, database, where)
        found = [
            (x.name, ",".join(t.spark.table(f"{database}.{x.name}").columns))
            for x in t.spark.catalog.listTables(database)
        ]
    finally:
        t.spark.sql(f"DROP DATABASE {database} CASCADE")
    return t.spark.createDataFrame(found, "sink_table string, columns string")


@query("k6_write_summary", """SELECT event_type, strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, count(*) AS n
FROM events GROUP BY ALL""")
def _(t):
    where = scratch_dir(t.spark, "k6")
    rows = t.events.groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("n"))
    keys, early = ["event_type", "day"], F.col("day") < "2024-01-15"
    for batch, part in ((0, early), (1, ~early), (1, ~early)):
        keyed.write_summary(rows.where(part), where, batch)
    return keyed.read_summary(t.spark, where, keys)


FLAT_SQL = f"""WITH {FLAT_CARTS}
SELECT flat_id AS id, op, '{DB}' AS db_name, log_before, log_after, 'cart_info' AS t_name, CAST(ts * 1000 AS VARCHAR) AS ts FROM flat_carts
QUALIFY row_number() OVER (PARTITION BY flat_id ORDER BY arrival DESC) = 1"""


def logged_carts(t, name):
    """The cart changes as read from a log that keeps their order."""
    values = t.placed_carts.select(F.to_json(F.struct(*DEBEZIUM.fieldNames())).alias("value"))
    return S.debezium_stream(round_trip(t, values, name, position=True))


@query("k8_write_changelog_flat", FLAT_SQL)
def _(t):
    """Two batches, merged in between, one of them repeated."""
    where = scratch_dir(t.spark, "k8")
    flat = flat_changes(logged_carts(t, "k8-in"))
    half = F.col("op").isin("CREATE", "DELETE")
    keyed.write_changelog_flat(flat.where(half), where, 0)
    keyed.compact_changelog_flat(t.spark, where)
    keyed.write_changelog_flat(flat.where(half), where, 0)
    keyed.write_changelog_flat(flat.where(~half), where, 1)
    return keyed.read_changelog_flat(t.spark, where)


MONTHLY = """c AS (SELECT CAST(l_partkey AS VARCHAR) AS rowkey, epoch(date_trunc('month', l_shipdate)) AS ts,
    row_number() OVER (ORDER BY l_quantity, l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_discount, l_tax, l_shipdate) AS line,
    l_returnflag = 'R' AND l_linestatus = 'F' AND l_suppkey % 3 = 0 AS deleted,
    CASE WHEN l_quantity <> 7 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS quantity,
    CASE WHEN l_linestatus = 'O' THEN l_returnflag || l_linenumber END AS flag FROM lineitem),
gone AS (SELECT rowkey, max((ts, line)) AS gone FROM c WHERE deleted GROUP BY rowkey)"""


@query("k4_dim_arrival_order", f"""WITH {MONTHLY}
SELECT c.rowkey, arg_max(quantity, (ts, line)) FILTER (WHERE quantity IS NOT NULL) AS quantity,
  arg_max(flag, (ts, line)) FILTER (WHERE flag IS NOT NULL) AS flag
FROM c LEFT JOIN gone ON gone.rowkey = c.rowkey WHERE NOT deleted AND (gone IS NULL OR (ts, line) > gone) GROUP BY c.rowkey""")
def _(t):
    """Many puts and deletes of a key in one second, in the order of the log, which keeps the changes of a key in one place;
    merged between two batches, one of which is repeated."""
    where = scratch_dir(t.spark, "k4-order")
    deleted = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F") & (F.col("l_suppkey") % 3 == 0)
    key, number = F.col("l_partkey").cast("string"), F.col("l_quantity").cast("bigint").cast("string")
    data = F.create_map(
        F.lit("id"), key, F.lit("quantity"), F.when(F.col("l_quantity") != 7, number),
        F.lit("flag"), F.when(F.col("l_linestatus") == "O", F.concat("l_returnflag", F.col("l_linenumber").cast("string"))))
    month = F.unix_seconds(F.date_trunc("month", F.col("l_shipdate").cast("timestamp")))
    lines = t.lineitem.repartition("l_partkey").sortWithinPartitions(
        "l_quantity", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_shipdate")
    values = lines.select(F.to_json(F.struct(
        F.lit(DB).alias("database"), F.lit("part_info").alias("table"), F.when(deleted, "delete").otherwise("update").alias("type"),
        month.alias("ts"), data.alias("data"))).alias("value"))
    config = t.spark.createDataFrame(
        [("part_info", "dim_part", "id,quantity,flag", "info", "id", "r")],
        "source_table string, sink_table string, sink_columns string, sink_family string, sink_row_key string, op string")
    changes = S.change_stream(round_trip(t, values, "k4-in", position=True))
    routed = dim_rows(changes, config, DB)
    half, late = F.length("rowkey") % 2 == 0, F.col("ts") % 7 == 0  # changes that come after later ones of the same key
    keyed.dim_upsert(routed.where(half & ~late), where, 0)
    keyed.compact_dim(t.spark, where)
    keyed.dim_upsert(routed.where(half & ~late), where, 0)
    keyed.dim_upsert(routed.where(~half | late), where, 1)
    keyed.compact_dim(t.spark, where)
    keyed.dim_upsert(routed.where(~half | late), where, 1)
    return keyed.read_dim(t.spark, where, "dim_part", ["quantity", "flag"])
