"""Splitting the behaviour log, and config routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.catalogue.registry import query
from tidemart.catalogue.stand_ins import CARTS, LOG_ROWS, ORDER_CHANGES
from tidemart.operators import logs as L, routing as R
from tidemart.schemas import LOG

NUMBERS = "(SELECT unnest(range(1, 4)) AS i)"

SPLIT_SQL = f"""WITH {LOG_ROWS}, n AS {NUMBERS}
SELECT 'err' AS topic, mid, page_id, ms AS ts, CAST(NULL AS VARCHAR) AS item FROM log WHERE is_err
UNION ALL SELECT 'start', mid, NULL, ms, NULL FROM log WHERE is_start
UNION ALL SELECT 'page', mid, page_id, ms, NULL FROM log WHERE NOT is_start
UNION ALL SELECT 'display', mid, page_id, ms, CAST(k + i AS VARCHAR) FROM log, n WHERE i <= n_displays
UNION ALL SELECT 'action', mid, page_id, ms, CAST(k + i AS VARCHAR) FROM log, n WHERE i <= n_actions"""


@query("r1_split_log", SPLIT_SQL)
def _(t):
    """Five outputs, each from its own selection."""
    parts = L.split_log(t.log.select(*LOG.fieldNames()))
    none = F.lit(None).cast("string")
    rows = None
    for topic, df in parts.items():
        page = F.col("page.page_id") if "page" in df.columns else none
        item = F.col("item") if "item" in df.columns else none
        part = df.select(F.lit(topic).alias("topic"), F.col("common.mid").alias("mid"), page.alias("page_id"), "ts",
                         item.alias("item"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


@query("r1_split_log_one_pass", SPLIT_SQL)
def _(t):
    """The same outputs as messages, from one pass over the log."""
    value = lambda path, name: F.get_json_object("value", path).alias(name)
    return L.log_messages(t.log.select(*LOG.fieldNames())).select(
        "topic", value("$.common.mid", "mid"), value("$.page.page_id", "page_id"),
        F.get_json_object("value", "$.ts").cast("bigint").alias("ts"), value("$.item", "item"))


@query("r2_explode_events", f"""WITH {LOG_ROWS}, n AS {NUMBERS}
SELECT 'displays' AS kind, mid, page_id, ms AS ts, CAST(k + i AS VARCHAR) AS item, i AS seq, CAST(NULL AS VARCHAR) AS action_id
FROM log, n WHERE i <= n_displays
UNION ALL SELECT 'actions', mid, page_id, ms, CAST(k + i AS VARCHAR), 0, 'a' || i FROM log, n WHERE i <= n_actions""")
def _(t):
    shared = (F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"), "ts", "item")
    shown = L.explode_events(t.log, "displays").select(
        F.lit("displays").alias("kind"), *shared, F.col("pos_seq").cast("bigint").alias("seq"),
        F.lit(None).cast("string").alias("action_id"))
    acted = L.explode_events(t.log, "actions").select(
        F.lit("actions").alias("kind"), *shared, F.lit(0).cast("bigint").alias("seq"), "action_id")
    return shown.unionByName(acted)


@query("r3_split_log_wrapped", f"""WITH {LOG_ROWS}, n AS {NUMBERS}
SELECT 'err' AS topic, CAST(NULL AS VARCHAR) AS mid, 'e' || k AS detail, CAST(0 AS BIGINT) AS ts FROM log WHERE is_err
UNION ALL SELECT 'start', mid, 'icon', ms FROM log WHERE is_start
UNION ALL SELECT 'page', mid, page_id, ms FROM log WHERE NOT is_start
UNION ALL SELECT 'display', mid, CAST(k + i AS VARCHAR), ms FROM log, n WHERE i <= n_displays
UNION ALL SELECT 'action', mid, 'a' || i, 0 FROM log, n WHERE i <= n_actions""")
def _(t):
    parts = L.split_log_wrapped(t.log.select(*LOG.fieldNames()))
    none, no_time = F.lit(None).cast("string"), F.lit(0)
    mid = F.col("common.mid")
    shape = {
        "err": (none, F.col("msg"), no_time), "start": (mid, F.col("start.entry"), F.col("ts")),
        "page": (mid, F.col("page.page_id"), F.col("ts")), "display": (mid, F.col("display.item"), F.col("ts")),
        "action": (mid, F.col("action.action_id"), no_time),
    }
    rows = None
    for topic, (who, detail, ts) in shape.items():
        part = parts[topic].select(F.lit(topic).alias("topic"), who.alias("mid"), detail.alias("detail"),
                                   ts.cast("bigint").alias("ts"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


def dim_config(t):
    """Config rows: one routed table with and one without a match in the change log."""
    return t.spark.createDataFrame(
        [("order_info", "dim_order", "id,user_id,order_status", "info", "id", "r"),
         ("cart_info", "dim_cart", "id,sku_num", "info", "id", "r"),
         ("other", "dim_other", "id", "info", "id", "r")],
        "source_table string, sink_table string, sink_columns string, sink_family string, sink_row_key string, op string",
    )


def fact_config(t):
    return t.spark.createDataFrame(
        [("order_info", "bootstrap-insert", "dwd_order_new", "id,user_id", "r"),
         ("order_info", "update", "dwd_order_changed", "id,order_status", "r")],
        "source_table string, source_type string, sink_table string, sink_columns string, op string",
    )


@query("r4_route_dim", f"""WITH {ORDER_CHANGES}, {CARTS}
SELECT 'dim_order' AS sink_table, 'id' AS sink_row_key, type, ts, id FROM order_changes
UNION ALL SELECT 'dim_cart', 'id', type, ts, id FROM carts""")
def _(t):
    changes = t.order_changes.unionByName(t.cart_changes).unionByName(t.detail_changes)
    return R.route_dim(changes, dim_config(t)).select(
        "sink_table", "sink_row_key", "type", "ts", F.col("data")["id"].alias("id"))


@query("r5_route_fact", f"""WITH {ORDER_CHANGES}
SELECT CASE type WHEN 'update' THEN 'dwd_order_changed' ELSE 'dwd_order_new' END AS sink_table, type, ts, id
FROM order_changes WHERE type IN ('insert', 'bootstrap-insert', 'update')""")
def _(t):
    changes = t.order_changes.unionByName(t.cart_changes)
    return R.route_fact(changes, fact_config(t)).select("sink_table", "type", "ts", F.col("data")["id"].alias("id"))


@query("r6_config_state", """SELECT source_table, sink_table, op, ts FROM (
  SELECT 't' || c_nationkey AS source_table, 'dim_' || c_mktsegment AS sink_table,
    CASE WHEN c_custkey % 10 = 0 THEN 'd' ELSE 'u' END AS op, c_custkey AS ts FROM customer)
QUALIFY row_number() OVER (PARTITION BY source_table ORDER BY ts DESC) = 1 AND op <> 'd'""")
def _(t):
    changes = t.customer.select(
        F.concat(F.lit("t"), "c_nationkey").alias("source_table"), F.concat(F.lit("dim_"), "c_mktsegment").alias("sink_table"),
        F.when(F.col("c_custkey") % 10 == 0, "d").otherwise("u").alias("op"), F.col("c_custkey").alias("ts"))
    return R.config_state(changes, ["source_table"])


@query("r7_route_by_op", f"""WITH {CARTS}
SELECT CASE type WHEN 'insert' THEN 'c' WHEN 'update' THEN 'u' ELSE 'r' END || '_cart_info' AS topic, id
FROM carts WHERE type <> 'delete'""")
def _(t):
    return R.route_by_op(t.cart_debezium, dim_config(t)).select("topic", F.col("data")["id"].alias("id"))
