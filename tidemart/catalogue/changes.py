"""Parsing, projection and filtering of messages and change rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.catalogue.registry import query
from tidemart.catalogue.stand_ins import CARTS, DB, DETAILS, LOG_ROWS, ORDER_CHANGES, REFUNDS
from tidemart.functions.ratios import safe_ratio
from tidemart.functions.scalar import snake_columns
from tidemart.operators import changes as C, parse as P
from tidemart.schemas import INSERT_TYPES, LOG

def parsed(df):
    """Some fields of each record, -1 for no error, so that the column stays integral anywhere."""
    return df.select(F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"),
                     F.coalesce("err.error_code", F.lit(-1)).alias("error_code"), "ts")


@query("p1_parse_strict", f"""WITH {LOG_ROWS}
SELECT mid, page_id, CASE WHEN is_err THEN k ELSE -1 END AS error_code, ms AS ts FROM log""")
def _(t):
    values = t.log.select(F.to_json(F.struct(*LOG.fieldNames())).alias("value"))
    return parsed(P.parse_strict(values, LOG))


@query("p2_parse_lenient", f"""WITH {LOG_ROWS}
SELECT mid, page_id, CASE WHEN is_err THEN k ELSE -1 END AS error_code, ms AS ts FROM log WHERE k % 13 <> 0""")
def _(t):
    return parsed(P.parse_lenient(t.log_messages, LOG))


@query("p3_parse_split", f"""WITH {LOG_ROWS}
SELECT 'good' AS side, CASE WHEN k % 13 <> 0 THEN mid END AS mid, CAST(NULL AS VARCHAR) AS raw FROM log WHERE k % 13 <> 0
UNION ALL SELECT 'bad', NULL, '{{"common": {{"mid": ' || k FROM log WHERE k % 13 = 0""")
def _(t):
    good, bad = P.parse_split(t.log_messages, LOG)
    none = F.lit(None).cast("string")
    return good.select(F.lit("good").alias("side"), F.col("common.mid").alias("mid"), none.alias("raw")).unionByName(
        bad.select(F.lit("bad").alias("side"), none.alias("mid"), F.col("value").alias("raw")))


@query("p4_require_fields", f"""WITH {LOG_ROWS}
SELECT event_id, uid, ms AS ts FROM log WHERE uid IS NOT NULL AND uid <> '' AND ms > 0""")
def _(t):
    flat = t.log.select("event_id", F.col("common.uid").alias("uid"), "ts")
    return P.require_fields(flat, ["uid"])


@query("p5_etl_changes", f"""WITH {ORDER_CHANGES}
SELECT type, ts, id FROM order_changes WHERE type NOT IN ('bootstrap-start', 'bootstrap-complete') AND id IS NOT NULL""")
def _(t):
    return C.etl_changes(t.order_changes, DB).select("type", "ts", F.col("data")["id"].alias("id"))


@query("p6_select_table", f"""WITH {ORDER_CHANGES}
SELECT type, ts, id, user_id FROM order_changes WHERE type IN ('bootstrap-insert', 'insert')""")
def _(t):
    rows = C.select_table(t.order_changes.unionByName(t.detail_changes), DB, "order_info")
    return C.extract_map(rows, ("id", "user_id"), keep=("type", "ts"))


@query("p7_status_transition", f"""WITH {ORDER_CHANGES}
SELECT 'cancel' AS step, id, ts FROM order_changes WHERE order_status = '1003'
  AND (type IN ('bootstrap-insert', 'insert') OR (type = 'update' AND old_status = '1001'))
UNION ALL
SELECT 'refund', id, ts FROM order_changes WHERE order_status = '1005'
  AND (type = 'bootstrap-insert' OR (type = 'update' AND old_status IS NOT NULL))
UNION ALL
SELECT 'refunded', id, ts FROM order_changes WHERE order_status = '1006'
  AND (type = 'bootstrap-insert' OR (type = 'update' AND old_status IS NOT NULL))""")
def _(t):
    def step(name, *rule):
        rows = C.status_transition(t.order_changes, "order_status", *rule)
        return rows.select(F.lit(name).alias("step"), F.col("data")["id"].alias("id"), "ts")
    return (
        step("cancel", "1003", "1001", INSERT_TYPES)
        .unionByName(step("refund", "1005")).unionByName(step("refunded", "1006"))
    )


CART_SQL = f"""WITH {CARTS}
SELECT id, user_id, sku_id, cart_price, CASE WHEN type IN ('bootstrap-insert', 'insert') THEN num ELSE num - old_num END AS sku_num,
  sku_name, is_checked, create_time, operate_time, is_ordered, order_time, {{ts}} AS ts
FROM carts WHERE type IN ('bootstrap-insert', 'insert') OR (type = 'update' AND old_num IS NOT NULL AND num > old_num)"""


@query("p8_cart_add", CART_SQL.replace("{ts}", "ts"))
def _(t):
    return C.cart_add(t.cart_changes, DB)


@query("p8_cart_add_debezium", CART_SQL.replace("{ts}", "ts * 1000"))
def _(t):
    return C.cart_add_debezium(t.cart_debezium)


@query("p9_project_config_columns", f"""WITH {ORDER_CHANGES}
SELECT ts, id, CASE WHEN CAST(id AS BIGINT) % 2 = 0 THEN user_id END AS user_id,
  CASE WHEN CAST(id AS BIGINT) % 2 = 1 THEN order_status END AS order_status, 2 AS n
FROM order_changes WHERE id IS NOT NULL""")
def _(t):
    """The payload keys kept depend on the row's own config."""
    rows = C.with_payload(t.order_changes)
    even = F.col("data")["id"].cast("bigint") % 2 == 0
    cut = C.project_config_columns(
        rows.withColumn("sink_columns", F.when(even, "id,user_id").otherwise("id,order_status")))
    data = F.col("data")
    return cut.select("ts", *(data[c].alias(c) for c in ("id", "user_id", "order_status")), F.size(data).alias("n"))


@query("p10_clean_change", f"""WITH {CARTS}
SELECT 'cart_info' AS "table", id, ts * 1000 AS ts_ms,
  CASE type WHEN 'insert' THEN 'c' WHEN 'update' THEN 'u' WHEN 'bootstrap-insert' THEN 'r' ELSE 'd' END AS op FROM carts""")
def _(t):
    return C.clean_change(t.cart_debezium).select("table", F.col("data")["id"].alias("id"), "ts_ms", "op")


@query("p11_flatten_change", f"""WITH {CARTS}
SELECT id || '_' || (ts * 1000) AS id, '{DB}' AS db_name, 'cart_info' AS t_name, CAST(ts * 1000 AS VARCHAR) AS ts,
  CASE type WHEN 'insert' THEN 'CREATE' WHEN 'update' THEN 'UPDATE' WHEN 'bootstrap-insert' THEN 'READ' ELSE 'DELETE' END AS op,
  CASE WHEN type = 'delete' THEN CAST(num AS VARCHAR) WHEN type = 'update' THEN CAST(old_num AS VARCHAR) END AS before_num,
  CASE WHEN type <> 'delete' THEN CAST(num AS VARCHAR) END AS after_num FROM carts""")
def _(t):
    number = lambda c, out: F.get_json_object(c, "$.sku_num").alias(out)
    return C.flatten_change(t.cart_debezium).select(
        "id", "db_name", "t_name", "ts", "op", number("log_before", "before_num"), number("log_after", "after_num"))


@query("p12_extract_map", f"WITH {ORDER_CHANGES} SELECT id AS order_id, province_id, ts FROM order_changes")
def _(t):
    return C.extract_map(t.order_changes, {"order_id": "id", "province_id": "province_id"}, keep=["ts"])


@query("p13_positional_insert", f"""WITH {REFUNDS}
SELECT id, refund_type AS refund_type_code, refund_amount FROM refunds
UNION ALL SELECT id, payment_type, total_amount FROM refund_payments""")
def _(t):
    first = C.select_table(t.refund_changes, DB, "order_refund_info")
    names = ("id", "refund_type_code", "refund_amount")
    refunds = C.positional_insert(C.extract_map(first, ("id", "refund_type", "refund_amount")), names)
    paid = C.extract_map(t.refund_payment_changes, ("id", "payment_type", "total_amount"))
    return refunds.unionByName(C.positional_insert(paid, names))


@query("p14_snake_case_out", "SELECT user_id, event_type, count(*) AS page_view_ct FROM events GROUP BY ALL")
def _(t):
    beans = t.events.groupBy(F.col("user_id").alias("userId"), F.col("event_type").alias("eventType")).agg(
        F.count(F.lit(1)).alias("pageViewCt"), F.max("ts").alias("ts"))
    return snake_columns(beans.drop("ts"))


@query("p15_safe_ratio", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_tax = 0 THEN NULL ELSE l_discount / l_tax END AS ratio,
  CASE WHEN l_discount = 0 THEN NULL ELSE l_quantity / l_discount * 100 END AS percent FROM lineitem""")
def _(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", safe_ratio("l_discount", "l_tax").alias("ratio"),
        safe_ratio("l_quantity", "l_discount", 100).alias("percent"))


@query("p18_assign_shop", f"WITH {DETAILS} SELECT id, l_partkey, CAST(l_partkey % 12 + 1 AS VARCHAR) AS shop_id FROM details")
def _(t):
    return C.assign_shop(t.details.select("id", "l_partkey"), "l_partkey")
