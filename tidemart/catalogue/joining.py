"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.catalogue.registry import query
from tidemart.catalogue.stand_ins import DB, DETAILS, ORDER_CHANGES, PRODUCT, REFUNDS, text
from tidemart.functions.keywords import words
from tidemart.operators import changes as C, joins as J
from tidemart.schemas import INSERT_TYPES

DIC = "dic AS (SELECT CAST(n_nationkey AS VARCHAR) AS rowkey, n_name AS dic_name FROM nation)"


def orders_in(t):
    return t.orders.select(text("o_orderkey").alias("id"), text("o_custkey").alias("user_id"), "o_orderdate")


@query("j1_order_wide_inner", f"""WITH {DETAILS}
SELECT id, order_id, sku_id, CAST(o_custkey AS VARCHAR) AS user_id, ts FROM details JOIN orders ON o_orderkey = l_orderkey""")
def _(t):
    detail = t.details.select("id", "order_id", "sku_id", "ts")
    return J.order_wide(detail, orders_in(t).select("id", "user_id"))


@query("j2_order_wide_left", f"""WITH {DETAILS}
SELECT d.id, order_id, CAST(o_custkey AS VARCHAR) AS user_id, activity_id, activity_rule_id, coupon_id
FROM details d JOIN orders ON o_orderkey = l_orderkey LEFT JOIN activity a ON a.id = d.id LEFT JOIN coupon c ON c.id = d.id""")
def _(t):
    activity = C.extract_map(t.activity_changes, {
        "id": "order_detail_id", "activity_id": "activity_id", "activity_rule_id": "activity_rule_id"})
    coupon = C.extract_map(t.coupon_changes, {"id": "order_detail_id", "coupon_id": "coupon_id"})
    return J.order_wide(t.details.select("id", "order_id"), orders_in(t).select("id", "user_id"), activity, coupon)


@query("j3_cancel_join", f"""WITH {ORDER_CHANGES}, {DETAILS}
SELECT d.id, d.order_id, d.sku_id, c.operate_time, c.ts FROM details d JOIN order_changes c ON c.id = d.order_id
WHERE order_status = '1003' AND (type IN ('bootstrap-insert', 'insert') OR (type = 'update' AND old_status = '1001'))""")
def _(t):
    cancelled = C.extract_map(
        C.status_transition(t.order_changes, "order_status", "1003", "1001", INSERT_TYPES), ("id", "operate_time"), keep=["ts"])
    return J.cancel_join(t.details.select("id", "order_id", "sku_id", "ts"), cancelled)


@query("j4_composite_key_join", f"""WITH {REFUNDS}
SELECT p.id, p.order_id, p.sku_id, p.total_amount, r.refund_num, CAST(o_custkey AS VARCHAR) AS user_id
FROM refund_payments p JOIN refunds r ON r.order_id = p.order_id AND r.sku_id = p.sku_id
JOIN orders ON CAST(o_orderkey AS VARCHAR) = p.order_id""")
def _(t):
    paid = C.extract_map(t.refund_payment_changes, ("id", "order_id", "sku_id", "total_amount"))
    refunds = C.extract_map(C.select_table(t.refund_changes, DB, "order_refund_info"), ("order_id", "sku_id", "refund_num"))
    return J.composite_key_join(paid, refunds, orders_in(t).select("id", "user_id"))


DAY = 86400
INTERVAL_SQL = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey
WHERE o_orderdate >= l_shipdate - INTERVAL 15 DAY"""


def interval_rows(t, upper):
    left = t.lineitem.select(F.col("l_orderkey").alias("key"), "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    right = t.orders.select(F.col("o_orderkey").alias("key"), "o_custkey", "o_orderdate")
    rows = J.interval_join(left, right, "key", "l_shipdate", "o_orderdate", -15 * DAY, upper)
    return rows.select(F.col("key").alias("l_orderkey"), "l_linenumber", "l_partkey", "l_suppkey", "o_custkey")


@query("j5_interval_join", INTERVAL_SQL + " AND o_orderdate <= l_shipdate + INTERVAL 5 DAY")
def _(t):
    return interval_rows(t, 5 * DAY)


@query("j5_interval_join_open", INTERVAL_SQL)
def _(t):
    return interval_rows(t, None)


@query("j6_lookup_join", f"""WITH {DIC} SELECT o_orderkey, dic_name FROM orders JOIN dic ON rowkey = CAST(o_custkey % 30 AS VARCHAR)""")
def _(t):
    rows = t.orders.select("o_orderkey", text(F.col("o_custkey") % 30).alias("code"))
    return J.lookup_join(rows, t.dictionary, "code", {"dic_name": "info.dic_name"}).drop("code")


@query("j7_lookup_join_twice", f"""WITH {DIC} SELECT o_orderkey, a.dic_name AS type_name, b.dic_name AS reason_name FROM orders
JOIN dic a ON a.rowkey = CAST(o_custkey % 30 AS VARCHAR) JOIN dic b ON b.rowkey = CAST(o_orderkey % 28 AS VARCHAR)""")
def _(t):
    rows = t.orders.select("o_orderkey", text(F.col("o_custkey") % 30).alias("type"), text(F.col("o_orderkey") % 28).alias("reason"))
    return J.lookup_join_twice(rows, t.dictionary, "type", "reason", ("type_name", "reason_name")).drop("type", "reason")


@query("j8_enrich", """SELECT o_orderkey, n_name AS province_name FROM orders LEFT JOIN nation ON n_nationkey = o_custkey % 30""")
def _(t):
    rows = t.orders.select("o_orderkey", text(F.col("o_custkey") % 30).alias("province_id"))
    return J.enrich(rows, t.provinces, "province_id", {"province_name": "name"}).drop("province_id")


@query("j9_enrich_product_chain", f"""WITH {PRODUCT}
SELECT l_orderkey, l_linenumber, l_suppkey, CAST(l_partkey AS VARCHAR) AS sku_id, spu_id, spu_name, trademark_id, trademark_name,
  category3_id, category3_name, category2_id, category2_name, category1_id, category1_name
FROM lineitem LEFT JOIN product ON sku_id = CAST(l_partkey AS VARCHAR)""")
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", text("l_partkey").alias("sku_id"))
    return J.enrich_product_chain(rows, t.product_dims)


@query("j10_lateral_udtf", r"""SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'))) AS keyword FROM documents""")
def _(t):
    return J.lateral_keywords(t.documents.select("doc_id", "text"), words, "text").select("doc_id", "keyword")


@query("j11_map_join", """SELECT c_custkey, n_name, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def _(t):
    rows = t.customer.select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    return J.map_join(rows, t.nation, "n_nationkey").select("c_custkey", "n_name", "n_regionkey")
