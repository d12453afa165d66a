"""Whole jobs in batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.catalogue.logs import dim_config, fact_config
from tidemart.catalogue.registry import query
from tidemart.catalogue.sources_sinks import FLAT_SQL, logged_carts, round_trip
from tidemart.catalogue.stand_ins import (
    CARTS, DB, DETAILS, FLAT_CARTS, LOG_ROWS, ORDER_CHANGES, PRODUCT, REFUNDS, RESENT, SALES_DETAILS, stamped, text,
)
from tidemart.functions.ratios import LIABILITY_TERMS, insurance_ratios, liability_share, solvency_ratios
from tidemart.operators import changes as C
from tidemart.plans import facts, routes, summaries as S
from tidemart.schemas import DEBEZIUM
from tidemart.session import scratch_dir
from tidemart.sinks import keyed, messages as M
from tidemart.sources import messages as SM

DIC = "dic AS (SELECT CAST(n_nationkey AS VARCHAR) AS rowkey, n_name AS dic_name FROM nation)"


# ---- routing jobs ----------------------------------------------------------------------

ORDER_DIM_SQL = f"""WITH {ORDER_CHANGES},
c AS (SELECT *, type = 'delete' AS deleted FROM order_changes WHERE id IS NOT NULL),
gone AS (SELECT id, max(ts) AS gone FROM c WHERE deleted GROUP BY id)
SELECT c.id AS rowkey, arg_max(c.user_id, ts) AS user_id, arg_max(order_status, ts) AS order_status
FROM c LEFT JOIN gone g ON g.id = c.id WHERE NOT deleted AND (gone IS NULL OR ts > gone) GROUP BY c.id"""


@query("q1_dimension_load", ORDER_DIM_SQL)
def _(t):
    """All configured dimensions in one write; the order dimension read back."""
    where = scratch_dir(t.spark, "q1")
    rows = routes.dim_rows(t.order_changes.unionByName(t.cart_changes), dim_config(t), DB)
    keyed.dim_upsert(rows, where)
    return keyed.read_dim(t.spark, where, "dim_order", ["user_id", "order_status"])


@query("q2_dimension_load_debezium", f"""WITH {FLAT_CARTS}
SELECT id AS rowkey, CAST(arg_max(num, (ts, arrival)) AS VARCHAR) AS sku_num FROM flat_carts WHERE op <> 'DELETE' GROUP BY id""")
def _(t):
    """From a log that keeps its order, which settles changes of one time."""
    where = scratch_dir(t.spark, "q2")
    keyed.dim_upsert(routes.dim_rows_debezium(logged_carts(t, "q2-in"), dim_config(t)), where)
    return keyed.read_dim(t.spark, where, "dim_cart", ["sku_num"])


@query("q3_fact_split", f"""WITH {ORDER_CHANGES}
SELECT CASE type WHEN 'update' THEN 'dwd_order_changed' ELSE 'dwd_order_new' END AS topic, id,
  CASE WHEN type <> 'update' THEN user_id END AS user_id, CASE WHEN type = 'update' THEN order_status END AS order_status
FROM order_changes WHERE type IN ('insert', 'bootstrap-insert', 'update')""")
def _(t):
    where = scratch_dir(t.spark, "q3")
    M.write_routed(routes.fact_messages(t.order_changes.unionByName(t.cart_changes), fact_config(t)), "topic", where)
    row = F.from_json("value", "id STRING, user_id STRING, order_status STRING")
    return t.spark.read.text(where).select("topic", row.alias("r")).select("topic", "r.*")


@query("q4_fact_split_debezium", f"""WITH {CARTS}
SELECT CASE type WHEN 'insert' THEN 'c' WHEN 'update' THEN 'u' ELSE 'r' END || '_cart_info' AS topic, id,
  CAST(num AS VARCHAR) AS sku_num FROM carts WHERE type <> 'delete'""")
def _(t):
    where = scratch_dir(t.spark, "q4")
    M.write_routed(routes.op_messages(t.cart_debezium, dim_config(t)), "topic", where)
    row = F.from_json("value", "id STRING, sku_num STRING")
    return t.spark.read.text(where).select("topic", row.alias("r")).select("topic", "r.*")


LOG_SPLIT_SQL = f"""WITH {LOG_ROWS}, log13 AS (SELECT * FROM log WHERE k % 13 <> 0), s AS (SELECT *, CAST(ts AS DATE) AS day,
  last_value(CASE WHEN is_new = '0' THEN CAST(ts AS DATE) - 1 END IGNORE NULLS) OVER w AS zero_day,
  first_value(CASE WHEN is_new = '1' THEN CAST(ts AS DATE) END IGNORE NULLS) OVER w AS one_day
  FROM log13 WINDOW w AS (PARTITION BY mid ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, CASE WHEN is_new = '1' AND coalesce(zero_day, one_day, day) <> day THEN '0' ELSE is_new END AS fixed FROM s),
n AS (SELECT unnest(range(1, 4)) AS i)
SELECT 'err' AS topic, mid, ms AS ts, fixed AS is_new FROM f WHERE is_err
UNION ALL SELECT 'start', mid, ms, fixed FROM f WHERE is_start
UNION ALL SELECT 'page', mid, ms, fixed FROM f WHERE NOT is_start
UNION ALL SELECT 'display', mid, ms, fixed FROM f, n WHERE i <= n_displays
UNION ALL SELECT 'action', mid, ms, fixed FROM f, n WHERE i <= n_actions"""


def log_fields(rows):
    value = lambda path: F.get_json_object("value", path)
    return rows.select("topic", value("$.common.mid").alias("mid"), value("$.ts").cast("bigint").alias("ts"),
                       value("$.common.is_new").alias("is_new"))


@query("q5_log_split", LOG_SPLIT_SQL)
def _(t):
    """Raw text with broken records to the five log topics, the new-visitor flag repaired."""
    where = scratch_dir(t.spark, "q5")
    M.write_routed(routes.log_split(t.log_messages, strict=False), "topic", where)
    return log_fields(t.spark.read.text(where))


# ---- fact jobs -------------------------------------------------------------------------

@query("q6_comments", f"""WITH {DIC}
SELECT CAST(doc_id AS VARCHAR) AS id, CAST(doc_id % 97 AS VARCHAR) AS user_id, source AS nick_name, CAST(doc_id % 200 AS VARCHAR) AS sku_id,
  CAST(doc_id % 20 AS VARCHAR) AS spu_id, CAST(doc_id * 3 AS VARCHAR) AS order_id, CAST(doc_id % 30 AS VARCHAR) AS appraise,
  dic_name, text AS comment_txt, '2024-01-01 00:00:00' AS create_time
FROM documents JOIN dic ON rowkey = CAST(doc_id % 30 AS VARCHAR) WHERE lang <> 'es'""")
def _(t):
    return facts.comments(t.comment_changes, t.dictionary, DB)


@query("q7_cart_adds", f"""WITH {CARTS}
SELECT id, user_id, sku_id, cart_price, CASE WHEN type IN ('bootstrap-insert', 'insert') THEN num ELSE num - old_num END AS sku_num,
  sku_name, is_checked, create_time, operate_time, is_ordered, order_time, ts
FROM carts WHERE type IN ('bootstrap-insert', 'insert') OR (type = 'update' AND old_num IS NOT NULL AND num > old_num)""")
def _(t):
    return facts.cart_adds(t.cart_changes.unionByName(t.order_changes), DB)


DETAIL_CTE = f"""{ORDER_CHANGES}, {DETAILS},
wide AS (SELECT d.id, d.order_id, d.sku_id, c.user_id, c.province_id, a.activity_id, a.activity_rule_id, k.coupon_id, d.sku_name,
    d.order_price, d.sku_num, d.create_time, d.split_total_amount, d.split_activity_amount, d.split_coupon_amount, d.ts
  FROM details d JOIN order_changes c ON c.id = d.order_id AND c.type IN ('bootstrap-insert', 'insert')
  LEFT JOIN activity a ON a.id = d.id LEFT JOIN coupon k ON k.id = d.id)"""


@query("q8_order_detail", f"WITH {DETAIL_CTE} SELECT * FROM wide")
def _(t):
    return facts.order_detail(t.sales_changes, DB)


@query("q9_order_cancel", f"""WITH {DETAIL_CTE}
SELECT w.id, w.order_id, w.sku_id, w.user_id, w.province_id, activity_id, activity_rule_id, coupon_id, sku_name, order_price, sku_num,
  create_time, c.operate_time, split_total_amount, split_activity_amount, split_coupon_amount, c.ts
FROM wide w JOIN order_changes c ON c.id = w.order_id WHERE order_status = '1003'
  AND (type IN ('bootstrap-insert', 'insert') OR (type = 'update' AND old_status = '1001'))""")
def _(t):
    return facts.order_cancel(facts.order_detail(t.sales_changes, DB), t.order_changes, DB)


PAY_SQL = f"""WITH {DETAIL_CTE}, {DIC}
SELECT w.id, w.order_id, sku_id, user_id, province_id, activity_id, activity_rule_id, coupon_id, sku_name, order_price, sku_num,
  split_total_amount, split_activity_amount, split_coupon_amount, CAST(o_custkey % 30 AS VARCHAR) AS payment_type_code,
  dic_name AS payment_type_name, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS payment_time, CAST(epoch(o_orderdate) AS BIGINT) AS ts
FROM wide w JOIN orders ON CAST(o_orderkey AS VARCHAR) = w.order_id JOIN dic ON rowkey = CAST(o_custkey % 30 AS VARCHAR)
WHERE o_custkey % 3 IN (0, 1) AND epoch(o_orderdate) >= w.ts - 15 * 86400"""


@query("q10_payment_success", PAY_SQL + " AND epoch(o_orderdate) <= w.ts + 5 * 86400")
def _(t):
    """Days stand for seconds in the test data's time range."""
    detail = facts.order_detail(t.sales_changes, DB)
    return facts.payment_success(detail, t.payment_changes, t.dictionary, DB, -15 * 86400, 5 * 86400)


@query("q10_payment_success_open", PAY_SQL)
def _(t):
    detail = facts.order_detail(t.sales_changes, DB)
    return facts.payment_success(detail, t.payment_changes, t.dictionary, DB, -15 * 86400, None)


@query("q11_order_refund", f"""WITH {ORDER_CHANGES}, {REFUNDS}
SELECT r.id, r.user_id, r.order_id, r.sku_id, c.province_id, substr(r.create_time, 1, 10) AS date_id, r.create_time,
  refund_type AS refund_type_code, a.dic_name AS refund_type_name, refund_reason_type AS refund_reason_type_code,
  b.dic_name AS refund_reason_type_name, refund_reason_txt, refund_num, refund_amount, r.ts
FROM refunds r JOIN order_changes c ON c.id = r.order_id AND order_status = '1005'
  AND (type = 'bootstrap-insert' OR (type = 'update' AND old_status IS NOT NULL))
JOIN dic a ON a.rowkey = refund_type JOIN dic b ON b.rowkey = refund_reason_type""")
def _(t):
    return facts.order_refund(t.refund_changes.unionByName(t.order_changes), t.dictionary, DB)


@query("q12_refund_payment", f"""WITH {ORDER_CHANGES}, {REFUNDS}
SELECT p.id, c.user_id, p.order_id, p.sku_id, c.province_id, p.payment_type AS payment_type_code, dic_name AS payment_type_name,
  substr(callback_time, 1, 10) AS date_id, callback_time, refund_num, total_amount AS refund_amount, p.ts
FROM refund_payments p JOIN refunds r ON r.order_id = p.order_id AND r.sku_id = p.sku_id AND r.l_linestatus = 'F'
JOIN order_changes c ON c.id = p.order_id AND order_status = '1006'
  AND (type = 'bootstrap-insert' OR (type = 'update' AND old_status IS NOT NULL))
JOIN dic ON rowkey = p.payment_type WHERE p.entered""")
def _(t):
    changes = t.refund_payment_changes.unionByName(t.refund_changes).unionByName(t.order_changes)
    return facts.refund_payment(changes, t.dictionary, DB)


# ---- summary jobs ----------------------------------------------------------------------

HOUR = "1 hour"


@query("q13_keyword_window", rf"""WITH {LOG_ROWS}, w AS (SELECT ts, unnest(list_distinct(regexp_extract_all(lower(item), '[\p{{L}}\p{{N}}]+'))) AS keyword
  FROM pages_log WHERE last_page_id IN ('search', 'home') AND item_type = 'keyword' AND item IS NOT NULL)
SELECT stt AS window_start, edt AS window_end, replace(cur_date, '-', '') AS cur_date, keyword, count(*) AS keyword_count
FROM (SELECT {stamped(HOUR)}, keyword FROM w) GROUP BY ALL""")
def _(t):
    page = F.from_json(F.to_json("page"), "map<string,string>")
    return S.keyword_window(t.pages.select(page.alias("page"), "row_time"), HOUR, "window")


TRAFFIC_SQL = f"""WITH {LOG_ROWS}, p AS (SELECT *,
  row_number() OVER (PARTITION BY mid, CAST(ts AS DATE) ORDER BY ts, vc, ch, ar, is_new) AS day_rn,
  row_number() OVER (PARTITION BY sid ORDER BY ts, vc, ch, ar, is_new) AS sid_rn FROM pages_log)
SELECT {stamped(HOUR)}, vc, ch, ar, is_new, CAST(count(*) FILTER (WHERE day_rn = 1) AS BIGINT) AS uv_ct,
  CAST(count(*) FILTER (WHERE sid_rn = 1) AS BIGINT) AS sv_ct, count(*) AS pv_ct, CAST(sum(during_time) AS BIGINT) AS dur_sum
FROM p GROUP BY ALL"""


@query("q14_traffic_window", TRAFFIC_SQL)
def _(t):
    return S.traffic_window(t.pages, HOUR, "window")


@query("q15_page_visitor_window", f"""WITH {LOG_ROWS}, p AS (SELECT min(ts) AS ts, mid, page_id FROM pages_log
  WHERE page_id IN ('home', 'good_detail') GROUP BY mid, page_id, CAST(ts AS DATE))
SELECT {stamped(HOUR)}, count(*) FILTER (WHERE page_id = 'home') AS home_uv_ct,
  count(*) FILTER (WHERE page_id = 'good_detail') AS good_detail_uv_ct FROM p GROUP BY ALL""")
def _(t):
    return S.page_visitor_window(t.pages, HOUR, "window")


@query("q16_login_window", f"""WITH {LOG_ROWS}, u AS (SELECT uid, CAST(ts AS DATE) AS day, min(ts) AS ts FROM pages_log
  WHERE uid IS NOT NULL AND (last_page_id IS NULL OR last_page_id = 'login') GROUP BY 1, 2),
b AS (SELECT *, CASE WHEN day - lag(day) OVER (PARTITION BY uid ORDER BY day) > 7 THEN 1 ELSE 0 END AS back FROM u)
SELECT {stamped(HOUR)}, CAST(sum(back) AS BIGINT) AS back_ct, count(*) AS uu_ct FROM b GROUP BY ALL""")
def _(t):
    return S.login_window(t.pages, HOUR, cur_date="window")


@query("q17_register_window", f"""SELECT {stamped(HOUR, "signed")}, count(*) AS register_ct
FROM (SELECT date_trunc('second', ts) - INTERVAL 8 HOUR AS signed FROM events WHERE event_type = 'signup') GROUP BY ALL""")
def _(t):
    """Registrations carry their time as text of zone +8."""
    rows = t.events.where(F.col("event_type") == "signup").select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("create_time"))
    return S.register_window(S.with_create_time(rows), HOUR, "window")


def user_sql(source: str, unique: str, new: str | None = None, size: str = "1 day", ctes: str = "") -> str:
    first = f", CAST(sum(CASE WHEN day = first_day THEN 1 ELSE 0 END) AS BIGINT) AS {new}" if new else ""
    return f"""WITH {ctes} u AS (SELECT user_id, CAST(ts AS DATE) AS day, min(ts) AS ts FROM ({source}) GROUP BY 1, 2),
f AS (SELECT *, min(day) OVER (PARTITION BY user_id) AS first_day FROM u)
SELECT {stamped(size)}, count(*) AS {unique}{first} FROM f GROUP BY ALL"""


@query("q18_cart_user_window", user_sql(
    "SELECT user_id, ts FROM events WHERE event_type IN ('click', 'purchase')", "cart_add_uu_ct", size=HOUR))
def _(t):
    rows = t.events.where(F.col("event_type").isin("click", "purchase")).select(
        text("user_id").alias("user_id"), F.col("ts").alias("row_time"))
    return S.cart_user_window(rows, HOUR, "window")


@query("q19_order_user_window", user_sql(
    "SELECT user_id, l_shipdate AS ts FROM sales", "order_unique_user_count", "order_new_user_count", ctes=SALES_DETAILS + ","))
def _(t):
    return S.order_user_window(t.sales_details, "1 day", "window")


@query("q20_payment_user_window", user_sql(
    "SELECT CAST(o_custkey AS VARCHAR) AS user_id, o_orderdate AS ts FROM orders WHERE o_custkey % 3 IN (0, 1)",
    "payment_suc_unique_user_count", "payment_suc_new_user_count"))
def _(t):
    paid = C.extract_map(C.status_transition(t.payment_changes, "payment_status", "1602"), ("user_id",), keep=["ts"])
    return S.payment_user_window(paid.withColumn("row_time", F.timestamp_seconds("ts")), "1 day", "window")


SKU_SQL = f"""WITH {DETAILS}, {PRODUCT},
m AS (SELECT *, CAST(order_price AS DECIMAL(18,2)) * CAST(sku_num AS INT) AS original,
  coalesce(CAST(split_activity_amount AS DECIMAL(18,2)), 0) AS activity, coalesce(CAST(split_coupon_amount AS DECIMAL(18,2)), 0) AS coupon,
  CAST(split_total_amount AS DECIMAL(18,2)) AS total FROM details),
d AS (SELECT l_shipdate AS ts, sku_id, sku_name, original - coalesce(lag(original) OVER w, 0) AS original, activity - coalesce(lag(activity) OVER w, 0) AS activity,
  coupon - coalesce(lag(coupon) OVER w, 0) AS coupon, total - coalesce(lag(total) OVER w, 0) AS total FROM m WINDOW w AS ({RESENT})),
s AS (SELECT {stamped('1 day')}, sku_id, min(sku_name) AS sku_name, CAST(sum(original) AS DOUBLE) AS original_amount,
  CAST(sum(activity) AS DOUBLE) AS activity_reduce_amount, CAST(sum(coupon) AS DOUBLE) AS coupon_reduce_amount,
  CAST(sum(total) AS DOUBLE) AS order_amount FROM d GROUP BY stt, edt, cur_date, sku_id)
SELECT s.*, product.* EXCLUDE (sku_id) FROM s LEFT JOIN product ON product.sku_id = s.sku_id"""


@query("q21_sku_order_window", SKU_SQL)
def _(t):
    return S.sku_order_window(t.sales_details_only(), t.product_dims, "1 day", t.RESENT_TIE, cur_date="window")


@query("q22_province_order_window", f"""WITH {SALES_DETAILS},
d AS (SELECT l_shipdate AS ts, order_id, province_id, CAST(split_total_amount AS DECIMAL(18,2))
  - coalesce(lag(CAST(split_total_amount AS DECIMAL(18,2))) OVER w, 0) AS total FROM sales WINDOW w AS ({RESENT})),
s AS (SELECT {stamped('1 day')}, province_id, count(DISTINCT order_id) AS order_count, CAST(sum(total) AS DOUBLE) AS order_amount
  FROM d GROUP BY stt, edt, cur_date, province_id)
SELECT s.*, n_name AS province_name FROM s LEFT JOIN nation ON CAST(n_nationkey AS VARCHAR) = province_id""")
def _(t):
    return S.province_order_window(t.sales_details, t.provinces, "1 day", t.RESENT_TIE, cur_date="window")


@query("q23_refund_window", f"""WITH {REFUNDS}, {PRODUCT},
r AS (SELECT make_timestamp(ts * 1000000) AS ts, user_id, order_id, trademark_id, trademark_name, category3_id, category3_name, category2_id, category2_name,
  category1_id, category1_name FROM refunds LEFT JOIN product ON product.sku_id = refunds.sku_id)
SELECT {stamped('1 day')}, user_id, trademark_id, trademark_name, category3_id, category3_name, category2_id, category2_name,
  category1_id, category1_name, count(DISTINCT order_id) AS refund_count FROM r GROUP BY ALL""")
def _(t):
    asked = C.extract_map(C.select_table(t.refund_changes, DB, "order_refund_info"), ("user_id", "order_id", "sku_id"), keep=["ts"])
    return S.refund_window(asked.withColumn("row_time", F.timestamp_seconds("ts")), t.product_dims, "1 day", "window")


@query("q24_shop_window", f"""WITH s AS (SELECT l_shipdate AS ts, CAST(l_partkey % 12 + 1 AS VARCHAR) AS shop_id,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS total FROM lineitem),
w AS (SELECT {stamped('10 seconds')}, shop_id, CAST(sum(total) AS DOUBLE) AS amount FROM s GROUP BY stt, edt, cur_date, shop_id)
SELECT w.*, n_name AS shop_name FROM w LEFT JOIN nation ON CAST(n_nationkey AS VARCHAR) = shop_id""")
def _(t):
    return S.shop_window(t.sales_details_only(), t.provinces, "l_partkey", cur_date="window")


# ---- relays ----------------------------------------------------------------------------

@query("q25_flat_changelog", FLAT_SQL)
def _(t):
    where = scratch_dir(t.spark, "q25")
    keyed.write_changelog_flat(routes.flat_changes(logged_carts(t, "q25-in")), where)
    return keyed.read_changelog_flat(t.spark, where)


@query("q26_json_to_table", "SELECT event_id, user_id, event_type, value FROM events")
def _(t):
    where = scratch_dir(t.spark, "q26")
    values = t.events.select(F.to_json(F.struct("event_id", "user_id", "event_type", "value")).alias("value"))
    row = F.from_json("value", "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE")
    keyed.write_summary(round_trip(t, values, "q26-in").select(row.alias("r")).select("r.*"), where)
    return keyed.read_summary(t.spark, where, ["event_id"])


@query("q27_message_relay", f"""WITH {CARTS}
SELECT id, ts * 1000 AS ts_ms FROM carts""")
def _(t):
    where = scratch_dir(t.spark, "q27")
    values = t.cart_debezium.select(F.to_json(F.struct(*DEBEZIUM.fieldNames())).alias("value"))
    raw = round_trip(t, values, "q27-in")
    M.write_routed(raw.withColumn("topic", F.lit("topic_db")), "topic", where)
    back = SM.debezium_stream(SM.read_messages(t.spark, f"{where}/topic=topic_db", "text", stream=False))
    return back.select(F.coalesce(F.col("after")["id"], F.col("before")["id"]).alias("id"), "ts_ms")


# ---- reports ---------------------------------------------------------------------------

def company_columns(balance: str) -> dict[str, str]:
    """Insurance columns as whole amounts computed from the customer's balance and key."""
    terms = {name: f"CAST({balance} AS BIGINT) % {i + 7} + c_custkey % {i + 3}" for i, name in enumerate(LIABILITY_TERMS)}
    return {
        **terms, "owner_equity": "c_custkey % 50", "total_liabilities": "c_custkey % 70 - 20",
        "admitted_assets": "c_custkey % 40", "admitted_liabilities": "c_custkey % 30", "minimum_capital": "c_custkey % 20",
        "beginning_actual_capital": "c_custkey % 60", "ending_actual_capital": "c_custkey % 90",
    }


TYPES = "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '财险业务' WHEN 'BUILDING' THEN '人身险业务' WHEN 'FURNITURE' THEN '再保财险业务' WHEN 'MACHINERY' THEN '再保人身险业务' ELSE '其他' END"
COMPANIES = "companies AS (SELECT CAST(c_custkey AS VARCHAR) AS company_id, " + TYPES + " AS business_type, " + ", ".join(
    f"CAST({e} AS DOUBLE) AS {c}" for c, e in company_columns("floor(c_acctbal)").items()) + " FROM customer)"
LIABILITIES = "(" + " + ".join(LIABILITY_TERMS) + ")"
KNOWN = "WHERE business_type <> '其他'"
SHARE = f"""CASE WHEN total_liabilities + owner_equity = 0 THEN NULL ELSE {LIABILITIES} / (total_liabilities + owner_equity) * 100 END AS insurance_liability_ratio"""


def companies(t):
    columns = [F.expr(f"CAST({e} AS DOUBLE)").alias(c) for c, e in company_columns("floor(c_acctbal)").items()]
    return t.customer.select(text("c_custkey").alias("company_id"), F.expr(TYPES).alias("business_type"), *columns)


@query("q28_insurance_ratios", f"""WITH {COMPANIES} SELECT company_id, business_type,
  CASE WHEN owner_equity = 0 THEN NULL ELSE unpaid_claims_reserve / owner_equity END AS unpaid_claims_reserve_to_equity_ratio,
  {LIABILITIES} AS insurance_liabilities, total_liabilities + owner_equity AS total_liabilities_and_equity, {SHARE} FROM companies {KNOWN}""")
def _(t):
    return insurance_ratios(companies(t))


@query("p16_liability_share", f"""WITH {COMPANIES} SELECT business_type, {LIABILITIES} AS insurance_liability,
  total_liabilities + owner_equity AS total_liabilities_and_equity, {SHARE} FROM companies {KNOWN}""")
def _(t):
    return liability_share(companies(t))


@query("p17_solvency_ratios", f"""WITH {COMPANIES} SELECT business_type,
  CASE WHEN minimum_capital = 0 THEN NULL ELSE (admitted_assets - admitted_liabilities) / minimum_capital * 100 END AS solvency_ratio,
  CASE WHEN beginning_actual_capital = 0 THEN NULL ELSE (ending_actual_capital - beginning_actual_capital) / beginning_actual_capital * 100 END AS actual_capital_change_rate,
  CASE WHEN admitted_assets = 0 THEN NULL ELSE admitted_liabilities / admitted_assets * 100 END AS admitted_asset_liability_ratio
FROM companies {KNOWN}""")
def _(t):
    return solvency_ratios(companies(t))
