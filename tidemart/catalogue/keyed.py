"""Keyed, order-dependent operators in their batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.catalogue.registry import query
from tidemart.catalogue.stand_ins import DETAILS, LOG_ROWS, RESENT
from tidemart.functions.scalar import money, or_zero
from tidemart.operators import flags

DAY = "CAST(ts AS DATE)"


@query("t1_first_of_day", f"""SELECT event_id, user_id,
  CASE WHEN lag({DAY}) OVER w IS DISTINCT FROM {DAY} THEN 1 ELSE 0 END AS is_first
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def _(t):
    return flags.first_of_day(t.events, ["user_id"], "ts", ["event_id"]).select("event_id", "user_id", "is_first")


@query("t2_first_ever", """SELECT event_id, user_id, CASE WHEN row_number() OVER w = 1 THEN 1 ELSE 0 END AS is_first
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def _(t):
    return flags.first_ever(t.events, ["user_id"], "ts", ["event_id"]).select("event_id", "user_id", "is_first")


# state before a row: the day before the last preceding 0-row, else the first row's date
REPAIR_SQL = f"""WITH {LOG_ROWS}, s AS (SELECT event_id, mid, is_new, CAST(ts AS DATE) AS day,
  last_value(CASE WHEN is_new = '0' THEN CAST(ts AS DATE) - 1 END IGNORE NULLS) OVER w AS zero_day,
  first_value(CASE WHEN is_new = '1' THEN CAST(ts AS DATE) END IGNORE NULLS) OVER w AS one_day
  FROM log WINDOW w AS (PARTITION BY mid ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT event_id, mid, is_new, CASE WHEN is_new = '1' AND coalesce(zero_day, one_day, day) <> day THEN '0' ELSE is_new END AS is_new_fixed
FROM s"""


@query("t3_repair_new_flag", REPAIR_SQL)
def _(t):
    rows = t.log.select("event_id", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"),
                        F.timestamp_millis("ts").alias("row_time"))
    fixed = flags.repair_new_flag(rows, "mid", "row_time", F.col("is_new"), ["event_id"])
    return fixed.select("event_id", "mid", "is_new", "is_new_fixed")


@query("t4_returning_user", f"""WITH d AS (SELECT user_id, {DAY} AS day FROM events GROUP BY ALL)
SELECT user_id, strftime(day, '%Y-%m-%d') AS day, CASE WHEN day - lag(day) OVER (PARTITION BY user_id ORDER BY day) > 2
  THEN 1 ELSE 0 END AS back FROM d""")
def _(t):
    """Two days of absence instead of seven, which no user of the test data reaches."""
    return flags.returning_user(t.events, ["user_id"], "ts", days=2).select(
        "user_id", F.date_format("day", "yyyy-MM-dd").alias("day"), "back")


@query("t5_page_first_of_day", f"""WITH {LOG_ROWS}
SELECT mid, page_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_view FROM pages_log
WHERE page_id IN ('home', 'good_detail') GROUP BY mid, page_id, {DAY}""")
def _(t):
    rows = t.pages.select(F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"), "row_time")
    firsts = flags.page_first_of_day(rows, "mid", "page_id", "row_time")
    return firsts.select("mid", "page_id", F.date_format("row_time", "yyyy-MM-dd HH:mm:ss").alias("first_view"))


@query("t6_delta_by_key", f"""WITH {DETAILS}
SELECT id, l_partkey, l_suppkey, CAST(CAST(l_extendedprice AS DECIMAL(18,2))
  - coalesce(lag(CAST(l_extendedprice AS DECIMAL(18,2))) OVER w, 0) AS DOUBLE) AS delta
FROM details WINDOW w AS ({RESENT})""")
def _(t):
    rows = t.sales_details_only().withColumn("total", money("split_total_amount"))
    deltas = flags.delta_by_key(rows, ["id"], {"delta": "total"}, "row_time", t.RESENT_TIE)
    return deltas.select("id", "l_partkey", "l_suppkey", "delta")


def delta_sql(columns: dict[str, str]) -> str:
    return ", ".join(
        f"CAST({m} - coalesce(lag({m}) OVER w, 0) AS DOUBLE) AS {o}" for o, m in columns.items()
    )


@query("t7_delta_by_key_multi", f"""WITH {DETAILS},
m AS (SELECT *, CAST(order_price AS DECIMAL(18,2)) * CAST(sku_num AS INT) AS original,
  coalesce(CAST(split_activity_amount AS DECIMAL(18,2)), 0) AS activity, coalesce(CAST(split_coupon_amount AS DECIMAL(18,2)), 0) AS coupon,
  CAST(split_total_amount AS DECIMAL(18,2)) AS total FROM details)
SELECT id, l_partkey, l_suppkey, {delta_sql({'d_original': 'original', 'd_activity': 'activity', 'd_coupon': 'coupon', 'd_total': 'total'})}
FROM m WINDOW w AS ({RESENT})""")
def _(t):
    rows = t.sales_details_only().withColumns({
        "original": (money("order_price") * money("sku_num", 10, 0)).cast("decimal(28,2)"),
        "activity": or_zero(money("split_activity_amount")), "coupon": or_zero(money("split_coupon_amount")),
        "total": money("split_total_amount"),
    })
    outs = {f"d_{c}": c for c in ("original", "activity", "coupon", "total")}
    return flags.delta_by_key(rows, ["id"], outs, "row_time", t.RESENT_TIE).select("id", "l_partkey", "l_suppkey", *outs)


@query("t8_state_ttl", """WITH v AS (SELECT event_id, user_id, ts, CAST(value AS DECIMAL(18,2)) AS v FROM events),
p AS (SELECT *, lag(v) OVER w AS pv, lag(ts) OVER w AS pt FROM v WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, user_id, CAST(v - CASE WHEN ts < pt + INTERVAL 6 HOUR THEN pv ELSE 0 END AS DOUBLE) AS delta FROM p""")
def _(t):
    """Values older than six hours of event time are forgotten."""
    rows = t.events.withColumn("v", money("value"))
    deltas = flags.delta_by_key(rows, ["user_id"], {"delta": "v"}, "ts", ["event_id"], ttl_seconds=6 * 3600)
    return deltas.select("event_id", "user_id", "delta")
