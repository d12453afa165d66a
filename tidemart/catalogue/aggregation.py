"""Windowed and keyed aggregation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.catalogue.registry import query
from tidemart.catalogue.stand_ins import stamped
from tidemart.functions.scalar import money
from tidemart.operators import aggregates as A
from tidemart.operators.joins import map_join
from tidemart.plans.reports import regional_count

HOUR = "1 hour"


def stamp(df):
    return A.stamp_window(df, cur_date="window")


@query("a1_window_sum_by_key", f"""SELECT {stamped(HOUR)}, event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amount,
  count(*) AS n FROM events GROUP BY ALL""")
def _(t):
    return stamp(A.window_sum_by_key(t.events, HOUR, ["event_type"], {"amount": money("value"), "n": F.lit(1)}, "ts"))


@query("a2_window_sum_global", f"""SELECT {stamped(HOUR)}, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amount, count(*) AS n
FROM events GROUP BY ALL""")
def _(t):
    return stamp(A.window_sum_global(t.events, HOUR, {"amount": money("value"), "n": F.lit(1)}, "ts"))


@query("a3_window_distinct", f"""SELECT {stamped('1 day')}, event_type, count(DISTINCT user_id) AS users,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM events GROUP BY ALL""")
def _(t):
    return stamp(A.window_distinct(t.events, "1 day", ["event_type"], "user_id", "users", {"amount": money("value")}, "ts"))


@query("a4_keyword_count", f"""SELECT {stamped(HOUR)}, event_type AS keyword, count(*) AS keyword_count FROM events GROUP BY ALL""")
def _(t):
    return stamp(A.keyword_count(t.events.withColumnRenamed("event_type", "keyword"), HOUR, ts="ts"))


@query("a5_stamp_window", """SELECT strftime(time_bucket(INTERVAL '5 seconds', ts, TIMESTAMP '1970-01-01'), '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(time_bucket(INTERVAL '5 seconds', ts, TIMESTAMP '1970-01-01') + INTERVAL 5 SECOND, '%Y-%m-%d %H:%M:%S') AS window_end,
  strftime(ts, '%Y%m%d') AS cur_date, count(*) AS n FROM events GROUP BY ALL""")
def _(t):
    counts = A.window_sum_global(t.events, "5 seconds", {"n": F.lit(1)}, "ts")
    return A.stamp_window(counts, ("window_start", "window_end", "cur_date"), "yyyyMMdd", "window")


@query("u2_reduce_with_window", f"""SELECT {stamped(HOUR)}, event_type, max(value) AS top, min(value) AS low, count(*) AS n
FROM events GROUP BY ALL""")
def _(t):
    aggs = {"top": F.max("value"), "low": F.min("value"), "n": F.count(F.lit(1))}
    return stamp(A.reduce_with_window(t.events, HOUR, ["event_type"], aggs, "ts"))


@query("a6_salted_count", "SELECT l_returnflag, count(*) AS cnt FROM lineitem GROUP BY ALL")
def _(t):
    return A.salted_count(t.lineitem, "l_returnflag", "l_orderkey")


REGION_SQL = """WITH d AS (SELECT substr(n_name, 1, 8) AS region_name, max(n_nationkey) AS region_id FROM nation GROUP BY 1),
c AS (SELECT substr(n_name, 1, 8) AS re, count(*) AS cnt FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1)
SELECT re, cnt, region_id FROM c JOIN d ON region_name = re"""


def regions(t):
    """Customers with a region text, and regions named by its prefix ("NATION_1" covers 1 and 10 to 19)."""
    named = map_join(t.customer.withColumnRenamed("c_nationkey", "n_nationkey"), t.nation, "n_nationkey")
    dim = t.nation.groupBy(F.substring("n_name", 1, 8).alias("region_name")).agg(F.max("n_nationkey").alias("region_id"))
    return named, dim


@query("a7_prefix_count_join", REGION_SQL)
def _(t):
    rows, dim = regions(t)
    return A.prefix_count_join(rows, dim, "n_name", "region_name", "region_id", 8)


@query("q29_regional_count", REGION_SQL)
def _(t):
    rows, dim = regions(t)
    return regional_count(rows, dim, "n_name", "c_custkey", length=8)
