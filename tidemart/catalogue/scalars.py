"""Scalar and table functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from tidemart.catalogue.registry import query
from tidemart.functions import keywords as K, scalar as S

ORDER_MS = "epoch_ms(o_orderdate) + o_orderkey"


def orders_ms(t):
    return t.orders.select("o_orderkey", (S.wall_ms("o_orderdate") + F.col("o_orderkey")).cast("bigint").alias("ms"))


def one(name, sql, column, source=orders_ms):
    """One function over every order."""
    @query(name, f"SELECT o_orderkey, {sql} AS v FROM orders")
    def _(t):
        return source(t).select("o_orderkey", column().alias("v"))


def order_text(t):
    return t.orders.withColumn("text", F.date_format("o_orderdate", S.DATETIME)).withColumn(
        "day", F.date_format("o_orderdate", S.DATE))


def plain(t):
    return t.orders


one("f1_ms_to_date", f"strftime(make_timestamp(({ORDER_MS}) * 1000), '%Y-%m-%d')", lambda: S.ms_to_date("ms"))
one("f2_ms_to_datetime", f"strftime(make_timestamp(({ORDER_MS}) * 1000), '%Y-%m-%d %H:%M:%S')", lambda: S.ms_to_datetime("ms"))
one("f3_ms_to_compact_date", f"strftime(make_timestamp(({ORDER_MS}) * 1000), '%Y%m%d')", lambda: S.ms_to_compact_date("ms"))
one("f4_datetime_to_ms", "epoch_ms(o_orderdate) - 28800000", lambda: S.datetime_to_ms("text").cast("bigint"), order_text)
one("f5_date_to_ms", "epoch_ms(o_orderdate) - 28800000", lambda: S.date_to_ms("day").cast("bigint"), order_text)
one("f6_epoch_to_timestamp", f"strftime(make_timestamp(({ORDER_MS}) * 1000), '%Y-%m-%d %H:%M:%S') || ' '"
    f" || strftime(make_timestamp((({ORDER_MS}) // 1000) * 1000000), '%H:%M:%S')",
    lambda: F.concat_ws(
        " ", F.date_format(S.epoch_to_timestamp("ms", "ms"), S.DATETIME),
        F.date_format(S.epoch_to_timestamp(F.floor(F.col("ms") / 1000).cast("bigint"), "s"), "HH:mm:ss")))
one("f7_text_to_date", "strftime(o_orderdate, '%Y-%m-%d')", lambda: S.text_to_date("text"), order_text)
def _within_the_run() -> Column:
    """Whether the time lies between now, as the query is made, and a day later."""
    made = F.lit(dt.datetime.now(dt.timezone.utc))
    return S.processing_time().between(made, made + F.expr("INTERVAL '1' DAY")).cast("int")


one("f8_processing_time", "1", _within_the_run, plain)
one("f9_casts", "CAST(CAST(o_orderkey AS VARCHAR) AS BIGINT) + coalesce(TRY_CAST(o_orderstatus AS BIGINT), 1)",
    lambda: S.to_bigint(F.col("o_orderkey").cast("string")) + F.coalesce(S.try_bigint("o_orderstatus"), F.lit(1)), plain)
one("f10_choose", "CASE WHEN o_totalprice > 100000 THEN 'big' ELSE 'small' END",
    lambda: S.choose(F.col("o_totalprice") > 100000, F.lit("big"), F.lit("small")), plain)
one("f11_subscripts", "o_orderstatus || '/' || o_orderpriority || '/' || o_orderkey",
    lambda: F.concat_ws(
        "/", F.create_map(F.lit("s"), "o_orderstatus")["s"], F.struct("o_orderpriority")["o_orderpriority"],
        F.get_json_object(F.to_json(F.struct(F.struct("o_orderkey").alias("a"))), "$.a.o_orderkey")), plain)
one("f12_predicates", "CASE WHEN o_orderstatus IN ('F', 'P') AND o_custkey IS NOT NULL AND o_totalprice BETWEEN 1000 AND 200000 THEN 1 ELSE 0 END",
    lambda: (F.col("o_orderstatus").isin("F", "P") & F.col("o_custkey").isNotNull()
             & F.col("o_totalprice").between(1000, 200000)).cast("int"), plain)
one("f13_intervals", "strftime(o_orderdate - INTERVAL 15 SECOND, '%Y-%m-%d %H:%M:%S')",
    lambda: F.date_format(F.col("o_orderdate") - F.expr("INTERVAL '15' SECOND"), S.DATETIME), plain)
one("f14_decimals", "CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 3 - coalesce(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END, 0) AS DOUBLE)",
    lambda: S.money("o_totalprice") * 3 - S.or_zero(F.when(F.col("o_orderstatus") == "F", S.money("o_totalprice"))), plain)
one("f16_in_csv", "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END",
    lambda: S.in_csv(F.lit("1-URGENT,2-HIGH,3"), F.col("o_orderpriority")).cast("int"), plain)
one("f17_json", """'{"status":"' || o_orderstatus || '","key":' || o_orderkey || '}'""",
    lambda: F.to_json(F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("key"))), plain)
one("f18_whole_days", "CAST(date_diff('day', TIMESTAMP '1995-01-01', o_orderdate) AS BIGINT)",
    lambda: S.whole_days_since("ms0", F.lit("1995-01-01")),
    lambda t: t.orders.select("o_orderkey", S.wall_ms("o_orderdate").alias("ms0")))
one("f20_prefix", "substr(o_orderpriority, 1, 2)", lambda: S.prefix("o_orderpriority", 2), plain)
one("f21_case_when", "CASE WHEN o_orderstatus = 'F' THEN NULL WHEN o_custkey = 0 THEN 0 ELSE o_totalprice / o_custkey END",
    lambda: F.when(F.col("o_orderstatus") == "F", None).when(F.col("o_custkey") == 0, 0).otherwise(
        F.try_divide("o_totalprice", "o_custkey")), plain)


@query("f15_composite_key", "SELECT o_orderstatus, o_orderpriority, o_custkey % 3 AS k, count(*) AS n FROM orders GROUP BY ALL")
def _(t):
    """Grouping by the columns themselves instead of a joined text."""
    return t.orders.groupBy("o_orderstatus", "o_orderpriority", (F.col("o_custkey") % 3).alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query("f19_set_size", "SELECT o_orderpriority, count(DISTINCT o_orderstatus) AS n FROM orders GROUP BY ALL")
def _(t):
    return t.orders.groupBy("o_orderpriority").agg(S.set_size("o_orderstatus").alias("n"))


@query("f22_names", 'SELECT s_suppkey AS "sSuppkey", s_nationkey AS "s_nationkey" FROM supplier')
def _(t):
    there = S.camel_columns(t.supplier.select("s_suppkey", "s_nationkey"))
    back = S.snake_columns(there.select("sNationkey"))
    return there.select("sSuppkey", there["sNationkey"].alias(back.columns[0]))


@query("u1_kw_split", r"""SELECT p_partkey, unnest(list_distinct(regexp_extract_all(lower(p_name || ' ' || p_name), '[\p{L}\p{N}]+'))) AS keyword FROM part""")
def _(t):
    named = t.part.select("p_partkey", F.concat_ws(" ", "p_name", "p_name").alias("text"))
    return K.split_keywords(named, "text").select("p_partkey", "keyword")


#: Longest first, as the alternatives of the SQL pattern are tried in order.
DICTIONARY = ("éaieur", "éaux", "éeux", "élle", "ñque", "éai", "ñas", "ños", "ñdo", "öen", "üen", "äen", "éé", "öö")


@query("u1_kw_split_dictionary", rf"""SELECT doc_id, unnest(list_distinct(regexp_extract_all(
    lower(text), '{"|".join(DICTIONARY)}|[a-z0-9]+|[\p{{L}}\p{{N}}]'))) AS keyword FROM documents""")
def _(t):
    """The dictionary splitter on whole texts: known words, runs of ASCII, other letters alone."""
    splitter = K.dictionary_words(DICTIONARY)
    return K.split_keywords(t.documents, "text", splitter=splitter).select("doc_id", "keyword")
