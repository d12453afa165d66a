"""Fact jobs over one landed text log: each message is parsed once per run."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.catalogue import jobs  # noqa: F401  registers the jobs whose SQL is shared
from tidemart.catalogue.registry import query, sql_of
from tidemart.catalogue.sources_sinks import round_trip
from tidemart.catalogue.stand_ins import DB, ORDER_CHANGES
from tidemart.plans import facts, landing
from tidemart.schemas import CHANGE
from tidemart.session import scratch_dir


def landed(t, name, *changes):
    """A text log of all these changes, landed in two batches, one of them repeated."""
    where = scratch_dir(t.spark, name)
    for i, rows in enumerate(changes):
        values = rows.select(F.to_json(F.struct(*CHANGE.fieldNames())).alias("value"))
        broken = values.limit(1).select(F.lit("no json").alias("value"))
        messages = round_trip(t, values.unionByName(broken), f"{name}-in", position=True)
        landing.land_changes(messages, where, i)
    landing.land_changes(messages, where, len(changes) - 1)
    return where


@query("p3_parse_tagged", f"""WITH {ORDER_CHANGES}
SELECT 'orders' AS kind, count(*) AS n FROM order_changes UNION ALL SELECT 'unreadable', 2""")
def _(t):
    """Readable and unreadable messages of one landing."""
    orders, odd = t.order_changes, F.coalesce(F.length(F.col("data")["id"]) % 2 == 1, F.lit(False))
    where = landed(t, "p3l", orders.where(~odd), orders.where(odd))
    good = landing.landed_changes(t.spark, where).groupBy(F.lit("orders").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    bad = landing.unreadable_messages(t.spark, where).groupBy(F.lit("unreadable").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    return good.unionByName(bad)


@query("q8_order_detail_landed", sql_of("q8_order_detail"))
def _(t):
    return facts.order_detail(landing.landed_changes(t.spark, landed(t, "q8l", t.sales_changes)), DB)


@query("q9_order_cancel_landed", sql_of("q9_order_cancel"))
def _(t):
    detail = landing.landed_changes(t.spark, landed(t, "q9l", t.sales_changes))
    orders = landing.landed_changes(t.spark, landed(t, "q9o", t.order_changes))
    return facts.order_cancel(facts.order_detail(detail, DB), orders, DB)


@query("q10_payment_success_landed", sql_of("q10_payment_success"))
def _(t):
    """The sales and the payments in one log."""
    changes = landing.landed_changes(t.spark, landed(t, "q10l", t.sales_changes, t.payment_changes))
    return facts.payment_success(facts.order_detail(changes, DB), changes, t.dictionary, DB, -15 * 86400, 5 * 86400)


@query("q11_order_refund_landed", sql_of("q11_order_refund"))
def _(t):
    changes = landing.landed_changes(t.spark, landed(t, "q11l", t.refund_changes, t.order_changes))
    return facts.order_refund(changes, t.dictionary, DB)


@query("q12_refund_payment_landed", sql_of("q12_refund_payment"))
def _(t):
    changes = landing.landed_changes(
        t.spark, landed(t, "q12l", t.refund_payment_changes.unionByName(t.refund_changes), t.order_changes))
    return facts.refund_payment(changes, t.dictionary, DB)
