"""Fact jobs over the change log.

`changes` is a change log as `change_stream` or a table gives it; `row_time` is needed only
for the streaming forms (`within`) and the payment job.

Jobs that look names up come in two steps as well, rows first and names after, so that a stream can run the
second on each micro-batch with the dimensions of its moment (`streaming.live`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemart.functions.scalar import epoch_to_timestamp, text_to_date
from tidemart.operators import changes as C, joins as J
from tidemart import schemas as S

DETAIL_KEYS = (
    "id", "order_id", "sku_id", "sku_name", "order_price", "sku_num", "create_time",
    "split_total_amount", "split_activity_amount", "split_coupon_amount",
)


def _timed(within: int | None) -> list[str]:
    return ["row_time"] if within is not None else []


def comment_rows(changes: DataFrame, database: str) -> DataFrame:
    rows = C.select_table(changes, database, "comment_info")
    return C.extract_map(rows, [c for c in S.COMMENT_COLUMNS if c != "dic_name"])


def name_comments(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    return J.lookup_join(rows, dictionary, "appraise", {"dic_name": "info.dic_name"}).select(*S.COMMENT_COLUMNS)


def comments(changes: DataFrame, dictionary: DataFrame, database: str) -> DataFrame:
    return name_comments(comment_rows(changes, database), dictionary)


def cart_adds(changes: DataFrame, database: str) -> DataFrame:
    return C.cart_add(changes, database)


def order_detail(changes: DataFrame, database: str, within: int | None = None) -> DataFrame:
    """Order details with user, province, activity and coupon; keyed by `id`.

    Streams pass `within` (seconds) to bound the joins, and get the detail's `row_time`.
    """
    timed = _timed(within)
    picked = lambda table, keys, keep=(): C.extract_map(
        C.select_table(changes, database, table), keys, keep=[*keep, *timed]
    )
    wide = J.order_wide(
        picked("order_detail", DETAIL_KEYS, ["ts"]),
        picked("order_info", ("id", "user_id", "province_id")),
        picked("order_detail_activity", {
            "id": "order_detail_id", "activity_id": "activity_id",
            "activity_rule_id": "activity_rule_id",
        }),
        picked("order_detail_coupon", {"id": "order_detail_id", "coupon_id": "coupon_id"}),
        within,
    )
    return wide.select(*S.ORDER_DETAIL.fieldNames(), *timed)


def order_cancel(
    detail: DataFrame, changes: DataFrame, database: str, within: int | None = None
) -> DataFrame:
    rows = changes.where((F.col("database") == database) & (F.col("table") == "order_info"))
    cancelled = C.extract_map(
        C.status_transition(rows, "order_status", "1003", "1001", S.INSERT_TYPES),
        ("id", "operate_time"), keep=["ts", *_timed(within)],
    )
    return J.cancel_join(detail, cancelled, within).select(*S.ORDER_CANCEL_COLUMNS, *_timed(within))


def paid_details(
    detail: DataFrame, changes: DataFrame, database: str, lower: int = -15, upper: int | None = 5,
) -> DataFrame:
    """Paid order details: payment time within `lower`..`upper` seconds of the order's."""
    rows = changes.where((F.col("database") == database) & (F.col("table") == "payment_info"))
    if "row_time" not in rows.columns:
        rows = rows.withColumn("row_time", epoch_to_timestamp("ts"))
    paid = C.extract_map(
        C.status_transition(rows, "payment_status", "1602"),
        {"order_id": "order_id", "user_id": "user_id", "payment_type_code": "payment_type",
         "payment_time": "callback_time"},
        keep=["ts", F.col("row_time").alias("pay_row_time")],
    )
    if "row_time" not in detail.columns:
        detail = detail.withColumn("row_time", epoch_to_timestamp("ts"))
    return J.interval_join(
        detail.drop("ts", "user_id", "create_time"), paid, "order_id", "row_time", "pay_row_time",
        lower, upper, dealt=not (detail.isStreaming or paid.isStreaming),
    )


def name_payments(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    named = J.lookup_join(rows, dictionary, "payment_type_code", {"payment_type_name": "info.dic_name"})
    return named.select(*S.PAYMENT_COLUMNS)


def payment_success(
    detail: DataFrame, changes: DataFrame, dictionary: DataFrame, database: str,
    lower: int = -15, upper: int | None = 5,
) -> DataFrame:
    return name_payments(paid_details(detail, changes, database, lower, upper), dictionary)


def refunded_rows(changes: DataFrame, database: str, within: int | None = None) -> DataFrame:
    refunds = C.extract_map(
        C.select_table(changes, database, "order_refund_info"),
        ("id", "user_id", "order_id", "sku_id", "refund_type", "refund_num", "refund_amount",
         "refund_reason_type", "refund_reason_txt", "create_time"),
        keep=["ts", *_timed(within)],
    )
    rows = changes.where((F.col("database") == database) & (F.col("table") == "order_info"))
    orders = C.extract_map(
        C.status_transition(rows, "order_status", "1005"), ("id", "province_id"), keep=_timed(within)
    )
    return J.join_changes(refunds, orders, "order_id", "id", "inner", within)


def name_refunds(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    named = J.lookup_join_twice(
        rows, dictionary, "refund_type", "refund_reason_type", ("type_name", "reason_name")
    )
    listed = named.select(
        "id", "user_id", "order_id", "sku_id", "province_id", text_to_date("create_time"),
        "create_time", "refund_type", "type_name", "refund_reason_type", "reason_name",
        "refund_reason_txt", "refund_num", "refund_amount", "ts",
    )
    return C.positional_insert(listed, S.REFUND_COLUMNS)


def order_refund(
    changes: DataFrame, dictionary: DataFrame, database: str, within: int | None = None
) -> DataFrame:
    return name_refunds(refunded_rows(changes, database, within), dictionary)


def refund_payment_rows(changes: DataFrame, database: str, within: int | None = None) -> DataFrame:
    def entered(table: str, field: str, status: str, keys, keep=()) -> DataFrame:
        rows = changes.where((F.col("database") == database) & (F.col("table") == table))
        moved = C.status_transition(rows, field, status)
        return C.extract_map(moved, keys, keep=[*keep, *_timed(within)])

    payments = entered(
        "refund_payment", "refund_status", "1602",
        ("id", "order_id", "sku_id", "payment_type", "callback_time", "total_amount"), ["ts"],
    )
    refunds = entered("order_refund_info", "refund_status", "0705", ("order_id", "sku_id", "refund_num"))
    orders = entered("order_info", "order_status", "1006", ("id", "user_id", "province_id"))
    return J.composite_key_join(payments, refunds, orders, within)


def name_refund_payments(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    named = J.lookup_join(rows, dictionary, "payment_type", {"type_name": "info.dic_name"})
    listed = named.select(
        "id", "user_id", "order_id", "sku_id", "province_id", "payment_type", "type_name",
        text_to_date("callback_time"), "callback_time", "refund_num", "total_amount", "ts",
    )
    return C.positional_insert(listed, S.REFUND_PAYMENT_COLUMNS)


def refund_payment(
    changes: DataFrame, dictionary: DataFrame, database: str, within: int | None = None
) -> DataFrame:
    return name_refund_payments(refund_payment_rows(changes, database, within), dictionary)
