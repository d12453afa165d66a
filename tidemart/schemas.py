"""Declared schemas of messages, facts and summaries (fixed field names)."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I = T.StringType(), T.LongType(), T.IntegerType()
TEXT_MAP = T.MapType(S, S)
MONEY = T.DecimalType(18, 2)
TOTAL = T.DecimalType(38, 2)


def struct(*fields: str, **typed: T.DataType) -> T.StructType:
    """String fields by position, other types by keyword."""
    return T.StructType(
        [T.StructField(f, S) for f in fields] + [T.StructField(f, t) for f, t in typed.items()]
    )


# change-log message, seconds
CHANGE = struct("database", "table", "type", ts=L, data=TEXT_MAP, old=TEXT_MAP)

# change-log message with before/after images, milliseconds
DEBEZIUM = struct("op", before=TEXT_MAP, after=TEXT_MAP, source=TEXT_MAP, ts_ms=L)

INSERT_TYPES = ("bootstrap-insert", "insert")
BOOTSTRAP_MARKERS = ("bootstrap-start", "bootstrap-complete")

COMMON = struct("ar", "ba", "ch", "is_new", "md", "mid", "os", "sid", "uid", "vc")
PAGE = struct(
    "page_id", "last_page_id", "item", "item_type",
    during_time=L, refer_id=S, from_pos_id=I, from_pos_seq=I,
)
START = struct("entry", open_ad_id=I, open_ad_ms=L, open_ad_skip_ms=L, loading_time=L)
DISPLAY = T.StructType([
    T.StructField("pos_seq", I), T.StructField("item", S),
    T.StructField("item_type", S), T.StructField("pos_id", I),
])
ACTION = struct("item", "action_id", "item_type", ts=L)
ERR = struct("msg", error_code=I)

# behaviour log, milliseconds
LOG = struct(
    common=COMMON, page=PAGE, start=START,
    displays=T.ArrayType(DISPLAY), actions=T.ArrayType(ACTION), err=ERR, ts=L,
)

# page log re-read with a dynamic page payload
PAGE_LOG = struct(page=TEXT_MAP, ts=L)

ORDER_DETAIL = struct(
    "id", "order_id", "sku_id", "user_id", "province_id", "activity_id",
    "activity_rule_id", "coupon_id", "sku_name", "order_price", "sku_num",
    "create_time", "split_total_amount", "split_activity_amount",
    "split_coupon_amount", ts=L,
)
ORDER_CANCEL_COLUMNS = (
    "id", "order_id", "sku_id", "user_id", "province_id", "activity_id",
    "activity_rule_id", "coupon_id", "sku_name", "order_price", "sku_num",
    "create_time", "operate_time", "split_total_amount", "split_activity_amount",
    "split_coupon_amount", "ts",
)
PAYMENT_COLUMNS = (
    "id", "order_id", "sku_id", "user_id", "province_id", "activity_id",
    "activity_rule_id", "coupon_id", "sku_name", "order_price", "sku_num",
    "split_total_amount", "split_activity_amount", "split_coupon_amount",
    "payment_type_code", "payment_type_name", "payment_time", "ts",
)
REFUND_COLUMNS = (
    "id", "user_id", "order_id", "sku_id", "province_id", "date_id", "create_time",
    "refund_type_code", "refund_type_name", "refund_reason_type_code",
    "refund_reason_type_name", "refund_reason_txt", "refund_num", "refund_amount", "ts",
)
REFUND_PAYMENT_COLUMNS = (
    "id", "user_id", "order_id", "sku_id", "province_id", "payment_type_code",
    "payment_type_name", "date_id", "callback_time", "refund_num", "refund_amount", "ts",
)
CART_COLUMNS = (
    "id", "user_id", "sku_id", "cart_price", "sku_num", "sku_name", "is_checked",
    "create_time", "operate_time", "is_ordered", "order_time", "ts",
)
COMMENT_COLUMNS = (
    "id", "user_id", "nick_name", "sku_id", "spu_id", "order_id", "appraise",
    "dic_name", "comment_txt", "create_time",
)
FLAT_CHANGE_COLUMNS = ("id", "op", "db_name", "log_before", "log_after", "t_name", "ts")

DIM_CONFIG = struct("source_table", "sink_table", "sink_columns", "sink_family", "sink_row_key", "op")
FACT_CONFIG = struct("source_table", "source_type", "sink_table", "sink_columns", "op")
