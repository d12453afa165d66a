"""Windowed summaries.

Each function serves batch and stream: keyed state is replaced by aggregates in batch.  On
streams the input must carry a watermark on `row_time`.  `cur_date` goes to `stamp_window`.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from tidemart.functions.keywords import split_keywords, words
from tidemart.functions.scalar import COMPACT_DATE, datetime_to_ms, money, or_zero
from tidemart.operators import aggregates as A, changes as C, flags, joins as J
from tidemart.streaming import state

SIZE = "5 seconds"
#: Visits, pages and carts are remembered for a day on streams.
DAY_SECONDS = 24 * 3600
DIMS = ("vc", "ch", "ar", "is_new")


def _flat_pages(pages: DataFrame, *columns: str) -> DataFrame:
    paths = {
        **{c: f"common.{c}" for c in ("mid", "sid", "uid", *DIMS)},
        **{c: f"page.{c}" for c in ("page_id", "last_page_id", "during_time")},
    }
    return pages.select("row_time", *(F.col(paths[c]).alias(c) for c in columns))


def _active(df: DataFrame, keys: list[str], retain: int | None = None) -> DataFrame:
    """First row per key and day with `is_active` and `is_first_day`."""
    if df.isStreaming:
        return state.active_days(df, keys, ttl_seconds=retain)
    return flags.new_and_active(df, keys, "row_time")


def keyword_window(page_log: DataFrame, size: str = SIZE, cur_date: str = "processing", splitter=words) -> DataFrame:
    """Keyword counts of searches; `page_log` holds a `page` map and `row_time`."""
    page = F.col("page")
    searched = page_log.where(
        page["last_page_id"].isin("search", "home")
        & (page["item_type"] == "keyword") & page["item"].isNotNull()
    ).select(page["item"].alias("kw"), "row_time")
    counts = A.keyword_count(split_keywords(searched, "kw", splitter=splitter), size)
    names = ("window_start", "window_end", "cur_date")
    return A.stamp_window(counts, names, COMPACT_DATE, cur_date)


def traffic_window(
    pages: DataFrame, size: str = SIZE, cur_date: str = "processing", retain: int | None = DAY_SECONDS,
    buckets: int = state.BUCKETS,
) -> DataFrame:
    """Visitors, sessions, views and duration per version, channel, area and new flag.

    In batch, views, first-of-day rows and first-of-session rows are counted side by side and meet in
    one windowed sum, so no row is shuffled by visitor or session before it is reduced.  On a stream one
    operator makes all three from one reading; state expires `retain` seconds after a visitor's last
    day began or a session's last row, in `buckets` groups (see `state.traffic`).  A null session is none.
    """
    rows = _flat_pages(pages, "mid", "sid", *DIMS, "during_time").where(F.col("mid") != "")
    if rows.isStreaming:
        parts = state.traffic(rows, "mid", "sid", DIMS, "during_time", size, ttl_seconds=retain, buckets=buckets)
    else:
        parts = _traffic_parts(rows)
    sums = A.window_sum_by_key(parts, size, DIMS, {m: m for m in state.TRAFFIC})
    return A.stamp_window(sums, cur_date=cur_date)


def _traffic_parts(rows: DataFrame) -> DataFrame:
    visits = flags.active_days(rows, ["mid"], "row_time", keep=DIMS)
    sessions = A.first_per_key(rows.where(F.col("sid").isNotNull()), ["sid"], ["row_time"], DIMS)

    def measured(df: DataFrame, **values) -> DataFrame:
        return df.select("row_time", *DIMS, *(
            values.get(m, F.lit(0)).cast("bigint").alias(m) for m in state.TRAFFIC
        ))

    one = F.lit(1)
    return (
        measured(rows, pv_ct=one, dur_sum=or_zero("during_time"))
        .unionByName(measured(visits, uv_ct=one))
        .unionByName(measured(sessions, sv_ct=one))
    )


def page_visitor_window(
    pages: DataFrame, size: str = SIZE, cur_date: str = "processing", retain: int | None = DAY_SECONDS,
) -> DataFrame:
    """First home and first product page view per device and day; stream state lasts `retain` seconds."""
    rows = _flat_pages(pages, "mid", "page_id").where(
        (F.col("mid") != "") & F.col("page_id").isin("home", "good_detail")
    )
    if rows.isStreaming:
        firsts = state.active_days(rows, ["mid", "page_id"], ttl_seconds=retain)
    else:
        firsts = flags.page_first_of_day(rows, "mid", "page_id", "row_time")
    is_page = lambda p: (F.col("page_id") == p).cast("bigint")
    sums = A.window_sum_global(firsts, size, {
        "home_uv_ct": is_page("home"), "good_detail_uv_ct": is_page("good_detail"),
    })
    return A.stamp_window(sums, cur_date=cur_date)


def login_window(pages: DataFrame, size: str = SIZE, days: int = 7, cur_date: str = "processing") -> DataFrame:
    """Users active, and users back after more than `days` days."""
    last = F.col("last_page_id")
    rows = _flat_pages(pages, "uid", "last_page_id").where(
        F.col("uid").isNotNull() & (last.isNull() | (last == "login"))
    )
    if rows.isStreaming:
        users = state.active_days(rows, ["uid"], away_days=days)
    else:
        users = flags.returning_user(rows, ["uid"], "row_time", days)
    sums = A.window_sum_global(users, size, {"back_ct": "back", "uu_ct": "is_active"})
    return A.stamp_window(sums, cur_date=cur_date)


def with_create_time(df: DataFrame, column: str = "create_time") -> DataFrame:
    """Event time from a text timestamp at the warehouse's fixed offset."""
    return df.withColumn("row_time", F.timestamp_millis(datetime_to_ms(column)))


def register_window(registrations: DataFrame, size: str = SIZE, cur_date: str = "processing") -> DataFrame:
    sums = A.window_sum_global(registrations, size, {"register_ct": F.lit(1).cast("bigint")})
    return A.stamp_window(sums, cur_date=cur_date)


def cart_user_window(
    carts: DataFrame, size: str = SIZE, cur_date: str = "processing", retain: int | None = DAY_SECONDS,
) -> DataFrame:
    users = _active(carts.where(F.col("user_id") != ""), ["user_id"], retain)
    sums = A.window_sum_global(users, size, {"cart_add_uu_ct": "is_active"})
    return A.stamp_window(sums, cur_date=cur_date)


def order_user_window(details: DataFrame, size: str = SIZE, cur_date: str = "processing") -> DataFrame:
    users = _active(details.where(F.col("user_id") != ""), ["user_id"])
    sums = A.window_sum_global(users, size, {
        "order_unique_user_count": "is_active", "order_new_user_count": "is_first_day",
    })
    return A.stamp_window(sums, cur_date=cur_date)


def payment_user_window(payments: DataFrame, size: str = SIZE, cur_date: str = "processing") -> DataFrame:
    users = _active(payments.where(F.col("user_id") != ""), ["user_id"])
    sums = A.window_sum_global(users, size, {
        "payment_suc_unique_user_count": "is_active", "payment_suc_new_user_count": "is_first_day",
    })
    return A.stamp_window(sums, cur_date=cur_date)


def _deltas(df: DataFrame, measures: Mapping[str, str], tie, ttl_seconds) -> DataFrame:
    by = state.delta_by_key if df.isStreaming else flags.delta_by_key
    return by(df, ["id"], measures, ts="row_time", tie=tie, ttl_seconds=ttl_seconds)


def sku_order_sums(
    details: DataFrame, size: str = SIZE, tie=(), ttl_seconds: int | None = None, cur_date: str = "processing",
) -> DataFrame:
    """Amounts per product, re-sent details counted once; `enrich_product_chain` names them."""
    rows = details.where(F.col("sku_id") != "").select(
        "id", "sku_id", "sku_name", "row_time", *tie,
        (money("order_price") * money("sku_num", 10, 0)).cast("decimal(28,2)").alias("original"),
        or_zero(money("split_activity_amount")).alias("activity"),
        or_zero(money("split_coupon_amount")).alias("coupon"),
        money("split_total_amount").alias("total"),
    )
    outs = {
        "original_amount": "original", "activity_reduce_amount": "activity",
        "coupon_reduce_amount": "coupon", "order_amount": "total",
    }
    deltas = _deltas(rows, outs, tie, ttl_seconds)
    sums = deltas.groupBy(A.tumble(size), "sku_id").agg(
        F.min("sku_name").alias("sku_name"),
        *(F.sum(o).cast("decimal(38,2)").alias(o) for o in outs),
    )
    return A.stamp_window(sums, cur_date=cur_date)


def sku_order_window(
    details: DataFrame, dims: Mapping[str, DataFrame], size: str = SIZE, tie=(),
    ttl_seconds: int | None = None, cur_date: str = "processing",
) -> DataFrame:
    """Amounts per product, re-sent details counted once, with the product's dimensions."""
    return J.enrich_product_chain(sku_order_sums(details, size, tie, ttl_seconds, cur_date), dims)


def province_order_sums(
    details: DataFrame, size: str = SIZE, tie=(), ttl_seconds: int | None = None, cur_date: str = "processing",
) -> DataFrame:
    """Distinct orders and amount per province, re-sent details counted once."""
    rows = details.where(F.col("province_id") != "").select(
        "id", "order_id", "province_id", "row_time", *tie, money("split_total_amount").alias("total"),
    )
    deltas = _deltas(rows, {"order_amount": "total"}, tie, ttl_seconds)
    sums = A.window_distinct(
        deltas, size, ["province_id"], "order_id", "order_count", {"order_amount": "order_amount"}
    )
    return A.stamp_window(sums, cur_date=cur_date)


def name_provinces(sums: DataFrame, provinces: DataFrame) -> DataFrame:
    return J.enrich(sums, provinces, "province_id", {"province_name": "name"})


def province_order_window(
    details: DataFrame, provinces: DataFrame, size: str = SIZE, tie=(),
    ttl_seconds: int | None = None, cur_date: str = "processing",
) -> DataFrame:
    """Distinct orders and amount per province, re-sent details counted once."""
    return name_provinces(province_order_sums(details, size, tie, ttl_seconds, cur_date), provinces)


REFUND_KEYS = ["trademark_id", "category3_id", "user_id"]


def refund_window(
    refunds: DataFrame, dims: Mapping[str, DataFrame], size: str = SIZE, cur_date: str = "processing",
) -> DataFrame:
    """Distinct refunded orders per trademark, category and user.

    Only the two grouping ids are looked up before the aggregation, the names after it.
    """
    ids = {"trademark_id": "tm_id", "category3_id": "category3_id"}
    rows = J.enrich(refunds.select("user_id", "sku_id", "order_id", "row_time"),
                    dims["dim_sku_info"], "sku_id", ids)
    sums = A.window_distinct(rows, size, REFUND_KEYS, "order_id", "refund_count")
    return _name_refund_counts(A.stamp_window(sums, cur_date=cur_date), dims)


def refund_orders(refunds: DataFrame, size: str = SIZE) -> DataFrame:
    """Each refunded order once per window, product and user, for `count_refunds`."""
    return refunds.groupBy(A.tumble(size), "sku_id", "user_id", "order_id").agg(F.count(F.lit(1)).alias("refunds"))


def count_refunds(orders: DataFrame, dims: Mapping[str, DataFrame], cur_date: str = "processing") -> DataFrame:
    """`refund_window` from `refund_orders` of whole windows, as a stream emits them."""
    ids = {"trademark_id": "tm_id", "category3_id": "category3_id"}
    rows = J.enrich(orders, dims["dim_sku_info"], "sku_id", ids)
    sums = rows.select("window", *REFUND_KEYS, "order_id").distinct().groupBy("window", *REFUND_KEYS).agg(
        F.count("order_id").alias("refund_count"))
    return _name_refund_counts(A.stamp_window(sums, cur_date=cur_date), dims)


def _name_refund_counts(sums: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    named = J.enrich(sums, dims["dim_base_trademark"], "trademark_id", {"trademark_name": "tm_name"})
    category = J.enrich(
        J.enrich(
            dims["dim_base_category3"].select("id", F.col("name").alias("category3_name"), "category2_id"),
            dims["dim_base_category2"], "category2_id",
            {"category2_name": "name", "category1_id": "category1_id"},
        ),
        dims["dim_base_category1"], "category1_id", {"category1_name": "name"},
    )
    fields = ("category3_name", "category2_id", "category2_name", "category1_id", "category1_name")
    return J.enrich(named, category, "category3_id", {f: f for f in fields})


def shop_sums(
    details: DataFrame, key: str, size: str = "10 seconds", cur_date: str = "processing",
) -> DataFrame:
    """Amount per shop; `key` is the number shops are assigned by."""
    rows = C.assign_shop(details, key).select(
        "shop_id", "row_time", money("split_total_amount").alias("total")
    )
    sums = A.window_sum_by_key(rows, size, ["shop_id"], {"amount": "total"})
    return A.stamp_window(sums, cur_date=cur_date)


def name_shops(sums: DataFrame, shops: DataFrame) -> DataFrame:
    return J.enrich(sums, shops, "shop_id", {"shop_name": "name"})


def shop_window(
    details: DataFrame, shops: DataFrame, key: str, size: str = "10 seconds",
    cur_date: str = "processing",
) -> DataFrame:
    """`shop_sums` with the shops' names."""
    return name_shops(shop_sums(details, key, size, cur_date), shops)
