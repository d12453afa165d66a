"""Joins between facts, changes and dimensions.

Lookups carry no broadcast hint: Catalyst broadcasts a dimension while its size stays
below `spark.sql.autoBroadcastJoinThreshold` (adaptive execution checks the real size at
run time) and falls back to a shuffle join, whose skewed partitions it splits.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def _within(left: Column, right: Column, seconds: int) -> Column:
    bound = F.expr(f"INTERVAL '{seconds}' SECOND")
    return (right >= left - bound) & (right <= left + bound)


def join_changes(
    left: DataFrame, right: DataFrame, left_key: str | Sequence[str], right_key: str | Sequence[str],
    how: str = "inner", within: int | None = None, ts: str = "row_time",
) -> DataFrame:
    """Equi-join of two change selections; the right keys and time are not kept.

    `within` bounds the distance of their event times in seconds.  Streams need it, so
    that state can be dropped; batch joins are unbounded by default.
    """
    left_keys, right_keys = ([k] if isinstance(k, str) else list(k) for k in (left_key, right_key))
    l, r = left.alias("l"), right.alias("r")
    on = F.lit(True)
    for a, b in zip(left_keys, right_keys, strict=True):
        on = on & (F.col(f"l.{a}") == F.col(f"r.{b}"))
    if within is not None:
        on = on & _within(F.col(f"l.{ts}"), F.col(f"r.{ts}"), within)
    known = {*left.columns, *right_keys, ts}
    return l.join(r, on, how).select("l.*", *(f"r.{c}" for c in right.columns if c not in known))


def order_wide(
    detail: DataFrame, orders: DataFrame, activity: DataFrame | None = None,
    coupon: DataFrame | None = None, within: int | None = None,
) -> DataFrame:
    """Order detail with its order, and with activity and coupon where there are any.

    In batch a detail is shuffled once, by order, and the result is dealt by order, so that what joins it by order next, such
    as cancellations, need not shuffle it again: activities and coupons, which name the detail only, first get
    its order and then go along with the details.  That reads `detail` twice.  On streams each table is joined in turn.
    """
    if within is None:
        return _order_wide(detail, orders, activity, coupon)
    wide = join_changes(detail, orders, "order_id", "id", "inner", within)
    if activity is not None:
        wide = join_changes(wide, activity, "id", "id", "left", within)
    if coupon is not None:
        wide = join_changes(wide, coupon, "id", "id", "left", within)
    return wide


def _order_wide(detail: DataFrame, orders: DataFrame, activity: DataFrame | None, coupon: DataFrame | None) -> DataFrame:
    seen, parts, kept = {*detail.columns, "row_time"}, {}, {}
    for name, part in (("_activity", activity), ("_coupon", coupon)):
        if part is not None:
            kept[name] = [c for c in part.columns if c not in seen]
            seen |= {*kept[name]}
            parts[name] = part.where(F.col("id").isNotNull()).select(
                F.col("id").alias("_detail"), F.struct(*(kept[name] or [F.lit(True).alias("_found")])).alias(name))
    if not parts:
        return join_changes(detail, orders, "order_id", "id", "inner")
    found = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts.values())
    found = found.groupBy("_detail").agg(*(F.collect_list(name).alias(name) for name in parts))
    # what an order's detail has, once however often the detail was sent
    named = detail.select(F.col("id").alias("_detail"), F.col("order_id").alias("_order")).where("_detail IS NOT NULL AND _order IS NOT NULL")
    known = named.join(found, "_detail").groupBy("_detail", "_order").agg(*(F.first(name).alias(name) for name in parts))
    filled = (F.when(F.size(name) > 0, F.col(name)).alias(name) for name in parts)
    along = known.select(F.col("_detail").alias("id"), F.col("_order").alias("order_id"), *filled)
    rows = detail.withColumn("_sent", F.lit(True)).unionByName(along, allowMissingColumns=True)
    rest = [c for c in orders.columns if c not in {*seen, "id"}]
    wide = join_changes(rows, orders.select("id", *rest), "order_id", "id", "inner")
    # the rows of an order lie together by now, so those of its details do
    of_detail = Window.partitionBy("order_id", "id")
    sent = wide.withColumns({name: F.first(name, ignorenulls=True).over(of_detail) for name in parts}).where(F.col("_sent"))
    for name in parts:
        sent = sent.withColumn(name, F.explode_outer(name))
    return sent.select(*detail.columns, *(F.col(name)[c].alias(c) for name in parts for c in kept[name]), *rest)


def cancel_join(detail: DataFrame, cancelled: DataFrame, within: int | None = None) -> DataFrame:
    """Details of cancelled orders; `operate_time` and `ts` are the cancellation's."""
    return join_changes(detail.drop("ts"), cancelled, "order_id", "id", "inner", within)


def composite_key_join(
    payments: DataFrame, refunds: DataFrame, orders: DataFrame, within: int | None = None
) -> DataFrame:
    """Refund payments with their refund (order and product) and their order."""
    both = ("order_id", "sku_id")
    paid = join_changes(payments, refunds, both, both, "inner", within)
    return join_changes(paid, orders, "order_id", "id", "inner", within)


def interval_join(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
    lower: int = -15, upper: int | None = 5, dealt: bool = False,
) -> DataFrame:
    """Rows with equal keys and `left_ts + lower <= right_ts <= left_ts + upper` (seconds).

    Both sides are also matched on a time slot as wide as the range, so a hot key is
    spread over its slots and only neighbours in time meet.  `upper=None` leaves the
    upper end open; no slot can bound that form, which is a plain equi-join with a filter.
    Columns of the right side that the left side has too are dropped.

    `dealt` is for left rows that come from a join by the same key, in batch: they stay where that has dealt them, and
    only the right rows are shuffled to them, as a join by key and slot cannot.  Rows that do not lie so are shuffled as well.
    """
    from_ = F.expr(f"INTERVAL '{lower}' SECOND")
    within = F.col(f"r.{right_ts}") >= F.col(f"l.{left_ts}") + from_
    extra = [c for c in right.columns if c not in left.columns]
    if upper is None:
        on = within & (F.col(f"l.{key}") == F.col(f"r.{key}"))
        return left.alias("l").join(right.alias("r"), on).select(*(f"l.{c}" for c in left.columns), *(f"r.{c}" for c in extra))
    within = within & (F.col(f"r.{right_ts}") <= F.col(f"l.{left_ts}") + F.expr(f"INTERVAL '{upper}' SECOND"))
    width = max(upper - lower, 1) * 1_000_000
    slot = lambda micros: F.floor(micros / F.lit(width))
    at = lambda ts: F.unix_micros(F.col(ts).cast("timestamp"))
    slots = F.explode(F.sequence(slot(at(right_ts) - F.lit(upper * 1_000_000)), slot(at(right_ts) - F.lit(lower * 1_000_000))))
    l = left.withColumn("_slot", slot(at(left_ts)))
    if dealt:
        # both go along as one, so that the rows of a key, which lie together, meet by slot without being dealt again
        known = right.where(F.col(key).isNotNull()).repartition(key).withColumn("_slot", slots)
        along = known.select(key, "_slot", F.struct(*right.columns).alias("_r"))
        rows = l.where(F.col(key).isNotNull()).withColumns({"_r": F.lit(None), "_l": F.lit(True)})
        both = rows.unionByName(along, allowMissingColumns=True).withColumn(
            "_near", F.collect_list("_r").over(Window.partitionBy(key, "_slot")))
        met = both.where(F.col("_l")).withColumn("r", F.explode("_near"))
        return met.select(F.struct(*left.columns).alias("l"), "r").where(within).select("l.*", *(f"r.{c}" for c in extra))
    on = (F.col("l._slot") == F.col("r._slot")) & (F.col(f"l.{key}") == F.col(f"r.{key}")) & within
    r = right.withColumn("_slot", slots)
    return l.alias("l").join(r.alias("r"), on).select(*(f"l.{c}" for c in left.columns), *(f"r.{c}" for c in extra))


def _lookup(
    df: DataFrame, dim: DataFrame, key: str, fields: Mapping[str, str], dim_key: str, how: str
) -> DataFrame:
    picked = dim.select(
        F.col(dim_key).alias("_dim_key"), *(F.col(path).alias(out) for out, path in fields.items())
    )
    return df.join(picked, df[key] == picked["_dim_key"], how).drop("_dim_key")


def lookup_join(
    df: DataFrame, dim: DataFrame, key: str, fields: Mapping[str, str], dim_key: str = "rowkey"
) -> DataFrame:
    """Dimension fields by key; rows without a match are dropped."""
    return _lookup(df, dim, key, fields, dim_key, "inner")


def lookup_join_twice(
    df: DataFrame, dim: DataFrame, first: str, second: str, outs: Sequence[str],
    field: str = "info.dic_name", dim_key: str = "rowkey",
) -> DataFrame:
    """One dictionary in two roles."""
    once = lookup_join(df, dim, first, {outs[0]: field}, dim_key)
    return lookup_join(once, dim, second, {outs[1]: field}, dim_key)


def enrich(
    df: DataFrame, dim: DataFrame, key: str, fields: Mapping[str, str], dim_key: str = "id"
) -> DataFrame:
    """Dimension fields by key; a miss leaves nulls."""
    return _lookup(df, dim, key, fields, dim_key, "left")


def product_dimension(dims: Mapping[str, DataFrame]) -> DataFrame:
    """Product rows with spu, trademark and the category chain, joined once.

    Joining the dimensions with each other first leaves a single join for the facts.
    """
    rows = dims["dim_sku_info"].select(
        F.col("id").alias("sku_id"), "spu_id", "category3_id", F.col("tm_id").alias("trademark_id")
    )
    rows = enrich(rows, dims["dim_spu_info"], "spu_id", {"spu_name": "spu_name"})
    rows = enrich(rows, dims["dim_base_trademark"], "trademark_id", {"trademark_name": "tm_name"})
    rows = enrich(rows, dims["dim_base_category3"], "category3_id",
                  {"category3_name": "name", "category2_id": "category2_id"})
    rows = enrich(rows, dims["dim_base_category2"], "category2_id",
                  {"category2_name": "name", "category1_id": "category1_id"})
    return enrich(rows, dims["dim_base_category1"], "category1_id", {"category1_name": "name"})


PRODUCT_FIELDS = (
    "spu_id", "spu_name", "trademark_id", "trademark_name", "category3_id", "category3_name",
    "category2_id", "category2_name", "category1_id", "category1_name",
)


def enrich_product_chain(
    df: DataFrame, dims: Mapping[str, DataFrame], fields: Sequence[str] = PRODUCT_FIELDS
) -> DataFrame:
    """Product fields by `sku_id`; a miss anywhere in the chain leaves nulls."""
    product = product_dimension(dims)
    return enrich(df, product, "sku_id", {f: f for f in fields}, "sku_id")


def lateral_keywords(df: DataFrame, splitter, text: str, out: str = "keyword") -> DataFrame:
    """Cross-apply a table function given as an array column; rows without output vanish."""
    return df.withColumn(out, F.explode(splitter(F.col(text))))


MAX_BROADCAST_BYTES = 10 << 20


def planned_bytes(df: DataFrame) -> int:
    """What the planner knows of a table's size without running anything; huge if it knows nothing."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def checked_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast for a static table of at most `max_bytes` by the planner's statistics.

    No job runs to find out.  A table of unknown size, such as one over JDBC, gets no hint; the
    planner then measures it while the join runs, and broadcasts it or splits skewed keys.
    """
    return F.broadcast(df) if not df.isStreaming and planned_bytes(df) <= max_bytes else df


def map_join(
    big: DataFrame, small: DataFrame, on, how: str = "inner", max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """Hold the small side in memory, but only when it is known to have at most `max_bytes`."""
    return big.join(checked_broadcast(small, max_bytes), on, how)
