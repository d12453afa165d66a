"""Windowed and keyed aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemart.functions.scalar import DATE, DATETIME, as_column, prefix

Keys = Sequence[str | Column]


def _has_order(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_has_order(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _has_order(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType, T.CalendarIntervalType))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The row with the greatest `order` per key.

    An aggregate, so each task first reduces its own rows and a hot key costs one row per
    task.  `order` should be total: equal rows in it are taken as equal.  Columns of `order` are shuffled once, not beside
    the row they are in; only rows with maps, which have no order, need them twice.
    """
    named = {}  # columns of the order with their first place in it
    for i, o in enumerate(order):
        if isinstance(o, str) and o in df.columns and o not in keys:
            named.setdefault(o, i)
    rest = [c for c in df.columns if c not in keys and c not in named]
    if named and all(_has_order(df.schema[c].dataType) for c in rest):
        by = (as_column(o).alias(o if isinstance(o, str) and named.get(o) == i else f"_by{i}") for i, o in enumerate(order))
        best = df.groupBy(*keys).agg(F.max(F.struct(*by, *rest)).alias("_row"))
    else:
        rest = [c for c in df.columns if c not in keys]
        by = F.struct(*(as_column(o) for o in order))
        best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


def first_per_key(
    df: DataFrame, keys: Keys, order: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Per key the least `order` values and the kept columns of that row."""
    if not keep and len(order) == 1:
        return df.groupBy(*keys).agg(F.min(order[0]).alias(order[0]))
    wanted = list(dict.fromkeys([*order, *keep]))
    best = df.groupBy(*keys).agg(F.min(F.struct(*wanted)).alias("_row"))
    names = [c for c in best.columns if c != "_row"]
    return best.select(*names, *(f"_row.{c}" for c in wanted))


def tumble(size: str, ts: str = "row_time") -> Column:
    """Epoch-aligned tumbling window."""
    return F.window(F.col(ts), size)


def reduce_with_window(
    df: DataFrame, size: str, keys: Keys, aggs: Mapping[str, Column], ts: str = "row_time"
) -> DataFrame:
    """Any aggregates per key and window; the window stays as a column for `stamp_window`."""
    return df.groupBy(tumble(size, ts), *keys).agg(*(a.alias(out) for out, a in aggs.items()))


def window_sum_by_key(
    df: DataFrame, size: str, keys: Keys, sums: Mapping[str, Column | str], ts: str = "row_time"
) -> DataFrame:
    totals = {out: F.sum(as_column(c)) for out, c in sums.items()}
    return reduce_with_window(df, size, keys, totals, ts)


def window_sum_global(
    df: DataFrame, size: str, sums: Mapping[str, Column | str], ts: str = "row_time"
) -> DataFrame:
    """Sums per window over all rows; only per-task partial sums meet."""
    return window_sum_by_key(df, size, [], sums, ts)


def window_distinct(
    df: DataFrame, size: str, keys: Sequence[str], column: str, out: str,
    sums: Mapping[str, Column | str] | None = None, ts: str = "row_time",
) -> DataFrame:
    """Exact distinct values of a column, and sums, per key and window.

    Counted in two levels: rows are first reduced to one per distinct value, so neither a
    batch task nor a stream's state ever holds the set of a group.  (Streams refuse
    `count_distinct`; chained aggregation in append mode they accept.)
    """
    sums = sums or {}
    level1 = df.groupBy(tumble(size, ts), *keys, F.col(column).alias("_value")).agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.sum(as_column(c)).alias(name) for name, c in sums.items()),
    )
    again = F.window("window", size) if df.isStreaming else F.col("window")
    return level1.groupBy(again.alias("window"), *keys).agg(
        F.count("_value").alias(out), *(F.sum(name).alias(name) for name in sums)
    )


def keyword_count(df: DataFrame, size: str, keyword: str = "keyword", ts: str = "row_time") -> DataFrame:
    return df.groupBy(tumble(size, ts), keyword).agg(F.count(F.lit(1)).alias("keyword_count"))


def stamp_window(
    df: DataFrame, names: Sequence[str] = ("stt", "edt", "cur_date"), date_format: str = DATE,
    cur_date: str = "processing",
) -> DataFrame:
    """Replace `window` by its formatted bounds and a date.

    The date is today's for `cur_date="processing"`, the window start's for `"window"`,
    and left out for `"none"`.
    """
    start, end, date = names
    bounds = [
        F.date_format("window.start", DATETIME).alias(start),
        F.date_format("window.end", DATETIME).alias(end),
    ]
    if cur_date == "processing":
        bounds.append(F.date_format(F.current_timestamp(), date_format).alias(date))
    elif cur_date == "window":
        bounds.append(F.date_format("window.start", date_format).alias(date))
    elif cur_date != "none":
        raise ValueError(f"unknown cur_date {cur_date!r}")
    return df.select(*bounds, *(c for c in df.columns if c != "window"))


def salted_count(df: DataFrame, key: str, row_id: str, salts: int = 16, prefix_length: int | None = None,
                 out: str = "cnt") -> DataFrame:
    """Rows per key (or per key prefix), counted per key and salt first."""
    salt = F.pmod(F.xxhash64(row_id), F.lit(salts))
    partial = df.groupBy(key, salt.alias("_salt")).agg(F.count(F.lit(1)).alias(out))
    group = prefix(key, prefix_length).alias("re") if prefix_length else F.col(key)
    return partial.groupBy(group).agg(F.sum(out).alias(out))


def prefix_count_join(
    df: DataFrame, dim: DataFrame, column: str, dim_name: str, dim_id: str, length: int = 2
) -> DataFrame:
    """Rows per prefix of a column, joined to a dimension named by that prefix."""
    counts = df.groupBy(prefix(column, length).alias("re")).agg(F.count(F.lit(1)).alias("cnt"))
    names = dim.select(F.col(dim_name).alias("_name"), F.col(dim_id).alias("region_id"))
    return counts.join(names, counts["re"] == names["_name"]).drop("_name")
