"""Scalar functions: time conversion, keys, names, money."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

DATE = "yyyy-MM-dd"
DATETIME = "yyyy-MM-dd HH:mm:ss"
COMPACT_DATE = "yyyyMMdd"
DAY_MS = 86_400_000

# the warehouse's fixed zone for text timestamps: UTC+8
TEXT_OFFSET_MS = 8 * 3_600_000


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- epoch -> text, in the session time zone ------------------------------------------

def ms_to_date(ms: Column | str) -> Column:
    return F.date_format(F.timestamp_millis(as_column(ms)), DATE)


def ms_to_datetime(ms: Column | str) -> Column:
    return F.date_format(F.timestamp_millis(as_column(ms)), DATETIME)


def ms_to_compact_date(ms: Column | str) -> Column:
    return F.date_format(F.timestamp_millis(as_column(ms)), COMPACT_DATE)


# ---- text -> epoch, at a fixed offset -------------------------------------------------

def datetime_to_ms(text: Column | str, offset_ms: int = TEXT_OFFSET_MS) -> Column:
    """`yyyy-MM-dd HH:mm:ss` read at a fixed offset, whatever the session zone is."""
    wall = F.to_timestamp_ntz(as_column(text), F.lit(DATETIME))
    return wall_ms(wall) - F.lit(offset_ms)


def date_to_ms(text: Column | str, offset_ms: int = TEXT_OFFSET_MS) -> Column:
    return datetime_to_ms(F.concat(as_column(text), F.lit(" 00:00:00")), offset_ms)


def wall_ms(ntz: Column | str) -> Column:
    """Milliseconds of a zone-less timestamp, counted as if it were UTC."""
    epoch = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    return F.timestamp_diff("MILLISECOND", epoch, as_column(ntz))


def epoch_to_timestamp(value: Column | str, unit: str = "s") -> Column:
    if unit == "s":
        return F.timestamp_seconds(as_column(value))
    if unit == "ms":
        return F.timestamp_millis(as_column(value))
    raise ValueError(f"unit must be 's' or 'ms', not {unit!r}")


def text_to_date(text: Column | str) -> Column:
    """Reformat a text timestamp as `yyyy-MM-dd`; null when it cannot be read."""
    pattern = F.lit("yyyy-MM-dd[ HH:mm:ss[.SSS]]")
    return F.date_format(F.try_to_timestamp(as_column(text), pattern), DATE)


def processing_time() -> Column:
    return F.current_timestamp()


def whole_days_since(ms: Column | str, date_text: Column | str, offset_ms: int = 0) -> Column:
    """Whole days from the midnight of `date_text` to `ms`, truncated."""
    return F.floor((as_column(ms) - date_to_ms(date_text, offset_ms)) / F.lit(DAY_MS)).cast("bigint")


# ---- values ---------------------------------------------------------------------------

def to_bigint(c: Column | str) -> Column:
    """Strict cast under ANSI mode: bad text raises."""
    return as_column(c).cast("bigint")


def try_bigint(c: Column | str) -> Column:
    return as_column(c).try_cast("bigint")


def choose(condition: Column, then: Column, otherwise: Column) -> Column:
    return F.when(condition, then).otherwise(otherwise)


def money(c: Column | str, precision: int = 18, scale: int = 2) -> Column:
    return as_column(c).cast(f"decimal({precision},{scale})")


def or_zero(c: Column | str) -> Column:
    return F.coalesce(as_column(c), F.lit(0))


def in_csv(csv: Column | str, member: Column) -> Column:
    """Exact membership of `member` in a comma separated list."""
    return F.find_in_set(member, as_column(csv)) > 0


def prefix(c: Column | str, n: int) -> Column:
    return F.substring(as_column(c), 1, n)


def set_size(c: Column | str) -> Column:
    """Distinct non-null values; the form streams accept (`count_distinct` is refused there)."""
    return F.size(F.collect_set(as_column(c))).cast("bigint")


def unscaled_decimal(c: Column | str, scale: int = 2) -> Column:
    """Decode a positive base64 unscaled decimal as change capture writes it."""
    unscaled = F.conv(F.hex(F.unbase64(as_column(c))), 16, 10).cast("decimal(20,0)")
    return (unscaled / F.lit(10**scale).cast("decimal(10,0)")).cast(f"decimal(22,{scale})")


def to_json_row(*columns: str) -> Column:
    return F.to_json(F.struct(*(columns or ("*",))))


# ---- names ----------------------------------------------------------------------------

def camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(part[:1].upper() + part[1:] for part in rest)


def snake(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower()


def camel_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*(camel(c) for c in df.columns))


def snake_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*(snake(c) for c in df.columns))
