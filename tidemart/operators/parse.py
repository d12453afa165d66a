"""Message parsing and field checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

BAD = "_bad_record"


def _parse_once(df: DataFrame, parsed: Column) -> DataFrame:
    """Add the parsed record as column `r`, evaluated once per message.

    As a plain projection it would be copied into every filter pushed below it and parse each
    message several times; nothing is pushed below a generated column.
    """
    return df.withColumn("r", F.explode(F.array(parsed)))


def parse_strict(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Typed columns of every message; a message that is not valid JSON fails the job."""
    parsed = F.from_json(F.col(value), schema, {"mode": "FAILFAST"})
    return _parse_once(df, parsed).select("r.*")


def _parsed(df: DataFrame, schema: T.StructType, value: str) -> tuple[DataFrame, Column]:
    wide = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    record = F.from_json(
        F.col(value), wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
    )
    # blank and null messages parse to a null record
    is_bad = F.col("r").isNull() | F.col(f"r.{BAD}").isNotNull()
    return _parse_once(df, record), is_bad


def parse_lenient(
    df: DataFrame, schema: T.StructType, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Typed columns of the readable messages, and the kept ones; the other messages are skipped."""
    rows, is_bad = _parsed(df, schema, value)
    return rows.where(~is_bad).select(*(f"r.{f}" for f in schema.fieldNames()), *keep)


def parse_split(
    df: DataFrame, schema: T.StructType, value: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """Readable messages as typed columns, and the raw text of the others."""
    rows, is_bad = _parsed(df, schema, value)
    good = rows.where(~is_bad).select(*(f"r.{f}" for f in schema.fieldNames()))
    return good, rows.where(is_bad).select(F.col(value).alias("value"))


def parse_tagged(
    df: DataFrame, schema: T.StructType, value: str = "value", keep: Sequence[str] = (), out: str = "unreadable"
) -> DataFrame:
    """Both halves of `parse_split` in one scan and one parse.

    The typed columns, null for unreadable messages, and `out`: the raw text of those, null for the others (a null
    message is an empty text there).
    """
    rows, is_bad = _parsed(df, schema, value)
    raw = F.when(is_bad, F.coalesce(F.col(value), F.lit("")))
    fields = (F.when(~is_bad, F.col(f"r.{f}")).alias(f) for f in schema.fieldNames())
    return rows.select(*fields, raw.alias(out), *keep)


def require_fields(
    df: DataFrame, columns: Sequence[str], ts: str | None = "ts", strict: bool = False
) -> DataFrame:
    """Keep rows whose required fields are non-empty and whose time is positive.

    With `strict`, a row that lacks a required field raises instead of being dropped.
    """
    present = F.lit(True)
    for c in columns:
        present = present & F.col(c).isNotNull()
    keep = F.lit(True)
    for c in columns:
        keep = keep & (F.col(c) != "")
    if ts:
        present = present & F.col(ts).isNotNull()
        keep = keep & (F.col(ts) > 0)
    if strict:
        message = F.lit(f"required field missing: {', '.join(columns)}, {ts}")
        keep = F.when(present, keep).otherwise(F.raise_error(message).cast("boolean"))
    return df.where(keep)
