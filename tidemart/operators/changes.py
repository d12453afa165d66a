"""Change-log rows: cleaning, selection, status changes and projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.functions.scalar import in_csv
from tidemart.schemas import BOOTSTRAP_MARKERS, CART_COLUMNS, INSERT_TYPES


def placed(changes: DataFrame) -> list[str]:
    """The column of the place in the log, if the changes carry it."""
    return [c for c in changes.columns if c == "position"]


def with_payload(changes: DataFrame) -> DataFrame:
    """Rows that carry a payload."""
    return changes.where(F.size(F.col("data")) > 0)


def etl_changes(changes: DataFrame, database: str) -> DataFrame:
    """Rows of one database with a payload, without the bootstrap markers."""
    return with_payload(changes).where(
        (F.col("database") == database) & ~F.col("type").isin(*BOOTSTRAP_MARKERS)
    )


def select_table(
    changes: DataFrame, database: str, table: str, types: Sequence[str] = INSERT_TYPES
) -> DataFrame:
    return changes.where(
        (F.col("database") == database) & (F.col("table") == table) & F.col("type").isin(*types)
    )


def select_debezium(changes: DataFrame, table: str, ops: Sequence[str] = ("r", "c", "u", "d")) -> DataFrame:
    return changes.where((F.col("source")["table"] == table) & F.col("op").isin(*ops))


def entered_status(
    field: str, to: str, from_: str | None = None,
    insert_types: Sequence[str] = ("bootstrap-insert",),
) -> Column:
    """True where a row enters status `to`: already in it when first seen, or updated into it.

    An update counts when the old image holds the field (any value, or exactly `from_`).
    """
    old = F.col("old")[field]
    was = old == from_ if from_ is not None else old.isNotNull()
    now = F.col("data")[field] == to
    return now & (F.col("type").isin(*insert_types) | ((F.col("type") == "update") & was))


def status_transition(
    changes: DataFrame, field: str, to: str, from_: str | None = None,
    insert_types: Sequence[str] = ("bootstrap-insert",),
) -> DataFrame:
    return changes.where(entered_status(field, to, from_, insert_types))


def cart_add(changes: DataFrame, database: str, table: str = "cart_info") -> DataFrame:
    """Items put into carts: inserts count whole, updates count their increase."""
    data, old = F.col("data"), F.col("old")
    now, before = data["sku_num"].cast("bigint"), old["sku_num"].cast("bigint")
    inserted = F.col("type").isin(*INSERT_TYPES)
    grown = (F.col("type") == "update") & old["sku_num"].isNotNull() & (now > before)
    rows = changes.where(
        (F.col("database") == database) & (F.col("table") == table) & (inserted | grown)
    )
    added = F.when(inserted, now).otherwise(now - before)
    return rows.select(*(_cart_column(c, data, added) for c in CART_COLUMNS))


def _cart_column(name: str, payload: Column, added: Column) -> Column:
    if name == "sku_num":
        return added.alias(name)
    return F.col(name) if name == "ts" else payload[name].alias(name)


def cart_add_debezium(changes: DataFrame, table: str = "cart_info") -> DataFrame:
    """The same for before/after images; snapshot rows (`r`) count like inserts (`c`)."""
    after, before = F.col("after"), F.col("before")
    now, was = after["sku_num"].cast("bigint"), before["sku_num"].cast("bigint")
    inserted = F.col("op").isin("r", "c")
    grown = (F.col("op") == "u") & before["sku_num"].isNotNull() & (now > was)
    rows = changes.where((F.col("source")["table"] == table) & (inserted | grown))
    added = F.when(inserted, now).otherwise(now - was)
    return rows.withColumn("ts", F.col("ts_ms")).select(
        *(_cart_column(c, after, added) for c in CART_COLUMNS)
    )


def project_config_columns(df: DataFrame, data: str = "data", columns: str = "sink_columns") -> DataFrame:
    """Keep only the payload keys listed in the row's own config."""
    kept = F.map_filter(F.col(data), lambda k, _: in_csv(columns, k))
    return df.withColumn(data, kept)


def clean_change(changes: DataFrame) -> DataFrame:
    """One image per change: the old one for deletes, the new one otherwise."""
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    return changes.select(
        F.col("source")["table"].alias("table"), "op", image.alias("data"), "ts_ms", *placed(changes)
    )


# fixed names of the operation codes in flat change rows
OP_NAMES = {"r": "READ", "c": "CREATE", "u": "UPDATE", "d": "DELETE"}


def op_name(op: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in OP_NAMES.items() for x in pair])
    return F.coalesce(names[op], op)


def flatten_change(changes: DataFrame, key: str = "id") -> DataFrame:
    """Seven text columns per change, and its `position` if it has one; the id joins the row key and the change time."""
    row_key = F.coalesce(F.col("after")[key], F.col("before")[key])
    return changes.select(
        F.concat_ws("_", row_key, F.col("ts_ms").cast("string")).alias("id"),
        op_name(F.col("op")).alias("op"),
        F.col("source")["db"].alias("db_name"),
        F.to_json("before").alias("log_before"),
        F.to_json("after").alias("log_after"),
        F.col("source")["table"].alias("t_name"),
        F.col("ts_ms").cast("string").alias("ts"), *placed(changes),
    )


def extract_map(
    df: DataFrame, keys: Mapping[str, str] | Sequence[str], data: str = "data",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Map subscripts as named columns, in order, plus the kept columns."""
    pairs = keys.items() if isinstance(keys, Mapping) else ((k, k) for k in keys)
    return df.select(*(F.col(data)[k].alias(a) for a, k in pairs), *keep)


def positional_insert(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Name the columns after the sink's, by position."""
    if len(df.columns) != len(names):
        raise ValueError(f"{len(df.columns)} columns for {len(names)} sink columns")
    return df.toDF(*names)


def assign_shop(df: DataFrame, key: str, shops: int = 12, out: str = "shop_id") -> DataFrame:
    """A reproducible shop number 1..shops for each row, as text."""
    return df.withColumn(out, (F.pmod(F.col(key), F.lit(shops)) + 1).cast("string"))
