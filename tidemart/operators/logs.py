"""Splitting the behaviour log into error, start, page, display and action rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.schemas import ACTION, DISPLAY

STREAMS = ("err", "start", "display", "action", "page")


def with_event_time(log: DataFrame, ts: str = "ts", out: str = "row_time") -> DataFrame:
    return log.withColumn(out, F.timestamp_millis(F.col(ts)))


def _is_start() -> Column:
    return F.col("start").isNotNull()


def _is_page() -> Column:
    return F.col("start").isNull() & F.col("page").isNotNull()


def explode_events(log: DataFrame, array: str) -> DataFrame:
    """Each array element as its own row, with the record's page, common and ts."""
    schema = {"displays": DISPLAY, "actions": ACTION}[array]
    own = [f"e.{f}" for f in schema.fieldNames() if f != "ts"]
    return (
        log.where(_is_page())
        .select(F.explode(array).alias("e"), "page", "common", "ts")
        .select(*own, "page", "common", "ts")
    )


def split_log(log: DataFrame) -> dict[str, DataFrame]:
    """Five outputs.  An error row is the whole record; a page row loses its events."""
    return {
        "err": log.where(F.col("err").isNotNull()),
        "start": log.where(_is_start()).drop("err"),
        "display": explode_events(log, "displays"),
        "action": explode_events(log, "actions"),
        "page": log.where(_is_page()).drop("err", "start", "displays", "actions"),
    }


def split_log_wrapped(log: DataFrame) -> dict[str, DataFrame]:
    """Variant: bare error objects, events nested, every record without start is a page."""
    other = log.where(F.col("start").isNull())
    emptied = {
        c: F.when(F.size(c) == 0, F.col(c)).otherwise(F.lit(None)) for c in ("displays", "actions")
    }
    return {
        "err": log.where(F.col("err").isNotNull()).select("err.*"),
        "start": log.where(_is_start()).drop("err"),
        "display": other.select("common", "page", F.explode("displays").alias("display"), "ts"),
        "action": other.select("common", "page", F.explode("actions").alias("action")),
        "page": other.drop("err", "start").withColumns(emptied),
    }


def log_messages(log: DataFrame) -> DataFrame:
    """All five outputs of `split_log` as (topic, value) rows, in one pass over the log."""
    def message(topic: str, *columns: Column | str) -> Column:
        return F.struct(F.lit(topic).alias("topic"), F.to_json(F.struct(*columns)).alias("value"))

    def events(topic: str, array: str, schema) -> Column:
        def one(e: Column) -> Column:
            own = [e[f].alias(f) for f in schema.fieldNames() if f != "ts"]
            return message(topic, *own, "page", "common", "ts")
        return F.when(_is_page(), F.transform(array, one))

    nothing = F.array().cast("array<struct<topic:string,value:string>>")
    rest = [c for c in log.columns if c != "err"]
    page = [c for c in rest if c not in ("start", "displays", "actions")]
    singles = F.array_compact(F.array(
        F.when(F.col("err").isNotNull(), message("err", *log.columns)),
        F.when(_is_start(), message("start", *rest)),
        F.when(_is_page(), message("page", *page)),
    ))
    rows = F.concat(
        singles,
        F.coalesce(events("display", "displays", DISPLAY), nothing),
        F.coalesce(events("action", "actions", ACTION), nothing),
    )
    return log.select(F.explode(rows).alias("m")).select("m.*")
