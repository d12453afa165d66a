"""Small builders and comparisons for tests."""

from __future__ import annotations

import datetime as dt
import json

from tidemart.schemas import CHANGE, DEBEZIUM, LOG

BASE = dt.datetime(2024, 3, 1, 8, 0, 0)
BASE_MS = 1_709_280_000_000


def rows(df):
    """Rows as a sorted list of tuples; None sorts first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: [(x is not None, str(x)) for x in t])


def at(seconds: float) -> dt.datetime:
    return BASE + dt.timedelta(seconds=seconds)


def change(table, type_, data, old=None, ts=1_709_280_000, database="shop"):
    text = lambda m: None if m is None else {k: None if v is None else str(v) for k, v in m.items()}
    return (database, table, type_, ts, text(data), text(old))


def changes(spark, *items):
    return spark.createDataFrame(list(items), CHANGE)


def debezium(spark, *items):
    """Items are (op, before, after, table, ts_ms)."""
    return spark.createDataFrame(
        [(op, b, a, {"db": "shop", "table": t}, ts) for op, b, a, t, ts in items],
        DEBEZIUM,
    )


def log_record(mid="m1", ts=BASE_MS, **parts):
    common = {"mid": mid, "uid": "u1", "sid": "s1", "vc": "v1", "ch": "c1", "ar": "a1", "is_new": "0"}
    common.update(parts.pop("common", {}))
    return {"common": common, "ts": ts, **parts}


def messages(spark, *records):
    values = [r if isinstance(r, str) or r is None else json.dumps(r) for r in records]
    return spark.createDataFrame([(v,) for v in values], "value string")


def logs(spark, *records):
    from tidemart.operators.parse import parse_strict
    return parse_strict(messages(spark, *records), LOG)
