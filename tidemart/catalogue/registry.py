"""Registration of queries next to their SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemart.catalogue.stand_ins import Tables

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}

_MODULES = (
    "sources_sinks", "changes", "logs", "joining", "aggregation", "keyed", "streams", "scalars", "jobs", "live", "landed",
)


def present(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that both engines show exact sums alike."""
    return df.select(*(
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema.fields
    ))


def query(name: str, sql: str | None = None):
    """Register `fn(tables) -> DataFrame` under a name, with its SQL if there is one."""
    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # text timestamps below are read and written in one zone
            if spark.conf.get("spark.sql.session.timeZone") != "UTC":
                spark.conf.set("spark.sql.session.timeZone", "UTC")
            return present(fn(Tables(spark, sf_dir)))
        if name in _QUERIES:
            raise ValueError(f"query {name} registered twice")
        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql
        return fn
    return register


def sql_of(name: str) -> str:
    """The SQL of a query registered before."""
    return _SQL[name]


def _load() -> None:
    for module in _MODULES:
        import_module(f"tidemart.catalogue.{module}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
