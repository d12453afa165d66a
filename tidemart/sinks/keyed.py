"""Keyed, idempotent sinks on plain files.

An upsert topic is an append-only log whose readers keep the latest row per key; the same
is done here.  Each micro-batch is a committed batch of a table (`versioned`), so a write costs what the
batch holds, not what the table holds.  `read_*` resolves the rows per key as of the last commit, and
`compact_*` merges the batches so far, a bucket at a time.

Rows that carry the `position` of their message are ordered by it within one time, so the last to arrive wins.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemart.operators.aggregates import latest_per_key
from tidemart.operators.changes import placed
from tidemart.sinks import versioned


# ---- whole rows ------------------------------------------------------------------------

def upsert(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], path: str, batch_id: int = 0,
    partition_by: Sequence[str] = (),
) -> None:
    """Commit the latest row per key of this batch; repeating a batch changes nothing."""
    versioned.commit(latest_per_key(df, keys, order), path, batch_id, partition_by)


def upsert_writer(keys, order, path, partition_by=()) -> Callable[[DataFrame, int], None]:
    """`foreachBatch` form of `upsert`."""
    return lambda df, batch_id: upsert(df, keys, order, path, batch_id, partition_by)


def read_committed(spark: SparkSession, path: str) -> DataFrame:
    """All committed rows with the `batch` they came in."""
    found = versioned.read_version(spark, path, versioned.current_version(spark, path))
    if found is None:
        raise ValueError(f"nothing was committed to {path}")
    return found


def read_upserts(
    spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The latest row per key over all batches; among equal `order`, the later batch wins."""
    return latest_per_key(read_committed(spark, path), keys, [*order, "batch"]).drop("batch")


def compact_upserts(
    spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], partition_by: Sequence[str] = (),
    buckets: int = versioned.BUCKETS,
) -> None:
    """Merge the batches so far, keeping the latest row per key."""
    versioned.compact(spark, path, keys, lambda rows: latest_per_key(rows, keys, [*order, "batch"]), partition_by, buckets)


def compact(resolved: DataFrame, new_path: str, batch_id: int = 0) -> None:
    """Write a resolved table as the only batch of a new path."""
    if versioned.current_version(resolved.sparkSession, new_path).last is not None:
        raise ValueError(f"{new_path} has batches already")
    versioned.commit(resolved, new_path, batch_id)


def write_summary(df: DataFrame, path: str, batch_id: int = 0) -> None:
    """Summary rows; `read_summary` keeps one per window and dimensions.

    Append-mode streams emit a window once, so a batch holds each key once already and only
    a repeated batch could write it again, which is not taken.
    """
    versioned.commit(df, path, batch_id)


def read_summary(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    return read_upserts(spark, path, keys, [])


def write_changelog_flat(df: DataFrame, path: str, batch_id: int = 0) -> None:
    """Seven-column flat change rows keyed by id; partitions (source tables) appear as needed.

    The id holds the change's time, so of changes of one row in one moment the last to arrive stays, by `position`.
    Batches are dealt by id, so that the wide rows are shuffled here and no more by `read_changelog_flat` and `compact_changelog_flat`.
    """
    versioned.commit(latest_per_key(df, ["id"], ["ts", *placed(df)]), path, batch_id, ["t_name"], dealt_by=["id"])


def read_changelog_flat(spark: SparkSession, path: str) -> DataFrame:
    """The flat change rows, of each id the last to arrive."""
    rows = read_committed(spark, path)
    return latest_per_key(rows, ["id"], ["ts", *placed(rows), "batch"]).drop("batch", *placed(rows))


def compact_changelog_flat(spark: SparkSession, path: str) -> None:
    """Merge the batches so far."""
    def reduce(rows: DataFrame) -> DataFrame:
        return latest_per_key(rows, ["id"], ["ts", *placed(rows), "batch"])
    versioned.compact(spark, path, ["id"], reduce, ["t_name"])


def write_jdbc(df: DataFrame, url: str, table: str, columns: Sequence[str], **options: str) -> None:
    """Append rows by position: the first column goes to `columns[0]`, and so on."""
    df.toDF(*columns).write.format("jdbc").options(url=url, dbtable=table, **options).mode("append").save()


# ---- dimensions: partial rows and deletes ------------------------------------------------

def dim_upsert(
    routed: DataFrame, path: str, batch_id: int = 0, ts: str = "ts", delete: str = "delete"
) -> None:
    """Puts and deletes of all dimensions in a batch, one folder per dimension.

    `routed` holds `sink_table`, `rowkey`, the text map `data`, the change `type` and `ts`, and
    may hold `position`, by which changes of one time are put in order.
    """
    rows = routed.where(F.col("rowkey").isNotNull()).select(
        "sink_table", "rowkey", "data", (F.col("type") == delete).alias("deleted"),
        F.col(ts).alias("ts"), *placed(routed),
    )
    versioned.commit(rows, path, batch_id, ["sink_table"])


def dim_writer(path: str) -> Callable[[DataFrame, int], None]:
    """`foreachBatch` form of `dim_upsert`."""
    return lambda df, batch_id: dim_upsert(df, path, batch_id)


def resolve_dim(
    changes: DataFrame, columns: Sequence[str], order: Sequence[str | Column] = ("ts",)
) -> DataFrame:
    """Current dimension rows: each cell is its latest non-null put after the last delete.

    One aggregation, reduced per task before the shuffle, so a hot row key stays cheap.
    """
    rows = changes.withColumn("_by", F.struct(*order))
    put = ~F.col("deleted")
    written = {c: F.when(put & F.col("data")[c].isNotNull(), F.col("_by")) for c in columns}
    # max and max_by skip null orderings: a null cell leaves the older one in place
    summary = rows.groupBy("rowkey").agg(
        F.max(F.when(F.col("deleted"), F.col("_by"))).alias("_gone"),
        F.max(F.when(put, F.col("_by"))).alias("_put"),
        *(F.max(F.struct(by.alias("at"), F.col("data")[c].alias("v"))).alias(f"_{c}")
          for c, by in written.items()),
    )
    gone = F.col("_gone")
    after = lambda at: gone.isNull() | (at > gone)
    return summary.where(F.col("_put").isNotNull() & after(F.col("_put"))).select(
        "rowkey",
        *(F.when(F.col(f"_{c}.at").isNotNull() & after(F.col(f"_{c}.at")), F.col(f"_{c}.v")).alias(c)
          for c in columns),
    )


def _dim_order(changes: DataFrame) -> list[str]:
    return ["ts", *placed(changes), "batch"]


def read_dim(
    spark: SparkSession, path: str, table: str, columns: Sequence[str], version: versioned.Version | None = None
) -> DataFrame:
    """The rows of one dimension as of a version, by default the last commit; without any commit it is empty.

    Changes of one time count in the order of their `position`, or of their batches if they have none.
    """
    found = versioned.read_version(spark, path, version or versioned.current_version(spark, path))
    if found is None:
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in ("rowkey", *columns)))
    return resolve_dim(found.where(F.col("sink_table") == table), columns, _dim_order(found))


def compact_dim(spark: SparkSession, path: str, buckets: int = versioned.BUCKETS) -> None:
    """Merge the batches so far to the changes that still matter, in the form in which changes are stored.

    Those are, of each row: its last delete, its last put, and of each cell the last put that is not null.  So late
    changes that come after a compaction find their place as before.
    """
    def reduce(rows: DataFrame) -> DataFrame:
        keys, order = ["sink_table", "rowkey"], _dim_order(rows)
        # one total order, also over equal changes of different batches, which are taken as equal
        moment = F.struct(*order)
        puts = rows.where(~F.col("deleted"))
        cells = puts.select(*keys, moment.alias("at"), F.explode("data").alias("cell", "v")).where("v is not null")
        cells = cells.groupBy(*keys, "cell").agg(F.max(F.struct("at", "v")).alias("last")).select(
            *keys, "last.at", F.lit(False).alias("deleted"), F.create_map("cell", "last.v").alias("data"))
        whole = rows.groupBy(*keys, "deleted").agg(F.max(moment).alias("at")).select(
            *keys, "at", "deleted", F.create_map().cast("map<string,string>").alias("data"))
        return cells.unionByName(whole).select(*keys, "data", "deleted", "at.*")

    versioned.compact(spark, path, ["sink_table", "rowkey"], reduce, ["sink_table"], buckets)


# ---- table life cycle ------------------------------------------------------------------

def dim_lifecycle(config_changes: DataFrame, database: str, location: str | None = None) -> list[str]:
    """Create, drop or recreate dimension tables for the config changes of one batch.

    `d` drops, `r` and `c` create if absent, `u` drops and creates.  Returns the statements
    run.  Changes come to the driver in order, a partition at a time, however many there are.
    """
    spark = config_changes.sparkSession
    rows = config_changes.select("sink_table", "sink_columns", "op", "ts").orderBy("ts")
    name = lambda x: "`" + x.replace("`", "``") + "`"
    done = []
    for row in rows.toLocalIterator():
        table = f"{name(database)}.{name(row.sink_table)}"
        columns = ", ".join(f"{name(c.strip())} STRING" for c in row.sink_columns.split(","))
        path = f"{location.rstrip('/')}/{row.sink_table}".replace("'", "\\'") if location else ""
        where = f" LOCATION '{path}'" if location else ""
        create = f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{where}"
        drop = f"DROP TABLE IF EXISTS {table}"
        statements = {"d": [drop], "r": [create], "c": [create], "u": [drop, create]}[row.op]
        for statement in statements:
            spark.sql(statement)
        done += statements
    return done
