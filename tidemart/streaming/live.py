"""Streams that see dimensions and routing config as they are now.

A lookup inside a streaming plan reads the files that the dimension had when the stream started.  Here a job has two
parts: the stream proper, up to its last stateful step, and what is done with the rows of each micro-batch, after the
aggregation.  The second part gets the dimensions as of their last commit, anew for every micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemart.operators.routing import config_state
from tidemart.session import scratch_dir
from tidemart.sinks import keyed, versioned
from tidemart.streaming.job import run_job

Dims = Mapping[str, DataFrame]


class LiveDims:
    """The dimensions of a `dim_upsert` path as of the last commit.

    Each micro-batch reads the manifest.  Only if there was a commit since are the dimensions resolved, and stored,
    so that many micro-batches between two commits cost one small read each.  `tables` names the columns of each
    dimension; a row's key becomes the column `key`.  A dimension that has no rows, or none yet, is empty.
    """

    def __init__(self, path: str, tables: Mapping[str, Sequence[str]], key: str = "id"):
        self.path, self.tables, self.key = path, tables, key
        self.batch: int | None = None
        self.found: dict[str, DataFrame] | None = None

    def __call__(self, spark: SparkSession) -> dict[str, DataFrame]:
        version = versioned.current_version(spark, self.path)
        if self.found is None or version.last != self.batch:
            found = {}
            for name, columns in self.tables.items():
                rows = keyed.read_dim(spark, self.path, name, columns, version).withColumnRenamed("rowkey", self.key)
                where = scratch_dir(spark, f"live-{name}")
                rows.write.parquet(where)
                found[name] = spark.read.schema(rows.schema).parquet(where)
            self.batch, self.found = version.last, found
        return self.found


def live_writer(
    finish: Callable[[DataFrame, Dims], DataFrame], dims: Callable[[SparkSession], Dims], sink: Callable[[DataFrame, int], None],
) -> Callable[[DataFrame, int], None]:
    """`foreachBatch` form of a lookup: the batch's rows with the dimensions of this moment, to a keyed sink.

    A micro-batch repeated after a failure may see later dimensions than at first; if its rows were committed
    already, they stay as they were.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        sink(finish(batch, dims(batch.sparkSession)), batch_id)
    return write


def run_live(
    stream: DataFrame, finish: Callable[[DataFrame, Dims], DataFrame], dims: Callable[[SparkSession], Dims],
    sink: Callable[[DataFrame, int], None], checkpoint: str, **options,
) -> StreamingQuery:
    """`run_job` over `stream`, with `finish` applied to each micro-batch and the dimensions of its moment."""
    return run_job(stream, checkpoint=checkpoint, sink=live_writer(finish, dims, sink), **options)


class LiveConfig:
    """The routing config in force, from committed config changes (`keyed.upsert`), as of their last commit.

    Added, changed and deleted rows take effect with the next micro-batch, for all rows that arrive in it.
    """

    def __init__(self, path: str, keys: Sequence[str], order: Sequence[str] = ("ts",)):
        self.path, self.keys, self.order = path, list(keys), list(order)
        self.batch: int | None = None
        self.found: DataFrame | None = None

    def __call__(self, spark: SparkSession) -> DataFrame:
        version = versioned.current_version(spark, self.path)
        if self.found is None or version.last != self.batch:
            rows = keyed.read_upserts(spark, self.path, self.keys, self.order)
            where = scratch_dir(spark, "live-config")
            config_state(rows, self.keys, self.order[0]).write.parquet(where)
            self.batch, self.found = version.last, spark.read.schema(rows.schema).parquet(where)
        return self.found
