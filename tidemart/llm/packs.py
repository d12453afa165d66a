"""Rows put up in packs: consecutive rows as one stored, compressed table each.

A pack is what one task works on, and it is the unit that shards answer.  Packs are stored in
buckets, so answers are shuffled to them and the texts themselves never are.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidemart.llm.grams import small_batches
from tidemart.session import scratch_dir

PACK_BYTES = 8 << 20


def put_up(rows: DataFrame, pack_bytes: int = PACK_BYTES) -> DataFrame:
    """A table of `pack` and `body`, one row for about `pack_bytes` of rows; a longer row has its own pack.

    There are as many buckets as shuffle partitions.  A task writes one file per bucket at most, and
    no more than it has packs.  The table is written once, so packs stay as they are if later steps
    run again.
    """
    spark = rows.sparkSession
    small_batches(spark)

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, total = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            # a batch is cut about where a pack is full
            at = 0
            while at < batch.num_rows:
                step = max(1, min(batch.num_rows - at, (batch.num_rows * (pack_bytes - total)) // max(batch.nbytes, 1)))
                part = batch.slice(at, step)
                held.append(part)
                total += part.nbytes
                at += step
                if total >= pack_bytes:
                    yield seal(number, held)
                    number, held, total = number + 1, [], 0
        if held:
            yield seal(number, held)

    name = f"packs_{uuid.uuid4().hex}"
    rows.mapInArrow(gather, "pack long, body binary").write.bucketBy(
        int(spark.conf.get("spark.sql.shuffle.partitions")), "pack",
    ).option("path", scratch_dir(spark, "packs")).option("parquet.block.size", 16 << 20).saveAsTable(name)
    return spark.table(name)


def seal(number: int, batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batches[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        for batch in batches:
            out.write_batch(batch)
    return pa.RecordBatch.from_pydict({
        "pack": pa.array([number], pa.int64()), "body": pa.array([sink.getvalue().to_pybytes()], pa.binary())})


def unseal(own: pa.Table) -> tuple[int, pa.Table]:
    """The number and the rows of a pack, from its row of the table."""
    return own.column("pack")[0].as_py(), pa.ipc.open_stream(own.column("body")[0].as_buffer()).read_all()
