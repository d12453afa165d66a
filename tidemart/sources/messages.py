"""Message streams: raw text, change logs, facts and log files."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemart.functions.scalar import epoch_to_timestamp, processing_time
from tidemart.operators.parse import parse_lenient
from tidemart.schemas import CHANGE, DEBEZIUM


#: The column of a message's place in its log.
POSITION = "position"
#: The column of the id that a writer gave a message.
MESSAGE_ID = "message_id"


def read_messages(
    spark: SparkSession, location: str, fmt: str = "kafka", stream: bool = True, position: bool = False,
    message_id: bool = False, **options: str,
) -> DataFrame:
    """Message values as text, from the earliest one on; null values stay null.

    `kafka`: `location` is a topic, and `options` name the brokers.  `text`: `location` is a
    folder of files with one message per line.

    With `position`, messages keep the order in which they arrived: a column of `log`, `block` and `line` that
    compares like it.  Of a topic these are the partition and the offset, so it orders what shares a partition,
    as the changes of one key do.  Of files they are the time of the file and its name, the place of the
    block in the file, and a number that rises with the lines of a block.

    With `message_id`, messages come with the id that `sinks.messages.once_writer` gave them, for `drop_repeats`.
    Messages of a topic that have none are known by their place; every line of text must have one.
    """
    reader = spark.readStream if stream else spark.read
    if fmt == "kafka":
        options = {"subscribe": location, "startingOffsets": "earliest", "includeHeaders": str(message_id).lower(), **options}
        raw = reader.format("kafka").options(**options).load()
        value = F.col("value").cast("string").alias("value")
        place = F.format_string("%010d", F.col("partition")), F.lit(0), F.col("offset")
        if message_id:
            given = F.get(F.filter("headers", lambda h: h["key"] == MESSAGE_ID), F.lit(0))["value"].cast("string")
            known = F.coalesce(given, F.concat_ws("/", "topic", "partition", "offset"))
    elif fmt == "text":
        raw, value = reader.options(**options).text(location), F.col("value")
        of_file = F.col("_metadata")
        place = (F.format_string("%015d %s", F.unix_millis(of_file["file_modification_time"]), of_file["file_path"]),
                 of_file["file_block_start"], F.monotonically_increasing_id())
        if stream and position:  # Spark numbers no rows of a stream
            raw = raw.select("value", place[0].alias("log"), place[1].alias("block")).mapInArrow(
                _numbered, "value string, log string, block long, line long")
            place = F.col("log"), F.col("block"), F.col("line")
        if message_id:  # the id, a tab, the message
            known, value = F.substring_index("value", "\t", 1), F.expr("substr(value, instr(value, '\t') + 1)").alias("value")
    if fmt in ("kafka", "text"):
        log, block, line = place
        return raw.select(value, *([F.struct(
            log.alias("log"), block.cast("long").alias("block"), line.cast("long").alias("line")).alias(POSITION)] if position else []),
            *([known.alias(MESSAGE_ID)] if message_id else []))
    raise ValueError(f"unknown message format {fmt!r}")


def _numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add a number that rises with the rows of a partition."""
    first = 0
    for batch in batches:
        end = first + batch.num_rows
        yield batch.append_column("line", pa.array(range(first, end), pa.int64()))
        first = end


def log_files(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    """Lines of the log files in a folder; the query's checkpoint is the read position."""
    return read_messages(spark, folder, "text", stream=True, **options)


def watermarked(df: DataFrame, ts: str, delay: str | None) -> DataFrame:
    return df.withWatermark(ts, delay) if delay and df.isStreaming else df


def _placed(messages: DataFrame) -> list[str]:
    return [c for c in (POSITION, MESSAGE_ID) if c in messages.columns]


def drop_repeats(df: DataFrame) -> DataFrame:
    """Each message once, by `message_id`; the column goes.

    A repeat has the event time of its first delivery.  On a stream, which needs its watermark by now, an id is
    kept until the watermark has passed that time by the delay; a repeat that comes later is late, and
    late rows are dropped, so no repeat gets through.
    """
    once = df.dropDuplicatesWithinWatermark([MESSAGE_ID]) if df.isStreaming else df.dropDuplicates([MESSAGE_ID])
    return once.drop(MESSAGE_ID)


def change_stream(messages: DataFrame, delay: str | None = "5 seconds") -> DataFrame:
    """Typed change log with event time (from seconds), processing time and, if read, `position`."""
    rows = parse_lenient(messages, CHANGE, keep=_placed(messages)).withColumns(
        {"row_time": epoch_to_timestamp("ts", "s"), "proc_time": processing_time()}
    )
    return watermarked(rows, "row_time", delay)


def debezium_stream(messages: DataFrame, delay: str | None = "5 seconds") -> DataFrame:
    """Typed before/after change log with event time (from milliseconds)."""
    rows = parse_lenient(messages, DEBEZIUM, keep=_placed(messages)).withColumn("row_time", epoch_to_timestamp("ts_ms", "ms"))
    return watermarked(rows, "row_time", delay)


def fact_stream(
    messages: DataFrame, schema: T.StructType, ts: str = "ts", unit: str = "s",
    delay: str | None = "5 seconds", out: str = "row_time",
) -> DataFrame:
    """A fact topic re-read with its declared columns and event time."""
    rows = parse_lenient(messages, schema, keep=_placed(messages)).withColumn(out, epoch_to_timestamp(ts, unit))
    return watermarked(rows, out, delay)
