"""Message sinks: one topic, or a topic per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemart.sources.messages import MESSAGE_ID

#: Messages of one file of a text log.  A compressed file is read by one task.
FILE_ROWS = 1_000_000
#: How text logs are written: messages repeat their field names, so they shrink to a tenth.
TEXT_LOG = {"compression": "gzip", "maxRecordsPerFile": str(FILE_ROWS)}


def as_messages(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias("value"))


def write_messages(df: DataFrame, topic: str, location: str, fmt: str = "text", **options: str) -> None:
    """Append rows as JSON messages to one topic.

    `text` writes files below `location/topic=<topic>`; `kafka` takes `location` as brokers.
    Kafka delivery is at least once; `once_writer` lets readers drop what comes twice.
    """
    write_routed(as_messages(df).withColumn("topic", F.lit(topic)), "topic", location, fmt, **options)


def write_routed(
    df: DataFrame, topic: str, location: str, fmt: str = "text", mode: str = "append", **options: str
) -> None:
    """Append each row's `value` to the topic named by the row.

    A `message_id` goes along: as a header to Kafka, before a tab in text.  Files of text are compressed and of
    at most `FILE_ROWS` messages, so that a log is read by many tasks; options say otherwise.
    """
    value, known = F.col("value"), []
    if MESSAGE_ID in df.columns and fmt == "kafka":
        known = [F.array(F.struct(F.lit(MESSAGE_ID).alias("key"), F.col(MESSAGE_ID).cast("binary").alias("value"))).alias("headers")]
    elif MESSAGE_ID in df.columns:
        value = F.concat(F.col(MESSAGE_ID), F.lit("\t"), F.coalesce(value, F.lit("")))
    rows = df.select(F.col(topic).alias("topic"), value.alias("value"), *known)
    if fmt == "kafka":
        options = {"kafka.bootstrap.servers": location, **options}
        rows.write.format("kafka").options(**options).save()
    else:
        options = {**(TEXT_LOG if fmt == "text" else {}), **options}
        rows.write.mode(mode).options(**options).partitionBy("topic").format(fmt).save(location)


def payload_messages(df: DataFrame, topic: str, data: str = "data") -> DataFrame:
    """Only the payload of routed rows, with its destination."""
    return df.select(F.col(topic).alias("topic"), F.to_json(data).alias("value"))


def batch_writer(location: str, topic: str = "topic"):
    """`foreachBatch` function for routed text files; a repeated batch replaces its own files."""
    def write(df: DataFrame, batch_id: int) -> None:
        write_routed(df, topic, f"{location}/batch={batch_id}", mode="overwrite")
    return write


def identified(df: DataFrame, job: str, batch_id: int) -> DataFrame:
    """Messages (`topic`, `value`) with a `message_id` that a repeat of the micro-batch gives them again.

    The id names the job, the batch, what is sent and which of several equal messages it is.  It does not depend on the
    order or the tasks of a run, which may differ when a batch is repeated.  Equal messages are counted before
    the shuffle, so many of them are one row per task.  The order of messages is not kept.
    """
    counted = df.groupBy("topic", "value").agg(F.count(F.lit(1)).alias("_n"))
    one_each = counted.select("topic", "value", F.explode(F.sequence(F.lit(1).cast("long"), "_n")).alias("_copy"))
    # a null field is left out of the JSON text, so it differs from every text
    sent = F.md5(F.to_json(F.struct("topic", "value")))
    return one_each.select("topic", "value", F.concat_ws("-", F.lit(job), F.lit(batch_id), sent, "_copy").alias(MESSAGE_ID))


def once_writer(location: str, job: str, topic: str = "topic", fmt: str = "kafka", **options: str):
    """`foreachBatch` function that appends messages with ids.

    A batch repeated after a failure is delivered again under the same ids; `read_messages(message_id=True)` and
    `drop_repeats` then give each message once.  `job` must be the same for all runs of a checkpoint and
    another for other jobs that write to the topic.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        rows = df.select(F.col(topic).alias("topic"), "value")
        write_routed(identified(rows, job, batch_id), "topic", location, fmt, **options)
    return write


def console(df: DataFrame, rows: int = 20) -> None:
    if df.isStreaming:
        df.writeStream.format("console").option("numRows", rows).start()
    else:
        df.show(rows, truncate=False)
