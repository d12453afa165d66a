"""Running streams: watermark settings and the source-transform-sink skeleton."""

from __future__ import annotations

from collections.abc import Callable
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemart.session import STATE_STORE

# fixed delays of the jobs
SUMMARY_DELAY = "5 seconds"
RAW_LOG_DELAY = "20 seconds"

#: One job at a time changes the session's settings while it starts.
_STARTING = Lock()


def watermark(df: DataFrame, ts: str = "row_time", delay: str = SUMMARY_DELAY) -> DataFrame:
    """Bounded out-of-orderness; rows behind it are dropped by stateful operators."""
    return df.withWatermark(ts, delay) if df.isStreaming else df


def stream_settings(spark: SparkSession, ignore_idle: bool = False) -> None:
    """Settings keyed state needs.

    By default the slowest input sets the watermark, so rows of an input that lags are kept, and an
    input without any rows holds windows open; `streaming.idle.IdleInputs` gives silent inputs a
    time-out.  `ignore_idle` lets the fastest input set the watermark instead, which LOSES the
    rows of slower ones as late; `run_job` refuses it for joins of streams.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    # upload what a batch changed, not the whole state
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    policy = "max" if ignore_idle else "min"
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", policy)


def _joins_streams(df: DataFrame) -> bool:
    """Whether a join has streams on both sides."""
    def any_join(node) -> bool:
        children = node.children()
        below = [children.apply(i) for i in range(children.size())]
        return (node.nodeName() == "Join" and all(c.isStreaming() for c in below)) or any(map(any_join, below))
    return any_join(df._jdf.queryExecution().analyzed())


def run_job(
    source: DataFrame, *handlers: Callable[[DataFrame], DataFrame], checkpoint: str,
    sink: Callable[[DataFrame, int], None] | None = None, path: str | None = None,
    available_now: bool = True, name: str | None = None, state_partitions: int | None = None,
) -> StreamingQuery:
    """The job skeleton: source, then each handler, then a sink.

    The sink is a `foreachBatch` function, or a folder of parquet files.  A stream keeps the
    number of state partitions of its first run; `state_partitions` sets it for this job
    alone, instead of `spark.sql.shuffle.partitions`.
    """
    df = source
    for handle in handlers:
        df = df.transform(handle)
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    if sink is not None:
        writer = writer.foreachBatch(sink)
    else:
        writer = writer.format("parquet").option("path", path)
    conf = df.sparkSession.conf
    if conf.get("spark.sql.streaming.multipleWatermarkPolicy", "min") == "max" and _joins_streams(df):
        raise ValueError("ignore_idle would drop matches of a join of streams: its slower side counts as late")
    with _STARTING:
        before = conf.get("spark.sql.shuffle.partitions")
        try:
            # a query copies the session's settings when it starts
            conf.set("spark.sql.shuffle.partitions", str(state_partitions or before))
            return writer.start()
        finally:
            conf.set("spark.sql.shuffle.partitions", before)


def run_to_end(*args, **kwargs) -> None:
    """`run_job` until all present input is done."""
    run_job(*args, **kwargs).awaitTermination()
