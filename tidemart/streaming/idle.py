"""Idle time-outs: an input that falls silent stops holding windows open.

Spark's watermark is the least of all inputs', so rows of an input that lags are kept, and one without rows
holds every window open.  Here each input is joined by a stream of heartbeats.  Once it was silent for
the time-out, heartbeats move its own watermark, and only its own, up to that of the inputs that still
have rows; the policy stays `min`.
"""

from __future__ import annotations

import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tidemart.streaming.job import SUMMARY_DELAY

_BEAT = "_beat"


class IdleInputs(StreamingQueryListener):
    """The inputs of one query, and which of them are silent.

    `add` each input instead of `watermark`, then `start` before the query runs and `stop` after it.
    Heartbeats are files of one number below `folder/<name>`, which must be the same folder when the query starts
    again from its checkpoint; Spark deletes them when they are read.

    An input is silent when a micro-batch has no row of it and began `timeout` seconds or more after the last
    that had one (or after the first).  A micro-batch takes all that has arrived when it begins, so input that waits
    behind a slow one is not taken for silent.  Silent inputs follow the slowest of the others; if all are
    silent, all follow the fastest.  Rows that a silent input sends later are late if the watermark has passed
    them.  The driver keeps three numbers per input.
    """

    def __init__(self, spark: SparkSession, folder: str, timeout: float = 5):
        self.spark, self.folder, self.timeout = spark, folder.rstrip("/"), timeout
        self.latest: dict[str, int | None] = {}   # the input's event time, its own or a heartbeat's, in microseconds
        self.alive: dict[str, float] = {}         # when a micro-batch with rows of the input began
        self.sent: dict[str, int] = {}            # the last heartbeat
        self.runs: set[str] = set()
        self.settled = False

    def add(self, name: str, df: DataFrame, ts: str = "row_time", delay: str = SUMMARY_DELAY) -> DataFrame:
        """A stream with its watermark and heartbeats; heartbeats themselves are no rows of the result."""
        if name in self.latest:
            raise ValueError(f"input {name!r} was added before")
        self.latest[name] = None
        if not df.isStreaming:
            return df
        beats_at = f"{self.folder}/{name}"
        self.spark.createDataFrame([], "at long").write.mode("ignore").parquet(beats_at)
        newest = lambda column: F.max(F.unix_micros(column)).alias("newest")
        rows = df.observe(f"rows of {name}", newest(F.col(ts).cast("timestamp")), F.count(F.lit(1)).alias("n"))
        beats = self.spark.readStream.schema("at long").option("cleanSource", "delete").parquet(beats_at).select(
            F.timestamp_micros("at").alias(ts), F.timestamp_micros("at").alias(_BEAT))
        beats = beats.observe(f"beats of {name}", newest(F.col(ts)), F.count(F.lit(1)).alias("n"))
        both = rows.unionByName(beats, allowMissingColumns=True).withWatermark(ts, delay)
        # a condition on the event time stays above the watermark, which has to see the heartbeats
        return both.where(F.col(_BEAT).isNull() | (F.col(_BEAT) > F.col(ts))).drop(_BEAT)

    def start(self) -> None:
        self.spark.streams.addListener(self)

    def stop(self) -> None:
        self.spark.streams.removeListener(self)

    def await_quiet(self, query: StreamingQuery, seconds: float) -> None:
        """Wait until all input is read and all heartbeats have taken effect."""
        end = time.monotonic() + seconds
        while not self.settled:
            if query.exception() is not None:
                raise query.exception()
            if time.monotonic() > end:
                raise TimeoutError(f"input still comes after {seconds} seconds")
            time.sleep(0.1)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = {k: (r["n"], r["newest"]) for k, r in event.progress.observedMetrics.items()}
        if any(f"rows of {name}" in seen for name in self.latest):
            self.runs.add(str(event.progress.runId))
        if str(event.progress.runId) in self.runs:
            self.follow(seen, _seconds(event.progress.timestamp))

    def onQueryIdle(self, event) -> None:
        if str(event.runId) in self.runs:
            self.settled = not self.follow({}, _seconds(event.timestamp))

    def follow(self, seen: dict[str, tuple[int, int | None]], began: float) -> bool:
        """Take in a micro-batch, or a look that found nothing; whether inputs are awake or heartbeats on their way."""
        self.settled = False
        for name in self.latest:
            n, newest = seen.get(f"rows of {name}", (0, None))
            _, beat = seen.get(f"beats of {name}", (0, None))
            if n or name not in self.alive:
                self.alive[name] = began
            known = [t for t in (self.latest[name], newest, beat) if t is not None]
            self.latest[name] = max(known, default=None)
        silent = [name for name in self.latest if began - self.alive[name] >= self.timeout]
        others = [self.latest[name] for name in self.latest if name not in silent]
        if None in others:  # an input that may still begin anywhere
            return True
        known = [t for t in self.latest.values() if t is not None]
        goal = min(others) if others else max(known, default=None)
        for name in silent if goal is not None else ():
            if max(self.latest[name] or goal - 1, self.sent.get(name, goal - 1)) < goal:
                self.sent[name] = goal
                self.beat(name, goal)
        return self._on_their_way() or len(silent) < len(self.latest)

    def _on_their_way(self) -> bool:
        return any(self.latest[name] is None or self.latest[name] < at for name, at in self.sent.items())

    def beat(self, name: str, at: int) -> None:
        self.spark.createDataFrame([(at,)], "at long").coalesce(1).write.mode("append").parquet(f"{self.folder}/{name}")


def _seconds(stamp: str) -> float:
    return datetime.fromisoformat(stamp.replace("Z", "+00:00")).timestamp()
