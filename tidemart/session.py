"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import SparkSession

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "tidemart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; `conf` wins over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # a skewed join may be split even where that costs one more shuffle
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def held(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Settings of the session for the queries that run within."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shuffles_freed(spark: SparkSession) -> AbstractContextManager[None]:
    """The shuffle files of the queries that run within go when each has ended.

    Else they stay on the executors' disks until the driver happens to collect its garbage.  For writes, whose
    rows stand elsewhere afterwards.
    """
    return held(spark, {FREE_SHUFFLES: "true"})


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder named by `spark.checkpoint.dir`.

    On a cluster that folder is shared by all executors.  Only a local session may
    fall back to a temporary folder, since all its tasks run on one machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
