"""Idle time-outs: which inputs count as silent, and a stream whose silent input comes back."""

import datetime as dt

from pyspark.sql import functions as F

from tidemart.operators import aggregates as A
from tidemart.session import scratch_dir
from tidemart.streaming import job
from tidemart.streaming.idle import IdleInputs
from tests.helpers import rows


class Recorded(IdleInputs):
    """Heartbeats are noted instead of written."""

    def __init__(self, *names, timeout=5):
        super().__init__(None, "/none", timeout)
        self.latest, self.beats = dict.fromkeys(names), []

    def beat(self, name, at):
        self.beats.append((name, at))


def batch(**newest):
    return {f"rows of {name}": (1, at) for name, at in newest.items()}


def test_a_silent_input_follows_the_slowest_of_the_others():
    inputs = Recorded("busy", "lagging", "silent")
    inputs.follow(batch(busy=900, lagging=100), began=0)
    inputs.follow(batch(busy=950, lagging=200), began=4.9)
    assert inputs.beats == []
    inputs.follow(batch(busy=990, lagging=300), began=5)
    assert inputs.beats == [("silent", 300)]
    inputs.follow(batch(busy=990, lagging=300), began=6)
    assert inputs.beats == [("silent", 300)]
    inputs.follow(batch(busy=990, lagging=400), began=7)
    assert inputs.beats[1:] == [("silent", 400)]


def test_an_input_that_comes_back_counts_again():
    inputs = Recorded("a", "b")
    inputs.follow(batch(a=100), began=0)
    inputs.follow(batch(a=200), began=10)
    inputs.follow(batch(a=300, b=150), began=11)
    inputs.follow(batch(a=400), began=12)
    assert inputs.beats == [("b", 200)]
    inputs.follow(batch(a=500), began=16)
    assert inputs.beats == [("b", 200), ("b", 500)]


def test_all_silent_inputs_follow_the_fastest():
    inputs = Recorded("a", "b", "c")
    inputs.follow(batch(a=100, b=300), began=0)
    assert inputs.follow({}, began=20)
    assert sorted(inputs.beats) == [("a", 300), ("c", 300)]
    assert inputs.follow({"beats of a": (1, 300)}, began=21)
    assert not inputs.follow({"beats of c": (1, 300)}, began=22)


def test_no_rows_at_all_send_nothing():
    inputs = Recorded("a", "b")
    inputs.follow({}, began=0)
    assert not inputs.follow({}, began=100) and inputs.beats == []


def test_rows_of_a_silent_input_count_if_the_watermark_has_not_passed_them(spark):
    start = dt.datetime(2024, 3, 1)
    schema = "name string, row_time timestamp"
    folders = {name: scratch_dir(spark, name) for name in ("busy", "quiet")}

    def put(name, *minutes):
        spark.createDataFrame([(name, start + dt.timedelta(minutes=m)) for m in minutes], schema).coalesce(1).write.mode("append").parquet(folders[name])

    spark.createDataFrame([], schema).write.parquet(folders["quiet"])
    put("busy", 1, 2, 50)
    beats, at, out = (scratch_dir(spark, n) for n in ("beats", "at", "out"))

    def run():
        inputs = IdleInputs(spark, beats, timeout=0.2)
        both = [inputs.add(n, spark.readStream.schema(schema).parquet(f)) for n, f in folders.items()]
        job.stream_settings(spark)
        inputs.start()
        counts = A.window_sum_by_key(both[0].unionByName(both[1]), "10 minutes", ["name"], {"n": F.lit(1)})
        query = job.run_job(counts.select(F.date_format("window.start", "HH:mm").alias("w"), "name", "n"), checkpoint=at, path=out,
                            available_now=False)
        try:
            inputs.await_quiet(query, 120)
        finally:
            query.stop()
            inputs.stop()
        return rows(spark.read.parquet(out))

    assert run() == [("00:00", "busy", 2)]
    put("quiet", 3, 52)  # the first is late by now
    put("busy", 53, 90)
    assert run() == [("00:00", "busy", 2), ("00:50", "busy", 2), ("00:50", "quiet", 1)]
