"""Batch forms of the keyed operators against the row-by-row rule in plain Python."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemart.operators import flags
from tests.helpers import rows

START = dt.datetime(2024, 3, 1)
SCHEMA = "id int, key string, row_time timestamp, is_new string, v decimal(18,2)"


@pytest.fixture(scope="module")
def data():
    """Many short histories and one key that holds a third of all rows."""
    rnd = random.Random(11)
    out = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else f"k{rnd.randrange(250)}"
        when = START + dt.timedelta(seconds=rnd.choice([0, 1, 600, 86_399, 86_400]) + rnd.randrange(12) * 86_400 * rnd.randrange(2)
                                    + rnd.randrange(0, 40_000))
        out.append((i, key, when, rnd.choice(["0", "1", "1", None]), rnd.randrange(1000)))
    return out


def fold(data, step):
    """Apply `step(state, row) -> (state, result)` per key in event order."""
    state, out = {}, {}
    for row in sorted(data, key=lambda r: (r[2], r[0])):
        state[row[1]], out[row[0]] = step(state.get(row[1]), row)
    return out


@pytest.fixture
def frame(spark, data):
    return spark.createDataFrame([(*r[:4], r[4]) for r in data], SCHEMA.replace("decimal(18,2)", "int")).withColumn(
        "v", F.col("v").cast("decimal(18,2)"))


def collected(df, column):
    return {r["id"]: r[column] for r in df.collect()}


def test_first_of_day(frame, data):
    want = fold(data, lambda s, r: (r[2].date(), int(s != r[2].date())))
    assert collected(flags.first_of_day(frame, ["key"], "row_time", ["id"]), "is_first") == want


def test_first_ever(frame, data):
    want = fold(data, lambda s, r: (True, int(s is None)))
    assert collected(flags.first_ever(frame, ["key"], "row_time", ["id"]), "is_first") == want


@pytest.mark.parametrize("slot", [60, 600, 10**9])
def test_slot_width_does_not_matter(frame, data, slot):
    want = fold(data, lambda s, r: (r[2].date(), int(s != r[2].date())))
    assert collected(flags.first_of_day(frame, ["key"], "row_time", ["id"], slot=slot), "is_first") == want
    deltas = fold(data, lambda s, r: (r[4], r[4] - (s or 0)))
    got = collected(flags.delta_by_key(frame, ["key"], {"d": "v"}, "row_time", ["id"], slot=slot), "d")
    assert {k: int(v) for k, v in got.items()} == deltas


@pytest.mark.parametrize("only_if_empty", [False, True])
def test_repair_new_flag(frame, data, only_if_empty):
    def step(stored, row):
        day, flag = row[2].date(), row[3]
        if flag == "1":
            if stored is None:
                return day, "1"
            return stored, "0" if stored != day else "1"
        if flag == "0" and not (only_if_empty and stored is not None):
            return day - dt.timedelta(days=1), "0"
        return stored, flag
    got = flags.repair_new_flag(frame, "key", "row_time", F.col("is_new"), ["id"], only_if_empty)
    assert collected(got, "is_new_fixed") == fold(data, step)
    assert got.columns == [*frame.columns, "is_new_fixed"]


def test_repair_needs_no_tie_break(frame, data):
    """With distinct times the time alone orders the rows."""
    spread = frame.withColumn("row_time", F.col("row_time") + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)") / 10000))
    with_tie = flags.repair_new_flag(spread, "key", "row_time", F.col("is_new"), ["id"])
    without = flags.repair_new_flag(spread, "key", "row_time", F.col("is_new"))
    assert collected(with_tie, "is_new_fixed") == collected(without, "is_new_fixed")


def test_deltas_sum_to_the_last_value(frame, data):
    deltas = flags.delta_by_key(frame, ["key"], {"d": "v"}, "row_time", ["id"])
    last = {}
    for r in sorted(data, key=lambda r: (r[2], r[0])):
        last[r[1]] = r[4]
    assert {r["key"]: int(r["s"]) for r in deltas.groupBy("key").agg(F.sum("d").alias("s")).collect()} == last


def test_deltas_forget_old_values(frame, data):
    ttl = 3600
    def step(s, r):
        fresh = s is not None and (r[2] - s[0]).total_seconds() < ttl
        return (r[2], r[4]), r[4] - (s[1] if fresh else 0)
    got = collected(flags.delta_by_key(frame, ["key"], {"d": "v"}, "row_time", ["id"], ttl_seconds=ttl), "d")
    assert {k: int(v) for k, v in got.items()} == fold(data, step)


def test_null_measure_counts_as_zero_before_it(spark):
    df = spark.createDataFrame([(1, "a", START, None), (2, "a", START + dt.timedelta(days=1), 5)],
                               "id int, key string, row_time timestamp, v int")
    assert collected(flags.delta_by_key(df, ["key"], {"d": "v"}, "row_time", ["id"]), "d") == {1: None, 2: 5}


def test_active_days_equal_distinct_days(frame, data):
    days = defaultdict(set)
    for r in data:
        days[r[1]].add(r[2].date())
    got = flags.new_and_active(frame, ["key"], "row_time").groupBy("key").agg(
        F.sum("is_active").alias("a"), F.sum("is_first_day").alias("n"))
    assert {r["key"]: (r.a, r.n) for r in got.collect()} == {k: (len(v), 1) for k, v in days.items()}


@pytest.mark.parametrize("gap,back", [(7, 0), (8, 1)])
def test_returning_after_more_than_seven_days(spark, gap, back):
    late = START + dt.timedelta(hours=23)
    df = spark.createDataFrame([("u", late), ("u", START + dt.timedelta(days=gap))], "uid string, row_time timestamp")
    assert rows(flags.returning_user(df, ["uid"], "row_time").select("day", "back"))[1][1] == back


def test_pages_are_counted_per_device_page_and_day(spark):
    hour = lambda h: START + dt.timedelta(hours=h)
    df = spark.createDataFrame(
        [("m", "home", hour(1)), ("m", "home", hour(2)), ("m", "good_detail", hour(3)), ("m", "cart", hour(4)),
         ("m", "home", hour(25))], "mid string, page_id string, row_time timestamp")
    got = flags.page_first_of_day(df, "mid", "page_id", "row_time")
    assert rows(got.select("page_id", "row_time")) == [
        ("good_detail", hour(3)), ("home", hour(1)), ("home", hour(25))]


def test_kept_columns_come_from_the_first_row(spark):
    df = spark.createDataFrame([("m", START + dt.timedelta(hours=2), "z"), ("m", START + dt.timedelta(hours=1), "y")],
                               "mid string, row_time timestamp, ch string")
    assert flags.active_days(df, ["mid"], "row_time", keep=["ch"]).first()["ch"] == "y"
