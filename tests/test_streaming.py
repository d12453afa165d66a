"""Streams against their batch twins: several files, one micro-batch each, and a late sentinel."""

import datetime as dt
import random
from unittest import mock

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemart.operators import aggregates as A, flags
from tidemart.plans import facts, routes, summaries as S
from tidemart.session import scratch_dir
from tidemart.sinks import keyed, messages as M
from tidemart.sources import messages as SM
from tidemart.streaming import job, state
from tests.helpers import BASE_MS, log_record, rows

START = dt.datetime(2024, 3, 1, 22, 0, 0)
SENTINEL = dt.datetime(2030, 1, 1)


def write_in_order(spark, df, folder, parts, order, fmt="parquet"):
    """One folder entry per part, oldest first, so that the file stream reads them in order."""
    import time
    for part in range(parts):
        df.where(F.col("_part") == part).drop("_part").coalesce(1).sortWithinPartitions(*order).write.mode("append").format(fmt).save(folder)
        time.sleep(0.05)


def read_stream(spark, folder, schema, fmt="parquet"):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).format(fmt).load(folder)


def finish(spark, df):
    job.stream_settings(spark)
    out = scratch_dir(spark, "out")
    job.run_to_end(df, checkpoint=scratch_dir(spark, "at"), path=out)
    return spark.read.schema(df.schema).parquet(out)


PARTS = 3


@pytest.fixture(scope="module")
def detail_data():
    """Order details over three days, in time order over three files, ids sent again."""
    rnd = random.Random(5)
    out = []
    times = sorted(START + dt.timedelta(seconds=rnd.randrange(2 * 86_400)) for _ in range(240))
    for i, when in enumerate(times):
        user = "u0" if i % 3 == 0 else f"u{rnd.randrange(12)}"
        out.append((f"d{rnd.randrange(60)}", f"o{rnd.randrange(80)}", f"s{rnd.randrange(5)}", f"sku {i % 5}", user,
                    f"p{rnd.randrange(3)}", f"{rnd.randrange(1, 99)}.50", str(rnd.randrange(1, 5)),
                    str(rnd.randrange(5)), str(rnd.randrange(5)), f"{rnd.randrange(1, 999)}.25", when, i, i * PARTS // 240))
    out.append(("end", "end", "s0", "sku", "end", "p0", "1", "1", "0", "0", "1", SENTINEL, 10**6, PARTS - 1))
    return out


COLUMNS = ("id string, order_id string, sku_id string, sku_name string, user_id string, province_id string, order_price string, "
           "sku_num string, split_activity_amount string, split_coupon_amount string, split_total_amount string, row_time timestamp, "
           "seq int, _part int")


@pytest.fixture(scope="module")
def details(spark, detail_data):
    df = spark.createDataFrame(detail_data, COLUMNS)
    folder = scratch_dir(spark, "details")
    write_in_order(spark, df, folder, PARTS, ["row_time"])
    batch = spark.read.parquet(folder)
    return batch, lambda: job.watermark(read_stream(spark, folder, batch.schema))


def closed(df, column="stt"):
    return rows(df.where(F.col(column) < "2029"))


def product_dims(spark):
    ids = [(f"s{i}", f"p{i}", f"c{i % 2}", f"t{i % 3}") for i in range(4)]
    return {
        "dim_sku_info": spark.createDataFrame(ids, "id string, spu_id string, category3_id string, tm_id string"),
        "dim_spu_info": spark.createDataFrame([(f"p{i}", f"spu {i}") for i in range(4)], "id string, spu_name string"),
        "dim_base_trademark": spark.createDataFrame([(f"t{i}", f"tm {i}") for i in range(3)], "id string, tm_name string"),
        "dim_base_category3": spark.createDataFrame([("c0", "c 0", "b0"), ("c1", "c 1", "b0")], "id string, name string, category2_id string"),
        "dim_base_category2": spark.createDataFrame([("b0", "b 0", "a0")], "id string, name string, category1_id string"),
        "dim_base_category1": spark.createDataFrame([("a0", "a 0")], "id string, name string"),
    }


def provinces(spark):
    return spark.createDataFrame([("p0", "north"), ("p1", "south")], "id string, name string")


HOUR = "1 hour"
JOBS = {
    "orders": lambda spark, df: S.order_user_window(df, HOUR, "window"),
    "payments": lambda spark, df: S.payment_user_window(df, HOUR, "window"),
    "carts": lambda spark, df: S.cart_user_window(df, HOUR, "window"),
    "registrations": lambda spark, df: S.register_window(df, HOUR, "window"),
    "skus": lambda spark, df: S.sku_order_window(df, product_dims(spark), HOUR, ["seq"], cur_date="window"),
    "provinces": lambda spark, df: S.province_order_window(df, provinces(spark), HOUR, ["seq"], cur_date="window"),
    "refunds": lambda spark, df: S.refund_window(df, product_dims(spark), HOUR, "window"),
    "shops": lambda spark, df: S.shop_window(df, provinces(spark), "seq", "10 seconds", "window"),
}


@pytest.mark.parametrize("name", JOBS)
def test_summary_stream_equals_batch(spark, details, name):
    batch, stream = details
    want = closed(JOBS[name](spark, batch))
    assert closed(finish(spark, JOBS[name](spark, stream()))) == want and want


@pytest.fixture(scope="module")
def page_log(spark):
    rnd = random.Random(8)
    records, parts = [], []
    times = sorted(rnd.randrange(12 * 86_400_000) for _ in range(300))
    for i, t in enumerate(times):
        device = "m0" if i % 3 == 0 else f"m{rnd.randrange(9)}"
        page = {"page_id": rnd.choice(["home", "good_detail", "cart"]), "last_page_id": rnd.choice([None, "login", "search", "home"]),
                "during_time": rnd.randrange(1000), "item": rnd.choice(["red ring", "Red, ring red", None]),
                "item_type": rnd.choice(["keyword", "sku_id"])}
        common = {"uid": device.replace("m", "u"), "sid": f"{device}-{t // 3_600_000}", "vc": rnd.choice("ab"), "is_new": rnd.choice("01")}
        records.append(log_record(mid=device, ts=BASE_MS + t, page=page, common=common))
        parts.append(i * PARTS // 300)
    # filters move below the watermark, so each job needs an end row that passes its own filter
    search = {"page_id": "home", "last_page_id": "home", "item_type": "keyword", "item": "end"}
    for page in ({"page_id": "home"}, search):
        records.append(log_record(mid="end", ts=BASE_MS + 10**12, page=page))
        parts.append(PARTS - 1)
    import json
    values = spark.createDataFrame([(json.dumps(r), p) for r, p in zip(records, parts)], "value string, _part int")
    folder = scratch_dir(spark, "log")
    write_in_order(spark, values, folder, PARTS, ["value"], "text")
    return folder


def page_frames(spark, folder):
    schema = "value string"
    as_pages = lambda df: routes.clean_log(df).where(F.col("page").isNotNull())
    return as_pages(spark.read.text(folder)), job.watermark(as_pages(read_stream(spark, folder, schema, "text")))


PAGE_JOBS = {
    "traffic": lambda df: S.traffic_window(df, HOUR, "window"),
    "visitors": lambda df: S.page_visitor_window(df, HOUR, "window"),
    "logins": lambda df: S.login_window(df, HOUR, 3, "window"),
    "keywords": lambda df: S.keyword_window(
        df.select(F.from_json(F.to_json("page"), "map<string,string>").alias("page"), "row_time"), HOUR, "window"),
}


@pytest.mark.parametrize("name", PAGE_JOBS)
def test_page_stream_equals_batch(spark, page_log, name):
    batch, stream = page_frames(spark, page_log)
    column = "window_start" if name == "keywords" else "stt"
    want = closed(PAGE_JOBS[name](batch), column)
    assert closed(finish(spark, PAGE_JOBS[name](stream)), column) == want and want


def test_traffic_stream_reads_its_input_once_and_forgets_sessions(spark, page_log):
    """One scan gives visitors, sessions and views; days later only the last rows have state."""
    stream = S.traffic_window(page_frames(spark, page_log)[1], HOUR, "window")
    assert stream._jdf.queryExecution().analyzed().toString().count("StreamingRelation") == 1
    job.stream_settings(spark)
    query = job.run_job(stream, checkpoint=scratch_dir(spark, "at"), path=scratch_dir(spark, "out"))
    query.awaitTermination()
    held = [max(o["numRowsTotal"] for o in p["stateOperators"] if o["operatorName"].startswith("transformWithState"))
            for p in query.recentProgress if p["stateOperators"]]
    assert held[-1] < max(held)


def test_traffic_stream_counts_null_sessions_durations_and_dims(spark):
    start = dt.datetime(2024, 3, 1, 10)
    at = lambda hours: start + dt.timedelta(hours=hours)
    items = [("m1", "s1", "a", at(0), 5, 0), ("m1", "s1", "a", at(0.1), None, 0), ("m2", None, None, at(0.2), 7, 0), (None, "s9", "a", at(0.2), 1, 0),
             ("m1", "s1", "a", at(1), 2, 1), ("m1", "s1", "a", at(60), 3, 2), ("m1", "s2", "a", at(60), 3, 2), ("end", None, "a", SENTINEL, 0, 2)]
    df = spark.createDataFrame(items, "mid string, sid string, vc string, row_time timestamp, spent long, _part int")
    folder = scratch_dir(spark, "traffic")
    write_in_order(spark, df, folder, 3, ["row_time"])
    stream = job.watermark(read_stream(spark, folder, df.drop("_part").schema))
    parts = state.traffic(stream, "mid", "sid", ["vc"], "spent", HOUR, ttl_seconds=86_400)
    got = finish(spark, A.stamp_window(A.window_sum_by_key(parts, HOUR, ["vc"], {m: m for m in state.TRAFFIC}), cur_date="none"))
    # the session s1 was silent for longer than its state lasts, so it counts again
    assert closed(got.select("stt", "vc", *state.TRAFFIC)) == rows(spark.createDataFrame([
        ("2024-03-01 10:00:00", "a", 1, 2, 3, 6), ("2024-03-01 10:00:00", None, 1, 0, 1, 7), ("2024-03-01 11:00:00", "a", 0, 0, 1, 2),
        ("2024-03-03 22:00:00", "a", 1, 2, 2, 6)], "stt string, vc string, a long, b long, c long, d long"))


def test_traffic_state_has_buckets_not_keys(spark):
    """Three thousand visitors and as many sessions, seen twice: every one counts once, and state rows are bounded by the buckets."""
    start = dt.datetime(2024, 3, 1, 10)
    items = [(f"m{i}", f"s{i}", "a", start + dt.timedelta(seconds=i % 600 + 900 * part), 1, part) for i in range(3000) for part in (0, 1)]
    items.append(("end", None, "a", SENTINEL, 0, 2))
    df = spark.createDataFrame(items, "mid string, sid string, vc string, row_time timestamp, spent long, _part int")
    folder = scratch_dir(spark, "traffic")
    write_in_order(spark, df, folder, 3, ["row_time"])
    stream = job.watermark(read_stream(spark, folder, df.drop("_part").schema))
    parts = state.traffic(stream, "mid", "sid", ["vc"], "spent", HOUR, ttl_seconds=86_400)
    sums = A.stamp_window(A.window_sum_by_key(parts, HOUR, ["vc"], {m: m for m in state.TRAFFIC}), cur_date="none")
    job.stream_settings(spark)
    out = scratch_dir(spark, "out")
    query = job.run_job(sums, checkpoint=scratch_dir(spark, "at"), path=out)
    query.awaitTermination()
    held = max(o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"] if o["operatorName"].startswith("transformWithState"))
    assert 0 < held <= 2 * state.BUCKETS < 6000
    got = spark.read.schema(sums.schema).parquet(out)
    assert closed(got.select("stt", *state.TRAFFIC)) == [("2024-03-01 10:00:00", 3000, 3000, 6000, 6000)]


class FakeList:
    """A list state in memory that also stands for the handle."""

    def __init__(self):
        self.items, self.timers = [], []

    getListState = lambda self, *_: self
    get = lambda self: iter(list(self.items))
    put = lambda self, values: self.items.__setitem__(slice(None), values)
    appendValue = lambda self, value: self.items.append(value)
    clear = lambda self: self.items.clear()
    registerTimer = lambda self, at: self.timers.append(at)


def test_traffic_changes_are_merged_and_expire():
    """Fifty micro-batches on one bucket: long lists are merged, sessions count once, and silent ones are forgotten."""
    inputs = [state.KIND, state.BUCKET, state.KEY, "vc", "row_time", state.US, state.DAY, state.LAST, "pv_ct", "dur_sum"]
    hour = 3_600_000
    processor, store = state._Traffic(inputs, "row_time", ["vc"], 24 * hour), FakeList()
    processor.init(store)
    times = lambda now: mock.Mock(getCurrentWatermarkInMs=lambda: now)
    counted = 0
    for i in range(50):
        at = i * 60_000
        frame = pd.DataFrame([(state.SESSION, 0, k, "a", None, at * 1000, 0, at, 0, 0) for k in ("old", f"new{i}")])
        counted += sum(int(f["sv_ct"].sum()) for f in processor.handleInputRows((state.SESSION, 0), iter([frame]), times(0)))
        assert 0 < len(store.items) <= state.CHANGES + 1
    assert counted == 51 and len(store.timers) == 1 and len(processor.load()[0]) == 51
    watermark = 24 * hour + 30 * 60_000
    list(processor.handleExpiredTimer((state.SESSION, 0), times(watermark), None))
    assert set(processor.load()[0]) == {"old", *(f"new{i}" for i in range(31, 50))} and len(store.timers) == 2
    list(processor.handleExpiredTimer((state.SESSION, 0), times(48 * hour), None))
    assert not store.items and len(store.timers) == 2


def test_log_split_stream_equals_batch(spark, page_log):
    want = rows(routes.log_split(spark.read.text(page_log)))
    out = scratch_dir(spark, "topics")
    job.stream_settings(spark)
    stream = read_stream(spark, page_log, "value string", "text")
    job.run_to_end(stream, routes.log_split, checkpoint=scratch_dir(spark, "at"), sink=M.batch_writer(out))
    assert rows(spark.read.text(out).select("topic", "value")) == want


def test_states_of_earlier_files_are_kept(spark, details):
    batch, stream = details
    want = rows(flags.active_days(batch, ["user_id"], "row_time").select("user_id", "row_time"))
    assert rows(finish(spark, state.active_days(stream(), ["user_id"])).select("user_id", "row_time")) == want
    firsts = rows(A.first_per_key(batch, ["user_id"], ["row_time"]))
    assert rows(finish(spark, state.first_ever(stream(), ["user_id"])).select("user_id", "row_time")) == firsts


def test_expiry_stream_equals_batch(spark, details):
    batch, stream = details
    money = lambda df: df.withColumn("v", F.col("split_total_amount").cast("decimal(18,2)"))
    ttl = 6 * 3600
    want = flags.delta_by_key(money(batch), ["id"], {"d": "v"}, "row_time", ["seq"], ttl_seconds=ttl).select("seq", "d")
    got = state.delta_by_key(money(stream()), ["id"], {"d": "v"}, tie=["seq"], ttl_seconds=ttl).select("seq", "d")
    assert rows(finish(spark, got)) == rows(want)


@pytest.mark.parametrize("name", ["Asia/Shanghai", "America/New_York"])
def test_keyed_state_keeps_times_in_any_session_zone(spark, details, zone, name):
    zone(name)
    batch, stream = details
    want = rows(flags.active_days(batch, ["user_id"], "row_time").select("user_id", F.unix_micros("row_time")))
    got = finish(spark, state.active_days(stream(), ["user_id"]))
    assert rows(got.select("user_id", F.unix_micros("row_time"))) == want


def test_late_rows_across_midnight_count_once(spark):
    """A row of yesterday, late by less than the watermark delay, neither counts today again nor is lost."""
    midnight = dt.datetime(2024, 3, 2)
    second = dt.timedelta(seconds=1)
    first = [("a", midnight + second), ("b", midnight + second), ("a", midnight - 3600 * second)]
    second_file = [("a", midnight - second), ("b", midnight - second), ("a", midnight + 2 * second)]
    df = spark.createDataFrame([(*r, 0) for r in first] + [(*r, 1) for r in second_file], "k string, row_time timestamp, _part int")
    folder = scratch_dir(spark, "late")
    write_in_order(spark, df, folder, 2, ["row_time"])
    stream = job.watermark(read_stream(spark, folder, "k string, row_time timestamp"))
    got = rows(finish(spark, state.active_days(stream, ["k"])).select("k", "row_time"))
    assert got == sorted([("a", midnight - 3600 * second), ("a", midnight + second), ("b", midnight - second), ("b", midnight + second)])


def test_order_detail_stream_joins_within_a_bound(spark):
    """Left joins emit once, after the watermark has passed, with or without a match."""
    items = [
        ("order_info", {"id": "o1", "user_id": "u1", "province_id": "p1"}, 100, 0),
        ("order_detail", {"id": "d1", "order_id": "o1", "sku_id": "s1"}, 100, 0),
        ("order_detail", {"id": "d2", "order_id": "o1", "sku_id": "s2"}, 100, 0),
        ("order_detail_activity", {"order_detail_id": "d1", "activity_id": "a1", "activity_rule_id": "r1"}, 160, 1),
        ("order_detail_coupon", {"order_detail_id": "d2", "coupon_id": "c1"}, 170, 1),
        *[(t, {"id": "end", "order_id": "end", "order_detail_id": "end"}, 10**6, 2)
          for t in ("order_info", "order_detail", "order_detail_activity", "order_detail_coupon")],
    ]
    import json
    value = lambda t, data, ts: json.dumps({"database": "shop", "table": t, "type": "insert", "ts": ts, "data": data})
    df = spark.createDataFrame([(value(t, d, ts), p) for t, d, ts, p in items], "value string, _part int")
    folder = scratch_dir(spark, "db")
    write_in_order(spark, df, folder, 3, ["value"], "text")
    stream = SM.change_stream(read_stream(spark, folder, "value string", "text"))
    got = finish(spark, facts.order_detail(stream, "shop", within=3600))
    assert rows(got.where("id != 'end'").select("id", "user_id", "activity_id", "coupon_id")) == [
        ("d1", "u1", "a1", None), ("d2", "u1", None, "c1")]


def test_refund_streams_equal_batch(spark):
    """Refunds and refund payments join other changes of one log, at most an hour apart."""
    import json
    def item(table, ts, part, data, old=None):
        row = {"database": "shop", "table": table, "type": "update" if old else "insert", "ts": ts, "data": data, "old": old}
        return json.dumps(row), part
    items = []
    for i in range(20):
        order, t = f"o{i}", 1000 + 40 * i
        items += [
            item("order_info", t, 0, {"id": order, "user_id": f"u{i}", "province_id": "p", "order_status": "1005"}, {"order_status": "1002"}),
            item("order_refund_info", t + 30, 0, {"id": f"r{i}", "user_id": f"u{i}", "order_id": order, "sku_id": "s", "refund_type": str(i % 3),
                 "refund_reason_type": "1", "refund_num": "1", "create_time": "2024-03-01 10:00:00"}),
            item("order_info", t + 60, 1, {"id": order, "user_id": f"u{i}", "province_id": "p", "order_status": "1006"}, {"order_status": "1005"}),
            item("order_refund_info", t + 70, 1, {"order_id": order, "sku_id": "s", "refund_num": "1", "refund_status": "0705"}, {"refund_status": "0701"}),
            item("refund_payment", t + 90, 1, {"id": f"q{i}", "order_id": order, "sku_id": "s" if i % 2 else "x", "payment_type": "1",
                 "callback_time": "2024-03-02 10:00:00", "total_amount": "5", "refund_status": "1602"}, {"refund_status": "1601"}),
        ]
    df = spark.createDataFrame(items, "value string, _part int")
    folder = scratch_dir(spark, "db")
    write_in_order(spark, df, folder, 2, ["value"], "text")
    dic = spark.createDataFrame([("0", ("zero",)), ("1", ("one",))], "rowkey string, info struct<dic_name string>")
    for fact, expected in ((facts.order_refund, 14), (facts.refund_payment, 10)):
        want = rows(fact(SM.change_stream(spark.read.text(folder)), dic, "shop"))
        stream = SM.change_stream(read_stream(spark, folder, "value string", "text"))
        assert rows(finish(spark, fact(stream, dic, "shop", within=3600))) == want and len(want) == expected


def test_dimension_stream_writes_every_batch_once(spark, tmp_path):
    """Config is read again in every micro-batch; the dimension folds all of them."""
    import json
    value = lambda i, name, ts, type_="insert": json.dumps(
        {"database": "shop", "table": "t", "type": type_, "ts": ts, "data": {"id": i, "name": name}})
    df = spark.createDataFrame(
        [(value("1", "a", 1), 0), (value("2", "b", 1), 0), (value("1", "c", 2), 1), (value("2", "b", 3, "delete"), 1)],
        "value string, _part int")
    folder, out = scratch_dir(spark, "db"), str(tmp_path / "dims")
    write_in_order(spark, df, folder, 2, ["value"], "text")
    config_path = str(tmp_path / "config")
    spark.createDataFrame([("t", "dim_t", "id,name", "id")],
                          "source_table string, sink_table string, sink_columns string, sink_row_key string").write.parquet(config_path)
    def sink(batch, batch_id):
        config = batch.sparkSession.read.parquet(config_path)
        keyed.dim_upsert(routes.dim_rows(batch, config, "shop"), out, batch_id)
    stream = SM.change_stream(read_stream(spark, folder, "value string", "text"))
    job.run_to_end(stream, checkpoint=scratch_dir(spark, "at"), sink=sink)
    assert rows(keyed.read_dim(spark, out, "dim_t", ["name"])) == [("1", "c")]


def test_a_fastest_input_watermark_is_refused_for_joined_streams(spark, tmp_path):
    spark.range(3).selectExpr("id", "timestamp_seconds(id) AS row_time").write.parquet(str(tmp_path / "in"))
    side = lambda: spark.readStream.schema("id long, row_time timestamp").parquet(str(tmp_path / "in")).withWatermark("row_time", "1 second")
    joined = side().join(side().withColumnsRenamed({"id": "b", "row_time": "t"}), F.expr("id = b AND t = row_time"))
    job.stream_settings(spark, ignore_idle=True)
    try:
        with pytest.raises(ValueError, match="join of streams"):
            job.run_job(joined, checkpoint=scratch_dir(spark, "at"), path=scratch_dir(spark, "out"))
        lookup = side().join(spark.range(2), "id")
        job.run_to_end(lookup, checkpoint=scratch_dir(spark, "at"), path=scratch_dir(spark, "out"))
    finally:
        job.stream_settings(spark)
