import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from tidemart.operators import aggregates as A, joins as J
from tests.helpers import at, rows


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def orders_and_payments(spark, offsets, key="o1"):
    left = spark.createDataFrame([(key, at(100))], "order_id string, row_time timestamp")
    right = spark.createDataFrame(
        [(key, at(100 + s), s) for s in offsets], "order_id string, pay_time timestamp, s double")
    return left, right


def test_interval_bounds_are_inclusive(spark):
    left, right = orders_and_payments(spark, [-16.0, -15.001, -15.0, -3.5, 0.0, 5.0, 5.001, 6.0])
    got = J.interval_join(left, right, "order_id", "row_time", "pay_time")
    assert sorted(r.s for r in got.collect()) == [-15.0, -3.5, 0.0, 5.0]


def test_interval_with_an_open_end(spark):
    left, right = orders_and_payments(spark, [-16.0, -15.0, 900.0])
    got = J.interval_join(left, right, "order_id", "row_time", "pay_time", upper=None)
    assert sorted(r.s for r in got.collect()) == [-15.0, 900.0]


def test_interval_join_equals_brute_force_on_a_hot_key(spark):
    """One key holds most rows on both sides; every slot boundary is crossed."""
    import random
    rnd = random.Random(3)
    left = [(rnd.choice("aaab"), i, at(rnd.uniform(0, 400))) for i in range(300)]
    right = [(rnd.choice("aaab"), i, at(rnd.uniform(0, 400))) for i in range(300)]
    l = spark.createDataFrame(left, "k string, i int, lt timestamp")
    r = spark.createDataFrame(right, "k string, j int, rt timestamp")
    got = J.interval_join(l, r, "k", "lt", "rt").select("i", "j")
    want = sorted(
        (i, j) for k, i, lt in left for k2, j, rt in right
        if k == k2 and -15 <= (rt - lt).total_seconds() <= 5)
    assert sorted(tuple(x) for x in got.collect()) == want and len(want) > 1000


def test_cancel_join_takes_the_cancellations_time(spark):
    detail = spark.createDataFrame([("d1", "o1", 5)], "id string, order_id string, ts bigint")
    cancelled = spark.createDataFrame([("o1", "2024", 9), ("o2", "2024", 9)], "id string, operate_time string, ts bigint")
    assert J.cancel_join(detail, cancelled).first().asDict() == {
        "id": "d1", "order_id": "o1", "operate_time": "2024", "ts": 9}


def test_left_joins_keep_details_without_activity_or_coupon(spark):
    detail = spark.createDataFrame([("d1", "o1"), ("d2", "o1"), ("d3", "o9")], "id string, order_id string")
    orders = spark.createDataFrame([("o1", "u1")], "id string, user_id string")
    activity = spark.createDataFrame([("d1", "a")], "id string, activity_id string")
    coupon = spark.createDataFrame([("d2", "c")], "id string, coupon_id string")
    got = J.order_wide(detail, orders, activity, coupon)
    assert rows(got.select("id", "activity_id", "coupon_id")) == [("d1", "a", None), ("d2", None, "c")]


def dictionary(spark):
    return spark.createDataFrame([("1", ("one",)), ("2", ("two",))], "rowkey string, info struct<dic_name string>")


def test_lookups_drop_and_enrichment_keeps_misses(spark):
    df = spark.createDataFrame([("a", "1"), ("b", "3"), ("c", None)], "id string, code string")
    hit = J.lookup_join(df, dictionary(spark), "code", {"dic_name": "info.dic_name"})
    assert rows(hit) == [("a", "1", "one")]
    kept = J.enrich(df, dictionary(spark), "code", {"name": "info.dic_name"}, "rowkey")
    assert rows(kept.select("id", "name")) == [("a", "one"), ("b", None), ("c", None)]


def test_two_roles_of_one_dictionary(spark):
    df = spark.createDataFrame([("1", "2"), ("1", "9")], "t string, r string")
    got = J.lookup_join_twice(df, dictionary(spark), "t", "r", ("type_name", "reason_name"))
    assert rows(got) == [("1", "2", "one", "two")]


def test_product_chain_keeps_facts_and_stops_at_a_miss(spark):
    dims = {
        "dim_sku_info": spark.createDataFrame([("s1", "p1", "c31", "t1"), ("s2", "p9", "c39", "t9")],
                                              "id string, spu_id string, category3_id string, tm_id string"),
        "dim_spu_info": spark.createDataFrame([("p1", "spu")], "id string, spu_name string"),
        "dim_base_trademark": spark.createDataFrame([("t1", "tm")], "id string, tm_name string"),
        "dim_base_category3": spark.createDataFrame([("c31", "three", "c21")], "id string, name string, category2_id string"),
        "dim_base_category2": spark.createDataFrame([("c21", "two", "c11")], "id string, name string, category1_id string"),
        "dim_base_category1": spark.createDataFrame([("c11", "one")], "id string, name string"),
    }
    df = spark.createDataFrame([("s1",), ("s2",), ("s3",)], "sku_id string")
    got = {r.sku_id: r for r in J.enrich_product_chain(df, dims).collect()}
    assert (got["s1"].category1_name, got["s1"].category2_id, got["s1"].trademark_name) == ("one", "c21", "tm")
    assert (got["s2"].spu_id, got["s2"].spu_name, got["s2"].category2_id) == ("p9", None, None)
    assert got["s3"].spu_id is None and len(got) == 3


def test_map_join_broadcasts_only_below_its_size_bound(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big, small = spark.range(1000), spark.range(50)
        assert "BroadcastHashJoin" in plan(J.map_join(big, small, "id", max_bytes=400))
        beyond = J.map_join(big, small, "id", max_bytes=399)
        assert "BroadcastHashJoin" not in plan(beyond) and beyond.count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_skewed_join_partitions_are_split(spark):
    """A key with most of the rows: adaptive execution splits its partition, rows stay whole."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10kb",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "32",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        detail = spark.range(0, 60_000, 1, 8).select(
            F.col("id").cast("string").alias("id"),
            F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("order_id"))
        orders = spark.createDataFrame([("hot", "u")], "id string, user_id string").unionByName(
            spark.range(0, 60_000, 3).select(F.col("id").cast("string").alias("id"), F.lit("u").alias("user_id")))
        got = J.order_wide(detail, orders)
        assert len(got.collect()) == 60_000
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# ---- aggregation -----------------------------------------------------------------------

def test_windows_are_epoch_aligned_and_stamped(spark):
    df = spark.createDataFrame([(at(0), 1), (at(4.999), 2), (at(5), 4)], "row_time timestamp, n int")
    got = A.stamp_window(A.window_sum_global(df, "5 seconds", {"n": "n"}), cur_date="window")
    assert rows(got) == [
        ("2024-03-01 08:00:00", "2024-03-01 08:00:05", "2024-03-01", 3),
        ("2024-03-01 08:00:05", "2024-03-01 08:00:10", "2024-03-01", 4)]
    assert A.stamp_window(A.window_sum_global(df, "5 seconds", {"n": "n"}), cur_date="none").columns == ["stt", "edt", "n"]
    with pytest.raises(ValueError):
        A.stamp_window(A.window_sum_global(df, "5 seconds", {"n": "n"}), cur_date="sometimes")


def test_distinct_ignores_nulls_and_repeats(spark):
    data = [(at(1), "p", "o1", 1), (at(2), "p", "o1", 2), (at(3), "p", "o2", 3), (at(4), "p", None, 4), (at(6), "p", "o1", 5)]
    df = spark.createDataFrame(data, "row_time timestamp, province string, order_id string, amount int")
    got = A.window_distinct(df, "5 seconds", ["province"], "order_id", "orders", {"amount": "amount"})
    assert rows(got.select("orders", "amount")) == [(1, 5), (2, 10)]


def test_latest_per_key_keeps_nulls_of_the_latest_row(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 1, "y")], "k string, ts int, v string")
    assert rows(A.latest_per_key(df, ["k"], ["ts"])) == [("a", 2, None), ("b", 1, "y")]


def test_salted_count_counts_rows_of_a_hot_key(spark):
    df = spark.range(3000).withColumn("region", F.when(F.col("id") % 3 == 0, "huabei").otherwise(F.concat(F.lit("r"), F.col("id") % 7)))
    want = {r.region: r["count"] for r in df.groupBy("region").count().collect()}
    assert {r.region: r.cnt for r in A.salted_count(df, "region", "id").collect()} == want
    by_prefix = {r.re: r.cnt for r in A.salted_count(df, "region", "id", prefix_length=1).collect()}
    assert by_prefix == {"h": 1000, "r": 2000}
