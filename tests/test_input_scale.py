"""Inputs and logs that grow: no single task, no shuffle of all changes for a small config, logs that take little disk."""

from __future__ import annotations

import glob

from pyspark.sql import functions as F

from tidemart.catalogue.live import in_batches
from tidemart.catalogue.sources_sinks import round_trip
from tidemart.catalogue.stand_ins import Tables
from tidemart.operators import flags, joins as J, routing as R
from tidemart.sinks import messages as M
from tidemart.streaming.job import run_to_end
from tests.test_joins import plan

FOLDER = "/root/testdata/sf0.001"


def test_changes_are_not_shuffled_for_a_small_config_of_unknown_size(spark):
    config = spark.createDataFrame([("order_info", "dim_order", "id", "id", "insert")],
                                   "source_table string, sink_table string, sink_columns string, sink_row_key string, source_type string")
    t = Tables(spark, FOLDER)
    changes = t.order_changes.unionByName(t.cart_changes)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10000")  # less than the changes
    try:
        for routed in (R.route_dim(changes, config), R.route_fact(changes, config)):
            assert "BroadcastHashJoin" in plan(routed) and "hashpartitioning" not in plan(routed)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert R.route_dim(changes, config).count() == t.order_changes.count()


def test_text_logs_are_compressed_files_of_bounded_length(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(M.TEXT_LOG, "maxRecordsPerFile", "40")
    rows = spark.range(0, 100, 1, 1).select(F.concat(F.lit("message "), "id").alias("value"), F.lit("t").alias("topic"))
    M.write_routed(rows, "topic", str(tmp_path / "log"))
    assert len(glob.glob(f"{tmp_path}/log/topic=t/*.gz")) == 3
    read = round_trip(Tables(spark, FOLDER), rows, "scale", position=True)
    assert len(read.inputFiles()) == 3 and all(f.endswith(".gz") for f in read.inputFiles())
    # the place in the log is still the order of the lines
    assert [r.value for r in read.orderBy("position").collect()] == [f"message {i}" for i in range(100)]


def test_carts_are_placed_by_several_tasks_and_a_row_by_one(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = Tables(spark, FOLDER).placed_carts.select(
            F.coalesce("after", "before").alias("image"), F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("at"))
        rows = placed.select(F.col("image")["id"].alias("id"), F.col("image")["sku_num"].cast("int").alias("num"), "task", "at").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(rows) == Tables(spark, FOLDER).lineitem.count() and len({r.task for r in rows}) > 1
    numbers = {}
    for r in sorted(rows, key=lambda r: r["at"]):
        numbers.setdefault(r.id, []).append((r.task, r.num))
    assert all(len({task for task, _ in seen}) == 1 and [n for _, n in seen] == sorted((n for _, n in seen), reverse=True)
               for seen in numbers.values())


def test_a_micro_batch_is_a_whole_table_of_several_files(spark, tmp_path):
    rows = spark.range(0, 100, 1, 4)
    # one of the tables has rows in a single task, one has none
    parts = [rows.where("id < 75"), rows.where("id >= 90"), rows.where("id < 0"), rows.where("id >= 75 and id < 90")]
    stream = in_batches(Tables(spark, FOLDER), "scale-in", *parts)
    assert stream._jdf.isStreaming()
    seen = {}
    run_to_end(stream, checkpoint=str(tmp_path / "at"), sink=lambda df, k: seen.update({k: (df.rdd.getNumPartitions(), sorted(r.id for r in df.collect()))}))
    found = [ids for _, (_, ids) in sorted(seen.items())]
    assert found == [list(range(75)), list(range(90, 100)), [], list(range(75, 90))]
    files = glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/scale-in-*/0/*.parquet")
    assert len(files) == 4


def test_the_second_shuffle_of_deltas_carries_no_tie_columns(spark):
    rows = spark.createDataFrame(
        [("a", 0, 2, 5), ("a", 0, 1, 3), ("a", 0, 3, 4), ("a", 700, 1, 9), ("a", 699, 1, 10), ("b", 5, 1, 7)],
        "id string, secs long, tie_column int, m int").withColumn("at", F.timestamp_seconds("secs")).drop("secs")
    deltas = flags.delta_by_key(rows, ["id"], {"d": "m"}, "at", ["tie_column"]).select("id", "at", "m", "d")
    assert sorted((r.id, r.m, r.d) for r in deltas.collect()) == [
        ("a", 3, 3), ("a", 4, -1), ("a", 5, 2), ("a", 9, -1), ("a", 10, 6), ("b", 7, 7)]
    # what follows the first window, from the top down to it
    second = plan(deltas).split("row_number")[0]
    assert "_inner" in second and "tie_column" not in second


def test_details_are_dealt_by_order_once_for_what_joins_them_by_order(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        detail = spark.createDataFrame([("d1", "o1", 1), ("d2", "o1", 2), ("d3", "o2", 3)], "id string, order_id string, ts long")
        orders = spark.createDataFrame([("o1", "u1")], "id string, user_id string")
        activity = spark.createDataFrame([("d1", "a1")], "id string, activity_id string")
        coupon = spark.createDataFrame([("d2", "c1")], "id string, coupon_id string")
        gone = spark.createDataFrame([("o1", 9)], "id string, ts long")
        cancelled = J.cancel_join(J.order_wide(detail, orders, activity, coupon), gone)
        assert plan(cancelled).count("hashpartitioning(order_id") == 1
        found = cancelled.select("id", "user_id", "activity_id", "coupon_id", "ts").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(map(tuple, found)) == [("d1", "u1", "a1", None, 9), ("d2", "u1", None, "c1", 9)]
