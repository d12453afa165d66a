"""What sinks and joins leave on disk: wide rows shuffled once, and no shuffle kept after its write."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from tidemart.operators import aggregates as A, joins as J
from tidemart.plans import landing, routes
from tidemart.session import FREE_SHUFFLES, shuffles_freed
from tidemart.sinks import keyed, versioned
from tests.helpers import debezium, messages, rows
from tests.test_joins import plan


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def flat(spark, *items):
    """Flat changes of (row, value, time, place in the log)."""
    changes = debezium(spark, *(("u", None, {"id": row, "v": v, "at": str(at)}, f"t{int(row) % 2}", ts) for row, v, ts, at in items))
    return routes.flat_changes(changes.withColumn("position", F.struct(
        F.lit("f").alias("log"), F.lit(0).cast("long").alias("block"), F.col("after")["at"].cast("long").alias("line"))))


def values(found):
    return sorted((r.id, json.loads(r.log_after)["v"]) for r in found.collect())


def test_flat_changes_are_shuffled_once_when_they_are_written(spark, tmp_path):
    path = str(tmp_path / "flat")
    first = [(str(i), "old", 5, i) for i in range(40)]
    keyed.write_changelog_flat(flat(spark, *first, ("7", "later", 5, 100), ("7", "earlier", 5, -1)), path, 0)
    want = {f"{i}_5": "old" for i in range(40)} | {"7_5": "later"}
    read = lambda: keyed.read_changelog_flat(spark, path)
    assert values(read()) == sorted(want.items()) and "hashpartitioning" not in plan(read())
    keyed.compact_changelog_flat(spark, path)
    keyed.write_changelog_flat(flat(spark, ("3", "new", 5, 200), ("3", "late", 5, -5), ("8", "too late", 5, -3), ("41", "next", 6, 7)), path, 1)
    want |= {"3_5": "new", "41_6": "next"}
    assert values(read()) == sorted(want.items()) and "hashpartitioning" not in plan(read())
    # another number of shuffle partitions changes neither the files' number nor what is read
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        keyed.write_changelog_flat(flat(spark, ("9", "newer", 5, 300), ("42", "last", 6, 8)), path, 2)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want |= {"9_5": "newer", "42_6": "last"}
    assert values(read()) == sorted(want.items()) and "hashpartitioning" not in plan(read())
    keyed.compact_changelog_flat(spark, path)
    version = versioned.current_version(spark, path)
    assert version.dealt == (("id",), int(before)) and not version.deltas
    assert values(read()) == sorted(want.items()) and "hashpartitioning" not in plan(read())


def test_dealt_batches_are_merged_without_a_shuffle_of_their_rows(spark, tmp_path, monkeypatch):
    path, seen, write = str(tmp_path / "flat"), [], versioned._write
    monkeypatch.setattr(versioned, "_write", lambda rows, *a: (seen.append(plan(rows)), write(rows, *a)))
    keyed.write_changelog_flat(flat(spark, *((str(i), "old", 5, i) for i in range(20))), path, 0)
    keyed.compact_changelog_flat(spark, path)
    keyed.write_changelog_flat(flat(spark, ("3", "new", 5, 200), ("4", "late", 5, -5)), path, 1)
    keyed.compact_changelog_flat(spark, path)
    assert ["hashpartitioning" in p for p in seen] == [True, False, True, False]
    assert values(keyed.read_changelog_flat(spark, path)) == sorted({**{f"{i}_5": "old" for i in range(20)}, "3_5": "new"}.items())


def test_a_log_of_older_batches_that_are_not_dealt_is_read_and_merged(spark, tmp_path):
    path = str(tmp_path / "flat")
    keyed.upsert(flat(spark, ("1", "a", 5, 1), ("2", "b", 5, 2)), ["id"], ["ts", "position"], path, 0, ["t_name"])
    keyed.write_changelog_flat(flat(spark, ("1", "c", 5, 3), ("3", "d", 5, 4)), path, 1)
    want = [("1_5", "c"), ("2_5", "b"), ("3_5", "d")]
    assert values(keyed.read_changelog_flat(spark, path)) == want
    keyed.compact_changelog_flat(spark, path)
    keyed.write_changelog_flat(flat(spark, ("2", "e", 5, 9)), path, 2)
    assert values(keyed.read_changelog_flat(spark, path)) == [("1_5", "c"), ("2_5", "e"), ("3_5", "d")]
    keyed.compact_changelog_flat(spark, path)
    assert values(keyed.read_changelog_flat(spark, path)) == [("1_5", "c"), ("2_5", "e"), ("3_5", "d")]


def test_a_dealt_batch_leaves_no_table_and_can_be_written_anew(spark, tmp_path, monkeypatch):
    path, tables = str(tmp_path / "flat"), lambda: {t.name for t in spark.catalog.listTables()}
    before = tables()
    with monkeypatch.context() as m:
        m.setattr(versioned, "_enter", lambda *a: (_ for _ in ()).throw(RuntimeError("lost before the commit")))
        with pytest.raises(RuntimeError):
            keyed.write_changelog_flat(flat(spark, ("1", "lost", 5, 1), ("2", "lost", 5, 2)), path, 0)
    keyed.write_changelog_flat(flat(spark, ("1", "kept", 5, 1)), path, 0)
    assert values(keyed.read_changelog_flat(spark, path)) == [("1_5", "kept")] and tables() == before


def test_shuffles_go_with_the_write_they_were_for(spark, tmp_path):
    before = shuffle_files(spark)
    keyed.write_changelog_flat(flat(spark, ("1", "a", 5, 1), ("2", "b", 5, 2)), str(tmp_path / "flat"), 0)
    keyed.upsert(spark.range(50).selectExpr("id % 7 AS k", "id AS ts"), ["k"], ["ts"], str(tmp_path / "facts"), 0)
    assert shuffle_files(spark) <= before
    with shuffles_freed(spark):
        assert spark.conf.get(FREE_SHUFFLES) == "true"
    assert spark.conf.get(FREE_SHUFFLES, "false") == "false"


def test_messages_are_landed_without_being_sorted_by_table(spark, tmp_path, monkeypatch):
    key, seen, named = "spark.sql.maxConcurrentOutputFileWriters", [], versioned._enter
    # the setting is what keeps Spark from sorting; it is seen by the write and gone when the batch is named
    free = versioned.held
    monkeypatch.setattr(versioned, "held", lambda spark, conf: (seen.append(conf), free(spark, conf))[1])
    monkeypatch.setattr(versioned, "_enter", lambda spark, *a: (seen.append(spark.conf.get(key, "0")), named(spark, *a)))
    log = messages(spark, *({"database": "shop", "table": f"t{i % (2 * versioned.WRITERS)}", "type": "insert", "ts": 1, "data": {"id": str(i)}}
                            for i in range(400))).coalesce(1)
    landing.land_changes(log, str(tmp_path / "landing"))
    assert seen == [{key: str(versioned.WRITERS)}, "0"]
    found = landing.landed_changes(spark, str(tmp_path / "landing"))
    # more tables than are written side by side
    assert sorted((int(r.data["id"]), r.table) for r in found.collect()) == [(i, f"t{i % (2 * versioned.WRITERS)}") for i in range(400)]


def test_latest_rows_carry_their_order_once(spark):
    df = spark.createDataFrame([("a", 1, "x", 5), ("a", 2, None, 4), ("a", 2, "y", 3), ("b", None, "z", 1)], "k string, ts int, v string, n int")
    latest = A.latest_per_key(df, ["k"], ["ts", "n"])
    assert rows(latest) == [("a", 2, None, 4), ("b", None, "z", 1)] and latest.columns == ["k", "ts", "v", "n"]
    assert "max_by" not in plan(latest)
    # by an expression, by a column named twice, by none, and beside a map, which has no order
    assert rows(A.latest_per_key(df, ["k"], [-F.col("n"), "ts"])) == [("a", 2, "y", 3), ("b", None, "z", 1)]
    assert rows(A.latest_per_key(df, ["k"], ["ts", "ts", "n"])) == [("a", 2, None, 4), ("b", None, "z", 1)]
    assert A.latest_per_key(df, ["k"], []).count() == 2
    maps = df.withColumn("m", F.create_map("k", "v"))
    assert rows(A.latest_per_key(maps, ["k"], ["ts", "n"]).select("k", "n", F.col("m")["a"])) == [("a", 4, None), ("b", 1, None)]


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def shuffles_of(df, column):
    """How many shuffles carry the column."""
    def below(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return below(node.initialPlan())
        names = [node.output().apply(i).name() for i in range(node.output().size())]
        return (node.nodeName() == "Exchange" and column in names) + sum(
            below(node.children().apply(i)) for i in range(node.children().size()))
    return below(df._jdf.queryExecution().executedPlan())


def sales(spark):
    """Details sent again, of one order, of unknown orders or without id; orders, activities and coupons of several rows."""
    r = random.Random(5)
    some = lambda n: None if r.random() < 0.08 else str(r.randrange(n))
    orders = spark.createDataFrame([(some(12), f"u{i}", f"p{i % 3}") for i in range(14)], "id string, user_id string, province_id string")
    detail = spark.createDataFrame(
        [(some(40), "3" if i % 3 == 0 else some(15), f"payload {i}", i) for i in range(120)] + [("7", "3", "payload 0", 0)] * 2,
        "id string, order_id string, payload string, ts long")
    activity = spark.createDataFrame([(some(60), f"a{i % 4}", some(5)) for i in range(50)], "id string, activity_id string, rule_id string")
    coupon = spark.createDataFrame([(some(60), f"c{i}", f"rule {i}") for i in range(40)], "id string, coupon_id string, rule_id string")
    return detail, orders, activity, coupon


def test_order_wide_shuffles_a_detail_once_and_is_the_joins_one_by_one(spark, no_broadcast):
    detail, orders, activity, coupon = sales(spark)
    for more in ([], [activity], [None, coupon], [activity.select("id"), coupon], [activity, coupon]):
        by_one = detail
        for part in filter(None, more):
            by_one = J.join_changes(by_one, part, "id", "id", "left")
        by_one = J.join_changes(by_one, orders, "order_id", "id")
        got = J.order_wide(detail, orders, *more)
        assert got.columns == by_one.columns and rows(got) == rows(by_one) and got.count() > 100
        assert shuffles_of(got, "payload") == 1
    assert shuffles_of(by_one, "payload") == 2  # by id, and by order


def test_cancellations_meet_wide_details_where_they_lie(spark, no_broadcast):
    detail, orders, activity, coupon = sales(spark)
    wide = J.order_wide(detail, orders, activity, coupon)
    cancelled = J.cancel_join(wide, spark.createDataFrame([("3", 9), ("4", 8), ("none", 7)], "id string, ts long"))
    assert shuffles_of(cancelled, "payload") == 1
    want = [(*r, 9 if r.order_id == "3" else 8) for r in wide.drop("ts").collect() if r.order_id in ("3", "4")]
    assert rows(cancelled) == sorted(want, key=lambda t: [(x is not None, str(x)) for x in t]) and len(want) > 40


@pytest.mark.parametrize("dealt", (True, False))
def test_interval_join_of_dealt_rows_shuffles_them_no_more(spark, no_broadcast, dealt):
    r = random.Random(6)
    key = lambda: None if r.random() < 0.05 else "hot" if r.random() < 0.5 else str(r.randrange(6))
    lefts = [(key(), r.choice([None, *range(200)]), f"l{i}") for i in range(150)]
    rights = [(key(), r.choice([None, *range(200)]), f"r{i}") for i in range(60)] + [("hot", 50, "twice")] * 2
    left = spark.createDataFrame(lefts, "k string, s long, payload string").select("k", F.timestamp_seconds("s").alias("lt"), "payload")
    right = spark.createDataFrame(rights, "k string, s long, j string").select("k", F.timestamp_seconds("s").alias("rt"), "j")
    if dealt:
        left = J.join_changes(left, spark.createDataFrame([(str(i),) for i in range(6)] + [("hot",)], "id string"), "k", "id")
    got = J.interval_join(left, right, "k", "lt", "rt", dealt=True)
    want = sorted((p, j) for k, s, p in lefts for q, u, j in rights
                  if k is not None and k == q and s is not None and u is not None and s - 15 <= u <= s + 5)
    assert sorted(map(tuple, got.select("payload", "j").collect())) == want and len(want) > 100
    assert got.columns == J.interval_join(left, right, "k", "lt", "rt").columns == ["k", "lt", "payload", "rt", "j"]
    assert shuffles_of(got, "payload") == 1
    if dealt:
        assert shuffles_of(J.interval_join(left, right, "k", "lt", "rt"), "payload") == 2
