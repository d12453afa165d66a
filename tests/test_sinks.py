import json

import pytest
from pyspark.sql import functions as F

from tidemart.plans import facts, routes
from tidemart.session import scratch_dir
from tidemart.sinks import keyed, messages as M, versioned
from tidemart.sources import messages as S
from tidemart.sources.tables import config_table, dim_table
from tests.helpers import change, changes, debezium, log_record, messages, rows


def test_upserts_keep_the_latest_row_and_survive_a_repeated_batch(spark, tmp_path):
    path = str(tmp_path / "facts")
    schema = "id string, ts bigint, v string"
    first = spark.createDataFrame([("a", 1, "a1"), ("a", 2, "a2"), ("b", 5, "b5")], schema)
    second = spark.createDataFrame([("a", 3, None), ("b", 4, "b4")], schema)
    for batch, df in ((0, first), (1, second), (1, second)):
        keyed.upsert(df, ["id"], ["ts"], path, batch)
    assert rows(keyed.read_upserts(spark, path, ["id"], ["ts"])) == [("a", 3, None), ("b", 5, "b5")]
    keyed.compact(keyed.read_upserts(spark, path, ["id"], ["ts"]), str(tmp_path / "compact"))
    assert rows(keyed.read_upserts(spark, str(tmp_path / "compact"), ["id"], ["ts"])) == [("a", 3, None), ("b", 5, "b5")]


def test_dimension_cells_deletes_and_null_puts(spark, tmp_path):
    path = str(tmp_path / "dims")
    schema = "sink_table string, rowkey string, data map<string,string>, type string, ts bigint"
    batches = [
        [("dim_a", "1", {"name": "n1", "v": "x"}, "insert", 1), ("dim_a", "2", {"name": "n2", "v": "y"}, "insert", 1),
         ("dim_b", "1", {"name": "other"}, "insert", 1), ("dim_a", None, {"name": "lost"}, "insert", 1),
         ("dim_a", "4", {"name": "n4"}, "insert", 1)],
        [("dim_a", "1", {"name": None, "v": "x2"}, "update", 2), ("dim_a", "2", {}, "delete", 2),
         ("dim_a", "3", {"name": "n3"}, "insert", 2), ("dim_a", "4", {}, "delete", 2)],
        [("dim_a", "2", {"v": "z"}, "insert", 3)],
    ]
    for i, items in enumerate(batches):
        keyed.dim_upsert(spark.createDataFrame(items, schema), path, i)
    assert rows(keyed.read_dim(spark, path, "dim_a", ["name", "v"])) == [("1", "n1", "x2"), ("2", None, "z"), ("3", "n3", None)]
    assert rows(keyed.read_dim(spark, path, "dim_b", ["name"])) == [("1", "other")]


def test_dimension_tables_follow_config_changes(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS life")
    config = lambda *items: spark.createDataFrame(list(items), "sink_table string, sink_columns string, op string, ts bigint")
    tables = lambda: {t.name for t in spark.catalog.listTables("life")}
    keyed.dim_lifecycle(config(("dim_a", "id,name", "r", 1), ("dim_b", "id", "c", 2)), "life", str(tmp_path))
    keyed.dim_lifecycle(config(("dim_a", "id,name", "r", 3)), "life", str(tmp_path))
    assert tables() == {"dim_a", "dim_b"}
    done = keyed.dim_lifecycle(config(("dim_a", "id,name,age", "u", 4), ("dim_b", "id", "d", 5)), "life", str(tmp_path / "next"))
    assert tables() == {"dim_a"} and len(done) == 3
    assert spark.table("life.dim_a").columns == ["id", "name", "age"]


def test_config_changes_have_no_cap_and_names_are_quoted(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS many")
    config = spark.range(40).select(
        F.concat(F.lit("t_"), F.col("id") % 2).alias("sink_table"), F.lit("id,a-b").alias("sink_columns"),
        F.when(F.col("id") < 38, "u").otherwise("r").alias("op"), F.col("id").alias("ts"))
    assert len(keyed.dim_lifecycle(config, "many")) == 38 * 2 + 2
    assert spark.table("many.t_1").columns == ["id", "a-b"]
    keyed.dim_lifecycle(config.limit(2).withColumn("op", F.lit("d")), "many")


def test_jdbc_rows_are_written_by_position(spark, monkeypatch):
    """No database runs in tests: the writer is replaced and what it is asked to do is checked."""
    from pyspark.sql import DataFrameWriter
    seen = {}
    def save(self, *args, **kwargs):
        seen["columns"] = self._df.columns
    monkeypatch.setattr(DataFrameWriter, "save", save)
    df = spark.createDataFrame([("s", "e", "d", 1, "1", "n")], "stt string, edt string, cd string, a int, sid string, sn string")
    keyed.write_jdbc(df, "jdbc:none", "shop", ["stt", "edt", "cur_date", "amount", "shop_id", "shop_name"])
    assert seen["columns"] == ["stt", "edt", "cur_date", "amount", "shop_id", "shop_name"]


def test_flat_changes_are_partitioned_by_table_and_keyed(spark, tmp_path):
    path = str(tmp_path / "flat")
    df = debezium(spark, ("c", None, {"id": "1"}, "t1", 5), ("c", None, {"id": "1"}, "t1", 5), ("d", {"id": "2"}, None, "t2", 6))
    keyed.write_changelog_flat(routes.flat_changes(df), path)
    back = keyed.read_changelog_flat(spark, path)
    assert rows(back.select("id", "t_name", "op")) == [("1_5", "t1", "CREATE"), ("2_6", "t2", "DELETE")]
    assert {p.name for p in (tmp_path / "flat" / "batch=0").iterdir() if p.is_dir()} == {"t_name=t1", "t_name=t2"}


def test_topics_and_console(spark, tmp_path, capsys):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    M.write_messages(df, "one", str(tmp_path / "bus"))
    M.write_messages(df.limit(1), "two", str(tmp_path / "bus"))
    assert S.read_messages(spark, str(tmp_path / "bus/topic=one"), "text", stream=False).count() == 2
    assert S.read_messages(spark, str(tmp_path / "bus/topic=two"), "text", stream=False).count() == 1
    M.console(df)
    assert "| 1|a  |" in capsys.readouterr().out.replace("|1  |", "| 1|")
    with pytest.raises(ValueError):
        S.read_messages(spark, "x", "carrier-pigeon")


def test_config_and_dim_tables(spark, tmp_path):
    spark.createDataFrame([("t", "dim_t", "id")], "source_table string, sink_table string, sink_row_key string").write.parquet(
        str(tmp_path / "config"))
    assert config_table(spark, str(tmp_path / "config"), "parquet").columns == ["sourceTable", "sinkTable", "sinkRowKey"]
    assert config_table(spark, str(tmp_path / "config"), "parquet", camel=False).columns[0] == "source_table"
    dim = dim_table(spark, str(tmp_path / "config"), "source_table")
    assert dim.first().info.sink_row_key == "id" and dim.columns == ["rowkey", "info"]


def test_scratch_folder_comes_from_the_session(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


# ---- jobs end to end -------------------------------------------------------------------

def config(spark):
    return spark.createDataFrame([("base_trademark", "dim_base_trademark", "id,tm_name", "info", "id", "r")],
                                 "source_table string, sink_table string, sink_columns string, sink_family string, sink_row_key string, op string")


def test_dimension_load_uses_the_envelope_type_for_deletes(spark, tmp_path):
    df = changes(
        spark, change("base_trademark", "bootstrap-insert", {"id": 1, "tm_name": "a", "logo": "l"}, ts=1),
        change("base_trademark", "insert", {"id": 2, "tm_name": "b", "type": "delete"}, ts=1),
        change("base_trademark", "delete", {"id": 1, "tm_name": "a"}, ts=2), change("other", "insert", {"id": 9}, ts=1))
    routed = routes.dim_rows(df, config(spark), "shop")
    assert {k for r in routed.collect() for k in r.data} == {"id", "tm_name"}
    keyed.dim_upsert(routed, str(tmp_path / "d"))
    assert rows(keyed.read_dim(spark, str(tmp_path / "d"), "dim_base_trademark", ["tm_name"])) == [("2", "b")]


def test_debezium_dimension_load_skips_deletes_and_nulls(spark, tmp_path):
    df = debezium(spark, ("r", None, {"id": "1", "tm_name": "a"}, "base_trademark", 1),
                  ("u", {"id": "1"}, {"id": "1", "tm_name": None}, "base_trademark", 2),
                  ("d", {"id": "1"}, None, "base_trademark", 3))
    keyed.dim_upsert(routes.dim_rows_debezium(df, config(spark)), str(tmp_path / "d"))
    assert rows(keyed.read_dim(spark, str(tmp_path / "d"), "dim_base_trademark", ["tm_name"])) == [("1", "a")]


def test_log_job_repairs_flags_and_splits(spark):
    day = 86_400_000
    ts = 1_709_280_000_000
    page = {"page_id": "home"}
    raw = messages(
        spark, log_record(ts=ts, page=page, common={"mid": "m", "is_new": "1"}),
        log_record(ts=ts + day, page=page, common={"mid": "m", "is_new": "1"}),
        log_record(ts=ts, start={"entry": "icon"}, common={"mid": ""}), "broken")
    out = routes.log_split(raw, strict=False).collect()
    assert [r.topic for r in out] == ["page", "page"]
    flags = {json.loads(r.value)["ts"]: json.loads(r.value)["common"]["is_new"] for r in out}
    assert flags == {ts: "1", ts + day: "0"}
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        routes.log_split(raw).collect()


def fact_changes(spark):
    return changes(
        spark,
        change("order_info", "insert", {"id": "o1", "user_id": "u1", "province_id": "p1", "order_status": "1001"}, ts=100),
        change("order_detail", "insert", {"id": "d1", "order_id": "o1", "sku_id": "s1", "split_total_amount": "5.00"}, ts=100),
        change("order_detail", "insert", {"id": "d2", "order_id": "o1", "sku_id": "s2", "split_total_amount": "6.00"}, ts=100),
        change("order_detail_activity", "insert", {"order_detail_id": "d1", "activity_id": "a1", "activity_rule_id": "r1"}, ts=101),
        change("order_detail_coupon", "insert", {"order_detail_id": "d2", "coupon_id": "c1"}, ts=101),
        change("order_info", "update", {"id": "o1", "operate_time": "t", "order_status": "1003"}, {"order_status": "1001"}, ts=150),
        change("payment_info", "update", {"id": "y1", "order_id": "o1", "user_id": "u1", "payment_type": "1", "callback_time": "cb",
                                          "payment_status": "1602"}, {"payment_status": "1601"}, ts=105),
        change("payment_info", "update", {"id": "y2", "order_id": "o1", "user_id": "u1", "payment_type": "1",
                                          "payment_status": "1602"}, {"payment_status": "1601"}, ts=106),
        change("payment_info", "insert", {"id": "y3", "order_id": "o1", "payment_type": "1", "payment_status": "1602"}, ts=100),
    )


def test_order_detail_cancel_and_payment(spark):
    df = fact_changes(spark)
    dic = spark.createDataFrame([("1", ("card",))], "rowkey string, info struct<dic_name string>")
    detail = facts.order_detail(df, "shop")
    assert rows(detail.select("id", "user_id", "activity_id", "coupon_id", "ts")) == [
        ("d1", "u1", "a1", None, 100), ("d2", "u1", None, "c1", 100)]
    assert rows(facts.order_cancel(detail, df, "shop").select("id", "operate_time", "ts")) == [("d1", "t", 150), ("d2", "t", 150)]
    paid = facts.payment_success(detail, df, dic, "shop")
    assert rows(paid.select("id", "payment_type_name", "payment_time", "ts")) == [("d1", "card", "cb", 105), ("d2", "card", "cb", 105)]
    # literal form: no upper bound
    assert facts.payment_success(detail, df, dic, "shop", upper=None).count() == 4


CHANGES = "sink_table string, rowkey string, data map<string,string>, type string, ts bigint, position struct<log:string,block:bigint,line:bigint>"


def placed(spark, *items):
    """Items are (rowkey, data, type, ts, line); all of one dimension and one log."""
    return spark.createDataFrame([("dim_a", k, d, t, ts, ("log", 0, line)) for k, d, t, ts, line in items], CHANGES)


def test_changes_of_one_second_count_in_the_order_they_came(spark, tmp_path):
    path = str(tmp_path / "dims")
    keyed.dim_upsert(placed(
        spark, ("put-put", {"v": "new"}, "update", 5, 2), ("put-put", {"v": "old", "w": "w"}, "insert", 5, 1),
        ("delete-put", {}, "delete", 5, 3), ("delete-put", {"v": "back"}, "insert", 5, 4), ("delete-put", {"w": "w"}, "insert", 5, 1),
        ("put-delete", {"v": "x"}, "insert", 5, 1), ("put-delete", {}, "delete", 5, 2),
        ("late", {"v": "late"}, "update", 3, 9), ("late", {"v": "now"}, "update", 5, 1)), path)
    want = [("delete-put", "back", None), ("late", "now", None), ("put-put", "new", "w")]
    assert rows(keyed.read_dim(spark, path, "dim_a", ["v", "w"])) == want


def test_compaction_between_batches_and_a_repeated_batch_after_it(spark, tmp_path):
    path = str(tmp_path / "dims")
    read = lambda: rows(keyed.read_dim(spark, path, "dim_a", ["v", "w"]))
    first = placed(spark, ("a", {"v": "1", "w": "1"}, "insert", 1, 1), ("b", {"v": "b"}, "insert", 1, 2), ("c", {"v": None}, "insert", 1, 3),
                   ("d", {}, "delete", 4, 4))
    second = placed(spark, ("a", {"v": "2"}, "update", 2, 5), ("b", {}, "delete", 2, 6))
    # late changes after a compaction: one before a put and one before a delete that were merged
    third = placed(spark, ("a", {"v": "late", "w": "3"}, "update", 1, 9), ("d", {"v": "late"}, "insert", 3, 10), ("b", {"w": "b3"}, "insert", 3, 11))
    plain = str(tmp_path / "plain")
    for i, batch in enumerate((first, second, third)):
        keyed.dim_upsert(batch, plain, i)
    keyed.dim_upsert(first, path, 0)
    keyed.compact_dim(spark, path, buckets=4)
    assert read() == [("a", "1", "1"), ("b", "b", None), ("c", None, None)]
    keyed.dim_upsert(second, path, 1)
    keyed.dim_upsert(first, path, 0)  # merged already
    assert read() == [("a", "2", "1"), ("c", None, None)]
    keyed.compact_dim(spark, path)
    keyed.dim_upsert(second, path, 1)
    keyed.dim_upsert(third, path, 2)
    assert read() == rows(keyed.read_dim(spark, plain, "dim_a", ["v", "w"])) == [("a", "2", "3"), ("b", None, "b3"), ("c", None, None)]
    keyed.compact_dim(spark, path)
    keyed.compact_dim(spark, path)
    assert read() == [("a", "2", "3"), ("b", None, "b3"), ("c", None, None)]


def test_compaction_rewrites_only_touched_buckets(spark, tmp_path):
    path, order = str(tmp_path / "facts"), ["ts"]
    everything = spark.range(200).selectExpr("cast(id as string) id", "1L ts", "'old' v")
    keyed.upsert(everything, ["id"], order, path, 0)
    keyed.compact_upserts(spark, path, ["id"], order, buckets=8)
    before = versioned.current_version(spark, path)
    keyed.upsert(everything.where("id = '7'").selectExpr("id", "2L ts", "'new' v"), ["id"], order, path, 1)
    keyed.compact_upserts(spark, path, ["id"], order)
    after = versioned.current_version(spark, path)
    assert len(before.base) == 8 and sum(before.base[b] != after.base[b] for b in before.base) == 1
    assert (after.upto, after.last, after.deltas) == (1, 1, {})
    found = keyed.read_upserts(spark, path, ["id"], order)
    assert found.count() == 200 and rows(found.where("v = 'new'")) == [("7", 2, "new")]


def test_readers_see_no_uncommitted_batch(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "facts")
    row = lambda v: spark.createDataFrame([("a", 1, v)], "id string, ts bigint, v string")
    keyed.upsert(row("first"), ["id"], ["ts"], path, 0)
    with monkeypatch.context() as m:
        m.setattr(versioned, "_enter", lambda *a: (_ for _ in ()).throw(RuntimeError("lost before the commit")))
        with pytest.raises(RuntimeError):
            keyed.upsert(row("second"), ["id"], ["ts"], path, 1)
    assert rows(keyed.read_upserts(spark, path, ["id"], ["ts"])) == [("a", 1, "first")]
    keyed.upsert(row("second"), ["id"], ["ts"], path, 1)
    assert rows(keyed.read_upserts(spark, path, ["id"], ["ts"])) == [("a", 1, "second")]
    with pytest.raises(ValueError):
        keyed.read_upserts(spark, str(tmp_path / "none"), ["id"], ["ts"])
    assert rows(keyed.read_dim(spark, str(tmp_path / "none"), "dim_a", ["v"])) == []


def test_messages_keep_the_order_of_their_lines(spark, tmp_path):
    folder = str(tmp_path / "log")
    for part in range(2):
        spark.range(part * 5000, part * 5000 + 5000).selectExpr("cast(id as string) value").coalesce(1).write.mode("append").text(folder)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # several blocks a file
    try:
        read = S.read_messages(spark, folder, "text", stream=False, position=True)
        assert read.rdd.getNumPartitions() > 4
        assert [int(r.value) for r in read.orderBy("position").collect()] == list(range(10_000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_flat_changes_of_one_moment_keep_the_last_to_arrive(spark, tmp_path):
    changes = debezium(spark, ("c", None, {"id": "1", "v": "1"}, "t1", 7), ("u", {"id": "1"}, {"id": "1", "v": "2"}, "t1", 7))
    lines = changes.selectExpr("to_json(struct(*)) value").coalesce(1)
    lines.write.text(str(tmp_path / "in"))
    read = S.debezium_stream(S.read_messages(spark, str(tmp_path / "in"), "text", stream=False, position=True))
    keyed.write_changelog_flat(routes.flat_changes(read), str(tmp_path / "flat"))
    keyed.write_changelog_flat(routes.flat_changes(read.where("op = 'c'")), str(tmp_path / "flat"), 1)
    found = keyed.read_changelog_flat(spark, str(tmp_path / "flat"))
    assert len(found.columns) == 7 and [(r.op, json.loads(r.log_after)["v"]) for r in found.collect()] == [("UPDATE", "2")]
    keyed.compact_changelog_flat(spark, str(tmp_path / "flat"))
    assert rows(keyed.read_changelog_flat(spark, str(tmp_path / "flat"))) == rows(found)


def test_a_stream_of_files_keeps_the_order_of_its_lines(spark, tmp_path):
    from tidemart.streaming.job import run_to_end
    folder, path = tmp_path / "in", str(tmp_path / "dims")
    folder.mkdir()
    record = lambda v, type_="update": json.dumps(
        {"database": "shop", "table": "t1", "type": type_, "ts": 5, "data": {"id": "1", "v": v}})
    (folder / "0.txt").write_text("\n".join([record("a"), record("b"), record("", "delete"), record("c"), record("d")]))
    (folder / "1.txt").write_text("\n".join([record("e"), record("", "delete"), record("f")]))
    config = spark.createDataFrame([("t1", "dim_a", "id,v", "id", "r")], "source_table string, sink_table string, sink_columns string, sink_row_key string, op string")
    log = S.change_stream(S.read_messages(spark, str(folder), "text", position=True, maxFilesPerTrigger="1"))
    run_to_end(routes.dim_rows(log, config, "shop"), checkpoint=str(tmp_path / "at"), sink=keyed.dim_writer(path))
    assert rows(keyed.read_dim(spark, path, "dim_a", ["v"])) == [("1", "f")]


def test_a_repeated_batch_gives_its_messages_the_same_ids(spark):
    """Ids do not depend on order or tasks; equal messages differ, and so do null, empty and other topics' ones."""
    sent = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "x"), ("a", ""), ("a", None), (None, "x")], "topic string, value string")
    first = M.identified(sent, "job", 3).collect()
    again = M.identified(sent.repartition(5).orderBy(F.desc("value")), "job", 3).collect()
    assert len(first) == 6 and len({r[S.MESSAGE_ID] for r in first}) == 6
    assert set(first) == set(again)
    for other in (M.identified(sent, "job", 4), M.identified(sent, "other", 3)):
        assert not {r[S.MESSAGE_ID] for r in first} & {r[S.MESSAGE_ID] for r in other.collect()}


def test_messages_are_read_once_whatever_they_hold(spark, tmp_path):
    sent = spark.createDataFrame([("t", "tab\there"), ("t", ""), ("t", "x"), ("t", "x")], "topic string, value string")
    write = M.once_writer(str(tmp_path), "job", fmt="text")
    for rows_ in (sent, sent.repartition(3)):
        write(rows_, 0)
    read = S.read_messages(spark, f"{tmp_path}/topic=t", "text", stream=False, message_id=True)
    assert read.count() == 8
    once = S.drop_repeats(read)
    assert once.columns == ["value"] and sorted(r.value for r in once.collect()) == ["", "tab\there", "x", "x"]
