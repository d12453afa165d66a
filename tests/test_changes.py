import json

import pytest
from pyspark.sql import functions as F

from tidemart.operators import changes as C, parse as P, routing as R
from tidemart.schemas import INSERT_TYPES, LOG
from tests.helpers import change, changes, debezium, log_record, logs, messages, rows


def ids(df):
    return sorted(r[0] for r in df.select(F.col("data")["id"]).collect())


# ---- parsing ---------------------------------------------------------------------------

BROKEN = '{"common": {"mid": "m1"'


def test_strict_parsing_fails_on_a_broken_message(spark):
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        P.parse_strict(messages(spark, log_record(), BROKEN), LOG).collect()


def test_lenient_parsing_skips_broken_blank_and_null_messages(spark):
    df = P.parse_lenient(messages(spark, log_record(), BROKEN, "", None), LOG)
    assert [r.common.mid for r in df.collect()] == ["m1"]


def test_split_parsing_keeps_broken_text(spark):
    good, bad = P.parse_split(messages(spark, log_record(mid="m2"), BROKEN, "oops"), LOG)
    assert [r.common.mid for r in good.collect()] == ["m2"]
    assert rows(bad) == sorted([(BROKEN,), ("oops",)])


def test_required_fields(spark):
    df = spark.createDataFrame(
        [("a", 1), ("", 1), (None, 1), ("b", 0), ("c", None), ("d", 5)], "mid string, ts bigint")
    assert rows(P.require_fields(df, ["mid"]).select("mid")) == [("a",), ("d",)]
    with pytest.raises(Exception, match="required field missing"):
        P.require_fields(df, ["mid"], strict=True).collect()
    present = df.where(F.col("mid").isNotNull() & F.col("ts").isNotNull())
    assert P.require_fields(present, ["mid"], strict=True).count() == 2


# ---- change rows -----------------------------------------------------------------------

def test_etl_drops_markers_other_databases_and_empty_payloads(spark):
    df = changes(
        spark, change("t", "insert", {"id": 1}), change("t", "bootstrap-start", {"id": 2}),
        change("t", "bootstrap-complete", {"id": 3}), change("t", "insert", {}), change("t", "insert", None),
        change("t", "insert", {"id": 6}, database="other"), change("t", "delete", {"id": 7}),
    )
    assert ids(C.etl_changes(df, "shop")) == ["1", "7"]


STATUS = [
    change("order_info", "bootstrap-insert", {"id": 1, "order_status": "1003"}),
    change("order_info", "insert", {"id": 2, "order_status": "1003"}),
    change("order_info", "update", {"id": 3, "order_status": "1003"}, {"order_status": "1001"}),
    change("order_info", "update", {"id": 4, "order_status": "1003"}, {"order_status": "1002"}),
    change("order_info", "update", {"id": 5, "order_status": "1003"}, {"operate_time": "x"}),
    change("order_info", "update", {"id": 6, "order_status": "1003"}),
    change("order_info", "delete", {"id": 7, "order_status": "1003"}, {"order_status": "1001"}),
    change("order_info", "update", {"id": 8, "order_status": "1004"}, {"order_status": "1001"}),
]


def test_status_with_exact_old_value_and_both_inserts(spark):
    df = changes(spark, *STATUS)
    assert ids(C.status_transition(df, "order_status", "1003", "1001", INSERT_TYPES)) == ["1", "2", "3"]


def test_status_with_any_old_value_skips_plain_inserts(spark):
    df = changes(spark, *STATUS)
    assert ids(C.status_transition(df, "order_status", "1003")) == ["1", "3", "4"]


def test_cart_counts_increases_only(spark):
    row = lambda i, type_, n, old=None: change("cart_info", type_, {"id": i, "sku_num": n}, old)
    df = changes(
        spark, row(1, "insert", 3), row(2, "bootstrap-insert", 4), row(3, "update", 5, {"sku_num": 2}),
        row(4, "update", 1, {"sku_num": 2}), row(5, "update", 5, {"is_checked": 1}), row(6, "delete", 5),
        row(7, "update", 5), change("other", "insert", {"id": 8, "sku_num": 1}),
    )
    got = C.cart_add(df, "shop")
    assert rows(got.select("id", "sku_num")) == [("1", 3), ("2", 4), ("3", 3)]
    assert dict(got.dtypes)["sku_num"] == "bigint"


def test_cart_images_count_snapshot_rows(spark):
    df = debezium(
        spark, ("r", None, {"id": "1", "sku_num": "3"}, "cart_info", 1), ("c", None, {"id": "2", "sku_num": "1"}, "cart_info", 1),
        ("u", {"sku_num": "1"}, {"id": "3", "sku_num": "4"}, "cart_info", 1),
        ("u", {"sku_num": "9"}, {"id": "4", "sku_num": "4"}, "cart_info", 1),
        ("d", {"id": "5", "sku_num": "4"}, None, "cart_info", 1),
    )
    assert rows(C.cart_add_debezium(df).select("id", "sku_num")) == [("1", 3), ("2", 1), ("3", 3)]


def test_projection_matches_whole_names(spark):
    df = changes(spark, change("t", "insert", {"id": 1, "name": "n", "nam": "x", "d": "y"})).withColumn(
        "sink_columns", F.lit("id,name"))
    assert C.project_config_columns(df).first()["data"] == {"id": "1", "name": "n"}


def test_clean_and_flatten(spark):
    df = debezium(
        spark, ("d", {"id": "1", "v": "a"}, None, "t", 5), ("u", {"id": "1"}, {"id": "1", "v": "b"}, "t", 6))
    assert rows(C.clean_change(df).select("op", F.col("data")["v"])) == [("d", "a"), ("u", "b")]
    flat = {r["op"]: r for r in C.flatten_change(df).collect()}
    gone = flat["DELETE"].asDict()
    assert json.loads(gone.pop("log_before")) == {"id": "1", "v": "a"}
    assert gone == {"id": "1_5", "op": "DELETE", "db_name": "shop", "log_after": None, "t_name": "t", "ts": "5"}
    assert json.loads(flat["UPDATE"]["log_after"]) == {"id": "1", "v": "b"}


def test_positional_insert_checks_the_width(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert C.positional_insert(df, ["x", "y"]).columns == ["x", "y"]
    with pytest.raises(ValueError):
        C.positional_insert(df, ["x"])


def test_shops_are_one_to_twelve_and_repeatable(spark):
    df = spark.range(-30, 30)
    first, second = (rows(C.assign_shop(df, "id")) for _ in range(2))
    assert first == second and {s for _, s in first} == {str(i) for i in range(1, 13)}


# ---- routing ---------------------------------------------------------------------------

def fact_config(spark, *items):
    return spark.createDataFrame(
        list(items), "source_table string, source_type string, sink_table string, sink_columns string, op string")


def test_fact_routing_normalises_both_sides(spark):
    df = changes(spark, change("user_info", "bootstrap-insert", {"id": 1}), change("user_info", "insert", {"id": 2}),
                 change("user_info", "update", {"id": 3}), change("cart_info", "insert", {"id": 4}))
    for written in ("insert", "bootstrap-insert"):
        config = fact_config(spark, ("user_info", written, "dwd_user_register", "id", "r"))
        routed = R.route_fact(df, config)
        assert ids(routed) == ["1", "2"]
        assert {r.type for r in routed.collect()} == {"bootstrap-insert", "insert"}


def test_config_is_broadcast_if_its_size_is_known_to_be_small(spark):
    from tests.test_joins import plan
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = changes(spark, change("user_info", "insert", {"id": 1}))
        config = spark.sql("SELECT * FROM VALUES ('user_info', 'insert', 'dwd_user_register', 'id', 'r') "
                           "AS c(source_table, source_type, sink_table, sink_columns, op)")
        assert "BroadcastHashJoin" in plan(R.route_fact(df, config))
        unknown = fact_config(spark, ("user_info", "insert", "dwd_user_register", "id", "r"))
        beyond = R.route_fact(df, unknown)
        assert "BroadcastHashJoin" not in plan(beyond) and beyond.count() == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_messages_are_parsed_once(spark):
    from tests.test_joins import plan
    parsed = P.parse_lenient(messages(spark, log_record()), LOG).where("common.mid != '' AND ts > 0")
    assert plan(parsed.select("common", "ts")).count("from_json") == 1


def test_config_state_keeps_the_latest_and_drops_deleted(spark):
    df = spark.createDataFrame(
        [("a", "dim_a1", "r", 1), ("a", "dim_a2", "u", 3), ("a", "dim_a0", "u", 2), ("b", "dim_b", "r", 1),
         ("b", "dim_b", "d", 2), ("c", "dim_c", None, 1)],
        "source_table string, sink_table string, op string, ts bigint")
    assert rows(R.config_state(df, ["source_table"]).select("source_table", "sink_table")) == [("a", "dim_a2"), ("c", "dim_c")]


def test_op_routing_skips_deletes_and_unknown_tables(spark):
    config = spark.createDataFrame([("t", "dim_t"), ("t", "dim_t2")], "source_table string, sink_table string")
    df = debezium(spark, ("c", None, {"id": "1"}, "t", 1), ("d", {"id": "2"}, None, "t", 1), ("u", None, {"id": "3"}, "x", 1))
    got = R.route_by_op(df, config)
    assert rows(got.select("topic", F.col("data")["id"])) == [("c_t", "1")]


# ---- log splitting ---------------------------------------------------------------------

def sample_log(spark):
    page = {"page_id": "home", "during_time": 5}
    shown = [{"pos_seq": 1, "item": "7", "item_type": "sku_id", "pos_id": 3}, {"pos_seq": 2, "item": "8"}]
    acted = [{"item": "7", "action_id": "fav", "ts": 99}]
    return logs(
        spark,
        log_record(mid="m1", page=page, displays=shown, actions=acted, err={"msg": "e", "error_code": 4}),
        log_record(mid="m2", start={"entry": "icon"}, err={"msg": "f", "error_code": 5}),
        log_record(mid="m3", start={"entry": "icon"}, page=page, displays=shown),
        log_record(mid="m4", page=page, displays=[]),
        log_record(mid="m5"),
    )


def mids(df):
    return sorted(r[0] for r in df.select("common.mid").collect())


def test_split_log(spark):
    from tidemart.operators import logs as L
    parts = L.split_log(sample_log(spark))
    assert {k: mids(v) for k, v in parts.items()} == {
        "err": ["m1", "m2"], "start": ["m2", "m3"], "display": ["m1", "m1"], "action": ["m1"], "page": ["m1", "m4"]}
    error = parts["err"].where("common.mid = 'm1'").first()
    assert len(error.displays) == 2 and error.err.error_code == 4
    assert "err" not in parts["start"].columns
    assert not {"err", "displays", "actions"} & set(parts["page"].columns)
    action = parts["action"].first()
    assert action.action_id == "fav" and action.ts != 99 and action.page.page_id == "home"


def test_split_log_in_one_pass_gives_the_same_rows(spark):
    from tidemart.operators import logs as L
    df = sample_log(spark)
    one_pass = rows(L.log_messages(df))
    parts = L.split_log(df)
    apart = []
    for topic, part in parts.items():
        apart += [(topic, r[0]) for r in part.select(F.to_json(F.struct("*"))).collect()]
    assert one_pass == sorted(apart)


def test_split_log_wrapped(spark):
    from tidemart.operators import logs as L
    parts = L.split_log_wrapped(sample_log(spark))
    assert sorted(r.error_code for r in parts["err"].collect()) == [4, 5]
    assert mids(parts["page"]) == ["m1", "m4", "m5"]
    assert parts["action"].columns == ["common", "page", "action"]
    assert parts["display"].columns == ["common", "page", "display", "ts"]
    page = {r.common.mid: r for r in parts["page"].collect()}
    assert page["m1"].displays is None and page["m4"].displays == []
