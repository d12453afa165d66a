"""Dimensions that change while a stream runs."""


from tidemart.operators import joins as J
from tidemart.sinks import keyed
from tidemart.streaming import live
from tests.helpers import rows

ROUTED = "sink_table string, rowkey string, data map<string,string>, type string, ts bigint"


def commit(spark, path, batch, *items):
    keyed.dim_upsert(spark.createDataFrame(list(items), ROUTED), path, batch)


def test_dimensions_are_resolved_anew_only_after_a_commit(spark, tmp_path):
    path = str(tmp_path / "dims")
    dims = live.LiveDims(path, {"dim_a": ["name"], "dim_none": ["x", "y"]})
    assert rows(dims(spark)["dim_a"]) == [] and dims(spark)["dim_none"].columns == ["id", "x", "y"]
    commit(spark, path, 0, ("dim_a", "1", {"name": "one"}, "insert", 1))
    first = dims(spark)
    assert rows(first["dim_a"]) == [("1", "one")] and rows(first["dim_none"]) == []
    assert dims(spark) is first
    commit(spark, path, 1, ("dim_a", "2", {"name": "two"}, "insert", 2), ("dim_a", "1", {}, "delete", 2))
    assert rows(dims(spark)["dim_a"]) == [("2", "two")]
    assert rows(first["dim_a"]) == [("1", "one")]  # a reader that has begun keeps what it began with
    before = dims(spark)
    keyed.compact_dim(spark, path)
    assert dims(spark) is before


def test_a_running_stream_sees_rows_added_between_micro_batches(spark, tmp_path):
    path, out, folder = (str(tmp_path / n) for n in ("dims", "out", "in"))
    commit(spark, path, 0, ("dim_sku_info", "1", {"spu_id": "s1", "category3_id": "c3", "tm_id": "t1"}, "insert", 1))
    for i in range(3):
        spark.createDataFrame([(f"{i}-{sku}", str(sku)) for sku in (1, 2)], "id string, sku_id string").coalesce(1).write.mode("append").parquet(folder)
    later = [
        [("dim_sku_info", "2", {"spu_id": "s2", "category3_id": "c3", "tm_id": "t2"}, "insert", 2), ("dim_base_trademark", "t1", {"tm_name": "T1"}, "insert", 2)],
        [("dim_base_category3", "c3", {"name": "C3", "category2_id": "c2"}, "insert", 3), ("dim_sku_info", "1", {}, "delete", 3)],
    ]
    tables = {"dim_sku_info": ["spu_id", "category3_id", "tm_id"], "dim_spu_info": ["spu_name"], "dim_base_trademark": ["tm_name"],
              "dim_base_category3": ["name", "category2_id"], "dim_base_category2": ["name", "category1_id"], "dim_base_category1": ["name"]}

    def sink(df, batch_id):
        keyed.upsert(df, ["id"], [], out, batch_id)
        if batch_id < len(later):
            commit(spark, path, batch_id + 1, *later[batch_id])

    stream = spark.readStream.schema("id string, sku_id string").option("maxFilesPerTrigger", 1).parquet(folder)
    live.run_live(stream, J.enrich_product_chain, live.LiveDims(path, tables), sink, str(tmp_path / "at")).awaitTermination()
    found = {r.id: (r.spu_id, r.trademark_name, r.category3_name) for r in keyed.read_upserts(spark, out, ["id"], []).collect()}
    assert found == {
        "0-1": ("s1", None, None), "0-2": (None, None, None), "1-1": ("s1", "T1", None), "1-2": ("s2", None, None),
        "2-1": (None, None, None), "2-2": ("s2", None, "C3")}


def test_a_repeated_micro_batch_keeps_what_was_committed(spark, tmp_path):
    path, out = str(tmp_path / "dims"), str(tmp_path / "out")
    batch = spark.createDataFrame([("a", "1")], "id string, key string")
    write = live.live_writer(
        lambda df, dims: J.enrich(df, dims["dim_a"], "key", {"name": "name"}), live.LiveDims(path, {"dim_a": ["name"]}),
        lambda df, i: keyed.upsert(df, ["id"], [], out, i))
    commit(spark, path, 0, ("dim_a", "1", {"name": "one"}, "insert", 1))
    write(batch, 0)
    commit(spark, path, 1, ("dim_a", "1", {"name": "new"}, "update", 2))
    write(batch, 0)
    assert rows(keyed.read_upserts(spark, out, ["id"], []).select("name")) == [("one",)]
    write(batch, 1)
    assert rows(keyed.read_upserts(spark, out, ["id"], []).select("name")) == [("new",)]


def test_config_changes_between_micro_batches_take_effect(spark, tmp_path):
    path = str(tmp_path / "config")
    schema = "source_table string, sink_table string, op string, ts bigint"
    put = lambda batch, *items: keyed.upsert(spark.createDataFrame(list(items), schema), ["source_table"], ["ts"], path, batch)
    config = live.LiveConfig(path, ["source_table"])
    tables = lambda: rows(config(spark).select("source_table", "sink_table"))
    put(0, ("a", "dim_a", "r", 1))
    assert tables() == [("a", "dim_a")]
    put(1, ("b", "dim_b", "c", 2), ("a", "dim_a2", "u", 2))
    assert tables() == [("a", "dim_a2"), ("b", "dim_b")]
    put(2, ("a", "dim_a2", "d", 3))
    assert tables() == [("b", "dim_b")] and config(spark) is config(spark)
