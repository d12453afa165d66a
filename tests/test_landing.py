"""Messages are parsed once, and jobs read the tables they ask for."""

import json

from pyspark.sql import functions as F

from tidemart.plans import facts, landing
from tests.helpers import messages, rows


def record(table, id_, ts=1, **data):
    return {"database": "shop", "table": table, "type": "insert", "ts": ts, "data": {"id": id_, **data}}


def test_tables_unreadable_messages_and_repeated_batches(spark, tmp_path):
    path = str(tmp_path / "landing")
    first = messages(spark, record("comment_info", "1"), "no json", None, record("order_info", "2"), record(None, "3"), "")
    second = messages(spark, record("comment_info", "4"), record("7", "5"))
    for batch, df in ((0, first), (0, first), (1, second), (1, second)):
        landing.land_changes(df, path, batch)
    found = landing.landed_changes(spark, path)
    assert found.columns == ["database", "table", "type", "ts", "data", "old", "row_time"]
    assert sorted((r.table or "", r.data["id"]) for r in found.collect()) == [
        ("", "3"), ("7", "5"), ("comment_info", "1"), ("comment_info", "4"), ("order_info", "2")]
    assert rows(landing.unreadable_messages(spark, path)) == [("",), ("",), ("no json",)]
    assert rows(landing.landed_changes(spark, path, ["7"]).select(F.col("data")["id"])) == [("5",)]


def test_jobs_parse_nothing_and_read_their_tables_only(spark, tmp_path):
    path = str(tmp_path / "landing")
    landing.land_changes(messages(spark, record("comment_info", "1", appraise="1"), record("order_info", "2")), path)
    plan = facts.comment_rows(landing.landed_changes(spark, path), "shop")._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan and "source_table" in plan.split("PartitionFilters: ")[1].split("]")[0]


def test_readers_of_one_version_see_the_same_messages(spark, tmp_path):
    from tidemart.sinks import versioned
    path = str(tmp_path / "landing")
    landing.land_changes(messages(spark, record("a", "1")), path, 0)
    version = versioned.current_version(spark, path)
    landing.land_changes(messages(spark, record("a", "2")), path, 1)
    assert landing.landed_changes(spark, path, version=version).count() == 1
    assert landing.landed_changes(spark, path).count() == 2


def test_landing_a_stream(spark, tmp_path):
    from tidemart.sources.messages import read_messages
    from tidemart.streaming.job import run_to_end
    folder, path = tmp_path / "in", str(tmp_path / "landing")
    folder.mkdir()
    for i in range(3):
        (folder / f"{i}.txt").write_text("\n".join(json.dumps(record("a", f"{i}-{k}")) for k in range(4)))
    log = read_messages(spark, str(folder), "text", position=True, maxFilesPerTrigger="1")
    run_to_end(log, checkpoint=str(tmp_path / "at"), sink=landing.landing_writer(path))
    found = landing.landed_changes(spark, path)
    assert "position" in found.columns and found.count() == 12
    assert [r.id for r in found.orderBy("position").select(F.col("data")["id"].alias("id")).collect()] == [f"{i}-{k}" for i in range(3) for k in range(4)]
