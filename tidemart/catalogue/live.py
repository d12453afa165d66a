"""Streams over several micro-batches during which dimensions change.

The first micro-batch sees the first commit of the dimensions; the others are committed by another job's hand, as soon
as the first micro-batch is written.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.catalogue.jobs import DIC, ORDER_DIM_SQL
from tidemart.catalogue.registry import query
from tidemart.catalogue.stand_ins import DB, PRODUCT, stamped, text
from tidemart.catalogue.streams import HOUR, ended, stamp
from tidemart.functions.scalar import money
from tidemart.operators import aggregates as A
from tidemart.plans import facts, routes, summaries as S
from tidemart.session import scratch_dir
from tidemart.sinks import keyed
from tidemart.sources.tables import as_dim
from tidemart.streaming import job, live


def in_batches(t, name, *parts):
    """Tables as one file stream that gives one of them per micro-batch.

    Each is written by as many tasks as read it.  Tasks without rows write no file; empty files make up for them, so that
    all tables have the same number, which a micro-batch takes.
    """
    folder = scratch_dir(t.spark, name)
    files = max(part.rdd.getNumPartitions() for part in parts)
    for k, part in enumerate(parts):
        where = f"{folder}/{k}"
        part.write.parquet(where)
        for _ in range(files - len(t.spark.read.schema(part.schema).parquet(where).inputFiles())):
            t.spark.createDataFrame([], part.schema).coalesce(1).write.mode("append").parquet(where)
    return t.spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/*")


def puts(table: str, rows, key: str = "id", ts: int = 1):
    """All rows of a dimension as inserts."""
    cells = [x for c in rows.columns if c != key for x in (F.lit(c), text(c))]
    return rows.select(F.lit(table).alias("sink_table"), text(key).alias("rowkey"), F.create_map(*cells).alias("data"),
                       F.lit("insert").alias("type"), F.lit(ts).cast("long").alias("ts"))


def run_with_commits(t, stream, finish, tables, commits, name, keys):
    """Run a stream over dimensions whose first commit is there at its start and whose others follow its first micro-batch."""
    dims_at, out = scratch_dir(t.spark, f"{name}-dims"), scratch_dir(t.spark, name)
    keyed.dim_upsert(commits[0], dims_at, 0)

    def sink(df, batch_id):
        keyed.upsert(df, keys, [], out, batch_id) if keys else keyed.write_summary(df, out, batch_id)
        if batch_id == 0:
            for i, commit in enumerate(commits[1:], 1):
                keyed.dim_upsert(commit, dims_at, i)

    job.stream_settings(t.spark)
    context = t.spark.sparkContext
    partitions = context.defaultParallelism if context.master.startswith("local") else None
    live.run_live(stream, finish, live.LiveDims(dims_at, tables), sink, scratch_dir(t.spark, f"{name}-at"),
                  state_partitions=partitions).awaitTermination()
    return keyed.read_committed(t.spark, out).drop("batch")


@query("j6_live_dimension_stream", f"""WITH {DIC}, seen AS (
  SELECT 0 AS half, rowkey, dic_name FROM dic WHERE CAST(rowkey AS INT) % 3 <> 0
  UNION ALL SELECT 1, rowkey, CASE WHEN CAST(rowkey AS INT) % 7 = 1 THEN 'new ' || dic_name ELSE dic_name END FROM dic WHERE rowkey <> '2')
SELECT CAST(doc_id AS VARCHAR) AS id, CAST(doc_id % 30 AS VARCHAR) AS appraise, dic_name, text AS comment_txt
FROM documents JOIN seen ON rowkey = CAST(doc_id % 30 AS VARCHAR) AND half = doc_id % 2 WHERE lang <> 'es'""")
def _(t):
    """Between two micro-batches rows are added to the dictionary, others changed and one deleted."""
    number = F.col("data")["id"].cast("bigint")
    halves = [t.comment_changes.where(number % 2 == k) for k in (0, 1)]
    dic = t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("dic_name"))
    first = puts("dim_base_dic", dic.where("id % 3 <> 0"))
    added = puts("dim_base_dic", dic.where("id % 3 = 0"), ts=2)
    changed = puts("dim_base_dic", dic.where("id % 7 = 1").withColumn("dic_name", F.concat(F.lit("new "), "dic_name")), ts=3)
    gone = puts("dim_base_dic", dic.where("id = 2"), ts=3).withColumn("type", F.lit("delete"))
    finish = lambda rows, dims: facts.name_comments(rows, as_dim(dims["dim_base_dic"], "id", ["dic_name"]))
    found = run_with_commits(t, facts.comment_rows(in_batches(t, "j6l-in", *halves), DB), finish, {"dim_base_dic": ["dic_name"]},
                             [first, added, changed.unionByName(gone)], "j6l", None)
    return found.select("id", "appraise", "dic_name", "comment_txt")


def event_halves(t, name):
    """The events in two micro-batches, earlier ones first."""
    at = F.unix_seconds(F.col("ts").cast("timestamp"))
    middle = t.events.agg(F.floor((F.min(at) + F.max(at)) / 2)).first()[0]
    rows = in_batches(t, name, t.events.where(at < middle), t.events.where(at >= middle))
    return job.watermark(rows.withColumn("row_time", F.col("ts").cast("timestamp")))


@query("j8_live_dimension_stream", f"""WITH d AS (SELECT ts, event_id, user_id % 30 AS p, CAST(value AS DECIMAL(18,2))
  - coalesce(lag(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0) AS total FROM events),
s AS (SELECT {stamped(HOUR)}, p, count(DISTINCT event_id) AS order_count, CAST(sum(total) AS DOUBLE) AS order_amount FROM d
  WHERE {ended(HOUR)} GROUP BY stt, edt, cur_date, p)
SELECT stt, edt, cur_date, CAST(p AS VARCHAR) AS province_id, order_count, order_amount, n_name AS province_name
FROM s LEFT JOIN nation ON n_nationkey = p""")
def _(t):
    """Windows close after the first micro-batch: provinces added behind it are found by all of them."""
    rows = event_halves(t, "j8l-in").select(
        text("user_id").alias("id"), text("event_id").alias("order_id"), text(F.col("user_id") % 30).alias("province_id"),
        "row_time", "event_id", text(money("value")).alias("split_total_amount"))
    provinces = t.provinces
    even = F.col("id").cast("int") % 2 == 0
    return run_with_commits(
        t, S.province_order_sums(rows, HOUR, ["event_id"], cur_date="window"),
        lambda sums, dims: S.name_provinces(sums, dims["dim_base_province"]), {"dim_base_province": ["name"]},
        [puts("dim_base_province", provinces.where(even)), puts("dim_base_province", provinces.where(~even))], "j8l", None)


DIMENSIONS = {
    "dim_sku_info": ["spu_id", "category3_id", "tm_id"], "dim_spu_info": ["spu_name"], "dim_base_trademark": ["tm_name"],
    "dim_base_category3": ["name", "category2_id"], "dim_base_category2": ["name", "category1_id"], "dim_base_category1": ["name"],
}


@query("j9_live_dimension_stream", f"""WITH {PRODUCT.removeprefix('WITH ')},
r AS (SELECT ts, CAST(user_id % 40 AS VARCHAR) AS user_id, CAST(event_id % 500 AS VARCHAR) AS order_id, trademark_id, trademark_name,
  category3_id, category3_name, category2_id, category2_name, category1_id, category1_name
  FROM events LEFT JOIN product ON product.sku_id = CAST(user_id % 150 AS VARCHAR) WHERE {ended('1 day')})
SELECT {stamped('1 day')}, user_id, trademark_id, trademark_name, category3_id, category3_name, category2_id, category2_name,
  category1_id, category1_name, count(DISTINCT order_id) AS refund_count FROM r GROUP BY ALL""")
def _(t):
    """Refunds per trademark and category, by products and a category chain of which a part comes between micro-batches."""
    rows = event_halves(t, "j9l-in").select(
        text(F.col("user_id") % 40).alias("user_id"), text(F.col("user_id") % 150).alias("sku_id"),
        text(F.col("event_id") % 500).alias("order_id"), "row_time")
    parts = [puts(name, t.product_dims[name].select("id", *columns)) for name, columns in DIMENSIONS.items()]
    dims = parts[0].unionByName(parts[1])
    for part in parts[2:]:
        dims = dims.unionByName(part)
    early = F.xxhash64("sink_table", "rowkey") % 2 == 0
    return run_with_commits(t, S.refund_orders(rows, "1 day"), lambda orders, found: S.count_refunds(orders, found, cur_date="window"),
                            DIMENSIONS, [dims.where(early), dims.where(~early)], "j9l", None)


@query("q1_live_config_stream", f"""WITH d AS ({ORDER_DIM_SQL})
SELECT rowkey, CASE WHEN CAST(rowkey AS BIGINT) % 3 < 2 THEN user_id END AS user_id,
  CASE WHEN CAST(rowkey AS BIGINT) % 3 = 1 THEN order_status END AS order_status FROM d WHERE CAST(rowkey AS BIGINT) % 3 < 2""")
def _(t):
    """Three micro-batches of a dimension load: after the first the config gets a column more, after the second it is deleted."""
    part = F.coalesce(F.col("data")["id"].cast("bigint") % 3, F.lit(0))
    stream = in_batches(t, "q1l-in", *(t.order_changes.where(part == k) for k in range(3)))
    config_at, out = scratch_dir(t.spark, "q1l-config"), scratch_dir(t.spark, "q1l")
    entry = lambda columns, op, ts: t.spark.createDataFrame(
        [("order_info", "dim_order", columns, "id", op, ts)],
        "source_table string, sink_table string, sink_columns string, sink_row_key string, op string, ts bigint")
    commits = [entry("id,user_id", "c", 1), entry("id,user_id,order_status", "u", 2), entry("id,user_id,order_status", "d", 3)]
    commit = lambda i: keyed.upsert(commits[i], ["source_table"], ["ts"], config_at, i)
    commit(0)

    def sink(df, batch_id):
        keyed.dim_upsert(df, out, batch_id)
        if batch_id + 1 < len(commits):
            commit(batch_id + 1)

    live.run_live(stream, lambda rows, config: routes.dim_rows(rows, config, DB), live.LiveConfig(config_at, ["source_table"]), sink,
                  scratch_dir(t.spark, "q1l-at")).awaitTermination()
    return keyed.read_dim(t.spark, out, "dim_order", ["user_id", "order_status"])
