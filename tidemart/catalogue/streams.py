"""Streaming forms, run over the tables as file streams until all input is done.

The watermark ends five seconds before the last event, so windows that end later stay open;
the SQL leaves them out as well.
"""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from tidemart.catalogue.registry import query
from tidemart.catalogue.stand_ins import (
    LOG_ROWS, ORDER_CHANGES, log_records, page_records, stamped, text,
)
from tidemart.functions.scalar import money
from tidemart.operators import aggregates as A, joins as J
from tidemart.plans import summaries as S
from tidemart.session import scratch_dir
from tidemart.sinks import keyed
from tidemart.streaming import idle, job, state

HOUR = "1 hour"


def ended(size: str, ts: str = "ts") -> str:
    """SQL condition: the row's window ends before the final watermark."""
    return (f"time_bucket(INTERVAL '{size}', {ts}, TIMESTAMP '1970-01-01') + INTERVAL '{size}' "
            f"<= (SELECT max(ts) FROM events) - INTERVAL 5 SECOND")


def events_stream(t):
    rows = t.stream("events").withColumn("row_time", F.col("ts").cast("timestamp"))
    return job.watermark(rows)


def pages_stream(t):
    return job.watermark(page_records(log_records(t.stream("events"))))


def run(t, *job_parts, ignore_idle=False, **options):
    """Run a stream to its end; one machine gets as many state partitions as it has cores."""
    job.stream_settings(t.spark, ignore_idle)
    context = t.spark.sparkContext
    partitions = context.defaultParallelism if context.master.startswith("local") else None
    job.run_to_end(*job_parts, state_partitions=partitions, **options)


def finish(t, df, name, ignore_idle=False):
    """Run a stream to its end and return what it wrote."""
    out = scratch_dir(t.spark, name)
    run(t, df, checkpoint=scratch_dir(t.spark, f"{name}-at"), path=out, ignore_idle=ignore_idle)
    return t.spark.read.schema(df.schema).parquet(out)


def stamp(df):
    return A.stamp_window(df, cur_date="window")


@query("w1_watermark", f"""SELECT {stamped(HOUR)}, count(*) AS n FROM events WHERE {ended(HOUR)} GROUP BY ALL""")
def _(t):
    return finish(t, stamp(A.window_sum_global(events_stream(t), HOUR, {"n": F.lit(1)})), "w1")


@query("w2_idleness", f"""SELECT {stamped(HOUR)}, count(*) AS n FROM events WHERE {ended(HOUR)} GROUP BY ALL""")
def _(t):
    """Two inputs, one of them silent for most of the time: on request it holds no window back."""
    silent = F.col("event_id") == 0
    busy, idle = (job.watermark(t.stream("events").where(c).withColumn("row_time", F.col("ts").cast("timestamp")))
                  for c in (~silent, silent))
    return finish(t, stamp(A.window_sum_global(busy.unionByName(idle), HOUR, {"n": F.lit(1)})), "w2", ignore_idle=True)


def event_inputs(t, *files):
    """Events dealt over streams by their ids, each stream with so many micro-batches, in time order."""
    at = F.unix_seconds(F.col("ts").cast("timestamp"))
    first, last = t.events.agg(F.min(at), F.max(at)).first()
    inputs = []
    for rest, n in enumerate(files):
        folder = scratch_dir(t.spark, f"w2-in{rest}")
        for k in range(n):
            slice_ = F.least(F.floor((at - first) * n / (last - first)), F.lit(n - 1)) == k
            t.events.where((F.col("event_id") % len(files) == rest) & slice_).coalesce(1).write.mode("append").parquet(folder)
        rows = t.spark.readStream.schema(t.events.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        inputs.append(rows.withColumn("row_time", F.col("ts").cast("timestamp")))
    return inputs


@query("w2_lagging_input", f"""SELECT {stamped(HOUR)}, count(*) AS n FROM events
WHERE time_bucket(INTERVAL '{HOUR}', ts, TIMESTAMP '1970-01-01') + INTERVAL '{HOUR}' <= (SELECT least(
  max(ts) FILTER (event_id % 2 = 0), max(ts) FILTER (event_id % 2 = 1)) FROM events) - INTERVAL 5 SECOND GROUP BY ALL""")
def _(t):
    """Two inputs over several micro-batches, one twice as far behind with each: none of its rows is lost."""
    inputs = [job.watermark(rows) for rows in event_inputs(t, 3, 6)]
    return finish(t, stamp(A.window_sum_global(inputs[0].unionByName(inputs[1]), HOUR, {"n": F.lit(1)})), "w2-lag")


@query("w2_idle_timeout", f"""SELECT {stamped(HOUR)}, count(*) AS n FROM events WHERE {ended(HOUR)} GROUP BY ALL""")
def _(t):
    """Three inputs: one busy, one that lags behind it and loses no row, one silent, for which no window waits."""
    busy, lagging = event_inputs(t, 3, 6)
    silent = scratch_dir(t.spark, "w2-silent")
    t.events.limit(0).write.parquet(silent)
    none = t.spark.readStream.schema(t.events.schema).parquet(silent).withColumn("row_time", F.col("ts").cast("timestamp"))
    inputs = idle.IdleInputs(t.spark, scratch_dir(t.spark, "w2-beats"), timeout=1)
    rows = [inputs.add(name, df) for name, df in (("busy", busy), ("lagging", lagging), ("silent", none))]
    out = scratch_dir(t.spark, "w2-idle")
    job.stream_settings(t.spark)
    inputs.start()
    counts = stamp(A.window_sum_global(rows[0].unionByName(rows[1]).unionByName(rows[2]), HOUR, {"n": F.lit(1)}))
    running = job.run_job(counts, checkpoint=scratch_dir(t.spark, "w2-idle-at"), path=out, available_now=False, state_partitions=2)
    try:
        inputs.await_quiet(running, 600)
    finally:
        running.stop()
        inputs.stop()
    return t.spark.read.schema(counts.schema).parquet(out)


@query("w3_tumble", f"""SELECT {stamped('5 seconds')}, event_type, count(*) AS n FROM events WHERE {ended('5 seconds')} GROUP BY ALL""")
def _(t):
    return finish(t, stamp(A.window_sum_by_key(events_stream(t), "5 seconds", ["event_type"], {"n": F.lit(1)})), "w3")


LATE_DAY = "2024-01-15"


@query("w4_late_drop", f"""SELECT {stamped(HOUR)}, count(*) AS n FROM events WHERE ts >= TIMESTAMP '{LATE_DAY}' AND {ended(HOUR)} GROUP BY ALL""")
def _(t):
    """Rows written after the watermark has passed them are dropped: the first half comes second."""
    folder, out, at = (scratch_dir(t.spark, n) for n in ("w4-in", "w4", "w4-at"))
    late = F.col("ts") < F.lit(LATE_DAY).cast("timestamp_ntz")
    for part in (~late, late):
        t.events.where(part).write.mode("append").parquet(folder)
        rows = t.spark.readStream.schema(t.events.schema).parquet(folder)
        rows = job.watermark(rows.withColumn("row_time", F.col("ts").cast("timestamp")))
        counts = stamp(A.window_sum_global(rows, HOUR, {"n": F.lit(1)}))
        run(t, counts, checkpoint=at, path=out)
    return t.spark.read.parquet(out)


@query("t1_first_of_day_stream", """SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_seen FROM events
GROUP BY user_id, CAST(ts AS DATE)""")
def _(t):
    firsts = state.active_days(events_stream(t), ["user_id"], ttl_seconds=86400)
    return finish(t, firsts.select("user_id", F.date_format("row_time", "yyyy-MM-dd HH:mm:ss").alias("first_seen")), "t1s")


@query("t2_first_ever_stream", """SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_seen FROM events GROUP BY user_id""")
def _(t):
    firsts = state.first_ever(events_stream(t), ["user_id"])
    return finish(t, firsts.select("user_id", F.date_format("row_time", "yyyy-MM-dd HH:mm:ss").alias("first_seen")), "t2s")


@query("t3_repair_new_flag_stream", f"""WITH {LOG_ROWS}, s AS (SELECT event_id, mid, is_new, CAST(ts AS DATE) AS day,
  last_value(CASE WHEN is_new = '0' THEN CAST(ts AS DATE) - 1 END IGNORE NULLS) OVER w AS zero_day,
  first_value(CASE WHEN is_new = '1' THEN CAST(ts AS DATE) END IGNORE NULLS) OVER w AS one_day
  FROM log WINDOW w AS (PARTITION BY mid ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT event_id, CASE WHEN is_new = '1' AND coalesce(zero_day, one_day, day) <> day THEN '0' ELSE is_new END AS is_new_fixed FROM s""")
def _(t):
    rows = log_records(t.stream("events")).select(
        "event_id", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"),
        F.timestamp_millis("ts").alias("row_time"))
    fixed = state.repair_new_flag(job.watermark(rows, delay=job.RAW_LOG_DELAY), "mid", F.col("is_new"), tie=["event_id"])
    return finish(t, fixed.select("event_id", "is_new_fixed"), "t3s")


@query("t6_delta_by_key_stream", """SELECT event_id, user_id, CAST(v - coalesce(lag(v) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0) AS DOUBLE) AS delta
FROM (SELECT *, CAST(value AS DECIMAL(18,2)) AS v FROM events)""")
def _(t):
    rows = events_stream(t).select("event_id", "user_id", "row_time", money("value").alias("v"))
    deltas = state.delta_by_key(rows, ["user_id"], {"delta": "v"}, tie=["event_id"])
    return finish(t, deltas.select("event_id", "user_id", "delta"), "t6s")


@query("t8_state_ttl_stream", """WITH v AS (SELECT event_id, user_id, ts, CAST(value AS DECIMAL(18,2)) AS v FROM events),
p AS (SELECT *, lag(v) OVER w AS pv, lag(ts) OVER w AS pt FROM v WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, user_id, CAST(v - CASE WHEN epoch_us(ts) // 1000 - epoch_us(pt) // 1000 < 21600000 THEN pv ELSE 0 END AS DOUBLE) AS delta FROM p""")
def _(t):
    rows = events_stream(t).select("event_id", "user_id", "row_time", money("value").alias("v"))
    deltas = state.delta_by_key(rows, ["user_id"], {"delta": "v"}, tie=["event_id"], ttl_seconds=6 * 3600)
    return finish(t, deltas.select("event_id", "user_id", "delta"), "t8s")


@query("u3_keyed_process_stream", """SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS visit,
  max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS top FROM events""")
def _(t):
    """User code: number the visits of each user and keep the largest value so far."""
    def step(state, row):
        visits, top = state or (0, row["value"])
        now = (visits + 1, max(top, row["value"]))
        return now, list(now)
    rows = events_stream(t).select("event_id", "user_id", "value", "row_time")
    schema = T.StructType([T.StructField("visit", T.LongType()), T.StructField("top", T.DoubleType())])
    out = state.keyed_process(rows, ["user_id"], step, schema, schema, tie=["event_id"])
    return finish(t, out.select("event_id", "user_id", "visit", "top"), "u3s")


@query("u4_job_skeleton_stream", f"""SELECT {stamped(HOUR)}, count(*) AS n FROM events WHERE event_type = 'click'
  AND {ended(HOUR).replace("FROM events)", "FROM events WHERE event_type = 'click')")} GROUP BY ALL""")
def _(t):
    """Source, handlers and sink given to the job skeleton."""
    out = scratch_dir(t.spark, "u4")
    run(
        t, t.stream("events").withColumn("row_time", F.col("ts").cast("timestamp")),
        lambda df: df.where(F.col("event_type") == "click"), job.watermark,
        lambda df: A.window_sum_global(df, HOUR, {"n": F.lit(1)}), stamp,
        checkpoint=scratch_dir(t.spark, "u4-at"), path=out)
    return t.spark.read.parquet(out)


@query("j1_order_wide_inner_stream", f"""WITH {ORDER_CHANGES}
SELECT a.id, a.user_id, b.order_status, a.ts FROM order_changes a JOIN order_changes b ON a.id = b.id AND abs(a.ts - b.ts) <= 90000
WHERE a.type IN ('insert', 'bootstrap-insert') AND b.type = 'update'""")
def _(t):
    """New orders with their first status change, at most 25 hours apart."""
    def selection(types, *columns):
        stream = type(t)(t.spark, t.folder)
        stream.__dict__["orders"] = t.stream("orders")
        rows = stream.order_changes.where(F.col("type").isin(*types)).withColumn("row_time", F.timestamp_seconds("ts"))
        return job.watermark(rows).select(*(F.col("data")[c].alias(c) for c in ("id", *columns)), "ts", "row_time")
    created = selection(("insert", "bootstrap-insert"), "user_id")
    changed = selection(("update",), "order_status")
    return finish(t, J.join_changes(created, changed.drop("ts"), "id", "id", within=90000).select(
        "id", "user_id", "order_status", "ts"), "j1s")


@query("j5_interval_join_stream", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey
WHERE o_orderdate BETWEEN l_shipdate - INTERVAL 15 DAY AND l_shipdate + INTERVAL 5 DAY""")
def _(t):
    left = t.stream("lineitem").select(F.col("l_orderkey").alias("key"), "l_linenumber", "l_partkey", "l_suppkey",
                                       F.col("l_shipdate").cast("timestamp").alias("od_time"))
    right = t.stream("orders").select(F.col("o_orderkey").alias("key"), "o_custkey",
                                      F.col("o_orderdate").cast("timestamp").alias("pay_time"))
    rows = J.interval_join(job.watermark(left, "od_time"), job.watermark(right, "pay_time"), "key", "od_time", "pay_time",
                           -15 * 86400, 5 * 86400)
    return finish(t, rows.select(F.col("key").alias("l_orderkey"), "l_linenumber", "l_partkey", "l_suppkey", "o_custkey"), "j5s")


@query("j6_lookup_join_stream", """SELECT event_id, n_name AS dic_name FROM events JOIN nation ON n_nationkey = user_id % 30""")
def _(t):
    rows = t.stream("events").select("event_id", text(F.col("user_id") % 30).alias("code"))
    return finish(t, J.lookup_join(rows, t.dictionary, "code", {"dic_name": "info.dic_name"}).drop("code"), "j6s")


@query("q14_traffic_window_stream", f"""WITH {LOG_ROWS}, p AS (SELECT *,
  row_number() OVER (PARTITION BY mid, CAST(ts AS DATE) ORDER BY ts) AS day_rn, row_number() OVER (PARTITION BY sid ORDER BY ts) AS sid_rn FROM pages_log)
SELECT {stamped(HOUR)}, vc, ch, ar, is_new, count(*) FILTER (WHERE day_rn = 1) AS uv_ct, count(*) FILTER (WHERE sid_rn = 1) AS sv_ct,
  count(*) AS pv_ct, CAST(sum(during_time) AS BIGINT) AS dur_sum FROM p
WHERE {ended(HOUR).replace("FROM events", "FROM pages_log")} GROUP BY ALL""")
def _(t):
    """Summary rows go through the idempotent sink, one folder per micro-batch."""
    out = scratch_dir(t.spark, "q14s")
    df = S.traffic_window(pages_stream(t), HOUR, "window")
    keys = ["stt", "edt", "vc", "ch", "ar", "is_new"]
    run(t, df, checkpoint=scratch_dir(t.spark, "q14s-at"),
        sink=lambda rows, batch: keyed.write_summary(rows, out, batch))
    return keyed.read_summary(t.spark, out, keys)


@query("q16_login_window_stream", f"""WITH {LOG_ROWS}, u AS (SELECT uid, CAST(ts AS DATE) AS day, min(ts) AS ts FROM pages_log
  WHERE uid IS NOT NULL AND (last_page_id IS NULL OR last_page_id = 'login') GROUP BY 1, 2),
b AS (SELECT *, CASE WHEN day - lag(day) OVER (PARTITION BY uid ORDER BY day) > 7 THEN 1 ELSE 0 END AS back FROM u)
SELECT {stamped(HOUR)}, CAST(sum(back) AS BIGINT) AS back_ct, count(*) AS uu_ct FROM b
WHERE {ended(HOUR).replace("FROM events", "FROM pages_log")} GROUP BY ALL""")
def _(t):
    return finish(t, S.login_window(pages_stream(t), HOUR, cur_date="window"), "q16s")


@query("q18_cart_user_window_stream", f"""WITH u AS (SELECT user_id, min(ts) AS ts FROM events GROUP BY user_id, CAST(ts AS DATE))
SELECT {stamped(HOUR)}, count(*) AS cart_add_uu_ct FROM u WHERE {ended(HOUR)} GROUP BY ALL""")
def _(t):
    rows = events_stream(t).select(text("user_id").alias("user_id"), "row_time")
    return finish(t, S.cart_user_window(rows, HOUR, "window"), "q18s")


@query("q22_province_order_window_stream", f"""WITH d AS (SELECT ts, event_id, user_id % 30 AS p, CAST(value AS DECIMAL(18,2))
  - coalesce(lag(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0) AS total FROM events),
s AS (SELECT {stamped(HOUR)}, p, count(DISTINCT event_id) AS order_count, CAST(sum(total) AS DOUBLE) AS order_amount FROM d
  WHERE {ended(HOUR)} GROUP BY stt, edt, cur_date, p)
SELECT stt, edt, cur_date, CAST(p AS VARCHAR) AS province_id, order_count, order_amount, n_name AS province_name
FROM s LEFT JOIN nation ON n_nationkey = p""")
def _(t):
    """Events stand for re-sent details of one id per user, keyed state before a two-level distinct count."""
    rows = events_stream(t).select(
        text("user_id").alias("id"), text("event_id").alias("order_id"), text(F.col("user_id") % 30).alias("province_id"),
        "row_time", "event_id", text(money("value")).alias("split_total_amount"))
    return finish(t, S.province_order_window(rows, t.provinces, HOUR, ["event_id"], cur_date="window"), "q22s")
