"""The jobs' inputs derived from the generated tables, in Spark and in SQL.

Nothing is filtered away to keep checks cheap: every derived table grows with its source.
The SQL constants are the same derivations as common table expressions.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemart.functions.scalar import DATETIME, wall_ms
from tidemart.operators.changes import op_name
from tidemart.schemas import ACTION, COMMON, DISPLAY, ERR, LOG, PAGE, START
from tidemart.sources.tables import as_dim

DB = "shop"


def text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def amount(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)")


def seconds(ntz: str) -> Column:
    return F.floor(wall_ms(ntz) / 1000).cast("bigint")


def stamp(ntz: str) -> Column:
    return F.date_format(F.col(ntz), DATETIME)


def no_map() -> Column:
    return F.lit(None).cast("map<string,string>")


def as_changes(df: DataFrame, table: str, payload, type_: Column, ts: Column, old: Column | None = None) -> DataFrame:
    """Change-log rows whose payload holds the named columns as text."""
    pairs = [x for c in payload for x in (F.lit(c), text(c))]
    return df.select(
        F.lit(DB).alias("database"), F.lit(table).alias("table"), type_.alias("type"), ts.alias("ts"),
        F.create_map(*pairs).alias("data"), (no_map() if old is None else old).alias("old"),
    )


class Tables:
    """The generated tables of one folder, and the inputs derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def stream(self, name: str, **options) -> DataFrame:
        """A table as a file stream."""
        schema = self.spark.read.parquet(self.path(name)).schema
        return self.spark.readStream.schema(schema).options(**options).parquet(self.path(name) + "*")

    # ---- orders as change log: two to three changes per order

    @cached_property
    def order_changes(self) -> DataFrame:
        boot = F.col("o_custkey") % 3 == 0
        final = F.when(F.col("o_orderstatus") == "F", "1003").when(
            F.col("o_orderstatus") == "O", "1005").otherwise("1006")
        secs = seconds("o_orderdate")

        def data(status: Column) -> Column:
            return F.create_map(
                F.lit("id"), text("o_orderkey"), F.lit("user_id"), text("o_custkey"),
                F.lit("province_id"), text(F.col("o_custkey") % 25), F.lit("order_status"), status,
                F.lit("operate_time"), stamp("o_orderdate"),
            )

        def change(type_: Column, ts: Column, payload: Column, old: Column) -> Column:
            return F.struct(type_.alias("type"), ts.alias("ts"), payload.alias("data"), old.alias("old"))

        old = F.when(F.col("o_custkey") % 3 == 1, F.create_map(F.lit("order_status"), F.lit("1001"))).otherwise(
            F.create_map(F.lit("operate_time"), F.lit("-")))
        empty = F.create_map().cast("map<string,string>")
        rows = F.array_compact(F.array(
            change(F.when(boot, "bootstrap-insert").otherwise("insert"), secs,
                   data(F.when(boot, final).otherwise("1001")), no_map()),
            change(F.lit("update"), secs + 86400, data(final), old),
            F.when(F.col("o_orderpriority") == "5-LOW",
                   change(F.lit("delete"), secs + 172800, data(final), no_map())),
            F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED",
                   change(F.lit("bootstrap-complete"), secs, empty, no_map())),
        ))
        return self.orders.select(F.explode(rows).alias("c")).select(
            F.lit(DB).alias("database"), F.lit("order_info").alias("table"), "c.*"
        )

    # ---- line items as order details

    @cached_property
    def details(self) -> DataFrame:
        """Order details as the fact topic holds them, without user, province and discounts' ids."""
        return self.lineitem.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
            text("l_orderkey").alias("order_id"), text("l_partkey").alias("sku_id"),
            F.concat(F.lit("sku "), "l_partkey").alias("sku_name"),
            text(amount("l_extendedprice")).alias("order_price"),
            text(F.col("l_quantity").cast("int")).alias("sku_num"),
            stamp("l_shipdate").alias("create_time"),
            text(amount("l_extendedprice")).alias("split_total_amount"),
            F.when(F.col("l_discount") >= 0.03, text(F.round(F.col("l_discount") * 100).cast("int")))
            .alias("split_activity_amount"),
            F.when(F.col("l_returnflag") != "A", text(F.round(F.col("l_tax") * 100).cast("int")))
            .alias("split_coupon_amount"),
            seconds("l_shipdate").alias("ts"),
            "l_partkey", "l_suppkey", "l_linenumber", "l_orderkey", "l_returnflag", "l_linestatus",
            "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        )

    DETAIL_PAYLOAD = (
        "id", "order_id", "sku_id", "sku_name", "order_price", "sku_num", "create_time",
        "split_total_amount", "split_activity_amount", "split_coupon_amount",
    )

    @cached_property
    def detail_changes(self) -> DataFrame:
        type_ = F.when(F.col("l_returnflag") == "A", "bootstrap-insert").otherwise("insert")
        return as_changes(self.details, "order_detail", self.DETAIL_PAYLOAD, type_, F.col("ts"))

    @cached_property
    def activity_changes(self) -> DataFrame:
        rows = self.details.where(F.col("l_discount") >= 0.08).select(
            F.col("id").alias("order_detail_id"),
            F.concat(F.lit("a"), F.col("l_partkey") % 7).alias("activity_id"),
            F.concat(F.lit("r"), F.col("l_suppkey") % 5).alias("activity_rule_id"), "ts",
        )
        payload = ("order_detail_id", "activity_id", "activity_rule_id")
        return as_changes(rows, "order_detail_activity", payload, F.lit("insert"), F.col("ts"))

    @cached_property
    def coupon_changes(self) -> DataFrame:
        rows = self.details.where((F.col("l_returnflag") == "R") & (F.col("l_tax") >= 0.05)).select(
            F.col("id").alias("order_detail_id"),
            F.concat(F.lit("c"), F.col("l_suppkey") % 9).alias("coupon_id"), "ts",
        )
        return as_changes(rows, "order_detail_coupon", ("order_detail_id", "coupon_id"), F.lit("insert"), F.col("ts"))

    @cached_property
    def sales_changes(self) -> DataFrame:
        """The four tables of the order detail job in one change log."""
        return (
            self.order_changes.unionByName(self.detail_changes)
            .unionByName(self.activity_changes).unionByName(self.coupon_changes)
        )

    @cached_property
    def sales_details(self) -> DataFrame:
        """Details with the user and province of their order, in event time."""
        orders = self.orders.select(
            F.col("o_orderkey").alias("l_orderkey"), text("o_custkey").alias("user_id"),
            text(F.col("o_custkey") % 25).alias("province_id"),
        )
        return self.details.join(orders, "l_orderkey").withColumn("row_time", F.timestamp_seconds("ts"))

    def sales_details_only(self) -> DataFrame:
        """Details in event time, without their order."""
        return self.details.withColumn("row_time", F.timestamp_seconds("ts"))

    RESENT_TIE = (
        "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus",
    )

    # ---- payments, refunds, carts, comments

    @cached_property
    def payment_changes(self) -> DataFrame:
        kind = F.col("o_custkey") % 3
        rows = self.orders.select(
            F.concat(F.lit("p"), "o_orderkey").alias("id"), text("o_orderkey").alias("order_id"),
            text("o_custkey").alias("user_id"), text(F.col("o_custkey") % 30).alias("payment_type"),
            stamp("o_orderdate").alias("callback_time"), F.lit("1602").alias("payment_status"),
            kind.alias("kind"), seconds("o_orderdate").alias("ts"),
        )
        type_ = F.when(F.col("kind") == 0, "bootstrap-insert").when(F.col("kind") == 1, "update").otherwise("insert")
        old = F.when(F.col("kind") == 1, F.create_map(F.lit("payment_status"), F.lit("1601")))
        payload = ("id", "order_id", "user_id", "payment_type", "callback_time", "payment_status")
        return as_changes(rows, "payment_info", payload, type_, F.col("ts"), old)

    @cached_property
    def refund_changes(self) -> DataFrame:
        """Two changes per returned line: the request, and its approval."""
        rows = self.details.where(F.col("l_returnflag") == "R").select(
            F.concat(F.lit("rf"), "id").alias("id"), text("l_suppkey").alias("user_id"), "order_id", "sku_id",
            text("l_linenumber").alias("refund_type"), F.col("sku_num").alias("refund_num"),
            F.col("split_total_amount").alias("refund_amount"),
            text(F.col("l_suppkey") % 30).alias("refund_reason_type"),
            F.concat(F.lit("reason "), "l_suppkey").alias("refund_reason_txt"), "create_time", "ts", "l_linestatus",
        )
        payload = ("id", "user_id", "order_id", "sku_id", "refund_type", "refund_num", "refund_amount",
                   "refund_reason_type", "refund_reason_txt", "create_time", "refund_status")
        asked = rows.withColumn("refund_status", F.lit("0701"))
        approved = rows.withColumn("refund_status", F.lit("0705"))
        old = F.when(F.col("l_linestatus") == "F", F.create_map(F.lit("refund_status"), F.lit("0701"))).otherwise(
            F.create_map(F.lit("refund_num"), F.lit("0")))
        return as_changes(asked, "order_refund_info", payload, F.lit("insert"), F.col("ts")).unionByName(
            as_changes(approved, "order_refund_info", payload, F.lit("update"), F.col("ts") + 60, old))

    @cached_property
    def refund_payment_changes(self) -> DataFrame:
        rows = self.details.where((F.col("l_returnflag") == "R") & (F.col("l_tax") >= 0.04)).select(
            F.concat(F.lit("rp"), "id").alias("id"), "order_id", "sku_id",
            text(F.col("l_suppkey") % 30).alias("payment_type"), F.col("create_time").alias("callback_time"),
            F.col("split_total_amount").alias("total_amount"), F.lit("1602").alias("refund_status"), "ts", "l_linenumber",
        )
        type_ = F.when(F.col("l_linenumber") % 2 == 0, "bootstrap-insert").otherwise("update")
        old = F.when(F.col("l_linenumber") % 4 == 1, F.create_map(F.lit("refund_status"), F.lit("1601")))
        payload = ("id", "order_id", "sku_id", "payment_type", "callback_time", "total_amount", "refund_status")
        return as_changes(rows, "refund_payment", payload, type_, F.col("ts"), old)

    CART_PAYLOAD = ("id", "user_id", "sku_id", "cart_price", "sku_num", "sku_name", "is_checked",
                    "create_time", "operate_time", "is_ordered", "order_time")

    @cached_property
    def carts(self) -> DataFrame:
        return self.details.select(
            F.concat(F.lit("ct"), "id").alias("id"), text("l_suppkey").alias("user_id"), "sku_id",
            F.col("order_price").alias("cart_price"), "sku_num", "sku_name", F.lit("1").alias("is_checked"),
            "create_time", F.lit(None).cast("string").alias("operate_time"), F.lit("0").alias("is_ordered"),
            F.lit(None).cast("string").alias("order_time"), "ts", "l_returnflag", "l_linestatus", "l_linenumber",
        )

    _old_num = staticmethod(lambda: F.when(
        F.col("l_linestatus") == "F", F.create_map(F.lit("sku_num"), text(F.col("l_linenumber") * 7))
    ).otherwise(F.create_map(F.lit("is_checked"), F.lit("0"))))

    @cached_property
    def cart_changes(self) -> DataFrame:
        type_ = F.when(F.col("l_returnflag") == "A", "insert").when(F.col("l_returnflag") == "N", "update").when(
            F.col("l_linestatus") == "F", "bootstrap-insert").otherwise("delete")
        return as_changes(self.carts, "cart_info", self.CART_PAYLOAD, type_, F.col("ts"), self._old_num())

    def _cart_images(self) -> tuple[Column, Column, Column]:
        """Operation, old and new image of a cart change."""
        op = F.when(F.col("l_returnflag") == "A", "c").when(F.col("l_returnflag") == "N", "u").when(
            F.col("l_linestatus") == "F", "r").otherwise("d")
        image = F.create_map(*[x for c in self.CART_PAYLOAD for x in (F.lit(c), text(c))])
        return op, F.when(op == "d", image).when(op == "u", self._old_num()), F.when(op != "d", image)

    @cached_property
    def cart_debezium(self) -> DataFrame:
        op, before, after = self._cart_images()
        return self.carts.select(
            op.alias("op"), before.alias("before"), after.alias("after"),
            F.create_map(F.lit("db"), F.lit(DB), F.lit("table"), F.lit("cart_info")).alias("source"),
            (F.col("ts") * 1000).alias("ts_ms"),
        )

    @cached_property
    def placed_carts(self) -> DataFrame:
        """The cart changes in the order in which they are written to the log.

        As in a topic, the changes of a cart row share a partition, and that is the order they have.  Lines are dealt and
        sorted before their images are made.
        """
        dealt = type(self)(self.spark, self.folder)
        dealt.__dict__["lineitem"] = self.lineitem.repartition("l_orderkey", "l_linenumber")
        op, before, _ = self._cart_images()
        dealt.__dict__["carts"] = dealt.carts.sortWithinPartitions(
            F.col("sku_num").cast("bigint").desc(), "user_id", "sku_id", "cart_price",
            op_name(op), F.to_json(before).asc_nulls_first())
        return dealt.cart_debezium

    @cached_property
    def comment_changes(self) -> DataFrame:
        rows = self.documents.select(
            text("doc_id").alias("id"), text(F.col("doc_id") % 97).alias("user_id"), F.col("source").alias("nick_name"),
            text(F.col("doc_id") % 200).alias("sku_id"), text(F.col("doc_id") % 20).alias("spu_id"),
            text(F.col("doc_id") * 3).alias("order_id"), text(F.col("doc_id") % 30).alias("appraise"),
            F.col("text").alias("comment_txt"), F.lit("2024-01-01 00:00:00").alias("create_time"), "doc_id", "lang",
        )
        type_ = F.when(F.col("lang") == "es", "update").otherwise("insert")
        payload = ("id", "user_id", "nick_name", "sku_id", "spu_id", "order_id", "appraise", "comment_txt", "create_time")
        return as_changes(rows, "comment_info", payload, type_, F.col("doc_id"))

    # ---- dimensions

    @cached_property
    def dictionary(self) -> DataFrame:
        return as_dim(self.nation.withColumnRenamed("n_name", "dic_name"), "n_nationkey", ["dic_name"])

    @cached_property
    def provinces(self) -> DataFrame:
        return self.nation.select(text("n_nationkey").alias("id"), F.col("n_name").alias("name"))

    @cached_property
    def product_dims(self) -> dict[str, DataFrame]:
        part = self.part
        types = part.select("p_type").distinct()
        levels = types.select(F.length("p_type").alias("n")).distinct()
        tops = levels.select((F.col("n") % 2).alias("m")).distinct()
        return {
            "dim_sku_info": part.select(
                text("p_partkey").alias("id"), text("p_size").alias("spu_id"),
                F.col("p_type").alias("category3_id"), F.col("p_brand").alias("tm_id")),
            "dim_spu_info": part.select("p_size").distinct().select(
                text("p_size").alias("id"), F.concat(F.lit("spu "), "p_size").alias("spu_name")),
            "dim_base_trademark": part.select("p_brand").distinct().select(
                F.col("p_brand").alias("id"), F.lower("p_brand").alias("tm_name")),
            "dim_base_category3": types.select(
                F.col("p_type").alias("id"), F.lower("p_type").alias("name"), text(F.length("p_type")).alias("category2_id")),
            "dim_base_category2": levels.select(
                text("n").alias("id"), F.concat(F.lit("c2 "), "n").alias("name"), text(F.col("n") % 2).alias("category1_id")),
            "dim_base_category1": tops.select(text("m").alias("id"), F.concat(F.lit("c1 "), "m").alias("name")),
        }

    # ---- behaviour log

    @cached_property
    def log(self) -> DataFrame:
        return log_records(self.events)

    @cached_property
    def log_messages(self) -> DataFrame:
        """The log as JSON text; one record in thirteen is cut short."""
        return log_text(self.log)

    @cached_property
    def pages(self) -> DataFrame:
        """Page records in event time."""
        return page_records(self.log)


def log_records(events: DataFrame) -> DataFrame:
    """Behaviour log records from the event table; `event_id` and `k` are kept beside them."""
    k = F.col("k")
    e = events.withColumns({
        "k": F.regexp_extract("props", r"(\d+)", 1).cast("int"), "ms": wall_ms("ts").cast("bigint"),
    })
    kind = F.col("event_type")

    def record(schema, **values) -> Column:
        return F.struct(*(
            values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
        ))

    common = record(
        COMMON, ar=text(F.col("user_id") % 7), ch=F.concat(F.lit("c"), k % 3),
        is_new=F.when(k % 3 == 0, "1").otherwise("0"), mid=F.concat(F.lit("m"), "user_id"),
        sid=F.concat(F.lit("s"), "user_id", F.lit("-"), F.date_format("ts", "yyyyMMdd")),
        uid=F.when(k % 10 != 9, text("user_id")), vc=F.concat(F.lit("v"), k % 4),
    )
    page = record(
        PAGE,
        page_id=F.when(kind == "view", "home").when(kind == "click", "good_detail")
        .when(kind == "purchase", "payment").otherwise("mine"),
        last_page_id=F.when(k % 5 == 0, "login").when(k % 5 == 2, "search").when(k % 5 == 3, "home")
        .when(k % 5 == 4, "good_list"),
        item=F.when(k % 11 != 0, F.concat(kind, F.lit(" kw"), k % 10, F.lit(", "), F.upper(kind))),
        item_type=F.when(k % 2 == 0, "keyword").otherwise("sku_id"), during_time=k * 100,
    )
    is_start = kind == "signup"
    display = lambda i: record(DISPLAY, pos_seq=i, item=text(k + i), item_type=F.lit("sku_id"), pos_id=i * 10)
    action = lambda i: record(ACTION, item=text(k + i), action_id=F.concat(F.lit("a"), i), item_type=F.lit("sku_id"),
                              ts=F.col("ms") + i)
    shown = kind.isin("view", "click") & (k % 4 > 0)
    acted = kind.isin("click", "purchase") & (k % 3 > 0)
    return e.select(
        common.alias("common"),
        F.when(~is_start, page).alias("page"),
        F.when(is_start, record(START, entry=F.lit("icon"), loading_time=k)).alias("start"),
        F.when(shown, F.transform(F.sequence(F.lit(1), k % 4), display)).alias("displays"),
        F.when(acted, F.transform(F.sequence(F.lit(1), k % 3), action)).alias("actions"),
        F.when(kind == "error", record(ERR, msg=F.concat(F.lit("e"), k), error_code=k)).alias("err"),
        F.col("ms").alias("ts"), "event_id", "k",
    )


def log_text(log: DataFrame) -> DataFrame:
    whole = F.to_json(F.struct(*LOG.fieldNames()))
    cut = F.concat(F.lit('{"common": {"mid": '), "k")
    return log.select(F.when(F.col("k") % 13 == 0, cut).otherwise(whole).alias("value"))


def page_records(log: DataFrame) -> DataFrame:
    return log.where(F.col("page").isNotNull()).withColumn("row_time", F.timestamp_millis("ts"))


# ---- the same derivations in SQL --------------------------------------------------------

ORDER_CHANGES = """
o AS (SELECT o_orderkey, o_custkey, o_orderpriority, CAST(epoch(o_orderdate) AS BIGINT) AS secs,
        CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
        CAST(o_custkey % 25 AS VARCHAR) AS province_id,
        strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS operate_time,
        CASE o_orderstatus WHEN 'F' THEN '1003' WHEN 'O' THEN '1005' ELSE '1006' END AS final
      FROM orders),
order_changes AS (
  SELECT CASE WHEN o_custkey % 3 = 0 THEN 'bootstrap-insert' ELSE 'insert' END AS type, secs AS ts, id, user_id,
    province_id, CASE WHEN o_custkey % 3 = 0 THEN final ELSE '1001' END AS order_status, operate_time,
    CAST(NULL AS VARCHAR) AS old_status FROM o
  UNION ALL
  SELECT 'update', secs + 86400, id, user_id, province_id, final, operate_time,
    CASE WHEN o_custkey % 3 = 1 THEN '1001' END FROM o
  UNION ALL
  SELECT 'delete', secs + 172800, id, user_id, province_id, final, operate_time, NULL FROM o
  WHERE o_orderpriority = '5-LOW'
  UNION ALL
  SELECT 'bootstrap-complete', secs, NULL, NULL, NULL, NULL, NULL, NULL FROM o
  WHERE o_orderpriority = '4-NOT SPECIFIED')"""

DETAILS = """
details AS (SELECT l_orderkey || '-' || l_linenumber AS id, CAST(l_orderkey AS VARCHAR) AS order_id,
    CAST(l_partkey AS VARCHAR) AS sku_id, 'sku ' || l_partkey AS sku_name,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS order_price,
    CAST(CAST(l_quantity AS INT) AS VARCHAR) AS sku_num,
    strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS create_time,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS split_total_amount,
    CASE WHEN l_discount >= 0.03 THEN CAST(CAST(round(l_discount * 100) AS INT) AS VARCHAR) END AS split_activity_amount,
    CASE WHEN l_returnflag <> 'A' THEN CAST(CAST(round(l_tax * 100) AS INT) AS VARCHAR) END AS split_coupon_amount,
    CAST(epoch(l_shipdate) AS BIGINT) AS ts, l_partkey, l_suppkey, l_linenumber, l_orderkey, l_returnflag,
    l_linestatus, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate
  FROM lineitem),
activity AS (SELECT id, 'a' || (l_partkey % 7) AS activity_id, 'r' || (l_suppkey % 5) AS activity_rule_id
  FROM details WHERE l_discount >= 0.08),
coupon AS (SELECT id, 'c' || (l_suppkey % 9) AS coupon_id FROM details WHERE l_returnflag = 'R' AND l_tax >= 0.05)"""

SALES_DETAILS = DETAILS + """,
sales AS (SELECT d.*, CAST(o_custkey AS VARCHAR) AS user_id, CAST(o_custkey % 25 AS VARCHAR) AS province_id
  FROM details d JOIN orders ON o_orderkey = l_orderkey)"""

# order of the re-sent rows of one detail id
RESENT = """PARTITION BY id ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity,
  l_discount, l_tax, l_returnflag, l_linestatus"""

PRODUCT = """
product AS (SELECT CAST(p_partkey AS VARCHAR) AS sku_id, CAST(p_size AS VARCHAR) AS spu_id,
    'spu ' || p_size AS spu_name, p_brand AS trademark_id, lower(p_brand) AS trademark_name,
    p_type AS category3_id, lower(p_type) AS category3_name, CAST(length(p_type) AS VARCHAR) AS category2_id,
    'c2 ' || length(p_type) AS category2_name, CAST(length(p_type) % 2 AS VARCHAR) AS category1_id,
    'c1 ' || (length(p_type) % 2) AS category1_name FROM part)"""

CARTS = DETAILS + """,
carts AS (SELECT 'ct' || id AS id, CAST(l_suppkey AS VARCHAR) AS user_id, sku_id, order_price AS cart_price,
    CAST(sku_num AS BIGINT) AS num, sku_name, '1' AS is_checked, create_time, CAST(NULL AS VARCHAR) AS operate_time,
    '0' AS is_ordered, CAST(NULL AS VARCHAR) AS order_time, ts, l_returnflag, l_linestatus,
    CASE l_returnflag WHEN 'A' THEN 'insert' WHEN 'N' THEN 'update'
      ELSE CASE l_linestatus WHEN 'F' THEN 'bootstrap-insert' ELSE 'delete' END END AS type,
    CASE WHEN l_linestatus = 'F' THEN CAST(l_linenumber * 7 AS BIGINT) END AS old_num FROM details)"""

CART_IMAGE = """'{"id":"' || id || '","user_id":"' || user_id || '","sku_id":"' || sku_id || '","cart_price":"' || cart_price ||
  '","sku_num":"' || num || '","sku_name":"' || sku_name || '","is_checked":"1","create_time":"' || create_time ||
  '","operate_time":null,"is_ordered":"0","order_time":null}'"""
#: Flat change rows of the carts, and the order in which `placed_carts` writes them to the log.
FLAT_CARTS = CARTS + f""",
flat_carts AS (SELECT *, row_number() OVER (ORDER BY num DESC, user_id, sku_id, CAST(cart_price AS VARCHAR), op, log_before NULLS FIRST) AS arrival
  FROM (SELECT id, id || '_' || (ts * 1000) AS flat_id, user_id, sku_id, cart_price, num, ts,
    CASE type WHEN 'insert' THEN 'CREATE' WHEN 'update' THEN 'UPDATE' WHEN 'bootstrap-insert' THEN 'READ' ELSE 'DELETE' END AS op,
    CASE WHEN type = 'delete' THEN {CART_IMAGE}
      WHEN type = 'update' THEN coalesce('{{"sku_num":"' || old_num || '"}}', '{{"is_checked":"0"}}') END AS log_before,
    CASE WHEN type <> 'delete' THEN {CART_IMAGE} END AS log_after FROM carts))"""

REFUNDS = DETAILS + """,
refunds AS (SELECT 'rf' || id AS id, CAST(l_suppkey AS VARCHAR) AS user_id, order_id, sku_id,
    CAST(l_linenumber AS VARCHAR) AS refund_type, sku_num AS refund_num, split_total_amount AS refund_amount,
    CAST(l_suppkey % 30 AS VARCHAR) AS refund_reason_type, 'reason ' || l_suppkey AS refund_reason_txt,
    create_time, ts, l_linestatus FROM details WHERE l_returnflag = 'R'),
refund_payments AS (SELECT 'rp' || id AS id, order_id, sku_id, CAST(l_suppkey % 30 AS VARCHAR) AS payment_type,
    create_time AS callback_time, split_total_amount AS total_amount, ts,
    l_linenumber % 2 = 0 OR l_linenumber % 4 = 1 AS entered
  FROM details WHERE l_returnflag = 'R' AND l_tax >= 0.04),
dic AS (SELECT CAST(n_nationkey AS VARCHAR) AS rowkey, n_name AS dic_name FROM nation)"""

LOG_ROWS = r"""
k AS (SELECT *, CAST(regexp_extract(props, '(\d+)', 1) AS INT) AS k, epoch_us(ts) // 1000 AS ms FROM events),
log AS (SELECT event_id, ts, ms, k, event_type, CAST(user_id % 7 AS VARCHAR) AS ar, 'c' || (k % 3) AS ch,
    CASE WHEN k % 3 = 0 THEN '1' ELSE '0' END AS is_new, 'm' || user_id AS mid,
    's' || user_id || '-' || strftime(ts, '%Y%m%d') AS sid,
    CASE WHEN k % 10 <> 9 THEN CAST(user_id AS VARCHAR) END AS uid, 'v' || (k % 4) AS vc,
    event_type = 'signup' AS is_start, event_type = 'error' AS is_err,
    CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail' WHEN 'purchase' THEN 'payment'
      WHEN 'error' THEN 'mine' END AS page_id,
    CASE k % 5 WHEN 0 THEN 'login' WHEN 2 THEN 'search' WHEN 3 THEN 'home' WHEN 4 THEN 'good_list' END AS last_page_id,
    CASE WHEN k % 11 <> 0 THEN event_type || ' kw' || (k % 10) || ', ' || upper(event_type) END AS item,
    CASE WHEN k % 2 = 0 THEN 'keyword' ELSE 'sku_id' END AS item_type, k * 100 AS during_time,
    CASE WHEN event_type IN ('view', 'click') THEN k % 4 ELSE 0 END AS n_displays,
    CASE WHEN event_type IN ('click', 'purchase') THEN k % 3 ELSE 0 END AS n_actions
  FROM k),
pages_log AS (SELECT * FROM log WHERE NOT is_start)"""


def stamped(size: str, ts: str = "ts") -> str:
    """SQL of the formatted bounds of a tumbling window."""
    start = f"time_bucket(INTERVAL '{size}', {ts}, TIMESTAMP '1970-01-01')"
    fmt = "'%Y-%m-%d %H:%M:%S'"
    return (
        f"strftime({start}, {fmt}) AS stt, strftime({start} + INTERVAL '{size}', {fmt}) AS edt, "
        f"strftime({start}, '%Y-%m-%d') AS cur_date"
    )
