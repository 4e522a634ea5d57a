"""The warehouse's inputs, mapped from the given TPC-H-like tables.

Every mapping is row by row (or a distinct, for three dimensions): no join, window or sort, so
what a query costs is the operator it runs. FIXTURES.md lists the rules. Each function takes
the table as a DataFrame, batch or streaming.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.times import millis_text

SPAN_SECONDS = 30 * 86400
ORDER_STEP = 7919  # prime, so order keys spread over the whole span
PROVINCES = 26  # one more than there are nations: some orders find no province
ROUTES = [
    ("orders", "insert", "kafka", "dwd_order_info", "id,user_id,order_status,total_amount", None, None),
    ("orders", "update", "kafka", "dwd_order_info_update", "id,order_status", None, None),
    ("customer", "insert", "hbase", "dim_user_info", "id,name,segment", "id", None),
    ("customer", "update", "hbase", "dim_user_info", "id,segment", "id", None),
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stream(spark: SparkSession, folder: str, name: str, **options: str) -> DataFrame:
    """The same table as a stream. The glob makes a single file acceptable as well as a folder."""
    path = f"{folder}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema).options(**options)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def money(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("decimal(16,2)")


def name_id(name: str) -> Column:
    """A stable 48-bit number for a name, without ranking all names."""
    return F.conv(F.substring(F.md5(F.col(name)), 1, 12), 16, 10)


def _event_ms() -> Column:
    return F.unix_millis(F.col("ts").cast("timestamp"))


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


# --- logs ------------------------------------------------------------------
def app_log(events: DataFrame) -> DataFrame:
    kind, user, k = F.col("event_type"), F.col("user_id"), F.col("k")
    text = lambda value: value.cast("string")
    shown = lambda item, item_type: F.struct(text(item).alias("item"), F.lit(item_type).alias("item_type"))
    page = (
        F.when(kind == "view", "good_list").when(kind == "click", "good_detail")
        .when(kind == "purchase", "trade").when(kind == "signup", "home").otherwise("error")
    )
    last_page = F.when(k % 6 == 0, None).when(k % 6 == 3, "").when(k % 3 == 1, "home").otherwise("good_list")
    new = (user % 2 == 0) | (k % 5 == 0)
    return events.select("event_id", "event_type", "user_id", "value", _event_ms().alias("ms"), _k().alias("k")).select(
        F.struct(
            text(user).alias("mid"),
            F.concat(F.lit("v"), user % 3).alias("vc"),
            F.concat(F.lit("ch"), user % 4).alias("ch"),
            text(user % 25).alias("ar"),
            F.when(new, "1").otherwise("0").alias("is_new"),
        ).alias("common"),
        F.struct(
            page.alias("page_id"),
            last_page.alias("last_page_id"),
            F.when(kind == "click", text(k)).alias("item"),
            F.floor(F.col("value") * 100).cast("bigint").alias("during_time"),
        ).alias("page"),
        F.when((kind == "signup") & (F.col("event_id") % 2 == 0),
               F.create_map(F.lit("entry"), F.lit("icon"))).alias("start"),
        F.when(kind == "view", F.array(
            shown(k, "sku_id"), shown(k + 1, "activity_id"),
            F.lit(None).cast("struct<item:string,item_type:string>"),
        )).alias("displays"),
        F.col("ms").alias("ts"),
        F.col("event_id").alias("seq"),
    )


def search_log(documents: DataFrame) -> DataFrame:
    """A search for the whole text of each document, on the product-list page."""
    text = lambda value: value.cast("string")
    doc = F.col("doc_id")
    return documents.select(
        F.struct(text(doc % 100).alias("mid"), F.lit("v0").alias("vc"), F.lit("ch0").alias("ch"),
                 text(doc % 25).alias("ar"), F.lit("0").alias("is_new")).alias("common"),
        F.struct(F.lit("good_list").alias("page_id"), F.lit("home").alias("last_page_id"), F.col("text").alias("item"),
                 F.lit(0).cast("bigint").alias("during_time")).alias("page"),
        F.lit(None).cast("map<string,string>").alias("start"),
        F.lit(None).cast("array<struct<item:string,item_type:string>>").alias("displays"),
        _order_ms("doc_id").alias("ts"),
        doc.alias("seq"),
    )


def log_lines(logs: DataFrame) -> DataFrame:
    """App logs as the JSON lines a collector would write."""
    return logs.select(F.to_json(F.struct("common", "page", "start", "displays", "ts")).alias("value"), "ts")


# --- facts -------------------------------------------------------------------
def _order_ms(key: str) -> Column:
    start = F.unix_millis(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return start + (F.col(key) * ORDER_STEP) % SPAN_SECONDS * 1000


def _detail_ms() -> Column:
    return _order_ms("l_orderkey") + ((F.col("l_partkey") + F.col("l_linenumber")) % 15 - 7) * 1000


def _split_total() -> Column:
    return money(money("l_extendedprice") * (F.lit(1) - money("l_discount")))


def order_info(orders: DataFrame) -> DataFrame:
    ms, total, none = _order_ms("o_orderkey"), money("o_totalprice"), F.lit(None).cast("string")
    return orders.select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_custkey") % PROVINCES).alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        total.alias("total_amount"),
        money(F.lit(0)).alias("activity_reduce_amount"),
        money(F.lit(0)).alias("coupon_reduce_amount"),
        total.alias("original_total_amount"),
        money(F.lit(0)).alias("feight_fee"),
        none.alias("expire_time"),
        millis_text(ms).alias("create_time"),
        none.alias("operate_time"),
        F.substring(millis_text(ms), 1, 10).alias("create_date"),
        F.substring(millis_text(ms), 12, 2).alias("create_hour"),
        ms.alias("create_ts"),
    )


def order_detail(lineitem: DataFrame) -> DataFrame:
    ms = _detail_ms()
    return lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        money("l_extendedprice").alias("order_price"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.concat(F.lit("sku "), F.col("l_partkey")).alias("sku_name"),
        millis_text(ms).alias("create_time"),
        _split_total().alias("split_total_amount"),
        money(F.lit(0)).alias("split_activity_amount"),
        money(F.lit(0)).alias("split_coupon_amount"),
        ms.alias("create_ts"),
    )


def payment_info(orders: DataFrame) -> DataFrame:
    key, ms = F.col("o_orderkey"), _order_ms("o_orderkey")
    return orders.filter(F.col("o_orderstatus") == "F").select(
        key.alias("id"),
        key.alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        money("o_totalprice").alias("total_amount"),
        F.concat(F.lit("order "), key).alias("subject"),
        F.concat(F.lit("110"), key % 3 + 1).alias("payment_type"),
        millis_text(ms).alias("create_time"),
        millis_text(ms + key * 37 % 3600 * 1000).alias("callback_time"),
    )


def order_refund_info(lineitem: DataFrame) -> DataFrame:
    return lineitem.filter(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        _split_total().alias("refund_amount"),
        millis_text(_detail_ms()).alias("create_time"),
    )


def comment_info(lineitem: DataFrame) -> DataFrame:
    return lineitem.filter(F.col("l_returnflag") == "A").select(
        F.col("l_partkey").alias("sku_id"),
        F.when(F.col("l_linestatus") == "O", "1201").otherwise("1203").alias("appraise"),
        millis_text(_detail_ms()).alias("create_time"),
    )


def _event_fact(events: DataFrame, kind: str) -> DataFrame:
    return events.filter(F.col("event_type") == kind).select(
        _k().alias("sku_id"), millis_text(_event_ms()).alias("create_time"))


def favor_info(events: DataFrame) -> DataFrame:
    return _event_fact(events, "signup")


def cart_info(events: DataFrame) -> DataFrame:
    return _event_fact(events, "purchase")


def mark_info(events: DataFrame) -> DataFrame:
    """:func:`favor_info` and :func:`cart_info` in one pass."""
    kind = F.col("event_type")
    return events.filter(kind.isin("signup", "purchase")).select(
        _k().alias("sku_id"), millis_text(_event_ms()).alias("create_time"),
        F.when(kind == "signup", "favor").otherwise("cart").alias("kind"))


def after_sale_info(lineitem: DataFrame) -> DataFrame:
    """:func:`order_refund_info` and :func:`comment_info` in one pass."""
    refund = F.col("l_returnflag") == "R"
    return lineitem.filter(F.col("l_returnflag").isin("R", "A")).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        F.when(refund, _split_total()).alias("refund_amount"),
        F.when(~refund, F.when(F.col("l_linestatus") == "O", "1201").otherwise("1203")).alias("appraise"),
        millis_text(_detail_ms()).alias("create_time"),
        F.when(refund, "refund").otherwise("comment").alias("kind"),
    )


# --- dimensions (all text, as a change-fed snapshot would be) ------------------
def user_dim(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    born = F.date_add(F.lit("1960-01-01").cast("date"), (key % 15000).cast("int"))
    return customer.select(
        key.cast("string").alias("id"),
        F.when(key % 2 == 0, "M").otherwise("F").alias("gender"),
        F.date_format(born, "yyyy-MM-dd").alias("birthday"),
    )


def province_dim(nation: DataFrame) -> DataFrame:
    key = F.col("n_nationkey")
    return nation.select(
        key.cast("string").alias("id"), F.col("n_name").alias("name"),
        F.col("n_regionkey").cast("string").alias("area_code"),
        F.concat(F.lit("N"), key).alias("iso_code"), F.concat(F.lit("X-"), key).alias("iso_3166_2"),
    )


def sku_dim(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("sku_name"),
        money("p_retailprice").cast("string").alias("price"),
        name_id("p_name").alias("spu_id"),
        name_id("p_type").alias("category3_id"),
        F.regexp_extract("p_brand", "([0-9]+)", 1).alias("tm_id"),
    )


def spu_dim(part: DataFrame) -> DataFrame:
    return part.select(name_id("p_name").alias("id"), F.col("p_name").alias("spu_name")).distinct()


def category3_dim(part: DataFrame) -> DataFrame:
    return part.select(name_id("p_type").alias("id"), F.col("p_type").alias("name")).distinct()


def trademark_dim(part: DataFrame) -> DataFrame:
    return part.select(
        F.regexp_extract("p_brand", "([0-9]+)", 1).alias("id"), F.col("p_brand").alias("tm_name")).distinct()


# --- change events ---------------------------------------------------------------
def _envelope(rows: DataFrame, name: str, key: str, after: dict[str, Column]) -> DataFrame:
    """One capture envelope per row; the operation cycles with the key, and deletes carry nothing."""
    turn = F.col(key) % 4
    op = F.when(turn == 0, "CREATE").when(turn == 1, "UPDATE").when(turn == 2, "DELETE").otherwise("bootstrap-insert")
    body = F.struct(*(value.cast("string").alias(column) for column, value in after.items()))
    return rows.select(
        F.to_json(F.struct(
            F.struct(F.lit("mart").alias("db"), F.lit(name).alias("table")).alias("source"),
            op.alias("op"), F.when(turn != 2, body).alias("after"),
        )).alias("value"),
        F.col(key).alias("seq"),
    )


def change_envelopes(orders: DataFrame, lineitem: DataFrame, customer: DataFrame) -> DataFrame:
    """Changes of three tables as JSON text, with a sequence number."""
    return (
        _envelope(orders, "orders", "o_orderkey", {
            "id": F.col("o_orderkey"), "user_id": F.col("o_custkey"),
            "order_status": F.col("o_orderstatus"), "total_amount": money("o_totalprice")})
        .unionByName(_envelope(lineitem, "lineitem", "l_orderkey", {
            "order_id": F.col("l_orderkey"), "sku_id": F.col("l_partkey")}))
        .unionByName(_envelope(customer, "customer", "c_custkey", {
            "id": F.col("c_custkey"), "name": F.col("c_name"),
            "segment": F.col("c_mktsegment"), "balance": money("c_acctbal")}))
    )


def routing(spark: SparkSession) -> DataFrame:
    from ..schemas import ROUTING

    return spark.createDataFrame(ROUTES, ROUTING)


def routing_history(part: DataFrame) -> DataFrame:
    """A long history of routing rules: each part rewrites the rule of its brand and operation."""
    key = F.col("p_partkey")
    return part.select(
        F.when(key % 50 != 49, F.lower(F.col("p_brand"))).alias("source_table"),
        F.when(key % 3 == 0, "insert").when(key % 3 == 1, "update").otherwise("delete").alias("operate_type"),
        F.when(F.col("p_size") % 2 == 0, "hbase").otherwise("kafka").alias("sink_type"),
        F.concat(F.lit("dwd_"), F.replace(F.col("p_name"), F.lit(" "), F.lit("_"))).alias("sink_table"),
        F.concat(F.lit("id,"), F.lower(F.col("p_type"))).alias("sink_columns"),
        F.lit("id").alias("sink_pk"),
        F.lit(None).cast("string").alias("sink_extend"),
        key.alias("seq"),
    )


def customer_changes(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """A history of customer changes: the row itself, then an update for each order it places."""
    first = customer.select(
        F.lit("insert").alias("type"), F.lit(-1).cast("bigint").alias("seq"),
        F.create_map(F.lit("id"), F.col("c_custkey").cast("string"), F.lit("name"), F.col("c_name"),
                     F.lit("segment"), F.col("c_mktsegment")).alias("data"),
    )
    later = orders.select(
        F.lit("update").alias("type"), F.col("o_orderkey").alias("seq"),
        F.create_map(F.lit("id"), F.col("o_custkey").cast("string"),
                     F.lit("segment"), F.col("o_orderpriority")).alias("data"),
    )
    return first.unionByName(later)
