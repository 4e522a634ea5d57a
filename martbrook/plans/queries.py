"""The registered queries: each takes (spark, folder of given tables) and returns a DataFrame."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..functions.times import (
    date_text, event_time_seconds, hour_label, millis_text, text_millis, time_text,
)
from ..functions.segments import register_segment_function, segments
from ..functions.tokens import tokens
from ..operators import applog, changes, dashboard, keywords, products, provinces, visitors, wide
from ..session import streaming_session, work_dir
from ..sources import given, topics
from ..sources.results import append_batch, read_result, result_rows
from ..streaming import changes as change_jobs, dimensions, late, logs as log_jobs, orders as order_jobs
from ..streaming.runtime import drain
from .warehouse import AS_OF, BOUNCE_MS, ORDER, WINDOW, Warehouse

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    @functools.wraps(fn)
    def tuned(spark: SparkSession, folder: str) -> DataFrame:
        own = spark.newSession()  # same context and catalog; the caller's options hold here, and stay as they are
        for key, value in spark.conf.getAll.items():
            if key.startswith("spark.sql.") and own.conf.isModifiable(key):
                own.conf.set(key, value)
        for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled",
                    "spark.sql.adaptive.forceOptimizeSkewedJoin"):
            own.conf.set(key, "true")
        return fn(own, folder)

    QUERIES[fn.__name__] = tuned
    return tuned


def _doubles(rows: DataFrame) -> DataFrame:
    """Decimals as doubles, which is how results are compared."""
    return rows.select(*(
        F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name)
        for f in rows.schema
    ))


def _visit(rows: DataFrame) -> DataFrame:
    return rows.select("seq", F.col("common.mid").alias("mid"), millis_text(F.col("ts")).alias("at"))


# --- logs ----------------------------------------------------------------------
@query
def log_route_split(spark, folder):
    routed = applog.with_route(Warehouse(spark, folder).logs)
    return routed.select("seq", F.col("common.mid").alias("mid"), "route")


@query
def display_explode(spark, folder):
    return applog.display_logs(Warehouse(spark, folder).pages)


@query
def raw_log_parse(spark, folder):
    """Daily JSON log files, as the collector writes them, read back and parsed."""
    logs, out = Warehouse(spark, folder).logs, work_dir(spark, "raw_log")
    lines = given.log_lines(logs).select("value", date_text(F.col("ts")).alias("day"))
    lines.write.partitionBy("day").text(out)
    read = applog.parse_logs(topics.log_source(spark, out, streaming=False))
    return read.select(
        F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"), "page.page_id", "page.last_page_id",
        "page.item", "page.during_time", F.coalesce(F.size("displays"), F.lit(0)).cast("bigint").alias("shown"), "ts")


@query
def time_conversions(spark, folder):
    logs = Warehouse(spark, folder).logs
    text = millis_text(F.col("ts"))
    second = event_time_seconds(F.col("ts"))
    return logs.select(
        "seq", date_text(F.col("ts")).alias("day"), text.alias("at"), text_millis(text).alias("at_ms"),
        time_text(second).alias("second"), hour_label(F.hour(second)).alias("hour"))


# --- change events ---------------------------------------------------------------
def _flat(spark, folder):
    return changes.flatten_envelopes(Warehouse(spark, folder).change_text)


def _renamed(rows: DataFrame, *more) -> DataFrame:
    return rows.select("seq", F.col("table").alias("src_table"), F.col("type").alias("op_type"), *more)


@query
def cdc_flatten(spark, folder):
    data = F.col("data")
    return _renamed(
        _flat(spark, folder), F.col("database").alias("src_db"), F.size(data).cast("bigint").alias("n_columns"),
        data["id"].alias("id"), data["total_amount"].alias("total_amount"), data["sku_id"].alias("sku_id"))


@query
def cdc_clean(spark, folder):
    return _renamed(changes.normalise_type(changes.clean_changes(_flat(spark, folder))))


def _tagged(spark, folder):
    return changes.tag_changes(changes.clean_changes(_flat(spark, folder)), given.routing(spark))


@query
def route_by_config(spark, folder):
    return _renamed(_tagged(spark, folder), "outcome", "sink_table")


@query
def route_column_trim(spark, folder):
    sent = _tagged(spark, folder).filter(F.col("outcome") != "unrouted")
    kept = F.concat_ws(",", F.array_sort(F.map_keys("data")))
    return _renamed(sent, "sink_table", kept.alias("kept"), F.col("data")["id"].alias("id"))


@query
def fact_messages(spark, folder):
    """Routed facts as messages, each for the topic its rule names."""
    return topics.as_messages(_tagged(spark, folder).filter(F.col("outcome") == "fact"))


def _latest_rules(spark, folder):
    return changes.latest_config(given.routing_history(Warehouse(spark, folder).table("part")), "seq")


@query
def config_latest(spark, folder):
    return _latest_rules(spark, folder).select(
        "source_table", "operate_type", "sink_type", "sink_table", "sink_columns")


@query
def dim_table_columns(spark, folder):
    """The tables, columns and keys that the current rules call for."""
    return changes.dimension_columns(_latest_rules(spark, folder))


@query
def dim_upsert_latest(spark, folder):
    house = Warehouse(spark, folder)
    history = given.customer_changes(house.table("customer"), house.table("orders"))
    return changes.upsert_dimension(history, ["id", "name", "segment"], "seq")


# --- visitors --------------------------------------------------------------------
@query
def is_new_repair(spark, folder):
    repaired = visitors.repair_new_flag(Warehouse(spark, folder).logs)
    return repaired.select("seq", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"))


@query
def unique_visitor_daily(spark, folder):
    return _visit(visitors.unique_visitors(Warehouse(spark, folder).pages, ORDER))


@query
def bounce_detail(spark, folder):
    return _visit(visitors.bounces(Warehouse(spark, folder).pages, BOUNCE_MS, ORDER))


@query
def visitor_stats_window(spark, folder):
    return Warehouse(spark, folder).visitor_stats


# --- wide rows ---------------------------------------------------------------------
WIDE_COLUMNS = ("order_id", "detail_id", "sku_id", "user_id", "province_id", "order_status", "sku_num",
                "create_time", "create_hour", "order_price", "split_total_amount", "total_amount")
DIM_COLUMNS = ("user_age", "user_gender", "province_name", "province_iso_code", "province_area_code",
               "province_3166_2_code", "spu_id", "spu_name", "category3_id", "category3_name", "tm_id", "tm_name")
PAID_COLUMNS = ("payment_id", "order_id", "detail_id", "sku_id", "user_id", "payment_type", "subject",
                "payment_create_time", "callback_time", "order_create_time", "split_total_amount", "total_amount")


@query
def order_wide_interval(spark, folder):
    return _doubles(Warehouse(spark, folder).order_wide.select(*WIDE_COLUMNS))


@query
def order_wide_dims(spark, folder):
    return Warehouse(spark, folder).order_wide_dims.select("order_id", "detail_id", "sku_name", *DIM_COLUMNS)


@query
def payment_wide_interval(spark, folder):
    return _doubles(Warehouse(spark, folder).payment_wide.select(*PAID_COLUMNS))


@query
def order_wide_merge(spark, folder):
    """Lines that lost their order header get it back from the order's own partial row."""
    house = Warehouse(spark, folder)
    lines = house.details.select(
        "order_id", F.col("id").alias("detail_id"), "sku_id", "sku_name", "order_price", "sku_num",
        "split_activity_amount", "split_coupon_amount", "split_total_amount",
        F.when(F.col("sku_id") % 2 == 0, F.lit("kept")).alias("order_status"),
        *(F.lit(None).cast(t).alias(n) for n, t in (
            ("create_time", "string"), ("create_date", "string"), ("coupon_reduce_amount", "decimal(16,2)"),
            ("activity_reduce_amount", "decimal(16,2)"), ("original_total_amount", "decimal(16,2)"),
            ("feight_fee", "decimal(16,2)"), ("total_amount", "decimal(16,2)"), ("user_id", "bigint"))))
    headers = house.orders.select(
        F.col("id").alias("order_id"), "order_status", "create_time", "create_date", "coupon_reduce_amount",
        "activity_reduce_amount", "original_total_amount", "feight_fee", "total_amount", "user_id",
        *(F.lit(None).cast(t).alias(n) for n, t in (
            ("sku_id", "bigint"), ("sku_name", "string"), ("order_price", "decimal(16,2)"), ("sku_num", "bigint"))))
    return _doubles(wide.merge_wide(lines, headers).select(
        "order_id", "detail_id", "sku_id", "order_status", "create_time", "user_id", "total_amount",
        "split_total_amount"))


# --- statistics --------------------------------------------------------------------
@query
def product_metric_union(spark, folder):
    rows = Warehouse(spark, folder).metrics()
    return _doubles(rows.withColumn("ts", millis_text(F.col("ts"))).withColumnRenamed("ts", "at"))


@query
def product_stats_window(spark, folder):
    return _doubles(Warehouse(spark, folder).product_stats)


def _province_stats(house: Warehouse) -> DataFrame:
    return provinces.province_stats(wide.with_province(house.order_wide, house.dims["provinces"]), WINDOW)


@query
def province_stats_window(spark, folder):
    return _doubles(_province_stats(Warehouse(spark, folder)))


@query
def keyword_stats_window(spark, folder):
    pages = applog.page_logs(Warehouse(spark, folder).searched_logs)
    return keywords.keyword_stats(keywords.keywords(keywords.searches(pages)), WINDOW)


@query
def keyword_stats_sql(spark, folder):
    pages = applog.page_logs(Warehouse(spark, folder).searched_logs)
    return keywords.keyword_stats_sql(spark, pages, WINDOW)


DICTIONARY = ("the", "then", "ing", "tion", "er", "ent", "ó")  # as text without spaces would need


@query
def keyword_dictionary(spark, folder):
    """All documents cut at the words of a small dictionary."""
    words = keywords.keywords(Warehouse(spark, folder).table("documents").select(
        F.col("text").alias("fullword"), F.lit(None).alias("order_time")), DICTIONARY)
    return words.groupBy("keyword").agg(F.count("*").alias("ct"))


CONSONANTS, VOWELS = "bcdfghjklmnpqrstvwxyz", "aeiou"


def syllables() -> list[str]:
    """A dictionary of 13,335 words by rule: a consonant and a vowel, the same and a consonant, and two such pairs."""
    pairs = [c + v for c in CONSONANTS for v in VOWELS]
    return [*pairs, *(p + c for p in pairs for c in CONSONANTS), *(p + q for p in pairs for q in pairs)]


@query
def keyword_segments(spark, folder):
    """All documents cut at the words of a large dictionary, the best of overlapping cuts; as a column function
    and as a table function of SQL, which must say the same."""
    documents = Warehouse(spark, folder).table("documents")
    words = documents.select(F.explode(segments(F.col("text"), syllables())).alias("keyword"))
    register_segment_function(spark, "cut_text", syllables())
    documents.createOrReplaceTempView("texts_to_cut")
    in_sql = spark.sql("SELECT k.word AS keyword FROM texts_to_cut, LATERAL cut_text(text) AS k(word)")
    each = words.groupBy("keyword").agg(F.count("*").alias("ct")).withColumn("sql_ct", F.lit(0).cast("bigint")).unionByName(
        in_sql.groupBy("keyword").agg(F.count("*").alias("sql_ct")).withColumn("ct", F.lit(0).cast("bigint")))
    return each.groupBy("keyword").agg(F.sum("ct").alias("ct"), F.sum("sql_ct").alias("sql_ct"))


@query
def view_messages(spark, folder):
    """Messages for one topic."""
    found = _visit(visitors.unique_visitors(Warehouse(spark, folder).pages, ORDER))
    return topics.as_messages(found.select("mid", "at"), "dwm_unique_visitor")


@query
def declared_view_stats(spark, folder):
    """JSON text declared as a view with an event time, and a windowed question in SQL."""
    rows = Warehouse(spark, folder).orders.select("create_time", "order_status", "total_amount")
    text = rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))
    schema = T.StructType.fromDDL("create_time string, order_status string, total_amount decimal(16,2)")
    topics.declare_view(text, "declared_orders", schema, "create_time", "3 seconds")
    return _doubles(spark.sql(f"""
        SELECT date_format(window.start, 'yyyy-MM-dd HH:mm:ss') AS stt, order_status, count(*) AS orders,
               sum(total_amount) AS total_amount
        FROM declared_orders GROUP BY window(rowtime, '{WINDOW}'), order_status"""))


# --- dashboard -----------------------------------------------------------------------
@query
def gmv_daily(spark, folder):
    return _doubles(dashboard.gmv_by_day(Warehouse(spark, folder).sales))


@query
def gmv_top_brand(spark, folder):
    return _doubles(dashboard.gmv_by_brand(Warehouse(spark, folder).sales_sums))


@query
def gmv_top_category(spark, folder):
    return _doubles(dashboard.gmv_by_category(Warehouse(spark, folder).sales_sums))


@query
def gmv_top_spu(spark, folder):
    return _doubles(dashboard.gmv_by_spu(Warehouse(spark, folder).sales_stats))


@query
def province_amount(spark, folder):
    return _doubles(dashboard.amount_by_province(_province_stats(Warehouse(spark, folder))))


@query
def visitor_totals(spark, folder):
    return dashboard.visitor_totals(Warehouse(spark, folder).visitor_stats)


@query
def visitor_new_vs_old(spark, folder):
    return _doubles(dashboard.new_versus_returning(Warehouse(spark, folder).visitor_stats))


@query
def visitor_by_hour(spark, folder):
    return dashboard.visitors_by_hour(Warehouse(spark, folder).visitor_stats)


# --- dashboard, one day of a stored table ------------------------------------------------
DAY, EMPTY_DAY = 20240103, 20230101


def stored(spark: SparkSession, stats: DataFrame, name: str) -> DataFrame:
    """Statistics as the jobs leave them: written in a folder for each day, and read back."""
    out = work_dir(spark, name)
    append_batch(result_rows(stats, [*stats.columns, "ts"]), out, 0, day_from="stt")
    return read_result(spark, out).drop("ts")


@query
def gmv_of_day(spark, folder):
    sales = stored(spark, Warehouse(spark, folder).sales_sums, "product_stats")
    return _doubles(dashboard.gmv(sales, DAY).withColumn("day", F.lit(DAY)).unionByName(
        dashboard.gmv(sales, EMPTY_DAY).withColumn("day", F.lit(EMPTY_DAY))))


@query
def gmv_top_brand_of_day(spark, folder):
    return _doubles(dashboard.gmv_by_brand(stored(spark, Warehouse(spark, folder).sales_sums, "product_stats"), day=DAY))


@query
def gmv_top_category_of_day(spark, folder):
    return _doubles(dashboard.gmv_by_category(stored(spark, Warehouse(spark, folder).sales_sums, "product_stats"), day=DAY))


@query
def gmv_top_spu_of_day(spark, folder):
    return _doubles(dashboard.gmv_by_spu(stored(spark, Warehouse(spark, folder).sales_stats, "product_stats"), day=DAY))


@query
def province_amount_of_day(spark, folder):
    stats = stored(spark, _province_stats(Warehouse(spark, folder)), "province_stats")
    return _doubles(dashboard.amount_by_province(stats, DAY))


@query
def visitor_totals_of_day(spark, folder):
    return dashboard.visitor_totals(stored(spark, Warehouse(spark, folder).visitor_stats, "visitor_stats"), DAY)


@query
def visitor_new_vs_old_of_day(spark, folder):
    return _doubles(dashboard.new_versus_returning(stored(spark, Warehouse(spark, folder).visitor_stats, "visitor_stats"), DAY))


@query
def visitor_by_hour_of_day(spark, folder):
    return dashboard.visitors_by_hour(stored(spark, Warehouse(spark, folder).visitor_stats, "visitor_stats"), DAY)


@query
def keyword_score_of_day(spark, folder):
    pages = applog.page_logs(Warehouse(spark, folder).searched_logs)
    stats = keywords.keyword_stats(keywords.keywords(keywords.searches(pages)), WINDOW)
    return dashboard.keyword_ranking(stored(spark, stats, "keyword_stats"), n=20, day=DAY, descending=True)


def _document_keywords(spark, folder) -> DataFrame:
    """Keyword counts of all documents, each document standing for one kind of source."""
    source = F.element_at(F.array(*map(F.lit, ("SEARCH", "ORDER", "CART", "CLICK", "OTHER"))),
                          (F.col("doc_id") % 5 + 1).cast("int"))
    words = Warehouse(spark, folder).table("documents").select(
        source.alias("source"), F.explode(tokens(F.col("text"))).alias("keyword"))
    return words.groupBy("keyword", "source").agg(F.count("*").alias("ct"))


@query
def keyword_score(spark, folder):
    return dashboard.keyword_ranking(_document_keywords(spark, folder))


@query
def keyword_score_popular(spark, folder):
    return dashboard.keyword_ranking(_document_keywords(spark, folder), n=20, descending=True)


# --- streaming: each runs its jobs over the whole tables, then reads what they wrote -------
def _streams(spark: SparkSession, folder: str, name: str) -> tuple[Warehouse, str]:
    session = streaming_session(spark)
    return Warehouse(session, folder, streaming=True), work_dir(spark, name)


def _written(house: Warehouse, out: str, topic: str) -> DataFrame:
    """A topic an earlier job wrote, as a stream."""
    path = f"{out}/{topic}"
    schema = house.spark.read.option("recursiveFileLookup", "true").parquet(path).schema
    return topics.file_source(house.spark, path, schema)


BATCHES = 5


def _in_batches(rows: DataFrame, out: str, name: str, job: Callable[[DataFrame], DataStreamWriter], by: str = "ts",
                empty_batches: bool = True, text: bool = False) -> list[StreamingQuery]:
    """Rows that arrive in parts, by a number they have, as they are or as the ``text`` in their column ``value``; the
    job is stopped after each part and started again, so that it goes on from its checkpoint."""
    least, most = rows.agg(F.min(by), F.max(by)).first()
    if least is None:
        return []
    queries = []
    session, arrived = streaming_session(rows.sparkSession), f"{out}/arrived/{name}"
    cuts = [least + (most - least) * k // BATCHES for k in range(BATCHES)] + [most + 1]
    for k, (start, end) in enumerate(zip(cuts, cuts[1:])):
        part = rows.filter((F.col(by) >= start) & (F.col(by) < end))
        if text:
            part.select("value").write.text(f"{arrived}/part={k}")
            source = topics.log_source(session, arrived)
        else:
            part.write.parquet(f"{arrived}/part={k}")
            source = topics.file_source(session, arrived, rows.schema)
        queries.append(drain(job(source), empty_batches))
    return queries


@query
def stream_log_split(spark, folder):
    house, out = Warehouse(spark, folder), work_dir(spark, "log_split")
    _in_batches(house.logs, out, "logs", lambda logs: log_jobs.split_job(logs, out))
    side = lambda topic: log_jobs.read_topic(spark, out, topic, house.logs.schema).select(
        F.lit(topic).alias("topic"), "seq", F.col("common.is_new").alias("detail"))
    shown = log_jobs.read_topic(spark, out, log_jobs.DISPLAY, applog.display_logs(house.pages).schema).select(
        F.lit(log_jobs.DISPLAY).alias("topic"), F.col("ts").alias("seq"),
        F.concat_ws("/", "page_id", "item_type", "item").alias("detail"))
    return side(log_jobs.START).unionByName(side(log_jobs.PAGE)).unionByName(shown)


def _damaged_lines(logs: DataFrame) -> DataFrame:
    """Logs as JSON lines, some of which are broken, blank or no object."""
    seq = F.col("seq")
    line = F.when(seq % 33 == 3, F.concat(F.lit('{"common": {"mid": "'), seq)).when(seq % 33 == 14, F.concat(F.lit("["), seq, F.lit("]")))
    line = line.when(seq % 33 == 25, "").otherwise(F.to_json(F.struct(*logs.columns)))
    return logs.select(line.alias("value"), "ts")


@query
def bad_log_lines(spark, folder):
    """Lines that are no records, and how often each comes, beside the records that each page has."""
    logs = Warehouse(spark, folder).logs
    rows = applog.parsed(_damaged_lines(logs).select("value"), logs.schema)
    bad = applog.bad_lines(rows).groupBy(F.col("value").alias("line")).agg(F.count("*").alias("ct"))
    pages = applog.page_logs(applog.good(rows)).groupBy(F.concat(F.lit("page "), "page.page_id").alias("line"))
    return bad.unionByName(pages.agg(F.count("*").alias("ct")))


@query
def stream_text_split(spark, folder):
    """The log job from JSON text, some of it broken."""
    house, out = Warehouse(spark, folder), work_dir(spark, "text_split")
    schema = house.logs.schema
    _in_batches(_damaged_lines(house.logs), out, "lines",
                lambda lines: log_jobs.split_job(applog.parsed(lines, schema), out), text=True)
    side = lambda topic: log_jobs.read_topic(spark, out, topic, schema).select(
        F.lit(topic).alias("topic"), F.col("seq").cast("string").alias("line"), F.col("common.is_new").alias("detail"))
    bad = log_jobs.read_topic(spark, out, log_jobs.BAD, T.StructType.fromDDL("value string"))
    return side(log_jobs.START).unionByName(side(log_jobs.PAGE)).unionByName(bad.select(
        F.lit(log_jobs.BAD).alias("topic"), F.col("value").alias("line"), F.lit(None).cast("string").alias("detail")))


LATE_DELAY = "10 days"


@query
def stream_late_rows(spark, folder):
    """Page metrics that arrive in turns over the whole time: rows that come for closed windows, and the groups
    that Spark says it has dropped in each batch."""
    house, out = Warehouse(spark, folder), work_dir(spark, "late_rows")
    metrics = visitors.page_view_metrics(house.pages.withColumn("common", F.col("common").withField(
        "mid", F.concat_ws("/", "common.mid", "seq")))).withColumn("turn", F.element_at(F.split("mid", "/"), 2).cast("bigint") % BATCHES * 10)
    queries = _in_batches(metrics, out, "metrics", lambda rows: late.visitor_stats_and_late_rows(rows.drop("turn"), out, WINDOW, LATE_DELAY),
                          by="turn", empty_batches=False)
    counts = [(batch, n) for q in queries for batch, n in late.dropped_by_batch(q).items()]
    dropped = spark.createDataFrame(counts, "batch int, n bigint").select(
        F.lit("dropped").alias("kind"), "batch", F.lit(None).cast("string").alias("mid"), F.lit(None).cast("string").alias("at"), "n")
    rows = late.late_rows(spark, out, metrics.drop("turn").schema).select(
        F.lit("row").alias("kind"), "batch", "mid", millis_text(F.col("ts")).alias("at"), F.lit(1).cast("bigint").alias("n"))
    return rows.unionByName(dropped)


@query
def stream_unique_visitor(spark, folder):
    house, out = Warehouse(spark, folder), work_dir(spark, "unique_visitor")
    _in_batches(house.pages, out, "pages", lambda pages: log_jobs.daily_unique_job(pages, out, ORDER), empty_batches=False)
    return _visit(read_result(spark, f"{out}/dwm_unique_visitor"))


@query
def stream_bounce(spark, folder):
    house, out = Warehouse(spark, folder), work_dir(spark, "bounce")
    _in_batches(house.pages, out, "pages", lambda pages: log_jobs.bounce_timer_job(pages, out, BOUNCE_MS, ORDER))
    return _visit(spark.read.schema(house.pages.schema).parquet(f"{out}/dwm_user_jump_detail"))


@query
def stream_visitor_stats(spark, folder):
    house, out = _streams(spark, folder, "visitor_stats")
    drain(log_jobs.split_job(house.logs, out))
    pages = lambda: topics.file_source(house.spark, log_jobs.topic_folder(out, log_jobs.PAGE), house.logs.schema)
    drain(log_jobs.daily_unique_job(pages(), out, ORDER), empty_batches=False)
    drain(log_jobs.bounce_timer_job(pages(), out, BOUNCE_MS, ORDER))
    drain(log_jobs.visitor_stats_job(
        pages(), _written(house, out, "dwm_unique_visitor"), _written(house, out, "dwm_user_jump_detail"), out, WINDOW))
    return read_result(spark, f"{out}/visitor_stats").drop("ts", "dt")


@query
def stream_keyword_stats(spark, folder):
    house, out = _streams(spark, folder, "keyword_stats")
    drain(log_jobs.keyword_stats_job(applog.page_logs(house.searched_logs), out, WINDOW))
    return read_result(spark, f"{out}/keyword_stats").drop("ts", "dt")


def _wide_jobs(house: Warehouse, out: str) -> None:
    drain(order_jobs.order_wide_job(house.orders, house.details, out,
                                    lambda session: Warehouse(session, house.folder).dims, AS_OF))


@query
def stream_order_wide(spark, folder):
    house, out = _streams(spark, folder, "order_wide")
    _wide_jobs(house, out)
    return _doubles(read_result(spark, f"{out}/dwm_order_wide").select(
        *WIDE_COLUMNS, "user_age", "province_name", "tm_name"))


@query
def stream_payment_wide(spark, folder):
    house, out = _streams(spark, folder, "payment_wide")
    _wide_jobs(house, out)
    drain(order_jobs.payment_wide_job(house.payments, _written(house, out, "dwm_order_wide"), out))
    return _doubles(spark.read.parquet(f"{out}/dwm_payment_wide").select(*PAID_COLUMNS))


@query
def stream_product_stats(spark, folder):
    house, out = _streams(spark, folder, "product_stats")
    _wide_jobs(house, out)
    drain(order_jobs.payment_wide_job(house.payments, _written(house, out, "dwm_order_wide"), out))
    metrics = house.metrics(_written(house, out, "dwm_order_wide"), _written(house, out, "dwm_payment_wide"))
    drain(order_jobs.product_stats_job(
        metrics, out, lambda session: Warehouse(session, folder).product_dim, WINDOW))
    return _doubles(read_result(spark, f"{out}/product_stats").drop("ts", "dt"))


@query
def stream_province_stats(spark, folder):
    house, out = _streams(spark, folder, "province_stats")
    _wide_jobs(house, out)
    drain(order_jobs.province_stats_job(_written(house, out, "dwm_order_wide"), out, WINDOW))
    return _doubles(read_result(spark, f"{out}/province_stats").drop("ts", "dt"))


@query
def stream_cdc_route(spark, folder):
    house, out = _streams(spark, folder, "cdc_route")
    flat = changes.flatten_envelopes(house.change_text)
    drain(change_jobs.route_job(flat, out, given.routing))
    event = "`table` string, type string, data map<string,string>"
    facts = change_jobs.read_routed(spark, out, "fact", event).select(
        "sink_table", F.col("data")["id"].alias("id"), F.col("data")["order_status"].alias("detail"))
    unrouted = change_jobs.read_routed(spark, out, "unrouted", event).select(
        F.lit("unrouted").alias("sink_table"), F.col("table").alias("id"), F.col("type").alias("detail"))
    users = change_jobs.read_dimension(spark, out, "dim_user_info", "id", ["id", "name", "segment"])
    users = users.select(F.lit("dim_user_info").alias("sink_table"), "id",
                         F.concat_ws("/", "name", "segment").alias("detail"))
    return facts.unionByName(unrouted).unionByName(users)


@query
def stream_dim_lookup(spark, folder):
    """Customer changes in five batches, merged in tiers of two; then each customer's row looked up for all orders
    from the buckets that their keys lie in."""
    house, out = Warehouse(spark, folder), work_dir(spark, "dim_lookup")
    history = given.customer_changes(house.table("customer"), house.table("orders")).select(
        F.lit("mart").alias("database"), F.lit("customer").alias("table"), "type", "data", "seq")
    _in_batches(history, out, "changes", lambda rows: change_jobs.route_job(rows, out, given.routing, fan_in=2), by="seq")
    orders = house.table("orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"))
    users = dimensions.lookup(orders, out, "dim_user_info", "user_id", "id", ["id", "name", "segment"], fan_in=2)
    return wide.enrich(orders, users, "user_id", {"name": "name", "segment": "segment"})
