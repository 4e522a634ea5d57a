"""Streaming jobs over several micro-batches against the batch operators, late data and restarts."""

from __future__ import annotations

import json
import random
import time
from decimal import Decimal as D

from pyspark.sql import functions as F, types as T

from martbrook import schemas
from martbrook.operators import applog, changes as change_ops, products, visitors, wide
from martbrook.session import streaming_session
from martbrook.sources import results, topics
from martbrook.sources.given import stream
from martbrook.streaming import changes as change_jobs, late, logs as log_jobs, orders as order_jobs, state
from martbrook.streaming.runtime import drain
from rows import LOGS, log, logs, ms, table, values

T0 = ms("2024-01-01 10:00:00")


class Topic:
    """A folder that takes one file per call, read one file per micro-batch."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema, self.files = streaming_session(spark), f"{folder}", schema, 0

    def add(self, frame):
        frame.coalesce(1).write.parquet(f"{self.folder}/part-{self.files:03d}")
        self.files += 1

    def read(self):
        return topics.file_source(self.spark, self.folder, self.schema, files_per_batch=1)


def dropped(query):
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)


def day_logs(spark, day, seqs):
    start = T0 + day * 86_400_000
    return logs(spark, *(
        log(f"m{n % 5}", start + n * 700, last=None if n % 3 else "home", is_new="1" if n % 4 else "0", seq=day * 1000 + n,
            displays=[("1", "sku_id")] if n % 2 else None, start={"entry": "icon"} if n % 7 == 6 else None, during=n)
        for n in seqs))


def test_log_jobs_equal_batch(spark, tmp_path):
    topic, out = Topic(spark, tmp_path / "logs", LOGS), f"{tmp_path}/out"
    parts = [day_logs(spark, 0, range(20)), day_logs(spark, 0, range(20, 40)), day_logs(spark, 1, range(20))]
    for part in parts[:2]:
        topic.add(part)
    drain(log_jobs.split_job(topic.read(), out))
    topic.add(parts[2])
    drain(log_jobs.split_job(topic.read(), out))  # picks up where the first run stopped

    everything = parts[0].unionByName(parts[1]).unionByName(parts[2])
    repaired = visitors.repair_new_flag(everything)
    pages = repaired.filter("start IS NULL")
    written = lambda name: results.read_result(spark, f"{out}/{name}" if name.startswith("dwm") or "stats" in name else log_jobs.topic_folder(out, name))
    assert values(written(log_jobs.PAGE), "seq", "common.is_new") == values(pages, "seq", "common.is_new")
    assert values(written(log_jobs.START), "seq") == values(repaired.filter("start IS NOT NULL"), "seq")
    assert written(log_jobs.DISPLAY).count() == pages.filter("displays IS NOT NULL").count()

    source = lambda name: topics.file_source(
        topic.spark, log_jobs.topic_folder(out, name) if name == log_jobs.PAGE else f"{out}/{name}", LOGS)
    drain(log_jobs.unique_visitor_job(source(log_jobs.PAGE), out, ("ts", "seq")))
    uniques = visitors.unique_visitors(pages, ("ts", "seq"))
    assert values(written("dwm_unique_visitor"), "seq") == values(uniques, "seq")

    drain(log_jobs.bounce_job(source(log_jobs.PAGE), out, 1000, ("ts", "seq"), delay="3 seconds"))
    last = everything.agg(F.max("ts")).first()[0]
    closed = visitors.bounces(pages, 1000, ("ts", "seq")).filter((F.floor(F.col("ts") / 1000) + 2) * 1000 <= last - 3000)
    jumps = spark.read.parquet(f"{out}/dwm_user_jump_detail")
    assert values(jumps, "seq") == values(closed, "seq") and jumps.count() > 5

    jumped = topics.file_source(topic.spark, f"{out}/dwm_user_jump_detail", LOGS)
    drain(log_jobs.visitor_stats_job(source(log_jobs.PAGE), source("dwm_unique_visitor"), jumped, out, delay="1 day"))
    stats = written("visitor_stats")
    whole = visitors.visitor_stats(visitors.visitor_metrics(pages, uniques, jumps))
    keys = ("stt", "edt", *visitors.STAT_KEYS, *visitors.STAT_SUMS)
    got, want = set(values(stats, *keys)), set(values(whole, *keys))
    assert got <= want and got == {row for row in want if ms(row[1]) <= last - 86_400_000}
    assert set(schemas.VISITOR_STATS) < set(stats.columns)


def test_first_visits_are_kept_as_state(spark, tmp_path):
    """Six batches with a restart before each: a visitor's day holds, and a batch reads as much as the one before."""
    topic, out = Topic(spark, tmp_path / "logs", LOGS), f"{tmp_path}/out"
    read = []
    for day in range(6):
        at = T0 + day * 86_400_000
        topic.add(logs(spark, log("old", at, seq=100 * day), *(log(f"m{day}-{n}", at + n, seq=100 * day + n) for n in range(1, 30))))
        query = drain(log_jobs.split_job(topic.read(), out))
        (progress,) = [p for p in query.recentProgress if p.numInputRows]
        read.append((progress.numInputRows, progress.stateOperators[0].numRowsUpdated))
        assert progress.stateOperators[0].numRowsTotal == 1 + 29 * (day + 1)
    pages = log_jobs.read_topic(spark, out, log_jobs.PAGE, LOGS)
    assert values(pages.filter("common.is_new = '0'"), "seq") == sorted([(100 * day,) for day in range(1, 6)], key=str)
    assert pages.count() == 180
    # Rows in do not grow with the visitors known so far; nor do the keys that are written.
    assert {rows for rows, _ in read} == {read[0][0]} and {written for _, written in read[1:]} == {29}


def test_first_visit_is_the_first_to_arrive(spark, tmp_path):
    """A claim of an earlier date that comes later changes nothing, and records without claim, visitor or time pass."""
    topic, out = Topic(spark, tmp_path / "logs", LOGS), f"{tmp_path}/out"
    day = 86_400_000
    topic.add(logs(spark, log("a", T0, seq=1), log("a", T0 + day, seq=2), log(None, T0, seq=3), log("b", T0, is_new="0", seq=4)))
    topic.add(logs(spark, log("a", T0 - day, seq=5), log("a", T0 + 1, seq=6), log("b", T0 + day, is_new=None, seq=7)))
    drain(log_jobs.split_job(topic.read(), out))
    pages = log_jobs.read_topic(spark, out, log_jobs.PAGE, LOGS)
    assert values(pages, "seq", "common.is_new") == sorted(
        [(1, "1"), (2, "0"), (3, "1"), (4, "0"), (5, "0"), (6, "1"), (7, None)], key=str)
    assert log_jobs.read_topic(spark, out, log_jobs.START, LOGS).count() == 0


def test_outputs_of_a_batch_are_one_write(spark, tmp_path):
    """The records of all topics in one pass equal the three filtered ones, columns and all."""
    rows = day_logs(spark, 0, range(40)).unionByName(logs(spark, log("x", T0, displays=[], seq=90), log("y", T0, displays=[None, ("2", "t")], seq=91)))
    together = applog.outputs(rows, "s", "p", "d")
    start, page, display = applog.split_logs(rows)
    for topic, frame in (("s", start), ("p", page), ("d", display)):
        mine = together.filter(F.col("topic") == topic)
        assert values(mine, *frame.columns) == values(frame, *frame.columns) and frame.count()
    plan = together._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") <= 2 and "Exchange" not in plan


def test_uniques_expire(spark, tmp_path):
    """What was written longer ago than the limit is never returned, what was written later still is."""
    topic, out = Topic(spark, tmp_path / "logs", LOGS), f"{tmp_path}/out"
    job = lambda: drain(log_jobs.daily_unique_job(topic.read(), out, ("ts", "seq"), ttl_ms=40_000), empty_batches=False)
    found = lambda: values(results.read_result(spark, f"{out}/dwm_unique_visitor"), "seq")
    topic.add(logs(spark, log("a", T0 + 5, seq=1), log("a", T0 + 5, seq=0), log("a", T0 + 9, last="x", seq=2), log("b", T0, seq=3)))
    job()
    topic.add(logs(spark, log("a", T0 + 1, seq=4), log("a", T0 + 86_400_000, seq=5)))
    job()
    assert found() == [(0,), (3,), (5,)]
    time.sleep(41)
    topic.add(logs(spark, log("a", T0 + 7, seq=6), log("c", T0, seq=7)))
    job()
    assert found() == [(0,), (3,), (5,), (6,), (7,)]
    topic.add(logs(spark, log("c", T0 - 1, seq=8)))
    job()
    assert found() == [(0,), (3,), (5,), (6,), (7,)]


def test_thinning_loses_no_bounce():
    """Records of a visitor cut into parts and thinned in any grouping decide the same entries."""
    rng = random.Random(7)
    for _ in range(400):
        limit = rng.choice([1, 3, 10])
        records = sorted((ts, n, f"p{n}" if rng.random() < 0.5 else None) for n, ts in enumerate(rng.choices(range(30), k=rng.randrange(1, 14))))
        want = [r[-1] for k, r in enumerate(records) if r[-1] and (k + 1 == len(records) or records[k + 1][0] - r[0] >= limit)]
        parts = [[], [], []]
        for r in records:
            rng.choice(parts).append(r)
        left = state.thinned(sorted((r for part in parts for r in state.thinned(part, limit)), key=state._place), limit)
        assert [r[-1] for r in left if r[-1]] == want
        assert sum(r[-1] is None for r in state.thinned([(t, t, None) for t in range(100)], 10)) <= 22


def test_bounces_come_when_decided(spark, tmp_path):
    """A timer fires as soon as the watermark passes the limit; records out of order within the delay count."""
    topic, out = Topic(spark, tmp_path / "logs", LOGS), f"{tmp_path}/out"
    job = lambda delay: drain(log_jobs.bounce_timer_job(topic.read(), out, 1000, ("ts", "seq"), delay))
    found = lambda: values(spark.read.schema(LOGS).parquet(f"{out}/dwm_user_jump_detail"), "seq")
    topic.add(logs(spark, log("a", T0, seq=1), log("b", T0 + 400, seq=2), log("c", T0 + 500, seq=3), log("c", T0 + 500, seq=4)))
    topic.add(logs(spark, log("b", T0 + 1399, last="x", seq=5), log("z", T0 + 1000, last="x", seq=6)))
    job("0 seconds")
    assert found() == [(1,)]  # not refuted, and the watermark is at its limit; the others are not decided yet
    topic.add(logs(spark, log("z", T0 + 1500, last="x", seq=7)))
    job("0 seconds")
    assert found() == [(1,), (4,)]  # of two at one moment the later is the last
    topic.add(logs(spark, log("z", T0 + 90_000, last="x", seq=8), log("d", T0 + 90_000, seq=9)))
    topic.add(logs(spark, log("a", T0 + 100, seq=10), log("d", T0 + 90_000, last="x", seq=11)))
    job("0 seconds")
    assert found() == [(1,), (4,)]


def test_bounces_out_of_order(spark, tmp_path):
    topic, out = Topic(spark, tmp_path / "logs", LOGS), f"{tmp_path}/out"
    times = [0, 5000, 2500, 4100, 9000, 7900, 8100, 30_000]
    rows = [log(f"m{n % 2}", T0 + t, seq=n, last=None if n % 3 else "x") for n, t in enumerate(times)]
    for row in rows:
        topic.add(logs(spark, row))
    drain(log_jobs.bounce_timer_job(topic.read(), out, 1000, ("ts", "seq"), "4 seconds"))
    whole = visitors.bounces(logs(spark, *rows), 1000, ("ts", "seq")).filter(F.col("ts") < T0 + 26_000)
    assert values(spark.read.schema(LOGS).parquet(f"{out}/dwm_user_jump_detail"), "seq") == values(whole, "seq")


def test_bounce_next_record_in_a_later_batch(spark, tmp_path):
    topic, out = Topic(spark, tmp_path / "logs", LOGS), f"{tmp_path}/out"
    topic.add(logs(spark, log("a", T0 + 900, seq=1), log("b", T0 + 900, seq=2)))
    topic.add(logs(spark, log("a", T0 + 1500, last="x", seq=3), log("b", T0 + 1900, last="x", seq=4)))
    topic.add(logs(spark, log("z", T0 + 60_000, last="x", seq=5)))
    drain(log_jobs.bounce_job(topic.read(), out))
    assert values(spark.read.parquet(f"{out}/dwm_user_jump_detail"), "seq") == [(2,)]


def test_unique_visitor_keeps_the_first_to_arrive(spark, tmp_path):
    topic, out = Topic(spark, tmp_path / "logs", LOGS), f"{tmp_path}/out"
    topic.add(logs(spark, log("a", T0 + 5000, seq=1), log("a", T0 + 4000, seq=2)))
    topic.add(logs(spark, log("a", T0 + 1000, seq=3), log("b", T0 + 1000, seq=4)))
    drain(log_jobs.unique_visitor_job(topic.read(), out))
    assert values(results.read_result(spark, f"{out}/dwm_unique_visitor"), "seq") == [(2,), (4,)]


def test_unique_visitor_days_follow_the_session_zone(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        rows = logs(spark, log("a", "2024-01-01 15:59:00", seq=1), log("a", "2024-01-01 16:01:00", seq=2),
                    log("a", "2024-01-02 15:00:00", seq=3))
        topic, out = Topic(spark, tmp_path / "logs", LOGS), f"{tmp_path}/out"
        topic.add(rows)
        drain(log_jobs.unique_visitor_job(topic.read(), out))
        streamed = values(results.read_result(spark, f"{out}/dwm_unique_visitor"), "seq")
        assert streamed == values(visitors.unique_visitors(rows), "seq") == [(1,), (2,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_unique_visitor_late_rows_and_daylight_saving(spark, tmp_path):
    """Nothing is lost however late it comes, nothing comes twice, and days are local dates."""
    zone = "Europe/Berlin"  # 31 March 2024 has 23 hours there
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        topic, out = Topic(spark, tmp_path / "logs", LOGS), f"{tmp_path}/out"
        parts = [logs(spark, log("a", "2024-03-30 22:30:00", seq=1), log("a", "2024-03-30 23:30:00", seq=2), log("a", "2024-03-31 21:30:00", seq=3),
                      log("a", "2024-03-31 22:30:00", seq=4)),
                 logs(spark, log("a", "2024-04-05 10:00:00", seq=5), log("b", "2024-04-05 10:00:00", seq=6)),
                 logs(spark, log("b", "2024-03-31 10:00:00", seq=7), log("a", "2024-03-31 10:00:00", seq=8))]
        for part in parts:
            topic.add(part)
            drain(log_jobs.unique_visitor_job(topic.read(), out, ("ts", "seq")))
        assert values(results.read_result(spark, f"{out}/dwm_unique_visitor"), "seq", "dt") == [
            (1, "2024-03-30"), (2, "2024-03-31"), (4, "2024-04-01"), (5, "2024-04-05"), (6, "2024-04-05"), (7, "2024-03-31")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_late_rows_are_dropped(spark, tmp_path):
    topic = Topic(spark, tmp_path / "logs", LOGS)
    topic.add(logs(spark, log("a", T0), log("a", T0 + 14_000, last="x")))
    topic.add(logs(spark, log("a", T0 + 30_000, last="x")))
    topic.add(logs(spark, log("a", T0 + 1, last="x"), log("a", T0 + 60_000, last="x")))
    stats = visitors.visitor_stats(visitors.page_view_metrics(topic.read()))
    query = drain(topics.folder_sink(stats, f"{tmp_path}/o", f"{tmp_path}/c"))
    assert dropped(query) == 1
    assert values(spark.read.parquet(f"{tmp_path}/o"), F.substring("stt", 12, 8).alias("t"), "pv_ct") == [
        ("10:00:00", 1), ("10:00:10", 1), ("10:00:30", 1)]


def text(millis):
    import datetime as dt
    return dt.datetime.fromtimestamp(millis / 1000, dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def test_order_jobs_equal_batch(spark, tmp_path):
    out = f"{tmp_path}/out"
    orders = Topic(spark, tmp_path / "orders", schemas.ORDER_INFO)
    details = Topic(spark, tmp_path / "details", schemas.ORDER_DETAIL)
    paid = Topic(spark, tmp_path / "paid", schemas.PAYMENT_INFO)
    everything = {"orders": [], "details": [], "paid": []}
    for part in range(3):
        keys = range(part * 10, part * 10 + 10)
        at = {k: T0 + k * 4000 for k in keys}
        frames = {
            "orders": table(spark, schemas.ORDER_INFO, *(
                {"id": k, "user_id": k % 3, "province_id": 1, "total_amount": D(k), "create_time": text(at[k]),
                 "create_ts": at[k]} for k in keys)),
            "details": table(spark, schemas.ORDER_DETAIL, *(
                {"id": 10 * k + n, "order_id": k, "sku_id": n, "sku_num": 1, "split_total_amount": D(n),
                 "create_time": text(at[k]), "create_ts": at[k] + (n - 1) * 3000} for k in keys for n in range(4))),
            "paid": table(spark, schemas.PAYMENT_INFO, *(
                {"id": k, "order_id": k, "user_id": 7, "total_amount": D(1), "create_time": text(at[k]),
                 "callback_time": text(at[k] + k * 1000)} for k in keys if k % 2)),
        }
        for topic, name in ((orders, "orders"), (details, "details"), (paid, "paid")):
            topic.add(frames[name])
            everything[name].append(frames[name])
    whole = {name: frames[0].unionByName(frames[1]).unionByName(frames[2]) for name, frames in everything.items()}
    text_dim = lambda columns: spark.createDataFrame([], columns)
    users = spark.createDataFrame([("1", "F", "2000-01-01")], "id string, gender string, birthday string")
    dims = {
        "users": users,
        "provinces": spark.createDataFrame([("1", "P", "I", "A", "X")],
                                           "id string, name string, iso_code string, area_code string, iso_3166_2 string"),
        "products": wide.product_dim(
            text_dim("id string, sku_name string, price string, spu_id string, category3_id string, tm_id string"),
            text_dim("id string, spu_name string"), text_dim("id string, name string"), text_dim("id string, tm_name string")),
    }
    drain(order_jobs.order_wide_job(orders.read(), details.read(), out, lambda session: dims, "2024-01-01"))
    want = wide.with_dimensions(wide.order_wide(whole["orders"], whole["details"]), **dims, as_of="2024-01-01")
    got = results.read_result(spark, f"{out}/dwm_order_wide")
    assert values(got, *schemas.ORDER_WIDE.names) == values(want, *schemas.ORDER_WIDE.names)
    assert got.count() == 90

    source = topics.file_source(orders.spark, f"{out}/dwm_order_wide", got.schema)
    drain(order_jobs.payment_wide_job(paid.read(), source, out))
    got_paid, want_paid = spark.read.parquet(f"{out}/dwm_payment_wide"), wide.payment_wide(whole["paid"], want)
    assert values(got_paid, "payment_id", "detail_id", "total_amount") == values(want_paid, "payment_id", "detail_id", "total_amount")

    metrics = lambda w, p: products.order_metrics(w).unionByName(products.payment_metrics(p))
    paid_source = topics.file_source(orders.spark, f"{out}/dwm_payment_wide", got_paid.schema)
    drain(order_jobs.product_stats_job(metrics(source, paid_source), out, lambda session: dims["products"]))
    batch_metrics = metrics(want, want_paid)
    last = batch_metrics.agg(F.max("ts")).first()[0]
    stats = products.product_stats_wide(products.product_stats(batch_metrics), dims["products"])
    columns = ("stt", "edt", "sku_id", "order_ct", "order_amount", "paid_order_ct", "payment_amount")
    closed = [row for row in values(stats, *columns) if ms(row[1]) <= last - 3000]
    assert values(results.read_result(spark, f"{out}/product_stats"), *columns) == closed and closed

    drain(order_jobs.province_stats_job(source, out))
    by_province = results.read_result(spark, f"{out}/province_stats")
    assert set(schemas.PROVINCE_STATS) < set(by_province.columns) and by_province.count() > 5


def test_change_job_upserts_across_batches(spark, tmp_path):
    out = f"{tmp_path}/out"
    schema = T.StructType([*schemas.CHANGE, T.StructField("seq", T.LongType())])
    topic = Topic(spark, tmp_path / "changes", schema)
    config = table(spark, schemas.ROUTING, *(
        {"source_table": "users", "operate_type": op, "sink_type": "hbase", "sink_table": "dim_users",
         "sink_columns": "id,name,city"} for op in ("insert", "update")),
        {"source_table": "orders", "operate_type": "insert", "sink_type": "kafka", "sink_table": "dwd_orders",
         "sink_columns": "id"})
    row = lambda seq, target, kind, **data: {"table": target, "type": kind, "data": data, "seq": seq}
    topic.add(table(spark, schema, row(1, "users", "insert", id="1", name="a", city="x", secret="s"),
                    row(2, "orders", "insert", id="9", note="n"), row(3, "goods", "insert", id="4")))
    job = lambda: change_jobs.route_job(topic.read(), out, lambda session: config)
    drain(job())
    topic.add(table(spark, schema, row(4, "users", "update", id="1", city="y"), row(5, "users", "insert", id="2", name="b")))
    topic.add(table(spark, schema, row(6, "orders", "insert", id="10")))
    drain(job())
    users = change_jobs.read_dimension(spark, out, "dim_users", "id", ["city", "id", "name"])
    assert values(users, "id", "name", "city") == [("1", "a", "y"), ("2", "b", None)]
    event = "`table` string, type string, data map<string,string>, seq bigint"
    facts = change_jobs.read_routed(spark, out, "fact", event)
    assert sorted((r.sink_table, json.dumps(r.data)) for r in facts.collect()) == [
        ("dwd_orders", '{"id": "10"}'), ("dwd_orders", '{"id": "9"}')]
    assert values(change_jobs.read_routed(spark, out, "unrouted", event), "table") == [("goods",)]


def test_a_retried_batch_replaces_its_files(spark, tmp_path):
    frame = spark.createDataFrame([("2024-01-01 00:00:00", 1, 7)], "stt string, n int, helper int")
    for _ in range(2):
        results.append_batch(results.result_rows(frame, ["stt", "n", "ts"]), f"{tmp_path}/t", 0, day_from="stt")
    rows = results.read_result(spark, f"{tmp_path}/t", view="stats")
    assert rows.count() == 1 and "helper" not in rows.columns
    assert spark.sql("SELECT n FROM stats WHERE dt = '2024-01-01'").first()[0] == 1


def test_messages_and_declared_views(spark, tmp_path):
    routed = spark.createDataFrame([("t1", {"a": "1"})], "sink_table string, data map<string,string>")
    assert values(topics.as_messages(routed), "topic", "value") == [("t1", '{"a":"1"}')]
    assert values(topics.as_messages(routed.select("sink_table"), "fixed"), "topic", "value") == [
        ("fixed", '{"sink_table":"t1"}')]
    spark.createDataFrame([('{"create_time":"2024-01-01 00:00:05","amount":2}',),
                           ('{"create_time":"2024-01-01 00:00:30","amount":3}',)], "value string").coalesce(1).write.text(
        f"{tmp_path}/raw")
    session = streaming_session(spark)
    schema = T.StructType([T.StructField("create_time", T.StringType()), T.StructField("amount", T.LongType())])
    topics.declare_view(topics.log_source(session, f"{tmp_path}/raw"), "ORDER_WIDE", schema, "create_time", "0 seconds")
    stats = session.sql("""
        SELECT date_format(window.start, 'HH:mm:ss') AS stt, sum(amount) AS amount
        FROM ORDER_WIDE GROUP BY window(rowtime, '10 seconds')""")
    drain(topics.folder_sink(stats, f"{tmp_path}/o", f"{tmp_path}/c"))
    assert values(spark.read.parquet(f"{tmp_path}/o"), "stt", "amount") == [("00:00:00", 2)]


def test_given_table_as_a_stream_of_a_folder(spark, tmp_path):
    spark.range(10).repartition(3).write.parquet(f"{tmp_path}/given/numbers.parquet")
    numbers = stream(streaming_session(spark), f"{tmp_path}/given", "numbers")
    drain(topics.folder_sink(numbers, f"{tmp_path}/o", f"{tmp_path}/c"))
    assert spark.read.parquet(f"{tmp_path}/o").count() == 10


def test_late_rows_are_kept_and_counted(spark, tmp_path):
    """What Spark says it drops is what the job keeps, batch by batch, and what is counted per query."""
    schema = visitors.page_view_metrics(logs(spark, log("a", T0))).schema
    topic, out = Topic(spark, tmp_path / "metrics", schema), f"{tmp_path}/out"
    listener = late.LateCounts()
    topic.spark.streams.addListener(listener)
    try:
        for at in ([0, 14_000], [30_000], [1, 12_000], [60_000, 2], [29_000, 3, 31_000], [57_000, 49_999]):
            topic.add(visitors.page_view_metrics(logs(spark, *(log(f"m{t}", T0 + t, last="x", vc=f"v{t}") for t in at))))
        query = drain(late.visitor_stats_and_late_rows(topic.read(), out).queryName("stats"), empty_batches=False)
        kept = late.late_rows(spark, out, schema)
        per_batch = {b: n for b, n in late.dropped_by_batch(query).items() if n}
        assert per_batch == {r["batch"]: r["count"] for r in kept.groupBy("batch").count().collect()} and per_batch
        for _ in range(100):
            if listener.dropped["stats"] == sum(per_batch.values()):
                break
            time.sleep(0.1)
        assert listener.dropped["stats"] == sum(per_batch.values())
        stats = results.read_result(spark, f"{out}/visitor_stats")
        counted = stats.agg(F.sum("pv_ct")).first()[0] + kept.count()
        assert counted <= 12 and stats.filter("vc = 'v1'").count() == 0 and ("m1",) in values(kept, "mid")
    finally:
        topic.spark.streams.removeListener(listener)


def test_a_watermark_for_each_input(spark, tmp_path):
    """A slow input behind a fast one loses nothing by the least of their watermarks, and its rows by the greatest."""
    sums = {}
    for policy in ("min", "max"):
        out = f"{tmp_path}/{policy}"
        fast, slow = Topic(spark, f"{out}/fast", LOGS), Topic(spark, f"{out}/slow", LOGS)
        fast.spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", policy)
        for n in range(3):
            fast.add(logs(spark, log("f", T0 + 3_600_000 * (n + 1), last="x")))
            slow.add(logs(spark, log("s", T0 + 20_000 * n), log("s", T0 + 20_000 * n + 1)))
        fast.add(logs(spark, log("f", T0 + 86_400_000, last="x")))
        slow.add(logs(spark, log("s", T0 + 86_400_000)))
        uniques = topics.file_source(fast.spark, slow.folder, LOGS, files_per_batch=1)
        empty = Topic(spark, f"{out}/none", LOGS)
        empty.add(logs(spark, log("e", T0 + 86_400_000)))
        jumps = topics.file_source(fast.spark, empty.folder, LOGS, files_per_batch=1)
        drain(log_jobs.visitor_stats_job(fast.read(), uniques, jumps, out, per_input=True))
        sums[policy] = results.read_result(spark, f"{out}/visitor_stats").agg(F.sum("uv_ct")).first()[0]
    assert sums["min"] == 6 and sums["max"] < 6


def test_broken_lines_have_a_topic(spark, tmp_path):
    good_line = '{"common":{"mid":"m","is_new":"1"},"page":{"page_id":"home"},"ts":1704067200000}'
    lines = ["{bad json", good_line, "", "   ", "null", "[1]", "[" + good_line + "]", '"text"', "7", '{"ts":"soon"}', "{}",
             '{"common":{"mid":"s"},"start":{"entry":"icon"},"ts":1704067200000}', good_line + "}", '{"common": 5, "ts": 1}']
    frame = spark.createDataFrame([(line, n) for n, line in enumerate([*lines, None])], "value string, offset int")
    rows = applog.parsed(frame, schemas.APP_LOG)
    assert rows.columns == ["offset", *schemas.APP_LOG.names, "bad"]
    assert {r.offset for r in rows.filter("bad IS NULL").collect()} == {1, 10, 11, 12}
    assert {r.offset: r.bad for r in rows.filter("bad IS NOT NULL").collect()} == {
        n: line or "" for n, line in enumerate([*lines, None]) if n not in (1, 10, 11, 12)}
    assert applog.parse_logs(frame).count() == 4

    frame.filter("value IS NOT NULL").select("value").coalesce(1).write.text(f"{tmp_path}/in")
    session, out = streaming_session(spark), f"{tmp_path}/out"
    drain(log_jobs.split_job(applog.parsed(topics.log_source(session, f"{tmp_path}/in")), out))
    read = lambda topic, schema: log_jobs.read_topic(spark, out, topic, schema)
    assert read(log_jobs.BAD, T.StructType.fromDDL("value string")).count() == len(lines) - 4
    assert read(log_jobs.PAGE, schemas.APP_LOG).count() == 3 and read(log_jobs.START, schemas.APP_LOG).count() == 1


def test_broken_change_events_are_left_out(spark):
    text = '{"source":{"db":"d","table":"t"},"op":"c","after":{"id":"1"}}'
    frame = spark.createDataFrame([("{oops", 1), (text, 2), ("", 3), ("[]", 4)], "value string, seq bigint")
    assert values(change_ops.flatten_envelopes(frame), "seq", "table", "type") == [(2, "t", "insert")]
    assert values(change_ops.parse_changes(spark.createDataFrame([('{"table":"t"}', 1), ("{", 2)], "value string, seq int")), "seq") == [(1,)]
