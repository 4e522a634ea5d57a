"""Joins and windows whose state is files: several batches, passes, late rows, repeated batches, and what stays stored."""

from __future__ import annotations

import os
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from martbrook import schemas
from martbrook.operators import products, wide
from martbrook.sources import results, topics
from martbrook.streaming import orders as order_jobs, pending
from martbrook.streaming.runtime import drain
from rows import ms, table, values
from test_streaming import Topic, text

T0 = ms("2024-01-01 10:00:00")


def order(key, second, **more):
    return {"id": key, "user_id": 1, "province_id": 1, "total_amount": D(5), "create_time": text(T0 + second * 1000),
            "create_ts": T0 + second * 1000} | more


def line(number, key, second, **more):
    return {"id": number, "order_id": key, "sku_id": 1, "sku_num": 1, "split_total_amount": D(2),
            "create_ts": None if second is None else T0 + second * 1000} | more


def payment(number, key, second):
    return {"id": number, "order_id": key, "user_id": 7, "total_amount": D(1), "callback_time": text(T0 + second * 1000)}


@pytest.fixture
def dims(spark):
    return {
        "users": spark.createDataFrame([("1", "F", "2000-01-01"), ("2", "M", "1990-01-01")], "id string, gender string, birthday string"),
        "provinces": spark.createDataFrame([("1", "P", "I", "A", "X")], "id string, name string, iso_code string, area_code string, iso_3166_2 string"),
        "products": spark.createDataFrame(
            [("1", "pen", D("2.50"), 3, 4, 5, "s", "c", "t")],
            "id string, sku_name string, sku_price decimal(16,2), spu_id bigint, category3_id bigint, tm_id bigint, spu_name string, "
            "category3_name string, tm_name string"),
    }


def stored(spark, out, batch):
    path = f"{out}/rows/batch={batch}"
    return spark.read.parquet(path).count() if os.path.exists(path) else 0


def files(folder):
    return [f for _, _, names in os.walk(folder) for f in names if f.endswith(".parquet")]


@pytest.mark.parametrize("rows_a_pass", [16_000_000, 4])
def test_a_join_keeps_only_what_may_still_meet(spark, tmp_path, monkeypatch, dims, rows_a_pass):
    monkeypatch.setattr(pending, "PASS_ROWS", rows_a_pass)
    out = f"{tmp_path}/out"
    orders, details = Topic(spark, tmp_path / "o", schemas.ORDER_INFO), Topic(spark, tmp_path / "d", schemas.ORDER_DETAIL)
    job = lambda: drain(order_jobs.order_wide_job(orders.read(), details.read(), out, lambda session: dims, "2024-01-01"))
    found = lambda: values(results.read_result(spark, f"{out}/dwm_order_wide"), "detail_id")
    orders.add(table(spark, schemas.ORDER_INFO, *(order(k, k) for k in range(60)), order(59, 59, user_id=2), order(70, 0, create_ts=None)))
    details.add(table(spark, schemas.ORDER_DETAIL, *(line(k, k, k) for k in range(50)), line(100, 3, 9), line(101, 59, 58),
                      line(102, None, 9), line(103, 70, None), line(104, 5, 10)))
    query = job()
    # Before: every row of the batch was put into a state store, and an order four times.
    assert not any(p.stateOperators for p in query.recentProgress)
    expected = [*range(50), 101, 101, 104]
    assert found() == sorted(((n,) for n in expected), key=str)
    # The watermark is at 55 (the lines' 58 less 3): orders from 51 on, which reach 5 seconds further, and one line are needed.
    assert stored(spark, f"{out}/pending/order_wide", 0) == 10 + 1
    assert sum(os.path.isdir(f"{out}/dwm_order_wide/{d}") for d in os.listdir(f"{out}/dwm_order_wide")) == (1 if rows_a_pass > 100 else 8)
    orders.add(table(spark, schemas.ORDER_INFO, order(80, 120), order(81, 54)))  # the second is late
    details.add(table(spark, schemas.ORDER_DETAIL, line(200, 59, 60), line(201, 58, 56), line(202, 57, 55), line(203, 80, 118), line(204, 81, 56)))
    job()
    assert found() == sorted(((n,) for n in [*expected, 200, 200, 201, 203]), key=str)
    orders.add(table(spark, schemas.ORDER_INFO, order(90, 300)))
    details.add(table(spark, schemas.ORDER_DETAIL, line(300, 80, 124), line(301, 90, 296)))
    job()
    assert found() == sorted(((n,) for n in [*expected, 200, 200, 201, 203, 300, 301]), key=str)
    orders.add(table(spark, schemas.ORDER_INFO, order(91, 300)))
    details.add(table(spark, schemas.ORDER_DETAIL, line(302, 91, 300)))
    job()
    assert stored(spark, f"{out}/pending/order_wide", 0) == 0 and stored(spark, f"{out}/pending/order_wide", 1) == 0


@pytest.mark.parametrize("rows_a_pass", [16_000_000, 2])
def test_payments_meet_wide_rows_of_other_batches(spark, tmp_path, monkeypatch, rows_a_pass):
    monkeypatch.setattr(pending, "PASS_ROWS", rows_a_pass)
    out = f"{tmp_path}/out"
    paid, lines = Topic(spark, tmp_path / "p", schemas.PAYMENT_INFO), Topic(spark, tmp_path / "w", schemas.ORDER_WIDE)
    unpaid = lambda *rows: table(spark, schemas.ORDER_WIDE, *(
        {"order_id": k, "detail_id": 10 * (k or 0), "sku_id": 1, "split_total_amount": D(2), "create_ts": T0 + s * 1000} for k, s in rows))
    lines.add(unpaid((1, 0), (2, 10), (3, 20), (None, 20)))
    paid.add(table(spark, schemas.PAYMENT_INFO, payment(1, 1, 0), payment(4, 4, 900), payment(5, None, 20)))
    lines.add(unpaid((4, 800), (5, 850)))
    paid.add(table(spark, schemas.PAYMENT_INFO, payment(2, 2, 1810), payment(3, 3, 1821), payment(6, 5, 849)))
    query = drain(order_jobs.payment_wide_job(paid.read(), lines.read(), out))
    assert not any(p.stateOperators for p in query.recentProgress)
    rows = spark.read.parquet(f"{out}/dwm_payment_wide")
    assert values(rows, "payment_id", "detail_id", "total_amount", "order_create_time") == [
        (1, 10, D("1.00"), text(T0)), (2, 20, D("1.00"), text(T0 + 10_000)), (4, 40, D("1.00"), text(T0 + 800_000))]
    whole = wide.payment_wide(spark.read.schema(schemas.PAYMENT_INFO).parquet(f"{paid.folder}/*"),
                              spark.read.schema(schemas.ORDER_WIDE).parquet(f"{lines.folder}/*"))
    assert values(rows, *whole.columns) == values(whole, *whole.columns)
    assert not files(f"{out}/pending/payment_wide/arrived") or spark.read.parquet(f"{out}/pending/payment_wide/arrived").count() == 0


def test_a_repeated_batch_replaces_what_it_wrote(spark, tmp_path, monkeypatch, dims):
    """The second batch fails after its output is written, and is done again."""
    out = f"{tmp_path}/out"
    orders, details = Topic(spark, tmp_path / "o", schemas.ORDER_INFO), Topic(spark, tmp_path / "d", schemas.ORDER_DETAIL)
    job = lambda: drain(order_jobs.order_wide_job(orders.read(), details.read(), out, lambda session: dims, "2024-01-01"))
    orders.add(table(spark, schemas.ORDER_INFO, order(1, 0), order(2, 3)))
    details.add(table(spark, schemas.ORDER_DETAIL, line(1, 1, 0), line(2, 2, 3)))
    job()
    orders.add(table(spark, schemas.ORDER_INFO, order(3, 60)))
    details.add(table(spark, schemas.ORDER_DETAIL, line(3, 3, 61), line(4, 2, 8)))
    whole = pending.Batch.finish
    monkeypatch.setattr(pending.Batch, "finish", lambda self: (whole(self), 1 / 0))
    with pytest.raises(Exception, match="division"):
        job()
    monkeypatch.setattr(pending.Batch, "finish", whole)
    job()
    assert values(results.read_result(spark, f"{out}/dwm_order_wide"), "detail_id") == [(1,), (2,), (3,), (4,)]


def test_lookups_ahead_of_the_join_change_no_row(spark, dims):
    """Also where keys are missing, unknown, or in a dimension twice."""
    twice = {**dims, "users": dims["users"].unionByName(dims["users"].filter("id = '2'"))}
    orders = table(spark, schemas.ORDER_INFO, order(1, 0), order(2, 0, user_id=2), order(3, 0, user_id=None, province_id=9))
    details = table(spark, schemas.ORDER_DETAIL, line(1, 1, 0), line(2, 2, 1, sku_id=None), line(3, 3, 2, sku_id=8), line(4, 2, 3, sku_name="own"))
    want = wide.with_dimensions(wide.order_wide(orders, details), **twice, as_of="2024-01-01")
    got = wide.order_wide(*wide.with_dimensions_ahead(orders, details, **twice, as_of="2024-01-01"))
    assert values(got, *want.columns) == values(want, *want.columns) and got.count() == 6
    assert got.dtypes == want.dtypes


def wide_rows(spark, *rows):
    return table(spark, schemas.ORDER_WIDE, *(
        {"order_id": k, "detail_id": k, "sku_id": k % 2, "sku_num": 1, "province_id": p, "split_total_amount": D(2),
         "create_ts": None if s is None else T0 + s * 1000} for k, p, s in rows))


@pytest.mark.parametrize("rows_a_pass", [16_000_000, 1])
def test_province_windows_close_whole_and_once(spark, tmp_path, monkeypatch, rows_a_pass):
    monkeypatch.setattr(pending, "PASS_ROWS", rows_a_pass)
    out, topic = f"{tmp_path}/out", Topic(spark, tmp_path / "w", schemas.ORDER_WIDE)
    topic.add(wide_rows(spark, (1, 1, 0), (1, 1, 9), (2, 1, 5), (3, None, 12), (4, 1, 25), (5, 1, None)))
    topic.add(wide_rows(spark, (6, 1, 19), (7, 1, 22), (4, 1, 28), (8, 2, 60)))  # the first is late
    topic.add(wide_rows(spark, (9, 2, 61)))
    query = drain(order_jobs.province_stats_job(topic.read(), out))
    assert not any(p.stateOperators for p in query.recentProgress)
    rows = results.read_result(spark, f"{out}/province_stats")
    assert values(rows, F.substring("stt", 12, 8).alias("t"), "province_id", "order_count", "order_amount") == [
        ("10:00:00", 1, 2, D("6.00")), ("10:00:10", None, 1, D("2.00")), ("10:00:20", 1, 2, D("6.00"))]
    assert stored(spark, f"{out}/pending/province_stats", 0) == 0 and stored(spark, f"{out}/pending/province_stats", 1) == 1


@pytest.mark.parametrize("rows_a_pass", [16_000_000, 1])
def test_product_windows_count_each_order_once(spark, tmp_path, monkeypatch, dims, rows_a_pass):
    """An order whose lines come in two batches of one window is one order; windows that are not closed yet stay stored."""
    monkeypatch.setattr(pending, "PASS_ROWS", rows_a_pass)
    out, topic = f"{tmp_path}/out", Topic(spark, tmp_path / "w", schemas.ORDER_WIDE)
    parts = [wide_rows(spark, (1, 1, 0), (1, 1, 1), (3, 1, 2), (2, 1, 5), (5, 1, 11)), wide_rows(spark, (5, 1, 12), (7, 1, 19), (9, 1, 30)),
             wide_rows(spark, (11, 1, 9), (11, 1, 31), (9, 1, 39), (2, 1, 43))]  # the first is late
    for part in parts:
        topic.add(part)
    query = drain(order_jobs.product_stats_job(products.order_metrics(topic.read()), out, lambda session: dims["products"]))
    assert not any(p.stateOperators for p in query.recentProgress)  # before: a row for each window, product and order
    rows = results.read_result(spark, f"{out}/product_stats")
    assert values(rows, F.substring("stt", 12, 8).alias("t"), "sku_id", "order_ct", "order_sku_num", "order_amount", "tm_name") == sorted([
        ("10:00:00", 0, 1, 1, D("2.00"), None), ("10:00:00", 1, 2, 3, D("6.00"), "t"), ("10:00:10", 1, 2, 3, D("6.00"), "t"),
        ("10:00:30", 1, 2, 3, D("6.00"), "t")], key=str)
    assert [stored(spark, f"{out}/pending/product_stats", n) for n in (0, 1, 2)] == [0, 1, 1]
    everything = parts[0].unionByName(parts[1]).unionByName(parts[2].filter(F.col("create_ts") != T0 + 9000))
    whole = products.product_stats_wide(products.product_stats(products.order_metrics(everything)), dims["products"]).filter(
        F.col("edt") <= text(T0 + 40_000))
    assert values(rows, *whole.columns) == values(whole, *whole.columns)
