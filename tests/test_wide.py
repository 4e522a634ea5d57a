from decimal import Decimal as D

from pyspark.sql import functions as F

from martbrook import schemas
from martbrook.operators import products, provinces, wide
from martbrook.sources import given
from rows import ms, table, values

T0 = ms("2024-01-01 10:00:00")


def text(millis):
    import datetime as dt
    return dt.datetime.fromtimestamp(millis / 1000, dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def orders(spark, **more):
    return table(spark, schemas.ORDER_INFO, {
        "id": 1, "user_id": 5, "province_id": 3, "total_amount": D(100), "create_time": text(T0), "create_ts": T0, **more})


def details(spark, *offsets, **more):
    return table(spark, schemas.ORDER_DETAIL, *(
        {"id": n, "order_id": 1, "sku_id": 9, "sku_num": 2, "split_total_amount": D(10),
         "create_time": text(T0 + off * 1000), "create_ts": T0 + off * 1000, **more} for n, off in enumerate(offsets)))


def test_order_interval_includes_both_ends(spark):
    for salts in (1, 4):
        rows = wide.order_wide(orders(spark), details(spark, -6, -5, 0, 5, 6), salts=salts)
        assert values(rows, "detail_id") == [(1,), (2,), (3,)]
    assert rows.columns == schemas.ORDER_WIDE.names
    assert [f.dataType for f in rows.schema] == [f.dataType for f in schemas.ORDER_WIDE]


def test_payment_interval_and_whose_total_stands(spark):
    for salts in (1, 4):
        for seconds, hit in ((0, 1), (1800, 1), (1801, 0), (-1, 0)):
            paid = table(spark, schemas.PAYMENT_INFO, {
                "id": 70, "order_id": 1, "user_id": 6, "total_amount": D(90), "create_time": text(T0),
                "callback_time": text(T0 + seconds * 1000)})
            rows = wide.payment_wide(paid, wide.order_wide(orders(spark), details(spark, 0)), salts=salts)
            assert values(rows, "payment_id", "user_id", "total_amount", "split_total_amount", "order_create_time") == (
                [(70, 6, D("90.00"), D("10.00"), text(T0))] if hit else [])


def test_missing_dimension_keeps_the_row(spark):
    sku = spark.createDataFrame([("9", "pen", "2.50", "1", "1", "1")],
                                "id string, sku_name string, price string, spu_id string, category3_id string, tm_id string")
    one = lambda column: spark.createDataFrame([("1", column)], f"id string, {column} string")
    dim = wide.product_dim(sku, one("spu_name"), one("name"), one("tm_name"))
    rows = wide.order_wide(orders(spark), details(spark, 0).unionByName(details(spark, 1, sku_id=10)))
    assert values(wide.with_product(rows, dim), "sku_id", "sku_name", "spu_name", "category3_name", "tm_name", "tm_id") == [
        (10, None, None, None, None, None), (9, "pen", "spu_name", "name", "tm_name", 1)]


def test_age_is_counted_in_365_day_years(spark):
    users = spark.createDataFrame([("5", "F", "2000-01-01")], "id string, gender string, birthday string")
    rows = wide.order_wide(orders(spark), details(spark, 0))
    for as_of, age in (("2000-12-30", 0), ("2000-12-31", 1), ("2024-01-01", 24)):
        assert values(wide.with_user(rows, users, as_of), "user_age", "user_gender") == [(age, "F")]


def test_merge_takes_first_non_null_but_never_split_amounts(spark):
    whole = wide.order_wide(orders(spark), details(spark, 0))
    partial = whole.withColumns({"create_time": F.lit(None).cast("string"), "user_id": F.lit(8).cast("bigint"),
                                 "split_total_amount": F.lit(None).cast("decimal(16,2)")})
    assert values(wide.merge_wide(partial, whole), "create_time", "user_id", "split_total_amount") == [(text(T0), 8, None)]


def test_product_stats_counts_orders_once(spark):
    rows = wide.order_wide(orders(spark), details(spark, 0, 1))
    metrics = products.order_metrics(rows)
    assert values(products.product_stats(metrics), "stt", "sku_id", "order_ct", "order_amount", "order_sku_num") == [
        (text(T0), 9, 1, D("20.00"), 4)]
    single = products.order_metrics(wide.order_wide(orders(spark), details(spark, 0)))
    assert values(products.product_stats(single), "order_ct", "paid_order_ct") == [(1, 0)]


def test_all_product_metrics(spark):
    from rows import log, logs
    pages = logs(spark, log("a", T0, page="good_detail", item="9"),
                 log("a", T0, page="good_list", displays=[("9", "sku_id"), None, ("9", "activity_id")]))
    at = {"sku_id": 9, "create_time": text(T0)}
    whole = wide.order_wide(orders(spark), details(spark, 0))
    paid = table(spark, schemas.PAYMENT_INFO, {"id": 70, "order_id": 1, "total_amount": D(90),
                                               "create_time": text(T0), "callback_time": text(T0)})
    apart = products.click_metrics(pages).unionByName(products.display_metrics(pages))
    assert values(products.page_metrics(pages), *apart.columns) == values(apart, *apart.columns)
    metrics = products.product_metrics(
        pages, table(spark, schemas.FAVOR_INFO, at, at), table(spark, schemas.CART_INFO, at),
        table(spark, schemas.REFUND_INFO, {**at, "order_id": 1, "refund_amount": D(3)}, {**at, "order_id": 1}),
        table(spark, schemas.COMMENT_INFO, {**at, "appraise": "1201"}, {**at, "appraise": "1203"}),
        whole, wide.payment_wide(paid, whole))
    stats = products.product_stats(metrics).collect()
    assert len(stats) == 1
    got = stats[0].asDict()
    assert {k: got[k] for k in got if k not in ("stt", "edt")} == {
        "sku_id": 9, "display_ct": 1, "click_ct": 1, "cart_ct": 1, "favor_ct": 2, "order_sku_num": 2,
        "comment_ct": 2, "good_comment_ct": 1, "order_amount": D(10), "payment_amount": D(10), "refund_amount": D(3),
        "order_ct": 1, "paid_order_ct": 1, "refund_order_ct": 1}


def test_inputs_that_come_together_give_the_rows_of_each(spark):
    tables = [spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet") for n in ("events", "lineitem")]
    marks, sales = products.mark_metrics(given.mark_info(tables[0])), products.after_sale_metrics(given.after_sale_info(tables[1]))
    apart = [products.favor_metrics(given.favor_info(tables[0])), products.cart_metrics(given.cart_info(tables[0])),
             products.refund_metrics(given.order_refund_info(tables[1])), products.comment_metrics(given.comment_info(tables[1]))]
    for one, two in ((marks, apart[:2]), (sales, apart[2:])):
        assert values(one, "*") == values(two[0].unionByName(two[1]), "*") != []


def test_province_stats(spark):
    rows = wide.order_wide(orders(spark), details(spark, 0, 1))
    assert values(provinces.province_stats(rows), "province_id", "order_count", "order_amount") == [(3, 1, D("20.00"))]
