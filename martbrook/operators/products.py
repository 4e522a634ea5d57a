"""Product metrics from seven inputs and the windowed product statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.times import event_time, text_millis, window_bounds
from .wide import with_product

GOOD_APPRAISAL = "1201"  # fixed value: the code of a good review

COUNTS = ("display_ct", "click_ct", "cart_ct", "favor_ct", "order_sku_num", "comment_ct", "good_comment_ct")
AMOUNTS = ("order_amount", "payment_amount", "refund_amount")
# Which distinct ids each kind of reference feeds.
REFERENCES = {"order": "order_ct", "paid": "paid_order_ct", "refund": "refund_order_ct"}


def _metric(rows: DataFrame, sku: Column, ts: Column, kind: str | Column | None = None, ref: Column | None = None,
            **measures: Column) -> DataFrame:
    return rows.select(
        sku.cast("bigint").alias("sku_id"),
        ts.alias("ts"),
        F.lit(kind).cast("string").alias("ref_kind"),
        (F.lit(None) if ref is None else ref).cast("bigint").alias("ref_id"),
        *(measures.get(name, F.lit(0)).cast("bigint").alias(name) for name in COUNTS),
        *(measures.get(name, F.lit(0)).cast("decimal(16,2)").alias(name) for name in AMOUNTS),
    )


def _created() -> Column:
    return text_millis(F.col("create_time"))


def click_metrics(pages: DataFrame) -> DataFrame:
    return _metric(pages.filter(F.col("page.page_id") == "good_detail"),
                   F.col("page.item"), F.col("ts"), click_ct=F.lit(1))


def display_metrics(pages: DataFrame) -> DataFrame:
    shown = pages.select("ts", F.explode("displays").alias("shown"))
    return _metric(shown.filter(F.col("shown.item_type") == "sku_id"),
                   F.col("shown.item"), F.col("ts"), display_ct=F.lit(1))


def page_metrics(pages: DataFrame) -> DataFrame:
    """Clicks and exposures together, in one pass over the page log."""
    seen = lambda item, click, display: F.struct(
        item.alias("item"), F.lit(click).alias("click"), F.lit(display).alias("display"))
    none = F.array().cast("array<struct<item:string,click:int,display:int>>")
    click = F.when(F.col("page.page_id") == "good_detail", F.array(seen(F.col("page.item"), 1, 0)))
    products = F.filter("displays", lambda shown: shown["item_type"] == "sku_id")
    shown = F.transform(products, lambda shown: seen(shown["item"], 0, 1))
    rows = pages.select("ts", F.inline(F.concat(F.coalesce(click, none), F.coalesce(shown, none))))
    return _metric(rows, F.col("item"), F.col("ts"), click_ct=F.col("click"), display_ct=F.col("display"))


def favor_metrics(favors: DataFrame) -> DataFrame:
    return _metric(favors, F.col("sku_id"), _created(), favor_ct=F.lit(1))


def cart_metrics(carts: DataFrame) -> DataFrame:
    return _metric(carts, F.col("sku_id"), _created(), cart_ct=F.lit(1))


def refund_metrics(refunds: DataFrame) -> DataFrame:
    return _metric(refunds, F.col("sku_id"), _created(), "refund", F.col("order_id"),
                   refund_amount=F.coalesce(F.col("refund_amount"), F.lit(0)))


def comment_metrics(comments: DataFrame) -> DataFrame:
    return _metric(comments, F.col("sku_id"), _created(), comment_ct=F.lit(1),
                   good_comment_ct=F.when(F.col("appraise") == GOOD_APPRAISAL, 1).otherwise(0))


def mark_metrics(marks: DataFrame) -> DataFrame:
    """Favourites and carts in one pass over both; ``kind`` says favor or cart."""
    count = lambda kind: F.when(F.col("kind") == kind, 1).otherwise(0)
    return _metric(marks, F.col("sku_id"), _created(), favor_ct=count("favor"), cart_ct=count("cart"))


def after_sale_metrics(rows: DataFrame) -> DataFrame:
    """Refunds and comments in one pass over both; ``kind`` says refund or comment."""
    refund, comment = F.col("kind") == "refund", F.col("kind") == "comment"
    return _metric(rows, F.col("sku_id"), _created(), F.when(refund, "refund"), F.when(refund, F.col("order_id")),
                   refund_amount=F.coalesce(F.when(refund, F.col("refund_amount")), F.lit(0)),
                   comment_ct=F.when(comment, 1).otherwise(0),
                   good_comment_ct=F.when(comment & (F.col("appraise") == GOOD_APPRAISAL), 1).otherwise(0))


def order_metrics(wide: DataFrame) -> DataFrame:
    return _metric(wide, F.col("sku_id"), F.col("create_ts"), "order", F.col("order_id"),
                   order_sku_num=F.col("sku_num"), order_amount=F.col("split_total_amount"))


def payment_metrics(paid: DataFrame) -> DataFrame:
    return _metric(paid, F.col("sku_id"), text_millis(F.col("callback_time")), "paid", F.col("order_id"),
                   payment_amount=F.col("split_total_amount"))


def product_metrics(pages: DataFrame, favors: DataFrame, carts: DataFrame, refunds: DataFrame,
                    comments: DataFrame, orders: DataFrame, payments: DataFrame) -> DataFrame:
    """The seven inputs as one set of metric rows."""
    return reduce(DataFrame.unionByName, [
        page_metrics(pages), favor_metrics(favors), cart_metrics(carts), refund_metrics(refunds),
        comment_metrics(comments), order_metrics(orders), payment_metrics(payments),
    ])


def merged_metrics(pages: DataFrame, marks: DataFrame, after_sales: DataFrame, orders: DataFrame,
                   payments: DataFrame) -> DataFrame:
    """:func:`product_metrics` where favourites and carts, and refunds and comments, come together."""
    return reduce(DataFrame.unionByName, [
        page_metrics(pages), mark_metrics(marks), after_sale_metrics(after_sales), order_metrics(orders),
        payment_metrics(payments),
    ])


def _sums() -> list[Column]:
    return [F.sum(name).alias(name) for name in (*COUNTS, *AMOUNTS)]


def product_sums(metrics: DataFrame, window: str = "10 seconds", delay: str = "3 seconds") -> DataFrame:
    """Only the sums per tumbling window and product: one shuffle, combined before it."""
    return (
        metrics.withColumn("event_time", event_time(F.col("ts")))
        .withWatermark("event_time", delay)
        .groupBy(F.window("event_time", window), "sku_id").agg(*_sums())
        .select(*window_bounds(), "sku_id", *COUNTS, *AMOUNTS)
    )


def product_stats(metrics: DataFrame, window: str = "10 seconds", delay: str = "3 seconds") -> DataFrame:
    """Sums and distinct order counts per tumbling window and product; batch and streaming.

    Two levels: first per (window, product, order id), then per (window, product), where each
    id is one row and counting rows counts distinct ids. The shuffle of the first level also
    hashes the id, so a best seller is spread over all tasks and no id set is ever held.
    """
    per_reference = (
        metrics.withColumn("event_time", event_time(F.col("ts")))
        .withWatermark("event_time", delay)
        .groupBy(F.window("event_time", window), "sku_id", "ref_kind", "ref_id").agg(*_sums())
    )
    return (
        per_reference.groupBy("window", "sku_id")
        .agg(*_sums(), *(F.count(F.when(F.col("ref_kind") == kind, F.col("ref_id"))).alias(name)
                         for kind, name in REFERENCES.items()))
        .select(*window_bounds(), "sku_id", *COUNTS, *AMOUNTS, *REFERENCES.values())
    )


def product_stats_wide(stats: DataFrame, products: DataFrame) -> DataFrame:
    """Product names, price, category and brand, looked up after the aggregation has shrunk the rows."""
    return with_product(stats, products, price=True)
