"""Order jobs: wide orders and payments, product and province statistics.

Dimensions come from functions that are called for every batch, so that changes show.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import nullcontext
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.times import text_millis
from ..operators.products import product_stats, product_stats_wide
from ..operators.provinces import READ, province_stats
from ..operators.wide import (
    DETAIL_LINE, FROM_PAYMENT, NOT_PAID, ORDER_HEADER, order_wide, payment_wide, with_dimensions_ahead,
)
from ..schemas import PRODUCT_STATS, PROVINCE_STATS
from ..sources.results import append_batch, result_rows
from .dimensions import StoredDimensions
from .pending import Input, close_windows, in_windows, join_batch, side_by_side
from .runtime import as_tables, kept

def order_wide_job(orders: DataFrame, details: DataFrame, out: str,
                   dims: Callable[[SparkSession], dict[str, DataFrame]] | StoredDimensions, as_of: str | None = None,
                   salts: int = 1, seconds: int = 5, delay: str = "3 seconds") -> DataStreamWriter:
    """``dims`` gives the ``users``, ``provinces`` and ``products`` tables: whole, or, where a change job keeps them,
    the buckets that a batch's keys lie in. They are looked up for orders and lines before these meet
    (:func:`.with_dimensions_ahead`). Adaptive execution splits an order with very many lines; ``salts`` does so beforehand."""
    sides = (
        Input(orders.select("id", *ORDER_HEADER), "id", F.col("create_ts"), seconds * 1000),
        Input(details.select("id", "order_id", *DETAIL_LINE, "create_ts"), "order_id", F.col("create_ts"), seconds * 1000))

    def write(batch: DataFrame, number: int) -> None:
        whole = None if isinstance(dims, StoredDimensions) else dims(batch.sparkSession)

        def joined(pairs: list[tuple[DataFrame, DataFrame]], part: str) -> None:
            looked_up = (with_dimensions_ahead(*pair, **(whole or dims.for_batch(*pair)), as_of=as_of) for pair in pairs)
            rows = reduce(DataFrame.unionByName, (order_wide(*pair, seconds, delay, salts) for pair in looked_up))
            append_batch(rows, f"{out}/dwm_order_wide", part, compression="zstd")

        with as_tables(batch.sparkSession), kept(whole["products"]) if whole else nullcontext():
            join_batch(batch, number, f"{out}/pending/order_wide", delay, *sides, joined)

    return side_by_side(*sides).writeStream.foreachBatch(write).option("checkpointLocation", f"{out}/checkpoints/order_wide")


def payment_wide_job(payments: DataFrame, wide: DataFrame, out: str, salts: int = 1, seconds: int = 1800,
                     delay: str = "3 seconds") -> DataStreamWriter:
    unread = {*FROM_PAYMENT, *NOT_PAID} - {"order_id", "create_ts"}
    sides = (Input(payments, "order_id", text_millis(F.col("callback_time")), 0),
             Input(wide.drop(*unread), "order_id", F.col("create_ts"), seconds * 1000))

    def write(batch: DataFrame, number: int) -> None:
        def joined(pairs: list[tuple[DataFrame, DataFrame]], part: str) -> None:
            rows = reduce(DataFrame.unionByName, (payment_wide(*pair, seconds, delay, salts) for pair in pairs))
            append_batch(rows, f"{out}/dwm_payment_wide", part, compression="zstd")

        with as_tables(batch.sparkSession):
            join_batch(batch, number, f"{out}/pending/payment_wide", delay, *sides, joined)

    return side_by_side(*sides).writeStream.foreachBatch(write).option("checkpointLocation", f"{out}/checkpoints/payment_wide")


def product_stats_job(metrics: DataFrame, out: str, products: Callable[[SparkSession], DataFrame],
                      window: str = "10 seconds", delay: str = "3 seconds") -> DataStreamWriter:
    def write(batch: DataFrame, number: int) -> None:
        def closed(rows: DataFrame, part: str) -> None:
            stats = product_stats_wide(product_stats(rows, window, delay), names)
            append_batch(result_rows(stats, PRODUCT_STATS), f"{out}/product_stats", part, day_from="stt", compression="zstd")

        with as_tables(batch.sparkSession), kept(products(batch.sparkSession)) as names:
            close_windows(batch, number, f"{out}/pending/product_stats", delay, "ts", closed)

    return in_windows(metrics, "ts", window).writeStream.foreachBatch(write).option(
        "checkpointLocation", f"{out}/checkpoints/product_stats")


def province_stats_job(wide: DataFrame, out: str, window: str = "10 seconds",
                       delay: str = "0 seconds") -> DataStreamWriter:
    def write(batch: DataFrame, number: int) -> None:
        def closed(rows: DataFrame, part: str) -> None:
            append_batch(result_rows(province_stats(rows, window, delay), PROVINCE_STATS), f"{out}/province_stats", part,
                         day_from="stt", compression="zstd")

        with as_tables(batch.sparkSession):
            close_windows(batch, number, f"{out}/pending/province_stats", delay, "create_ts", closed)

    return in_windows(wide.select(*READ), "create_ts", window).writeStream.foreachBatch(write).option(
        "checkpointLocation", f"{out}/checkpoints/province_stats")
