"""Wide order and payment rows: interval joins and dimension lookups."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.times import age_years, event_time, millis_text, text_time
from ..schemas import ORDER_WIDE

ORDER_HEADER = (
    "order_status", "create_time", "create_date", "create_hour", "activity_reduce_amount",
    "coupon_reduce_amount", "original_total_amount", "feight_fee", "total_amount",
    "province_id", "user_id", "create_ts",
)
DETAIL_LINE = (
    "sku_id", "sku_name", "order_price", "sku_num",
    "split_activity_amount", "split_coupon_amount", "split_total_amount",
)
# Columns a partial wide row takes from another one where its own are null.
MERGED = (
    "order_status", "create_time", "create_date", "coupon_reduce_amount", "activity_reduce_amount",
    "original_total_amount", "feight_fee", "total_amount", "user_id",
    "sku_id", "sku_name", "order_price", "sku_num",
)


def _as_wide(rows: DataFrame, known: Mapping[str, Column]) -> DataFrame:
    """Every column of the wide layout, in order; those not known yet are typed nulls."""
    return rows.select(*(
        known.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name) for field in ORDER_WIDE
    ))


def _salted(many: DataFrame, one: DataFrame, spread: Column, salts: int) -> tuple[DataFrame, DataFrame, Column]:
    """Spread the rows of a key on the ``many`` side over ``salts`` tasks, copying the ``one`` side to each."""
    many = many.withColumn("many_salt", F.pmod(spread, F.lit(salts)))
    one = one.withColumn("one_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return many, one, F.col("many_salt") == F.col("one_salt")


# Columns of a paid row that come from the payment, and columns of a wide row that it does not have.
FROM_PAYMENT = ("order_id", "user_id", "total_amount")
NOT_PAID = ("create_ts", "create_time", "create_date", "create_hour", "expire_time", "operate_time")
# What dimensions add to a wide row, or to its order or line beforehand.
LOOKED_UP = (
    "user_age", "user_gender", "province_name", "province_iso_code", "province_area_code", "province_3166_2_code",
    "spu_id", "category3_id", "tm_id", "spu_name", "category3_name", "tm_name",
)


# --- interval joins ----------------------------------------------------------
def order_wide(orders: DataFrame, details: DataFrame, seconds: int = 5,
               delay: str = "3 seconds", salts: int = 1) -> DataFrame:
    """Order lines with their order, where the two were created at most ``seconds`` apart.

    Batch and streaming. In batch, adaptive execution splits an order with very many lines;
    a streaming join cannot be re-planned, so there ``salts`` > 1 spreads each order's lines
    over that many state partitions. What dimensions have added to either side is kept.
    """
    o = orders.withColumn("o_time", event_time(F.col("create_ts"))).withWatermark("o_time", delay).alias("o")
    d = details.withColumn("d_time", event_time(F.col("create_ts"))).withWatermark("d_time", delay).alias("d")
    near = (
        (F.col("o.id") == F.col("d.order_id"))
        & (F.col("d_time") >= F.col("o_time") - F.expr(f"INTERVAL {seconds} SECONDS"))
        & (F.col("d_time") <= F.col("o_time") + F.expr(f"INTERVAL {seconds} SECONDS"))
    )
    if salts > 1:
        d, o, same = _salted(d, o, F.xxhash64("d.id", "d.sku_id", "d.create_ts"), salts)
        near = near & same
    return _as_wide(
        o.join(d, near),
        {
            "order_id": F.col("o.id"), "detail_id": F.col("d.id"),
            **{name: F.col(f"o.{name}") for name in ORDER_HEADER},
            **{name: F.col(f"d.{name}") for name in DETAIL_LINE},
            **{name: F.col(f"{side}.{name}") for side, rows in (("d", details), ("o", orders)) for name in LOOKED_UP
               if name in rows.columns},
        },
    )


def payment_wide(payments: DataFrame, wide: DataFrame, seconds: int = 1800,
                 delay: str = "3 seconds", salts: int = 1) -> DataFrame:
    """Wide order rows with the payment called back at most ``seconds`` after the order.

    Where both have a column (order, user and **total amount**), the payment's value stands.
    """
    p = payments.withColumn("p_time", text_time(F.col("callback_time"))).withWatermark("p_time", delay).alias("p")
    w = wide.withColumn("w_time", event_time(F.col("create_ts"))).withWatermark("w_time", delay).alias("w")
    paid = (
        (F.col("p.order_id") == F.col("w.order_id"))
        & (F.col("w_time") >= F.col("p_time") - F.expr(f"INTERVAL {seconds} SECONDS"))
        & (F.col("w_time") <= F.col("p_time"))
    )
    if salts > 1:
        w, p, same = _salted(w, p, F.xxhash64("w.detail_id", "w.sku_id"), salts)
        paid = paid & same
    return p.join(w, paid).select(
        F.col("p.id").alias("payment_id"), "p.subject", "p.payment_type",
        F.col("p.create_time").alias("payment_create_time"), "p.callback_time",
        *(F.col(f"p.{name}") for name in FROM_PAYMENT),
        millis_text(F.col("w.create_ts")).alias("order_create_time"),
        *(F.col(f"w.{name}") for name in wide.columns if name not in (*FROM_PAYMENT, *NOT_PAID)),
    )


def merge_wide(rows: DataFrame, others: DataFrame, on: str = "order_id") -> DataFrame:
    """Fill the null columns of partial wide rows from the matching row of ``others``.

    The three split amounts belong to the line itself and are never taken over.
    """
    other = others.select(on, *(F.col(name).alias(f"other_{name}") for name in MERGED if name != on))
    return rows.join(other, on, "left").select(*(
        F.coalesce(F.col(name), F.col(f"other_{name}")).alias(name) if name in MERGED and name != on else F.col(name)
        for name in rows.columns
    ))


# --- dimension lookups ---------------------------------------------------------
def enrich(rows: DataFrame, dim: DataFrame, key: str, columns: Mapping[str, Column | str], dim_key: str = "id") -> DataFrame:
    """Left join a dimension, so that a missing key leaves the row with nulls.

    ``columns`` maps output names to dimension columns. No broadcast is forced: the planner
    broadcasts what it knows to be small and otherwise runs a shuffle join, whose hot keys
    adaptive execution splits.
    """
    side = dim.select(
        F.col(dim_key).cast(rows.schema[key].dataType).alias("dim_key"),
        *(F.col(c).alias(f"dim_{name}") if isinstance(c, str) else c.alias(f"dim_{name}") for name, c in columns.items()),
    )
    kept = [name for name in rows.columns if name not in columns]
    joined = rows.select(*kept).join(side, F.col(key) == F.col("dim_key"), "left")
    return joined.select(*(F.col(f"dim_{n}").alias(n) if n in columns else F.col(n)
                           for n in [*rows.columns, *(n for n in columns if n not in rows.columns)]))


def product_dim(sku: DataFrame, spu: DataFrame, category3: DataFrame, trademark: DataFrame) -> DataFrame:
    """The sku dimension with its spu, category and brand names.

    Joining dimension to dimension first means the fact side is joined, and shuffled, once.
    """
    flat = sku.select(
        "id", "sku_name", F.col("price").cast("decimal(16,2)").alias("sku_price"),
        *(F.col(name).cast("bigint").alias(name) for name in ("spu_id", "category3_id", "tm_id")),
    )
    flat = enrich(flat, spu, "spu_id", {"spu_name": "spu_name"})
    flat = enrich(flat, category3, "category3_id", {"category3_name": "name"})
    return enrich(flat, trademark, "tm_id", {"tm_name": "tm_name"})


PRODUCT_KEYS = ("sku_name", "spu_id", "category3_id", "tm_id", "spu_name", "category3_name", "tm_name")


def with_user(wide: DataFrame, users: DataFrame, as_of: str | Column) -> DataFrame:
    return enrich(wide, users, "user_id",
                  {"user_age": age_years(F.col("birthday"), as_of), "user_gender": "gender"})


def with_province(wide: DataFrame, provinces: DataFrame) -> DataFrame:
    return enrich(wide, provinces, "province_id", {
        "province_name": "name", "province_iso_code": "iso_code",
        "province_area_code": "area_code", "province_3166_2_code": "iso_3166_2",
    })


def with_product(rows: DataFrame, products: DataFrame, price: bool = False) -> DataFrame:
    names = (*PRODUCT_KEYS, "sku_price") if price else PRODUCT_KEYS
    return enrich(rows, products, "sku_id", {name: name for name in names})


def with_dimensions(wide: DataFrame, users: DataFrame, provinces: DataFrame, products: DataFrame,
                    as_of: str | Column | None = None) -> DataFrame:
    """All six lookups of a wide order row; ``products`` comes from :func:`product_dim`."""
    as_of = F.current_date() if as_of is None else as_of
    return with_product(with_province(with_user(wide, users, as_of), provinces), products)


def with_dimensions_ahead(orders: DataFrame, details: DataFrame, users: DataFrame, provinces: DataFrame, products: DataFrame,
                          as_of: str | Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The lookups of :func:`with_dimensions` on orders and lines that are still to be joined by :func:`order_wide`, whose
    rows are then the same. An order is looked up once for all its lines, and no row is shuffled at its full width."""
    as_of = F.current_date() if as_of is None else as_of
    return with_province(with_user(orders, users, as_of), provinces), with_product(details, products)
