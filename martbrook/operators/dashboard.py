"""The dashboard questions, over the result tables.

``day`` is ``yyyymmdd`` (0: today); without it a question covers the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.rates import bounce_rate, pages_per_session, seconds_per_session
from ..functions.times import day_text, hour_label, on_day

# The weight of a keyword by where it came from.
SOURCE_WEIGHTS = {"SEARCH": 10, "ORDER": 5, "CART": 2, "CLICK": 1}

VISITOR_SUMS = ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")


def _on(stats: DataFrame, day: int | None) -> DataFrame:
    """The rows of a day; of a stored table, whose folders are days, only that folder is read."""
    if day is None:
        return stats
    found = stats.filter(on_day(F.col("stt"), day))
    return found.filter(F.col("dt") == day_text(day)) if "dt" in stats.columns else found


def _sum(name: str) -> Column:
    return F.sum(name).alias(name)


# --- sales ---------------------------------------------------------------------
def gmv(product_stats: DataFrame, day: int) -> DataFrame:
    """Total sales of one day; 0 for a day without any."""
    return _on(product_stats, day).agg(F.coalesce(F.sum("order_amount"), F.lit(0)).alias("order_amount"))


def gmv_by_day(product_stats: DataFrame) -> DataFrame:
    """Total sales of every day that has rows."""
    return product_stats.groupBy(F.substring("stt", 1, 10).alias("day")).agg(_sum("order_amount"))


def _top_sales(stats: DataFrame, keys: Sequence[str], n: int, day: int | None, *extra: Column) -> DataFrame:
    return (
        _on(stats, day).groupBy(*keys)
        .agg(_sum("order_amount"), *extra)
        .filter(F.col("order_amount") > 0)
        .orderBy(F.desc("order_amount"), *keys)
        .limit(n)
    )


def gmv_by_brand(product_stats: DataFrame, n: int = 5, day: int | None = None) -> DataFrame:
    return _top_sales(product_stats, ["tm_id", "tm_name"], n, day)


def gmv_by_category(product_stats: DataFrame, n: int = 5, day: int | None = None) -> DataFrame:
    return _top_sales(product_stats, ["category3_id", "category3_name"], n, day)


def gmv_by_spu(product_stats: DataFrame, n: int = 5, day: int | None = None) -> DataFrame:
    return _top_sales(product_stats, ["spu_id", "spu_name"], n, day, _sum("order_ct"))


def amount_by_province(province_stats: DataFrame, day: int | None = None) -> DataFrame:
    return _on(province_stats, day).groupBy("province_id", "province_name").agg(_sum("order_amount"))


# --- visitors --------------------------------------------------------------------
def visitor_totals(visitor_stats: DataFrame, day: int | None = None) -> DataFrame:
    """The five sums for new ('1') and returning ('0') visitors."""
    return _on(visitor_stats, day).groupBy("is_new").agg(*map(_sum, VISITOR_SUMS))


def new_versus_returning(visitor_stats: DataFrame, day: int | None = None) -> DataFrame:
    """Five measures as rows, with a column for returning and one for new visitors."""
    totals = visitor_totals(visitor_stats, day)
    measures = {
        "visitors": F.col("uv_ct"),
        "page_views": F.col("pv_ct"),
        "bounce_rate": bounce_rate(F.col("uj_ct"), F.col("sv_ct")),
        "seconds_per_session": seconds_per_session(F.col("dur_sum"), F.col("sv_ct")),
        "pages_per_session": pages_per_session(F.col("pv_ct"), F.col("sv_ct")),
    }
    rows = totals.select("is_new", F.explode(F.array(*(
        F.struct(F.lit(name).alias("type"), value.cast("decimal(30,2)").alias("value"))
        for name, value in measures.items()
    ))).alias("measure"))

    def of(flag: str) -> Column:
        value = F.max(F.when(F.col("is_new") == flag, F.col("measure.value")))
        return F.coalesce(value, F.lit(0).cast("decimal(30,2)"))

    found = rows.groupBy(F.col("measure.type").alias("type")).agg(of("0").alias("old"), of("1").alias("new"))
    spine = totals.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, measures))).alias("type"))
    zero = F.lit(0).cast("decimal(30,2)")
    return spine.join(found, "type", "left").select(
        "type", F.coalesce("old", zero).alias("old"), F.coalesce("new", zero).alias("new"))


def visitors_by_hour(visitor_stats: DataFrame, day: int | None = None) -> DataFrame:
    """Page views, visitors and new visitors for each of the 24 hours, zero where there were none."""
    hours = visitor_stats.sparkSession.range(24).select(F.col("id").cast("int").alias("hr"))
    sums = ("pv_ct", "uv_ct", "new_uv")
    found = (
        _on(visitor_stats, day).groupBy(F.hour("stt").alias("hr"))
        .agg(_sum("pv_ct"), _sum("uv_ct"),
             F.sum(F.when(F.col("is_new") == "1", F.col("uv_ct")).otherwise(0)).alias("new_uv"))
    )
    return hours.join(found, "hr", "left").select(
        hour_label(F.col("hr")).alias("hr"), *(F.coalesce(name, F.lit(0)).alias(name) for name in sums))


# --- keywords --------------------------------------------------------------------
def keyword_ranking(keyword_stats: DataFrame, n: int = 5, day: int | None = None,
                    descending: bool = False) -> DataFrame:
    """Weighted keyword scores: the first ``n`` by unweighted count, rarest first by default."""
    weight = F.lit(0)
    for source, value in SOURCE_WEIGHTS.items():
        weight = F.when(F.col("source") == source, value).otherwise(weight)
    scored = _on(keyword_stats, day).groupBy("keyword").agg(
        F.sum(F.col("ct") * weight).alias("score"), F.sum("ct").alias("raw"))
    order = F.desc("raw") if descending else F.asc("raw")
    return scored.orderBy(order, "keyword").limit(n).select("keyword", F.col("score").alias("ct"))
