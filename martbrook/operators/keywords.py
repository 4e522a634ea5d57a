"""Search keywords: filter, tokenise, count per window."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.times import event_time_seconds, window_bounds
from ..functions.tokens import register_keyword_function, tokens

SOURCE = "SEARCH"  # fixed value: how search keywords are marked in the result table


def searches(pages: DataFrame) -> DataFrame:
    """Texts entered on the product list page."""
    return pages.filter(
        (F.col("page.page_id") == "good_list") & F.col("page.item").isNotNull()
    ).select(F.col("page.item").alias("fullword"), event_time_seconds(F.col("ts")).alias("order_time"))


def keywords(texts: DataFrame, dictionary: Iterable[str] | None = None) -> DataFrame:
    """One row per keyword; a text without any disappears."""
    return texts.select(F.explode(tokens(F.col("fullword"), dictionary)).alias("keyword"), "order_time")


def keyword_stats(words: DataFrame, window: str = "10 seconds", delay: str = "3 seconds") -> DataFrame:
    return (
        words.withWatermark("order_time", delay)
        .groupBy(F.window("order_time", window), "keyword")
        .agg(F.count("*").alias("ct"))
        .select(*window_bounds(), "keyword", "ct", F.lit(SOURCE).alias("source"))
    )


def keyword_stats_sql(spark: SparkSession, pages: DataFrame, window: str = "10 seconds",
                      delay: str = "3 seconds", dictionary: Iterable[str] | None = None) -> DataFrame:
    """The same job as chained SQL over a view, batch or streaming."""
    register_keyword_function(spark, dictionary=dictionary)
    pages.select(
        F.struct(F.col("page.page_id"), F.col("page.item")).alias("page"),
        event_time_seconds(F.col("ts")).alias("order_time"),
    ).withWatermark("order_time", delay).createOrReplaceTempView("page_view")
    spark.sql("""
        SELECT page.item AS fullword, order_time FROM page_view
        WHERE page.page_id = 'good_list' AND page.item IS NOT NULL
    """).createOrReplaceTempView("search_text")
    spark.sql("""
        SELECT t.keyword, order_time FROM search_text, LATERAL ik_analyze(fullword) AS t(keyword)
    """).createOrReplaceTempView("search_keyword")
    return spark.sql(f"""
        SELECT date_format(window.start, 'yyyy-MM-dd HH:mm:ss') AS stt,
               date_format(window.end, 'yyyy-MM-dd HH:mm:ss') AS edt,
               keyword, count(*) AS ct, '{SOURCE}' AS source
        FROM search_keyword GROUP BY window(order_time, '{window}'), keyword
    """)
