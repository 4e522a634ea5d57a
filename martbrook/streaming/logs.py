"""App-log jobs: split, unique visitors, bounces, visitor statistics, keyword statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from ..functions.times import date_text
from ..operators.applog import bad_lines, good, outputs
from ..operators.keywords import keyword_stats, keywords, searches
from ..operators.visitors import (
    bounce_metrics, bounces, page_view_metrics, repair_new_flag, unique_visitor_metrics, unique_visitors, visitor_metrics,
    visitor_stats, with_watermark,
)
from ..schemas import KEYWORD_STATS, VISITOR_STATS
from ..sources.results import append_batch, result_rows
from ..sources.topics import folder_sink
from .runtime import adaptive, read_if_there
from .state import DAY_MS, bounces_by_timer, daily_firsts, visits_of_batch

# The names of the topics.
START, PAGE, DISPLAY = "dwd_start_log", "dwd_page_log", "dwd_display_log"
BAD = "bad_log_line"


def topic_folder(out: str, topic: str) -> str:
    """Where :func:`split_job` leaves the records of a topic."""
    return f"{out}/logs/topic={topic}"


def read_topic(spark: SparkSession, out: str, topic: str, schema: T.StructType) -> DataFrame:
    """All records of a topic; none if no batch has had any."""
    found = read_if_there(spark, topic_folder(out, topic), schema)
    return spark.createDataFrame([], schema) if found is None else found.select(*schema.names)


def split_job(logs: DataFrame, out: str) -> DataStreamWriter:
    """Repair the new-visitor flag and write the start, page and exposure logs.

    What must be remembered, each visitor's first visit, is keyed state (:class:`~.state.FirstVisit`), which
    gets one row of each visitor and task. A batch brings its records together with the first visits of its own
    visitors, and they are joined like any tables, a busy visitor's records over several tasks. What a batch reads
    follows its size alone. All outputs are one write, in folders by topic and batch; a repeated batch replaces
    its own. Rows of :func:`~..operators.applog.parsed` go on as records or, where they are none, as their text to
    a topic of bad lines.
    """
    text = "bad" in logs.columns
    records = logs.select(F.struct(*logs.columns).alias("log"))
    visits = visits_of_batch(logs).select(F.struct("mid", date_text(F.col("first_ts")).alias("first_date"), "records").alias("visit"))
    together = records.unionByName(visits, allowMissingColumns=True)

    def write(batch: DataFrame, number: int) -> None:
        with adaptive(batch.sparkSession):
            batch.persist(StorageLevel.MEMORY_AND_DISK)  # the state is gone through once
            try:
                rows, visits = batch.filter("log IS NOT NULL").select("log.*"), batch.filter("visit IS NOT NULL").select("visit.*")
                repaired = repair_new_flag(good(rows) if text else rows, visits)
                found = outputs(repaired, START, PAGE, DISPLAY)
                if text:
                    found = found.unionByName(bad_lines(rows).withColumn("topic", F.lit(BAD)), allowMissingColumns=True)
                found.withColumn("batch", F.lit(number)).write.mode("overwrite").option(
                    "partitionOverwriteMode", "dynamic").partitionBy("topic", "batch").parquet(f"{out}/logs")
            finally:
                batch.unpersist()

    return together.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", f"{out}/checkpoints/split")


UNIQUES = "dwm_unique_visitor"


def known_visitors(spark: SparkSession, out: str, days: Sequence[str], before: int) -> DataFrame | None:
    """Visitors that batches earlier than ``before`` have passed on for these days: ``mid, dt``. Only the
    folders of these days are read."""
    found = read_if_there(spark, f"{out}/{UNIQUES}", "common struct<mid: string>, dt string, batch bigint")
    if found is None:
        return None
    return found.filter(F.col("dt").isin(list(days)) & (F.col("batch") < before)).select("common.mid", "dt")


def unique_visitor_job(pages: DataFrame, out: str, order: Sequence[str] = ("ts",)) -> DataStreamWriter:
    """Streaming daily uniques: a batch passes on its first entry of each visitor on each date that no
    earlier batch has passed on.

    What was passed on is looked up in the output, whose folders are days, so a batch reads the days
    that it has entries for and no clock or watermark decides: entries that come late, by whatever time,
    still count for their day, and a repeated batch gives the same rows. Days are those of the
    session time zone, as in the batch form.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        with adaptive(spark):
            first = unique_visitors(batch, order).withColumn("dt", date_text(F.col("ts"))).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                days = [row["dt"] for row in first.select("dt").distinct().collect()]  # as many as the calendar has
                known = known_visitors(spark, out, days, number)
                if known is not None:
                    known = known.withColumnsRenamed({"mid": "known_mid", "dt": "known_dt"})
                    first = first.join(
                        known, F.col("common.mid").eqNullSafe(F.col("known_mid")) & (F.col("dt") == F.col("known_dt")), "left_anti")
                append_batch(first.drop("dt"), f"{out}/{UNIQUES}", number, date_text(F.col("ts")))
            finally:
                first.unpersist()

    return pages.writeStream.foreachBatch(write).option("checkpointLocation", f"{out}/checkpoints/unique_visitor")


def daily_unique_job(pages: DataFrame, out: str, order: Sequence[str] = ("ts",), ttl_ms: int = DAY_MS) -> DataStreamWriter:
    """Streaming daily uniques from keyed state: a batch costs what its visitors cost, and a visitor's day is
    forgotten ``ttl_ms`` after it was written. :func:`unique_visitor_job` forgets nothing."""

    def write(batch: DataFrame, number: int) -> None:
        append_batch(batch.drop("dt"), f"{out}/{UNIQUES}", number, date_text(F.col("ts")))

    return (
        daily_firsts(pages, order, ttl_ms).writeStream.outputMode("append").foreachBatch(write)
        .option("checkpointLocation", f"{out}/checkpoints/daily_unique")
    )


def bounce_timer_job(pages: DataFrame, out: str, within_ms: int = 1000, order: Sequence[str] = ("ts",),
                     delay: str = "0 seconds") -> DataStreamWriter:
    """Bounces when they are decided, from keyed state and timers; :func:`bounce_job` needs no state of its
    own but waits for its windows to close."""
    return folder_sink(bounces_by_timer(pages, within_ms, order, delay), f"{out}/dwm_user_jump_detail",
                       f"{out}/checkpoints/user_jump_timer")


def bounce_job(pages: DataFrame, out: str, within_ms: int = 1000, order: Sequence[str] = ("ts",),
               delay: str = "0 seconds") -> DataStreamWriter:
    return folder_sink(bounces(pages, within_ms, order, delay), f"{out}/dwm_user_jump_detail",
                       f"{out}/checkpoints/user_jump")


def _stats_job(stats: DataFrame, columns: Sequence[str], out: str, name: str) -> DataStreamWriter:
    return (
        stats.writeStream.outputMode("append")
        .foreachBatch(lambda batch, number: append_batch(
            result_rows(batch, columns), f"{out}/{name}", number, day_from="stt"))
        .option("checkpointLocation", f"{out}/checkpoints/{name}")
    )


def visitor_stats_job(pages: DataFrame, uniques: DataFrame, jumps: DataFrame, out: str,
                      window: str = "10 seconds", delay: str = "3 seconds", per_input: bool = False) -> DataStreamWriter:
    """``per_input`` gives each input a watermark of its own instead of one to all; see
    :func:`~..operators.visitors.with_watermark`."""
    if per_input:
        parts = (page_view_metrics(pages), unique_visitor_metrics(uniques), bounce_metrics(jumps))
        first, *rest = (with_watermark(part, delay) for part in parts)
        for part in rest:
            first = first.unionByName(part)
        return _stats_job(visitor_stats(first, window, None), VISITOR_STATS, out, "visitor_stats")
    stats = visitor_stats(visitor_metrics(pages, uniques, jumps), window, delay)
    return _stats_job(stats, VISITOR_STATS, out, "visitor_stats")


def keyword_stats_job(pages: DataFrame, out: str, window: str = "10 seconds", delay: str = "3 seconds",
                      dictionary: Sequence[str] | None = None) -> DataStreamWriter:
    stats = keyword_stats(keywords(searches(pages), dictionary), window, delay)
    return _stats_job(stats, KEYWORD_STATS, out, "keyword_stats")
