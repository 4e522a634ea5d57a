"""Visitor operators: flag repair, daily uniques, bounces and the windowed visitor statistics.

Each is an aggregation that combines on the map side, or a join that adaptive execution can
split, so one visitor who owns a large share of the log never ends up in a single task.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.times import date_text, event_time, window_bounds
from .applog import is_entry, is_start

HOT_RECORDS = 1_000_000  # from here on a visitor's records are spread over several tasks

STAT_KEYS = ("vc", "ch", "ar", "is_new")
STAT_SUMS = ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")


# --- new-visitor flag --------------------------------------------------------
def first_visits(logs: DataFrame) -> DataFrame:
    """Per visitor, the date of the earliest of their ``records`` that claim to be a first visit."""
    return (
        logs.filter(F.col("common.is_new") == "1")
        .groupBy(F.col("common.mid").alias("mid"))
        .agg(F.min("ts").alias("first_ts"), F.count("*").alias("records"))
        .select("mid", date_text(F.col("first_ts")).alias("first_date"), "records")
    )


def repair_flag(rows: DataFrame, visits: DataFrame, hot: int = HOT_RECORDS) -> DataFrame:
    """Clear ``is_new`` on rows from any other date than the visitor's first.

    Works on any rows with ``mid``, ``is_new`` and ``ts``, in one pass. Visitors with ``hot`` or
    more records, of whom there are few, are looked up on their own; the planner, which knows how large
    that side is, sends it to all tasks or splits their rows over several. Their rows, and rows without the flag, which neither read nor set the date, take
    a made-up join key that spreads them over the shuffle. It may hit a visitor by chance, and
    what it finds is not used then.
    """
    busy = visits.filter(F.col("records") >= hot).select(
        F.col("mid").alias("busy_mid"), F.col("first_date").alias("busy_date"))
    dates = visits.filter(F.col("records") < hot).select(F.col("mid").alias("key"), "first_date")
    flagged = F.coalesce(F.col("is_new") == "1", F.lit(False))
    spread = F.xxhash64("ts").cast("string")
    first = F.coalesce("busy_date", "first_date")
    return (
        rows.join(busy, F.col("mid") == F.col("busy_mid"), "left")
        .withColumn("key", F.when(flagged & F.col("busy_mid").isNull(), F.col("mid")).otherwise(spread))
        .join(dates, "key", "left")
        .withColumn("is_new", F.when(flagged & (date_text(F.col("ts")) != first), "0").otherwise(F.col("is_new")))
        .select(*rows.columns)
    )


def repair_new_flag(logs: DataFrame, visits: DataFrame | None = None, hot: int = HOT_RECORDS) -> DataFrame:
    """:func:`repair_flag` on app logs; only records that carry the flag are joined and shuffled.

    ``visits`` replaces the dates found in ``logs`` itself.
    """
    visits = first_visits(logs) if visits is None else visits
    flagged = F.coalesce(F.col("common.is_new") == "1", F.lit(False))
    flat = logs.filter(flagged).withColumns({"mid": F.col("common.mid"), "is_new": F.col("common.is_new")})
    repaired = (
        repair_flag(flat, visits, hot)
        .withColumn("common", F.col("common").withField("is_new", F.col("is_new")))
        .select(*logs.columns)
    )
    return logs.filter(~flagged).unionByName(repaired)


# --- daily unique visitors -----------------------------------------------------
def unique_visitors(pages: DataFrame, order: Sequence[str] = ("ts",)) -> DataFrame:
    """The first session entry of each visitor on each date."""
    return (
        pages.filter(is_entry())
        .groupBy(F.col("common.mid").alias("mid"), date_text(F.col("ts")).alias("date"))
        .agg(F.min_by(F.struct(*pages.columns), F.struct(*order)).alias("first"))
        .select("first.*")
    )


# --- bounces -------------------------------------------------------------------
def bounces(pages: DataFrame, within_ms: int = 1000, order: Sequence[str] = ("ts",),
            delay: str = "0 seconds") -> DataFrame:
    """Session entries with no further record of the same visitor inside ``within_ms``.

    Works on batch and streaming input alike. Time is cut into cells as long as the limit, and
    a window covers one cell plus the next. Any later record of the same cell follows within
    the limit, so only a visitor's last record of a cell can be a bounce, and only the earliest
    record of the next cell can refute it. Both are plain aggregates: rows of a busy visitor
    are combined before the shuffle, and no per-visitor history is ever sorted or held.
    """
    cell = f"{within_ms} milliseconds"
    seen = (
        pages.withColumn("event_time", event_time(F.col("ts")))
        .withWatermark("event_time", delay)
        .withColumn("window", F.window("event_time", f"{2 * within_ms} milliseconds", cell))
    )
    in_first_cell = F.col("ts") < F.unix_millis(F.col("window.start")) + within_ms
    return (
        seen.groupBy("window", F.col("common.mid").alias("mid"))
        .agg(
            F.max_by(
                F.when(is_entry(), F.struct(*pages.columns)),
                F.when(in_first_cell, F.struct(*order)),
            ).alias("last"),
            F.min(F.when(~in_first_cell, F.col("ts"))).alias("next_ts"),
        )
        .filter(F.col("last").isNotNull())
        .filter(F.col("next_ts").isNull() | (F.col("next_ts") - F.col("last.ts") >= within_ms))
        .select("last.*")
    )


# --- visitor metrics -------------------------------------------------------------
def metric_pages(pages: DataFrame, order: Sequence[str] = ("ts",)) -> DataFrame:
    """What the metrics read of page logs, and the order: uniques and bounces keep whole rows in their buffers,
    so what is not read is left out before them."""
    return pages.select(
        F.struct(*(F.col(f"common.{key}").alias(key) for key in ("mid", *STAT_KEYS))).alias("common"),
        F.struct("page.last_page_id", "page.during_time").alias("page"), *order)


def _metric(rows: DataFrame, **counts: Column) -> DataFrame:
    return rows.select(
        F.col("common.mid").alias("mid"),
        *(F.col(f"common.{key}").alias(key) for key in STAT_KEYS),
        *(counts.get(name, F.lit(0)).cast("bigint").alias(name) for name in STAT_SUMS),
        "ts",
    )


def page_view_metrics(pages: DataFrame) -> DataFrame:
    return _metric(
        pages,
        pv_ct=F.lit(1),
        sv_ct=F.when(is_entry(), 1).otherwise(0),
        dur_sum=F.coalesce(F.col("page.during_time"), F.lit(0)),
    )


def unique_visitor_metrics(uniques: DataFrame) -> DataFrame:
    return _metric(uniques, uv_ct=F.lit(1))


def bounce_metrics(jumps: DataFrame) -> DataFrame:
    return _metric(jumps, uj_ct=F.lit(1))


def visitor_metrics(pages: DataFrame, uniques: DataFrame, jumps: DataFrame) -> DataFrame:
    return (
        page_view_metrics(pages)
        .unionByName(unique_visitor_metrics(uniques))
        .unionByName(bounce_metrics(jumps))
    )


# --- all metrics from one pass over the log ----------------------------------------
def _position(seq: str) -> Column:
    """Order by time, then by ``seq``, with whether the record is an entry as the last bit: one number, so that its
    least and greatest are kept in buffers of fixed width, which Spark aggregates by hashing."""
    return (F.col("ts").cast("decimal(20,0)") * F.lit(Decimal(1 << 65))
            + F.coalesce(F.col(seq), F.lit(0)).cast("decimal(20,0)") * 2 + F.when(is_entry(), 1).otherwise(0))


def visitor_cells(logs: DataFrame, window: str, within_ms: int, seq: str = "seq") -> DataFrame:
    """What :func:`cell_metrics` and :func:`cell_visits` need of a log, in one pass over it.

    A row for each visitor, date, window, cell of time as long as the bounce limit, and set of keys: sums, and the first and
    last records. It combines before the shuffle, and a busy visitor is spread over cells. Records without a time are left out.
    """
    page, entry, position = ~is_start(), ~is_start() & is_entry(), _position(seq)
    flat = logs.filter(F.col("ts").isNotNull()).select(
        *(F.col(f"common.{key}").alias(key) for key in ("mid", *STAT_KEYS)),
        "ts", date_text(F.col("ts")).alias("day"), (F.col("ts") - F.pmod("ts", F.lit(within_ms))).alias("cell"),
        F.window(event_time(F.col("ts")), window)["start"].alias("slot"), page.alias("page"), entry.alias("entry"),
        F.coalesce(F.col("page.during_time"), F.lit(0)).alias("dur"), position.alias("position"))
    seen, entered = (lambda value: F.when(F.col("page"), value)), (lambda value: F.when(F.col("entry"), value))
    return flat.groupBy("mid", *STAT_KEYS, "day", "slot", "cell").agg(
        F.min("ts").alias("first_ts"), F.count("*").alias("records"),
        F.count(seen(F.lit(1))).alias("pv_ct"), F.count(entered(F.lit(1))).alias("sv_ct"),
        F.sum(seen(F.col("dur"))).alias("dur_sum"),
        F.min(seen(F.col("ts"))).alias("page_ts"), F.max(seen(F.col("ts"))).alias("last_ts"),
        F.max(seen(F.col("position"))).alias("last"),
        F.min(entered(F.col("ts"))).alias("entry_ts"), F.min(entered(F.col("position"))).alias("first_entry"))


def cell_visits(cells: DataFrame) -> DataFrame:
    """:func:`first_visits` of the log that ``cells`` are of."""
    return (
        cells.filter(F.col("is_new") == "1").groupBy("mid")
        .agg(F.min("first_ts").alias("first_ts"), F.sum("records").alias("records"))
        .select("mid", date_text(F.col("first_ts")).alias("first_date"), "records")
    )


def _cell_metric(rows: DataFrame, ts: str, **counts: Column) -> DataFrame:
    return rows.select("mid", *STAT_KEYS, *(counts.get(name, F.lit(0)).cast("bigint").alias(name) for name in STAT_SUMS),
                       F.col(ts).alias("ts"))


def cell_metrics(cells: DataFrame, within_ms: int) -> DataFrame:
    """:func:`visitor_metrics` of the log that ``cells`` are of, page views summed by cell.

    The first entry of a date is the first of its cells' first entries. A bounce is the last record of its cell, if an
    entry, and no record of the next cell comes within the limit.
    """
    pages = cells.filter(F.col("pv_ct") > 0)
    views = _cell_metric(pages, "page_ts", pv_ct=F.col("pv_ct"), sv_ct=F.col("sv_ct"), dur_sum=F.col("dur_sum"))
    first = (
        cells.filter(F.col("first_entry").isNotNull()).groupBy("mid", "day")
        .agg(F.min_by(F.struct(*STAT_KEYS, "entry_ts"), "first_entry").alias("first"))
    )
    near = pages.withColumn("back", F.explode(F.array(F.lit(0), F.lit(within_ms))))
    own = F.col("back") == 0
    jumps = (
        near.groupBy("mid", (F.col("cell") - F.col("back")).alias("cell"))
        .agg(F.max_by(F.struct(*STAT_KEYS, "last_ts", "last"), F.when(own, F.col("last"))).alias("own"),
             F.min(F.when(~own, F.col("page_ts"))).alias("next_ts"))
        .filter(F.col("own").isNotNull() & (F.pmod(F.col("own.last"), F.lit(2)) == 1))
        .filter(F.col("next_ts").isNull() | (F.col("next_ts") - F.col("own.last_ts") >= within_ms))
    )
    return (
        views
        .unionByName(_cell_metric(first.select("mid", "first.*"), "entry_ts", uv_ct=F.lit(1)))
        .unionByName(_cell_metric(jumps.select("mid", "own.*"), "last_ts", uj_ct=F.lit(1)))
    )


def with_watermark(metrics: DataFrame, delay: str) -> DataFrame:
    """Metrics of one input with an event time and a watermark of its own.

    After a union of such inputs, :func:`visitor_stats` without a delay goes by all their watermarks: by the least of
    them, so that a slow input loses nothing, or by the greatest (``spark.sql.streaming.multipleWatermarkPolicy``).
    """
    return metrics.withColumn("event_time", event_time(F.col("ts"))).withWatermark("event_time", delay)


def visitor_stats(metrics: DataFrame, window: str = "10 seconds", delay: str | None = "3 seconds") -> DataFrame:
    """Metrics summed per tumbling window, version, channel, area and visitor kind. Without ``delay`` the metrics
    have watermarks already."""
    return (
        (metrics if delay is None else with_watermark(metrics, delay))
        .groupBy(F.window("event_time", window), *STAT_KEYS)
        .agg(*(F.sum(name).alias(name) for name in STAT_SUMS))
        .select(*window_bounds(), *STAT_KEYS, *STAT_SUMS)
    )
