"""Rows behind the watermark: kept beside the statistics they came too late for, and counted."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener, StreamingQueryProgress

from ..functions.times import event_time
from ..operators.visitors import visitor_stats
from ..schemas import VISITOR_STATS
from ..sources.results import append_batch, result_rows
from .runtime import read_if_there

LATE = "late_rows"


def dropped_rows(progress: StreamingQueryProgress) -> int:
    """What a batch's stateful operators dropped as late. An aggregate drops groups: rows that it had put
    together before."""
    return sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)


def dropped_by_batch(query: StreamingQuery) -> dict[int, int]:
    return {p.batchId: dropped_rows(p) for p in query.recentProgress}


class LateCounts(StreamingQueryListener):
    """Adds up what each named query has dropped as late, for as long as the session runs it."""

    def __init__(self) -> None:
        self.dropped: dict[str, int] = defaultdict(int)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.dropped[event.progress.name or str(event.progress.id)] += dropped_rows(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def latest_seen(spark, out: str, batch: int) -> int | None:
    """The latest event time (epoch milliseconds) of all batches up to one; a row for each batch is stored."""
    found = None if batch < 0 else read_if_there(spark, f"{out}/latest/batch={batch}", "ms bigint")
    row = None if found is None else found.first()
    return None if row is None else row["ms"]


def visitor_stats_and_late_rows(metrics: DataFrame, out: str, window: str = "10 seconds", delay: str = "3 seconds") -> DataStreamWriter:
    """Windowed visitor statistics, and the metric rows that belong to windows which were closed before they came.

    Both come from one query, so that they speak of the same batches: its sink gets the closed windows and
    all rows of the batch. Windows that end at or before the watermark are closed by a batch; what comes for
    them in a later one is late. The watermark of a batch is the latest event time of all earlier ones less
    the delay. A batch stores the latest time so far for those after it; a repeated batch writes the same.
    """
    stats = visitor_stats(metrics, window, delay).select(F.struct("*").alias("closed"))
    together = metrics.select(F.struct("*").alias("came")).unionByName(stats, allowMissingColumns=True)

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            append_batch(result_rows(batch.filter("closed IS NOT NULL").select("closed.*"), VISITOR_STATS),
                         f"{out}/visitor_stats", number, day_from="stt")
            came = batch.filter("came IS NOT NULL").select("came.*")
            before = latest_seen(spark, out, number - 2)
            closed = F.lit(before).cast("bigint") - F.unix_millis(F.timestamp_millis(F.lit(0)) + F.expr(f"INTERVAL {delay}"))
            end = F.unix_millis(F.window(event_time(F.col("ts")), window)["end"])
            append_batch(came.filter(end <= closed), f"{out}/{LATE}", number)
            known = F.lit(latest_seen(spark, out, number - 1)).cast("bigint")
            append_batch(came.agg(F.greatest(F.max("ts"), known).alias("ms")), f"{out}/latest", number)
        finally:
            batch.unpersist()

    return together.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", f"{out}/checkpoints/late")


def late_rows(spark, out: str, schema) -> DataFrame:
    """All late rows so far, with the ``batch`` they came in."""
    found = read_if_there(spark, f"{out}/{LATE}", f"{_ddl(schema)}, batch int")
    return spark.createDataFrame([], f"{_ddl(schema)}, batch int") if found is None else found


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
