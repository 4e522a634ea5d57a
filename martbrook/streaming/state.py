"""Keyed state of the visitor jobs: first visits, daily uniques that expire, and bounces by timer.

A busy visitor's rows would all meet in the task that owns their key. So every job first reduces what a task
has read, an Arrow batch at a time, to what the state needs of it: a row for each visitor (and day), or,
for bounces, the few records that can still decide one. Only these are shuffled. State is in RocksDB, so it may
outgrow memory, and a batch reads and writes the keys that it has rows of, however many there are.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.times import date_text, event_time
from ..operators.applog import is_entry

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have this package

DAY_MS = 86_400_000


def as_payload(rows: DataFrame) -> Column:
    """Whole rows as text, which passes through state as it is."""
    return F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})


def from_payload(found: DataFrame, schema: T.StructType, *keep: str) -> DataFrame:
    """The rows of a text column ``payload``, parsed once."""
    return found.select(*keep, F.inline(F.array(F.from_json("payload", schema))))


def reduced(rows: DataFrame, schema: T.StructType, reduce: Callable[[list[tuple]], list[tuple]]) -> DataFrame:
    """What ``reduce`` makes of the rows of each Arrow batch, before any shuffle."""
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = reduce(list(zip(*(column.to_pylist() for column in batch.columns))))
            if kept:
                yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*kept))))

    return rows.mapInArrow(run, schema)


def _fields(rows: DataFrame, order: Sequence[str]) -> list[T.StructField]:
    """The columns that order a visitor's records after ``ts``."""
    return [T.StructField(f"o{k}", rows.schema[name].dataType) for k, name in enumerate(order)]


# --- first visits -------------------------------------------------------------------
class FirstVisit(StatefulProcessor):
    """Remembers, for good, the time of the first visit that was claimed: the earliest of the batch that came
    first. Says so again for each batch with such a claim."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first", "ts bigint")

    def handleInputRows(self, key, rows, timerValues):
        found, records = None, 0
        for row in rows:
            found = row.ts if found is None else min(found, row.ts)
            records += row.records
        known = self.first.get()
        if known is None:
            self.first.update((found,))
        else:
            found = known[0]
        yield Row(mid=key[0], first_ts=found, records=records)

    def close(self) -> None:
        pass


def _least_by_visitor(rows: list[tuple]) -> list[tuple]:
    least: dict = {}
    for mid, ts in rows:
        known = least.get(mid)
        least[mid] = (ts, 1) if known is None else (min(known[0], ts), known[1] + 1)
    return [(mid, ts, n) for mid, (ts, n) in least.items()]


def visits_of_batch(logs: DataFrame) -> DataFrame:
    """As a stream: ``mid, first_ts, records`` of the visitors of each batch that claim a first visit, where
    ``records`` counts the batch's claims."""
    claims = logs.filter((F.col("common.is_new") == "1") & F.col("common.mid").isNotNull() & F.col("ts").isNotNull())
    schema = T.StructType.fromDDL("mid string, ts bigint, records bigint")
    few = reduced(claims.select(F.col("common.mid").alias("mid"), "ts"), schema, _least_by_visitor)
    return few.groupBy("mid").transformWithState(FirstVisit(), "mid string, first_ts bigint, records bigint", "Append", "None")


# --- daily uniques --------------------------------------------------------------------
class SeenToday(StatefulProcessor):
    """Passes on the first row of a key and remembers the key for a while; what has expired counts as unseen."""

    def __init__(self, ttl_ms: int, n_order: int):
        self.ttl_ms, self.n_order = ttl_ms, n_order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "yes boolean", ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        first = min(rows, key=lambda row: tuple(row[f"o{k}"] for k in range(self.n_order)))
        if not self.seen.exists():
            self.seen.update((True,))
            yield Row(dt=key[1], payload=first.payload)

    def close(self) -> None:
        pass


def _first_of_day(rows: list[tuple]) -> list[tuple]:
    first: dict = {}
    for row in rows:
        known = first.get(row[:2])
        if known is None or row[2:-1] < known[2:-1]:
            first[row[:2]] = row
    return list(first.values())


def daily_firsts(pages: DataFrame, order: Sequence[str] = ("ts",), ttl_ms: int = DAY_MS) -> DataFrame:
    """As a stream: the first session entry of each visitor on each date, with ``dt``.

    A visitor's day is remembered for ``ttl_ms`` of processing time after it was written. An entry that comes
    later than that, for the same day, is passed on again."""
    fields = _fields(pages, order)
    schema = T.StructType([T.StructField("mid", T.StringType()), T.StructField("dt", T.StringType()), *fields,
                           T.StructField("payload", T.StringType())])
    entries = pages.filter(is_entry()).select(
        F.col("common.mid").alias("mid"), date_text(F.col("ts")).alias("dt"),
        *(F.col(name).alias(f.name) for name, f in zip(order, fields)), as_payload(pages).alias("payload"))
    found = reduced(entries, schema, _first_of_day).groupBy("mid", "dt").transformWithState(
        SeenToday(ttl_ms, len(fields)), "dt string, payload string", "Append", "ProcessingTime")
    return from_payload(found, pages.schema, "dt")


# --- bounces ----------------------------------------------------------------------------
def thinned(records: list[tuple], within_ms: int) -> list[tuple]:
    """A visitor's records (ts, order..., payload), sorted, without what can't matter any more.

    An entry (a record with a payload) that has a record behind it within the limit is none. A record
    between two that are less than the limit apart is not needed: whatever entry comes to stand before it has
    the later of the two within the limit. So about two records are left for each length of the limit.
    """
    out: list[tuple] = []
    for k, record in enumerate(records):
        if record[-1] is not None and k + 1 < len(records) and records[k + 1][0] - record[0] < within_ms:
            record = (*record[:-1], None)
        while len(out) > 1 and out[-1][-1] is None and record[0] - out[-2][0] < within_ms:
            out.pop()
        out.append(record)
    return out


def _place(record: tuple) -> tuple:
    return record[:-1]


class Bounce(StatefulProcessor):
    """Holds the records that may still decide about an entry, and a timer for when the first of them is
    decided: when the watermark has passed the last moment that counts."""

    def __init__(self, within_ms: int, state: str):
        self.within_ms, self.state = within_ms, state

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.records = handle.getListState("records", self.state)

    def _settle(self, records: list[tuple], timers) -> Iterator[Row]:
        # Records to come are later than the watermark.
        over = timers.getCurrentWatermarkInMs() + 1 - self.within_ms
        records = thinned(records, self.within_ms)
        ready = [r for r in records if r[0] <= over]
        left = records[len(ready):]
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if left:
            self.records.put(left)
            self.handle.registerTimer(left[0][0] + self.within_ms - 1)
        elif self.records.exists():
            self.records.clear()
        return (Row(payload=r[-1]) for r in ready if r[-1] is not None)

    def handleInputRows(self, key, rows, timerValues):
        records = [tuple(r) for r in self.records.get()]
        records += [(row.ts, *(row[k] for k in range(2, len(row) - 2)), row.payload) for row in rows]
        yield from self._settle(sorted(records, key=_place), timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._settle([tuple(r) for r in self.records.get()], timerValues)

    def close(self) -> None:
        pass


def bounces_by_timer(pages: DataFrame, within_ms: int = 1000, order: Sequence[str] = ("ts",), delay: str = "0 seconds") -> DataFrame:
    """As a stream: session entries with no further record of the same visitor within the limit, as soon as
    the watermark says that none can come.

    Records may come in any order within ``delay``; a record as late as the latest so far minus ``delay`` still
    counts, earlier ones are dropped."""
    fields = _fields(pages, order)
    text = T.StructField("payload", T.StringType())
    state = T.StructType([T.StructField("ts", T.LongType()), *fields, text])
    schema = T.StructType([T.StructField("mid", T.StringType()), *state.fields])

    def reduce(rows: list[tuple]) -> list[tuple]:
        visitors: dict = {}
        for row in rows:
            visitors.setdefault(row[0], []).append(row[1:])
        return [(mid, *r) for mid, found in visitors.items() for r in thinned(sorted(found, key=_place), within_ms)]

    records = pages.filter(F.col("ts").isNotNull()).select(
        F.col("common.mid").alias("mid"), "ts", *(F.col(name).alias(f.name) for name, f in zip(order, fields)),
        F.when(is_entry(), as_payload(pages)).alias("payload"))
    # Spark drops what is at the watermark too: a millisecond more, and the latest moment still counts.
    few = reduced(records, schema, reduce).withColumn("event_time", event_time(F.col("ts"))).withWatermark(
        "event_time", f"{delay} 1 milliseconds")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in state.fields)
    found = few.groupBy("mid").transformWithState(Bounce(within_ms, ddl), "payload string", "Append", "EventTime")
    return from_payload(found, pages.schema)
