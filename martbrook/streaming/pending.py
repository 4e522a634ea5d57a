"""Joins within time bounds, and windows, whose state is files.

A batch joins or aggregates its own rows as tables and stores only those that a later batch may still need: rows whose
bounds, or whose window, the watermark has not passed. The watermark of a batch is what the batches before it have seen,
less the delay; rows at or behind it are late and left out, as Spark's own operators leave them out. What a batch stores
has its number, so a repeated batch replaces it, and goes when no later one needs it.

Rows that arrive are first dealt to ``SLICES`` folders, by the key of a join or by window. A large batch goes through
them in several passes, so that only a part of it is shuffled at a time; nothing is read twice for that.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.times import event_time
from .runtime import held, read_if_there

SLICES = 8  # a power of two
PASS_ROWS = 16_000_000  # rows of a batch that one pass may take, as far as there are slices
MARKS = "latest array<bigint>, live array<struct<batch:int,until:bigint>>"
AT, UNTIL, SIDE, SLICE = "pending_at", "pending_until", "pending_side", "pending_slice"


class Marks(NamedTuple):
    """After a batch: the latest time of each input, and the batches whose stored rows are needed, each until when."""

    latest: list[int | None]
    live: list[tuple[int, int]]


class Input(NamedTuple):
    rows: DataFrame
    key: str
    time: Column  # epoch milliseconds
    reach: int  # milliseconds: rows of the other input that a row may meet come so much later at most


def interval_ms(spark: SparkSession, interval: str) -> int:
    return spark.range(1).select(F.unix_millis(F.timestamp_millis(F.lit(0)) + F.expr(f"INTERVAL {interval}"))).first()[0]


def watermark(spark: SparkSession, latest: Iterable[int | None], late: int) -> int:
    """That of the slowest input, or by the session's policy of the fastest; 0 for an input without rows so far."""
    choose = max if spark.conf.get("spark.sql.streaming.multipleWatermarkPolicy") == "max" else min
    return max(0, choose(0 if ms is None else ms - late for ms in latest))


def _slice(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SLICES)).cast("int").alias(SLICE)


def _shared(rows: DataFrame) -> dict[str, str]:
    """A name for each column that is the same for the n-th column of its type in any table."""
    names, count = {}, Counter()
    for field in rows.schema:
        kind = re.sub(r"\W+", "_", field.dataType.simpleString())
        names[field.name] = f"{kind}_{count[kind]}"
        count[kind] += 1
    return names


def side_by_side(left: Input, right: Input) -> DataFrame:
    """Both inputs of a join as one stream; columns of a type are shared, so that a row is no wider than it need be."""
    each = [side.rows.select(*(F.col(f"`{c}`").alias(name) for c, name in _shared(side.rows).items()), side.time.alias(AT),
                             F.lit(n).alias(SIDE), _slice(F.col(side.key))) for n, side in enumerate((left, right))]
    return each[0].unionByName(each[1], allowMissingColumns=True)


def in_windows(rows: DataFrame, time: str, window: str) -> DataFrame:
    """A stream with the end of each row's tumbling window; rows without a time are in none."""
    return rows.withColumn("window", F.window(event_time(F.col(time)), window)).select(
        *rows.columns, F.unix_millis("window.end").alias(UNTIL), F.lit(0).alias(SIDE), _slice(F.col("window.end")))


class Batch:
    """One batch of rows with a time ``at``, a ``SIDE``, one of so many ``sides``, and a ``SLICE``; ``until`` when each is needed."""

    def __init__(self, rows: DataFrame, number: int, folder: str, delay: str, at: str, until: Column, sides: int = 1) -> None:
        self.spark, self.number, self.folder, self.schema = rows.sparkSession, number, folder, rows.schema
        self.sides, self.needed = sides, until
        self.arrived = f"{folder}/arrived"  # only while the batch lasts
        with held(self.spark, **{"spark.sql.maxConcurrentOutputFileWriters": str(2 * SLICES)}):  # else rows are sorted first
            rows.write.mode("overwrite").option("compression", "zstd").partitionBy(SIDE, SLICE).parquet(self.arrived)
        self.before, late = self._marks(number - 1), interval_ms(self.spark, delay)
        seen = self._read(self.arrived).agg(
            F.count("*"), F.max(until), *(F.max(F.when(F.col(SIDE) == side, F.col(at))) for side in range(sides))).first()
        self.rows, self.until = seen[:2]
        self.latest = [max((ms for ms in pair if ms is not None), default=None) for pair in zip(self.before.latest, seen[2:])]
        self.opened, self.closed = watermark(self.spark, self.before.latest, late), watermark(self.spark, self.latest, late)
        self.in_time = (F.col(at) if sides > 1 else until) > self.opened
        self.keep()

    def _read(self, *folders: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*folders) if len(folders) == 1 else self.spark.read.schema(
            T.StructType([*self.schema, T.StructField("batch", T.IntegerType())])).option(
            "basePath", f"{self.folder}/rows").parquet(*folders).drop("batch")

    def _marks(self, number: int) -> Marks:
        found = None if number < 0 else read_if_there(self.spark, f"{self.folder}/marks/batch={number}", MARKS)
        row = None if found is None else found.first()
        return Marks([None] * self.sides, []) if row is None else Marks(row["latest"], [tuple(x) for x in row["live"]])

    def new(self) -> DataFrame:
        """What has come in time."""
        return self._read(self.arrived).filter(self.in_time)

    def old(self) -> DataFrame | None:
        """What earlier batches have left."""
        if not self.before.live:
            return None
        return self._read(*(f"{self.folder}/rows/batch={n}" for n, _ in self.before.live)).filter(self.needed > self.opened)

    def passes(self) -> Iterator[tuple[str, Column]]:
        """For each pass, what tells its output from that of others and of other batches, and which rows are its own."""
        count = 1
        while count < SLICES and count * PASS_ROWS < self.rows:
            count *= 2
        for n in range(count):
            yield f"{self.number}_{n}" if n else str(self.number), F.col(SLICE) % count == n
            for side, place in itertools.product(range(self.sides), range(n, SLICES, count) if count > 1 else ()):
                self._empty(f"{self.arrived}/{SIDE}={side}/{SLICE}={place}")  # makes room for what the others shuffle

    def keep(self) -> None:
        """Store what later batches need."""
        if self.until is not None and self.until > self.closed:
            self.new().filter(self.needed > self.closed).write.mode("overwrite").parquet(f"{self.folder}/rows/batch={self.number}")

    def finish(self) -> None:
        ends = [*self.before.live, *([] if self.until is None else [(self.number, self.until)])]
        live = [(batch, end) for batch, end in ends if end > self.closed]
        self.spark.createDataFrame([(self.latest, live)], MARKS).coalesce(1).write.mode("overwrite").parquet(
            f"{self.folder}/marks/batch={self.number}")
        self._empty(self.arrived)
        for batch, _ in self._marks(self.number - 2).live:
            if batch not in {n for n, _ in self.before.live}:  # a repetition of this batch would not read it either
                self._empty(f"{self.folder}/rows/batch={batch}")

    def _empty(self, folder: str) -> None:
        schema = T.StructType([field for field in self.schema if field.name not in (SIDE, SLICE)])
        self.spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(folder)


def join_batch(rows: DataFrame, number: int, folder: str, delay: str, left: Input, right: Input,
               write: Callable[[list[tuple[DataFrame, DataFrame]], str], None]) -> None:
    """``write`` gets pairs of tables, once for each pass; what meets within a pair is all that the batch adds to the join."""
    until = F.col(AT) + F.when(F.col(SIDE) == 0, left.reach).otherwise(right.reach)
    batch = Batch(rows, number, folder, delay, AT, until, 2)
    side = lambda some, n: some.filter(F.col(SIDE) == n).select(*(
        F.col(name).alias(c) for c, name in _shared((left, right)[n].rows).items()))
    for part, own in batch.passes():
        new, old = batch.new().filter(own), batch.old()
        pairs = [(side(new, 0), side(new, 1))]
        if old is not None:
            pairs += [(side(new, 0), side(old.filter(own), 1)), (side(old.filter(own), 0), side(new, 1))]
        write(pairs, part)
    batch.finish()


def close_windows(rows: DataFrame, number: int, folder: str, delay: str, time: str, write: Callable[[DataFrame, str], None]) -> None:
    """``write`` gets all rows of the windows that the watermark passes with this batch, each window whole and in one pass."""
    batch = Batch(rows, number, folder, delay, time, F.col(UNTIL))
    for part, own in batch.passes():
        new, old = batch.new(), batch.old()
        closing = (new if old is None else new.unionByName(old)).filter(own & (F.col(UNTIL) <= batch.closed))
        write(closing.drop(UNTIL, SIDE, SLICE), part)
    batch.finish()
