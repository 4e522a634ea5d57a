"""Tests of membership by a bitmap of fixed size: a cheap first look before a join."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .texts import ship_package

#: Bits of the bitmap (1 MB). With more ids it fills up and tells less; it never says no wrongly.
BITS = 1 << 23


def _place(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BITS))


def _bitmap(keys: DataFrame, column: str):
    """The bitmap of a column's values, on its way to the tasks."""
    place = _place(F.col(column)) + 1
    parts = keys.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    bits = np.zeros(BITS, dtype=bool)
    for row in parts.collect():  # BITS / 32768 rows of 4 kB at most
        part = np.unpackbits(np.frombuffer(row["bits"], dtype=np.uint8), bitorder="little")
        bits[(row["bucket"] - 1) * len(part):row["bucket"] * len(part)] = part
    spark = keys.sparkSession
    ship_package(spark)
    return spark.sparkContext.broadcast(np.packbits(bits))


def place_test(keys: DataFrame, column: str) -> tuple[Callable[[Column], Column], Callable[[], Callable[[np.ndarray], np.ndarray]]]:
    """For rows that go to Python anyway: the column with a value's place, and what a task makes once to tell
    by the places which rows to keep, all values of a column of ``keys`` and few others. A condition in front of them
    would take each task another Python worker."""
    shared = _bitmap(keys, column)

    def make():
        known = np.unpackbits(shared.value).astype(bool)
        return lambda places: known[places]

    return _place, make


def may_contain(keys: DataFrame, column: str):
    """A condition that holds for all values of a column of ``keys``, and for few others."""
    shared = _bitmap(keys, column)

    @F.pandas_udf(T.BooleanType())
    def test(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = np.unpackbits(shared.value).astype(bool)
        for places in batches:
            yield pd.Series(known[places.to_numpy()])

    return lambda key: test(_place(key))
