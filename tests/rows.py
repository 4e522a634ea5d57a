"""Small inputs for hand-worked cases."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

from martbrook import schemas

LOGS = T.StructType([*schemas.APP_LOG, T.StructField("seq", T.LongType())])


def ms(text: str) -> int:
    """``2024-01-01 09:00:00[.mmm]`` as epoch milliseconds, UTC."""
    moment = dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)
    return round(moment.timestamp() * 1000)


def log(mid, ts, last=None, page="home", is_new="1", item=None, during=0, start=None, displays=None, seq=0, vc="v1"):
    ts = ms(ts) if isinstance(ts, str) else ts
    return ((mid, vc, "ch1", "ar1", is_new), (page, last, item, during), start, displays, ts, seq)


def logs(spark, *rows):
    return spark.createDataFrame(list(rows), LOGS)


def table(spark, schema, *rows):
    """Rows given as dicts; missing columns are null."""
    return spark.createDataFrame([tuple(row.get(n) for n in schema.names) for row in rows], schema)


def values(frame, *columns):
    return sorted((tuple(row) for row in frame.select(*columns).collect()), key=str)
