"""Time conversions. Everything uses the session time zone; there is no hidden offset."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

TIME_TEXT = "yyyy-MM-dd HH:mm:ss"


def event_time(millis: Column) -> Column:
    """Epoch milliseconds as a timestamp."""
    return F.timestamp_millis(millis)


def event_time_seconds(millis: Column) -> Column:
    """Epoch milliseconds as a timestamp cut to whole seconds."""
    return F.date_trunc("second", F.timestamp_millis(millis))


def date_text(millis: Column) -> Column:
    return F.date_format(F.timestamp_millis(millis), "yyyy-MM-dd")


def time_text(when: Column) -> Column:
    return F.date_format(when, TIME_TEXT)


def millis_text(millis: Column) -> Column:
    return time_text(F.timestamp_millis(millis))


def text_time(text: Column) -> Column:
    return F.to_timestamp(text, TIME_TEXT)


def text_millis(text: Column) -> Column:
    return F.unix_millis(text_time(text))


def window_bounds(window: str = "window") -> list[Column]:
    """Start and end of a window as text, named ``stt`` and ``edt``."""
    return [time_text(F.col(f"{window}.start")).alias("stt"), time_text(F.col(f"{window}.end")).alias("edt")]


def processing_millis() -> Column:
    return F.unix_millis(F.current_timestamp())


def day_text(day: int, later: int = 0) -> Column:
    """``yyyymmdd`` as ``yyyy-MM-dd``, or some days later; 0 means today in the session time zone."""
    if day == 0:
        return F.date_format(F.date_add(F.current_date(), later), "yyyy-MM-dd")
    return F.lit(str(dt.datetime.strptime(str(day), "%Y%m%d").date() + dt.timedelta(days=later)))


def on_day(column: Column, day: int) -> Column:
    """Whether a ``yyyy-MM-dd HH:mm:ss`` text falls on ``day`` (``yyyymmdd``; 0 means today).

    A plain range on the stored text, so that it reaches the scan and prunes row groups.
    """
    midnight = F.lit(" 00:00:00")
    return (column >= F.concat(day_text(day), midnight)) & (column < F.concat(day_text(day, 1), midnight))


def age_years(birthday: Column, as_of: str | Column) -> Column:
    """Whole years of 365 days between a ``yyyy-MM-dd`` birthday and ``as_of``."""
    end = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    return F.floor(F.datediff(end, F.to_date(birthday)) / 365).cast("int")


def hour_label(hour: Column) -> Column:
    return F.lpad(hour.cast("string"), 2, "0")
