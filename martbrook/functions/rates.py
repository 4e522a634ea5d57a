"""Session ratios of the visitor dashboard: decimal, rounded half up, zero without sessions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

WHOLE = "decimal(20,0)"


def _per_session(amount: Column, sessions: Column, scale: int) -> Column:
    ratio = F.round(amount.cast(WHOLE) / F.nullif(sessions, F.lit(0)).cast(WHOLE), scale)
    return F.coalesce(ratio, F.lit(0))


def bounce_rate(bounces: Column, sessions: Column) -> Column:
    return _per_session(bounces * 100, sessions, 2)


def seconds_per_session(millis: Column, sessions: Column) -> Column:
    """Rounded to whole milliseconds first, then to tenths of a second."""
    return F.round(_per_session(millis, sessions, 0) / 1000, 1)


def pages_per_session(pages: Column, sessions: Column) -> Column:
    return _per_session(pages, sessions, 2)
