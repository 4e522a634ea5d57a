"""App logs: parsing, the start/page split and the exposure rows."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..schemas import APP_LOG


class SplitLogs(NamedTuple):
    start: DataFrame
    page: DataFrame
    display: DataFrame


def parsed(raw: DataFrame, schema: T.StructType = APP_LOG, column: str = "value") -> DataFrame:
    """JSON text as records of ``schema``, the other columns of ``raw``, and ``bad``: the text, where it is no
    whole record.

    That is text which is not JSON, blank or null, no object, or has a field of another type. A field that is
    missing is null; what follows a whole object is not looked at. The generator parses each text once; as a projection, later filters would repeat the parsing.
    """
    rest = [F.col(f"`{name}`") for name in raw.columns if name != column]
    corrupt = T.StructType([*schema, T.StructField("__corrupt", T.StringType())])
    record = F.from_json(F.col(f"`{column}`"), corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__corrupt"})
    text = F.coalesce(F.col(f"`{column}`"), F.lit(""))
    rows = raw.select(*rest, F.inline(F.array(F.struct(text.alias("__text"), record.alias("__record")))))
    whole = F.startswith(F.ltrim("__text"), F.lit("{")) & F.col("__record").isNotNull() & F.col("__record.__corrupt").isNull()
    return rows.select(*rest, *(F.col(f"__record.`{f.name}`").alias(f.name) for f in schema), F.when(~whole, F.col("__text")).alias("bad"))


def good(rows: DataFrame) -> DataFrame:
    """The records among rows of :func:`parsed`."""
    return rows.filter(F.col("bad").isNull()).drop("bad")


def bad_lines(rows: DataFrame) -> DataFrame:
    """The text of what is none among rows of :func:`parsed`, as ``value``."""
    return rows.filter(F.col("bad").isNotNull()).select(F.col("bad").alias("value"))


def parse_logs(raw: DataFrame, column: str = "value") -> DataFrame:
    """JSON text to app-log records; lines that are none are left out (:func:`parsed` has them)."""
    return good(parsed(raw.select(F.col(f"`{column}`")), APP_LOG, column))


def is_start() -> Column:
    return F.coalesce(F.size("start") > 0, F.lit(False))


def is_entry() -> Column:
    """The first page of a session: no page before it."""
    return F.coalesce(F.col("page.last_page_id"), F.lit("")) == ""


def with_route(logs: DataFrame) -> DataFrame:
    return logs.withColumn("route", F.when(is_start(), "start").otherwise("page"))


def start_logs(logs: DataFrame) -> DataFrame:
    return logs.filter(is_start())


def page_logs(logs: DataFrame) -> DataFrame:
    return logs.filter(~is_start())


def display_logs(pages: DataFrame) -> DataFrame:
    """One row per shown element, stamped with the time and page it was shown on."""
    return (
        pages.select("ts", F.col("page.page_id").alias("page_id"), F.explode("displays").alias("shown"))
        .filter(F.col("shown").isNotNull())
        .select("shown.*", "ts", "page_id")
    )


def split_logs(logs: DataFrame) -> SplitLogs:
    pages = page_logs(logs)
    return SplitLogs(start_logs(logs), pages, display_logs(pages))


def outputs(logs: DataFrame, start: str, page: str, display: str) -> DataFrame:
    """All records of :func:`split_logs` in one table, in one pass: ``topic`` (as named), the columns of the
    logs, and those of a shown element (``item``, ``item_type``, ``page_id``); what a topic has not is null."""
    shown = F.transform(F.filter("displays", lambda d: d.isNotNull()), lambda d: F.struct(F.lit(display).alias("topic"), d.alias("shown")))
    none = F.lit(None).cast(logs.schema["displays"].dataType.elementType)
    own = lambda topic: F.array(F.struct(F.lit(topic).alias("topic"), none.alias("shown")))
    each = F.when(is_start(), own(start)).when(F.col("displays").isNull(), own(page)).otherwise(F.concat(own(page), shown))
    rows = logs.select("*", F.inline(each))
    whole = F.col("topic") != display
    return rows.select(
        "topic", *(F.col(name) if name == "ts" else F.when(whole, F.col(name)).alias(name) for name in logs.columns),
        "shown.*", F.when(~whole, F.col("page.page_id")).alias("page_id"))
