"""Database change events: flattening, cleaning, routing by configuration, dimension upserts."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schemas import CHANGE, CHANGE_ENVELOPE
from .applog import good, parsed

TO_TOPIC, TO_DIMENSION = "kafka", "hbase"  # fixed values: sink types in the routing configuration


class Routed(NamedTuple):
    facts: DataFrame
    dims: DataFrame
    unrouted: DataFrame


def flatten_envelopes(raw: DataFrame, column: str = "value", deletes: bool = False) -> DataFrame:
    """Capture envelopes to ``database, table, type, data``; a delete has empty data, unless
    ``deletes`` asks for the row as it was before.

    Columns of ``raw`` other than the text (an offset, a time) are kept. Text that is no envelope
    is left out; :func:`~.applog.parsed` with that schema has it.
    """
    after = F.when(op_is_delete(), F.col("before")).otherwise(F.col("after")) if deletes else F.col("after")
    rest = [name for name in raw.columns if name != column]
    op = F.lower("op")
    return good(parsed(raw, CHANGE_ENVELOPE, column)).select(
        *rest,
        F.col("source.db").alias("database"),
        F.col("source.table").alias("table"),
        F.when(op.isin("create", "c"), "insert").when(op == "u", "update").when(op == "d", "delete")
        .when(op == "r", "read").otherwise(op).alias("type"),
        F.coalesce(after, F.create_map().cast("map<string,string>")).alias("data"),
    )


def op_is_delete() -> Column:
    return F.lower("op").isin("delete", "d")


def parse_changes(raw: DataFrame, column: str = "value") -> DataFrame:
    """Change events that are already flat JSON; text that is none is left out."""
    return good(parsed(raw, CHANGE, column))


def clean_changes(changes: DataFrame) -> DataFrame:
    """Keep events that name a table and carry data."""
    return changes.filter((F.col("table") != "") & (F.size("data") > 0))


def normalise_type(changes: DataFrame) -> DataFrame:
    """Rows of an initial load count as inserts."""
    kind = F.col("type")
    return changes.withColumn("type", F.when(kind == "bootstrap-insert", "insert").otherwise(kind))


def latest_config(history: DataFrame, order: str) -> DataFrame:
    """The current routing rules: the newest entry per source table and operation.

    Rules are replaced, never removed; entries without a key (deletes) are ignored.
    """
    key = ("source_table", "operate_type")
    rest = [name for name in history.columns if name not in (*key, order)]
    return (
        history.dropna(subset=list(key)).groupBy(*key)
        .agg(F.max_by(F.struct(*rest), F.col(order)).alias("rule"))
        .select(*key, "rule.*")
    )


def table_keys(config: DataFrame) -> DataFrame:
    """``sink_table, key``: the key column of each dimension table, the one that any of its rules
    names, else ``id``. Two rules that name different ones are an error."""
    keys = config.filter(F.col("sink_type") == TO_DIMENSION).groupBy("sink_table").agg(
        F.min("sink_pk").alias("one"), F.max("sink_pk").alias("other"))
    differ = F.raise_error(F.concat(F.lit("rules name two keys for "), F.col("sink_table"))).cast("string")
    return keys.select(
        "sink_table", F.when(F.col("one") != F.col("other"), differ).otherwise(F.coalesce("one", F.lit("id"))).alias("key"))


def keep_columns(data: Column, columns: Column, match: str = "exact") -> Column:
    """The entries of ``data`` named in a comma list; ``match='substring'`` keeps any name the list contains."""
    if match == "substring":
        return F.map_filter(data, lambda name, _: F.contains(columns, name))
    listed = F.split(columns, ",")
    return F.map_filter(data, lambda name, _: F.array_contains(listed, name))


def tag_changes(changes: DataFrame, config: DataFrame, match: str = "exact") -> DataFrame:
    """Give each change the target its (table, operation) is configured for, and trim its data.

    ``outcome`` is fact, dim or unrouted (no rule, or an unknown sink type; data is left whole).
    The configuration has one row per table and operation (:func:`latest_config`). ``key`` is the
    key column of a dimension's table; it is kept whether or not the rule lists it.
    """
    rules = config.join(table_keys(config), "sink_table", "left").select(
        F.col("source_table").alias("table"), F.col("operate_type").alias("type"),
        F.when(F.col("sink_type") == TO_TOPIC, "fact").when(F.col("sink_type") == TO_DIMENSION, "dim").alias("outcome"),
        "sink_table", "sink_columns", "sink_pk", F.when(F.col("sink_type") == TO_DIMENSION, F.col("key")).alias("key"),
    ).filter("outcome IS NOT NULL")
    matched = normalise_type(changes).join(rules, ["table", "type"], "left")
    trimmed = keep_columns(F.col("data"), F.col("sink_columns"), match)
    kept = F.map_filter("data", lambda name, _: (name == F.col("key")) | F.map_contains_key(trimmed, name))
    return matched.withColumns({
        "data": F.when(F.col("outcome").isNull(), F.col("data")).when(F.col("key").isNull(), trimmed).otherwise(kept),
        "outcome": F.coalesce("outcome", F.lit("unrouted")),
    }).drop("sink_columns")


def route_changes(changes: DataFrame, config: DataFrame, match: str = "exact") -> Routed:
    """The three outputs of :func:`tag_changes`."""
    tagged = tag_changes(changes, config, match)
    facts, dims, unrouted = (tagged.filter(F.col("outcome") == name).drop("outcome")
                             for name in ("fact", "dim", "unrouted"))
    return Routed(facts, dims, unrouted.select(*changes.columns))


def upsert_dimension(changes: DataFrame, columns: Sequence[str], order: str, key: str = "id",
                     snapshot: DataFrame | None = None, apply_deletes: bool = False) -> DataFrame:
    """A dimension snapshot, one text row per key, after a set of changes.

    Each column keeps the newest value any change carried for it, so a change that lacks a
    column leaves it alone. One grouping does it all: the old snapshot joins in as the oldest
    change, and many changes of one key are combined before the shuffle. Deletes are upserts
    like the rest unless ``apply_deletes`` is set.
    """
    rows = changes.select(
        F.col("data")[key].alias(key),
        F.struct(F.lit(1).alias("layer"), F.col(order).cast("bigint").alias("at")).alias("at"),
        (F.col("type") == "delete").alias("deleted"), "data",
    )
    if snapshot is not None:
        present = F.map_from_arrays(F.array(*map(F.lit, columns)), F.array(*columns))
        rows = rows.unionByName(snapshot.select(
            key,
            F.struct(F.lit(0).alias("layer"), F.lit(0).cast("bigint").alias("at")).alias("at"),
            F.lit(False).alias("deleted"), present.alias("data"),
        ))
    others = [name for name in columns if name != key]
    merged = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.max("at").alias("newest"),
        F.max(F.when(F.col("deleted"), F.col("at"))).alias("deleted_at"),
        *(F.max(F.when(F.map_contains_key("data", name), F.struct("at", F.col("data")[name].alias("value")))).alias(name)
          for name in others),
    )
    if not apply_deletes:
        return merged.select(key, *(F.col(f"{name}.value").alias(name) for name in others))
    gone = F.col("deleted_at")
    live = merged.filter(gone.isNull() | (F.col("newest") > gone))
    return live.select(key, *(
        F.when(gone.isNull() | (F.col(f"{name}.at") > gone), F.col(f"{name}.value")).alias(name) for name in others))


# --- all dimensions in one table of cells ------------------------------------------
CELLS = "sink_table string, key string, name string, at bigint, value string, deleted boolean"


def dimension_cells(dims: DataFrame, order: str) -> DataFrame:
    """Routed dimension rows (``sink_table, key, type, data``) as cells: the newest value of each column
    of each row, and when a row was last deleted (a cell without a name). Rows without a value for
    their key are left out; :func:`keyless` has them."""
    named = dims.withColumn("id", F.col("data")[F.col("key")]).filter(F.col("id").isNotNull())
    at = F.col(order).cast("bigint").alias("at")
    deleted = F.col("type") == "delete"
    cells = named.filter(~deleted | deleted.isNull()).select(
        "sink_table", F.col("id").alias("key"), at, F.explode("data").alias("name", "value"))
    gone = named.filter(deleted).select("sink_table", F.col("id").alias("key"), at)
    cells = cells.withColumn("deleted", F.lit(False)).unionByName(gone.withColumns(
        {"name": F.lit(None).cast("string"), "value": F.lit(None).cast("string"), "deleted": F.lit(True)}))
    return newest_cells(cells)


def keyless(dims: DataFrame) -> DataFrame:
    """Routed dimension rows that carry no value for their table's key."""
    return dims.filter(F.col("data")[F.col("key")].isNull())


def newest_cells(cells: DataFrame) -> DataFrame:
    """One cell for each column of each row; of equal times any one counts, the greatest value."""
    newest = cells.groupBy("sink_table", "key", "name", "deleted").agg(F.max(F.struct("at", "value")).alias("newest"))
    return newest.select("sink_table", "key", "name", "newest.at", "newest.value", "deleted")


def dimension_rows(cells: DataFrame, key: str, columns: Sequence[str], apply_deletes: bool = False) -> DataFrame:
    """A dimension from the cells of its table: one text row per key. Columns no change carried are null."""
    newest = newest_cells(cells if apply_deletes else cells.filter(~F.col("deleted")))
    others = [name for name in columns if name != key]
    merged = newest.groupBy(F.col("key").alias("__key")).agg(
        F.max("at").alias("__newest"), F.max(F.when(F.col("deleted"), F.col("at"))).alias("__gone"),
        *(F.max(F.when(F.col("name") == name, F.struct("at", "value"))).alias(name) for name in others))
    gone = F.col("__gone")
    if not apply_deletes:
        return merged.select(F.col("__key").alias(key), *(F.col(f"`{name}`.value").alias(name) for name in others))
    live = merged.filter(gone.isNull() | (F.col("__newest") > gone))
    return live.select(F.col("__key").alias(key), *(
        F.when(gone.isNull() | (F.col(f"`{name}`.at") > gone), F.col(f"`{name}`.value")).alias(name) for name in others))


def dimension_columns(config: DataFrame) -> DataFrame:
    """The text columns of every dimension table the configuration creates, and which is the key; the key
    comes first where its rule does not list it."""
    rules = config.filter((F.col("sink_type") == TO_DIMENSION) & (F.col("operate_type") == "insert"))
    listed = F.split("sink_columns", ",")
    names = F.when(F.array_contains(listed, F.col("key")), listed).otherwise(F.concat(F.array("key"), listed))
    return rules.join(table_keys(config), "sink_table").select(
        "sink_table", "key", F.posexplode(names).alias("position", "column"),
    ).select("sink_table", "position", "column", (F.col("column") == F.col("key")).alias("is_key"))


def create_dimension_tables(spark: SparkSession, config: DataFrame) -> list[str]:
    """Create the configured dimension tables that do not exist yet, all columns text; returns their names.

    A statement a table is what a catalog takes; the tables come to the driver one by one.
    """
    tables = dimension_columns(config).groupBy("sink_table").agg(
        F.array_sort(F.collect_list(F.struct("position", "column"))).alias("columns"))
    quoted = lambda name: ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))
    names = []
    for table in tables.orderBy("sink_table").toLocalIterator():
        names.append(table["sink_table"])
        if not spark.catalog.tableExists(quoted(names[-1])):
            body = ", ".join(f"`{entry['column'].replace('`', '``')}` STRING" for entry in table["columns"])
            spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(names[-1])} ({body}) USING parquet")
    return names
