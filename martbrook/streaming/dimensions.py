"""Dimensions that a stream of changes builds: cells in tiers and buckets, lookups that read what a batch needs,
and the catalog tables they land in.

A batch stores the cells that it changes in a folder of its own. Whenever :data:`FAN_IN` folders of one tier are
full, the batch that fills them merges them into one of the next tier, as counting carries digits. So which
folders are to be read follows from the number of batches alone, and there are at most ``FAN_IN - 1`` for each digit
of it; each cell is merged once a tier. Inside, cells lie in a folder for each table and bucket of keys, and a
lookup of some keys opens their buckets only.

A reader goes by the last batch that was finished. Merged folders are written before that is said, and what they
replace stays, so readers at work are not disturbed; a repeated batch writes the same again.
"""

from __future__ import annotations

from collections.abc import Collection, Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.changes import CELLS, dimension_columns, dimension_rows, newest_cells
from .runtime import read_if_there

FAN_IN = 8
#: Buckets of keys in each dimension.
BUCKETS = 16
_CELL = "struct<key: string, name: string, at: bigint, value: string, deleted: boolean>"
_STORED = f"cell {_CELL}, outcome string, sink_table string, bucket int"


def bucket_of(key: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def as_stored(cells: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Cells of :func:`~..operators.changes.dimension_cells` as the job stores them."""
    return cells.select(
        F.struct("key", "name", "at", "value", "deleted").alias("cell"), F.lit("dim").alias("outcome"), "sink_table",
        bucket_of(F.col("key"), buckets).alias("bucket"))


def live_parts(batches: int, fan_in: int = FAN_IN) -> Iterator[tuple[int, int]]:
    """``(tier, part)`` of the folders that hold all of so many batches: the digits of the number."""
    tier = 0
    while batches:
        last = batches // fan_in * fan_in
        yield from ((tier, part) for part in range(last, batches))
        tier, batches = tier + 1, batches // fan_in


def _folder(out: str, tier: int, part: int) -> str:
    return f"{out}/routed/batch={part}" if tier == 0 else f"{out}/merged/tier={tier}/part={part}"


def _cells(spark: SparkSession, out: str, parts: Collection[tuple[int, int]]) -> DataFrame:
    """The cells in some folders."""
    rows = None
    for tier in sorted({tier for tier, _ in parts}):
        folders = [_folder(out, t, part) for t, part in parts if t == tier]
        base, levels = (f"{out}/routed", "batch int") if tier == 0 else (f"{out}/merged", "tier int, part int")
        found = spark.read.schema(f"{_STORED}, {levels}").option("basePath", base).parquet(*folders)
        found = found.filter("outcome = 'dim'").select("cell", "sink_table", "bucket")
        rows = found if rows is None else rows.unionByName(found)
    return spark.createDataFrame([], f"cell {_CELL}, sink_table string, bucket int") if rows is None else rows


def merge_tiers(spark: SparkSession, out: str, batch: int, buckets: int = BUCKETS, fan_in: int = FAN_IN) -> None:
    """Merge the tiers that a batch fills, the lowest first, all tables at once."""
    tier, count = 1, batch + 1
    while count % fan_in == 0:
        count //= fan_in
        parts = [(tier - 1, part) for part in range((count - 1) * fan_in, count * fan_in)]
        rows = _cells(spark, out, parts).select("sink_table", "cell.*")
        as_stored(newest_cells(rows), buckets).write.mode("overwrite").partitionBy("outcome", "sink_table", "bucket").parquet(
            _folder(out, tier, count - 1))
        tier += 1


def finish_batch(spark: SparkSession, out: str, batch: int) -> None:
    spark.range(1).select(F.lit(batch).cast("bigint").alias("n")).write.mode("overwrite").parquet(f"{out}/finished/batch={batch % 2}")


def finished_batches(spark: SparkSession, out: str) -> int:
    """How many batches have been finished; the last two say so."""
    found = read_if_there(spark, f"{out}/finished", "n bigint")
    last = None if found is None else found.agg(F.max("n")).first()[0]
    return 0 if last is None else last + 1


def read_cells(spark: SparkSession, out: str, table: str, buckets: Collection[int] | None = None, fan_in: int = FAN_IN) -> DataFrame:
    """The cells of a dimension table, of some buckets or all; files of other tables and buckets are not opened."""
    rows = _cells(spark, out, list(live_parts(finished_batches(spark, out), fan_in))).filter(F.col("sink_table") == table)
    if buckets is not None:
        rows = rows.filter(F.col("bucket").isin(sorted(buckets)))
    return rows.select("sink_table", "cell.*")


def read_dimension(spark: SparkSession, out: str, table: str, key: str, columns: Sequence[str], apply_deletes: bool = False,
                   buckets: Collection[int] | None = None, fan_in: int = FAN_IN) -> DataFrame:
    """A dimension as it is now, whole or some buckets of it; no rows if nothing was written for it."""
    return dimension_rows(read_cells(spark, out, table, buckets, fan_in), key, columns, apply_deletes)


def buckets_of(rows: DataFrame, key: str, buckets: int = BUCKETS) -> list[int]:
    """The buckets that the keys of some rows lie in; there are no more than ``buckets``."""
    found = rows.filter(F.col(key).isNotNull()).select(bucket_of(F.col(key), buckets).alias("bucket")).distinct()
    return [row["bucket"] for row in found.collect()]


def lookup(rows: DataFrame, out: str, table: str, on: str, key: str, columns: Sequence[str],
           buckets: int = BUCKETS, fan_in: int = FAN_IN) -> DataFrame:
    """The part of a dimension that the keys in column ``on`` of a batch need, as it is now: what a change has
    altered since the last batch shows."""
    return read_dimension(rows.sparkSession, out, table, key, columns, buckets=buckets_of(rows, on, buckets), fan_in=fan_in)


class StoredDimensions:
    """Dimensions of a batch of wide rows, read from where a change job leaves them.

    ``tables`` maps the name that :func:`~..operators.wide.with_dimensions` takes to the batch's column, the
    dimension table, its key and its columns."""

    def __init__(self, out: str, tables: Mapping[str, tuple[str, str, str, Sequence[str]]]):
        self.out, self.tables = out, tables

    def for_batch(self, *rows: DataFrame) -> dict[str, DataFrame]:
        """For one or more kinds of rows; a table is looked up for the first that has its key."""
        having = lambda on: next(some for some in rows if on in some.columns)
        return {name: lookup(having(on), self.out, table, on, key, columns) for name, (on, table, key, columns) in self.tables.items()}


# --- catalog tables -----------------------------------------------------------------
OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def _quoted(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def _columns(rules: DataFrame) -> dict[str, tuple[str, list[str]]]:
    """Key and columns of each dimension table, as the rules have them now."""
    out: dict[str, tuple[str, list[str]]] = {}
    for row in dimension_columns(rules).orderBy("sink_table", "position").toLocalIterator():
        key, names = out.get(row["sink_table"], (None, []))
        out[row["sink_table"]] = (row["column"] if row["is_key"] else key, [*names, row["column"]])
    return out


def land_dimensions(spark: SparkSession, out: str, rules: DataFrame, touched: DataFrame, fan_in: int = FAN_IN) -> list[str]:
    """Bring the catalog tables of some dimensions up to date; returns their names.

    ``touched`` has ``sink_table`` and ``bucket`` of what has changed. A table that is not there yet is created, all
    columns text, with a folder for each bucket; columns that its rule has gained are added, and then hold what
    changes carried for them before, too. Only touched buckets are written again.
    """
    rules_of = _columns(rules)
    changed: dict[str, list[int]] = {}
    for row in touched.filter("bucket IS NOT NULL").select("sink_table", "bucket").distinct().collect():  # tables x buckets
        changed.setdefault(row["sink_table"], []).append(row["bucket"])
    for table in sorted(changed.keys() & rules_of.keys()):
        key, names = rules_of[table]
        text = lambda columns: ", ".join(f"`{c.replace('`', '``')}` STRING" for c in columns)
        wanted = changed[table]
        if not spark.catalog.tableExists(_quoted(table)):
            spark.sql(f"CREATE TABLE {_quoted(table)} ({text(names)}, dim_bucket INT) USING parquet PARTITIONED BY (dim_bucket)")
        have = [c for c in spark.table(_quoted(table)).columns if c != "dim_bucket"]
        if gained := [c for c in names if c not in have]:
            spark.sql(f"ALTER TABLE {_quoted(table)} ADD COLUMNS ({text(gained)})")
            wanted, have = None, [*have, *gained]
        rows = read_dimension(spark, out, table, key, have, buckets=wanted, fan_in=fan_in)
        placed = rows.select(*(F.col(f"`{c}`") for c in have), bucket_of(F.col(f"`{key}`")).alias("dim_bucket"))
        before = spark.conf.get(OVERWRITE)
        spark.conf.set(OVERWRITE, "dynamic")  # an insert by position goes by the session's setting alone
        try:
            placed.write.mode("overwrite").insertInto(_quoted(table))
        finally:
            spark.conf.set(OVERWRITE, before)
    return sorted(changed.keys() & rules_of.keys())
