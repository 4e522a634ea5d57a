"""Result tables: batched appends by column name, and reading them back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.times import processing_millis


def result_rows(stats: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The stored columns, in the table's order; helper columns stay behind, ``ts`` is stamped."""
    stamped = stats if "ts" in stats.columns else stats.withColumn("ts", processing_millis())
    return stamped.select(*columns)


def append_batch(rows: DataFrame, folder: str, batch: int | str, day_from: str | Column | None = None,
                 compression: str | None = None) -> None:
    """Write one batch of a stream into its own sub-folder, so that a retry replaces it.

    ``day_from`` names a time text, or is a column with a day; rows then go to a folder for its day, and the batch's folder is
    inside that, so readers of one day list and open only that day's files. A batch that is written in passes has a folder
    for each.
    """
    options = {"compression": compression} if compression else {}
    if day_from is None:
        rows.write.mode("overwrite").options(**options).parquet(f"{folder}/batch={batch}")
        return
    day = F.substring(day_from, 1, 10) if isinstance(day_from, str) else day_from
    placed = rows.withColumns({"dt": day, "batch": F.lit(batch)})
    placed.write.mode("overwrite").options(partitionOverwriteMode="dynamic", **options).partitionBy("dt", "batch").parquet(folder)


def append_jdbc(rows: DataFrame, url: str, table: str, batch_rows: int = 10_000, **options: str) -> None:
    """Append to a database table by column name, in batches of ``batch_rows`` statements."""
    rows.write.format("jdbc").options(url=url, dbtable=table, batchsize=batch_rows, **options).mode("append").save()


def read_result(spark: SparkSession, folder: str, view: str | None = None) -> DataFrame:
    """All batches of a result table, optionally registered as a view. ``dt`` stays text."""
    rows = spark.read.option("inferTimestamp", "false").parquet(folder).drop("batch")
    if "dt" in rows.columns:
        rows = rows.withColumn("dt", F.col("dt").cast("string"))
    if view:
        rows.createOrReplaceTempView(view)
    return rows


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
