"""The change-event job: clean, route, append facts, upsert dimensions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.changes import clean_changes, dimension_cells, latest_config, tag_changes
from .dimensions import FAN_IN, as_stored, finish_batch, land_dimensions, merge_tiers, read_dimension
from .runtime import adaptive, read_if_there

__all__ = ["read_dimension", "read_routed", "route_job"]


def route_job(changes: DataFrame, out: str, config: Callable[[SparkSession], DataFrame], order: str = "seq",
              match: str = "exact", config_order: str = "seq", create_tables: bool = False, fan_in: int = FAN_IN) -> DataStreamWriter:
    """Flat change events to facts, dimension cells, events without a rule and dimension rows without a key.

    ``config`` is read again for every batch. It may be a history, ordered by ``config_order``; the newest
    entry of each table and operation counts. All that a batch routes is one write, in folders by outcome and
    target; of dimensions it is the cells that the batch changes, so its cost follows the batch. They are read
    with :func:`read_dimension`, which opens few files however many batches there were
    (:mod:`.dimensions`). With ``create_tables`` the catalog tables of the rules follow. A repeated batch
    replaces what it wrote.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rules = config(spark)
        if config_order in rules.columns:
            rules = latest_config(rules, config_order)
        with adaptive(spark):
            tagged = tag_changes(clean_changes(batch.persist(StorageLevel.MEMORY_AND_DISK)), rules, match)
            try:
                dims = tagged.filter("outcome = 'dim'")
                no_key = F.col("data")[F.col("key")].isNull()
                rest = tagged.filter("outcome != 'dim'").unionByName(dims.filter(no_key).withColumn("outcome", F.lit("keyless")))
                routed = rest.drop("sink_pk").unionByName(as_stored(dimension_cells(dims, order)), allowMissingColumns=True)
                routed.write.mode("overwrite").partitionBy("outcome", "sink_table", "bucket").parquet(f"{out}/routed/batch={number}")
            finally:
                batch.unpersist()
            merge_tiers(spark, out, number, fan_in=fan_in)
            finish_batch(spark, out, number)
            if create_tables:
                stored = spark.read.schema("outcome string, sink_table string, bucket int").parquet(f"{out}/routed/batch={number}")
                land_dimensions(spark, out, rules, stored.filter("outcome = 'dim'"), fan_in)

    return (
        changes.writeStream.foreachBatch(write).option("checkpointLocation", f"{out}/checkpoints/route")
    )


def read_routed(spark: SparkSession, out: str, outcome: str, columns: str) -> DataFrame:
    """Routed events of all batches: ``outcome`` is fact, unrouted or keyless; ``columns`` are those of the events, as
    DDL, to which comes their ``sink_table``."""
    found = read_if_there(spark, f"{out}/routed", f"{columns}, batch int, outcome string, sink_table string, bucket int")
    found = spark.createDataFrame([], f"{columns}, batch int, outcome string, sink_table string, bucket int") if found is None else found
    return found.filter(F.col("outcome") == outcome).drop("batch", "outcome", "bucket")
