"""Stream sources and sinks. A topic is either a Kafka topic or a folder of files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from ..functions.times import text_time


def kafka_source(spark: SparkSession, servers: str, topic: str, starting: str = "latest") -> DataFrame:
    """The text of a Kafka topic (needs the Kafka connector on the classpath)."""
    return (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic).option("startingOffsets", starting).load()
        .select(F.col("value").cast("string").alias("value"), F.col("offset").alias("seq"))
    )


def file_source(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """A folder of parquet files as a stream, batches taken in the order the files were written."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def log_source(spark: SparkSession, folder: str, streaming: bool = True) -> DataFrame:
    """The collector's daily log files, one JSON text per line."""
    reader = spark.readStream if streaming else spark.read
    return reader.option("recursiveFileLookup", "true").text(folder)


def declare_view(raw: DataFrame, name: str, schema: T.StructType, time_column: str, delay: str,
                 millis: bool = False) -> DataFrame:
    """Declare JSON text as a view with an event time and watermark, for use from SQL.

    The event time ``rowtime`` comes from a time text, or from epoch milliseconds.
    """
    rows = raw.select(F.inline(F.array(F.from_json("value", schema))))  # parsed once, whatever filters follow
    when = F.timestamp_millis(F.col(time_column)) if millis else text_time(F.col(time_column))
    view = rows.withColumn("rowtime", when).withWatermark("rowtime", delay)
    view.createOrReplaceTempView(name)
    return view


def as_messages(rows: DataFrame, topic: str | None = None) -> DataFrame:
    """Rows as JSON messages; ``topic`` is one name for all, else each row's ``sink_table``."""
    if topic is not None:
        return rows.select(F.lit(topic).alias("topic"), F.to_json(F.struct(*rows.columns)).alias("value"))
    return rows.select(F.col("sink_table").alias("topic"), F.to_json("data").alias("value"))


def kafka_sink(messages: DataFrame, servers: str, checkpoint: str) -> DataStreamWriter:
    """Write messages to the topics they name. Delivery is at least once."""
    return (
        messages.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
    )


def folder_sink(rows: DataFrame, folder: str, checkpoint: str, partition_by: Sequence[str] = ()) -> DataStreamWriter:
    """Append rows to a folder of parquet files, exactly once."""
    writer = rows.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint)
    return writer.partitionBy(*partition_by) if partition_by else writer
