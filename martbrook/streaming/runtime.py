"""Starting streaming jobs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"


def drain(writer: DataStreamWriter, empty_batches: bool = True) -> StreamingQuery:
    """Run a job over everything its source holds now, then stop.

    State that expires by the clock asks for another batch for ever, so such a job is drained without
    ``empty_batches``; others need them to act on the last watermark.
    """
    conf = writer._spark.conf
    before = conf.get(NO_DATA)
    conf.set(NO_DATA, str(empty_batches).lower())  # a query takes the settings of when it starts
    try:
        query = writer.trigger(availableNow=True).start()
    finally:
        conf.set(NO_DATA, before)
    query.awaitTermination()
    return query


def keep_running(writer: DataStreamWriter, every: str = "5 seconds") -> StreamingQuery:
    return writer.trigger(processingTime=every).start()


@contextmanager
def held(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Settings that hold for a while, then are as they were."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def adaptive(spark: SparkSession) -> AbstractContextManager[None]:
    """Adaptive execution for the batch queries of a ``foreachBatch``.

    Spark turns it off for a whole stateful stream, since it may not change the number of state
    partitions. What is done with a finished batch has no state, and joins there need it.
    """
    return held(spark, **{"spark.sql.adaptive.enabled": "true"})


def as_tables(spark: SparkSession) -> AbstractContextManager[None]:
    """For batches that are joined and aggregated as tables: hot keys are split, tasks are of the advised size, so that they
    write few files, and what a query has shuffled goes when it ends, not when the driver happens to collect its garbage."""
    return held(spark, **{"spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}, **dict.fromkeys((
        "spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled", "spark.sql.adaptive.forceOptimizeSkewedJoin",
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled"), "true"))


@contextmanager
def kept(rows: DataFrame) -> Iterator[DataFrame]:
    """A table that several queries read, computed once."""
    rows.persist()
    try:
        yield rows
    finally:
        rows.unpersist()


def read_if_there(spark: SparkSession, folder: str, schema: T.StructType | str) -> DataFrame | None:
    """A folder an earlier batch may have written."""
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
