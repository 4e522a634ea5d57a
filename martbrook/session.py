"""Session settings and the shared folder that jobs write to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Optional session setting: how many partitions the state of streaming jobs has.
STATE_PARTITIONS = "spark.martbrook.state.partitions"

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the split costs one more shuffle downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Else every store, however small, takes some 4 MB of disk ahead for its logs.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def build_session(master: str | None = None, app: str = "martbrook", **extra: str) -> SparkSession:
    """A session with this package's settings; ``master`` stays with spark-submit if not given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def streaming_session(spark: SparkSession) -> SparkSession:
    """A sibling session on the same context, so that state-store settings stay out of the caller's."""
    child = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and child.conf.isModifiable(key):
            child.conf.set(key, value)
    for key, value in SETTINGS.items():
        if key.startswith("spark.sql."):
            child.conf.set(key, value)
    child.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    # Every state partition is a store of its own, committed in every batch, and their number is fixed
    # in a job's checkpoint. STATE_PARTITIONS names it; else it is that of other shuffles, on a local
    # master at most two per core.
    wanted = spark.conf.get(STATE_PARTITIONS, None)
    if wanted is None:
        wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
        if spark.conf.get("spark.master", "").startswith("local"):
            wanted = min(wanted, 2 * spark.sparkContext.defaultParallelism)
    # What a batch does as a table starts from the caller's number; adaptive execution puts small ones together.
    if child.conf.get(INITIAL, None) is None:
        child.conf.set(INITIAL, spark.conf.get("spark.sql.shuffle.partitions"))
    child.conf.set("spark.sql.shuffle.partitions", int(wanted))
    return child


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = tempfile.mkdtemp(prefix="martbrook-")
    return os.path.join(base, "martbrook", f"{name}-{uuid.uuid4().hex}")


def written(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written to the shared folder and read back: computed once, with no lineage to redo."""
    spark = rows.sparkSession
    folder = work_dir(spark, name)
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)
