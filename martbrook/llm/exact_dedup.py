"""Exact dedup as a stateful stream: keyed state on disk, never expired, and a check of all bytes.

A stream of arrivals (digest of the normalised text, the document's id, where its text is) runs
into keyed state: for each digest the id and place of the document that stays, and how many
documents share it. The state is a streaming aggregation without a watermark in RocksDB, so it is held
on disk, survives restarts through the checkpoint, and no key expires. Aggregates combine before the
shuffle, so a text that a third of all documents share reaches its state as a row for each task.

A digest that was met before is a hit. The bytes of hits are compared in full: hits are found again
by id and digest, which no two tasks' shares make uneven, and per digest the least and the greatest
text are kept, again with partial aggregation; where they differ, the digest is no proof and the
documents are grouped by their texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import streaming_session, work_dir
from ..streaming.runtime import drain, read_if_there
from .texts import named, whole_text

# Only these letters are folded.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Files that one micro-batch takes in when a finished folder is drained.
FILES_A_BATCH = 1000


def folded(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def arrivals(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    digest: Callable[[Column], Column] = sha256, place: Column | None = None,
) -> DataFrame:
    """What the state needs of each document: ``digest``, ``doc_id`` and ``place``, the locator of its
    content (a number, unique among rows; the row's place in the input if not given)."""
    place = F.monotonically_increasing_id() if place is None else place
    return docs.select(
        digest(folded(whole_text(text_col))).alias("digest"), named(id_col).alias("doc_id"), place.alias("place"))


def retained(stream: DataFrame) -> DataFrame:
    """The keyed state of a stream of :func:`arrivals`: the document that stays of each digest (the
    largest id, then the largest place) and the number of documents so far."""
    return stream.groupBy("digest").agg(
        F.max(F.struct("doc_id", "place")).alias("keep"), F.count(F.lit(1)).alias("group_size"))


def run_state(stream: DataFrame, folder: str) -> None:
    """Take in all that a stream of :func:`arrivals` holds now. Each batch writes the digests that it
    changed to a folder of its own under ``folder/changes``; a repeated batch writes it again. Started
    again with the same folder, the stream goes on from its state."""

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{folder}/changes/batch={batch}")

    drain(retained(stream).writeStream.outputMode("update").option("checkpointLocation", f"{folder}/state")
          .foreachBatch(write))


def groups(spark: SparkSession, folder: str, id_type: T.DataType) -> DataFrame:
    """The state as it is now: ``digest``, ``keep``, ``group_size``."""
    keep = T.StructType([T.StructField("doc_id", id_type), T.StructField("place", T.LongType())])
    schema = T.StructType([
        T.StructField("digest", T.StringType()), T.StructField("keep", keep), T.StructField("group_size", T.LongType())])
    changes = read_if_there(spark, f"{folder}/changes", T.StructType([*schema.fields, T.StructField("batch", T.LongType())]))
    if changes is None:
        return spark.createDataFrame([], schema)
    # Counts only grow, and so does the document that stays.
    return changes.groupBy("digest").agg(F.max("keep").alias("keep"), F.max("group_size").alias("group_size"))


def same_rows(docs: DataFrame, rows: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column],
              how: str = "left_semi") -> DataFrame:
    """Rows of ``docs`` whose id and digest are in ``rows`` (doc_id, digest)."""
    keys = rows.select(F.col("doc_id").alias("__found_id"), F.col("digest").alias("__found_digest"))
    return docs.join(keys, named(id_col).eqNullSafe(F.col("__found_id")) & (
        digest(folded(whole_text(text_col))) == F.col("__found_digest")), how)


def collided(docs: DataFrame, hits: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    """Digests of ``hits`` (doc_id, digest) whose documents differ in any byte."""
    text = folded(whole_text(text_col))
    texts = same_rows(docs, hits, id_col, text_col, digest).select(digest(text).alias("digest"), text.alias("bytes"))
    ends = texts.groupBy("digest").agg(F.min("bytes").alias("least"), F.max("bytes").alias("greatest"))
    return ends.filter(F.col("least") != F.col("greatest")).select("digest")


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    digest: Callable[[Column], Column] = sha256, files_a_batch: int = FILES_A_BATCH,
) -> DataFrame:
    """The group of equal texts of each document; equal after lower-casing A-Z only.

    Returns per row of ``docs``: ``doc_id``, ``keep_id`` (id of the row that stays, the largest),
    ``group_size``, ``kept``, ``digest`` and ``place``. Null texts count as empty, and equal each
    other. Null ids come before all others. Of rows that share both text and the largest id, one is
    kept. Other columns are not looked at; no rows give no rows.

    ``docs`` must give the same rows each time it is read, as stored tables do. The arrivals are
    written to the shared folder, a row of about 50 bytes for each document, and drained through the
    state from there.
    """
    spark = docs.sparkSession
    folder = work_dir(spark, "exact_dedup")
    arrivals(docs, id_col, text_col, digest).write.parquet(f"{folder}/arrivals")
    came = spark.read.parquet(f"{folder}/arrivals")
    source = streaming_session(spark).readStream.schema(came.schema).option("maxFilesPerTrigger", files_a_batch)
    run_state(source.parquet(f"{folder}/arrivals"), folder)
    # Stored first: joined as it comes from its grouping, a hot digest could not be split over tasks.
    groups(spark, folder, came.schema["doc_id"].dataType).write.parquet(f"{folder}/groups")
    state = spark.read.parquet(f"{folder}/groups")
    came.join(state, "digest").write.parquet(f"{folder}/found")
    found = spark.read.parquet(f"{folder}/found")

    collided(docs, found.filter("group_size > 1"), id_col, text_col, digest).write.parquet(f"{folder}/collided")
    differ = spark.read.schema("digest string").parquet(f"{folder}/collided")
    if not differ.isEmpty():
        found = found.join(differ, "digest", "left_anti").unionByName(_by_text(docs, differ, id_col, text_col, digest))
    return found.select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("place") == F.col("keep.place")).alias("kept"), "digest", "place")


def _by_text(docs, differ, id_col, text_col, digest) -> DataFrame:
    """Groups of the documents whose digest is no proof, by their texts."""
    text = folded(whole_text(text_col))
    rows = docs.select(named(id_col).alias("doc_id"), digest(text).alias("digest"), text.alias("bytes"),
                       F.monotonically_increasing_id().alias("place")).join(differ, "digest", "left_semi")
    same = rows.groupBy("bytes").agg(
        F.max(F.struct("doc_id", "place")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    return rows.join(same, "bytes").select("digest", "doc_id", "place", "keep", "group_size")


def deduplicated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    digest: Callable[[Column], Column] = sha256, files_a_batch: int = FILES_A_BATCH,
) -> DataFrame:
    """One row of ``docs`` for each text, with its columns: of the rows with the largest id any one."""
    found = exact_groups(docs, id_col, text_col, digest, files_a_batch)
    folder = work_dir(docs.sparkSession, "exact_kept")
    found.filter("kept").select("doc_id", "digest").write.parquet(folder)
    kept = docs.sparkSession.read.parquet(folder)
    rows = same_rows(docs, kept, id_col, text_col, digest, "inner")
    # With a real digest, an id and a digest name one text; a repeated row is one of several such.
    rows = rows.withColumn("__found_text", folded(whole_text(text_col)) if digest is not sha256 else F.lit(""))
    return rows.dropDuplicates(["__found_id", "__found_digest", "__found_text"]).select(*map(named, docs.columns))
