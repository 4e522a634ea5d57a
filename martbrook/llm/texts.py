"""Helpers of the training-data operators: a function over each whole text, and shared files."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import work_dir

#: Rows that a task turns into output at once; its memory is bounded by so many texts.
ROWS = 512


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_text(column: str) -> Column:
    """The text of a column; null counts as empty."""
    return F.coalesce(F.col(f"`{column}`"), F.lit(""))


def named(column: str) -> Column:
    return F.col(f"`{column}`")


def output_schema(docs: DataFrame, id_col: str, result: str) -> T.StructType:
    """``doc_id`` with the type of the id column, then the fields of ``result``."""
    first = T.StructField("doc_id", docs.schema[id_col].dataType)
    return T.StructType([first, *T.StructType.fromDDL(result).fields])


def map_texts(
    docs: DataFrame, make: Callable[[], Callable[[str], tuple]], result: str,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: its id and what a function makes of its whole text.

    ``make`` runs once per task and returns that function, so a task loads its tables once.
    Other columns of ``docs`` are not read, whatever their names.
    """
    schema = output_schema(docs, id_col, result)
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, out = make(), to_arrow_schema(schema)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                rows = [step(text) for text in part.column(1).to_pylist()]
                columns = [pa.array(list(c), out.field(i + 1).type) for i, c in enumerate(zip(*rows))]
                yield pa.RecordBatch.from_arrays([part.column(0).cast(out.field(0).type), *columns], schema=out)

    return docs.select(named(id_col).alias("doc_id"), whole_text(text_col).alias("text")).mapInArrow(run, schema)


def keep_texts(docs: DataFrame, make: Callable[[], Callable[[str], bool]], text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with their columns, whose whole text passes a test; null counts as empty.

    ``make`` runs once per task and returns the test. Rows go through a few hundred at a time."""
    at_text = docs.columns.index(text_col)
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                yield part.filter(pa.array([bool(step(t.as_py() or "")) for t in part.column(at_text)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top, packed = Path(__file__).resolve().parents[1], io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for file in sorted(top.rglob("*.py")):
            archive.write(file, file.relative_to(top.parent))
    folder = work_dir(spark, "package")
    files, path = file_system(folder)
    files.create_dir(path)
    with files.open_output_stream(f"{path}/{top.name}.zip") as out:
        out.write(packed.getvalue())
    context.addPyFile(f"{folder}/{top.name}.zip")
    _shipped.add(context.applicationId)


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared folder and the path in it; plain paths are local ones."""
    if "://" in uri or uri.startswith("file:"):
        if uri.startswith("file:") and not uri.startswith("file://"):
            uri = "file://" + uri[len("file:"):]
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri
