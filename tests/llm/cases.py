"""Awkward documents for the training-data operators."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Columns that operators use for themselves or return.
CLASHING = ("digest", "place", "kept", "group_size", "keep_id", "n_words", "spans", "ids", "decoded", "score", "size",
            "hash", "entry", "set", "component_id", "start", "part", "label", "y", "again", "tail", "key")

LONG = " ".join(f"w{n % 977}x{n}" for n in range(30_000))
TEXTS = [
    None, "", "  \n\t ", "one", "One", "ONE", "one two three", "a b c d e f g h i j k l m", "A b c d e f g h i j k l M",
    "ünïcode Ünïcode ünïcode ſ K İ", "emoji 😀 and 中文 字", "x" * 5000, LONG, LONG + " end", "line one\nline two\r\n  three   spaces",
    "one two three", "\x00\x01 control \x7f", "tab\ttab", "nbsp nbsp",
]
_names = itertools.count()


def documents(spark: SparkSession, texts=None, ids=None, folder=None) -> DataFrame:
    """A stored table: ids from 0 on (or given), the texts, and columns with clashing names."""
    texts = TEXTS if texts is None else texts
    rows = [(i, t) for i, t in zip(ids if ids is not None else range(len(texts)), texts)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    frame = frame.withColumns({name: F.lit(name) for name in CLASHING})
    path = f"{folder}/docs{next(_names)}"
    frame.repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def plain(frame: DataFrame, *columns: str) -> list[tuple]:
    """Rows in a fixed order; nulls first."""
    rows = [tuple(r) for r in (frame.select(*columns) if columns else frame).collect()]
    return sorted(rows, key=lambda r: tuple((v is not None, str(type(v)), v) if not isinstance(v, (list, bytes)) else (True, "", str(v)) for v in r))
