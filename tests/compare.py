"""Run a registered query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def difference(frame, connection, sql: str) -> str | None:
    """None when equal, else what differs."""
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    kinds = {column[0]: str(column[1]) for column in cursor.description}
    expected = cursor.fetchall()
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} / {sorted(names)}"
    mine = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    wrong = [(f.name, f.dataType.simpleString(), kinds[f.name]) for f in frame.schema
             if mine.get(f.dataType.simpleString()) != kinds[f.name]]
    if wrong:
        return f"types {wrong}"
    order = sorted(names)
    got = Counter(tuple(plain(row[name]) for name in order) for row in frame.collect())
    want = Counter(tuple(plain(row[names.index(name)]) for name in order) for row in expected)
    if got == want:
        return None
    return (f"rows {sum(got.values())} / {sum(want.values())}; columns {order}; "
            f"only here {list((got - want).items())[:3]}; only there {list((want - got).items())[:3]}")
