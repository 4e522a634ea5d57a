import functools
import json
import random

import pytest
from pyspark.sql import DataFrame, functions as F

from martbrook import schemas
from martbrook.operators import changes
from rows import table, values


def envelopes(spark, *rows):
    return spark.createDataFrame([(json.dumps(row), n) for n, row in enumerate(rows)], "value string, seq long")


def rule(source, op, kind, target, columns, pk=None):
    return {"source_table": source, "operate_type": op, "sink_type": kind, "sink_table": target,
            "sink_columns": columns, "sink_pk": pk}


def test_flatten_and_clean(spark):
    source = {"db": "d", "table": "t"}
    flat = changes.flatten_envelopes(envelopes(
        spark,
        {"source": source, "op": "CREATE", "after": {"id": 1, "price": 2.5}},
        {"source": source, "op": "DELETE", "after": None},
        {"source": source, "op": "u", "after": {"id": 3}},
        {"source": {"db": "d", "table": ""}, "op": "READ", "after": {"id": 4}}))
    assert values(flat, "seq", "database", "table", "type", F.size("data").alias("n")) == [
        (0, "d", "t", "insert", 2), (1, "d", "t", "delete", 0), (2, "d", "t", "update", 1), (3, "d", "", "read", 1)]
    assert values(changes.clean_changes(flat), "seq") == [(0,), (2,)]
    assert flat.filter("seq = 0").select("data").first()[0] == {"id": "1", "price": "2.5"}


def change(table_name, kind, **data):
    return {"table": table_name, "type": kind, "data": data}


def test_routing(spark):
    config = table(spark, schemas.ROUTING,
                   rule("orders", "insert", "kafka", "dwd_orders", "user_id,name"),
                   rule("users", "update", "hbase", "dim_users", "id"),
                   rule("odd", "insert", "clickhouse", "nowhere", "id"))
    rows = table(spark, schemas.CHANGE,
                 change("orders", "bootstrap-insert", id="1", user_id="2"), change("users", "update", id="3", x="4"),
                 change("orders", "delete", id="5"), change("odd", "insert", id="6"))
    routed = changes.route_changes(rows, config)
    assert [(r.sink_table, r.type, r.data) for r in routed.facts.collect()] == [("dwd_orders", "insert", {"user_id": "2"})]
    assert [(r.sink_table, r.data) for r in routed.dims.collect()] == [("dim_users", {"id": "3"})]
    assert values(routed.unrouted, "table", "type") == [("odd", "insert"), ("orders", "delete")]
    assert values(routed.dims, "key") == [("id",)]
    loose = changes.route_changes(rows, config, match="substring").facts.first().data
    assert loose == {"id": "1", "user_id": "2"}


def test_key_is_kept_and_is_one_for_a_table(spark):
    config = table(spark, schemas.ROUTING,
                   rule("u", "insert", "hbase", "dim_users", "name,user_id"), rule("u", "update", "hbase", "dim_users", "name", "uid"),
                   rule("v", "insert", "hbase", "dim_other", "name,user_id"))
    rows = table(spark, schemas.CHANGE, change("u", "insert", uid="1", name="a", x="b"), change("u", "update", uid="1", name="c"),
                 change("v", "insert", id="7", user_id="2", x="y"), change("v", "insert", name="without"))
    dims = changes.route_changes(rows, config).dims
    assert sorted((r.sink_table, r.key, sorted(r.data.items())) for r in dims.collect()) == [
        ("dim_other", "id", [("id", "7"), ("user_id", "2")]), ("dim_other", "id", [("name", "without")]),
        ("dim_users", "uid", [("name", "a"), ("uid", "1")]), ("dim_users", "uid", [("name", "c"), ("uid", "1")])]
    assert changes.keyless(dims).count() == 1
    wrong = table(spark, schemas.ROUTING, rule("u", "insert", "hbase", "d", "a", "a"), rule("u", "update", "hbase", "d", "b", "b"))
    with pytest.raises(Exception, match="rules name two keys for d"):
        changes.table_keys(wrong).collect()


def test_deletes_from_envelopes(spark):
    source = {"db": "d", "table": "t"}
    raw = envelopes(spark, {"source": source, "op": "c", "after": {"id": 1, "a": "x"}},
                    {"source": source, "op": "d", "before": {"id": 1, "a": "x"}, "after": None})
    assert changes.clean_changes(changes.flatten_envelopes(raw)).count() == 1
    flat = changes.clean_changes(changes.flatten_envelopes(raw, deletes=True))
    config = table(spark, schemas.ROUTING, *(rule("t", op, "hbase", "dim_t", "a") for op in ("insert", "delete")))
    cells = changes.dimension_cells(changes.route_changes(flat, config).dims, "seq")
    assert changes.dimension_rows(cells, "id", ["id", "a"]).collect() == [("1", "x")]
    assert changes.dimension_rows(cells, "id", ["id", "a"], apply_deletes=True).collect() == []


def test_cells_are_the_upsert(spark):
    """A dimension put together from the cells of many batches is the one that upserting gives."""
    pick = random.Random(2)
    rows = [(pick.choice(["insert", "update", "update", "delete"]), n, {"id": str(pick.randint(0, 5)), **{
        c: str(n) for c in "ab" if pick.random() < 0.5}}) for n in range(60)]
    whole = spark.createDataFrame(rows, "type string, seq long, data map<string,string>").withColumns(
        {"sink_table": F.lit("t"), "key": F.lit("id")})
    batches = [changes.dimension_cells(whole.filter((F.col("seq") / 7).cast("int") == n), "seq") for n in range(9)]
    cells = functools.reduce(DataFrame.unionByName, batches)
    for deletes in (False, True):
        upserted = changes.upsert_dimension(whole, ["id", "a", "b"], "seq", apply_deletes=deletes)
        found = changes.dimension_rows(cells, "id", ["id", "a", "b"], deletes)
        want = values(upserted if deletes else changes.upsert_dimension(whole.filter("type != 'delete'"), ["id", "a", "b"], "seq"), "id", "a", "b")
        assert values(found, "id", "a", "b") == want


def test_latest_config_ignores_entries_without_key(spark):
    schema = schemas.ROUTING.fieldNames()
    history = table(spark, schemas.ROUTING, rule("a", "insert", "kafka", "old", "x"), rule("a", "insert", "hbase", "new", "y"),
                    {name: None for name in schema}).withColumn("seq", F.monotonically_increasing_id())
    assert values(changes.latest_config(history, "seq"), "source_table", "sink_type", "sink_table") == [("a", "hbase", "new")]


def test_upsert_keeps_columns_a_change_does_not_carry(spark):
    schema = "type string, seq long, data map<string,string>"
    first = spark.createDataFrame([("insert", 1, {"id": "1", "a": "x", "b": "y"}), ("update", 2, {"id": "1", "a": "z"}),
                                   ("insert", 1, {"id": "2", "a": "q"})], schema)
    columns = ["id", "a", "b"]
    old = changes.upsert_dimension(first, columns, "seq")
    assert values(old, *columns) == [("1", "z", "y"), ("2", "q", None)]
    later = spark.createDataFrame([("update", 3, {"id": "1", "b": None}), ("delete", 4, {"id": "2"}),
                                   ("insert", 5, {"id": "3", "a": "n"})], schema)
    assert values(changes.upsert_dimension(later, columns, "seq", snapshot=old), *columns) == [
        ("1", "z", None), ("2", "q", None), ("3", "n", None)]
    assert values(changes.upsert_dimension(later, columns, "seq", snapshot=old, apply_deletes=True), *columns) == [
        ("1", "z", None), ("3", "n", None)]
    again = spark.createDataFrame([("delete", 6, {"id": "1"}), ("insert", 7, {"id": "1", "b": "back"})], schema)
    assert values(changes.upsert_dimension(again, columns, "seq", snapshot=old, apply_deletes=True), *columns) == [
        ("1", None, "back"), ("2", "q", None)]


def test_dimension_tables_are_created_once(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS dims LOCATION '{tmp_path}'")
    config = table(spark, schemas.ROUTING, rule("u", "insert", "hbase", "dims.users", "uid,name", "uid"),
                   rule("u", "update", "hbase", "dims.ignored", "uid"), rule("o", "insert", "kafka", "topic", "id"))
    assert values(changes.dimension_columns(config), "sink_table", "column", "is_key") == [
        ("dims.users", "name", False), ("dims.users", "uid", True)]
    for _ in range(2):
        assert changes.create_dimension_tables(spark, config) == ["dims.users"]
    assert spark.table("dims.users").dtypes == [("uid", "string"), ("name", "string")]
    spark.sql("DROP DATABASE dims CASCADE")
