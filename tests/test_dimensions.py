"""Dimensions built by a stream: tiers, buckets, lookups and the catalog tables."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from martbrook import schemas
from martbrook.operators import changes
from martbrook.streaming import changes as change_jobs, dimensions
from martbrook.streaming.runtime import drain
from rows import table, values
from test_streaming import Topic

CHANGES = T.StructType([*schemas.CHANGE, T.StructField("seq", T.LongType())])


def user(seq, kind="update", **data):
    return {"table": "users", "type": kind, "data": data, "seq": seq}


def rules(spark, columns="id,name,city", target="dim_users"):
    return table(spark, schemas.ROUTING, *(
        {"source_table": "users", "operate_type": op, "sink_type": "hbase", "sink_table": target, "sink_columns": columns}
        for op in ("insert", "update")))


def test_live_parts_are_few_and_whole():
    """Every batch is in one folder, and there are at most seven for each digit."""
    for count in range(600):
        parts = list(dimensions.live_parts(count))
        held = [b for tier, part in parts for b in range(part * 8 ** tier, (part + 1) * 8 ** tier)]
        assert sorted(held) == list(range(count)) and len(parts) <= 7 * 4


def test_fifty_batches_open_few_files(spark, tmp_path):
    """The stored batches as the job writes them, fifty of them, with a retry: what is read stays bounded and right."""
    out = f"{tmp_path}/out"
    for batch in range(50):
        rows = table(spark, CHANGES, *(user(batch * 10 + n, id=str((batch + n) % 20), name=f"n{batch}") for n in range(2)))
        tagged = changes.tag_changes(rows, rules(spark))
        for _ in range(2 if batch in (7, 30) else 1):
            dimensions.as_stored(changes.dimension_cells(tagged, "seq")).coalesce(1).write.mode("overwrite").partitionBy(
                "outcome", "sink_table", "bucket").parquet(f"{out}/routed/batch={batch}")
            dimensions.merge_tiers(spark, out, batch)
            dimensions.finish_batch(spark, out, batch)
    assert dimensions.finished_batches(spark, out) == 50
    found = dimensions.read_dimension(spark, out, "dim_users", "id", ["id", "name"])
    newest = {str((batch + n) % 20): f"n{batch}" for batch in range(50) for n in range(2)}
    assert values(found, "id", "name") == sorted(newest.items())
    # 50 = 6 of the next tier and 2 of the first; a folder has a file for each bucket it has keys of.
    opened = len(dimensions.read_cells(spark, out, "dim_users").inputFiles())
    assert len(list(dimensions.live_parts(50))) == 8 and opened <= 8 * dimensions.BUCKETS


def test_lookups_read_the_buckets_of_their_keys(spark, tmp_path):
    out, topic = f"{tmp_path}/out", Topic(spark, tmp_path / "changes", CHANGES)
    topic.add(table(spark, CHANGES, *(user(n, "insert", id=str(n), name=f"n{n}") for n in range(200))))
    job = lambda: drain(change_jobs.route_job(topic.read(), out, lambda session: rules(session)))
    job()
    batch = spark.createDataFrame([(1, 7), (2, 7), (3, None), (4, 9999)], "order_id int, user_id bigint")
    found = dimensions.lookup(batch, out, "dim_users", "user_id", "id", ["id", "name"])
    whole = dimensions.read_dimension(spark, out, "dim_users", "id", ["id", "name"])
    assert whole.count() == 200 and ("7", "n7") in values(found, "id", "name")
    scans = lambda frame: frame._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in scans(found) and found.count() < 200
    read = lambda rows: sum(1 for _ in rows.select(F.input_file_name().alias("f")).distinct().collect())
    some = dimensions.read_cells(spark, out, "dim_users", dimensions.buckets_of(batch, "user_id"))
    assert read(some) <= 2 < read(dimensions.read_cells(spark, out, "dim_users"))
    topic.add(table(spark, CHANGES, user(500, id="7", name="new")))
    job()
    again = dimensions.lookup(batch, out, "dim_users", "user_id", "id", ["id", "name"])
    assert ("7", "new") in values(again, "id", "name")
    stored = dimensions.StoredDimensions(out, {"users": ("user_id", "dim_users", "id", ["id", "name"])})
    assert values(stored.for_batch(batch)["users"], "id", "name") == values(again, "id", "name")
    assert dimensions.read_dimension(spark, f"{tmp_path}/nothing", "dim_users", "id", ["id"]).count() == 0


def test_tables_are_filled_and_gain_columns(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS landed LOCATION '{tmp_path}/db'")
    try:
        out, topic = f"{tmp_path}/out", Topic(spark, tmp_path / "changes", CHANGES)
        current = {"columns": "id,name"}
        job = lambda: drain(change_jobs.route_job(
            topic.read(), out, lambda session: rules(session, current["columns"], "landed.users"), create_tables=True, fan_in=2))
        topic.add(table(spark, CHANGES, user(1, "insert", id="1", name="a", city="x"), user(2, "insert", id="2", name="b", city="y")))
        job()
        assert spark.table("landed.users").columns == ["id", "name", "dim_bucket"]
        assert values(spark.table("landed.users"), "id", "name") == [("1", "a"), ("2", "b")]
        current["columns"] = "id,name,city"
        topic.add(table(spark, CHANGES, user(3, id="1", city="z"), user(4, "insert", id="3", city="w")))
        job()
        topic.add(table(spark, CHANGES, user(5, id="2", name="c")))
        job()
        spark.catalog.refreshTable("landed.users")
        assert spark.table("landed.users").columns == ["id", "name", "city", "dim_bucket"]
        assert values(spark.table("landed.users"), "id", "name", "city") == [("1", "a", "z"), ("2", "c", None), ("3", None, "w")]
    finally:
        spark.sql("DROP DATABASE landed CASCADE")


def test_keyless_rows_and_facts_are_one_write(spark, tmp_path):
    out, topic = f"{tmp_path}/out", Topic(spark, tmp_path / "changes", CHANGES)
    topic.add(table(spark, CHANGES, user(1, "insert", id="1", name="a"), user(2, "insert", name="lost"),
                    {"table": "other", "type": "insert", "data": {"x": "y"}, "seq": 3}))
    drain(change_jobs.route_job(topic.read(), out, lambda session: rules(session)))
    event = "`table` string, data map<string,string>, seq bigint"
    assert values(change_jobs.read_routed(spark, out, "keyless", event), "seq", "sink_table") == [(2, "dim_users")]
    assert values(change_jobs.read_routed(spark, out, "unrouted", event), "seq", "sink_table") == [(3, None)]
    assert change_jobs.read_routed(spark, out, "fact", event).count() == 0
    assert values(change_jobs.read_dimension(spark, out, "dim_users", "id", ["id", "name"]), "id", "name") == [("1", "a")]
