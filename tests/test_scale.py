"""One key holding a third of all rows: nothing gathers it, results stay whole."""

from __future__ import annotations

import pytest
from pyspark.sql import Window, functions as F

from martbrook import schemas
from martbrook.operators import products, provinces, visitors, wide
from rows import LOGS, values

DAY = 86_400_000


@pytest.fixture(scope="module")
def hot_logs(spark):
    """Thirty thousand log rows, every third from the same visitor."""
    n = F.col("id")
    return spark.range(30_000).select(
        F.struct(F.when(n % 3 == 0, "hot").otherwise(F.concat(F.lit("m"), n % 997)).alias("mid"),
                 F.lit("v").alias("vc"), F.lit("c").alias("ch"), F.lit("a").alias("ar"),
                 F.when(n % 2 == 0, "1").otherwise("0").alias("is_new")).alias("common"),
        F.struct(F.lit("home").alias("page_id"), F.when(n % 4 == 0, None).otherwise("x").alias("last_page_id"),
                 F.lit(None).cast("string").alias("item"), n.alias("during_time")).alias("page"),
        F.lit(None).cast("map<string,string>").alias("start"),
        F.lit(None).cast(LOGS["displays"].dataType).alias("displays"),
        (1704067200000 + n * 9000).alias("ts"), n.alias("seq"))


@pytest.fixture()
def shuffle_joins(spark):
    """No broadcasts, and small thresholds for what counts as a skewed partition."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def test_visitor_operators_need_no_window_over_a_visitor(hot_logs):
    for rows in (visitors.repair_new_flag(hot_logs), visitors.unique_visitors(hot_logs),
                 visitors.bounces(hot_logs), visitors.visitor_stats(visitors.page_view_metrics(hot_logs))):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "Window [" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
        assert "partial_" in plan


def test_hot_visitor_results_equal_the_window_forms(spark, hot_logs):
    """The aggregates against sorting each visitor's whole history."""
    mid, entry = F.col("common.mid"), F.coalesce(F.col("page.last_page_id"), F.lit("")) == ""
    day = F.date_format(F.timestamp_millis("ts"), "yyyy-MM-dd")
    first = hot_logs.filter(entry).withColumn("n", F.row_number().over(Window.partitionBy(mid, day).orderBy("ts", "seq")))
    assert values(visitors.unique_visitors(hot_logs, ("ts", "seq")), "seq") == values(first.filter("n = 1"), "seq")
    for limit in (1000, 27_000, 60_000, 3_600_000):
        after = F.lead("ts").over(Window.partitionBy(mid).orderBy("ts", "seq"))
        alone = hot_logs.withColumn("after", after).filter(entry).filter(F.expr(f"after IS NULL OR after - ts >= {limit}"))
        assert values(visitors.bounces(hot_logs, limit, ("ts", "seq")), "seq") == values(alone, "seq")


def test_flag_repair_spreads_the_hot_visitor(spark, hot_logs, shuffle_joins):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    flagged_rows = hot_logs.filter("common.is_new = '1'").count()
    largest = {}
    for hot in (1000, 1_000_000):
        sizes = visitors.repair_new_flag(hot_logs, hot=hot).filter("common.is_new IN ('0', '1') AND seq % 2 = 0")
        largest[hot] = sizes.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert largest[1_000_000] > flagged_rows / 3 and largest[1000] < flagged_rows / 6

    repaired = visitors.repair_new_flag(hot_logs, hot=1000)
    day = F.date_format(F.timestamp_millis("ts"), "yyyy-MM-dd")
    flagged = hot_logs.filter("common.is_new = '1'")
    first = flagged.groupBy(F.col("common.mid").alias("m")).agg(F.min("ts").alias("first"))
    kept = flagged.join(first, F.col("common.mid") == F.col("m")).filter(day == F.date_format(F.timestamp_millis("first"), "yyyy-MM-dd")).count()
    assert repaired.filter("common.is_new = '1'").count() == kept
    assert repaired.count() == 30_000


def test_interval_join_splits_the_hot_order(spark, shuffle_joins):
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit(0)).otherwise(n % 500).cast("bigint")
    null = lambda field: F.lit(None).cast(field.dataType).alias(field.name)
    orders = spark.range(500).select(*(
        {"id": n.alias("id"), "create_ts": F.lit(1704067200000).alias("create_ts")}.get(f.name, null(f))
        for f in schemas.ORDER_INFO))
    details = spark.range(30_000).repartition(8).select(*(
        {"id": n.alias("id"), "order_id": key.alias("order_id"), "sku_id": (n % 7).alias("sku_id"),
         "create_ts": (F.lit(1704067200000) + n % 13 * 1000).alias("create_ts"),
         "split_total_amount": F.lit(1).cast("decimal(16,2)").alias("split_total_amount")}.get(f.name, null(f))
        for f in schemas.ORDER_DETAIL))
    joined = wide.order_wide(orders, details)
    assert "skew=true" in final_plan(joined)
    want = details.filter((F.col("create_ts") - 1704067200000) <= 5000).count()
    assert joined.count() == want
    salted = wide.order_wide(orders, details, salts=4)
    assert salted.count() == want

    paid = spark.range(500).select(
        n.alias("id"), n.alias("order_id"), n.alias("user_id"), F.lit(1).cast("decimal(16,2)").alias("total_amount"),
        F.lit("s").alias("subject"), F.lit("t").alias("payment_type"), F.lit("2024-01-01 00:00:00").alias("create_time"),
        F.lit("2024-01-01 00:10:00").alias("callback_time"))
    twice = wide.payment_wide(paid, joined)
    assert final_plan(twice).count("skew=true") == 2
    assert twice.count() == want
    per_product = products.product_stats(products.order_metrics(joined), "1 minute")
    exact = joined.groupBy("sku_id").agg(F.countDistinct("order_id").alias("n"))
    assert {tuple(r) for r in per_product.select("sku_id", "order_ct").collect()} == {tuple(r) for r in exact.collect()}
    by_order = provinces.province_stats(joined, "1 minute")
    assert by_order.first().order_count == joined.select("order_id").distinct().count()


def test_distinct_orders_of_a_best_seller_are_counted_apart(spark, shuffle_joins):
    """Level one hashes the order too, so one product's orders go to many tasks."""
    n = F.col("id")
    refunds = spark.range(20_000).select(
        (n % 4000).alias("order_id"), F.when(n % 3 == 0, 1).otherwise(n % 50 + 2).cast("bigint").alias("sku_id"),
        F.lit(1).cast("decimal(16,2)").alias("refund_amount"),
        F.date_format(F.timestamp_seconds(1704067200 + n % 600), "yyyy-MM-dd HH:mm:ss").alias("create_time"))
    stats = products.product_stats(products.refund_metrics(refunds), "1 hour")
    plan = stats._jdf.queryExecution().executedPlan().toString()
    shuffles = [part.split(", 16)")[0] for part in plan.split("Exchange hashpartitioning(")[1:]]
    assert any("sku_id" in keys and "ref_id" in keys for keys in shuffles), shuffles
    exact = refunds.groupBy("sku_id").agg(F.countDistinct("order_id").alias("n"), F.sum("refund_amount").alias("a"))
    assert values(stats, "sku_id", "refund_order_ct", "refund_amount") == values(exact, "sku_id", "n", "a")


def test_queries_go_by_the_settings_of_the_caller(spark):
    """Options that the caller has set hold inside a registered query, and stay as they were."""
    from martbrook.plans.queries import QUERIES

    key = "spark.sql.autoBroadcastJoinThreshold"
    plans = {}
    for limit in ("10485760", "-1"):
        spark.conf.set(key, limit)
        try:
            frame = QUERIES["order_wide_dims"](spark, "/root/testdata/sf0.001")
            plans[limit] = frame._jdf.queryExecution().executedPlan().toString()
            assert spark.conf.get(key) == limit
        finally:
            spark.conf.unset(key)
    assert "BroadcastHashJoin" in plans["10485760"] and "Broadcast" not in plans["-1"]
