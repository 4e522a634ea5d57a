import os
import random
import re
from collections import Counter
from decimal import Decimal as D

from pyspark.sql import functions as F

from martbrook.functions import rates, times
from martbrook.functions.times import day_text
from martbrook.functions import tokens as tokens_module
from martbrook.functions.tokens import register_keyword_function, tokens
from martbrook.operators import dashboard, keywords
from martbrook.sources.results import append_batch, read_result
from rows import log, logs, values

VISITORS = "stt string, is_new string, uv_ct long, pv_ct long, sv_ct long, uj_ct long, dur_sum long"


def test_rates_round_half_up(spark):
    rows = spark.createDataFrame([(1, 1, 8, 0), (2, 1, 800, 0), (3, 0, 1, 10500), (4, 0, 2, 1), (5, 3, 0, 9)],
                                 "n int, uj long, sv long, dur long")
    got = values(rows, "n", rates.bounce_rate(F.col("uj"), F.col("sv")).cast("double"),
                 rates.seconds_per_session(F.col("dur"), F.col("sv")).cast("double"),
                 rates.pages_per_session(F.col("uj"), F.col("sv")).cast("double"))
    assert got == [(1, 12.5, 0.0, 0.13), (2, 0.13, 0.0, 0.0), (3, 0.0, 10.5, 0.0), (4, 0.0, 0.0, 0.0), (5, 0.0, 0.0, 0.0)]


def test_hours_without_traffic_are_zero(spark):
    stats = spark.createDataFrame([("2024-01-01 03:10:00", "1", 1, 2, 0, 0, 0), ("2024-01-01 17:00:00", "0", 5, 7, 0, 0, 0),
                                   ("2024-01-02 17:00:00", "1", 9, 9, 0, 0, 0)], VISITORS)
    hours = values(dashboard.visitors_by_hour(stats, 20240101), "hr", "pv_ct", "uv_ct", "new_uv")
    assert [h[0] for h in hours] == [f"{n:02d}" for n in range(24)]
    assert [h for h in hours if any(h[1:])] == [("03", 2, 1, 1), ("17", 7, 5, 0)]


def test_missing_visitor_kind_is_zero(spark):
    stats = spark.createDataFrame([("2024-01-01 03:10:00", "1", 3, 8, 4, 1, 10000)], VISITORS)
    assert values(dashboard.new_versus_returning(stats), "type", "old", "new") == [
        ("bounce_rate", D("0.00"), D("25.00")), ("page_views", D("0.00"), D("8.00")),
        ("pages_per_session", D("0.00"), D("2.00")), ("seconds_per_session", D("0.00"), D("2.50")),
        ("visitors", D("0.00"), D("3.00"))]
    assert dashboard.new_versus_returning(stats, 20240105).count() == 5


SALES = "stt string, tm_id long, tm_name string, spu_id long, spu_name string, order_ct long, order_amount decimal(16,2)"


def sales(spark):
    day = "2024-01-01 03:00:00"
    return spark.createDataFrame([
        (day, 1, "a", 1, "s", 1, D(5)), (day, 1, "a", 2, "t", 1, D(6)), (day, 2, "b", 3, "u", 2, D(9)),
        (day, 3, "none", 4, "v", 0, D(0)), (day, 4, "minus", 5, "w", 1, D(-1)),
        ("2024-01-02 00:00:00", 2, "b", 3, "u", 1, D(50))], SALES)


def test_sales_questions(spark):
    rows = sales(spark)
    assert dashboard.gmv(rows, 20240101).first()[0] == D(19)
    assert dashboard.gmv(rows, 20300101).first()[0] == D(0)
    assert [(r.tm_name, r.order_amount) for r in dashboard.gmv_by_brand(rows, day=20240101).collect()] == [
        ("a", D(11)), ("b", D(9))]
    assert [r.tm_name for r in dashboard.gmv_by_brand(rows, n=1).collect()] == ["b"]
    assert [(r.spu_name, r.order_ct) for r in dashboard.gmv_by_spu(rows, n=1).collect()] == [("u", 3)]
    assert values(dashboard.gmv_by_day(rows), "day", "order_amount") == [
        ("2024-01-01", D("19.00")), ("2024-01-02", D("50.00"))]


def test_day_filter_reaches_the_scan(spark, tmp_path):
    sales(spark).write.parquet(f"{tmp_path}/stats")
    frame = dashboard.gmv(spark.read.parquet(f"{tmp_path}/stats"), 20240101)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(stt,2024-01-01 00:00:00)" in plan and "LessThan(stt,2024-01-02 00:00:00)" in plan


def test_a_stored_day_is_one_folder(spark, tmp_path):
    out = f"{tmp_path}/stats"
    for batch in (0, 1, 1):  # the last one again
        append_batch(sales(spark), out, batch, day_from="stt")
    rows = read_result(spark, out)
    frame = dashboard.gmv(rows, 20240101)
    assert frame.first()[0] == 2 * D(19) and dashboard.gmv(rows, 20300101).first()[0] == D(0)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*dt#\d+[^]]*2024-01-01", plan)
    assert sorted(os.listdir(out))[-2:] == ["dt=2024-01-01", "dt=2024-01-02"]


def test_the_default_day_is_that_of_the_session(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        days = set()
        for other in ("Pacific/Kiritimati", "Etc/GMT+12"):  # 26 hours apart
            spark.conf.set("spark.sql.session.timeZone", other)
            days.add(spark.range(1).select(day_text(0)).first()[0])
        assert len(days) == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_keyword_scores(spark):
    stats = spark.createDataFrame(
        [("pen", "SEARCH", 1), ("pen", "CLICK", 3), ("ink", "OTHER", 1), ("cup", "CART", 2), ("cup", "ORDER", 1)],
        "keyword string, source string, ct long")
    assert [tuple(r) for r in dashboard.keyword_ranking(stats).collect()] == [("ink", 0), ("cup", 9), ("pen", 13)]
    assert [tuple(r) for r in dashboard.keyword_ranking(stats, n=1, descending=True).collect()] == [("pen", 13)]


def test_tokens(spark):
    rows = spark.createDataFrame([("Red pen-2, RED",), ("...",), (None,)], "text string")
    assert [r[0] for r in rows.select(tokens(F.col("text"))).collect()] == [["red", "pen", "2", "red"], [], None]
    words = ["我", "是", "你", "你的", "爸爸"]
    chinese = spark.createDataFrame([("我说 我是你的爸爸哎",), (None,)], "text string")
    assert [r[0] for r in chinese.select(tokens(F.col("text"), words)).collect()] == [
        ["我", "说", "我", "是", "你的", "爸爸", "哎"], None]


def test_dictionary_forms_agree(spark, monkeypatch):
    pick = random.Random(1)
    texts = ["".join(pick.choice("abAB é,") for _ in range(30)) for _ in range(50)]
    words = ["ab", "aba", "B", "éa", "a b", "(", ""]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    pattern = [r[0] for r in rows.select(tokens(F.col("text"), words)).collect()]
    register_keyword_function(spark, "cut_words", words)
    rows.createOrReplaceTempView("cut_texts")
    found = spark.sql("SELECT word, count(*) AS n FROM cut_texts, LATERAL cut_words(text) GROUP BY word").collect()
    assert {r.word: r.n for r in found} == Counter(w for ws in pattern for w in ws)
    monkeypatch.setattr(tokens_module, "PATTERN_WORDS", 0)
    assert [r[0] for r in rows.select(tokens(F.col("text"), words)).collect()] == pattern
    register_keyword_function(spark, "cut_words_in_python", words)
    found = spark.sql("SELECT word, count(*) AS n FROM cut_texts, LATERAL cut_words_in_python(text) GROUP BY word").collect()
    assert {r.word: r.n for r in found} == Counter(w for ws in pattern for w in ws)


def test_searches(spark):
    pages = logs(spark, log("a", "2024-01-01 00:00:01.500", page="good_list", item="red pen"),
                 log("a", "2024-01-01 00:00:09", page="good_list", item="Pen"),
                 log("a", "2024-01-01 00:00:03", page="good_list"), log("a", "2024-01-01 00:00:03", page="home", item="pen"))
    stats = keywords.keyword_stats(keywords.keywords(keywords.searches(pages)))
    want = [("2024-01-01 00:00:00", "pen", 2, "SEARCH"), ("2024-01-01 00:00:00", "red", 1, "SEARCH")]
    assert values(stats, "stt", "keyword", "ct", "source") == want
    assert values(keywords.keyword_stats_sql(spark, pages), "stt", "keyword", "ct", "source") == want


def test_times(spark):
    row = spark.range(1).select(
        times.text_millis(F.lit("2024-01-01 00:00:01")), times.millis_text(F.lit(1704067201999)),
        times.time_text(times.event_time_seconds(F.lit(1704067201999))), times.hour_label(F.lit(7))).first()
    assert tuple(row) == (1704067201000, "2024-01-01 00:00:01", "2024-01-01 00:00:01", "07")
