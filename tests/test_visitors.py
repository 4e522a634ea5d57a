from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from martbrook.operators import applog, visitors
from martbrook.plans.warehouse import Warehouse
from rows import log, logs, ms, values

D1, D2, D3 = "2024-01-01 10:00:00", "2024-01-02 10:00:00", "2024-01-03 10:00:00"


def test_flag_is_kept_on_the_first_day_only(spark):
    rows = logs(spark,
                log("a", D1, seq=1), log("a", "2024-01-01 11:00:00", seq=2), log("a", D2, seq=3),
                log("a", D2, is_new="0", seq=4),
                log("b", D1, is_new="0", seq=5), log("b", D2, seq=6), log("b", D3, seq=7))
    repaired = visitors.repair_new_flag(rows)
    assert values(repaired, "seq", "common.is_new") == [
        (1, "1"), (2, "1"), (3, "0"), (4, "0"), (5, "0"), (6, "1"), (7, "0")]
    assert repaired.columns == rows.columns


def test_unique_visitor_is_the_first_entry_of_each_day(spark):
    rows = logs(spark,
                log("a", "2024-01-01 10:00:00", seq=2), log("a", "2024-01-01 09:00:00", seq=1),
                log("a", "2024-01-02 09:00:00", last="home", seq=3), log("a", "2024-01-02 10:00:00", last="", seq=4))
    assert values(visitors.unique_visitors(rows), "seq") == [(1,), (4,)]


def bounced(spark, *rows, within=1000):
    return [seq for seq, in values(visitors.bounces(logs(spark, *rows), within, ("ts", "seq")), "seq")]


def test_bounce_limits(spark):
    t = ms(D1) + 300
    assert bounced(spark, log("a", t, seq=1), log("a", t + 999, last="x", seq=2)) == []
    assert bounced(spark, log("a", t, seq=1), log("a", t + 1000, last="x", seq=2)) == [1]
    assert bounced(spark, log("a", t, seq=1)) == [1]
    assert bounced(spark, log("a", t, seq=1), log("a", t + 500, seq=2)) == [2]
    assert bounced(spark, log("a", t, seq=1), log("b", t + 10, last="x", seq=2)) == [1]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 5000), st.booleans()), min_size=1, max_size=40))
def test_bounce_equals_looking_at_the_next_record(spark, seen):
    rows = [log(mid, ms(D1) + at, last=None if entry else "x", seq=n) for n, (mid, at, entry) in enumerate(seen)]
    want = []
    for mid in "ab":
        mine = sorted((at, n, entry) for n, (m, at, entry) in enumerate(seen) if m == mid)
        for (at, n, entry), after in zip(mine, [*mine[1:], None]):
            if entry and (after is None or after[0] - at >= 1000):
                want.append(n)
    assert bounced(spark, *rows) == sorted(want, key=str)


def test_visitor_stats_window_edges_and_sums(spark):
    rows = logs(spark,
                log("a", "2024-01-01 00:00:00", during=5), log("a", "2024-01-01 00:00:09.999", last="x", during=None),
                log("a", "2024-01-01 00:00:10", last="x", during=7))
    metrics = visitors.visitor_metrics(rows, visitors.unique_visitors(rows), visitors.bounces(rows))
    assert values(visitors.visitor_stats(metrics), "stt", "edt", "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum") == [
        ("2024-01-01 00:00:00", "2024-01-01 00:00:10", 1, 2, 1, 1, 5),
        ("2024-01-01 00:00:10", "2024-01-01 00:00:20", 0, 1, 0, 0, 7)]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 9000), st.booleans(), st.sampled_from("01"), st.booleans()),
                min_size=1, max_size=30))
def test_one_pass_equals_one_pass_for_each_metric(spark, seen):
    """Records of a visitor lie on both sides of midnight; some have other keys, some are starts, and times are tied."""
    rows = logs(spark, log(None, ms(D1), seq=98), log("a", None, seq=99), *(
        log(mid, ms("2024-01-01 23:59:55") + at // 100 * 100, last=None if entry else "x", is_new=new, during=at, seq=n,
            start={"entry": "icon"} if begun and at % 3 == 0 else None, vc=f"v{at % 2}")
        for n, (mid, at, entry, new, begun) in enumerate(seen)))
    pages, order = applog.page_logs(rows), ("ts", "seq")
    plain = visitors.visitor_metrics(pages, visitors.unique_visitors(pages, order), visitors.bounces(pages, 1000, order))
    cells = visitors.visitor_cells(rows, "2 seconds", 1000)
    stats = lambda metrics, visits: values(visitors.visitor_stats(visitors.repair_flag(metrics, visits), "2 seconds"), "*")
    assert stats(visitors.cell_metrics(cells, 1000), visitors.cell_visits(cells)) == stats(plain, visitors.first_visits(rows))


def test_cells_keep_order_for_ids_of_any_sign(spark):
    rows = logs(spark, *(log("a", ms(D1), last=None if seq == -5 else "x", seq=seq) for seq in (-(1 << 63), -5, -7)),
                log("b", ms(D1), seq=(1 << 63) - 1), log("b", ms(D1) + 1, last="x", seq=-(1 << 63)))
    metrics = visitors.cell_metrics(visitors.visitor_cells(rows, "10 seconds", 1000), 1000)
    assert values(metrics.filter("uj_ct = 1"), "mid") == [("a",)]


def test_visitor_statistics_scan_the_log_once_and_hash(spark):
    plan = lambda frame: frame._jdf.queryExecution().executedPlan().toString()
    house = Warehouse(spark, "/root/testdata/sf0.001")
    first = plan(visitors.visitor_cells(house.logs, "1 hour", 3_600_000))
    assert first.count("Scan parquet") == 1 and "HashAggregate" in first and "SortAggregate" not in first
    assert "events.parquet" not in plan(house.visitor_stats)


def test_split_and_displays(spark):
    rows = logs(spark,
                log("a", 1, start={"entry": "icon"}, seq=1),
                log("a", 2, page="good_list", displays=[("7", "sku_id"), None, ("8", "activity_id")], seq=2),
                log("a", 3, start={}, seq=3))
    split = applog.split_logs(rows)
    assert values(split.start, "seq") == [(1,)]
    assert values(split.page, "seq") == [(2,), (3,)]
    assert values(split.display, "item", "item_type", "ts", "page_id") == [
        ("7", "sku_id", 2, "good_list"), ("8", "activity_id", 2, "good_list")]


def test_parse(spark):
    raw = spark.createDataFrame(
        [('{"common":{"mid":"m"},"page":{"page_id":"p","during_time":3},"displays":[{"item":"1"},null],"ts":5}',),
         ("not json",)], "value string")
    parsed = applog.parse_logs(raw)
    assert values(parsed, "common.mid", "page.during_time", F.size("displays").alias("n"), "ts") == [
        ("m", 3, 2, 5)]
