"""The registered queries as plain SQL over the given tables, for an independent check."""

from __future__ import annotations

import re

HOUR = 3600000

# Shared sub-queries, by name; a query pulls in those it names and what they need.
VIEWS = {
    "app_log": """
        SELECT event_id AS seq, epoch_us(ts) // 1000 AS ms, CAST(user_id AS VARCHAR) AS mid, k, event_type,
               'v' || (user_id % 3) AS vc, 'ch' || (user_id % 4) AS ch, CAST(user_id % 25 AS VARCHAR) AS ar,
               CASE WHEN user_id % 2 = 0 OR k % 5 = 0 THEN '1' ELSE '0' END AS is_new,
               CASE event_type WHEN 'view' THEN 'good_list' WHEN 'click' THEN 'good_detail'
                    WHEN 'purchase' THEN 'trade' WHEN 'signup' THEN 'home' ELSE 'error' END AS page_id,
               CASE WHEN k % 6 = 0 THEN NULL WHEN k % 6 = 3 THEN '' WHEN k % 3 = 1 THEN 'home'
                    ELSE 'good_list' END AS last_page_id,
               CASE WHEN event_type = 'click' THEN CAST(k AS VARCHAR) END AS item,
               CAST(floor(value * 100) AS BIGINT) AS during_time,
               event_type = 'signup' AND event_id % 2 = 0 AS is_start,
               strftime(ts, '%Y-%m-%d') AS day
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""",
    "first_visit": """
        SELECT mid, strftime(make_timestamp(min(ms) * 1000), '%Y-%m-%d') AS first_day
        FROM app_log WHERE is_new = '1' GROUP BY mid""",
    "repaired": """
        SELECT a.* REPLACE (CASE WHEN a.is_new = '1' AND f.first_day <> a.day THEN '0' ELSE a.is_new END AS is_new)
        FROM app_log a LEFT JOIN first_visit f ON a.mid = f.mid""",
    "page_log": """
        SELECT *, coalesce(last_page_id, '') = '' AS is_entry FROM repaired WHERE NOT is_start""",
    "uniques": """
        SELECT * FROM page_log WHERE is_entry
        QUALIFY row_number() OVER (PARTITION BY mid, day ORDER BY ms, seq) = 1""",
    "bounce": """
        SELECT * FROM (SELECT *, lead(ms) OVER (PARTITION BY mid ORDER BY ms, seq) AS next_ms FROM page_log)
        WHERE is_entry AND (next_ms IS NULL OR next_ms - ms >= 3600000)""",
    "closed_bounce": """
        SELECT * FROM bounce WHERE ms + 3600000 <= (SELECT max(ms) FROM page_log)""",
    "raw_page": """
        SELECT *, seq % 5 AS turn, (ms // 3600000 + 1) * 3600000 AS window_end FROM app_log WHERE NOT is_start""",
    "turn_latest": "SELECT turn AS of, max(ms) AS latest FROM raw_page GROUP BY turn",
    "late_page": """
        SELECT p.* FROM raw_page p
        WHERE window_end <= (SELECT max(latest) FROM turn_latest WHERE of <= p.turn - 2) - 10 * 86400000""",
    "display": """
        SELECT CAST(k AS VARCHAR) AS item, 'sku_id' AS item_type, ms AS ts, page_id FROM page_log WHERE event_type = 'view'
        UNION ALL
        SELECT CAST(k + 1 AS VARCHAR), 'activity_id', ms, page_id FROM page_log WHERE event_type = 'view'""",
    "order_info": """
        SELECT o_orderkey AS id, o_custkey % 26 AS province_id, o_orderstatus AS order_status, o_custkey AS user_id,
               CAST(o_totalprice AS DECIMAL(16,2)) AS total_amount,
               epoch_ms(TIMESTAMP '2024-01-01') + (o_orderkey * 7919) % 2592000 * 1000 AS create_ts
        FROM orders""",
    "order_detail": """
        SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS sku_id,
               CAST(l_extendedprice AS DECIMAL(16,2)) AS order_price, CAST(l_quantity AS BIGINT) AS sku_num,
               'sku ' || l_partkey AS sku_name, l_returnflag, l_linestatus,
               CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * (1 - CAST(l_discount AS DECIMAL(16,2))) AS DECIMAL(16,2))
                   AS split_total_amount,
               epoch_ms(TIMESTAMP '2024-01-01') + (l_orderkey * 7919) % 2592000 * 1000
                   + ((l_partkey + l_linenumber) % 15 - 7) * 1000 AS create_ts
        FROM lineitem""",
    "payment_info": """
        SELECT id AS payment_id, id AS order_id, user_id, total_amount, 'order ' || id AS subject,
               '110' || (id % 3 + 1) AS payment_type, create_ts, create_ts + id * 37 % 3600 * 1000 AS callback_ts
        FROM order_info WHERE order_status = 'F'""",
    "products": """
        SELECT p_partkey AS sku, p_name AS sku_name, CAST(p_retailprice AS DECIMAL(16,2)) AS sku_price,
               CAST('0x' || substr(md5(p_name), 1, 12) AS BIGINT) AS spu_id, p_name AS spu_name,
               CAST('0x' || substr(md5(p_type), 1, 12) AS BIGINT) AS category3_id, p_type AS category3_name,
               CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS BIGINT) AS tm_id, p_brand AS tm_name
        FROM part""",
    "wide": """
        SELECT d.order_id, d.id AS detail_id, d.sku_id, o.user_id, o.province_id, o.order_status, d.sku_num,
               o.create_ts, d.order_price, d.split_total_amount, o.total_amount
        FROM order_detail d JOIN order_info o ON d.order_id = o.id AND abs(d.create_ts - o.create_ts) <= 5000""",
    "paid": """
        SELECT p.payment_id, p.order_id, w.detail_id, w.sku_id, p.user_id, p.payment_type, p.subject,
               p.create_ts AS payment_ts, p.callback_ts, w.create_ts AS order_ts, w.split_total_amount, p.total_amount
        FROM payment_info p JOIN wide w ON p.order_id = w.order_id
             AND w.create_ts BETWEEN p.callback_ts - 1800000 AND p.callback_ts""",
    "visitor_metric": """
        SELECT vc, ch, ar, is_new, ms, 0 AS uv, 1 AS pv, CASE WHEN is_entry THEN 1 ELSE 0 END AS sv, 0 AS uj,
               during_time AS dur FROM page_log
        UNION ALL SELECT vc, ch, ar, is_new, ms, 1, 0, 0, 0, 0 FROM uniques
        UNION ALL SELECT vc, ch, ar, is_new, ms, 0, 0, 0, 1, 0 FROM {bounces}""",
    "visitor_stats": """
        SELECT {stt_hour} AS stt, {edt_hour} AS edt, ms // 3600000 AS hour_no, vc, ch, ar, is_new,
               CAST(sum(uv) AS BIGINT) AS uv_ct, CAST(sum(pv) AS BIGINT) AS pv_ct, CAST(sum(sv) AS BIGINT) AS sv_ct,
               CAST(sum(uj) AS BIGINT) AS uj_ct, CAST(sum(dur) AS BIGINT) AS dur_sum
        FROM visitor_metric GROUP BY ms // 3600000, vc, ch, ar, is_new""",
    "metric": """
        SELECT k AS sku_id, ms, NULL AS ref_kind, CAST(NULL AS BIGINT) AS ref_id, 0 AS display_ct, 1 AS click_ct,
               0 AS cart_ct, 0 AS favor_ct, 0 AS order_sku_num, 0 AS comment_ct, 0 AS good_comment_ct,
               0.00 AS order_amount, 0.00 AS payment_amount, 0.00 AS refund_amount
        FROM page_log WHERE event_type = 'click'
        UNION ALL SELECT k, ms, NULL, NULL, 1, 0, 0, 0, 0, 0, 0, 0, 0, 0 FROM page_log WHERE event_type = 'view'
        UNION ALL SELECT k, ms // 1000 * 1000, NULL, NULL, 0, 0, 0, 1, 0, 0, 0, 0, 0, 0 FROM app_log
                  WHERE event_type = 'signup'
        UNION ALL SELECT k, ms // 1000 * 1000, NULL, NULL, 0, 0, 1, 0, 0, 0, 0, 0, 0, 0 FROM app_log
                  WHERE event_type = 'purchase'
        UNION ALL SELECT sku_id, create_ts, 'refund', order_id, 0, 0, 0, 0, 0, 0, 0, 0, 0, split_total_amount
                  FROM order_detail WHERE l_returnflag = 'R'
        UNION ALL SELECT sku_id, create_ts, NULL, NULL, 0, 0, 0, 0, 0, 1,
                         CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END, 0, 0, 0
                  FROM order_detail WHERE l_returnflag = 'A'
        UNION ALL SELECT sku_id, create_ts, 'order', order_id, 0, 0, 0, 0, sku_num, 0, 0, split_total_amount, 0, 0 FROM wide
        UNION ALL SELECT sku_id, callback_ts, 'paid', order_id, 0, 0, 0, 0, 0, 0, 0, 0, split_total_amount, 0 FROM paid""",
    "product_stats": """
        SELECT {stt_hour} AS stt, {edt_hour} AS edt, ms // 3600000 AS hour_no, sku_id,
               {count_sums},
               CAST(sum(order_amount) AS DOUBLE) AS order_amount, CAST(sum(payment_amount) AS DOUBLE) AS payment_amount,
               CAST(sum(refund_amount) AS DOUBLE) AS refund_amount,
               count(DISTINCT CASE WHEN ref_kind = 'order' THEN ref_id END) AS order_ct,
               count(DISTINCT CASE WHEN ref_kind = 'paid' THEN ref_id END) AS paid_order_ct,
               count(DISTINCT CASE WHEN ref_kind = 'refund' THEN ref_id END) AS refund_order_ct
        FROM metric GROUP BY ms // 3600000, sku_id""",
    "product_stats_named": """
        SELECT s.*, p.sku_name, CAST(p.sku_price AS DOUBLE) AS sku_price, p.spu_id, p.spu_name, p.tm_id, p.tm_name,
               p.category3_id, p.category3_name
        FROM product_stats s LEFT JOIN products p ON s.sku_id = p.sku""",
    "sales": """
        SELECT w.create_ts // 3600000 AS hour_no, p.*, sum(w.split_total_amount) AS order_amount,
               count(DISTINCT w.order_id) AS order_ct
        FROM wide w LEFT JOIN products p ON w.sku_id = p.sku GROUP BY ALL""",
    "province_stats": """
        SELECT strftime(make_timestamp(create_ts // 3600000 * 3600000000), '%Y-%m-%d %H:%M:%S') AS stt,
               strftime(make_timestamp((create_ts // 3600000 + 1) * 3600000000), '%Y-%m-%d %H:%M:%S') AS edt,
               create_ts // 3600000 AS hour_no, w.province_id, n_name AS province_name,
               CAST(n_regionkey AS VARCHAR) AS area_code, 'N' || n_nationkey AS iso_code,
               'X-' || n_nationkey AS iso_3166_2, count(DISTINCT order_id) AS order_count,
               CAST(sum(split_total_amount) AS DOUBLE) AS order_amount
        FROM wide w LEFT JOIN nation ON w.province_id = n_nationkey GROUP BY ALL""",
    "keyword_stats": """
        SELECT {stt_hour} AS stt, {edt_hour} AS edt, ms // 3600000 AS hour_no, keyword, count(*) AS ct,
               'SEARCH' AS source
        FROM (SELECT ms, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS keyword
              FROM search)
        GROUP BY ms // 3600000, keyword""",
    "search": """
        SELECT doc_id AS seq, text, epoch_ms(TIMESTAMP '2024-01-01') + (doc_id * 7919) % 2592000 * 1000 AS ms
        FROM documents""",
    "keyword_source": """
        SELECT keyword, CAST(sum(weight) AS BIGINT) AS ct, count(*) AS raw
        FROM (SELECT unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS keyword,
                     CASE doc_id % 5 WHEN 0 THEN 10 WHEN 1 THEN 5 WHEN 2 THEN 2 WHEN 3 THEN 1 ELSE 0 END AS weight
              FROM documents)
        GROUP BY keyword""",
    "change": """
        SELECT o_orderkey AS seq, 'orders' AS src_table, o_orderkey % 4 AS turn, CAST(o_orderkey AS VARCHAR) AS id,
               CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS VARCHAR) AS total_amount, NULL AS sku_id,
               o_orderstatus AS order_status, NULL AS name, NULL AS segment, 4 AS n_columns FROM orders
        UNION ALL SELECT l_orderkey, 'lineitem', l_orderkey % 4, NULL, NULL, CAST(l_partkey AS VARCHAR), NULL, NULL, NULL, 2
                  FROM lineitem
        UNION ALL SELECT c_custkey, 'customer', c_custkey % 4, CAST(c_custkey AS VARCHAR), NULL, NULL, NULL, c_name,
                         c_mktsegment, 4 FROM customer""",
    "latest_rule": """
        SELECT lower(p_brand) AS source_table,
               CASE p_partkey % 3 WHEN 0 THEN 'insert' WHEN 1 THEN 'update' ELSE 'delete' END AS operate_type,
               CASE WHEN p_size % 2 = 0 THEN 'hbase' ELSE 'kafka' END AS sink_type,
               'dwd_' || replace(p_name, ' ', '_') AS sink_table, 'id,' || lower(p_type) AS sink_columns
        FROM part WHERE p_partkey % 50 <> 49
        QUALIFY row_number() OVER (PARTITION BY p_brand, p_partkey % 3 ORDER BY p_partkey DESC) = 1""",
    "clean_change": """
        SELECT *, CASE turn WHEN 1 THEN 'update' ELSE 'insert' END AS op_type FROM change WHERE turn <> 2""",
    "routed": """
        SELECT *, CASE WHEN src_table = 'customer' THEN 'dim' WHEN src_table = 'orders' THEN 'fact'
                       ELSE 'unrouted' END AS outcome,
               CASE WHEN src_table = 'customer' THEN 'dim_user_info'
                    WHEN src_table = 'orders' AND op_type = 'insert' THEN 'dwd_order_info'
                    WHEN src_table = 'orders' THEN 'dwd_order_info_update' END AS sink_table
        FROM clean_change""",
}


def _window(ms: str) -> dict[str, str]:
    hour = f"{ms} // 3600000"
    text = "strftime(make_timestamp({} * 3600000000), '%Y-%m-%d %H:%M:%S')"
    return {"stt_hour": text.format(f"({hour})"), "edt_hour": text.format(f"({hour} + 1)")}


COUNTS = ("display_ct", "click_ct", "cart_ct", "favor_ct", "order_sku_num", "comment_ct", "good_comment_ct")
AT = "strftime(make_timestamp({} * 1000), '%Y-%m-%d %H:%M:%S')"


def _sql(body: str, bounces: str = "bounce") -> str:
    """``body`` with the shared views it needs in front."""
    fill = {
        **_window("ms"), "bounces": bounces,
        "count_sums": ", ".join(f"CAST(sum({name}) AS BIGINT) AS {name}" for name in COUNTS),
    }
    texts = {name: view.format(**fill) for name, view in VIEWS.items()}
    needed: list[str] = []

    def add(sql: str) -> None:
        for name in texts:
            if name not in needed and re.search(rf"\b(FROM|JOIN) {name}\b", sql):
                add(texts[name])
                needed.append(name)

    add(body)
    shared = ",\n".join(f"{name} AS ({texts[name]})" for name in needed)
    return f"WITH {shared}\n{body}" if needed else body


WIDE = f"""order_id, detail_id, sku_id, user_id, province_id, order_status, sku_num,
    {AT.format('create_ts')} AS create_time, substr({AT.format('create_ts')}, 12, 2) AS create_hour,
    CAST(order_price AS DOUBLE) AS order_price, CAST(split_total_amount AS DOUBLE) AS split_total_amount,
    CAST(total_amount AS DOUBLE) AS total_amount"""
PAID = f"""SELECT payment_id, order_id, detail_id, sku_id, user_id, payment_type, subject,
    {AT.format('payment_ts')} AS payment_create_time, {AT.format('callback_ts')} AS callback_time,
    {AT.format('order_ts')} AS order_create_time, CAST(split_total_amount AS DOUBLE) AS split_total_amount,
    CAST(total_amount AS DOUBLE) AS total_amount FROM paid"""
AGE = "CAST(floor(date_diff('day', DATE '1960-01-01' + CAST(c_custkey % 15000 AS INTEGER), DATE '2024-01-01') / 365) AS INTEGER)"
PROVINCE_JOIN = "LEFT JOIN nation ON province_id = n_nationkey"
VISIT = f"SELECT seq, mid, {AT.format('ms')} AS at FROM "
VISITOR = "SELECT stt, edt, vc, ch, ar, is_new, uv_ct, pv_ct, sv_ct, uj_ct, dur_sum FROM visitor_stats"
PROVINCE = """SELECT stt, edt, province_id, province_name, area_code, iso_code, iso_3166_2, order_count, order_amount
    FROM province_stats"""
KEYWORD = "SELECT stt, edt, keyword, ct, source FROM keyword_stats"
PRODUCT = "SELECT * EXCLUDE (hour_no) FROM product_stats_named"


def _closed(latest: str, delay_ms: int = 3000) -> str:
    return f" WHERE (hour_no + 1) * {HOUR} <= (SELECT {latest}) - {delay_ms}"


def _damaged(body: str) -> str:
    """``body`` over the logs without every eleventh line, which is broken."""
    return _sql(body).replace("AS k FROM events)", "AS k FROM events WHERE event_id % 11 <> 3)")


def _segments() -> str:
    """From its end to its start, each run carries the cost of the best cut of every rest (a million for a letter in
    no word, one for a word) and the length of the word it begins with, 0 for a letter in none."""
    is_word = "regexp_full_match({}, '[bcdfghjklmnpqrstvwxyz][aeiou]([bcdfghjklmnpqrstvwxyz][aeiou]?)?')"
    takes = ", ".join(
        f"CASE WHEN pos + {n - 1} <= length(run) AND {is_word.format(f'substr(run, pos, {n})')} THEN "
        f"(coalesce(costs[{n}], 0) + 1) * 10 + {9 - n} END" for n in (4, 3, 2))
    return f"""WITH RECURSIVE runs AS (
        SELECT run, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS run FROM documents) GROUP BY run),
      cut AS (
        SELECT run, n, length(run) AS pos, CAST([] AS BIGINT[]) AS costs, CAST([] AS INTEGER[]) AS steps FROM runs
        UNION ALL
        SELECT run, n, pos - 1, list_prepend(choice // 10, costs),
               list_prepend(CAST(CASE WHEN choice % 10 = 9 THEN 0 ELSE 9 - choice % 10 END AS INTEGER), steps)
        FROM (SELECT *, list_min([x for x in [(coalesce(costs[1], 0) + 1000000) * 10 + 9, {takes}] if x IS NOT NULL]) AS choice
              FROM cut WHERE pos > 0)),
      walk AS (
        SELECT run, n, steps, 1 AS pos, 1 AS plain, CAST([] AS VARCHAR[]) AS words FROM cut WHERE pos = 0
        UNION ALL
        SELECT run, n, steps, pos + greatest(step, 1), CASE WHEN step > 0 THEN pos + step ELSE plain END,
               CASE WHEN step = 0 THEN words WHEN plain < pos THEN words || [substr(run, plain, pos - plain), substr(run, pos, step)]
                    ELSE words || [substr(run, pos, step)] END
        FROM (SELECT *, steps[pos] AS step FROM walk WHERE pos <= length(run))),
      found AS (
        SELECT n, unnest(CASE WHEN plain < pos THEN words || [substr(run, plain)] ELSE words END) AS keyword
        FROM walk WHERE pos > length(run))
      SELECT keyword, CAST(sum(n) AS BIGINT) AS ct, CAST(sum(n) AS BIGINT) AS sql_ct FROM found GROUP BY keyword"""


def _late() -> str:
    """A window is closed by a batch when it ends ten days before the latest of all earlier batches; what comes for
    it in a batch after that is late."""
    return _sql(f"""SELECT 'row' AS kind, CAST(turn AS INTEGER) AS batch, mid || '/' || seq AS mid, {AT.format('ms')} AS at,
               CAST(1 AS BIGINT) AS n FROM late_page
        UNION ALL SELECT 'dropped', CAST(batch AS INTEGER), NULL, NULL, count(DISTINCT (ms // {HOUR}, vc, ch, ar, is_new)) FILTER (WHERE seq IS NOT NULL)
        FROM range(5) AS batches(batch) LEFT JOIN late_page ON turn = batch GROUP BY batch""")


def _top(keys: str, extra: str = "") -> str:
    return f"""SELECT {keys}, CAST(sum(order_amount) AS DOUBLE) AS order_amount{extra} FROM sales
        GROUP BY {keys} HAVING sum(order_amount) > 0 ORDER BY sum(order_amount) DESC, {keys} LIMIT 5"""


DAY_NO = 19725  # 2024-01-03, in days since 1970
OF_DAY = f" WHERE hour_no // 24 = {DAY_NO}"


def _pivot(which: str = "") -> str:
    def row(name: str, value: str) -> str:
        def of(flag: str) -> str:
            return f"coalesce((SELECT CAST({value} AS DOUBLE) FROM totals WHERE is_new = '{flag}'), 0.0)"
        return f"SELECT '{name}' AS type, {of('0')} AS old, {of('1')} AS new"

    half_up = "CASE WHEN sv = 0 THEN 0 ELSE (2 * {} * {} + sv) // (2 * sv) / {} END"
    whole_ms = "((2 * dur + sv) // (2 * sv))"
    tenths = f"CASE WHEN sv = 0 THEN 0 ELSE ({whole_ms} + 50) // 100 / 10.0 END"
    rows = [
        row("visitors", "uv"), row("page_views", "pv"), row("bounce_rate", half_up.format(10000, "uj", "100.0")),
        row("seconds_per_session", tenths), row("pages_per_session", half_up.format(100, "pv", "100.0")),
    ]
    totals = f"""(SELECT is_new, sum(uv_ct) AS uv, sum(pv_ct) AS pv, sum(sv_ct) AS sv, sum(uj_ct) AS uj,
        sum(dur_sum) AS dur FROM visitor_stats{which} GROUP BY is_new)"""
    return "\nUNION ALL ".join(rows).replace("FROM totals", f"FROM {totals}")


ORACLES = {
    "log_route_split": _sql("SELECT seq, mid, CASE WHEN is_start THEN 'start' ELSE 'page' END AS route FROM app_log"),
    "display_explode": _sql("SELECT item, item_type, ts, page_id FROM display"),
    "raw_log_parse": _sql("""SELECT mid, is_new, page_id, last_page_id, item, during_time,
        CASE WHEN event_type = 'view' THEN 3 ELSE 0 END::BIGINT AS shown, ms AS ts FROM app_log"""),
    "time_conversions": _sql(f"""SELECT seq, day, {AT.format('ms')} AS at, ms // 1000 * 1000 AS at_ms,
        {AT.format('ms')} AS second, strftime(make_timestamp(ms * 1000), '%H') AS hour FROM app_log"""),
    "cdc_flatten": _sql("""SELECT seq, src_table, 'mart' AS src_db,
        CASE turn WHEN 0 THEN 'insert' WHEN 1 THEN 'update' WHEN 2 THEN 'delete' ELSE 'bootstrap-insert' END AS op_type,
        CASE WHEN turn = 2 THEN 0 ELSE n_columns END::BIGINT AS n_columns,
        CASE WHEN turn <> 2 THEN id END AS id, CASE WHEN turn <> 2 THEN total_amount END AS total_amount,
        CASE WHEN turn <> 2 THEN sku_id END AS sku_id FROM change"""),
    "cdc_clean": _sql("SELECT seq, src_table, op_type FROM clean_change"),
    "route_by_config": _sql("SELECT seq, src_table, op_type, outcome, sink_table FROM routed"),
    "route_column_trim": _sql("""SELECT seq, src_table, op_type, sink_table, id,
        CASE WHEN src_table = 'orders' AND op_type = 'insert' THEN 'id,order_status,total_amount,user_id'
             WHEN src_table = 'orders' THEN 'id,order_status'
             WHEN op_type = 'insert' THEN 'id,name,segment' ELSE 'id,segment' END AS kept
        FROM routed WHERE outcome <> 'unrouted'"""),
    "fact_messages": _sql("""SELECT sink_table AS topic, CASE WHEN op_type = 'insert'
        THEN '{"id":"' || id || '","user_id":"' || user_id || '","order_status":"' || order_status
             || '","total_amount":"' || total_amount || '"}'
        ELSE '{"id":"' || id || '","order_status":"' || order_status || '"}' END AS value
        FROM routed JOIN (SELECT o_orderkey, o_custkey AS user_id FROM orders) ON seq = o_orderkey
        WHERE outcome = 'fact'"""),
    "config_latest": _sql("SELECT * FROM latest_rule"),
    "dim_table_columns": _sql("""SELECT sink_table, i - 1 AS position, string_split(sink_columns, ',')[i] AS "column",
        i = 1 AS is_key FROM latest_rule, (VALUES (1), (2)) AS place(i)
        WHERE sink_type = 'hbase' AND operate_type = 'insert'"""),
    "dim_upsert_latest": """SELECT CAST(coalesce(c_custkey, k) AS VARCHAR) AS id, c_name AS name,
        coalesce(latest, c_mktsegment) AS segment
        FROM customer FULL JOIN (SELECT o_custkey AS k, arg_max(o_orderpriority, o_orderkey) AS latest
                                 FROM orders GROUP BY o_custkey) ON c_custkey = k""",
    "is_new_repair": _sql("SELECT seq, mid, is_new FROM repaired"),
    "unique_visitor_daily": _sql(VISIT + "uniques"),
    "bounce_detail": _sql(VISIT + "bounce"),
    "visitor_stats_window": _sql(VISITOR),
    "order_wide_interval": _sql(f"SELECT {WIDE} FROM wide"),
    "order_wide_dims": _sql(f"""SELECT order_id, detail_id, sku_name, {AGE} AS user_age,
        CASE WHEN c_custkey % 2 = 0 THEN 'M' WHEN c_custkey % 2 = 1 THEN 'F' END AS user_gender,
        n_name AS province_name, 'N' || n_nationkey AS province_iso_code,
        CAST(n_regionkey AS VARCHAR) AS province_area_code, 'X-' || n_nationkey AS province_3166_2_code,
        spu_id, spu_name, category3_id, category3_name, tm_id, tm_name
        FROM wide LEFT JOIN customer ON user_id = c_custkey {PROVINCE_JOIN} LEFT JOIN products ON sku_id = sku"""),
    "payment_wide_interval": _sql(PAID),
    "order_wide_merge": _sql(f"""SELECT d.order_id, d.id AS detail_id, d.sku_id,
        CASE WHEN d.sku_id % 2 = 0 THEN 'kept' ELSE o.order_status END AS order_status,
        {AT.format('o.create_ts')} AS create_time, o.user_id, CAST(o.total_amount AS DOUBLE) AS total_amount,
        CAST(d.split_total_amount AS DOUBLE) AS split_total_amount
        FROM order_detail d LEFT JOIN order_info o ON d.order_id = o.id"""),
    "product_metric_union": _sql(f"""SELECT sku_id, {AT.format('ms')} AS at, ref_kind, ref_id,
        {', '.join(f'CAST({name} AS BIGINT) AS {name}' for name in COUNTS)},
        CAST(order_amount AS DOUBLE) AS order_amount, CAST(payment_amount AS DOUBLE) AS payment_amount,
        CAST(refund_amount AS DOUBLE) AS refund_amount FROM metric"""),
    "product_stats_window": _sql(PRODUCT),
    "province_stats_window": _sql(PROVINCE),
    "keyword_stats_window": _sql(KEYWORD),
    "keyword_stats_sql": _sql(KEYWORD),
    "gmv_daily": _sql("""SELECT strftime(make_timestamp(hour_no * 3600000000), '%Y-%m-%d') AS day,
        CAST(sum(order_amount) AS DOUBLE) AS order_amount FROM sales GROUP BY 1"""),
    "gmv_top_brand": _sql(_top("tm_id, tm_name")),
    "gmv_top_category": _sql(_top("category3_id, category3_name")),
    "gmv_top_spu": _sql(_top("spu_id, spu_name", ", CAST(sum(order_ct) AS BIGINT) AS order_ct")),
    "province_amount": _sql(f"""SELECT province_id, n_name AS province_name,
        CAST(sum(split_total_amount) AS DOUBLE) AS order_amount FROM wide {PROVINCE_JOIN} GROUP BY ALL"""),
    "visitor_totals": _sql("""SELECT is_new, CAST(sum(uv_ct) AS BIGINT) AS uv_ct, CAST(sum(pv_ct) AS BIGINT) AS pv_ct,
        CAST(sum(sv_ct) AS BIGINT) AS sv_ct, CAST(sum(uj_ct) AS BIGINT) AS uj_ct,
        CAST(sum(dur_sum) AS BIGINT) AS dur_sum FROM visitor_stats GROUP BY is_new"""),
    "visitor_new_vs_old": _sql(_pivot()),
    "visitor_by_hour": _sql("""SELECT lpad(CAST(h AS VARCHAR), 2, '0') AS hr,
        CAST(coalesce(sum(pv_ct), 0) AS BIGINT) AS pv_ct, CAST(coalesce(sum(uv_ct), 0) AS BIGINT) AS uv_ct,
        CAST(coalesce(sum(CASE WHEN is_new = '1' THEN uv_ct ELSE 0 END), 0) AS BIGINT) AS new_uv
        FROM range(24) AS hours(h) LEFT JOIN visitor_stats ON hour_no % 24 = h GROUP BY h"""),
    "keyword_score": _sql("SELECT keyword, ct FROM keyword_source ORDER BY raw, keyword LIMIT 5"),
    "keyword_score_popular": _sql("SELECT keyword, ct FROM keyword_source ORDER BY raw DESC, keyword LIMIT 20"),
    "stream_log_split": _sql("""
        SELECT CASE WHEN is_start THEN 'dwd_start_log' ELSE 'dwd_page_log' END AS topic, seq, is_new AS detail FROM repaired
        UNION ALL SELECT 'dwd_display_log', ts, page_id || '/' || item_type || '/' || item FROM display"""),
    "bad_log_lines": _damaged("""
        SELECT CASE event_id % 33 WHEN 3 THEN '{"common": {"mid": "' || event_id WHEN 14 THEN '[' || event_id || ']' ELSE '' END AS line,
               count(*) AS ct FROM events WHERE event_id % 11 = 3 GROUP BY line
        UNION ALL SELECT 'page ' || page_id, count(*) FROM page_log GROUP BY page_id"""),
    "stream_text_split": _damaged("""
        SELECT CASE WHEN is_start THEN 'dwd_start_log' ELSE 'dwd_page_log' END AS topic, CAST(seq AS VARCHAR) AS line,
               is_new AS detail FROM repaired
        UNION ALL SELECT 'bad_log_line', CASE event_id % 33 WHEN 3 THEN '{"common": {"mid": "' || event_id
               WHEN 14 THEN '[' || event_id || ']' ELSE '' END, NULL FROM events WHERE event_id % 11 = 3"""),
    "stream_late_rows": _late(),
    "keyword_segments": _segments(),
    "stream_dim_lookup": """SELECT o_orderkey AS order_id, o_custkey AS user_id, c_name AS name,
        coalesce(latest, c_mktsegment) AS segment FROM orders LEFT JOIN customer ON c_custkey = o_custkey
        LEFT JOIN (SELECT o_custkey AS k, arg_max(o_orderpriority, o_orderkey) AS latest FROM orders GROUP BY o_custkey) ON k = o_custkey""",
    "stream_unique_visitor": _sql(VISIT + "uniques"),
    "stream_bounce": _sql(VISIT + "closed_bounce"),
    "stream_visitor_stats": _sql(VISITOR + _closed("max(ms) FROM visitor_metric"), "closed_bounce"),
    "stream_keyword_stats": _sql(KEYWORD + _closed(
        "max(ms) FROM search")),
    "stream_order_wide": _sql(f"""SELECT {WIDE}, {AGE} AS user_age, n_name AS province_name, tm_name
        FROM wide LEFT JOIN customer ON user_id = c_custkey {PROVINCE_JOIN} LEFT JOIN products ON sku_id = sku"""),
    "stream_payment_wide": _sql(PAID),
    "stream_product_stats": _sql(PRODUCT + _closed("max(ms) FROM metric")),
    "stream_province_stats": _sql(PROVINCE + _closed("max(create_ts) FROM wide", 0)),
    "stream_cdc_route": _sql("""SELECT sink_table, id, order_status AS detail FROM routed WHERE outcome = 'fact'
        UNION ALL SELECT 'unrouted', src_table, op_type FROM routed WHERE outcome = 'unrouted'
        UNION ALL SELECT sink_table, id, CASE WHEN op_type = 'insert' THEN name || '/' || segment ELSE segment END
                  FROM routed WHERE outcome = 'dim'"""),
}

# One day of a stored table.
ORACLES |= {
    "gmv_of_day": _sql(f"""SELECT 20240103 AS day, CAST(coalesce(sum(order_amount), 0) AS DOUBLE) AS order_amount
        FROM sales{OF_DAY} UNION ALL SELECT 20230101, 0.0"""),
    "gmv_top_brand_of_day": _sql(_top("tm_id, tm_name").replace("FROM sales", f"FROM sales{OF_DAY}")),
    "gmv_top_category_of_day": _sql(_top("category3_id, category3_name").replace("FROM sales", f"FROM sales{OF_DAY}")),
    "gmv_top_spu_of_day": _sql(_top("spu_id, spu_name", ", CAST(sum(order_ct) AS BIGINT) AS order_ct").replace(
        "FROM sales", f"FROM sales{OF_DAY}")),
    "province_amount_of_day": _sql(f"""SELECT province_id, n_name AS province_name,
        CAST(sum(split_total_amount) AS DOUBLE) AS order_amount FROM wide {PROVINCE_JOIN}
        WHERE create_ts // 86400000 = {DAY_NO} GROUP BY ALL"""),
    "visitor_totals_of_day": ORACLES["visitor_totals"].replace(
        "FROM visitor_stats GROUP BY is_new", f"FROM visitor_stats{OF_DAY} GROUP BY is_new"),
    "visitor_new_vs_old_of_day": _sql(_pivot(OF_DAY)),
    "visitor_by_hour_of_day": ORACLES["visitor_by_hour"].replace(
        "hour_no % 24 = h", f"hour_no % 24 = h AND hour_no // 24 = {DAY_NO}"),
    "keyword_dictionary": """SELECT keyword, count(*) AS ct FROM (SELECT unnest(regexp_extract_all(regexp_replace(
        lower(text), '(tion|then|ing|the|ent|er|ó)', ' \\1 ', 'g'), '[\\p{L}\\p{N}]+')) AS keyword FROM documents) GROUP BY keyword""",
    "view_messages": _sql(f"""SELECT 'dwm_unique_visitor' AS topic, '{{"mid":"' || mid || '","at":"' || {AT.format('ms')}
        || '"}}' AS value FROM uniques"""),
    "declared_view_stats": _sql("""SELECT strftime(make_timestamp(create_ts // 3600000 * 3600000000), '%Y-%m-%d %H:%M:%S') AS stt,
        order_status, count(*) AS orders, CAST(sum(total_amount) AS DOUBLE) AS total_amount FROM order_info
        GROUP BY create_ts // 3600000, order_status"""),
    "keyword_score_of_day": _sql(f"""SELECT keyword, CAST(10 * sum(ct) AS BIGINT) AS ct FROM keyword_stats{OF_DAY}
        GROUP BY keyword ORDER BY sum(ct) DESC, keyword LIMIT 20"""),
}
