"""SQL twins of the registered queries, written for DuckDB and independent of the Spark plans."""

from __future__ import annotations

SEC = 1_000_000
MIN = 60 * SEC
HOUR = 60 * MIN
DAY = 24 * HOUR

VIEWS = {
    "e": """SELECT *, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k, event_id AS seq FROM events""",
    "clicks": """SELECT 'u' || user_id AS user_name, '/' || event_type || '?k=' || k AS url, ts, seq FROM e""",
    "behavior": """SELECT user_id, k AS item_id, k % 10 AS category_id,
        CASE event_type WHEN 'view' THEN 'pv' WHEN 'click' THEN 'cart' WHEN 'purchase' THEN 'buy'
                        WHEN 'error' THEN 'fav' WHEN 'signup' THEN 'uv' END AS behavior, ts, seq FROM e""",
    "pv": "SELECT * FROM behavior WHERE behavior = 'pv'",
    "login": """SELECT user_id, CASE event_type WHEN 'error' THEN 'fail' ELSE 'success' END AS status, ts, seq FROM e""",
    "order_log": """SELECT user_id * 10 + k % 10 AS order_id, user_id,
        CASE event_type WHEN 'signup' THEN 'create' ELSE 'pay' END AS action, ts, seq
        FROM e WHERE event_type IN ('signup', 'purchase')""",
    "pay_log": "SELECT o_orderkey AS tx_id, o_orderdate AS pay_ts FROM orders",
    "receipt_log": "SELECT l_orderkey AS tx_id, min(l_shipdate) AS receipt_ts FROM lineitem GROUP BY 1",
    "ad_click": """SELECT user_id, k % 5 AS ad_id, n_name AS province, r_name AS city, ts, seq
        FROM e JOIN customer ON c_custkey = user_id JOIN nation ON n_nationkey = c_nationkey
        JOIN region ON r_regionkey = n_regionkey WHERE event_type = 'click'""",
    "ad_ranked": """SELECT *, row_number() OVER (PARTITION BY user_id, ad_id, CAST(ts + INTERVAL 8 HOUR AS DATE)
        ORDER BY ts, seq) AS rn FROM ad_click""",
    "marketing": """SELECT user_id, CASE event_type WHEN 'click' THEN 'CLICK' WHEN 'view' THEN 'DOWNLOAD'
          WHEN 'purchase' THEN 'INSTALL' ELSE 'UNINSTALL' END AS behavior,
        CASE k % 3 WHEN 0 THEN 'app store' WHEN 1 THEN 'wechat' ELSE 'weibo' END AS channel, ts, seq
        FROM e WHERE event_type IN ('click', 'view', 'purchase', 'error')""",
    "l": "SELECT user_id, ts AS l_ts, seq AS l_seq FROM e WHERE event_type = 'click'",
    "r": "SELECT user_id, ts AS r_ts, seq AS r_seq FROM e WHERE event_type = 'purchase'",
    "disordered": "SELECT *, event_id + (7919 * event_id) % 50 AS arrival FROM e",
    "wm": """SELECT *, epoch_us(max(ts) OVER (ORDER BY arrival, event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS top_us FROM disordered""",
    # Three micro-batches by arrival; the watermark of one is the newest time of those before, in whole milliseconds, less the delay.
    "slices": f"""SELECT s.slice, (SELECT (max(epoch_us(d.ts)) // 1000) * 1000 - {10 * 60 * 1_000_000} FROM disordered d
        WHERE (d.arrival - a.low) // a.span < s.slice) AS wm_us
        FROM (SELECT unnest(range(3)) AS slice) s, (SELECT min(arrival) AS low, (max(arrival) - min(arrival)) // 3 + 1 AS span FROM disordered) a""",
    "sliced": """SELECT d.*, s.slice, s.wm_us FROM disordered d,
        (SELECT min(arrival) AS low, (max(arrival) - min(arrival)) // 3 + 1 AS span FROM disordered) a, slices s
        WHERE s.slice = (d.arrival - a.low) // a.span""",
}


def sql(body: str, *views: str) -> str:
    names = ["e"] if views else []
    names += [v for v in views if v != "e"]
    if not names:
        return body
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in names) + "\n" + body


def start(us: int, ts: str = "ts") -> str:
    return f"make_timestamp((epoch_us({ts}) // {us}) * {us})"


def end(us: int, ts: str = "ts") -> str:
    return f"make_timestamp((epoch_us({ts}) // {us} + 1) * {us})"


def hop(source: str, columns: str, size: int, slide: int) -> str:
    """Rows copied to each sliding window they are in."""
    return (
        f"SELECT {columns}, make_timestamp((epoch_us(ts) // {slide} + i) * {slide} - {size}) AS window_start, "
        f"make_timestamp((epoch_us(ts) // {slide} + i) * {slide}) AS window_end "
        f"FROM {source}, range(1, {size // slide + 1}) AS t(i)"
    )


def strict(table: str, conditions: list[str], names: list[str], extra: str = "", where: str = "") -> str:
    n = len(conditions)
    leads = ", ".join(
        f"lead({c}, {i}) OVER w AS {c}{i}" for i in range(1, n) for c in ("seq", "ts", "kind")
    )
    cond = " AND ".join([f"kind = '{conditions[0]}'"] + [f"kind{i} = '{conditions[i]}'" for i in range(1, n)])
    cols = ", ".join([f"seq AS {names[0]}_seq"] + [f"seq{i} AS {names[i]}_seq" for i in range(1, n)])
    return (
        f"SELECT user_id, {cols}{extra} FROM (SELECT user_id, seq, ts, kind, {leads} FROM {table} "
        f"WINDOW w AS (PARTITION BY user_id ORDER BY ts, seq)) WHERE {cond}{where}"
    )


KIND_EVENTS = "(SELECT user_id, seq, ts, event_type AS kind FROM e)"
KIND_LOGIN = "(SELECT user_id, seq, ts, status AS kind FROM login)"
FAILS = ["fail1", "fail2", "fail3"]
LOGIN_COLS = ", ts AS first_ts, ts2 AS last_ts"

HASH = """CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END"""


def hashed(col: str) -> str:
    chars = f"list_transform(regexp_extract_all({col}, '(?s).'), lambda c: CAST(unicode(c) AS BIGINT))"
    return f"list_reduce(list_prepend(CAST(0 AS BIGINT), {chars}), lambda a, c: (a * 31 + c) % 4294967296)"


def slots(col: str) -> str:
    chars = f"list_transform(regexp_extract_all({col}, '(?s).'), lambda c: CAST(unicode(c) AS BIGINT))"
    return f"list_reduce(list_prepend(CAST(0 AS BIGINT), {chars}), lambda a, c: (a * 61 + c) % 536870912)"


HOT = (
    "SELECT * FROM (SELECT window_end, {key}, cnt, row_number() OVER (PARTITION BY window_end "
    "ORDER BY cnt DESC, {key}) AS rn FROM c) WHERE rn <= {n}"
)

ORACLE: dict[str, str] = {
    # sources
    "csv_records": sql(
        """SELECT user_id, item_id, CAST(category_id AS INTEGER) AS category_id, behavior,
           epoch_us(ts) // 1000000 AS sec FROM behavior""",
        "behavior",
    ),
    "access_log_parse": sql(
        """SELECT '10.0.0.' || user_id % 256 AS ip, CAST(user_id AS VARCHAR) AS user_id, date_trunc('second', ts) AS ts,
           CASE WHEN event_type IN ('view', 'click') THEN 'GET' ELSE 'POST' END AS method,
           '/' || event_type || '/' || k AS url FROM e WHERE seq % 97 <> 0""",
        "e",
    ),
    "access_log_rejects": "SELECT 'damaged ' || event_id AS line FROM events WHERE event_id % 97 = 0",
    "ddl_table_scan": "SELECT event_id, user_id, event_type, ts FROM events",
    "kafka_payload": sql("SELECT user_name AS key, url AS value FROM clicks", "clicks"),
    "json_to_person": """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(NULL AS VARCHAR) AS sex,
        CAST(NULL AS VARCHAR) AS birthday, 'nation ' || c_nationkey AS address, CAST(NULL AS VARCHAR) AS amount,
        CAST(NULL AS VARCHAR) AS education, c_mktsegment AS job, '555-' || c_custkey AS idphone,
        CAST(NULL AS VARCHAR) AS creditcard FROM customer WHERE c_custkey % 50 <> 0""",
    "json_rejects": """SELECT '{"id":' || c_custkey || ',"name"' AS line FROM customer WHERE c_custkey % 50 = 0""",
    "key_range_scan": """SELECT lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS row_key,
        lpad(CAST(p_partkey AS VARCHAR), 8, '0') || concat_ws('_', p_name, p_brand, p_size) AS row
        FROM part WHERE p_partkey >= 10 AND p_partkey < 1000""",
    "stream_as_table": sql("SELECT item_id AS item, behavior AS action, ts AS rt FROM pv", "behavior", "pv"),
    "event_time_column": "SELECT event_id, epoch_us(ts) // 1000 AS ms, date_trunc('second', ts) AS et FROM events",
    # sinks
    "file_sink_roundtrip": sql("SELECT url, user_name FROM clicks", "clicks"),
    "csv_insert": sql("SELECT url, user_name FROM clicks WHERE user_name = 'u7'", "clicks"),
    "kafka_encode": sql(
        """SELECT user_name AS key, '{"user_name":"' || user_name || '","url":"' || url || '","seq":' || seq || '}' AS value
           FROM clicks""",
        "clicks",
    ),
    "to_documents": sql(
        "SELECT 'clicks-' || strftime(ts, '%Y%m%d') AS index, CAST(seq AS VARCHAR) AS id, url FROM clicks", "clicks"
    ),
    "upsert_latest": sql(
        "SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY user_name ORDER BY ts DESC, seq DESC) AS rn "
        "FROM clicks) WHERE rn = 1",
        "clicks",
    ),
    "upsert_wide_column": sql(
        """SELECT CAST(user_id AS VARCHAR) AS row_key, event_type AS cf1_name, CAST(k AS VARCHAR) AS cf1_age FROM
           (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, seq DESC) AS rn FROM e) WHERE rn = 1""",
        "e",
    ),
    "complete_batches": """SELECT user_id, event_id AS seq, (rn - 1) // 10 AS batch_id FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
               count(*) OVER (PARTITION BY user_id) AS n FROM events) WHERE (rn - 1) // 10 < n // 10""",
    # projections
    "map_project": sql("SELECT user_name FROM clicks", "clicks"),
    "flatmap_fields": sql(
        """SELECT user_name AS field FROM clicks UNION ALL SELECT url FROM clicks
           UNION ALL SELECT CAST(epoch_us(ts) // 1000 AS VARCHAR) FROM clicks""",
        "clicks",
    ),
    "word_pairs": "SELECT unnest(string_split(p_name || ' ' || p_type, ' ')) AS word, CAST(1 AS BIGINT) AS one FROM part",
    "filter_predicates": sql(
        "SELECT user_id, item_id, ts FROM pv WHERE ts > TIMESTAMP '2024-01-02'", "behavior", "pv"
    ),
    "map_length": sql("SELECT user_name, length(user_name) AS len FROM clicks", "clicks"),
    "map_with_setup": sql(
        "SELECT user_name, 'user ' || user_name AS tagged, length(user_name) AS len FROM clicks", "clicks"
    ),
    "table_api_select": sql("SELECT url, user_name FROM clicks WHERE user_name = 'u1'", "clicks"),
    "sql_project_view": sql("SELECT url, user_name FROM clicks WHERE user_name <> 'u1'", "clicks"),
    "hash_concat": sql(
        f"SELECT url, CAST({HASH} AS VARCHAR) || '----' || url AS tagged FROM "
        f"(SELECT url, {hashed('url')} AS h FROM clicks)",
        "clicks",
    ),
    "route_by_value": sql(
        "SELECT CASE WHEN user_name IN ('u1', 'u2') THEN user_name ELSE 'rest' END AS tag, user_name, url, seq FROM clicks",
        "clicks",
    ),
    "custom_partition": f"""SELECT user_id, seq, CAST(abs({HASH} % 4) AS BIGINT) AS pid FROM (SELECT user_id, event_id AS seq,
        {hashed('CAST(user_id AS VARCHAR)')} AS h FROM events)""".replace(
        "CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END % 4",
        "(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) % 4",
    ),
    "range_partition": sql(
        "SELECT k, seq, CAST(CASE WHEN k < 11 THEN 0 WHEN k < 21 THEN 1 ELSE 2 END AS BIGINT) AS pid FROM e", "e"
    ),
    "union_streams": "SELECT user_id, event_type, ts FROM events WHERE event_type IN ('click', 'view')",
    "connect_map": """SELECT 'clicks' AS origin, user_id AS who, ts AS at FROM events WHERE event_type = 'click'
        UNION ALL SELECT 'orders', o_custkey, o_orderdate FROM orders""",
    # joins
    "window_join": sql(
        f"""SELECT user_id, l_seq, r_seq, {start(DAY, 'l_ts')} AS window_start, {end(DAY, 'l_ts')} AS window_end
            FROM l JOIN r USING (user_id) WHERE {start(DAY, 'l_ts')} = {start(DAY, 'r_ts')}""",
        "l",
        "r",
    ),
    "window_cogroup": sql(
        f"""SELECT user_id, window_start, make_timestamp(epoch_us(window_start) + {DAY}) AS window_end,
              CAST(coalesce(sum(l), 0) AS BIGINT) AS l_cnt, CAST(sum(ls) AS BIGINT) AS l_sum,
              CAST(coalesce(sum(r), 0) AS BIGINT) AS r_cnt, CAST(sum(rs) AS BIGINT) AS r_sum
            FROM (SELECT user_id, {start(DAY, 'l_ts')} AS window_start, 1 AS l, l_seq AS ls, 0 AS r, NULL AS rs FROM l
                  UNION ALL SELECT user_id, {start(DAY, 'r_ts')}, 0, NULL, 1, r_seq FROM r)
            GROUP BY user_id, window_start""",
        "l",
        "r",
    ),
    "interval_join": sql(
        """SELECT user_id, l_seq, r_seq, l_ts, r_ts FROM l JOIN r USING (user_id)
           WHERE r_ts BETWEEN l_ts - INTERVAL 6 HOUR AND l_ts + INTERVAL 12 HOUR""",
        "l",
        "r",
    ),
    "pay_match_interval": sql(
        """SELECT tx_id, pay_ts, receipt_ts FROM pay_log JOIN receipt_log USING (tx_id)
           WHERE receipt_ts BETWEEN pay_ts - INTERVAL 300 DAY AND pay_ts + INTERVAL 500 DAY""",
        "pay_log",
        "receipt_log",
    ),
    "history_join": sql("SELECT user_id, l_seq, r_seq FROM l JOIN r USING (user_id)", "l", "r"),
    "history_join_outer": sql(
        """SELECT order_id, l_seq, r_seq FROM (SELECT order_id, seq AS l_seq FROM order_log WHERE action = 'create')
           FULL JOIN (SELECT order_id, seq AS r_seq FROM order_log WHERE action = 'pay') USING (order_id)""",
        "order_log",
    ),
    "rule_pair_match": """SELECT user_id, event_id AS seq, prev AS action1, event_type AS action2 FROM (
        SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)
        WHERE prev IN ('view', 'click') AND event_type = 'purchase'""",
    "rule_pair_match_latest": """SELECT user_id, event_id AS seq, prev AS action1, event_type AS action2 FROM (
        SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)
        WHERE prev = 'click' AND event_type = 'purchase'""",
    "bill_check": sql(
        """SELECT coalesce(p.tx_id, r.tx_id) AS order_id, pay_ts AS app_ts,
             CASE WHEN r.tx_id IS NOT NULL THEN 'success' END AS third_status, receipt_ts AS third_ts,
             CASE WHEN r.tx_id IS NULL THEN 'app_only' WHEN p.tx_id IS NULL THEN 'third_only' ELSE 'matched' END AS tag
           FROM pay_log p FULL JOIN receipt_log r
             ON p.tx_id = r.tx_id AND receipt_ts BETWEEN pay_ts AND pay_ts + INTERVAL 365 DAY""",
        "pay_log",
        "receipt_log",
    ),
    "reconcile_payments": sql(
        """SELECT coalesce(p.tx_id, r.tx_id) AS tx_id, pay_ts, receipt_ts,
             CASE WHEN r.tx_id IS NULL THEN 'order_only' WHEN p.tx_id IS NULL THEN 'receipt_only' ELSE 'matched' END AS tag
           FROM pay_log p FULL JOIN receipt_log r
             ON p.tx_id = r.tx_id AND receipt_ts BETWEEN pay_ts - INTERVAL 300 DAY AND pay_ts + INTERVAL 500 DAY""",
        "pay_log",
        "receipt_log",
    ),
    "lateral_split": """SELECT page_id, word, length(word) AS length FROM (
        SELECT page_id, unnest(string_split(rtrim(url, '?'), '?')) AS word FROM pages)""",
    # aggregations
    "running_count": sql(
        "SELECT user_name, ts, seq, row_number() OVER (PARTITION BY user_name ORDER BY ts, seq) AS cnt FROM clicks", "clicks"
    ),
    "most_active_user": sql(
        """SELECT user_name, cnt FROM (SELECT user_name, count(*) AS cnt, max(ts) AS t, max(seq) AS s FROM clicks GROUP BY 1)
           ORDER BY cnt DESC, t DESC, s DESC LIMIT 1""",
        "clicks",
    ),
    "most_active_running": sql(
        """, n AS (SELECT *, row_number() OVER (PARTITION BY user_name ORDER BY ts, seq) AS n FROM clicks),
           m AS (SELECT ts, seq, max(struct_pack(n := n, t := ts, s := seq, k := user_name))
                 OVER (ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS b FROM n)
           SELECT ts, seq, b.k AS top_user_name, b.n AS cnt FROM m""",
        "clicks",
    ),
    "latest_visit": sql(
        "SELECT user_name, url, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_name ORDER BY ts DESC, seq DESC) AS rn "
        "FROM clicks) WHERE rn = 1",
        "clicks",
    ),
    "sql_group_count": sql("SELECT user_name, count(url) AS cnt FROM clicks GROUP BY 1", "clicks"),
    "changelog_counts": sql(
        """, n AS (SELECT user_name, seq, row_number() OVER (PARTITION BY user_name ORDER BY ts, seq) AS n FROM clicks)
           SELECT user_name, seq, '+I' AS row_kind, n AS cnt FROM n WHERE n = 1
           UNION ALL SELECT user_name, seq, '-U', n - 1 FROM n WHERE n > 1
           UNION ALL SELECT user_name, seq, '+U', n FROM n WHERE n > 1""",
        "clicks",
    ),
    "apply_changelog": sql(
        """SELECT user_id, k AS n, seq FROM (
             SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, seq DESC) AS rn FROM e)
           WHERE rn = 1 AND event_type IN ('signup', 'view', 'purchase')""",
        "e",
    ),
    "weighted_avg": sql(
        """SELECT user_id, CAST(sum(k * CAST(floor(value) AS BIGINT)) // nullif(sum(CAST(floor(value) AS BIGINT)), 0) AS BIGINT)
           AS wavg FROM e GROUP BY user_id""",
        "e",
    ),
    "table_agg_top2": sql(
        f""", c AS (SELECT {start(HOUR)} AS window_start, {end(HOUR)} AS window_end, user_name, count(*) AS cnt
                    FROM clicks GROUP BY ALL)
            SELECT window_start, window_end, cnt AS value, rank FROM (SELECT *, row_number() OVER (
              PARTITION BY window_end ORDER BY cnt DESC, user_name) AS rank FROM c) WHERE rank <= 2""",
        "clicks",
    ),
    "window_count_user": sql(
        f"SELECT {start(HOUR)} AS window_start, {end(HOUR)} AS window_end, user_name, count(*) AS cnt FROM clicks GROUP BY ALL",
        "clicks",
    ),
    "window_avg_ts": sql(
        f"""SELECT {start(DAY)} AS window_start, {end(DAY)} AS window_end, user_name,
              make_timestamp(CAST(sum(epoch_us(ts) // 1000) // count(*) AS BIGINT) * 1000) AS avg_ts FROM clicks
            GROUP BY 1, 2, 3""",
        "clicks",
    ),
    "window_pv_uv": sql(
        f"""SELECT {start(6 * HOUR)} AS window_start, {end(6 * HOUR)} AS window_end, count(*) AS pv,
              count(DISTINCT user_name) AS uv, CAST(count(*) AS DOUBLE) / count(DISTINCT user_name) AS ratio
            FROM clicks GROUP BY 1, 2""",
        "clicks",
    ),
    "window_uv": sql(
        f"""SELECT {start(6 * HOUR)} AS window_start, {end(6 * HOUR)} AS window_end, count(DISTINCT user_name) AS uv
            FROM clicks GROUP BY 1, 2""",
        "clicks",
    ),
    "window_url_count": sql(
        f"""SELECT {start(6 * HOUR)} AS window_start, {end(6 * HOUR)} AS window_end, url, count(*) AS cnt
            FROM clicks GROUP BY ALL""",
        "clicks",
    ),
    "hourly_pv": sql(
        f"SELECT {start(HOUR)} AS window_start, {end(HOUR)} AS window_end, count(*) AS cnt FROM pv GROUP BY 1, 2",
        "behavior",
        "pv",
    ),
    "hourly_uv": sql(
        f"SELECT {start(HOUR)} AS window_start, {end(HOUR)} AS window_end, count(DISTINCT user_id) AS uv FROM pv GROUP BY 1, 2",
        "behavior",
        "pv",
    ),
    "uv_bitmap": sql(
        f"""SELECT {start(HOUR)} AS window_start, {end(HOUR)} AS window_end,
              count(DISTINCT {slots('CAST(user_id AS VARCHAR)')}) AS uv FROM pv GROUP BY 1, 2""",
        "behavior",
        "pv",
    ),
    "uv_running": sql(
        f""", f AS (SELECT *, row_number() OVER (PARTITION BY {end(HOUR)}, user_id ORDER BY ts, seq) AS visit FROM pv)
            SELECT {end(HOUR)} AS window_end, user_id, seq,
              row_number() OVER (PARTITION BY {end(HOUR)} ORDER BY ts, seq) AS uv FROM f WHERE visit = 1""",
        "behavior",
        "pv",
    ),
    "marketing_total": sql(
        f""", w AS ({hop('marketing', "'total' AS name", HOUR, MIN)})
            SELECT window_start, window_end, name, count(*) AS cnt FROM w GROUP BY ALL""",
        "marketing",
    ),
    "marketing_by_channel": sql(
        f""", w AS ({hop('marketing', 'channel, behavior', HOUR, 5 * MIN)})
            SELECT window_start, window_end, channel, behavior, count(*) AS cnt FROM w
            WHERE behavior <> 'UNINSTALL' GROUP BY ALL""",
        "marketing",
    ),
    "ad_clicks_by_province": sql(
        f""", kept AS (SELECT * FROM ad_ranked WHERE rn <= 1), w AS ({hop('kept', 'province', HOUR, 5 * MIN)})
            SELECT window_start, window_end, province, count(*) AS cnt FROM w GROUP BY ALL""",
        "ad_click",
        "ad_ranked",
    ),
    "every_n_average": sql(
        """, n AS (SELECT *, (row_number() OVER (PARTITION BY user_name ORDER BY ts, seq) - 1) // 5 AS batch FROM clicks)
           SELECT user_name, batch, make_timestamp(CAST(sum(epoch_us(ts) // 1000) // 5 AS BIGINT) * 1000) AS avg_ts
           FROM n GROUP BY 1, 2 HAVING count(*) = 5""",
        "clicks",
    ),
    "keyed_state_view": sql(
        """SELECT user_name, seq, url, count(*) OVER w AS list_size, count(*) OVER w AS map_count,
             first_value(url) OVER w AS first_url, ts, 'result ' || count(*) OVER w AS agg_result FROM clicks
           WINDOW w AS (PARTITION BY user_name ORDER BY ts, seq ROWS UNBOUNDED PRECEDING)""",
        "clicks",
    ),
    # windows and late data
    "sliding_count": sql(
        f""", w AS ({hop('behavior', 'category_id', HOUR, 5 * MIN)})
            SELECT window_start, window_end, category_id, count(*) AS cnt FROM w GROUP BY ALL""",
        "behavior",
    ),
    "session_sum": sql(
        f""", m AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) <= {6 * HOUR} THEN 0 ELSE 1 END AS fresh
                    FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, seq)),
              s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS sid FROM m)
            SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end, count(*) AS cnt,
              CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM s GROUP BY user_id, sid""",
        "e",
    ),
    "sql_tumble": sql(
        f"SELECT user_name, {end(HOUR)} AS end_ts, count(url) AS cnt FROM clicks GROUP BY 1, 2", "clicks"
    ),
    "tvf_tumble": sql(
        f"SELECT user_name, seq, {start(10 * SEC)} AS window_start, {end(10 * SEC)} AS window_end FROM clicks", "clicks"
    ),
    "tvf_cumulate": sql(
        f"""SELECT {start(DAY)} AS window_start, make_timestamp((epoch_us(ts) // {DAY}) * {DAY} + i * {HOUR}) AS window_end,
              category_id, count(*) AS cnt FROM behavior, range(1, 25) AS t(i)
            WHERE (epoch_us(ts) % {DAY}) // {HOUR} < i GROUP BY ALL""",
        "behavior",
    ),
    "sql_hop": sql(
        f""", w AS ({hop('pv', 'item_id', HOUR, 5 * MIN)})
            SELECT item_id, window_end, count(*) AS cnt FROM w GROUP BY ALL""",
        "behavior",
        "pv",
    ),
    "manual_window": sql(
        f"""SELECT {start(10 * MIN)} AS window_start, {end(10 * MIN)} AS window_end, user_name, count(*) AS cnt
            FROM clicks GROUP BY ALL""",
        "clicks",
    ),
    "evict_last_n": sql(
        f"""SELECT user_id, window_start, window_end, CAST(sum(k) AS BIGINT) AS total FROM (
              SELECT user_id, k, {start(DAY)} AS window_start, {end(DAY)} AS window_end,
                row_number() OVER (PARTITION BY user_id, {start(DAY)} ORDER BY ts DESC, seq DESC) AS rn FROM e)
            WHERE rn <= 2 GROUP BY ALL""",
        "e",
    ),
    "evict_last_span": sql(
        f"""SELECT user_id, window_start, window_end, CAST(sum(k) AS BIGINT) AS total FROM (
              SELECT user_id, k, ts, {start(DAY)} AS window_start, {end(DAY)} AS window_end,
                max(ts) OVER (PARTITION BY user_id, {start(DAY)}) AS newest FROM e)
            WHERE newest - ts <= INTERVAL 2 HOUR GROUP BY ALL""",
        "e",
    ),
    "late_status": sql(
        f"""SELECT event_id, CASE WHEN top_us IS NULL OR last_end > top_us - {10 * MIN} THEN 'on_time'
              WHEN last_end + {30 * MIN} > top_us - {10 * MIN} THEN 'late_allowed' ELSE 'too_late' END AS status
            FROM (SELECT *, (epoch_us(ts) // {HOUR} + 1) * {HOUR} AS last_end FROM wm)""",
        "disordered",
        "wm",
    ),
    "late_corrected": sql(
        f"""SELECT {start(HOUR)} AS window_start, {end(HOUR)} AS window_end,
              count(*) FILTER (top_us IS NULL OR last_end > top_us - {10 * MIN}) AS first_cnt, count(*) AS cnt
            FROM (SELECT *, (epoch_us(ts) // {HOUR} + 1) * {HOUR} AS last_end FROM wm)
            WHERE top_us IS NULL OR last_end + {30 * MIN} > top_us - {10 * MIN} GROUP BY 1, 2""",
        "disordered",
        "wm",
    ),
    "late_split": sql(
        f"SELECT event_id, arrival, ts FROM wm WHERE (epoch_us(ts) // {HOUR} + 1) * {HOUR} <= top_us - {HOUR}",
        "disordered",
        "wm",
    ),
    "stream_late_rows": sql(
        """SELECT user_id, event_id AS seq, late,
             CASE WHEN NOT late THEN count(*) OVER (PARTITION BY user_id, late ORDER BY ts, event_id) END AS cnt
           FROM (SELECT *, coalesce(epoch_us(ts) <= wm_us, false) AS late FROM sliced)""",
        "disordered",
        "slices",
        "sliced",
    ),
    "stream_late_corrected": sql(
        f""", d AS (
             SELECT k % 3 AS part, slice, (epoch_us(ts) // {HOUR}) * {HOUR} AS w, wm_us FROM sliced
           ), late AS (
             SELECT part, w, 'late' AS row_kind, count(*) AS cnt FROM d WHERE w + {HOUR} + {150 * MIN} <= wm_us GROUP BY part, w, slice
           ), n AS (
             SELECT part, w, slice, count(*) AS c FROM d
             WHERE wm_us IS NULL OR w + {HOUR} + {150 * MIN} > wm_us GROUP BY part, w, slice
           ), fires AS (
             SELECT part, w, coalesce((SELECT min(s.slice) FROM slices s WHERE s.wm_us >= w + {HOUR}), 99) AS at FROM (SELECT DISTINCT part, w FROM n)
           ), later AS (
             SELECT part, w, slice, sum(c) OVER (PARTITION BY part, w ORDER BY slice) AS new, c FROM n
           ), first AS (
             SELECT part, w, min(slice) AS slice FROM n GROUP BY part, w
           ), born AS (
             SELECT f.part, f.w, greatest(f.at, b.slice) AS at FROM fires f JOIN first b USING (part, w)
           ), changes AS (
             SELECT part, w, '+I' AS row_kind, sum(c) AS cnt FROM n JOIN born USING (part, w) WHERE n.slice <= born.at GROUP BY part, w
             UNION ALL SELECT part, w, '-U', new - c FROM later JOIN born USING (part, w) WHERE later.slice > born.at
             UNION ALL SELECT part, w, '+U', new FROM later JOIN born USING (part, w) WHERE later.slice > born.at
             UNION ALL SELECT part, w, row_kind, cnt FROM late
           )
           SELECT part, make_timestamp(w) AS window_start, row_kind, CAST(cnt AS BIGINT) AS cnt FROM changes""",
        "disordered",
        "slices",
        "sliced",
    ),
    "watermark_trace": sql(
        """SELECT event_id, max(ts) OVER (ORDER BY arrival, event_id ROWS UNBOUNDED PRECEDING) - INTERVAL 5 SECOND
           AS watermark FROM disordered""",
        "disordered",
    ),
    "periodic_pv": sql(
        """, f AS (SELECT user_name, min(ts) AS first FROM clicks GROUP BY 1),
           t AS (SELECT user_name, unnest(range(first + INTERVAL 1 DAY, (SELECT max(ts) FROM clicks) + INTERVAL 1 MICROSECOND,
                 INTERVAL 1 DAY)) AS tick FROM f)
           SELECT t.user_name, tick, count(*) AS cnt FROM t JOIN clicks c ON c.user_name = t.user_name AND c.ts <= tick
           GROUP BY 1, 2""",
        "clicks",
    ),
    # top-n
    "hot_items": sql(
        f""", w AS ({hop('pv', 'item_id', HOUR, 5 * MIN)}),
              c AS (SELECT window_end, item_id, count(*) AS cnt FROM w GROUP BY ALL)
            {HOT.format(key='item_id', n=10)}""",
        "behavior",
        "pv",
    ),
    "hot_items_sql": sql(
        f""", w AS ({hop('pv', 'item_id', HOUR, 5 * MIN)}),
              c AS (SELECT window_end, item_id, count(*) AS cnt FROM w GROUP BY ALL)
            {HOT.format(key='item_id', n=5)}""",
        "behavior",
        "pv",
    ),
    "hot_pages": sql(
        f""", g AS (SELECT '/' || k % 20 AS url, ts, top_us FROM wm WHERE event_type = 'view'),
              w AS ({hop('g', 'url, top_us', 10 * MIN, MIN)}),
              c AS (SELECT window_end, url, count(*) AS cnt FROM w
                    WHERE top_us IS NULL OR epoch_us(window_end) > top_us - {2 * MIN} GROUP BY ALL)
            {HOT.format(key='url', n=3)}""",
        "disordered",
        "wm",
    ),
    "hot_pages_late": sql(
        f"""SELECT event_id, arrival, ts FROM wm WHERE event_type = 'view'
            AND (epoch_us(ts) // {MIN}) * {MIN} + {10 * MIN} + {MIN} <= top_us - {MIN}""",
        "disordered",
        "wm",
    ),
    "window_top2_users": sql(
        f""", c AS (SELECT {start(HOUR)} AS window_start, {end(HOUR)} AS window_end, user_name, count(*) AS cnt
                    FROM clicks GROUP BY ALL)
            SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, user_name) AS rn FROM c)
            WHERE rn <= 2""",
        "clicks",
    ),
    # patterns
    "pattern_next": sql(strict(KIND_EVENTS, ["view", "click", "purchase"], ["a", "b", "c"]), "e"),
    "pattern_times": sql(strict(KIND_LOGIN, ["fail"] * 3, FAILS, LOGIN_COLS), "login"),
    "login_fail_alert": sql(
        strict(KIND_LOGIN, ["fail"] * 3, FAILS, LOGIN_COLS, " AND ts2 - ts < INTERVAL 2 DAY"), "login"
    ),
    "login_fail_timer": sql(
        """, o AS (SELECT user_id, ts, status = 'fail' AS bad, row_number() OVER (PARTITION BY user_id ORDER BY ts, seq) AS rn
                   FROM login),
           fold AS (
             SELECT user_id, rn, CASE WHEN bad THEN ts END AS f, CASE WHEN bad THEN ts END AS l,
               CASE WHEN bad THEN 1 ELSE 0 END AS n, CAST(NULL AS TIMESTAMP) AS of, CAST(NULL AS TIMESTAMP) AS ol, 0 AS n_out
             FROM o WHERE rn = 1
             UNION ALL
             SELECT o.user_id, o.rn,
               CASE WHEN NOT bad THEN NULL WHEN f IS NULL OR o.ts > f + INTERVAL 1 DAY THEN o.ts ELSE f END,
               CASE WHEN bad THEN o.ts END,
               CASE WHEN NOT bad THEN 0 WHEN f IS NULL OR o.ts > f + INTERVAL 1 DAY THEN 1 ELSE n + 1 END,
               f, l, CASE WHEN o.ts > f + INTERVAL 1 DAY THEN n ELSE 0 END
             FROM fold JOIN o ON o.user_id = fold.user_id AND o.rn = fold.rn + 1),
           tail AS (SELECT user_id, max(rn) AS rn FROM o GROUP BY 1)
           SELECT user_id, of AS first_ts, ol AS last_ts, CAST(n_out AS BIGINT) AS times FROM fold WHERE n_out >= 3
           UNION ALL SELECT user_id, f, l, CAST(n AS BIGINT) FROM fold JOIN tail USING (user_id, rn) WHERE n >= 3""",
        "login",
    ),
    "pattern_followed_by": sql(
        """, m AS (SELECT a.user_id, a.seq AS a_seq, a.ts, min(b.seq) AS b_seq, min(b.ts) AS b_ts FROM e a
             LEFT JOIN e b ON b.event_type = 'purchase' AND b.user_id = a.user_id AND b.seq > a.seq
             WHERE a.event_type = 'signup' GROUP BY 1, 2, 3)
           SELECT user_id, a_seq, CASE WHEN b_ts - ts < INTERVAL 1 DAY THEN b_seq END AS b_seq,
             CASE WHEN b_ts - ts < INTERVAL 1 DAY THEN 'matched' ELSE 'timeout' END AS status FROM m""",
        "e",
    ),
    "pattern_three_steps": sql(
        """, m AS (SELECT a.user_id, a.seq AS a_seq, a.ts, min(b.seq) AS b_seq FROM e a
             LEFT JOIN e b ON b.event_type = 'click' AND b.user_id = a.user_id AND b.seq > a.seq
             WHERE a.event_type = 'signup' GROUP BY 1, 2, 3),
           n AS (SELECT m.user_id, a_seq, m.ts, b_seq, min(c.seq) AS c_seq, min(c.ts) AS c_ts FROM m
             LEFT JOIN e c ON c.event_type = 'purchase' AND c.user_id = m.user_id AND c.seq > b_seq GROUP BY 1, 2, 3, 4)
           SELECT user_id, a_seq, CASE WHEN c_ts - ts < INTERVAL 3 DAY THEN b_seq END AS b_seq,
             CASE WHEN c_ts - ts < INTERVAL 3 DAY THEN c_seq END AS c_seq,
             CASE WHEN c_ts - ts < INTERVAL 3 DAY THEN 'matched' ELSE 'timeout' END AS status FROM n""",
        "e",
    ),
    "order_timeout": sql(
        """, m AS (SELECT a.order_id, a.seq AS create_seq, a.ts, min(b.seq) AS b_seq, min(b.ts) AS b_ts FROM order_log a
             LEFT JOIN order_log b ON b.action = 'pay' AND b.order_id = a.order_id AND b.seq > a.seq
             WHERE a.action = 'create' GROUP BY 1, 2, 3)
           SELECT order_id, create_seq, CASE WHEN b_ts - ts < INTERVAL 5 DAY THEN b_seq END AS pay_seq,
             CASE WHEN b_ts - ts < INTERVAL 5 DAY THEN 'matched' ELSE 'timeout' END AS status FROM m""",
        "order_log",
    ),
    "ad_blacklist": sql(
        "SELECT user_id, ad_id, seq, 'click over 1 times' AS msg FROM ad_ranked WHERE rn = 2", "ad_click", "ad_ranked"
    ),
    "ad_clicks_kept": sql(
        "SELECT user_id, ad_id, province, ts, seq FROM ad_ranked WHERE rn = 1", "ad_click", "ad_ranked"
    ),
    "order_status": sql(
        """, o AS (SELECT order_id, min(ts) FILTER (action = 'create') AS create_ts, min(ts) FILTER (action = 'pay') AS pay_ts
             FROM order_log GROUP BY 1)
           SELECT *, CASE WHEN pay_ts IS NULL THEN 'created_not_paid' WHEN create_ts IS NULL THEN 'paid_not_created'
             WHEN pay_ts < create_ts THEN 'pay_first' WHEN pay_ts - create_ts < INTERVAL 5 DAY THEN 'paid'
             ELSE 'paid_late' END AS status FROM o""",
        "order_log",
    ),
    "ttl_last_value": """SELECT user_id, event_id AS seq, CASE WHEN ts - t < INTERVAL 6 HOUR THEN prev END AS last_value
        FROM (SELECT *, lag(event_type) OVER w AS prev, lag(ts) OVER w AS t FROM events
              WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))""",
    # functions
    "java_hash": f"SELECT p_partkey, {HASH} AS h FROM (SELECT p_partkey, {hashed('p_name')} AS h FROM part)",
    "udf_from_sql": f"""SELECT page_id, word, length(word) AS length, {HASH} AS h FROM (
        SELECT page_id, word, {hashed('word')} AS h FROM (
          SELECT page_id, unnest(string_split(rtrim(url, '?'), '?')) AS word FROM pages))""",
}
# Streams.
ORACLE["stream_changelog"] = sql(
    """, n AS (SELECT user_id, seq, row_number() OVER (PARTITION BY user_id ORDER BY ts, seq) AS n FROM e)
       SELECT user_id, seq, '+I' AS row_kind, n AS cnt FROM n WHERE n = 1
       UNION ALL SELECT user_id, seq, '-U', n - 1 FROM n WHERE n > 1
       UNION ALL SELECT user_id, seq, '+U', n FROM n WHERE n > 1""",
    "e",
)
ORACLE["stream_every_n"] = sql(
    """, n AS (SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY ts, seq) - 1) // 5 AS batch FROM e)
       SELECT user_id, batch, CAST(sum(epoch_us(ts) // 1000) // 5 AS BIGINT) AS avg_ms FROM n GROUP BY 1, 2 HAVING count(*) = 5""",
    "e",
)
ORACLE["stream_click_limit"] = sql(
    """, c AS (SELECT *, k % 5 AS ad_id FROM e WHERE event_type = 'click'),
          n AS (SELECT *, row_number() OVER (PARTITION BY user_id, ad_id, CAST(ts + INTERVAL 8 HOUR AS DATE)
               ORDER BY ts, seq) AS rn FROM c)
       SELECT user_id, ad_id, seq, CASE rn WHEN 1 THEN 'kept' ELSE 'warning' END AS tag FROM n WHERE rn <= 2""",
    "e",
)
ORACLE["stream_hot_items"] = ORACLE["hot_items"]
ORACLE["stream_interval_join"] = sql(
    """SELECT user_id, l_seq, r_seq FROM l JOIN r USING (user_id)
       WHERE r_ts BETWEEN l_ts - INTERVAL 6 HOUR AND l_ts + INTERVAL 12 HOUR""",
    "l",
    "r",
)
ORACLE["stream_upsert"] = """SELECT user_id, event_type, event_id AS seq FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"""
ORACLE["csv_file_records"] = ORACLE["csv_records"]
ORACLE["uv_hll"] = f"SELECT *, TRUE AS within_bound FROM ({ORACLE['hourly_uv']})"
ORACLE["hourly_pv_salted"] = ORACLE["hourly_pv"]
ORACLE["sliding_count_panes"] = ORACLE["sliding_count"]
ORACLE["api_slide"] = ORACLE["sql_hop"]


# Bodies that add their own common table expressions start with a comma.
ORACLE = {name: text.replace("\n, ", ",\n", 1) if "\n, " in text else text for name, text in ORACLE.items()}

ORACLE["rule_pair_match_asof"] = sql(
    """, r AS (
         SELECT ts AS valid_from, event_id AS rule_version, CASE user_id % 3 WHEN 0 THEN 'view' WHEN 1 THEN 'click' ELSE 'error' END AS action1
         FROM e WHERE event_type = 'signup' AND k % 10 = 7
       ), p AS (
         SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM e
       )
       SELECT user_id, event_id AS seq, rule_version, action1, event_type AS action2
       FROM p ASOF JOIN r ON p.ts >= r.valid_from WHERE prev = action1 AND event_type = 'purchase'""",
    "e",
)

IDLE_TOPS = ", ".join(
    f"max(epoch_us(ts)) FILTER (WHERE source = {i}) OVER upto AS top{i}, "
    f"arrival - coalesce(max(arrival) FILTER (WHERE source = {i}) OVER upto, min(arrival) OVER upto) <= 60 AS live{i}"
    for i in range(4)
)
IDLE_HELD = " OR ".join(f"(live{i} AND top{i} IS NULL)" for i in range(4))
IDLE_LEAST = ", ".join(f"CASE WHEN live{i} THEN top{i} END" for i in range(4))
ORACLE["watermark_idle"] = sql(
    f""", s AS (SELECT *, user_id % 4 AS source FROM disordered WHERE NOT (user_id % 4 = 3 AND (event_id // 200) % 2 = 1)),
       t AS (SELECT *, {IDLE_TOPS} FROM s WINDOW upto AS (ORDER BY arrival, event_id ROWS UNBOUNDED PRECEDING)),
       l AS (SELECT *, CASE WHEN {IDLE_HELD} THEN NULL ELSE least({IDLE_LEAST}) END AS low FROM t)
       SELECT event_id, source,
         make_timestamp(max(low) OVER (ORDER BY arrival, event_id ROWS UNBOUNDED PRECEDING) - {10 * MIN}) AS watermark FROM l""",
    "disordered",
)

ORACLE["rolling_files"] = sql(
    f""", l AS (
         SELECT event_id, event_id % 2 AS writer, epoch_us(ts) AS us,
           strlen(concat_ws(',', event_id, user_id, event_type, epoch_us(ts))) + 1 AS size FROM e
       ), p AS (
         SELECT *, coalesce(us - lag(us) OVER (PARTITION BY writer ORDER BY event_id) >= {3 * HOUR}, false) AS pause FROM l
       ), r AS (
         SELECT *, count(*) FILTER (WHERE pause) OVER (PARTITION BY writer ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS run FROM p
       ), a AS (
         SELECT *, (us - first_value(us) OVER (PARTITION BY writer, run ORDER BY event_id)) // {48 * HOUR} AS age FROM r
       ), b AS (
         SELECT *, coalesce(sum(size) OVER (PARTITION BY writer, run, age ORDER BY event_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 8192 AS part FROM a
       ), g AS (
         SELECT *, dense_rank() OVER (PARTITION BY writer ORDER BY run, age, part) - 1 AS file FROM b
       )
       SELECT writer, file, count(*) AS n, CAST(sum(size) AS BIGINT) AS bytes, min(us) AS first_us, max(us) AS last_us FROM g GROUP BY 1, 2""",
    "e",
)
