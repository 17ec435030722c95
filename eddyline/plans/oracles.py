"""The event queries in plain SQL, to check results against another engine."""

from __future__ import annotations


def _slides(key: str, source: str, size_s: int, slide_s: int) -> str:
    """Counts per window and key by copying each row into every window."""
    us = slide_s * 1_000_000
    return f"""
        SELECT make_timestamp((pane + 1 + shift) * {us}) AS window_end, {key}, count(*) AS count
        FROM (SELECT *, floor(epoch_us(ts) / {us}.0)::BIGINT AS pane FROM {source}) AS p,
             range({size_s // slide_s}) AS r(shift)
        GROUP BY ALL
    """


def _ranked(counts: str, key: str, n: int) -> str:
    return f"""
        SELECT window_end, {key}, count, rank FROM (
            SELECT *, CAST(row_number() OVER (
                PARTITION BY window_end ORDER BY count DESC, {key}) AS INTEGER) AS rank
            FROM ({counts}) AS c
        ) AS ranked WHERE rank <= {n}
    """


_URLS = "(SELECT ts, json_extract_string(props, '$.k') AS url FROM events) AS u"
_VIEWS = "(SELECT ts, user_id FROM events WHERE event_type = 'view') AS v"

HOT_ITEMS = _ranked(_slides("user_id", "events", 3600, 300), "user_id", 5)
HOT_URLS = _ranked(_slides("url", _URLS, 600, 5), "url", 5)
HOT_ITEMS_BY_TYPE = _ranked(_slides("user_id", _VIEWS, 3600, 3600), "user_id", 3)

HOT_ITEMS_REPORT = f"""
    SELECT window_end,
        '窗口结束时间： ' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || '.0' || chr(10)
        || string_agg('NO' || rank || ':' || chr(9) || '商品ID = ' || user_id || chr(9)
            || '热门度 = ' || count || chr(10), '' ORDER BY rank)
        || '=======================' || chr(10) AS report
    FROM ({HOT_ITEMS}) AS h GROUP BY window_end
"""
HOT_URLS_REPORT = f"""
    SELECT window_end,
        '时间: ' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || '.0' || chr(10)
        || string_agg('NO' || rank || ': URL= ' || url || '访问量= ' || count || chr(10), ''
            ORDER BY rank)
        || '==============================' AS report
    FROM ({_ranked(_slides("url", _URLS, 3600, 900), "url", 5)}) AS h GROUP BY window_end
"""

UNEVEN_SLIDING_COUNT = """
    SELECT make_timestamp(start_us + 3000000000) AS window_end, event_type, count(*) AS count
    FROM (
        SELECT epoch_us(ts) AS t, event_type,
               floor(epoch_us(ts) / 1200000000.0)::BIGINT * 1200000000 - back * 1200000000 AS start_us
        FROM events, range(3) AS r(back)
    ) AS s
    WHERE t < start_us + 3000000000
    GROUP BY ALL
"""

TUMBLING_COUNT = """
    SELECT date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end, event_type, count(*) AS count
    FROM events GROUP BY ALL
"""

DOMAIN_TRAFFIC = """
    SELECT window_end, strftime(window_end, '%Y-%m-%d %H:%M:%S') AS time_label, event_type,
           CAST(sum(cents) AS BIGINT) AS traffic
    FROM (
        SELECT date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end, event_type,
               CAST(round(value * 100) AS BIGINT) AS cents
        FROM events
    ) AS m GROUP BY ALL
"""

LOGIN_FAIL = """
    SELECT user_id, ts AS first_fail_time, next_ts AS last_fail_time, 'warning...' AS warning_msg
    FROM (
        SELECT user_id, ts, event_type, lead(ts) OVER w AS next_ts, lead(event_type) OVER w AS next_type
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
    ) AS n
    WHERE event_type = 'error' AND next_type = 'error' AND next_ts - ts < INTERVAL 6 HOUR
"""

STRICT_SEQUENCE = """
    SELECT user_id, event_id AS view_id, value AS view_value, next_id AS click_id, next_ts AS click_ts
    FROM (
        SELECT *, lead(event_id) OVER w AS next_id, lead(ts) OVER w AS next_ts,
               lead(event_type) OVER w AS next_type
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
    ) AS n
    WHERE event_type = 'view' AND next_type = 'click' AND next_ts - ts < INTERVAL 12 HOUR
"""

ORDER_TIMEOUT_PATTERN = """
    SELECT user_id, CASE WHEN paid THEN 'matched' ELSE 'timeout' END AS tag, ts AS created_at,
           CASE WHEN paid THEN pay_ts END AS paid_at,
           CASE WHEN paid THEN '成功支付'
                ELSE '超时支付 ' || CAST(floor(epoch_us(ts) / 1000000.0) AS BIGINT) END AS result_msg
    FROM (
        SELECT c.user_id, c.event_id, c.ts, min(p.ts) AS pay_ts,
               coalesce(min(p.ts) - c.ts < INTERVAL 24 HOUR, false) AS paid
        FROM events AS c LEFT JOIN events AS p
          ON p.user_id = c.user_id AND p.event_type = 'purchase'
         AND (p.ts > c.ts OR (p.ts = c.ts AND p.event_id > c.event_id))
        WHERE c.event_type = 'signup'
        GROUP BY c.user_id, c.event_id, c.ts
    ) AS f
"""

_LIFECYCLE_MESSAGE = """CASE tag WHEN 'payed' THEN 'payed successfully'
        WHEN 'late' THEN 'payed but already timeout' WHEN 'timeout' THEN 'order timeout'
        WHEN 'orphan' THEN 'already payed but not found create log' END AS result_msg"""

ORDER_LIFECYCLE = f"""
    SELECT user_id, day, tag, created_at, paid_at, {_LIFECYCLE_MESSAGE}
    FROM (
        SELECT *, CASE WHEN created_at IS NULL THEN 'orphan' WHEN paid_at IS NULL THEN 'timeout'
                       WHEN paid_at < created_at + INTERVAL 6 HOUR THEN 'payed' ELSE 'late' END AS tag
        FROM (
            SELECT user_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day,
                   min(ts) FILTER (event_type = 'signup') AS created_at,
                   min(ts) FILTER (event_type = 'purchase') AS paid_at
            FROM events WHERE event_type IN ('signup', 'purchase') GROUP BY ALL
        ) AS f
    ) AS t
"""


def _walked(key: str, source: str, wait: str) -> str:
    """The order state machine, one row of a key per recursion step."""
    return f"""
        WITH RECURSIVE steps AS (
            SELECT {key}, ts, event_type = 'signup' AS created,
                   row_number() OVER (PARTITION BY {key} ORDER BY ts, event_id) AS n
            FROM {source} WHERE event_type IN ('signup', 'purchase')
        ), walk AS (
            SELECT {key}, n, CASE WHEN created THEN 'C' ELSE 'P' END AS held,
                   CASE WHEN created THEN ts + {wait} ELSE ts END AS deadline,
                   NULL::VARCHAR AS fired, NULL::TIMESTAMP AS fired_at, NULL::VARCHAR AS got, NULL::TIMESTAMP AS got_at
            FROM steps WHERE n = 1
            UNION ALL
            SELECT {key}, n,
                   CASE WHEN created THEN CASE WHEN found = 'P' THEN 'E' ELSE 'C' END
                        ELSE CASE WHEN found = 'E' THEN 'P' ELSE 'E' END END,
                   CASE WHEN created THEN ts + {wait} ELSE ts END,
                   CASE WHEN found <> held THEN CASE held WHEN 'C' THEN 'timeout' ELSE 'orphan' END END,
                   CASE WHEN found <> held THEN deadline END,
                   CASE WHEN created AND found = 'P' THEN 'payed'
                        WHEN NOT created AND found <> 'E' THEN
                            CASE WHEN deadline > ts THEN 'payed' ELSE 'late' END END,
                   ts
            FROM (
                SELECT s.{key}, s.n, s.ts, s.created, w.held, w.deadline,
                       CASE WHEN w.held <> 'E' AND w.deadline < s.ts THEN 'E' ELSE w.held END AS found
                FROM walk AS w JOIN steps AS s ON s.{key} = w.{key} AND s.n = w.n + 1
            ) AS x
        ), outcomes AS (
            SELECT {key}, fired AS tag, fired_at AS emitted_at FROM walk WHERE fired IS NOT NULL
            UNION ALL
            SELECT {key}, got, got_at FROM walk WHERE got IS NOT NULL
            UNION ALL
            SELECT {key}, CASE held WHEN 'C' THEN 'timeout' ELSE 'orphan' END, deadline
            FROM (SELECT *, max(n) OVER (PARTITION BY {key}) AS last FROM walk) AS e
            WHERE n = last AND held <> 'E'
        )
        SELECT {key}, tag, emitted_at, {_LIFECYCLE_MESSAGE} FROM outcomes
    """


_HOURLY = """(SELECT event_id, event_type, user_id % 10 AS bucket,
    CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts FROM events) AS h"""

ORDER_LIFECYCLE_STRICT = _walked("user_id", "events", "INTERVAL 24 HOUR")
ORDER_LIFECYCLE_COARSE = _walked("bucket", _HOURLY, "INTERVAL 2 HOUR")

def _matched(within: str) -> str:
    """One row of a key per recursion step; a row that waits is taken, replaced or left over."""
    return f"""
    WITH RECURSIVE steps AS (
        SELECT user_id, ts, event_id, event_type = 'click' AS receipt,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_type = 'click', event_id) AS n
        FROM events WHERE event_type IN ('purchase', 'click')
    ), walk AS (
        SELECT user_id, n, ts, event_id, receipt, true AS waits, NULL::BIGINT AS partner,
               NULL::TIMESTAMP AS partner_ts, NULL::BIGINT AS dropped
        FROM steps WHERE n = 1
        UNION ALL
        SELECT s.user_id, s.n, s.ts, s.event_id, s.receipt,
               NOT (w.waits AND w.receipt <> s.receipt AND s.ts - w.ts <= {within}),
               CASE WHEN w.waits AND w.receipt <> s.receipt AND s.ts - w.ts <= {within}
                    THEN w.event_id END,
               CASE WHEN w.waits AND w.receipt <> s.receipt AND s.ts - w.ts <= {within}
                    THEN w.ts END,
               CASE WHEN w.waits AND w.receipt = s.receipt AND s.ts - w.ts <= {within}
                    THEN w.event_id END
        FROM walk AS w JOIN steps AS s ON s.user_id = w.user_id AND s.n = w.n + 1
    ), left_over AS (
        SELECT * FROM walk WHERE waits
           AND event_id NOT IN (SELECT partner FROM walk WHERE partner IS NOT NULL)
    )
    SELECT user_id, 'matched' AS tag,
           CASE WHEN receipt THEN partner_ts ELSE ts END AS pay_time,
           CASE WHEN receipt THEN partner ELSE event_id END AS pay_event_id,
           CASE WHEN receipt THEN ts ELSE partner_ts END AS receipt_time,
           CASE WHEN receipt THEN event_id ELSE partner END AS receipt_event_id
    FROM walk WHERE NOT waits
    UNION ALL
    SELECT user_id,
           CASE WHEN event_id IN (SELECT dropped FROM walk WHERE dropped IS NOT NULL) THEN 'replaced'
                WHEN receipt THEN 'unmatchedReceipts' ELSE 'unmatchedPays' END,
           CASE WHEN NOT receipt THEN ts END, CASE WHEN NOT receipt THEN event_id END,
           CASE WHEN receipt THEN ts END, CASE WHEN receipt THEN event_id END
    FROM left_over
"""


TX_MATCH_REPEATED = _matched("INTERVAL 12 HOUR")
TX_MATCH = f"SELECT * FROM ({_matched('INTERVAL 2 HOUR')}) AS m WHERE tag <> 'replaced'"
TX_UNMATCHED_PAYS = f"""
    SELECT user_id, pay_time, pay_event_id FROM ({TX_MATCH}) AS m WHERE tag = 'unmatchedPays'
"""
TX_UNMATCHED_RECEIPTS = f"""
    SELECT user_id, receipt_time, receipt_event_id FROM ({TX_MATCH}) AS m WHERE tag = 'unmatchedReceipts'
"""

STREAM_TX_MATCH = """
    WITH pays AS (SELECT event_id AS tx_id, ts, user_id FROM events WHERE event_type = 'purchase'),
    receipts AS (SELECT event_id - 1 AS tx_id, ts, user_id FROM events WHERE event_type = 'click')
    SELECT coalesce(p.tx_id, r.tx_id) AS tx_id,
           CASE WHEN r.tx_id IS NULL THEN 'unmatchedPays'
                WHEN p.tx_id IS NULL THEN 'unmatchedReceipts' ELSE 'matched' END AS tag,
           p.ts AS pay_time, p.user_id AS pay_user, r.ts AS receipt_time, r.user_id AS receipt_user
    FROM pays AS p FULL OUTER JOIN receipts AS r
      ON p.tx_id = r.tx_id
     AND p.ts - r.ts <= INTERVAL 5 MINUTE AND r.ts - p.ts <= INTERVAL 5 MINUTE
"""

_LOGGED = """(SELECT event_id, event_type, user_id AS order_id,
    CAST(date_trunc('second', ts) AS TIMESTAMP) AS ts FROM events) AS logged"""

ORDER_LOG_LIFECYCLE = _walked("order_id", _LOGGED, "INTERVAL 24 HOUR")

_ACCESSES = """(SELECT date_trunc('second', ts) AS ts, '/k/' || json_extract_string(props, '$.k') AS url
    FROM events WHERE event_type <> 'error') AS u"""
ACCESS_LOG_HOT_URLS = _ranked(_slides("url", _ACCESSES, 600, 60), "url", 5)

# Timers as a list of times in microseconds, the waiting row's own one among them.
ORDER_LIFECYCLE_LEGACY = f"""
    WITH RECURSIVE steps AS (
        SELECT user_id, epoch_us(ts) AS t, event_type = 'signup' AS created,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n
        FROM events WHERE event_type IN ('signup', 'purchase')
    ), walk AS (
        SELECT user_id, 0::BIGINT AS n, 'E' AS held, 0::BIGINT AS deadline, []::BIGINT[] AS timers,
               []::BIGINT[] AS fired, 'E' AS before, NULL::VARCHAR AS got, NULL::BIGINT AS got_at
        FROM (SELECT DISTINCT user_id FROM steps)
        UNION ALL
        SELECT user_id, n,
               CASE WHEN got IS NOT NULL THEN 'E' WHEN created THEN 'C' ELSE 'P' END,
               CASE WHEN created THEN t + 86400000000 ELSE t END,
               CASE WHEN got IS NOT NULL THEN list_filter(left_over, lambda x: x <> deadline)
                    ELSE list_distinct(list_append(left_over, CASE WHEN created THEN t + 86400000000 ELSE t END)) END,
               fired, before, got, t
        FROM (
            SELECT *, CASE WHEN created AND found = 'P' THEN 'payed'
                           WHEN NOT created AND found <> 'E' THEN CASE WHEN deadline > t THEN 'payed' ELSE 'late' END
                      END AS got
            FROM (
                SELECT s.user_id, s.n, s.t, s.created, w.deadline, w.held AS before,
                       list_sort(list_filter(w.timers, lambda x: x < s.t)) AS fired,
                       list_filter(w.timers, lambda x: x >= s.t) AS left_over,
                       CASE WHEN len(list_filter(w.timers, lambda x: x < s.t)) > 0 THEN 'E' ELSE w.held END AS found
                FROM walk AS w JOIN steps AS s ON s.user_id = w.user_id AND s.n = w.n + 1
            ) AS x
        ) AS y
    ), firing AS (
        SELECT user_id, before, unnest(fired) AS ended, fired[1] AS earliest FROM walk
        UNION ALL
        SELECT user_id, held, unnest(list_sort(timers)), list_sort(timers)[1]
        FROM (SELECT *, max(n) OVER (PARTITION BY user_id) AS last FROM walk) AS e WHERE n = last
    ), outcomes AS (
        SELECT user_id, CASE WHEN before = 'P' AND ended = earliest THEN 'orphan' ELSE 'timeout' END AS tag,
               make_timestamp(ended) AS emitted_at FROM firing
        UNION ALL
        SELECT user_id, got, make_timestamp(got_at) FROM walk WHERE got IS NOT NULL
    )
    SELECT user_id, tag, emitted_at, {_LIFECYCLE_MESSAGE} FROM outcomes
"""

SILENT_USERS = """
    SELECT user_id, ts AS last_seen, ts + INTERVAL 24 HOUR AS silent_at
    FROM (SELECT user_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS next FROM events) AS n
    WHERE next IS NULL OR next - ts >= INTERVAL 24 HOUR
"""

# The batch in which a row arrives, and the watermark (milliseconds) that earlier batches left.
def _arriving(delay_ms: int) -> str:
    return f"""
    arriving AS (
        SELECT *, epoch_us(ts) AS t,
               floor((epoch_us(ts) + event_id * 7919 % 1000 * 172800000) / 864000000000)::BIGINT AS batch
        FROM events
    ), marks AS (
        SELECT batch, coalesce(
            max(latest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) // 1000 - {delay_ms}, 0
        ) AS mark
        FROM (SELECT batch, max(t) AS latest FROM arriving GROUP BY batch) AS b
    )
    """


_KEPT_WINDOWS = "make_timestamp((floor(t / 21600000000)::BIGINT + 1) * 21600000000)"

LATE_COUNTS = f"""
    WITH {_arriving(86_400_000)}
    SELECT {_KEPT_WINDOWS} AS window_end, event_type, count(*) AS count
    FROM arriving JOIN marks USING (batch) WHERE t > mark * 1000 GROUP BY ALL
"""
LATE_LEDGER = f"""
    WITH {_arriving(86_400_000)}, runs AS (
        SELECT row_number() OVER (ORDER BY batch) - 1 AS run, mark, batch FROM marks
    )
    SELECT run::INTEGER AS run, count(*) FILTER (t <= mark * 1000) AS dropped
    FROM arriving JOIN runs USING (batch) GROUP BY run
    UNION ALL
    SELECT max(run)::INTEGER + 1, 0 FROM runs HAVING max(run) IS NOT NULL
"""
REVISED_HOT_ITEMS = f"""
    WITH {_arriving(86_401_000)}, kept AS (
        SELECT {_KEPT_WINDOWS} AS window_end, user_id, batch FROM arriving JOIN marks USING (batch)
        WHERE (floor(t / 21600000000) + 1) * 21600000000 > mark * 1000
    ), counts AS (
        SELECT window_end, user_id, count(*) AS count, count(DISTINCT batch) - 1 AS revisions FROM kept GROUP BY ALL
    )
    SELECT *, CAST(row_number() OVER (PARTITION BY window_end ORDER BY count DESC, user_id) AS INTEGER) AS rank
    FROM counts QUALIFY rank <= 5
"""

SQL_VIEW = """
    SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, max(ts) AS last_ts
    FROM events WHERE value > 10 GROUP BY event_type
"""
LOGIN_SUCCESS_VIEW = "SELECT event_type, props FROM events WHERE event_type = 'view'"
FILTER_EMPTY_KEY = """
    SELECT event_id, json_extract_string(props, '$.k') AS tx_id
    FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) >= 10
"""

_SECOND = "CAST(date_trunc('second', ts) AS TIMESTAMP) AS event_time"

PARSE_ACCESS_LOG = f"""
    SELECT event_id, '10.0.0.' || user_id AS ip, CAST(user_id AS VARCHAR) AS user_id, {_SECOND},
           'GET' AS method, '/k/' || json_extract_string(props, '$.k') AS url
    FROM events WHERE event_type <> 'error'
"""
QUARANTINE_ACCESS_LOG = """
    SELECT '10.0.0.' || user_id || ' ' || user_id || ' - ' || strftime(ts, '%d/%m/%Y:%H:%M:%S')
           || ' +0000 GET' AS value
    FROM events WHERE event_type = 'error'
"""
PARSE_TRAFFIC_LOG = f"""
    SELECT event_id, {_SECOND}, '10.0.0.' || user_id AS ip, event_type AS domain,
           CAST(round(value * 100) AS BIGINT) AS traffic
    FROM events WHERE event_type NOT IN ('error', 'signup')
"""
PARSE_BEHAVIOR_LOG = f"""
    SELECT event_id, user_id, event_id AS item_id,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS category_id,
           event_type AS behavior, {_SECOND}
    FROM events WHERE event_type <> 'click'
"""
PARSE_LOGIN_LOG = f"""
    SELECT event_id, user_id, '10.0.0.' || user_id AS ip, event_type, {_SECOND} FROM events
"""
PARSE_ORDER_LOG = f"""
    SELECT event_id, user_id AS order_id, event_type,
           CASE WHEN event_type = 'signup' THEN '' ELSE 'tx' || event_id END AS tx_id, {_SECOND}
    FROM events
"""
PARSE_RECEIPT_LOG = f"""
    SELECT event_id, 'tx' || event_id AS tx_id, event_type AS pay_channel, {_SECOND}
    FROM events WHERE event_type <> 'click'
"""

ORACLES = {
    "hot_items": HOT_ITEMS,
    "hot_urls": HOT_URLS,
    "hot_items_by_type": HOT_ITEMS_BY_TYPE,
    "hot_items_report": HOT_ITEMS_REPORT,
    "hot_urls_report": HOT_URLS_REPORT,
    "sliding_count": _slides("user_id", "events", 3600, 300),
    "uneven_sliding_count": UNEVEN_SLIDING_COUNT,
    "tumbling_count": TUMBLING_COUNT,
    "domain_traffic": DOMAIN_TRAFFIC,
    "login_fail": LOGIN_FAIL,
    "strict_sequence": STRICT_SEQUENCE,
    "order_timeout_pattern": ORDER_TIMEOUT_PATTERN,
    "order_lifecycle": ORDER_LIFECYCLE,
    "order_lifecycle_strict": ORDER_LIFECYCLE_STRICT,
    "order_lifecycle_coarse": ORDER_LIFECYCLE_COARSE,
    "tx_match": TX_MATCH,
    "tx_unmatched_pays": TX_UNMATCHED_PAYS,
    "tx_unmatched_receipts": TX_UNMATCHED_RECEIPTS,
    "tx_match_repeated": TX_MATCH_REPEATED,
    "login_success_view": LOGIN_SUCCESS_VIEW,
    "sql_view": SQL_VIEW,
    "filter_empty_key": FILTER_EMPTY_KEY,
    "parse_access_log": PARSE_ACCESS_LOG,
    "quarantine_access_log": QUARANTINE_ACCESS_LOG,
    "parse_traffic_log": PARSE_TRAFFIC_LOG,
    "parse_behavior_log": PARSE_BEHAVIOR_LOG,
    "parse_login_log": PARSE_LOGIN_LOG,
    "parse_order_log": PARSE_ORDER_LOG,
    "parse_receipt_log": PARSE_RECEIPT_LOG,
    # A stream over the whole table ends with the result of the bounded query.
    "stream_sliding_count": _slides("user_id", "events", 3600, 300),
    "stream_hot_items": HOT_ITEMS,
    "stream_hot_urls": HOT_URLS,
    "stream_hot_items_report": HOT_ITEMS_REPORT,
    "stream_domain_traffic": DOMAIN_TRAFFIC,
    "stream_login_fail": LOGIN_FAIL,
    "stream_order_timeout_pattern": ORDER_TIMEOUT_PATTERN,
    "stream_order_lifecycle": ORDER_LIFECYCLE_STRICT,
    "stream_tx_match_repeated": TX_MATCH_REPEATED,
    "stream_tx_match": STREAM_TX_MATCH,
    "stream_login_success_view": LOGIN_SUCCESS_VIEW,
    "stream_tx_join": STREAM_TX_MATCH,
    "stream_two_logs": STREAM_TX_MATCH,
    "stream_order_lifecycle_legacy": ORDER_LIFECYCLE_LEGACY,
    "stream_order_log": ORDER_LOG_LIFECYCLE,
    "stream_silent_users": SILENT_USERS,
    "stream_late_counts": LATE_COUNTS,
    "stream_late_ledger": LATE_LEDGER,
    "stream_revised_hot_items": REVISED_HOT_ITEMS,
    "order_log_lifecycle": ORDER_LOG_LIFECYCLE,
    "access_log_hot_urls": ACCESS_LOG_HOT_URLS,
    "domain_traffic_minutes": DOMAIN_TRAFFIC.replace("%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M"),
}
