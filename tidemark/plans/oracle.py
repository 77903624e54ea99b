"""The catalog queries as DuckDB SQL, written independently of the Spark plans."""

from __future__ import annotations

EVENTS = """
events_k AS (
  SELECT event_id AS seq, ts, user_id, event_type,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k
  FROM events
)
"""


def sliding(source: str, keys: str, hours: int, slide: int) -> str:
    """Each row joined to the window ends that cover it."""
    key_list = f"{keys}, " if keys else ""
    return f"""
      SELECT {key_list}window_end, count(*) AS cnt
      FROM (
        SELECT {key_list}
               unnest(generate_series(
                 time_bucket(INTERVAL {slide} HOUR, ts, TIMESTAMP '1970-01-01') + INTERVAL {slide} HOUR,
                 time_bucket(INTERVAL {slide} HOUR, ts, TIMESTAMP '1970-01-01') + INTERVAL {hours} HOUR,
                 INTERVAL {slide} HOUR)) AS window_end
        FROM {source}
      )
      GROUP BY {key_list}window_end
    """


def ranked(counts: str, key: str, n: int) -> str:
    return f"""
      SELECT {key}, window_end, cnt, rank FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, {key}) AS INTEGER) AS rank
        FROM ({counts})
      ) WHERE rank <= {n}
    """


def log_lines(*parts: str, sep: str = ",") -> str:
    return f" || '{sep}' || ".join(f"({part})" for part in parts)


# Of every fifty events one has a word for its time, one a time far too large and one none.
def log_time(time: str) -> str:
    return f"""CASE WHEN seq % 50 = 7 THEN 'soon' WHEN seq % 50 = 13 THEN {time} || '000000000000'
                    WHEN seq % 50 = 21 THEN '' ELSE {time}::VARCHAR END"""


SECONDS, MILLIS = log_time("(epoch_us(ts) // 1000000)"), log_time("(epoch_us(ts) // 1000)")
PAY = "CASE WHEN k % 3 > 0 THEN 'p' || k ELSE '' END"

LOG_LINES = {
    "behavior": log_lines("user_id", "k", "k % 7", "event_type", SECONDS),
    "ad_click": log_lines("user_id", "k", "'province' || k % 5", "'city' || k % 9", SECONDS),
    "login": log_lines("user_id", "'10.0.0.' || k", "event_type", SECONDS),
    "order": log_lines("user_id", "event_type", PAY, SECONDS),
    "receipt": log_lines("'p' || k", "event_type", SECONDS),
    "market": log_lines("user_id", "'channel' || k % 6", MILLIS, "event_type"),
    "key_time": log_lines("event_type", SECONDS, sep=" "),
}

PARSED_LOGS = f"WITH {EVENTS}" + " UNION ALL ".join(
    f"""
      SELECT '{name}' AS format, count(*) FILTER (seq % 50 NOT IN (7, 13, 21)) AS accepted,
             count(*) FILTER (seq % 50 IN (7, 13, 21)) AS rejected,
             date_trunc('{"millisecond" if name == "market" else "second"}',
                        min(ts) FILTER (seq % 50 NOT IN (7, 13, 21))) AS first_ts,
             date_trunc('{"millisecond" if name == "market" else "second"}',
                        max(ts) FILTER (seq % 50 NOT IN (7, 13, 21))) AS last_ts
      FROM events_k
    """
    for name in LOG_LINES
)

REJECTED_LINES = f"WITH {EVENTS}" + " UNION ALL ".join(
    f"SELECT '{name}' AS format, {line} AS line FROM events_k WHERE seq % 50 IN (7, 13, 21)"
    for name, line in LOG_LINES.items()
)

PAID_ORDER_LOG = f"""
  WITH {EVENTS}
  SELECT user_id AS order_id, event_type AS state, 'p' || k AS pay_id, date_trunc('second', ts) AS ts
  FROM events_k WHERE k % 3 > 0 AND seq % 50 NOT IN (7, 13, 21)
"""

# Rows that follow each other closely and change sides form a chain, and pair up along it.
RECONCILE_SHIPMENTS = """
  WITH items AS (
    SELECT l_orderkey AS pay_id, l_shipdate AS ts, l_linenumber AS seq, 1 - l_linenumber % 2 AS side FROM lineitem
  ), steps AS (
    SELECT *, row_number() OVER log AS n,
           CASE WHEN side <> lag(side) OVER log AND ts - lag(ts) OVER log <= INTERVAL 20 DAY THEN 0 ELSE 1 END AS opens
    FROM items WINDOW log AS (PARTITION BY pay_id ORDER BY ts, side, seq)
  ), chains AS (
    SELECT *, sum(opens) OVER (PARTITION BY pay_id ORDER BY n) AS chain FROM steps
  ), pairs AS (
    SELECT *, (row_number() OVER (PARTITION BY pay_id, chain ORDER BY n) - 1) // 2 AS pair FROM chains
  )
  SELECT pay_id,
         CASE WHEN count(*) = 2 THEN 'matched' WHEN min(side) = 0 THEN 'left_only' ELSE 'right_only' END AS kind,
         min(seq) FILTER (side = 0) AS sent, min(seq) FILTER (side = 1) AS received
  FROM pairs GROUP BY pay_id, chain, pair
"""

HOT_ITEMS = ranked(
    sliding("(SELECT k AS item_id, ts FROM events_k WHERE event_type = 'view')", "item_id", 6, 1),
    "item_id",
    3,
)

PAIRS = """
  SELECT user_id, prev_ts AS first_ts, ts AS last_ts FROM (
    SELECT user_id, ts, event_type,
           lag(ts) OVER w AS prev_ts, lag(event_type) OVER w AS prev_type
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
  )
  WHERE event_type = 'error' AND prev_type = 'error' AND ts - prev_ts < INTERVAL {gap}
"""

CAPPED = """
capped AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn
  FROM events
)
"""

NEXT_PAY = """
next_pay AS (
  SELECT c.user_id, c.ts AS create_ts,
         (SELECT min(p.ts) FROM events p
          WHERE p.user_id = c.user_id AND p.event_type = 'purchase'
            AND (p.ts > c.ts OR (p.ts = c.ts AND p.event_id > c.event_id))) AS pay_ts
  FROM events c WHERE c.event_type = 'signup'
)
"""

UNPAID = """
  SELECT c.user_id, c.ts AS create_ts FROM events c
  WHERE c.event_type = 'signup' AND NOT EXISTS (
    SELECT 1 FROM events p
    WHERE p.user_id = c.user_id AND p.event_type = 'purchase'
      AND p.ts < c.ts + INTERVAL 1 DAY {lower}
  )
"""

RECONCILED = """
both_sides AS (
  SELECT o.o_orderkey, o.o_orderdate, r.l_orderkey, r.ship_ts
  FROM orders o FULL OUTER JOIN (
    SELECT l_orderkey, min(l_shipdate) AS ship_ts FROM lineitem GROUP BY l_orderkey
  ) r
  ON o.o_orderkey = r.l_orderkey
     AND r.ship_ts BETWEEN o.o_orderdate - INTERVAL 365 DAY AND o.o_orderdate + INTERVAL 365 DAY
)
"""

DAILY_UV = """
  SELECT date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, count(DISTINCT user_id) AS {out}
  FROM events WHERE event_type = 'view' GROUP BY 1
"""

ORACLE: dict[str, str] = {
    "hot_items_topn": f"WITH {EVENTS} {HOT_ITEMS}",
    "topn_report": f"""
      WITH {EVENTS}
      SELECT window_end,
             'time: ' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || chr(10) || 'item -> count' || chr(10)
             || string_agg(item_id || ' -> ' || cnt, chr(10) ORDER BY rank) AS report
      FROM ({HOT_ITEMS}) GROUP BY window_end
    """,
    "key_sliding_count": sliding("events", "event_type", 6, 2),
    "hot_pages_topn": f"WITH {EVENTS} "
    + ranked(
        sliding(
            "(SELECT '/' || event_type || '/' || k AS url, date_trunc('second', ts) AS ts FROM events_k)",
            "url",
            6,
            1,
        ),
        "url",
        5,
    ),
    "page_views": """
      SELECT date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, count(*) AS pv
      FROM events WHERE event_type = 'view' GROUP BY 1
    """,
    "channel_counts": f"WITH {EVENTS} "
    + sliding(
        "(SELECT event_type AS behavior, k % 6 AS channel, ts FROM events_k WHERE event_type <> 'error')",
        "behavior, channel",
        6,
        1,
    ),
    "total_counts": sliding("events", "", 6, 1),
    "parsed_logs": PARSED_LOGS,
    "rejected_lines": REJECTED_LINES,
    "paid_order_log": PAID_ORDER_LOG,
    "reconcile_shipments": RECONCILE_SHIPMENTS,
    "unique_visitors": DAILY_UV.format(out="uv"),
    # The bound is wide enough for every window to be within it.
    "sketched_daily_visitors": f"SELECT window_end, uv, TRUE AS within FROM ({DAILY_UV.format(out='uv')})",
    "event_moments": f"""
      WITH {EVENTS}
      SELECT event_type, count(k) AS n, round(avg(k), 6) AS mean, round(var_pop(k), 3) AS variance
      FROM events_k GROUP BY event_type
    """,
    "approx_unique_visitors_error": f"""
      SELECT window_end, exact, true AS in_bound FROM ({DAILY_UV.format(out="exact")})
    """,
    "running_unique_visitors": """
      WITH v AS (
        SELECT event_id AS seq, ts, user_id, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end
        FROM events WHERE event_type = 'view'
      ), marked AS (
        SELECT *, row_number() OVER (PARTITION BY window_end, user_id ORDER BY ts, seq) = 1 AS is_new FROM v
      )
      SELECT seq, ts, user_id, window_end, is_new,
             CAST(sum(CASE WHEN is_new THEN 1 ELSE 0 END)
                  OVER (PARTITION BY window_end ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS uv
      FROM marked
    """,
    "click_cap_pass_counts": f"WITH {CAPPED} "
    + sliding("(SELECT * FROM capped WHERE rn <= 2)", "event_type", 6, 1),
    "click_cap_warnings": f"""
      WITH {CAPPED}
      SELECT user_id, ts, 'clicked more often than allowed' AS msg FROM capped WHERE rn = 3
    """,
    "fail_burst": """
      WITH RECURSIVE runs AS (
        SELECT user_id, event_id, ts, event_type,
               sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END)
                 OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run
        FROM events
      ), fails AS (
        SELECT user_id, run, ts FROM runs WHERE event_type = 'error'
      ), ends AS (
        SELECT user_id, run - 1 AS run, ts AS end_ts FROM runs WHERE event_type <> 'error'
      ), anchors AS (
        SELECT user_id, run, min(ts) AS anchor FROM fails GROUP BY user_id, run
        UNION ALL
        SELECT a.user_id, a.run,
               (SELECT min(f.ts) FROM fails f
                WHERE f.user_id = a.user_id AND f.run = a.run AND f.ts > a.anchor + INTERVAL 2 DAY)
        FROM anchors a
        WHERE EXISTS (SELECT 1 FROM fails f
                      WHERE f.user_id = a.user_id AND f.run = a.run AND f.ts > a.anchor + INTERVAL 2 DAY)
      )
      SELECT a.user_id, a.anchor AS first_ts, max(f.ts) AS last_ts, count(*) AS cnt
      FROM anchors a JOIN fails f
        ON f.user_id = a.user_id AND f.run = a.run
       AND f.ts BETWEEN a.anchor AND a.anchor + INTERVAL 2 DAY
      LEFT JOIN ends e ON e.user_id = a.user_id AND e.run = a.run
      WHERE e.end_ts IS NULL OR e.end_ts > a.anchor + INTERVAL 2 DAY
      GROUP BY a.user_id, a.run, a.anchor
      HAVING count(*) >= 2
    """,
    "consecutive_fail_pairs": PAIRS.format(gap="12 HOUR"),
    "fail_fail_pattern": PAIRS.format(gap="1 DAY"),
    "create_pay_match": f"""
      WITH {NEXT_PAY}
      SELECT user_id, create_ts, pay_ts FROM next_pay WHERE pay_ts - create_ts < INTERVAL 1 DAY
    """,
    "create_pay_timeout": f"""
      WITH {NEXT_PAY}
      SELECT user_id, create_ts FROM next_pay
      WHERE pay_ts IS NULL OR pay_ts - create_ts >= INTERVAL 1 DAY
    """,
    "unpaid_orders": UNPAID.format(lower=""),
    "unpaid_orders_lookback": UNPAID.format(lower="AND p.ts >= c.ts - INTERVAL 1 DAY"),
    "order_lifecycle": """
      WITH c AS (SELECT user_id, min(ts) AS create_ts FROM events WHERE event_type = 'signup' GROUP BY 1),
           p AS (SELECT user_id, min(ts) AS pay_ts FROM events WHERE event_type = 'purchase' GROUP BY 1)
      SELECT coalesce(c.user_id, p.user_id) AS user_id, create_ts,
             CASE WHEN create_ts IS NULL OR pay_ts < create_ts + INTERVAL 1 DAY THEN pay_ts END AS pay_ts,
             CASE WHEN create_ts IS NULL THEN 'no_create'
                  WHEN pay_ts < create_ts + INTERVAL 1 DAY THEN 'paid'
                  ELSE 'timeout' END AS status
      FROM c FULL OUTER JOIN p ON c.user_id = p.user_id
    """,
    "reconcile_matched": f"""
      WITH {RECONCILED}
      SELECT o_orderkey AS pay_id, o_orderdate AS order_ts, ship_ts AS receipt_ts
      FROM both_sides WHERE o_orderkey IS NOT NULL AND l_orderkey IS NOT NULL
    """,
    "reconcile_warnings": f"""
      WITH {RECONCILED}
      SELECT coalesce(o_orderkey, l_orderkey) AS pay_id,
             CASE WHEN l_orderkey IS NULL THEN 'receiptState time out' ELSE 'pay time out' END AS msg
      FROM both_sides WHERE o_orderkey IS NULL OR l_orderkey IS NULL
    """,
}
