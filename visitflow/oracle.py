"""DuckDB SQL that computes, from the driver's raw tables, what each registered query computes.

The views ``events customer nation region`` are registered by the caller.  Every query starts from
the same two derived relations as the Spark adapters (``visits``/``users`` and ``ad_clicks``), so
the SQL below is an independent second implementation of each operator, not a copy of the plan.
Every aggregate is cast to BIGINT (DuckDB sums to HUGEINT) and every column is aliased to the
Spark name, because the comparison sorts columns by name before hashing.
"""

from __future__ import annotations

# Fixed parameters of the test queries; they must equal the ones in __spark_entry__.py.
RANGE_START = "2024-01-05 01:00:00"
RANGE_END = "2024-01-20 05:00:00"
SAMPLE_SIZE = 30
SAMPLE_SEED = 42
TEST_BLACKLIST_THRESHOLD = 2

_VISITS = f"""
raw_events AS (
    SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
),
visits AS (
    SELECT CAST(ts AS DATE) AS visit_date,
           user_id,
           CAST(user_id AS VARCHAR) || '-' || strftime(CAST(ts AS DATE), '%Y-%m-%d') AS session_id,
           date_trunc('second', ts) AS action_time,
           CASE event_type WHEN 'click' THEN 'click' WHEN 'purchase' THEN 'pay'
                           WHEN 'signup' THEN 'order' ELSE 'search' END AS action,
           CASE WHEN event_type = 'purchase' THEN k ELSE 0 END AS pay_category_id,
           CASE WHEN event_type = 'purchase' THEN event_id % 100 ELSE 0 END AS pay_product_id,
           CASE WHEN event_type = 'click' THEN k ELSE 0 END AS click_category_id,
           CASE WHEN event_type = 'click' THEN event_id % 100 ELSE 0 END AS click_product_id,
           CASE WHEN event_type = 'signup' THEN k ELSE 0 END AS order_category_id,
           CASE WHEN event_type = 'signup' THEN event_id % 100 ELSE 0 END AS order_product_id,
           CASE WHEN event_type IN ('click', 'purchase', 'signup') THEN '' ELSE event_type END
               AS search_keyword,
           k % 10 AS page_id
    FROM raw_events
),
users AS (SELECT c_custkey AS user_id FROM customer),
in_range AS (
    SELECT * FROM visits v
    WHERE v.action_time >= TIMESTAMP '{RANGE_START}' AND v.action_time < TIMESTAMP '{RANGE_END}'
      AND v.user_id IN (SELECT user_id FROM users)
),
summary AS (
    SELECT session_id, min(action_time) AS start_time, max(action_time) AS end_time,
           CAST(count(DISTINCT page_id) AS BIGINT) AS page_count
    FROM visits WHERE session_id IS NOT NULL AND action_time IS NOT NULL
    GROUP BY session_id
    HAVING count(DISTINCT page_id) <> 1
),
bucketed AS (
    SELECT CASE WHEN secs < 30 THEN '0s-30S' WHEN secs < 60 THEN '30s-60s'
                WHEN secs < 180 THEN '1m-3m' WHEN secs < 600 THEN '3m-10m' ELSE '10m' END AS dur,
           CASE WHEN page_count < 4 THEN '0-4' WHEN page_count < 7 THEN '4-7'
                WHEN page_count <= 10 THEN '7-10' ELSE 'other' END AS pages
    FROM (SELECT *, epoch(end_time) - epoch(start_time) AS secs FROM summary)
),
labels(bucket, pos) AS (
    VALUES ('0s-30S', 0), ('30s-60s', 1), ('1m-3m', 2), ('3m-10m', 3), ('10m', 4),
           ('0-4', 5), ('4-7', 6), ('7-10', 7), ('other', 8), ('sessionCount', 9)
),
hist AS (
    SELECT l.bucket,
           CAST(CASE WHEN l.bucket = 'sessionCount' THEN (SELECT count(*) FROM bucketed)
                     ELSE (SELECT count(*) FROM bucketed b WHERE b.dur = l.bucket OR b.pages = l.bucket)
                END AS BIGINT) AS session_count
    FROM labels l
),
cat_events AS (
    SELECT click_category_id AS category_id, 'click' AS kind FROM visits WHERE action = 'click'
    UNION ALL
    SELECT order_category_id, 'order' FROM visits WHERE action = 'order'
    UNION ALL
    SELECT pay_category_id, 'pay' FROM visits WHERE pay_category_id <> 0
),
cat_counts AS (
    SELECT category_id,
           CAST(count(*) FILTER (WHERE kind = 'click') AS BIGINT) AS click_count,
           CAST(count(*) FILTER (WHERE kind = 'order') AS BIGINT) AS order_count,
           CAST(count(*) FILTER (WHERE kind = 'pay') AS BIGINT) AS pay_count
    FROM cat_events WHERE category_id IS NOT NULL
    GROUP BY category_id
    HAVING count(*) FILTER (WHERE kind = 'click') > 0
       AND count(*) FILTER (WHERE kind = 'order') > 0
       AND count(*) FILTER (WHERE kind = 'pay') > 0
),
top_cat AS (
    SELECT * FROM cat_counts
    ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id
    LIMIT 10
),
cat_click_events AS (
    SELECT 1 AS task_id, t.category_id, v.session_id, t.click_count
    FROM visits v JOIN top_cat t ON v.click_category_id = t.category_id
    WHERE v.click_category_id <> 0
)
"""

_CLICKS = """
ad_clicks AS (
    SELECT r.r_name AS province, n.n_name AS city, e.user_id,
           TRY_CAST(json_extract_string(e.props, '$.k') AS BIGINT) % 20 AS ad_id,
           epoch_us(e.ts) // 1000 AS ts_ms,
           e.ts AS ts,
           CAST(e.ts AS DATE) AS click_date
    FROM events e
    JOIN customer c ON e.user_id = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
    WHERE e.event_type = 'click'
),
user_counts AS (
    SELECT click_date, user_id, ad_id, CAST(count(*) AS BIGINT) AS click_count
    FROM ad_clicks WHERE click_date IS NOT NULL AND user_id IS NOT NULL AND ad_id IS NOT NULL
    GROUP BY ALL
),
test_blacklist AS (
    SELECT DISTINCT user_id FROM user_counts WHERE click_count >= {threshold}
),
daily_counts AS (
    SELECT click_date, province, ad_id, CAST(count(*) AS BIGINT) AS click_count
    FROM ad_clicks WHERE click_date IS NOT NULL AND province IS NOT NULL AND ad_id IS NOT NULL
    GROUP BY ALL
),
minute_counts AS (
    SELECT click_date, ad_id, date_trunc('minute', ts) AS minute, CAST(count(*) AS BIGINT) AS click_count
    FROM ad_clicks WHERE click_date IS NOT NULL AND ad_id IS NOT NULL AND ts IS NOT NULL
    GROUP BY ALL
)
""".format(threshold=TEST_BLACKLIST_THRESHOLD)


def _with(*parts: str) -> str:
    return "WITH " + ",".join(p.strip() for p in parts) + "\n"


def queries() -> dict[str, str]:
    v = _with(_VISITS)
    c = _with(_CLICKS)
    return {
        "visits_in_range": v + "SELECT * FROM in_range",
        "session_summary": v + "SELECT * FROM summary",
        "session_histogram": v + """
            SELECT bucket, session_count FROM hist
            WHERE bucket <> 'other' OR session_count > 0""",
        "session_histogram_share": v + """
            SELECT h.bucket, h.session_count,
                   CAST(h.session_count AS DOUBLE)
                     / NULLIF(CAST((SELECT session_count FROM hist WHERE bucket = 'sessionCount') AS DOUBLE), 0)
                     AS share
            FROM hist h
            WHERE h.bucket <> 'sessionCount' AND (h.bucket <> 'other' OR h.session_count > 0)""",
        "sample_sessions": v + f"""
            , keyed AS (
                SELECT session_id, start_time, end_time, date_trunc('hour', start_time) AS hour,
                       md5('{SAMPLE_SEED}' || ':' || session_id) AS sample_key
                FROM summary
            ), hours AS (
                SELECT hour, count(*) AS hour_n, sum(count(*)) OVER () AS total FROM keyed GROUP BY hour
            ), ranked AS (
                SELECT k.*, row_number() OVER (PARTITION BY k.hour ORDER BY k.sample_key, k.session_id) AS rn
                FROM keyed k
            )
            SELECT 1 AS task_id, r.session_id, r.start_time, r.end_time
            FROM ranked r JOIN hours h ON r.hour = h.hour
            WHERE r.rn <= least(h.hour_n, ({SAMPLE_SIZE} * h.hour_n + h.total - 1) // h.total)""",
        "category_counts": v + "SELECT * FROM cat_counts",
        "top_categories": v + """
            SELECT 1 AS task_id, category_id, click_count, order_count, pay_count FROM top_cat""",
        "category_click_events": v + "SELECT * FROM cat_click_events",
        "top_sessions_per_category": v + """
            , per AS (
                SELECT category_id, session_id, CAST(count(*) AS BIGINT) AS click_count
                FROM cat_click_events GROUP BY ALL
            )
            SELECT 1 AS task_id, category_id, session_id, click_count FROM (
                SELECT *, row_number() OVER (PARTITION BY category_id
                                             ORDER BY click_count DESC, session_id) AS rn
                FROM per) WHERE rn <= 10""",
        "session_detail": v + """
            SELECT 1 AS task_id, user_id, session_id, page_id, action_time, search_keyword,
                   click_category_id, click_product_id,
                   order_category_id AS order_category_ids, order_product_id AS order_product_ids,
                   pay_category_id AS pay_category_ids, pay_product_id AS pay_product_ids
            FROM visits
            WHERE session_id IN (SELECT session_id FROM cat_click_events)""",
        "parse_clicks": c + """
            SELECT province, city, user_id, ad_id, ts_ms, click_date FROM ad_clicks""",
        "filter_blacklisted": c + """
            SELECT province, city, user_id, ad_id, ts_ms, click_date FROM ad_clicks
            WHERE user_id NOT IN (SELECT user_id FROM test_blacklist)""",
        "daily_ad_counts": c + "SELECT * FROM daily_counts",
        "province_top_ads": c + """
            SELECT click_date, province, ad_id, click_count FROM (
                SELECT *, row_number() OVER (PARTITION BY click_date, province
                                             ORDER BY click_count DESC, ad_id) AS rn
                FROM daily_counts) WHERE rn <= 3""",
        "ad_trend": c + """
            , ends AS (
                SELECT click_date, ad_id, click_count,
                       CAST(minute + i * INTERVAL 1 MINUTE AS TIMESTAMP) AS window_end
                FROM (SELECT *, unnest(range(1, 61)) AS i FROM minute_counts)
            )
            SELECT click_date, ad_id, window_end, strftime(window_end, '%M') AS minute,
                   CAST(sum(click_count) AS BIGINT) AS click_count
            FROM ends
            GROUP BY click_date, ad_id, window_end""",
        "ad_minute_counts": c + "SELECT * FROM minute_counts",
        "region_ad_counts": c + """
            SELECT click_date, province, city, ad_id, CAST(count(*) AS BIGINT) AS click_count
            FROM ad_clicks
            WHERE click_date IS NOT NULL AND province IS NOT NULL AND city IS NOT NULL AND ad_id IS NOT NULL
            GROUP BY ALL""",
        "user_ad_counts": c + "SELECT * FROM user_counts",
        "blacklist_candidates": c + "SELECT * FROM test_blacklist",
    }
