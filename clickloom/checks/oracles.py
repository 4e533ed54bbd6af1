"""ANSI SQL twins of the registered queries, written for DuckDB."""

from __future__ import annotations

# The derived tables of `fixtures`, as common table expressions.
TABLES = """
ev AS (
  SELECT event_id, user_id, ts, event_type,
    cast(regexp_extract(props, '([0-9]+)', 1) AS bigint) AS k,
    cast(cast(ts AS date) AS varchar) AS d,
    cast(floor((extract(hour FROM ts) * 3600 + extract(minute FROM ts) * 60
      + floor(extract(second FROM ts)))
      / (CASE user_id % 3 WHEN 0 THEN 20 WHEN 1 THEN 600 ELSE 60 END)) AS bigint) AS n
  FROM events),
user_visit_action AS (
  SELECT d AS date, user_id,
    cast(user_id AS varchar) || '_' || replace(d, '-', '') AS session_id,
    k % 5 AS page_id,
    d || ' ' || lpad(cast(cast(floor(n / 3600) AS bigint) AS varchar), 2, '0')
      || ':' || lpad(cast(cast(floor(n / 60) AS bigint) % 60 AS varchar), 2, '0')
      || ':' || lpad(cast(n % 60 AS varchar), 2, '0') AS action_time,
    CASE WHEN event_type = 'view' THEN 'kw' || cast(k % 10 AS varchar) END AS search_keyword,
    CASE WHEN event_type = 'click' THEN k END AS click_category_id,
    CASE WHEN event_type = 'click' THEN event_id % 100 END AS click_product_id,
    CASE WHEN event_type = 'purchase'
      THEN cast(k AS varchar) || ',' || cast((k * 7 + 3) % 100 AS varchar) END AS order_category_ids,
    CASE WHEN event_type = 'purchase' THEN cast(event_id % 100 AS varchar)
      || ',' || cast((event_id * 3) % 100 AS varchar) END AS order_product_ids,
    CASE WHEN event_type = 'signup' THEN cast(k AS varchar) END AS pay_category_ids,
    CASE WHEN event_type = 'signup' THEN cast(event_id % 100 AS varchar) END AS pay_product_ids,
    (event_id + k) % 25 AS city_id
  FROM ev),
user_info AS (
  SELECT c_custkey AS user_id, c_name AS username, c_name AS name,
    cast(18 + c_custkey % 43 AS int) AS age, c_mktsegment AS professional,
    'city' || cast(c_nationkey AS varchar) AS city,
    CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer),
product_info AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
    '{"product_status": ' || cast(p_size % 2 AS varchar) || '}' AS extend_info
  FROM part),
city_info AS (
  SELECT cast(n_nationkey AS bigint) AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey),
ad_click_log AS (
  SELECT event_id, ts, d AS date, replace(area, ' ', '-') AS province, city_name AS city,
    user_id, k % 10 AS ad_id
  FROM ev JOIN city_info ON (event_id + k) % 25 = city_id)
"""

SESSIONS = """
sessions AS (
  SELECT session_id, min(user_id) AS user_id,
    coalesce(string_agg(DISTINCT search_keyword, ',' ORDER BY search_keyword), '') AS search_keywords,
    coalesce(string_agg(DISTINCT cast(click_category_id AS varchar), ','
      ORDER BY cast(click_category_id AS varchar)), '') AS click_category_ids,
    min(action_time) AS start_time, max(action_time) AS end_time,
    date_diff('second', cast(min(action_time) AS timestamp), cast(max(action_time) AS timestamp))
      AS visit_length,
    count(*) AS step_length
  FROM user_visit_action GROUP BY session_id),
full_sessions AS (
  SELECT s.*, u.age, u.professional, u.city, u.sex
  FROM sessions s JOIN user_info u USING (user_id)),
picked AS (
  SELECT * FROM full_sessions WHERE age BETWEEN 20 AND 50 AND sex = 'male'),
detail AS (
  SELECT a.* FROM user_visit_action a WHERE session_id IN (SELECT session_id FROM picked))
"""

CATEGORIES = """
used AS (
  SELECT 'click' AS kind, cast(click_category_id AS varchar) AS ids FROM detail
  UNION ALL SELECT 'order', order_category_ids FROM detail
  UNION ALL SELECT 'pay', pay_category_ids FROM detail),
uses AS (
  SELECT kind, try_cast(id AS bigint) AS category_id
  FROM (SELECT kind, unnest(string_split(ids, ',')) AS id FROM used WHERE ids IS NOT NULL) x
  WHERE try_cast(id AS bigint) IS NOT NULL),
counts AS (
  SELECT category_id,
    cast(sum(CASE WHEN kind = 'click' THEN 1 ELSE 0 END) AS bigint) AS click_count,
    cast(sum(CASE WHEN kind = 'order' THEN 1 ELSE 0 END) AS bigint) AS order_count,
    cast(sum(CASE WHEN kind = 'pay' THEN 1 ELSE 0 END) AS bigint) AS pay_count
  FROM uses GROUP BY category_id),
top_cat AS (
  SELECT * FROM counts
  ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10),
session_clicks AS (
  SELECT session_id, click_category_id AS category_id, count(*) AS click_count
  FROM detail WHERE click_category_id IS NOT NULL GROUP BY session_id, click_category_id),
top_session AS (
  SELECT category_id, session_id, click_count FROM (
    SELECT c.*, row_number() OVER (
      PARTITION BY c.category_id ORDER BY c.click_count DESC, c.session_id) AS rn
    FROM session_clicks c JOIN top_cat t USING (category_id)) x
  WHERE rn <= 10)
"""

SAMPLE = """
hours AS (
  SELECT substr(start_time, 1, 10) AS date, substr(start_time, 12, 2) AS hour,
    count(*) AS session_count
  FROM picked GROUP BY 1, 2),
plan AS (
  SELECT date, hour, session_count,
    least(cast(floor(cast(session_count AS double)
      / cast(sum(session_count) OVER (PARTITION BY date) AS double)
      * (100 // (SELECT count(DISTINCT date) FROM hours))) AS bigint), session_count) AS sample_size
  FROM hours),
sampled AS (
  SELECT s.* FROM (
    SELECT p.*, row_number() OVER (
      PARTITION BY substr(start_time, 1, 10), substr(start_time, 12, 2)
      ORDER BY md5('7:' || session_id), session_id) AS rn
    FROM picked p) s
  JOIN plan ON plan.date = substr(s.start_time, 1, 10) AND plan.hour = substr(s.start_time, 12, 2)
  WHERE s.rn <= plan.sample_size)
"""

PRODUCTS = """
clicks AS (
  SELECT city_id, click_product_id AS product_id FROM user_visit_action
  WHERE click_product_id IS NOT NULL),
placed AS (
  SELECT c.city_id, i.city_name, i.area, c.product_id FROM clicks c JOIN city_info i USING (city_id)),
area_counts AS (
  SELECT area, product_id, count(*) AS click_count,
    string_agg(DISTINCT cast(city_id AS varchar) || ':' || city_name, ','
      ORDER BY cast(city_id AS varchar) || ':' || city_name) AS city_infos
  FROM placed GROUP BY area, product_id),
enriched AS (
  SELECT a.area, a.product_id, a.click_count, a.city_infos, p.product_name,
    CASE WHEN json_extract_string(p.extend_info, '$.product_status') = '0'
      THEN 'self' ELSE 'third party' END AS product_status
  FROM area_counts a JOIN product_info p USING (product_id)),
leveled AS (
  SELECT *, CASE WHEN area IN ('ASIA', 'EUROPE') THEN 'A level' WHEN area = 'AMERICA' THEN 'B level'
    WHEN area = 'AFRICA' THEN 'C level' ELSE 'D level' END AS area_level
  FROM enriched)
"""

FLOW = """
ordered AS (
  SELECT session_id, cast(action_time AS timestamp) AS moment, page_id AS to_page,
    lag(page_id) OVER (PARTITION BY session_id ORDER BY action_time, page_id) AS from_page
  FROM user_visit_action),
moves AS (SELECT * FROM ordered WHERE from_page IS NOT NULL),
steps(step, from_page, to_page) AS (VALUES (1, 0, 1), (2, 1, 2), (3, 2, 3)),
pvs AS (
  SELECT from_page, to_page, count(*) AS pv
  FROM moves JOIN steps USING (from_page, to_page) GROUP BY from_page, to_page),
start_pv AS (SELECT count(*) AS pv FROM user_visit_action WHERE page_id = 0),
chain AS (
  SELECT s.step, s.from_page, s.to_page, coalesce(p.pv, 0) AS pv
  FROM steps s LEFT JOIN pvs p USING (from_page, to_page)
  UNION ALL SELECT 0, NULL, 0, pv FROM start_pv),
rates AS (
  SELECT step, from_page, to_page, pv, lag(pv) OVER (ORDER BY step) AS previous FROM chain)
"""

ADS = """
daily AS (
  SELECT date, user_id, ad_id, count(*) AS click_count
  FROM ad_click_log GROUP BY date, user_id, ad_id),
crossed AS (
  SELECT user_id, min(date) AS day FROM daily WHERE click_count >= 3 GROUP BY user_id),
clean AS (
  SELECT c.* FROM ad_click_log c LEFT JOIN crossed x USING (user_id)
  WHERE x.day IS NULL OR c.date <= x.day),
stat AS (
  SELECT date, province, city, ad_id, count(*) AS click_count
  FROM ad_click_log GROUP BY date, province, city, ad_id),
province AS (
  SELECT date, province, ad_id, cast(sum(click_count) AS bigint) AS click_count
  FROM stat GROUP BY date, province, ad_id),
trend AS (
  SELECT date, strftime(ts, '%H') AS hour, strftime(ts, '%M') AS minute, ad_id,
    count(*) AS click_count
  FROM ad_click_log GROUP BY 1, 2, 3, 4),
-- Replay in three batches, ten days each: a user is dropped from the batch after the crossing one.
batch_log AS (
  SELECT *, least((cast(substr(date, 9, 2) AS bigint) - 1) // 10, 2) AS batch FROM ad_click_log),
batch_crossed AS (
  SELECT user_id, min(batch) AS batch FROM (
    SELECT user_id, batch FROM batch_log GROUP BY date, batch, user_id, ad_id
    HAVING count(*) >= 3) x GROUP BY user_id),
batch_clean AS (
  SELECT c.* FROM batch_log c LEFT JOIN batch_crossed x USING (user_id)
  WHERE x.batch IS NULL OR c.batch <= x.batch)
"""

HALVES = """
even AS (
  SELECT date, province, city, ad_id, count(*) AS click_count
  FROM ad_click_log WHERE event_id % 2 = 0 GROUP BY ALL),
recent AS (
  SELECT date, province, city, ad_id, count(*) AS click_count
  FROM ad_click_log WHERE date >= '2024-01-16' GROUP BY ALL)
"""


def _with(select: str, *parts: str) -> str:
    return "WITH " + ",".join(part.strip() for part in (TABLES, *parts)) + "\n" + select.strip()


def _sessions(select: str, *parts: str) -> str:
    return _with(select, SESSIONS, *parts)


def _share(name: str, column: str, low: int, high: int | None) -> str:
    inside = f"{column} >= {low}" + ("" if high is None else f" AND {column} < {high}")
    n = f"count(*) FILTER (WHERE {inside})"
    return f"((200 * {n} + count(*)) // (2 * count(*))) / 100.0::double AS {name}"


# Bucket bounds as (name, lowest value, first value above the bucket).
_VISIT = [
    ("1s_3s", 1, 4), ("4s_6s", 4, 7), ("7s_9s", 7, 10), ("10s_30s", 10, 30), ("30s_60s", 30, 60),
    ("1m_3m", 60, 180), ("3m_10m", 180, 600), ("10m_30m", 600, 1800), ("30m", 1800, None),
]
_STEP = [
    ("1_3", 1, 4), ("4_6", 4, 7), ("7_9", 7, 10), ("10_30", 10, 30), ("30_60", 30, 60), ("60", 60, None),
]


def _buckets(column: str, buckets: list) -> str:
    cases = " ".join(
        f"WHEN {column} >= {low}" + ("" if high is None else f" AND {column} < {high}") + f" THEN '{name}'"
        for name, low, high in buckets
    )
    return _sessions(
        f"SELECT bucket, count(*) AS session_count FROM (SELECT CASE {cases} END AS bucket FROM picked) x "
        "WHERE bucket IS NOT NULL GROUP BY bucket"
    )


_ACTION = (
    "date, user_id, session_id, page_id, action_time, search_keyword, click_category_id, click_product_id,"
    " order_category_ids, order_product_ids, pay_category_ids, pay_product_ids, city_id"
)
_DETAIL = (
    "cast(1 AS bigint) AS taskid, user_id, session_id, page_id, action_time, search_keyword,"
    " click_category_id, click_product_id, order_category_ids, order_product_ids, pay_category_ids,"
    " pay_product_ids"
)
_FULL = (
    "session_id, user_id, search_keywords, click_category_ids, start_time, end_time, visit_length,"
    " step_length, age, professional, city, sex"
)
_CLICK = "event_id, date, province, city, user_id, ad_id"


def oracle_sql() -> dict[str, str]:
    shares = ", ".join(
        [_share(f"visit_length_{n}_ratio", "visit_length", lo, hi) for n, lo, hi in _VISIT]
        + [_share(f"step_length_{n}_ratio", "step_length", lo, hi) for n, lo, hi in _STEP]
    )
    overlap = "len(list_intersect(string_split({0}, ','), {1})) > 0"
    keywords = overlap.format("search_keywords", "['kw1', 'kw4']")
    categories = overlap.format("click_category_ids", "['3', '17', '42', '58', '96']")
    demo = "professional IN ('BUILDING', 'MACHINERY') AND city IN ('city1', 'city4', 'city7', 'city9', 'city12', 'city20') AND sex = 'female'"
    every = (
        "age BETWEEN 20 AND 55 AND professional IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE')"
        " AND city IN ('city1', 'city4', 'city7', 'city9', 'city12', 'city20') AND sex = 'male'"
        " AND len(list_intersect(string_split(search_keywords, ','), ['kw1', 'kw4', 'kw6', 'kw8'])) > 0"
        f" AND len(list_intersect(string_split(click_category_ids, ','), [{', '.join(repr(str(i)) for i in range(0, 100, 3))}])) > 0"
    )
    return {
        # sources
        "actions_by_date": _with(
            f"SELECT {_ACTION} FROM user_visit_action WHERE date BETWEEN '2024-01-08' AND '2024-01-21'"
        ),
        "click_actions": _with(
            "SELECT city_id, click_product_id AS product_id FROM user_visit_action"
            " WHERE click_product_id IS NOT NULL AND date BETWEEN '2024-01-08' AND '2024-01-21'"
        ),
        "parse_ad_log": _with(
            "SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, date, province, city, user_id, ad_id"
            " FROM ad_click_log"
        ),
        "ad_log_rejects": _with(
            "SELECT count(*) FILTER (WHERE area LIKE '% %') AS rejected, count(*) AS lines"
            " FROM ev JOIN city_info ON (event_id + k) % 25 = city_id"
        ),
        # sessions
        "session_aggregate": _sessions("SELECT * FROM sessions"),
        "session_with_user": _sessions(f"SELECT {_FULL} FROM full_sessions"),
        "session_filter_age": _sessions(f"SELECT {_FULL} FROM full_sessions WHERE age BETWEEN 25 AND 40"),
        "session_filter_demo": _sessions(f"SELECT {_FULL} FROM full_sessions WHERE {demo}"),
        "session_filter_lists": _sessions(
            f"SELECT {_FULL} FROM full_sessions WHERE {keywords} AND {categories}"
        ),
        "session_filter_equal": _sessions(f"SELECT {_FULL} FROM full_sessions WHERE sex = 'male'"),
        "filtered_sessions": _sessions(f"SELECT {_FULL} FROM full_sessions WHERE {every}"),
        "session_detail": _sessions(f"SELECT {_DETAIL} FROM detail"),
        "filtered_session_detail": _sessions(
            f"SELECT {_DETAIL} FROM user_visit_action"
            f" WHERE session_id IN (SELECT session_id FROM full_sessions WHERE {every})"
        ),
        "visit_length_buckets": _buckets("visit_length", _VISIT),
        "step_length_buckets": _buckets("step_length", _STEP),
        "session_aggr_stat": _sessions(
            f"SELECT cast(1 AS bigint) AS taskid, count(*) AS session_count, {shares} FROM picked"
        ),
        # sampling
        "sessions_per_hour": _sessions("SELECT * FROM hours", SAMPLE),
        "sample_plan": _sessions("SELECT * FROM plan", SAMPLE),
        "session_random_extract": _sessions(
            "SELECT cast(1 AS bigint) AS taskid, session_id, start_time, search_keywords,"
            " click_category_ids FROM sampled",
            SAMPLE,
        ),
        "sample_detail": _sessions(
            f"SELECT {_DETAIL} FROM user_visit_action"
            " WHERE session_id IN (SELECT session_id FROM sampled)",
            SAMPLE,
        ),
        # categories
        "visited_categories": _sessions("SELECT DISTINCT category_id FROM uses", CATEGORIES),
        "category_clicks": _sessions(
            "SELECT category_id, click_count FROM counts WHERE click_count > 0", CATEGORIES
        ),
        "category_orders": _sessions(
            "SELECT category_id, order_count FROM counts WHERE order_count > 0", CATEGORIES
        ),
        "category_pays": _sessions(
            "SELECT category_id, pay_count FROM counts WHERE pay_count > 0", CATEGORIES
        ),
        "category_counts": _sessions("SELECT * FROM counts", CATEGORIES),
        "top10_category": _sessions(
            "SELECT cast(1 AS bigint) AS taskid, * FROM top_cat", CATEGORIES
        ),
        "session_category_clicks": _sessions("SELECT * FROM session_clicks", CATEGORIES),
        "category_session_counts": _sessions(
            "SELECT c.category_id, c.session_id, c.click_count"
            " FROM session_clicks c JOIN top_cat t USING (category_id)",
            CATEGORIES,
        ),
        "top10_category_session": _sessions(
            "SELECT cast(1 AS bigint) AS taskid, * FROM top_session", CATEGORIES
        ),
        "top_session_detail": _sessions(
            f"SELECT {_DETAIL} FROM user_visit_action"
            " WHERE session_id IN (SELECT session_id FROM top_session)",
            CATEGORIES,
        ),
        # funnel
        "page_transitions": _with(
            "SELECT session_id, strftime(moment, '%Y-%m-%d %H:%M:%S') AS time, from_page, to_page,"
            " count(*) AS transitions FROM moves GROUP BY ALL",
            FLOW,
        ),
        "page_split_pv": _with("SELECT * FROM pvs", FLOW),
        "start_page_pv": _with("SELECT * FROM start_pv", FLOW),
        "page_convert_rate": _with(
            "SELECT step, cast(from_page AS bigint) AS from_page, cast(to_page AS bigint) AS to_page, pv,"
            " ((200 * pv + previous) // (2 * previous)) / 100.0::double AS convert_rate"
            " FROM rates WHERE step > 0",
            FLOW,
        ),
        "page_convert_rate_string": _with(
            "SELECT cast(1 AS bigint) AS taskid, string_agg(from_page || '_' || to_page || '=' ||"
            " cast(((200 * pv + previous) // (2 * previous)) / 100.0::double AS varchar), '|'"
            " ORDER BY step) AS convert_rate FROM rates WHERE step > 0",
            FLOW,
        ),
        # products
        "click_with_city": _with("SELECT * FROM placed", PRODUCTS),
        "area_product_clicks": _with("SELECT * FROM area_counts", PRODUCTS),
        "area_product_enriched": _with("SELECT * FROM enriched", PRODUCTS),
        "area_level": _with("SELECT area, product_id, area_level FROM leveled", PRODUCTS),
        "area_top3_product": _with(
            "SELECT cast(1 AS bigint) AS taskid, area, area_level, product_id, click_count, city_infos,"
            " product_name, product_status FROM ("
            " SELECT *, row_number() OVER (PARTITION BY area ORDER BY click_count DESC, product_id) AS rn"
            " FROM leveled) x WHERE rn <= 3",
            PRODUCTS,
        ),
        # ads
        "ad_clean_clicks": _with(f"SELECT {_CLICK} FROM clean", ADS),
        "daily_user_ad_clicks": _with("SELECT * FROM daily", ADS),
        "ad_blacklist": _with("SELECT DISTINCT user_id FROM daily WHERE click_count >= 3", ADS),
        "ad_stat": _with("SELECT * FROM stat", ADS),
        "ad_province_counts": _with("SELECT * FROM province", ADS),
        "ad_province_top3": _with(
            "SELECT date, province, ad_id, click_count FROM ("
            " SELECT *, row_number() OVER (PARTITION BY date, province"
            " ORDER BY click_count DESC, ad_id) AS rn FROM province) x WHERE rn <= 3",
            ADS,
        ),
        "ad_click_trend": _with("SELECT * FROM trend", ADS),
        "ad_trend_last_hour": _with(
            "SELECT * FROM trend WHERE cast(date || ' ' || hour || ':' || minute || ':00' AS timestamp)"
            " > timestamp '2024-01-15 11:30:00'"
            " AND cast(date || ' ' || hour || ':' || minute || ':00' AS timestamp)"
            " <= timestamp '2024-01-15 12:30:00'",
            ADS,
        ),
        # streams: the final state of a replay
        "ad_stat_stream": _with("SELECT * FROM stat", ADS),
        "ad_trend_stream": _with("SELECT * FROM trend", ADS),
        "ad_clean_clicks_stream": _with(
            "SELECT batch AS batch_id, date, province, city, user_id, ad_id, count(*) AS clicks"
            " FROM batch_clean GROUP BY ALL",
            ADS,
        ),
        "ad_blacklist_stream": _with("SELECT user_id, batch AS crossed_in FROM batch_crossed", ADS),
        "ad_province_top3_stream": _with(
            "SELECT date, province, ad_id, click_count FROM ("
            " SELECT date, province, ad_id, count(*) AS click_count, row_number() OVER ("
            " PARTITION BY date, province ORDER BY count(*) DESC, ad_id) AS rn"
            " FROM batch_clean GROUP BY date, province, ad_id) x WHERE rn <= 3",
            ADS,
        ),
        "ad_user_counts_stream": _with(
            "SELECT date, user_id, ad_id, count(*) AS click_count FROM clean GROUP BY ALL", ADS
        ),
        "ad_published_stat_stream": _with(
            "SELECT date, province, city, ad_id, count(*) AS click_count FROM clean GROUP BY ALL", ADS
        ),
        # Every window counted on its own from the clicks that arrived in it.
        "ad_trend_sliding_stream": _with(
            "SELECT strftime(make_timestamp(s.slide * 10000000), '%Y-%m-%d %H:%M:%S') AS slide_end,"
            " strftime(s.minute, '%Y-%m-%d') AS date, strftime(s.minute, '%H') AS hour,"
            " strftime(s.minute, '%M') AS minute, s.ad_id, count(a.pane) AS click_count"
            " FROM slides s LEFT JOIN arrived a ON a.minute = s.minute AND a.ad_id = s.ad_id"
            " AND a.pane < s.slide AND a.pane >= s.slide - 360"
            " GROUP BY s.slide, s.minute, s.ad_id",
            ADS,
            """
arrived AS (
  SELECT ad_id, date_trunc('minute', cast(ts AS timestamp)) AS minute,
    cast(floor(epoch(cast(ts AS timestamp) + to_seconds(event_id % 7 * 10)) / 10) AS bigint) AS pane
  FROM ad_click_log),
slides AS (
  SELECT DISTINCT minute, ad_id, pane + unnest([1, 361]) AS slide FROM arrived)
""",
        ),
        "ad_log_rejects_stream": _with(
            "SELECT count(*) FILTER (WHERE area LIKE '% %') AS rejected, count(*) AS lines"
            " FROM ev JOIN city_info ON (event_id + k) % 25 = city_id"
        ),
        # tables
        "table_upsert": _with(
            "SELECT * FROM recent UNION ALL SELECT * FROM even WHERE (date, province, city, ad_id) NOT IN"
            " (SELECT (date, province, city, ad_id) FROM recent)",
            ADS,
            HALVES,
        ),
        "table_append": _with("SELECT * FROM even UNION ALL SELECT * FROM recent", ADS, HALVES),
        "table_replace": _with(
            "SELECT * FROM recent WHERE province = 'ASIA' UNION ALL"
            " SELECT * FROM even WHERE (date, province) NOT IN"
            " (SELECT (date, province) FROM recent WHERE province = 'ASIA')",
            ADS,
            HALVES,
        ),
        "result_replace": _with(
            "SELECT cast(1 AS bigint) AS taskid, date, count(*) AS actions FROM user_visit_action"
            " WHERE date BETWEEN '2024-01-08' AND '2024-01-21' GROUP BY date"
        ),
        "sql_functions": _with(
            "SELECT city_id, cast(city_id AS varchar) || ':' || city_name AS text, city_name AS name FROM city_info"
        ),
        "days_from_today": _with(
            "SELECT d AS date, count(*) FILTER (WHERE cast(d AS date) < current_date - 1) AS before_yesterday,"
            " count(*) FILTER (WHERE cast(d AS date) < current_date) AS before_today FROM ev GROUP BY d"
        ),
        "json_parameters": _with(
            "SELECT u.user_id, count(DISTINCT session_id) AS sessions FROM user_visit_action a"
            " JOIN user_info u ON u.user_id = a.user_id"
            " WHERE date BETWEEN '2024-01-08' AND '2024-01-21' AND age BETWEEN 25 AND 40 AND sex = 'male'"
            " GROUP BY u.user_id"
        ),
        # functions
        "concat_long_string": _with(
            "SELECT session_id, coalesce(cast(click_category_id AS varchar), 'null') || ':' ||"
            " coalesce(search_keyword, 'null') AS text FROM user_visit_action"
        ),
        "json_field": _with(
            "SELECT product_id, json_extract_string(extend_info, '$.product_status') AS product_status"
            " FROM product_info"
        ),
        "group_concat_distinct": _with(
            "SELECT date, string_agg(DISTINCT cast(city_id AS varchar), ','"
            " ORDER BY cast(city_id AS varchar)) AS cities FROM user_visit_action GROUP BY date"
        ),
        "time_formats": _with(
            "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time,"
            " strftime(ts, '%Y%m%d') AS day_key, strftime(ts, '%Y%m%d%H%M') AS minute_key,"
            " strftime(ts, '%Y-%m-%d_%H') AS day_hour FROM events"
        ),
        "time_compare": _with(
            "SELECT session_id, action_time,"
            " coalesce(cast(cast(action_time AS timestamp) < noon AS int), 0) AS is_before,"
            " coalesce(cast(cast(action_time AS timestamp) > noon AS int), 0) AS is_after,"
            " coalesce(date_diff('second', noon, cast(action_time AS timestamp)), 0) AS seconds FROM ("
            " SELECT *, CASE WHEN page_id < 3 THEN cast(date || ' 01:00:00' AS timestamp) END AS noon"
            " FROM user_visit_action) x"
        ),
        "parse_times": _with(
            "SELECT session_id, action_time AS time, CASE WHEN page_id < 3 THEN date END AS day"
            " FROM user_visit_action"
        ),
        "empty_text": _with(
            "SELECT session_id, CASE WHEN coalesce(text, '') = '' THEN 1 ELSE 0 END AS is_empty,"
            " CASE WHEN coalesce(text, '') = '' THEN 0 ELSE 1 END AS is_not_empty FROM ("
            " SELECT session_id, CASE WHEN click_category_id % 2 = 0 THEN '' ELSE search_keyword END"
            " AS text FROM user_visit_action) x"
        ),
        "trim_comma": _with(
            "SELECT session_id, regexp_replace(',' || coalesce(order_category_ids, ',') || ',', '^,|,$',"
            " '', 'g') AS text FROM user_visit_action"
        ),
        "pad2": _with(
            "SELECT event_id, CASE WHEN length(cast(k AS varchar)) = 2 THEN cast(k AS varchar)"
            " ELSE '0' || cast(k AS varchar) END AS text FROM ev"
        ),
    }
