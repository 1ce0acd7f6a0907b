"""SQL for a second engine that gives the result of each registered query."""

from __future__ import annotations

from clickloom.catalog.queries import (
    CHUNK_TERMS,
    DAY,
    FULL_FILTER,
    LARGE_SAMPLE,
    ORDERS_DATASET,
    SEED,
    TASK_ID,
    TOP_USERS_SQL,
)
from clickloom.functions.buckets import STEP, VISIT, Buckets
from clickloom.session_filter import SessionFilter, parse_list
from clickloom.sources import generator as gen
from clickloom.sources.tables import ACTION_TABLE, PRODUCT_TABLE, USER_TABLE

DAY_KEY = "user_id || '_' || CAST(CAST(ts AS DATE) AS VARCHAR)"
MIXED_KEY = f"""CASE user_id % 3 WHEN 0 THEN {DAY_KEY}
    WHEN 1 THEN user_id || '_w' || CAST(floor((dayofyear(ts) - 1) / 7) AS BIGINT)
    ELSE CAST(user_id AS VARCHAR) END"""
TIME_TEXT = "strftime({}, '%Y-%m-%d %-H:%M:%S')"


def _time(column: str) -> str:
    return TIME_TEXT.format(column)


def _actions(key: str = DAY_KEY) -> str:
    return f"""keyed AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
actions AS (
  SELECT CAST(ts AS DATE) AS date, user_id, {key} AS session_id, k % 10 + 1 AS page_id,
    ts AS action_time,
    CASE WHEN event_type = 'view' THEN 'kw' || (k % 10) END AS search_keyword,
    CASE WHEN event_type = 'click' THEN k ELSE -1 END AS click_category_id,
    CASE WHEN event_type = 'click' THEN k ELSE -1 END AS click_product_id,
    CASE WHEN event_type = 'signup' THEN CAST(k AS VARCHAR) END AS order_category_ids,
    CASE WHEN event_type = 'signup' THEN CAST(k AS VARCHAR) END AS order_product_ids,
    CASE WHEN event_type = 'purchase' THEN k END AS pay_category_ids,
    CASE WHEN event_type = 'purchase' THEN k END AS pay_product_ids,
    user_id % 11 AS city_id, event_id AS action_id
  FROM keyed)"""


USERS = """users AS (
  SELECT c_custkey AS user_id, 'user' || c_custkey AS username, c_name AS name,
    10 + (c_custkey * 37) % 51 AS age, c_mktsegment AS professional,
    'city' || c_nationkey AS city,
    CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS sex
  FROM customer)"""

PRODUCTS = """products AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
    '{"product_status":' || (p_partkey % 2)
      || CASE WHEN p_partkey % 5 = 0 THEN '' ELSE '}' END AS extend_info
  FROM part)"""

SUMMARY = """summary AS (
  SELECT session_id, arg_min(user_id, row(action_time, action_id)) AS user_id,
    CAST(floor(epoch(max(action_time))) - floor(epoch(min(action_time))) AS BIGINT)
      AS visit_length,
    count(*) AS step_length, min(action_time) AS start_time, max(action_time) AS end_time
  FROM actions GROUP BY session_id)"""

JOINED = """joined AS (
  SELECT s.*, u.age, u.professional, u.sex, u.city
  FROM summary s JOIN users u ON s.user_id = u.user_id)"""

FILTERED = "filtered AS (SELECT * FROM joined WHERE age BETWEEN 30 AND 50)"

TERMS = """keyword_lists AS (
  SELECT session_id, string_agg(term, ',' ORDER BY used) AS search_keywords
  FROM (SELECT session_id, search_keyword AS term,
          min(row(action_time, action_id)) AS used FROM actions
        WHERE search_keyword IS NOT NULL AND search_keyword <> '' GROUP BY ALL)
  GROUP BY session_id),
category_lists AS (
  SELECT session_id, string_agg(term, ',' ORDER BY used) AS click_categories
  FROM (SELECT session_id, CAST(click_category_id AS VARCHAR) AS term,
          min(row(action_time, action_id)) AS used
        FROM actions WHERE click_category_id <> -1 GROUP BY session_id, click_category_id)
  GROUP BY session_id)"""

CATEGORY_EVENTS = """category_events AS (
  SELECT session_id, click_category_id AS category_id, 1 AS click, 0 AS ordered, 0 AS pay
    FROM actions WHERE click_category_id <> -1
  UNION ALL
  SELECT session_id, CAST(unnest(string_split(order_category_ids, ',')) AS BIGINT), 0, 1, 0
    FROM actions WHERE order_category_ids IS NOT NULL
  UNION ALL
  SELECT session_id, pay_category_ids, 0, 0, 1 FROM actions
    WHERE pay_category_ids IS NOT NULL)"""

CATEGORY_SUMS = """CAST(sum(click) AS BIGINT) AS click_count,
  CAST(sum(ordered) AS BIGINT) AS order_count, CAST(sum(pay) AS BIGINT) AS pay_count"""

SESSION_COLUMNS = f"""session_id, user_id, visit_length, step_length,
  {_time('start_time')} AS start_time, {_time('end_time')} AS end_time"""
USER_COLUMNS = "age, professional, sex, city"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _quoted(text: str) -> str:
    return ", ".join(f"'{value}'" for value in parse_list(text))


def _filtered(key: str = DAY_KEY) -> str:
    return _with(_actions(key), USERS, SUMMARY, JOINED, FILTERED)


def _bucket(buckets: Buckets, column: str) -> str:
    low = f"CAST(greatest(ceil({column} / {buckets.width}.0), 1) - 1 AS BIGINT) * {buckets.width}"
    return f"""CASE WHEN {column} > {buckets.top} THEN '{buckets.overflow}'
      ELSE '{buckets.prefix}_' || ({low}) || '_' || ({low} + {buckets.width}) END"""


def _ratio(buckets: Buckets, column: str, key: str) -> str:
    shares = ",\n  ".join(
        f"count(*) FILTER (WHERE {_bucket(buckets, column)} = '{name}') / count(*) AS {name}"
        for name in buckets.ratio_columns()
    )
    return f"""{_filtered(key)}SELECT '{TASK_ID}' AS task_id, count(*) AS session_count,
  {shares} FROM filtered"""


def _full_filter() -> str:
    p = FULL_FILTER
    return f"""{_with(_actions(MIXED_KEY), USERS, SUMMARY, JOINED)}
SELECT {SESSION_COLUMNS}, {USER_COLUMNS} FROM joined
WHERE age BETWEEN {p.start_age} AND {p.end_age}
  AND professional IN ({_quoted(p.professionals)}) AND city IN ({_quoted(p.cities)})
  AND sex = '{p.sex}'
  AND session_id IN (SELECT session_id FROM actions
                     WHERE search_keyword IN ({_quoted(p.keywords)}))
  AND session_id IN (SELECT session_id FROM actions
                     WHERE click_category_id IN ({p.category_ids}))"""


def _counters() -> str:
    return f"""{_filtered()}
SELECT 'sum_visit' AS counter, count(*) AS sessions FROM filtered
UNION ALL SELECT 'sum_step', count(*) FROM filtered
UNION ALL SELECT {_bucket(VISIT, 'visit_length')}, count(*) FROM filtered GROUP BY 1
UNION ALL SELECT {_bucket(STEP, 'step_length')}, count(*) FROM filtered GROUP BY 1"""


def _sample(size: int) -> str:
    return f"""{_with(_actions(), USERS, SUMMARY, JOINED, FILTERED, TERMS)}
SELECT '{TASK_ID}' AS task_id, session_id, {_time('start_time')} AS start_time,
  coalesce(search_keywords, '') AS search_keywords,
  coalesce(click_categories, '') AS click_categories
FROM (SELECT * FROM filtered ORDER BY md5('{SEED}:' || session_id), session_id LIMIT {size})
  LEFT JOIN keyword_lists USING (session_id) LEFT JOIN category_lists USING (session_id)"""


def _page_conversion() -> str:
    flow = SessionFilter().page_flow
    steps = ", ".join(f"({i + 1}, {a}, {b})" for i, (a, b) in enumerate(zip(flow, flow[1:])))
    return f"""{_with(_actions())}, moves AS (
  SELECT page_id, lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, action_id)
    AS next_page FROM actions),
flow(step, from_page, to_page) AS (VALUES {steps})
SELECT CAST(step AS INTEGER) AS step, CAST(from_page AS BIGINT) AS from_page,
  CAST(to_page AS BIGINT) AS to_page,
  count(*) FILTER (WHERE page_id = from_page) AS views,
  count(*) FILTER (WHERE page_id = from_page AND next_page = to_page) AS hops,
  count(*) FILTER (WHERE page_id = from_page AND next_page = to_page)
    / nullif(count(*) FILTER (WHERE page_id = from_page), 0) AS rate
FROM flow CROSS JOIN moves GROUP BY ALL"""


ORDERS_SIDES = f"""s1 AS ({ORDERS_DATASET["source1_sql"].format(orders="orders")}),
s2 AS ({ORDERS_DATASET["source2_sql"].format(orders="orders")})"""

ORDERS_PAIRS = f"""{ORDERS_SIDES},
ranked AS (
  SELECT 1 AS side, *, count(*) OVER (PARTITION BY o_orderkey) AS n,
    row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderstatus NULLS FIRST,
      o_totalprice NULLS FIRST, o_orderdate NULLS FIRST) AS rn FROM s1
  UNION ALL
  SELECT 2, *, count(*) OVER (PARTITION BY o_orderkey),
    row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderstatus NULLS FIRST,
      o_totalprice NULLS FIRST, o_orderdate NULLS FIRST) FROM s2),
one AS (SELECT * FROM ranked WHERE side = 1 AND rn = 1),
two AS (SELECT * FROM ranked WHERE side = 2 AND rn = 1),
pairs AS (
  SELECT a.o_orderkey AS k1, b.o_orderkey AS k2, a.o_orderstatus AS status1,
    b.o_orderstatus AS status2, a.o_totalprice AS price1, b.o_totalprice AS price2,
    a.o_orderdate AS date1, b.o_orderdate AS date2,
    coalesce(a.n, 0) AS n1, coalesce(b.n, 0) AS n2
  FROM one a FULL JOIN two b ON a.o_orderkey = b.o_orderkey)"""

# Every row of either side once: rows of a repeated key pair up in order.
ORDERS_FIELDS = f"""{ORDERS_SIDES},
one AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderstatus NULLS FIRST,
  o_totalprice NULLS FIRST, o_orderdate NULLS FIRST) AS rn FROM s1),
two AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderstatus NULLS FIRST,
  o_totalprice NULLS FIRST, o_orderdate NULLS FIRST) AS rn FROM s2),
fields AS (
  SELECT a.o_orderkey AS o_orderkey_source1, b.o_orderkey AS o_orderkey_source2,
    a.o_orderstatus AS o_orderstatus_source1, b.o_orderstatus AS o_orderstatus_source2,
    a.o_totalprice AS o_totalprice_source1, b.o_totalprice AS o_totalprice_source2,
    CAST(a.o_orderdate AS VARCHAR) AS o_orderdate_source1,
    CAST(b.o_orderdate AS VARCHAR) AS o_orderdate_source2
  FROM one a FULL JOIN two b ON a.o_orderkey = b.o_orderkey AND a.rn = b.rn)"""

MISMATCHES = """mismatches AS (
  SELECT 'o_orderkey' AS column_name, 0 AS mismatch
  UNION ALL SELECT 'o_orderstatus', count(*) FROM pairs
    WHERE n1 = 1 AND n2 = 1 AND status1 IS DISTINCT FROM status2
  UNION ALL SELECT 'o_totalprice', count(*) FROM pairs
    WHERE n1 = 1 AND n2 = 1 AND price1 IS DISTINCT FROM price2
  UNION ALL SELECT 'o_orderdate', count(*) FROM pairs
    WHERE n1 = 1 AND n2 = 1 AND date1 IS DISTINCT FROM date2)"""


AUDIT = """SELECT m.*, c.* FROM mismatches m,
  (SELECT count(*) FILTER (WHERE n1 = 0) AS missing_from_src1,
     count(*) FILTER (WHERE n2 = 0) AS missing_from_src2,
     count(*) FILTER (WHERE n1 > 1) AS duplicate_keys_src1,
     count(*) FILTER (WHERE n2 > 1) AS duplicate_keys_src2 FROM pairs) c"""


def _draw(digest: str, index: int, low: int, high: int | str) -> str:
    number = f"CAST('0x' || substr({digest}, {1 + 8 * index}, 8) AS BIGINT)"
    return f"({low} + {number} % (({high}) - {low} + 1))"


def _choice(digest: str, index: int, values: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[{_draw(digest, index, 1, len(values))}]"


def _gen_actions() -> str:
    kind = _choice("what", 0, gen.ACTION_KINDS)
    return f"""WITH slots AS (SELECT DISTINCT user_id AS slot FROM events),
sessions AS (
  SELECT {_draw(f"md5('{SEED}:user:' || slot)", 0, 1, '(SELECT count(*) FROM slots)')}
      AS user_id,
    md5('{SEED}:session:' || slot || ':' || visit) AS session_id,
    md5('{SEED}:shape:' || slot || ':' || visit) AS shape
  FROM slots, (SELECT unnest(range(1, {gen.SESSIONS_PER_USER + 1})) AS visit)),
steps AS (
  SELECT user_id, session_id, {_draw('shape', 0, 0, 23)} AS hour,
    unnest(range(1, 1 + {_draw('shape', 1, *gen.STEPS)})) AS step FROM sessions),
digests AS (
  SELECT *, md5('{SEED}:when:' || session_id || ':' || step) AS moment,
    md5('{SEED}:what:' || session_id || ':' || step) AS what FROM steps),
drawn AS (
  SELECT *, {kind} AS kind, {_draw('what', 2, *gen.CATEGORIES)} AS category,
    {_draw('what', 3, *gen.PRODUCTS)} AS product FROM digests)
SELECT '{DAY}' AS date, user_id, session_id, {_draw('moment', 0, *gen.PAGES)} AS page_id,
  format('{DAY} {{:d}}:{{:02d}}:{{:02d}}', hour, {_draw('moment', 1, 0, 59)},
    {_draw('moment', 2, 0, 59)}) AS action_time,
  CASE WHEN kind = 'search' THEN {_choice('what', 1, gen.SEARCH_KEYWORDS)} END
    AS search_keyword,
  CASE WHEN kind = 'click' THEN category ELSE -1 END AS click_category_id,
  CASE WHEN kind = 'click' THEN product ELSE -1 END AS click_product_id,
  CASE WHEN kind = 'order' THEN CAST(category AS VARCHAR) END AS order_category_ids,
  CASE WHEN kind = 'order' THEN CAST(product AS VARCHAR) END AS order_product_ids,
  CASE WHEN kind = 'pay' THEN category END AS pay_category_ids,
  CASE WHEN kind = 'pay' THEN product END AS pay_product_ids,
  {_draw('moment', 3, *gen.CITIES)} AS city_id
FROM drawn"""


def _gen_users() -> str:
    draw = f"md5('{SEED}:person:' || c_custkey)"
    return f"""SELECT c_custkey AS user_id, 'user' || c_custkey AS username,
  'name' || c_custkey AS name, {_draw(draw, 0, *gen.AGES)} AS age,
  'professional' || {_draw(draw, 1, *gen.PROFESSIONS)} AS professional,
  'city' || {_draw(draw, 2, *gen.HOME_CITIES)} AS city,
  {_choice(draw, 3, gen.SEXES)} AS sex FROM customer"""


def _gen_products() -> str:
    status = _draw(f"md5('{SEED}:product:' || p_partkey)", 0, 0, 1)
    return f"""SELECT p_partkey AS product_id, 'product' || p_partkey AS product_name,
  '{{"product_status":' || {status} || '}}' AS extend_info FROM part"""


CLICKS_BY_DAY = """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS period_start,
  count(DISTINCT event_id) AS clicks
FROM events WHERE event_type = 'click'"""


def _report_rows() -> str:
    """Rows of the report tables but the audit, and the same with the sides exchanged."""

    def text(*columns: str) -> str:
        return " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in columns)

    parts = []
    for dataset, one, two in (("orders", 1, 2), ("swapped", 2, 1)):
        missing = text(f"CASE WHEN n{one} = 0 THEN 'source1' ELSE 'source2' END", "o_orderkey")
        sides = [f"{c}_source{n}" for c in ("o_orderkey", "o_orderstatus", "o_orderdate") for n in (one, two)]
        parts += [
            f"""SELECT '{dataset}' AS dataset, 'missing_keys' AS report, {missing} AS row
  FROM sizes WHERE n1 = 0 OR n2 = 0""",
            f"""SELECT '{dataset}', 'duplicate_keys', {text('o_orderkey', f'n{one}', f'n{two}')}
  FROM sizes WHERE n1 > 1 OR n2 > 1""",
            f"SELECT '{dataset}', 'field_to_field', {text(*sides)} FROM fields",
        ]
    return f"""{_with(ORDERS_FIELDS)},
sizes AS (
  SELECT o_orderkey, count(*) FILTER (side = 1) AS n1, count(*) FILTER (side = 2) AS n2
  FROM (SELECT 1 AS side, o_orderkey FROM s1 UNION ALL SELECT 2, o_orderkey FROM s2) GROUP BY 1)
""" + "\nUNION ALL ".join(parts)


def oracle_sql() -> dict[str, str]:
    counts = f"{_with(_actions(), CATEGORY_EVENTS)}SELECT category_id, {CATEGORY_SUMS}"
    recon = _with(ORDERS_PAIRS)
    return {
        "scan_actions": f"""{_with(_actions())}SELECT * REPLACE (
  CAST(date AS VARCHAR) AS date, {_time('action_time')} AS action_time) FROM actions""",
        "scan_users": f"{_with(USERS)}SELECT * FROM users",
        "scan_products": f"{_with(PRODUCTS)}SELECT * FROM products",
        "sql_source": f"{_with(USERS)}{TOP_USERS_SQL.format(user_info_table='users')}",
        "action_kinds": """SELECT k.kind, count(e.event_id) AS actions
FROM (VALUES ('search', 'view'), ('click', 'click'), ('order', 'signup'),
  ('pay', 'purchase'), ('none', 'error')) k(kind, event_type)
LEFT JOIN events e ON e.event_type = k.event_type GROUP BY k.kind""",
        "session_actions": f"""{_with(_actions())}SELECT session_id,
  row_number() OVER (PARTITION BY session_id ORDER BY action_time, action_id) AS step,
  {_time('action_time')} AS action_time, action_id, page_id FROM actions""",
        "session_store_steps": f"""{_with(_actions())}SELECT session_id,
  row_number() OVER (PARTITION BY session_id ORDER BY action_time, action_id) AS step,
  {_time('action_time')} AS action_time, action_id, page_id FROM actions""",
        "session_store_summary": f"""{_with(_actions(), SUMMARY, TERMS)}
SELECT {SESSION_COLUMNS}, search_keywords FROM summary LEFT JOIN keyword_lists USING (session_id)""",
        "session_summary": f"{_with(_actions(), SUMMARY)}SELECT {SESSION_COLUMNS} FROM summary",
        "session_user_check": f"""{_with(_actions())}
SELECT count(*) AS sessions, count(*) FILTER (WHERE users > 1) AS mixed_user_sessions
FROM (SELECT session_id, count(DISTINCT user_id) AS users FROM actions GROUP BY session_id)""",
        "session_terms": f"""{_with(_actions())}
SELECT session_id, 'search_keywords' AS list, search_keyword AS term,
  {_time('min(action_time)')} AS first_seen
FROM actions WHERE search_keyword IS NOT NULL GROUP BY session_id, search_keyword
UNION ALL
SELECT session_id, 'click_categories', CAST(click_category_id AS VARCHAR),
  {_time('min(action_time)')}
FROM actions WHERE click_category_id <> -1 GROUP BY session_id, click_category_id""",
        "session_keywords": f"{_with(_actions(), TERMS)}SELECT * FROM keyword_lists",
        "session_categories": f"{_with(_actions(), TERMS)}SELECT * FROM category_lists",
        "session_term_chunks": f"""{_with(_actions(MIXED_KEY))},
used AS (
  SELECT session_id, 'search_keywords' AS list, search_keyword AS term,
    min(row(action_time, action_id)) AS used FROM actions WHERE search_keyword <> '' GROUP BY ALL
  UNION ALL
  SELECT session_id, 'click_categories', CAST(click_category_id AS VARCHAR),
    min(row(action_time, action_id)) FROM actions WHERE click_category_id <> -1 GROUP BY ALL),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY session_id, list ORDER BY used, term) - 1 AS place FROM used)
SELECT session_id, list, place // {CHUNK_TERMS} AS chunk, count(*) AS n_terms,
  string_agg(term, ',' ORDER BY place) AS terms FROM placed GROUP BY 1, 2, 3""",
        "session_user_join": f"""{_with(_actions(), USERS, SUMMARY, JOINED)}
SELECT {SESSION_COLUMNS}, {USER_COLUMNS} FROM joined""",
        "session_filter_age": f"{_filtered()}SELECT {SESSION_COLUMNS}, {USER_COLUMNS} FROM filtered",
        "session_filter_full": _full_filter(),
        "session_full_info": f"""{_with(_actions(), USERS, SUMMARY, JOINED, FILTERED, TERMS)}
SELECT session_id, user_id, coalesce(search_keywords, '') AS search_keywords,
  coalesce(click_categories, '') AS click_categories, visit_length, step_length,
  {_time('start_time')} AS start_time, {USER_COLUMNS}
FROM filtered LEFT JOIN keyword_lists USING (session_id)
  LEFT JOIN category_lists USING (session_id)""",
        "session_totals": f"""{_filtered()}
SELECT count(*) AS sum_visit, count(*) AS sum_step FROM filtered""",
        "session_counters": _counters(),
        "session_info_counters": _counters(),
        "visit_histogram": f"""{_filtered()}SELECT {_bucket(VISIT, 'visit_length')} AS bucket,
  count(*) AS sessions FROM filtered GROUP BY 1""",
        "step_histogram": f"""{_filtered(MIXED_KEY)}SELECT {_bucket(STEP, 'step_length')} AS bucket,
  count(*) AS sessions FROM filtered GROUP BY 1""",
        "visit_length_ratio": _ratio(VISIT, "visit_length", DAY_KEY),
        "step_length_ratio": _ratio(STEP, "step_length", MIXED_KEY),
        "category_counts": f"{counts} FROM category_events GROUP BY category_id",
        "top10_categories": f"""
{_with(_actions(), USERS, SUMMARY, JOINED, FILTERED, CATEGORY_EVENTS)}
SELECT '{TASK_ID}' AS task_id, category_id, {CATEGORY_SUMS} FROM category_events
WHERE session_id IN (SELECT session_id FROM filtered) GROUP BY category_id
ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10""",
        "session_sample": _sample(100),
        "session_sample_large": _sample(LARGE_SAMPLE),
        "page_conversion": _page_conversion(),
        "recon_missing_keys": f"""{_with(ORDERS_SIDES)}
SELECT 'source1' AS missing_from, o_orderkey
  FROM (SELECT o_orderkey FROM s2 EXCEPT SELECT o_orderkey FROM s1)
UNION ALL SELECT 'source2', o_orderkey
  FROM (SELECT o_orderkey FROM s1 EXCEPT SELECT o_orderkey FROM s2)""",
        "recon_field_to_field": f"{_with(ORDERS_FIELDS)}SELECT * FROM fields",
        "recon_mismatch": f"{_with(ORDERS_PAIRS, MISMATCHES)}SELECT * FROM mismatches",
        "recon_audit": f"{_with(ORDERS_PAIRS, MISMATCHES)}{AUDIT}",
        "recon_duplicates": """SELECT l_orderkey, l_linenumber, count(*) AS copies
FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
        "recon_duplicate_pairs": f"""{recon}SELECT coalesce(k1, k2) AS o_orderkey,
  n1 AS rows_source1, n2 AS rows_source2 FROM pairs WHERE n1 > 1 OR n2 > 1""",
        "set_union_all": f"""{_with(ORDERS_SIDES)}
SELECT o_orderkey, o_orderstatus, o_totalprice FROM s1
UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice FROM s2""",
        "set_except": f"{_with(ORDERS_SIDES)}SELECT o_orderkey FROM s2 EXCEPT SELECT o_orderkey FROM s1",
        "set_intersect": f"""{_with(ORDERS_SIDES)}
SELECT o_orderkey, o_orderstatus, o_totalprice FROM s1
INTERSECT SELECT o_orderkey, o_orderstatus, o_totalprice FROM s2""",
        "gen_actions": _gen_actions(),
        "gen_users": _gen_users(),
        "gen_products": _gen_products(),
        "top_products_by_city": f"""{_with(_actions(), PRODUCTS)},
clicks AS (SELECT city_id, click_product_id AS product_id, count(*) AS clicks FROM actions
  WHERE click_product_id <> -1 GROUP BY ALL),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY city_id
  ORDER BY clicks DESC, product_id) AS INTEGER) AS rank FROM clicks)
SELECT city_id, rank, product_id, product_name,
  CAST(regexp_extract(extend_info, ':([0-9]+)', 1) AS INTEGER) AS product_status, clicks
FROM ranked LEFT JOIN products USING (product_id) WHERE rank <= 3""",
        "ad_click_traffic": f"{CLICKS_BY_DAY} GROUP BY 1",
        "ad_click_backlog": f"{CLICKS_BY_DAY} GROUP BY 1",
        "ad_click_late": f"""{_with(_actions())},
clicks AS (
  SELECT date, action_id % 2 = 1 AND date + INTERVAL 1 DAY <= max(action_time)
      FILTER (action_id % 2 = 0) OVER () - INTERVAL 1 HOUR AS late
  FROM actions WHERE click_category_id <> -1)
SELECT strftime(date, '%Y-%m-%d 00:00:00') AS period_start,
  count(*) FILTER (NOT late) AS clicks, count(*) FILTER (late) AS late_deliveries
FROM clicks GROUP BY 1""",
        "ad_clicks_by_day": f"{CLICKS_BY_DAY} GROUP BY 1",
        "time_texts": f"""{_with(_actions(), SUMMARY)}SELECT session_id,
  date_trunc('second', start_time) < date_trunc('second', end_time) AS takes_time,
  strftime(end_time, '%Y/%m/%d') AS end_day, strftime(end_time, '%H:%M:%S') AS end_clock
FROM summary""",
        "packed_summary": f"""{_with(_actions(), SUMMARY)}SELECT 'session_id=' || session_id
    || '|visit_length=' || visit_length || '|step_length=' || step_length AS packed,
  session_id, CAST(visit_length AS VARCHAR) AS visit_length,
  CAST(step_length AS VARCHAR) AS step_length, CAST(NULL AS VARCHAR) AS age FROM summary""",
        "counters_decoded": _counters(),
        "sink_replace": f"{_with(USERS)}SELECT * FROM users",
        "sink_append": f"""{_ratio(VISIT, "visit_length", DAY_KEY)}
UNION ALL SELECT * REPLACE ('task-2' AS task_id)
  FROM ({_ratio(VISIT, "visit_length", DAY_KEY)})""",
        "sink_ratio_text": f"""{_ratio(VISIT, "visit_length", DAY_KEY)}
UNION ALL SELECT * REPLACE ('task-2' AS task_id)
  FROM ({_ratio(VISIT, "visit_length", DAY_KEY)})""",
        "sink_report_rows": _report_rows(),
        "sink_report": f"""{_with(ORDERS_PAIRS, MISMATCHES)}
SELECT *, 'orders' AS dataset FROM ({AUDIT})
UNION ALL SELECT column_name, mismatch, missing_from_src2, missing_from_src1,
  duplicate_keys_src2, duplicate_keys_src1, 'swapped' FROM ({AUDIT})""",
        "load_generated": f"""SELECT '{ACTION_TABLE}' AS "table", count(*) AS n
  FROM ({_gen_actions()})
UNION ALL SELECT '{USER_TABLE}', count(*) FROM customer
UNION ALL SELECT '{PRODUCT_TABLE}', count(*) FROM part""",
        "gen_today": f"SELECT count(*) AS actions, CAST(0 AS BIGINT) AS of_other_days FROM ({_gen_actions()})",
    }
