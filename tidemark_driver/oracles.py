"""Independent SQL for the driver queries, written from the definitions: direct joins and groupings, no shared tricks."""

from __future__ import annotations

from tidemark.functions.text import VALID_TEXT
from tidemark_driver.inputs import LAUNCH_TABLES, ORDER_LINES, RENAMED, USER_LOGS

SQL: dict[str, str] = {}

# Fixed values, written here again so that a wrong one in the library shows.
MAKERS = {
    "华为": ("huawei", "honor"), "小米": ("xiaomi", "mi ", "redmi"), "OPPO": ("oppo",), "VIVO": ("vivo",), "三星": ("samsung",),
    "一加": ("oneplus",), "Realme": ("realme",),
}
MUNICIPALITIES = ("北京", "天津", "上海", "重庆")
PROVINCES = (
    "河北", "山西", "辽宁", "吉林", "黑龙江", "江苏", "浙江", "安徽", "福建", "江西", "山东", "河南", "湖北", "湖南", "广东", "海南", "四川",
    "贵州", "云南", "陕西", "甘肃", "青海", "台湾",
)
AUTONOMOUS = {"内蒙古": "自治区", "广西": "壮族自治区", "西藏": "自治区", "宁夏": "回族自治区", "新疆": "维吾尔自治区"}
SPECIAL = ("香港", "澳门")

CLOCK = "'%Y-%m-%d %H:%M:%S'"
ENDS = f"strftime(CAST(g.day AS TIMESTAMP), {CLOCK}) AS window_start, strftime(CAST(g.day AS TIMESTAMP) + {{end}}, {CLOCK}) AS window_end"


def _bounds(step: int) -> str:
    return ENDS.format(end=f"to_seconds((g.step + 1) * {step})")


def _grid(step: int, source: str = "order_lines") -> str:
    return f"""grid AS (
  SELECT day, UNNEST(generate_series(first, {86400 // step - 1})) AS step
  FROM (SELECT day, MIN(sec // {step}) AS first FROM {source} GROUP BY day))"""


def _cumulative(step: int, lines: str = ORDER_LINES, where: str = "") -> str:
    return f"""WITH {lines}, {_grid(step)}
SELECT {_bounds(step)}, CAST(SUM(o.amount) AS DECIMAL(38,2)) AS total_cumulative_amount
FROM grid g JOIN order_lines o ON o.day = g.day AND o.sec // {step} <= g.step {where}
GROUP BY g.day, g.step"""


SQL["cumulative_sales"] = _cumulative(10)
SQL["cumulative_sales_day"] = _cumulative(600, where="WHERE g.day = DATE '2024-01-15'")
SQL["cumulative_sales_zone"] = _cumulative(
    3600, ORDER_LINES.replace("FROM events", "FROM (SELECT * REPLACE (ts + INTERVAL 8 HOUR AS ts) FROM events)")
)
SQL["cumulative_sales_process"] = f"""WITH {ORDER_LINES}, {_grid(600)}
SELECT {_bounds(600)}, CAST(SUM(o.amount) AS DECIMAL(38,2)) AS period_amount,
       string_agg(o.id || '(' || CAST(o.amount AS VARCHAR) || ')', '+' ORDER BY o.ts, o.id) AS cumulative_process
FROM grid g JOIN order_lines o ON o.day = g.day AND o.sec // 600 <= g.step GROUP BY g.day, g.step"""
SQL["sale_lines"] = f"""WITH {ORDER_LINES}
SELECT strftime(CAST(day AS TIMESTAMP), {CLOCK}) AS window_start,
       strftime(CAST(day AS TIMESTAMP) + to_seconds((sec // 600 + 1) * 600), {CLOCK}) AS first_window_end,
       strftime(ts, {CLOCK}) AS ts, id, CAST(amount AS DECIMAL(10,2)) AS amount FROM order_lines"""


def _tumble(key: str, seconds: int, where: str = "") -> str:
    places = " || ',' || ".join(f"MAX(CASE WHEN rn = {n} THEN key ELSE '' END)" for n in range(1, 6))
    return f"""WITH {ORDER_LINES},
sums AS (SELECT day, sec // {seconds} AS w, {key} AS key, SUM(sale_num) AS total FROM order_lines GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY day, w ORDER BY total DESC, key) AS rn FROM sums)
SELECT strftime(CAST(day AS TIMESTAMP) + to_seconds(w * {seconds}), {CLOCK}) AS window_start,
       strftime(CAST(day AS TIMESTAMP) + to_seconds((w + 1) * {seconds}), {CLOCK}) AS window_end, {places} AS top5_ids
FROM ranked {where} GROUP BY day, w"""


SQL["tumble_top5"] = _tumble("id", 300)
SQL["tumble_top5_products"] = _tumble("product_id", 14400)


def _gmv(step: int) -> str:
    return f"""{_grid(step)},
product_sums AS (
  SELECT g.day, g.step, o.product_id, SUM(o.amount) AS gmv
  FROM grid g JOIN order_lines o ON o.day = g.day AND o.sec // {step} <= g.step GROUP BY g.day, g.step, o.product_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY day, step ORDER BY gmv DESC, product_id) AS rn FROM product_sums),
gmv AS (
  SELECT g.day AS ds, {_bounds(step)}, CAST(SUM(gmv) FILTER (rn <= 5) AS DECIMAL(18,2)) AS win_gmv,
         string_agg(product_id, ',' ORDER BY rn) FILTER (rn <= 5) AS win_gmv_ids,
         string_agg(product_id, ',' ORDER BY rn) FILTER (rn <= 5) AS top5_product_ids,
         CAST(SUM(gmv) AS DECIMAL(18,2)) AS total_gmv
  FROM ranked g GROUP BY g.day, g.step)"""


GMV = _gmv(600)
SQL["cumulative_gmv_topn"] = f"WITH {ORDER_LINES}, {GMV} SELECT * FROM gmv"
_SINCE = ORDER_LINES.replace("event_type = 'purchase'", "event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-20'")
SQL["gmv_since_midnight"] = f"WITH {_SINCE}, {_gmv(3600)} SELECT * FROM gmv"
SQL["gmv_daily_report"] = f"""WITH {ORDER_LINES}, {GMV},
days AS (SELECT * FROM gmv QUALIFY row_number() OVER (PARTITION BY ds ORDER BY window_end DESC) = 1),
listed AS (SELECT ds, UNNEST(string_split(top5_product_ids, ',')) AS id, UNNEST(generate_series(1, 5)) AS pos FROM days),
names AS (
  SELECT ds, list(p_name ORDER BY pos) AS names FROM listed LEFT JOIN part ON id = CAST(p_partkey AS VARCHAR)
  WHERE id IS NOT NULL GROUP BY ds),
paired AS (
  SELECT days.*, names, lag(names) OVER (ORDER BY ds) AS pre, lag(win_gmv) OVER (ORDER BY ds) AS pre_gmv
  FROM days JOIN names USING (ds))
SELECT ds, window_start, window_end, win_gmv, array_to_string(names, ',') AS "product_topN_name",
       coalesce(array_to_string(pre, ','), '') AS "pre_product_topN_name",
       printf('%.2f%%', coalesce(len(list_intersect(names, pre)), 0) / 5.0 * 100) AS similarity_rate,
       CASE WHEN pre_gmv <> 0 THEN printf('%.2f%%', round(CAST(win_gmv - pre_gmv AS DOUBLE) / CAST(pre_gmv AS DOUBLE) * 100, 2)) END AS dod_rate
FROM paired"""

# --- user logs -------------------------------------------------------------------------------------------------------

SQL["page_pv"] = f"""WITH {USER_LOGS}
SELECT strftime(ts, '%Y-%m-%d') AS stat_date, log_type AS page_type, COUNT(*) AS pv_count FROM user_logs GROUP BY ALL"""

SEARCH = """counts AS (
  SELECT keyword, COUNT(*) AS search_count FROM (
    SELECT trim(UNNEST(string_split(replace(p_name, ' ', ','), ','))) AS keyword
    FROM events JOIN part ON CAST(json_extract_string(props, '$.k') AS BIGINT) = p_partkey)
  WHERE keyword <> '' GROUP BY keyword),
top AS (
  SELECT keyword, search_count, CAST(row_number() OVER (ORDER BY search_count DESC, keyword) AS INTEGER) AS ranking,
         (SELECT COUNT(*) FROM counts) AS total_keywords FROM counts QUALIFY ranking <= 10)"""
SQL["keyword_counts"] = f"WITH {SEARCH} SELECT * FROM counts"
SQL["keyword_top10"] = f"WITH {SEARCH} SELECT * FROM top"
SQL["ranked_snapshot"] = f"WITH {SEARCH} SELECT *, '2024-01-31 00:00:00' AS update_time FROM top"

_OFFICIAL = (
    [n + "市" for n in MUNICIPALITIES] + [n + "省" for n in PROVINCES] + [n + s for n, s in AUTONOMOUS.items()] + list(SPECIAL)
)
_SHORT = [*MUNICIPALITIES, *PROVINCES, *AUTONOMOUS, *SPECIAL]
_CHECKS = [(o + "特别行政区" if o in SPECIAL else o, o) for o in _OFFICIAL] + list(zip(_SHORT, _OFFICIAL))
PLACES = f"""places AS (
  SELECT *, {' OR '.join(f"contains(region, '{n}')" for n in ['中国', *_OFFICIAL])} AS in_china,
         CASE {' '.join(f"WHEN contains(replace(region, '中国', ''), '{n}') THEN '{o}'" for n, o in _CHECKS)} ELSE '' END AS province
  FROM user_logs)"""
SQL["region_province"] = f"""WITH {USER_LOGS}, {PLACES}
SELECT region, in_china, province, COUNT(*) AS cnt FROM places GROUP BY ALL"""
SQL["region_login"] = f"""WITH {USER_LOGS}, {PLACES}
SELECT '中国' AS country, province, COUNT(*) AS login_count FROM places
WHERE log_type = 'signup' AND in_china AND province <> '' GROUP BY province"""
SQL["merge_aggregate"] = f"""WITH {USER_LOGS}, {PLACES}
SELECT '中国' AS country, province, COUNT(*) AS login_count,
       CASE WHEN MAX(ts) >= TIMESTAMP '2024-01-15' THEN 'batch 1' ELSE 'batch 0' END AS update_time
FROM places WHERE log_type = 'signup' AND in_china AND province <> '' GROUP BY province"""

SQL["path_distribution"] = f"""WITH {USER_LOGS},
pairs AS (
  SELECT '行为类型' AS stat_type, log_type AS stat_key FROM user_logs UNION ALL
  SELECT '操作类型', opa FROM user_logs UNION ALL SELECT '页面访问', pageinfo FROM user_logs),
counts AS (SELECT stat_type, stat_key, COUNT(*) AS stat_value FROM pairs WHERE stat_key <> '' GROUP BY ALL)
SELECT *, CAST(row_number() OVER (PARTITION BY stat_type ORDER BY stat_value DESC, stat_key) AS INTEGER) AS ranking
FROM counts QUALIFY ranking <= CASE stat_type WHEN '行为类型' THEN 10 ELSE 8 END"""
SQL["active_users"] = f"WITH {USER_LOGS} SELECT COUNT(DISTINCT user_id) AS active_users FROM user_logs WHERE user_id <> 'unknown'"


def _paths(rows: str, order: str, k: int) -> str:
    return f"""{rows},
marked AS (SELECT *, lag(log_type) OVER (PARTITION BY user_id ORDER BY {order}) AS before FROM user_logs),
paths AS (
  SELECT user_id, string_agg(log_type, ' → ' ORDER BY {order}) AS path, COUNT(*) AS steps
  FROM marked WHERE before IS NULL OR before <> log_type GROUP BY user_id)
SELECT path, steps, COUNT(*) AS users, MIN(user_id) AS first_user FROM paths WHERE steps >= 2 GROUP BY path, steps
ORDER BY users DESC, steps, first_user LIMIT {k}"""


SQL["path_patterns"] = _paths(f"WITH {USER_LOGS}", "ts, event_id", 5)
SQL["path_patterns_orders"] = _paths(
    """WITH user_logs AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS user_id, l_returnflag AS log_type, l_shipdate AS ts, l_linenumber, l_returnflag FROM lineitem)""",
    "ts, l_linenumber, l_returnflag",
    20,
)


def _has(column: str, marks: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains(lower({column}), '{m}')" for m in marks) + ")"


def _maker(column: str) -> str:
    whens = " ".join(f"WHEN {_has(column, marks)} THEN '{name}'" for name, marks in MAKERS.items())
    return f"CASE WHEN platform_type = 'iOS' THEN '苹果' {whens} ELSE '其他' END"


STATS = f"""typed AS (
  SELECT *, CASE WHEN {_has('plat', ('iphone', 'ios'))} OR {_has('brand', ('iphone', 'apple'))} THEN 'iOS'
                 WHEN {_has('plat', ('android',))} OR {_has('brand', ('huawei', 'xiaomi', 'oppo', 'vivo', 'samsung'))} THEN 'Android'
                 ELSE '其他' END AS platform_type FROM user_logs),
shown AS (SELECT *, {_maker('device')} AS maker FROM typed WHERE brand <> '' OR plat <> ''),
pairs AS (
  SELECT 'platform_type' AS stat_type, platform_type, platform_type AS stat_key FROM shown UNION ALL
  SELECT 'brand', platform_type, brand FROM shown WHERE brand NOT IN ('', '其他') UNION ALL
  SELECT 'device_model', platform_type, device FROM shown WHERE device <> '' AND maker <> '其他' UNION ALL
  SELECT 'platform_version', platform_type, platv FROM shown UNION ALL
  SELECT 'software_version', platform_type, softv FROM shown),
stats AS (SELECT stat_type, platform_type, stat_key, COUNT(*) AS stat_value FROM pairs GROUP BY ALL)"""
SQL["device_stats"] = f"WITH {USER_LOGS}, {STATS} SELECT * FROM stats"
SQL["platform_brand"] = f"""WITH {USER_LOGS}, {STATS}
SELECT plat, brand, device, platform_type AS platform, {_maker('device')} AS maker, COUNT(*) AS cnt FROM typed GROUP BY ALL"""
SQL["platform_share"] = f"""WITH {USER_LOGS}, {STATS},
counts AS (
  SELECT p AS platform_type, CAST(coalesce(SUM(stat_value), 0) AS BIGINT) AS cnt
  FROM (VALUES ('iOS'), ('Android'), ('其他')) t(p) LEFT JOIN stats ON stat_type = 'platform_type' AND stat_key = p GROUP BY p)
SELECT platform_type, cnt, printf('%.1f%%', cnt * 100.0 / SUM(cnt) OVER ()) AS share FROM counts"""
SQL["device_detail"] = f"""WITH {USER_LOGS}, {STATS}
SELECT platform_type, stat_key AS brand, '未知' AS model, stat_value AS cnt FROM stats WHERE stat_type = 'brand' UNION ALL
SELECT platform_type, {_maker('stat_key')}, stat_key, stat_value FROM stats WHERE stat_type = 'device_model'"""
SQL["stats_by_type"] = f"WITH {USER_LOGS}, {STATS} SELECT * FROM stats WHERE stat_type = 'brand'"
SQL["top_brands"] = f"""WITH {USER_LOGS}, {STATS} SELECT stat_key, stat_value FROM stats
WHERE stat_type = 'brand' AND platform_type = 'iOS' ORDER BY stat_value DESC, stat_key LIMIT 10"""
SQL["top_models"] = f"""WITH {USER_LOGS}, {STATS} SELECT stat_key, stat_value FROM stats
WHERE stat_type = 'device_model' AND platform_type = 'Android' ORDER BY stat_value DESC, stat_key LIMIT 10"""

PART = """CASE WHEN date_part('hour', ts) BETWEEN 6 AND 11 THEN '6:00-12:00' WHEN date_part('hour', ts) BETWEEN 12 AND 17 THEN '12:00-18:00'
     WHEN date_part('hour', ts) BETWEEN 18 AND 21 THEN '18:00-22:00' ELSE '22:00-6:00' END"""
SQL["day_part_counts"] = f"WITH {USER_LOGS} SELECT {PART} AS day_part, COUNT(*) AS cnt FROM user_logs GROUP BY ALL"
SQL["user_profile"] = f"""WITH {USER_LOGS}, seen AS (SELECT *, strftime(ts, '%Y-%m-%d') AS d, {PART} AS p FROM user_logs)
SELECT user_id, string_agg(DISTINCT d, ',' ORDER BY d) AS login_dates, CAST(COUNT(DISTINCT d) AS INTEGER) AS login_days_count,
       string_agg(DISTINCT p, ',' ORDER BY p) AS login_periods,
       CAST(bool_or(log_type = 'purchase') AS VARCHAR) AS has_purchase, CAST(bool_or(log_type = 'search') AS VARCHAR) AS has_search,
       CAST(bool_or(log_type = 'view') AS VARCHAR) AS has_view, MIN(d) AS first_login_date, MAX(d) AS last_login_date
FROM seen GROUP BY user_id"""

# --- new products ----------------------------------------------------------------------------------------------------

SQL["latest_partition"] = f"""WITH {USER_LOGS}, dated AS (SELECT event_id, user_id, log_type, strftime(ts, '%Y-%m-%d') AS ds FROM user_logs)
SELECT * FROM dated WHERE ds = (SELECT MAX(ds) FROM dated)"""
LAUNCHED = f"""WITH {LAUNCH_TABLES},
launched AS (
  SELECT p_partkey AS product_id, p_name AS product_title, p_brand AS product_code, p_type AS product_image,
         CAST(online_time AS DATE) AS online_date, online_time, CAST(coalesce(paid30.amount, 0) AS DECIMAL(38,2)) AS total_payment_30d
  FROM part JOIN online ON p_partkey = online.product_id LEFT JOIN paid30 ON p_partkey = paid30.product_id)"""
SQL["all_launches"] = f"{LAUNCHED} SELECT * REPLACE (strftime(online_time, {CLOCK}) AS online_time) FROM launched WHERE total_payment_30d >= 0"
SQL["recent_launches"] = f"""{LAUNCHED} SELECT * REPLACE (strftime(online_time, {CLOCK}) AS online_time),
  CAST(row_number() OVER (ORDER BY online_time DESC, product_id) AS INTEGER) AS rn
FROM launched WHERE total_payment_30d >= 0 QUALIFY rn <= 50"""
SQL["launch_calendar"] = f"""{LAUNCHED}
SELECT online_date, COUNT(DISTINCT product_id) AS new_product_count, CAST(SUM(total_payment_30d) AS DECIMAL(38,2)) AS total_payment_30d,
       CAST(year(online_date) AS INTEGER) AS year, CAST(month(online_date) AS INTEGER) AS month, CAST(day(online_date) AS INTEGER) AS day
FROM launched GROUP BY online_date"""


def _monitor(weight: str) -> str:
    return f"""WITH {LAUNCH_TABLES},
fresh AS (SELECT p_partkey AS product_id FROM part JOIN online ON p_partkey = product_id WHERE p_type = 'PROMO'),
viewed AS (
  SELECT DISTINCT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id FROM events WHERE event_type = 'view'),
v AS (SELECT * FROM viewed WHERE product_id IN (SELECT product_id FROM fresh)),
p AS (SELECT * FROM paid WHERE product_id IN (SELECT product_id FROM fresh)),
seen AS (SELECT product_id, COUNT(*) AS n FROM v GROUP BY product_id),
f AS (
  SELECT (SELECT COUNT(DISTINCT product_id) FROM fresh) AS products,
         (SELECT SUM(amount * {weight}) FROM paid30 JOIN fresh USING (product_id) LEFT JOIN seen USING (product_id)) AS money,
         (SELECT COUNT(DISTINCT order_id) FROM p) AS orders, (SELECT COUNT(DISTINCT user_id) FROM p) AS buyers,
         (SELECT COUNT(DISTINCT user_id) FROM v) AS viewers)
SELECT '最近30天' AS period_type, products AS new_product_count, CAST(coalesce(money, 0) AS DECIMAL(38,2)) AS total_payment_amount,
       orders AS total_order_count, buyers AS total_user_count,
       CAST(CASE WHEN viewers > 0 THEN round(orders * 100.0 / viewers, 2) ELSE 0 END AS DECIMAL(38,2)) AS conversion_rate
FROM f WHERE products > 0"""


SQL["launch_monitor"] = _monitor("1")
SQL["launch_monitor_plain_join"] = _monitor("coalesce(seen.n, 1)")

# --- ingest ----------------------------------------------------------------------------------------------------------

CHANGES = """changes AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(12,2)) AS old, CAST(o_totalprice AS DECIMAL(12,2)) + 1 AS new,
         UNNEST(['r', 'u', 'd']) AS op FROM orders),
kept AS (SELECT * FROM changes WHERE op = 'r' OR (op = 'u' AND o_orderkey % 5 = 0) OR (op = 'd' AND o_orderkey % 7 = 0))"""
_IMAGE = "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(CASE op WHEN 'u' THEN new ELSE old END AS VARCHAR) AS o_totalprice"
SQL["cdc_flatten"] = f"WITH {CHANGES} {_IMAGE}, 'shop.oms.orders' AS table_name, op FROM kept WHERE op <> 'd'"
SQL["cdc_deletes"] = f"WITH {CHANGES} {_IMAGE}, 'shop.oms.orders' AS table_name, op FROM kept WHERE op = 'd'"
SQL["cdc_latest_state"] = f"""WITH {CHANGES}, last AS (
  SELECT * FROM kept QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY CASE op WHEN 'r' THEN 1 WHEN 'u' THEN 2 ELSE 3 END DESC) = 1)
{_IMAGE}, op FROM last WHERE op <> 'd'"""
SQL["cdc_snapshot"] = "SELECT o_orderkey, o_custkey, o_orderstatus, 'shop.oms.orders' AS table_name, 'r' AS op FROM orders"
SQL["json_strict"] = f"WITH {CHANGES} SELECT o_orderkey, op FROM kept"

RECORDS = """records AS (
  SELECT event_id, event_id % 10 AS kind, CAST(event_id AS VARCHAR) AS id, CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) AS amount,
         (event_id + 1700000000) * CASE event_id % 2 WHEN 1 THEN 1 ELSE 1000 END AS epoch, event_type FROM events)"""
SQL["json_lenient"] = f"""WITH {RECORDS}
SELECT event_id, id, CASE WHEN kind NOT IN (4, 5) THEN amount END AS total_amount, CASE WHEN kind <> 3 THEN epoch END AS ts
FROM records WHERE kind > 2"""
SQL["json_keep"] = f"WITH {RECORDS} SELECT event_id, CASE WHEN kind > 2 THEN id END AS id, kind <= 2 AS is_bad FROM records"
SQL["json_rejects"] = f"""WITH {RECORDS}
SELECT event_id, CASE kind WHEN 0 THEN '{{"id":"' || id || '"' WHEN 1 THEN event_type ELSE '' END AS value FROM records WHERE kind <= 2"""
SQL["epoch_normalise"] = f"""WITH {RECORDS}
SELECT event_id, CASE WHEN kind <> 3 THEN strftime(TIMESTAMP '1970-01-01' + to_seconds(event_id + 1700000000), {CLOCK}) END AS event_time
FROM records WHERE kind > 2"""
SQL["rate_feed"] = """WITH quotes AS (
  SELECT UNNEST([{'zh': '美元', 'en': 'U' || o_orderkey, 'v': CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR)},
                 {'zh': '欧元', 'en': 'E' || o_orderkey, 'v': CAST(o_orderkey AS VARCHAR)}]) AS q, o_orderdate FROM orders)
SELECT q.zh AS ccy_zh, q.en AS ccy_en, strftime(o_orderdate, '%Y-%m-%d') || ' 09:30:00' AS ct_time,
  '{"ccy_zh":"' || q.zh || '","ccy_en":"' || q.en || '","rtbBid":"' || q.v || '","rthOfr":"' || q.v || '","rtcOfr":"' || q.v || '","rthBid":"'
  || q.v || '","rtcBid":"' || q.v || '","ratTim":"09:30:00","ratDat":"' || strftime(o_orderdate, '%Y年%m月%d日') || '"}' AS data
FROM quotes"""

# --- columns and small tables ----------------------------------------------------------------------------------------

_BUCKET = "lpad(CAST(CAST('0x' || right(md5(c_name), 3) AS INTEGER) % 128 AS VARCHAR), 4, '0')"
SQL["hash_bucket"] = f"""SELECT c_custkey, {_BUCKET} AS bucket,
  CASE lower(c_name) WHEN 'customer#000000001' THEN '9001' WHEN 'customer#000000002' THEN '9002' ELSE {_BUCKET} END AS bucket_hot FROM customer"""
SQL["row_key"] = """SELECT c_custkey, CAST(c_nationkey AS VARCHAR) || '_' || md5(c_name) AS item_key,
  md5(CAST(c_nationkey AS VARCHAR) || c_name) AS md5_key FROM customer"""
SQL["day_partitions"] = """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS ds, COUNT(o_orderkey) AS orders
FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY) t(d) LEFT JOIN orders ON CAST(o_orderdate AS DATE) = CAST(d AS DATE)
GROUP BY d"""
WORDS = r"""doc_words AS (SELECT * FROM (SELECT doc_id, UNNEST(string_split_regex(lower(text), '\s+')) AS word FROM documents) WHERE word <> ''),
listed AS (SELECT DISTINCT word FROM (SELECT UNNEST(string_split_regex(lower(text), '\s+')) AS word FROM benchmark) WHERE word <> '')"""
SQL["membership_flag"] = f"""WITH {WORDS} SELECT doc_id, COUNT(*) AS words, COUNT(listed.word) AS members
FROM doc_words LEFT JOIN listed USING (word) GROUP BY doc_id"""
SQL["membership_keep"] = f"WITH {WORDS} SELECT word, COUNT(*) AS cnt FROM doc_words WHERE word IN (FROM listed) GROUP BY word"
SQL["membership_drop"] = f"WITH {WORDS} SELECT doc_id, COUNT(*) AS cnt FROM doc_words WHERE word NOT IN (FROM listed) GROUP BY doc_id"
SQL["membership_check"] = f"WITH {WORDS} SELECT DISTINCT word, word IN (FROM listed) AS is_member FROM doc_words"
SQL["text_valid"] = f"""SELECT doc_id, COUNT(*) FILTER (regexp_matches(word, '{VALID_TEXT}')) AS valid, COUNT(*) AS words
FROM (SELECT doc_id, UNNEST(string_split_regex(text, '\\s+')) AS word FROM documents) WHERE word <> '' GROUP BY doc_id"""

_CELLS = ("c_acctbal", "c_mktsegment", "c_name", "c_nationkey")
CUSTOMER = """cust AS (SELECT CAST(c_custkey AS VARCHAR) AS row_key, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
  CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer)"""
CELLS = CUSTOMER + ", cells AS (" + " UNION ALL ".join(f"SELECT row_key, '{c}' AS qualifier, {c} AS value FROM cust" for c in _CELLS) + ")"
SQL["cells_put"] = f"WITH {CELLS} SELECT * FROM cells WHERE value IS NOT NULL"
SQL["cells_roundtrip"] = f"WITH {CUSTOMER} SELECT * FROM cust"
SQL["cells_scan_limit"] = f"WITH {CUSTOMER} SELECT row_key, c_name, c_mktsegment FROM cust ORDER BY row_key LIMIT 20"
_ENTRIES = " || ',' || ".join(f"'\"{c}\":\"' || {c} || '\"'" for c in _CELLS)
SQL["cells_documents"] = f"WITH {CUSTOMER} SELECT row_key, '{{' || {_ENTRIES} || '}}' AS document FROM cust"
SQL["cells_get"] = f"WITH {CELLS} SELECT * FROM cells WHERE row_key = '42'"
SQL["cells_row_count"] = "SELECT COUNT(*) AS row_count FROM customer"
SQL["delete_keys"] = """SELECT l_orderkey, COUNT(*) AS lines FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY l_orderkey"""
SQL["payload_words"] = """SELECT c_custkey, CAST(i AS INTEGER) AS pos, '0x' || md5(c_name) || md5(md5(c_name)) AS word
FROM customer, generate_series(0, 2) t(i) WHERE i < c_custkey % 4"""
SQL["amount_normalise"] = """WITH v AS (
  SELECT c_custkey, c_custkey % 3 = 0 AS is_decimal, CAST(c_acctbal AS DECIMAL(12,2)) AS d,
         CAST('0x' || left(md5(c_name), CAST(c_custkey % 30 + 1 AS INTEGER)) AS HUGEINT) AS h, CAST(1000000000000000000 AS HUGEINT) AS unit FROM customer)
SELECT c_custkey, CASE WHEN is_decimal THEN CAST(d AS VARCHAR) ELSE CAST(h AS VARCHAR) END AS amount,
  CASE WHEN is_decimal THEN
    CASE WHEN d < 0 THEN '-' ELSE '' END || '0.' || CASE WHEN d = 0 THEN '00' ELSE rtrim(lpad(CAST(CAST(abs(d) * 100 AS BIGINT) AS VARCHAR), 20, '0'), '0') END
  ELSE CAST(h // unit AS VARCHAR) || CASE WHEN h % unit = 0 THEN '' ELSE '.' || rtrim(lpad(CAST(h % unit AS VARCHAR), 18, '0'), '0') END END AS units
FROM v"""
SQL["append_list"] = """SELECT c_custkey, '[' || CASE c_custkey % 2 WHEN 0 THEN '"' || c_mktsegment || '","' || c_name || '",' ELSE '' END || '"' || c_name || '"]' AS items,
  '[' || CASE c_custkey % 2 WHEN 0 THEN c_mktsegment || ', ' || c_name || ', ' ELSE '' END || c_name || ']' AS shown FROM customer"""
SQL["keyword_split"] = """SELECT event_id, CAST(i - 1 AS INTEGER) AS pos, string_split(p_name, ' ')[i] AS word
FROM events JOIN part ON CAST(json_extract_string(props, '$.k') AS BIGINT) = p_partkey, generate_series(1, 9) t(i) WHERE i <= len(string_split(p_name, ' '))"""
SQL["string_utils"] = """SELECT p_partkey, upper(left(p_name, 1)) || substr(p_name, 2) AS upper_first, lower(left(p_type, 1)) || substr(p_type, 2) AS lower_first,
  p_partkey % 3 <> 1 AS is_blank, TRUE AS is_empty, replace(p_name, ' ', ', ') AS csv, replace(p_name, ' ', '|') AS joined,
  repeat('0', CAST(p_size % 5 AS INTEGER)) AS zeros, p_name AS clean_id, p_name AS field FROM part"""
SQL["camel_columns_rename"] = 'SELECT s_suppkey AS "sSuppkey", s_name AS "sName", s_nationkey AS "sNationkey" FROM supplier'
SQL["parse_clock"] = "SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN strftime(ts, '%Y-%m-%d') END AS day FROM events"
SQL["upsert_unique"] = f"""SELECT o_custkey, o_orderkey, strftime(o_orderdate, {CLOCK}) AS o_orderdate, o_orderpriority FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY orders.o_orderdate DESC, o_orderkey DESC) = 1"""

# --- streams: the batch answers, as far as windows are closed --------------------------------------------------------

CLOSED = ORDER_LINES.replace("order_lines AS", "all_lines AS") + """,
mark AS (SELECT MAX(ts) - INTERVAL 5 SECOND AS mark FROM all_lines),
order_lines AS (SELECT all_lines.* FROM all_lines, mark WHERE CAST(day AS TIMESTAMP) + to_seconds((sec // {step} + 1) * {step}) <= mark)"""
_UNTIL = " WHERE CAST(g.day AS TIMESTAMP) + to_seconds((g.step + 1) * 600) <= (SELECT mark FROM mark)"
SQL["stream_cumulative_sales"] = _cumulative(600, CLOSED.format(step=600), _UNTIL)
SQL["stream_gmv_topn"] = f"""WITH {CLOSED.format(step=600)}, {GMV} SELECT * FROM gmv
WHERE window_end <= (SELECT strftime(mark, {CLOCK}) FROM mark)"""
SQL["stream_tumble_top5"] = SQL["tumble_top5"].replace(ORDER_LINES, CLOSED.format(step=300))
SQL["stream_tumble_top5_zone"] = _tumble("id", 43200).replace(
    ORDER_LINES, CLOSED.format(step=43200).replace("FROM events", "FROM (SELECT * REPLACE (ts + INTERVAL 8 HOUR AS ts) FROM events)")
)
SQL["stream_page_pv"] = SQL["page_pv"]
SQL["stream_region_login"] = SQL["region_login"]
SQL["stream_device_stats"] = SQL["device_stats"]
SQL["stream_path_distribution"] = SQL["path_distribution"]
SQL["stream_user_profile"] = SQL["user_profile"]
SQL["stream_keyword_top10"] = SQL["keyword_top10"]
SQL["stream_cdc_latest_state"] = SQL["cdc_latest_state"]
SQL["stream_active_users"] = SQL["active_users"]
SQL["stream_active_users_daily"] = f"""WITH {USER_LOGS}
SELECT strftime(ts, '%Y-%m-%d') AS stat_date, COUNT(DISTINCT user_id) AS active_users FROM user_logs WHERE user_id <> 'unknown' GROUP BY ALL"""
# rows of the hours that have ended five seconds before the last event
_ENDED = "(SELECT * FROM events WHERE ts < (SELECT date_trunc('hour', MAX(ts) - INTERVAL 5 SECOND) FROM events))"
SQL["stream_path_patterns"] = _paths(f"WITH {USER_LOGS.replace('FROM events', 'FROM ' + _ENDED)}", "ts, event_id", 5)
SQL["read_latest"] = SQL["latest_partition"]
SQL["cdc_handed_over"] = SQL["cdc_latest_state"]
# changed orders go out as changes only, the others once as they were loaded; deletes have no row
SQL["cdc_handed_over_in_order"] = f"""WITH {CHANGES}
{_IMAGE}, 'shop.oms.orders' AS table_name, op FROM kept WHERE op = 'u' OR (op = 'r' AND o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0)"""
SQL["names_as_of"] = f"""WITH {ORDER_LINES}, {RENAMED}, versions AS (
  SELECT product_id, x.at AS since, lead(x.at) OVER (PARTITION BY product_id ORDER BY x.at, x.n) AS until, x.name AS name FROM renamed WHERE x.at IS NOT NULL)
SELECT o.id, o.product_id, v.name AS product_desc FROM order_lines o
LEFT JOIN versions v ON v.product_id = o.product_id AND v.since <= o.ts AND (v.until IS NULL OR o.ts < v.until)"""
SQL["stream_names_as_of"] = SQL["names_as_of"]
SQL["json_typed"] = SQL["json_lenient"]

# --- messages, files and event time ----------------------------------------------------------------------------------

_TEXT = """CASE kind WHEN 0 THEN '{"id":"' || id || '"' WHEN 1 THEN event_type WHEN 2 THEN ''
  WHEN 3 THEN '{"id":"' || id || '","total_amount":"' || amount || '","ts":"soon"}'
  WHEN 4 THEN '{"id":"' || id || '","total_amount":null,"ts":' || epoch || '}' WHEN 5 THEN '{"id":"' || id || '","ts":' || epoch || '}'
  ELSE '{"id":"' || id || '","total_amount":"' || amount || '","ts":' || epoch || '}' END"""
SQL["topic_texts"] = f"WITH {RECORDS} SELECT {_TEXT} AS value, COUNT(*) AS messages FROM records WHERE event_id % 4 > 0 GROUP BY ALL"
SQL["topic_messages"] = f"""WITH {ORDER_LINES} SELECT product_id AS key,
  '{{"id":"' || id || '","product_id":"' || product_id || '","total_amount":"' || CAST(CAST(amount AS DECIMAL(10,2)) AS VARCHAR) || '"}}' AS value
FROM order_lines"""
SQL["json_lines_roundtrip"] = SQL["json_lenient"].replace("SELECT event_id, id", "SELECT id")
SQL["partitioned_files"] = "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders"
SQL["bucketed_table"] = "SELECT o_custkey, COUNT(*) AS orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(38,2)) AS spent FROM orders GROUP BY 1"
SQL["truncated_folder"] = "SELECT COUNT(*) AS rows_left, MIN(c_custkey) AS least FROM customer WHERE c_custkey % 10 = 0"
SQL["event_times"] = """SELECT event_id, CASE WHEN event_id % 3 > 0 THEN event_id * 1000 WHEN event_id % 2 = 0 THEN event_id ELSE 0 END AS millis FROM events"""
SQL["json_event_times"] = f"WITH {RECORDS} SELECT event_id, CASE WHEN kind > 3 THEN epoch ELSE 0 END AS millis FROM records"
