"""The same queries as SQL over the driver's tables."""

from __future__ import annotations

_WINDOW_US = 6 * 3600 * 1_000_000
_GAP_US = 2 * 3600 * 1_000_000
_TTL_US = 4 * 3600 * 1_000_000


def _with(*parts: str, select: str) -> str:
    return f"WITH {', '.join(parts)} {select}"


USERS = """users AS (
  SELECT CAST(c_custkey % 3 + 1 AS VARCHAR) AS cert_type, CAST(c_custkey AS VARCHAR) AS cert_nbr,
    20 + (c_custkey * 7919 % 10000) / 1e4 AS lat, 100 + (c_custkey * 104729 % 10000) / 1e4 AS lng,
    20 + (c_custkey * 6827 % 10000) / 1e4 AS lat_night,
    100 + (c_custkey * 2909 % 10000) / 1e4 AS lng_night,
    CASE c_custkey % 3 WHEN 0 THEN '20220207' WHEN 1 THEN '20220210' ELSE '20220218' END AS partstart
  FROM customer)"""

REQUESTS = """requests AS (
  SELECT s_suppkey AS num, 'C' || s_suppkey AS coupon_id, 'S' || s_suppkey AS store_id,
    'R' || s_suppkey AS unique_req_id, CAST(5000 + s_suppkey % 4 * 5000 AS VARCHAR) AS store_range,
    CAST(s_suppkey % 50 AS VARCHAR) AS user_num,
    CASE WHEN s_suppkey % 3 = 0 THEN '02' ELSE '01' END AS message_type,
    20 + (s_suppkey * 6101 % 10000) / 1e4 + CASE WHEN s_suppkey % 10 = 9 THEN 40 ELSE 0 END AS slat,
    100 + (s_suppkey * 3571 % 10000) / 1e4 AS slng
  FROM supplier)"""

# Records of both topics.
TOPICS = """topics AS (
  SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS trade_id, epoch_us(ts) AS us,
    CASE WHEN event_type IN ('signup', 'purchase') THEN 'm' || event_id END AS msg_id,
    CASE WHEN event_type NOT IN ('signup', 'purchase') THEN CAST(event_id % 10 AS VARCHAR) END
      AS status_code
  FROM events)"""

SCORES = """scores AS (
  SELECT CAST(o_custkey AS VARCHAR) AS name, CAST(round(o_totalprice) AS BIGINT) AS score,
    o_orderkey AS seq FROM orders)"""


def _distance(lat: str = "u.lat", lng: str = "u.lng") -> str:
    return (
        f"round(6378.138 * 2 * asin(sqrt(pow(sin((r.slat * pi() / 180 - {lat} * pi() / 180) / 2), 2)"
        f" + cos(r.slat * pi() / 180) * cos({lat} * pi() / 180)"
        f" * pow(sin((r.slng * pi() / 180 - {lng} * pi() / 180) / 2), 2))) * 1000)"
    )


def _pairs(lat: str = "u.lat", lng: str = "u.lng", extra: str = "true", banded: bool = True) -> str:
    """Requests and users in range, made once. No range exceeds 20 km, so with ``banded``
    users meet the requests of their own fifth of a degree and of its neighbours only."""
    bands = "(VALUES (-1), (0), (1)) AS bands(band)" if banded else "(VALUES (0)) AS bands(band)"
    near = f"floor({lat} * 5) = floor(r.slat * 5) + band" if banded else "true"
    return f"""pairs AS MATERIALIZED (
  SELECT * EXCLUDE (band) FROM (
    SELECT r.*, u.cert_type, u.cert_nbr, band, {_distance(lat, lng)} AS distance_m
    FROM (SELECT * FROM requests CROSS JOIN {bands}) r JOIN users u ON {near} AND {extra})
  WHERE distance_m < CAST(store_range AS DOUBLE))"""


COUNTS = """counts AS MATERIALIZED (
  SELECT unique_req_id, coalesce(n, 0) AS n FROM requests LEFT JOIN (
    SELECT unique_req_id, count(*) AS n FROM pairs GROUP BY unique_req_id) USING (unique_req_id))"""

RECORDS = """records AS (
  SELECT p.coupon_id, '02' AS message_type, CAST(c.n AS VARCHAR) AS coupon_send_num,
    p.cert_type AS id_type, p.cert_nbr AS id_number, p.store_id, p.store_range, p.unique_req_id
  FROM pairs p JOIN counts c ON c.unique_req_id = p.unique_req_id
  UNION ALL
  SELECT NULL, kind, CAST(n AS VARCHAR), NULL, NULL, NULL, NULL, unique_req_id
  FROM counts JOIN (VALUES ('01'), ('03')) AS kinds(kind) ON kind = '01' OR n > 0)"""

_MATCH = (USERS, REQUESTS, _pairs())

_BUCKETS = f"""buckets AS (
  SELECT *, us // {_WINDOW_US} * {_WINDOW_US} AS window_start,
    us // {_WINDOW_US} * {_WINDOW_US} + {_WINDOW_US} AS window_end FROM topics)"""

_SESSIONS = f"""marked AS (
  SELECT *, CASE WHEN us - lag(us) OVER w <= {_GAP_US} THEN 0 ELSE 1 END AS opens
  FROM topics WINDOW w AS (PARTITION BY trade_id ORDER BY us, seq)),
numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY trade_id ORDER BY us, seq) AS no FROM marked),
sessions AS (
  SELECT *, min(us) OVER (PARTITION BY trade_id, no) AS window_start,
    max(us) OVER (PARTITION BY trade_id, no) + {_GAP_US} AS window_end FROM numbered)"""


def _error(message: str) -> str:
    return (
        f"""'{{"message":"{message}","value":null,"success":false,"msgCode":"999999","""
        """"resultMap":null}'"""
    )


_PAIR = """'{"msgId":"' || msg_id || '","statusCode":"' || status_code || '"}'"""
_PAIR_OR_NULL = """'{"msgId":' || coalesce('"' || msg_id || '"', 'null')
  || ',"statusCode":' || coalesce('"' || status_code || '"', 'null') || '}'"""


def _pair_by_last(source: str, closed: str = "true") -> str:
    return f"""SELECT trade_id, window_start, window_end,
  CASE WHEN full_pair THEN msg_id END AS msg_id,
  CASE WHEN full_pair THEN status_code END AS status_code,
  CASE WHEN full_pair THEN {_PAIR} ELSE {_error('数据未到齐')} END AS value
FROM (SELECT *, msg_id IS NOT NULL AND status_code IS NOT NULL AS full_pair FROM (
  SELECT trade_id, window_start, window_end,
    arg_max(msg_id, us) FILTER (msg_id IS NOT NULL) AS msg_id,
    arg_max(status_code, us) FILTER (status_code IS NOT NULL) AS status_code
  FROM {source} GROUP BY trade_id, window_start, window_end)) WHERE {closed}"""


def _pair_by_count(source: str, closed: str = "true") -> str:
    return f"""SELECT trade_id, window_start, window_end,
  CASE WHEN n > 1 THEN msg_id END AS msg_id, status_code,
  CASE WHEN n > 1 THEN {_PAIR_OR_NULL} ELSE {_error('数据存在延迟')} END AS value
FROM (SELECT trade_id, window_start, window_end, count(*) AS n,
    arg_min(msg_id, us) FILTER (msg_id IS NOT NULL) AS msg_id,
    arg_min(status_code, us) FILTER (msg_id IS NULL) AS status_code
  FROM {source} GROUP BY trade_id, window_start, window_end)
WHERE (n > 1 OR msg_id IS NOT NULL) AND {closed}"""


_CLOSED = "window_end <= (SELECT max(us) FROM topics)"


def _label(start: str, end: str) -> str:
    return (
        f"'start: ' || strftime(make_timestamp({start}), '%Y-%m-%d %H:%M:%S')"
        f" || ' end:' || strftime(make_timestamp({end}), '%Y-%m-%d %H:%M:%S')"
    )


_INFO = f"""info AS (
  SELECT trade_id, count(*) AS records, {_label('window_start', 'window_end')} AS bounds,
    'apply result' AS result
  FROM buckets GROUP BY trade_id, window_start, window_end)"""

_TTL_JOIN = _with(
    TOPICS,
    f"""held AS (
  SELECT *, last_value(msg_id IGNORE NULLS) OVER w AS held_id,
    last_value(CASE WHEN msg_id IS NOT NULL THEN us END IGNORE NULLS) OVER w AS held_us
  FROM topics WINDOW w AS (PARTITION BY trade_id ORDER BY us, seq
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
    select=f"""SELECT trade_id, seq, held_id AS msg_id, status_code FROM held
WHERE msg_id IS NULL AND us - held_us < {_TTL_US}""",
)

_CHANGELOG = _with(
    SCORES,
    """sums AS (
  SELECT *, sum(score) OVER (PARTITION BY name ORDER BY seq) AS total FROM scores),
steps AS (
  SELECT *, lag(total) OVER (PARTITION BY name ORDER BY seq) AS old FROM sums)""",
    select="""SELECT true AS is_add, name, CAST(total AS BIGINT) AS total, seq FROM steps
WHERE old IS NULL OR old <> total
UNION ALL
SELECT false, name, CAST(old AS BIGINT), seq FROM steps WHERE old <> total""",
)

_HISTORY = """WITH entries AS (
  SELECT 'u' || user_id AS msg_id, event_type AS status_code, event_id AS seq FROM events),
firsts AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY msg_id, status_code ORDER BY seq) = 1
    THEN 1 ELSE 0 END AS fresh FROM entries)
SELECT msg_id, status_code, seq,
  CAST(sum(fresh) OVER (PARTITION BY msg_id ORDER BY seq) AS BIGINT) AS entries FROM firsts"""

_COUPON = _with(*_MATCH, COUNTS, RECORDS, select="SELECT * FROM records")
_SUMMARY = "SELECT partstart, count(*) AS cnt, max(CAST(cert_nbr AS BIGINT)) AS last_nbr FROM users"
_BY_KEY = """SELECT coupon_id, store_id, store_range, user_num, count(*) AS cnt
FROM pairs GROUP BY coupon_id, store_id, store_range, user_num"""

SQL: dict[str, str] = {
    "coupon_match": _COUPON,
    "coupon_messages": _with(
        *_MATCH,
        COUNTS,
        RECORDS,
        select="""SELECT CAST(to_json({'COUPON_ID': coupon_id, 'MESSAGE_TYPE': message_type,
  'COUPON_SEND_NUM': coupon_send_num, 'SERIAL_NO': NULL, 'ID_TYPE': id_type,
  'ID_NUMBER': id_number, 'STORE_ID': store_id, 'STORE_RANGE': store_range,
  'UNIQUE_REQ_ID': unique_req_id}) AS VARCHAR) AS value FROM records""",
    ),
    "coupon_match_day_night": _with(
        USERS,
        REQUESTS,
        _pairs(
            "CASE WHEN r.num % 60 % 2 = 0 THEN u.lat ELSE u.lat_night END",
            "CASE WHEN r.num % 60 % 2 = 0 THEN u.lng ELSE u.lng_night END",
            banded=False,
        ),
        select="""SELECT unique_req_id, CAST(num % 60 % 2 AS VARCHAR) AS period,
  cert_nbr AS id_number, distance_m FROM pairs""",
    ),
    "coupon_match_night": _with(
        USERS,
        REQUESTS,
        _pairs("u.lat_night", "u.lng_night"),
        COUNTS,
        RECORDS,
        select="SELECT * FROM records",
    ),
    "coupon_match_grid": _with(
        *_MATCH, select="SELECT unique_req_id, cert_nbr AS id_number, distance_m FROM pairs"
    ),
    "coupon_count": _with(*_MATCH, select="SELECT count(*) AS cnt FROM pairs"),
    "coupon_count_by_key": _with(*_MATCH, select=_BY_KEY),
    "coupon_top1": _with(
        *_MATCH,
        select=f"""SELECT coupon_id, store_id, store_range, cnt FROM ({_BY_KEY})
ORDER BY cnt DESC, coupon_id, store_id, store_range, user_num LIMIT 1""",
    ),
    "coupon_limit_count": _with(
        *_MATCH, select="SELECT count(*) AS cnt FROM (SELECT * FROM pairs LIMIT 10000)"
    ),
    "coupon_groups": _with(
        *_MATCH, select="SELECT DISTINCT coupon_id, store_id, store_range, user_num FROM pairs"
    ),
    "coupon_split": _with(
        REQUESTS,
        select="""SELECT unique_req_id, message_type, 'item' AS route FROM requests
WHERE message_type = '01'
UNION ALL SELECT unique_req_id, message_type, 'item_copy' FROM requests WHERE message_type = '01'
UNION ALL SELECT unique_req_id, message_type, 'count' FROM requests WHERE message_type = '02'""",
    ),
    "request_enrich": _with(
        REQUESTS,
        select="""SELECT coupon_id, store_id, store_range, user_num, unique_req_id,
  CAST(slat AS VARCHAR) AS store_latitude, '1' AS type, '2022-02-10 10:00:00' AS date_string
FROM requests""",
    ),
    "filter_chain": """SELECT p_partkey AS id, p_name AS name, p_size AS age FROM part
WHERE p_size >= 18 AND starts_with(p_name, 'r')""",
    "text_contains": """SELECT p_partkey AS id, 'new' || p_name AS value FROM part
WHERE contains(p_name, 'ring')""",
    "side_route": """SELECT p_partkey AS id, p_name AS name,
  CASE WHEN starts_with(p_name, 'r') THEN 'main' ELSE 'side' END AS route FROM part""",
    "window_side_output": _with(
        TOPICS,
        _BUCKETS,
        _INFO,
        select="""SELECT trade_id, bounds, result, route FROM info
JOIN (VALUES ('main'), ('side')) AS routes(route) ON true""",
    ),
    "json_enrich": """SELECT event_id,
  CAST(json_merge_patch(props, '{"processFlag":true}') AS VARCHAR) AS value FROM events""",
    "json_filter": _with(
        TOPICS,
        select="""SELECT '{"msgId":null,"tradeId":"' || trade_id || '","statusCode":"0","createTime":"'
  || strftime(make_timestamp(us), '%Y-%m-%d %H:%M:%S') || '"}' AS value
FROM topics WHERE status_code = '0'""",
    ),
    "json_flatmap": _with(
        TOPICS,
        select="""SELECT seq, status_code, '2022-02-10 10:00:00' AS update_time
FROM topics WHERE CAST(status_code AS INTEGER) < 5""",
    ),
    "json_types": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS from_map,
  user_id AS from_list, CAST(json_extract_string(props, '$.k') AS BIGINT) AS from_copy FROM events""",
    "job_param": "SELECT c_custkey AS id, c_name || '-tide' AS name FROM customer",
    "sql_view": """SELECT c_custkey AS id, c_name AS name FROM customer
WHERE c_mktsegment = 'BUILDING'""",
    "union_topics": _with(
        TOPICS,
        select="""SELECT trade_id, count(msg_id) AS messages, count(status_code) AS statuses
FROM topics GROUP BY trade_id""",
    ),
    "table_product": """SELECT 'R' || s_suppkey AS unique_req_id, r_name AS name
FROM supplier, region""",
    "product_count": """SELECT count(*) AS cnt FROM events JOIN nation ON n_regionkey = 1""",
    "equi_join": """SELECT o_orderkey, o_orderstatus, c_name, c_mktsegment
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "where_equi_join": """SELECT c_custkey, c_mktsegment, count(c_custkey) AS user_count
FROM customer, orders WHERE c_custkey = o_custkey GROUP BY c_custkey, c_mktsegment""",
    "skew_join": """SELECT s_suppkey, c_mktsegment, count(*) AS cnt
FROM supplier JOIN customer ON s_nationkey = c_nationkey GROUP BY s_suppkey, c_mktsegment""",
    "lookup_join": """SELECT event_id AS seq, n_nationkey, n_name
FROM events JOIN nation ON n_nationkey = 1""",
    "partition_fixed": _with(
        USERS, select=f"{_SUMMARY} WHERE partstart = '20220210' GROUP BY partstart"
    ),
    "partition_latest": _with(
        USERS,
        select=f"{_SUMMARY} WHERE partstart = (SELECT max(partstart) FROM users) GROUP BY partstart",
    ),
    "partition_all": _with(USERS, select=f"{_SUMMARY} GROUP BY partstart"),
    "temporal_join": _with(
        USERS,
        REQUESTS,
        _pairs(
            extra="u.cert_type = '3' AND u.partstart = (SELECT max(partstart) FROM users)"
        ),
        select="""SELECT unique_req_id, '3' AS type, cert_nbr AS id_number, distance_m
FROM pairs""",
    ),
    "table_roundtrip": _with(
        USERS,
        select="""SELECT partstart, cert_type, count(*) AS cnt, 0 AS days FROM (
  SELECT partstart, cert_type FROM users WHERE partstart <> '20220210'
  UNION ALL SELECT '20220210', cert_type FROM users WHERE cert_type = '1')
GROUP BY partstart, cert_type""",
    ),
    "sum_by_key": _with(
        SCORES, select="SELECT name, CAST(sum(score) AS BIGINT) AS total FROM scores GROUP BY name"
    ),
    "sum_changelog": _CHANGELOG,
    "tumbling_pair": _with(TOPICS, _BUCKETS, select=_pair_by_last("buckets")),
    "tumbling_pair_by_count": _with(TOPICS, _BUCKETS, select=_pair_by_count("buckets")),
    "window_label": _with(TOPICS, _BUCKETS, _INFO, select="SELECT * FROM info"),
    "window_members": _with(
        TOPICS,
        _BUCKETS,
        select=f"""SELECT trade_id, seq, {_label('window_start', 'window_end')} AS bounds
FROM buckets""",
    ),
    "session_pair": _with(TOPICS, _SESSIONS, select=_pair_by_count("sessions")),
    "session_join": _with(
        TOPICS,
        _SESSIONS,
        select="""SELECT m.trade_id, m.window_start AS session_start, m.window_end AS session_end,
  m.msg_id, m.us AS message_time, s.status_code, s.us AS status_time,
  '{"msgId":"' || m.msg_id || '","statusCode":"' || s.status_code || '"}' AS value
FROM sessions m JOIN sessions s ON m.trade_id = s.trade_id AND m.no = s.no
WHERE m.msg_id IS NOT NULL AND s.msg_id IS NULL""",
    ),
    "state_ttl_join": _TTL_JOIN,
    "state_history": _HISTORY,
    "date_functions": """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS day_text,
  strftime(o_orderdate, '%Y%m%d%H%M%S') AS compact,
  date_diff('day', CAST(o_orderdate AS DATE), DATE '2023-06-01') AS days,
  CAST(m // 12 AS INTEGER) AS part_years, CAST(m % 12 AS INTEGER) AS part_months,
  CAST(date_diff('day', CAST(o_orderdate + to_months(CAST(m AS INTEGER)) AS DATE),
    DATE '2021-03-15') AS INTEGER) AS part_days
FROM (SELECT *, (2021 - year(o_orderdate)) * 12 + 3 - month(o_orderdate)
  - CASE WHEN day(o_orderdate) > 15 THEN 1 ELSE 0 END AS m FROM orders)""",
    "key_text": _with(
        TOPICS,
        select="""SELECT seq,
  trade_id || '_' || coalesce(msg_id, '') || '_' || coalesce(status_code, '') AS key_text,
  coalesce(msg_id, '') <> '' AS has_msg, trim(coalesce(status_code, '')) = '' AS no_status
FROM topics""",
    ),
    "error_envelope": _with(
        TOPICS,
        select="""SELECT seq, CASE WHEN msg_id IS NULL THEN
  '{"message":"数据未到齐","value":"' || status_code
    || '","success":false,"msgCode":"999999","resultMap":null}'
  ELSE '{"message":"处理成功","value":"' || msg_id
    || '","success":true,"msgCode":"000000","resultMap":null}' END AS value FROM topics""",
    ),
}

_PUNCTUATED = "window_end <= (SELECT max(us) FROM topics WHERE msg_id IS NULL)"

SQL |= {
    "stream_tumbling": _with(TOPICS, _BUCKETS, select=_pair_by_last("buckets", _CLOSED)),
    "stream_session": _with(TOPICS, _SESSIONS, select=_pair_by_count("sessions", _CLOSED)),
    "stream_punctuated": _with(TOPICS, _BUCKETS, select=_pair_by_last("buckets", _PUNCTUATED)),
    "stream_state_history": _HISTORY,
    "stream_event_ttl": _TTL_JOIN,
    "stream_processing_windows": _with(
        TOPICS, select="SELECT trade_id, count(*) AS records FROM topics GROUP BY trade_id"
    ),
    "stream_late_windows": _with(
        TOPICS,
        _BUCKETS,
        select="""SELECT trade_id, window_start, count(*) AS records FROM buckets
GROUP BY trade_id, window_start""",
    ),
    "stream_sum": SQL["sum_by_key"],
    "stream_changelog": _CHANGELOG,
    "stream_union": SQL["union_topics"],
    "stream_join_table": SQL["equi_join"],
    "stream_lookup": SQL["lookup_join"],
    "stream_coupon": _COUPON,
    "stream_temporal_join": _with(
        USERS,
        REQUESTS,
        _pairs(extra="u.cert_type = '3' AND u.partstart = (SELECT max(partstart) FROM users)"),
        COUNTS,
        RECORDS,
        select="SELECT * FROM records",
    ),
    "stream_routes": SQL["side_route"],
    "stream_top1": """SELECT o_custkey, count(*) AS cnt FROM orders GROUP BY o_custkey
ORDER BY cnt DESC, o_custkey LIMIT 1""",
    "stream_resume": "SELECT event_type, count(*) AS cnt FROM events GROUP BY event_type",
}

# Queries whose input comes in rounds: slices of time, with every seventh record one
# round late. A delay of one slice drops nothing, half a slice does.
_ROUNDS, _LATE_OF, _LATE = 4, 7, 3
_DELIVERED = f"""span AS (
  SELECT min(us) AS low, max(us) // 1000 AS high_ms, (max(us) - min(us)) // {_ROUNDS * 1_000_000} + 1 AS slice_s
  FROM topics),
delivered AS (
  SELECT topics.*, (us - low) // (slice_s * 1000000)
    + CASE WHEN seq % {_LATE_OF} = {_LATE} THEN 1 ELSE 0 END AS round, high_ms - slice_s * 1000 AS closed_ms
  FROM topics, span)"""

_FINAL_MS = "(SELECT high_ms - slice_s * 1000 FROM span)"

# The watermark before a round, with a delay of two quarters of a slice; a window is
# late when it ends at or before it.
_LATE_ROUNDS = f"""marks AS (
  SELECT k, (SELECT max(us) // 1000 FROM delivered WHERE round < k) - 2000 * (slice_s // 4) AS mark
  FROM span, range({_ROUNDS + 1}) r(k)),
placed AS (
  SELECT *, us // {_WINDOW_US} * {_WINDOW_US} AS window_start FROM delivered),
judged AS (
  SELECT placed.*, coalesce((window_start + {_WINDOW_US}) // 1000 <= mark, false) AS late
  FROM placed JOIN marks ON k = round)"""

SQL |= {
    "stream_session_join": _with(
        TOPICS,
        _DELIVERED,
        _SESSIONS,
        select=f"""SELECT m.trade_id, m.window_start AS session_start, m.window_end AS session_end,
  m.msg_id, m.us AS message_time, s.status_code, s.us AS status_time,
  '{{"msgId":"' || m.msg_id || '","statusCode":"' || s.status_code || '"}}' AS value
FROM sessions m JOIN sessions s ON m.trade_id = s.trade_id AND m.no = s.no
WHERE m.msg_id IS NOT NULL AND s.msg_id IS NULL AND m.window_end // 1000 + 1 <= {_FINAL_MS}""",
    ),
    "stream_join_changelog": " UNION ALL ".join(
        f"""SELECT {k} AS round, c_custkey, c_mktsegment, count(*) AS total
FROM customer JOIN orders ON c_custkey = o_custkey WHERE c_custkey % 3 <= {k} AND o_orderkey % 3 <= {k}
GROUP BY c_custkey, c_mktsegment"""
        for k in range(3)
    ),
    "stream_top_changes": " UNION ALL ".join(
        f"""SELECT * FROM (SELECT {k} AS round, CAST(o_custkey AS VARCHAR) AS name, count(*) AS total,
  CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(o_custkey AS VARCHAR)) AS INTEGER) AS rank
FROM orders WHERE o_orderkey % 3 <= {k} GROUP BY o_custkey) WHERE rank <= 3"""
        for k in range(3)
    ),
    "stream_late_rounds": _with(
        TOPICS,
        _DELIVERED,
        _LATE_ROUNDS,
        select=f"""SELECT 'window' AS kind, trade_id, window_start, count(*) AS records,
  CAST(count(DISTINCT round) AS INTEGER) AS given
FROM judged WHERE NOT late GROUP BY trade_id, window_start
UNION ALL
SELECT 'late', NULL, NULL, count(DISTINCT (trade_id, window_start)) FILTER (late), CAST(k AS INTEGER)
FROM range({_ROUNDS + 1}) r(k) LEFT JOIN judged ON round = k GROUP BY k""",
    ),
    "stream_resume_state": _with(
        TOPICS,
        _DELIVERED,
        _BUCKETS,
        select=f"""SELECT trade_id, window_start, count(*) AS records,
  CASE WHEN window_end // 1000 <= {_FINAL_MS} THEN 'given' ELSE 'held' END AS place
FROM buckets GROUP BY trade_id, window_start, window_end""",
    ),
    "stream_fresh_lookup": _with(
        TOPICS,
        _DELIVERED,
        select="""SELECT seq, n_nationkey, n_name FROM delivered JOIN nation
ON n_regionkey = 1 AND (round > 0 OR n_nationkey < 10)""",
    ),
    "stream_ttl_lives": _with(
        TOPICS,
        select="""SELECT s.trade_id, m.msg_id, s.status_code, 'long' AS life FROM topics s JOIN (
  SELECT trade_id, arg_max(msg_id, (us, seq)) AS msg_id FROM topics WHERE msg_id IS NOT NULL
  GROUP BY trade_id) m ON m.trade_id = s.trade_id WHERE s.msg_id IS NULL""",
    ),
    "stream_processing_tumbling": _with(
        TOPICS,
        _DELIVERED,
        select="""SELECT trade_id, count(*) AS records, true AS whole_bounds FROM delivered
WHERE round < 2 GROUP BY trade_id""",
    ),
    "stream_coupon_rounds": _COUPON,
    "stream_partitions": SQL["partition_all"],
    "partition_latest_by_time": _with(
        USERS, select=f"{_SUMMARY} WHERE partstart = '20220207' GROUP BY partstart"
    ),
}

SQL |= {
    "text_lines": _with(
        TOPICS,
        select="""SELECT '{"msgId":' || coalesce('"' || msg_id || '"', 'null') || ',"tradeId":"' || trade_id
  || '","statusCode":' || coalesce('"' || status_code || '"', 'null') || ',"createTime":"'
  || strftime(make_timestamp(us), '%Y-%m-%d %H:%M:%S') || '"}' AS value FROM topics""",
    ),
    "processing_time": """SELECT o_orderkey, true AS same_text, true AS same_minute,
  true AS one_minute, true AS same_period FROM orders""",
    "named_columns": _with(
        USERS, select='SELECT cert_nbr, lat AS "first", lng AS "second" FROM users'
    ),
    "observed_records": """SELECT event_type, count(*) AS cnt, (SELECT count(*) FROM events) AS observed
FROM events GROUP BY event_type""",
    "row_functions": """SELECT event_id, k, CAST(copy AS INTEGER) AS copy FROM (
  SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events), range(2) r(copy)
WHERE copy < k % 3""",
    "serial_numbers": _with(
        *_MATCH,
        COUNTS,
        RECORDS,
        select="""SELECT message_type, count(*) AS cnt,
  CASE message_type WHEN '02' THEN count(*) ELSE 0 END AS serials,
  CASE message_type WHEN '02' THEN count(*) ELSE 0 END AS well_formed
FROM records GROUP BY message_type""",
    ),
}
