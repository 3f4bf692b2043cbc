"""The registered queries as SQL over the provided tables.

Written from the rules, not from the Spark code: row-level windows, generated hours and plain
joins, with none of the pre-aggregation the Spark side uses.
"""

from __future__ import annotations

TRIPLE = "space_id, zone_device_id, zone_device_control_id"
_IDS = "user_id % 50 AS space_id, user_id AS zone_device_id, user_id + 1000 AS zone_device_control_id"
_TYPE = (
    "CASE user_id % 4 WHEN 0 THEN 'elemeter' WHEN 1 THEN 'watermeter' WHEN 2 THEN 'camera' "
    "ELSE 'airpurifiercontrol' END"
)
_TAG = "CAST(CASE user_id % 4 WHEN 2 THEN 1010 WHEN 3 THEN 1050 ELSE 1020 END AS INTEGER)"
_TEXT = (
    "CASE user_id % 4 WHEN 2 THEN CAST(CAST(floor(value) AS INTEGER) AS VARCHAR) "
    "ELSE CAST(value AS VARCHAR) END"
)
_CLOSED = "date_trunc('millisecond', (SELECT max(ts) FROM events)) - INTERVAL '10' MINUTE"

VIEWS = {
    "readings": f"""SELECT event_id, {_IDS}, ts, event_type <> 'error' AS is_online,
        event_type = 'signup' AS is_scenario, {_TEXT} AS value FROM events""",
    "numbers": f"""SELECT {_IDS}, ts, event_type <> 'error' AS is_online,
        event_type = 'signup' AS is_scenario, CAST({_TEXT} AS DOUBLE) AS value FROM events""",
    "live": f"SELECT {TRIPLE}, ts, is_online, is_scenario, value FROM readings WHERE is_online AND NOT is_scenario",
    "registry": f"""SELECT DISTINCT {_IDS}, {_TYPE} AS device_type, {_TAG} AS zone_device_control_tag
        FROM events WHERE user_id % 5 <> 0""",
    "invalid_registry": f"SELECT DISTINCT {_IDS} FROM events WHERE user_id % 20 = 0",
    "master": f"""SELECT DISTINCT {_IDS}, {_TYPE} AS device_type_c, {_TAG} AS zone_device_control_tag,
        concat('dev-', CAST(user_id AS VARCHAR)) AS zone_device_code FROM events WHERE user_id % 10 <> 0""",
    "used": """SELECT user_id, date_trunc('hour', ts) AS date_time_key,
        sum(CAST(value AS DECIMAL(18,2))) AS used FROM events GROUP BY ALL""",
    "totals": """SELECT *, sum(used) OVER (PARTITION BY user_id ORDER BY date_time_key) AS total FROM used""",
    "hourly": f"""SELECT {_IDS}, date_time_key, true AS is_online, false AS is_scenario,
        CAST(total AS DOUBLE) AS value FROM totals""",
    "space_hourly": f"""SELECT {_IDS}, date_time_key - INTERVAL '9346' DAY AS date_time_key,
        CAST(used AS DOUBLE) AS accumulate_value, {_TYPE} AS device_type FROM totals""",
    "space": """SELECT DISTINCT user_id % 50 AS id, CASE WHEN user_id % 50 < 40 THEN 'room' ELSE 'public' END AS type_c,
        concat('R', CAST(user_id % 50 AS VARCHAR)) AS code FROM events""",
    "bookings": """SELECT o_orderkey AS id, concat('B', CAST(o_orderkey AS VARCHAR)) AS order_number,
        o_custkey AS user_id, o_custkey % 50 AS space_id,
        CASE WHEN o_orderpriority = '1-URGENT' THEN 'owner' ELSE 'tenant' END AS order_type_c,
        CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'active' ELSE 'rerenting' END AS status_c,
        o_orderdate AS check_in_date, o_orderdate + (o_orderkey % 120) * INTERVAL '1' DAY AS check_out_date
        FROM orders""",
    "booking_history": """SELECT o_orderkey AS order_id,
        CASE WHEN o_orderkey % 14 = 0 THEN '' ELSE CAST((o_custkey + 1) % 50 AS VARCHAR) END AS space_id
        FROM orders WHERE o_orderkey % 7 = 0""",
    "extensions": """SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_shipdate AS start_date,
        l_shipdate + CAST(l_quantity AS INT) * INTERVAL '1' DAY AS end_date, l_shipdate AS created_at,
        CASE l_returnflag WHEN 'R' THEN 'canceled' ELSE 'active' END AS status_c FROM lineitem""",
    "users": "SELECT c_custkey AS id, c_name AS display_name FROM customer",
    "moved": """SELECT b.id AS order_id, b.* EXCLUDE (id, space_id),
        CASE WHEN h.space_id IS NOT NULL AND h.space_id <> '' THEN CAST(h.space_id AS BIGINT)
             ELSE b.space_id END AS space_id
        FROM bookings b LEFT JOIN booking_history h ON b.id = h.order_id""",
    "current_bookings": """SELECT * FROM moved WHERE order_type_c = 'tenant'
        AND status_c IN ('completed', 'active', 'rerenting')
        AND date_diff('day', check_in_date, check_out_date) > 15
        AND CAST(check_out_date AS DATE) >= DATE '1998-06-29'
        AND CAST(check_in_date AS DATE) <= DATE '1998-05-30'""",
    "live_extensions": """SELECT * FROM extensions WHERE status_c <> 'canceled'
        AND CAST(created_at AS DATE) >= DATE '1998-05-30'""",
    "ext_days": """SELECT e.id, e.order_id, CAST(d AS DATE) AS date FROM live_extensions e,
        unnest(generate_series(CAST(CAST(start_date + INTERVAL '8' HOUR AS DATE) AS TIMESTAMP),
          CAST(CAST(end_date AS DATE) AS TIMESTAMP), INTERVAL '1' DAY)) AS t(d)""",
    "booking_days": """SELECT b.*, CAST(d AS DATE) AS date FROM current_bookings b,
        unnest(generate_series(TIMESTAMP '1998-05-30', TIMESTAMP '1998-06-29', INTERVAL '1' DAY)) AS t(d)""",
    "days_on_extension": """SELECT b.*, e.id IS NOT NULL AS on_rerent FROM booking_days b
        LEFT JOIN ext_days e ON b.order_id = e.order_id AND b.date = e.date""",
    "extension_counts": """SELECT order_id, count(*) AS rerent_count FROM days_on_extension
        WHERE on_rerent GROUP BY order_id""",
    "kept_days": """SELECT d.* FROM days_on_extension d LEFT JOIN extension_counts c ON d.order_id = c.order_id
        WHERE c.rerent_count IS NULL OR c.rerent_count < 15""",
    "hours": """SELECT DISTINCT d.order_id, d.order_number, d.date,
        CAST(d.date AS TIMESTAMP) + n.n * INTERVAL '1' HOUR AS date_time_key,
        u.display_name AS user_name, s.code AS room, d.on_rerent, d.space_id, d.status_c
        FROM kept_days d LEFT JOIN users u ON d.user_id = u.id LEFT JOIN space s ON d.space_id = s.id,
        range(13, 37) AS n(n)""",
    "met": """SELECT h.*, r.zone_device_id, r.device_type, r.accumulate_value
        FROM hours h LEFT JOIN space_hourly r ON h.space_id = r.space_id AND h.date_time_key = r.date_time_key""",
    "target_days": """SELECT CAST(CASE WHEN date_time_key > date_trunc('day', date_time_key) + INTERVAL '12' HOUR
          THEN date_time_key ELSE date_time_key - INTERVAL '24' HOUR END AS DATE) AS actual_date_key,
        order_id, on_rerent, device_type, CAST(sum(CAST(accumulate_value AS DECIMAL(18,2))) AS DOUBLE) AS accumulate_value
        FROM met GROUP BY ALL""",
    "keyed": """SELECT *, CASE WHEN date_time_key > date_trunc('day', date_time_key) + INTERVAL '11' HOUR
          THEN CAST(date_time_key AS DATE) + 1 ELSE CAST(date_time_key AS DATE) END AS date_key FROM hourly""",
    "daily": f"""SELECT {TRIPLE},
        CAST(CAST(arg_max(value, date_time_key) AS DECIMAL(28,9)) - CAST(arg_min(value, date_time_key) AS DECIMAL(28,9)) AS DOUBLE) AS consumption,
        arg_max(value, date_time_key) AS value, CAST(date_key AS DATE) AS date_key,
        arg_max(is_online, date_time_key) AS is_online, arg_max(is_scenario, date_time_key) AS is_scenario
        FROM keyed GROUP BY {TRIPLE}, date_key""",
    "devices": f"SELECT {TRIPLE}, zone_device_code AS device FROM master WHERE device_type_c IN ('elemeter', 'watermeter') AND zone_device_control_tag = 1020",
    "rooms": "SELECT id AS space_id, type_c AS room_type, code AS room FROM space WHERE type_c = 'room'",
    "routed": f"""SELECT {TRIPLE}, ts, is_online, is_scenario, value, route, device_type, device_tag,
        CASE WHEN device_type IN ('elemeter', 'watermeter') THEN 'meter' WHEN device_type = 'airpurifiercontrol' THEN 'co2'
             WHEN device_type = 'camera' THEN 'camera' END AS kind
        FROM (SELECT l.*,
            CASE WHEN r.device_type IS NOT NULL THEN 'known' WHEN i.space_id IS NOT NULL THEN 'listed_invalid'
                 WHEN m.device_type_c IS NOT NULL THEN 'newly_known' ELSE 'invalid' END AS route,
            CASE WHEN r.device_type IS NOT NULL THEN r.device_type WHEN i.space_id IS NOT NULL THEN NULL
                 ELSE m.device_type_c END AS device_type,
            CASE WHEN r.device_type IS NULL AND i.space_id IS NULL THEN m.zone_device_control_tag END AS device_tag
          FROM live l
          LEFT JOIN registry r USING ({TRIPLE})
          LEFT JOIN invalid_registry i USING ({TRIPLE})
          LEFT JOIN master m USING ({TRIPLE}))""",
    "typed": """SELECT *, CASE WHEN kind IN ('meter', 'co2') THEN TRY_CAST(value AS DOUBLE) END AS value_double,
        CASE WHEN kind = 'camera' AND regexp_full_match(value, '[+-]?[0-9]+') THEN TRY_CAST(value AS INTEGER) END AS value_int
        FROM routed""",
    "reads": f"""SELECT {_IDS}, ts + CAST(k AS INTEGER) * INTERVAL '1' HOUR AS ts, true AS is_online, false AS is_scenario,
        CASE WHEN k = 0 THEN CAST({_TEXT} AS DOUBLE) ELSE value / 2 END AS value
        FROM events, range(0, 2) AS n(k) WHERE event_type NOT IN ('error', 'signup')""",
    "whole": f"SELECT {TRIPLE}, date_trunc('second', ts) AS ts, is_online, is_scenario, value FROM numbers",
    "best": f"""SELECT {TRIPLE}, is_online, is_scenario, value, date_time_key FROM (
        SELECT *, date_trunc('hour', ts) AS date_time_key, row_number() OVER (
          PARTITION BY {TRIPLE}, date_trunc('hour', ts)
          ORDER BY value DESC, ts DESC, is_online DESC, is_scenario DESC) AS rn FROM numbers) WHERE rn = 1""",
    "wide": f"""SELECT {_IDS}, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS event_datetime, event_type <> 'error' AS is_online,
        value AS current_value, value / 2 AS average_value, year(ts) AS year, month(ts) AS month, day(ts) AS day,
        hour(ts) AS hour, minute(ts) AS minute, second(ts) AS second, user_id % 10 AS zone_id, user_id + 2000 AS control_id,
        {_TAG} AS zone_device_control_tag, concat('ctl-', user_id) AS zone_device_control_code,
        concat('dev-', user_id) AS zone_device_code, event_type AS control_value_type_c, concat('Z', user_id % 10) AS zone_code,
        user_id % 3 AS project_id, concat('R', user_id % 50) AS space_code,
        CASE WHEN user_id % 50 < 40 THEN 'room' ELSE 'public' END AS space_type_c, concat('P', user_id % 3) AS project_code,
        user_id % 50 >= 40 AS is_community, event_type = 'signup' AS is_scenario, value AS accumulate_value, value AS last_value,
        CAST(60 AS INTEGER) AS frequency, strftime(ts, '%Y-%m-%d') AS date_key,
        strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S.%g') AS date_time_key,
        strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS created_at, event_id AS device_id, {_TYPE} AS device_type
        FROM events WHERE user_id % 4 = 1 AND CAST(ts AS DATE) = DATE '2024-01-05'""",
    "minutes": f"""SELECT {TRIPLE}, date_trunc('minute', ts) AS ts, value, is_online, is_scenario FROM (
        SELECT *, row_number() OVER (PARTITION BY {TRIPLE}, date_trunc('minute', ts)
          ORDER BY ts, value, is_online, is_scenario) AS rn FROM numbers) WHERE rn = 1""",
}


def _with(body: str) -> str:
    """Prefix a query with the views it needs, each after the views it reads itself."""
    import re

    ordered: list[str] = []

    def need(text: str) -> None:
        for name in VIEWS:
            if name not in ordered and re.search(rf"(FROM|JOIN)\s+{name}\b", text):
                need(VIEWS[name])
                ordered.append(name)

    need(body)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in ordered) + "\n" + body


def _fill_between(source: str, time: str) -> str:
    flags = "is_online, is_scenario"
    return f"""SELECT {TRIPLE}, {time}, value, {flags} FROM {source}
      UNION ALL
      SELECT {TRIPLE}, h AS {time}, least(pv, value) AS value, {flags} FROM (
        SELECT *, lag({time}) OVER w AS pt, lag(value) OVER w AS pv FROM {source}
        WINDOW w AS (PARTITION BY {TRIPLE} ORDER BY {time}, value, {flags})),
      unnest(range(pt + INTERVAL '1' HOUR, {time}, INTERVAL '1' HOUR)) AS t(h) WHERE pt IS NOT NULL"""


def _fill_forward(source: str, time: str) -> str:
    flags = "is_online, is_scenario"
    return f"""SELECT {TRIPLE}, {time}, value, {flags} FROM {source}
      UNION ALL
      SELECT {TRIPLE}, {time} + CAST(k AS INTEGER) * INTERVAL '1' HOUR AS {time}, value, {flags} FROM (
        SELECT *, date_sub('hour', {time}, lead({time}) OVER (
          PARTITION BY {TRIPLE} ORDER BY {time}, value, {flags})) AS diff FROM {source}),
      unnest(range(1, diff)) AS t(k) WHERE diff > 1"""


def _closed(time: str, period: str) -> str:
    return f"{time} + INTERVAL '1' {period} <= {_CLOSED}"


def _carry(source: str, time: str, period: str, max_steps: int | None) -> str:
    last = f"date_trunc('{period}', {_CLOSED}) - INTERVAL '1' {period}"
    stop = f"coalesce(nxt, {last} + INTERVAL '1' {period})"
    if max_steps is not None:
        stop = f"least({stop}, {time} + INTERVAL '{max_steps + 1}' {period})"
    return f"""SELECT {TRIPLE}, h AS {time}, value, is_online, is_scenario, h > {time} AS carried FROM (
        SELECT *, lead({time}) OVER (PARTITION BY {TRIPLE} ORDER BY {time}) AS nxt
        FROM {source} WHERE {_closed(time, period)}),
      unnest(range({time}, {stop}, INTERVAL '1' {period})) AS t(h)"""


_Q_DAILY = """SELECT consumption, value AS amount, room, device, date_key,
  TIMESTAMP '2024-02-01 00:00:00' AS created_at
  FROM daily JOIN devices USING (space_id, zone_device_id, zone_device_control_id) LEFT JOIN rooms USING (space_id)"""

_SECONDS = "'%Y-%m-%d %H:%M:%S'"


def _dates(series: str) -> str:
    return f"array_to_string(list_transform({series}, lambda x: strftime(x, '%Y-%m-%d')), '|')"


def _times(series: str) -> str:
    return f"array_to_string(list_transform({series}, lambda x: strftime(x, {_SECONDS})), '|')"


_DAY, _FIX = "CAST(CAST(ts AS DATE) AS TIMESTAMP)", "TIMESTAMP '2024-01-15'"
_SEC = "date_trunc('second', ts)"
_SPAN = f"generate_series({_DAY}, {_FIX}, INTERVAL '1' DAY)"

_BODIES = {
    "stream_read_json": f"SELECT {TRIPLE}, ts, is_online, value, is_scenario FROM readings",
    "scan_fixed_schema": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "scan_inferred_schema": "SELECT * FROM orders",
    "registry_scan": f"""SELECT concat(space_id, '-', zone_device_id, '-', zone_device_control_id) AS _id, {TRIPLE},
        device_type, zone_device_control_tag FROM registry""",
    "dated_table_scan": f"""SELECT CAST(date_time_key AS DATE) AS date_key, date_time_key, date_time_key AS create_at,
        CAST(total AS DOUBLE) AS current_value, CAST(used AS DOUBLE) AS difference, {_IDS},
        true AS is_online, false AS is_scenario, strftime(date_time_key, '%H:%M:%S') AS time_key
        FROM totals WHERE CAST(date_time_key AS DATE) = DATE '2024-01-14'""",
    "range_scan_count": """SELECT count(*) AS readings FROM events
        WHERE ts >= TIMESTAMP '2024-01-14 12:00:00' AND ts < TIMESTAMP '2024-01-15 12:00:00'""",
    "history_json_reads": f"SELECT {TRIPLE}, ts, is_online, is_scenario, value FROM reads",
    "sink_append": f"""SELECT {TRIPLE}, ts, is_online, is_scenario, value FROM numbers
        WHERE ts >= TIMESTAMP '2024-05-10' - INTERVAL '10000000' SECOND""",
    "upsert_latest": f"""SELECT {TRIPLE}, date_time_key,
        CASE WHEN date_time_key >= TIMESTAMP '2024-01-20' THEN value + 1000 ELSE value END AS value,
        CAST(CASE WHEN date_time_key >= TIMESTAMP '2024-01-20' THEN 1 ELSE 0 END AS INTEGER) AS load_seq FROM hourly""",
    "csv_export": f"""SELECT {TRIPLE}, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS ts, is_online, is_scenario, value FROM numbers""",
    "topic_publish_json": f"""SELECT CASE kind WHEN 'meter' THEN 'device-ele-water-data'
          WHEN 'camera' THEN 'device-camera-data' ELSE 'device-air-co2-data' END AS topic,
        strftime(ts, {_SECONDS}) AS key,
        concat('{{"space_id":', space_id, ',"zone_device_id":', zone_device_id, ',"zone_device_control_id":',
          zone_device_control_id, ',"ts":"', strftime(ts, {_SECONDS}), '","is_online":', is_online, ',"value":',
          CASE WHEN kind = 'camera' THEN CAST(value_int AS VARCHAR) ELSE CAST(value_double AS VARCHAR) END,
          ',"is_scenario":', is_scenario, '}}') AS value
        FROM typed WHERE value_double IS NOT NULL OR value_int IS NOT NULL""",
    "topic_publish_once": f"""SELECT CASE kind WHEN 'meter' THEN 'device-ele-water-data'
          WHEN 'camera' THEN 'device-camera-data' ELSE 'device-air-co2-data' END AS topic,
        strftime(ts, {_SECONDS}) AS key,
        concat('{{"space_id":', space_id, ',"zone_device_id":', zone_device_id, ',"zone_device_control_id":',
          zone_device_control_id, ',"ts":"', strftime(ts, {_SECONDS}), '","is_online":', is_online, ',"value":',
          CASE WHEN kind = 'camera' THEN CAST(value_int AS VARCHAR) ELSE CAST(value_double AS VARCHAR) END,
          ',"is_scenario":', is_scenario, '}}') AS value
        FROM typed WHERE value_double IS NOT NULL OR value_int IS NOT NULL""",
    "registry_upsert": f"""SELECT DISTINCT CASE kind WHEN 'meter' THEN 'DEVICE_ELE_WATER' WHEN 'co2' THEN 'DEVICE_AIR_CO2'
          WHEN 'camera' THEN 'DEVICE_CAMERA' ELSE 'INVALID_DEVICE' END AS "table",
        concat(space_id, '-', zone_device_id, '-', zone_device_control_id) AS _id, {TRIPLE},
        device_tag AS zone_device_control_tag, device_type
        FROM routed WHERE route IN ('newly_known', 'invalid')""",
    "flatten_rename": f"SELECT {TRIPLE}, ts, is_online, value, is_scenario FROM readings",
    "live_readings": f"SELECT {TRIPLE}, ts, is_online, is_scenario, value FROM live",
    "registry_type_tag_filter": f"""SELECT {TRIPLE}, device_type_c, zone_device_code, CAST(tag AS INTEGER) AS zone_device_control_tag,
        device_type_c IN ('elemeter', 'watermeter') AS meter
        FROM (SELECT * EXCLUDE (zone_device_control_tag) FROM master), (VALUES (1010), (1020), (1050)) AS t(tag)
        WHERE (device_type_c IN ('elemeter', 'watermeter') AND tag = 1020) OR (device_type_c = 'camera' AND tag = 1010)
           OR (device_type_c = 'airpurifiercontrol' AND tag = 1050)""",
    "route_by_type": f"SELECT {TRIPLE}, ts, kind, value_double, value_int FROM typed WHERE route = 'known'",
    "booking_filter": """SELECT b.id AS order_id, order_number, user_id, space_id, order_type_c, status_c, check_in_date,
        check_out_date, check_in_date + INTERVAL '8' HOUR AS local_check_in_date, check_out_date AS local_check_out_date,
        DATE '1998-06-29' AS "current_date", DATE '1998-05-30' AS last_month_date FROM bookings b
        WHERE order_type_c = 'tenant' AND date_diff('day', check_in_date, check_out_date) > 15
        AND CAST(check_out_date AS DATE) >= DATE '1998-06-29' AND CAST(check_in_date AS DATE) <= DATE '1998-05-30'""",
    "extension_filter": """SELECT *, start_date + INTERVAL '8' HOUR AS local_start_date, end_date AS local_end_date
        FROM live_extensions""",
    "override_space": "SELECT order_id, space_id AS actual_space_id FROM moved",
    "null_predicates": """SELECT 'known' AS part, count(*) AS readings FROM routed WHERE route = 'known'
        UNION ALL SELECT 'unknown', count(*) FROM routed WHERE route <> 'known'
        UNION ALL SELECT 'newly_known', count(*) FROM routed WHERE route = 'newly_known'
        UNION ALL SELECT 'invalid', count(*) FROM routed WHERE route = 'invalid'""",
    "wide_export": "SELECT * FROM wide",
    "alias_projection": """SELECT id AS order_id, order_number, user_id, space_id AS history_space_id, order_type_c, status_c,
        check_in_date, check_out_date FROM bookings""",
    "room_filter": "SELECT space_id, room_type, room FROM rooms",
    "enrich_readings": f"""SELECT r.* EXCLUDE (event_id), device_type, zone_device_control_tag
        FROM readings r LEFT JOIN registry USING ({TRIPLE})""",
    "unknown_minus_invalid": f"""SELECT {TRIPLE}, ts, is_online, is_scenario, value FROM readings r
        WHERE NOT EXISTS (SELECT 1 FROM registry d WHERE d.zone_device_id = r.zone_device_id AND d.space_id = r.space_id)
          AND NOT EXISTS (SELECT 1 FROM invalid_registry i WHERE i.zone_device_id = r.zone_device_id AND i.space_id = r.space_id)""",
    "unknown_vs_master": f"""SELECT r.* EXCLUDE (event_id), m.device_type_c, m.zone_device_control_tag AS zone_device_control
        FROM readings r LEFT JOIN master m USING ({TRIPLE})
        WHERE NOT EXISTS (SELECT 1 FROM registry d WHERE d.zone_device_id = r.zone_device_id AND d.space_id = r.space_id)
          AND NOT EXISTS (SELECT 1 FROM invalid_registry i WHERE i.zone_device_id = r.zone_device_id AND i.space_id = r.space_id)""",
    "booking_history_join": """SELECT order_id, order_number, user_id, space_id, count(*) AS copies FROM moved GROUP BY ALL""",
    "booking_day_extension": """SELECT order_id, space_id, date, on_rerent, count(*) AS copies
        FROM days_on_extension GROUP BY ALL""",
    "booking_user_space": """SELECT b.id, b.order_number, b.user_id, u.display_name AS user_name, b.space_id, s.code AS room
        FROM bookings b LEFT JOIN users u ON b.user_id = u.id LEFT JOIN space s ON b.space_id = s.id""",
    "extension_count_join": "SELECT DISTINCT order_id, space_id, date, on_rerent FROM kept_days",
    "readings_registered": f"SELECT h.* FROM hourly h SEMI JOIN registry USING ({TRIPLE})",
    "daily_device_join": f"SELECT * FROM daily JOIN devices USING ({TRIPLE})",
    "daily_room_join": "SELECT d.*, r.room FROM daily d LEFT JOIN rooms r USING (space_id)",
    "hours_with_readings": """SELECT order_id, space_id, date_time_key, on_rerent, zone_device_id, device_type,
        accumulate_value FROM met""",
    "daily_consumption": "SELECT * FROM daily",
    "hourly_max_reading": "SELECT * FROM best",
    "minute_camera_sum": """SELECT user_id % 50 AS space_id, CAST(sum(CAST(floor(value) AS INTEGER)) AS INTEGER) AS value,
        arg_max(event_type <> 'error', ts) AS is_online, arg_max(event_type = 'signup', ts) AS is_scenario,
        date_trunc('minute', ts) AS ts FROM events GROUP BY user_id % 50, date_trunc('minute', ts)""",
    "extension_day_count": "SELECT order_id, rerent_count FROM extension_counts",
    "target_day_sum": "SELECT * FROM target_days",
    "target_period_sum": """SELECT order_id, device_type,
        CAST(sum(CAST(accumulate_value AS DECIMAL(18,2))) AS DOUBLE) AS consumption, count(DISTINCT actual_date_key) AS days
        FROM target_days WHERE NOT on_rerent GROUP BY order_id, device_type""",
    "target_period_totals": """SELECT order_id, device_type,
        CAST(sum(CAST(accumulate_value AS DECIMAL(18,2))) AS DOUBLE) AS consumption, count(DISTINCT actual_date_key) AS days
        FROM target_days WHERE NOT on_rerent GROUP BY order_id, device_type""",
    "daily_consumption_loads": "SELECT * FROM daily",
    "table_count": """SELECT 'events' AS name, count(*) AS rows FROM events UNION ALL SELECT 'orders', count(*) FROM orders
        UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'customer', count(*) FROM customer""",
    "map_merge_sum": """SELECT event_id, name, CAST(sum(n) AS INTEGER) AS amount FROM (
          SELECT event_id, event_type AS name, 1 AS n FROM events UNION ALL SELECT event_id, 'all', 3 FROM events
          UNION ALL SELECT event_id, 'error', 3 FROM events) GROUP BY event_id, name""",
    "map_group_sum": """SELECT user_id, event_type AS name, count(*)::BIGINT AS amount FROM events GROUP BY ALL
        UNION ALL SELECT user_id, 'cents', sum(round(value * 100))::BIGINT FROM events GROUP BY user_id""",
    "sink_expiry": """SELECT CAST(ts AS DATE) AS date_key, count(*) AS rows, 'before' AS phase FROM events GROUP BY ALL
        UNION ALL SELECT CAST(ts AS DATE), count(*), 'after' FROM events
        WHERE CAST(ts AS DATE) >= CAST(TIMESTAMP '2024-05-10' - INTERVAL '10000000' SECOND AS DATE) GROUP BY ALL""",
    "next_reading_lead": f"""SELECT * FROM (
        SELECT *, CAST(date_sub('hour', ts, next_time) AS INTEGER) AS diff FROM (
          SELECT *, lead(ts) OVER (PARTITION BY {TRIPLE} ORDER BY ts, value, is_online, is_scenario) AS next_time FROM numbers))
        WHERE diff > 1""",
    "fill_forward_lead": _fill_forward("hourly", "date_time_key"),
    "fill_between_min": _fill_between("hourly", "date_time_key"),
    "fill_incremental": f"""SELECT {TRIPLE}, ts, value, is_online, is_scenario FROM numbers
        WHERE ts >= TIMESTAMP '2024-01-15' AND NOT (space_id = 7 AND zone_device_id IN (
          SELECT zone_device_id FROM numbers WHERE ts < TIMESTAMP '2024-01-15'))
      UNION ALL
      SELECT {TRIPLE}, h AS ts, least(pv, value) AS value, is_online, is_scenario FROM (
        SELECT *, lag(ts) OVER w AS pt, lag(value) OVER w AS pv FROM numbers
        WINDOW w AS (PARTITION BY {TRIPLE} ORDER BY ts, value, is_online, is_scenario)),
      unnest(range(pt + INTERVAL '1' HOUR, ts, INTERVAL '1' HOUR)) AS t(h)
      WHERE pt IS NOT NULL AND ts >= TIMESTAMP '2024-01-15' AND NOT (space_id = 7 AND zone_device_id IN (
          SELECT zone_device_id FROM numbers WHERE ts < TIMESTAMP '2024-01-15'))""",
    "fill_incremental_state": f"""SELECT {TRIPLE}, CASE WHEN spoiled THEN old_ts ELSE last_ts END AS ts,
        CASE WHEN spoiled THEN 'n/a' ELSE CAST(last_value AS VARCHAR) END AS value FROM (
          SELECT {TRIPLE}, max(ts) FILTER (ts < TIMESTAMP '2024-01-15') AS old_ts, max(ts) AS last_ts,
            arg_max(value, ts) AS last_value, space_id = 7 AND min(ts) < TIMESTAMP '2024-01-15' AS spoiled
          FROM numbers GROUP BY {TRIPLE})""",
    "fill_incremental_load": f"""SELECT {TRIPLE}, ts AS date_time_key, value, is_online, is_scenario FROM (
        SELECT *, row_number() OVER (PARTITION BY {TRIPLE}, ts
          ORDER BY value DESC, is_online DESC, is_scenario DESC) AS rn FROM ({_fill_between('whole', 'ts')})) WHERE rn = 1""",
    "numeric_guard": f"""SELECT {TRIPLE}, ts, is_online, is_scenario, CAST(value AS DOUBLE) AS value FROM readings WHERE is_online""",
    "sort_multi_key": f"SELECT * FROM hourly ORDER BY date_time_key DESC, {TRIPLE} LIMIT 100",
    "sort_by_key_reduce": f"""SELECT {TRIPLE}, min(ts) AS first_ts, arg_min(value, ts) AS first_value, max(ts) AS last_ts,
        arg_max(value, ts) AS last_value FROM numbers GROUP BY {TRIPLE}""",
    "distinct_devices": f"SELECT DISTINCT {TRIPLE} FROM readings",
    "distinct_rows": "SELECT DISTINCT space_id, date_time_key FROM hourly",
    "union_all": f"""SELECT {TRIPLE}, ts, is_online, is_scenario, value FROM numbers
        UNION ALL SELECT {TRIPLE}, date_time_key AS ts, is_online, is_scenario, value FROM hourly""",
    "explode_days": """SELECT date, count(*) AS days, CAST(count(*) + sum(CASE WHEN first AND one = 0 THEN 1 ELSE 0 END)
          + sum(one) AS BIGINT) AS days_with_repeated_start FROM (
        SELECT CAST(d AS DATE) AS date, CAST(d AS DATE) = CAST(start_date + INTERVAL '8' HOUR AS DATE) AS first,
          CASE WHEN CAST(end_date AS DATE) = CAST(start_date + INTERVAL '8' HOUR AS DATE) THEN 1 ELSE 0 END AS one
        FROM extensions, unnest(generate_series(CAST(CAST(start_date + INTERVAL '8' HOUR AS DATE) AS TIMESTAMP),
          CAST(CAST(end_date AS DATE) AS TIMESTAMP), INTERVAL '1' DAY)) AS t(d)) GROUP BY date""",
    "explode_hours": """SELECT order_id, space_id, date, CAST(date AS TIMESTAMP) + n.n * INTERVAL '1' HOUR AS date_time_key
        FROM booking_days, range(13, 37) AS n(n)""",
    "range_replay": f"""SELECT {TRIPLE}, CAST(CAST(arg_max(value, date_time_key) AS DECIMAL(28,9))
          - CAST(arg_min(value, date_time_key) AS DECIMAL(28,9)) AS DOUBLE) AS consumption,
        arg_max(value, date_time_key) AS value, CAST(date_key AS DATE) AS date_key, true AS is_online, false AS is_scenario
        FROM keyed WHERE date_time_key >= TIMESTAMP '2024-01-05 12:00:00' AND date_time_key < TIMESTAMP '2024-01-15 12:00:00'
        GROUP BY {TRIPLE}, date_key""",
    "time_parse_format": f"""SELECT event_id, strftime(ts, {_SECONDS}) AS text, epoch_ms({_SEC}) AS millis,
        strftime({_SEC}, '%Y-%m-%d %H:%M:%S.%g') AS from_millis, strftime(ts, '%H') AS hour_of_millis,
        strftime(ts, '%Y%m%d%H%M%S') AS compact, {_SEC} AS parsed, strftime(ts, '%Y-%m-%d') AS date_text FROM events""",
    "time_add": """SELECT event_id, strftime(ts - INTERVAL '3' DAY, '%Y%m%d') AS add_date, ts + INTERVAL '40' DAY AS add_days,
        ts + INTERVAL '8' HOUR AS add_hours, ts - INTERVAL '90' MINUTE AS add_minutes, ts + INTERVAL '3601' SECOND AS add_seconds
        FROM events""",
    "time_add_floor": """SELECT event_id,
        date_trunc('hour', ts + INTERVAL '5' HOUR) + (ts - date_trunc('minute', ts)) AS hours_zero_minute,
        date_trunc('minute', ts - INTERVAL '7' MINUTE) AS minutes_zero_second,
        date_trunc('minute', ts + INTERVAL '1' MINUTE) AS next_minute, date_trunc('hour', ts + INTERVAL '1' HOUR) AS next_hour,
        date_trunc('minute', ts + INTERVAL '10' MINUTE) AS next_ten_minutes FROM events""",
    "time_floor": """SELECT event_id, date_trunc('hour', ts) AS hour, date_trunc('minute', ts) AS minute,
        epoch_ms(ts) // 60000 AS epoch_minute FROM events""",
    "time_keys": """SELECT event_id, strftime(ts, '%Y-%m-%d-%H-%M-%S') AS time_key, strftime(ts, '%Y-%m-%d-%H') AS hour_key,
        strftime(ts, '%Y%m%d%H') AS compact_hour_key, strftime(ts, '%Y-%m-%d') AS date_key FROM events""",
    "time_diff": f"""SELECT event_id, date_sub('second', {_SEC}, TIMESTAMP '2024-01-15 12:00:00') AS seconds,
        date_sub('hour', ts, TIMESTAMP '2024-01-15 12:00:00') AS hours,
        CAST(date_diff('day', ts, TIMESTAMP '2024-01-15 12:00:00') AS INTEGER) AS days,
        CAST(date_diff('day', CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-20' THEN DATE '2024-01-20' ELSE DATE '2023-01-20' END,
          CAST(ts AS DATE)) AS INTEGER) AS since_20_january FROM events""",
    "time_compare": """SELECT event_id, ts BETWEEN TIMESTAMP '2024-01-10 12:00:00' AND TIMESTAMP '2024-01-20 12:00:00' AS within,
        event_type = 'click' AND ts BETWEEN TIMESTAMP '2024-01-10 12:00:00' AND TIMESTAMP '2024-01-20 12:00:00' AS within_or_null,
        ts <= TIMESTAMP '2024-01-20 12:00:00' AS not_after, ts < TIMESTAMP '2024-01-20 12:00:00' AS before FROM events""",
    "business_day": f"""SELECT event_id,
        CAST(CASE WHEN {_SEC} > date_trunc('day', ts) + INTERVAL '11' HOUR THEN ts + INTERVAL '1' DAY ELSE ts END AS DATE) AS ending_11,
        CAST(CASE WHEN {_SEC} > date_trunc('day', ts) + INTERVAL '12' HOUR THEN ts ELSE ts - INTERVAL '24' HOUR END AS DATE) AS starting_12,
        {_SEC} > TIMESTAMP '2024-01-14 12:00:00' AND {_SEC} < TIMESTAMP '2024-01-15 12:00:00' AS in_day FROM events""",
    "day_bounds": """SELECT event_id, date_trunc('day', ts) - INTERVAL '12' HOUR AS yesterday_12,
        date_trunc('day', ts) - INTERVAL '13' HOUR AS yesterday_11, date_trunc('day', ts) + INTERVAL '12' HOUR AS today_12 FROM events""",
    "time_lists": f"""SELECT event_id, {_dates(_SPAN)} AS dates,
        CASE WHEN {_DAY} < {_FIX} THEN concat(strftime(ts, '%Y-%m-%d'), '|', {_dates(_SPAN)})
             ELSE concat(strftime(ts, '%Y-%m-%d'), '|2024-01-15') END AS dates_repeated,
        {_times(f"generate_series({_DAY} + INTERVAL '13' HOUR, {_DAY} + INTERVAL '36' HOUR, INTERVAL '1' HOUR)")} AS booking_hours,
        {_times(f"range({_SEC} + INTERVAL '1' HOUR, date_trunc('hour', {_SEC} + INTERVAL '5' HOUR), INTERVAL '1' HOUR)")} AS "between",
        {_times(f"list_transform(range(1, event_id % 5 + 1), lambda k: {_SEC} + CAST(k AS INTEGER) * INTERVAL '1' HOUR)")} AS "after",
        {_dates(f"list_transform(range(0, 4), lambda k: {_DAY} - CAST(k AS INTEGER) * INTERVAL '1' DAY)")} AS past_days,
        {_times(f"list_transform(range(0, 3), lambda k: {_SEC} - CAST(k AS INTEGER) * INTERVAL '6' HOUR)")} AS past_hours
        FROM events""",
    "device_key": f"""SELECT event_id, concat(space_id, '-', zone_device_id, '-', zone_device_control_id) AS key, {TRIPLE}
        FROM readings""",
    "numeric_check": """SELECT event_id, text, coalesce(regexp_full_match(text, '[+-]?[0-9]+'), false) AS is_int,
        text <> 'n/a' AS is_double FROM (
          SELECT event_id, CASE WHEN is_scenario THEN concat(' ', value) WHEN is_online THEN value ELSE 'n/a' END AS text FROM readings)""",
    "json_fields": "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
    "json_encode": f"""SELECT event_id, concat('{{"space_id":', space_id, ',"zone_device_id":', zone_device_id,
        ',"zone_device_control_id":', zone_device_control_id, ',"ts":"', strftime(ts, {_SECONDS}), '","is_online":', is_online,
        ',"value":"', value, '","is_scenario":', is_scenario, '}}') AS json FROM readings""",
    "least_value": "SELECT l_orderkey, l_linenumber, least(l_quantity, 25.0) AS smaller FROM lineitem",
    "decimal_delta": """SELECT event_id, CAST(CAST(value AS DECIMAL(18,9)) - CAST(0.1 AS DECIMAL(18,9)) AS DOUBLE) AS difference,
        CAST(CAST(value AS DECIMAL(18,9)) + CAST(0.2 AS DECIMAL(18,9)) AS DOUBLE) AS sum FROM events""",
    "date_builtins": """SELECT o_orderkey, CAST(date_diff('day', o_orderdate, TIMESTAMP '1998-06-29') AS INTEGER) AS age_days,
        CAST(o_orderdate - INTERVAL '30' DAY AS DATE) AS month_before, CAST(o_orderdate AS DATE) <= DATE '1998-05-30' AS before_window
        FROM orders""",
    "string_contains": f"""SELECT concat(space_id, '-', zone_device_id, '-', zone_device_control_id) AS _id, {TRIPLE}
        FROM registry WHERE space_id >= 10""",
    "stream_hourly_meter": f"SELECT * FROM best WHERE {_closed('date_time_key', 'HOUR')}",
    "stream_minute_camera": f"""SELECT * FROM (SELECT user_id % 50 AS space_id,
        CAST(sum(CAST(floor(value) AS INTEGER)) AS INTEGER) AS value,
        arg_max(event_type <> 'error', ts) AS is_online, arg_max(event_type = 'signup', ts) AS is_scenario,
        date_trunc('minute', ts) AS ts FROM events GROUP BY user_id % 50, date_trunc('minute', ts)) WHERE {_closed('ts', 'MINUTE')}""",
    "stream_minute_co2": f"""SELECT {TRIPLE}, date_trunc('hour', ts) AS hour, count(*) AS minutes,
        count(*) FILTER (carried) AS carried, min(value) AS least, max(value) AS most,
        count(*) FILTER (is_online) AS online, count(*) FILTER (is_scenario) AS scenario
        FROM ({_carry("minutes", "ts", "MINUTE", None)}) GROUP BY ALL""",
    "stream_carry_forward": _carry("best", "date_time_key", "HOUR", None),
    "stream_state_handover": _carry("best", "date_time_key", "HOUR", None),
    "stream_late_correction": "SELECT * FROM best",
    "stream_refused": """SELECT CASE WHEN event_id % 10 = 0 THEN concat('{"event":', event_id)
        ELSE concat('{"spaceId":1,"event":', event_id, '}') END AS refused FROM events WHERE event_id % 10 < 2""",
    "ragged_messages": f"""SELECT {TRIPLE}, date_trunc('second', ts) AS ts, is_online,
        CASE WHEN event_id % 10 = 2 AND CAST(value AS DOUBLE) = floor(CAST(value AS DOUBLE)) THEN CAST(CAST(CAST(value AS DOUBLE) AS BIGINT) AS VARCHAR)
          WHEN event_id % 10 = 2 THEN CAST(CAST(value AS DOUBLE) AS VARCHAR) ELSE value END AS value, is_scenario
        FROM readings WHERE event_id % 10 > 1""",
    "stream_ingest": f"""SELECT kind, {TRIPLE}, ts, is_online, is_scenario, value_double, value_int FROM typed
        WHERE kind IS NOT NULL""",
    "stream_ingest_cold": f"""SELECT kind, {TRIPLE}, ts, is_online, is_scenario,
        CASE WHEN kind IN ('meter', 'co2') THEN TRY_CAST(value AS DOUBLE) END AS value_double,
        CASE WHEN kind = 'camera' AND regexp_full_match(value, '[+-]?[0-9]+') THEN TRY_CAST(value AS INTEGER) END AS value_int
        FROM (SELECT l.*, CASE m.device_type_c WHEN 'camera' THEN 'camera' WHEN 'airpurifiercontrol' THEN 'co2'
            ELSE 'meter' END AS kind FROM live l JOIN master m USING ({TRIPLE}))""",
    "q_ingest_route": f"SELECT {TRIPLE}, ts, route, kind, device_type, value_double, value_int FROM typed",
    "q_hourly_meter": "SELECT * FROM best",
    "q_hourly_filled": f"SELECT * RENAME (ts AS date_time_key) FROM ({_fill_between('whole', 'ts')})",
    "q_missing_dates": f"SELECT * RENAME (ts AS date_time_key) FROM ({_fill_forward('whole', 'ts')})",
    "q_daily_consumption": _Q_DAILY,
    "q_booking_hours": "SELECT * FROM hours",
    "q_consumption_target": """SELECT h.order_id, h.order_number, h.user_name, h.room, h.space_id,
        max(now.on_rerent) AS on_rerent, r.device_type, min(r.zone_device_id) AS zone_device_id,
        arg_min(r.zone_device_control_id, r.zone_device_id) AS zone_device_control_id,
        'dev-' || min(r.zone_device_id)::VARCHAR AS zone_device_code,
        CAST(sum(CAST(r.accumulate_value AS DECIMAL(18,2))) AS DOUBLE) AS consumption,
        count(DISTINCT CAST(h.date AS DATE)) AS days, DATE '1998-06-29' AS date_key,
        TIMESTAMP '2024-02-01 00:00:00' AS created_at
        FROM hours h LEFT JOIN space_hourly r ON h.space_id = r.space_id AND h.date_time_key = r.date_time_key
        JOIN (SELECT DISTINCT order_id, on_rerent FROM kept_days WHERE date = DATE '1998-06-29') now
          ON h.order_id = now.order_id
        WHERE NOT h.on_rerent
        GROUP BY h.order_id, h.order_number, h.user_name, h.room, h.space_id, r.device_type""",
    "q_history_backfill": f"SELECT {TRIPLE}, ts, is_online, is_scenario, value FROM reads",
    "q_wide_export": "SELECT * FROM wide",
}

ORACLES = {key: _with(body) for key, body in _BODIES.items()}
