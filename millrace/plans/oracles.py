"""The registered queries in plain SQL, written on their own from the same rules."""

from __future__ import annotations

ORACLES = {}

EVENTS = """
events_log AS (
  SELECT event_id AS "offset", CAST(user_id % 6 AS INTEGER) AS "partition", user_id,
         ts AS occurred_at, event_type, value, props
  FROM events)"""

LATE = """
late_log AS (
  SELECT event_id AS "offset", CAST(user_id % 6 AS INTEGER) AS "partition", user_id, event_type,
         ts AS recorded,
         CASE WHEN event_id % 17 = 0 THEN ts - INTERVAL 20 MINUTE
              WHEN event_id % 11 = 0 THEN ts - INTERVAL 2 MINUTE ELSE ts END AS occurred_at
  FROM events),
timed AS (
  SELECT *, max(occurred_at) OVER (PARTITION BY "partition" ORDER BY "offset"
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stream_time
  FROM late_log)"""

ORDERS = """
orders_log AS (
  SELECT o_orderkey AS "offset", 'evt-' || o_orderkey AS event_id, o_orderdate AS occurred_at,
         'trace-' || o_orderkey AS trace_id, CAST(o_orderkey AS VARCHAR) AS order_id,
         o_custkey AS user_id, CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount,
         o_orderpriority AS priority
  FROM orders)"""

PROFILES = """
profiles AS (
  SELECT c_custkey AS user_id, c_name AS name,
         lower(replace(c_name, '#', '.')) || '@example.com' AS email
  FROM customer)"""

ENRICHED = f"""{ORDERS}, {PROFILES},
enriched AS (
  SELECT o.order_id, o.event_id, o.occurred_at, o.trace_id, o.user_id, o.total_amount,
         p.name AS user_name, p.email AS user_email, o."offset", o.priority
  FROM orders_log o JOIN profiles p ON o.user_id = p.user_id)"""


def window_start(ts, seconds):
    """Start of the epoch-aligned window of a timestamp."""
    micros = seconds * 1_000_000
    return f"make_timestamp((epoch_us({ts}) // {micros}) * {micros})"


def numbered(source, seconds, user="user_id", ts="occurred_at"):
    return f"""
      SELECT *, {window_start(ts, seconds)} AS window_start,
             row_number() OVER (PARTITION BY {user}, {window_start(ts, seconds)}
                                ORDER BY "offset") AS n
      FROM {source}"""


def velocity(source, seconds, threshold=3):
    return f"""
      SELECT 'velocity|' || user_id || '|' || epoch_ms(window_start) AS order_id, user_id,
             'VELOCITY' AS reason, least(1.0, n / 10.0)::DOUBLE AS score, n
      FROM ({numbered(source, seconds)}) WHERE n >= {threshold}"""


def high_value(threshold=10000):
    return f"""
      SELECT trace_id, order_id, user_id, 'HIGH_VALUE' AS reason, 1.0::DOUBLE AS score
      FROM orders_log WHERE total_amount > {threshold}"""


ORACLES["high_value_alerts"] = f"WITH {ORDERS} {high_value()}"
ORACLES["high_value_alerts_400k"] = f"WITH {ORDERS} {high_value(400000)}"
ORACLES["velocity_alerts_5m"] = f"WITH {EVENTS} {velocity('events_log', 300)}"
ORACLES["velocity_alerts_1d"] = f"WITH {EVENTS} {velocity('events_log', 86400)}"
ORACLES["running_counts"] = f"""
  WITH {EVENTS} SELECT "offset", user_id, window_start, n FROM ({numbered('events_log', 86400)})"""
ORACLES["window_counts"] = f"""
  WITH {EVENTS}, w AS (SELECT user_id, {window_start('occurred_at', 3600)} AS window_start
                       FROM events_log)
  SELECT user_id, window_start, window_start + INTERVAL 1 HOUR AS window_end, count(*) AS n
  FROM w GROUP BY user_id, window_start"""
_FRAUD = f"""
  SELECT order_id, user_id, reason, score FROM ({high_value()})
  UNION ALL
  SELECT order_id, user_id, reason, score FROM ({velocity('orders_log', 30 * 86400)})"""
ORACLES["fraud_alerts"] = f"WITH {ORDERS} {_FRAUD}"
ORACLES["fraud_counters"] = f"""
  WITH {ORDERS} SELECT reason, count(*) AS n FROM ({_FRAUD}) GROUP BY reason"""
ORACLES["stream_time"] = f"""
  WITH {LATE} SELECT "offset", "partition", occurred_at, stream_time FROM timed"""
ORACLES["late_accepted"] = f"""
  WITH {LATE} SELECT "offset", user_id, occurred_at FROM timed
  WHERE {window_start('occurred_at', 300)} + INTERVAL 5 MINUTE > stream_time - INTERVAL 1 MINUTE"""
ORACLES["late_filtered_velocity"] = f"""
  WITH {LATE}, accepted AS (
    SELECT * FROM timed
    WHERE {window_start('occurred_at', 3600)} + INTERVAL 1 HOUR > stream_time - INTERVAL 1 MINUTE)
  {velocity('accepted', 3600, 2)}"""
ORACLES["late_candidates"] = f"""
  WITH {LATE}, lagged AS (
    SELECT "offset", user_id, epoch_ms(recorded) - epoch_ms(occurred_at) AS lag_ms FROM late_log)
  SELECT * FROM lagged WHERE lag_ms >= 60000"""
ORACLES["event_times"] = f"""
  WITH {LATE}, own AS (
    SELECT "offset", "partition",
           CASE WHEN event_type = 'error' THEN NULL
                WHEN event_type = 'click' THEN recorded ELSE occurred_at END AS t
    FROM late_log)
  SELECT "offset", "partition",
         coalesce(t, max(t) OVER (PARTITION BY "partition" ORDER BY "offset"
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS event_time
  FROM own"""

ORACLES["enriched_orders"] = f"WITH {ENRICHED} SELECT * FROM enriched"
_CHANGES = """
changes AS (
  SELECT user_id, "offset", 'user-' || user_id || '-v' || "offset" AS name
  FROM events_log WHERE event_type = 'signup')"""
_ASOF = f"""
  SELECT p.user_id, p."offset", CAST(p.value AS DECIMAL(18,2)) AS total_amount,
         c.name AS user_name, c.name || '@example.com' AS user_email
  FROM (SELECT * FROM events_log WHERE event_type = 'purchase') p
  ASOF JOIN changes c ON p.user_id = c.user_id AND p."offset" >= c."offset" """
ORACLES["asof_enriched"] = f"WITH {EVENTS}, {_CHANGES} {_ASOF}"
ORACLES["asof_enriched_tombstones"] = f"""
  WITH {EVENTS}, marks AS (
    SELECT user_id, "offset", value, event_type,
           max(CASE WHEN event_type IN ('signup', 'error') THEN "offset" END)
             OVER (PARTITION BY user_id ORDER BY "offset") AS changed_at
    FROM events_log WHERE event_type IN ('signup', 'error', 'purchase')),
  hits AS (
    SELECT m.user_id, m."offset", CAST(m.value AS DECIMAL(18,2)) AS total_amount,
           'user-' || m.user_id || '-v' || e."offset" AS user_name
    FROM marks m JOIN events_log e ON e."offset" = m.changed_at
    WHERE m.event_type = 'purchase' AND e.event_type = 'signup')
  SELECT *, user_name || '@example.com' AS user_email FROM hits"""
ORACLES["latest_profile"] = f"""
  WITH {EVENTS}, ranked AS (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY "offset" DESC) AS r FROM events_log)
  SELECT user_id, "offset", event_type, value FROM ranked WHERE r = 1 AND event_type <> 'error'"""
_UNWRAPPED = """
  SELECT user_id AS key, 'users-cdc' AS topic, "partition", "offset",
         CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
         CASE WHEN event_type <> 'error' THEN value END AS value
  FROM events_log"""
ORACLES["cdc_unwrapped"] = f"WITH {EVENTS} {_UNWRAPPED}"
ORACLES["cdc_state"] = f"""
  WITH {EVENTS}, ranked AS (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY "partition" DESC, "offset" DESC) AS r
    FROM ({_UNWRAPPED}))
  SELECT key, "offset", event_type, value FROM ranked WHERE r = 1 AND event_type IS NOT NULL"""
ORACLES["last_100_alerts"] = f"""
  WITH {ORDERS} SELECT "offset", trace_id, order_id, user_id, 'HIGH_VALUE' AS reason,
         1.0::DOUBLE AS score
  FROM orders_log WHERE total_amount > 10000 ORDER BY "offset" DESC LIMIT 100"""
ORACLES["last_50_cdc"] = f"""
  WITH {EVENTS} SELECT key, "offset", event_type FROM ({_UNWRAPPED})
  ORDER BY "offset" DESC LIMIT 50"""
ORACLES["topic_upsert"] = f"""
  WITH {EVENTS}, {PROFILES}, given AS (
    SELECT user_id,
           max_by('name-' || "offset", "offset") FILTER (event_type = 'signup') AS name,
           max_by('mail-' || "offset", "offset") FILTER (event_type IN ('signup', 'view')) AS email,
           max_by('phone-' || "offset", "offset") FILTER (event_type = 'purchase') AS phone
    FROM events_log WHERE event_type IN ('signup', 'view', 'purchase') GROUP BY user_id)
  SELECT coalesce(p.user_id, g.user_id) AS user_id, coalesce(g.name, p.name) AS name,
         coalesce(g.email, p.email) AS email, g.phone,
         TIMESTAMP '2026-01-01 00:00:00' AS ingested_at
  FROM profiles p FULL JOIN given g ON p.user_id = g.user_id"""
ORACLES["document_upsert"] = f"""
  WITH {EVENTS}, {PROFILES}, ranked AS (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY "offset" DESC) AS r FROM events_log),
  docs AS (
    SELECT user_id, event_type, 'name-' || "offset" AS name,
           CASE WHEN event_type IN ('signup', 'view') THEN 'mail-' || "offset" END AS email
    FROM ranked WHERE r = 1)
  SELECT user_id, name, email FROM docs WHERE event_type <> 'error'
  UNION ALL
  SELECT * FROM profiles WHERE user_id NOT IN (SELECT user_id FROM docs)"""
ORACLES["order_lookup"] = f"""
  WITH {ENRICHED}, wanted AS (
    SELECT DISTINCT CAST(l_orderkey * 2 AS VARCHAR) AS order_id FROM lineitem)
  SELECT w.order_id, e.user_name, e.total_amount, e.order_id IS NOT NULL AS found,
         CASE WHEN e.order_id IS NULL THEN 'not found' END AS reason
  FROM wanted w LEFT JOIN enriched e ON w.order_id = e.order_id"""
ORACLES["search_orders"] = f"""
  WITH {ENRICHED}, ranked AS (
    SELECT order_id, user_email, priority,
           CAST(len(list_intersect(['customer.000000001', '1', 'urgent'], regexp_extract_all(
             lower(user_email) || chr(10) || lower(priority), '\\w+(?:\\.\\w+)*'))) AS INTEGER)
             AS matched
    FROM enriched)
  SELECT * FROM ranked WHERE matched > 0 ORDER BY matched DESC, order_id LIMIT 10"""

_PAYMENTS = """
  SELECT order_id, user_id, total_amount AS amount,
         CASE WHEN total_amount < 10000 THEN 'PAID' ELSE 'FAILED' END AS status,
         'pay-' || order_id AS transaction_id
  FROM orders_log"""
ORACLES["payments"] = f"WITH {ORDERS} {_PAYMENTS}"
ORACLES["payment_counters"] = f"""
  WITH {ORDERS} SELECT status, count(*) AS n FROM ({_PAYMENTS}) GROUP BY status"""
_NOTES = f"""
  WITH {ORDERS}, pay AS (
    SELECT *, CASE WHEN CAST(order_id AS BIGINT) % 97 <> 0 THEN 'pay-evt-' || order_id END AS event_id,
           'orderId=' || order_id || ' userId=' || user_id || ' status=' || status AS body,
           CASE WHEN CAST(order_id AS BIGINT) % 97 <> 0 THEN 1 ELSE 2 END AS copies
    FROM ({_PAYMENTS})),
  sent AS (SELECT * FROM pay UNION ALL SELECT * FROM pay WHERE copies = 2),
  notes AS (
    SELECT 'payments-email' AS channel, 'notification-email' AS group_id, event_id, order_id,
           user_id, 'Email sent ' || body || ' group=notification-email' AS message FROM sent
    UNION ALL
    SELECT 'payments-sms', 'notification-sms', event_id, order_id, user_id,
           'SMS sent ' || body || ' group=notification-sms' FROM sent
    UNION ALL
    SELECT 'shipments-in', 'notification-email', 'ship-evt-' || order_id, order_id, user_id,
           'tracking link sent shipmentId=ship-' || order_id || ' orderId=' || order_id ||
           ' userId=' || user_id || ' group=notification-email' FROM orders_log)"""
ORACLES["notifications"] = f"{_NOTES} SELECT * FROM notes"
ORACLES["notification_counters"] = f"""
  {_NOTES} SELECT channel, count(*) AS n FROM notes GROUP BY channel"""
_LAG = f"""
  WITH {EVENTS}, bounds AS (
    SELECT "partition", min("offset") AS lo, max("offset") + 1 AS hi FROM events_log GROUP BY 1),
  grp(group_id, until) AS (VALUES ('notification-email', TIMESTAMP '2024-01-20'),
                                  ('notification-sms', TIMESTAMP '2024-01-10')),
  committed AS (
    SELECT group_id, "partition", max("offset") + 1 AS at
    FROM events_log JOIN grp ON occurred_at < until
    WHERE NOT (group_id = 'notification-sms' AND "partition" = 5) GROUP BY 1, 2),
  lag AS (
    SELECT g.group_id, 'payments' AS topic, b."partition", coalesce(c.at, b.lo) AS committed_offset,
           b.hi AS end_offset, greatest(0, b.hi - coalesce(c.at, b.lo)) AS lag
    FROM bounds b CROSS JOIN grp g
    LEFT JOIN committed c ON c.group_id = g.group_id AND c."partition" = b."partition")"""
ORACLES["consumer_lag"] = f"{_LAG} SELECT * FROM lag"
ORACLES["group_lag"] = f"""
  {_LAG} SELECT group_id, topic, CAST(sum(lag) AS BIGINT) AS total_lag FROM lag GROUP BY 1, 2"""
ORACLES["enrichment_counters"] = f"""
  WITH {EVENTS}, {_CHANGES}
  SELECT 'consumed' AS table_name, count(*) AS n FROM events_log WHERE event_type = 'purchase'
  UNION ALL SELECT 'joined', count(*) FROM ({_ASOF})"""
ORACLES["row_counts"] = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS n FROM {name}"
    for name in ("orders", "lineitem", "events", "part")
)

ORACLES["order_totals"] = """
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_suppkey AS VARCHAR) AS user_id,
         CAST(CASE WHEN l_linestatus = 'F' THEN CAST(l_extendedprice AS DECIMAL(18,2))
              ELSE CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_quantity AS INTEGER)
                   + CAST(l_tax * 100 AS DECIMAL(18,2)) * l_linenumber END AS DECIMAL(18,2))
           AS total_amount,
         CASE WHEN l_returnflag = 'R' THEN 'EUR' ELSE 'USD' END AS currency
  FROM lineitem"""
ORACLES["order_lines"] = """
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_orderkey AS "offset", 0 AS line,
         CAST(l_partkey AS VARCHAR) AS sku, CAST(l_quantity AS INTEGER) AS quantity,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price FROM lineitem
  UNION ALL
  SELECT CAST(l_orderkey AS VARCHAR), l_orderkey, 1, 'shipping', l_linenumber,
         CAST(l_tax * 100 AS DECIMAL(18,2)) FROM lineitem"""
_REASON = """
  CASE o_orderkey % 50
    WHEN 1 THEN ['items is empty'] WHEN 2 THEN ['items has a line without sku']
    WHEN 3 THEN ['user_id is blank', 'items has a line below 1']
    WHEN 4 THEN ['items has a line without price'] WHEN 5 THEN ['event_id is null']
    WHEN 6 THEN ['occurred_at is null'] WHEN 7 THEN ['trace_id is blank']
    WHEN 8 THEN ['user_id is blank'] WHEN 9 THEN ['total_amount is null']
    WHEN 10 THEN ['currency is blank'] ELSE CAST([] AS VARCHAR[]) END"""
ORACLES["order_validation"] = f"""
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
         coalesce(array_to_string({_REASON}, '; '), '') AS reasons FROM orders"""
ORACLES["invalid_orders"] = f"""
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, unnest({_REASON}) AS reason FROM orders"""
_IDEMPOTENT = f"""
  WITH {EVENTS}, keyed AS (
    SELECT "offset", 'ord-' || "offset" AS order_id,
           CASE WHEN event_type IN ('purchase', 'signup')
                THEN user_id || '|' || event_type || '|' || strftime(occurred_at, '%Y-%m-%d')
                WHEN event_type = 'click' THEN user_id || '|' || strftime(occurred_at, '%Y-%m-%d')
                ELSE 'offset-' || "offset" END AS idempotency_key
    FROM events_log),
  placed AS (
    SELECT *, row_number() OVER (PARTITION BY idempotency_key ORDER BY "offset") AS r,
           first_value(order_id) OVER (PARTITION BY idempotency_key ORDER BY "offset")
             AS canonical_order_id
    FROM keyed)"""
ORACLES["idempotent_orders"] = f"""{_IDEMPOTENT}
  SELECT "offset", idempotency_key, order_id, canonical_order_id, r = 1 AS accepted FROM placed"""
ORACLES["intake_counters"] = f"""{_IDEMPOTENT}
  SELECT CASE WHEN r = 1 THEN 'success' ELSE 'duplicate' END AS result, count(*) AS n
  FROM placed GROUP BY 1"""
ORACLES["ledger_dedup"] = f"""
  WITH {EVENTS} SELECT "partition", "offset", user_id, event_type FROM events_log
  WHERE occurred_at >= TIMESTAMP '2024-01-10'"""


def _reserve(per_size, quantity="CAST(l_quantity AS INTEGER)"):
    return f"""
  WITH RECURSIVE lines AS (
    SELECT l_partkey AS sku, l_orderkey AS "offset", l_linenumber AS line,
           {quantity} AS quantity,
           row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey,
             l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) AS r
    FROM lineitem),
  fold AS (
    SELECT p_partkey AS sku, CAST(0 AS BIGINT) AS r, p_size * {per_size} AS left_over,
           CAST(NULL AS BIGINT) AS "offset", CAST(NULL AS INTEGER) AS line,
           CAST(NULL AS INTEGER) AS quantity, CAST(NULL AS VARCHAR) AS status
    FROM part
    UNION ALL
    SELECT f.sku, l.r,
           CAST(CASE WHEN l.quantity <= f.left_over THEN f.left_over - l.quantity
             ELSE f.left_over END AS BIGINT),
           l."offset", l.line, l.quantity,
           CASE WHEN l.quantity <= f.left_over THEN 'RESERVED' ELSE 'REJECTED' END
    FROM fold f JOIN lines l ON l.sku = f.sku AND l.r = f.r + 1)"""


ORACLES["reserve_stock"] = f"""{_reserve(10)}
  SELECT "offset", line, sku, quantity, status FROM fold WHERE r > 0"""
ORACLES["reserve_stock_ample"] = f"""{_reserve(40)}
  SELECT "offset", line, sku, quantity, status FROM fold WHERE r > 0"""
_ODD_QUANTITY = """CASE l_orderkey % 5 WHEN 1 THEN NULL WHEN 2 THEN 0
             WHEN 3 THEN -CAST(l_quantity AS INTEGER) ELSE CAST(l_quantity AS INTEGER) END"""
ORACLES["reserve_odd_lines"] = f"""{_reserve(3, _ODD_QUANTITY)}
  SELECT "offset", line, sku, quantity, status FROM fold WHERE r > 0"""
ORACLES["payment_events"] = f"""
  WITH {ORDERS}, named AS (
    SELECT *, md5('7:PAYMENT|' || length('pay-' || order_id) || ':pay-' || order_id) AS h
    FROM orders_log)
  SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' ||
         substr(h, 17, 4) || '-' || substr(h, 21, 12) AS event_id,
         occurred_at, trace_id, order_id, user_id, total_amount AS amount,
         CASE WHEN total_amount < 10000 THEN 'PAID' ELSE 'FAILED' END AS status,
         'pay-' || order_id AS transaction_id, order_id AS key
  FROM named"""
ORACLES["processed_once"] = f"""
  WITH {EVENTS} SELECT "partition", "offset", user_id, event_type FROM events_log
  WHERE occurred_at >= TIMESTAMP '2024-01-10'"""
ORACLES["stock_after"] = f"""{_reserve(10)}
  SELECT sku, CAST(min(left_over) AS BIGINT) AS quantity FROM fold GROUP BY sku"""
ORACLES["inventory_counters"] = f"""{_reserve(10)}
  SELECT status, count(*) AS n FROM fold WHERE r > 0 GROUP BY status"""
ORACLES["seeded_stock"] = """
  SELECT 'SKU-' || p_partkey AS sku, p_size * 10 AS quantity FROM part
  UNION ALL
  SELECT * FROM (VALUES ('SKU-1', 100), ('SKU-LOAD', 1000)) s(sku, quantity)
  WHERE s.sku NOT IN (SELECT 'SKU-' || p_partkey FROM part)"""
ORACLES["restock"] = """
  SELECT sku, CAST(sum(q) AS BIGINT) AS quantity FROM (
    SELECT p_partkey AS sku, p_size * 10 AS q FROM part
    UNION ALL
    SELECT l_partkey, CAST(l_quantity AS INTEGER) FROM lineitem
    WHERE l_returnflag = 'R' AND l_quantity >= 1) GROUP BY sku"""

_VIP = """
  SELECT c_custkey, CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'vip-' ELSE 'user-' END || c_custkey
         AS key FROM customer"""
ORACLES["vip_partition_md5"] = f"""
  SELECT c_custkey, key, CASE WHEN starts_with(key, 'vip-') THEN 0
         ELSE CAST(1 + ('0x' || substr(md5(key), 1, 7))::BIGINT % 5 AS INTEGER) END AS "partition"
  FROM ({_VIP})"""

# 32-bit arithmetic on wider integers; the last 0 to 3 bytes follow the whole words.
_M = "1540483477"
ORACLES["vip_partition_murmur2"] = f"""
  WITH keys AS ({_VIP}),
  bytes AS (
    SELECT c_custkey, key, length(key) AS n,
           list_transform(range(1, length(key) + 1),
                          lambda i: CAST(ascii(substr(key, i, 1)) AS BIGINT)) AS b
    FROM keys),
  words AS (
    SELECT *, list_transform(range(0, n // 4), lambda i:
             ((b[i*4+1] + b[i*4+2] * 256 + b[i*4+3] * 65536 + b[i*4+4] * 16777216) * {_M}) % 4294967296)
             AS w
    FROM bytes),
  mixed AS (
    SELECT *, list_prepend(xor(2538058380, CAST(n AS BIGINT)),
             list_transform(w, lambda k: (xor(k, k >> 24) * {_M}) % 4294967296)) AS w2 FROM words),
  folded AS (
    SELECT *, list_reduce(w2, lambda h, k: xor((h * {_M}) % 4294967296, k)) AS h FROM mixed),
  tailed AS (
    SELECT *, CASE n % 4
      WHEN 0 THEN h
      WHEN 1 THEN (xor(h, b[n]) * {_M}) % 4294967296
      WHEN 2 THEN (xor(h, b[n-1] + b[n] * 256) * {_M}) % 4294967296
      ELSE (xor(h, b[n-2] + b[n-1] * 256 + b[n] * 65536) * {_M}) % 4294967296 END AS t
    FROM folded),
  done AS (
    SELECT *, (xor(t, t >> 13) * {_M}) % 4294967296 AS u FROM tailed)
  SELECT c_custkey, key, CASE WHEN starts_with(key, 'vip-') THEN 0
         ELSE CAST(1 + (xor(u, u >> 15) & 2147483647) % 5 AS INTEGER) END AS "partition"
  FROM done"""

_VALUES = """
  values AS (
    SELECT *, CASE event_id % 13 WHEN 1 THEN substr(props, 1, 4) WHEN 2 THEN ''
                WHEN 3 THEN '{"k": "many"}' WHEN 4 THEN '{"other": 1}' ELSE props END AS v
    FROM events)"""
ORACLES["json_quarantine"] = f"""
  WITH {_VALUES}, told AS (
    SELECT event_id AS "offset", v,
           CASE WHEN v = '' THEN NULL WHEN NOT json_valid(v) THEN 'malformed'
                WHEN json_type(v, '$.k') = 'VARCHAR' THEN 'malformed'
                WHEN json_extract(v, '$.k') IS NULL THEN 'k is missing' END AS error
    FROM values)
  SELECT "offset",
         CASE WHEN v <> '' AND error IS NULL
              THEN CAST(json_extract_string(v, '$.k') AS INTEGER) END AS k,
         error, CASE WHEN error IS NULL THEN 0 ELSE 1 END AS attempts FROM told"""
ORACLES["tolerant_parse"] = f"""
  WITH {_VALUES}
  SELECT event_id AS "offset",
         CASE WHEN v <> '' AND json_valid(v) THEN json_extract_string(v, '$.k') END AS k,
         CASE WHEN v <> '' AND NOT json_valid(v) THEN v END AS raw FROM values"""
ORACLES["trace_headers"] = """
  WITH t AS (
    SELECT event_id AS "offset",
           CASE event_type WHEN 'view' THEN 'p-' || event_id WHEN 'signup' THEN 'p-' || event_id
             WHEN 'click' THEN 'h-' || event_id ELSE 'new-' || event_id END AS trace_id,
           CASE event_type WHEN 'view' THEN 2 ELSE 1 END AS n_headers
    FROM events)
  SELECT *, trace_id AS header FROM t"""
ORACLES["wire_frames"] = """
  SELECT c_custkey,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN ascii(substr(c_name, 1, 1)) ELSE 0 END AS magic,
         CASE WHEN c_mktsegment <> 'MACHINERY' THEN CAST(c_nationkey AS BIGINT) END AS schema_id,
         CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_name END AS body
  FROM customer"""
ORACLES["decoded_profiles"] = f"""
  WITH {PROFILES}
  SELECT CAST(7 AS BIGINT) AS schema_id, CAST(user_id AS VARCHAR) AS user_id, name, email
  FROM profiles"""
ORACLES["conformed_profiles"] = f"""
  WITH {PROFILES}
  SELECT CAST(user_id AS VARCHAR) AS user_id, name, email, CAST(NULL AS VARCHAR) AS phone
  FROM profiles
  UNION ALL
  SELECT 's' || s_suppkey, s_name, s_suppkey || '@supplier.example', '+' || s_nationkey
  FROM supplier"""
ORACLES["inferred_flat"] = """
  SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS "orderId",
         CAST(o_custkey AS INTEGER) AS "userId", o_orderkey + 3000000000 AS "bigId",
         CAST(o_totalprice AS DECIMAL(18,2)) AS "totalAmount",
         CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 4 END AS quarter,
         o_orderpriority = '1-URGENT' AS urgent,
         '{"status":"' || o_orderstatus || '"}' AS state
  FROM orders"""
ORACLES["topic_rows"] = f"""
  WITH {ORDERS}
  SELECT CAST(user_id AS VARCHAR) AS key,
         '{{"order_id":"' || order_id || '","user_id":' || user_id || ',"reason":"HIGH_VALUE"}}'
           AS value,
         'fraud-alerts' AS topic, trace_id AS trace
  FROM orders_log WHERE total_amount > 10000"""

ORACLES["alert_events"] = f"""
  WITH {ORDERS}, named AS (
    SELECT *, md5('10:HIGH_VALUE|' || length(order_id) || ':' || order_id) AS h FROM orders_log WHERE total_amount > 10000)
  SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' ||
         substr(h, 17, 4) || '-' || substr(h, 21, 12) AS event_id,
         occurred_at, trace_id, order_id, user_id, 'HIGH_VALUE' AS reason, 1.0::DOUBLE AS score
  FROM named"""
ORACLES["dead_letters"] = f"""
  WITH {_VALUES}
  SELECT CAST(user_id AS VARCHAR) AS key, v AS value, 'orders-dlq' AS topic,
         CAST(user_id % 6 AS INTEGER) AS "partition", event_id AS "offset",
         CASE WHEN NOT json_valid(v) OR json_type(v, '$.k') = 'VARCHAR' THEN 'malformed'
              ELSE 'k is missing' END AS error, 1 AS attempts
  FROM values
  WHERE v <> '' AND (NOT json_valid(v) OR json_extract(v, '$.k') IS NULL
                     OR json_type(v, '$.k') = 'VARCHAR')"""
ORACLES["stream_velocity"] = f"""
  WITH {EVENTS}, last AS (
    SELECT *, max(n) OVER (PARTITION BY order_id) AS top FROM ({velocity('events_log', 86400)}))
  SELECT order_id, user_id, reason, score, n FROM last WHERE n = top"""
ORACLES["stream_fraud_alerts"] = f"""
  WITH {ORDERS}, last AS (
    SELECT *, max(n) OVER (PARTITION BY order_id) AS top
    FROM ({velocity('orders_log', 30 * 86400)}))
  SELECT order_id, user_id, reason, score FROM ({high_value()})
  UNION ALL
  SELECT order_id, user_id, reason, score FROM last WHERE n = top"""
ORACLES["fraud_alerts_with_grace"] = f"""
  WITH {LATE}, accepted AS (
    SELECT * FROM timed
    WHERE {window_start('occurred_at', 3600)} + INTERVAL 1 HOUR > stream_time - INTERVAL 1 MINUTE)
  SELECT 'ord-' || event_id AS order_id, user_id, 'HIGH_VALUE' AS reason, 1.0::DOUBLE AS score
  FROM events WHERE CAST(value * 1000 AS DECIMAL(18,2)) > 90000
  UNION ALL
  SELECT order_id, user_id, reason, score FROM ({velocity('accepted', 3600, 2)})"""
ORACLES["stream_velocity_exact"] = ORACLES["late_filtered_velocity"]
ORACLES["stream_velocity_per_record"] = ORACLES["velocity_alerts_1d"]
ORACLES["stream_dedup"] = """
  SELECT DISTINCT user_id || '|' || event_type AS channel,
         strftime(ts, '%Y-%m-%d %H') AS event_id FROM events WHERE event_type <> 'view'
  UNION ALL
  SELECT user_id || '|' || event_type, NULL FROM events WHERE event_type = 'view'"""
ORACLES["stream_dedup_table"] = """
  SELECT user_id || '|' || event_type AS channel, strftime(ts, '%Y-%m-%d %H') AS event_id,
         min(event_id) AS "offset"
  FROM events e WHERE event_type <> 'view' GROUP BY 1, 2
  UNION ALL
  SELECT user_id || '|' || event_type, NULL, event_id FROM events WHERE event_type = 'view'"""
ORACLES["stream_enrich"] = ORACLES["asof_enriched"]
ORACLES["stream_enrich_keyed"] = ORACLES["asof_enriched"]
ORACLES["stream_reserve"] = ORACLES["reserve_stock"]
ORACLES["stream_payments"] = ORACLES["payments"]
ORACLES["stream_upsert"] = f"""
  WITH {EVENTS}, ranked AS (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY "offset" DESC) AS r FROM events_log)
  SELECT user_id, event_type, value FROM ranked WHERE r = 1 AND event_type <> 'error'"""
ORACLES["idempotent_null_keys"] = f"""
  WITH {EVENTS}, keyed AS (
    SELECT "offset", CASE WHEN user_id % 3 = 0 THEN user_id || '|' || event_type END AS idempotency_key,
           'ord-' || "offset" AS order_id
    FROM events_log)
  SELECT "offset", idempotency_key, order_id,
         CASE WHEN idempotency_key IS NULL THEN order_id
              ELSE first_value(order_id) OVER same END AS canonical_order_id,
         idempotency_key IS NULL OR row_number() OVER same = 1 AS accepted
  FROM keyed WINDOW same AS (PARTITION BY idempotency_key ORDER BY "offset")"""
ORACLES["ledger_ranges"] = """
  WITH done AS (SELECT DISTINCT event_id AS o FROM events WHERE event_id % 1000 <> 7),
  runs AS (SELECT o, o - row_number() OVER (ORDER BY o) AS run FROM done)
  SELECT 0 AS "partition", min(o) AS "first", max(o) AS "last" FROM runs GROUP BY run"""
ORACLES["processed_by_ranges"] = f"""
  WITH {EVENTS} SELECT "partition", "offset", user_id, event_type FROM events_log
  WHERE occurred_at >= TIMESTAMP '2024-01-10' AND "offset" % 11 <> 5"""
ORACLES["reserve_hot_returns"] = """
  WITH RECURSIVE lines AS MATERIALIZED (
    SELECT l_partkey % 50 AS sku, l_partkey AS part, l_orderkey AS "offset", l_linenumber AS line,
           CASE WHEN l_orderkey % 5 = 3 THEN -CAST(l_quantity AS INTEGER)
                ELSE CAST(l_quantity AS INTEGER) END AS quantity,
           row_number() OVER (PARTITION BY l_partkey % 50 ORDER BY l_orderkey, l_linenumber, l_partkey,
             l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) AS r
    FROM lineitem),
  steps AS MATERIALIZED (
    SELECT r, list({'sku': sku, 'part': part, 'offset': "offset", 'line': line, 'quantity': quantity}) AS now
    FROM lines GROUP BY r),
  shelf AS (SELECT p_partkey AS sku, p_size * 10 AS q FROM part WHERE p_partkey < 50),
  fold AS (
    SELECT CAST(0 AS BIGINT) AS r, (SELECT map(list(sku), list(CAST(q AS BIGINT))) FROM shelf) AS stock,
           CAST([] AS STRUCT(sku BIGINT, part BIGINT, "offset" BIGINT, line BIGINT, quantity BIGINT, fits BOOLEAN)[]) AS done
    UNION ALL
    SELECT s.r,
           map_from_entries(list_transform(map_entries(f.stock), lambda e: {'key': e.key, 'value':
             e.value - coalesce(list_sum(list_transform(list_filter(s.now,
               lambda n: n.sku = e.key AND n.quantity <= e.value), lambda n: n.quantity)), 0)::BIGINT})),
           list_transform(s.now, lambda n: {'sku': n.sku::BIGINT, 'part': n.part::BIGINT, 'offset': n."offset"::BIGINT,
             'line': n.line::BIGINT, 'quantity': n.quantity::BIGINT,
             'fits': coalesce(n.quantity <= f.stock[n.sku], false)})
    FROM fold f JOIN steps s ON s.r = f.r + 1),
  rows AS (SELECT unnest(done) AS d FROM fold)
  SELECT d."offset" AS "offset", CAST(d.line AS INTEGER) AS line, d.part AS part, d.sku AS sku,
         CAST(d.quantity AS INTEGER) AS quantity,
         CASE WHEN d.fits THEN 'RESERVED' ELSE 'REJECTED' END AS status
  FROM rows"""
ORACLES["reservation_events"] = f"""{_reserve(10)},
  placed AS (
    SELECT f.*, l.l_suppkey, l.l_extendedprice, l.l_discount, l.l_tax, l.l_shipdate
    FROM fold f JOIN (
      SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey,
        l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) AS r FROM lineitem) l
    ON l.l_partkey = f.sku AND l.r = f.r),
  named AS (
    SELECT *, md5(array_to_string([length(v) || ':' || v FOR v IN [
      CAST("offset" AS VARCHAR), CAST(sku AS VARCHAR), CAST("offset" AS VARCHAR), CAST(line AS VARCHAR),
      CAST(l_suppkey AS VARCHAR), CAST(quantity AS VARCHAR), CAST(l_extendedprice AS VARCHAR),
      CAST(l_discount AS VARCHAR), CAST(l_tax AS VARCHAR), strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')]], '|')) AS h
    FROM placed)
  SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' ||
         substr(h, 17, 4) || '-' || substr(h, 21, 12) AS event_id,
         l_shipdate AS occurred_at, 'trace-' || "offset" AS trace_id, CAST("offset" AS VARCHAR) AS order_id,
         sku, quantity, status, CAST("offset" AS VARCHAR) AS key, 'trace-' || "offset" AS header
  FROM named"""
ORACLES["stream_upsert_buckets"] = f"""
  WITH {EVENTS}, {PROFILES}, turns AS (SELECT *, row("offset" % 3, "offset") AS turn FROM events_log),
  given AS (
    SELECT user_id,
           max_by('name-' || "offset", turn) FILTER (event_type = 'signup') AS name,
           max_by('mail-' || "offset", turn) FILTER (event_type IN ('signup', 'view')) AS email,
           max_by('phone-' || "offset", turn) FILTER (event_type = 'purchase') AS phone
    FROM turns WHERE event_type IN ('signup', 'view', 'purchase') GROUP BY user_id)
  SELECT coalesce(p.user_id, g.user_id) AS user_id, coalesce(g.name, p.name) AS name,
         coalesce(g.email, p.email) AS email, g.phone
  FROM profiles p FULL JOIN given g ON p.user_id = g.user_id"""
ORACLES["stream_documents"] = f"""
  WITH {EVENTS}, judged AS (
    SELECT *, CASE WHEN event_type = 'error' THEN NULL WHEN "offset" % 29 = 2 THEN 'malformed'
                   WHEN "offset" % 29 = 1 THEN 'name is missing' END AS wrong
    FROM events_log),
  all_of AS (
    SELECT *, coalesce(wrong, CASE WHEN "offset" % 29 = 3 THEN 'key is missing' END) AS error FROM judged),
  ranked AS (
    SELECT *, row_number() OVER (PARTITION BY user_id
      ORDER BY occurred_at >= TIMESTAMP '2024-01-15' DESC, "offset" DESC) AS r
    FROM all_of WHERE error IS NULL)
  SELECT CAST(user_id AS VARCHAR) AS id, 'name-' || "offset" AS name,
         CASE WHEN event_type <> 'view' THEN 'mail-' || "offset" END AS email,
         occurred_at AS ingested_at, CAST(NULL AS BIGINT) AS "offset", CAST(NULL AS VARCHAR) AS error
  FROM ranked WHERE r = 1 AND event_type <> 'error'
  UNION ALL
  SELECT CASE WHEN "offset" % 29 <> 3 THEN CAST(user_id AS VARCHAR) END, NULL, NULL, NULL, "offset", error
  FROM all_of WHERE error IS NOT NULL"""
ORACLES["stream_reserve_redelivered"] = ORACLES["reserve_stock"]
ORACLES["stream_velocity_clock"] = ORACLES["late_filtered_velocity"]
ORACLES["enriched_broadcast"] = f"""
  WITH {ENRICHED} SELECT order_id, event_id, TIMESTAMP '2026-01-01 00:00:00' AS occurred_at, user_id,
         user_name, user_email FROM enriched"""
ORACLES["search_all_columns"] = f"""
  WITH {ENRICHED}, ranked AS (
    SELECT order_id, user_name, priority,
           CAST(len(list_intersect(['customer.000000001', 'example.com', 'trace', '7', '2', 'high'],
             regexp_extract_all(lower(concat_ws(chr(10), order_id, event_id, trace_id, user_name, user_email,
             priority)), '\\w+(?:\\.\\w+)*'))) AS INTEGER) AS matched
    FROM enriched)
  SELECT * FROM ranked WHERE matched > 0 ORDER BY matched DESC, order_id LIMIT 10"""
ORACLES["velocity_events"] = f"""
  WITH {EVENTS}, alerts AS (
    SELECT 'velocity|' || user_id || '|' || epoch_ms(window_start) AS order_id, user_id, n, window_start
    FROM ({numbered('events_log', 86400)}) WHERE n >= 3),
  named AS (
    SELECT *, md5('8:VELOCITY|' || length(order_id) || ':' || order_id || '|' || length(CAST(n AS VARCHAR))
                  || ':' || n) AS h FROM alerts),
  ids AS (
    SELECT *, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' ||
              substr(h, 17, 4) || '-' || substr(h, 21, 12) AS id FROM named)
  SELECT id AS event_id, window_start AS occurred_at, id AS trace_id, order_id, user_id, 'VELOCITY' AS reason,
         least(1.0::DOUBLE, n / 10.0::DOUBLE) AS score, n, user_id AS key
  FROM ids"""
ORACLES["partitions_of_keys"] = f"""
  SELECT user_id, count(*) AS n, CAST(1 AS BIGINT) AS partitions FROM events GROUP BY user_id"""
ORACLES["stream_retained_windows"] = f"""
  WITH {LATE}, windowed AS (
    SELECT *, {window_start('occurred_at', 3600)} AS window_start FROM timed),
  accepted AS (
    SELECT * FROM windowed WHERE window_start + INTERVAL 1 HOUR > stream_time - INTERVAL 1 MINUTE),
  last AS (SELECT "partition", max(stream_time) AS reached FROM timed GROUP BY "partition")
  SELECT user_id, window_start, window_start + INTERVAL 1 HOUR AS window_end, count(*) AS n
  FROM accepted JOIN last USING ("partition")
  WHERE window_start + INTERVAL 1 HOUR > reached - INTERVAL 1 MINUTE
  GROUP BY user_id, window_start"""
ORACLES["stream_payments_restarted"] = ORACLES["payments"]
ORACLES["stream_notification_groups"] = f"""
  SELECT * FROM ({ORACLES["notifications"]}) WHERE channel <> 'shipments-in'"""
ORACLES["stream_state_lookup"] = f"""
  WITH {EVENTS}, {_CHANGES}, last AS (
    SELECT user_id, max_by(name, "offset") AS name FROM changes GROUP BY user_id)
  SELECT c_custkey AS user_id, name, name || '@example.com' AS email, name IS NOT NULL AS found,
         CASE WHEN name IS NULL THEN 'not found' END AS reason
  FROM customer LEFT JOIN last ON user_id = c_custkey"""
ORACLES["stream_counters"] = f"""
  WITH {ORDERS}, p AS ({_PAYMENTS})
  SELECT 'payments-counted' AS "query", 'payments' AS name, label, n FROM (
    SELECT 'rows' AS label, count(*) AS n FROM p
    UNION ALL SELECT 'paid', count(*) FROM p WHERE status = 'PAID'
    UNION ALL SELECT 'failed', count(*) FROM p WHERE status = 'FAILED')"""
ORACLES["stream_topic_orders"] = f"""
  WITH {ORDERS}, lines AS (
    SELECT l_orderkey, count(*) AS n, sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_quantity AS INTEGER)) AS total,
           string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_linenumber, CAST(l_partkey AS VARCHAR),
             CAST(l_quantity AS INTEGER), CAST(l_extendedprice AS DECIMAL(18,2))) AS skus
    FROM lineitem GROUP BY l_orderkey)
  SELECT 'evt-' || o_orderkey AS event_id, o_orderdate AS occurred_at, CAST(o_orderkey AS VARCHAR) AS order_id,
         CAST(o_custkey AS VARCHAR) AS user_id,
         CAST(CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(18,2))
              ELSE coalesce(total, 0) END AS DECIMAL(18,2)) AS total_amount,
         CASE WHEN o_orderstatus <> 'O' THEN 'EUR' ELSE 'USD' END AS currency,
         coalesce(n, 0) AS n_items, coalesce(skus, '') AS skus
  FROM orders LEFT JOIN lines ON l_orderkey = o_orderkey"""
ORACLES["stream_payments_inserted"] = ORACLES["payments"]
ORACLES["stream_fraud_one_read"] = ORACLES["fraud_alerts_with_grace"]
