"""The result of each query as plain SQL, written from the rules and not from the code.

The change log is read here as columns, never through JSON.
"""

from __future__ import annotations

_CDC = """
keyed AS (
  SELECT *, user_id * 10 + event_id % 10 AS payment_id,
    TIMESTAMP '2023-12-01 00:00:00.25' + to_minutes(((user_id * 10 + event_id % 10) * 37) % 41760) AS first_created
  FROM events
),
cdc AS (
  SELECT payment_id, user_id % 10 + 1 AS merchant_id, user_id AS shopper_id,
    CAST(value AS DECIMAL(12,2)) AS amount,
    CASE event_id % 3 WHEN 0 THEN 'EUR' WHEN 1 THEN ' usd' ELSE 'Gbp ' END AS currency_raw,
    CASE event_id % 7 WHEN 0 THEN 'card' WHEN 1 THEN ' PayPal' WHEN 2 THEN 'Apple  Pay'
      WHEN 3 THEN 'Bank Transfer ' WHEN 4 THEN 'google_pay' WHEN 5 THEN 'CARD'
      ELSE 'Google Pay' END AS method_raw,
    CASE event_id % 6 WHEN 0 THEN 'Authorized' WHEN 1 THEN 'failed' WHEN 2 THEN 'REFUNDED'
      WHEN 3 THEN 'pending' WHEN 4 THEN ' authorized' ELSE 'chargeback' END AS status_raw,
    CASE user_id % 8 WHEN 0 THEN ' nl' WHEN 1 THEN 'US' WHEN 2 THEN 'de' WHEN 3 THEN 'BE '
      WHEN 4 THEN 'FR' WHEN 5 THEN 'gb' WHEN 6 THEN 'CA' ELSE 'ES' END AS country_raw,
    CASE WHEN event_id % 97 = 5 THEN NULL WHEN event_id % 89 = 7 THEN 't'
      WHEN event_type = 'error' THEN 'd' WHEN event_type = 'signup' THEN 'c'
      WHEN event_id % 11 = 0 THEN 'r' ELSE 'u' END AS op,
    CASE WHEN event_id % 53 = 0 THEN first_created + INTERVAL 3 HOUR ELSE first_created END AS created_raw,
    first_created,
    CASE WHEN event_id % 29 = 3 THEN ts - INTERVAL 2 HOUR
      WHEN event_id % 31 = 1 THEN date_trunc('day', ts) ELSE ts END AS updated_raw,
    CAST(payment_id % 3 AS INTEGER) AS kafka_partition,
    CASE WHEN ts < TIMESTAMP '2024-01-20' THEN event_id + 1300000000 ELSE event_id END AS kafka_offset,
    ts AS kafka_timestamp
  FROM keyed
),
ups AS (
  SELECT payment_id, merchant_id, amount, upper(trim(currency_raw)) AS currency,
    regexp_replace(lower(trim(method_raw)), '\\s+', '_', 'g') AS payment_method,
    regexp_replace(lower(trim(status_raw)), '\\s+', '_', 'g') AS payment_status,
    upper(trim(country_raw)) AS country_code,
    date_trunc('second', created_raw) AS created_at, date_trunc('second', updated_raw) AS updated_at,
    created_raw, updated_raw, kafka_offset, kafka_timestamp
  FROM cdc WHERE op IN ('c', 'u', 'r')
)"""

_PAYMENT = (
    "payment_id, merchant_id, amount, currency, payment_method, payment_status, country_code, "
    "created_at, updated_at"
)

_STATE = (
    _CDC
    + f""",
latest AS (
  SELECT {_PAYMENT} FROM ups
  QUALIFY row_number() OVER (PARTITION BY payment_id ORDER BY updated_at DESC, kafka_offset DESC) = 1
),
state AS (
  SELECT * FROM latest l
  WHERE NOT EXISTS (SELECT 1 FROM cdc d WHERE d.op = 'd' AND d.payment_id = l.payment_id)
)"""
)

_ORDERED = (
    _CDC
    + """,
ends AS (
  SELECT payment_id, kafka_timestamp, kafka_offset FROM cdc WHERE op IN ('c', 'u', 'r', 'd')
  QUALIFY row_number() OVER (PARTITION BY payment_id ORDER BY kafka_timestamp DESC, kafka_offset DESC) = 1
),
state AS (
  SELECT u.* FROM ups u JOIN ends e ON u.payment_id = e.payment_id AND u.kafka_timestamp = e.kafka_timestamp
    AND u.kafka_offset = e.kafka_offset
)"""
)

_TWO_BATCHES = (
    _CDC
    + f""",
latest AS (
  SELECT {_PAYMENT}, kafka_timestamp >= TIMESTAMP '2024-01-16' AS late FROM ups
  QUALIFY row_number() OVER (
    PARTITION BY payment_id, kafka_timestamp >= TIMESTAMP '2024-01-16'
    ORDER BY updated_at DESC, kafka_offset DESC) = 1
),
dels AS (
  SELECT DISTINCT payment_id, kafka_timestamp >= TIMESTAMP '2024-01-16' AS late FROM cdc WHERE op = 'd'
),
after_first AS (
  SELECT {_PAYMENT} FROM latest l WHERE NOT late
    AND NOT EXISTS (SELECT 1 FROM dels d WHERE NOT d.late AND d.payment_id = l.payment_id)
),
merged AS (
  SELECT {_PAYMENT} FROM latest WHERE late
  UNION ALL
  SELECT * FROM after_first a
  WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.late AND l.payment_id = a.payment_id)
),
state AS (
  SELECT * FROM merged m
  WHERE NOT EXISTS (SELECT 1 FROM dels d WHERE d.late AND d.payment_id = m.payment_id)
)"""
)

_PAY = """
pay AS (
  SELECT event_id AS payment_id, user_id % 10 + 1 AS merchant_id, user_id AS shopper_id,
    CAST(value AS DECIMAL(12,2)) AS amount,
    CASE event_id % 4 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' WHEN 2 THEN 'GBP' ELSE 'CAD' END AS currency,
    CASE event_id % 5 WHEN 0 THEN 'card' WHEN 1 THEN 'paypal' WHEN 2 THEN 'apple_pay'
      WHEN 3 THEN 'bank_transfer' ELSE 'google_pay' END AS payment_method,
    CASE event_id % 6 WHEN 0 THEN 'authorized' WHEN 1 THEN 'failed' WHEN 2 THEN 'refunded'
      WHEN 3 THEN 'pending' WHEN 4 THEN 'authorized' ELSE 'chargeback' END AS payment_status,
    CASE user_id % 8 WHEN 0 THEN 'NL' WHEN 1 THEN 'US' WHEN 2 THEN 'DE' WHEN 3 THEN 'BE'
      WHEN 4 THEN 'FR' WHEN 5 THEN 'GB' WHEN 6 THEN 'CA' ELSE 'ES' END AS country_code,
    ts AS created_at, ts + INTERVAL 1 HOUR AS updated_at
  FROM events
)"""

_REF = (
    _PAY
    + """,
ref AS (
  SELECT payment_id + 9100 AS refund_id, payment_id, amount AS refund_amount,
    CASE payment_id % 4 WHEN 0 THEN 'requested_by_customer' WHEN 1 THEN 'duplicate'
      WHEN 2 THEN 'suspected_fraud' ELSE 'inventory_shortfall' END AS refund_reason,
    updated_at + INTERVAL 30 MINUTE AS created_at
  FROM pay WHERE payment_status = 'refunded'
)"""
)

_DIRTY = (
    _PAY
    + """,
dirty AS (
  SELECT CASE WHEN payment_id % 101 = 0 THEN NULL WHEN payment_id % 103 = 1 THEN payment_id - 1
      ELSE payment_id END AS payment_id,
    CASE WHEN payment_id % 107 = 0 THEN NULL ELSE merchant_id END AS merchant_id,
    CASE WHEN payment_id % 109 = 0 THEN NULL WHEN payment_id % 113 = 0 THEN -amount ELSE amount END AS amount,
    CASE WHEN payment_id % 127 = 0 THEN NULL WHEN payment_id % 131 = 0 THEN 'EURO' ELSE currency END AS currency,
    CASE WHEN payment_id % 137 = 0 THEN NULL WHEN payment_id % 139 = 0 THEN 'cash'
      ELSE payment_method END AS payment_method,
    CASE WHEN payment_id % 149 = 0 THEN NULL WHEN payment_id % 151 = 0 THEN 'unknown'
      ELSE payment_status END AS payment_status,
    CASE WHEN payment_id % 157 = 0 THEN NULL WHEN payment_id % 163 = 0 THEN 'N1'
      ELSE country_code END AS country_code,
    CASE WHEN payment_id % 167 = 0 THEN NULL ELSE created_at END AS created_at,
    CASE WHEN payment_id % 173 = 0 THEN NULL WHEN payment_id % 179 = 0 THEN created_at - INTERVAL 1 HOUR
      ELSE updated_at END AS updated_at
  FROM pay
)"""
)

_RULES = {
    "null_payment_id": "payment_id IS NULL",
    "null_merchant_id": "merchant_id IS NULL",
    "null_amount": "amount IS NULL",
    "negative_amount": "amount < 0",
    "null_currency": "currency IS NULL",
    "invalid_currency": "NOT regexp_matches(currency, '^[A-Z]{3}$')",
    "null_payment_method": "payment_method IS NULL",
    "invalid_payment_method": "payment_method NOT IN ('apple_pay', 'bank_transfer', 'card', 'google_pay', 'paypal')",
    "null_payment_status": "payment_status IS NULL",
    "invalid_payment_status": (
        "payment_status NOT IN ('authorized', 'cancelled', 'chargeback', 'failed', 'pending', 'refunded')"
    ),
    "null_country_code": "country_code IS NULL",
    "invalid_country_code": "NOT regexp_matches(country_code, '^[A-Z]{2}$')",
    "null_created_at": "created_at IS NULL",
    "null_updated_at": "updated_at IS NULL",
    "updated_before_created": "updated_at < created_at",
}


def _gold(source: str) -> str:
    return f"""
  SELECT date_trunc('hour', created_at)::TIMESTAMP AS payment_hour, country_code, payment_method,
    count(*) AS payment_count, CAST(sum(amount) AS DECIMAL(18,2)) AS gross_volume,
    round(avg(CASE WHEN payment_status = 'authorized' THEN 1.0 ELSE 0.0 END), 5) AS auth_rate
  FROM {source} GROUP BY ALL"""


_OLD = "(SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')"
_NEW = """(SELECT * REPLACE (CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN 'X'
    ELSE o_orderstatus END AS o_orderstatus) FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01')"""

_SEED = """
numbers AS (SELECT event_id + 1 AS n FROM events),
made AS (
  SELECT 2000 + n AS payment_id, (n - 1) % 10 + 1 AS merchant_id, 700 + n AS shopper_id,
    CAST(25 + (n * 17) % 475 + CAST((n * 13) % 100 AS DECIMAL(10,2)) / 100 AS DECIMAL(12,2)) AS amount,
    (['EUR', 'USD', 'GBP', 'CAD'])[(n - 1) % 4 + 1] AS currency,
    (['card', 'paypal', 'apple_pay', 'bank_transfer', 'google_pay'])[(n - 1) % 5 + 1] AS payment_method,
    (['authorized', 'failed', 'authorized', 'pending', 'refunded', 'authorized', 'chargeback',
      'cancelled'])[(n - 1) % 8 + 1] AS payment_status,
    (['NL', 'US', 'DE', 'BE', 'FR', 'GB', 'CA', 'ES'])[(n - 1) % 8 + 1] AS country_code,
    date_trunc('hour', TIMESTAMP '2024-02-01 12:34:56' - to_hours((n - 1) % 168))
      - to_minutes((n - 1) % 4 * 15) AS created_at
  FROM numbers
),
seeded AS (
  SELECT *, created_at + to_hours(payment_id % 6 + 1) AS updated_at FROM made
)"""

ORACLE: dict[str, str] = {
    "q_bronze_project": f"""WITH {_CDC}
SELECT '{{"payment_id":' || payment_id || '}}' AS kafka_key, 'cdc.public.payments' AS kafka_topic,
  kafka_partition, kafka_offset, kafka_timestamp, op,
  CASE WHEN op <> 'd' THEN CAST(amount AS VARCHAR) END AS amount
FROM cdc""",
    "q_bronze_mask": f"""WITH {_CDC}
SELECT kafka_offset, op,
  CASE WHEN op IN ('u', 'd') THEN sha256(CAST(shopper_id AS VARCHAR)) END AS before_shopper,
  CASE WHEN op <> 'd' THEN sha256(CAST(shopper_id AS VARCHAR)) END AS after_shopper,
  CASE WHEN op <> 'd' THEN CAST(amount AS VARCHAR) END AS amount,
  CASE WHEN op <> 'd' THEN method_raw END AS method,
  CASE WHEN op <> 'd' THEN epoch_us(created_raw) END AS created_micros
FROM cdc""",
    "q_op_routing": f"""WITH {_CDC}
SELECT CASE WHEN op IS NULL THEN 'null_op' WHEN op = 'd' THEN 'delete'
  WHEN op IN ('c', 'u', 'r') THEN 'upsert' ELSE 'unexpected_op' END AS route, count(*) AS n
FROM cdc GROUP BY ALL""",
    "q_dlq": f"""WITH {_CDC}
SELECT CAST(7 AS BIGINT) AS batch_id, CASE WHEN op IS NULL THEN 'null_op' ELSE 'unexpected_op' END AS error_reason,
  CASE WHEN op IS NOT NULL THEN CAST(payment_id AS VARCHAR)
    WHEN kafka_offset % 2 = 0 THEN 'not-json' END AS subject
FROM cdc WHERE op IS NULL OR op NOT IN ('c', 'u', 'r', 'd')""",
    "q_silver_typed": f"WITH {_CDC} SELECT {_PAYMENT}, kafka_offset AS _kafka_offset FROM ups",
    "q_silver_latest": f"WITH {_STATE} SELECT * FROM latest",
    "q_silver_latest_maxby": f"WITH {_STATE} SELECT * FROM latest",
    "q_silver_micros": f"""WITH {_ORDERED}
SELECT payment_id, created_raw AS created_at, updated_raw AS updated_at FROM state""",
    "q_delete_keys": f"WITH {_CDC} SELECT payment_id FROM cdc WHERE op = 'd'",
    "q_silver_state_reference": f"WITH {_STATE} SELECT * FROM state",
    "q_silver_state_ordered": f"WITH {_ORDERED} SELECT {_PAYMENT} FROM state",
    "q_silver_two_batches": f"WITH {_TWO_BATCHES} SELECT * FROM state",
    "q_dq_metrics": f"WITH {_DIRTY} SELECT "
    + ", ".join(f"count(*) FILTER (WHERE {test}) AS {name}" for name, test in _RULES.items())
    + " FROM dirty",
    "q_dup_keys": f"""WITH {_DIRTY}
SELECT payment_id, count(*) AS row_count FROM dirty
WHERE payment_id IS NOT NULL GROUP BY payment_id HAVING count(*) > 1""",
    "q_quarantine": f"WITH {_DIRTY}, judged AS (SELECT array_to_string(list_sort(list_filter(["
    + ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in _RULES.items())
    + """], lambda r: r IS NOT NULL)), ',') AS broken_rules FROM dirty)
SELECT broken_rules, count(*) AS n FROM judged WHERE broken_rules <> '' GROUP BY broken_rules""",
    "q_fk_orphans": """WITH lines AS (
  SELECT CASE WHEN l_orderkey % 97 = 0 THEN -l_orderkey ELSE l_orderkey END AS l_orderkey FROM lineitem)
SELECT l_orderkey, count(*) AS child_rows FROM lines
WHERE l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l_orderkey)
GROUP BY l_orderkey""",
    "q_schema_drift": """SELECT 'events' AS table_name, 'event_type' AS column_name, count(event_type) AS filled_rows FROM events
UNION ALL SELECT 'events', 'props', count(props) FROM events""",
    "q_payload_drift": f"""WITH {_CDC}
SELECT column_name, count(*) AS records FROM cdc, (VALUES ('merchant_id'), ('shopper_id')) k(column_name)
WHERE op <> 'd' GROUP BY column_name""",
    "q_affected_hours": f"""WITH {_CDC}
SELECT DISTINCT date_trunc('hour', CASE WHEN op = 'd' THEN first_created ELSE created_raw END)::TIMESTAMP AS payment_hour
FROM cdc WHERE op IS NOT NULL AND NOT (op = 'd' AND kafka_offset % 13 = 0)""",
    "q_gold_hourly": f"WITH {_STATE} {_gold('state')}",
    "q_gold_incremental": f"WITH {_TWO_BATCHES} {_gold('state')}",
    "q_silver_rows": f"WITH {_STATE} SELECT count(*) AS silver_rows FROM state",
    "q_gold_rows": f"WITH {_PAY} SELECT count(*) AS gold_rows FROM ({_gold('pay')})",
    "q_rollup_country_method": f"""WITH {_PAY}
SELECT country_code, payment_method, CAST(sum(payment_count) AS BIGINT) AS total_payments,
  CAST(sum(gross_volume) AS DECIMAL(18,2)) AS total_volume
FROM ({_gold('pay')}) GROUP BY ALL""",
    "q_rollup_auth_rate": f"""WITH {_PAY}
SELECT country_code, round(avg(CASE WHEN payment_status = 'authorized' THEN 1.0 ELSE 0.0 END), 9) AS auth_rate
FROM pay GROUP BY country_code""",
    "q_silver_serving": f"""WITH {_STATE}
SELECT payment_id, amount, payment_method, payment_status, created_at, updated_at FROM state ORDER BY payment_id""",
    "q_gold_serving": f"WITH {_PAY} {_gold('pay')} ORDER BY 1, 2, 3",
    "q_total_payments": f"WITH {_PAY} SELECT count(*)::DOUBLE AS total_payments FROM pay",
    "q_gross_volume": f"WITH {_PAY} SELECT coalesce(sum(amount), 0)::DOUBLE AS gross_volume FROM pay",
    "q_auth_rate": f"""WITH {_PAY}
SELECT coalesce(avg(CASE WHEN payment_status = 'authorized' THEN 1.0 ELSE 0.0 END), 0)::DOUBLE AS authorization_rate
FROM pay""",
    "q_refund_count": f"WITH {_REF} SELECT count(*)::DOUBLE AS refunds_issued FROM ref",
    "q_volume_by_hour": f"""WITH {_PAY}
SELECT date_trunc('hour', created_at)::TIMESTAMP AS time, sum(amount)::DOUBLE AS gross_volume
FROM pay GROUP BY 1 ORDER BY 1""",
    "q_method_mix": f"""WITH {_PAY}
SELECT payment_method, count(*)::DOUBLE AS payments FROM pay GROUP BY 1 ORDER BY 2 DESC""",
    "q_volume_by_country": f"""WITH {_PAY}
SELECT country_code, sum(amount)::DOUBLE AS gross_volume FROM pay GROUP BY 1 ORDER BY 2 DESC""",
    "q_refunds_by_hour": f"""WITH {_REF}
SELECT date_trunc('hour', created_at)::TIMESTAMP AS time, count(*)::DOUBLE AS refunds
FROM ref GROUP BY 1 ORDER BY 1""",
    "q_method_share": f"""WITH {_PAY}
SELECT payment_method, count(*) AS payments, count(*) / (SELECT count(*) FROM pay) AS share
FROM pay GROUP BY payment_method""",
    "q_auth_rate_4dp": f"""WITH {_PAY}
SELECT CAST(round_even(count(*) FILTER (WHERE payment_status = 'authorized') / count(*), 4) AS DECIMAL(5,4)) AS auth_rate
FROM pay""",
    "q_normalize_payment": f"""WITH {_CDC}
SELECT payment_id, merchant_id, shopper_id, amount, upper(currency_raw) AS currency,
  replace(lower(trim(method_raw)), ' ', '_') AS payment_method,
  replace(lower(trim(status_raw)), ' ', '_') AS payment_status,
  upper(trim(country_raw)) AS country_code, created_raw AS created_at, updated_raw AS updated_at
FROM cdc""",
    "q_merge_upsert": f"""SELECT * FROM {_NEW}
UNION ALL SELECT * FROM {_OLD} o WHERE NOT EXISTS (SELECT 1 FROM {_NEW} n WHERE n.o_orderkey = o.o_orderkey)""",
    "q_delete_by_key": """SELECT * FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey IS NOT NULL)""",
    "q_update_by_key": f"""WITH {_PAY}
SELECT * REPLACE (
  CASE WHEN shopper_id = 7 THEN 149.99 ELSE amount END::DECIMAL(12,2) AS amount,
  CASE WHEN shopper_id = 7 THEN 'authorized' ELSE payment_status END AS payment_status,
  CASE WHEN shopper_id = 7 THEN TIMESTAMP '2024-02-01 12:34:56' ELSE updated_at END AS updated_at)
FROM pay""",
    "q_insert_if_absent": f"""SELECT * FROM {_OLD}
UNION ALL SELECT * FROM {_NEW} n WHERE n.o_orderkey % 101 <> 0
  AND NOT EXISTS (SELECT 1 FROM {_OLD} o WHERE o.o_orderkey = n.o_orderkey)
UNION ALL SELECT n.* REPLACE (NULL AS o_orderkey, o_totalprice + more AS o_totalprice)
FROM {_NEW} n, unnest([0, 1]) AS m(more) WHERE o_orderkey % 101 = 0""",
    "q_change_feed": f"""SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey,
  CASE WHEN o.o_orderkey IS NULL THEN 'c' WHEN n.o_orderkey IS NULL THEN 'd' ELSE 'u' END AS op,
  o.o_orderstatus AS old_status, n.o_orderstatus AS new_status,
  CASE WHEN n.o_orderpriority = '1-URGENT' THEN 'yes' END AS new_rush, epoch_us(n.o_orderdate) AS new_date_micros
FROM {_OLD} o FULL JOIN {_NEW} n ON o.o_orderkey = n.o_orderkey
WHERE o.o_orderkey IS NULL OR n.o_orderkey IS NULL OR o.o_orderstatus <> n.o_orderstatus
  OR n.o_orderpriority = '1-URGENT'""",
    "q_sparse_change_feed": """SELECT -o_orderkey AS o_orderkey, 'c' AS op, NULL AS old_status,
  o_orderstatus AS new_status, NULL::BOOLEAN AS dearer
FROM orders WHERE o_orderkey % 1000 = 1
UNION ALL SELECT o_orderkey, 'd', o_orderstatus, NULL, NULL FROM orders WHERE o_orderkey % 1000 = 4
UNION ALL SELECT o_orderkey, 'u', o_orderstatus, o_orderstatus, true FROM orders WHERE o_orderkey % 1000 = 2
UNION ALL SELECT o_orderkey, 'u', o_orderstatus, NULL, false FROM orders WHERE o_orderkey % 1000 = 3 AND o_orderstatus IS NOT NULL""",
    "q_snapshot_feed": "SELECT o_orderkey, 'r' AS op, o_totalprice FROM orders",
    "q_seed_payments": f"""WITH {_SEED}
SELECT * FROM seeded
UNION ALL SELECT * FROM (VALUES
  (1001::BIGINT, 1::BIGINT, 501::BIGINT, 149.99::DECIMAL(12,2), 'EUR', 'card', 'authorized', 'NL',
    TIMESTAMP '2024-01-30 12:34:56', TIMESTAMP '2024-01-30 12:34:56'),
  (1002, 2, 502, 499.50, 'USD', 'paypal', 'failed', 'US',
    TIMESTAMP '2024-01-31 12:34:56', TIMESTAMP '2024-01-31 12:34:56'),
  (1003, 1, 503, 89.00, 'EUR', 'card', 'authorized', 'BE',
    TIMESTAMP '2024-02-01 00:34:56', TIMESTAMP '2024-02-01 00:34:56'),
  (1004, 3, 504, 44.25, 'EUR', 'card', 'refunded', 'DE',
    TIMESTAMP '2024-02-01 06:34:56', TIMESTAMP '2024-02-01 10:34:56'))""",
    "q_seed_refunds": f"""WITH {_SEED}
SELECT 9100 + payment_id AS refund_id, payment_id, amount AS refund_amount,
  CASE payment_id % 4 WHEN 0 THEN 'requested_by_customer' WHEN 1 THEN 'duplicate'
    WHEN 2 THEN 'suspected_fraud' ELSE 'inventory_shortfall' END AS refund_reason,
  updated_at + INTERVAL 30 MINUTE AS created_at
FROM seeded WHERE payment_status = 'refunded' AND payment_id BETWEEN 2001 AND 2000 + (SELECT max(n) FROM numbers)
  AND 9100 + payment_id <> 9001
UNION ALL SELECT 9001, 1004, 44.25, 'duplicate', TIMESTAMP '2024-02-01 11:34:56'""",
    "q_state_counts": "SELECT "
    + ", ".join(
        f"count(*) FILTER (WHERE event_type = '{s}') AS {s}"
        for s in ("click", "view", "signup", "purchase", "error", "refund")
    )
    + " FROM events",
    "q_last_value": """SELECT user_id, arg_max(value, (ts, event_id)) AS value FROM events
WHERE event_type <> 'error' AND value IS NOT NULL GROUP BY user_id""",
    "q_sum_latest": """SELECT CAST(sum(value) AS DECIMAL(18,2)) AS total FROM (
  SELECT CAST(value AS DECIMAL(12,2)) AS value FROM events WHERE value IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) = 1)""",
    "q_counter_rate": """WITH paired AS (
  SELECT event_type, ts, CAST(value AS DECIMAL(12,2)) AS value,
    lag(CAST(value AS DECIMAL(12,2))) OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) AS previous
  FROM events WHERE event_id % 17 <> 0 AND value IS NOT NULL)
SELECT event_type, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
  sum(CASE WHEN value >= previous THEN value - previous ELSE value END)::DOUBLE / 300 AS rate
FROM paired WHERE previous IS NOT NULL GROUP BY 1, 2""",
    "q_stream_silver": f"WITH {_ORDERED} SELECT {_PAYMENT} FROM state",
    "q_stream_gold": f"WITH {_STATE} {_gold('state')}",
    "q_stream_gold_events": f"WITH {_TWO_BATCHES} {_gold('state')}",
    "q_silver_version": f"WITH {_TWO_BATCHES} SELECT * FROM after_first",
    "q_table_silver": f"WITH {_TWO_BATCHES} SELECT * FROM state",
    "q_gold_retraction": f"WITH {_TWO_BATCHES} {_gold('state')}",
    "q_stream_once": f"WITH {_CDC} SELECT kafka_partition, count(*) AS n FROM cdc GROUP BY kafka_partition",
    "q_stream_dlq": f"""WITH {_CDC}
SELECT CASE WHEN op IS NULL THEN 'null_op' ELSE 'unexpected_op' END AS error_reason, count(*) AS n
FROM cdc WHERE op IS NULL OR op NOT IN ('c', 'u', 'r', 'd') GROUP BY 1""",
    "q_type_drift": f"""WITH {_CDC},
images AS (
  SELECT 'after' AS side, kafka_offset FROM cdc WHERE op IS NOT NULL AND op <> 'd'
  UNION ALL SELECT 'before', kafka_offset FROM cdc WHERE op IN ('u', 'd')
),
moved AS (SELECT side, count(*) AS n FROM images WHERE kafka_offset % 5 = 0 GROUP BY side)
SELECT side || '.merchant_id' AS path, 'object' AS kind, 'number' AS expected, n AS records FROM moved
UNION ALL SELECT side || '.merchant_id.id', 'number', NULL, n FROM moved
UNION ALL SELECT 'before.country_code', 'text', NULL, count(*) FROM images WHERE side = 'before' HAVING count(*) > 0
UNION ALL SELECT side || '.created_at', 'number', 'text', count(*) FROM (
  SELECT 'after' AS side FROM cdc WHERE op IS NOT NULL AND op <> 'd'
  UNION ALL SELECT 'before' FROM cdc WHERE op IN ('u', 'd') AND NOT (op = 'd' AND kafka_offset % 13 = 0)
) GROUP BY side""",
    "q_stream_last_value": """SELECT user_id, arg_max(value, (ts, event_id)) AS value FROM events
WHERE event_type <> 'error' AND value IS NOT NULL GROUP BY user_id""",
    "q_stream_orphans": """WITH payments AS (
  SELECT event_id AS payment_id, ts + to_minutes(event_id % 300) AS made_at FROM events WHERE event_id % 4 <> 0)
SELECT r.event_id AS payment_id, r.user_id FROM events r
WHERE r.event_id % 3 = 0 AND NOT EXISTS (SELECT 1 FROM payments p WHERE p.payment_id = r.event_id
  AND p.made_at BETWEEN r.ts - INTERVAL 30 DAY AND r.ts + INTERVAL 2 HOUR)""",
}
