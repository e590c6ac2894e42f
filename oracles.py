"""DuckDB statements that compute what the registered queries compute.

They are built from shared CTEs: the transactions and customers derived from
the benchmark tables, then each rule in its plainest sequential form.
"""

from __future__ import annotations

# Provinces and coordinates, in the same order as the demo source.
_NAMES = (
    "['Ha Noi','Ho Chi Minh','Da Nang','Hai Phong','Can Tho','Bien Hoa','Hue','Nha Trang',"
    "'Vung Tau','Quy Nhon','Buon Ma Thuot','Thai Nguyen','Nam Dinh']"
)
_LATS = (
    "([21.0278,10.8231,16.0544,20.8449,10.0452,10.9574,16.4637,12.2388,"
    "10.3460,13.7830,12.6667,21.5928,20.4389]::DOUBLE[])"
)
_LONS = (
    "([105.8342,106.6297,108.2022,106.6881,105.7469,106.8426,107.5909,109.1967,"
    "107.0843,109.2196,108.0500,105.8442,106.1621]::DOUBLE[])"
)
# Public holidays and their names.
_HOLIDAYS = """(VALUES
  (DATE '2025-01-01', 'Tết Dương lịch'), (DATE '2025-01-28', 'Tết Nguyên Đán (nghỉ bù)'),
  (DATE '2025-01-29', 'Tết Nguyên Đán'), (DATE '2025-01-30', 'Tết Nguyên Đán'),
  (DATE '2025-01-31', 'Tết Nguyên Đán'), (DATE '2025-02-01', 'Tết Nguyên Đán'),
  (DATE '2025-02-02', 'Tết Nguyên Đán'), (DATE '2025-02-03', 'Tết Nguyên Đán'),
  (DATE '2025-04-07', 'Giỗ Tổ Hùng Vương'), (DATE '2025-04-30', 'Ngày Giải phóng miền Nam'),
  (DATE '2025-05-01', 'Ngày Quốc tế Lao động'), (DATE '2025-09-02', 'Ngày Quốc khánh')
) h(full_date, holiday_name)"""


def _pad(prefix: str, number: str, width: int) -> str:
    text = f"({number})::VARCHAR"
    return f"'{prefix}' || lpad({text}, greatest({width}, length({text}))::INTEGER, '0')"


def _alert_id(prefix: str, rule: str) -> str:
    return f"'{prefix}' || upper(md5(transaction_id || '|{rule}'))"


def _km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    dlat, dlon = f"radians({lat2} - {lat1}) / 2", f"radians({lon2} - {lon1}) / 2"
    a = f"(sin({dlat}) * sin({dlat}) + cos(radians({lat1})) * cos(radians({lat2})) * sin({dlon}) * sin({dlon}))"
    return f"(2 * 6371.0 * atan2(sqrt({a}), sqrt(greatest(0.0, 1.0 - {a}))))"


_SEVERITY = """CASE rule_triggered WHEN 'velocity' THEN 'MEDIUM' WHEN 'geo_anomaly' THEN 'HIGH'
  WHEN 'off_hours_large' THEN 'HIGH' WHEN 'duplicate' THEN 'LOW' END"""
_ALERT = f"""CASE rule_triggered WHEN 'velocity' THEN {_alert_id('ALT-V-', 'velocity')}
  WHEN 'geo_anomaly' THEN {_alert_id('ALT-G-', 'geo_anomaly')}
  WHEN 'off_hours_large' THEN {_alert_id('ALT-R3-', 'off_hours_large')}
  WHEN 'duplicate' THEN {_alert_id('ALT-D-', 'duplicate')} END"""

TXN = f"""
burst AS (
  SELECT event_id, user_id, value, ts, unnest(range(0, 1 + event_id % 5)) AS i FROM events
),
timed AS (
  SELECT *, event_id * 5 + i AS n,
    date_trunc('second', ts) + to_seconds(i * (7 + event_id % 23)) AS event_ts,
    CASE WHEN event_id % 7 = 0 THEN (user_id + i) % 13 ELSE user_id % 13 END AS place
  FROM burst
),
txn AS (
  SELECT {_pad('TXN', 'n', 10)} AS transaction_id,
    strftime(event_ts, '%Y-%m-%dT%H:%M:%S') AS "timestamp",
    {_pad('****', 'user_id', 4)} AS account_masked,
    {_pad('CUS', 'user_id + 1', 6)} AS customer_id,
    ['ATM','POS','mobile','internet'][event_id % 4 + 1] AS channel,
    {_pad('MER', 'event_id % 500 + 1', 5)} AS merchant_id,
    {_NAMES}[place + 1] AS merchant_province,
    {_LATS}[place + 1] AS merchant_lat,
    {_LONS}[place + 1] AS merchant_lon,
    (floor(value * CASE WHEN event_id % 3 = 0 THEN 1 ELSE 1 + i END) * 1000000)::BIGINT AS amount,
    'VND' AS currency, 'SUCCESS' AS status,
    (event_id % 29 = 0)::SMALLINT AS fraud_label,
    CASE WHEN event_id % 29 = 0
      THEN ['velocity','geo_anomaly','off_hours_large','duplicate'][(event_id // 29) % 4 + 1] END AS fraud_type,
    event_ts, event_ts + to_milliseconds(500 + n * 37 % 4500) AS loaded_at,
    n, epoch_ms(event_ts) AS t
  FROM timed
)"""

CUSTOMERS = f"""
raw_customer AS (
  SELECT {_pad('CUS', 'c_custkey + 1', 6)} AS customer_id,
    {_pad('VCB', 'c_custkey + 1000000000', 10)} AS account_number,
    {_pad('0', 'c_custkey * 7 + 900000000', 9)} AS phone,
    {_pad('', 'c_custkey * 11 + 12345678901', 12)} AS national_id,
    ['VIP','Premium','Standard','New','Watch'][c_custkey % 5 + 1] AS segment,
    (c_custkey % 90 + 10)::INTEGER AS risk_score,
    {_NAMES}[c_custkey % 13 + 1] AS home_province,
    ({_LATS}[c_custkey % 13 + 1])::DECIMAL(9,6) AS home_lat,
    ({_LONS}[c_custkey % 13 + 1])::DECIMAL(9,6) AS home_lon
  FROM customer
),
dim_customer AS (
  SELECT customer_id, '****' || right(account_number, 4) AS account_masked, segment, risk_score,
    home_province, home_lat, home_lon FROM raw_customer
)"""

_NIGHT = "(try_cast(substr(\"timestamp\", 12, 2) AS INTEGER) >= 22 OR try_cast(substr(\"timestamp\", 12, 2) AS INTEGER) < 6)"
_OFF = f"(amount > 50000000 AND {_NIGHT})"


def velocity(source: str, out: str) -> str:
    return f"""{out} AS (
  SELECT *, coalesce(t - lag(t, 2) OVER (PARTITION BY account_masked ORDER BY t, transaction_id) <= 60000, false)
    AS velocity FROM {source}
)"""


def geo(source: str, out: str) -> str:
    w = "OVER (PARTITION BY account_masked ORDER BY t, transaction_id)"
    km = _km("plat", "plon", "merchant_lat", "merchant_lon")
    return f"""{out}_prev AS (
  SELECT *, lag(t) {w} AS pt, lag(merchant_lat) {w} AS plat, lag(merchant_lon) {w} AS plon FROM {source}
),
{out} AS (
  SELECT * EXCLUDE (pt, plat, plon),
    CASE WHEN t > pt AND t - pt <= 1800000 AND {km} > 300 THEN {km} END AS km
  FROM {out}_prev
)"""


def duplicate(source: str, out: str) -> str:
    """Follow the anchors one by one from the first row of each combination."""
    key = "account_masked, amount, merchant_id"
    return f"""{out}_num AS (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY t, transaction_id) AS rn,
    min(t) OVER (PARTITION BY {key} ORDER BY t RANGE BETWEEN 30001 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_t
  FROM {source}
),
{out}_first AS (
  SELECT {key}, t, min(rn) AS rn, any_value(next_t) AS next_t FROM {out}_num GROUP BY {key}, t
),
{out}_anchor AS (
  SELECT {key}, t, rn, next_t FROM {out}_first WHERE rn = 1
  UNION ALL
  SELECT f.account_masked, f.amount, f.merchant_id, f.t, f.rn, f.next_t
  FROM {out}_anchor a JOIN {out}_first f
    ON f.account_masked = a.account_masked AND f.amount = a.amount AND f.merchant_id = a.merchant_id AND f.t = a.next_t
),
{out} AS (
  SELECT s.* EXCLUDE (rn, next_t), a.rn IS NULL AS duplicate
  FROM {out}_num s LEFT JOIN {out}_anchor a
    ON s.account_masked = a.account_masked AND s.amount = a.amount AND s.merchant_id = a.merchant_id AND s.rn = a.rn
)"""


def _with(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


_STAMP = f"""scored AS (
  SELECT *, {_SEVERITY} AS severity, {_ALERT} AS alert_id, rule_triggered IS NOT NULL AS fraud_flag FROM judged
)"""

CASCADE = ",\n".join(
    [
        velocity("txn", "v"),
        "after_v AS (SELECT * FROM v WHERE NOT velocity)",
        duplicate("after_v", "dup"),
        f"""judged AS (
  SELECT txn.*, NULL::DOUBLE AS km, CASE WHEN v.velocity THEN 'velocity' WHEN dup.duplicate THEN 'duplicate'
    WHEN txn.amount > 50000000 AND {_NIGHT.replace('"timestamp"', 'txn."timestamp"')} THEN 'off_hours_large' END AS rule_triggered
  FROM txn JOIN v USING (transaction_id) LEFT JOIN dup USING (transaction_id)
)""",
        _STAMP,
    ]
)
CASCADE_GEO = ",\n".join(
    [
        velocity("txn", "v"),
        "after_v AS (SELECT * FROM v WHERE NOT velocity)",
        geo("after_v", "g"),
        "after_g AS (SELECT * FROM g WHERE km IS NULL)",
        duplicate("after_g", "dup"),
        f"""judged AS (
  SELECT txn.*, g.km AS km, CASE WHEN v.velocity THEN 'velocity' WHEN g.km IS NOT NULL THEN 'geo_anomaly'
    WHEN dup.duplicate THEN 'duplicate'
    WHEN txn.amount > 50000000 AND {_NIGHT.replace('"timestamp"', 'txn."timestamp"')} THEN 'off_hours_large' END AS rule_triggered
  FROM txn JOIN v USING (transaction_id) LEFT JOIN g USING (transaction_id) LEFT JOIN dup USING (transaction_id)
)""",
        _STAMP,
    ]
)
_TIME_ID = "(hour(event_ts) * 100 + minute(event_ts))::INTEGER"
_DATE_ID = "(year(event_ts) * 10000 + month(event_ts) * 100 + day(event_ts))::INTEGER"
FACTS = f"""facts AS (
  SELECT transaction_id, account_masked, customer_id, channel, merchant_id, merchant_province, amount, currency,
    status, fraud_flag, alert_id, {_TIME_ID} AS time_id, {_DATE_ID} AS date_id, event_ts, loaded_at FROM scored
),
alerts AS (
  SELECT alert_id, transaction_id, rule_triggered, severity, event_ts AS detected_at,
    NULL::TIMESTAMP AS resolved_at, loaded_at AS created_at FROM scored WHERE fraud_flag
)"""
DIM_TIME = """dim_time AS (
  SELECT (h * 100 + m)::INTEGER AS time_id, h::INTEGER AS hour, m::INTEGER AS minute,
    h IN (8,9,10,11,13,14,15,16) AS is_peak_hour, h >= 8 AND h < 17 AS is_business_hour,
    CASE WHEN h >= 6 AND h < 12 THEN 'morning' WHEN h >= 12 AND h < 18 THEN 'afternoon'
      WHEN h >= 18 AND h < 22 THEN 'evening' ELSE 'night' END AS period_label
  FROM range(24) a(h), range(60) b(m)
)"""
_CALENDAR_COLUMNS = """(year(full_date) * 10000 + month(full_date) * 100 + day(full_date))::INTEGER AS date_id,
    full_date, (isodow(full_date) - 1)::INTEGER AS day_of_week, isodow(full_date) >= 6 AS is_weekend,
    holiday_name IS NOT NULL AS is_holiday, holiday_name, isodow(full_date) = 7 AS is_maintenance"""
DIM_CALENDAR = f"""days AS (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2026-12-31', INTERVAL 1 DAY))::DATE AS full_date),
dim_calendar AS (SELECT {_CALENDAR_COLUMNS} FROM days LEFT JOIN {_HOLIDAYS} USING (full_date))"""

_BASE = _with(TXN)
_SCORED = _with(TXN, CASCADE)
_HOUSE = _with(TXN, CASCADE, FACTS)
_HOUSE_DIMS = _with(TXN, CUSTOMERS, CASCADE, FACTS, DIM_TIME, DIM_CALENDAR)
_SCORED_GEO = _with(TXN, CASCADE_GEO)
_VERDICT = "transaction_id, rule_triggered, severity, alert_id, fraud_flag"


def _alerts_of(rule: str, prefix: str, severity: str, source: str, where: str, extra: str = "") -> str:
    return f"""SELECT {_alert_id(prefix, rule)} AS alert_id, transaction_id, '{rule}' AS rule_triggered,
  '{severity}' AS severity, account_masked, event_ts AS detected_at{extra} FROM {source} WHERE {where}"""


def _pct(cond: str) -> str:
    return f"round(100.0::DOUBLE * (count(*) FILTER (WHERE {cond}))::DOUBLE / nullif(count(*), 0)::DOUBLE, 2)"


_SPLIT = f"count(*) AS total, count(*) FILTER (WHERE fraud_flag) AS fraud, {_pct('fraud_flag')} AS fraud_pct"
_CONTEXT = f"""hour(event_ts) IN (8,9,10,11,13,14,15,16) AS is_peak_hour,
  isodow(event_ts) <= 5 AND hour(event_ts) BETWEEN 8 AND 17 AS is_business_hour,
  event_ts::DATE IN (SELECT full_date FROM {_HOLIDAYS}) AS is_holiday,
  isodow(event_ts) = 7 AND hour(event_ts) BETWEEN 1 AND 3 AS is_maintenance,
  {_OFF} AS is_night_large_risk"""
_MESSAGE = """transaction_id, "timestamp", account_masked, customer_id, channel, merchant_id, merchant_province,
  merchant_lat, merchant_lon, amount, currency, status, fraud_label, fraud_type"""
_CHECKED = """checked AS (
  SELECT *, CASE WHEN n % 50 = 12 THEN 'amount,currency,status' WHEN n % 50 = 17 THEN 'timestamp'
    WHEN n % 50 = 22 THEN 'amount'
    WHEN n % 50 = 37 THEN 'json,transaction_id,timestamp,account_masked,channel,amount,currency,status'
    ELSE '' END AS reasons FROM txn
)"""
# The messages that pass validation, in place of all transactions.
_GOOD = TXN.replace("txn AS (", "every AS (") + """,
txn AS (SELECT * FROM every WHERE n % 50 NOT IN (12, 17, 22, 37))"""
_ENRICH = """SELECT transaction_id, t.customer_id, t.account_masked, segment, risk_score, home_province, home_lat::DOUBLE AS home_lat,
  home_lon::DOUBLE AS home_lon FROM txn t LEFT JOIN dim_customer c ON c.customer_id = t.customer_id"""
_LATENCY = "(epoch_us(created_at) - epoch_us(detected_at))"


def _per_minute(where: str) -> str:
    return f"SELECT date_trunc('minute', loaded_at)::TIMESTAMP AS time, count(*) AS value FROM facts WHERE {where} GROUP BY 1"


def _eod(day: str) -> str:
    return f"""SELECT count(*) AS total_txns, coalesce(sum(amount), 0)::BIGINT AS total_amount_vnd,
  sum(CASE WHEN fraud_flag THEN 1 ELSE 0 END)::BIGINT AS fraud_count, count(DISTINCT channel) AS channels_active,
  count(DISTINCT customer_id) AS unique_customers,
  (SELECT count(*) FROM alerts WHERE detected_at::DATE = DATE '{day}') AS alert_count
FROM facts WHERE loaded_at::DATE = DATE '{day}'"""


# Rules of a document: other thresholds, night hours, holidays and three windows.
_DOCUMENT = [("<= 60000", "<= 90000"), ("50000000", "20000000"), (">= 22", ">= 21"), ("< 6", "< 5")]


def _documented(text: str) -> str:
    for old, new in _DOCUMENT:
        text = text.replace(old, new)
    return text


# Accounts that deliver their messages when all others have, and the watermark by then.
_LATE = """recent AS (
  SELECT DISTINCT account_masked FROM every WHERE event_ts >= (SELECT max(event_ts) FROM every) - INTERVAL 2 HOURS
),
picked AS (
  SELECT DISTINCT account_masked FROM every
  WHERE right(account_masked, 1) = '3' AND account_masked NOT IN (SELECT account_masked FROM recent)
),
mark AS (
  SELECT max(t) - 3600000 AS w FROM txn WHERE account_masked NOT IN (SELECT account_masked FROM picked)
)"""
_HOUR_AGO = "(SELECT max(loaded_at) FROM facts) - INTERVAL 1 HOUR"
_SHARE = "count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 1) AS pct"

ORACLES = {
    "velocity_alerts": _with(TXN, velocity("txn", "v")) + _alerts_of("velocity", "ALT-V-", "MEDIUM", "v", "velocity"),
    "geo_anomaly_alerts": _with(TXN, geo("txn", "g"))
    + _alerts_of("geo_anomaly", "ALT-G-", "HIGH", "g", "km IS NOT NULL", ", printf('%.1f', km) AS dist_km"),
    "duplicate_alerts": _with(TXN, duplicate("txn", "d"))
    + _alerts_of("duplicate", "ALT-D-", "LOW", "d", "duplicate"),
    "off_hours_alerts": _BASE + _alerts_of("off_hours_large", "ALT-R3-", "HIGH", "txn", _OFF),
    "cascade_verdicts": _SCORED + f"SELECT {_VERDICT} FROM scored",
    "cascade_with_geo": _SCORED_GEO
    + f"SELECT {_VERDICT}, CASE WHEN km IS NOT NULL THEN printf('%.1f', km) END AS dist_km FROM scored",
    "cascade_duplicate_first": _with(
        TXN,
        duplicate("txn", "dup"),
        velocity("(SELECT * FROM dup WHERE NOT duplicate)", "v"),
        """judged AS (SELECT dup.*, CASE WHEN dup.duplicate THEN 'duplicate' WHEN v.velocity THEN 'velocity' END
  AS rule_triggered FROM dup LEFT JOIN v USING (transaction_id))""",
        _STAMP,
    )
    + f"SELECT {_VERDICT} FROM scored",
    "fact_txn": _HOUSE + "SELECT * FROM facts",
    "fact_txn_off_hours_unmarked": _SCORED
    + """SELECT transaction_id, fraud_flag AND rule_triggered <> 'off_hours_large' AS fraud_flag,
  CASE WHEN rule_triggered <> 'off_hours_large' THEN alert_id END AS alert_id FROM scored""",
    "fact_alert": _HOUSE + "SELECT * FROM alerts",
    "customer_enrichment": _with(TXN, CUSTOMERS) + _ENRICH,
    "customer_enrichment_hot_keys": _with(TXN, CUSTOMERS) + _ENRICH,
    "alert_messages": _SCORED
    + "SELECT transaction_id, rule_triggered, alert_id, amount::VARCHAR AS amount FROM scored WHERE fraud_flag",
    "alert_reconciliation": _HOUSE
    + """SELECT t.transaction_id, t.fraud_flag, t.alert_id AS txn_alert_id, a.alert_id AS alert_table_id,
  a.rule_triggered, a.severity, a.detected_at FROM facts t JOIN alerts a ON t.alert_id = a.alert_id""",
    "recent_velocity_reconciliation": _HOUSE
    + """SELECT t.transaction_id, t.fraud_flag, t.alert_id AS txn_alert_id, a.alert_id AS alert_table_id,
  a.rule_triggered, a.severity, a.detected_at FROM facts t JOIN alerts a ON t.alert_id = a.alert_id
WHERE a.rule_triggered = 'velocity' ORDER BY a.detected_at DESC, t.transaction_id LIMIT 5""",
    "dim_time_activity": _HOUSE_DIMS
    + """SELECT d.*, (SELECT count(*) FROM facts f WHERE f.time_id = d.time_id) AS txns FROM dim_time d""",
    "dim_calendar_activity": _HOUSE_DIMS
    + """SELECT d.* REPLACE (full_date::VARCHAR AS full_date),
  (SELECT count(*) FROM facts f WHERE f.date_id = d.date_id) AS txns FROM dim_calendar d""",
    "calendar_from_data": _BASE
    + f"""SELECT * REPLACE (full_date::VARCHAR AS full_date) FROM (
  SELECT {_CALENDAR_COLUMNS} FROM (SELECT DISTINCT event_ts::DATE AS full_date FROM txn)
  LEFT JOIN {_HOLIDAYS} USING (full_date))""",
    "dim_customer_upsert": _with(CUSTOMERS)
    + f""", second AS (
  SELECT * REPLACE ({_pad('CUS', "substr(customer_id, 4)::BIGINT + 500", 6)} AS customer_id, risk_score + 1 AS risk_score)
  FROM dim_customer
)
SELECT * REPLACE (home_lat::DOUBLE AS home_lat, home_lon::DOUBLE AS home_lon) FROM
(SELECT * FROM second UNION ALL SELECT * FROM dim_customer WHERE customer_id NOT IN (SELECT customer_id FROM second))""".lstrip(),
    "context_tags": _BASE + f"SELECT transaction_id, {_CONTEXT} FROM txn",
    "maintenance_hold": _BASE
    + f"""SELECT CASE WHEN is_maintenance THEN 'held' ELSE 'now' END AS part, count(*) AS n
FROM (SELECT {_CONTEXT} FROM txn) GROUP BY 1""",
    "time_keys": _BASE
    + f"""SELECT transaction_id, {_TIME_ID} AS time_id, {_DATE_ID} AS date_id,
  CASE WHEN hour(event_ts) BETWEEN 6 AND 11 THEN 'morning' WHEN hour(event_ts) BETWEEN 12 AND 17 THEN 'afternoon'
    WHEN hour(event_ts) BETWEEN 18 AND 21 THEN 'evening' ELSE 'night' END AS period_label,
  (isodow(event_ts) - 1)::INTEGER AS day_of_week,
  greatest(10000, (round_even(amount / 7.0::DOUBLE / 1000.0::DOUBLE, 0) * 1000)::BIGINT) AS amount_clamped FROM txn""",
    "mask_pii": _with(CUSTOMERS)
    + """SELECT customer_id, '****' || right(account_number, 4) AS account_masked,
  left(phone, 3) || '****' || right(phone, 3) AS phone_masked,
  left(national_id, 3) || '******' || right(national_id, 3) AS national_id_masked, segment FROM raw_customer""",
    "token_accounts": _with(CUSTOMERS)
    + "SELECT customer_id, '****' || sha256(account_number) AS account_token FROM raw_customer",
    "home_distance": _with(TXN, CUSTOMERS)
    + f"""SELECT transaction_id, round({_km('home_lat::DOUBLE', 'home_lon::DOUBLE', 'merchant_lat', 'merchant_lon')}, 3) AS home_km
FROM txn LEFT JOIN dim_customer USING (customer_id)""",
    "normalise_channels": _BASE + f"SELECT {_MESSAGE} FROM txn",
    "channel_files": _BASE + f"SELECT {_MESSAGE} FROM txn",
    "type_rows": _BASE
    + """SELECT transaction_id, CASE WHEN n % 40 <> 39 THEN event_ts END AS ts, account_masked, customer_id, channel,
  merchant_id, merchant_province, CASE WHEN n % 40 <> 13 THEN merchant_lat END AS merchant_lat,
  CASE WHEN n % 40 <> 33 THEN merchant_lon END AS merchant_lon, CASE WHEN n % 40 <> 3 THEN amount END::VARCHAR AS amount,
  currency, status, fraud_label, CASE WHEN n % 40 <> 23 THEN fraud_type END AS fraud_type,
  CASE n % 40 WHEN 39 THEN 'timestamp' WHEN 33 THEN 'merchant_lon' WHEN 3 THEN 'amount' ELSE '' END AS errors FROM txn""",
    "staging_load": _BASE
    + """SELECT CASE WHEN n % 40 IN (3, 33, 39) THEN 'rejects' ELSE 'staging' END AS table_name, count(*) AS n,
  sum(CASE WHEN n % 40 <> 3 THEN amount END)::BIGINT AS amount FROM txn GROUP BY 1""",
    "validate_records": _with(TXN, _CHECKED)
    + """SELECT CASE WHEN n % 50 <> 37 THEN transaction_id END AS transaction_id,
  CASE WHEN n % 50 NOT IN (12, 22, 37) THEN amount END::VARCHAR AS amount,
  CASE WHEN n % 50 NOT IN (17, 37) THEN event_ts END AS event_ts, reasons AS error_reasons FROM checked""",
    "dead_letters": _with(TXN, _CHECKED)
    + "SELECT reasons AS error_reasons, count(*) AS n FROM checked WHERE reasons <> '' GROUP BY 1",
    "dead_letter_replay": _with(TXN, _CHECKED)
    + "SELECT count(*) AS replayed, count(*) AS rejected FROM checked WHERE reasons <> ''",
    "dedupe_redelivered": _BASE + "SELECT transaction_id, event_ts, amount FROM txn",
    "error_rate": _with(TXN, _CHECKED)
    + """SELECT count(*) AS total, count(*) FILTER (WHERE reasons <> '') AS dead_letters,
  round(100.0::DOUBLE * (count(*) FILTER (WHERE reasons <> ''))::DOUBLE / nullif(count(*), 0)::DOUBLE, 4) AS error_pct FROM checked""",
    "dq_report": _BASE
    + """SELECT bool_and('VCB' || customer_id LIKE 'VCB%') AS account_prefix_ok,
  bool_and(account_masked LIKE '****%') AS masking_ok, bool_and(transaction_id IS NOT NULL) AS transaction_id_ok,
  bool_and(amount > 0) AS amount_ok, avg(fraud_label) BETWEEN 0.01 AND 0.05 AS fraud_rate_ok FROM txn""",
    "audit_trail": _with(TXN, CUSTOMERS, CASCADE)
    + """, steps AS (
  SELECT transaction_id, loaded_at, unnest([
    {'p': 'consume', 'e': 'RECEIVE'}, {'p': 'validate', 'e': 'ROUTE'}, {'p': 'normalise', 'e': 'CONTENT_MODIFIED'},
    {'p': 'lookup_customer', 'e': CASE WHEN c.segment IS NOT NULL THEN 'MATCHED' ELSE 'UNMATCHED' END},
    {'p': 'score_rules', 'e': coalesce(rule_triggered, 'PASS')}, {'p': 'load_fact_txn', 'e': 'SEND'}] ||
    CASE WHEN fraud_flag THEN [{'p': 'publish_alert', 'e': 'SEND'}, {'p': 'load_fact_alert', 'e': 'SEND'}] ELSE [] END) AS s
  FROM scored LEFT JOIN dim_customer c USING (customer_id)
)
SELECT md5(transaction_id || '|' || s.p) AS flowfile_uuid, s.p AS processor_name, s.e AS event_type,
  transaction_id AS txn_id, loaded_at AS logged_at FROM steps""".lstrip(),
    "batch_load": _with(_GOOD, CASCADE, FACTS)
    + """SELECT 'fact_txn' AS table_name, (SELECT count(*) FROM facts) AS n
UNION ALL SELECT 'fact_alert', (SELECT count(*) FROM alerts)
UNION ALL SELECT 'dead_letter', (SELECT count(*) FROM every WHERE n % 50 IN (12, 17, 22, 37))
UNION ALL SELECT 'dim_customer', (SELECT count(*) FROM customer)
UNION ALL SELECT 'audit_log', 6 * (SELECT count(*) FROM facts) + 2 * (SELECT count(*) FROM alerts)""",
    "maintenance_release": _with(_GOOD, CASCADE)
    + f"""SELECT transaction_id, rule_triggered, NOT is_maintenance AS loaded_first
FROM (SELECT transaction_id, rule_triggered, {_CONTEXT} FROM scored)""",
    "batch_in_parts": _with(_GOOD, CASCADE) + "SELECT transaction_id, rule_triggered FROM scored",
    "stream_late_rows": _with(_GOOD, CASCADE) + "SELECT transaction_id, rule_triggered FROM scored",
    "eod_report": _HOUSE + _eod("2024-01-15"),
    "eod_report_empty_day": _HOUSE
    + f"SELECT * REPLACE (fraud_count::DOUBLE AS fraud_count) FROM ({_eod('2031-01-01')})",
    "total_transactions": _BASE + "SELECT count(*) AS value FROM txn",
    "total_alerts": _HOUSE + "SELECT count(*) AS value FROM alerts",
    "fraud_rate": _HOUSE + f"SELECT {_pct('fraud_flag')} AS value FROM facts",
    "alert_latency": _HOUSE
    + f"""SELECT round(avg({_LATENCY}) / 1e6, 2) AS value FROM alerts
WHERE detected_at > (SELECT max(detected_at) FROM alerts) - INTERVAL 1 HOUR""",
    "clean_count": _HOUSE + "SELECT count(*) AS value FROM facts WHERE fraud_flag = false",
    "masking_violations": _HOUSE + "SELECT count(*) AS value FROM facts WHERE account_masked NOT LIKE '****%'",
    "volume_per_minute": _HOUSE + _per_minute("true"),
    "volume_last_hour": _HOUSE + _per_minute(f"loaded_at > {_HOUR_AGO}"),
    "fraud_per_minute": _HOUSE + _per_minute("fraud_flag"),
    "fraud_last_hour": _HOUSE + _per_minute(f"fraud_flag AND loaded_at > {_HOUR_AGO}"),
    "alerts_by_rule": _HOUSE + "SELECT rule_triggered AS metric, count(*) AS value FROM alerts GROUP BY 1",
    "alerts_by_rule_severity": _HOUSE
    + "SELECT rule_triggered, severity, count(*) AS alert_count FROM alerts GROUP BY 1, 2",
    "volume_by_channel": _HOUSE + f"SELECT channel, {_SPLIT} FROM facts GROUP BY channel",
    "top_fraud_merchants": _HOUSE
    + """SELECT merchant_id, merchant_province, count(*) AS fraud_count FROM facts WHERE fraud_flag GROUP BY 1, 2
ORDER BY 3 DESC, 1, 2 LIMIT 10""",
    "recent_alerts": _HOUSE
    + """SELECT alert_id, transaction_id, rule_triggered, severity, detected_at FROM alerts
ORDER BY detected_at DESC, alert_id LIMIT 20""",
    "recent_duplicate_alerts": _HOUSE
    + """SELECT alert_id, transaction_id, rule_triggered, severity, detected_at FROM alerts
WHERE rule_triggered = 'duplicate' ORDER BY detected_at DESC, alert_id LIMIT 5""",
    "recent_by_prefix": _HOUSE
    + """SELECT transaction_id, account_masked, amount, merchant_id, merchant_province, fraud_flag, alert_id, loaded_at
FROM facts WHERE transaction_id LIKE 'TXN%' OR transaction_id LIKE 'V2%' ORDER BY loaded_at DESC, transaction_id LIMIT 10""",
    "rows_by_id_pattern": _HOUSE
    + "SELECT transaction_id, fraud_flag, alert_id FROM facts WHERE transaction_id LIKE 'TXN%005'",
    "holiday_fraud_rate": _HOUSE_DIMS
    + f"SELECT is_holiday, is_weekend, {_SPLIT} FROM facts JOIN dim_calendar USING (date_id) GROUP BY 1, 2",
    "period_fraud_rate": _HOUSE_DIMS
    + f"""SELECT period_label, is_peak_hour, is_business_hour, {_SPLIT} FROM facts JOIN dim_time USING (time_id)
GROUP BY 1, 2, 3""",
    "segment_fraud_rate": _HOUSE_DIMS
    + f"SELECT segment, {_SPLIT} FROM facts f LEFT JOIN dim_customer c USING (customer_id) GROUP BY 1",
    "dataset_summary": _BASE
    + f"""SELECT count(*) AS total_transactions, sum(fraud_label)::BIGINT AS fraud_transactions,
  round(avg(fraud_label) * 100, 2) AS fraud_pct, min("timestamp") AS first_timestamp, max("timestamp") AS last_timestamp,
  round(avg(amount) FILTER (WHERE fraud_label = 0), 0) AS mean_amount_normal,
  round(avg(amount) FILTER (WHERE fraud_label = 1), 0) AS mean_amount_fraud,
  count(*) FILTER (WHERE is_peak_hour) AS peak_hour_txns, round(avg(is_peak_hour::INTEGER) * 100, 1) AS peak_hour_pct,
  count(*) FILTER (WHERE is_business_hour) AS business_hour_txns,
  round(avg(is_business_hour::INTEGER) * 100, 1) AS business_hour_pct FROM (SELECT *, {_CONTEXT} FROM txn)""",
    "channel_share": _BASE + f"SELECT channel, {_SHARE} FROM txn GROUP BY channel",
    "fraud_type_share": _BASE + f"SELECT fraud_type, {_SHARE} FROM txn WHERE fraud_label = 1 GROUP BY fraud_type",
    "hour_label_matrix": _BASE
    + """SELECT hour(event_ts)::INTEGER AS hour, count(*) FILTER (WHERE fraud_label = 0) AS normal,
  count(*) FILTER (WHERE fraud_label = 1) AS fraud FROM txn GROUP BY 1""",
    "amount_histogram": _BASE
    + """, span AS (SELECT fraud_label, min(amount)::DOUBLE AS lo, max(amount)::DOUBLE AS hi FROM txn GROUP BY 1),
binned AS (
  SELECT fraud_label, lo, (hi - lo) / 50 AS width,
    least(floor((amount::DOUBLE - lo) / ((hi - lo) / 50)), 49)::INTEGER AS bin FROM txn JOIN span USING (fraud_label)
)
SELECT fraud_label, bin, lo + bin * width AS bin_start, count(*) AS n FROM binned GROUP BY 1, 2, 3""".lstrip(),
    "fraud_samples": _BASE
    + """SELECT "timestamp", transaction_id, account_masked, amount, merchant_province FROM txn
WHERE fraud_label = 1 AND fraud_type = 'velocity' AND account_masked = (SELECT account_masked FROM txn
  WHERE fraud_label = 1 AND fraud_type = 'velocity' ORDER BY "timestamp", transaction_id LIMIT 1)
ORDER BY "timestamp", transaction_id LIMIT 5""",
    "sorted_dataset": _BASE + 'SELECT "timestamp", transaction_id, fraud_label FROM txn ORDER BY 1, 2',
    "table_counts": _HOUSE_DIMS
    + """SELECT 'dim_customer' AS table_name, (SELECT count(*) FROM dim_customer) AS n
UNION ALL SELECT 'dim_calendar', (SELECT count(*) FROM dim_calendar)
UNION ALL SELECT 'dim_time', (SELECT count(*) FROM dim_time)
UNION ALL SELECT 'fact_txn', (SELECT count(*) FROM facts)
UNION ALL SELECT 'fact_alert', (SELECT count(*) FROM alerts)""",
    "latency_percentiles": _HOUSE
    + f"""SELECT round(quantile_disc({_LATENCY}, 0.5) / 1e6, 3) AS p50_s,
  round(quantile_disc({_LATENCY}, 0.95) / 1e6, 3) AS p95_s FROM alerts""",
    "load_completeness": _HOUSE
    + """SELECT count(*) AS arrived, round((epoch_us(max(loaded_at)) - epoch_us(min(loaded_at))) / 1e6, 3) AS elapsed_s,
  round(count(*) / ((epoch_us(max(loaded_at)) - epoch_us(min(loaded_at))) / 1e6), 4) AS rows_per_s,
  count(*) >= 1 AS complete FROM facts WHERE transaction_id LIKE 'TXN%'""",
    "kpi_status": _with(TXN, _CHECKED, CASCADE, FACTS)
    + f""", kpi AS (
  SELECT 'fraud_rate' AS kpi, (SELECT {_pct('fraud_flag')} FROM facts) AS value
  UNION ALL SELECT 'masking_violations', (SELECT count(*) FROM facts WHERE account_masked NOT LIKE '****%')::DOUBLE
  UNION ALL SELECT 'alerts', (SELECT count(*) FROM alerts)::DOUBLE
  UNION ALL SELECT 'alert_latency', (SELECT round(avg({_LATENCY}) / 1e6, 2) FROM alerts
    WHERE detected_at > (SELECT max(detected_at) FROM alerts) - INTERVAL 1 HOUR)
  UNION ALL SELECT 'error_rate', (SELECT round(100.0::DOUBLE * (count(*) FILTER (WHERE reasons <> ''))::DOUBLE / count(*)::DOUBLE, 4) FROM checked)
)
SELECT kpi, value, CASE
  WHEN kpi IN ('alerts', 'masking_violations', 'error_rate') AND value >= 1 THEN 'red'
  WHEN kpi IN ('fraud_rate', 'alert_latency') AND value >= 5 THEN 'red'
  WHEN kpi = 'fraud_rate' AND value >= 1 THEN 'orange' WHEN kpi = 'alert_latency' AND value >= 3 THEN 'orange'
  ELSE 'green' END AS status FROM kpi""".lstrip(),
    "raw_archive": _BASE
    + "SELECT event_ts::DATE::VARCHAR AS event_date, channel, count(*) AS n, sum(amount)::BIGINT AS amount FROM txn GROUP BY 1, 2",
    "idempotent_sink": _HOUSE
    + """SELECT 'fact_txn' AS table_name, (SELECT count(*) FROM facts) AS n
UNION ALL SELECT 'fact_alert', (SELECT count(*) FROM alerts)""",
    "stream_cascade": _with(_GOOD, CASCADE)
    + "SELECT transaction_id, fraud_flag, alert_id, rule_triggered, severity FROM scored",
    "stream_cascade_with_geo": _with(_GOOD, CASCADE_GEO)
    + "SELECT transaction_id, rule_triggered, alert_id FROM scored WHERE fraud_flag",
    "stream_volume_per_minute": _with(_GOOD)
    + """SELECT date_trunc('minute', event_ts)::TIMESTAMP AS time, count(*) AS value FROM txn GROUP BY 1
HAVING time + INTERVAL 1 MINUTE <= (SELECT max(event_ts) FROM txn) - INTERVAL 1 HOUR""",
    "stream_volume_every_minute": _with(_GOOD)
    + "SELECT date_trunc('minute', event_ts)::TIMESTAMP AS time, count(*) AS value FROM txn GROUP BY 1",
    "stream_totals_by_channel": _with(_GOOD)
    + f"""SELECT channel, count(*) AS total, count(*) FILTER (WHERE fraud_label = 1) AS fraud,
  {_pct('fraud_label = 1')} AS fraud_pct FROM txn GROUP BY channel""",
    "stream_keyed_cascade": _with(_GOOD, CASCADE_GEO) + "SELECT transaction_id, rule_triggered FROM scored",
    "customer_csv": _with(CUSTOMERS)
    + """SELECT customer_id, account_masked, segment, risk_score, home_province, home_lat::DOUBLE AS home_lat,
  home_lon::DOUBLE AS home_lon FROM dim_customer""",
    "rule_document": _with(TXN, _documented(CASCADE))
    + f"""SELECT transaction_id, rule_triggered,
  (isodow(event_ts) = 7 AND hour(event_ts) BETWEEN 1 AND 3) OR (isodow(event_ts) = 3 AND hour(event_ts) BETWEEN 22 AND 23)
    OR (event_ts::DATE = DATE '2024-01-15' AND hour(event_ts) BETWEEN 8 AND 11) AS is_maintenance,
  event_ts::DATE IN (DATE '2024-01-01', DATE '2024-01-20') AS is_holiday, {_documented(_OFF)} AS is_night_large_risk
FROM scored""",
    "dead_letter_replay_keyed": _BASE
    + """SELECT transaction_id AS key, '{"transaction_id": "' || transaction_id || '",' || chr(10) || ' "timestamp": "'
  || "timestamp" || '"}' AS value, 1::BIGINT AS n FROM txn WHERE n % 7 = 3""",
    "array_messages": _BASE
    + """SELECT transaction_id, CASE WHEN n % 11 <> 4 THEN amount END::VARCHAR AS amount, event_ts,
  CASE WHEN n % 11 = 4 THEN 'amount' ELSE '' END AS error_reasons FROM txn""",
    "rows_by_prefix_in_order": _HOUSE
    + """SELECT transaction_id, account_masked, amount, merchant_id, merchant_province, fraud_flag, alert_id, loaded_at
FROM facts WHERE transaction_id LIKE 'TXN000000%' ORDER BY loaded_at, transaction_id""",
    "fraud_samples_of_all_kinds": _BASE
    + " UNION ALL ".join(
        f"""SELECT * FROM (SELECT "timestamp", transaction_id, account_masked, amount, merchant_province, '{kind}' AS kind
FROM txn WHERE fraud_label = 1 AND fraud_type = '{kind}' AND {where} ORDER BY "timestamp", transaction_id LIMIT {k})"""
        for kind, k, where in (
            *(
                (
                    kind,
                    k,
                    f"""account_masked = (SELECT account_masked FROM txn WHERE fraud_label = 1 AND fraud_type = '{kind}'
  ORDER BY "timestamp", transaction_id LIMIT 1)""",
                )
                for kind, k in (("velocity", 5), ("geo_anomaly", 4))
            ),
            ("off_hours_large", 5, "true"),
        )
    ),
    "load_completeness_of_sent": _HOUSE
    + " UNION ALL ".join(
        f"""SELECT count(*) AS arrived, round((epoch_us(max(loaded_at)) - epoch_us(min(loaded_at))) / 1e6, 3) AS elapsed_s,
  round(count(*) / nullif((epoch_us(max(loaded_at)) - epoch_us(min(loaded_at))) / 1e6, 0), 4) AS rows_per_s,
  count(*) >= (SELECT count(*) FROM txn) AS complete, '{prefix}' AS prefix
FROM facts WHERE transaction_id LIKE '{prefix}%'"""
        for prefix in ("TXN", "TXN00000002")
    ),
    "channel_array_files": _BASE + f"SELECT {_MESSAGE} FROM txn",
    "stream_keyed_late": _with(_GOOD, CASCADE_GEO, _LATE)
    + """SELECT transaction_id, CASE WHEN NOT late THEN rule_triggered END AS rule_triggered, late FROM (
  SELECT *, account_masked IN (SELECT account_masked FROM picked) AND t < w AS late FROM scored, mark)""",
    "stream_minutes_late": _with(_GOOD, _LATE)
    + """SELECT time, late, count(*) AS value FROM (
  SELECT date_trunc('minute', event_ts)::TIMESTAMP AS time, account_masked IN (SELECT account_masked FROM picked) AS late FROM txn
), mark WHERE epoch_ms(time) + 60000 <= w GROUP BY 1, 2""",
}
