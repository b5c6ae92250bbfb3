"""DuckDB oracles for the registered batch queries (see ``catalog``)."""

from __future__ import annotations

from ledgerhawk.plans.oracle_decisions import hav
from ledgerhawk.plans import oracle_views
from ledgerhawk.plans.oracle_views import with_views

D = ("txn", "txn_dirty")
CARD = ("txn", "card")
DIRTY_CARD_BODY = oracle_views.CARD.replace("FROM txn", "FROM txn_dirty")

NULLS = ("list_filter([" + ", ".join(
    f"CASE WHEN {f} IS NULL THEN 'NULL_{f.upper()}' END"
    for f in ("transaction_id", "customer_id", "amount", "event_timestamp", "channel_type", "account_id_source"))
    + "], lambda x: x IS NOT NULL)")
CHANNELS = "('MOBILE_APP','WEB_BANKING','ATM','POS','BRANCH','SWIFT_WIRE','E_WALLET','INTERNAL_TRANSFER')"


def dq_cte(self_transfer: bool = False) -> str:
    rules = [("amount > 0", "AMOUNT_NOT_POSITIVE"), ("amount < 10000000", "AMOUNT_EXCEEDS_CAP"),
             ("event_timestamp > 1000000000000", "INVALID_TIMESTAMP"),
             (f"channel_type IN {CHANNELS}", "INVALID_CHANNEL")]
    if self_transfer:
        rules.append(("account_id_source IS DISTINCT FROM account_id_dest", "SELF_TRANSFER"))
    viol = " || ".join([f"array_to_string({NULLS}, '|')"] +
                       [f"(CASE WHEN NOT ({c}) THEN '|{n}' ELSE '' END)" for c, n in rules])
    passed = " AND ".join([f"len({NULLS}) = 0"] + [f"({c})" for c, _ in rules])
    return f"""SELECT *, {viol} AS dq_violations, {passed} AS dq_passed,
  CAST(6 - len({NULLS}) AS DOUBLE) / 6 AS completeness_score FROM txn_dirty"""


SLA_COLS = """CASE WHEN kafka_timestamp IS NOT NULL THEN kafka_timestamp - event_timestamp ELSE 0 END AS source_to_kafka_lag_ms,
  ingest_ms - kafka_timestamp AS kafka_to_spark_lag_ms,
  ingest_ms - event_timestamp AS total_pipeline_lag_ms,
  ingest_ms - event_timestamp > 30000 AS sla_breached"""

DQ_NULLS = with_views(f"SELECT transaction_id, array_to_string({NULLS}, '|') AS null_violations FROM txn_dirty",
                      views=D)
DQ_VALIDATE = with_views("SELECT transaction_id, dq_violations, dq_passed, completeness_score FROM dq",
                         ("dq", dq_cte()), views=D)
DQ_COMPLETENESS = with_views("SELECT completeness_score, count(*) AS rows FROM dq GROUP BY 1",
                             ("dq", dq_cte()), views=D)
DQ_SELF_TRANSFER = with_views("""SELECT transaction_id, account_id_source, account_id_dest, dq_violations
FROM dq WHERE contains(dq_violations, 'SELF_TRANSFER')""", ("dq", dq_cte(True)), views=D)
ROUTE_COUNTS = with_views(f"""SELECT route, count(*) AS rows FROM (
  SELECT CASE WHEN NOT dq_passed THEN 'dlq' WHEN sla_breached THEN 'archive' ELSE 'decision' END AS route
  FROM (SELECT *, {SLA_COLS} FROM dq) s) r GROUP BY route""", ("dq", dq_cte()), views=D)
DLQ_ROWS = with_views("SELECT transaction_id, dq_violations FROM dq WHERE NOT dq_passed",
                      ("dq", dq_cte()), views=D)
SLA_METRICS = with_views(f"""SELECT transaction_id, {SLA_COLS} FROM txn""")
SLA_BREACH_RATE = with_views(f"""SELECT channel_type, count(*) AS rows,
  CAST(sum(CASE WHEN sla_breached THEN 1 ELSE 0 END) AS BIGINT) AS breached,
  max(total_pipeline_lag_ms) AS max_lag_ms,
  CAST(sum(CASE WHEN sla_breached THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS breach_rate
FROM (SELECT *, {SLA_COLS} FROM txn) s GROUP BY channel_type""")
SLA_ARCHIVE = with_views("""SELECT transaction_id, ingest_ms - event_timestamp AS total_pipeline_lag_ms
FROM txn WHERE ingest_ms - event_timestamp > 30000""")
DLQ_ENVELOPE = with_views("""SELECT coalesce(CAST(transaction_id AS VARCHAR), 'unknown') AS key,
  to_json({'transaction_id': transaction_id, 'customer_id': customer_id, 'channel_type': channel_type,
           'event_timestamp': event_timestamp}) AS original_event,
  dq_violations AS error, CAST(floor(ingest_ms / 1000) AS BIGINT) AS failed_at
FROM dq WHERE NOT dq_passed""", ("dq", dq_cte()), views=D)

FINGERPRINT = with_views("""SELECT transaction_id, sha256(concat_ws('|', CAST(transaction_id AS VARCHAR),
  CAST(customer_id AS VARCHAR), CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR),
  CAST(event_timestamp AS VARCHAR), channel_type)) AS data_fingerprint FROM txn""")


def r4(x: str) -> str:
    return f"(floor(({x}) * 10000 + 0.5) / CAST(10000.0 AS DOUBLE))"


HAVERSINE = with_views(f"""SELECT transaction_id, {r4(hav('CAST(country_src * 6 - 75 AS DOUBLE)', 'CAST(country_src * 14 - 170 AS DOUBLE)', 'latitude', 'longitude'))} AS km_from_home FROM txn""")

WK = "(CASE WHEN {ts} IS NOT NULL AND dayofweek({ts}) IN (0, 6) THEN 1 ELSE 0 END)"
STEP = ("(CASE WHEN {a} > 5000 THEN CAST(0.9 AS DOUBLE) WHEN " + WK + " = 1 THEN CAST(0.7 AS DOUBLE) "
        "ELSE CAST(0.2 AS DOUBLE) END)")
SUSPECT = "(CASE WHEN " + STEP + " > 0.8 THEN 1 ELSE 0 END)"

ENRICHED = f"""SELECT *,
  CASE WHEN prev_ts IS NOT NULL AND Trans_ts IS NOT NULL
       THEN CAST(epoch_us(Trans_ts) - epoch_us(prev_ts) AS DOUBLE) / 1000000.0 ELSE CAST(0.0 AS DOUBLE) END AS time_since_last_trans,
  {hav('prev_lat', 'prev_lon', 'latitude', 'longitude')} AS distance_from_last_loc,
  {SUSPECT.format(a='Trans_amount', ts='Trans_ts')} AS suspect_flag,
  CASE WHEN Trans_amount > 5000 THEN CAST(70.0 AS DOUBLE) + CAST((Trans_id * 13) % 3001 AS DOUBLE) / 100.0
       ELSE CAST((Trans_id * 13) % 4001 AS DOUBLE) / 100.0 END AS risk_score,
  CAST(CAST(Trans_amount AS DECIMAL(18,2)) * CAST(1.5 AS DECIMAL(10,4)) AS DOUBLE) AS new_current_amount
FROM (SELECT *,
  lag(Trans_ts) OVER (PARTITION BY Clt_id ORDER BY Trans_ts NULLS LAST, Trans_id) AS prev_ts,
  lag(latitude) OVER (PARTITION BY Clt_id ORDER BY Trans_ts, Trans_id) AS prev_lat,
  lag(longitude) OVER (PARTITION BY Clt_id ORDER BY Trans_ts, Trans_id) AS prev_lon
  FROM card) c"""
JUNK = ("CASE WHEN suspect_flag = 1 AND Trans_status IN ('Rejected','Failed') THEN 4 WHEN suspect_flag = 1 THEN 3 "
        "WHEN Trans_status IN ('Rejected','Failed') THEN 2 ELSE 1 END")

DISTANCE_FROM_LAST = with_views(f"SELECT Trans_id, {r4('distance_from_last_loc')} AS distance_km FROM enr",
                                ("enr", ENRICHED), views=CARD)
TIME_SINCE_LAST = with_views("""SELECT transaction_id,
  CASE WHEN prev IS NOT NULL AND event_ts IS NOT NULL
       THEN CAST(epoch_us(event_ts) - epoch_us(prev) AS DOUBLE) / 1000000.0 ELSE CAST(0.0 AS DOUBLE) END AS time_since_last_trans
FROM (SELECT *, lag(event_ts) OVER (PARTITION BY customer_id ORDER BY event_ts NULLS LAST, transaction_id) AS prev
      FROM txn) t""")
IS_WEEKEND = with_views(f"SELECT transaction_id, {WK.format(ts='event_ts')} AS is_weekend FROM txn")
IS_HOLIDAY = with_views("""SELECT transaction_id, CASE WHEN CAST(event_ts AS DATE) IN
  (DATE '2024-01-01', DATE '2024-01-15', DATE '2024-01-26') THEN 1 ELSE 0 END AS is_holiday FROM txn""")
RISK_STEP = with_views(f"SELECT transaction_id, {STEP.format(a='amount', ts='event_ts')} AS step_risk FROM txn")
IS_SUSPECT = with_views(f"SELECT transaction_id, {SUSPECT.format(a='amount', ts='event_ts')} AS suspect_flag FROM txn")
ADJUSTED_AMOUNT = with_views("""SELECT transaction_id,
  CAST(CAST(amount AS DECIMAL(18,2)) * CAST(1.5 AS DECIMAL(10,4)) AS DOUBLE) AS new_current_amount,
  CAST(CAST(amount AS DECIMAL(18,2)) * CAST(-1 AS DECIMAL(10,4)) AS DOUBLE) AS signed_amount,
  CAST(CAST(amount AS DECIMAL(18,2)) * CAST(1.05 AS DECIMAL(10,4)) AS DOUBLE) AS bronze_amount FROM txn""")
RISK_BAND = with_views("""SELECT transaction_id,
  CASE WHEN amount > 5000 THEN CAST(70.0 AS DOUBLE) + CAST((transaction_id * 13) % 3001 AS DOUBLE) / 100.0
       ELSE CAST((transaction_id * 13) % 4001 AS DOUBLE) / 100.0 END AS risk_score FROM txn""")
OUTCOME_CLASS = with_views(f"SELECT Trans_id, {JUNK} AS junk_sk FROM enr", ("enr", ENRICHED), views=CARD)
FAILED_TXN = with_views("SELECT Trans_id, Trans_status FROM card WHERE Trans_status IN ('Failed','Rejected')",
                        views=CARD)
SILVER_FILTER = with_views("""SELECT Trans_id, Currency FROM dcard
WHERE Trans_amount > 0 AND Trans_amount <= 100000 AND Currency IN ('USD','EGP','EUR','GBP')
  AND year(Trans_ts) BETWEEN 2015 AND 2025""", ("dcard", DIRTY_CARD_BODY), views=D)
SILVER_STANDARDIZE = with_views("""SELECT Trans_id, upper(trim(Currency)) AS Currency,
  upper(trim(Trans_type)) AS Trans_type, upper(trim(Trans_status)) AS Trans_status FROM card""", views=CARD)
FACT_PROJECTION = with_views(f"""SELECT Trans_id AS trans_sk, Clt_id AS clt_sk, Card_id AS card_sk,
  Dev_id AS device_sk, Trans_ts AS event_timestamp, {JUNK} AS junk_sk, Trans_Ref_No AS trans_ref_no,
  Trans_destination AS trans_destination, Dev_Ip_Location AS dev_ip_location, Country_Src AS country_src,
  Country_Dest AS country_dest, Trans_Reason AS trans_reason, Currency AS currency,
  Dest_account_No AS dest_account_no, Trans_amount AS trans_amount, time_since_last_trans,
  {r4('distance_from_last_loc')} AS distance_from_last_loc, risk_score, new_current_amount,
  Trans_type AS trans_type, Trans_status AS trans_status FROM enr""", ("enr", ENRICHED), views=CARD)
FACT_SURROGATE_KEYS = with_views(f"""SELECT Trans_id AS trans_sk, coalesce(c.c_custkey, -1) AS clt_sk,
  Card_id AS card_sk, Dev_id AS device_sk,
  CAST(strftime(Trans_ts, '%Y%m%d') AS INTEGER) AS date_sk, CAST(strftime(Trans_ts, '%H%M%S') AS INTEGER) AS time_sk,
  {JUNK} AS junk_sk, Trans_id AS trans_id, Trans_Ref_No AS trans_ref_no,
  coalesce(n.n_name, 'UNKNOWN') AS country_src_name, Trans_amount AS trans_amount, risk_score, new_current_amount,
  Trans_type AS trans_type, Trans_status AS trans_status
FROM enr LEFT JOIN customer c ON enr.Clt_id = c.c_custkey LEFT JOIN nation n ON enr.Country_Src = n.n_nationkey""",
                                 ("enr", ENRICHED), views=CARD)
PARSE_TIME_12H = with_views("""SELECT Trans_id, text_12h,
  CAST(epoch(try_strptime(text_12h, '%Y-%m-%d %I:%M:%S %p')) AS BIGINT) AS parsed_epoch_s
FROM (SELECT Trans_id, strftime(Trans_ts, '%Y-%m-%d %I:%M:%S %p') AS text_12h FROM card) c""", views=CARD)
PARSE_TIME_24H = with_views("""SELECT Trans_id, CAST(epoch(coalesce(try_strptime(text, '%Y-%m-%d %H:%M:%S'),
  try_strptime(text, '%Y-%m-%d %I:%M:%S %p'))) AS BIGINT) AS parsed_epoch_s
FROM (SELECT Trans_id, CASE WHEN Trans_id % 2 = 0 THEN Trans_date
             ELSE strftime(Trans_ts, '%Y-%m-%d %I:%M:%S %p') END AS text FROM card) c""", views=CARD)
EPOCH_MS = with_views("SELECT transaction_id, epoch_ms(event_timestamp) AS event_time FROM txn")

# --------------------------------------------------------------------- rules
HOURLY = """SELECT customer_id, time_bucket(INTERVAL 1 HOUR, event_ts) AS ws, country_src, country_code,
  count(*) AS n FROM txn GROUP BY ALL"""


def win_alert(having: str, reason: str, day: bool = False) -> str:
    ws = "time_bucket(INTERVAL 1 DAY, ws)" if day else "ws"
    width = "INTERVAL 1 DAY" if day else "INTERVAL 1 HOUR"
    return f"""SELECT customer_id, w AS window_start, w + {width} AS window_end,
  CAST(txn_count AS BIGINT) AS txn_count, '{reason}' AS suspect_reason
FROM (SELECT customer_id, {ws} AS w, sum(n) AS txn_count, count(DISTINCT country_code) AS countries
      FROM hourly GROUP BY ALL) a WHERE {having}"""


RULE_HIGH_AMOUNT = with_views("""SELECT customer_id, transaction_id, amount, 'High Amount' AS suspect_reason
FROM txn WHERE amount > 10000""")
RULE_VELOCITY = with_views(win_alert("txn_count > 1", "Velocity Check"), ("hourly", HOURLY))
RULE_COUNTRY_MISMATCH = with_views("""SELECT customer_id, transaction_id, country_src, country_dest,
  'Country Mismatch' AS suspect_reason FROM txn WHERE country_src <> country_dest""")
RULE_REPEAT_COUNTRY = with_views("""SELECT customer_id, country_src, ws AS window_start,
  ws + INTERVAL 1 HOUR AS window_end, CAST(sum(n) AS BIGINT) AS txn_count, 'Impossible Travel' AS suspect_reason
FROM hourly GROUP BY customer_id, ws, country_src HAVING sum(n) > 1""", ("hourly", HOURLY))
RULE_IMPOSSIBLE_TRAVEL = with_views(win_alert("countries > 1", "Impossible Travel"), ("hourly", HOURLY))
RULE_BLACKLIST = with_views("""SELECT customer_id, transaction_id, trans_destination,
  'Blacklisted Merchant' AS suspect_reason FROM txn
WHERE trans_destination IN ('BlacklistedMerchant1', 'BlacklistedMerchant2')""")
RULE_DAILY_FREQUENCY = with_views(win_alert("txn_count > 5", "Abnormal Frequency", day=True), ("hourly", HOURLY))
RULE_ODD_HOURS = with_views("""SELECT customer_id, transaction_id, CAST(hour(event_ts) AS INTEGER) AS hour_of_day,
  'Odd Hours' AS suspect_reason FROM txn WHERE hour(event_ts) NOT BETWEEN 6 AND 23""")
RULE_UNEXPECTED_COUNTRY = with_views("""SELECT t.customer_id, transaction_id, country_code, expected_country,
  'Unexpected Country' AS suspect_reason
FROM txn t JOIN (
  SELECT customer_id, country_code AS expected_country FROM (
    SELECT customer_id, country_code, row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, country_code) AS r
    FROM (SELECT customer_id, country_code, count(*) AS n FROM txn GROUP BY ALL) c) x WHERE r = 1
) e ON t.customer_id = e.customer_id
WHERE country_code <> expected_country""")
RULES_UNION = with_views(f"""
SELECT customer_id, transaction_id, CAST(NULL AS TIMESTAMP) AS window_start, CAST(NULL AS TIMESTAMP) AS window_end,
  CAST(NULL AS BIGINT) AS txn_count, reason AS suspect_reason
FROM (SELECT customer_id, transaction_id, unnest(list_filter([
    CASE WHEN amount > 10000 THEN 'High Amount' END,
    CASE WHEN country_src <> country_dest THEN 'Country Mismatch' END,
    CASE WHEN trans_destination IN ('BlacklistedMerchant1', 'BlacklistedMerchant2') THEN 'Blacklisted Merchant' END,
    CASE WHEN hour(event_ts) NOT BETWEEN 6 AND 23 THEN 'Odd Hours' END], lambda x: x IS NOT NULL)) AS reason
  FROM txn) r
UNION ALL SELECT customer_id, NULL, window_start, window_end, txn_count, suspect_reason FROM ({win_alert("txn_count > 1", "Velocity Check")}) a
UNION ALL SELECT customer_id, NULL, window_start, window_end, txn_count, suspect_reason FROM ({win_alert("countries > 1", "Impossible Travel")}) b
UNION ALL SELECT customer_id, NULL, window_start, window_end, txn_count, suspect_reason FROM ({win_alert("txn_count > 5", "Abnormal Frequency", day=True)}) c
UNION ALL SELECT customer_id, NULL, ws, ws + INTERVAL 1 HOUR, CAST(sum(n) AS BIGINT), 'Impossible Travel'
  FROM hourly GROUP BY customer_id, ws, country_src HAVING sum(n) > 1
""", ("hourly", HOURLY))
SQL_SUSPECT_BY_CATEGORY = with_views("""SELECT merchant_category, count(*) AS suspect_cases FROM txn
WHERE amount > 5000 GROUP BY merchant_category ORDER BY suspect_cases DESC, merchant_category""")
SQL_LIMIT = with_views("""SELECT transaction_id, customer_id, amount FROM txn
ORDER BY amount DESC, transaction_id LIMIT 10""")
SQL_COUNT = with_views("SELECT count(*) AS transactions FROM txn")

# --------------------------------------------------------------------- gold
SILVER = f"""SELECT * REPLACE (upper(trim(Currency)) AS Currency),
  {SUSPECT.format(a='Trans_amount', ts='Trans_ts')} AS suspect_flag
FROM (SELECT DISTINCT ON (Trans_id, Trans_Ref_No) * FROM card) d
WHERE Trans_amount > 0 AND Trans_amount <= 100000 AND Currency IN ('USD','EGP','EUR','GBP')
  AND year(Trans_ts) BETWEEN 2015 AND 2025"""


def gold(body: str) -> str:
    return with_views(body, ("silver", SILVER), views=CARD)


SUSPECT_KPIS = gold("""SELECT year, month, day, total_transactions, suspect_transactions,
  CAST(s AS DOUBLE) / total_transactions AS avg_transaction_amount, CAST(s AS DOUBLE) AS total_transaction_amount,
  CAST(suspect_transactions AS DOUBLE) / total_transactions AS suspect_rate
FROM (SELECT CAST(year(Trans_ts) AS INTEGER) AS year, CAST(month(Trans_ts) AS INTEGER) AS month,
        CAST(day(Trans_ts) AS INTEGER) AS day, count(*) AS total_transactions,
        CAST(sum(CASE WHEN suspect_flag = 1 THEN 1 ELSE 0 END) AS BIGINT) AS suspect_transactions,
        sum(Trans_amount) AS s FROM silver GROUP BY ALL) k""")
CUSTOMER_RISK = gold("""SELECT Clt_id, transactions_count, CAST(s AS DOUBLE) / transactions_count AS avg_amount,
  suspect_count, CAST(suspect_count AS DOUBLE) / transactions_count AS customer_risk_score
FROM (SELECT Clt_id, count(*) AS transactions_count, sum(Trans_amount) AS s,
        CAST(sum(CASE WHEN suspect_flag = 1 THEN 1 ELSE 0 END) AS BIGINT) AS suspect_count FROM silver GROUP BY Clt_id) k""")
SUSPECT_BY_CATEGORY = gold("""SELECT merchant_category, count(*) AS suspect_cases FROM silver WHERE suspect_flag = 1
GROUP BY merchant_category ORDER BY suspect_cases DESC, merchant_category""")
REPEAT_SUSPECTS = gold("""SELECT Clt_id, count(*) AS suspicious_count FROM silver WHERE suspect_flag = 1
GROUP BY Clt_id HAVING count(*) > 1""")
CUSTOMER_RISK_TREND = gold("""SELECT *, risk_ratio - lag(risk_ratio) OVER (PARTITION BY Clt_id ORDER BY period_start) AS risk_change
FROM (SELECT Clt_id, date_trunc('week', Trans_ts) AS period_start, count(*) AS transactions_count,
        CAST(sum(CASE WHEN suspect_flag = 1 THEN 1 ELSE 0 END) AS BIGINT) AS suspect_count,
        CAST(sum(CASE WHEN suspect_flag = 1 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS risk_ratio
      FROM silver GROUP BY ALL) k""")
SUSPECT_TREND = gold("""SELECT *,
  CAST(sum(suspect_transactions) OVER (ORDER BY period_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_suspect,
  CAST(sum(total_transactions) OVER (ORDER BY period_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_total
FROM (SELECT date_trunc('day', Trans_ts) AS period_start, count(*) AS total_transactions,
        CAST(sum(CASE WHEN suspect_flag = 1 THEN 1 ELSE 0 END) AS BIGINT) AS suspect_transactions
      FROM silver GROUP BY ALL) k""")
CLIENT_FEATURES_BODY = """SELECT Clt_id, count(*) AS transactions_last_day,
  CAST(sum(Trans_amount) AS DOUBLE) / count(*) AS average_transaction_amount FROM silver GROUP BY Clt_id"""
CLIENT_FEATURES = gold(CLIENT_FEATURES_BODY)
FEATURE_JOIN = gold(f"""SELECT Trans_id, s.Clt_id, Trans_amount, transactions_last_day, average_transaction_amount
FROM silver s JOIN ({CLIENT_FEATURES_BODY}) f ON s.Clt_id = f.Clt_id""")
DIM_LOOKUP = with_views("""SELECT transaction_id, coalesce(n.n_name, 'UNKNOWN') AS country_name,
  coalesce(c.c_mktsegment, 'UNKNOWN') AS segment
FROM txn t LEFT JOIN nation n ON t.country_code = n.n_nationkey LEFT JOIN customer c ON t.customer_id = c.c_custkey""")
GOLD_SUSPECT_ALERTS = gold("SELECT Trans_id, Clt_id, Trans_amount FROM silver WHERE suspect_flag = 1")
DEDUP_SILVER = with_views("SELECT DISTINCT transaction_id, trans_ref_no, amount FROM redelivered",
                          views=("txn", "redelivered"))
MARKS = """SELECT channel_type, max(transaction_id) AS last_id FROM txn
WHERE event_ts < TIMESTAMP '2024-01-15 00:00:00' GROUP BY channel_type"""
REPLAY_REPORT = """SELECT t.channel_type, count(*) AS total,
  CAST(sum(CASE WHEN transaction_id > coalesce(m.last_id, 0) THEN 0 ELSE 1 END) AS BIGINT) AS skipped,
  CAST(sum(CASE WHEN transaction_id > coalesce(m.last_id, 0) THEN 1 ELSE 0 END) AS BIGINT) AS new,
  max(CASE WHEN transaction_id > coalesce(m.last_id, 0) THEN transaction_id END) AS newmax,
  max(m.last_id) AS old
FROM txn t LEFT JOIN marks m ON t.channel_type = m.channel_type GROUP BY t.channel_type"""
REPLAY_RESUME = with_views("SELECT channel_type, total, skipped, new FROM rep", ("marks", MARKS),
                           ("rep", REPLAY_REPORT))
REPLAY_ROWS = with_views("""SELECT transaction_id, channel_type FROM txn LEFT JOIN
  (SELECT channel_type AS ch, last_id FROM marks) m ON channel_type = ch WHERE transaction_id > coalesce(last_id, 0)""", ("marks", MARKS))
REPLAY_MARKS = with_views("SELECT channel_type, coalesce(newmax, old) AS last_id FROM rep", ("marks", MARKS),
                          ("rep", REPLAY_REPORT))

# --------------------------------------------------------------------- T13, T17
def _last_of(cond: str, value: str) -> str:
    return (f"arg_max(CASE WHEN {cond} THEN {value} END, "
            f"CASE WHEN {cond} THEN {{'ts': event_timestamp, 'id': transaction_id}} END)")


CUSTOMER_LAST_STATE = with_views(f"""SELECT customer_id,
  {_last_of("channel_type = 'MOBILE_APP'", 'event_timestamp')} AS last_mobile_ts,
  {_last_of("channel_type = 'MOBILE_APP'", 'device_id')} AS last_mobile_device,
  {_last_of("channel_type = 'MOBILE_APP'", 'ip_country')} AS last_mobile_ip_country,
  {_last_of("channel_type = 'MOBILE_APP'", 'latitude')} AS last_mobile_latitude,
  {_last_of("channel_type = 'MOBILE_APP'", 'longitude')} AS last_mobile_longitude,
  {_last_of("channel_type IN ('ATM','POS','BRANCH')", 'event_timestamp')} AS last_atm_ts,
  {_last_of("channel_type IN ('ATM','POS','BRANCH')", 'latitude')} AS last_atm_latitude,
  {_last_of("channel_type IN ('ATM','POS','BRANCH')", 'longitude')} AS last_atm_longitude,
  {_last_of("channel_type = 'WEB_BANKING'", 'event_timestamp')} AS last_web_ts,
  {_last_of("channel_type = 'WEB_BANKING'", 'ip_country')} AS last_web_ip_country,
  {_last_of("channel_type = 'SWIFT_WIRE'", 'event_timestamp')} AS last_wire_ts,
  {_last_of("channel_type = 'SWIFT_WIRE'", 'country_code')} AS last_wire_country,
  {_last_of("channel_type = 'SWIFT_WIRE'", 'CAST(amount AS DOUBLE)')} AS last_wire_amount,
  {_last_of("country_code IS NOT NULL", 'country_code')} AS last_known_country,
  max(event_timestamp) AS last_activity_ts, count(*) AS txn_count
FROM txn GROUP BY customer_id""")
_RW = "PARTITION BY customer_id ORDER BY event_timestamp"
ROLLING_FEATURES = with_views(f"""SELECT transaction_id,
  CAST(sum(CASE WHEN transaction_type IN ('TRANSFER_IN','DEPOSIT','WIRE_IN') THEN amount_usd ELSE 0 END)
       OVER ({_RW} RANGE BETWEEN 86400000 PRECEDING AND CURRENT ROW) AS DOUBLE) AS total_in_24h,
  CAST(sum(CASE WHEN transaction_type IN ('TRANSFER_OUT','WITHDRAWAL','WIRE_OUT') THEN amount_usd ELSE 0 END)
       OVER ({_RW} RANGE BETWEEN 86400000 PRECEDING AND CURRENT ROW) AS DOUBLE) AS total_out_24h,
  count(*) OVER ({_RW} RANGE BETWEEN 3600000 PRECEDING AND CURRENT ROW) AS txn_count_1h,
  array_to_string(list(CAST(amount AS VARCHAR)) OVER ({_RW}, transaction_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), ',')
    AS last_txn_amounts
FROM txn""")

#: the same at the precision of the stream's buckets: whole minutes, and the row's own up to it
ROLLING_BY_MINUTE = with_views(f"""SELECT s.transaction_id, total_in_24h, total_out_24h, txn_count_1h, last_txn_amounts FROM (
  SELECT a.transaction_id,
    CAST(sum(CASE WHEN b.transaction_type IN ('TRANSFER_IN','DEPOSIT','WIRE_IN') THEN coalesce(b.amount_usd, 0) ELSE 0 END) AS DOUBLE) AS total_in_24h,
    CAST(sum(CASE WHEN b.transaction_type IN ('TRANSFER_OUT','WITHDRAWAL','WIRE_OUT') THEN coalesce(b.amount_usd, 0) ELSE 0 END) AS DOUBLE) AS total_out_24h,
    count(*) FILTER (b.event_timestamp // 60000 > a.event_timestamp // 60000 - 60) AS txn_count_1h
  FROM txn a JOIN txn b ON a.customer_id = b.customer_id AND b.event_timestamp <= a.event_timestamp
    AND b.event_timestamp // 60000 > a.event_timestamp // 60000 - 1440 GROUP BY a.transaction_id) s
JOIN (SELECT transaction_id,
  array_to_string(list(CAST(amount AS VARCHAR)) OVER ({_RW}, transaction_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), ',')
    AS last_txn_amounts FROM txn) l ON s.transaction_id = l.transaction_id""")

# --------------------------------------------------------------------- Q suites
def suite_sql(suite, source: str) -> str:
    """One aggregate over ``source`` and one report row per expectation."""
    aggs = ["count(*) AS n"]
    for i, e in enumerate(suite):
        c = e.column
        if e.kind != "type":
            aggs.append(f"sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS m{i}")
        if e.kind == "between":
            aggs.append(f"sum(CASE WHEN {c} IS NOT NULL AND ({c} < {e.min_value} OR {c} > {e.max_value}) "
                        f"THEN 1 ELSE 0 END) AS u{i}")
        elif e.kind == "regex":
            aggs.append(f"sum(CASE WHEN {c} IS NOT NULL AND NOT regexp_matches(CAST({c} AS VARCHAR), "
                        f"'{e.regex}') THEN 1 ELSE 0 END) AS u{i}")
        elif e.kind == "in_set":
            vals = ", ".join(f"'{v}'" for v in e.values)
            aggs.append(f"sum(CASE WHEN {c} IS NOT NULL AND NOT (CAST({c} AS VARCHAR) IN ({vals})) "
                        f"THEN 1 ELSE 0 END) AS u{i}")
    uniq = [(i, e) for i, e in enumerate(suite) if e.kind == "unique"]
    rows = []
    for i, e in enumerate(suite):
        head = f"CAST({i} AS INTEGER) AS check_no, '{e.kind}' AS expectation, '{e.column}' AS column_name, n AS element_count"
        if e.kind == "type":
            kinds = {"int": "INTEGER|BIGINT|SMALLINT|TINYINT", "float": "DOUBLE|FLOAT", "str": "VARCHAR",
                     "bool": "BOOLEAN", "decimal": "DECIMAL.*"}[e.type_name]
            ok = f"coalesce((SELECT regexp_full_match(typeof({e.column}), '{kinds}') FROM {source} LIMIT 1), FALSE)"
            rows.append(f"SELECT {head}, CAST(0 AS BIGINT) AS missing_count, CASE WHEN {ok} THEN CAST(0 AS BIGINT) END AS unexpected_count, "
                        f"CASE WHEN {ok} THEN CAST(0 AS DOUBLE) END AS unexpected_percent, {ok} AS success FROM a")
            continue
        u = f"m{i}" if e.kind == "not_null" else f"u{i}"
        base = "n" if e.kind == "not_null" else f"(n - m{i})"
        rows.append(f"SELECT {head}, CAST(m{i} AS BIGINT) AS missing_count, CAST({u} AS BIGINT) AS unexpected_count, "
                    f"CASE WHEN {base} = 0 THEN NULL ELSE CAST({u} AS DOUBLE) * 100.0 / CAST({base} AS DOUBLE) END "
                    f"AS unexpected_percent, {u} = 0 AS success FROM a")
    uq = "".join(
        f", (SELECT coalesce(sum(k), 0) FROM (SELECT count(*) AS k FROM {source} WHERE {e.column} IS NOT NULL "
        f"GROUP BY {e.column} HAVING count(*) > 1) d) AS u{i}" for i, e in uniq)
    a = f"(SELECT *{uq} FROM (SELECT {', '.join(aggs)} FROM {source}) a0)"
    return " UNION ALL ".join(r.replace(" FROM a", f" FROM {a} a") for r in rows)
