"""SQL twins of the canonical views, for the DuckDB oracle.

Each constant is a CTE body; ``with_views`` prefixes a query with the CTEs it
names. The arithmetic mirrors ``ledgerhawk.sources.canonical`` exactly.
"""

from __future__ import annotations

TXN = """
SELECT
  event_id AS transaction_id,
  'IK-' || CAST(event_id AS VARCHAR) AS idempotency_key,
  user_id AS customer_id,
  user_id AS account_id_source,
  event_id % 97 AS account_id_dest,
  (['MOBILE_APP','ATM','POS','WEB_BANKING','SWIFT_WIRE','BRANCH','E_WALLET'])[k % 7 + 1] AS channel_type,
  CASE event_type WHEN 'signup' THEN 'DEPOSIT' WHEN 'view' THEN 'TRANSFER_IN'
       WHEN 'click' THEN 'TRANSFER_OUT' WHEN 'purchase' THEN 'WITHDRAWAL'
       WHEN 'error' THEN 'PURCHASE' END AS transaction_type,
  CASE WHEN event_type = 'error' THEN 'Rejected' ELSE 'Successful' END AS trans_status,
  (['Shopping','Salary','Transfer','Bill Payment'])[event_id % 4 + 1] AS trans_reason,
  CAST(CAST(value AS DECIMAL(12,2)) * 40 AS DECIMAL(12,2)) AS amount,
  CAST(CAST(value AS DECIMAL(12,2)) * 40 AS DECIMAL(12,2)) AS amount_usd,
  (['USD','EGP','EUR','GBP'])[event_id % 4 + 1] AS currency_code,
  ts AS event_ts,
  epoch_us(ts) // 1000 AS event_timestamp,
  epoch_us(ts) // 1000 + (event_id * 37) % 5000 AS kafka_timestamp,
  epoch_us(ts) // 1000 + (event_id * 37) % 5000 + (event_id * 911) % 40000 AS ingest_ms,
  user_id % 25 AS country_src,
  CASE WHEN event_id % 3 = 0 THEN (event_id * 7) % 25 ELSE user_id % 25 END AS country_dest,
  user_id % 25 AS ip_country,
  CASE WHEN event_id % 5 = 0 THEN (user_id + event_id) % 25 ELSE user_id % 25 END AS country_code,
  CAST((CASE WHEN event_id % 5 = 0 THEN (user_id + event_id) % 25 ELSE user_id % 25 END) * 6 - 75 AS DOUBLE) AS latitude,
  CAST((CASE WHEN event_id % 5 = 0 THEN (user_id + event_id) % 25 ELSE user_id % 25 END) * 14 - 170 AS DOUBLE) AS longitude,
  'D' || CAST(user_id AS VARCHAR) || '-' || CAST(k % 4 AS VARCHAR) AS device_id,
  event_id % 50 = 0 AS is_rooted_device,
  event_id % 20 AS merchant_id,
  (['GROCERY','ELECTRONICS','TRAVEL','RESTAURANT','FUEL'])[event_id % 20 % 5 + 1] AS merchant_category,
  CASE WHEN event_id % 20 = 7 THEN 'BlacklistedMerchant1'
       WHEN event_id % 20 = 13 THEN 'BlacklistedMerchant2'
       ELSE 'Merchant' || CAST(event_id % 20 AS VARCHAR) END AS trans_destination,
  CAST(hour(ts) AS INTEGER) AS local_hour,
  k % 3 AS failed_auth_count,
  'TR' || lpad(CAST(event_id AS VARCHAR), 14, '0') AS trans_ref_no
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e
"""

TXN_DIRTY = """
SELECT * EXCLUDE (customer_id, channel_type, amount, event_timestamp),
  CASE WHEN transaction_id % 211 = 0 THEN NULL ELSE customer_id END AS customer_id,
  CASE WHEN transaction_id % 103 = 0 THEN 'TELEX' ELSE channel_type END AS channel_type,
  CAST(CASE WHEN transaction_id % 101 = 0 THEN NULL
            WHEN transaction_id % 107 = 0 THEN -amount
            WHEN transaction_id % 113 = 0 THEN CAST(10000000 AS DECIMAL(12,2))
            ELSE amount END AS DOUBLE) AS amount,
  CASE WHEN transaction_id % 109 = 0 THEN CAST(0 AS BIGINT) ELSE event_timestamp END AS event_timestamp
FROM txn
"""

REDELIVERED = """
SELECT * FROM txn
UNION ALL
SELECT * FROM txn WHERE (transaction_id * 37) % 5000 < 500
"""

CARD = """
SELECT
  transaction_id AS Trans_id, customer_id AS Clt_id, customer_id * 10 + 1 AS Card_id,
  device_id AS Dev_id,
  strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS Trans_date,
  event_ts AS Trans_ts,
  CASE WHEN transaction_type = 'DEPOSIT' THEN 'Deposit'
       WHEN transaction_type IN ('TRANSFER_IN', 'TRANSFER_OUT') THEN 'Transfer'
       ELSE 'Withdrawal' END AS Trans_type,
  trans_status AS Trans_status,
  amount AS Trans_amount,
  currency_code AS Currency,
  trans_ref_no AS Trans_Ref_No,
  country_src AS Country_Src,
  country_dest AS Country_Dest,
  CAST(account_id_dest AS VARCHAR) AS Dest_account_No,
  trans_destination AS Trans_destination,
  CASE WHEN transaction_id % 10 = 0 THEN CAST(transaction_id % 900 + 1 AS VARCHAR) || ' Nile Street'
       ELSE '10.' || CAST(customer_id % 256 AS VARCHAR) || '.' || CAST(transaction_id % 256 AS VARCHAR) || '.1'
  END AS Dev_Ip_Location,
  trans_reason AS Trans_Reason,
  merchant_category, latitude, longitude
FROM txn
"""

VIEWS = {"txn": TXN, "txn_dirty": TXN_DIRTY, "redelivered": REDELIVERED, "card": CARD}
ORDER = ("txn", "txn_dirty", "redelivered", "card")


def with_views(body: str, *extra: tuple[str, str], views=("txn",)) -> str:
    """``WITH txn AS (...), <extra...> <body>``; views are emitted in dependency order."""
    parts = [f"{v} AS ({VIEWS[v]})" for v in ORDER if v in views]
    parts += [f"{name} AS ({sql})" for name, sql in extra]
    return "WITH " + ",\n".join(parts) + "\n" + body
