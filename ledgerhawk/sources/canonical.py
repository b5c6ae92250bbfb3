"""Canonical transaction view over the driver's ``events`` table.

The reference's own data is not shipped, so every operator runs on a view that
Spark derives, row for row, from ``events``. The SQL twin lives in
``ledgerhawk.plans.oracle_views`` and is defined with the same integer and
decimal arithmetic, so both engines produce identical rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerhawk.sources.tables import table

# fixed derivation values of the canonical view (do not edit)
VIEW_CHANNELS = ("MOBILE_APP", "ATM", "POS", "WEB_BANKING", "SWIFT_WIRE", "BRANCH", "E_WALLET")
VIEW_TYPES = {"signup": "DEPOSIT", "view": "TRANSFER_IN", "click": "TRANSFER_OUT",
              "purchase": "WITHDRAWAL", "error": "PURCHASE"}
VIEW_CURRENCIES = ("USD", "EGP", "EUR", "GBP")
VIEW_REASONS = ("Shopping", "Salary", "Transfer", "Bill Payment")
VIEW_CATEGORIES = ("GROCERY", "ELECTRONICS", "TRAVEL", "RESTAURANT", "FUEL")
N_COUNTRIES = 25


def _pick(values, idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + F.lit(1)).cast("int"))


def txn_from_events(ev: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    eid, uid = F.col("event_id"), F.col("user_id")
    ctry_code = F.when(eid % 5 == 0, (uid + eid) % N_COUNTRIES).otherwise(uid % N_COUNTRIES)
    type_map = F.create_map(*[F.lit(x) for kv in VIEW_TYPES.items() for x in kv])
    amount = (F.col("value").cast("decimal(12,2)") * F.lit(40)).cast("decimal(12,2)")
    event_ms = F.unix_millis(F.col("ts").cast("timestamp"))
    kafka_ms = event_ms + (eid * 37) % 5000
    return (ev.select("event_id", "ts", "user_id", "event_type", "value", k.alias("k"))
            .select(
                eid.alias("transaction_id"),
                F.concat(F.lit("IK-"), eid.cast("string")).alias("idempotency_key"),
                uid.alias("customer_id"),
                uid.alias("account_id_source"),
                (eid % 97).alias("account_id_dest"),
                _pick(VIEW_CHANNELS, F.col("k") % 7).alias("channel_type"),
                type_map[F.col("event_type")].alias("transaction_type"),
                F.when(F.col("event_type") == "error", "Rejected").otherwise("Successful").alias("trans_status"),
                _pick(VIEW_REASONS, eid % 4).alias("trans_reason"),
                amount.alias("amount"),
                amount.alias("amount_usd"),
                _pick(VIEW_CURRENCIES, eid % 4).alias("currency_code"),
                F.col("ts").cast("timestamp").alias("event_ts"),
                event_ms.alias("event_timestamp"),
                kafka_ms.alias("kafka_timestamp"),
                (kafka_ms + (eid * 911) % 40000).alias("ingest_ms"),
                (uid % N_COUNTRIES).alias("country_src"),
                F.when(eid % 3 == 0, (eid * 7) % N_COUNTRIES).otherwise(uid % N_COUNTRIES).alias("country_dest"),
                (uid % N_COUNTRIES).alias("ip_country"),
                ctry_code.alias("country_code"),
                (ctry_code * 6 - 75).cast("double").alias("latitude"),
                (ctry_code * 14 - 170).cast("double").alias("longitude"),
                F.concat(F.lit("D"), uid.cast("string"), F.lit("-"), (F.col("k") % 4).cast("string")).alias("device_id"),
                (eid % 50 == 0).alias("is_rooted_device"),
                (eid % 20).alias("merchant_id"),
                _pick(VIEW_CATEGORIES, eid % 20 % 5).alias("merchant_category"),
                F.when(eid % 20 == 7, F.lit("BlacklistedMerchant1"))
                 .when(eid % 20 == 13, F.lit("BlacklistedMerchant2"))
                 .otherwise(F.concat(F.lit("Merchant"), (eid % 20).cast("string"))).alias("trans_destination"),
                F.hour(F.col("ts")).alias("local_hour"),
                (F.col("k") % 3).alias("failed_auth_count"),
                F.concat(F.lit("TR"), F.lpad(eid.cast("string"), 14, "0")).alias("trans_ref_no"),
            ))


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return txn_from_events(table(spark, sf_dir, "events"))


def txn_dirty_from(t: DataFrame) -> DataFrame:
    """Deterministic defect injection for the row-level quality rules."""
    i = F.col("transaction_id")
    amount = (F.when(i % 101 == 0, F.lit(None).cast("decimal(12,2)"))
              .when(i % 107 == 0, -F.col("amount"))
              .when(i % 113 == 0, F.lit(10_000_000).cast("decimal(12,2)"))
              .otherwise(F.col("amount")))
    return t.select(
        *[c for c in t.columns if c not in ("customer_id", "channel_type", "amount", "event_timestamp")],
        F.when(i % 211 == 0, F.lit(None).cast("bigint")).otherwise(F.col("customer_id")).alias("customer_id"),
        F.when(i % 103 == 0, F.lit("TELEX")).otherwise(F.col("channel_type")).alias("channel_type"),
        amount.cast("double").alias("amount"),
        F.when(i % 109 == 0, F.lit(0).cast("bigint")).otherwise(F.col("event_timestamp")).alias("event_timestamp"),
    )


def txn_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return txn_dirty_from(txn(spark, sf_dir))


def redelivered_from(t: DataFrame) -> DataFrame:
    """Bronze as a message bus delivers it: producer retries repeat some rows.

    Rows whose simulated broker lag is under 500 ms are delivered twice, so the
    dedup operators have real work on the whole table.
    """
    again = t.filter((F.col("transaction_id") * 37) % 5000 < 500)
    return t.unionByName(again)


def redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redelivered_from(txn(spark, sf_dir))


def card_from_txn(t: DataFrame) -> DataFrame:
    """Card-transaction record (reference entity E6) over the canonical view.

    Carries the event time as a real timestamp (``Trans_ts``) next to the text
    ``Trans_date`` so that silver and gold never lose it.
    """
    i, c = F.col("transaction_id"), F.col("customer_id")
    return t.select(
        i.alias("Trans_id"), c.alias("Clt_id"), (c * 10 + 1).alias("Card_id"),
        F.col("device_id").alias("Dev_id"),
        F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss").alias("Trans_date"),
        F.col("event_ts").alias("Trans_ts"),
        F.when(F.col("transaction_type") == "DEPOSIT", "Deposit")
         .when(F.col("transaction_type").isin("TRANSFER_IN", "TRANSFER_OUT"), "Transfer")
         .otherwise("Withdrawal").alias("Trans_type"),
        F.col("trans_status").alias("Trans_status"),
        F.col("amount").alias("Trans_amount"),
        F.col("currency_code").alias("Currency"),
        F.col("trans_ref_no").alias("Trans_Ref_No"),
        F.col("country_src").alias("Country_Src"),
        F.col("country_dest").alias("Country_Dest"),
        F.col("account_id_dest").cast("string").alias("Dest_account_No"),
        F.col("trans_destination").alias("Trans_destination"),
        F.when(i % 10 == 0, F.concat((i % 900 + 1).cast("string"), F.lit(" Nile Street")))
         .otherwise(F.concat(F.lit("10."), (c % 256).cast("string"), F.lit("."),
                             (i % 256).cast("string"), F.lit(".1"))).alias("Dev_Ip_Location"),
        F.col("trans_reason").alias("Trans_Reason"),
        F.col("merchant_category"), F.col("latitude"), F.col("longitude"),
    )


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return card_from_txn(txn(spark, sf_dir))
