"""Channel messages in full: 33 fields with text ids, malformed ones kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerhawk.streaming.sources import ENVELOPE_SCHEMA, JSON_OPTS, N_PARTITIONS, topic_of

# --- fixed values: the message's fields and types
TEXT_FIELDS = ("transaction_id", "idempotency_key", "correlation_id", "customer_id", "account_id_source", "account_id_dest",
               "channel_type", "channel_subtype", "device_id", "device_fingerprint", "device_type", "ip_address", "ip_country",
               "country_code", "city", "atm_id", "currency_code", "transaction_type", "merchant_id", "merchant_category",
               "merchant_country", "session_id", "auth_method")
OTHER_FIELDS = {"is_rooted_device": T.BooleanType(), "latitude": T.DoubleType(), "longitude": T.DoubleType(), "amount": T.DoubleType(),
                "amount_usd": T.DoubleType(), "event_timestamp": T.LongType(), "kafka_timestamp": T.LongType(), "local_hour": T.IntegerType(),
                "failed_auth_count": T.IntegerType(), "auth_success": T.BooleanType()}
# ----------------------------------------------------------
MESSAGE_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in TEXT_FIELDS] + [T.StructField(n, t) for n, t in OTHER_FIELDS.items()])
CORRUPT = "_malformed"
MALFORMED = "MALFORMED_JSON"


def to_messages(t: DataFrame) -> DataFrame:
    """Producer side: an envelope of whole messages; fields that ``t`` lacks are null."""
    fields = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in t.columns else F.lit(None).cast(f.dataType).alias(f.name)
              for f in MESSAGE_SCHEMA.fields]
    return t.select(
        F.col("transaction_id").cast("string").cast("binary").alias("key"), F.to_json(F.struct(*fields), JSON_OPTS).cast("binary").alias("value"),
        topic_of(F.col("channel_type")).alias("topic"), F.pmod(F.xxhash64("customer_id"), F.lit(N_PARTITIONS)).cast("int").alias("partition"),
        F.col("offset").cast("long").alias("offset"), F.timestamp_millis("kafka_timestamp").alias("timestamp")).select(*[f.name for f in ENVELOPE_SCHEMA.fields])


def decode_messages(envelope: DataFrame) -> DataFrame:
    """All fields of every message, the broker's time and place, and the text of what
    could not be read in ``CORRUPT``. No message is lost: one that is no JSON object, or that
    has a value of the wrong type, keeps what was readable. ``event_ts`` follows from the
    epoch."""
    schema = T.StructType([*MESSAGE_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    text = F.col("value").cast("string")
    data = F.from_json(text, schema, {**JSON_OPTS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    whole = envelope.select(data.alias("data"), text.alias("_text"), F.col("key").cast("string").alias("_key"), F.unix_millis("timestamp").alias("kafka_timestamp"),
                            F.col("offset").alias("kafka_offset"), F.col("partition").alias("kafka_partition"), "topic")
    unreadable = F.when(F.col("data").isNull() | F.col(f"data.{CORRUPT}").isNotNull() | F.col("_text").isNull() | (F.trim("_text") == ""), F.coalesce("_text", F.lit("")))
    return whole.select(*[F.col(f"data.{f.name}").alias(f.name) for f in MESSAGE_SCHEMA.fields if f.name != "kafka_timestamp"],
                        F.timestamp_millis("data.event_timestamp").alias("event_ts"), "kafka_timestamp", "kafka_offset", "kafka_partition", "topic",
                        F.col("_key").alias("message_key"), unreadable.alias(CORRUPT))


def readable(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def malformed_letters(decoded: DataFrame, failed_at_s: Column) -> DataFrame:
    """S17 for messages that cannot be read: their text as it came, under their key."""
    return decoded.where(F.col(CORRUPT).isNotNull()).select(
        F.coalesce("message_key", F.lit("unknown")).alias("key"), F.col(CORRUPT).alias("original_event"), F.lit(MALFORMED).alias("error"),
        failed_at_s.cast("long").alias("failed_at"))
