"""Alert payloads and keyed message shaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerhawk.config import ALERT_TYPE, ALERTS_TOPIC, DECISIONS_TOPIC, REVIEW_URL_BASE

JSON_OPTS = {"ignoreNullFields": "false"}


def alert_payload(decisions: DataFrame, generated_at: Column | None = None,
                  url_base: str = REVIEW_URL_BASE) -> DataFrame:
    """BLOCK/FLAG_WAIT rows with a JSON payload of 11 fields.

    Generation time and URL base are parameters so a batch re-run is repeatable."""
    gen = generated_at if generated_at is not None else F.current_timestamp().cast("string")
    return (decisions.filter(F.col("decision_action").isin("BLOCK", "FLAG_WAIT"))
                     .withColumn("alert_payload", F.to_json(F.struct(
                         F.lit(ALERT_TYPE).alias("alert_type"), "transaction_id", "customer_id", "channel_type",
                         "amount", "composite_risk_score", "decision_action", "decision_reasons",
                         "data_fingerprint", gen.alias("alert_generated_at"),
                         F.concat(F.lit(url_base), F.col("transaction_id").cast("string")).alias("review_url")),
                         JSON_OPTS)))


def decision_messages(decisions: DataFrame, topic: str = DECISIONS_TOPIC) -> DataFrame:
    """(key, value, topic) rows for the decisions topic."""
    return decisions.select(
        F.col("transaction_id").cast("string").alias("key"),
        F.to_json(F.struct("transaction_id", "idempotency_key", "customer_id", "decision_action",
                           "composite_risk_score", "decision_reasons", "data_fingerprint",
                           "processing_timestamp"), JSON_OPTS).alias("value"),
        F.lit(topic).alias("topic"))


def alert_messages(alerts: DataFrame, topic: str = ALERTS_TOPIC) -> DataFrame:
    """Alerts keyed by customer."""
    return alerts.select(F.col("customer_id").cast("string").alias("key"),
                         F.col("alert_payload").alias("value"), F.lit(topic).alias("topic"))


def dlq_envelope(rejected: DataFrame, failed_at_s: Column, fields=None) -> DataFrame:
    """Original event as JSON text, error message, epoch seconds,
    key = id or 'unknown'."""
    fields = fields or [c for c in rejected.columns if c not in ("dq_violations", "dq_passed", "completeness_score")]
    return rejected.select(
        F.coalesce(F.col("transaction_id").cast("string"), F.lit("unknown")).alias("key"),
        F.to_json(F.struct(*fields), JSON_OPTS).alias("original_event"),
        F.col("dq_violations").alias("error"),
        failed_at_s.cast("long").alias("failed_at"))


def gold_suspect_alerts(silver: DataFrame) -> DataFrame:
    """Alerts table from flagged rows."""
    return silver.filter(F.col("suspect_flag") == 1)
