"""Latency metrics (L1-L3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerhawk.config import SLA_THRESHOLD_MS


def sla_metrics(df: DataFrame, ingest_col: str | None = "ingest_ms",
                threshold_ms: int = SLA_THRESHOLD_MS) -> DataFrame:
    """L1-L3. ``ingest_col`` names the processing time column (epoch ms); ``None``
    takes the current time, as a live stream does."""
    ingest = F.col(ingest_col) if ingest_col else F.unix_millis(F.current_timestamp())
    kafka, event = F.col("kafka_timestamp"), F.col("event_timestamp")
    total = ingest - event
    return df.withColumns({
        "source_to_kafka_lag_ms": F.when(kafka.isNotNull(), kafka - event).otherwise(F.lit(0).cast("long")),
        "kafka_to_spark_lag_ms": ingest - kafka,
        "total_pipeline_lag_ms": total,
        "sla_breached": total > F.lit(threshold_ms)})


def sla_breach_rate(df: DataFrame, by: str = "channel_type") -> DataFrame:
    """L3 report: breaches per group (map-side combined aggregate)."""
    return (df.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.when(F.col("sla_breached"), 1).otherwise(0)).cast("long").alias("breached"),
        F.max("total_pipeline_lag_ms").alias("max_lag_ms"))
        .withColumn("breach_rate", F.col("breached") / F.col("rows")))
