"""Idempotent keyed sinks for ``foreachBatch`` (S11, S12) and plain file sinks.

Without a table format, exactly-once comes from two facts: a micro-batch id is
replayed with the same data after a failure, and every batch writes only its
own directory ``batch_id=<n>`` in overwrite mode. A replay therefore replaces
its own earlier partial output and never duplicates rows.

* keyed serving rows (S11): levels of sorted runs with committed versions (``levels``);
* insert-if-absent gold (S12): only key files that may hold a key of the batch are
  opened (``keyindex``), then the batch is written partitioned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerhawk.streaming.files import folders, path_exists, read_runs
from ledgerhawk.streaming.keyindex import BUCKETS, FAN, KeyIndex
from ledgerhawk.streaming.levels import Serving


def write_batch(df: DataFrame, path: str, batch_id: int, partition_cols=()) -> None:
    """Overwrite exactly this batch's directory (idempotent on replay)."""
    w = df.write.mode("overwrite")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(f"{path}/batch_id={int(batch_id)}")


def read_log(spark: SparkSession, path: str) -> DataFrame | None:
    if not path_exists(spark, path):
        return None
    return spark.read.option("basePath", path).parquet(path)


def serving_rows(decisions: DataFrame, by_customer_time: bool = False) -> DataFrame:
    """S11 cells: row key, JSON data, decision, score, fingerprint. The key is the
    idempotency key or, for a customer's history, ``customer_id_timestamp``."""
    key = F.concat_ws("_", F.col("customer_id").cast("string"), F.col("event_timestamp").cast("string")) if by_customer_time \
        else F.col("idempotency_key")
    return decisions.select(
        key.alias("row_key"),
        F.to_json(F.struct(*decisions.columns)).alias("data"),
        F.col("decision_action").alias("decision"),
        F.col("composite_risk_score").alias("risk_score"),
        F.col("data_fingerprint").alias("fingerprint"),
        F.col("processing_timestamp").alias("version_ts"))


def rule_alert_rows(alerts: DataFrame, version_ts: int) -> DataFrame:
    """S11, second table: alerts of the batch rules by customer, transaction or window
    start (epoch seconds), and reason."""
    when = F.coalesce(F.col("transaction_id"), F.unix_seconds(F.col("window_start").cast("timestamp")))
    return alerts.select(
        F.concat_ws("_", F.col("customer_id").cast("string"), when.cast("string"), "suspect_reason").alias("row_key"),
        *alerts.columns, F.lit(version_ts).cast("long").alias("version_ts"))


def upsert_batch(batch: DataFrame, path: str, batch_id: int, **how) -> None:
    """S11 write side: the batch becomes a run of its newest row a key. Rows without a key
    are no versions of each other: all are kept."""
    Serving(batch.sparkSession, path, **how).upsert(batch, batch_id)


def read_serving(spark: SparkSession, path: str) -> DataFrame:
    """S11 read side: latest row per key across all batches (repeated key overwrites)."""
    return Serving(spark, path).read()


def merge_insert_batch(spark: SparkSession, batch: DataFrame, path: str, batch_id: int, key: str,
                       partition_cols=("decision_action",), buckets: int = BUCKETS, fan: int = FAN) -> list[str]:
    """Insert rows whose key is not stored yet (MERGE ... WHEN NOT MATCHED INSERT).
    Of rows with one key the least by all its columns goes in, so a replay chooses alike;
    rows without a key match nothing and all go in. Returns the key folders it opened."""
    cols = [c for c in batch.columns if c != key]
    order = F.xxhash64(*[F.col(c) for c in cols])
    keyed = (batch.filter(F.col(key).isNotNull()).groupBy(key)
                  .agg(F.min_by(F.struct(*cols), order).alias("r")).select(key, "r.*").select(*batch.columns)).persist()
    index = KeyIndex(spark, f"{path}/_keys", batch.schema[key].dataType, buckets, fan)
    runs = index.runs()
    for stored in sorted(int(n.partition("=")[2]) for n in folders(spark, path) if n.startswith("batch_id=")):
        if stored < batch_id and not any(r.low <= stored <= r.high for r in runs):       # written without its keys
            index.add(stored, stored, _stored_keys(spark, path, stored, key, batch.schema))
    known, opened = index.known(keyed.select(F.col(key).alias("k")), batch_id)
    fresh = keyed if known is None else keyed.join(known.withColumnRenamed("k", key), key, "left_anti")
    fresh = fresh.select(*batch.columns).unionByName(batch.filter(F.col(key).isNull()))
    write_batch(fresh, path, batch_id, partition_cols)
    index.add(batch_id, batch_id, _stored_keys(spark, path, batch_id, key, batch.schema))
    index.compact(batch_id)
    keyed.unpersist()
    return opened


def _stored_keys(spark: SparkSession, path: str, batch_id: int, key: str, schema) -> DataFrame:
    return read_runs(spark, path, [f"{path}/batch_id={batch_id}"], schema).where(F.col(key).isNotNull()).select(F.col(key).alias("k"))


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """Gold table with schema merge across batches (reference: mergeSchema)."""
    return (spark.read.option("mergeSchema", "true").option("basePath", path).parquet(path)
                 .drop("batch_id"))
