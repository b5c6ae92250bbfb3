"""Stateful streaming operators on ``transformWithState``.

State lives in the RocksDB state store, checkpointed with the query; a 24 h
TTL on the value state expires idle customers (T14). Rows of a key inside one
micro-batch are processed in (event time, id) order (X13).

The Row form of the API hands over a group's rows cell by cell and takes its outputs as
one Arrow batch a group, so the decision engine groups customers into ``GROUPS`` buckets,
with a map state by customer, and a row crosses as one JSON text: batches are large however
few rows a customer has. One state read and one write per customer and micro-batch.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ledgerhawk.config import DecisionParams
from ledgerhawk.streaming.step import CustomerState

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY_MS = 24 * 3600 * 1000

DECISION_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.LongType()), T.StructField("idempotency_key", T.StringType()),
    T.StructField("customer_id", T.LongType()), T.StructField("channel_type", T.StringType()),
    T.StructField("amount", T.DoubleType()), T.StructField("amount_usd", T.DoubleType()),
    T.StructField("event_timestamp", T.LongType()),
    T.StructField("source_to_kafka_lag_ms", T.LongType()), T.StructField("kafka_to_spark_lag_ms", T.LongType()),
    T.StructField("total_pipeline_lag_ms", T.LongType()), T.StructField("sla_breached", T.BooleanType()),
    T.StructField("dq_passed", T.BooleanType()), T.StructField("dq_violations", T.StringType()),
    T.StructField("completeness_score", T.DoubleType()), T.StructField("ml_risk_score", T.DoubleType()),
    T.StructField("ml_cluster_id", T.IntegerType()), T.StructField("amount_zscore", T.DoubleType()),
    T.StructField("geo_violation", T.StringType()), T.StructField("micro_structuring", T.BooleanType()),
    T.StructField("mule_account_flag", T.BooleanType()), T.StructField("cross_channel_violation", T.StringType()),
    T.StructField("composite_risk_score", T.DoubleType()), T.StructField("decision_action", T.StringType()),
    T.StructField("decision_reasons", T.StringType()), T.StructField("data_fingerprint", T.StringType()),
    T.StructField("processing_timestamp", T.LongType()), T.StructField("pipeline_version", T.StringType()),
])
INPUT_COLS = ("transaction_id", "idempotency_key", "customer_id", "channel_type", "transaction_type",
              "amount", "amount_usd", "event_timestamp", "latitude", "longitude", "country_code", "ip_country",
              "device_id", "is_rooted_device", "source_to_kafka_lag_ms", "kafka_to_spark_lag_ms",
              "total_pipeline_lag_ms", "sla_breached", "dq_passed", "dq_violations", "completeness_score",
              "processing_ms")


OUTPUT_NAMES = tuple(f.name for f in DECISION_SCHEMA.fields)
GROUPS = 2048                # buckets of customers; a checkpoint's state is laid out by them
DECISION = Row(*OUTPUT_NAMES)
NO_FIELDS = dict.fromkeys(INPUT_COLS)


def _time_order(r: dict):
    """(event time asc, nulls last; id)."""
    ts = r["event_timestamp"]
    return (ts is None, ts if ts is not None else 0, r["transaction_id"])


NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"
_BEFORE: dict = {}


def restore_settings(spark) -> None:
    """Undo what ``use_rocksdb`` changed for one query, once it has started."""
    if NO_DATA in _BEFORE:
        spark.conf.set(NO_DATA, _BEFORE.pop(NO_DATA))


def use_rocksdb(spark, timers: bool = False) -> None:
    """transformWithState needs the RocksDB provider; set before the query starts.

    No-data micro-batches are off: with processing-time TTL they would otherwise
    be scheduled back to back while state exists (an ``availableNow`` run would
    never finish); expired state is evicted on the next data batch instead. With
    event-time ``timers`` they are on: one follows when the watermark has moved."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    if NO_DATA not in _BEFORE:
        _BEFORE[NO_DATA] = spark.conf.get(NO_DATA, "true")
    spark.conf.set(NO_DATA, str(timers).lower())
    # commit = upload this batch's changes only; snapshots are made in the
    # background maintenance task (a full snapshot per batch dominated commits)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


class DecisionProcessor(StatefulProcessor):
    """The per-customer decision engine as a stateful processor over buckets of
    customers. A bucket's rows of one micro-batch are held at a time."""

    def __init__(self, params: DecisionParams = DecisionParams(), ttl_ms: int | None = DAY_MS, key_schema: str = "customer_id bigint"):
        self.params, self.ttl_ms, self.key_schema = params, ttl_ms, key_schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.states = handle.getMapState("customers", self.key_schema, "state string", self.ttl_ms)   # as JSON

    def handleInputRows(self, key, rows, timerValues):
        own: dict = {}
        for r in rows:
            rec = {**NO_FIELDS, **json.loads(r["row"])}
            own.setdefault(rec["customer_id"], []).append(rec)
        now_ms = int(time.time() * 1000)
        for customer, recs in own.items():
            recs.sort(key=_time_order)
            stored = self.states.getValue((customer,))
            st = CustomerState(json.loads(stored[0]) if stored else None)
            out = [st.step(r, self.params, now_ms) for r in recs]
            self.states.updateValue((customer,), (json.dumps(st.to_list()),))
            for d in out:
                yield DECISION(*[d[n] for n in OUTPUT_NAMES])

    def close(self) -> None:
        pass


def _as_text(df: DataFrame) -> Column:
    """A row as JSON, as exactly as in columns: decimals as text (any precision), NaN as null."""
    def plain(f):
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("string")
        return F.nanvl(f.name, F.lit(None)) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
    return F.to_json(F.struct(*[plain(f).alias(f.name) for f in df.schema.fields]))


def stream_decisions(clean: DataFrame, params: DecisionParams = DecisionParams(),
                     processing_ms: str | None = None) -> DataFrame:
    """Run the engine on the clean, on-time stream by bucket of customers (append mode:
    each input row yields its final decision once)."""
    use_rocksdb(clean.sparkSession)
    proc = F.col(processing_ms) if processing_ms else F.lit(None).cast("long")
    cols = [F.col(c) if c in clean.columns else F.lit(None).alias(c) for c in INPUT_COLS if c != "processing_ms"]
    x = clean.select(*cols, proc.alias("processing_ms"))
    # ids and countries may be numbers or text: results and the state's keys take their types over
    kinds = {c: clean.schema[c].dataType for c in ("transaction_id", "customer_id")}
    out = T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in DECISION_SCHEMA.fields])
    keys = f"customer_id {kinds['customer_id'].simpleString()}"
    packed = x.select(F.pmod(F.xxhash64("customer_id"), F.lit(GROUPS)).cast("int").alias("bucket"), _as_text(x).alias("row"))
    return packed.groupBy("bucket").transformWithState(
        statefulProcessor=DecisionProcessor(params, key_schema=keys), outputStructType=out,
        outputMode="Append", timeMode="ProcessingTime")


class TimeSinceLastProcessor(StatefulProcessor):
    """T16 stream: seconds since the client's previous transaction across batches.
    State is kept for good unless ``ttl_ms`` is given."""

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last_ts", "last_us long", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        recs = sorted(((r["event_us"], r["transaction_id"]) for r in rows),
                      key=lambda t: (t[0] is None, t[0] if t[0] is not None else 0, t[1]))
        stored = self.last.get()
        last = stored[0] if stored else None
        out = []
        for cur, tid in recs:
            out.append(Row(transaction_id=tid, time_since_last_trans=(
                (cur - last) / 1_000_000.0 if last is not None and cur is not None else 0.0)))
            last = cur
        self.last.update((last,))
        yield from out

    def close(self) -> None:
        pass


def stream_time_since_last(decoded: DataFrame, key: str = "customer_id", ttl_ms: int | None = None) -> DataFrame:
    """T16 of a decoded stream; ``ttl_ms`` of processing time bounds the state, after
    which a key's next row counts as its first."""
    use_rocksdb(decoded.sparkSession)
    x = decoded.select(key, "transaction_id", F.unix_micros("event_ts").alias("event_us"))
    return x.groupBy(key).transformWithState(
        statefulProcessor=TimeSinceLastProcessor(ttl_ms),
        outputStructType="transaction_id long, time_since_last_trans double",
        outputMode="Append", timeMode="ProcessingTime")
