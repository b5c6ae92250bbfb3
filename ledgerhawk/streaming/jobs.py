"""Streaming queries: wiring of sources, operators and sinks (S1-S3, S7, S8,
S13, S14, C2, W1-W7, T15, T16).

Triggers are parameters (``processingTime`` in production, ``availableNow`` in
tests and backfills). Every query has its own checkpoint folder under the
shared scratch root taken from ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerhawk.config import DecisionParams, StreamParams
from ledgerhawk.operators import alerts as al
from ledgerhawk.operators import centres as cm
from ledgerhawk.operators import learn as ml
from ledgerhawk.operators.latency import sla_metrics
from ledgerhawk.operators.quality import dq_validate
from ledgerhawk.streaming import sinks as sk
from ledgerhawk.streaming.messages import decode_messages, malformed_letters, readable
from ledgerhawk.streaming.sources import decode, envelope_stream, fields_of, raw_landing
from ledgerhawk.streaming.stateful import restore_settings, stream_decisions


def _trigger(w, trigger_seconds: int | None):
    return w.trigger(availableNow=True) if trigger_seconds is None else \
        w.trigger(processingTime=f"{trigger_seconds} seconds")


def _started(w, spark: SparkSession, trigger_seconds: int | None):
    """Start, wait if it only drains, and undo settings made for this query alone."""
    try:
        q = _trigger(w, trigger_seconds).start()
    finally:
        restore_settings(spark)
    if trigger_seconds is None:
        q.awaitTermination()
    return q


def run_to_files(stream: DataFrame, out: str, ckpt: str, fmt: str = "parquet", partition_cols=(),
                 mode: str = "append", trigger_seconds: int | None = None, options: dict | None = None):
    """File sink (S7, S8, S13, S14). With ``trigger_seconds=None`` it drains what
    is available and returns; otherwise it returns the running query."""
    w = (stream.writeStream.format(fmt).option("path", out).option("checkpointLocation", ckpt)
               .outputMode(mode))
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    return _started(w, stream.sparkSession, trigger_seconds)


def run_foreach_batch(stream: DataFrame, fn, ckpt: str, mode: str = "append",
                      trigger_seconds: int | None = None):
    w = stream.writeStream.foreachBatch(fn).option("checkpointLocation", ckpt).outputMode(mode)
    return _started(w, stream.sparkSession, trigger_seconds)


# ---------------------------------------------------------------- pipelines
def parsed_stream(spark: SparkSession, env_path: str, rate: StreamParams = StreamParams(), fields=None) -> DataFrame:
    """Decoded rows; with ``fields`` only those of the message."""
    env = envelope_stream(spark, env_path, rate)
    return decode(env) if fields is None else decode(env, fields_of(*fields))


def message_stream(spark: SparkSession, env_path: str, rate: StreamParams = StreamParams()) -> DataFrame:
    """S2 with the whole schema; what cannot be read stays in it, marked."""
    return decode_messages(envelope_stream(spark, env_path, rate))


def message_fanout(spark: SparkSession, env_path: str, root: str, ingest_s=None, rate: StreamParams = StreamParams(), drain: bool = True):
    """Readable messages and, as dead letters (S17), the others, from one read."""
    def fan(batch: DataFrame, batch_id: int) -> None:
        b = batch.persist()
        sk.write_batch(readable(b), f"{root}/messages", batch_id)
        sk.write_batch(malformed_letters(b, F.unix_timestamp() if ingest_s is None else F.lit(ingest_s)), f"{root}/dlq", batch_id)
        b.unpersist()
    return run_foreach_batch(message_stream(spark, env_path, rate), fan, f"{root}/_ckpt/messages",
                             trigger_seconds=None if drain else rate.trigger_of("bronze", "dlq"))


def decision_stream(spark: SparkSession, env_path: str, params: DecisionParams = DecisionParams(),
                    ingest_col: str | None = "ingest_ms", rate: StreamParams = StreamParams()) -> DataFrame:
    """Source -> decode -> DQ -> clean -> SLA -> on time -> stateful engine."""
    return decide_parsed(parsed_stream(spark, env_path, rate), params, ingest_col)


def decide_parsed(parsed: DataFrame, params: DecisionParams = DecisionParams(), ingest_col: str | None = "ingest_ms") -> DataFrame:
    """The rest of the decision stream, from decoded rows with ids of any type."""
    clean = dq_validate(parsed).filter("dq_passed")
    on_time = sla_metrics(clean, ingest_col).filter(~F.col("sla_breached"))
    return stream_decisions(on_time, params, processing_ms=ingest_col)


def landing_fanout(spark: SparkSession, env_path: str, root: str, ingest_col: str | None = "ingest_ms",
                   rate: StreamParams = StreamParams(), drain: bool = True):
    """W6 part 1 (stateless sinks, one read of the source): bronze by channel,
    dead letters (S13) and SLA archive (S14) from one persisted micro-batch. With
    ``drain`` it ends with what is there, else it runs at its sinks' interval (W4)."""
    def fan(batch: DataFrame, batch_id: int) -> None:
        b = dq_validate(batch).persist()
        sk.write_batch(b.select(*batch.columns), f"{root}/bronze", batch_id, ("channel_type",))      # decoded once
        sk.write_batch(b.filter(~F.col("dq_passed")), f"{root}/dlq", batch_id)
        timed = sla_metrics(b.filter("dq_passed"), ingest_col)
        sk.write_batch(timed.filter("sla_breached"), f"{root}/archive", batch_id)
        b.unpersist()
    return run_foreach_batch(parsed_stream(spark, env_path, rate), fan, f"{root}/_ckpt/landing",
                             trigger_seconds=None if drain else rate.trigger_of("bronze", "dlq", "archive"))


def decision_fanout(spark: SparkSession, env_path: str, root: str, params: DecisionParams = DecisionParams(),
                    ingest_col: str | None = "ingest_ms", rate: StreamParams = StreamParams(), drain: bool = True):
    """W5/W6 part 2: the stateful decision stream (append) feeds decisions topic
    rows (S9), alerts (N1/S10), keyed serving rows (S11) and the gold merge (S12)
    from one persisted micro-batch, instead of four queries recomputing state."""
    def fan(batch: DataFrame, batch_id: int) -> None:
        d = batch.persist()
        sk.write_batch(al.decision_messages(d), f"{root}/decisions", batch_id)
        alerts = al.alert_payload(d, F.col("processing_timestamp").cast("string"))
        sk.write_batch(al.alert_messages(alerts), f"{root}/alerts", batch_id)
        sk.upsert_batch(sk.serving_rows(d), f"{root}/serving", batch_id)
        sk.merge_insert_batch(d.sparkSession, d, f"{root}/gold", batch_id, "idempotency_key")
        d.unpersist()
    return run_foreach_batch(decision_stream(spark, env_path, params, ingest_col, rate), fan, f"{root}/_ckpt/decisions",
                             trigger_seconds=None if drain else rate.trigger_of("decisions", "alerts", "serving", "gold"))


def scored_decisions(spark: SparkSession, env_path: str, models: str, out: str, ckpt: str, weight: float = 0.0,
                     params: DecisionParams = DecisionParams(), ingest_col: str | None = "ingest_ms",
                     rate: StreamParams = StreamParams(), drain: bool = True):
    """ML6/ML9 in the decision stream: every micro-batch is scored and blended with the
    newest model version below ``models`` at that time."""
    def score(batch: DataFrame, batch_id: int) -> None:
        model = cm.newest(batch.sparkSession, models)
        scored = cm.score(batch.drop("ml_risk_score", "ml_cluster_id"), model, cm.decision_inputs())
        sk.write_batch(ml.blend(scored, weight, params.block_pct, params.flag_pct), out, batch_id)
    return run_foreach_batch(decision_stream(spark, env_path, params, ingest_col, rate), score, ckpt,
                             trigger_seconds=None if drain else rate.trigger_of("decisions"))


def stream_dedup(parsed: DataFrame, watermark: str = StreamParams().watermark) -> DataFrame:
    """Watermark first, then dedup within it (bounded state)."""
    return parsed.withWatermark("event_ts", watermark).dropDuplicatesWithinWatermark(["transaction_id"])


def stream_velocity_counts(parsed: DataFrame, watermark: str = StreamParams().watermark) -> DataFrame:
    """Hourly tumbling counts per client with a watermark."""
    return (parsed.withWatermark("event_ts", watermark)
                  .groupBy("customer_id", F.window("event_ts", "1 hour").alias("w"))
                  .agg(F.count(F.lit(1)).alias("txn_count")))


def upsert_window_counts(path: str):
    """Update-mode window counts -> per-batch log; readers take the latest per window."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        sk.write_batch(batch.select("customer_id", F.col("w.start").alias("window_start"),
                                    F.col("w.end").alias("window_end"), "txn_count"), path, batch_id)
    return fn


def read_window_counts(spark: SparkSession, path: str) -> DataFrame:
    log = sk.read_log(spark, path)
    return (log.groupBy("customer_id", "window_start")
               .agg(F.max_by(F.struct("window_end", "txn_count"), F.col("batch_id")).alias("r"))
               .select("customer_id", "window_start", "r.window_end", "r.txn_count"))


def landing_stream(spark: SparkSession, env_path: str, rate: StreamParams = StreamParams()) -> DataFrame:
    """S3 raw landing stream."""
    return raw_landing(envelope_stream(spark, env_path, rate))


def upsert_batch_sizes(path: str):
    """Rows of every micro-batch, one row a batch."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        sk.write_batch(batch.agg(F.count(F.lit(1)).alias("rows")), path, batch_id)
    return fn
