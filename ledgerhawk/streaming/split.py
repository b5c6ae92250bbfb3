"""The decision stream with hot customers in several tasks.

Keyed state gives a customer to one task per micro-batch. Here a micro-batch goes through the
batch engine instead, from the customers' states before it (``operators.continued``): a
customer above ``SplitParams.hot_rows`` rows of a micro-batch is cut into segments that run
side by side. Meant for large micro-batches, such as a backlog that is caught up with: each
reads the states of its customers from a keyed table (``levels``), which a scan of that
table pays for; ``stateful`` is the form for small ones.

A micro-batch writes its decisions, then its states as one version. Replayed, it finds
either its own version and does nothing, or the version before and starts again.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerhawk.config import DecisionParams, StreamParams
from ledgerhawk.operators import continued
from ledgerhawk.operators.latency import sla_metrics
from ledgerhawk.operators.quality import dq_validate
from ledgerhawk.operators.segments import SEG, SplitParams
from ledgerhawk.operators.sequence import decide
from ledgerhawk.streaming import sinks as sk
from ledgerhawk.streaming.files import read_runs
from ledgerhawk.streaming.jobs import parsed_stream, run_foreach_batch
from ledgerhawk.streaming.levels import Serving
from ledgerhawk.streaming.stateful import DAY_MS

SEEN = "seen_ms"


def states_of(table: Serving, customers: DataFrame, now_ms: int, ttl_ms: int | None) -> DataFrame | None:
    """States of ``customers`` that were written within ``ttl_ms``; None before the first."""
    known = table.read()
    if known is None:
        return None
    known = known if ttl_ms is None else known.where(F.col(SEEN) >= now_ms - ttl_ms)
    return known.join(customers, "customer_id", "left_semi").drop(SEEN)


def decide_batch(rows: DataFrame, batch_id: int, root: str, params: DecisionParams = DecisionParams(), ingest_col: str | None = "ingest_ms",
                 split: SplitParams = SplitParams(), ttl_ms: int | None = DAY_MS, now_ms: int | None = None) -> None:
    """Decisions of one micro-batch of clean, on-time rows and the states after it."""
    spark = rows.sparkSession
    table = Serving(spark, f"{root}/state", key="customer_id", version=SEEN)
    if table.holds(batch_id):
        return
    now_ms = int(time.time() * 1000) if now_ms is None else now_ms
    kind = continued.state_type(rows)
    base = states_of(table, rows.select("customer_id").distinct(), now_ms, ttl_ms)
    if base is not None:
        base = base.checkpoint()                    # read several times; a row a customer
    decided = decide(rows, params, F.col(ingest_col) if ingest_col else F.lit(now_ms), split=split, base=base, keep_state=True)
    sk.write_batch(decided, f"{root}/decisions", batch_id)
    stored = read_runs(spark, f"{root}/decisions", [f"{root}/decisions/batch_id={int(batch_id)}"], decided.schema)
    table.upsert(continued.states(stored, kind).withColumn(SEEN, F.lit(now_ms).cast("long")), batch_id)


def read_decisions(spark: SparkSession, root: str) -> DataFrame:
    """Decisions of all micro-batches, one cut short included until it is run again."""
    return sk.read_log(spark, f"{root}/decisions").drop("batch_id", SEG, continued.END, continued.EXIT)


def split_decisions(spark: SparkSession, env_path: str, root: str, params: DecisionParams = DecisionParams(), ingest_col: str | None = "ingest_ms",
                    split: SplitParams = SplitParams(), ttl_ms: int | None = DAY_MS, rate: StreamParams = StreamParams(), drain: bool = True):
    """Source -> decode -> DQ -> clean -> SLA -> on time -> the batch engine from stored states."""
    def run(batch: DataFrame, batch_id: int) -> None:
        on_time = sla_metrics(dq_validate(batch).filter("dq_passed"), ingest_col).filter(~F.col("sla_breached")).persist()
        decide_batch(on_time, batch_id, root, params, ingest_col, split, ttl_ms)
        on_time.unpersist()
    return run_foreach_batch(parsed_stream(spark, env_path, rate), run, f"{root}/_ckpt", trigger_seconds=None if drain else rate.trigger_of("decisions"))
