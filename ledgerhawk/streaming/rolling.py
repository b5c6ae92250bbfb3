"""Rolling features as a stream, with state that event time expires.

A customer's last day is minute buckets, at most 1,440 beyond the watermark's delay however
many transactions there are; the last amounts are a list of ten. Both are one value, read
and written once a customer and micro-batch: each call to the state store costs more than a
row. An event-time
timer stands at the moment the oldest bucket leaves the day and drops all that have left by
the watermark, so a customer who stops trading is cleared from the state without a row of
theirs arriving. A total covers the whole minutes of the window and, of the row's own
minute, the rows up to it.
"""

from __future__ import annotations

import json
from itertools import groupby

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ledgerhawk import config as C
from ledgerhawk.config import StreamParams
from ledgerhawk.streaming.stateful import use_rocksdb

MINUTE_MS = 60_000
STATE = "minutes array<long>, ins array<long>, outs array<long>, n array<long>, amounts array<long>, due long"
FIELDS = ("transaction_id", "ts", "cents", "in_cents", "out_cents")
READS = ("transaction_id", "customer_id", "transaction_type", "amount", "amount_usd", "event_ts")
OUTPUT = "transaction_id long, total_in_24h double, total_out_24h double, txn_count_1h long, last_txn_amounts string"


def _money(cents: int) -> str:
    return f"{'-' if cents < 0 else ''}{abs(cents) // 100}.{abs(cents) % 100:02d}"


class RollingProcessor(StatefulProcessor):
    """Rows of a customer in (event time, id) order; rows without a time get no totals and
    change nothing. ``keep_amounts``: the last amounts outlive the day's buckets."""

    def __init__(self, day: int = 1440, hour: int = 60, last_n: int = 10, keep_amounts: bool = True):
        self.day, self.hour, self.last_n, self.keep_amounts = day, hour, last_n, keep_amounts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("buckets", STATE)

    def _read(self, watermark_ms: int):
        """Buckets still in the day, the last amounts, and the moment of the timer."""
        stored = self.state.get()
        if stored is None:
            return {}, [], None
        minutes, ins, outs, n, last, due = stored
        held = {m: v for m, *v in zip(minutes, ins, outs, n) if (m + self.day) * MINUTE_MS > watermark_ms}
        return held, list(last), due

    def _write(self, held: dict, last: list, due: int | None, fired: int | None = None) -> None:
        """One write, and one timer a customer, for the oldest bucket."""
        if not held and not (last and self.keep_amounts):
            self.state.clear()
            return
        new = (min(held) + self.day) * MINUTE_MS if held else None
        if new != due or due == fired:
            if due is not None and due != fired:
                self.handle.deleteTimer(due)
            if new is not None:
                self.handle.registerTimer(new)
        columns = zip(*((m, *held[m]) for m in held)) if held else ((), (), (), ())
        self.state.update((*map(list, columns), last, new))

    def handleInputRows(self, key, rows, timerValues):
        recs = sorted((dict(zip(FIELDS, json.loads(r["row"]))) for r in rows), key=lambda r: (r["ts"] is not None, r["ts"] or 0, r["transaction_id"]))
        held, last, due = self._read(timerValues.getCurrentWatermarkInMs())
        touched = False
        for minute, own in groupby(recs, key=lambda r: None if r["ts"] is None else r["ts"] // MINUTE_MS):
            if minute is None:
                for r in own:
                    yield Row(transaction_id=r["transaction_id"], total_in_24h=None, total_out_24h=None, txn_count_1h=None, last_txn_amounts=None)
                continue
            before = [v for m, v in held.items() if minute - self.day < m < minute]
            ins, outs = sum(v[0] for v in before), sum(v[1] for v in before)
            hour = sum(v[2] for m, v in held.items() if minute - self.hour < m < minute)
            here = list(held.get(minute, (0, 0, 0)))
            for _, peers in groupby(own, key=lambda r: r["ts"]):
                peers = list(peers)
                for r in peers:
                    here = [here[0] + r["in_cents"], here[1] + r["out_cents"], here[2] + 1]
                for r in peers:
                    last = [*last, r["cents"]][-self.last_n:]
                    yield Row(transaction_id=r["transaction_id"], total_in_24h=(ins + here[0]) / 100.0, total_out_24h=(outs + here[1]) / 100.0,
                              txn_count_1h=hour + here[2], last_txn_amounts=",".join(map(_money, last)))
            held[minute] = here
            touched = True
        if touched:
            self._write(held, last, due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held, last, due = self._read(timerValues.getCurrentWatermarkInMs())
        self._write(held, last, due, expiredTimerInfo.getExpiryTimeInMs())
        return iter(())

    def close(self) -> None:
        pass


def stream_rolling_features(decoded: DataFrame, watermark: str = StreamParams().watermark, keep_amounts: bool = True) -> DataFrame:
    """T17 of a decoded stream, by customer; late rows beyond the watermark are dropped."""
    use_rocksdb(decoded.sparkSession, timers=True)
    usd = (F.coalesce("amount_usd", F.lit(0)).cast("decimal(18,2)") * 100).cast("long")
    kind = F.col("transaction_type")
    x = decoded.withWatermark("event_ts", watermark).withColumns({
        "ts": F.unix_millis("event_ts"), "cents": (F.coalesce("amount", F.lit(0)).cast("decimal(18,2)") * 100).cast("long"),
        "in_cents": F.when(kind.isin(*C.INBOUND_TYPES), usd).otherwise(0), "out_cents": F.when(kind.isin(*C.OUTBOUND_TYPES), usd).otherwise(0)})
    x = x.select("customer_id", F.to_json(F.array(*[F.col(c).cast("long") for c in FIELDS])).alias("row"), "event_ts")   # one cell a row to Python
    return x.groupBy("customer_id").transformWithState(
        statefulProcessor=RollingProcessor(keep_amounts=keep_amounts), outputStructType=OUTPUT, outputMode="Append", timeMode="EventTime")


def live_state(spark: SparkSession, checkpoint: str, variable: str = "buckets") -> DataFrame:
    """The buckets in the state after the last micro-batch of a stopped query, a row each."""
    stored = spark.read.format("statestore").option("stateVarName", variable).load(checkpoint)
    each = F.explode(F.arrays_zip("value.minutes", "value.ins", "value.outs", "value.n"))
    return stored.select("key", each.alias("value"), "partition_id")
