"""Work that must not grow faster than the input: what is read once, written in bounded
files, and crosses to Python in few calls."""

import json
import os

from pyspark.sql import functions as F

from ledgerhawk.operators import sequence as seq
from ledgerhawk.streaming import levels
from ledgerhawk.streaming import sources as ss
from ledgerhawk.streaming import stateful as sf
from ledgerhawk.streaming.rolling import RollingProcessor


def _files(path):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))


def _rows(spark, n=100):
    return spark.range(n).select(F.col("id").alias("transaction_id"), (F.col("id") % 7).alias("customer_id"), F.lit("ATM").alias("channel_type"),
                                 F.lit(1.5).cast("decimal(12,2)").alias("amount"), (F.lit(1704067200000) + F.col("id")).alias("kafka_timestamp"))


def test_envelope_files_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ss, "FILE_ROWS", 10)
    parts = list(ss.envelope_slices(spark, _rows(spark).coalesce(1), str(tmp_path / "env"), ()))
    assert len(_files(parts[0])) == 10 and spark.read.parquet(parts[0]).count() == 100


def test_only_the_named_fields_are_decoded(spark):
    env = ss.to_envelope(_rows(spark))
    names = ("transaction_id", "channel_type", "amount")
    few, whole = ss.decode(env, ss.fields_of(*names)), ss.decode(env)
    assert "customer_id" not in few.columns
    assert few.select(*names).exceptAll(whole.select(*names)).isEmpty() and few.count() == 100


def test_one_file_a_value_without_a_sort(spark, tmp_path):
    path, name = str(tmp_path / "out"), "spark.sql.maxConcurrentOutputFileWriters"
    ss.write_one_file_a_value(_rows(spark).withColumn("file", F.col("transaction_id") % 3), path, "file", 3)
    assert len(_files(path)) == 3 and spark.conf.get(name) == "0"
    assert sorted(r["count"] for r in spark.read.parquet(path).groupBy("file").count().collect()) == [33, 33, 34]


def test_a_run_reads_its_batch_once(spark):
    rows = spark.createDataFrame([("a", 1, "p"), ("a", 2, "q"), (None, 1, "r"), (None, 1, "r"), ("b", 1, "s")], "row_key string, version_ts long, data string")
    once = levels.newest(levels.placed(rows, "row_key"), "row_key", ["version_ts"], levels.PLACE)
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and plan.split("+- == Initial Plan ==")[-1].count("Exchange") == 1
    assert sorted((r["row_key"] or "", r["data"]) for r in once.collect()) == [("", "r"), ("", "r"), ("a", "q"), ("b", "s")]


def test_the_fold_gets_only_what_is_read(spark):
    t = _rows(spark).selectExpr("*", "amount AS amount_usd", "kafka_timestamp AS event_timestamp", "'DEPOSIT' AS transaction_type", "CAST(1 AS DOUBLE) AS latitude",
                                "CAST(1 AS DOUBLE) AS longitude", "1L AS country_code", "1L AS ip_country", "'d' AS device_id", "false AS is_rooted_device",
                                "concat('IK-', transaction_id) AS idempotency_key", "3 AS local_hour", "'wide' AS merchant_category")
    few, whole = seq.decide(t, keep_features=("amount_usd", "local_hour")), seq.decide(t, keep_features=True)
    assert "merchant_category" in whole.columns and "merchant_category" not in few.columns
    cols = ("transaction_id", "amount", "amount_usd", "local_hour", "amount_zscore", "decision_action")
    assert few.select(*cols).exceptAll(whole.select(*cols)).isEmpty() and few.count() == 100


def test_a_row_crosses_as_one_exact_text(spark):
    rows = spark.sql("SELECT 'x' AS customer_id, CAST('1234567890123456789012.345678' AS DECIMAL(38,6)) AS amount, double('NaN') AS latitude, 0.1D AS longitude, 9007199254740993L AS n")
    got = json.loads(rows.select(sf._as_text(rows).alias("row")).first()["row"])
    assert got == {"customer_id": "x", "amount": "1234567890123456789012.345678", "longitude": 0.1, "n": 9007199254740993}


class _Value:
    def __init__(self):
        self.stored, self.calls = None, 0

    def get(self):
        self.calls += 1
        return self.stored

    def update(self, value):
        self.calls, self.stored = self.calls + 1, value

    def clear(self):
        self.calls, self.stored = self.calls + 1, None


class _Handle:
    def __init__(self):
        self.value, self.timers = _Value(), []

    def getValueState(self, name, schema, ttl=None):
        return self.value

    def registerTimer(self, at):
        self.timers.append(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


class _Clock:
    def __init__(self, watermark):
        self.watermark = watermark

    def getCurrentWatermarkInMs(self):
        return self.watermark

    getExpiryTimeInMs = getCurrentWatermarkInMs


def test_state_calls_do_not_grow_with_minutes():
    h, p = _Handle(), RollingProcessor(keep_amounts=False)
    p.init(h)
    rows = [{"row": json.dumps([i, i * 60_000, 100, 100, 0])} for i in range(500)]
    out = list(p.handleInputRows((1,), iter(rows), _Clock(0)))
    assert out[-1]["total_in_24h"] == 500.0 and out[-1]["txn_count_1h"] == 60 and out[-1]["last_txn_amounts"].count("1.00") == 10
    assert h.value.calls == 2 and h.timers == [1440 * 60_000]
    end = (1440 + 600) * 60_000
    assert list(p.handleExpiredTimer((1,), _Clock(end), _Clock(h.timers[0]))) == [] and h.value.stored is None
