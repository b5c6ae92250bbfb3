"""Streams: admission, expiry, progress and models that SQL does not see."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerhawk.config import StreamParams
from ledgerhawk.operators import centres as cm
from ledgerhawk.operators import learn as ml
from ledgerhawk.plans.harness import SF_SMALL
from ledgerhawk.sources.canonical import txn
from ledgerhawk.streaming import sources as ss
from ledgerhawk.streaming.rolling import live_state, stream_rolling_features


def test_quiet_customers_leave_the_state(spark):
    live = {r["customer_id"] for r in entry.queries()["stream_state_expiry"](spark, SF_SMALL).collect()}
    everyone = {r["customer_id"] for r in txn(spark, SF_SMALL).select("customer_id").distinct().collect()}
    assert live and live < everyone


def test_state_of_a_stopped_query_follows_event_time(spark, tmp_path):
    """One customer trades on, the other stops: a day later only the first is in the state,
    with as many minutes as a day has of its rows, and a late row is refused."""
    schema = "customer_id long, transaction_id long, transaction_type string, amount decimal(12,2), amount_usd decimal(12,2), event_ts timestamp"
    src, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))

    def feed(n, rows):
        at = [(c, i, "DEPOSIT", a, a, t) for c, i, a, t in rows]
        spark.createDataFrame([], schema).unionByName(spark.createDataFrame(at, "customer_id long, transaction_id long, transaction_type string, amount double, amount_usd double, t string")
                              .select("customer_id", "transaction_id", "transaction_type", F.col("amount").cast("decimal(12,2)"), F.col("amount_usd").cast("decimal(12,2)"),
                                      F.col("t").cast("timestamp").alias("event_ts"))).write.parquet(f"{src}/n={n}")
        from ledgerhawk.streaming.jobs import run_to_files
        stream = stream_rolling_features(spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src), keep_amounts=False)
        run_to_files(stream, out, ckpt)

    feed(0, [(1, 1, 10.5, "2024-01-01 00:00:10"), (1, 2, 1.0, "2024-01-01 00:00:10"), (2, 3, 5.0, "2024-01-01 00:10:00")])
    feed(1, [(1, 4, 2.0, "2024-01-01 23:59:50"), (1, 5, 3.0, "2024-01-02 00:00:05")])
    feed(2, [(1, 6, 4.0, "2024-01-03 12:00:00"), (2, 7, 9.0, "2023-12-30 00:00:00")])
    got = {r["transaction_id"]: (r["total_in_24h"], r["txn_count_1h"], r["last_txn_amounts"]) for r in spark.read.parquet(out).collect()}
    assert got == {1: (11.5, 2, "10.50"), 2: (11.5, 2, "10.50,1.00"), 3: (5.0, 1, "5.00"), 4: (13.5, 1, "10.50,1.00,2.00"),
                   5: (5.0, 2, "10.50,1.00,2.00,3.00"), 6: (4.0, 1, got[6][2])}
    assert {r["c"] for r in live_state(spark, ckpt).select(F.col("key.customer_id").alias("c")).collect()} == {1}
    assert live_state(spark, ckpt).count() == 1


def test_admission_is_by_files_or_by_bytes(spark, tmp_path):
    with pytest.raises(ValueError):
        ss.envelope_stream(spark, str(tmp_path), StreamParams(max_files_per_trigger=1, max_bytes_per_trigger=1))
    p = StreamParams()
    assert p.trigger_of("decisions", "alerts", "serving", "gold") == 2 and p.trigger_of("bronze", "dlq", "archive") == 30


def test_models_by_version_and_none(spark, tmp_path):
    path = str(tmp_path / "models")
    assert cm.newest(spark, path) is None and ml.load_model(spark, str(tmp_path / "no")) is None
    rows = spark.createDataFrame([(1, 3.0, 4.0), (2, None, 0.0)], "id int, a double, b double")
    none = cm.score(rows, None, [F.col("a"), F.col("b")])
    assert [tuple(r)[3:] for r in none.orderBy("id").collect()] == [(-1, 0.0, 0)] * 2
    cm.publish(spark, path, cm.CentreModel((1.0, float("inf")), ((0.0, 0.0), (3.0, 0.0)), 5.0))
    one = cm.newest(spark, path)
    assert one.version == 1 and one.scales == (1.0, float("inf"))
    assert [tuple(r)[3:] for r in cm.score(rows, one, [F.col("a"), F.col("b")]).orderBy("id").collect()] == [(1, 0.0, 1), (0, 0.0, 1)]
    cm.publish(spark, path, cm.CentreModel((1.0, 1.0), ((0.0, 0.0), (0.0, 0.0)), 10.0))
    assert [tuple(r)[3:] for r in cm.score(rows, cm.newest(spark, path), [F.col("a"), F.col("b")]).orderBy("id").collect()] == [(0, 0.5, 2), (0, 0.0, 2)]
    with pytest.raises(Exception):
        (tmp_path / "broken" / "metadata").mkdir(parents=True)
        ml.load_model(spark, str(tmp_path / "broken"))


def test_centres_of_a_fitted_model_score_alike(spark):
    from ledgerhawk.plans import catalog as cat
    df = cat._ml_input(spark, SF_SMALL)
    fitted = ml.kmeans_profile(df, k=3)
    cols = ("transaction_id", "ml_cluster_id", F.round("ml_risk_score", 9).alias("r"))
    own = cm.score(df.drop("ml_cluster_id", "ml_risk_score"), cm.CentreModel.of(fitted), [F.col(c) for c in ml.RAW_COLS]).select(*cols)
    theirs = ml.kmeans_score(df.drop("ml_cluster_id", "ml_risk_score"), fitted).select(*cols)
    assert own.count() > 0 and own.exceptAll(theirs).isEmpty()




def test_messages_of_any_text_are_kept(spark):
    from ledgerhawk.streaming import messages as ms
    texts = [b'{"transaction_id":"T1","amount":1.5}', b"not json", b"", None, b"null", b"[1]", b'{"transaction_id":"T2","amount":"many"}', b"{"]
    env = spark.createDataFrame([(None if i == 5 else f"k{i}".encode(), v, "t", 0, i, None) for i, v in enumerate(texts)],
                                "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    decoded = ms.decode_messages(env)
    assert len(ms.MESSAGE_SCHEMA) == 33
    good, bad = ms.readable(decoded).collect(), ms.malformed_letters(decoded, F.lit(7)).collect()
    assert len(good) + len(bad) == len(texts)
    assert {r["transaction_id"] for r in good} == {"T1"}
    assert {r["key"] for r in bad} == {"k1", "k2", "k3", "k4", "unknown", "k6", "k7"} and {r["failed_at"] for r in bad} == {7}
