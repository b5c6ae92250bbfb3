"""Hot-key splitting: a key cut into many time segments gives exactly the
rows of the unsplit per-key scan (forced with tiny split thresholds)."""

from ledgerhawk.plans.harness import SF_ORACLE
from pyspark.sql import functions as F

from ledgerhawk.operators import derive as dv
from ledgerhawk.operators import segments as sg
from ledgerhawk.operators import sequence as seq
from ledgerhawk.operators.segments import SplitParams
from ledgerhawk.plans import catalog as cat
from ledgerhawk.sources.canonical import txn

TINY = SplitParams(hot_rows=5, seg_rows=3)


def _same(a, b):
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_time_since_last_split_equals_unsplit(spark):
    t = txn(spark, SF_ORACLE)
    cols = ("transaction_id", "time_since_last_trans")
    _same(seq.time_since_last(t).select(*cols), seq.time_since_last(t, split=TINY).select(*cols))


def test_card_scans_split_equal_unsplit_with_null_times(spark):
    c = cat.cards(spark, SF_ORACLE)
    # time-less rows (sorted first by P13, last by T16) exercise segment -1
    c = c.withColumn("Trans_ts", F.when(F.col("Trans_id") % 17 != 0, F.col("Trans_ts")))
    cols = ("Trans_id", "distance_from_last_loc", "time_since_last_trans")
    whole = dv.enrich_card(c).select(*cols)
    s = seq.segmented(c.withColumnRenamed("Trans_id", "transaction_id"), "Clt_id", "Trans_ts", TINY)
    assert s.filter(F.col(sg.SEG) > 0).count() > 0
    assert s.filter(F.col(sg.SEG) < -1).count() > 0  # time-less rows cut into several segments too
    s = seq.time_since_last(s, key="Clt_id", ts="Trans_ts")
    split = dv.distance_from_last(s, "Clt_id", "Trans_ts", "transaction_id") \
        .withColumnRenamed("transaction_id", "Trans_id").select(*cols)
    _same(whole, split)


def test_hot_key_table_is_bounded(spark):
    t = txn(spark, SF_ORACLE)
    n = t.count()
    p = SplitParams(hot_rows=50, seg_rows=10)
    hot = sg.hot_keys(t, "customer_id", F.unix_micros("event_ts"), p).count()
    assert hot <= n // p.hot_rows


def test_decision_engine_split_equals_unsplit(spark):
    """Windows with carries plus the fold with fixpoint entry states give the
    sequential result; thresholds chosen so anchored windows, mule and trust fire
    and a 24 h anchor spans many segments."""
    from ledgerhawk.config import DecisionParams
    t = txn(spark, SF_ORACLE)
    p = DecisionParams(micro_window_ms=86_400_000, mule_window_ms=86_400_000,
                       mule_min_cents=200_000, wire_min_cents=100_000)
    cols = ("transaction_id", "micro_n", "micro_sum_cents", "micro_hit", "mule_in_cents", "mule_out_cents",
            "mule_hit", "new_device", "wire_hit", "novelty_hit", "trust_joined", "trust_size", "_n", "_s1",
            "_s2", "_t3", "_t4", "_t7", "_new_country", "decision_action", "decision_reasons")
    whole = seq.decision_pipeline(t, p, processing_ms=F.col("ingest_ms"), keep_features=True).select(*cols)
    split = seq.decision_pipeline(t, p, processing_ms=F.col("ingest_ms"), keep_features=True,
                                  split=SplitParams(hot_rows=20, seg_rows=8)).select(*cols)
    assert whole.filter("micro_hit OR mule_hit OR wire_hit").count() > 0
    _same(whole, split)


def test_rolling_features_split_equals_unsplit(spark):
    """T17 prefix differences with probes and the last-n carry; also with
    time-less rows (peer-group frames, ordered first)."""
    t = txn(spark, SF_ORACLE)
    nulls = t.withColumn("event_timestamp", F.when(F.col("transaction_id") % 13 != 0, F.col("event_timestamp")))
    cols = ("transaction_id", "total_in_24h", "total_out_24h", "txn_count_1h", "last_txn_amounts")
    for df in (t, nulls):
        _same(seq.rolling_features(df).select(*cols), seq.rolling_features(df, split=TINY).select(*cols))


def test_decision_engine_split_with_trust_eviction(spark):
    """Customers with more devices than the trust list holds: FIFO eviction
    order must carry across segments exactly."""
    from ledgerhawk.config import DecisionParams
    t = txn(spark, SF_ORACLE).withColumn(
        "device_id", F.concat(F.lit("D"), (F.col("transaction_id") % 15).cast("string")))
    p = DecisionParams(wire_min_cents=100_000)
    cols = ("transaction_id", "new_device", "wire_hit", "novelty_hit", "trust_joined", "trust_size",
            "decision_action", "decision_reasons")
    whole = seq.decision_pipeline(t, p, processing_ms=F.col("ingest_ms"), keep_features=True).select(*cols)
    split = seq.decision_pipeline(t, p, processing_ms=F.col("ingest_ms"), keep_features=True,
                                  split=SplitParams(hot_rows=20, seg_rows=8)).select(*cols)
    assert whole.filter("trust_size = 10").count() > 0
    _same(whole, split)


def test_text_ids_and_a_burst_split_equal_unsplit(spark):
    """Ids of the reference are strings, and a key's rows may come in one burst."""
    t = txn(spark, SF_ORACLE).withColumn("transaction_id", F.concat(F.lit("T"), F.col("transaction_id").cast("string")))
    burst = F.when(F.col("customer_id") % 2 == 0, F.lit("2024-01-03 10:00:00").cast("timestamp")
                   + F.make_dt_interval(secs=F.pmod(F.xxhash64("transaction_id"), F.lit(40)).cast("decimal(18,6)")))
    t = t.withColumn("event_ts", F.coalesce(burst, F.col("event_ts").cast("timestamp")))
    cols = ("transaction_id", "time_since_last_trans")
    p = SplitParams(hot_rows=20, seg_rows=5)
    s = seq.segmented(t, "customer_id", "event_ts", p)
    most = s.groupBy("customer_id", sg.SEG).count().agg(F.max("count")).first()[0]
    whole = t.groupBy("customer_id").count().agg(F.max("count")).first()[0]
    assert most < whole / 2
    _same(seq.time_since_last(t).select(*cols), seq.time_since_last(t, split=p).select(*cols))


def _steady(spark, n=1500, devices=7):
    """One customer without any pause: a row each 20 seconds, amounts that fire both windows."""
    i = F.col("id")
    return spark.range(n).select(
        i.alias("transaction_id"), F.concat(F.lit("k"), i.cast("string")).alias("idempotency_key"), F.lit(1).cast("long").alias("customer_id"),
        F.when(i % 11 == 0, "SWIFT_WIRE").otherwise("WEB_BANKING").alias("channel_type"),
        F.element_at(F.array(*[F.lit(x) for x in ("DEPOSIT", "WITHDRAWAL", "PAYMENT")]), (F.pmod(F.xxhash64(i), F.lit(3)) + 1).cast("int")).alias("transaction_type"),
        (F.pmod(F.xxhash64(i, F.lit(1)), F.lit(9_000)) + 1).cast("decimal(12,2)").alias("amount"), F.lit(None).cast("decimal(12,2)").alias("amount_usd"),
        (F.lit(1_704_067_200_000) + i * 20_000 + F.pmod(F.xxhash64(i, F.lit(2)), F.lit(15_000))).alias("event_timestamp"),
        F.lit(None).cast("double").alias("latitude"), F.lit(None).cast("double").alias("longitude"), F.lit(1).cast("long").alias("country_code"),
        F.lit(1).cast("long").alias("ip_country"), F.concat(F.lit("D"), F.pmod(F.xxhash64(F.floor(i / 40), i % 3), F.lit(devices)).cast("string")).alias("device_id"),
        F.lit(False).alias("is_rooted_device"))


def test_customer_without_a_pause_takes_no_rounds(spark, monkeypatch):
    """Anchors that never realign: over a hundred segments equal the sequential fold, and
    with no more devices than the trust list holds nothing is folded twice."""
    from ledgerhawk.config import DecisionParams
    from ledgerhawk.operators import summaries as sm
    p = DecisionParams(micro_window_ms=7_000_003, mule_window_ms=3_100_007, micro_sum_cents=100_000_000, mule_min_cents=15_000_000)
    cols = ("transaction_id", "micro_n", "micro_sum_cents", "micro_hit", "mule_in_cents", "mule_out_cents", "mule_hit",
            "new_device", "wire_hit", "trust_joined", "trust_size", "decision_reasons")
    rounds = []
    plain = sm._trust_exits
    monkeypatch.setattr(sm, "_trust_exits", lambda *a: rounds.append(1) or plain(*a))
    t = _steady(spark)
    whole = seq.decide(t, p, F.col("event_timestamp"), keep_features=True).select(*cols)
    split = seq.decide(t, p, F.col("event_timestamp"), keep_features=True, split=SplitParams(hot_rows=100, seg_rows=12)).select(*cols)
    _same(whole, split)
    assert whole.filter("micro_hit").count() > 0 and whole.filter("trust_joined").count() >= 7 and not rounds


def test_step_functions_compose(spark):
    """Entry states by look-up are those of a row-by-row fold, for any cut and any window."""
    import random

    import numpy as np

    from ledgerhawk.operators import summaries as sm

    rng = random.Random(1)
    for _ in range(200):
        n, window = rng.randrange(1, 60), rng.choice((0, 1, 5, 30, 200))
        t = sorted(rng.randrange(0, 150) for _ in range(n))
        a, b = [rng.randrange(5) for _ in t], [rng.randrange(9) for _ in t]
        cuts = sorted({0, n, *[rng.randrange(n + 1) for _ in range(4)]})
        state, fold = (None, 0, 0), (None, 0, 0)
        for lo, hi in zip(cuts, cuts[1:]):
            state = sm.leave(state, sm.steps(np.array(t[lo:hi]), np.array(a[lo:hi]), np.array(b[lo:hi]), window), window)
            for x, u, v in zip(t[lo:hi], a[lo:hi], b[lo:hi]):
                if fold[0] is None or x - fold[0] > window:
                    fold = (x, 0, 0)
                fold = (fold[0], fold[1] + u, fold[2] + v)
            assert state == fold
