"""The batch engine over rows that follow others equals one run over all of them."""

from pyspark.sql import functions as F

from ledgerhawk.config import DecisionParams
from ledgerhawk.operators import continued
from ledgerhawk.operators import sequence as seq
from ledgerhawk.operators.segments import SplitParams
from ledgerhawk.plans.harness import SF_SMALL
from ledgerhawk.sources.canonical import txn
from ledgerhawk.streaming import split as sp
from ledgerhawk.streaming.levels import Serving

P = DecisionParams(micro_window_ms=86_400_000, mule_window_ms=86_400_000, mule_min_cents=200_000, wire_min_cents=100_000, trust_size=4)
SPLIT = SplitParams(hot_rows=12, seg_rows=5)


def in_parts(spark, t, cuts, split, p=P):
    """Decisions of consecutive parts, each from the states after the ones before."""
    kind, base, out = continued.state_type(t), None, None
    for low, high in zip(cuts, cuts[1:]):
        part = t.where((F.col("event_timestamp") >= low) & (F.col("event_timestamp") < high))
        d = seq.decide(part, p, F.col("event_timestamp"), split=split, base=base, keep_state=True).checkpoint()
        new = continued.states(d, kind).checkpoint()
        assert new.count() == new.select("customer_id").distinct().count()
        base = new if base is None else base.join(new, "customer_id", "left_anti").unionByName(new).checkpoint()
        d = d.drop("_seg", continued.END, continued.EXIT)
        out = d if out is None else out.unionByName(d)
    return out


def same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def rows(spark):
    t = txn(spark, SF_SMALL)
    hot = F.when(F.col("transaction_id") % 10 < 6, F.lit(1)).otherwise(F.col("customer_id")).cast("long")       # most rows are one customer's
    device = F.when(F.col("customer_id") % 2 == 0, F.concat(F.lit("D"), (F.col("transaction_id") % 9).cast("string"))).otherwise(F.col("device_id"))
    t = t.withColumn("device_id", device).withColumn("customer_id", hot)
    return t.withColumn("device_id", F.when(F.col("customer_id") == 1, F.concat(F.lit("H"), (F.floor(F.col("transaction_id") / 50) % 7).cast("string")))
                        .otherwise(F.col("device_id"))).checkpoint()


def test_parts_equal_the_whole(spark):
    t = rows(spark)
    low, high = t.agg(F.min("event_timestamp"), F.max("event_timestamp")).first()
    cuts = [low, low + (high - low) // 2, high + 1]
    whole = seq.decide(t, P, F.col("event_timestamp")).checkpoint()
    assert whole.where("mule_account_flag OR micro_structuring").count() > 0
    same(whole, in_parts(spark, t, cuts, SPLIT))
    same(whole, in_parts(spark, t, cuts, SplitParams()))


def test_late_rows_follow_the_state(spark):
    """Rows earlier than the state's own come after it all the same, split or not."""
    t = rows(spark)
    mid = t.agg(F.percentile_approx("event_timestamp", 0.5)).first()[0]
    first, late = t.where(F.col("event_timestamp") >= mid), t.where(F.col("event_timestamp") < mid)
    d = seq.decide(first, P, F.col("event_timestamp"), keep_state=True).checkpoint()
    base = continued.states(d, continued.state_type(t)).checkpoint()
    got = [seq.decide(late, P, F.col("event_timestamp"), split=s, base=base).checkpoint() for s in (SplitParams(), SPLIT)]
    same(*got)


def test_no_rows_and_no_states(spark):
    t = rows(spark)
    kind = continued.state_type(t)
    empty = spark.createDataFrame([], kind)
    some = t.limit(50).checkpoint()
    same(seq.decide(some, P, F.col("event_timestamp")), seq.decide(some, P, F.col("event_timestamp"), base=empty))
    none = seq.decide(t.limit(0), P, F.col("event_timestamp"), base=empty, keep_state=True)
    assert none.count() == 0 and continued.states(none, kind).count() == 0


def test_hot_customer_is_spread_and_replays_add_nothing(spark, tmp_path):
    """One customer has nine tenths of the second micro-batch: its rows are in many tasks' files,
    and a batch that is replayed, or was cut short before its states, changes nothing."""
    t = rows(spark).withColumn("customer_id", F.when(F.col("transaction_id") % 10 > 0, F.lit(1)).otherwise(F.col("customer_id")).cast("long")).checkpoint()
    mid = t.agg(F.percentile_approx("event_timestamp", 0.5)).first()[0]
    parts = [t.where(F.col("event_timestamp") < mid), t.where(F.col("event_timestamp") >= mid)]
    how = dict(params=P, ingest_col="event_timestamp", split=SplitParams(hot_rows=60, seg_rows=20), ttl_ms=None)
    root, names = str(tmp_path), ["transaction_id", "decision_action", "decision_reasons", "amount_zscore"]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")        # small tasks would be joined up
    try:
        for i in (0, 1):
            sp.decide_batch(parts[i], i, root, **how)
            sp.decide_batch(parts[i], i, root, **how)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = sp.read_decisions(spark, root).select(*names)
    same(seq.decide(t, P, F.col("event_timestamp")).select(*names), got)
    files = spark.read.parquet(f"{root}/decisions/batch_id=1").where("customer_id = 1").groupBy(F.input_file_name()).count().collect()
    assert len(files) >= 4 and max(r["count"] for r in files) < sum(r["count"] for r in files) / 2
    table = Serving(spark, f"{root}/state", key="customer_id", version=sp.SEEN)
    assert table.holds(0) and table.holds(1) and not table.holds(2)
    seen = table.read().select(F.max(sp.SEEN)).first()[0]
    everyone = t.select("customer_id").distinct()
    assert sp.states_of(table, everyone, seen, 0).count() <= everyone.count() == sp.states_of(table, everyone, seen, None).count()
    assert sp.states_of(table, everyone, seen + 10, 5).count() == 0
