"""Per-customer sequential decision logic, batch form.

Plan shape (one shuffle): rows are hash-partitioned by customer and sorted by
(event time, id) once. Every feedback-free rule is a window expression over
that order (running moments, last fix per channel group, last known country).
What is left is truly sequential: the two anchored windows (T5, T6) and the
device-trust set (T12) whose membership depends on the row's own violations,
which depend on trust (T8, T9). That residue is a small fold over the already
sorted partition in ``mapInPandas``: it streams Arrow batches and keeps only the
current customer's bounded state (two anchors, four sums, <= 10 devices), so no
customer history is ever collected into memory.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from ledgerhawk import config as C
from ledgerhawk.config import DecisionParams
from ledgerhawk.functions.geo import haversine
from ledgerhawk.functions.joins import broadcast_if_small
from ledgerhawk.functions.text import (cents_to_dollars_text, fingerprint, half_up_int,
                                       one_decimal, ratio_text)
from ledgerhawk.operators import continued
from ledgerhawk.operators import segments as sg
from ledgerhawk.operators import summaries as sm
from ledgerhawk.operators.segments import SplitParams

ORDER = ("_ts", "transaction_id")
ATM_GROUP = ("ATM", "POS", "BRANCH")


def _w(key: str = "customer_id"):
    """Rows of one customer segment in (event time, id) order. Ordinary
    customers have one segment; a hot customer's segments get carries."""
    return W.partitionBy(key, sg.SEG).orderBy(*ORDER)


def _carry(name: str, default=None) -> Column:
    c = F.col(f"_c{name}")
    return c if default is None else F.coalesce(c, default)


def with_segment_carries(df: DataFrame, split: SplitParams = SplitParams(), base: DataFrame | None = None) -> DataFrame:
    """Cut hot customers into time segments and attach, per segment, what the
    windows need from the segments before it: exact moment sums, the last mobile
    fix, the last ATM/POS/BRANCH fix and the last known country. With ``base``
    (``continued``) that includes the customer's rows before ``df``."""
    s = segmented(df, "customer_id", "_ts", split)
    order = sg.row_order(F.col("_ts"), F.col("transaction_id"), True, sg.id_type(s, F.col("transaction_id")))
    x = F.col("_cents").cast("decimal(38,0)")
    mob, atm = F.col("_channel") == "MOBILE_APP", F.col("_channel").isin(*ATM_GROUP)
    fix = {"ts": "_ts", "lat": "latitude", "lon": "longitude", "ip": "ip_country"}
    last = {f"_mob_{k}": (mob, F.col(c)) for k, c in fix.items()}
    last.update({f"_atm_{k}": (atm, F.col(c)) for k, c in fix.items()})
    last["_country"] = (F.col("country_code").isNotNull(), F.col("country_code"))
    c = sg.carries(s, "customer_id", order, True,
                   sums={"_n": F.lit(1).cast("long"), "_s1": x, "_s2": x * x}, last_nonnull=last)
    return sg.attach(s, "customer_id", c) if base is None else continued.attach_base(s, c, base)


def _carried_fix(prefix: str) -> Column:
    return F.when(F.col(f"_c{prefix}_ts").isNotNull(), F.struct(
        F.col(f"_c{prefix}_ts").alias("ts"), F.col(f"_c{prefix}_lat").alias("latitude"),
        F.col(f"_c{prefix}_lon").alias("longitude"), F.col(f"_c{prefix}_ip").alias("ip_country")))


def prepare_rows(df: DataFrame) -> DataFrame:
    """Missing-value fallbacks of the reference: ts -> now, amount -> 0,
    usd -> amount, channel -> UNKNOWN. Amounts become exact integer cents."""
    amount = F.coalesce(F.col("amount").cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)"))
    usd = F.when(F.col("amount_usd").isNull() | (F.col("amount_usd") == 0), amount) \
        .otherwise(F.col("amount_usd").cast("decimal(18,2)"))
    return df.withColumns({
        "_ts": F.coalesce(F.col("event_timestamp"), F.unix_millis(F.current_timestamp())),
        "_cents": (amount * 100).cast("long"),
        "_usd_cents": (usd * 100).cast("long"),
        "_channel": F.coalesce(F.col("channel_type"), F.lit("UNKNOWN"))})


# --------------------------------------------------------------------- windows
def with_running_stats(df: DataFrame, p: DecisionParams = DecisionParams()) -> DataFrame:
    """Running count/mean/population std including the current row.

    Exact integer moments (decimal(38,0)) make the z > limit test exact:
    |n*x - s1| > z * sqrt(n*s2 - s1^2)  <=>  (n*x - s1)^2 > z^2 (n*s2 - s1^2).
    """
    w = _w().rowsBetween(W.unboundedPreceding, W.currentRow)
    x = F.col("_cents").cast("decimal(38,0)")
    zero = F.lit(0).cast("decimal(38,0)")
    df = df.withColumns({
        "_n": _carry("_n", F.lit(0).cast("long")) + F.count(F.lit(1)).over(w),
        "_s1": (_carry("_s1", zero) + F.sum(x).over(w)).cast("decimal(38,0)"),
        "_s2": (_carry("_s2", zero) + F.sum(x * x).over(w)).cast("decimal(38,0)")})
    n = F.col("_n").cast("decimal(38,0)")
    dx = n * x - F.col("_s1")
    var_n = n * F.col("_s2") - F.col("_s1") * F.col("_s1")
    z = F.abs(dx).cast("double") / F.sqrt(var_n.cast("double"))
    scored = (F.col("_n") >= p.z_min_count) & (var_n > 0)
    return df.withColumns({
        "running_mean": F.col("_s1").cast("double") / F.col("_n") / 100.0,
        "running_std": F.sqrt(var_n.cast("double")) / F.col("_n") / 100.0,
        "_z": F.when(scored, z).otherwise(F.lit(0.0)),
        "_outlier": scored & (dx * dx > F.lit(p.z_limit * p.z_limit) * var_n)})


def _fix(cond: Column, *cols: str) -> Column:
    return F.when(cond, F.struct(F.col("_ts").alias("ts"), *[F.col(c) for c in cols]))


def with_last_fixes(df: DataFrame) -> DataFrame:
    """Last mobile fix, last ATM/POS/BRANCH fix and last known country *before* the row.

    The whole struct is carried so that a mobile row with a null latitude still
    replaces the fix, as a state overwrite would."""
    prev = _w().rowsBetween(W.unboundedPreceding, -1)
    ch = F.col("_channel")
    return df.withColumns({
        "_mob": F.coalesce(F.last(_fix(ch == "MOBILE_APP", "latitude", "longitude", "ip_country"), True)
                           .over(prev), _carried_fix("_mob")),
        "_atm": F.coalesce(F.last(_fix(ch.isin(*ATM_GROUP), "latitude", "longitude", "ip_country"), True)
                           .over(prev), _carried_fix("_atm")),
        "_last_country": F.coalesce(F.last("country_code", True).over(prev), F.col("_c_country"))})


def with_travel_rules(df: DataFrame, p: DecisionParams = DecisionParams()) -> DataFrame:
    """T3 (cross-channel), T4 (same channel group), T7 (session conflict), T10 (rooted)."""
    ch, lat, lon = F.col("_channel"), F.col("latitude"), F.col("longitude")

    def leg(fix: str):
        hours = F.greatest((F.col("_ts") - F.col(f"{fix}.ts")) / F.lit(3_600_000.0), F.lit(p.min_hours))
        dist = haversine(F.col(f"{fix}.latitude"), F.col(f"{fix}.longitude"), lat, lon)
        return dist, dist / hours

    d3, s3 = leg("_mob")
    t3 = (ch.isin("ATM", "POS") & F.col("_mob").isNotNull() & F.col("_mob.latitude").isNotNull()
          & lat.isNotNull())
    same = F.when(ch.isin(*ATM_GROUP), F.col("_atm")).when(ch == "MOBILE_APP", F.col("_mob"))
    df = df.withColumn("_same", same)
    d4, s4 = leg("_same")
    t4 = F.col("_same").isNotNull() & F.col("_same.latitude").isNotNull() & lat.isNotNull()
    limit = lambda d, s: (s > F.lit(p.speed_kmh)) & (d > F.lit(p.min_distance_km))
    df = df.withColumns({
        "_d3": d3, "_s3": s3, "_d4": d4, "_s4": s4,
        "_t7": F.coalesce((ch == "ATM") & F.col("_mob").isNotNull()
                          & ((F.col("_ts") - F.col("_mob.ts")) < F.lit(p.session_window_ms))
                          & ~F.col("country_code").eqNullSafe(F.col("_mob.ip_country")), F.lit(False)),
        "_t10": F.coalesce(F.col("is_rooted_device"), F.lit(False)),
        "_new_country": F.coalesce(F.col("country_code").isNotNull()
                                   & ~F.col("country_code").eqNullSafe(F.col("_last_country")), F.lit(False))})
    return df.withColumns({
        "_t3": F.coalesce(t3 & limit(F.col("_d3"), F.col("_s3")), F.lit(False)),
        "_t4": F.coalesce(t4 & limit(F.col("_d4"), F.col("_s4")), F.lit(False))}).drop("_same")


# --------------------------------------------------------------------- fold
FOLD_FIELDS = (
    ("micro_n", T.LongType()), ("micro_sum_cents", T.LongType()), ("micro_hit", T.BooleanType()),
    ("mule_in_cents", T.LongType()), ("mule_out_cents", T.LongType()), ("mule_hit", T.BooleanType()),
    ("new_device", T.BooleanType()), ("wire_hit", T.BooleanType()), ("novelty_hit", T.BooleanType()),
    ("trust_joined", T.BooleanType()), ("trust_size", T.IntegerType()),
)


ENTRY_FIELDS = (
    ("a1", T.LongType()), ("mc", T.LongType()), ("msum", T.LongType()),
    ("a30", T.LongType()), ("ins", T.LongType()), ("outs", T.LongType()),
    ("trusted", T.ArrayType(T.StringType())),
)
ENTRY_COLS = tuple(f"_e_{n}" for n, _ in ENTRY_FIELDS)
FOLD_INPUT = ("customer_id", sg.SEG, "_ts", "transaction_id", "_usd_cents", "transaction_type",
              "device_id", "_channel", "_new_country", "_pre_violation")
# read by the decision assembly after the fold (besides the fold's own outputs)
AFTER_FOLD = ("transaction_id", "idempotency_key", "customer_id", "amount", "_channel", "_cents",
              "_usd_cents", "_ts", "source_to_kafka_lag_ms", "kafka_to_spark_lag_ms", "total_pipeline_lag_ms",
              "sla_breached", "dq_passed", "dq_violations", "completeness_score", "ml_risk_score",
              "ml_cluster_id", "_z", "_outlier", "_d3", "_s3", "_d4", "_t3", "_t4", "_t7", "_t10", "_proc")


def _entry_state(pdf, i):
    """State at the start of a segment: the entry columns if set, else fresh."""
    if "_e_set" in pdf.columns and bool(pdf["_e_set"].iat[i]):
        e = [pdf[c].iat[i] for c in ENTRY_COLS]
        trusted = [] if e[6] is None else [str(d) for d in e[6]]
        a1 = None if e[0] is None or e[0] != e[0] else int(e[0])
        a30 = None if e[3] is None or e[3] != e[3] else int(e[3])
        return a1, int(e[1]), int(e[2]), a30, int(e[4]), int(e[5]), trusted
    return None, 0, 0, None, 0, 0, []


def _fold(batches, p: DecisionParams):
    """Anchored windows + trust set over rows sorted by (customer, segment, ts, id).

    State is carried across Arrow batches and re-initialised when the segment
    changes: from the segment's entry state if one is attached (a hot
    customer's later segment), else fresh."""
    inbound, outbound = set(C.INBOUND_TYPES), set(C.OUTBOUND_TYPES)
    cur = object()
    a1 = a30 = None
    mc = msum = ins = outs = 0
    trusted: list = []

    for pdf in batches:
        cust = pdf["customer_id"].tolist()
        seg = pdf[sg.SEG].tolist()
        ts = pdf["_ts"].tolist()
        usd = pdf["_usd_cents"].tolist()
        ttype = pdf["transaction_type"].tolist()
        dev = pdf["device_id"].tolist()
        chan = pdf["_channel"].tolist()
        newc = pdf["_new_country"].tolist()
        pre = pdf["_pre_violation"].tolist()
        ends = pdf[continued.END].tolist() if continued.END in pdf.columns else None
        exits = []
        out = {name: [] for name, _ in FOLD_FIELDS}
        for i in range(len(cust)):
            if (cust[i], seg[i]) != cur:
                cur = (cust[i], seg[i])
                a1, mc, msum, a30, ins, outs, trusted = _entry_state(pdf, i)
            t, u = ts[i], usd[i]
            if a1 is None or t - a1 > p.micro_window_ms:
                a1, mc, msum = t, 0, 0
            micro = False
            if u < p.micro_limit_cents:
                mc += 1
                msum += u
                micro = mc >= p.micro_min_count and msum > p.micro_sum_cents
            if a30 is None or t - a30 > p.mule_window_ms:
                a30, ins, outs = t, 0, 0
            if ttype[i] in inbound:
                ins += u
            elif ttype[i] in outbound:
                outs += u
            mule = (ins > p.mule_min_cents and outs > p.mule_min_cents
                    and 100 * min(ins, outs) >= p.mule_ratio_pct * max(ins, outs))
            d = dev[i] if isinstance(dev[i], str) else None
            new_dev = bool(d) and d not in trusted
            wire = chan[i] == "SWIFT_WIRE" and new_dev and u > p.wire_min_cents
            novelty = new_dev and bool(newc[i]) and u > p.novelty_min_cents
            joined = False
            if not (pre[i] or micro or mule or wire or novelty) and d and d not in trusted:
                trusted.append(d)
                trusted = trusted[-p.trust_size:]
                joined = True
            for k, v in (("micro_n", mc), ("micro_sum_cents", msum), ("micro_hit", micro),
                         ("mule_in_cents", ins), ("mule_out_cents", outs), ("mule_hit", mule),
                         ("new_device", new_dev), ("wire_hit", wire), ("novelty_hit", novelty),
                         ("trust_joined", joined), ("trust_size", len(trusted))):
                out[k].append(v)
            if ends is not None:
                exits.append(json.dumps([a1, mc, msum, a30, ins, outs, trusted]) if ends[i] else None)
        if ends is not None:
            pdf[continued.EXIT] = exits
        for k, _ in FOLD_FIELDS:
            pdf[k] = out[k]
        yield pdf


def _with_entries(df: DataFrame, entries: DataFrame | None) -> DataFrame:
    """Attach each segment's entry state (broadcast under the size check; the
    table has one row per hot segment, bounded by total_rows / seg_rows)."""
    if entries is None:
        return df.withColumn("_e_set", F.lit(False)).select(
            "*", *[F.lit(None).cast(t).alias(f"_e_{n}") for n, t in ENTRY_FIELDS])
    e = broadcast_if_small(entries.select(
        F.col("customer_id").alias("_ek"), F.col(sg.SEG).alias("_es"), F.lit(True).alias("_e_set"),
        *[F.col(n).alias(f"_e_{n}") for n, _ in ENTRY_FIELDS]))
    j = df.join(e, (F.col("customer_id") == F.col("_ek")) & (F.col(sg.SEG) == F.col("_es")), "left")
    return j.drop("_ek", "_es").withColumn("_e_set", F.coalesce(F.col("_e_set"), F.lit(False)))


def resolve_entry_states(windowed: DataFrame, p: DecisionParams = DecisionParams(), base: DataFrame | None = None) -> DataFrame:
    """Entry state of every segment of every hot customer, exactly (``summaries``): the
    anchored windows by step functions; then, with the windows known, one fold tells which
    rows may add their device, and the trust lists follow from those. Rows come from a
    checkpointed, (customer, segment)-clustered narrow copy of the hot rows; state tables
    hold one row per segment (bounded by total_rows / seg_rows). ``base`` are the
    customers' states before their first rows here, none if not given."""
    from ledgerhawk.session import scratch_root
    scratch_root(windowed.sparkSession)  # cluster checkpoint dir, or a test folder when unset
    # the window stage left the rows hash-clustered by (customer, segment) and
    # sorted; filter, projection and checkpoint keep that
    hot = windowed.filter(F.col(sg.HOT)).select(*FOLD_INPUT).checkpoint()
    anchors = sm.anchor_entries(hot, p, base).checkpoint()
    none = [F.lit(None).cast(t).alias(n) for n, t in ENTRY_FIELDS if n == "trusted"]
    flagged = sequential_fold(hot, p, anchors.select("*", *none))
    stopped = F.col("_pre_violation") | F.col("micro_hit") | F.col("mule_hit") \
        | ((F.col("_channel") == "SWIFT_WIRE") & (F.col("_usd_cents") > p.wire_min_cents)) \
        | (F.col("_new_country") & (F.col("_usd_cents") > p.novelty_min_cents))
    accesses = flagged.where((F.col("device_id") != "") & ~F.coalesce(stopped, F.lit(False))) \
        .select("customer_id", sg.SEG, *ORDER, "device_id")
    if base is not None:
        accesses = accesses.unionByName(continued.trusted_before(base, accesses, anchors))
    accesses = accesses.checkpoint()
    trust = sm.trust_entries(anchors.select("customer_id", sg.SEG), accesses, p)
    return anchors.join(trust, ["customer_id", sg.SEG], "left").select("customer_id", sg.SEG, *[n for n, _ in ENTRY_FIELDS]).checkpoint()


def sequential_fold(df: DataFrame, p: DecisionParams = DecisionParams(),
                    entries: DataFrame | None = None) -> DataFrame:
    """Run the residual fold on rows clustered by (customer, segment) and sorted.

    ``sortWithinPartitions`` is free when the window stage already produced that
    order (Spark removes the redundant sort)."""
    if sg.SEG not in df.columns:
        df = df.withColumn(sg.SEG, F.lit(0).cast("long"))
    x = _with_entries(df, entries)
    more = [T.StructField(continued.EXIT, T.StringType())] if continued.END in x.columns else []
    schema = T.StructType(x.schema.fields + more + [T.StructField(n, t, True) for n, t in FOLD_FIELDS])
    sorted_df = x.sortWithinPartitions("customer_id", sg.SEG, *ORDER)
    return sorted_df.mapInPandas(lambda it: _fold(it, p), schema).drop("_e_set", *ENTRY_COLS)


# --------------------------------------------------------------------- assembly
def window_stage(df: DataFrame, p: DecisionParams = DecisionParams(),
                 split: SplitParams = SplitParams(), base: DataFrame | None = None) -> DataFrame:
    """The rules that need no feedback, as window expressions. Columns a
    caller does not read are pruned with their windows; no Python runs."""
    x = with_segment_carries(prepare_rows(df), split, base)
    x = with_travel_rules(with_last_fixes(with_running_stats(x, p)), p)
    return x.withColumn("amount_zscore", F.floor(F.col("_z") * 10000 + F.lit(0.5)) / F.lit(10000.0))


def decide(df: DataFrame, p: DecisionParams = DecisionParams(),
           processing_ms: Column | None = None, keep_features: bool | tuple = False,
           split: SplitParams = SplitParams(), base: DataFrame | None = None, keep_state: bool = False) -> DataFrame:
    """T1-T12 + decision (T11) + fingerprint (F2): the enriched decision rows.

    ``keep_features`` returns the features with the decision, with all columns or those of
    ``df`` that it names. ``base`` are customers' states before these rows; ``keep_state`` adds the columns that
    ``continued.states`` reads the states after them from."""
    need = {"ml_risk_score": F.lit(0.0), "ml_cluster_id": F.lit(-1).cast("int"),
            "source_to_kafka_lag_ms": F.lit(0).cast("long"), "kafka_to_spark_lag_ms": F.lit(0).cast("long"),
            "total_pipeline_lag_ms": F.lit(0).cast("long"), "sla_breached": F.lit(False),
            "dq_passed": F.lit(True), "dq_violations": F.lit(""), "completeness_score": F.lit(1.0)}
    for c, v in need.items():
        if c not in df.columns:
            df = df.withColumn(c, v)
    x = window_stage(df, p, split, base).drop("amount_zscore")
    if keep_state:
        x = x.withColumn(continued.END, continued.end_of_segment(_w(), ATM_GROUP))
    x = x.withColumn("_pre_violation", F.col("_outlier") | F.col("_t3") | F.col("_t4")
                     | F.col("_t7") | F.col("_t10")).drop("_mob", "_atm")
    split_any = not x.schema[sg.HOT].metadata.get(sg.UNSPLIT)
    proc = processing_ms if processing_ms is not None else F.unix_millis(F.current_timestamp())
    x = x.withColumn("_proc", proc.cast("long"))
    if keep_features is not True:
        # the fold is opaque to column pruning: hand it only what is read after it
        read = {*AFTER_FOLD, *FOLD_INPUT, sg.SEG, sg.HOT, continued.END, *(keep_features or ())}
        x = x.select(*[c for c in x.columns if c in read])
    entries = resolve_entry_states(x, p, base) if split_any else None
    if base is not None:
        entries = continued.entries(base, entries, [n for n, _ in ENTRY_FIELDS])
    x = sequential_fold(x, p, entries)

    micro_txt = F.concat(F.lit("MICRO_STRUCTURING_"), F.col("micro_n").cast("string"), F.lit("TXN_$"),
                         cents_to_dollars_text(F.col("micro_sum_cents")), F.lit("_IN_1H"))
    lo = F.least("mule_in_cents", "mule_out_cents")
    hi = F.greatest("mule_in_cents", "mule_out_cents")
    mule_txt = F.concat(F.lit("MULE_SYMMETRY_IN$"), cents_to_dollars_text(F.col("mule_in_cents")),
                        F.lit("_OUT$"), cents_to_dollars_text(F.col("mule_out_cents")),
                        F.lit("_RATIO"), ratio_text(lo, hi))
    cross_txt = F.concat(F.lit("IMPOSSIBLE_CROSS_CHANNEL_"), half_up_int(F.col("_d3")).cast("string"),
                         F.lit("KM_"), half_up_int(F.col("_s3")).cast("string"), F.lit("KMH"))
    travel_txt = F.concat(F.lit("IMPOSSIBLE_TRAVEL_"), half_up_int(F.col("_d4")).cast("string"), F.lit("KM"))
    rules = [
        ("_outlier", F.concat(F.lit("STATISTICAL_OUTLIER_Z"), one_decimal(F.col("_z"))), C.RISK_OUTLIER),
        ("_t3", cross_txt, C.RISK_CROSS_CHANNEL),
        ("_t4", travel_txt, C.RISK_SAME_CHANNEL),
        ("micro_hit", micro_txt, C.RISK_MICRO),
        ("mule_hit", mule_txt, C.RISK_MULE),
        ("_t7", F.lit("SESSION_HIJACK_MOBILE_ACTIVE"), C.RISK_HIJACK),
        ("wire_hit", F.lit("HIGH_VALUE_WIRE_UNKNOWN_DEVICE"), C.RISK_WIRE),
        ("novelty_hit", F.lit("TRIPLE_NOVELTY"), C.RISK_NOVELTY),
        ("_t10", F.lit("ROOTED_DEVICE"), C.RISK_ROOTED),
    ]
    reasons = F.array_compact(F.array(*[F.when(F.col(f), txt) for f, txt, _ in rules]))
    pct = sum((F.when(F.col(f), F.lit(w)).otherwise(F.lit(0)) for f, _, w in rules), F.lit(0))
    hard = F.col("_t3") | F.col("_t4") | F.col("_t7") | F.col("wire_hit") | F.col("mule_hit")
    x = x.withColumns({"_pct": F.least(pct, F.lit(100)), "_reasons": reasons})
    x = x.withColumns({
        "composite_risk_score": F.col("_pct") / F.lit(100.0),
        "decision_action": F.when((F.col("_pct") >= p.block_pct) | hard, F.lit("BLOCK"))
                            .when(F.col("_pct") >= p.flag_pct, F.lit("FLAG_WAIT")).otherwise(F.lit("PASS")),
        "decision_reasons": F.when(F.size("_reasons") > 0, F.array_join("_reasons", "|"))
                             .otherwise(F.lit("CLEAN")),
        "geo_violation": F.when(F.col("_t4"), travel_txt).when(F.col("_t3"), cross_txt).otherwise(F.lit("NONE")),
        "cross_channel_violation": F.when(F.col("wire_hit"), F.lit("HIGH_VALUE_WIRE_UNKNOWN_DEVICE"))
                                    .when(F.col("_t7"), F.lit("SESSION_HIJACK_MOBILE_ACTIVE"))
                                    .otherwise(F.lit("NONE")),
        "amount_zscore": F.floor(F.col("_z") * 10000 + F.lit(0.5)) / F.lit(10000.0),
        "data_fingerprint": fingerprint(F.col("transaction_id"), F.col("customer_id"), F.col("amount"),
                                        F.col("_ts"), F.col("_channel")),
        "processing_timestamp": F.col("_proc"),
        "pipeline_version": F.lit(C.PIPELINE_VERSION)})
    if keep_features:
        return x
    return x.select(
        "transaction_id", "idempotency_key", "customer_id", F.col("_channel").alias("channel_type"),
        (F.col("_cents") / F.lit(100.0)).alias("amount"),
        (F.col("_usd_cents") / F.lit(100.0)).alias("amount_usd"),
        F.col("_ts").alias("event_timestamp"),
        F.coalesce("source_to_kafka_lag_ms", F.lit(0)).cast("long").alias("source_to_kafka_lag_ms"),
        F.coalesce("kafka_to_spark_lag_ms", F.lit(0)).cast("long").alias("kafka_to_spark_lag_ms"),
        F.coalesce("total_pipeline_lag_ms", F.lit(0)).cast("long").alias("total_pipeline_lag_ms"),
        F.coalesce("sla_breached", F.lit(False)).alias("sla_breached"),
        "dq_passed", "dq_violations", "completeness_score", "ml_risk_score", "ml_cluster_id",
        "amount_zscore", "geo_violation", F.col("micro_hit").alias("micro_structuring"),
        F.col("mule_hit").alias("mule_account_flag"), "cross_channel_violation",
        "composite_risk_score", "decision_action", "decision_reasons", "data_fingerprint",
        "processing_timestamp", "pipeline_version", *((sg.SEG, continued.END, continued.EXIT) if keep_state else ()))


# --------------------------------------------------------------------- other T keys
def _micros(df: DataFrame, ts: str) -> Column:
    """Numeric time of a timestamp or epoch column (segment arithmetic)."""
    if isinstance(df.schema[ts].dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(ts).cast("timestamp"))
    return F.col(ts)


def segmented(df: DataFrame, key: str, ts: str, split: SplitParams = SplitParams(),
              ident: str = "transaction_id") -> DataFrame:
    """Add the hot-key segment column once, so several ordered scans share it
    (and its single shuffle on (key, segment)). No-op if already present."""
    return df if sg.SEG in df.columns else sg.with_segments(df, key, _micros(df, ts), split, F.col(ident))


def time_since_last(df: DataFrame, key: str = "customer_id", ts: str = "event_ts",
                    ident: str = "transaction_id", split: SplitParams = SplitParams()) -> DataFrame:
    """Seconds since the key's previous row; first row and null times give 0.0.

    Ordered per (key, segment); a hot key's segment takes the previous row's
    time from the segments before it (exact carry)."""
    own = sg.SEG not in df.columns
    s = segmented(df, key, ts, split, ident)
    us = _micros(s, ts)
    order = sg.row_order(us, F.col(ident), True, sg.id_type(s, F.col(ident)))
    s = sg.attach(s, key, sg.carries(s, key, order, True, last_row={"_prev_us": us}))
    w = sg.seg_window(key, F.col(ts).asc_nulls_last(), F.col(ident))
    prev = F.coalesce(F.lag(us).over(w), F.col("_c_prev_us"))
    secs = (us - prev) / F.lit(1_000_000.0)
    out = s.withColumn("time_since_last_trans",
                       F.when(prev.isNotNull() & us.isNotNull(), secs).otherwise(F.lit(0.0))).drop("_c_prev_us")
    return out.drop(sg.SEG, sg.HOT) if own else out


def _rolling_values(df: DataFrame):
    usd = F.col("amount_usd").cast("decimal(38,2)")
    zero = F.lit(0).cast("decimal(38,2)")
    vin = F.when(F.col("transaction_type").isin(*C.INBOUND_TYPES), usd).otherwise(zero)
    vout = F.when(F.col("transaction_type").isin(*C.OUTBOUND_TYPES), usd).otherwise(zero)
    return vin, vout, zero


def _rolling_plain(df: DataFrame, day_ms: int, hour_ms: int, last_n: int) -> DataFrame:
    base = W.partitionBy("customer_id").orderBy("event_timestamp")
    day = base.rangeBetween(-day_ms, 0)
    hour = base.rangeBetween(-hour_ms, 0)
    lastn = W.partitionBy("customer_id").orderBy("event_timestamp", "transaction_id") \
        .rowsBetween(-(last_n - 1), 0)
    vin, vout, _ = _rolling_values(df)
    return (df.withColumn("total_in_24h", F.sum(vin).over(day).cast("decimal(38,2)"))
              .withColumn("total_out_24h", F.sum(vout).over(day).cast("decimal(38,2)"))
              .withColumn("txn_count_1h", F.count(F.lit(1)).over(hour))
              .withColumn("last_txn_amounts", F.array_join(
                  F.collect_list(F.col("amount").cast("string")).over(lastn), ",")))


def _rolling_hot(h: DataFrame, day_ms: int, hour_ms: int, last_n: int, split: SplitParams) -> DataFrame:
    """T17 for split customers, without a per-customer window.

    Range sums are prefix differences: sum over [t - D, t] = P(t) - P(t - D - 1)
    with P(x) = sum of values at times <= x (integer ms). Every row adds two
    *probe* rows at t - D - 1 and t - H - 1; data and probes are segmented by
    time together, P is carry + running range sum per segment (probes add 0),
    and the three readings of a row meet in one aggregate by id. The last-n
    list takes the previous segments' last n-1 amounts as a carry. Time-less
    rows (segment -1, first in the order) use their peer group, as a range
    frame does."""
    key, t = "customer_id", F.col("event_timestamp")
    vin, vout, zero = _rolling_values(h)
    timed = h.filter(t.isNotNull())
    one = F.lit(1).cast("long")

    def rows(tt: Column, kind: int, a: Column, b: Column, c: Column) -> DataFrame:
        return timed.select(key, tt.cast("long").alias("_t"), "transaction_id", F.lit(kind).alias("_k"),
                            a.alias("_vin"), b.alias("_vout"), c.alias("_vc"))

    u = (rows(t, 0, vin, vout, one)
         .unionByName(rows(t - F.lit(day_ms + 1), 1, zero, zero, F.lit(0).cast("long")))
         .unionByName(rows(t - F.lit(hour_ms + 1), 2, zero, zero, F.lit(0).cast("long"))))
    u = sg.with_segments(u, key, F.col("_t"), split)
    order = sg.row_order(F.col("_t"), F.col("transaction_id"), True, sg.id_type(u, F.col("transaction_id")))
    u = sg.attach(u, key, sg.carries(u, key, order, True,
                                     sums={"_in": F.col("_vin"), "_out": F.col("_vout"), "_n": F.col("_vc")}))
    w = W.partitionBy(key, sg.SEG).orderBy("_t").rangeBetween(W.unboundedPreceding, 0)
    pin = _carry("_in", zero) + F.sum("_vin").over(w)
    pout = _carry("_out", zero) + F.sum("_vout").over(w)
    pn = _carry("_n", F.lit(0).cast("long")) + F.sum("_vc").over(w)
    p = u.select("transaction_id", "_k", pin.alias("_pin"), pout.alias("_pout"), pn.alias("_pn"))

    def pick(kind: int, c: str) -> Column:
        return F.max(F.when(F.col("_k") == kind, F.col(c)))

    sums = p.groupBy("transaction_id").agg(
        (pick(0, "_pin") - pick(1, "_pin")).cast("decimal(38,2)").alias("total_in_24h"),
        (pick(0, "_pout") - pick(1, "_pout")).cast("decimal(38,2)").alias("total_out_24h"),
        (pick(0, "_pn") - pick(2, "_pn")).cast("long").alias("txn_count_1h"))
    # time-less rows: the frame is the key's whole peer group of null times
    nulls = (h.filter(t.isNull()).groupBy(key)
              .agg(F.sum(vin).cast("decimal(38,2)").alias("_nin"), F.sum(vout).cast("decimal(38,2)").alias("_nout"),
                   F.count(F.lit(1)).alias("_nn")))
    # last-n amounts: in-segment frame plus the previous segments' tail
    amt = F.col("amount").cast("string")
    lw = W.partitionBy(key, sg.SEG).orderBy(t.asc_nulls_first(), F.col("transaction_id"))
    o = sg.row_order(t, F.col("transaction_id"), False, sg.id_type(h, F.col("transaction_id")))
    x = (h.withColumn("_in_seg", F.collect_list(amt).over(lw.rowsBetween(-(last_n - 1), 0)))
          .withColumn("_after", F.count(F.lit(1)).over(lw.rowsBetween(1, W.unboundedFollowing))))
    tails = (x.filter(F.col("_after") < last_n - 1).groupBy(key, sg.SEG)
              .agg(F.array_sort(F.collect_list(F.struct(o.alias("o"), amt.alias("a")))).alias("_tail")))
    sw = W.partitionBy(key).orderBy(sg.seg_order(nulls_last=False)).rowsBetween(-(last_n - 1), -1)
    prev = F.flatten(F.collect_list("_tail").over(sw))
    carry = tails.select(F.col(key).alias("_ck"), F.col(sg.SEG).alias("_cs"),
                         F.transform(F.slice(prev, F.greatest(F.size(prev) - (last_n - 2), F.lit(1)), last_n - 1),
                                     lambda e: e["a"]).alias("_prev_tail"))
    x = x.join(broadcast_if_small(carry), (F.col(key) == F.col("_ck")) & (F.col(sg.SEG) == F.col("_cs")), "left")
    full = F.concat(F.coalesce(F.col("_prev_tail"), F.array().cast("array<string>")), F.col("_in_seg"))
    x = x.withColumn("last_txn_amounts", F.array_join(
        F.slice(full, F.greatest(F.size(full) - (last_n - 1), F.lit(1)), last_n), ","))
    x = x.drop("_in_seg", "_after", "_ck", "_cs", "_prev_tail")
    x = x.join(sums, "transaction_id", "left").join(F.broadcast(nulls), key, "left")
    return (x.withColumn("total_in_24h", F.coalesce(F.col("total_in_24h"), F.col("_nin")))
             .withColumn("total_out_24h", F.coalesce(F.col("total_out_24h"), F.col("_nout")))
             .withColumn("txn_count_1h", F.coalesce(F.col("txn_count_1h"), F.col("_nn")))
             .drop("_nin", "_nout", "_nn"))


def rolling_features(df: DataFrame, day_ms: int = 86_400_000, hour_ms: int = 3_600_000,
                     last_n: int = 10, split: SplitParams = SplitParams()) -> DataFrame:
    """Declared rolling state: in/out totals over 24 h and count over 1 h
    (range frames on epoch ms, ties included), last ``last_n`` amounts.

    Ordinary customers use range windows per customer; customers above the
    split threshold take the prefix-difference path (``_rolling_hot``)."""
    s = segmented(df, "customer_id", "event_timestamp", split)
    if s.schema[sg.HOT].metadata.get(sg.UNSPLIT):
        return _rolling_plain(df, day_ms, hour_ms, last_n)
    cols = df.columns + ["total_in_24h", "total_out_24h", "txn_count_1h", "last_txn_amounts"]
    plain = _rolling_plain(s.filter(~F.col(sg.HOT)), day_ms, hour_ms, last_n).select(*cols)
    hot = _rolling_hot(s.filter(F.col(sg.HOT)), day_ms, hour_ms, last_n, split).select(*cols)
    return plain.unionByName(hot)


def customer_last_state(df: DataFrame) -> DataFrame:
    """Last activity per channel family, last country, last activity time.

    ``max_by`` is a partial aggregate, so a customer with a huge history is
    reduced map-side before the shuffle."""
    order = F.struct("event_timestamp", "transaction_id")
    ch = F.col("channel_type")

    def last_of(cond: Column, value: Column) -> Column:
        return F.max_by(F.when(cond, value), F.when(cond, order))

    return df.groupBy("customer_id").agg(
        last_of(ch == "MOBILE_APP", F.col("event_timestamp")).alias("last_mobile_ts"),
        last_of(ch == "MOBILE_APP", F.col("device_id")).alias("last_mobile_device"),
        last_of(ch == "MOBILE_APP", F.col("ip_country")).alias("last_mobile_ip_country"),
        last_of(ch == "MOBILE_APP", F.col("latitude")).alias("last_mobile_latitude"),
        last_of(ch == "MOBILE_APP", F.col("longitude")).alias("last_mobile_longitude"),
        last_of(ch.isin(*ATM_GROUP), F.col("event_timestamp")).alias("last_atm_ts"),
        last_of(ch.isin(*ATM_GROUP), F.col("latitude")).alias("last_atm_latitude"),
        last_of(ch.isin(*ATM_GROUP), F.col("longitude")).alias("last_atm_longitude"),
        last_of(ch == "WEB_BANKING", F.col("event_timestamp")).alias("last_web_ts"),
        last_of(ch == "WEB_BANKING", F.col("ip_country")).alias("last_web_ip_country"),
        last_of(ch == "SWIFT_WIRE", F.col("event_timestamp")).alias("last_wire_ts"),
        last_of(ch == "SWIFT_WIRE", F.col("country_code")).alias("last_wire_country"),
        last_of(ch == "SWIFT_WIRE", F.col("amount").cast("double")).alias("last_wire_amount"),
        last_of(F.col("country_code").isNotNull(), F.col("country_code")).alias("last_known_country"),
        F.max("event_timestamp").alias("last_activity_ts"),
        F.count(F.lit(1)).alias("txn_count"))


def on_time_rows(t: DataFrame) -> DataFrame:
    """DQ -> clean -> SLA -> on-time (reference order)."""
    from ledgerhawk.operators.latency import sla_metrics
    from ledgerhawk.operators.quality import dq_validate
    return sla_metrics(dq_validate(t).filter("dq_passed")).filter(~F.col("sla_breached"))


def decision_pipeline(t: DataFrame, p: DecisionParams = DecisionParams(),
                      processing_ms: Column | None = None, keep_features: bool | tuple = False,
                      split: SplitParams = SplitParams()) -> DataFrame:
    """Flagship batch chain: DQ -> clean -> SLA -> on-time -> decisions (reference order)."""
    return decide(on_time_rows(t), p, processing_ms=processing_ms, keep_features=keep_features, split=split)
