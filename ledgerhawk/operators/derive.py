"""Projections, filters and derived columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerhawk.operators.gold import dedup_batch
from ledgerhawk.config import HOLIDAYS, SilverParams, StepRiskParams
from ledgerhawk.functions.geo import haversine
from ledgerhawk.functions.joins import broadcast_if_small
from ledgerhawk.operators import segments as sg
from ledgerhawk.operators.segments import SplitParams
from ledgerhawk.operators.sequence import _micros, segmented, time_since_last

FMT_12H = "yyyy-MM-dd hh:mm:ss a"
FMT_24H = "yyyy-MM-dd HH:mm:ss"


def is_weekend(ts: Column) -> Column:
    """1 on Saturday/Sunday, 0 otherwise (null time -> 0)."""
    return F.when(ts.isNotNull() & F.dayofweek(ts).isin(1, 7), F.lit(1)).otherwise(F.lit(0))


def is_holiday(ts: Column, holidays=HOLIDAYS) -> Column:
    """1 when the date is in the holiday list (a parameter)."""
    dates = [F.lit(d).cast("date") for d in holidays]
    return F.when(F.to_date(ts).isin(*dates), F.lit(1)).otherwise(F.lit(0))


def risk_step(amount: Column, weekend: Column, p: StepRiskParams = StepRiskParams()) -> Column:
    """Amount > limit -> high, weekend -> weekend score, else base."""
    return (F.when(amount > F.lit(p.amount_limit), F.lit(p.high))
             .when(weekend == 1, F.lit(p.weekend)).otherwise(F.lit(p.base)))


def is_suspect(risk: Column, p: StepRiskParams = StepRiskParams()) -> Column:
    """P10: 1 when the step risk exceeds the suspect threshold."""
    return F.when(risk > F.lit(p.suspect_above), F.lit(1)).otherwise(F.lit(0))


def adjusted_amount(amount: Column, factor: float) -> Column:
    """One multiply with a factor parameter (-1, 1.5, 1.05 in the three jobs)."""
    return (amount.cast("decimal(18,2)") * F.lit(factor).cast("decimal(10,4)")).cast("double")


def risk_band(amount: Column, ident: Column, limit: float = 5000.0) -> Column:
    """70-100 above the limit, 0-40 below; the position inside the band is a
    deterministic function of the id (reproducible, no ``rand()``)."""
    return (F.when(amount > F.lit(limit), F.lit(70.0) + (ident * 13 % 3001) / F.lit(100.0))
             .otherwise((ident * 13 % 4001) / F.lit(100.0)))


def distance_from_last(df: DataFrame, key: str, ts: str, ident: str,
                       split: SplitParams = SplitParams()) -> DataFrame:
    """Haversine km from the key's previous location; first row 0.0.

    Ordered per (key, segment) like T16; the first row of a hot key's segment
    takes the previous location from the segments before it."""
    own = sg.SEG not in df.columns
    s = segmented(df, key, ts, split, ident)
    t = _micros(s, ts)
    order = sg.row_order(t, F.col(ident), False, sg.id_type(s, F.col(ident)))
    s = sg.attach(s, key, sg.carries(s, key, order, False, last_row={
        "_prev_lat": F.col("latitude"), "_prev_lon": F.col("longitude")}))
    w = sg.seg_window(key, F.col(ts).asc_nulls_first(), F.col(ident))
    first = F.row_number().over(w) == 1
    lat = F.when(first, F.col("_c_prev_lat")).otherwise(F.lag("latitude").over(w))
    lon = F.when(first, F.col("_c_prev_lon")).otherwise(F.lag("longitude").over(w))
    out = s.withColumn("distance_from_last_loc", haversine(lat, lon, F.col("latitude"), F.col("longitude"))) \
        .drop("_c_prev_lat", "_c_prev_lon")
    return out.drop(sg.SEG, sg.HOT) if own else out


def outcome_class(status: Column, suspect: Column, failed=("Rejected", "Failed")) -> Column:
    """1 normal, 2 failed, 3 suspect, 4 failed suspect."""
    bad = status.isin(*failed)
    return (F.when((suspect == 1) & bad, F.lit(4)).when(suspect == 1, F.lit(3))
             .when(bad, F.lit(2)).otherwise(F.lit(1)))


def failed_txn(df: DataFrame, status_col: str = "Trans_status",
               failed_values=("Failed", "Rejected")) -> DataFrame:
    """Failed transactions (the domain of failure values is a parameter)."""
    return df.filter(F.col(status_col).isin(*failed_values))


def silver_filter(df: DataFrame, p: SilverParams = SilverParams(), amount: str = "Trans_amount",
                  currency: str = "Currency", ts: str = "Trans_ts") -> DataFrame:
    """Business rules of silver, one conjunctive filter (pushed to the scan)."""
    a = F.col(amount)
    return df.filter((a > F.lit(p.min_amount)) & (a <= F.lit(p.max_amount))
                     & F.col(currency).isin(*p.currencies)
                     & F.year(ts).between(p.min_year, p.max_year))


def silver_standardize(df: DataFrame, cols=("Currency", "Trans_type", "Trans_status")) -> DataFrame:
    """Trimmed upper-case text columns."""
    for c in cols:
        df = df.withColumn(c, F.upper(F.trim(F.col(c))))
    return df


def enrich_card(df: DataFrame, step: StepRiskParams = StepRiskParams(), factor: float = 1.5) -> DataFrame:
    """Card-stream enrichment: weekend/holiday flags, step risk, suspect flag,
    distance and time since the client's previous transaction, outcome class,
    risk band and adjusted amount (P7-P14, T16). Both ordered scans share one
    segmentation, so the rows are shuffled once, on (client, segment)."""
    df = segmented(df.withColumnRenamed("Trans_id", "transaction_id"), "Clt_id", "Trans_ts")
    df = time_since_last(df, key="Clt_id", ts="Trans_ts")
    df = distance_from_last(df, "Clt_id", "Trans_ts", "transaction_id") \
        .drop(sg.SEG, sg.HOT).withColumnRenamed("transaction_id", "Trans_id")
    wk = is_weekend(F.col("Trans_ts"))
    risk = risk_step(F.col("Trans_amount"), wk, step)
    return (df.withColumn("is_weekend", wk)
              .withColumn("is_holiday", is_holiday(F.col("Trans_ts")))
              .withColumn("step_risk", risk)
              .withColumn("suspect_flag", is_suspect(risk, step))
              .withColumn("junk_sk", outcome_class(F.col("Trans_status"), F.col("suspect_flag")))
              .withColumn("risk_score", risk_band(F.col("Trans_amount"), F.col("Trans_id"), step.band_limit))
              .withColumn("new_current_amount", adjusted_amount(F.col("Trans_amount"), factor)))


def fact_projection(enriched: DataFrame) -> DataFrame:
    """Fact schema E7, partition columns last."""
    return enriched.select(
        F.col("Trans_id").alias("trans_sk"), F.col("Clt_id").alias("clt_sk"),
        F.col("Card_id").alias("card_sk"), F.col("Dev_id").alias("device_sk"),
        F.col("Trans_ts").alias("event_timestamp"), "junk_sk",
        F.col("Trans_Ref_No").alias("trans_ref_no"), F.col("Trans_destination").alias("trans_destination"),
        F.col("Dev_Ip_Location").alias("dev_ip_location"), F.col("Country_Src").alias("country_src"),
        F.col("Country_Dest").alias("country_dest"), F.col("Trans_Reason").alias("trans_reason"),
        F.col("Currency").alias("currency"), F.col("Dest_account_No").alias("dest_account_no"),
        F.col("Trans_amount").alias("trans_amount"), "time_since_last_trans", "distance_from_last_loc",
        "risk_score", "new_current_amount",
        F.col("Trans_type").alias("trans_type"), F.col("Trans_status").alias("trans_status"))


def fact_surrogate_keys(enriched: DataFrame, clients: DataFrame, nations: DataFrame) -> DataFrame:
    """P2 + J2: fact schema E8 with derived date/time keys and looked-up dimension keys.

    Dimensions are joined left with default key -1; each is broadcast only if its
    estimated size is under the limit, otherwise the planner shuffles it."""
    clients = broadcast_if_small(clients.select(F.col("c_custkey").alias("_ck"),
                                                F.col("c_custkey").alias("clt_sk")))
    nations = broadcast_if_small(nations.select(F.col("n_nationkey").alias("_nk"),
                                                F.col("n_name").alias("country_src_name")))
    j = (enriched.join(clients, F.col("Clt_id") == F.col("_ck"), "left")
                 .join(nations, F.col("Country_Src") == F.col("_nk"), "left"))
    return j.select(
        F.col("Trans_id").alias("trans_sk"),
        F.coalesce("clt_sk", F.lit(-1).cast("long")).alias("clt_sk"),
        F.col("Card_id").alias("card_sk"),
        F.col("Dev_id").alias("device_sk"),
        F.date_format("Trans_ts", "yyyyMMdd").cast("int").alias("date_sk"),
        F.date_format("Trans_ts", "HHmmss").cast("int").alias("time_sk"),
        "junk_sk", F.col("Trans_id").alias("trans_id"), F.col("Trans_Ref_No").alias("trans_ref_no"),
        F.coalesce("country_src_name", F.lit("UNKNOWN")).alias("country_src_name"),
        F.col("Trans_amount").alias("trans_amount"), "risk_score", "new_current_amount",
        F.col("Trans_type").alias("trans_type"), F.col("Trans_status").alias("trans_status"))


SILVER_KEYS = ("Trans_id", "Trans_Ref_No")


def silver(cards: DataFrame, p: SilverParams = SilverParams(), step: StepRiskParams = StepRiskParams(),
           columns: tuple | None = None) -> DataFrame:
    """Bronze -> silver: business rules (P16), dedup (C1), standardise (P17) and the
    suspect flag gold needs (P9/P10), keeping the event time (X6). The rules stand below the
    dedup, at the scan: a key stays if one of its copies keeps them. ``columns``: those that
    are read afterwards, beside the flag; by default all."""
    wanted = list(dict.fromkeys([*SILVER_KEYS, "Trans_ts", "Trans_amount", *(cards.columns if columns is None else columns)]))
    s = dedup_batch(silver_filter(cards, p).select(*wanted), SILVER_KEYS)
    if "Currency" in wanted:
        s = silver_standardize(s, cols=("Currency",))
    wk = is_weekend(F.col("Trans_ts"))
    return s.withColumn("suspect_flag", is_suspect(risk_step(F.col("Trans_amount"), wk, step), step))
