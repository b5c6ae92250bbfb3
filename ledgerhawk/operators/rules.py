"""Batch suspect rules (R1-R9) and their union.

Row rules share one pass (an array of reasons, exploded); window rules share
one hourly aggregate per (client, hour, source country, location country) that
is map-side combined, so a client with a huge history is reduced before the
shuffle; daily and distinct-country rules are re-aggregations of that small table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerhawk.config import RuleParams
from ledgerhawk.functions.joins import broadcast_if_small

ALERT_COLS = ("customer_id", "transaction_id", "window_start", "window_end", "txn_count", "suspect_reason")


def _ntz(c):
    return F.col(c).cast("timestamp_ntz")


def rule_high_amount(df: DataFrame, p: RuleParams = RuleParams()) -> DataFrame:
    """R1."""
    return (df.filter(F.col("amount") > F.lit(p.high_amount))
              .select("customer_id", "transaction_id", "amount", F.lit("High Amount").alias("suspect_reason")))


def hourly(df: DataFrame) -> DataFrame:
    """Shared hourly aggregate for R2, R4a, R4b, R6."""
    return (df.groupBy("customer_id", F.window("event_ts", "1 hour").alias("w"), "country_src", "country_code")
              .agg(F.count(F.lit(1)).alias("n")))


def _window_alerts(agg: DataFrame, keys, having, reason: str) -> DataFrame:
    return (agg.groupBy(*keys).agg(F.sum("n").alias("txn_count"),
                                   F.count_distinct("country_code").alias("countries"))
               .filter(having)
               .select("customer_id", _ntz("w.start").alias("window_start"), _ntz("w.end").alias("window_end"),
                       F.col("txn_count").cast("long").alias("txn_count"), F.lit(reason).alias("suspect_reason")))


def rule_velocity(df: DataFrame, p: RuleParams = RuleParams(), agg: DataFrame | None = None) -> DataFrame:
    """R2: more than N transactions per client per tumbling hour."""
    agg = agg if agg is not None else hourly(df)
    return _window_alerts(agg, ["customer_id", "w"], F.col("txn_count") > p.velocity_per_hour, "Velocity Check")


def rule_repeat_country(df: DataFrame, p: RuleParams = RuleParams(), agg: DataFrame | None = None) -> DataFrame:
    """R4a (as coded): more than N transactions from the same source country per client-hour."""
    agg = agg if agg is not None else hourly(df)
    out = (agg.groupBy("customer_id", "w", "country_src").agg(F.sum("n").alias("txn_count"))
              .filter(F.col("txn_count") > p.repeat_country_per_hour))
    return out.select("customer_id", "country_src", _ntz("w.start").alias("window_start"),
                      _ntz("w.end").alias("window_end"), F.col("txn_count").cast("long").alias("txn_count"),
                      F.lit("Impossible Travel").alias("suspect_reason"))


def rule_impossible_travel(df: DataFrame, p: RuleParams = RuleParams(), agg: DataFrame | None = None) -> DataFrame:
    """R4b (as stated): transactions from more than N distinct countries per client-hour."""
    agg = agg if agg is not None else hourly(df)
    return _window_alerts(agg, ["customer_id", "w"], F.col("countries") > p.distinct_countries_per_hour,
                          "Impossible Travel")


def rule_daily_frequency(df: DataFrame, p: RuleParams = RuleParams(), agg: DataFrame | None = None) -> DataFrame:
    """More than N transactions per client per tumbling day (re-aggregated from hours)."""
    agg = agg if agg is not None else hourly(df)
    day = agg.withColumn("w", F.window(F.col("w.start"), "1 day"))
    return _window_alerts(day, ["customer_id", "w"], F.col("txn_count") > p.daily_frequency, "Abnormal Frequency")


def rule_country_mismatch(df: DataFrame) -> DataFrame:
    """Source country differs from destination (nulls are not flagged)."""
    return (df.filter(F.col("country_src") != F.col("country_dest"))
              .select("customer_id", "transaction_id", "country_src", "country_dest",
                      F.lit("Country Mismatch").alias("suspect_reason")))


def rule_blacklist(df: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Destination on the blacklist, broadcast into a left-semi join if its size
    is small (no shuffle of the transactions)."""
    bl = broadcast_if_small(blacklist.select(F.col("name").alias("_bl")).distinct())
    return (df.join(bl, F.col("trans_destination") == F.col("_bl"), "left_semi")
              .select("customer_id", "transaction_id", "trans_destination",
                      F.lit("Blacklisted Merchant").alias("suspect_reason")))


def rule_odd_hours(df: DataFrame, p: RuleParams = RuleParams()) -> DataFrame:
    """Hour of day outside [from, to]."""
    h = F.hour("event_ts")
    return (df.filter(~h.between(p.odd_hour_from, p.odd_hour_to))
              .select("customer_id", "transaction_id", h.alias("hour_of_day"),
                      F.lit("Odd Hours").alias("suspect_reason")))


def expected_country(df: DataFrame) -> DataFrame:
    """Most frequent location country per client, ties to the smaller code."""
    from pyspark.sql.window import Window as W
    counts = df.groupBy("customer_id", "country_code").agg(F.count(F.lit(1)).alias("n"))
    w = W.partitionBy("customer_id").orderBy(F.desc("n"), F.asc("country_code"))
    return (counts.withColumn("_r", F.row_number().over(w)).filter("_r = 1")
                  .select("customer_id", F.col("country_code").alias("expected_country")))


def rule_unexpected_country(df: DataFrame) -> DataFrame:
    """Location country differs from the client's expected country.

    The expected-country table has one row per client; the join is a shuffle
    join on client id (AQE splits a skewed client's partition)."""
    exp = expected_country(df)
    return (df.join(exp, "customer_id")
              .filter(F.col("country_code") != F.col("expected_country"))
              .select("customer_id", "transaction_id", "country_code", "expected_country",
                      F.lit("Unexpected Country").alias("suspect_reason")))


def rules_union(df: DataFrame, blacklist: DataFrame, p: RuleParams = RuleParams()) -> DataFrame:
    """Every rule's alerts in one normalised schema, one scan for the row
    rules and one shared hourly aggregate for the window rules."""
    h = F.hour("event_ts")
    bl = broadcast_if_small(blacklist.select(F.col("name").alias("_bl")).distinct())
    rows = (df.join(bl, F.col("trans_destination") == F.col("_bl"), "left")
              .select("customer_id", "transaction_id", F.explode(F.array_compact(F.array(
                  F.when(F.col("amount") > F.lit(p.high_amount), F.lit("High Amount")),
                  F.when(F.col("country_src") != F.col("country_dest"), F.lit("Country Mismatch")),
                  F.when(F.col("_bl").isNotNull(), F.lit("Blacklisted Merchant")),
                  F.when(~h.between(p.odd_hour_from, p.odd_hour_to), F.lit("Odd Hours")),
              ))).alias("suspect_reason"))
              .select("customer_id", "transaction_id", F.lit(None).cast("timestamp_ntz").alias("window_start"),
                      F.lit(None).cast("timestamp_ntz").alias("window_end"),
                      F.lit(None).cast("long").alias("txn_count"), "suspect_reason"))
    agg = hourly(df)
    win = [rule_velocity(df, p, agg), rule_impossible_travel(df, p, agg), rule_daily_frequency(df, p, agg)]
    rc = rule_repeat_country(df, p, agg).drop("country_src")
    out = rows
    for w in win + [rc]:
        out = out.unionByName(w.withColumn("transaction_id", F.lit(None).cast("long")).select(*ALERT_COLS))
    return out
