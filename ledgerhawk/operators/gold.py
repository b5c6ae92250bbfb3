"""Gold aggregates and reports (A1-A8), joins (J1, J2), dedup (C1), replay.

All aggregates are partial+final hash aggregates (map-side combine), so a hot
key is reduced before it is shuffled. Averages are double(sum)/count over
exact decimal sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from ledgerhawk.functions.joins import broadcast_if_small
from ledgerhawk.streaming.files import path_exists


def _suspect(flag: str = "suspect_flag") -> Column:
    return F.sum(F.when(F.col(flag) == 1, 1).otherwise(0)).cast("long")


def write_by_day(df: DataFrame, path: str, ts: str) -> None:
    """Partitioned table by day of ``ts``; only the days that ``df`` has are replaced, each
    as a whole, so a rerun of a day adds nothing."""
    df.withColumn("day_of", F.to_date(ts)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("day_of").parquet(path)


def write_gold(df: DataFrame, path: str, days=("year", "month", "day")) -> None:
    """Gold rows by the day columns they carry, overwritten day by day."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*days).parquet(path)


def suspect_kpis(silver: DataFrame, ts: str = "Trans_ts", amount: str = "Trans_amount") -> DataFrame:
    """A1: daily KPIs by year, month, day."""
    return (silver.groupBy(F.year(ts).alias("year"), F.month(ts).alias("month"), F.dayofmonth(ts).alias("day"))
                  .agg(F.count(F.lit(1)).alias("total_transactions"), _suspect().alias("suspect_transactions"),
                       F.sum(amount).alias("_sum"))
                  .select("year", "month", "day", "total_transactions", "suspect_transactions",
                          (F.col("_sum").cast("double") / F.col("total_transactions")).alias("avg_transaction_amount"),
                          F.col("_sum").cast("double").alias("total_transaction_amount"),
                          (F.col("suspect_transactions") / F.col("total_transactions")).alias("suspect_rate")))


def customer_risk(silver: DataFrame, key: str = "Clt_id", amount: str = "Trans_amount") -> DataFrame:
    """A2: per-customer count, average amount, suspect count and ratio."""
    return (silver.groupBy(key).agg(F.count(F.lit(1)).alias("transactions_count"),
                                    F.sum(amount).alias("_sum"), _suspect().alias("suspect_count"))
                  .select(key, "transactions_count",
                          (F.col("_sum").cast("double") / F.col("transactions_count")).alias("avg_amount"),
                          "suspect_count",
                          (F.col("suspect_count") / F.col("transactions_count")).alias("customer_risk_score")))


def suspect_by_category(df: DataFrame, flag: Column, category: str = "merchant_category") -> DataFrame:
    """A3: suspect cases per category, descending (unique tiebreak by name)."""
    return (df.filter(flag).groupBy(category).agg(F.count(F.lit(1)).alias("suspect_cases"))
              .orderBy(F.desc("suspect_cases"), F.asc(category)))


def repeat_suspects(df: DataFrame, flag: Column, min_count: int = 1, key: str = "customer_id") -> DataFrame:
    """A4: customers with more than ``min_count`` suspicious transactions."""
    return (df.filter(flag).groupBy(key).agg(F.count(F.lit(1)).alias("suspicious_count"))
              .filter(F.col("suspicious_count") > min_count))


def customer_risk_trend(silver: DataFrame, period: str = "month", key: str = "Clt_id",
                        ts: str = "Trans_ts") -> DataFrame:
    """A5: A2 per period, and the change of the suspect ratio against the previous period.

    The window runs over the per-(customer, period) aggregate, not the raw rows."""
    agg = (silver.groupBy(key, F.date_trunc(period, ts).cast("timestamp_ntz").alias("period_start"))
                 .agg(F.count(F.lit(1)).alias("transactions_count"), _suspect().alias("suspect_count"))
                 .withColumn("risk_ratio", F.col("suspect_count") / F.col("transactions_count")))
    w = W.partitionBy(key).orderBy("period_start")
    return agg.withColumn("risk_change", F.col("risk_ratio") - F.lag("risk_ratio").over(w))


def suspect_trend(silver: DataFrame, period: str = "day", ts: str = "Trans_ts") -> DataFrame:
    """Suspect per period and running totals.

    The running window has no partition key, but it runs over the per-period
    aggregate (one row per day: bounded by the calendar, not by the data)."""
    agg = (silver.groupBy(F.date_trunc(period, ts).cast("timestamp_ntz").alias("period_start"))
                 .agg(F.count(F.lit(1)).alias("total_transactions"), _suspect().alias("suspect_transactions")))
    w = W.orderBy("period_start").rowsBetween(W.unboundedPreceding, W.currentRow)
    return (agg.withColumn("running_suspect", F.sum("suspect_transactions").over(w))
               .withColumn("running_total", F.sum("total_transactions").over(w)))


def client_features(df: DataFrame, key: str = "Clt_id", amount: str = "Trans_amount") -> DataFrame:
    """Per-client count (named as in the reference) and average amount."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("transactions_last_day"), F.sum(amount).alias("_sum"))
              .select(key, "transactions_last_day",
                      (F.col("_sum").cast("double") / F.col("transactions_last_day")).alias("average_transaction_amount")))


def feature_join(df: DataFrame, key: str = "Clt_id", amount: str = "Trans_amount") -> DataFrame:
    """Transactions joined with their client's aggregate.

    Aggregate first (map-side combined), then an equi-join on the client key;
    the aggregate side has one row per client, and AQE's skew-join split handles
    a client holding a large share of the rows."""
    return df.join(client_features(df, key, amount), key)


def dim_lookup(df: DataFrame, dim: DataFrame, fk: str, dim_key: str, value: str, out: str,
               default=-1) -> DataFrame:
    """Left lookup of a dimension attribute with a default for misses."""
    d = broadcast_if_small(dim.select(F.col(dim_key).alias("_dk"), F.col(value).alias(out)))
    return (df.join(d, F.col(fk) == F.col("_dk"), "left").drop("_dk")
              .withColumn(out, F.coalesce(F.col(out), F.lit(default))))


def decision_mix(decisions: DataFrame) -> DataFrame:
    """Decision mix per channel."""
    return decisions.groupBy("channel_type", "decision_action").agg(F.count(F.lit(1)).alias("decisions"))


def _fixed_width(kind: T.DataType) -> bool:
    return isinstance(kind, (T.IntegralType, T.FractionalType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)) \
        and not (isinstance(kind, T.DecimalType) and kind.precision > 18)


def dedup_batch(df: DataFrame, keys=("transaction_id", "trans_ref_no")) -> DataFrame:
    """Exact dedup with map-side combine. Of rows with the same keys the one with
    the least XXH64 of its columns stays, so a rerun keeps the same row. Hand it the columns
    that are read after it: no others are scanned, and if those beside the keys are of fixed
    width, it is a hash aggregate."""
    rest = [c for c in df.columns if c not in keys]
    order = F.xxhash64(*[F.col(c) for c in df.columns])
    if all(_fixed_width(df.schema[c].dataType) for c in rest):
        return df.groupBy(*keys).agg(*[F.min_by(c, order).alias(c) for c in rest]).select(*df.columns) if rest else df.distinct()
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_kept")) \
        .select(*[F.col(f"_kept.{c}") if c in rest else F.col(c) for c in df.columns])


# ----------------------------------------------------------------- S15 by changed day
def changed_days(rows: DataFrame, ts: str = "Trans_ts") -> list:
    """Days that new rows touch; as many as the calendar has, whatever the rows."""
    return sorted(r["day_of"] for r in rows.select(F.to_date(ts).alias("day_of")).where("day_of IS NOT NULL").distinct().collect())


def refresh_gold(spark: SparkSession, silver_path: str, gold_path: str, days: list, key: str = "Clt_id",
                 ts: str = "Trans_ts", amount: str = "Trans_amount") -> None:
    """Gold tables of ``days`` from stored silver (``write_by_day``), of which only those
    days are read: partial sums a day and a day and client, the KPIs (A1) of those days, and
    the trend (A6) from the first of them on, whose running totals go on from the day before.
    Other days' files stay as they are; a repeated run replaces its own."""
    if not days:
        return
    rows = spark.read.parquet(silver_path).where(F.col("day_of").isin(days))
    sums = [F.count(F.lit(1)).alias("transactions"), _suspect().alias("suspects"), F.sum(amount).alias("total")]
    _replace_days(rows.groupBy("day_of").agg(*sums), f"{gold_path}/days")
    _replace_days(rows.groupBy("day_of", key).agg(*sums), f"{gold_path}/clients")
    _replace_days(suspect_kpis(rows, ts, amount).withColumn("day_of", F.make_date("year", "month", "day")), f"{gold_path}/kpis")
    suffix = spark.read.parquet(f"{gold_path}/days").where(F.col("day_of") >= F.lit(min(days)))
    before = (0, 0)
    if path_exists(spark, f"{gold_path}/trend"):
        last = spark.read.parquet(f"{gold_path}/trend").where(F.col("day_of") < F.lit(min(days))) \
            .agg(F.max_by(F.struct("running_suspect", "running_total"), "day_of").alias("r")).first()["r"]
        before = tuple(last) if last else before
    w = W.orderBy("day_of").rowsBetween(W.unboundedPreceding, W.currentRow)         # a row a day
    _replace_days(suffix.select("day_of", F.col("day_of").cast("timestamp_ntz").alias("period_start"), F.col("transactions").alias("total_transactions"),
                                F.col("suspects").alias("suspect_transactions"), (F.sum("suspects").over(w) + F.lit(before[0])).alias("running_suspect"),
                                (F.sum("transactions").over(w) + F.lit(before[1])).alias("running_total")), f"{gold_path}/trend")


def _replace_days(df: DataFrame, path: str) -> None:
    df.repartition("day_of").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day_of").parquet(path)


def customer_risk_from_days(clients: DataFrame, key: str = "Clt_id") -> DataFrame:
    """A2 from the stored partial sums a day and client."""
    n, bad = F.sum("transactions"), F.sum("suspects")
    return clients.groupBy(key).agg(n.alias("transactions_count"), (F.sum("total").cast("double") / n).alias("avg_amount"),
                                    bad.alias("suspect_count"), (bad / n).alias("customer_risk_score"))


# ----------------------------------------------------------------- S16 replay
def replay_marks_from(sent: DataFrame, channel: str = "channel_type", ident: str = "transaction_id") -> DataFrame:
    """Stored high-water marks: channel -> last id already published."""
    return sent.groupBy(channel).agg(F.max(ident).alias("last_id"))


def replay_resume(df: DataFrame, marks: DataFrame, channel: str = "channel_type",
                  ident: str = "transaction_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Per channel, skip ids <= stored mark, emit the rest, new mark = max id.

    Marks have one row per channel and are broadcast if their size is small. Returns (rows to emit, report per channel, new marks)."""
    m = broadcast_if_small(marks.select(F.col(channel).alias("_ch"), F.col("last_id").alias("_mark")))
    j = df.join(m, F.col(channel) == F.col("_ch"), "left")
    fresh = F.col(ident) > F.coalesce(F.col("_mark"), F.lit(0))
    emit = j.filter(fresh).drop("_ch", "_mark")
    report = (j.groupBy(channel).agg(F.count(F.lit(1)).alias("total"),
                                     F.sum(F.when(fresh, 0).otherwise(1)).cast("long").alias("skipped"),
                                     F.sum(F.when(fresh, 1).otherwise(0)).cast("long").alias("new"),
                                     F.max(F.when(fresh, F.col(ident))).alias("_newmax"),
                                     F.max("_mark").alias("_old")))
    new_marks = report.select(channel, F.coalesce("_newmax", "_old").alias("last_id"))
    return emit, report.drop("_newmax", "_old"), new_marks
