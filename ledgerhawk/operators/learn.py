"""Machine learning and model monitoring (ML1-ML9) on Spark MLlib.

Training runs distributed (MLlib); scoring is a native projection: cluster
centres are a handful of small vectors (k x d) put into the plan as literals,
so distance-to-centre stays in whole-stage codegen with no UDF.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerhawk.streaming.files import path_exists

ML_FEATURE_COLS = ("amount_usd_scaled", "local_hour_scaled", "amount_zscore_scaled", "failed_auth_count_scaled")
RAW_COLS = ("amount_usd_safe", "local_hour", "amount_zscore", "failed_auth_safe")


def with_safe_inputs(df: DataFrame) -> DataFrame:
    """Null-safe amount and failed-auth count."""
    return (df.withColumn("amount_usd_safe", F.coalesce(F.col("amount_usd"), F.col("amount")).cast("double"))
              .withColumn("failed_auth_safe", F.coalesce(F.col("failed_auth_count"), F.lit(0)).cast("double"))
              .withColumn("local_hour", F.col("local_hour").cast("double"))
              .withColumn("amount_zscore", F.coalesce(F.col("amount_zscore"), F.lit(0.0))))


def feature_stages():
    """ML1: assemble the raw inputs and scale them (unit variance)."""
    return [VectorAssembler(inputCols=list(RAW_COLS), outputCol="raw_features", handleInvalid="keep"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=False, withStd=True)]


def ml_features(df: DataFrame) -> tuple[PipelineModel, DataFrame]:
    model = Pipeline(stages=feature_stages()).fit(df)
    out = model.transform(df)
    arr = vector_to_array("features")
    return model, out.select("*", *[arr[i].alias(n) for i, n in enumerate(ML_FEATURE_COLS)])


def kmeans_profile(df: DataFrame, k: int = 4, seed: int = 42, max_iter: int = 20) -> PipelineModel:
    """ML2: KMeans of normal behaviour (assembler -> scaler -> KMeans)."""
    return Pipeline(stages=feature_stages() + [KMeans(k=k, seed=seed, maxIter=max_iter,
                                                      featuresCol="features",
                                                      predictionCol="ml_cluster_id")]).fit(df)


def distance_to_centre(features: Column, cluster: Column, centres) -> Column:
    """Euclidean distance between a vector and its assigned centre (native arrays)."""
    table = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centres])
    centre = F.element_at(table, cluster + F.lit(1))
    diffs = F.zip_with(vector_to_array(features), centre, lambda a, b: (a - b) * (a - b))
    return F.sqrt(F.aggregate(diffs, F.lit(0.0), lambda acc, x: acc + x))


def kmeans_score(df: DataFrame, model: PipelineModel | None, scale: float = 10.0) -> DataFrame:
    """ML3: risk = min(distance / scale, 1) and cluster id; fallback 0.0 / -1."""
    if model is None:
        return df.withColumn("ml_risk_score", F.lit(0.0)).withColumn("ml_cluster_id", F.lit(-1))
    centres = model.stages[-1].clusterCenters()
    scored = model.transform(df)
    d = distance_to_centre(F.col("features"), F.col("ml_cluster_id"), [list(c) for c in centres])
    return (scored.withColumn("ml_distance", d)
                  .withColumn("ml_risk_score", F.least(F.col("ml_distance") / F.lit(scale), F.lit(1.0)))
                  .withColumn("ml_cluster_id", F.col("ml_cluster_id").cast("int")))


def load_model(spark: SparkSession, path: str) -> PipelineModel | None:
    """A stored model, None where there is none (rules only); any other fault is raised."""
    return PipelineModel.load(path) if path_exists(spark, f"{path}/metadata") else None


def blend(decisions: DataFrame, weight: float = 0.0, block_pct: int = 75, flag_pct: int = 40) -> DataFrame:
    """ML9: optional weighted blend of the ML score into the composite (0 = as coded)."""
    score = F.least(F.col("composite_risk_score") + F.lit(weight) * F.col("ml_risk_score"), F.lit(1.0))
    hard = F.col("decision_action") == "BLOCK"
    return decisions.withColumns({                               # both from the score as it was
        "composite_risk_score": score,
        "decision_action": F.when(hard | (score >= block_pct / 100.0), "BLOCK")
                            .when(score >= flag_pct / 100.0, "FLAG_WAIT").otherwise("PASS")})


LR_INPUTS = ("Trans_amount_d", "transactions_last_day", "average_transaction_amount")


def lr_dataset(silver_with_features: DataFrame) -> DataFrame:
    return (silver_with_features.withColumn("Trans_amount_d", F.col("Trans_amount").cast("double"))
                                .withColumn("label", F.col("suspect_flag").cast("double")))


def lr_train(dataset: DataFrame, path: str | None = None, max_iter: int = 50) -> PipelineModel:
    """ML4: assembler + logistic regression; saved with overwrite when a path is given."""
    model = Pipeline(stages=[VectorAssembler(inputCols=list(LR_INPUTS), outputCol="features"),
                             LogisticRegression(featuresCol="features", labelCol="label",
                                                maxIter=max_iter)]).fit(dataset)
    if path:
        model.write().overwrite().save(path)
    return model


def accuracy(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """ML5: matching rows / rows in one aggregate."""
    return predictions.agg(F.try_divide(F.sum(F.when(F.col(label) == F.col(prediction), 1).otherwise(0))
                                        .cast("double"), F.count(F.lit(1)).cast("double")).alias("accuracy"),
                           F.count(F.lit(1)).alias("rows"))


def log_run(spark: SparkSession, path: str, run_id: str, params: dict, metrics: dict) -> DataFrame:
    """ML5 run tracking: one row per param/metric appended to a parquet table."""
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    rows = [(run_id, "param", k, str(v), None, now) for k, v in params.items()] + \
           [(run_id, "metric", k, None, float(v), now) for k, v in metrics.items()]
    df = spark.createDataFrame(rows, "run_id string, kind string, name string, text_value string, "
                                     "metric_value double, logged_at timestamp_ntz")
    df.write.mode("append").parquet(path)
    return spark.read.parquet(path)


def model_quality(df: DataFrame, prediction: Column, label: Column) -> DataFrame:
    """ML7: suspect rate, precision, recall, F1 from one confusion-matrix aggregate."""
    p, y = prediction.cast("int"), label.cast("int")
    cm = df.agg(F.count(F.lit(1)).alias("rows"),
                F.sum(y).cast("long").alias("positives"),
                F.sum(F.when((p == 1) & (y == 1), 1).otherwise(0)).cast("long").alias("tp"),
                F.sum(F.when((p == 1) & (y == 0), 1).otherwise(0)).cast("long").alias("fp"),
                F.sum(F.when((p == 0) & (y == 1), 1).otherwise(0)).cast("long").alias("fn"))
    prec = F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double"))
    rec = F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fn")).cast("double"))
    return (cm.withColumn("suspect_rate", F.try_divide(F.col("positives").cast("double"), F.col("rows").cast("double")))
              .withColumn("precision", prec).withColumn("recall", rec)
              .withColumn("f1", F.try_divide(2 * F.col("precision") * F.col("recall"),
                                             F.col("precision") + F.col("recall"))))


def feature_drift(df: DataFrame, period: Column, feature_edges: dict) -> DataFrame:
    """ML8: total variation distance 0..1 between two periods' binned
    distributions, per feature: 1/2 * sum |p - q| over fixed bins. One scan and one
    shuffle of the per-bin counts, whatever the number of features."""
    def bin_of(name: str, edges) -> Column:
        b = F.lit(0)
        for e in edges:
            b = b + F.when(F.col(name) >= F.lit(e), 1).otherwise(0)
        return F.struct(F.lit(name).alias("feature"), b.alias("bin"))

    pairs = df.select(period.alias("_period"), F.explode(F.array(*[bin_of(*x) for x in feature_edges.items()])).alias("x"))
    counts = pairs.groupBy("x.feature", "x.bin").agg(F.sum(F.when(F.col("_period") == 0, 1).otherwise(0)).alias("a"),
                                                     F.sum(F.when(F.col("_period") == 1, 1).otherwise(0)).alias("b"))
    w = Window.partitionBy("feature")          # one row per bin
    return (counts.withColumn("ta", F.sum("a").over(w)).withColumn("tb", F.sum("b").over(w)).groupBy("feature")
                  .agg((F.sum(F.abs(F.col("a") / F.col("ta") - F.col("b") / F.col("tb"))) / 2).alias("drift_score")))

