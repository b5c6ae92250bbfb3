"""Centre models: cluster centres as a small stored table of versions (ML3, ML6, ML9).

A version is one JSON row in a folder of its own, committed by its last file. Scoring puts
the newest version's centres into the plan as literals, so a stream that looks for it in
each micro-batch takes a new model from its next batch on, without a restart.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerhawk.streaming.files import committed

SCHEMA = "scales array<double>, centres array<array<double>>, distance double"


@dataclass(frozen=True)
class CentreModel:
    """``scales`` divide the inputs, ``distance`` is the distance of full risk."""

    scales: tuple
    centres: tuple
    distance: float = 10.0
    version: int = 0

    @staticmethod
    def of(model: PipelineModel, distance: float = 10.0) -> "CentreModel":
        """From a fitted assembler, scaler and KMeans; an input without spread counts for nothing."""
        std = model.stages[1].std.toArray()
        return CentreModel(tuple(float(x) if x > 0 else float("inf") for x in std),
                           tuple(tuple(float(x) for x in c) for c in model.stages[-1].clusterCenters()), distance)


def publish(spark: SparkSession, path: str, model: CentreModel) -> int:
    """Store the model as the next version."""
    n = max(_versions(spark, path), default=0) + 1
    spark.createDataFrame([(list(model.scales), [list(c) for c in model.centres], model.distance)], SCHEMA) \
        .coalesce(1).write.json(f"{path}/v={n}")
    return n


def _versions(spark: SparkSession, path: str) -> list[int]:
    return [int(n.partition("=")[2]) for n in committed(spark, path)]


def newest(spark: SparkSession, path: str) -> CentreModel | None:
    """The last version, None where none is stored; any other fault is raised."""
    n = max(_versions(spark, path), default=None)
    if n is None:
        return None
    row = spark.read.schema(SCHEMA).option("allowNonNumericNumbers", "true").json(f"{path}/v={n}").first()
    return CentreModel(tuple(row["scales"]), tuple(map(tuple, row["centres"])), row["distance"], n)


def score(df: DataFrame, model: CentreModel | None, inputs: list[Column]) -> DataFrame:
    """``ml_cluster_id`` (the nearest centre, the first of equals), ``ml_risk_score`` =
    min(distance / full, 1) and ``model_version``; -1, 0.0 and 0 without a model. Null
    inputs count as 0."""
    if model is None:
        return df.withColumns({"ml_cluster_id": F.lit(-1), "ml_risk_score": F.lit(0.0), "model_version": F.lit(0)})
    scaled = [F.coalesce(x.cast("double"), F.lit(0.0)) / F.lit(s) for x, s in zip(inputs, model.scales)]
    far = []
    for centre in model.centres:
        squares = [(x - F.lit(float(c))) * (x - F.lit(float(c))) for x, c in zip(scaled, centre)]
        total = squares[0]
        for s in squares[1:]:
            total = total + s
        far.append(F.struct(F.sqrt(total).alias("far"), F.lit(len(far)).alias("id")))
    return df.withColumn("_near", F.array_min(F.array(*far))).withColumns({
        "ml_cluster_id": F.col("_near.id"), "ml_risk_score": F.least(F.col("_near.far") / F.lit(model.distance), F.lit(1.0)),
        "model_version": F.lit(model.version)}).drop("_near")


def decision_inputs() -> list[Column]:
    """What the model sees of a decision row: amount, hour of day, z-score."""
    return [F.col("amount_usd"), F.floor(F.col("event_timestamp") / 3_600_000) % 24, F.col("amount_zscore")]
