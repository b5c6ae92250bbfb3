"""Batch scans of the input tables (S5) and header CSV scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerhawk.session import prepare

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; Catalyst prunes columns and pushes filters into it."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def csv_scan(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV by path or glob with a header and a declared schema (no inference pass)."""
    return (spark.read.option("header", True).option("mode", "PERMISSIVE")
            .schema(schema).csv(path))
