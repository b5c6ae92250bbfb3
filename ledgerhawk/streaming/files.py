"""Folders of stored tables, through whatever file system their path names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DONE = "_SUCCESS"                           # Spark's writers put it last, so it commits a folder


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below ``path``; none if it does not exist."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def marks(spark: SparkSession, path: str) -> list[str]:
    """Names of the empty files below ``path``."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isFile()) if fs.exists(p) else []


def mark(spark: SparkSession, path: str) -> None:
    """Make an empty file, all at once."""
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file, replacing it."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def committed(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below ``path`` whose write was finished."""
    return [n for n in folders(spark, path) if path_exists(spark, f"{path}/{n}/{DONE}")]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of a table that this library keeps."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_runs(spark: SparkSession, base: str, paths: list[str], schema) -> DataFrame:
    """Rows of Parquet folders below ``base``, of one schema and with the partition columns
    that their paths name; no folders are an empty table."""
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*paths)
