"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerhawk.session import prepare, scratch_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
TOKENIZER_DIR = "/opt/tokenizers"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stored table; the path is whatever Spark's readers accept."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared scratch folder and read back: cuts lineage with a
    copy that survives lost executors, and fixes what several consumers see."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")             # the written copy replaces the shuffle files
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, whatever else the table carries; null text is empty."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def rows_of(batches: Iterator, size: int = 4096) -> Iterator:
    """Arrow batches cut to at most ``size`` rows, so that a worker's lists stay small."""
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)
