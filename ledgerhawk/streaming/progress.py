"""Progress of streaming queries as a table.

A listener puts the report of every micro-batch in a file of its own below
``path``, by query and batch, so a batch that is run again after a restart replaces its
report. Rows dropped by the watermark, offsets and input rows are then ordinary columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.window import Window as W

from ledgerhawk.streaming.files import folders, put_text

REPORT = ("id string, runId string, batchId long, timestamp string, numInputRows long, eventTime map<string,string>, "
          "sources array<struct<description:string,startOffset:string,endOffset:string,numInputRows:long>>, "
          "stateOperators array<struct<operatorName:string,numRowsTotal:long,numRowsUpdated:long,numRowsDroppedByWatermark:long>>")


class ProgressLog(StreamingQueryListener):
    """``with ProgressLog(spark, path): ...`` reports all queries that run inside."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        text = p.json if isinstance(p.json, str) else p.json()
        if p.numInputRows > 0:                                  # batches without rows have no offsets to join up
            put_text(self.spark, f"{self.path}/query={p.id}/batch-{p.batchId:09d}.json", text.replace("\n", " "))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def __enter__(self):
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_):
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()    # reports come on a thread of their own
        self.spark.streams.removeListener(self)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """A row a micro-batch: ``query_id, run_id, batch_id, input_rows, dropped_rows,
    start_offset, end_offset, joins_up``; the last tells whether the batch starts where the
    query's batch before it ended, across restarts too. Offsets are of the first source."""
    raw = spark.read.schema(REPORT).json(path) if folders(spark, path) else spark.createDataFrame([], REPORT)
    dropped = F.aggregate("stateOperators", F.lit(0).cast("long"), lambda n, o: n + F.coalesce(o["numRowsDroppedByWatermark"], F.lit(0).cast("long")))
    source = F.get("sources", 0)
    rows = raw.select(F.col("id").alias("query_id"), F.col("runId").alias("run_id"), F.col("batchId").alias("batch_id"), F.col("numInputRows").alias("input_rows"),
                      F.coalesce(dropped, F.lit(0).cast("long")).alias("dropped_rows"), source["startOffset"].alias("start_offset"), source["endOffset"].alias("end_offset"))
    before = F.lag("end_offset").over(W.partitionBy("query_id").orderBy("batch_id"))
    return rows.withColumn("joins_up", before.eqNullSafe(F.col("start_offset")))
