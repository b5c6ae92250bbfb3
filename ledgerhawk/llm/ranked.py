"""Places of rows in their groups, however many rows one group has."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerhawk.llm.common import stored


def ranked(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``df``, which must read stored rows, with ``pos``: the place of a row in its
    ``group``, from 0, in ascending ``order`` (null first); rows that agree in all of it
    come in any fixed order. ``group`` is a column without nulls.

    Rows are ranged over partitions by group, order and a row number, so that a group with
    a third of all rows, or of equal rows, covers many of them; each piece counts its own
    rows and only the counts of the pieces meet."""
    columns = df.columns
    keys = [group, *order, "_row"]
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext
        piece, last, n = TaskContext.get().partitionId(), object(), 0
        at = columns.index(group)
        for b in batches:
            place = []
            for g in b.column(at).to_pylist():
                n = n + 1 if g == last else 0
                last = g
                place.append(n)
            more = [pa.array([piece] * len(place), pa.int32()), pa.array(place, pa.int64())]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], [*columns, "_piece", "_place"])

    rows = stored(numbered.repartitionByRange(width, *keys).sortWithinPartitions(*keys).select(*columns)
                  .mapInArrow(run, f"{fields}, _piece int, _place long"), name)
    before = Window.partitionBy(group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    moved = rows.groupBy(group, "_piece").agg(F.count(F.lit(1)).alias("_n")).withColumn("_ahead", F.sum("_n").over(before)) \
        .where("_ahead > 0").select(F.col(group).alias("_group"), F.col("_piece").alias("_at"), "_ahead")
    # a piece continues at most one group, so there are no more rows here than partitions
    both = rows.join(F.broadcast(moved), (F.col("_piece") == F.col("_at")) & (F.col(group) == F.col("_group")), "left")
    return both.select(*columns, (F.col("_place") + F.coalesce("_ahead", F.lit(0))).alias("pos"))
