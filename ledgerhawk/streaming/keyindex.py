"""Index of the keys that a table holds, read in proportion to the batch that asks.

The keys of a range of batches are a *run*: files of sorted keys, one folder a hash bucket,
and a blocked Bloom filter as a table of 256-bit blocks. A batch joins its keys with the
blocks that are theirs, on (run, block), and then opens the key files of those runs and
buckets in which some key may be; a key that no filter knows is new without any file being
read. A run counts once its record below ``runs/`` is committed, which is written last.

Runs of ``FAN`` batches are merged into one, those of ``FAN`` squared again, so there are
some ``FAN`` runs for each power of it. Only runs of batches before the current one are
merged, and a batch asks only the runs before it: a replayed batch never finds itself.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerhawk.streaming.files import mark, marks, read_runs, remove

FAN = 8
BUCKETS = 16
BITS_A_KEY, BLOCK_BITS, WORDS = 16, 256, 4  # two bits a word: about one false key in a thousand
BLOCK_SCHEMA = "block long, " + ", ".join(f"w{i} long" for i in range(WORDS))


class Run(NamedTuple):
    low: int
    high: int
    keys: int
    blocks: int

    @property
    def name(self) -> str:
        return "-".join(map(str, self))


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), F.col(key)), F.lit(buckets)).cast("int")


def _block(key: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), F.col(key)), blocks)


def _masks(key: str) -> list[Column]:
    """The bits of a key in each word of its block."""
    bit = f"shiftleft(1L, int(shiftrightunsigned(xxhash64(2, {key}), {{}}) & 63))"
    return [F.expr(f"{bit.format(12 * i)} | {bit.format(12 * i + 6)}") for i in range(WORDS)]


class KeyIndex:
    """Keys of one column below ``path``; ``buckets`` must not change once there are runs."""

    def __init__(self, spark: SparkSession, path: str, key_type: T.DataType, buckets: int = BUCKETS, fan: int = FAN):
        self.spark, self.path, self.buckets, self.fan = spark, path, buckets, fan
        self.schema = T.StructType([T.StructField("k", key_type)])

    def _run(self, what: str, low: int, high: int) -> str:
        return f"{self.path}/{what}/run={low}-{high}"

    def _keys(self, folders: list[str]) -> DataFrame:
        return read_runs(self.spark, f"{self.path}/files", folders, self.schema).select("k")

    def runs(self) -> list[Run]:
        """Committed runs that no larger one contains, in order; few, since they are merged."""
        runs = [Run(*map(int, n.split("-"))) for n in marks(self.spark, f"{self.path}/runs")]
        return sorted(r for r in runs if not any((o.low, o.high) != (r.low, r.high) and o.low <= r.low and r.high <= o.high for o in runs))

    def add(self, low: int, high: int, keys: DataFrame) -> None:
        """Commit the run of batches ``low`` to ``high`` with the distinct, non-null keys
        in column ``k``. Written again, it replaces itself."""
        for r in self.runs():
            if (r.low, r.high) == (low, high):
                remove(self.spark, f"{self.path}/runs/{r.name}")
        files = self._run("files", low, high)
        keys.withColumn("bucket", _bucket("k", self.buckets)).repartition("bucket").sortWithinPartitions("bucket", "k") \
            .write.mode("overwrite").partitionBy("bucket").parquet(files)
        stored = self._keys([files])
        n = stored.count()
        blocks = max(1, math.ceil(n * BITS_A_KEY / BLOCK_BITS))
        stored.groupBy(_block("k", F.lit(blocks)).alias("block")).agg(*[F.bit_or(m).alias(f"w{i}") for i, m in enumerate(_masks("k"))]) \
            .write.mode("overwrite").parquet(self._run("filters", low, high))
        mark(self.spark, f"{self.path}/runs/{Run(low, high, n, blocks).name}")

    def candidates(self, keys: DataFrame, before: int) -> DataFrame | None:
        """``k, run, bucket`` wherever a filter of a run before ``before`` knows a key of
        ``keys`` (column ``k``, distinct); None where there is no run."""
        live = [r for r in self.runs() if r.high < before]
        if not live:
            return None
        places = F.explode(F.array(*[F.struct(F.lit(i).alias("run"), _block("k", F.lit(r.blocks)).alias("block")) for i, r in enumerate(live)]))
        asked = keys.select("k", *[m.alias(f"m{i}") for i, m in enumerate(_masks("k"))], places.alias("at")).select("*", "at.run", "at.block").drop("at")
        known = None
        for i, r in enumerate(live):
            part = self.spark.read.schema(BLOCK_SCHEMA).parquet(self._run("filters", r.low, r.high)).withColumn("run", F.lit(i))
            known = part if known is None else known.unionByName(part)
        hit = F.lit(True)
        for i in range(WORDS):
            hit = hit & (F.col(f"w{i}").bitwiseAND(F.col(f"m{i}")) == F.col(f"m{i}"))
        return asked.join(known, ["run", "block"]).where(hit).select("k", "run", _bucket("k", self.buckets).alias("bucket"))

    def known(self, keys: DataFrame, before: int) -> tuple[DataFrame | None, list[str]]:
        """The keys that batches before ``before`` hold, and the folders that were opened
        to tell, at most one a run and bucket."""
        found = self.candidates(keys, before)
        if found is None:
            return None, []
        found = found.persist()
        live = [r for r in self.runs() if r.high < before]
        opened = [f"{self._run('files', live[r['run']].low, live[r['run']].high)}/bucket={r['bucket']}"
                  for r in found.select("run", "bucket").distinct().sort("run", "bucket").collect()]
        if not opened:
            found.unpersist()
            return None, []
        return self._keys(opened).join(found.select("k").distinct(), "k", "left_semi"), opened

    def compact(self, batch_id: int) -> None:
        """Merge the runs of the last ``fan`` batches before ``batch_id``, or of a power of
        it, where that many are complete; the merged runs are then deleted."""
        span = 1
        while batch_id > 0 and batch_id % (span * self.fan) == 0:
            span *= self.fan
        low, high = batch_id - span, batch_id - 1
        inside = [r for r in self.runs() if low <= r.low and r.high <= high]
        if span == 1 or len(inside) < 2:
            return
        self.add(low, high, self._keys([self._run("files", r.low, r.high) for r in inside]))
        for r in inside:                                        # a run without its mark is no run
            remove(self.spark, f"{self.path}/runs/{r.name}")
            remove(self.spark, self._run("filters", r.low, r.high))
            remove(self.spark, self._run("files", r.low, r.high))
