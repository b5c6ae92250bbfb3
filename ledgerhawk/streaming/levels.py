"""Keyed serving table as levels of sorted runs with committed versions.

A batch adds one run of its newest row a key to level 0, sorted by key in hash buckets. When
level 0 has ``FAN`` runs they are merged: into the one run of level 1 if they have grown to
``SHARE`` of it, else among themselves, so that a row is rewritten a bounded number of times for
each doubling of the table. A version is a small folder that lists its runs and is
committed by its last file; runs have names of their own and never change, so readers keep
the version that they started with, a run without a version is never read, and a batch that
a version already has adds nothing when it is replayed.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerhawk.streaming.files import committed, folders, read_runs, remove

FAN, SHARE, BUCKETS, PARTS = 8, 0.5, 16, 4
PLACE = ("_bucket", "_part")
BATCH = "_batch"
VERSION_SCHEMA = "run string, level int, low long, high long, rows long, columns string"


def _bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def placed(rows: DataFrame, key: str) -> DataFrame:
    """Rows in the tasks that write them: a bucket is dealt to ``PARTS`` tasks by key."""
    return rows.withColumns({"_bucket": _bucket(F.col(key)), "_part": F.pmod(F.xxhash64(F.lit(1), F.col(key)), F.lit(PARTS)).cast("int")}).repartition("_bucket", "_part")


def newest(rows: DataFrame, key: str, order: list[str], by: tuple = ()) -> DataFrame:
    """Of the rows of a key the greatest by ``order``; rows without a key are no versions
    of each other and all stay. One pass over ``rows``; ``by`` are columns that follow from
    the key, by which rows may lie together already."""
    rest = [c for c in rows.columns if c != key and c not in by]
    values = [*order, *[c for c in rest if c not in order]]
    alone = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    latest = rows.withColumn("_alone", alone).groupBy(*by, key, "_alone").agg(F.max(F.struct(*values)).alias("_r"))
    return latest.select(*by, key, *[F.col(f"_r.{c}").alias(c) for c in rest])


class Serving:
    """Rows by ``key`` below ``path``; of one key's rows the latest batch's holds, within a
    batch the one greatest by ``version`` and then by the other columns."""

    def __init__(self, spark: SparkSession, path: str, key: str = "row_key", version: str = "version_ts", fan: int = FAN, share: float = SHARE):
        self.spark, self.path, self.key, self.version, self.fan, self.share = spark, path, key, version, fan, share

    # ------------------------------------------------------------ versions
    def versions(self) -> list[int]:
        return sorted(int(n.partition("=")[2]) for n in committed(self.spark, f"{self.path}/versions"))

    def runs(self, at: int | None = None) -> list:
        """Rows of VERSION_SCHEMA of a version, by default the last; none before the first."""
        if at is None:
            at = max(self.versions(), default=None)
        return [] if at is None else self.spark.read.schema(VERSION_SCHEMA).json(f"{self.path}/versions/v={at}").collect()

    def _commit(self, runs: list) -> None:
        n = max(self.versions(), default=0) + 1
        self.spark.createDataFrame(runs, VERSION_SCHEMA).coalesce(1).write.mode("overwrite").json(f"{self.path}/versions/v={n}")

    # ------------------------------------------------------------ writing
    def _write(self, rows: DataFrame, level: int, low: int, high: int):
        """A run of rows that are ``placed``, not yet in any version."""
        run = f"{low}-{high}-{uuid.uuid4().hex[:12]}"
        rows = rows.select(*[c for c in rows.columns if c not in PLACE], *PLACE)
        rows.sortWithinPartitions(*PLACE, self.key).drop("_part").write.partitionBy("_bucket").parquet(f"{self._base}/run={run}")
        fields = T.StructType([f for f in rows.schema.fields if f.name not in PLACE])
        return run, level, low, high, self._of([run], fields).count(), fields.json()

    @property
    def _base(self) -> str:
        return f"{self.path}/runs"

    def _of(self, runs: list[str], schema) -> DataFrame:
        return read_runs(self.spark, self._base, [f"{self._base}/run={r}" for r in runs], schema)

    def holds(self, batch_id: int) -> bool:
        """Whether the last version has a batch's rows."""
        return any(r["low"] <= batch_id <= r["high"] for r in self.runs())

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        if self.holds(batch_id):
            return
        runs = self.runs()
        rows = newest(placed(batch, self.key), self.key, [self.version], PLACE).withColumn(BATCH, F.lit(int(batch_id)).cast("long"))
        self._commit([*runs, self._write(rows, 0, batch_id, batch_id)])
        self.compact()

    def compact(self) -> None:
        """Merge level 0 once it has ``fan`` runs."""
        runs = self.runs()
        upper, base = [r for r in runs if r["level"] == 0], [r for r in runs if r["level"] == 1]
        if len(upper) < self.fan:
            return
        whole = sum(r["rows"] for r in upper) >= self.share * sum(r["rows"] for r in base)
        own, kept = (runs, []) if whole else (upper, base)
        if len(own) > len(upper):
            rows = placed(self._merged(own), self.key)
        else:
            rows = newest(placed(self._rows(own), self.key), self.key, [BATCH, self.version], PLACE)
        merged = self._write(rows, int(whole), min(r["low"] for r in own), max(r["high"] for r in own))
        self._commit([*kept, merged])

    def vacuum(self, keep: int = 2) -> None:
        """Drop all but the last ``keep`` versions, and the runs that no kept version lists."""
        versions = self.versions()
        used = {r["run"] for v in versions[-keep:] for r in self.runs(v)}
        for v in versions[:-keep]:
            remove(self.spark, f"{self.path}/versions/v={v}")
        for name in folders(self.spark, self._base):
            if name.partition("=")[2] not in used:
                remove(self.spark, f"{self._base}/{name}")

    # ------------------------------------------------------------ reading
    def _rows(self, runs: list, only: Column | None = None) -> DataFrame:
        """All rows of some runs; columns that a run does not have are null."""
        out = None
        for schema in sorted({r["columns"] for r in runs}):
            fields = T.StructType.fromJson(json.loads(schema))
            part = self._of([r["run"] for r in runs if r["columns"] == schema and r["rows"]], fields)
            if only is not None and "_bucket" in part.columns:         # an empty table has no buckets
                part = part.where(only)
            part = part.select(*fields.names)
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
        return out

    def _merged(self, runs: list, only: Column | None = None) -> DataFrame:
        """Level 0 is merged by key and replaces what level 1, whose keys are unique, has of
        it: only the smaller level is aggregated."""
        upper, base = [r for r in runs if r["level"] == 0], [r for r in runs if r["level"] == 1]
        if not upper:
            return self._rows(base, only)
        fresh = self._rows(upper, only)
        if len(upper) > 1:
            fresh = newest(fresh, self.key, [BATCH, self.version])
        if not base:
            return fresh
        old = self._rows(base, only).join(fresh.select(self.key), self.key, "left_anti")
        return old.unionByName(fresh, allowMissingColumns=True)

    def read(self, at: int | None = None) -> DataFrame | None:
        """The table as of a version, by default the last; None before the first batch."""
        runs = self.runs(at)
        return self._merged(runs).drop(BATCH) if runs else None

    def lookup(self, keys: list, at: int | None = None) -> DataFrame | None:
        """The rows of some keys: only their buckets are listed, and the key filter
        reaches the sorted files."""
        runs = self.runs(at)
        if not runs:
            return None
        kind = T.StructType.fromJson(json.loads(runs[0]["columns"]))[self.key].dataType
        asked = self.spark.createDataFrame([(k,) for k in keys], T.StructType([T.StructField("k", kind)]))
        buckets = [r["b"] for r in asked.select(_bucket(F.col("k")).alias("b")).distinct().collect()]
        return self._merged(runs, F.col("_bucket").isin(buckets) & F.col(self.key).isin(list(keys))).drop(BATCH)
