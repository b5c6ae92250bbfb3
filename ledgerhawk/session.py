"""Session construction and the shared scratch/checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "ledgerhawk", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, the submitter's session is used as-is."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.sql.streaming.stateStore.providerClass",
                 "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
         .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
         .config("spark.driver.memory", os.environ.get("LEDGERHAWK_DRIVER_MEM", "8g"))
         .config("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024)))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``ledgerhawk`` importable in Python workers (like ``--py-files``).

    The archive is built once per context on the driver and distributed by
    Spark itself; nothing on executors depends on a local path."""
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="ledgerhawk-pyfiles-"), "ledgerhawk.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    # Runners that do not receive py-files (the stateful-processor planner, the
    # foreachBatch runner) get our functions and classes pickled by value.
    import ledgerhawk
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(ledgerhawk)
    _SHIPPED.add(key)


def prepare(spark: SparkSession) -> SparkSession:
    """Per-query session guards: UTC wall clock so NTZ->timestamp casts are
    stable, and the package shipped to the Python workers."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir`` (or the context's checkpoint dir).
    A fresh local temp dir is made only in local mode, where every task runs on
    this machine; on any other master the setting is required.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="ledgerhawk-ckpt-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, never reused sub-folder of the shared scratch root."""
    return f"{scratch_root(spark)}/ledgerhawk/{name}-{uuid.uuid4().hex[:12]}"
