"""Quality gate in the pass that writes (Q7, Q8).

A run is written once, and the counts that its checks need are observed by that same
write: nothing is shuffled after the observation, so a task that is run again counts once.
Only ``unique`` looks at the rows again: one grouped count over the key columns of the
stored run, for all such checks together.

The rows never move. A run's report, one small file written last, names the destination,
and readers take the runs whose report names theirs: a run without a report is in neither.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerhawk.operators.quality import scalar_counts, scalar_row
from ledgerhawk.streaming.files import marks

RUN = "gate_run"
SILVER, QUARANTINE = "silver", "quarantine"
REPORT = ("check_no int, expectation string, column_name string, element_count long, missing_count long, "
          "unexpected_count long, unexpected_percent double, success boolean, destination string")


def repeated_values(df: DataFrame, suite) -> dict[str, int]:
    """``u<check>`` of every ``unique`` check: the rows whose value another row has too.

    One scan and one grouped count: each row gives a key per check, with a slot of its own
    for each column so that values keep their types. Equal keys meet before the shuffle."""
    checks = [(i, e) for i, e in enumerate(suite) if e.kind == "unique"]
    if not checks:
        return {}
    kinds = {f"v{i}": df.schema[e.column].dataType for i, e in checks}
    keys = [F.struct(F.lit(i).alias("check"), *[(F.col(e.column) if name == f"v{i}" else F.lit(None).cast(kind)).alias(name)
                                                for name, kind in kinds.items()]) for i, e in checks]
    each = df.select(F.explode(F.array(*keys)).alias("key")).select("key.*")
    each = each.where(reduce(or_, [F.col(v).isNotNull() for v in kinds]))
    twice = each.groupBy("check", *kinds).agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    found = {r["check"]: r["u"] for r in twice.groupBy("check").agg(F.sum("k").alias("u")).collect()}   # a row a check
    return {f"u{i}": found.get(i, 0) for i, _ in checks}


def write_gated(df: DataFrame, suite, root: str, run: int) -> bool:
    """Write ``df`` as run ``run`` below ``root`` and report on it: silver if every check
    holds, else quarantine, as a whole. Returns whether it went to silver.

    A run that has a report is left as it is, whatever ``df`` holds, and its verdict is
    returned; one whose write was cut short is written anew. No rows pass every check but
    those of type. Several runs may be written at a time, one run by one writer."""
    spark = df.sparkSession
    report = f"{root}/report/{RUN}={run}"
    if not any(name.startswith("part-") for name in marks(spark, report)):       # one file, there as a whole or not at all
        seen = Observation()
        data = f"{root}/data/{RUN}={run}"
        df.observe(seen, *scalar_counts(suite)).write.mode("overwrite").parquet(data)
        counts = {**seen.get, **repeated_values(spark.read.schema(df.schema).parquet(data), suite)}
        fields = {f.name: f.dataType for f in df.schema.fields}
        one = spark.range(1).select(*[F.lit(v).cast("long").alias(k) for k, v in counts.items()])
        rows = one.select(F.inline(F.array(*[scalar_row(i, e, fields) for i, e in enumerate(suite)]))).collect() if suite else []
        where = SILVER if all(r["success"] for r in rows) else QUARANTINE
        if not suite:       # a report without checks still names the destination
            rows = [(None, None, None, counts["n"], None, None, None, True)]
        spark.createDataFrame([(*r, where) for r in rows], REPORT).coalesce(1).write.mode("overwrite").parquet(report)
    return spark.read.schema(REPORT).parquet(report).first()["destination"] == SILVER


def reports(spark: SparkSession, root: str) -> DataFrame:
    """Report rows of all runs, with their destination and ``gate_run``."""
    return spark.read.schema(f"{REPORT}, {RUN} int").parquet(f"{root}/report")


def gated(spark: SparkSession, root: str, destination: str, schema) -> DataFrame:
    """The rows of the runs that went to ``destination``, with ``gate_run``. The join on the
    partition column keeps the folders of other runs from being read."""
    runs = reports(spark, root).where(F.col("destination") == destination).select(RUN).distinct()
    base = f"{root}/data"
    return spark.read.schema(schema).option("basePath", base).parquet(base).join(runs, RUN, "left_semi")
