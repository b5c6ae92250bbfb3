"""The gate that writes: one pass over the input, verdicts, runs cut short and replayed."""

import uuid

from ledgerhawk.operators import gate
from ledgerhawk.operators import quality as ql

E = ql.Expectation
SCHEMA = "id long, v double, s string, d double"
SUITE = (E("not_null", "id"), E("between", "v", 0, 10), E("regex", "s", regex="^[a-z]+$"), E("in_set", "s", values=("a", "b", "c")),
         E("type", "id", type_name="int"), E("unique", "id"), E("unique", "s"), E("unique", "d"))
GOOD = [(1, 0.0, "a", 1.0), (2, 10.0, "b", None), (3, None, "c", None), (4, 1.0, None, float("nan"))]
BAD = [(1, 11.0, "a", 0.0), (1, -1.0, "A", -0.0), (None, 5.0, "a", float("nan")), (None, 5.0, None, float("nan")), (7, 1.0, "b", 3.0)]


def report(spark, root, run):
    rows = gate.reports(spark, root).where(f"gate_run = {run}").orderBy("check_no").collect()
    return [tuple(r)[:8] for r in rows], {r["destination"] for r in rows}


def test_report_is_that_of_the_suite(spark, tmp_path):
    root = str(tmp_path)
    for run, rows in enumerate((GOOD, BAD, [])):
        df = spark.createDataFrame(rows, SCHEMA).repartition(3)
        ok = gate.write_gated(df, SUITE, root, run)
        got, where = report(spark, root, run)
        assert got == [tuple(r) for r in ql.suite_report(df, SUITE).orderBy("check_no").collect()]
        assert ok == (run != 1) and where == {gate.SILVER if ok else gate.QUARANTINE}
    assert gate.gated(spark, root, gate.SILVER, SCHEMA).count() == len(GOOD)
    assert {r["gate_run"] for r in gate.gated(spark, root, gate.QUARANTINE, SCHEMA).collect()} == {1}


def test_input_is_computed_once(spark, tmp_path):
    seen = tmp_path / "seen"
    seen.mkdir()

    def watch(batches):
        (seen / uuid.uuid4().hex).touch()
        yield from batches

    df = spark.range(0, 1000, 1, 4).selectExpr("id", "cast(id % 5 as double) v", "'a' s", "cast(id as double) d")
    df = df.mapInArrow(watch, df.schema)
    assert not gate.write_gated(df, SUITE, str(tmp_path / "out"), 0)       # s repeats
    assert len(list(seen.iterdir())) == 4                                  # a task a partition, no second pass


def test_runs_cut_short_and_replayed(spark, tmp_path):
    root = str(tmp_path)
    good, bad = spark.createDataFrame(GOOD, SCHEMA), spark.createDataFrame(BAD, SCHEMA)
    gate.write_gated(good, SUITE, root, 0)
    bad.write.parquet(f"{root}/data/gate_run=1")                           # no report: the write was cut short
    assert gate.gated(spark, root, gate.SILVER, SCHEMA).count() == len(GOOD)
    assert gate.gated(spark, root, gate.QUARANTINE, SCHEMA).count() == 0
    assert gate.write_gated(good, SUITE, root, 1)
    assert gate.write_gated(bad, SUITE, root, 1)                           # has its verdict
    assert gate.gated(spark, root, gate.SILVER, SCHEMA).count() == 2 * len(GOOD)


def test_no_checks_and_other_runs_unread(spark, tmp_path):
    root = str(tmp_path)
    assert gate.write_gated(spark.createDataFrame(BAD, SCHEMA), (), root, 5)
    assert gate.gated(spark, root, gate.SILVER, SCHEMA).count() == len(BAD)
    assert gate.reports(spark, root).select("element_count").first()[0] == len(BAD)
    plan = gate.gated(spark, root, gate.SILVER, SCHEMA)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
