"""Every registered query with a SQL oracle equals DuckDB on the sf0.01 tables."""

import pytest

import __spark_entry__ as entry
from ledgerhawk.plans.harness import SF_ORACLE
from ledgerhawk.plans.harness import compare

STREAM_OR_SLOW = {k for k in entry.queries() if k.startswith("stream_")} | {
    "json_decode", "raw_landing", "partitioned_sink_roundtrip", "csv_export"}
BATCH = sorted(k for k in entry.oracle_sql() if k not in STREAM_OR_SLOW)
STREAM = sorted(k for k in entry.oracle_sql() if k in STREAM_OR_SLOW)


@pytest.mark.parametrize("key", BATCH)
def test_batch_matches_oracle(spark, duck, key):
    r = compare(spark, duck, SF_ORACLE, key, entry.queries()[key], entry.oracle_sql()[key])
    assert r["status"] == "match", r


@pytest.mark.parametrize("key", STREAM)
def test_stream_matches_oracle(spark, duck, key):
    r = compare(spark, duck, SF_ORACLE, key, entry.queries()[key], entry.oracle_sql()[key])
    assert r["status"] == "match", r


def test_every_key_has_a_callable():
    qs = entry.queries()
    assert set(entry.oracle_sql()) <= set(qs)
    assert all(callable(f) for f in qs.values())
