"""Driver contract: flagship entry runs on sf0.001 with a stable schema."""

import __spark_entry__ as entry


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:4] == ["transaction_id", "idempotency_key", "customer_id", "channel_type"]
    assert "decision_action" in df.columns and "data_fingerprint" in df.columns


def test_rows_only_keys_run(spark):
    from ledgerhawk.plans.harness import SF_SMALL
    for key in ("kmeans_profile", "lr_accuracy", "stream_late_rows"):
        assert entry.queries()[key](spark, SF_SMALL).count() > 0


def test_late_rows_are_dropped(spark):
    from ledgerhawk.plans.harness import SF_SMALL
    rows = {r["arrival"]: r for r in entry.queries()["stream_late_rows"](spark, SF_SMALL).collect()}
    assert rows["in order"]["output_rows"] == rows["in order"]["input_rows"] > 0
    assert rows["late"]["input_rows"] > 0 and rows["late"]["output_rows"] == 0
