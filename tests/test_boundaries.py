"""Hand-made boundary rows (FIXTURES §2). The batch engine (windows + fold) is
checked against the streaming state machine run row by row in plain Python,
which serves as the brute-force oracle, and against stated expectations."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerhawk.config import DecisionParams, QualityParams
from ledgerhawk.operators import quality as ql
from ledgerhawk.operators import sequence as seq
from ledgerhawk.streaming.step import CustomerState

T0 = 1_704_067_200_000  # 2024-01-01 00:00 UTC
MIN, HOUR = 60_000, 3_600_000
SCHEMA = ("transaction_id long, idempotency_key string, customer_id long, account_id_source long, "
          "account_id_dest long, channel_type string, transaction_type string, amount decimal(12,2), "
          "amount_usd decimal(12,2), event_timestamp long, latitude double, longitude double, "
          "country_code long, ip_country long, device_id string, is_rooted_device boolean")


def _rows():
    rows, nid = [], [0]

    def add(c, dt, amount, ch="WEB_BANKING", tt="PURCHASE", lat=None, lon=None, ctry=None, ip=None,
            dev=None, rooted=False):
        nid[0] += 1
        a = Decimal(str(amount)).quantize(Decimal("0.01"))
        rows.append((nid[0], f"IK-{nid[0]}", c, c, 0, ch, tt, a, a, T0 + dt, lat, lon, ctry, ip, dev, rooted))

    for c, amounts in ((1, (7000, 7000, 6000)), (2, (7000, 7000, "6000.01"))):
        for i, a in enumerate(amounts):
            add(c, i * MIN, a)
    for i, a in enumerate((9000, 7000, 7000, 7000)):
        add(3, i * MIN, a)
    for c, last in ((4, HOUR), (5, HOUR + 1)):
        for dt in (0, 1000, last):
            add(c, dt, 7000)
    add(6, 0, 10000, tt="DEPOSIT"); add(6, MIN, 8500, tt="WITHDRAWAL")
    add(7, 0, 5000, tt="DEPOSIT"); add(7, MIN, 5000, tt="WITHDRAWAL")
    add(8, 0, 10000, tt="DEPOSIT"); add(8, 30 * MIN + 1, 10000, tt="WITHDRAWAL")
    for i in range(11):
        add(9, i * MIN, 10, dev=f"dev{i}")
    add(9, 20 * MIN, 15000, ch="SWIFT_WIRE", dev="dev0")
    add(10, 0, 10, dev="X", rooted=True); add(10, MIN, 15000, ch="SWIFT_WIRE", dev="X")
    add(11, 0, 10, ch="MOBILE_APP", lat=0.0, lon=0.0); add(11, 10 * MIN, 10, ch="ATM", lat=10.0, lon=10.0)
    add(12, 0, 10, ch="MOBILE_APP", lat=0.0, lon=None); add(12, 10 * MIN, 10, ch="ATM", lat=10.0, lon=10.0)
    add(13, 0, 10, ch="MOBILE_APP", ip=1); add(13, 15 * MIN - 1, 10, ch="ATM", ctry=2)
    add(14, 0, 10, ch="MOBILE_APP", ip=1); add(14, 15 * MIN, 10, ch="ATM", ctry=2)
    for c, n_small in ((15, 17), (16, 16)):
        for i in range(n_small):
            add(c, i * MIN, 100)
        add(c, n_small * MIN, 100000)
    add(17, 0, 10, rooted=True)
    add(18, 0, 10, dev="A", ctry=1); add(18, MIN, 6000, dev="B", ctry=2, rooted=True)
    add(19, 0, 10, dev="A", ctry=1); add(19, MIN, 6000, dev="B", ctry=2)
    return rows


@pytest.fixture(scope="module")
def decided(spark):
    df = spark.createDataFrame(_rows(), SCHEMA)
    out = seq.decide(df, DecisionParams(), processing_ms=F.lit(0)).collect()
    return {r["transaction_id"]: r for r in out}


def test_batch_equals_row_by_row_state_machine(decided):
    p = DecisionParams()
    rows = sorted(_rows(), key=lambda r: (r[2], r[9], r[0]))
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    states = {}
    for r in rows:
        d = dict(zip(names, r))
        d["processing_ms"] = 0
        st = states.setdefault(d["customer_id"], CustomerState(None))
        want = st.step(d, p, 0)
        got = decided[d["transaction_id"]]
        for k in ("decision_action", "decision_reasons", "composite_risk_score", "geo_violation",
                  "micro_structuring", "mule_account_flag", "cross_channel_violation", "amount_zscore",
                  "data_fingerprint"):
            assert got[k] == want[k], (d["customer_id"], k, got[k], want[k])


def _by_customer(decided, c):
    return [r for _, r in sorted(decided.items()) if r["customer_id"] == c]


@pytest.mark.parametrize("c,fires", [(1, False), (2, True), (3, True), (4, True), (5, False)])
def test_micro_structuring_edges(decided, c, fires):
    assert any(r["micro_structuring"] for r in _by_customer(decided, c)) is fires


@pytest.mark.parametrize("c,fires", [(6, True), (7, False), (8, False)])
def test_mule_edges(decided, c, fires):
    rows = _by_customer(decided, c)
    assert any(r["mule_account_flag"] for r in rows) is fires
    if fires:
        assert "RATIO0.85" in rows[-1]["decision_reasons"] and rows[-1]["decision_action"] == "BLOCK"


def test_eleventh_device_evicts_first_and_violation_earns_no_trust(decided):
    assert _by_customer(decided, 9)[-1]["cross_channel_violation"] == "HIGH_VALUE_WIRE_UNKNOWN_DEVICE"
    assert _by_customer(decided, 10)[-1]["cross_channel_violation"] == "HIGH_VALUE_WIRE_UNKNOWN_DEVICE"


def test_zero_latitude_is_a_fix_and_null_longitude_is_zero_distance(decided):
    assert _by_customer(decided, 11)[-1]["geo_violation"].startswith("IMPOSSIBLE_CROSS_CHANNEL_")
    assert _by_customer(decided, 12)[-1]["geo_violation"] == "NONE"


@pytest.mark.parametrize("c,hit", [(13, True), (14, False)])
def test_session_window_edge(decided, c, hit):
    got = _by_customer(decided, c)[-1]["cross_channel_violation"]
    assert (got == "SESSION_HIJACK_MOBILE_ACTIVE") is hit


@pytest.mark.parametrize("c,hit", [(15, True), (16, False)])
def test_outlier_needs_eighteen_rows(decided, c, hit):
    assert _by_customer(decided, c)[-1]["decision_reasons"].startswith("STATISTICAL_OUTLIER_Z") is hit


def test_composite_thresholds(decided):
    rooted = _by_customer(decided, 17)[0]
    assert (rooted["composite_risk_score"], rooted["decision_action"]) == (0.3, "PASS")
    both = _by_customer(decided, 18)[-1]
    assert (both["composite_risk_score"], both["decision_action"]) == (0.9, "BLOCK")
    novelty = _by_customer(decided, 19)[-1]
    assert (novelty["composite_risk_score"], novelty["decision_action"]) == (0.6, "FLAG_WAIT")


def test_dq_boundaries(spark):
    schema = ("transaction_id long, customer_id long, amount double, event_timestamp long, "
              "channel_type string, account_id_source long, account_id_dest long")
    rows = [(1, 1, 0.0, T0, "ATM", 1, 2), (2, 1, -1.0, T0, "ATM", 1, 2), (3, 1, 9_999_999.99, T0, "ATM", 1, 2),
            (4, 1, 10_000_000.0, T0, "ATM", 1, 2), (5, 1, 5.0, 10 ** 12, "ATM", 1, 2),
            (6, 1, 5.0, T0, "TELEX", 1, 2), (7, None, 5.0, T0, "ATM", 1, 2), (8, 1, 5.0, T0, "ATM", 3, 3)]
    out = {r["transaction_id"]: r for r in ql.dq_validate(
        spark.createDataFrame(rows, schema), QualityParams(check_self_transfer=True)).collect()}
    assert out[1]["dq_violations"] == "|AMOUNT_NOT_POSITIVE" and not out[1]["dq_passed"]
    assert out[3]["dq_passed"] and out[3]["dq_violations"] == ""
    assert out[4]["dq_violations"] == "|AMOUNT_EXCEEDS_CAP"
    assert out[5]["dq_violations"] == "|INVALID_TIMESTAMP"
    assert out[6]["dq_violations"] == "|INVALID_CHANNEL"
    assert out[7]["dq_violations"] == "NULL_CUSTOMER_ID" and out[7]["completeness_score"] == 5 / 6
    assert out[8]["dq_violations"] == "|SELF_TRANSFER"


def test_suite_bounds_nulls_and_unique(spark):
    df = spark.createDataFrame([(0.0, None, "a"), (100000.0, None, "a"), (100000.01, None, "b")],
                               "v double, n string, u string")
    suite = (ql.Expectation("between", "v", 0, 100000), ql.Expectation("not_null", "n"),
             ql.Expectation("unique", "u"))
    rep = {r["expectation"]: r for r in ql.suite_report(df, suite).collect()}
    assert rep["between"]["unexpected_count"] == 1
    assert rep["not_null"]["unexpected_count"] == 3 and rep["not_null"]["unexpected_percent"] == 100.0
    assert rep["unique"]["unexpected_count"] == 2 and not rep["unique"]["success"]


def test_suite_file_and_empty_input(spark, tmp_path):
    import json

    from ledgerhawk.operators import quality as ql
    f = tmp_path / "suite.json"
    f.write_text(json.dumps({"expectations": [
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "a"}},
        {"expectation_type": "expect_column_values_to_be_of_type", "kwargs": {"column": "a", "type_": "int"}},
        {"expectation_type": "expect_column_values_to_be_between", "kwargs": {"column": "a", "min_value": 1, "max_value": 2}},
        {"expectation_type": "expect_column_values_to_be_in_set", "kwargs": {"column": "b", "value_set": ["x"]}},
        {"expectation_type": "expect_column_values_to_be_unique", "kwargs": {"column": "a"}}]}, indent=1))
    suite = ql.load_suite(spark, str(f))
    df = spark.createDataFrame([(1, "x"), (1, "y"), (None, None)], "a int, b string")
    assert [r["success"] for r in ql.suite_report(df, suite).orderBy("check_no").collect()] == [False, True, True, False, False]
    assert all(r["success"] and r["element_count"] == 0 for r in ql.suite_report(df.limit(0), suite).collect())


def test_rows_without_key_or_broker_time_stay(spark, tmp_path):
    from pyspark.sql import functions as F

    from ledgerhawk.streaming import sinks as sk
    from ledgerhawk.streaming import sources as ss
    rows = spark.createDataFrame([("a", 1, "p"), ("a", 1, "q"), (None, 1, "r"), (None, 2, "s")], "row_key string, version_ts long, data string")
    for _ in range(2):                                        # a replay replaces its own output
        sk.upsert_batch(rows, str(tmp_path / "serving"), 0)
        sk.merge_insert_batch(spark, rows, str(tmp_path / "gold"), 0, "row_key", ())
    got = sorted((r["row_key"] or "", r["data"]) for r in sk.read_serving(spark, str(tmp_path / "serving")).collect())
    assert got == [("", "r"), ("", "s"), ("a", "q")]
    gold = sk.read_gold(spark, str(tmp_path / "gold")).collect()
    assert len(gold) == 3 and sum(r["row_key"] is None for r in gold) == 2
    t = spark.range(100).select(F.col("id").alias("transaction_id"), F.lit("ATM").alias("channel_type"), F.col("id").alias("customer_id"),
                                F.when(F.col("id") % 10 != 0, F.lit(1704067200000) + F.col("id") * 86_400_000).alias("kafka_timestamp"))
    parts = list(ss.envelope_slices(spark, t, str(tmp_path / "env"), ("2024-01-08", "2024-02-01")))
    assert sum(spark.read.parquet(p).count() for p in parts) == 100


def test_scratch_folder_is_required_on_clusters():
    import pytest

    from ledgerhawk.session import scratch_root

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError):
        scratch_root(Session())
