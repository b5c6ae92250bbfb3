"""SQL oracle of the decision engine (T1-T12): window features + recursive fold.

Independent formulation: the anchored windows and the trust set are a
recursive CTE stepping through each customer's rows by rank, carrying the
state in columns (a list column for the trust set).
"""

from __future__ import annotations

from ledgerhawk.config import DecisionParams
from ledgerhawk.plans.oracle_views import with_views


def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
         f" * pow(sin(radians({lon2} - {lon1}) / 2), 2)")
    return (f"(CASE WHEN {lat1} IS NULL OR {lon1} IS NULL OR {lat2} IS NULL OR {lon2} IS NULL "
            f"THEN CAST(0.0 AS DOUBLE) ELSE CAST(6371.0 AS DOUBLE) * 2 * atan2(sqrt({a}), sqrt(1 - ({a}))) END)")


def one_dec(x: str) -> str:
    t = f"CAST(floor({x} * 10 + 0.5) AS BIGINT)"
    return f"(CAST({t} // 10 AS VARCHAR) || '.' || CAST({t} % 10 AS VARCHAR))"


def half_up(x: str) -> str:
    return f"CAST(CAST(floor({x} + 0.5) AS BIGINT) AS VARCHAR)"


def dollars(c: str) -> str:
    return f"CAST(CAST(floor(({c} + 50) / 100) AS BIGINT) AS VARCHAR)"


def ratio(lo: str, hi: str) -> str:
    r = f"CAST(floor(({lo} * 200 + {hi}) / ({hi} * 2)) AS BIGINT)"
    return f"(CAST({r} // 100 AS VARCHAR) || '.' || lpad(CAST({r} % 100 AS VARCHAR), 2, '0'))"


DQ_ONTIME = """
SELECT *, TRUE AS dq_passed, '' AS dq_violations, CAST(1.0 AS DOUBLE) AS completeness_score,
  CASE WHEN kafka_timestamp IS NOT NULL THEN kafka_timestamp - event_timestamp ELSE 0 END AS source_to_kafka_lag_ms,
  ingest_ms - kafka_timestamp AS kafka_to_spark_lag_ms,
  ingest_ms - event_timestamp AS total_pipeline_lag_ms, FALSE AS sla_breached
FROM txn
WHERE transaction_id IS NOT NULL AND customer_id IS NOT NULL AND amount IS NOT NULL
  AND event_timestamp IS NOT NULL AND channel_type IS NOT NULL AND account_id_source IS NOT NULL
  AND amount > 0 AND amount < 10000000 AND event_timestamp > 1000000000000
  AND channel_type IN ('MOBILE_APP','WEB_BANKING','ATM','POS','BRANCH','SWIFT_WIRE','E_WALLET','INTERNAL_TRANSFER')
  AND NOT (ingest_ms - event_timestamp > 30000)
"""


def feature_sql(p: DecisionParams, source: str = "speed") -> str:
    w = "PARTITION BY customer_id ORDER BY _ts, transaction_id"
    return f"""
SELECT *,
  _n >= {p.z_min_count} AND _var > 0 AS _scored,
  CASE WHEN _n >= {p.z_min_count} AND _var > 0 THEN CAST(abs(_dx) AS DOUBLE) / sqrt(CAST(_var AS DOUBLE))
       ELSE CAST(0.0 AS DOUBLE) END AS _z,
  _n >= {p.z_min_count} AND _var > 0 AND _dx * _dx > {p.z_limit * p.z_limit} * _var AS _outlier
FROM (
  SELECT *, _n * CAST(_cents AS HUGEINT) - _s1 AS _dx, _n * _s2 - _s1 * _s1 AS _var
  FROM (
    SELECT *,
      row_number() OVER ({w}) AS rn,
      CAST(count(*) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS HUGEINT) AS _n,
      sum(CAST(_cents AS HUGEINT)) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _s1,
      sum(CAST(_cents AS HUGEINT) * CAST(_cents AS HUGEINT)) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _s2,
      last_value(CASE WHEN _channel = 'MOBILE_APP' THEN {{'ts': _ts, 'latitude': latitude, 'longitude': longitude, 'ip_country': ip_country}} END IGNORE NULLS)
        OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _mob,
      last_value(CASE WHEN _channel IN ('ATM','POS','BRANCH') THEN {{'ts': _ts, 'latitude': latitude, 'longitude': longitude, 'ip_country': ip_country}} END IGNORE NULLS)
        OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _atm,
      last_value(country_code IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _last_country
    FROM (
      SELECT *, coalesce(event_timestamp, epoch_ms(now())) AS _ts,
        CAST(coalesce(CAST(amount AS DECIMAL(18,2)), 0) * 100 AS BIGINT) AS _cents,
        CAST(CASE WHEN amount_usd IS NULL OR amount_usd = 0 THEN coalesce(CAST(amount AS DECIMAL(18,2)), 0)
                  ELSE CAST(amount_usd AS DECIMAL(18,2)) END * 100 AS BIGINT) AS _usd_cents,
        coalesce(channel_type, 'UNKNOWN') AS _channel
      FROM {source}
    ) x0
  ) x1
) x2
"""


def travel_sql(p: DecisionParams) -> str:
    hours_m = f"greatest(CAST(_ts - _mob.ts AS DOUBLE) / 3600000.0, {p.min_hours})"
    hours_s = f"greatest(CAST(_ts - _same.ts AS DOUBLE) / 3600000.0, {p.min_hours})"
    d3 = hav("_mob.latitude", "_mob.longitude", "latitude", "longitude")
    d4 = hav("_same.latitude", "_same.longitude", "latitude", "longitude")
    return f"""
SELECT *,
  coalesce(_channel IN ('ATM','POS') AND _mob IS NOT NULL AND _mob.latitude IS NOT NULL AND latitude IS NOT NULL
           AND _s3 > {p.speed_kmh} AND _d3 > {p.min_distance_km}, FALSE) AS _t3,
  coalesce(_same IS NOT NULL AND _same.latitude IS NOT NULL AND latitude IS NOT NULL
           AND _s4 > {p.speed_kmh} AND _d4 > {p.min_distance_km}, FALSE) AS _t4,
  coalesce(_channel = 'ATM' AND _mob IS NOT NULL AND (_ts - _mob.ts) < {p.session_window_ms}
           AND country_code IS DISTINCT FROM _mob.ip_country, FALSE) AS _t7,
  coalesce(is_rooted_device, FALSE) AS _t10,
  coalesce(country_code IS NOT NULL AND country_code IS DISTINCT FROM _last_country, FALSE) AS _new_country
FROM (
  SELECT *, {d3} AS _d3, {d3} / {hours_m} AS _s3, {d4} AS _d4, {d4} / {hours_s} AS _s4
  FROM (
    SELECT *, CASE WHEN _channel IN ('ATM','POS','BRANCH') THEN _atm WHEN _channel = 'MOBILE_APP' THEN _mob END AS _same
    FROM feat0
  ) y0
) y1
"""


def fold_sql(p: DecisionParams) -> str:
    reset1 = f"(f.a1 IS NULL OR b._ts - f.a1 > {p.micro_window_ms})"
    reset30 = f"(f.a30 IS NULL OR b._ts - f.a30 > {p.mule_window_ms})"
    small = f"(b._usd_cents < {p.micro_limit_cents})"
    inb = "(b.transaction_type IN ('TRANSFER_IN','DEPOSIT','WIRE_IN'))"
    outb = "(b.transaction_type IN ('TRANSFER_OUT','WITHDRAWAL','WIRE_OUT'))"
    return f"""
SELECT customer_id, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS a1, CAST(0 AS BIGINT) AS mc,
       CAST(0 AS BIGINT) AS msum, CAST(NULL AS BIGINT) AS a30, CAST(0 AS BIGINT) AS ins,
       CAST(0 AS BIGINT) AS outs, CAST([] AS VARCHAR[]) AS trusted, FALSE AS micro_hit, FALSE AS mule_hit,
       FALSE AS new_device, FALSE AS wire_hit, FALSE AS novelty_hit, FALSE AS trust_joined
FROM (SELECT DISTINCT customer_id FROM feat) c
UNION ALL
SELECT customer_id, rn, a1, mc, msum, a30, ins, outs,
  CASE WHEN trust_joined
       THEN list_slice(list_append(t0, device_id), greatest(len(t0) + 1 - {p.trust_size - 1}, 1), len(t0) + 1)
       ELSE t0 END AS trusted,
  micro_hit, mule_hit, new_device, wire_hit, novelty_hit, trust_joined
FROM (
  SELECT *, NOT (_pre OR micro_hit OR mule_hit OR wire_hit OR novelty_hit)
            AND device_id IS NOT NULL AND device_id <> '' AND NOT list_contains(t0, device_id) AS trust_joined
  FROM (
  SELECT *,
    _channel = 'SWIFT_WIRE' AND new_device AND _usd_cents > {p.wire_min_cents} AS wire_hit,
    new_device AND _new_country AND _usd_cents > {p.novelty_min_cents} AS novelty_hit
  FROM (
    SELECT *,
      _small AND mc >= {p.micro_min_count} AND msum > {p.micro_sum_cents} AS micro_hit,
      ins > {p.mule_min_cents} AND outs > {p.mule_min_cents}
        AND 100 * least(ins, outs) >= {p.mule_ratio_pct} * greatest(ins, outs) AS mule_hit,
      device_id IS NOT NULL AND device_id <> '' AND NOT list_contains(t0, device_id) AS new_device
    FROM (
      SELECT b.customer_id, b.rn, b._usd_cents, b.device_id, b._channel, b._new_country, b._pre,
        {small} AS _small,
        CASE WHEN {reset1} THEN b._ts ELSE f.a1 END AS a1,
        CASE WHEN {reset1} THEN 0 ELSE f.mc END + CASE WHEN {small} THEN 1 ELSE 0 END AS mc,
        CASE WHEN {reset1} THEN 0 ELSE f.msum END + CASE WHEN {small} THEN b._usd_cents ELSE 0 END AS msum,
        CASE WHEN {reset30} THEN b._ts ELSE f.a30 END AS a30,
        CASE WHEN {reset30} THEN 0 ELSE f.ins END + CASE WHEN {inb} THEN b._usd_cents ELSE 0 END AS ins,
        CASE WHEN {reset30} THEN 0 ELSE f.outs END
          + CASE WHEN {outb} AND NOT {inb} THEN b._usd_cents ELSE 0 END AS outs,
        f.trusted AS t0
      FROM fold f JOIN feat b ON b.customer_id = f.customer_id AND b.rn = f.rn + 1
    ) s1
  ) s2
  ) s25
) s3
"""


def assemble_sql(p: DecisionParams) -> str:
    micro = f"'MICRO_STRUCTURING_' || CAST(g.mc AS VARCHAR) || 'TXN_$' || {dollars('g.msum')} || '_IN_1H'"
    mule = (f"'MULE_SYMMETRY_IN$' || {dollars('g.ins')} || '_OUT$' || {dollars('g.outs')} || '_RATIO' || "
            f"{ratio('least(g.ins, g.outs)', 'greatest(g.ins, g.outs)')}")
    cross = f"'IMPOSSIBLE_CROSS_CHANNEL_' || {half_up('_d3')} || 'KM_' || {half_up('_s3')} || 'KMH'"
    travel = f"'IMPOSSIBLE_TRAVEL_' || {half_up('_d4')} || 'KM'"
    rules = [
        ("_outlier", f"'STATISTICAL_OUTLIER_Z' || {one_dec('_z')}", 35),
        ("_t3", cross, 90), ("_t4", travel, 85), ("g.micro_hit", micro, 70), ("g.mule_hit", mule, 65),
        ("_t7", "'SESSION_HIJACK_MOBILE_ACTIVE'", 80), ("g.wire_hit", "'HIGH_VALUE_WIRE_UNKNOWN_DEVICE'", 75),
        ("g.novelty_hit", "'TRIPLE_NOVELTY'", 60), ("_t10", "'ROOTED_DEVICE'", 30),
    ]
    arr = "list_filter([" + ", ".join(f"CASE WHEN {f} THEN {t} END" for f, t, _ in rules) + "], lambda x: x IS NOT NULL)"
    pct = "least(" + " + ".join(f"CASE WHEN {f} THEN {w} ELSE 0 END" for f, _, w in rules) + ", 100)"
    hard = "(_t3 OR _t4 OR _t7 OR g.wire_hit OR g.mule_hit)"
    return f"""
SELECT transaction_id, idempotency_key, b.customer_id, _channel AS channel_type,
  CAST(_cents AS DOUBLE) / 100 AS amount, CAST(b._usd_cents AS DOUBLE) / 100 AS amount_usd,
  _ts AS event_timestamp,
  CAST(coalesce(source_to_kafka_lag_ms, 0) AS BIGINT) AS source_to_kafka_lag_ms,
  CAST(coalesce(kafka_to_spark_lag_ms, 0) AS BIGINT) AS kafka_to_spark_lag_ms,
  CAST(coalesce(total_pipeline_lag_ms, 0) AS BIGINT) AS total_pipeline_lag_ms,
  coalesce(sla_breached, FALSE) AS sla_breached, dq_passed, dq_violations, completeness_score,
  CAST(0.0 AS DOUBLE) AS ml_risk_score, CAST(-1 AS INTEGER) AS ml_cluster_id,
  floor(_z * 10000 + 0.5) / CAST(10000.0 AS DOUBLE) AS amount_zscore,
  CASE WHEN _t4 THEN {travel} WHEN _t3 THEN {cross} ELSE 'NONE' END AS geo_violation,
  g.micro_hit AS micro_structuring, g.mule_hit AS mule_account_flag,
  CASE WHEN g.wire_hit THEN 'HIGH_VALUE_WIRE_UNKNOWN_DEVICE' WHEN _t7 THEN 'SESSION_HIJACK_MOBILE_ACTIVE'
       ELSE 'NONE' END AS cross_channel_violation,
  {pct} / CAST(100.0 AS DOUBLE) AS composite_risk_score,
  CASE WHEN {pct} >= {p.block_pct} OR {hard} THEN 'BLOCK' WHEN {pct} >= {p.flag_pct} THEN 'FLAG_WAIT'
       ELSE 'PASS' END AS decision_action,
  CASE WHEN len({arr}) > 0 THEN array_to_string({arr}, '|') ELSE 'CLEAN' END AS decision_reasons,
  sha256(concat_ws('|', CAST(transaction_id AS VARCHAR), CAST(b.customer_id AS VARCHAR),
         CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR), CAST(_ts AS VARCHAR), _channel)) AS data_fingerprint,
  CAST(ingest_ms AS BIGINT) AS processing_timestamp,
  'txnmon-v2.0.0' AS pipeline_version
FROM feat b JOIN fold g ON g.customer_id = b.customer_id AND g.rn = b.rn
"""


def decisions_sql(p: DecisionParams = DecisionParams(), select: str | None = None,
                  where: str | None = None) -> str:
    """Full decision oracle; ``select`` replaces the final projection (over
    ``feat b JOIN fold g``) for the per-rule keys."""
    final = assemble_sql(p) if select is None else (
        f"SELECT {select} FROM feat b JOIN fold g ON g.customer_id = b.customer_id AND g.rn = b.rn"
        + (f" WHERE {where}" if where else ""))
    body = "WITH RECURSIVE " + ",\n".join([
        f"feat0 AS ({feature_sql(p)})",
        f"feat AS (SELECT *, _outlier OR _t3 OR _t4 OR _t7 OR _t10 AS _pre FROM ({travel_sql(p)}) z)",
        f"fold AS ({fold_sql(p)})",
    ]) + "\n" + final
    # prepend the plain views in a separate WITH level
    return with_views(f"SELECT * FROM ({body}) d", ("speed", DQ_ONTIME))
