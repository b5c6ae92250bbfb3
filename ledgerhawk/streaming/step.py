"""Per-customer row step for the streaming decision engine.

In a stream, windows over a customer's history are not available across
micro-batches, so the bounded state carries what the batch form reads from
windows: exact integer moments, the last mobile / ATM-group fix, the last known
country, two anchored windows and the trust list (<= 10 devices). Arithmetic
and text formatting are the same as in ``ledgerhawk.operators.sequence``, so a
stream and a batch run over the same rows give the same decisions.
"""

from __future__ import annotations

import hashlib
import math
from decimal import ROUND_HALF_UP, Decimal

from ledgerhawk import config as C
from ledgerhawk.config import DecisionParams

EARTH_RADIUS_KM = 6371.0
STATE_FIELDS = (
    ("n", "long"), ("s1", "decimal(38,0)"), ("s2", "decimal(38,0)"),
    ("mob_ts", "long"), ("mob_lat", "double"), ("mob_lon", "double"), ("mob_ip", "long"),
    ("atm_ts", "long"), ("atm_lat", "double"), ("atm_lon", "double"),
    ("last_country", "long"), ("a1", "long"), ("mc", "long"), ("msum", "long"),
    ("a30", "long"), ("ins", "long"), ("outs", "long"), ("trusted", "array<string>"),
    ("last_activity_ts", "long"),
)


def state_schema(country: str, ip_country: str) -> str:
    """The state's fields, the last country and the last mobile country of the input's types."""
    kinds = {"last_country": country, "mob_ip": ip_country}
    return ", ".join(f"{n} {kinds.get(n, t)}" for n, t in STATE_FIELDS)


STATE_SCHEMA = state_schema("bigint", "bigint")


def _hav(lat1, lon1, lat2, lon2) -> float:
    if lat1 is None or lon1 is None or lat2 is None or lon2 is None:
        return 0.0
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.pow(math.sin(math.radians(lat2 - lat1) / 2), 2) + \
        math.cos(p1) * math.cos(p2) * math.pow(math.sin(math.radians(lon2 - lon1) / 2), 2)
    return EARTH_RADIUS_KM * 2 * math.atan2(math.sqrt(a), math.sqrt(1 - a))


def _half_up(x: float) -> int:
    return int(math.floor(x + 0.5))


def _one_dec(x: float) -> str:
    t = int(math.floor(x * 10 + 0.5))
    return f"{t // 10}.{t % 10}"


def _dollars(c: int) -> str:
    return str(int(math.floor((c + 50) / 100)))


def _ratio(lo: int, hi: int) -> str:
    r = int(math.floor((lo * 200 + hi) / (hi * 2)))
    return f"{r // 100}.{r % 100:02d}"


_CENT = Decimal("0.01")


def _money(v) -> Decimal:
    """Money as Spark casts a double to decimal(18,2): shortest decimal text of
    the double, rounded half-up to cents (0.6 is 60 cents, not 59). Decimals come as
    themselves or as their text."""
    d = v if isinstance(v, Decimal) else Decimal(v if isinstance(v, str) else repr(float(v)))
    return d.quantize(_CENT, rounding=ROUND_HALF_UP)


def _nn(v):
    """pandas hands NaN for missing numbers; treat it as null."""
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


class CustomerState:
    def __init__(self, stored: tuple | None):
        names = [n for n, _ in STATE_FIELDS]
        s = dict(zip(names, stored)) if stored else {n: None for n in names}
        self.s = s
        self.s["n"] = int(s["n"] or 0)
        self.s["s1"] = int(s["s1"] or 0)
        self.s["s2"] = int(s["s2"] or 0)
        self.s["trusted"] = list(s["trusted"] or [])
        for k in ("mc", "msum", "ins", "outs"):
            self.s[k] = int(s[k] or 0)

    def to_tuple(self) -> tuple:
        out = []
        for n, t in STATE_FIELDS:
            v = self.s[n]
            if t.startswith("decimal") and v is not None:
                v = Decimal(int(v))
            out.append(v)
        return tuple(out)

    def to_list(self) -> list:
        """The fields in order, for JSON, whose whole numbers have any size."""
        return [self.s[n] for n, _ in STATE_FIELDS]

    def step(self, r: dict, p: DecisionParams, now_ms: int) -> dict:
        s = self.s
        ts = _nn(r["event_timestamp"])
        ts = int(ts) if ts is not None else now_ms
        amount = r["amount"]
        amount = Decimal(0) if _nn(amount) is None else _money(amount)
        usd = _nn(r.get("amount_usd"))
        usd = amount if usd is None or _money(usd) == 0 and float(usd) == 0 else _money(usd)
        cents, ucents = int(amount * 100), int(usd * 100)
        ch = r["channel_type"] or "UNKNOWN"
        lat, lon = _nn(r["latitude"]), _nn(r["longitude"])
        country = _nn(r["country_code"])
        # T1/T2 exact moments
        s["n"] += 1
        s["s1"] += cents
        s["s2"] += cents * cents
        n, s1, s2 = s["n"], s["s1"], s["s2"]
        dx, var_n = n * cents - s1, n * s2 - s1 * s1
        scored = n >= p.z_min_count and var_n > 0
        z = abs(dx) / math.sqrt(var_n) if scored else 0.0
        outlier = scored and dx * dx > p.z_limit * p.z_limit * var_n

        def leg(fts, flat, flon):
            hours = max((ts - fts) / 3_600_000.0, p.min_hours)
            d = _hav(flat, flon, lat, lon)
            return d, d / hours

        t3 = t4 = False
        d3 = s3 = d4 = 0.0
        if ch in ("ATM", "POS") and s["mob_ts"] is not None and s["mob_lat"] is not None and lat is not None:
            d3, s3 = leg(s["mob_ts"], s["mob_lat"], s["mob_lon"])
            t3 = s3 > p.speed_kmh and d3 > p.min_distance_km
        if ch in ("ATM", "POS", "BRANCH"):
            fix = (s["atm_ts"], s["atm_lat"], s["atm_lon"])
        elif ch == "MOBILE_APP":
            fix = (s["mob_ts"], s["mob_lat"], s["mob_lon"])
        else:
            fix = (None, None, None)
        if fix[0] is not None and fix[1] is not None and lat is not None:
            d4, s4 = leg(*fix)
            t4 = s4 > p.speed_kmh and d4 > p.min_distance_km
        t7 = (ch == "ATM" and s["mob_ts"] is not None and (ts - s["mob_ts"]) < p.session_window_ms
              and country != s["mob_ip"])
        t10 = bool(r.get("is_rooted_device"))
        new_country = country is not None and country != s["last_country"]
        # T5/T6 anchored windows
        if s["a1"] is None or ts - s["a1"] > p.micro_window_ms:
            s["a1"], s["mc"], s["msum"] = ts, 0, 0
        micro = False
        if ucents < p.micro_limit_cents:
            s["mc"] += 1
            s["msum"] += ucents
            micro = s["mc"] >= p.micro_min_count and s["msum"] > p.micro_sum_cents
        if s["a30"] is None or ts - s["a30"] > p.mule_window_ms:
            s["a30"], s["ins"], s["outs"] = ts, 0, 0
        tt = r.get("transaction_type")
        if tt in C.INBOUND_TYPES:
            s["ins"] += ucents
        elif tt in C.OUTBOUND_TYPES:
            s["outs"] += ucents
        ins, outs = s["ins"], s["outs"]
        mule = (ins > p.mule_min_cents and outs > p.mule_min_cents
                and 100 * min(ins, outs) >= p.mule_ratio_pct * max(ins, outs))
        # T8/T9/T12 trust
        dev = r.get("device_id")
        dev = dev if isinstance(dev, str) and dev else None
        new_dev = dev is not None and dev not in s["trusted"]
        wire = ch == "SWIFT_WIRE" and new_dev and ucents > p.wire_min_cents
        novelty = new_dev and new_country and ucents > p.novelty_min_cents
        cross_txt = f"IMPOSSIBLE_CROSS_CHANNEL_{_half_up(d3)}KM_{_half_up(s3)}KMH"
        travel_txt = f"IMPOSSIBLE_TRAVEL_{_half_up(d4)}KM"
        rules = [
            (outlier, f"STATISTICAL_OUTLIER_Z{_one_dec(z)}", C.RISK_OUTLIER),
            (t3, cross_txt, C.RISK_CROSS_CHANNEL),
            (t4, travel_txt, C.RISK_SAME_CHANNEL),
            (micro, f"MICRO_STRUCTURING_{s['mc']}TXN_${_dollars(s['msum'])}_IN_1H", C.RISK_MICRO),
            (mule, f"MULE_SYMMETRY_IN${_dollars(ins)}_OUT${_dollars(outs)}_RATIO"
                   f"{_ratio(min(ins, outs), max(ins, outs)) if mule else ''}", C.RISK_MULE),
            (t7, "SESSION_HIJACK_MOBILE_ACTIVE", C.RISK_HIJACK),
            (wire, "HIGH_VALUE_WIRE_UNKNOWN_DEVICE", C.RISK_WIRE),
            (novelty, "TRIPLE_NOVELTY", C.RISK_NOVELTY),
            (t10, "ROOTED_DEVICE", C.RISK_ROOTED),
        ]
        reasons = [txt for hit, txt, _ in rules if hit]
        pct = min(sum(w for hit, _, w in rules if hit), 100)
        hard = t3 or t4 or t7 or wire or mule
        action = "BLOCK" if pct >= p.block_pct or hard else ("FLAG_WAIT" if pct >= p.flag_pct else "PASS")
        if not reasons and dev is not None and dev not in s["trusted"]:
            s["trusted"] = (s["trusted"] + [dev])[-p.trust_size:]
        # state updates (H)
        if ch == "MOBILE_APP":
            s["mob_ts"], s["mob_lat"], s["mob_lon"], s["mob_ip"] = ts, lat, lon, _nn(r.get("ip_country"))
        elif ch in ("ATM", "POS", "BRANCH"):
            s["atm_ts"], s["atm_lat"], s["atm_lon"] = ts, lat, lon
        if country is not None:
            s["last_country"] = country
        s["last_activity_ts"] = ts
        canon = f"{r['transaction_id']}|{r['customer_id']}|{amount.quantize(Decimal('0.01'))}|{ts}|{ch}"
        return {
            "transaction_id": r["transaction_id"], "idempotency_key": r.get("idempotency_key"),
            "customer_id": r["customer_id"], "channel_type": ch,
            "amount": cents / 100.0, "amount_usd": ucents / 100.0, "event_timestamp": ts,
            "source_to_kafka_lag_ms": int(_nn(r.get("source_to_kafka_lag_ms")) or 0),
            "kafka_to_spark_lag_ms": int(_nn(r.get("kafka_to_spark_lag_ms")) or 0),
            "total_pipeline_lag_ms": int(_nn(r.get("total_pipeline_lag_ms")) or 0),
            "sla_breached": bool(r.get("sla_breached") or False),
            "dq_passed": bool(r.get("dq_passed", True)), "dq_violations": r.get("dq_violations", ""),
            "completeness_score": float(r.get("completeness_score", 1.0)),
            "ml_risk_score": 0.0, "ml_cluster_id": -1,
            "amount_zscore": math.floor(z * 10000 + 0.5) / 10000.0,
            "geo_violation": travel_txt if t4 else (cross_txt if t3 else "NONE"),
            "micro_structuring": micro, "mule_account_flag": mule,
            "cross_channel_violation": ("HIGH_VALUE_WIRE_UNKNOWN_DEVICE" if wire else
                                        ("SESSION_HIJACK_MOBILE_ACTIVE" if t7 else "NONE")),
            "composite_risk_score": pct / 100.0, "decision_action": action,
            "decision_reasons": "|".join(reasons) if reasons else "CLEAN",
            "data_fingerprint": hashlib.sha256(canon.encode()).hexdigest(),
            "processing_timestamp": int(_nn(r.get("processing_ms")) or now_ms),
            "pipeline_version": C.PIPELINE_VERSION,
        }
