"""Thresholds and fixed values as frozen dataclasses.

Money thresholds are held in integer cents so that every comparison is exact
in Spark and in the SQL oracle alike.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values of the rules (do not edit); labels, topics and the review URL
# --- below them are deployment parameters with neutral defaults
CHANNELS = (
    "MOBILE_APP", "WEB_BANKING", "ATM", "POS",
    "BRANCH", "SWIFT_WIRE", "E_WALLET", "INTERNAL_TRANSFER",
)
MANDATORY_FIELDS = (
    "transaction_id", "customer_id", "amount",
    "event_timestamp", "channel_type", "account_id_source",
)
INBOUND_TYPES = ("TRANSFER_IN", "DEPOSIT", "WIRE_IN")
OUTBOUND_TYPES = ("TRANSFER_OUT", "WITHDRAWAL", "WIRE_OUT")
HARD_VIOLATION_MARKERS = (
    "IMPOSSIBLE", "SESSION_HIJACK", "HIGH_VALUE_WIRE_UNKNOWN", "MULE_SYMMETRY",
)
HOLIDAYS = ("2026-01-01", "2026-05-01", "2026-07-23")
SILVER_CURRENCIES = ("USD", "EGP", "EUR", "GBP")
BLACKLIST = ("BlacklistedMerchant1", "BlacklistedMerchant2")
PIPELINE_VERSION = "txnmon-v2.0.0"
ALERT_TYPE = "SUSPECT_ALERT"
REVIEW_URL_BASE = "https://review.example.invalid/review/"
DECISIONS_TOPIC = "txn.decisions.output"
ALERTS_TOPIC = "txn.alerts.security"
SLA_THRESHOLD_MS = 30_000
# risk increments of the decision engine, in hundredths
RISK_OUTLIER = 35
RISK_CROSS_CHANNEL = 90
RISK_SAME_CHANNEL = 85
RISK_MICRO = 70
RISK_MULE = 65
RISK_HIJACK = 80
RISK_WIRE = 75
RISK_NOVELTY = 60
RISK_ROOTED = 30
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class DecisionParams:
    """Per-customer sequential rules (T1-T12); reference defaults."""

    z_min_count: int = 5
    z_limit: int = 4
    speed_kmh: float = 900.0
    min_distance_km: float = 50.0
    min_hours: float = 0.0001
    micro_limit_cents: int = 900_000
    micro_window_ms: int = 3_600_000
    micro_min_count: int = 3
    micro_sum_cents: int = 2_000_000
    mule_window_ms: int = 1_800_000
    mule_min_cents: int = 500_000
    mule_ratio_pct: int = 85
    session_window_ms: int = 900_000
    wire_min_cents: int = 1_000_000
    novelty_min_cents: int = 500_000
    trust_size: int = 10
    block_pct: int = 75
    flag_pct: int = 40
    ml_weight: float = 0.0


@dataclass(frozen=True)
class RuleParams:
    """Batch suspect rules (R1-R9); reference defaults."""

    high_amount: float = 10_000.0
    velocity_per_hour: int = 10
    repeat_country_per_hour: int = 1
    distinct_countries_per_hour: int = 1
    daily_frequency: int = 50
    odd_hour_from: int = 6
    odd_hour_to: int = 23
    blacklist: tuple = BLACKLIST


@dataclass(frozen=True)
class StepRiskParams:
    """Card-stream step score."""

    amount_limit: float = 5000.0
    high: float = 0.9
    weekend: float = 0.7
    base: float = 0.2
    suspect_above: float = 0.8
    band_limit: float = 5000.0


@dataclass(frozen=True)
class SilverParams:
    """Silver business rules."""

    min_amount: float = 0.0
    max_amount: float = 100_000.0
    currencies: tuple = SILVER_CURRENCIES
    min_year: int = 2015
    max_year: int = 2025


@dataclass(frozen=True)
class QualityParams:
    amount_cap: float = 10_000_000.0
    min_epoch_ms: int = 1_000_000_000_000
    channels: tuple = CHANNELS
    check_self_transfer: bool = False


@dataclass(frozen=True)
class StreamParams:
    """Admission and cadence of the streams. A file source takes at most
    ``max_files_per_trigger`` files or ``max_bytes_per_trigger`` (one of them, or neither), a broker
    source ``max_offsets_per_trigger`` messages from ``starting_offsets``."""

    watermark: str = "10 minutes"
    max_files_per_trigger: int | None = None
    max_bytes_per_trigger: int | None = 256 * 1024 * 1024
    max_offsets_per_trigger: int = 50_000
    starting_offsets: str = "latest"
    trigger_seconds: dict = field(default_factory=lambda: {
        "serving": 5, "decisions": 2, "alerts": 2, "gold": 30,
        "bronze": 60, "dlq": 30, "archive": 30,
    })

    def trigger_of(self, *sinks: str) -> int:
        """Interval of one query that feeds several sinks: that of the most frequent."""
        return min(self.trigger_seconds[s] for s in sinks)
