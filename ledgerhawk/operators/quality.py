"""Row-level data quality (D1-D9) and table-level expectation suites (Q1-Q8)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerhawk.config import MANDATORY_FIELDS, QualityParams


# --------------------------------------------------------------------------- D1-D9
def present(fields=MANDATORY_FIELDS) -> dict[str, Column]:
    """A violation's name to the condition that a sound row meets."""
    return {f"NULL_{f.upper()}": F.col(f).isNotNull() for f in fields}


def plausible(p: QualityParams = QualityParams()) -> dict[str, Column]:
    """D2-D6, likewise."""
    amount = F.col("amount")
    checks = {"AMOUNT_NOT_POSITIVE": amount > 0, "AMOUNT_EXCEEDS_CAP": amount < F.lit(p.amount_cap),
              "INVALID_TIMESTAMP": F.col("event_timestamp") > F.lit(p.min_epoch_ms), "INVALID_CHANNEL": F.col("channel_type").isin(list(p.channels))}
    return {**checks, "SELF_TRANSFER": self_transfer_ok()} if p.check_self_transfer else checks


def marks(checks: dict[str, Column], before: str = "") -> Column:
    """Names of the checks that a row fails; one that cannot be told is no failure."""
    return F.array_compact(F.array(*[F.when(~ok, F.lit(before + name)) for name, ok in checks.items()]))


def null_violations(fields=MANDATORY_FIELDS) -> Column:
    """Array of ``NULL_<FIELD>`` markers."""
    return marks(present(fields))


def dq_validate(df: DataFrame, p: QualityParams = QualityParams(),
                fields=MANDATORY_FIELDS) -> DataFrame:
    """Violations text, pass flag and completeness score (one projection)."""
    checks, missing = plausible(p), F.size("_nulls")
    sound = missing == 0
    for ok in checks.values():
        sound = sound & ok
    return df.withColumn("_nulls", null_violations(fields)).withColumns({
        "dq_violations": F.concat(F.array_join("_nulls", "|"), F.array_join(marks(checks, "|"), "")),
        "dq_passed": sound,
        "completeness_score": (F.lit(len(fields)) - missing) / F.lit(len(fields))}).drop("_nulls")


def self_transfer_ok() -> Column:
    """Source differs from destination (null-safe)."""
    return ~F.col("account_id_source").eqNullSafe(F.col("account_id_dest"))


def route(df: DataFrame) -> DataFrame:
    """Label each row with its sink; the two splits partition the input."""
    return df.withColumn(
        "route",
        F.when(~F.col("dq_passed"), F.lit("dlq"))
         .when(F.col("sla_breached"), F.lit("archive"))
         .otherwise(F.lit("decision")))


# --------------------------------------------------------------------------- Q1-Q8
@dataclass(frozen=True)
class Expectation:
    kind: str            # not_null | between | regex | in_set | unique | type
    column: str
    min_value: float | None = None
    max_value: float | None = None
    regex: str | None = None
    values: tuple = ()
    type_name: str | None = None


# --- fixed values: the suites (domains are parameters of each suite)
TRANSACTIONS_SUITE = (
    Expectation("not_null", "Trans_id"),
    Expectation("not_null", "Clt_id"),
    Expectation("between", "Trans_amount", 0, 100000),
    Expectation("regex", "Currency", regex="^[A-Z]{3}$"),
    Expectation("in_set", "Trans_status", values=("SUCCESS", "FAILED", "PENDING")),
    Expectation("in_set", "Trans_type", values=("POS", "ATM", "ONLINE", "TRANSFER")),
)
TRANSACTIONS_JSON_SUITE = (
    Expectation("not_null", "Trans_id"),
    Expectation("type", "Trans_amount", type_name="int"),
    Expectation("between", "Trans_amount", 1, 100000),
    Expectation("in_set", "Currency", values=("USD", "EGP", "EUR", "GBP")),
    Expectation("in_set", "Trans_status", values=("SUCCESS", "FAILED")),
    Expectation("unique", "Trans_Ref_No"),
)
CLIENTS_SUITE = (
    Expectation("not_null", "Clt_id"),
    Expectation("not_null", "Card_id"),
    Expectation("regex", "Clt_phoneNumber", regex=r"^\+?[0-9]{7,15}$"),
    Expectation("between", "Clt_age", 18, 100),
    Expectation("regex", "National_ID", regex=r"^[0-9]{14}$"),
)
CARDS_SUITE = (
    Expectation("not_null", "Card_id"),
    Expectation("regex", "Card_number", regex=r"^[0-9]{12,19}$"),
    Expectation("in_set", "Card_type", values=("DEBIT", "CREDIT", "PREPAID")),
    Expectation("between", "Current_amount", 0, 1000000),
    Expectation("between", "account_age_days", 0, 3650),
    Expectation("in_set", "account_type", values=("SAVINGS", "CHECKING", "BUSINESS")),
)
DEVICES_SUITE = (
    Expectation("not_null", "Dev_id"),
    Expectation("regex", "Dev_Ip_Location", regex=r"^\d{1,3}(\.\d{1,3}){3}$"),
    Expectation("not_null", "Dev_name"),
    Expectation("in_set", "Dev_type", values=("MOBILE", "DESKTOP", "TABLET", "POS")),
)

JSON_KINDS = {
    "expect_column_values_to_not_be_null": "not_null", "expect_column_values_to_be_of_type": "type",
    "expect_column_values_to_be_between": "between", "expect_column_values_to_match_regex": "regex",
    "expect_column_values_to_be_in_set": "in_set", "expect_column_values_to_be_unique": "unique",
}


def suite_from_json(text: str) -> tuple:
    """Q7: a stored suite, ``{"expectations": [{"expectation_type", "kwargs"}]}``."""
    import json
    out = []
    for e in json.loads(text)["expectations"]:
        kind, kw = JSON_KINDS.get(e["expectation_type"]), e["kwargs"]
        if kind is None:
            raise ValueError(f"unknown expectation {e['expectation_type']}")
        out.append(Expectation(kind, kw["column"], kw.get("min_value"), kw.get("max_value"), kw.get("regex"),
                               tuple(kw.get("value_set", ())), kw.get("type_")))
    return tuple(out)


def load_suite(spark, path: str) -> tuple:
    """A suite file, read by Spark from wherever it is stored."""
    return suite_from_json(spark.read.text(path, wholetext=True).first()[0])


_TYPE_NAMES = {
    "int": (T.IntegerType, T.LongType, T.ShortType, T.ByteType),
    "float": (T.DoubleType, T.FloatType), "str": (T.StringType,),
    "bool": (T.BooleanType,), "decimal": (T.DecimalType,),
}


def _unexpected(e: Expectation) -> Column:
    c = F.col(e.column)
    if e.kind == "between":
        bad = (c < F.lit(e.min_value)) | (c > F.lit(e.max_value))
    elif e.kind == "regex":
        bad = ~c.cast("string").rlike(e.regex)
    elif e.kind == "in_set":
        bad = ~c.cast("string").isin(list(e.values))
    else:
        raise ValueError(e.kind)
    return F.sum(F.when(c.isNotNull() & bad, 1).otherwise(0))


def suite_report(df: DataFrame, suite) -> DataFrame:
    """Q7: all scalar checks of a suite in ONE aggregation pass, then one row per check.

    ``unique`` needs its own grouped count (map-side combined, so a hot value is
    pre-aggregated before the shuffle) and yields its report row from that
    grouped table alone; ``type`` reads only the schema. Rows are unioned, never
    joined."""
    one = df.agg(*scalar_counts(suite))
    fields = {f.name: f.dataType for f in df.schema.fields}
    rows = [scalar_row(i, e, fields) for i, e in enumerate(suite) if e.kind != "unique"]
    out = one.select(F.inline(F.array(*rows))) if rows else None
    for i, e in enumerate(suite):
        if e.kind != "unique":
            continue
        g = df.groupBy(e.column).agg(F.count(F.lit(1)).alias("k"))
        u = (g.agg(F.sum("k").alias("n"),
                   F.sum(F.when(F.col(e.column).isNull(), F.col("k")).otherwise(0)).alias("m"),
                   F.sum(F.when(F.col(e.column).isNotNull() & (F.col("k") > 1), F.col("k"))
                         .otherwise(0)).alias("u"))
              .select(_report_row(i, e, F.coalesce(F.col("n"), F.lit(0)).cast("long"),
                                  F.coalesce(F.col("m"), F.lit(0)).cast("long"),
                                  F.coalesce(F.col("u"), F.lit(0)).cast("long")).alias("r"))
              .select("r.*"))
        out = u if out is None else out.unionByName(u)
    return out


def scalar_counts(suite) -> list[Column]:
    """Aggregates that a suite's checks are told from, but for repeated values: rows ``n``,
    missing ``m<check>`` and unexpected ``u<check>``."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, e in enumerate(suite):
        if e.kind != "type":
            aggs.append(F.sum(F.when(F.col(e.column).isNull(), 1).otherwise(0)).alias(f"m{i}"))
        if e.kind in ("between", "regex", "in_set"):
            aggs.append(_unexpected(e).alias(f"u{i}"))
    return aggs


def scalar_row(i: int, e: Expectation, fields: dict) -> Column:
    """Report row of a check over the columns of ``scalar_counts``; a ``unique`` check takes
    its repeated values from ``u<check>`` as well."""
    n = F.col("n").cast("long")
    if e.kind == "type":
        ok = isinstance(fields.get(e.column), _TYPE_NAMES.get(e.type_name, ()))
        return F.struct(
            F.lit(i).alias("check_no"), F.lit(e.kind).alias("expectation"),
            F.lit(e.column).alias("column_name"), n.alias("element_count"),
            F.lit(0).cast("long").alias("missing_count"),
            F.lit(0 if ok else None).cast("long").alias("unexpected_count"),
            F.lit(0.0 if ok else None).cast("double").alias("unexpected_percent"),
            F.lit(ok).alias("success"))
    miss = F.coalesce(F.col(f"m{i}"), F.lit(0)).cast("long")       # sums over no rows are null
    unexp = miss if e.kind == "not_null" else F.coalesce(F.col(f"u{i}"), F.lit(0)).cast("long")
    return _report_row(i, e, n, miss, unexp)


def _report_row(i: int, e: Expectation, n, miss, unexp):
    base = n if e.kind == "not_null" else n - miss
    return F.struct(
        F.lit(i).alias("check_no"), F.lit(e.kind).alias("expectation"),
        F.lit(e.column).alias("column_name"), n.alias("element_count"),
        miss.alias("missing_count"), unexp.alias("unexpected_count"),
        F.try_divide(unexp * F.lit(100.0), base.cast("double")).alias("unexpected_percent"),
        (unexp == 0).alias("success"))


def quality_gate(df: DataFrame, report: DataFrame) -> tuple[bool, DataFrame]:
    """Q8: the whole input goes to silver if every check passed, else to quarantine.

    The only value brought to the driver is one boolean from a one-row aggregate.
    """
    ok = report.agg(F.coalesce(F.bool_and("success"), F.lit(True)).alias("ok")).first()["ok"]
    return bool(ok), df.withColumn("destination", F.lit("silver" if ok else "quarantine"))
