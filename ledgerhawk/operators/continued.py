"""The decision engine over rows that follow others: states before and after.

A micro-batch run through the batch engine needs each customer's state before it and gives
the state after it, so that a customer with most of a micro-batch is cut into segments like
in batch. A state is one row a customer: exact moment sums, the last fixes, the last known
country, both anchored windows and the trust list.

The state before enters where a hot customer's segments get theirs: in the carry of every
segment of the customer, and in the entry state of the first. The state after is read off
the last row of the customer's last segment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerhawk.functions.joins import broadcast_if_small
from ledgerhawk.operators.segments import SEG

END, EXIT = "_end", "_exit"
BEFORE = -1                  # segment of what came before; time segments start at 0
ANCHORS = ("a1", "mc", "msum", "a30", "ins", "outs")
FIX = (("ts", None), ("lat", "latitude"), ("lon", "longitude"), ("ip", "ip_country"))


def state_type(rows: DataFrame) -> T.StructType:
    """State of one customer of ``rows``, whose ids and countries may be numbers or text."""
    kind = {c: rows.schema[c].dataType for c in ("customer_id", "latitude", "longitude", "ip_country", "country_code")}
    fix = T.StructType([T.StructField("ts", T.LongType()), *[T.StructField(c, kind[c]) for c in ("latitude", "longitude", "ip_country")]])
    total = T.DecimalType(38, 0)
    fields = [("customer_id", kind["customer_id"]), ("n", T.LongType()), ("s1", total), ("s2", total), ("mob", fix), ("atm", fix),
              ("country", kind["country_code"]), *[(n, T.LongType()) for n in ANCHORS], ("trusted", T.ArrayType(T.StringType()))]
    return T.StructType([T.StructField(n, t) for n, t in fields])


def attach_base(rows: DataFrame, carry: DataFrame, base: DataFrame) -> DataFrame:
    """``segments.attach`` with the carries of all segments that follow something: other
    segments, a state, or both. One row a segment; the rows are joined on the keys that
    the windows partition by, so a customer's rows stay spread."""
    known = base.select(F.col("customer_id").alias("_bk"), *[F.col(c).alias(f"_b_{c}") for c in ("n", "s1", "s2", "mob", "atm", "country")])
    parts = rows.groupBy("customer_id", SEG).agg(F.count(F.lit(1)).alias("_rows"))
    parts = parts.join(carry, (F.col("customer_id") == F.col("_ck")) & (F.col(SEG) == F.col("_cs")), "left") \
        .join(broadcast_if_small(known), F.col("customer_id") == F.col("_bk"), "left").where("_ck IS NOT NULL OR _bk IS NOT NULL")
    kinds = dict(zip(carry.columns, (f.dataType for f in carry.schema.fields)))

    def total(c: str) -> Column:
        zero = F.lit(0).cast(kinds[c])
        return (F.coalesce(c, zero) + F.coalesce(c.replace("_c_", "_b_"), zero)).cast(kinds[c]).alias(c)

    def fix(which: str) -> list[Column]:
        here = F.col(f"_c_{which}_ts").isNotNull()
        return [F.when(here, F.col(f"_c_{which}_{k}")).otherwise(F.col(f"_b_{which}.{name or k}")).alias(f"_c_{which}_{k}") for k, name in FIX]

    joined = parts.select(F.col("customer_id").alias("_ck"), F.col(SEG).alias("_cs"), total("_c_n"), total("_c_s1"), total("_c_s2"),
                          *fix("mob"), *fix("atm"), F.coalesce("_c_country", "_b_country").alias("_c_country"))
    return rows.join(broadcast_if_small(joined), (F.col("customer_id") == F.col("_ck")) & (F.col(SEG) == F.col("_cs")), "left").drop("_ck", "_cs")


def entries(base: DataFrame, split: DataFrame | None, names: list[str]) -> DataFrame:
    """Entry states by ``customer_id, SEG``: those of split customers' segments, and the
    states of the others at the start of their only one."""
    whole = base
    if split is not None:
        whole = base.join(split.select("customer_id").distinct(), "customer_id", "left_anti")
    whole = whole.select("customer_id", F.lit(0).cast("long").alias(SEG), *names)
    return whole if split is None else split.unionByName(whole)


def trusted_before(base: DataFrame, accesses: DataFrame, segments: DataFrame) -> DataFrame:
    """Devices on split customers' lists as accesses before their first segment, in order."""
    own = base.join(segments.select("customer_id").distinct(), "customer_id", "left_semi")
    return own.select("customer_id", F.posexplode("trusted").alias("_at", "device_id")).select(
        "customer_id", F.lit(BEFORE).cast("long").alias(SEG), F.col("_at").cast("long").alias("_ts"),
        F.lit(None).cast(accesses.schema["transaction_id"].dataType).alias("transaction_id"), "device_id")


def end_of_segment(w, atm_group: tuple) -> Column:
    """What the windows know after a segment's last row, as JSON; null on other rows."""
    def after(cond: Column, prev: str) -> Column:
        return F.when(cond, F.struct(F.col("_ts").alias("ts"), "latitude", "longitude", "ip_country")).otherwise(F.col(prev))
    ch = F.col("_channel")
    state = F.struct(F.col("_n").alias("n"), F.col("_s1").alias("s1"), F.col("_s2").alias("s2"),
                     after(ch == "MOBILE_APP", "_mob").alias("mob"), after(ch.isin(*atm_group), "_atm").alias("atm"),
                     F.coalesce("country_code", "_last_country").alias("country"))
    return F.when(F.lead(F.lit(1)).over(w).isNull(), F.to_json(state))


def states(decided: DataFrame, kind: T.StructType) -> DataFrame:
    """States after the rows of ``decide(..., keep_state=True)``, one row a customer. Rows
    without a customer leave none."""
    last = decided.where(F.col(END).isNotNull() & F.col("customer_id").isNotNull()) \
        .groupBy("customer_id").agg(F.max_by(F.struct(END, EXIT), SEG).alias("_l"))
    windows = T.StructType([f for f in kind.fields if f.name not in ("customer_id", "trusted", *ANCHORS)])
    fold = F.from_json(f"_l.{EXIT}", T.ArrayType(T.StringType()))
    parsed = last.select("customer_id", F.from_json(f"_l.{END}", windows).alias("_w"), fold.alias("_x"))
    return parsed.select("customer_id", *[F.col(f"_w.{f.name}") for f in windows.fields],
                         *[F.element_at("_x", i + 1).cast("long").alias(n) for i, n in enumerate(ANCHORS)],
                         F.from_json(F.element_at("_x", len(ANCHORS) + 1), T.ArrayType(T.StringType())).alias("trusted"))
