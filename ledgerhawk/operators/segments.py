"""Hot-key splitting for ordered per-key scans.

``Window.partitionBy(key).orderBy(t)`` sends every row of a key to one task; a
key holding a third of the data would run in one task. Here a key with more than
``hot_rows`` rows is cut at quantiles of its times into consecutive segments of
about ``seg_rows`` rows. Windows then run per (key, segment), and every segment receives an exact
*carry* from the segments before it:

* sums and counts: the sum over earlier segments;
* "value of the previous row" / "last non-null value": the value of the last
  qualifying row of the earlier segments.

Both are prefix monoids, so the carry is an exclusive prefix over a per-segment
aggregate (partial + final aggregation; one row per segment) and the result
equals the unsplit window row for row.

Size bounds (why the broadcasts are safe): the hot-key table has at most
``total_rows / hot_rows`` rows and the carry table at most
``total_rows / seg_rows + hot keys`` rows, whatever the skew. Keys below
``hot_rows`` get segment 0 and no carry, so the common case is one shuffle on
(key, segment) as before.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from ledgerhawk.functions.joins import broadcast_if_small

SEG = "_seg"
HOT = "_hot"
NULL_SEG = -1
QUANTILES = 1024         # most segments of one key


@dataclass(frozen=True)
class SplitParams:
    hot_rows: int = 2_000_000   # a key with more rows is split
    seg_rows: int = 500_000     # target rows per segment of a split key


def id_number(ident: Column, kind: T.DataType) -> Column:
    """A long that grows with the id: the id itself, or for any other type the first
    seven bytes of its text (ids that share them fall into one segment)."""
    if isinstance(kind, T.IntegralType):
        return ident.cast("long")
    head = F.rpad(F.hex(F.substring(ident.cast("string").cast("binary"), 1, 7)), 14, "0")
    return F.conv(head, 16, 10).cast("long")


def id_type(df: DataFrame, ident: Column) -> T.DataType:
    return df.select(ident.alias("i")).schema["i"].dataType


def counted(df: DataFrame, key: str, p: SplitParams = SplitParams()) -> DataFrame:
    """Keys above ``hot_rows`` rows: one partial aggregation over the key column."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_kn")).filter(F.col("_kn") > F.lit(p.hot_rows)) \
        .select(F.col(key).alias("_hk"), "_kn")


def hot_keys(df: DataFrame, key: str, t: Column, p: SplitParams = SplitParams(),
             ident: Column | None = None) -> DataFrame:
    """Keys above ``hot_rows`` rows with the times that cut them into about equal parts.

    The cuts are quantiles of the key's own times, so a key whose rows come in a burst
    is cut inside the burst (rows of one time stay together). Rows without a time are
    cut the same way by ``ident`` (their order among themselves). Only rows of hot keys
    are looked at; their list is bounded by total rows / ``hot_rows``."""
    i = F.lit(0).cast("long") if ident is None else id_number(ident, id_type(df, ident))
    own = df.select(F.col(key).alias("_k"), t.cast("long").alias("_t"), F.when(t.isNull(), i).alias("_i")) \
        .join(F.broadcast(counted(df, key, p)), F.col("_k") == F.col("_hk"))
    grid = [q / QUANTILES for q in range(1, QUANTILES)]
    stats = own.groupBy("_hk").agg(F.max("_kn").alias("_kn"), F.percentile_approx("_t", grid, 10 * QUANTILES).alias("_tq"),
                                   F.percentile_approx("_i", grid, 10 * QUANTILES).alias("_iq"))
    parts = F.least(F.ceil(F.col("_kn") / F.lit(p.seg_rows)), F.lit(QUANTILES)).cast("int")

    def cuts(c: str) -> Column:
        places = F.transform(F.sequence(F.lit(1), F.greatest(parts - 1, F.lit(1))),
                             lambda j: F.greatest(F.floor(j * F.lit(QUANTILES) / parts).cast("int"), F.lit(1)))
        found = F.array_distinct(F.transform(places, lambda j: F.element_at(F.col(c), j)))
        return F.when(parts > 1, F.coalesce(found, F.array().cast("array<bigint>"))).otherwise(F.array().cast("array<bigint>"))

    return stats.select("_hk", cuts("_tq").alias("_t_cuts"), cuts("_iq").alias("_i_cuts"))


def has_hot(df: DataFrame, key: str, t: Column, p: SplitParams = SplitParams()) -> bool:
    """Whether any key is split (one partial aggregation over the key column)."""
    return not counted(df, key, p).isEmpty()


UNSPLIT = "ledgerhawk.unsplit"


def with_segments(df: DataFrame, key: str, t: Column, p: SplitParams = SplitParams(),
                  ident: Column | None = None) -> DataFrame:
    """Add ``_seg`` (0 for ordinary keys; time segment >= 0 for hot keys; for a
    hot key's rows without time -1, -2, ... by ``ident`` when given, else -1)
    and ``_hot``. The hot-key table is broadcast: its row count is bounded by
    total_rows / hot_rows (module docstring).

    When no key is hot (one small aggregate tells), the columns are constants
    and ``attach`` adds null carries without any job: the plan is the plain
    per-key window plan."""
    if not has_hot(df, key, t, p):
        return (df.withColumn(SEG, F.lit(0).cast("long"))
                  .withColumn(HOT, F.lit(False).alias(HOT, metadata={UNSPLIT: True})))
    hot = F.broadcast(hot_keys(df, key, t, p, ident))
    j = df.join(hot, F.col(key) == F.col("_hk"), "left")
    def below(cuts: str, value: Column) -> Column:
        return F.size(F.filter(cuts, lambda c: c <= value)).cast("long")

    timeless = F.lit(NULL_SEG).cast("long") if ident is None else \
        F.lit(NULL_SEG).cast("long") - below("_i_cuts", id_number(ident, id_type(df, ident)))
    seg = F.when(F.col("_hk").isNull(), F.lit(0).cast("long")) \
        .when(t.isNull(), timeless).otherwise(below("_t_cuts", t.cast("long")))
    return j.withColumn(SEG, seg).withColumn(HOT, F.col("_hk").isNotNull()) \
        .drop("_hk", "_t_cuts", "_i_cuts")


def seg_order(nulls_last: bool) -> Column:
    """Sort key of segments in row order: time segments ascending; time-less
    segments (-1, -2, ... by id) all before or all after them."""
    edge = F.lit(2 ** 40 if nulls_last else -(2 ** 40)).cast("long")
    return F.when(F.col(SEG) < 0, edge - F.col(SEG)).otherwise(F.col(SEG))


def seg_window(key: str, *order: Column):
    return W.partitionBy(key, SEG).orderBy(*order)


def row_order(t: Column, ident: Column, nulls_last: bool, kind: T.DataType | None = None) -> Column:
    """Total order of a key's rows, null times first or last.

    For whole-number ids (or no stated type) one fixed-width number, t * 10^20 +
    (id + 2^63) as decimal(38,0), which keeps the ``max_by`` carries in a hash
    aggregate; for ids of any other type a struct of time and id. Times are epoch
    micros (|t| < 10^17)."""
    edge = F.lit(10 ** 17 if nulls_last else -(10 ** 17)).cast("decimal(38,0)")
    tt = F.coalesce(t.cast("decimal(38,0)"), edge)
    if kind is not None and not isinstance(kind, T.IntegralType):
        return F.struct(tt.alias("t"), ident.alias("i"))
    ii = ident.cast("decimal(38,0)") + F.lit(str(2 ** 63)).cast("decimal(38,0)")
    return (tt * F.lit(str(10 ** 20)).cast("decimal(38,0)") + ii).cast("decimal(38,0)")


def carries(seg_df: DataFrame, key: str, order: Column, nulls_last: bool,
            sums: dict[str, Column] | None = None, last_row: dict[str, Column] | None = None,
            last_nonnull: dict[str, tuple[Column, Column]] | None = None) -> DataFrame:
    """Exclusive prefix per (hot key, segment), over the segments before it.

    ``sums``: name -> value summed over all earlier rows.
    ``last_row``: name -> value at the last earlier row (may be null).
    ``last_nonnull``: name -> (condition, value): value at the last earlier row
    where the condition holds.
    Carry columns are named ``_c<name>``.
    """
    sums, last_row, last_nonnull = sums or {}, last_row or {}, last_nonnull or {}
    aggs = [F.sum(v).alias(n) for n, v in sums.items()]
    aggs += [F.max_by(v, order).alias(n) for n, v in last_row.items()]
    aggs += [F.max_by(v, F.when(c, order)).alias(n) for n, (c, v) in last_nonnull.items()]
    aggs += [F.max(F.when(c, order)).alias(f"_o{n}") for n, (c, _) in last_nonnull.items()]
    aggs.append(F.max(order).alias("_olast"))
    per_seg = seg_df.filter(F.col(HOT)).groupBy(key, SEG).agg(*aggs)
    # earlier segments first; time-less segments go first or last like their rows
    w = W.partitionBy(key).orderBy(seg_order(nulls_last)).rowsBetween(W.unboundedPreceding, -1)
    cols = [F.sum(n).over(w).alias(f"_c{n}") for n in sums]
    # "last earlier row" = the earlier segment with the greatest order value
    cols += [F.max_by(F.col(n), F.col("_olast")).over(w).alias(f"_c{n}") for n in last_row]
    cols += [F.max_by(F.col(n), F.col(f"_o{n}")).over(w).alias(f"_c{n}") for n in last_nonnull]
    return per_seg.select(F.col(key).alias("_ck"), F.col(SEG).alias("_cs"), *cols)


def attach(seg_df: DataFrame, key: str, carry: DataFrame) -> DataFrame:
    """Left-join the carries on (key, segment). Rows of ordinary keys get nulls.
    The carry table is bounded by total_rows / seg_rows rows; it is broadcast
    under the size check, else joined on the same (key, segment) keys the
    windows partition by, so the rows are still shuffled once."""
    if seg_df.schema[HOT].metadata.get(UNSPLIT):
        return seg_df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name)
                                    for f in carry.schema.fields if f.name not in ("_ck", "_cs")])
    c = broadcast_if_small(carry)
    return seg_df.join(c, (F.col(key) == F.col("_ck")) & (F.col(SEG) == F.col("_cs")), "left") \
        .drop("_ck", "_cs")
