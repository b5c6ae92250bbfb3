"""Entry states of a hot customer's segments from composable summaries.

The anchored windows: a segment meets its entry anchor ``a`` only through the first row
later than ``a + window``; from that row on, the chain of anchors is the segment's own. So a
segment is a step function from entry anchor to exit state, and since later rows never lead
to an earlier last anchor, its steps are in order and few: at most the rows of the
segment's first window, merged where they end alike. One pass makes the step functions in
parallel, one look-up a segment then gives every entry state, whether or not the customer
ever pauses. No pass is repeated.

The trust list: whether a row may add its device does not depend on the list, since what
depends on it (an unknown device) is so whenever the device would be added. So with the
windows known, a segment is a sequence of devices. A customer with no more of them than the
list holds never evicts, and its lists are the devices first seen in earlier segments: one
aggregate. Other customers' lists are first in, first out; their segments are folded from
a guess, and again wherever the segment before turned out to end differently.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from ledgerhawk import config as C
from ledgerhawk.config import DecisionParams
from ledgerhawk.functions.joins import broadcast_if_small
from ledgerhawk.operators.segments import SEG

KEYS = ("customer_id", SEG)
STEP_FIELDS = "starts array<bigint>, anchors array<bigint>, firsts array<bigint>, seconds array<bigint>, all_first bigint, all_second bigint"
WINDOWS = ("micro", "mule")
ANCHOR_STATES = (("a1", "mc", "msum"), ("a30", "ins", "outs"))


def steps(t, first, second, window: int) -> tuple:
    """Step function of a segment with sorted times ``t`` and two values a row: an anchor
    whose window ends before ``starts[k]``, and no earlier start, leaves ``anchors[k]`` with
    the sums ``firsts[k]``, ``seconds[k]`` since; one whose window covers the segment stays,
    and its sums grow by those of all rows."""
    import numpy as np
    n = len(t)
    after = np.searchsorted(t, t + window, side="right")
    last = np.where(after < n, after, np.arange(n))
    while True:                                                 # to the end of each chain, by doubling
        further = last[last]
        if (further == last).all():
            break
        last = further
    reach = min(int(np.searchsorted(t, t[0] + window, side="right")), n - 1) + 1
    ends = np.flatnonzero(np.append(last[1:reach] != last[:reach - 1], True))    # the last row of each step
    sums = [np.concatenate([[0], np.cumsum(v)]) for v in (first, second)]
    at = last[ends]
    return (t[ends].tolist(), t[at].tolist(), (sums[0][n] - sums[0][at]).tolist(), (sums[1][n] - sums[1][at]).tolist(), int(sums[0][n]), int(sums[1][n]))


def leave(state: tuple, step: tuple, window: int) -> tuple:
    """Exit state of a segment for the entry state (anchor or None, first, second)."""
    from bisect import bisect_right
    starts, anchors, firsts, seconds, all_first, all_second = step
    k = 0 if state[0] is None else bisect_right(starts, state[0] + window)
    if k == len(starts):
        return state[0], state[1] + all_first, state[2] + all_second
    return anchors[k], firsts[k], seconds[k]


def _by_segment(batches: Iterator) -> Iterator:
    """Segments of a sorted partition: key, and the arrays of the other columns."""
    import numpy as np
    now, held = None, []
    for pdf in batches:
        keys = list(zip(pdf.iloc[:, 0].tolist(), pdf.iloc[:, 1].tolist()))
        cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and keys[a] != now:
                yield now, [np.concatenate(c) for c in zip(*held)]
                held = []
            now = keys[a]
            held.append([pdf.iloc[a:b, i].to_numpy() for i in range(2, pdf.shape[1])])
    if held:
        yield now, [np.concatenate(c) for c in zip(*held)]


def anchor_entries(hot: DataFrame, p: DecisionParams = DecisionParams(), base: DataFrame | None = None) -> DataFrame:
    """``customer_id, SEG`` and both windows' states at the start of every segment of
    ``hot``, whose rows are clustered by segment; ``base`` has those of customers before
    their first segment. A task holds one segment's times and sums,
    and one step function of a customer at a time."""
    sizes = (p.micro_window_ms, p.mule_window_ms)
    usd = F.col("_usd_cents")
    small = usd < p.micro_limit_cents
    kind = F.col("transaction_type")
    values = [F.when(small, 1).otherwise(0), F.when(small, usd).otherwise(0),
              F.when(kind.isin(*C.INBOUND_TYPES), usd).otherwise(0),
              F.when(~kind.isin(*C.INBOUND_TYPES) & kind.isin(*C.OUTBOUND_TYPES), usd).otherwise(0)]
    rows = hot.sortWithinPartitions(*KEYS, "_ts", "transaction_id").select(*KEYS, "_ts", *[F.coalesce(v.cast("long"), F.lit(0).cast("long")).alias(f"v{i}") for i, v in enumerate(values)])
    key = T.StructType([hot.schema["customer_id"], T.StructField(SEG, T.LongType())])
    made = T.StructType([*key.fields, *[T.StructField(w, T._parse_datatype_string(STEP_FIELDS)) for w in WINDOWS]])

    def summarise(batches: Iterator) -> Iterator:
        import pandas as pd

        from ledgerhawk.operators.summaries import _by_segment, steps
        names = ("starts", "anchors", "firsts", "seconds", "all_first", "all_second")
        for (customer, seg), (t, *v) in _by_segment(batches):
            both = [dict(zip(names, steps(t, v[2 * i], v[2 * i + 1], size))) for i, size in enumerate(sizes)]
            yield pd.DataFrame({"customer_id": [customer], SEG: [seg], "micro": [both[0]], "mule": [both[1]]})

    states = T.StructType([*key.fields, *[T.StructField(n, T.LongType()) for group in ANCHOR_STATES for n in group]])

    def walk(batches: Iterator) -> Iterator:
        import pandas as pd

        from ledgerhawk.operators.summaries import leave
        names = ("starts", "anchors", "firsts", "seconds", "all_first", "all_second")
        now, entry = None, None
        for pdf in batches:
            out = []
            for customer, seg, before, *both in zip(*(pdf[c].tolist() for c in ("customer_id", SEG, "before", *WINDOWS))):
                if entry is None or customer != now:
                    now, entry = customer, [(None, 0, 0)] * len(WINDOWS) if before is None else [tuple(before[:3]), tuple(before[3:])]
                out.append((customer, seg, *entry[0], *entry[1]))
                entry = [leave(e, tuple(list(s[n]) if i < 4 else s[n] for i, n in enumerate(names)), size) for e, s, size in zip(entry, both, sizes)]
            if out:
                frame = pd.DataFrame(out, columns=states.names, dtype=object)
                yield frame

    summaries = rows.mapInPandas(summarise, made).checkpoint()
    known = F.lit(None).cast("array<bigint>").alias("before")
    if base is not None:
        given = broadcast_if_small(base.select(F.col("customer_id").alias("_bk"), F.array(*[n for group in ANCHOR_STATES for n in group]).alias("before")))
        summaries, known = summaries.join(given, F.col("customer_id") == F.col("_bk"), "left"), F.col("before")
    summaries = summaries.select(*KEYS, known, *WINDOWS)
    return summaries.repartition("customer_id").sortWithinPartitions(*KEYS).mapInPandas(walk, states)


def _trust_exits(accesses: DataFrame, entries: DataFrame | None, size: int) -> DataFrame:
    """Trust list at the end of every segment of ``accesses``, from its entry list."""
    x = accesses.withColumn("_entry", F.lit(None).cast("array<string>"))
    if entries is not None:
        e = broadcast_if_small(entries.select(F.col("customer_id").alias("_ek"), F.col(SEG).alias("_es"), F.col("trusted").alias("_given")))
        x = accesses.join(e, (F.col("customer_id") == F.col("_ek")) & (F.col(SEG) == F.col("_es")), "left").withColumn("_entry", F.col("_given"))
    x = x.select(*KEYS, "_ts", "transaction_id", "device_id", "_entry").repartition(*KEYS).sortWithinPartitions(*KEYS, "_ts", "transaction_id") \
        .select(*KEYS, "device_id", "_entry")

    def fold(batches: Iterator) -> Iterator:
        import pandas as pd
        now, held, done = None, [], []
        for pdf in batches:
            for customer, seg, device, entry in zip(*(pdf[c].tolist() for c in (*KEYS, "device_id", "_entry"))):
                if now != (customer, seg):
                    if now is not None:
                        done.append((*now, held))
                    now, held = (customer, seg), [] if entry is None else list(entry)
                if device not in held:
                    held = [*held, device][-size:]
            if done:
                yield pd.DataFrame(done, columns=[*KEYS, "trusted"])
                done = []
        if now is not None:
            yield pd.DataFrame([(*now, held)], columns=[*KEYS, "trusted"])

    schema = T.StructType([accesses.schema["customer_id"], T.StructField(SEG, T.LongType()), T.StructField("trusted", T.ArrayType(T.StringType()))])
    return x.mapInPandas(fold, schema)


def _shifted(exits: DataFrame) -> DataFrame:
    """Entry list of each segment: the exit list of the customer's one before."""
    prev = F.lag("trusted").over(W.partitionBy("customer_id").orderBy(SEG))
    return exits.select(*KEYS, prev.alias("trusted")).where("trusted IS NOT NULL")


def evicting_exits(accesses: DataFrame, size: int) -> DataFrame:
    """Exit lists by fixpoint: after a round in which a segment's entry list did not
    change, its exit list is right; only the other segments are folded again."""
    exits = _trust_exits(accesses, None, size).checkpoint()
    entries = _shifted(exits).checkpoint()
    changed = entries.select(*KEYS)
    while not changed.isEmpty():
        redo = accesses.join(changed, list(KEYS), "left_semi")
        exits = exits.join(changed, list(KEYS), "left_anti").unionByName(_trust_exits(redo, entries, size)).checkpoint()
        following = _shifted(exits).checkpoint()
        changed = following.exceptAll(entries).select(*KEYS).checkpoint()
        entries = following
    return exits


def trust_entries(segments: DataFrame, accesses: DataFrame, p: DecisionParams = DecisionParams()) -> DataFrame:
    """``customer_id, SEG, trusted`` for every row of ``segments``, from the devices that may
    join the list: ``customer_id, SEG, _ts, transaction_id, device_id``."""
    firsts = accesses.groupBy("customer_id", "device_id").agg(F.min(F.struct(SEG, "_ts", "transaction_id")).alias("first"))
    many = firsts.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > p.trust_size).select("customer_id").checkpoint()
    few = firsts.join(many, "customer_id", "left_anti").groupBy("customer_id").agg(F.collect_list(F.struct("first", "device_id")).alias("seen"))
    quiet = segments.join(few, "customer_id", "left").select(*KEYS, F.array_sort(F.transform(
        F.filter(F.coalesce("seen", F.array().cast(few.schema["seen"].dataType)), lambda s: s["first"][SEG] < F.col(SEG)), lambda s: s["device_id"])).alias("trusted"))
    if many.isEmpty():
        return quiet
    exits = evicting_exits(accesses.join(broadcast_if_small(many), "customer_id", "left_semi").checkpoint(), p.trust_size)
    before = W.partitionBy("customer_id").orderBy(SEG).rowsBetween(W.unboundedPreceding, -1)
    # accesses may precede all of a customer's segments, so their exits are kept beside them
    busy = segments.join(many, "customer_id", "left_semi").withColumn("_own", F.lit(True)).join(exits.withColumnRenamed("trusted", "_exit"), list(KEYS), "full") \
        .select(*KEYS, "_own", F.coalesce(F.last("_exit", True).over(before), F.array().cast("array<string>")).alias("trusted")).where("_own").drop("_own")
    return quiet.join(many, "customer_id", "left_anti").unionByName(busy)
