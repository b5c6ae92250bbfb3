"""Toxicity by maximum-scoring segments.

Tokens, and their first bytes, carry a log-odds between toxic and other labelled
documents, shrunk by a Dirichlet prior from all labelled text, less a drift that makes
ordinary text lose; of a token and its beginning the better counts, so that unseen forms
of a known stem are recognised. A linear scan finds every maximal segment of a whole text (Ruzzo and Tompa); extreme-value
theory says how surprising a segment of that score is in ordinary text of that length,
and the surprise of all significant passages becomes a probability.

Tokens are counted in ``BUCKETS`` hash buckets, so the table of log-odds that goes to
the executors has a fixed size whatever the vocabulary. Counting covers every labelled
document outside the held-out fifth; the calibration uses log-odds from the other half
of the labelled documents, so it never sees a document's own counts.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerhawk.llm.common import rows_of, stored, table

BUCKETS = 1 << 20
PRIOR = 0.0125           # pseudo-tokens of the prior per labelled token, shared out as all labelled text is
DEVIATIONS = 3.0         # by which every log-odds is moved towards none
STEM_BYTES = 5
DRIFT = 0.7              # taken from every token's log-odds
CAP = 6.0
PASS_BYTES = 1 << 21
FLOOR = -12.0


def _letters():
    import numpy as np
    own = np.zeros(256, bool)
    own[128:] = True
    for low, high in ((48, 58), (65, 91), (97, 123)):
        own[low:high] = True
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    return own, lower


def token_buckets(texts: list):
    """Buckets of all tokens (runs of letters, digits and bytes beyond ASCII, A-Z lowered)
    of the texts and of their first STEM_BYTES, with their text, start and end byte. Texts
    are scanned whole, in passes that end between tokens."""
    import numpy as np
    own, lower = _letters()
    base = np.uint64(0x9E3779B97F4A7C15)
    inverse = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
    at = np.cumsum(sizes + 1) - sizes - 1
    word = own[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([0], word.view(np.int8), [0]))))
    start, end = edge[::2], edge[1::2]
    bucket, stem = np.empty(len(start), np.int64), np.empty(len(start), np.int64)
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + PASS_BYTES)))
        low, high = start[i], end[j - 1]
        n = int(high - low)
        up, down = np.full(n, base), np.full(n, inverse)
        up[0] = down[0] = 1
        np.multiply.accumulate(up, out=up)
        np.multiply.accumulate(down, out=down)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((lower[data[low:high]].astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
        first, last = start[i:j] - low, end[i:j] - low
        for out, to, salt in ((bucket, last, 0), (stem, np.minimum(first + STEM_BYTES, last), 0x5851F42D4C957F2D)):
            h = (sums[to] - sums[first]) * down[first] ^ np.uint64(salt)
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            out[i:j] = ((h ^ (h >> np.uint64(30))) >> shift).astype(np.int64)
        i = j
    text = np.searchsorted(at, start, side="right") - 1
    return bucket, stem, text, start - at[text], end - at[text], len(raw)


def maximal_segments(scores: list) -> list:
    """All maximal scoring segments ``(first, last + 1, score)`` of a sequence, in order.

    Linear: every segment is pushed once and merged away at most once."""
    kept: list = []                  # first, end, sum before, sum after, previous smaller start
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        seg = [i, i + 1, before, total]
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= seg[2]:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= seg[3]:
                kept.append([*seg, j])
                break
            seg = [kept[j][0], seg[1], kept[j][2], seg[3]]
            del kept[j:]
    return [(a, b, after - before) for a, b, before, after, _ in kept]


def segments(w):
    """Maximal segments of one text's token scores. Runs of tokens that lose are one step, so the
    scan looks at the tokens that gain."""
    import numpy as np
    gain = np.flatnonzero(w > 0)
    if not len(gain):
        return []
    sums = np.concatenate(([0.0], np.cumsum(w, dtype=np.float64)))
    lost = sums[gain] - np.concatenate(([sums[gain[0]]], sums[gain[:-1] + 1]))
    steps = np.empty(2 * len(gain))
    steps[::2], steps[1::2] = lost, w[gain]
    return [(int(gain[a // 2]), int(gain[(b - 1) // 2]) + 1, s) for a, b, s in maximal_segments(steps.tolist())]


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def token_counts(labelled: DataFrame) -> DataFrame:
    """``half, bucket, toxic, other``: tokens of the labelled texts (``text, toxic, half``)."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from ledgerhawk.llm.toxicity import token_buckets as tokens
        for b in rows_of(batches, 2048):
            bucket, stem, text, _, _, _ = tokens(b.column(0).to_pylist())
            toxic, half = (np.array(b.column(i).to_pylist(), np.int64) for i in (1, 2))
            of = half[text] * 2 + toxic[text]
            key, n = np.unique(np.concatenate((bucket * 4 + of, stem * 4 + of)), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["key", "n"])

    got = labelled.select("text", "toxic", "half").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    part = F.col("key").bitwiseAND(F.lit(3))
    return got.groupBy(F.shiftright("key", 2).alias("bucket")).agg(
        *[F.sum(F.when(part == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(4)])


def log_odds(toxic: Column, other: Column, all_toxic: float, all_other: float) -> Column:
    """Log-odds of a bucket under the prior, moved DEVIATIONS towards none and capped."""
    prior = PRIOR * (toxic + other)
    y, z = toxic + prior, other + prior
    mass = PRIOR * (all_toxic + all_other)
    least = F.lit(1e-9)
    odds = F.log(y / F.greatest(all_toxic + mass - y, least)) - F.log(z / F.greatest(all_other + mass - z, least))
    sure = F.greatest(F.abs(odds) - DEVIATIONS * F.sqrt(1 / y + 1 / z), F.lit(0.0))
    return F.when(toxic + other > 0, F.signum(odds) * F.least(sure, F.lit(CAP))).otherwise(0.0)


def lexicons(counts: DataFrame) -> list:
    """Scores per bucket from all labelled text, from its first and from its second half.

    Only buckets whose log-odds is surely not none come to the driver, at most BUCKETS;
    the others score the drift alone."""
    import numpy as np
    n = [F.col(f"n{k}").cast("double") for k in range(4)]
    sums = [float(x or 0) for x in counts.agg(*[F.sum(x) for x in n]).first()]
    parts = [log_odds(n[1] + n[3], n[0] + n[2], sums[1] + sums[3], sums[0] + sums[2]),
             log_odds(n[1], n[0], sums[1], sums[0]), log_odds(n[3], n[2], sums[3], sums[2])]
    rows = counts.select("bucket", *[c.cast("float").alias(f"w{i}") for i, c in enumerate(parts)]) \
        .where("w0 != 0 or w1 != 0 or w2 != 0").toPandas()
    out = []
    for i in range(3):
        w = np.full(BUCKETS, -DRIFT, np.float32)
        w[rows["bucket"].to_numpy(np.int64)] += rows[f"w{i}"].to_numpy(np.float32)
        out.append(w)
    return out


def _scan(docs: DataFrame, weights: list) -> DataFrame:
    """``doc_id, half, n_tokens, passages, cross``: passages under the full table, and the
    scores of those under the table of the other half for rows that calibrate."""
    sc = docs.sparkSession.sparkContext
    sent = sc.broadcast(weights)
    src = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "half")
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from ledgerhawk.llm.toxicity import segments as of
        from ledgerhawk.llm.toxicity import token_buckets as tokens
        tables = sent.value
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for b in rows_of(batches, 1024):
            bucket, stem, text, start, end, n = tokens(b.column(1).to_pylist())
            full, *rest = (np.maximum(t[bucket], t[stem]) for t in tables)
            cut = np.searchsorted(text, np.arange(n + 1))
            passages, cross = [], []
            for i, half in enumerate(b.column(2).to_pylist()):
                own = slice(cut[i], cut[i + 1])
                passages.append([{"start": int(start[cut[i] + x]), "end": int(end[cut[i] + y - 1]), "score": s}
                                 for x, y, s in of(full[own])])
                cross.append(None if half is None else [s for _, _, s in of(rest[1 - half][own])])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(np.diff(cut)), pa.array(passages, span), pa.array(cross, pa.list_(pa.float64()))],
                ["doc_id", "half", "n_tokens", "passages", "cross"])

    return src.mapInArrow(run, f"doc_id {kind}, half int, n_tokens long, passages array<struct<start:int,end:int,score:double>>, cross array<double>")


def surprise(scores: Column, tokens: Column, decay: float, log_k: float) -> Column:
    """Nats by which the passages beat what ordinary text of that length holds: the best
    passage in full (at least FLOOR), the others where they are significant."""
    e = F.transform(scores, lambda s: s * decay - log_k - F.log(F.greatest(tokens, F.lit(1)).cast("double")))
    best = F.greatest(F.coalesce(F.array_max(e), F.lit(FLOOR)), F.lit(FLOOR))
    more = F.aggregate(e, F.lit(0.0), lambda a, x: a + F.greatest(x, F.lit(0.0)))
    return best + F.greatest(more - F.greatest(best, F.lit(0.0)), F.lit(0.0))


def _logistic(bins: list) -> tuple:
    """Slope and intercept for counts ``(x, positives, all)`` by Newton steps."""
    from math import exp
    a, b = 0.5, 0.0
    for _ in range(50):
        ga = gb = 0.0
        haa, hab, hbb = 1e-3, 0.0, 1e-3
        for x, good, n in bins:
            p = 1 / (1 + exp(-max(-30.0, min(30.0, a * x + b))))
            ga += (good - n * p) * x
            gb += good - n * p
            w = n * p * (1 - p)
            haa, hab, hbb = haa + w * x * x, hab + w * x, hbb + w
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        size = max(1.0, abs(da), abs(db) / 5)
        a, b = a + da / size, b + db / size
        if abs(da) + abs(db) < 1e-8:
            break
    return max(a, 0.0), b


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_tokens, passages`` of every row; passages are
    the significant segments as byte ``start, end`` and nats of ``surprise``.

    Labels of rows in the held-out fifth and null labels are not read; a document labelled
    twice is toxic if one label says so. Null and empty texts have no passage and get the
    least score. Without both labels to learn from every score is 0. Repeated rows are each
    answered; other columns are not read; an empty table gives an empty result."""
    marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 0)) \
        .groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    half = (fold(F.col("doc_id")) > 2).cast("int")
    # copies of a text count once, or a much copied document's words would look like evidence
    prints = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("print")).join(marks, "doc_id")
    once = prints.groupBy("print").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic")).drop("print")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(once, "doc_id").withColumn("half", half)
    weights = lexicons(stored(token_counts(texts), "tox-counts"))
    learn = fold(F.col("doc_id")) != 0
    scanned = stored(_scan(docs.select("doc_id", "text", F.when(learn & F.col("doc_id").isNotNull(), half).alias("half")), weights),
                     "tox-scan")
    held = scanned.where("half is not null").select("doc_id", "half", "n_tokens", "cross").join(marks, "doc_id")

    # scores of the best passage in ordinary documents follow a Gumbel law: its scale comes
    # from the spread, its location from the mean, which lies Euler's constant above
    best, length = F.array_max("cross"), F.log(F.greatest("n_tokens", F.lit(1)).cast("double"))
    spread = held.where("toxic = 0").agg(F.stddev(best)).first()[0]
    decay = 3.14159265 / (spread * 6 ** 0.5) if spread else 1.0
    log_k = (held.where("toxic = 0").agg(F.avg(best * decay - length)).first()[0] or 0.0) - 0.5772156649
    x = surprise(F.col("cross"), F.col("n_tokens"), decay, log_k)
    bins = held.select((F.round(F.least(F.greatest(x, F.lit(FLOOR)), F.lit(60.0)) * 4) / 4).alias("x"), "toxic") \
        .groupBy("x").agg(F.sum("toxic").alias("good"), F.count(F.lit(1)).alias("n")).collect()    # at most 289 bins
    good, every = sum(r["good"] for r in bins), sum(r["n"] for r in bins)
    value = surprise(F.transform("passages", lambda p: p["score"]), F.col("n_tokens"), decay, log_k)
    if 0 < good < every:
        a, b = _logistic([(r["x"], r["good"], r["n"]) for r in bins])
        p = 1.0 / (1.0 + F.exp(-(F.least(value, F.lit(60.0)) * a + b)))
    else:
        p = F.lit(0.0)
    found = F.filter(F.transform("passages", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"),
        (s["score"] * decay - log_k - F.log(F.greatest("n_tokens", F.lit(1)).cast("double"))).alias("surprise"))),
        lambda s: s["surprise"] > 0)
    return scanned.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), p.alias("score"), "n_tokens", found.alias("passages")) \
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op4(spark, sf_dir: str) -> DataFrame:
    """Contract digest of ``score`` over whole ``documents``."""
    out = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted", F.size("passages").cast("long").alias("n_passages"))
