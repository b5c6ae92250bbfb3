"""Benchmark decontamination by SimHash over item-sized windows.

A document is contaminated by a benchmark item if some window of as many words as the
item has a weighted-shingle similarity (multiset Jaccard of five-word shingles) of at
least ``similarity``. The search:

1. Seeds: a window that similar shares a shingle with an item, so only windows around
   shared shingles are looked at. Each window is made once, by the first seed in it.
2. Every window and item gets a 64-bit SimHash of its shingles. The 64 bits are cut
   into ``radius + 1`` blocks; fingerprints within ``radius`` agree on one of them, so
   the join on (size, block, value) misses none. A pair is kept at its first equal
   block only, then by its exact distance.
3. The pairs left are verified on the words themselves.

Everything is column expressions. Two fingerprints of texts with similarity 0.8 differ
in about 10 of 64 bits (standard deviation 3); the default radius of 23 is more than
four deviations away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ledgerhawk.llm.common import stored, table

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 23
BROADCAST_SHINGLES = 1_000_000     # 24 bytes each; above, the seeds are found by a shuffled join
LANE_MAX = 65_535                  # shingles that a 16-bit counter lane can count


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), "")


def shingle_hashes(w: Column, k: int) -> Column:
    """XXH64 of every run of ``k`` words."""
    n = F.size(w)
    shifted = [F.slice(w, i + 1, F.greatest(n - k + 1, F.lit(0))).alias(f"w{i}") for i in range(k)]
    return F.transform(F.arrays_zip(*shifted), lambda x: F.xxhash64(*[x[f"w{i}"] for i in range(k)]))


def shingle_texts(w: Column, k: Column) -> Column:
    last = F.size(w) - k
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                                         lambda i: F.concat_ws(" ", F.slice(w, i + 1, k)))) \
        .otherwise(F.array(F.concat_ws(" ", w)))


def simhash(hashes: Column) -> Column:
    """Bitwise majority of 64-bit hashes; four 16-bit counters share a number."""
    lanes = F.lit(0x0001000100010001)
    n = F.size(hashes)
    bits = F.lit(0).cast("long")
    for j in range(16):
        counts = F.aggregate(hashes, F.lit(0).cast("long"),
                             lambda a, h: a + F.shiftrightunsigned(h, j).bitwiseAND(lanes))
        for lane in range(4):
            one = F.shiftrightunsigned(counts, 16 * lane).bitwiseAND(F.lit(LANE_MAX)) * 2 > n
            b = 16 * lane + j
            bits = bits.bitwiseOR(F.when(one, F.lit((1 << b) - (1 << 64 if b == 63 else 0))).otherwise(F.lit(0)))
    return bits


def blocks(radius: int) -> list[tuple[int, int]]:
    """(shift, mask) of ``radius + 1`` nearly equal blocks of 64 bits."""
    cut = [64 * i // (radius + 1) for i in range(radius + 2)]
    return [(a, (1 << b - a) - 1) for a, b in zip(cut, cut[1:])]


def multiset_jaccard(a: Column, b: Column) -> Column:
    """Sum of lesser counts over sum of greater counts of two arrays of shingles."""
    plain = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
    common = F.array_intersect(a, b)
    counted = F.aggregate(common, F.lit(0), lambda s, x: s + F.least(
        F.size(F.filter(a, lambda y: y == x)), F.size(F.filter(b, lambda y: y == x))))
    shared = F.when(plain, F.size(common)).otherwise(counted)
    return shared / (F.size(a) + F.size(b) - shared)


def _hashes_of(w: Column, k: Column, kinds: list[int]) -> Column:
    """Shingle hashes with the row's own ``k``; a list shorter than ``k`` is one shingle."""
    out = None
    for size in kinds:
        h = shingle_hashes(w, size)
        out = F.when(k == size, h) if out is None else out.when(k == size, h)
    short = F.array(F.xxhash64(F.concat_ws(" ", w)))
    return F.when(F.size(w) < k, short).otherwise(out)


def items(benchmark: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``item_id, words, n, k`` of every item with a word; repeated items count once."""
    return (benchmark.select("item_id", words(F.coalesce("text", F.lit(""))).alias("item_words"))
            .withColumn("n", F.size("item_words")).where("n > 0")
            .withColumn("k", F.least(F.col("n"), F.lit(shingle))).distinct())


def _seeds(docs: DataFrame, grams: DataFrame, k: int, n_grams: int) -> DataFrame:
    """Positions of shared shingles, with the words that windows around them can hold."""
    base = docs.select("doc_id", "digest", words(F.col("text")).alias("words")) \
        .withColumn("len", F.size("words")).where(F.col("len") >= k)
    at = base.select("doc_id", "digest", "len", "words", F.posexplode(shingle_hashes(F.col("words"), k)).alias("p", "h"))
    own = grams.where(F.col("k") == k)
    low = F.greatest(F.col("p") - F.col("n") + k, F.lit(0))
    if n_grams <= BROADCAST_SHINGLES:
        hit = at.join(F.broadcast(own), "h")
    else:
        whole = base.select(F.col("doc_id").alias("whole_id"), F.col("digest").alias("whole_digest"), "words").distinct()
        hit = at.drop("words").join(own, "h") \
            .join(whole, F.col("doc_id").eqNullSafe(F.col("whole_id")) & (F.col("digest") == F.col("whole_digest")))
    return hit.select("doc_id", "digest", "len", "n", "k", "p", low.alias("low"),
                      F.slice("words", low + 1, F.col("p") + F.col("n") - low).alias("near"))


def windows(docs: DataFrame, benchmark_items: DataFrame) -> DataFrame:
    """Every item-sized window with a shared shingle, once:
    ``doc_id, digest, n, k, start, window``."""
    kinds = [r[0] for r in benchmark_items.select("k").distinct().collect()]      # at most 1..shingle
    grams = None
    for k in kinds:
        g = (benchmark_items.where(F.col("k") == k)
             .select(F.explode(shingle_hashes(F.col("item_words"), k)).alias("h"), "n", "k"))
        grams = g if grams is None else grams.unionByName(g)
    if grams is None:
        return None
    grams = stored(grams.distinct(), "decontam-grams")
    n_grams = grams.count()
    seeds = None
    for k in kinds:
        s = _seeds(docs, grams, k, n_grams)
        seeds = s if seeds is None else seeds.unionByName(s)
    order = Window.partitionBy("doc_id", "digest", "n").orderBy("p")
    first = F.greatest(F.col("low"), F.coalesce(F.lag("p").over(order) + 1, F.lit(0)))
    last = F.least(F.col("p"), F.greatest(F.col("len") - F.col("n"), F.lit(0)))
    return (seeds.withColumn("first", first).withColumn("last", last).where("first <= last")
            .select("doc_id", "digest", "n", "k", "low", "near", F.explode(F.sequence("first", "last")).alias("start"))
            .select("doc_id", "digest", "n", "k", "start",
                    F.slice("near", F.col("start") - F.col("low") + 1, F.col("n")).alias("window")))


RESULT = "item_id, start, n_words, distance, similarity"


def contaminated(docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE,
                 similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """``doc_id, digest, item_id, start, n_words, distance, similarity``: the best window
    (highest similarity, then the first) of every contaminated document for every item.

    ``digest`` (XXH64 of the text) tells rows apart that share a doc_id or have none;
    rows equal in both are one document. Null and empty texts match nothing, items
    without a word are left out, items under ``shingle`` words are one shingle, and a
    document shorter than an item is one window. An empty side gives an empty result."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")) \
        .withColumn("digest", F.xxhash64("text"))
    bench = stored(items(benchmark, shingle), "decontam-items")
    longest = bench.agg(F.max("n")).first()[0] or 0
    if longest > LANE_MAX:
        raise ValueError(f"an item has {longest} words; counters hold {LANE_MAX}")
    wins = windows(docs, bench)
    if wins is None:
        return docs.where("false").select("doc_id", "digest", F.lit(None).cast(dict(bench.dtypes)["item_id"]).alias("item_id"),
                                          F.lit(0).alias("start"), F.lit(0).alias("n_words"), F.lit(0).alias("distance"),
                                          F.lit(0.0).alias("similarity"))
    kinds = list(range(1, shingle + 1))
    hashed = wins.withColumn("hashes", _hashes_of(F.col("window"), F.col("k"), kinds))
    left = stored(hashed.withColumn("fp", simhash(F.col("hashes"))), "decontam-windows")
    right = stored(bench.withColumn("item_hashes", _hashes_of(F.col("item_words"), F.col("k"), kinds))
                   .withColumn("item_fp", simhash(F.col("item_hashes"))).drop("k"), "decontam-prints")
    cut = blocks(radius)

    def keyed(df: DataFrame, fp: str) -> DataFrame:
        parts = F.array(*[F.shiftrightunsigned(F.col(fp), s).bitwiseAND(F.lit(m)) for s, m in cut])
        return df.select("*", F.posexplode(parts).alias("block", "value"))

    pairs = keyed(left, "fp").join(keyed(right, "item_fp"), ["n", "block", "value"])
    apart = F.col("fp").bitwiseXOR(F.col("item_fp"))
    first = F.coalesce(*[F.when(F.shiftrightunsigned(apart, s).bitwiseAND(F.lit(m)) == 0, F.lit(i))
                         for i, (s, m) in enumerate(cut)])
    pairs = pairs.where((F.bit_count(apart) <= radius) & (F.col("block") == first))
    near = stored(pairs.select("doc_id", "digest", "item_id", "start", "n", "k", F.bit_count(apart).alias("distance"),
                               "window", "item_words", "hashes", "item_hashes"), "decontam-pairs")
    # equal shingles have equal hashes, so a pair that fails on hashes fails on words
    exact = F.when(multiset_jaccard(F.col("hashes"), F.col("item_hashes")) >= similarity, multiset_jaccard(
        shingle_texts(F.col("window"), F.col("k")), shingle_texts(F.col("item_words"), F.col("k"))))
    scored = near.select("doc_id", "digest", "item_id", "start", F.col("n").alias("n_words"), "distance", exact.alias("similarity"))
    best = F.struct("similarity", (-F.col("start")).alias("at"), "n_words", "distance")
    return (scored.where(F.col("similarity") >= similarity).groupBy("doc_id", "digest", "item_id")
            .agg(F.max(best).alias("b"))
            .select("doc_id", "digest", "item_id", (-F.col("b.at")).alias("start"), "b.n_words", "b.distance", "b.similarity"))


def clean(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with all their columns."""
    bad = contaminated(docs, benchmark, similarity=similarity)
    bad = bad.select(F.col("doc_id").isNull().alias("_dc_none"), F.coalesce("doc_id", F.lit(0)).alias("_dc_id"),
                     F.col("digest").alias("_dc_digest")).distinct()
    keys = ["_dc_none", "_dc_id", "_dc_digest"]
    return (docs.withColumns({"_dc_none": F.col("doc_id").isNull(), "_dc_id": F.coalesce("doc_id", F.lit(0)),
                              "_dc_digest": F.xxhash64(F.coalesce("text", F.lit("")))})
            .join(bad, keys, "left_anti").drop(*keys))


def op5(spark, sf_dir: str) -> DataFrame:
    """Contaminated documents of whole ``documents`` against whole ``benchmark``."""
    out = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "item_id", F.col("start").cast("long"), F.col("n_words").cast("long"),
                      F.round("similarity", 6).alias("similarity"))


ORACLE = r"""
WITH it AS (SELECT item_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS iw FROM benchmark),
dw AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
ig AS (SELECT item_id, len(iw) AS n, q, list_aggregate(iw[q:q+4], 'string_agg', ' ') AS g
       FROM (SELECT item_id, iw, unnest(generate_series(1, len(iw) - 4)) AS q FROM it)),
dg AS (SELECT doc_id, len(w) AS len, p, list_aggregate(w[p:p+4], 'string_agg', ' ') AS g
       FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS p FROM dw)),
st AS (SELECT DISTINCT doc_id, item_id, n, len, unnest(generate_series(greatest(p - n + 5, 1), least(p, greatest(len - n + 1, 1)))) AS s
       FROM dg JOIN (SELECT DISTINCT item_id, n, g FROM ig) USING (g)),
wg AS (SELECT st.doc_id, st.item_id, st.n, st.s, g, count(*) AS c
       FROM st JOIN dg ON dg.doc_id = st.doc_id AND dg.p BETWEEN st.s AND st.s + st.n - 5 GROUP BY ALL),
ic AS (SELECT item_id, g, count(*) AS c, any_value(n) AS n FROM ig GROUP BY ALL),
sim AS (SELECT wg.doc_id, wg.item_id, wg.n, wg.s, sum(least(wg.c, ic.c)) AS shared
        FROM wg JOIN ic ON ic.item_id = wg.item_id AND ic.g = wg.g GROUP BY ALL),
tot AS (SELECT doc_id, item_id, n, s, sum(c) AS total FROM wg GROUP BY ALL),
j AS (SELECT doc_id, item_id, n, s, shared / (total + (n - 4) - shared) AS similarity FROM sim JOIN tot USING (doc_id, item_id, n, s))
SELECT doc_id, item_id, arg_min(s, (-similarity, s)) - 1 AS start, any_value(n)::BIGINT AS n_words, round(max(similarity), 6) AS similarity
FROM j WHERE similarity >= 0.8 GROUP BY doc_id, item_id
"""
