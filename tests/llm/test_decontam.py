"""Best windows against sliding over every document, both join ways, edges."""

from collections import Counter

import pytest

from ledgerhawk.llm import decontam

WORDS = [f"w{i}" for i in range(400)]


def tokens(t):
    out, word = [], ""
    for ch in (t or "").lower() + " ":
        if ch.isalnum():
            word += ch
        else:
            if word:
                out.append(word)
            word = ""
    return out


def grams(w, k):
    return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else Counter([tuple(w)])


def plain(docs, items):
    out = {}
    for d, t in docs:
        w = tokens(t)
        for i, b in items:
            want = tokens(b)
            n = len(want)
            if not w or not n:
                continue
            k = min(5, n)
            own = grams(want, k)
            best = None
            for s in range(max(1, len(w) - n + 1)):
                g = grams(w[s:s + n], k)
                shared = sum((g & own).values())
                sim = shared / (sum(g.values()) + sum(own.values()) - shared)
                if sim >= 0.8 and (best is None or sim > best[1] + 1e-12):
                    best = (s, sim)
            if best:
                out[d, i] = (best[0], round(best[1], 6))
    return out


DOCS = [
    (1, " ".join(WORDS[:60])), (2, "intro text " + " ".join(WORDS[10:40]) + " and more after it"),
    (3, " ".join([*WORDS[10:22], "edit", *WORDS[22:40]])), (4, " ".join(WORDS[100:190])), (5, None), (6, ""),
    (7, " ".join(WORDS[10:38])), (8, "Tiny, item!"), (9, " ".join([*WORDS[200:230], "x", *WORDS[200:230]])),
    (10, " ".join([*WORDS[10:20], "a", *WORDS[20:28], "b", *WORDS[28:40]])), (11, " ".join(["rep"] * 40)),
    (None, " ".join(WORDS[10:40])), (None, "clean words only in this one"),
]
ITEMS = [(1, " ".join(WORDS[10:40]).upper()), (2, "tiny item"), (3, ""), (4, None), (5, " ".join(WORDS[200:230])), (6, "rep " * 30)]


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_equals_sliding(spark, monkeypatch, limit):
    monkeypatch.setattr(decontam, "BROADCAST_SHINGLES", limit)
    docs = spark.createDataFrame([(*d, 1, "x") for d in DOCS], "doc_id long, text string, n long, words string").repartition(3)
    got = decontam.contaminated(docs, spark.createDataFrame(ITEMS, "item_id long, text string")).collect()
    want = plain([d for d in DOCS if d[0]], ITEMS)
    assert {(r["doc_id"], r["item_id"]): (r["start"], round(r["similarity"], 6)) for r in got if r["doc_id"]} == want
    assert [r["item_id"] for r in got if r["doc_id"] is None] == [1]
    assert (3, 1) not in want and (7, 1) in want and (1, 1) in want and (11, 6) in want


def test_clean_keeps_the_rest(spark, odd_docs):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontam.clean(docs, bench)
    bad = {d for d, _ in plain([d for d in DOCS if d[0]], ITEMS)}
    assert {r["doc_id"] for r in kept.collect() if r["doc_id"]} == {d for d, _ in DOCS if d} - bad
    assert [r["text"] for r in kept.collect() if r["doc_id"] is None] == ["clean words only in this one"]
    same = decontam.clean(odd_docs, bench)
    assert same.columns == odd_docs.columns and same.count() == odd_docs.count()
    assert decontam.clean(docs, bench.limit(0)).count() == len(DOCS)
    assert decontam.contaminated(docs.limit(0), bench).count() == 0


def test_simhash_and_blocks(spark):
    from pyspark.sql import functions as F
    hashes = [[1, 3, -1], [5], [-(1 << 63), -(1 << 63), 7]]
    rows = spark.createDataFrame([(h,) for h in hashes], "h array<long>").select(decontam.simhash(F.col("h"))).collect()
    want = [sum(1 << b for b in range(64) if 2 * sum((x >> b) & 1 for x in h) > len(h)) for h in hashes]
    assert [r[0] & (1 << 64) - 1 for r in rows] == want
    for radius in (0, 3, 23):
        cut = decontam.blocks(radius)
        assert len(cut) == radius + 1 and sum(m << s for s, m in cut) == (1 << 64) - 1


def test_native_plan(spark):
    out = decontam.op5(spark, "/root/testdata/sf0.001")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoop"))
