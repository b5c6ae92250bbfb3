"""Segments against all intervals, tokens against a plain scan, held-out accuracy, edges."""

import random
import re
import zlib

from ledgerhawk.llm import toxicity


def plain_segments(s):
    """Maximal segments by their definition: the best run first, then left and right of it."""
    best = None
    for i in range(len(s)):
        for j in range(i + 1, len(s) + 1):
            v = sum(s[i:j])
            if v > 0 and (best is None or v > best[2] or v == best[2] and j - i < best[1] - best[0]):
                best = (i, j, v)
    if best is None:
        return []
    i, j, v = best
    return plain_segments(s[:i]) + [best] + [(a + j, b + j, w) for a, b, w in plain_segments(s[j:])]


def test_maximal_segments():
    rng = random.Random(0)
    assert toxicity.maximal_segments([4, -5, 3, -3, 1, 2, -2, 2, -2, 1, 5]) == [(0, 1, 4), (2, 3, 3), (4, 11, 7)]
    for _ in range(300):
        s = [rng.choice((-1, 1)) * (rng.randint(1, 10 ** 6) + 0.5) for _ in range(rng.randint(0, 14))]
        got = [(a, b, round(v, 3)) for a, b, v in toxicity.maximal_segments(s)]
        assert got == [(a, b, round(v, 3)) for a, b, v in plain_segments(s)]


def test_segments_skip_losing_runs():
    import numpy as np
    rng = random.Random(4)
    for _ in range(100):
        s = [rng.choice((-1, -1, 1)) * (rng.randint(1, 1000) + 0.5) for _ in range(30)]
        assert [(a, b) for a, b, _ in toxicity.segments(np.array(s))] == [(a, b) for a, b, _ in toxicity.maximal_segments(s)]


def test_tokens(monkeypatch):
    texts = ["", "One two, ONE", "é a", "...", "x" * 50 + " stupid clown", "two"]
    for size in (1 << 21, 8):
        monkeypatch.setattr(toxicity, "PASS_BYTES", size)
        bucket, stem, text, start, end, n = toxicity.token_buckets(texts)
        want = [(i, m.start(), m.end()) for i, t in enumerate(texts) for m in re.finditer(rb"[0-9A-Za-z\x80-\xff]+", t.encode())]
        assert list(zip(text.tolist(), start.tolist(), end.tolist())) == want and n == len(texts)
        words = [texts[i].encode()[a:b].lower() for i, a, b in want]
        for i, a in enumerate(words):
            for j, b in enumerate(words):
                assert (a == b) == (bucket[i] == bucket[j]) and (a[:5] == b[:5]) == (stem[i] == stem[j])


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    out = toxicity.op4(spark, sf)
    rows = out.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert out.count() == 10_000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == r["toxic"] for r in held) / len(held) > 0.96
    hit = [r["toxic"] for r in held if r["predicted"]]
    assert sum(hit) / len(hit) > 0.9 and sum(hit) / sum(r["toxic"] for r in held) > 0.8


def test_edges(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (4, 1, 0), (5, 1, None), (None, 1, 1), (6, 1, 0)], "doc_id long, quality int, toxic int")
    rows = toxicity.score(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["passages"] == [] for r in rows if not r["n_tokens"])
    assert all(r["score"] == 0 for r in toxicity.score(odd_docs, labels.limit(0)).collect())
    assert toxicity.score(odd_docs.limit(0), labels).count() == 0
