"""Fingerprints, bit-sliced links and classes against plain versions."""

import random

import pytest
import xxhash

from ledgerhawk.llm import simhash
from ledgerhawk.llm.components import components


def plain_fingerprint(text):
    words = text.encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(fps, radius):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    fps = list(parent)
    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if bin(a ^ b).count("1") <= radius:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in fps}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def some_fingerprints(seed, n=300):
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        f = rng.getrandbits(64)
        out.add(f)
        for _ in range(rng.choice((0, 0, 1, 6))):
            for b in rng.sample(range(64), rng.randint(1, 5)):
                f ^= 1 << b
            out.add(f)
    return sorted(out)


def test_fingerprint():
    for text in ("", "  ", "One", "one TWO", "a b c", "Été Aß c d\x1ce f g" * 9, "a b " * 999):
        assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("radius,rows", [(3, 1 << 16), (3, 8), (2, 1 << 16), (5, 1 << 16), (1, 4), (0, 1 << 16)])
def test_links_find_all_classes(spark, radius, rows):
    fps = some_fingerprints(radius)
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    star = components(simhash.links(df, radius, rows)).collect()
    got, want = {}, {}
    roots = {r["node"]: r["root"] for r in star}
    for f in fps:
        got.setdefault(roots.get(signed(f), signed(f)), set()).add(f)
    for f, r in classes(fps, radius).items():
        want.setdefault(r, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (200, 199)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 199: 199, 200: 199}
    assert components(edges.limit(0)).count() == 0


def test_op9(spark, small_docs):
    rows = simhash.op9(spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: r["text"] for r in small_docs.collect()}
    fp = {i: plain_fingerprint(t) for i, t in texts.items()}
    root = classes(fp.values(), 3)
    least = {}
    for i, f in fp.items():
        least[root[f]] = min(i, least.get(root[f], i))
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == \
        {i: (f"{f:016x}", least[root[f]]) for i, f in fp.items()}


def test_edges(spark, odd_docs):
    got = simhash.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by[1]["component_id"] == by[2]["component_id"] == by[3]["component_id"] == 1 and by[1]["fp"] == 0
    assert by[6]["component_id"] == 5
    assert sorted(r["component_id"] is None for r in got if r["doc_id"] is None) == [True, True]
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r["doc_id"] or 0, len(r["text"] or "")) for r in kept.collect()) == \
        [(0, 4), (0, 66), (1, 0), (4, 300_000), (5, 120), (7, 100_000), (8, 28)]
    assert simhash.keep_one(odd_docs.limit(0)).count() == 0
