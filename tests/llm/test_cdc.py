"""Chunks by a byte-wise gear hash, removal by a set of chunks, edges."""

import numpy as np

from ledgerhawk.llm import cdc


def plain_ends(b):
    table, h, ends, start = cdc.gear().astype(int).tolist(), 0, [], 0
    for i, c in enumerate(b):
        h = (h << 1) + table[c] & 0xFFFF
        n = i + 1 - start
        if n == cdc.MOST or (n >= cdc.LEAST and h >> 16 - cdc.BITS == 0):
            start = i + 1
            ends.append(start)
    return ends + [len(b)] * (start < len(b))


def plain(docs):
    seen, out = set(), {}
    for i, t in sorted(docs):
        b, at, spans, n = (t or "").encode(), 0, [], 0
        own = set()
        for e in plain_ends(b):
            if b[at:e] in seen or b[at:e] in own:
                if spans and spans[-1][1] == at:
                    spans[-1][1] = e
                else:
                    spans.append([at, e])
            own.add(b[at:e])
            at, n = e, n + 1
        seen |= own
        out[i] = (len(b), n, spans)
    return out


def test_given_documents(spark, small_docs):
    got = {r["doc_id"]: (r["n_bytes"], r["n_chunks"], [list(s) for s in r["spans"]])
           for r in cdc.repeated_chunks(small_docs.repartition(5)).collect()}
    assert got == plain([(r["doc_id"], r["text"]) for r in small_docs.collect()])


def test_cuts_resist_insertions():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 110, 20_000, dtype=np.uint8)
    moved = np.concatenate((data[:5000], np.frombuffer(b"inserted", np.uint8), data[5000:]))
    a = {bytes(data[s:e]) for s, e in zip([0, *cdc.chunk_ends(data)], cdc.chunk_ends(data))}
    b = {bytes(moved[s:e]) for s, e in zip([0, *cdc.chunk_ends(moved)], cdc.chunk_ends(moved))}
    assert len(a - b) <= 4


def test_passes_agree(monkeypatch):
    data = np.random.default_rng(4).integers(0, 256, 5000, dtype=np.uint8)
    whole = cdc.cut_points(data).tolist()
    monkeypatch.setattr(cdc, "PASS_BYTES", 100)
    assert cdc.cut_points(data).tolist() == whole


def test_edges(spark, odd_docs):
    rows = cdc.repeated_chunks(odd_docs).collect()
    by = {(r["doc_id"], r["n_bytes"]): r for r in rows}
    assert len(rows) == odd_docs.select("doc_id", "text").distinct().count()
    assert by[1, 0]["n_chunks"] == 0 and by[2, 0]["spans"] == []
    whole = 120 - by[5, 120]["n_removed"]
    assert 0 < whole <= 120 and by[6, 120]["n_removed"] == 120
    texts = {(r["doc_id"], len(r["text"])) for r in cdc.strip(odd_docs).collect()}
    assert (6, 0) in texts and (1, 0) in texts
    assert cdc.repeated_chunks(odd_docs.limit(0)).count() == cdc.strip(odd_docs.limit(0)).count() == 0


def test_endings_alike_are_no_repeats(spark):
    def body(seed, n):
        return "".join(map(chr, np.random.default_rng(seed).integers(97, 123, n)))

    def ending(text):
        ends = [0, *plain_ends(text.encode())]
        return text[ends[-2]:]

    found = {}
    for seed in range(2000):                           # texts of their own that end in the same short chunk
        text = body(seed, 700) + "."
        if len(ending(text)) < 4:
            found.setdefault(ending(text), []).append(text)
    tail, (a, b, *_) = next((k, v) for k, v in found.items() if len(v) > 1)
    long_tail = next(t for t in (body(s, 700) for s in range(9000, 9100)) if 4 < len(ending(t)) < cdc.LEAST)
    rows = [(1, a), (2, b), (3, tail), (4, tail), (5, long_tail), (6, long_tail)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in cdc.repeated_passages(docs).collect()}
    assert got[2]["n_removed"] == got[2]["removed_chunks"] == got[2]["n_spans"] == 0 and got[2]["spans"] == []
    assert got[3]["n_removed"] == 0 and got[4]["n_removed"] == len(tail)
    assert got[6]["n_removed"] == 700 and got[6]["n_spans"] == 1
    assert {r["doc_id"]: r["text"] for r in cdc.strip(docs).collect()} == {1: a, 2: b, 3: tail, 4: "", 5: long_tail, 6: ""}


def test_op8_keeps_lone_endings(spark):
    raw = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in cdc.repeated_chunks(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect()}
    size = lost = 0
    for r in cdc.op8(spark, "/root/testdata/sf0.001").collect():
        spans = [tuple(map(int, x.split(":"))) for x in r["spans"].split(",") if x]
        want = [s for s in raw[r["doc_id"]] if not (s[1] == r["n_bytes"] and 0 < s[1] - s[0] < cdc.LEAST and s[0] > 0)]
        assert spans == want and r["n_removed"] == sum(b - a for a, b in spans)
        lost, size = lost + len(raw[r["doc_id"]]) - len(spans), size + len(spans)
    assert lost > 0 and size > 0
