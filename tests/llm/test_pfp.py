"""Removed bytes against a dictionary of all 50-byte strings."""

import hashlib
import random

import numpy as np

from ledgerhawk.llm import pfp


def plain(docs):
    """doc_id -> (n_bytes, n_removed, n_spans, digest) for (doc_id, text) pairs."""
    first = {}
    for i, t in docs:
        b = (t or "").encode()
        for s in range(len(b) - 49):
            g = b[s:s + 50]
            first[g] = min(i, first.get(g, i))
    out = {}
    for i, t in docs:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - 49):
            if first[b[s:s + 50]] < i:
                gone[s:s + 50] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out[i] = (len(b), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest())
    return out


def found(spark, pairs, parts):
    df = spark.createDataFrame(pairs, "doc_id long, text string").repartition(parts)
    from pyspark.sql import functions as F
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["h"])
            for r in pfp.repeated_strings(df).withColumn("h", F.sha2("kept", 256)).collect()}


def test_given_documents(spark):
    rows = {r["doc_id"]: tuple(r)[1:] for r in pfp.op2(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert rows == plain([tuple(r) for r in docs])


def test_low_entropy_and_edits(spark):
    rng = random.Random(11)
    base = "".join(rng.choices("ab é", k=400))
    docs = [(i, "") for i in range(3)]
    for i in range(3, 60):
        kind = i % 6
        if kind == 0:
            t = "a" * rng.randint(40, 200)
        elif kind == 1:
            t = base[rng.randint(0, 200):][:rng.randint(45, 160)]
        elif kind == 2:
            s = list(base)
            for _ in range(6):
                s[rng.randrange(len(s))] = rng.choice("xyz")
            t = "".join(s)
        elif kind == 3:
            t = "".join(rng.choices("ab", k=300)) + base[100:149] + "!" + base[100:151]
        elif kind == 4:
            t = ("abc" * 40)[: rng.randint(49, 120)]
        else:
            t = base
        docs.append((i, t))
    rng.shuffle(docs)
    assert found(spark, docs, 7) == plain(docs) == found(spark, docs, 1)


def test_suffix_order():
    rng = random.Random(2)
    data = np.frombuffer("".join(rng.choices("ab", k=300)).encode(), np.uint8)
    starts = np.arange(280)
    order, new = pfp.suffix_order(data, starts, 11)
    keys = [bytes(data[s:s + 11]).ljust(11, b"\0") for s in range(280)]
    assert [keys[i] for i in order] == sorted(keys)
    assert new.sum() == len(set(keys))


def test_edges(spark, odd_docs):
    rows = pfp.repeated_strings(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {(r["doc_id"], r["n_bytes"]): r for r in rows}
    assert by[1, 0]["n_removed"] == by[2, 0]["n_removed"] == 0 and bytes(by[1, 0]["kept"]) == b""
    assert by[4, 300_000]["n_removed"] == by[5, 120]["n_removed"] == by[None, 66]["n_removed"] == 0
    assert by[6, 120]["n_removed"] == 120 and [tuple(s) for s in by[6, 120]["spans"]] == [(0, 120)]
    assert pfp.repeated_strings(odd_docs.limit(0)).count() == 0
