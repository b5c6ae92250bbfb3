import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from ledgerhawk.llm import merkle


def hashed(text):
    return sha256(text.encode()).hexdigest()


def plain(rows):
    """The manifest by its definition; rows of (doc_id, source, lang, n_chars, text)."""
    def leaf(r, text):
        return hashed("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*r[:4], text)))

    def climb(nodes):
        """Root, and the run and place of every node on each level."""
        steps = [[] for _ in nodes]
        at = [[i] for i in range(len(nodes))]
        while len(nodes) > 1:
            runs = [nodes[i:i + 3] for i in range(0, len(nodes), 3)]
            for k, own in enumerate(at):
                for i in own:
                    steps[i].append((runs[k // 3], k % 3))
            at = [sum(at[i:i + 3], []) for i in range(0, len(at), 3)]
            nodes = [hashed("".join(r)) for r in runs]
        return nodes[0], steps

    found = [(r, leaf(r, r[4]), leaf(r, None if r[4] is None else r[4].replace("\n", ""))
              if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 else leaf(r, r[4])) for r in rows]
    names = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: sorted((f for f in found if f[0][1] == s), key=lambda f: (f[0][0] is not None, f[0][0] or 0, f[1])) for s in names}
    trees = {s: climb([f[1] for f in own[s]]) for s in names}
    root, over = climb([trees[s][0] for s in names]) if names else ("", [])
    out = []
    for k, s in enumerate(names):
        for f, steps in zip(own[s], trees[s][1]):
            proof, node = "", f[2]
            for run, i in steps + over[k]:
                proof += "".join(run[:i] + run[i + 1:])
                node = hashed("".join(run[:i]) + node + "".join(run[i + 1:]))
            out.append((f[0][0], f[1], trees[s][0], root, hashed(proof), node, node == root))
    return out


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def run(spark, docs, monkeypatch):
    monkeypatch.setattr(merkle, "table", lambda *_: docs)
    return [tuple(r) for r in merkle.op12(spark, "").select(*COLUMNS).collect()]


def same(a, b):
    assert sorted(map(str, a)) == sorted(map(str, b))


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_every_row_as_defined(spark, small_docs, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 3 ** levels)
    rows = [tuple(r) for r in small_docs.select(*merkle.FIELDS).collect()]
    got = run(spark, small_docs, monkeypatch)
    same(got, plain(rows))
    assert 0 < sum(r[-1] for r in got) < len(got)


def test_odd_rows(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 3)
    rows = [tuple(r) for r in odd_docs.select(*merkle.FIELDS).collect()]
    rows += [(i, None, None, None, "a\nb") for i in (1, 2, 2, 3, None)] + [(9, "Ä", "x", 1, "t"), (9, "z", "x", 1, "t"), (9, "", "", 1, "")]
    docs = spark.createDataFrame(rows, odd_docs.select(*merkle.FIELDS).schema).withColumn("pos", F.lit(1)).withColumn("grp", F.lit("g"))
    same(run(spark, docs, monkeypatch), plain(rows))


def test_empty_and_single(spark, odd_docs, monkeypatch):
    docs = odd_docs.select(*merkle.FIELDS)
    assert run(spark, docs.limit(0), monkeypatch) == []
    one = docs.where("doc_id = 8")
    same(run(spark, one, monkeypatch), plain([tuple(r) for r in one.collect()]))


def test_proof_is_a_path(spark, small_docs):
    done = merkle.manifest(merkle.tampered(small_docs)).limit(20).collect()
    for r in done:
        assert merkle.fold(r["leaf"], r["proof"]) == r["root"]
