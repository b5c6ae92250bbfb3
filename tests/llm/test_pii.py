"""Base spans against the contract's patterns, selection, redaction, edges."""

import hashlib
import random
import re

from ledgerhawk.llm import pii


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def plain(t):
    out = []
    for k, kind in enumerate(pii.BASE):
        for m in re.finditer(pii.BASE[kind], t):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                  "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def listed(spans):
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def tricky():
    rng = random.Random(9)
    parts = ["a@b.c", "x_y@d-e.f.g", "a@b.c.x_y@d.e", "1.2.3.4.5.6.7.8", "255.255.255.255", "256.1.1.1", "0001.2.3.4", "4111 1111 1111 1111",
             "4111-1111-1111-1111", "79927398713", "+1 (017) 555-7713", "+44 20 7946 0958", "+1", "é", "\U0001f600", "..", "@", "-", "%", " ", "\n", "9", "+", "12 34",
             "378282246310005", "+1 (826) 555-4081 19", "token = \"cb1a9fee807a05366fcb8b6c95c7c565ede51a72\""]
    return ["", *parts, *("".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(400)),
            "1" * 5000, "a" * 30_000 + "@", "1-" * 4000, "+" + "1 " * 4000, "é" * 50 + " a@b.c"]


def test_base_spans_equal_patterns(spark):
    texts = tricky()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pii.digest(pii.detect(df, pii.Trees([], [], {}))).collect()
    for r in rows:
        want = plain(texts[r["doc_id"]])
        assert r["spans"] == listed(want), texts[r["doc_id"]][:200]
        assert r["base_sha256"] == hashlib.sha256(listed(want).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS[:4]] == [sum(x == i for _, x, _ in want) for i in range(4)]


def test_trees_score_like_the_model(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F
    rng = random.Random(1)
    rows = [([float(rng.randint(0, 9)) for _ in range(3)],) for _ in range(300)]
    df = spark.createDataFrame(rows, "x array<double>").withColumn("label", ((F.col("x")[0] + F.col("x")[1] * F.col("x")[2]) > 20).cast("double")) \
        .withColumn("features", array_to_vector("x"))
    model = GBTClassifier(maxIter=5, maxDepth=3, seed=1).fit(df)
    ours = pii.Trees(pii._parse(model.toDebugString), list(model.treeWeights), {})
    from pyspark.ml.functions import vector_to_array
    got = model.transform(df).select(vector_to_array("probability")[1].alias("p"), ours.score([F.col("x")[i] for i in range(3)]).alias("q")).collect()
    assert max(abs(r["p"] - r["q"]) for r in got) < 1e-9


def test_selection_and_redaction(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = pii.train(docs)
    assert 4 in model.least
    text = 'call token = "cb1a9fee807a05366fcb8b6c95c7c565ede51a72" or a@b.c now'
    df = spark.createDataFrame([(1, text, 5, "s")], "doc_id long, text string, n_chars long, base string")
    got = pii.digest(pii.detect(df, model)).first()["spans"].split(",")
    assert "email:59:64" in got and any(s.startswith("secret:") for s in got)
    out = pii.redact(df, model)
    row = out.first()
    assert out.columns == df.columns and row["text"] == 'call token = "[secret]" or [email] now'
    assert row["n_chars"] == len(row["text"]) and row["base"] == "s"
    prose = spark.createDataFrame([(1, "an ordinary text, version 4.0. of 2024-01-05 with internationalisation")], "doc_id long, text string")
    assert pii.digest(pii.detect(prose, model)).first()["spans"] == ""


def test_edges(spark, odd_docs):
    none = pii.Trees([], [], {})
    got = pii.digest(pii.detect(odd_docs, none)).collect()
    assert len(got) == odd_docs.count() and all(r["spans"] == "" for r in got)
    same = pii.redact(odd_docs, none)
    assert same.columns == odd_docs.columns and sorted(map(str, same.collect())) == sorted(map(str, odd_docs.collect()))
    empty = odd_docs.limit(0)
    assert pii.digest(pii.detect(empty)).count() == 0 and pii.train(empty).least == {}


def test_native_plan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = pii.digest(pii.detect(docs, pii.Trees([1.0], [1.0], {4: 0.5})))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Exchange"))


def test_sample_and_thresholds_cover_the_whole_table(spark, monkeypatch):
    monkeypatch.setattr(pii, "TRAIN_DOCS", 200)
    secret = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(300)]
    texts = [f"an ordinary text, version {i}.0 of 2024-01-05" for i in range(300)] + [f'some words, token = "{s}" and more' for s in secret]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = pii.train(docs.coalesce(1))                 # the sources one after the other
    assert 4 in model.least
    assert pii.train(docs.repartition(7)).least == model.least
    got = pii.digest(pii.detect(docs, model)).where("spans like 'secret%'").count()
    assert got == len(secret)
    sample = docs.where(pii._sampled(docs)).select("doc_id").collect()
    assert 0 < len(sample) <= 200 and any(r[0] >= 300 for r in sample)
    assert pii._unseen(docs, pii._sampled(docs)).count() > len(secret) - len(sample)
