import random
import re
import time

import pytest
from pyspark.sql import functions as F

from ledgerhawk.llm import licenses


def plain(text, threshold=licenses.THRESHOLD):
    """Counts, phrase places and block matches of a text by their definition."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = sorted((label, i) for p, label in licenses.PHRASES for i in range(len(words)) if words[i:i + len(p.split())] == p.split())
    matches = set()
    for label, t in licenses.TEMPLATES:
        own = licenses.words_of(t)
        m, n = len(own), len(set(own))
        for b in range(0, max(len(words), 1), m):
            common = len(set(own) & set(words[b:b + 2 * m]))
            if common >= licenses.needed(n, threshold):
                matches.add((label, b, min(b + 2 * m, len(words)) - 1, round(common / n, 9)))
    return len(words), places, sorted(matches)


def held(docs, rows, threshold=licenses.THRESHOLD):
    got = licenses.scan(docs, threshold=threshold).collect()
    assert len(got) == len(rows)
    found = sorted(str((r["doc_id"], r["n_words"], sorted((p["label"], p["at"]) for p in r["places"]),
                        sorted({(m["label"], m["first"], m["last"], round(m["containment"], 9)) for m in r["matches"]}))) for r in got)
    assert found == sorted(str((i, *plain(t, threshold))) for i, t in rows)


def test_notices_whole_cut_and_wrapped(spark):
    texts = []
    for _, t in licenses.TEMPLATES:
        words = t.split()
        texts += [t, t.upper(), "\n * ".join(words), " ".join(words[1:]), " ".join(words[len(words) // 3:]),
                  "some code before it " * 7 + t + " and some after" * 9, " ".join(reversed(words))]
    texts += ["UNDER THE MIT LICENSE", "the mit licensed", "under-the-MIT-License; cc\nby\nnc", "under the mit licenſe", "under the KMIT license",
              "apache license version 2 apache license version 2", ("cc by nc " * 2000)]
    rows = list(enumerate(texts))
    held(spark.createDataFrame(rows, "doc_id long, text string"), rows)


@pytest.mark.parametrize("threshold", [0.5, 0.9])
def test_random_blocks(spark, threshold):
    rng = random.Random(3)
    pool = sorted({w for _, t in licenses.TEMPLATES for w in licenses.words_of(t)}) + ["x", "y", "z"] * 20
    rows = []
    for i in range(60):
        words = rng.choices(pool, k=rng.randrange(0, 90))
        own = licenses.words_of(rng.choice(licenses.TEMPLATES)[1])
        words[len(words) // 2:len(words) // 2] = [w for w in own if rng.random() < 0.93]
        rows.append((i % 50, " ".join(words)))
    held(spark.createDataFrame(rows, "doc_id long, text string"), rows, threshold)


def test_odd_rows(spark, odd_docs, small_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    held(odd_docs.withColumn("marks", F.lit(1)).withColumn("found", F.lit("x")), rows)
    assert licenses.scan(odd_docs.limit(0)).collect() == []
    held(small_docs, [(r["doc_id"], r["text"]) for r in small_docs.collect()])


def test_time_grows_with_the_text(spark):
    notice = "Released under the MIT License. Licensed under the Apache License, Version 2.0.\n"
    took = []
    for n in (4_000, 32_000):
        docs = spark.createDataFrame([(1, notice * n)], "doc_id long, text string")
        began = time.time()
        row = licenses.scan(docs).select(F.size("places").alias("p"), F.size("matches").alias("m")).first()
        took.append(time.time() - began)
        assert row["p"] == 2 * n and row["m"] > n
    assert took[1] < 40 * max(took[0], 1)


def test_no_python_on_the_main_path(spark, small_docs):
    plan = licenses.scan(small_docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)
