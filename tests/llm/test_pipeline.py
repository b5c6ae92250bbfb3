"""The stages one after another against plain versions of each."""

import corpus_pipeline
from ledgerhawk.llm import quality, simhash, viterbi
from test_decontam import plain as leaks
from test_simhash import classes, plain_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    columns, out = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = stage(spark, docs, SF)
        rows = {r["doc_id"]: r for r in docs.collect()}
        assert len(rows) == docs.count()
        if name != "sentencepiece_ids":
            assert docs.columns == columns
        if name == "quality_rules":
            kept = quality.measure([r["text"] for r in before.values()], [r["lang"] for r in before.values()], quality.score.__defaults__[0])
            assert set(rows) == {i for i, k in zip(before, kept) if k[-1]}
        elif name == "simhash_near_dedup":
            fp = {i: plain_fingerprint(r["text"]) for i, r in before.items()}
            root, least = classes(fp.values(), 3), {}
            for i, f in fp.items():
                least[root[f]] = min(i, least.get(root[f], i))
            assert set(rows) == set(least.values())
        elif name == "benchmark_decontamination":
            assert set(rows) == set(before) - {d for d, _ in leaks([(i, r["text"]) for i, r in before.items()], bench)}
        elif name == "pii_redaction":
            assert set(rows) == set(before) and all("@mail" not in r["text"] for r in rows.values())
        else:
            v = viterbi.Vocabulary.of(viterbi.MODEL)
            assert all(viterbi.decode(r["ids"], v) == before[i]["text"] for i, r in rows.items()) and set(rows) == set(before)
        out[name] = set(rows)
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, SF).collect()} == out["sentencepiece_ids"]
    assert simhash.first_masks(3)


def test_odd_documents_pass_every_stage(spark, odd_docs):
    docs = odd_docs
    for _, stage in corpus_pipeline.STAGES[1:]:
        docs = stage(spark, docs, SF)
        assert docs.count() == 7
    empty = odd_docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_registered():
    import __spark_entry__ as entry
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
