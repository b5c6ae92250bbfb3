"""Counts against SQL, fertility against the tokeniser on whole words, edges."""

import sentencepiece
from ledgerhawk.llm import quality
from ledgerhawk.llm.common import TOKENIZER_DIR
from ledgerhawk.plans.harness import duck

MODEL = f"{TOKENIZER_DIR}/piece_bpe_32k.model"
BASE = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_counts_equal_sql(spark):
    sf = "/root/testdata/sf0.001"
    got = sorted(tuple(r) for r in quality.op6(spark, sf).select(*BASE).collect())
    assert got == sorted(duck(sf).sql(quality.BASE_SQL).fetchall())


def test_repeat_words_by_definition():
    def plain(words):
        n = len(words) - 4
        grams = [tuple(words[i:i + 5]) for i in range(max(0, n))]
        hit = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)}
        return len(hit)

    for text in ("a a a a a a", "a b c d e a b c d e", "a b c d e f a b c d", "x " * 30, "one two three four five", ""):
        assert quality.repeat_words(text.encode().split()) == plain(text.split())


def test_fertility_is_the_vocabulary_s():
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    text = "The café naïve \U0001f600 wordlet anthwh"
    row = quality.measure([text], ["en"], MODEL)[0]
    ids = [i for w in text.split() for i in sp.encode(w)]
    assert row[5] == len(ids) and row[7] == sum(map(sp.is_byte, ids)) / len(ids)


def test_edges(spark, odd_docs):
    rows = quality.score(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {(r["doc_id"], r["n_words"]): r for r in rows}
    assert by[1, 0]["base_failed"] and not by[1, 0]["kept"] and by[2, 0]["word_chars"] == 0
    assert by[4, 60_000]["n_repeat_words"] == 60_000
    assert by[None, 12]["kept"]
    kept = quality.keep(odd_docs)
    assert kept.columns == odd_docs.columns and [r["doc_id"] for r in kept.collect()] == [None]
    assert quality.score(odd_docs.limit(0)).count() == quality.keep(odd_docs.limit(0)).count() == 0


def test_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    out = quality.op6(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("quality = 1 and not base_failed")
    assert out.where("kept").count() == out.count()


def test_bands_hold_at_every_length():
    from math import log2
    for band, known in [(b, True) for b in quality.BANDS.values()] + [(b, False) for b in quality.SCRIPT_BANDS.values()]:
        for n in (20, 40, 70, 100, 200, 460, 1000, 10_000, 1_000_000):
            usual = (band[0] + band[1]) / 2 * n
            assert not quality.judge(usual, n, 0, 0.95 * log2(n), band, known)
            assert quality.judge(usual, n, 0, 0.15 * log2(n), band, known)
            assert quality.judge((band[1] + 3) * n, n, 0, 0.95 * log2(n), band, known)
            if band[2] < 1:
                assert quality.judge(usual, n, n, 0.95 * log2(n), band, known)
            if known:
                assert quality.judge(1.0 * n, n, 0, 0.95 * log2(n), band) and quality.judge(usual, n, 0, 0.29 * log2(n), band)


def test_codes_are_forgiven_once():
    words = "the clean text holds one token and then some more words".split()
    secret = "dfd1944d2e84f15e89902e34b677eb5a8a7d42ab"
    one, many = " ".join([*words, secret]), " ".join([*words, *(secret[i:] + secret[:i] for i in range(30))])
    got = quality.measure([one, many, "10 20 30 40 50 60 70 80 90 11 21 31"], ["en"] * 3, MODEL)
    assert [r[-2] for r in got] == [False, True, True]


def test_labelled_junk_is_rejected(spark):
    sf = "/root/testdata/sf0.1"
    rows = quality.op6(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed") \
        .select("quality", "kept", "n_tokens").collect()
    assert all(r["kept"] for r in rows if r["quality"] == 1)
    for low, high in ((0, 200), (200, 460), (460, 1 << 40)):
        junk = [r["kept"] for r in rows if r["quality"] == 0 and low <= r["n_tokens"] < high]
        assert junk.count(False) > len(junk) / 2
