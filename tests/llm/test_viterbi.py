"""Exact round trips, and the best score by a plain search."""

import random

from ledgerhawk.llm import viterbi


def plain_best(text, v):
    """Highest score over all segmentations of a text without literal blanks' signs."""
    s = (" " + text).replace(" ", viterbi.BLANK)
    best = [0.0] + [float("-inf")] * len(s)
    for i in range(len(s)):
        if s[i] not in v.piece:
            best[i + 1] = max(best[i + 1], best[i] + v.byte_score * len(v.char_ids(s[i])))
        for j in range(i + 1, min(len(s), i + v.longest) + 1):
            if s[i:j] in v.piece:
                best[j] = max(best[j], best[i] + v.piece[s[i:j]][0])
    return best[-1]


def score_of(ids, v):
    worth = {i: s for s, i in v.piece.values()}
    return sum(worth.get(i, v.byte_score) for i in ids)


def sample():
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz" * 3 + "ABCXYZ0123456789éß你\U0001f600 \n\t.,*" * 2 + "      "
    return ["", " ", "a", "  two  blanks ", "line\nbreak\n\n", "café 你好 \U0001f600"] + \
        ["".join(rng.choices(letters, k=rng.randint(1, 400))) for _ in range(60)] + ["q" * 700, "the" * 300, "你" * 200]


def test_best_score_and_round_trip():
    v = viterbi.Vocabulary.of(viterbi.MODEL)
    for text, ids in zip(sample(), viterbi.encode(sample(), v)):
        assert viterbi.decode(ids, v) == text
        assert score_of(ids.tolist(), v) == plain_best(text, v)


def test_stream_equals_batch():
    v = viterbi.Vocabulary.of(viterbi.MODEL)
    for text, ids in zip(sample(), viterbi.encode(sample(), v)):
        chars = (" " + text).replace(" ", viterbi.BLANK)
        assert list(viterbi.stream(iter(chars), v)) == ids.tolist()
        assert list(viterbi.stream(iter([chars[:7], chars[7:]]), v)) == ids.tolist()


def test_literal_blank_sign():
    v = viterbi.Vocabulary.of(viterbi.MODEL)
    for text in ("▁", "a▁ b", " ▁▁ "):
        assert viterbi.decode(viterbi.encode([text], v)[0], v) == text


def test_stream_commits_early():
    """Ids come out while the text is still being read."""
    v = viterbi.Vocabulary.of(viterbi.MODEL)
    read = 0

    def chars():
        nonlocal read
        for ch in viterbi.BLANK.join(["the", "quick", "brown", "fox"] * 50):
            read += 1
            yield ch

    next(viterbi.stream(chars(), v))
    assert read < 60


def test_documents(spark, odd_docs):
    got = viterbi.encode_documents(odd_docs)
    rows = got.collect()
    assert len(rows) == odd_docs.count() and all(r["round_trip"] and r["n_ids"] == len(r["ids"]) for r in rows)
    back = sorted((r["doc_id"] or 0, r["text"]) for r in viterbi.decode_documents(got).collect())
    assert back == sorted((r["doc_id"] or 0, r["text"] or "") for r in odd_docs.collect())
    assert viterbi.encode_documents(odd_docs.limit(0)).count() == 0


def test_whole_table(spark):
    out = viterbi.op7(spark, "/root/testdata/sf0.001")
    assert out.count() == 200 and out.where("not round_trip").count() == 0
