"""Role repair against exhaustive search, and chunked against whole solutions."""

import itertools
import random

import pytest

from ledgerhawk.llm import chat

NAMES = {0: "tool", 1: "system", 2: "user", 3: "assistant"}


def cheapest(codes):
    """Least cost over every assignment of an action to every turn."""
    best = None
    for targets in itertools.product((0, 1, 2, 3), repeat=len(codes)):      # 0: merge
        q, cost = chat.START, 0
        for code, to in zip(codes, targets):
            if to == 0:
                if q == chat.START:
                    break
                cost += chat.MERGE if code == q else chat.MERGE_OTHER if code else chat.MERGE_UNKNOWN
            else:
                if chat.GAP[q][to] is None:
                    break
                cost += chat.INSERT * len(chat.GAP[q][to]) + (0 if code == to else chat.RELABEL if code else chat.NAME_UNKNOWN)
                q = to
        else:
            cost += chat.INSERT * len(chat.TAIL[q])
            best = cost if best is None else min(best, cost)
    return best


def whole(codes):
    states = chat.settle([chat.TURN[c] for c in codes], chat.START, None)
    return sum(chat.step(c, a, b)[0] for c, a, b in zip(codes, states, states[1:])) + chat.INSERT * len(chat.TAIL[states[-1]])


def test_cost_is_least():
    for n in range(1, 5):
        for codes in itertools.product(range(4), repeat=n):
            assert whole(codes) == cheapest(codes), codes


def legal(text):
    roles = [s.split("\n")[0] for s in text.split(chat.OPEN)[1:]]
    turns = roles[1:] if roles[:1] == ["system"] else roles
    return turns == ["user", "assistant"] * (len(turns) // 2) and text.count(chat.OPEN) == text.count(chat.CLOSE)


def rendered(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["conv_id"] is None, r["conv_id"] or 0, r["part"])):
        cost, n, text = out.get(r["conv_id"], (0, 0, ""))
        out[r["conv_id"]] = (cost + r["cost"], n + r["n_in"], text + r["text"])
    return out


@pytest.mark.parametrize("size", [3, 256])
def test_chunks_equal_whole(spark, monkeypatch, size):
    monkeypatch.setattr(chat, "CHUNK", size)
    rng = random.Random(5)
    convs = {i: [rng.choice((0, 1, 2, 2, 3, 3)) for _ in range(rng.randint(1, 40))] for i in range(30)}
    rows = [(i, t, NAMES[c], f"t{t} <|x|>") for i, cs in convs.items() for t, c in enumerate(cs)]
    rng.shuffle(rows)
    got = rendered(chat.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)).collect())
    for i, codes in convs.items():
        assert got[i][0] == whole(codes) and got[i][1] == len(codes)
        assert legal(got[i][2]) and "<|x|>" not in got[i][2]
        order = [got[i][2].find(f"t{t} <") for t in range(len(codes))]
        assert order == sorted(order) and -1 not in order


def test_edges(spark):
    rows = [(None, 0, "user", "a"), (None, 1, None, None), (1, None, " Human ", "x"), (1, 0, "GPT", ""), (1, 0, "GPT", ""),
            (2, 5, "system", "only")]
    df = spark.createDataFrame([(*r, 7, "k") for r in rows], "conv_id long, turn long, role string, text string, pos long, chunk string")
    got = rendered(chat.repair(df).collect())
    assert set(got) == {None, 1, 2} and all(legal(t) for _, _, t in got.values())
    assert got[1][1] == 3 and got[2][0] == 2 * chat.INSERT
    assert chat.repair(df.limit(0)).count() == 0
