import heapq
import random
import re
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from ledgerhawk.llm import glr

SPACES = " \t\n\x0b\x0c\r"
NAMES = {"u": "user", "a": "assistant"}


def digest(text):
    return sha256(text.encode()).hexdigest()


def broken(rows):
    """Rows of (conv, turn, role, text) damaged by the checksum."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            row = (conv, turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
            out += [row] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        end = text.rstrip(SPACES)[-1:]
        out.append("blank" if not end else "duplicate" if (role, text) in seen else "" if end in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, kinds):
    """Every way in order of (cost, audit), nothing merged, until one is legal."""
    todo = [(0, "", 0, ())]
    while todo:
        cost, audit, i, made = heapq.heappop(todo)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in made)):
            return cost, audit, made
        if cost + 5 <= 2 * len(rows):
            for n in NAMES.values():
                heapq.heappush(todo, (cost + 5, audit + "I", i, made + ((n, ""),)))
        if i < len(rows):
            _, _, role, text = rows[i]
            heapq.heappush(todo, (cost + 2, audit + "D", i + 1, made))
            if kinds[i] in ("", "truncated"):
                more = 5 if kinds[i] else 0
                heapq.heappush(todo, (cost + more, audit + "K", i + 1, made + ((role, text),)))
                for n in NAMES.values():
                    heapq.heappush(todo, (cost + more + 1, audit + "R", i + 1, made + ((n, text),)))


def plain(rows):
    out = []
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in broken(rows) if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], digest(r[3])))
        kinds, turns = faults(own), {r[1] for r in own} - {None}
        cost, audit, made = cheapest(own, kinds) if own else (0, "", ())
        initials = [r[2][:1] for r in own]
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                    digest("\n".join(f"{r}:{t}" for r, t in made))))
    return out


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def held(spark, rows, monkeypatch, more=lambda df: df):
    monkeypatch.setattr(glr, "table", lambda *_: more(spark.createDataFrame(rows, SCHEMA)))
    got = [tuple(r) for r in glr.op11(spark, "").select(*COLUMNS).collect()]
    assert sorted(map(str, got)) == sorted(map(str, plain(rows)))


def some(rng, convs, most):
    texts = ["Yes.", "No!", "So?", "and then", "", "  \n", "end. ", "…", " ", "a\nb."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "turns", "$", "uncle", None]
    return [(c, t, rng.choice(roles[:rng.choice((2, 5, 11))]), rng.choice(texts)) for c in range(convs) for t in range(rng.randrange(1, most))]


@pytest.mark.parametrize("chunk, fan", [(256, 64), (1, 2), (2, 2)])
def test_random_conversations(spark, monkeypatch, chunk, fan):
    monkeypatch.setattr(glr, "CHUNK", chunk)
    monkeypatch.setattr(glr, "FAN", fan)
    held(spark, some(random.Random(chunk), 150 if chunk == 256 else 60, 7), monkeypatch)


def test_odd_rows(spark, monkeypatch):
    rows = [(None, 1, "user", "a."), (None, None, None, None), (None, 2, "assistant", "b."), (1, None, "user", None), (1, None, "user", "x."),
            (2, 5, "user", "x."), (2, 5, "user", "x."), (2, 5, "assistant", "x."), (2, 9, None, "word " * 60_000), (3, 7, "", ""),
            (4, -5, "system", "s."), (4, 3, "user", "u."), (4, 3, "assistant", "a."), *[(c, 0, "user", "q?") for c in range(50, 90)]]
    held(spark, rows, monkeypatch, lambda df: df.withColumn("grp", F.lit("x")).withColumn("pos", F.lit(0)).withColumn("nth", F.lit(0)))


def test_empty_and_extreme_turns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert [df.collect() for df in glr.repair(empty)] == [[], []]
    wide = spark.createDataFrame([(1, -2 ** 63, "user", "a."), (1, 2 ** 63 - 1, "assistant", "b.")], SCHEMA)
    assert [(r["gaps"], r["audit"]) for r in glr.repair(wide)[0].collect()] == [(None, "KK")]


def test_one_conversation_over_many_chunks(spark, monkeypatch):
    """A long conversation in small chunks is repaired as it is in one."""
    rng = random.Random(5)
    rows = [(7, t, rng.choice(["user", "assistant"]), rng.choice(["Yes.", "No", f"turn {t}."])) for t in range(600)]
    turns = spark.createDataFrame(rows, SCHEMA)
    initials = [r[2][0] for r in rows]
    whole = glr.parse(list(zip(initials, [{"": 0, "blank": 1, "duplicate": 2, "truncated": 3}[k] for k in faults(rows)])), True)
    cost, audit = min(c[2:] for c in whole if glr.accepted(glr.STACKS[c[1]]))
    monkeypatch.setattr(glr, "CHUNK", 16)
    monkeypatch.setattr(glr, "FAN", 3)
    conversations, repaired = glr.repair(turns)
    row = conversations.first()
    assert (row["cost"], row["audit"]) == (cost, audit)
    made = repaired.orderBy("nth").collect()
    assert [r["nth"] for r in made] == list(range(len(made))) and re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in made))
    assert "".join(r["edit"] for r in made) == audit.replace("D", "")


def test_given_conversations(spark, monkeypatch):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    held(spark, rows, monkeypatch)
