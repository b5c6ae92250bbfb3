"""Conversation structure repair by a generalised LR parser with weighted edits.

Roles are parsed by their initials with the tables that ``Tables`` derives from ``GRAMMAR``. Where a row
allows several edits, all are followed at once on a graph-structured stack: a stack is a
cell of its top state and the stack below, cells are shared, and of the ways that lead to
equal stacks only the least (cost, audit) is kept. That loses nothing: the cost of a way
follows from its audit and the rows, so of two ways with one cost over the same rows neither
audit begins with the other, and what is least now stays least whatever follows.

The grammar is left-recursive, so only a few stacks are ever reached. Therefore a run of rows is a
table of (entry stack, final stack) with the least (cost, audit) each, and tables of
neighbours combine. Conversations are cut into chunks of ``CHUNK`` rows, chunks parsed one
by one and their tables combined ``FAN`` at a time, so that a conversation with a third of
all rows is parsed all over the cluster. What remains in one task for a conversation is what
the result has of it in one value: the audit, and the digest of its repaired rows, which is
read as a stream.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerhawk.llm.chat import _arrow as arrow_schema
from ledgerhawk.llm.chat import _groups as groups
from ledgerhawk.llm.chat import _written as written
from ledgerhawk.llm.common import rows_of, stored, table
from ledgerhawk.llm.ranked import ranked

# --- fixed values: role grammar by initials, costs of the edits, faults, legal neighbours
GRAMMAR = (("whole", ()), ("whole", ("turns",)), ("turns", ("s", "u", "a")), ("turns", ("u", "a")), ("turns", ("turns", "u", "a")))
ROLES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
SOUND, BLANK, DUPLICATE, CUT = range(4)
LEGAL = ("su", "ua", "au")
SPACES, STOPS = " \t\n\x0b\x0c\r", (".", "!", "?")
# ----------------------------------------------------------
CHUNK, FAN = 256, 64
END = "$"


class Tables:
    """LR item sets of a grammar, with one symbol of lookahead from the FOLLOW sets.

    An item is (production, dots passed); production -1 is the start symbol alone."""

    def __init__(self, grammar: tuple):
        self.grammar, self.start = grammar, grammar[0][0]
        self.heads = {h for h, _ in grammar}
        self.states = [self._closure({(-1, 0)})]
        self.goto: dict = {}
        for i, items in enumerate(self.states):             # grows while it is read
            for x in sorted({self._next(it) for it in items} - {None}):
                to = self._closure({(p, d + 1) for p, d in items if self._next((p, d)) == x})
                if to not in self.states:
                    self.states.append(to)
                self.goto[i, x] = self.states.index(to)
        self.follow = self._follow()

    def body(self, p: int) -> tuple:
        return (self.start,) if p < 0 else self.grammar[p][1]

    def _next(self, item: tuple):
        p, d = item
        return self.body(p)[d] if d < len(self.body(p)) else None

    def _closure(self, items: set) -> frozenset:
        while True:
            heads = {self._next(it) for it in items}
            more = items | {(p, 0) for p, (h, _) in enumerate(self.grammar) if h in heads}
            if more == items:
                return frozenset(items)
            items = more

    def _follow(self) -> dict:
        """FOLLOW sets; no production but the start symbol's may be empty."""
        first = {h: set() for h in self.heads}
        follow = {h: set() for h in self.heads}
        follow[self.start].add(END)
        for _ in range(len(self.grammar) ** 2 + 1):
            for h, b in self.grammar:
                if b:
                    first[h] |= first[b[0]] if b[0] in self.heads else {b[0]}
                for x, y in zip(b, b[1:]):
                    if x in self.heads:
                        follow[x] |= first[y] if y in self.heads else {y}
                if b and b[-1] in self.heads:
                    follow[b[-1]] |= follow[h]
        return follow


TABLES = Tables(GRAMMAR)
START = (0, None)                           # a stack: its top state, and the stack below


def _reduced(stack: tuple, ahead: str) -> set:
    """The stack, and those that reductions make of it before ``ahead``."""
    seen, todo = {stack}, [stack]
    while todo:
        top = todo.pop()
        for p, d in TABLES.states[top[0]]:
            if p >= 0 and d == len(TABLES.body(p)) and ahead in TABLES.follow[TABLES.grammar[p][0]]:
                below = top
                for _ in range(d):
                    below = below[1]
                made = (TABLES.goto[below[0], TABLES.grammar[p][0]], below)
                if made not in seen:
                    seen.add(made)
                    todo.append(made)
    return seen


@lru_cache(maxsize=None)
def shifted(stack: tuple, symbol: str) -> tuple:
    """Stacks after ``symbol``."""
    return tuple((TABLES.goto[s[0], symbol], s) for s in _reduced(stack, symbol) if (s[0], symbol) in TABLES.goto)


@lru_cache(maxsize=None)
def accepted(stack: tuple) -> bool:
    return any(TABLES.states[s[0]] == frozenset({(-1, 1)}) for s in _reduced(stack, END))


def _reachable() -> list:
    """All stacks a way can have: finitely many, since recursion is on the left alone."""
    out = [START]
    for s in out:                                           # grows while it is read
        out += [t for x in ("s", *ROLES) for t in shifted(s, x) if t not in out]
    return out


STACKS = _reachable()
NUMBER = {s: i for i, s in enumerate(STACKS)}


def _put(tops: dict, stack: tuple, way: tuple) -> bool:
    if stack not in tops or way < tops[stack]:
        tops[stack] = way
        return True
    return False


def _inserted(tops: dict) -> dict:
    """``tops`` and what insertions make of them."""
    todo = list(tops)
    while todo:
        s = todo.pop()
        cost, audit = tops[s]
        todo += [t for x in ROLES for t in shifted(s, x) if _put(tops, t, (cost + INSERT, audit + "I"))]
    return tops


def advance(tops: dict, initial: str, fault: int) -> dict:
    """All ways one row further."""
    out: dict = {}
    extra = TRUNCATED if fault == CUT else 0
    for s, (cost, audit) in tops.items():
        _put(out, s, (cost + DELETE, audit + "D"))
        if fault not in (BLANK, DUPLICATE):
            for t in shifted(s, initial):
                _put(out, t, (cost + KEEP + extra, audit + "K"))
            for x in ROLES:
                for t in shifted(s, x):
                    _put(out, t, (cost + REROLE + extra, audit + "R"))
    return _inserted(out)


def parse(rows: list, first: bool) -> list:
    """Table of a run of (initial, fault): (entry, leave, cost, audit). A conversation's
    first run is entered with the empty stack, with insertions ahead of it."""
    cells = []
    for entry in [START] if first else STACKS:
        tops = _inserted({entry: (0, "")}) if first else {entry: (0, "")}
        for initial, fault in rows:
            tops = advance(tops, initial, fault)
        cells += [(NUMBER[entry], NUMBER[s], *way) for s, way in sorted(tops.items(), key=lambda x: NUMBER[x[0]])]
    return cells


def joined(left: list, right: list) -> list:
    """Table of two runs, one after the other."""
    after: dict = {}
    for entry, leave, cost, audit in right:
        after.setdefault(entry, []).append((leave, cost, audit))
    best: dict = {}
    for entry, middle, cost, audit in left:
        for leave, more, rest in after.get(middle, ()):
            _put(best, (entry, leave), (cost + more, audit + rest))
    return [(*k, *v) for k, v in sorted(best.items())]


def folded(parts: list) -> list:
    """Table of many runs, by halves."""
    while len(parts) > 1:
        parts = [joined(*parts[i:i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def illegal(initials: list) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


def row_edits(audit: str) -> list:
    """What an audit does at each row: (position, insertions before it, edit, insertions
    after it, place of the first turn that comes out, whether a system turn leads)."""
    odd = (len(audit) - audit.count("D")) % 2
    out, before, place = [], 0, 0
    for edit in audit:
        if edit == "I":
            before += 1
            continue
        out.append([len(out), before, edit, 0, place, odd])
        place, before = place + before + (edit != "D"), 0
    if out:
        out[-1][3] = before
    return out


# ------------------------------------------------------------------ Spark
def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults put in by the checksum of ``conv_id:turn``:
    rows dropped, emptied, without stops, repeated, or given to the user. Null is a space."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).where("kind != 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", "".join(STOPS), "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def _key(conv: Column) -> Column:
    """A conversation's name without null: null to "", any other behind a mark."""
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit(""))


CELL = "array<struct<entry:int,leave:int,cost:long,audit:string>>"
TABLE = f"grp string, nth long, n_blank long, n_duplicate long, n_truncated long, n_illegal long, head string, tail string, cell {CELL}"


def _cells(value: list) -> list:
    return [(c["entry"], c["leave"], c["cost"], c["audit"]) for c in value]


def _as_structs(cells: list) -> list:
    return [dict(zip(("entry", "leave", "cost", "audit"), c)) for c in cells]


def _tables(codes: DataFrame) -> DataFrame:
    """One table a conversation from ``grp, pos, initial, fault``."""

    def chunks(batches: Iterator) -> Iterator:
        from ledgerhawk.llm import glr

        def rows() -> Iterator:
            for (grp, chunk), own in groups(batches, 2):
                faults = [r[2] for r in own]
                yield (grp, chunk, *(faults.count(k) for k in (glr.BLANK, glr.DUPLICATE, glr.CUT)), glr.illegal([r[1] for r in own]),
                       own[0][1], own[-1][1], glr._as_structs(glr.parse([r[1:3] for r in own], chunk == 0)))

        yield from written(rows(), schema)

    def neighbours(batches: Iterator) -> Iterator:
        from ledgerhawk.llm import glr

        def rows() -> Iterator:
            for (grp, chunk), own in groups(batches, 2):
                counts = [sum(r[k] for r in own) for k in range(1, 5)]
                counts[3] += sum(glr.illegal([a[6], b[5]]) for a, b in zip(own, own[1:]))
                yield grp, chunk, *counts, own[0][5], own[-1][6], glr._as_structs(glr.folded([glr._cells(r[7]) for r in own]))

        yield from written(rows(), schema)

    def arranged(df: DataFrame, size: int, at: str) -> DataFrame:
        cols = [c for c in df.columns if c not in ("grp", at)]
        part = df.select("grp", F.floor(F.col(at) / size).cast("long").alias("chunk"), F.col(at).alias("at"), *cols)
        return part.repartition("grp", "chunk").sortWithinPartitions("grp", "chunk", "at")

    schema = arrow_schema(codes, TABLE)
    level = stored(arranged(codes, CHUNK, "pos").mapInArrow(chunks, TABLE), "glr-chunks")
    while level.where("nth > 0").head(1):
        level = stored(arranged(level, FAN, "nth").mapInArrow(neighbours, TABLE), "glr-up")
    return level


EDITS = "grp string, pos long, before int, edit string, after int, place long, odd int"


def _edits(audits: DataFrame) -> DataFrame:
    """EDITS of ``grp, audit``, a row for each row of the conversations."""

    def run(batches: Iterator) -> Iterator:
        from ledgerhawk.llm import glr

        def rows() -> Iterator:
            for b in rows_of(batches, 64):
                for grp, audit in zip(*(c.to_pylist() for c in b.columns)):
                    for e in glr.row_edits(audit):
                        yield grp, *e

        yield from written(rows(), schema, 4096)

    schema = arrow_schema(audits, EDITS)
    return audits.mapInArrow(run, EDITS)


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations, and their repaired turns, of ``conv_id, turn, role, text``.

    Conversations: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``.
    Repaired turns: ``conv_id, nth, role, text, edit``, ``nth`` from 0 in each
    conversation, edits as in the audit.

    Rows are in order of turn (null first); those of one turn in order of role and of the
    text's SHA-256, repeated rows next to each other. Null roles and texts are one space,
    null conversation ids are one conversation, which may be of any length. A gap count
    beyond a long is null. Other columns are not read; an empty table gives empty results."""
    blank = F.lit(" ")
    src = turns.select(_key(F.col("conv_id")).alias("grp"), "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", blank).alias("role"),
                       F.coalesce("text", blank).alias("text")).withColumn("print", F.sha2(F.col("text").cast("binary"), 256))
    placed = ranked(src, "grp", ["turn", "role", "print"], "glr-rows")
    first = placed.groupBy("grp", "role", "print").agg(F.min("pos").alias("pos")).select("grp", "pos", F.lit(True).alias("first"))
    end = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    codes = placed.select("grp", "pos", F.substring("role", 1, 1).alias("initial"), end.alias("end")).join(first, ["grp", "pos"], "left") \
        .select("grp", "pos", "initial", F.when(F.col("end") == "", BLANK).when(F.col("first").isNull(), DUPLICATE)
                .when(~F.col("end").isin(*STOPS), CUT).otherwise(SOUND).alias("fault"))
    whole = _tables(codes)
    ways = F.filter("cell", lambda c: c["leave"].isin(*[NUMBER[s] for s in STACKS if accepted(s)]))
    best = F.array_min(F.transform(ways, lambda c: F.struct(c["cost"].alias("cost"), c["audit"].alias("audit"))))
    solved = stored(whole.select("grp", "n_blank", "n_duplicate", "n_truncated", "n_illegal", best.alias("best")), "glr-solved")
    gaps = placed.groupBy("grp").agg(F.first("conv_id").alias("conv_id"), F.min("turn").alias("low"), F.max("turn").alias("high"),
                                     F.countDistinct("turn").alias("turns"))
    width = F.coalesce(F.try_subtract("high", "low"), F.when(F.col("low").isNull(), F.lit(-1)))
    conversations = gaps.join(solved, "grp").select(
        "conv_id", F.try_subtract(F.try_add(width, F.lit(1)), F.col("turns")).alias("gaps"), F.col("n_blank").alias("blank"),
        F.col("n_duplicate").alias("duplicate"), F.col("n_truncated").alias("truncated"), F.col("n_illegal").alias("illegal"),
        F.col("best.cost").alias("cost"), F.col("best.audit").alias("audit"))

    kept = (F.col("edit") != "D").cast("int")
    many = F.col("before") + kept + F.col("after")
    nth = F.col("place") + F.col("k")
    own = (F.col("k") == F.col("before")) & (F.col("edit") != "D")
    made = F.when((nth - F.col("odd")) % 2 == 0, ROLES["u"]).otherwise(ROLES["a"])
    repaired = placed.select("grp", "pos", "conv_id", "role", "text").join(_edits(solved.select("grp", "best.audit")), ["grp", "pos"]) \
        .withColumn("k", F.explode(F.when(many > 0, F.sequence(F.lit(0), many - 1)).otherwise(F.array().cast("array<int>")))) \
        .select("conv_id", nth.alias("nth"), F.when(own & (F.col("edit") == "K"), F.col("role")).otherwise(made).alias("role"),
                F.when(own, F.col("text")).otherwise("").alias("text"), F.when(own, F.col("edit")).otherwise("I").alias("edit"))
    return conversations, repaired


def digests(repaired: DataFrame) -> DataFrame:
    """``grp, repaired_sha256`` of every conversation with repaired turns, whose
    ``role:text`` lines are hashed as a stream, in order and joined by line ends."""

    def run(batches: Iterator) -> Iterator:
        def rows() -> Iterator:
            now, state = None, None
            for b in rows_of(batches, 1024):
                for grp, role, text in zip(*(c.to_pylist() for c in b.columns)):
                    if grp == now:
                        state.update(b"\n")
                    else:
                        if state:
                            yield now, state.hexdigest()
                        now, state = grp, sha256()
                    state.update(f"{role}:{text}".encode())
            if state:
                yield now, state.hexdigest()

        yield from written(rows(), schema)

    out = "grp string, repaired_sha256 string"
    schema = arrow_schema(repaired, out)
    lines = repaired.select(_key(F.col("conv_id")).alias("grp"), "nth", "role", "text")
    return lines.repartition("grp").sortWithinPartitions("grp", "nth").select("grp", "role", "text").mapInArrow(run, out)


def op11(spark, sf_dir: str) -> DataFrame:
    """Every conversation damaged and repaired."""
    turns = table(spark, sf_dir, "conversations")
    conversations, repaired = repair(damaged(turns))
    counts = [c for c in conversations.columns if c not in ("conv_id", "audit")]
    return turns.select("conv_id").distinct().withColumn("grp", _key(F.col("conv_id"))) \
        .join(conversations.withColumn("grp", _key(F.col("conv_id"))).drop("conv_id"), "grp", "left").join(digests(repaired), "grp", "left") \
        .select("conv_id", *[F.when(F.col("audit").isNull(), F.lit(0).cast("long")).otherwise(F.col(c)).alias(c) for c in counts],
                F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def _sql_moves() -> str:
    """(from, symbol, to, roles that come out after it) of the four states that any stack
    stands for: nothing yet, system, user, complete; with the insertions of most use."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    more = [(0, 0, ""), (0, 2, "u"), (0, 3, "ua"), (1, 1, ""), (1, 2, "u"), (1, 3, "ua"), (2, 2, ""), (2, 3, "a"), (3, 3, ""), (3, 2, "u")]
    rows = [(q, x, to, ins) for (q, x), mid in step.items() for at, to, ins in more if at == mid] + [(q, "", to, ins) for q, to, ins in more]
    return ", ".join(f"({q}, '{x}', {to}, {len(ins)}, '{'I' * len(ins)}', {_sql_lines(ins)})" for q, x, to, ins in rows)


def _sql_lines(roles: str) -> str:
    return " || ".join(["''", *[f"chr(10) || '{ROLES[x]}:'" for x in roles]])


#: Rows are stepped together, a state a row and its least (cost, audit); what comes out rides along.
ORACLE = f"""WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295, list_reduce(list_prepend(4294967295,
      list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, c: list_reduce([xor(crc, c), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))) % 20 AS kind FROM conversations),
broken AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN replace(replace(replace(text, '.', ''), '!', ''), '?', '') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM src WHERE kind <> 0),
named AS (SELECT coalesce('=' || conv_id, '') AS grp, turn, role, text,
    right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos FROM broken),
seen AS (SELECT *, row_number() OVER (PARTITION BY grp, role, text ORDER BY pos) AS nth, left(role, 1) AS initial FROM named),
placed AS (SELECT *, CASE WHEN last = '' THEN {BLANK} WHEN nth > 1 THEN {DUPLICATE} WHEN last NOT IN ('.', '!', '?') THEN {CUT} ELSE {SOUND} END AS fault,
    lag(initial) OVER (PARTITION BY grp ORDER BY pos) || initial AS pair FROM seen),
move(q, x, p, n, letters, lines) AS (VALUES {_sql_moves()}),
edit AS (
  SELECT grp, pos, '' AS x, {DELETE} AS cost, 'D' AS letter, '' AS line FROM placed
  UNION ALL SELECT grp, pos, initial, {KEEP} + CASE WHEN fault = {CUT} THEN {TRUNCATED} ELSE 0 END, 'K', chr(10) || role || ':' || text
  FROM placed WHERE fault NOT IN ({BLANK}, {DUPLICATE}) AND initial <> ''
  UNION ALL SELECT grp, pos, r.x, {REROLE} + CASE WHEN fault = {CUT} THEN {TRUNCATED} ELSE 0 END, 'R', chr(10) || r.name || ':' || text
  FROM placed, (VALUES ('u', 'user'), ('a', 'assistant')) r(x, name) WHERE fault NOT IN ({BLANK}, {DUPLICATE})),
way AS (
  SELECT grp, 0 AS pos, p AS q, {{'cost': {INSERT} * n, 'audit': letters, 'out': lines}} AS best
  FROM (SELECT DISTINCT grp FROM placed) g, move WHERE q = 0 AND x = ''
  UNION ALL
  SELECT w.grp, w.pos + 1, m.p, min({{'cost': w.best.cost + e.cost + {INSERT} * m.n, 'audit': w.best.audit || e.letter || m.letters, 'out': w.best.out || e.line || m.lines}})
  FROM way w JOIN edit e ON w.grp = e.grp AND e.pos = w.pos + 1 JOIN move m ON m.q = w.q AND m.x = e.x
  GROUP BY w.grp, w.pos, m.p),
solved AS (SELECT w.grp, min(best) AS best FROM way w JOIN (SELECT grp, max(pos) AS n FROM placed GROUP BY grp) c ON w.grp = c.grp AND w.pos = c.n
           WHERE q IN (0, 3) GROUP BY w.grp),
counted AS (SELECT grp, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = {BLANK}) AS blank,
    count(*) FILTER (fault = {DUPLICATE}) AS duplicate, count(*) FILTER (fault = {CUT}) AS truncated,
    count(*) FILTER (pair NOT IN ({", ".join(f"'{x}'" for x in LEGAL)})) AS illegal FROM placed GROUP BY grp)
SELECT c.conv_id, coalesce(n.gaps, 0) AS gaps, coalesce(n.blank, 0) AS blank, coalesce(n.duplicate, 0) AS duplicate, coalesce(n.truncated, 0) AS truncated,
  coalesce(n.illegal, 0) AS illegal, CAST(coalesce(s.best.cost, 0) AS BIGINT) AS cost, coalesce(s.best.audit, '') AS audit, sha256(coalesce(s.best.out[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce('=' || conv_id, '') AS grp FROM conversations) c LEFT JOIN counted n ON c.grp = n.grp LEFT JOIN solved s ON c.grp = s.grp"""
