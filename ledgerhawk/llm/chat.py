"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant in turn, ending
with the assistant. Every stored turn is emitted under its role, emitted under another
role, or merged into the turn before it, and empty turns may be put in; a dynamic
programme over the automaton's states finds the cheapest way.

A turn is a matrix of costs between states, and a run of turns is the min-plus product
of theirs, so a conversation of any length is solved in chunks of ``CHUNK`` turns: chunks
are multiplied, ``CHUNK`` products at a time, up to one per conversation; the states at
the boundaries are then settled from the top down, and every chunk is repaired and
rendered on its own. Equal costs go to the lowest state, traced from the end of a chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerhawk.llm.common import rows_of, stored, table

CHUNK = 256
# --- fixed values: states, roles as they are written, costs
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
ALIASES = {"system": ("system", "developer"), "user": ("user", "human", "prompter"), "assistant": ("assistant", "gpt", "bot", "model")}
MERGE, MERGE_UNKNOWN, MERGE_OTHER = 1, 2, 6
RELABEL, NAME_UNKNOWN, INSERT = 4, 2, 3
#: empty turns needed between a state and an emitted role; None where no insertion helps
GAP = {
    START: (None, (), (), (USER,)),
    SYSTEM: (None, None, (), (USER,)),
    USER: (None, None, (ASSISTANT,), ()),
    ASSISTANT: (None, None, (), (USER,)),
}
#: empty turns that complete a conversation
TAIL = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
# ----------------------------------------------------------
NEVER = 1 << 40
IDENTITY = tuple(tuple(0 if i == j else NEVER for j in range(4)) for i in range(4))


def role_code(role: Column) -> Column:
    """Number of a role, 0 for null and unknown ones; case and blanks around do not count."""
    name = F.lower(F.trim(role))
    out = None
    for i, r in enumerate(ROLES[1:], 1):
        hit = name.isin(*ALIASES[r])
        out = F.when(hit, i) if out is None else out.when(hit, i)
    return out.otherwise(0)


def step(role: int, q: int, to: int) -> tuple:
    """Least cost from state ``q`` to state ``to`` over one turn, and whether it merges."""
    emit = merge = NEVER
    if to != START and GAP[q][to] is not None:
        emit = INSERT * len(GAP[q][to]) + (0 if role == to else RELABEL if role else NAME_UNKNOWN)
    if q == to != START:
        merge = MERGE if role == q else MERGE_OTHER if role else MERGE_UNKNOWN
    return (merge, True) if merge <= emit and merge < NEVER else (emit, False)


TURN = tuple(tuple(tuple(step(r, q, t)[0] for t in range(4)) for q in range(4)) for r in range(4))


def times(a: tuple, b: tuple) -> tuple:
    """Min-plus product."""
    return tuple(tuple(min(min(a[i][k] + b[k][j] for k in range(4)), NEVER) for j in range(4)) for i in range(4))


def product(parts: list) -> tuple:
    out = IDENTITY
    for p in parts:
        out = times(out, p)
    return out


def settle(parts: list, entry: int, leave: int | None) -> list:
    """States at all boundaries of a run: the cheapest way from ``entry`` to ``leave``
    (to the cheapest completed end if None), the lowest state first where costs tie."""
    costs = [[0 if q == entry else NEVER for q in range(4)]]
    for p in parts:
        v = costs[-1]
        costs.append([min(min(v[k] + p[k][j] for k in range(4)), NEVER) for j in range(4)])
    if leave is None:
        done = [c + INSERT * len(TAIL[q]) for q, c in enumerate(costs[-1])]
        leave = done.index(min(done))
    states = [leave]
    for p, v in zip(reversed(parts), reversed(costs[:-1])):
        here = [v[k] + p[k][states[-1]] for k in range(4)]
        states.append(here.index(min(here)))
    return states[::-1]


def escape(text: str) -> str:
    """Text with the marker of control tokens broken up."""
    return text.replace("<|", "< |")


def fragment(role: int, q: int, to: int, text: str, last: bool) -> tuple:
    """What one turn adds to the rendered conversation, and its counts: cost, emitted
    turns, merges, relabels, inserted turns. A turn is closed by what comes after it."""
    cost, merged = step(role, q, to)
    tail = TAIL[to] if last else ()
    made = () if merged else GAP[q][to]
    out = []
    if merged:
        out.append("\n" + escape(text))
    else:
        out.append(CLOSE if q != START else "")
        out += [f"{OPEN}{ROLES[r]}\n{CLOSE}" for r in made]
        out.append(f"{OPEN}{ROLES[to]}\n{escape(text)}")
    if last:
        out.append(CLOSE)
        out += [f"{OPEN}{ROLES[r]}\n{CLOSE}" for r in tail]
    inserted = len(made) + len(tail)
    return ("".join(out), cost + INSERT * len(tail), (not merged) + inserted, int(merged),
            int(not merged and role != to), inserted)


def numbered(turns: DataFrame) -> DataFrame:
    """``conv_id, pos, code, text``: every row with its place in its conversation, by turn
    (null first), role and text. Rows are ranged over partitions by that order, so a
    conversation may cover many; only the counts of the pieces meet."""
    src = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), role_code(F.col("role")).alias("code"),
                       F.coalesce("text", F.lit("")).alias("text")) \
        .withColumns({"print": F.xxhash64("text"), "task": F.spark_partition_id()})
    keys = ["conv_id", "turn", "code", "print", "task"]
    kind = src.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext
        piece, last, n = TaskContext.get().partitionId(), object(), 0
        for b in batches:
            place = []
            for c in b.column(0).to_pylist():
                n = n + 1 if c == last else 0
                last = c
                place.append(n)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array([piece] * len(place), pa.int32()),
                                              pa.array(place, pa.int64())], ["conv_id", "code", "text", "piece", "place"])

    width = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = stored(src.repartitionByRange(width, *keys).sortWithinPartitions(*keys).select("conv_id", "code", "text")
                  .mapInArrow(run, f"conv_id {kind}, code int, text string, piece int, place long"), "chat-rows")
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("conv_id", "piece").agg(F.count(F.lit(1)).alias("n"))
    moved = sizes.withColumn("ahead", F.sum("n").over(before)).where("ahead > 0") \
        .select(F.col("conv_id").alias("id"), F.col("piece").alias("at"), "ahead")
    # a piece continues at most one conversation: no more rows here than partitions
    both = rows.join(F.broadcast(moved), (F.col("piece") == F.col("at")) & F.col("conv_id").eqNullSafe(F.col("id")), "left")
    return both.select("conv_id", (F.col("place") + F.coalesce("ahead", F.lit(0))).alias("pos"), "code", "text")


MATRIX = "array<array<long>>"


def _groups(batches: Iterator, width: int) -> Iterator:
    """Runs of rows that agree in the first ``width`` columns (the partition is sorted)."""
    now, held = None, []
    for b in rows_of(batches, 1024):
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if held and row[:width] != now:
                yield now, held
                held = []
            now = row[:width]
            held.append(row[width:])
    if held:
        yield now, held


def _arrow(df: DataFrame, schema: str):
    """A DDL schema for Arrow."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(schema))


def _written(rows: Iterator, schema, size: int = 256) -> Iterator:
    """Tuples as Arrow batches of at most ``size`` rows."""
    from itertools import batched

    import pyarrow as pa
    for part in batched(rows, size):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)


def _arranged(df: DataFrame, keys: list, order: str) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys, order)


def _products(parts: DataFrame, kind: str) -> DataFrame:
    """``conv_id, chunk, cell, last`` rows to one product per chunk: ``conv_id, nth, cell``."""

    def run(batches: Iterator) -> Iterator:
        from ledgerhawk.llm import chat

        def rows() -> Iterator:
            for (conv, chunk), own in chat._groups(batches, 2):
                yield conv, chunk, chat.product([chat.TURN[c] if isinstance(c, int) else c for _, c in own])

        yield from chat._written(rows(), schema)

    out = f"conv_id {kind}, nth long, cell {MATRIX}"
    schema = _arrow(parts, out)
    return _arranged(parts, ["conv_id", "chunk"], "nth").mapInArrow(run, out)


def boundaries(turns: DataFrame) -> DataFrame:
    """``conv_id, nth, entry, leave`` of every chunk of ``conv_id, pos, code``; ``leave`` is
    null in a conversation's last chunk."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    levels = [stored(_products(turns.select("conv_id", F.floor(F.col("pos") / CHUNK).alias("chunk"),
                                            F.col("pos").alias("nth"), F.col("code").alias("cell")), kind), "chat-up")]
    while (levels[-1].agg(F.max("nth")).first()[0] or 0) >= CHUNK:
        up = levels[-1].select("conv_id", F.floor(F.col("nth") / CHUNK).alias("chunk"), "nth", "cell")
        levels.append(stored(_products(up, kind), "chat-up"))
    known = levels[-1].select("conv_id", "nth").groupBy("conv_id").agg(F.max("nth").alias("top"))
    known = known.select("conv_id", F.lit(0).cast("long").alias("chunk"), F.lit(START).alias("entry"), F.lit(None).cast("int").alias("leave"))

    def run(batches: Iterator) -> Iterator:
        from ledgerhawk.llm import chat

        def rows() -> Iterator:
            for (conv, _), own in chat._groups(batches, 2):
                states = chat.settle([r[1] for r in own], own[0][2], own[0][3])
                for r, entry, leave in zip(own, states, states[1:-1] + [own[0][3]]):
                    yield conv, r[0], entry, leave

        yield from chat._written(rows(), schema)

    out = f"conv_id {kind}, nth long, entry int, leave int"
    schema = _arrow(turns, out)
    for level in reversed(levels):
        cells = level.select("conv_id", F.floor(F.col("nth") / CHUNK).alias("chunk"), "nth", "cell")
        both = _same(cells, known, "chunk").select("conv_id", "chunk", "nth", "cell", "entry", "leave")
        known = stored(_arranged(both, ["conv_id", "chunk"], "nth").mapInArrow(run, out), "chat-down") \
            .withColumnRenamed("nth", "chunk")
    return known


def _same(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Join on conversation (null is one) and ``key``."""
    k = known.select(F.col("conv_id").alias("k_conv"), F.col(key).alias("k_key"), "entry", "leave")
    return rows.join(k, rows["conv_id"].eqNullSafe(k["k_conv"]) & (rows[key] == k["k_key"])).drop("k_conv", "k_key")


PART = "part long, n_in long, n_out long, cost long, n_merged long, n_relabelled long, n_inserted long, text string"


def repair(turns: DataFrame) -> DataFrame:
    """``conv_id`` and PART: one row per conversation and ``CHUNK`` turns of it, nearly
    always one; the texts of its parts one after another are the rendered conversation.

    Null roles are unknown ones, null texts empty; null conversation ids are one
    conversation; equal turn numbers are ordered by role and text, repeated rows are
    separate turns. Other columns are not read; an empty table gives an empty result."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    rows = numbered(turns).withColumn("chunk", F.floor(F.col("pos") / CHUNK))
    both = _same(rows, boundaries(rows.select("conv_id", "pos", "code")), "chunk") \
        .select("conv_id", "chunk", "pos", "code", "text", "entry", "leave")

    def run(batches: Iterator) -> Iterator:
        from ledgerhawk.llm import chat

        def parts() -> Iterator:
            for (conv, chunk), own in chat._groups(batches, 2):
                codes, leave = [r[1] for r in own], own[0][4]
                states = chat.settle([chat.TURN[c] for c in codes], own[0][3], leave)
                done = [chat.fragment(c, a, b, r[2], leave is None and i == len(own) - 1)
                        for i, (c, a, b, r) in enumerate(zip(codes, states, states[1:], own))]
                texts, *counts = zip(*done)
                cost, n_out, merged, named, inserted = map(sum, counts)
                yield conv, chunk, len(own), n_out, cost, merged, named, inserted, "".join(texts)

        yield from chat._written(parts(), schema)

    out = f"conv_id {kind}, {PART}"
    schema = _arrow(turns, out)
    return _arranged(both, ["conv_id", "chunk"], "pos").mapInArrow(run, out)


def op1(spark, sf_dir: str) -> DataFrame:
    """Every conversation repaired and rendered."""
    return repair(table(spark, sf_dir, "conversations"))
