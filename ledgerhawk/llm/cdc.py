"""Substring dedup by content-defined chunking.

A gear rolling hash over the last 16 bytes cuts a text wherever its low bits agree with
a fixed value, so an insertion moves only the cuts near it. Chunks are between ``least``
and ``most`` bytes; every chunk whose digest occurs in a document with a smaller doc_id,
or earlier in its own, is removed. A text's last chunk may be shorter than ``least``: such
an ending is removed only together with the chunk just before it, and a whole text of
that length only if another whole text equals it. A repeated passage is found without its ends: up to
one chunk before its first cut and after its last.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerhawk.llm.common import rows_of, stored, table

LEAST, MOST, BITS = 32, 256, 5          # about 64 bytes a chunk
PASS_BYTES = 1 << 20


def gear():
    import numpy as np
    return np.random.default_rng(19730917).integers(0, 1 << 16, 256, dtype=np.uint16)


def cut_points(data, bits: int = BITS):
    """Positions after which the gear hash allows a cut: its top bits are zero.

    The hash of 16 bits is the sum of the last 16 bytes' table values, each shifted by
    its age; doubling adds them up in four steps."""
    import numpy as np
    table_, out = gear(), []
    for at in range(0, len(data), PASS_BYTES):
        low = max(0, at - 15)
        h = table_[data[low:at + PASS_BYTES]]
        for step in (1, 2, 4, 8):
            older = np.zeros_like(h)
            older[step:] = h[:-step] << np.uint16(step) if len(h) > step else 0
            h = h + older
        hit = np.flatnonzero((h >> np.uint16(16 - bits)) == 0) + low
        out.append(hit[hit >= at] + 1)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def chunk_ends(data, least: int = LEAST, most: int = MOST, bits: int = BITS) -> list:
    """Ends of the chunks of one text; the last chunk may be short."""
    n, ends, start = len(data), [], 0
    for cut in cut_points(data, bits).tolist():
        while cut - start > most:
            start += most
            ends.append(start)
        if cut - start >= least:
            start = cut
            ends.append(start)
    while n - start > most:
        start += most
        ends.append(start)
    if n > start:
        ends.append(n)
    return ends


def chunks(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, print, start, end, high, low, first``: one row per chunk, and
    one with a null start for a text without bytes. ``high, low`` are the digest's halves,
    ``first`` says whether the chunk is the first of its digest in its row."""
    text = F.coalesce("text", F.lit(""))
    src = docs.select("doc_id", F.xxhash64(text).alias("print"), text.alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import hashlib

        import numpy as np
        import pyarrow as pa
        from ledgerhawk.llm.cdc import chunk_ends as ends_of
        for b in rows_of(batches, 256):
            row, start, end, raw, first, size = [], [], [], [], [], []
            for i, text in enumerate(b.column(2).to_pylist()):
                data = text.encode("utf-8", "surrogatepass")
                ends = ends_of(np.frombuffer(data, np.uint8))
                at, seen = 0, set()
                for e in ends or [None]:
                    kind_of = b"whole" if len(data) < LEAST else b""     # a short text is no other text's ending
                    d = hashlib.blake2b(data[at:e], digest_size=16, person=kind_of).digest() if e else bytes(16)
                    raw.append(d)
                    row.append(i)
                    start.append(at if e else None)
                    end.append(e)
                    first.append(d not in seen)
                    size.append(len(data))
                    seen.add(d)
                    at = e
            halves = np.frombuffer(b"".join(raw), np.int64).reshape(-1, 2)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(take), pa.array(size, pa.int64()), b.column(1).take(take), pa.array(start, pa.int32()),
                 pa.array(end, pa.int32()), pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(first)],
                ["doc_id", "n_bytes", "print", "start", "end", "high", "low", "first"])

    return src.mapInArrow(run, f"doc_id {kind}, n_bytes long, print long, start int, end int, high long, low long, first boolean")


def repeated_chunks(docs: DataFrame, endings: bool = True) -> DataFrame:
    """``doc_id, print, n_bytes, n_chunks, n_removed, removed_chunks, n_spans, spans``: per
    document the removed bytes as maximal runs ``start, end``; ``print`` is XXH64 of the text.
    Every known chunk counts, with ``endings`` also a short last chunk on its own; what is
    cut from texts is ``repeated_passages``.

    Rows equal in doc_id and text are one document. Documents that share a doc_id (or have
    none: the largest of all) do not remove each other's chunks. Null and empty texts have
    no chunks. An empty table gives an empty result; other columns are not read."""
    cut = stored(chunks(docs), "cdc")
    none = F.lit((1 << 63) - 1)
    owner = F.coalesce(F.col("doc_id").cast("long"), none)
    seen = cut.where("first and start is not null").select("high", "low", owner.alias("owner"))
    least = seen.groupBy("high", "low").agg(F.min("owner").alias("least"), F.max("owner").alias("most")) \
        .where("least < most").select("high", "low", "least")
    # a chunk goes if its digest is known from before, or stands earlier in its own text
    gone = cut.where("start is not null and not first").select("doc_id", "print", "start", "end") \
        .unionByName(cut.where("start is not null and first").join(least, ["high", "low"])
                     .where(owner > F.col("least")).select("doc_id", "print", "start", "end"))
    runs = gone.groupBy("doc_id", "print").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("parts"))
    # only a text's last chunk can be short; alone it is an ending, not a passage
    tail = F.element_at("parts", -1)
    lone = (tail["start"] > 0) & (tail["end"] - tail["start"] < LEAST) \
        & ~F.exists("parts", lambda x: x["end"] == tail["start"])
    if not endings:
        runs = runs.withColumn("parts", F.when(lone, F.slice("parts", 1, F.size("parts") - 1)).otherwise(F.col("parts")))
    empty = F.array().cast("array<struct<start:int,end:int>>")
    whole = cut.groupBy("doc_id", "print").agg(F.max("n_bytes").alias("n_bytes"),
                                               F.countDistinct("start").alias("n_chunks"))
    # adjoining chunks become one run; a list of a document's chunks is bounded by its text
    joined = F.aggregate(
        "parts", empty, lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] == x["start"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), x["end"].alias("end")))))
        .otherwise(F.concat(acc, F.array(F.struct(x["start"].alias("start"), x["end"].alias("end"))))))
    bytes_ = F.aggregate("parts", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return whole.join(runs, [whole["doc_id"].eqNullSafe(runs["doc_id"]), whole["print"] == runs["print"]], "left") \
        .select(whole["doc_id"], whole["print"], "n_bytes", "n_chunks", F.coalesce(bytes_, F.lit(0).cast("long")).alias("n_removed"),
                F.coalesce(F.size("parts"), F.lit(0)).cast("long").alias("removed_chunks"),
                F.coalesce(F.size(joined), F.lit(0)).cast("long").alias("n_spans"), F.coalesce(joined, empty).alias("spans"))


def repeated_passages(docs: DataFrame) -> DataFrame:
    """``repeated_chunks`` without endings: a last chunk under ``LEAST`` bytes goes only
    together with the chunk just before it."""
    return repeated_chunks(docs, endings=False)


def strip(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with the removed chunks cut out of every text (bytes that no longer
    form a character are dropped with them)."""
    found = repeated_passages(docs).select(F.col("doc_id").alias("_id"), "print", "spans")
    src = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    both = src.join(found, src["doc_id"].eqNullSafe(found["_id"]) & (F.xxhash64("text") == found["print"]), "left") \
        .select("doc_id", "text", "spans")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in rows_of(batches, 512):
            out = []
            for text, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                raw, at, keep = text.encode("utf-8", "surrogatepass"), 0, []
                for s in spans or ():
                    keep.append(raw[at:s["start"]])
                    at = s["end"]
                out.append(b"".join([*keep, raw[at:]]).decode("utf-8", "ignore"))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], ["doc_id", "text"])

    return both.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, text string")


def op8(spark, sf_dir: str) -> DataFrame:
    """Removed runs of every whole text of ``documents``."""
    out = repeated_passages(table(spark, sf_dir, "documents"))
    spans = F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string"))), ",")
    return out.drop("print").withColumn("spans", spans)
