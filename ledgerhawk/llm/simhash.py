"""SimHash near-dedup with bit-sliced comparison.

A fingerprint is the bitwise majority of the XXH64 hashes of a document's word
shingles. Two fingerprints within ``radius`` bits agree on at least two of
``radius + 2`` blocks, so every link shows up in a bucket of one of the block
pairs. Inside the buckets the fingerprints' bit planes are stored vertically: one
machine word holds one bit of 64 fingerprints, the distances of 64 pairs are
updated at once by carry-save adders, and a block of lanes is abandoned as soon
as every lane has passed the radius.

Buckets hold distinct fingerprints only, so exact copies cost nothing. A bucket
above ``bucket_rows`` is keyed again by a further block of its remaining bits (the
same pigeonhole argument), until it is small; nothing is capped or sampled.
Links leave a bucket as a spanning forest, never as all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerhawk.llm.common import id_and_text, rows_of, stored, table
from ledgerhawk.llm.components import components

BUCKET_ROWS = 65536


def fingerprint(text: str, shingle: int = 3) -> int:
    """Majority of the shingle hashes of one whole text, as an unsigned 64-bit number.

    Words are runs of non-blank ASCII after lower-casing A-Z; fewer words than a
    shingle make one shingle, no words make fingerprint zero."""
    import numpy as np
    import xxhash
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    h64 = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return h64(b" ".join(words), 42)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - shingle + 1
    del words
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        to = min(n, at + (1 << 16))
        hashes = np.array([h64(joined[a:b], 42) for a, b in
                           zip(starts[at:to].tolist(), ends[at + shingle - 1:to + shingle - 1].tolist())], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def signatures(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``(doc_id, fp)`` of every row; ``fp`` is the fingerprint as a signed long."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from ledgerhawk.llm.simhash import fingerprint as of
        for b in rows_of(batches):
            fps = np.array([of(t, shingle) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    src = id_and_text(docs)
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, fp long")


def _ranges(bits: list[int], parts: int) -> list[list[int]]:
    return [bits[len(bits) * i // parts:len(bits) * (i + 1) // parts] for i in range(parts)]


def _mask(bits: list[int]) -> int:
    m = sum(1 << b for b in bits)
    return m - (1 << 64) if m >> 63 else m


def _bits(mask: int) -> list[int]:
    return [b for b in range(64) if mask >> b & 1]


def first_masks(radius: int) -> list[int]:
    """Bit masks of the block pairs: fingerprints within ``radius`` agree on one of them."""
    return [_mask(x + y) for x, y in combinations(_ranges(list(range(64)), radius + 2), 2)]


def next_masks(mask: int, radius: int) -> list[int]:
    """The mask with each of ``radius + 1`` blocks of its remaining bits added."""
    rest = [b for b in range(64) if not mask >> b & 1]
    return [_mask(_bits(mask) + part) for part in _ranges(rest, radius + 1)]


def sliced_links(fps, mask: int, starts, sizes, radius: int):
    """Spanning forest of the links within buckets of one mask.

    ``fps`` are unsigned fingerprints ordered by bucket; ``starts``/``sizes`` give the
    buckets. Returns the row that stands for each row (itself if nothing links lower)."""
    import numpy as np
    parent = np.arange(len(fps))
    free = [b for b in range(64) if not mask >> b & 1]
    width = max(1, radius.bit_length())
    for k in range(1, 64):
        pick = (sizes >> k) == 1                      # buckets of 2^k .. 2^(k+1)-1 rows together
        if not pick.any():
            if not (sizes >> k).any():
                break
            continue
        size = sizes[pick]
        bucket = np.repeat(np.arange(len(size)), size)
        first = np.cumsum(size) - size
        rows = starts[pick][bucket] + np.arange(len(bucket)) - first[bucket]
        n, longest = len(rows), int(size.max())
        words = -(-n // 64)
        pad = words + longest // 64 + 2
        planes = np.zeros((len(free), pad), np.uint64)
        own = fps[rows]
        for i, b in enumerate(free):
            packed = np.packbits((own >> np.uint64(b)).astype(np.uint8) & 1, bitorder="little")
            planes[i].view(np.uint8)[:len(packed)] = packed
        left = size[bucket] - (np.arange(n) - first[bucket])   # rows from here to the bucket's end
        for d in range(1, longest):
            live = np.zeros(words * 8, np.uint8)
            packed = np.packbits(left > d, bitorder="little")
            live[:len(packed)] = packed
            live = live.view(np.uint64)
            act = np.flatnonzero(live)
            if not len(act):
                break
            live = live[act]
            q, r = divmod(d, 64)
            count = [np.zeros(len(act), np.uint64) for _ in range(width)]
            over = np.zeros(len(act), np.uint64)
            for at in range(0, len(free), 3):
                x = []
                for i in range(at, min(at + 3, len(free))):
                    p = planes[i]
                    far = p[act + q] >> np.uint64(r)
                    if r:
                        far |= p[act + (q + 1)] << np.uint64(64 - r)
                    x.append(p[act] ^ far)
                while len(x) < 3:
                    x.append(np.zeros(len(act), np.uint64))
                half = x[0] ^ x[1]
                total, twos = half ^ x[2], (x[0] & x[1]) | (half & x[2])
                carry = count[0] & total                # carry-save: three planes into two counters
                count[0] ^= total
                if width == 1:
                    over |= carry | twos
                else:
                    half = carry ^ twos
                    out = (carry & twos) | (half & count[1])
                    count[1] ^= half
                    for c in count[2:]:
                        out, c[:] = c & out, c ^ out
                    over |= out
                if at % 12 == 9:
                    keep = (live & ~over) != 0
                    if not keep.any():
                        act = act[:0]
                        break
                    if keep.mean() < 0.7:
                        act, live, over, count = act[keep], live[keep], over[keep], [c[keep] for c in count]
            if not len(act):
                continue
            more, same = np.zeros(len(act), np.uint64), ~np.zeros(len(act), np.uint64)
            for j in range(width - 1, -1, -1):
                if radius >> j & 1:
                    same &= count[j]
                else:
                    more |= same & count[j]
                    same &= ~count[j]
            good = live & ~(over | more)
            hit = np.flatnonzero(good)
            if not len(hit):
                continue
            lanes = np.unpackbits(good[hit].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            w, lane = np.nonzero(lanes)
            i = act[hit[w]] * 64 + lane
            _join(parent, rows[i], rows[i + d])
    return _roots(parent, np.arange(len(fps)))


def _roots(parent, x):
    p = parent[x]
    while True:
        up = parent[p]
        if (up == p).all():
            return p
        p = up


def _join(parent, i, j) -> None:
    import numpy as np
    while True:
        a, b = _roots(parent, i), _roots(parent, j)
        apart = a != b
        if not apart.any():
            return
        np.minimum.at(parent, np.maximum(a, b)[apart], np.minimum(a, b)[apart])


def _bucket_links(blocks: DataFrame, radius: int) -> DataFrame:
    """Links of every bucket ``(mask, key)``, as edges to the bucket's representatives."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from ledgerhawk.llm.simhash import sliced_links

        def solve(mask, key, fp):
            cut = np.flatnonzero(np.r_[True, (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])])
            sizes = np.diff(np.r_[cut, len(fp)])
            a, b = [], []
            for m in np.unique(mask):
                own = mask[cut] == m
                root = sliced_links(fp.view(np.uint64), int(m), cut[own], sizes[own], radius)
                i = np.flatnonzero(root != np.arange(len(fp)))
                a.append(fp[i])
                b.append(fp[root[i]])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

        held = None
        for batch in batches:
            now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if not len(now[0]):
                continue
            now = now if held is None else [np.concatenate(x) for x in zip(held, now)]
            last = (now[0] == now[0][-1]) & (now[1] == now[1][-1])
            at = len(last) - int(last.sum())          # the last bucket may go on in the next batch
            held = [x[at:] for x in now]
            if at:
                yield solve(*[x[:at] for x in now])
        if held is not None:
            yield solve(*held)

    return (blocks.repartition("mask", "key").sortWithinPartitions("mask", "key")
            .mapInArrow(run, "a long, b long"))


def links(fps: DataFrame, radius: int = 3, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Edges ``(a, b)`` that span every class of distinct fingerprints ``fp`` linked at
    ``radius`` or fewer differing bits."""
    masks = first_masks(radius)
    rows = fps.select(F.explode(F.array(*[F.lit(m) for m in masks])).alias("mask"), "fp")
    found = []
    while True:
        blocks = rows.select("mask", F.col("mask").bitwiseAND(F.col("fp")).alias("key"), "fp")
        large = stored(blocks.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n"))
                       .where(F.col("n") > bucket_rows).select("mask", "key"), "simhash-large")
        masks = [r[0] for r in large.select("mask").distinct().collect()]   # at most the fixed masks
        if not masks:
            found.append(_bucket_links(blocks, radius))
            break
        found.append(_bucket_links(blocks.join(large, ["mask", "key"], "left_anti"), radius))
        finer = F.create_map(*[x for m in masks for x in
                               (F.lit(m), F.array(*[F.lit(v) for v in next_masks(m, radius)]))])
        rows = (blocks.join(large, ["mask", "key"], "left_semi")
                .select(F.explode(F.element_at(finer, F.col("mask"))).alias("mask"), "fp"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3,
                    bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fp, root, component_id``.

    Documents whose fingerprints differ in at most ``radius`` bits are linked;
    ``component_id`` is the smallest doc_id reachable and ``root`` names the class by a
    fingerprint of it. Null and empty texts have fingerprint zero and link like any
    other. A row without a doc_id links others; a class of such rows alone has a null
    component. Repeated rows are each answered. Empty tables give empty results."""
    sig = stored(signatures(docs, shingle), "simhash")
    reps = sig.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    stars = components(links(reps.select("fp"), radius, bucket_rows))
    rooted = (reps.join(stars.withColumnRenamed("node", "fp"), "fp", "left")
              .select("fp", "rep", F.coalesce("root", "fp").alias("root")))
    rooted = stored(rooted, "simhash-classes")
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    classes = rooted.join(least, "root").select("fp", "root", "component_id")
    return sig.join(classes, "fp").select("doc_id", "fp", "root", "component_id")


def hex64(c) -> Column:
    return F.lpad(F.lower(F.hex(c)), 16, "0")


def op9(spark, sf_dir: str) -> DataFrame:
    """Contract digest of ``near_duplicates`` over whole ``documents``."""
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", hex64("fp").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` with one row of each near-duplicate class: the one with the smallest
    doc_id (a null id only where the class has no other); of repeated rows one stays."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    own = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), row.alias("row"))
    near = near_duplicates(docs.select(own.alias("doc_id"), "text"), shingle, radius)
    best = near.select(F.col("component_id.id").alias("_sh_id"), F.col("component_id.row").alias("_sh_row")).distinct()
    keys = ["_sh_id", "_sh_row"]
    kept = (docs.withColumns({"_sh_id": F.coalesce("doc_id", F.lit(0)), "_sh_row": row})
            .join(best, keys, "left_semi"))
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    return kept.withColumn("_sh_n", first).where("_sh_n = 1").drop("_sh_n", *keys)
