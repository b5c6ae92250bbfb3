"""Exact substring dedup by prefix-free parsing.

A byte goes if it lies in a ``length``-byte string that also starts in a document with a
smaller doc_id. The corpus is parsed into phrases at rolling-hash triggers: the trigger
of a string is the position of the least hash of its ``WINDOW``-byte windows (rightmost
of equals), so equal strings have equal triggers wherever they stand, and consecutive
starts with one trigger form a phrase. A phrase is kept with the ``length`` bytes its last
start needs, so its own suffixes decide the order of all strings that start in it.

1. Dictionary: phrases equal to one of an earlier document are covered as a whole; the
   rest are the dictionary. In highly repetitive text it is small.
2. Triggers that different phrases of different documents share mark the dictionary
   phrases that may still hold a common string.
3. The suffixes of those phrases are put in order, to a depth of ``length`` bytes
   (beyond it the order does not matter here): a suffix array of the dictionary in every
   unit of text, whose runs of equal suffixes are merged across units by 128-bit digests.
   Read through the parse, each run gives the earliest document of a string.

Every merge sends one record per distinct key and unit of text, so a passage that a
third of all documents share costs one record per unit, and a key's group is no larger
than the number of units.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerhawk.llm.common import stored, table

LENGTH = 50
WINDOW = 24
UNIT_BYTES = 2_500_000          # text parsed together
PASS_BYTES = 1 << 19            # positions hashed together; below 2^24
BUCKET_BYTES = 16_000_000       # text whose keys share a bucket
UNIT = "unit long, to long, data binary"


@lru_cache(1)
def _tables():
    import numpy as np
    rng = np.random.default_rng(20240229)
    byte = rng.integers(1, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    base = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
    return byte, base


_POWERS: dict = {}


def _powers(which: int, n: int):
    """Powers of the base and of its inverse; one table per worker."""
    import numpy as np
    if which not in _POWERS or len(_POWERS[which][0]) < n:
        b = _tables()[1][which]
        up, down = np.full(max(n, 2 * PASS_BYTES), b, np.uint64), np.full(max(n, 2 * PASS_BYTES), pow(b, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        np.multiply.accumulate(up, out=up)
        np.multiply.accumulate(down, out=down)
        _POWERS[which] = (up, down)
    return _POWERS[which]


def stretch_hashes(data, start, end, which: int = 0):
    """Mixed polynomial hashes modulo 2^64 of the stretches ``start`` to ``end``, whose
    starts ascend; prefix sums are made over PASS_BYTES at a time."""
    import numpy as np
    byte = _tables()[0][which]
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        low = int(start[i])
        j = int(np.searchsorted(start, low + PASS_BYTES))
        first, last = start[i:j] - low, end[i:j] - low
        n = int(last.max())
        up, down = _powers(which, n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(byte[data[low:low + n]] * up[:n], out=sums[1:])
        h = (sums[last] - sums[first]) * down[first]
        h = (h ^ (h >> np.uint64(29)) ^ (last - first).astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        out[i:j] = h ^ (h >> np.uint64(32))
        i = j
    return out


def window_hashes(data, window: int):
    """Hashes of all windows of one size: ``stretch_hashes`` for stretches side by side."""
    import numpy as np
    n = len(data)
    up, down = _powers(0, n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.multiply(_tables()[0][0][data], up[:n], out=sums[1:])
    np.cumsum(sums, out=sums)
    h = sums[window:] - sums[:-window]
    h *= down[:len(h)]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h


class Parse:
    """Phrases of documents laid end to end: for phrase i the starts ``first[i]`` to
    ``last[i]``, its trigger and its document. Memory beyond the text is that of the
    phrases, about one for every 14 bytes."""

    def __init__(self, texts: list, length: int = LENGTH, window: int = WINDOW):
        import numpy as np
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        self.length, self.window = length, window
        self.sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        self.at = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(raw), np.uint8)
        del raw
        first, trigger, doc = [], [], []
        for low in range(0, max(len(self.data) - length + 1, 0), PASS_BYTES):
            high = min(low + PASS_BYTES, len(self.data) - length + 1)
            t = self._triggers(low, high)
            here = np.arange(np.searchsorted(self.at, low, side="right") - 1, np.searchsorted(self.at, high))
            edge = np.clip(np.append(self.at[here], high), low, high)
            d = np.repeat(here, np.diff(edge))
            change = np.empty(high - low, bool)
            change[0] = True
            np.not_equal(t[1:], t[:-1], out=change[1:])
            change[edge[:-1][edge[:-1] < high] - low] = True
            for end in (self.at + self.sizes)[here].tolist():                # strings do not cross documents
                change[max(end - length + 1 - low, 0):max(end - low, 0)] = False
            new = np.flatnonzero(change)
            if len(new) and trigger and new[0] == 0 and trigger[-1][-1] == t[0] and doc[-1][-1] == d[0]:
                new = new[1:]                              # the last phrase goes on
            if len(new):
                first.append(new + low)
                trigger.append(t[new])
                doc.append(d[new])
        none = np.zeros(0, np.int64)
        self.first, self.trigger, self.doc = (np.concatenate(x) if x else none for x in (first, trigger, doc))
        self.counts = np.bincount(self.doc, minlength=len(texts))
        # a phrase ends before the next one of its document, or with the document's last string
        self.last = (self.at + self.sizes - length)[self.doc]
        same = self.doc[1:] == self.doc[:-1]
        self.last[:-1][same] = self.first[1:][same] - 1

    def _triggers(self, low: int, high: int):
        """Place of the least window hash of every string that starts in the range."""
        import numpy as np
        span = self.length - self.window + 1
        h = window_hashes(self.data[low:high + self.length - 1], self.window)
        h &= ~np.uint64((1 << 24) - 1)
        h |= np.arange((1 << 24) - 1, (1 << 24) - 1 - len(h), -1, dtype=np.uint64)     # rightmost of equals
        width, n = 1, high - low
        while width * 2 <= span:                           # least hash of 2, 4, 8 ... windows
            h = np.minimum(h[:len(h) - width], h[width:])
            width *= 2
        h = np.minimum(h[:n], h[span - width:span - width + n])
        return low + (1 << 24) - 1 - (h & np.uint64((1 << 24) - 1)).astype(np.int64)

    def phrase_keys(self):
        """128 bits for each phrase with the bytes its last start needs."""
        end = self.last + self.length
        return stretch_hashes(self.data, self.first, end), stretch_hashes(self.data, self.first, end, 1)

    def trigger_keys(self):
        return stretch_hashes(self.data, self.trigger, self.trigger + self.window)

    def suffixes(self, phrases):
        """Starts in the given phrases, with their phrase."""
        import numpy as np
        size = self.last[phrases] - self.first[phrases] + 1
        own = np.repeat(phrases, size)
        return self.first[own] + np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size), own


def suffix_order(data, starts, depth: int):
    """Order of the suffixes at ``starts`` by their first ``depth`` bytes, and for each
    place in that order whether its suffix differs from the one before."""
    import numpy as np
    words = -(-depth // 8)
    padded = np.concatenate((data, np.zeros(words * 8, np.uint8)))
    columns = []
    for w in range(words):
        take = min(8, depth - 8 * w)
        value = np.zeros(len(starts), np.uint64)
        for k in range(take):
            value = (value << np.uint64(8)) | padded[starts + (8 * w + k)]
        columns.append(value)
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(starts), bool)
    if len(new):
        new[0] = True
    for value in columns:
        v = value[order]
        new[1:] |= v[1:] != v[:-1]
    return order, new


def units(batches: Iterator, length: int) -> Iterator:
    """Rows of Arrow batches in units of about UNIT_BYTES of text (longer rows alone)."""
    for batch in batches:
        sizes = batch.column("size").to_numpy(zero_copy_only=False)
        start = total = 0
        for i, size in enumerate(sizes):
            if i > start and total + size > UNIT_BYTES:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)


def _pack(*arrays) -> bytes:
    out = [struct.pack("<i", len(arrays))]
    for a in arrays:
        out.append(struct.pack("<2sq", a.dtype.str[1:].encode(), len(a)))
        out.append(a.tobytes())
    return b"".join(out)


def _unpack(blob: bytes) -> list:
    import numpy as np
    n, at, out = struct.unpack_from("<i", blob)[0], 4, []
    for _ in range(n):
        kind, size = struct.unpack_from("<2sq", blob, at)
        at += struct.calcsize("<2sq")
        a = np.frombuffer(blob, np.dtype("<" + kind.decode()), size, at)
        out.append(a)
        at += a.nbytes
    return out


def send(ids, prints, counts, keys, subs, labels, buckets: int, differs: bool) -> Iterator:
    """Rows ``unit, to, data`` for one unit's records (``counts`` per document, in order).

    To every bucket go the unit's distinct keys, each once, with the least doc_id it has
    here; to the unit's home (a negative ``to``) goes what turns answers into records."""
    import numpy as np
    import xxhash
    own = np.repeat(np.arange(len(ids)), counts)
    unit = xxhash.xxh64_intdigest(ids.tobytes() + prints.tobytes()) >> 8      # a task run again names it alike
    doc = ids[own]
    order = np.lexsort((np.arange(len(doc)), doc, keys) if differs else (np.arange(len(doc)), doc, subs, keys))
    k, s, d = keys[order], subs[order], doc[order]
    new = np.r_[True, (k[1:] != k[:-1])] if differs else np.r_[True, (k[1:] != k[:-1]) | (s[1:] != s[:-1])]
    if not len(order):
        new = new[:0]
    group = np.cumsum(new) - 1
    rep = order[new]                                     # record that stands for the group
    rep_of = np.empty(len(order), np.int64)
    rep_of[order] = rep[group]
    if differs:                                          # the key's phrases differ here already?
        mixed = np.zeros(len(rep), bool)
        apart = np.zeros(len(rep), bool)
        np.logical_or.at(mixed, group, s != s[new][group])
        np.logical_or.at(apart, group, d != d[new][group])
        send_sub = (s[new] << np.uint64(1)) | mixed
        local = (mixed & apart)[group][np.argsort(order)]
    else:
        send_sub = s[new]
        local = (d > d[new][group])[np.argsort(order)]
    shared = np.flatnonzero(rep_of != np.arange(len(rep_of)))
    yield unit, -1 - unit, _pack(ids, prints, counts.astype(np.int32), np.packbits(local), shared.astype(np.uint32),
                                 rep_of[shared].astype(np.uint32), labels.astype(np.uint32))
    place = (keys[rep] >> np.uint64(40)).astype(np.int64) % buckets
    by = np.lexsort((rep, place))
    cut = np.searchsorted(place[by], np.arange(buckets + 1))
    for b in range(buckets):
        r = by[cut[b]:cut[b + 1]]
        if len(r):
            rec = rep[r]
            yield unit, b, _pack(keys[rec], send_sub[r], rec.astype(np.uint32), doc[rec])


def settle(parts: list, differs: bool) -> Iterator:
    """Answers of one bucket: per unit the records whose key is elsewhere in an earlier
    document, or (``differs``) elsewhere with another phrase."""
    import numpy as np
    unit = np.repeat(np.arange(len(parts)), [len(p[1][0]) for p in parts])
    keys, subs, recs, docs = (np.concatenate([p[1][i] for p in parts]) for i in range(4))
    if differs:
        order = np.argsort(keys, kind="stable")
        k, s = keys[order], subs[order]
        new = np.r_[True, k[1:] != k[:-1]]
        group = np.cumsum(new) - 1
        odd = np.zeros(int(group[-1]) + 1, bool)
        np.logical_or.at(odd, group, (s != s[new][group]) | ((s & np.uint64(1)) == 1))
        many = np.bincount(group) > 1
        hit = (odd & many)[group]
    else:
        order = np.lexsort((docs, subs, keys))
        k, s, d = keys[order], subs[order], docs[order]
        new = np.r_[True, (k[1:] != k[:-1]) | (s[1:] != s[:-1])]
        group = np.cumsum(new) - 1
        hit = d > d[new][group]
    won = order[hit]
    won = won[np.argsort(unit[won], kind="stable")]
    cut = np.searchsorted(unit[won], np.arange(len(parts) + 1))
    for u, (name, _) in enumerate(parts):
        if cut[u + 1] > cut[u]:
            yield name, -1 - name, _pack(recs[won[cut[u]:cut[u + 1]]])


def merge(sent: DataFrame, differs: bool, name: str) -> DataFrame:
    """``doc_id, print, labels``: the labels of the records that ``settle`` found, per
    document that has any."""

    def groups(batches: Iterator) -> Iterator:
        """Rows of one ``to`` together; the partition is sorted by it."""
        now, held = None, []
        for b in batches:
            for u, to, data in zip(*(c.to_pylist() for c in b.columns)):
                if to != now and held:
                    yield now, held
                    held = []
                now = to
                held.append((u, data))
        if held:
            yield now, held

    def solve(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from ledgerhawk.llm import pfp
        for to, rows in groups(batches):
            out = [(u, to, d) for u, d in rows] if to < 0 else list(
                pfp.settle([(u, pfp._unpack(d)) for u, d in rows], differs))
            for at in range(0, len(out), 64):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out[at:at + 64]), (pa.int64(), pa.int64(), pa.binary()))],
                    ["unit", "to", "data"])

    def home(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from ledgerhawk.llm import pfp
        for _, rows in groups(batches):
            parts = [pfp._unpack(d) for _, d in rows]
            ids, prints, counts, local, shared, reps, labels = next(p for p in parts if len(p) > 1)
            total = int(counts.sum())
            hit = np.zeros(total, bool)
            for p in parts:
                if len(p) == 1:
                    hit[p[0]] = True
            hit[shared] |= hit[reps]
            hit |= np.unpackbits(local, count=total).astype(bool)
            ends = np.cumsum(counts)
            sums = np.concatenate(([0], np.cumsum(hit)))
            each = sums[ends] - sums[ends - counts]
            some = np.flatnonzero(each)
            if len(some):
                at = np.concatenate(([0], np.cumsum(each[some]))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(at), pa.array(labels[hit].astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(prints[some]), lists],
                                                 ["doc_id", "print", "labels"])

    answers = sent.repartition("to").sortWithinPartitions("to").mapInArrow(solve, UNIT)
    found = answers.repartition("to").sortWithinPartitions("to").mapInArrow(home, "doc_id long, print long, labels array<int>")
    return stored(found, name)


def _source(docs: DataFrame) -> DataFrame:
    """``doc_id, print, text, size``; a null id sorts after all others, equal rows are one."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("doc_id"),
                       F.xxhash64(text).alias("print"), text.alias("text"), F.octet_length(text).alias("size"))


def _phrase_records(src: DataFrame, length: int, buckets: int, differs: bool) -> DataFrame:
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from ledgerhawk.llm import pfp
        for b in pfp.units(batches, length):
            ids, prints = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            p = pfp.Parse(b.column(2).to_pylist(), length)
            one, two = p.phrase_keys()
            keys, subs = (p.trigger_keys(), one) if differs else (one, two)
            nth = np.arange(len(p.doc)) - np.repeat(np.cumsum(p.counts) - p.counts, p.counts)
            for u, to, data in pfp.send(ids, prints, p.counts, keys, subs, nth, buckets, differs):
                yield pa.RecordBatch.from_arrays([pa.array([u]), pa.array([to]), pa.array([data])], ["unit", "to", "data"])

    return src.where(F.col("size") >= length).mapInArrow(run, UNIT)


def _suffix_records(src: DataFrame, length: int, buckets: int) -> DataFrame:
    """Records of the dictionary suffixes of the marked phrases (``maybe`` without ``whole``)."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from ledgerhawk.llm import pfp
        for b in pfp.units(batches, length):
            ids, prints = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            p = pfp.Parse(b.column(2).to_pylist(), length)
            from_doc = np.cumsum(p.counts) - p.counts
            mark = np.zeros(len(p.doc), bool)
            for i, (on, off) in enumerate(zip(b.column(4).to_pylist(), b.column(5).to_pylist())):
                mark[from_doc[i] + np.array(on, np.int64)] = True
                if off:
                    mark[from_doc[i] + np.array(off, np.int64)] = False
            starts, own = p.suffixes(np.flatnonzero(mark))
            order, new = pfp.suffix_order(p.data, starts, length)
            run_of = np.empty(len(order), np.int64)
            run_of[order] = np.cumsum(new) - 1
            head = starts[order[new]]                      # one suffix of every run of equals
            ascending = np.argsort(head, kind="stable")
            keys, subs = np.empty(len(head), np.uint64), np.empty(len(head), np.uint64)
            for out, which in ((keys, 0), (subs, 1)):
                out[ascending] = pfp.stretch_hashes(p.data, head[ascending], head[ascending] + length, which)
            keys, subs = keys[run_of], subs[run_of]
            counts = np.bincount(p.doc[own], minlength=len(ids))
            for u, to, data in pfp.send(ids, prints, counts, keys, subs, starts - p.at[p.doc[own]], buckets, False):
                yield pa.RecordBatch.from_arrays([pa.array([u]), pa.array([to]), pa.array([data])], ["unit", "to", "data"])

    return src.mapInArrow(run, UNIT)


def covered(sizes: int, parse, whole, starts):
    """Boolean per byte of one document: inside a whole phrase or a common string."""
    import numpy as np
    edge = np.zeros(sizes + 1, np.int32)
    if whole is not None:
        np.add.at(edge, parse.first[whole], 1)
        np.add.at(edge, parse.last[whole] + parse.length, -1)
    if starts is not None:
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + parse.length, -1)
    return np.cumsum(edge[:-1]) > 0


def repeated_strings(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, spans, kept`` of every row: removed runs as
    byte ``start, end`` and the bytes that stay.

    Null and short texts lose nothing. Documents of one doc_id do not remove each other;
    rows equal in id and text are answered alike; a null id counts as the largest. Other
    columns are not read; an empty table gives an empty result."""
    src = _source(docs)
    total = src.agg(F.sum(F.col("size").cast("long"))).first()[0] or 0
    buckets = int(max(8, total // BUCKET_BYTES))
    whole = merge(_phrase_records(src, length, buckets, False), False, "pfp-dictionary") \
        .withColumnRenamed("labels", "whole")
    maybe = merge(_phrase_records(src, length, buckets, True), True, "pfp-triggers") \
        .withColumnRenamed("labels", "maybe")
    key = ["doc_id", "print"]
    todo = src.join(maybe.dropDuplicates(key), key).join(whole.dropDuplicates(key), key, "left") \
        .select("doc_id", "print", "text", "size", "maybe", "whole").dropDuplicates(key) \
        .sortWithinPartitions(key)                      # units must be the same when a task is run again
    found = merge(_suffix_records(todo, length, buckets), False, "pfp-suffixes").withColumnRenamed("labels", "starts")
    last = src.join(whole.dropDuplicates(key), key, "left").join(found.dropDuplicates(key), key, "left") \
        .select("doc_id", "text", "whole", "starts")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from ledgerhawk.llm import pfp
        from ledgerhawk.llm.common import rows_of
        for b in rows_of(batches, 512):
            ids, texts, wholes, starts = (c.to_pylist() for c in b.columns)
            rows = []
            for text, w, s in zip(texts, wholes, starts):
                raw = text.encode("utf-8", "surrogatepass")
                if w is None and s is None:
                    rows.append((len(raw), 0, 0, [], raw))
                    continue
                gone = pfp.covered(len(raw), pfp.Parse([text], length) if w is not None else pfp.Parse([""], length),
                                   w and np.array(w), s and np.array(s))
                edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0])))).reshape(-1, 2)
                rows.append((len(raw), int(gone.sum()), len(edge), [{"start": a, "end": z} for a, z in edge.tolist()],
                             np.frombuffer(raw, np.uint8)[~gone].tobytes()))
            span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), span, pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows), kinds))],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    out = last.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, "
                               "spans array<struct<start:int,end:int>>, kept binary")
    return out.withColumn("doc_id", F.when(F.col("doc_id") < (1 << 63) - 1, F.col("doc_id")))


def op2(spark, sf_dir: str) -> DataFrame:
    """Contract digest of ``repeated_strings`` over whole ``documents``."""
    out = repeated_strings(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
