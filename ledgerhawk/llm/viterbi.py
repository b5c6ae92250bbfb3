"""SentencePiece encoding and decoding by streaming Viterbi.

A text becomes the best-scoring sequence of a public vocabulary's pieces; characters
outside the vocabulary fall back to byte pieces. The search runs left to right over a
window no longer than the longest piece and commits ids as soon as every surviving
backpointer path goes through one boundary. At a blank no piece can span the boundary,
so all paths meet there: the stretch since the last such boundary is committed, and a
worker remembers the ids of stretches it has met.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

from pyspark.sql import DataFrame

from ledgerhawk.llm.common import TOKENIZER_DIR, id_and_text, rows_of, table

MODEL = f"{TOKENIZER_DIR}/piece_bpe_32k.model"
BLANK = "▁"
CACHE = 400_000
CACHE_CHARS = 64


class Vocabulary:
    """Pieces, scores and byte fallback of one model file, opened once per worker."""

    _open: dict = {}

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes_of: list = []
        self.piece: dict = {}
        self.byte_id: dict = {}
        low = 0.0
        for i in range(sp.vocab_size()):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(p[3:5], 16)] = i
                self.bytes_of.append(bytes([int(p[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.piece[p] = (sp.get_score(i), i)
                self.bytes_of.append(p.replace(BLANK, " ").encode())
                low = min(low, sp.get_score(i))
        if len(self.byte_id) != 256:
            raise ValueError("the vocabulary has no byte fallback")
        self.longest = max(map(len, self.piece))
        self.byte_score = 2 * low                      # a byte piece is worse than any other
        self.prefixes = {p[:k] for p in self.piece for k in range(1, len(p) + 1)}
        if len(self.byte_id) != 256:
            raise ValueError("the vocabulary has no byte fallback")
        self.longest = max(map(len, self.piece))
        self.byte_score = 2 * low                      # a byte piece is worse than any other
        self.prefixes = {p[:k] for p in self.piece for k in range(1, len(p) + 1)}
        self.trie: dict = {}                           # character -> node; None holds (score, id)
        for p, hit in self.piece.items():
            node = self.trie
            for ch in p:
                node = node.setdefault(ch, {})
            node[None] = hit
        if any(BLANK in p.lstrip(BLANK) or "\n" in p for p in self.piece):
            raise ValueError("pieces cross a blank: stretches would not be independent")
        self.ids: dict = {}
        self.graph = Graph(self.piece)

    @classmethod
    def of(cls, path: str) -> Vocabulary:
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def char_ids(self, ch: str) -> list:
        return self.char_ids_of(" " if ch == BLANK else ch)

    def char_ids_of(self, ch: str) -> list:
        return [self.byte_id[b] for b in ch.encode("utf-8", "surrogatepass")]


def stream(chars: Iterator, v: Vocabulary) -> Iterator:
    """Ids of a stream of characters (blanks already written as BLANK), committed as
    soon as all surviving paths agree. Equal scores: the longer last piece wins.

    ``best[k]`` is the best way to reach boundary ``done + k``; only the last
    ``longest`` boundaries can still be extended. Every path that ends there goes back
    through the window, and the boundary all of them share is final."""
    longest, piece, prefixes = v.longest, v.piece, v.prefixes
    text, base = "", 0                     # characters kept, position of text[0]
    best = {0: (0.0, 0, ())}               # boundary -> score, previous boundary, ids of the last piece
    done = reach = 0
    source, ended = iter(chars), False
    while True:
        while not ended and base + len(text) - reach < longest:
            part = next(source, None)
            if part is None:
                ended = True
            else:
                text += part
        if base + len(text) == reach:
            break
        here, at = best[reach][0], reach - base
        ch = text[at]
        if ch not in piece:
            got = v.char_ids(ch)
            s = here + v.byte_score * len(got)
            if reach + 1 not in best or s > best[reach + 1][0]:
                best[reach + 1] = (s, reach, tuple(got))
        for k in range(1, min(longest, len(text) - at) + 1):
            p = text[at:at + k]
            if p not in prefixes:
                break
            if p in piece:
                s = here + piece[p][0]
                if reach + k not in best or s > best[reach + k][0]:
                    best[reach + k] = (s, reach, (piece[p][1],))
        reach += 1
        # the boundaries that a later piece can start from or has been reached already
        ends = [b for b in best if b >= reach]
        meet = min(ends)
        live = set(ends)
        while len(live) > 1:               # walk the later paths back until they agree
            far = max(live)
            live.discard(far)
            live.add(max(best[far][1], done))
        meet = live.pop()
        if meet > done:
            back, b = [], meet
            while b > done:
                back.append(best[b][2])
                b = best[b][1]
            for ids in reversed(back):
                yield from ids
            done = meet
            shift = best[done][0]          # scores count from the committed boundary on
            best = {b: ((s - shift, max(p, done), i) if b > done else (0.0, done, ()))
                    for b, (s, p, i) in best.items() if b >= done}
            text, base = text[done - base:], done
    # the text's end is a boundary shared by all paths that are left
    back, b = [], reach
    while b > done:
        back.append(best[b][2])
        b = best[b][1]
    for ids in reversed(back):
        yield from ids


def learn(stretches: set, v: Vocabulary) -> None:
    """Remember the ids of the given stretches.

    Stretches of one length are searched together: the recurrence runs boundary by
    boundary over the columns of a character matrix. Those longer than the cache takes,
    or with characters outside the vocabulary, go through ``stream``."""
    import numpy as np
    if len(v.ids) > CACHE:
        v.ids.clear()
    by_size: dict = {}
    for s in stretches:
        if s not in v.ids:
            by_size.setdefault(len(s), []).append(s)
    for n, words in by_size.items():
        if n > CACHE_CHARS:
            continue                                       # not remembered: see encode()
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, n)
        cls = v.graph.classes(points)
        known = (cls >= 0).all(axis=1)
        for i in np.flatnonzero(~known).tolist():
            v.ids[words[i]] = array("i", stream(iter([words[i]]), v)).tobytes()
        rows = np.flatnonzero(known)
        for at in range(0, len(rows), 20_000):
            part = rows[at:at + 20_000]
            flat, ends = v.graph.best(cls[part])
            raw, start = flat.tobytes(), 0
            for i, end in zip(part.tolist(), (ends * 4).tolist()):
                v.ids[words[i]] = raw[start:end]
                start = end


class Graph:
    """The vocabulary as a character automaton on arrays."""

    def __init__(self, piece: dict):
        import numpy as np
        chars = sorted({p for p in piece if len(p) == 1})
        self.points = np.array([ord(c) for c in chars], np.uint32)
        rank = {c: i for i, c in enumerate(chars)}
        usable = {p: hit for p, hit in piece.items() if all(c in rank for c in p)}
        node = {"": 0}
        for p in usable:
            for k in range(1, len(p) + 1):
                node.setdefault(p[:k], len(node))
        self.piece = np.full(len(node), -1, np.int32)
        self.worth = np.zeros(len(node))
        for p, (worth, i) in usable.items():
            self.piece[node[p]], self.worth[node[p]] = i, worth
        names = [p for p in node if p]
        self.width = len(chars)
        keys = np.array([node[p[:-1]] * self.width + rank[p[-1]] for p in names], np.int64)
        to = np.array([node[p] for p in names], np.int32)
        self.levels = []                                   # hash tables; each takes what the last could not
        while len(keys):
            slot = self._slot(keys, len(self.levels))
            held, target = np.full(self.SIZE, -1, np.int64), np.zeros(self.SIZE, np.int32)
            held[slot], target[slot] = keys, to
            out = held[slot] != keys
            self.levels.append((held, target))
            keys, to = keys[out], to[out]

    SIZE = 1 << 19

    def _slot(self, keys, level: int):
        import numpy as np
        mixed = (keys.astype(np.uint64) + np.uint64(level)) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(45)).astype(np.int64)

    def classes(self, points):
        """Index of each character in the vocabulary, -1 if it has no piece of its own."""
        import numpy as np
        at = np.searchsorted(self.points, points).clip(max=self.width - 1)
        return np.where(self.points[at] == points, at, -1)

    def step(self, node, cls):
        import numpy as np
        keys = node.astype(np.int64) * self.width + cls
        to = np.full(len(keys), -1, np.int32)
        for level, (held, target) in enumerate(self.levels):
            slot = self._slot(keys, level)
            hit = held[slot] == keys
            to[hit] = target[slot[hit]]
        return to

    def best(self, cls):
        """Ids of the best path of every row, one after another, and where each row ends."""
        import numpy as np
        m, n = cls.shape
        score = np.full((m, n + 1), -np.inf)
        score[:, 0] = 0
        prev, ids = np.zeros((m, n + 1), np.int16), np.zeros((m, n + 1), np.int32)
        for i in range(n):
            rows, node = np.arange(m), np.zeros(m, np.int32)
            for k in range(i, n):
                node = self.step(node, cls[rows, k])
                on = node >= 0
                rows, node = rows[on], node[on]
                if not len(rows):
                    break
                ends = self.piece[node] >= 0
                r, q = rows[ends], node[ends]
                t = score[r, i] + self.worth[q]
                better = t > score[r, k + 1]
                r, q = r[better], q[better]
                score[r, k + 1], prev[r, k + 1], ids[r, k + 1] = t[better], i, self.piece[q]
        out = np.full((m, n), -1, np.int32)
        rows, at = np.arange(m), np.full(m, n)
        for col in range(n - 1, -1, -1):                   # written from the right
            out[rows, col] = ids[rows, at]
            at = prev[rows, at]
            on = at > 0
            rows, at = rows[on], at[on]
            if not len(rows):
                break
        used = out >= 0
        return out[used], np.cumsum(used.sum(axis=1))


_CUTS = re.compile("\n|" + BLANK + "+[^" + BLANK + "\n]*|[^" + BLANK + "\n]+")


def _cut(text: str) -> list:
    return _CUTS.findall((" " + text).replace(" ", BLANK))


def encode(texts: list, v: Vocabulary) -> list:
    """Ids of whole texts; a literal U+2581 is written as bytes so that decoding is exact."""
    import numpy as np
    literal = array("i", v.char_ids_of(BLANK)).tobytes()
    cut = []
    for text in texts:
        head, *rest = text.split(BLANK)
        cut.append([_cut(head), *(_CUTS.findall(part.replace(" ", BLANK)) for part in rest)])
    learn({s for parts in cut for part in parts for s in part}, v)
    get, out = v.ids, []
    for parts in cut:
        blobs = [b"".join([get[s] if s in get else array("i", stream(iter([s]), v)).tobytes() for s in part])
                 for part in parts]
        out.append(np.frombuffer(literal.join(blobs), np.int32))
    return out


def decode(ids, v: Vocabulary) -> str:
    """The text again; the blank that encoding puts first is taken off."""
    raw = b"".join(map(v.bytes_of.__getitem__, ids.tolist() if hasattr(ids, "tolist") else ids))
    return raw.decode("utf-8", "surrogatepass")[1:]


def encode_documents(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id, n_ids, ids, round_trip`` of every row; ``round_trip`` says that decoding
    the ids gives the whole text back.

    Null text counts as empty (the one id of the leading blank). Repeated rows are each
    answered; an empty table gives an empty result; other columns are not read."""
    src = id_and_text(docs)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from ledgerhawk.llm.viterbi import Vocabulary as Opened
        from ledgerhawk.llm.viterbi import decode as back
        from ledgerhawk.llm.viterbi import encode as forth
        v = Opened.of(model)
        for b in rows_of(batches, 512):
            texts = b.column(1).to_pylist()
            ids = forth(texts, v)
            same = [back(i, v) == t for i, t in zip(ids, texts)]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes), lists, pa.array(same)],
                                             ["doc_id", "n_ids", "ids", "round_trip"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, n_ids long, ids array<int>, round_trip boolean")


def decode_documents(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids give null text."""
    src = encoded.select("doc_id", "ids")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from ledgerhawk.llm.viterbi import Vocabulary as Opened
        from ledgerhawk.llm.viterbi import decode as back
        v = Opened.of(model)
        for b in rows_of(batches, 512):
            texts = [None if i is None else back(i, v) for i in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, text string")


def op7(spark, sf_dir: str) -> DataFrame:
    """Ids of every whole text of ``documents``."""
    return encode_documents(table(spark, sf_dir, "documents"))
