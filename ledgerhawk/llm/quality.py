"""Quality rules with tokeniser fertility.

Plain counts (words, symbols, repeated lines and windows) come first; documents that
pass them are judged by how a public vocabulary tokenises their words: characters per
token, share of byte-fallback tokens, and token entropy, each against the rejection
band of the document's language, or of its main script where the language is unknown.
The limits hold at every length: what a short text may deviate by is a standard error,
and the least entropy falls with the length as it does in clean text.
Tokens of a word do not depend on its neighbours (pieces never cross a blank), so each
worker keeps the token ids of the words it has met.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerhawk.llm.common import TOKENIZER_DIR, rows_of, table

# --- fixed values: rejection bands
# lowest and highest characters per token, highest byte-fallback share, lowest share of
# the entropy that a text of so many tokens can have
BANDS = {
    "en": (2.05, 6.5, 0.15, 0.30),
    "de": (2.05, 6.5, 0.15, 0.30),
    "fr": (1.80, 6.5, 0.15, 0.30),
    "es": (1.80, 6.5, 0.15, 0.30),
}
SCRIPT_BANDS = {
    "latin": (1.30, 9.0, 0.25, 0.25),
    "cyrillic": (1.00, 9.0, 0.25, 0.25),
    "greek": (0.80, 9.0, 0.50, 0.25),
    "arabic": (0.60, 9.0, 0.60, 0.25),
    "cjk": (0.30, 4.0, 0.95, 0.25),
    "other": (0.25, 9.0, 1.00, 0.20),
}
SCRIPT_RANGES = (
    ("latin", 0x41, 0x24F), ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F),
    ("arabic", 0x600, 0x6FF), ("cjk", 0x3040, 0x9FFF), ("cjk", 0xAC00, 0xD7A3),
)
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
# ---------------------------------

MIN_WORDS = 10
WINDOW = 5
MAX_REPEAT_PCT = 20
FORGIVEN = 60        # tokens of words with a digit (codes, numbers) that any text may hold
# from all labelled documents that pass the plain counts: spread of characters per token
# within a text (0.84 to 0.95 by language), and the share of entropy, which falls by 0.052
# for each doubling of the tokens; clean rows lie at 1.192 on this line, none under 1.142
DEVIATION, ERRORS = 0.93, 3
CHAR_BYTES = 4       # byte-fallback tokens come a character at a time
ENTROPY_AT_ONE, ENTROPY_FALL, ENTROPY_SHORT = 1.13, 0.052, 0.78
CACHE_WORDS = 400_000

METRICS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "n_tokens long, chars_per_token double, byte_share double, entropy double, "
           "base_failed boolean, fertility_failed boolean, kept boolean")


class Fertility:
    """Token ids of words under one SentencePiece vocabulary, remembered per worker."""

    _open: dict = {}

    def __init__(self, path: str):
        import numpy as np
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.sp.is_byte(i) or self.sp.is_unknown(i) for i in range(self.sp.vocab_size())])
        self.ids: dict = {}
        self.codes: dict = {}

    @classmethod
    def of(cls, path: str) -> Fertility:
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def learn(self, words: set) -> None:
        if len(self.ids) > CACHE_WORDS:
            self.ids.clear()
            self.codes.clear()
        new = [w for w in words if w not in self.ids]
        for at in range(0, len(new), 50_000):
            part = new[at:at + 50_000]
            texts = [w.decode("utf-8", "replace") for w in part]
            for w, got in zip(part, self.sp.encode(texts, num_threads=1)):
                self.ids[w] = array("i", got).tobytes()
            for w, t in zip(part, texts):
                if len(w.translate(None, b"0123456789")) < len(w):
                    self.codes[w] = len(t), len(self.ids[w]) // 4

    def forgiven(self, words: list) -> tuple:
        """Characters and tokens of the words with a digit, in order, up to FORGIVEN tokens."""
        chars = tokens = 0
        for c, t in filter(None, map(self.codes.get, words)):
            if tokens + t <= FORGIVEN:
                chars, tokens = chars + c, tokens + t
        return chars, tokens

    def measure(self, words: list) -> tuple:
        """Tokens, byte-fallback tokens and entropy in bits."""
        import numpy as np
        get = self.ids
        blob = b"".join([get[w] for w in words])
        ids = np.frombuffer(blob, np.int32)
        if not len(ids):
            return 0, 0, 0.0
        counts = np.diff(np.flatnonzero(np.r_[True, np.diff(np.sort(ids)) != 0, True]))
        p = counts / len(ids)
        return len(ids), int(self.is_byte[ids].sum()), float(max(0.0, -(p * np.log2(p)).sum()))


def repeat_words(words: list, size: int = WINDOW) -> int:
    """Words inside windows of ``size`` words that occur at least twice in the text."""
    import numpy as np
    n = len(words) - size + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(size):
        key = key * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    maybe = np.zeros(n, bool)
    maybe[order[1:][same]] = True
    maybe[order[:-1][same]] = True
    seen: dict = {}
    for i in np.flatnonzero(maybe).tolist():           # equal hashes, now the words themselves
        seen.setdefault(tuple(words[i:i + size]), []).append(i)
    covered = np.zeros(len(words) + 1, np.int64)
    for at in seen.values():
        if len(at) > 1:
            np.add.at(covered, at, 1)
            np.add.at(covered, np.array(at) + size, -1)
    return int((np.cumsum(covered) > 0).sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    seen, n = set(), 0
    if "\n" not in text:
        return 0
    for line in text.split("\n"):
        if line in seen:
            n += 1
        elif line.strip(BLANKS):
            seen.add(line)
    return n


def script_of(text: str) -> str:
    """Script of most letters; ties go to the earlier script of the list."""
    import numpy as np
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    counts = {"other": int((points >= 0x250).sum())}
    for name, low, high in SCRIPT_RANGES:
        k = int(((points >= low) & (points <= high)).sum())
        counts[name] = counts.get(name, 0) + k
        if low >= 0x250:
            counts["other"] -= k
    return max(SCRIPT_BANDS, key=lambda s: counts.get(s, 0)) if any(counts.values()) else "latin"


def least_spread(tokens: int) -> float:
    """Lowest share of log2(tokens) that the entropy of clean text of a known language has."""
    from math import log2
    return min(ENTROPY_SHORT, ENTROPY_AT_ONE - ENTROPY_FALL * log2(tokens))


def judge(chars: int, tokens: int, byte_tokens: int, entropy: float, band: tuple, known: bool = True,
          codes: tuple = (0, 0)) -> bool:
    """True if the fertility lies outside the band. ``codes`` are the characters and tokens
    of forgiven words; a text of nothing else is judged whole. ``known`` languages also
    have a least entropy by length."""
    from math import log2, sqrt
    if not tokens:
        return True
    low, high, most_bytes, least_entropy = band
    slack = FORGIVEN / tokens                      # the whole text, as if the codes were plain
    each = chars / tokens
    if each < low - slack or each > high + slack:
        return True
    c, t = (chars - codes[0], tokens - codes[1]) if codes[1] < tokens else (chars, tokens)
    error = ERRORS * DEVIATION / sqrt(t)           # the text without its codes
    if c / t < low - min(error, low / 2) or c / t > high + error:
        return True
    # a share that no text could exceed would be no limit, so at most half the way to it
    wide = min(slack, sqrt(CHAR_BYTES * most_bytes * (1 - most_bytes) / tokens), (1 - most_bytes) / 2)
    if byte_tokens / tokens > most_bytes + wide:
        return True
    spread = entropy / log2(tokens) if tokens > 1 else 1.0
    return spread < (max(least_entropy, least_spread(tokens)) if known else least_entropy)


def measure(texts: list, langs: list, model: str) -> list[tuple]:
    """Rows of METRICS for whole texts."""
    vocabulary = Fertility.of(model)
    split = [t.encode("utf-8", "surrogatepass").split() for t in texts]
    vocabulary.learn({w for words in split for w in words})
    out = []
    for text, lang, words in zip(texts, langs, split):
        chars = len(text) - sum(map(text.count, BLANKS))
        repeats = repeat_words(words)
        tokens, by_byte, entropy = vocabulary.measure(words)
        failed = len(words) < MIN_WORDS or 100 * repeats > MAX_REPEAT_PCT * len(words)
        band = BANDS.get(lang) or SCRIPT_BANDS[script_of(text)]
        odd = judge(chars, tokens, by_byte, entropy, band, lang in BANDS, vocabulary.forgiven(words))
        out.append((len(words), chars, sum(map(text.count, SYMBOLS)), duplicate_lines(text), repeats,
                    tokens, chars / tokens if tokens else 0.0, by_byte / tokens if tokens else 0.0, entropy,
                    failed, odd, not failed and not odd))
    return out


def score(docs: DataFrame, model: str = f"{TOKENIZER_DIR}/piece_bpe_32k.model") -> DataFrame:
    """``doc_id`` and METRICS of every row, whatever else the table carries.

    Null text counts as empty (no words: fails). Unknown or null languages are judged
    by script. Repeated rows are each answered; an empty table gives an empty result."""
    src = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang")
    schema = f"doc_id {src.schema['doc_id'].dataType.simpleString()}, {METRICS}"

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from ledgerhawk.llm.quality import METRICS as names
        from ledgerhawk.llm.quality import measure as of
        names = [x.split()[0] for x in names.split(", ")]
        for b in rows_of(batches, 1024):
            rows = of(b.column(1).to_pylist(), b.column(2).to_pylist(), model)
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, zip(*rows))], ["doc_id", *names])

    return src.mapInArrow(run, schema)


def keep(docs: DataFrame, model: str = f"{TOKENIZER_DIR}/piece_bpe_32k.model") -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns; one pass, no shuffle."""
    text, lang = docs.columns.index("text"), docs.columns.index("lang")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from ledgerhawk.llm.quality import measure as of
        for b in rows_of(batches, 1024):
            rows = of([t or "" for t in b.column(text).to_pylist()], b.column(lang).to_pylist(), model)
            yield b.filter(pa.array([r[-1] for r in rows]))

    return docs.mapInArrow(run, docs.schema)


def op6(spark, sf_dir: str) -> DataFrame:
    """Contract digest of ``score`` over whole ``documents``."""
    return score(table(spark, sf_dir, "documents")).drop("fertility_failed")


BASE_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT rid, i, w[i:i+4] AS k FROM (SELECT rid, w, unnest(generate_series(1, len(w) - 4)) AS i FROM d WHERE len(w) >= 6)),
twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS n FROM win) WHERE n > 1),
rep AS (
  SELECT rid, count(DISTINCT i + o) AS n FROM twice, (SELECT unnest(generate_series(0, 4)) AS o) GROUP BY rid),
lines AS (
  SELECT rid, sum(n - 1) AS n FROM (
    SELECT rid, line, count(*) AS n FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid, line) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
       length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
       coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
       (len(w) < 10 OR 100 * coalesce(rep.n, 0) > 20 * len(w)) AS base_failed
FROM d LEFT JOIN lines USING (rid) LEFT JOIN rep USING (rid)
"""
