"""Personal data by candidate gradient boosting, in column expressions only.

Four base patterns with validity checks are always reported. Beside them high-recall
generators propose further, overlapping spans (spelled-out addresses, numbers without a
plus sign, defanged addresses, long codes after a key word). Boosted trees score every
proposal from its format and its context; a threshold per kind, calibrated for precision
on the proposals of all documents that the trees have not seen, selects. Proposals that touch a base span give way to
it; among the rest the better score wins, then the earlier and the longer.

The trees are trained on a bounded sample (``TRAIN_DOCS`` documents, chosen by a hash of
the text over the whole table) with labels the checks themselves give: valid matches and their rewritten variants against proposals
that fail the checks and plain words. Scanning and scoring cover every whole text and
need no shuffle: the trees become one CASE expression inside the scan.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerhawk.llm.common import stored, table

# --- fixed values: base kinds in their order, patterns of the contract
KINDS = ("email", "ip", "card", "phone", "secret")
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# the same matches, started only where a leftmost match can start and without
# backtracking into what has been read
FAST = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GUARD = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){13}", "phone": r"\+[0-9]"}
# high-recall proposals; a kind may be proposed in several ways
PROPOSALS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:\(at\)|\[at\]|\{at\}|@) ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]|\{dot\}) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:(?:\[\.\]|\.)[0-9]{1,3}){3}(?![0-9.])",
    "card": r"(?<![0-9])[0-9]{4}(?:[ .\x2d]?[0-9]){8,15}(?![0-9])",
    "phone": r"(?<![0-9+])(?:\([0-9]{2,4}\)|[0-9]{2,4})[ ./\x2d]?[0-9]{3,4}[ ./\x2d][0-9]{3,4}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9])[A-Za-z0-9+/_\x2d]{20,}(?![A-Za-z0-9])",
}
PROPOSAL_GUARD = {
    "email": r"@|\(at\)|\[at\]|\{at\}", "ip": r"[0-9]{1,3}(?:\[\.\]|\.)[0-9]{1,3}(?:\[\.\]|\.)[0-9]",
    "card": r"[0-9]{4}(?:[ .\x2d]?[0-9]){8}", "phone": r"[0-9]{3,4}[ ./\x2d][0-9]{3,4}",
    "secret": r"[A-Za-z0-9+/_\x2d]{20}",
}
CUES = {
    "email": "(?i)(mail|contact|write)", "ip": "(?i)(ip|host|server|address)", "card": "(?i)(card|visa|pay|iban)",
    "phone": "(?i)(phone|tel|call|mobile|fax)", "secret": "(?i)(token|key|secret|passw|auth|credential)",
}
# ---------------------------------------------------------------------

TRAIN_DOCS = 4_000       # documents the trees may be fitted on, whatever the table's size
TREES, DEPTH = 10, 4
PRECISION = 0.98         # wanted among the selected proposals of a kind
CONTEXT = 20


def _octets(m: Column) -> Column:
    return F.regexp_like(m, F.lit(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])$"))


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(d: Column) -> Column:
    return F.coalesce(F.call_function("luhn_check", d), F.lit(False))


def valid(kind: str, m: Column) -> Column:
    """The contract's check of a base match."""
    n = F.length(digits(m))
    return {"email": F.lit(True), "ip": _octets(m),
            "card": F.when(n.between(14, 19), luhn(digits(m))).otherwise(F.lit(False)),
            "phone": n.between(10, 15)}[kind]


SPAN = "array<struct<start:int,kind:int,end:int,match:string>>"


def matches(text: Column, kind: str, pattern: str, guard: str) -> Column:
    """Leftmost non-overlapping matches as structs ``start, kind, end, match`` in code
    points: the pieces between the matches give the offsets."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(acc, x):
        at = acc["at"] + F.length(x["between"])
        end = at + F.length(x["found"])
        one = F.struct(at.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"), x["found"].alias("match"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    pairs = F.arrays_zip(found.alias("found"), F.slice(between, 1, F.size(found)).alias("between"))
    spans = F.aggregate(pairs, start, step)["out"]
    return F.when(F.regexp_like(text, F.lit(guard)), spans).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> Column:
    """Valid base spans, by start and then kind."""
    def passing(kind: str) -> Column:
        return F.filter(matches(text, kind, FAST[kind], GUARD[kind]), lambda x: valid(kind, x["match"]))

    return F.array_sort(F.concat(*map(passing, BASE)))


FEATURES = ("kind", "length", "digits", "letters", "groups", "luhn", "octets", "at", "spelled", "cue",
            "quoted", "uppers", "glued_left", "glued_right", "dots", "assigned")


def features(kind: Column, m: Column, left: Column, right: Column) -> list[Column]:
    """Format of the span and what stands around it, as numbers."""
    def count(pattern: str) -> Column:
        return F.length(m) - F.length(F.regexp_replace(m, pattern, ""))

    def yes(c: Column) -> Column:
        return F.when(c, 1).otherwise(0)

    cue = F.lit(False)
    for i, k in enumerate(KINDS):
        cue = cue | ((kind == i) & F.regexp_like(left, F.lit(CUES[k])))
    d = digits(m)
    return [kind, F.length(m), count("[0-9]"), count("[A-Za-z]"),
            F.size(F.split(m, "[^A-Za-z0-9]+", -1)), yes(luhn(d)), yes(_octets(F.regexp_replace(m, r"[\[\]]", ""))),
            count("@"), yes(F.regexp_like(m, F.lit(r"[\[({](at|dot)[\])}]|\[\.\]"))), yes(cue),
            yes(F.regexp_like(left, F.lit("[\"']$")) & F.regexp_like(right, F.lit("^[\"']"))), count("[A-Z]"),
            yes(F.regexp_like(left, F.lit(r"[\p{L}0-9]$"))), yes(F.regexp_like(right, F.lit(r"^[\p{L}0-9]"))),
            count(r"\."), yes(F.regexp_like(left, F.lit("[=:]\\s*[\"']?$")))]


def proposals(text: Column, base: Column) -> Column:
    """Proposed spans that touch no base span, with their contexts."""
    raw = F.concat(*[matches(text, k, PROPOSALS[k], PROPOSAL_GUARD[k]) for k in PROPOSALS])
    free = F.filter(raw, lambda x: ~F.exists(base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    low = lambda x: F.greatest(x["start"] - CONTEXT, F.lit(0))
    return F.transform(free, lambda x: F.struct(
        x["start"], x["kind"], x["end"], x["match"],
        F.substring(text, low(x) + 1, x["start"] - low(x)).alias("left"),
        F.substring(text, x["end"] + 1, F.lit(CONTEXT)).alias("right")))


def _hinted(text: Column) -> Column:
    return F.regexp_like(text, F.lit("[0-9@]"))


def _sampled(docs: DataFrame) -> Column:
    """Whether a text is in the sample: its hash lies under the share that gives at most
    ``TRAIN_DOCS`` distinct texts (five deviations off), wherever the rows stand."""
    n = docs.where(_hinted(F.col("text"))).count()
    if n <= TRAIN_DOCS:
        return _hinted(F.col("text"))
    share = max(1.0, TRAIN_DOCS - 5 * TRAIN_DOCS ** 0.5) / n
    return _hinted(F.col("text")) & (F.pmod(F.xxhash64("text"), F.lit(1 << 40)) < int(share * (1 << 40)))


def _fine() -> Column:
    """Label of a proposal ``kind, match, left`` by the checks."""
    m = F.col("match")
    code = (F.col("kind") == 4) & F.regexp_like("match", F.lit("[0-9]")) & F.regexp_like("match", F.lit("[A-Za-z]")) \
        & F.regexp_like("left", F.lit(CUES["secret"]))
    return code | ((F.col("kind") == 0) & F.regexp_like("match", F.lit(r"[\[({]at"))) | \
        ((F.col("kind") == 1) & F.regexp_like("match", F.lit(r"\[\.\]")) & _octets(F.regexp_replace(m, r"[\[\]]", ""))) | \
        ((F.col("kind") == 2) & luhn(digits(m))) | \
        ((F.col("kind") == 3) & F.regexp_like("left", F.lit(CUES["phone"])))


def _held() -> Column:
    return F.pmod(F.xxhash64("match", "left", "right"), F.lit(3)) == 0


def _training(docs: DataFrame, sampled: Column) -> DataFrame:
    """Labelled spans ``kind, match, left, right, label, held`` of the sample."""
    sample = docs.where(sampled).select("text").distinct()
    base = base_spans(F.col("text"))
    rows = sample.withColumn("base", base).withColumn("more", proposals(F.col("text"), F.col("base")))
    low = lambda x: F.greatest(x["start"] - CONTEXT, F.lit(0))
    text = F.col("text")
    good = rows.select(F.explode(F.transform("base", lambda x: F.struct(
        x["kind"], x["match"], F.substring(text, low(x) + 1, x["start"] - low(x)).alias("left"),
        F.substring(text, x["end"] + 1, F.lit(CONTEXT)).alias("right")))).alias("x")).select("x.*")
    m = F.col("match")
    spelled = F.when(F.col("kind") == 0, F.regexp_replace(F.regexp_replace(m, "@", " [at] "), r"\.", " [dot] ")) \
        .when(F.col("kind") == 1, F.regexp_replace(m, r"\.", "[.]")) \
        .when(F.col("kind") == 2, F.regexp_replace(digits(m), "([0-9]{4})(?=[0-9])", "$1.")) \
        .otherwise(F.regexp_replace(m, r"^\+[0-9]{1,3} ?", ""))
    good = good.unionByName(good.withColumn("match", spelled))
    rest = rows.select(F.explode("more").alias("x")).select("x.kind", "x.match", "x.left", "x.right")
    words = rows.select(F.explode(F.slice(F.split("text", " ", -1), 1, 20)).alias("match")).where("match != ''") \
        .select((F.abs(F.hash("match")) % len(KINDS)).alias("kind"), "match", F.lit(" ").alias("left"), F.lit(" ").alias("right"))
    every = good.withColumn("label", F.lit(1.0)) \
        .unionByName(rest.withColumn("label", F.when(_fine(), 1.0).otherwise(0.0))) \
        .unionByName(words.withColumn("label", F.lit(0.0)))
    return every.withColumn("held", _held())


def _unseen(docs: DataFrame, sampled: Column) -> DataFrame:
    """Labelled proposals ``kind, match, left, right, label`` of all documents but those
    the trees are fitted on."""
    text = F.col("text")
    rows = docs.select("text", sampled.alias("sampled")).withColumn("base", base_spans(text)) \
        .withColumn("more", proposals(text, F.col("base")))
    return rows.select("sampled", F.explode("more").alias("x")).select("sampled", "x.kind", "x.match", "x.left", "x.right") \
        .where(~F.col("sampled") | _held()).withColumn("label", F.when(_fine(), 1.0).otherwise(0.0))


class Trees:
    """Boosted trees as nested conditions and a least score per kind."""

    def __init__(self, trees: list, weights: list, least: dict):
        self.trees, self.weights, self.least = trees, weights, least

    def score(self, x: list[Column]) -> Column:
        """Estimated probability from the additive margin."""
        margin = F.lit(0.0)
        for tree, w in zip(self.trees, self.weights):
            margin = margin + F.lit(w) * self._tree(tree, x)
        return 1.0 / (1.0 + F.exp(-2.0 * margin))

    def _tree(self, t, x: list[Column]) -> Column:
        if not isinstance(t, tuple):
            return F.lit(float(t))
        feature, cut, low, high = t
        return F.when(x[feature] <= F.lit(cut), self._tree(low, x)).otherwise(self._tree(high, x))

    def selects(self, kind: Column, score: Column) -> Column:
        """Kinds without a threshold that reached the wanted precision select nothing."""
        out = F.lit(False)
        for k, low in self.least.items():
            out = out | ((kind == k) & (score >= low))
        return out


def _parse(text: str) -> list:
    """Trees from the public text form of a fitted model."""
    lines = [ln.strip() for ln in text.splitlines()]
    trees, at = [], 0

    def node():
        nonlocal at
        line = lines[at]
        at += 1
        if m := re.match(r"Predict: (\S+)", line):
            return float(m[1])
        m = re.match(r"If \(feature (\d+) <= (\S+)\)", line)
        low = node()
        at += 1                                   # the Else line
        return int(m[1]), float(m[2]), low, node()

    while at < len(lines):
        if lines[at].startswith("Tree "):
            at += 1
            trees.append(node())
        else:
            at += 1
    return trees


def train(docs: DataFrame) -> Trees:
    """Fit on the sample and calibrate on all documents; without both labels in the sample
    nothing beyond base spans is selected."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector
    sampled = _sampled(docs)
    labelled = _training(docs, sampled)
    x = features(F.col("kind"), F.col("match"), F.col("left"), F.col("right"))
    numbers = F.array(*[c.cast("double") for c in x]).alias("x")
    rows = stored(labelled.where("not held").select("kind", "label", numbers), "pii-train").coalesce(2)
    have = {r[0]: r[1] for r in rows.groupBy("label").count().collect()}
    if len(have) < 2:
        return Trees([], [], {})
    fit = rows.select("label", array_to_vector("x").alias("features"))
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, cacheNodeIds=False, maxBins=32).fit(fit)
    made = Trees(_parse(model.toDebugString), list(model.treeWeights), {})
    scored = _unseen(docs, sampled).select("kind", "label", (F.floor(made.score(x) * 100) / 100).alias("s"))
    table_of: dict = {}
    for k, s, good, n in scored.groupBy("kind", "s").agg(F.sum("label"), F.count("*")).collect():   # at most 101 a kind
        table_of.setdefault(int(k), []).append((s, good, n))
    for k, parts in table_of.items():
        good = n = 0.0
        for s, g, c in sorted(parts, reverse=True):
            good, n = good + g, n + c
            if s >= 0.5 and good >= PRECISION * n:
                made.least[k] = s - 1e-9               # scores are cut down to their step, so all of it is selected
    return made


def detect(docs: DataFrame, model: Trees | None = None) -> DataFrame:
    """``doc_id, text, base, more``: base spans and the selected further spans, each
    ``start, kind, end, match``, of every row; no shuffle. Null text counts as empty."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return _with_spans(docs, model or train(docs), F.col("text"))


def _with_spans(docs: DataFrame, model: Trees, text: Column) -> DataFrame:
    out = docs.withColumn("base", base_spans(text))
    if not model.least:
        return out.withColumn("more", F.array().cast(SPAN))
    out = out.withColumn("more", proposals(text, F.col("base")))
    rated = F.transform("more", lambda x: F.struct(
        model.score(features(x["kind"], x["match"], x["left"], x["right"])).alias("score"),
        x["start"], x["kind"], x["end"], x["match"]))
    out = out.withColumn("more", rated)
    chosen = F.filter("more", lambda x: model.selects(x["kind"], x["score"]))
    out = out.withColumn("more", chosen)

    def beats(y, x):                                  # a total order, so one of two overlapping spans goes
        longer = (y["end"] - y["start"]) > (x["end"] - x["start"])
        same = (y["end"] - y["start"]) == (x["end"] - x["start"])
        tie = longer | (same & ((y["start"] < x["start"]) | ((y["start"] == x["start"]) & (y["kind"] < x["kind"]))))
        return (y["score"] > x["score"]) | ((y["score"] == x["score"]) & tie)

    kept = F.filter("more", lambda x: ~F.exists("more", lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"]) & beats(y, x)))
    return out.withColumn("more", F.transform(kept, lambda x: F.struct(x["start"], x["kind"], x["end"], x["match"])))


def listed(spans: Column) -> Column:
    """``kind:start:end`` joined by commas, in the order of the array."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, the digest of the base spans and the list of all spans."""
    def count(i: int) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == i)).cast("long")

    counts = [count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:4])]
    return found.select("doc_id", *counts, F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        listed(F.array_sort(F.concat("base", "more"))).alias("spans"))


def redact(docs: DataFrame, model: Trees | None = None) -> DataFrame:
    """``docs`` with every reported span of ``text`` replaced by ``[kind]``; overlapping
    base spans become one, named by the first. Null text stays null, n_chars follows."""
    model = model or train(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    text = F.coalesce("text", F.lit(""))
    work = _with_spans(docs.withColumnsRenamed({c: f"_in_{c}" for c in docs.columns if c in ("base", "more")}), model, text)
    spans = F.array_sort(F.concat("base", "more"))
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, x):
        ahead = F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["start"] - acc["at"]), F.element_at(names, x["kind"] + 1))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"),
                        F.when(x["start"] >= acc["at"], ahead).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    work = work.withColumn("text", F.when(F.size(spans) > 0, done).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        work = work.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
                               .otherwise(F.col("n_chars")))
    work = work.drop("base", "more").withColumnsRenamed({f"_in_{c}": c for c in ("base", "more") if c in docs.columns})
    return work.select(*[f"`{c}`" for c in docs.columns])


def op3(spark, sf_dir: str) -> DataFrame:
    """Contract digest of ``detect`` over whole ``documents``."""
    return digest(detect(table(spark, sf_dir, "documents")))
