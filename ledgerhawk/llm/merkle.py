"""Merkle manifest of a dataset, with a proof for every row.

Leaves are hashed in the scan. The rows of a group are put in order and cut into
superblocks of ``BLOCK`` leaves, a power of the tree's arity, so a superblock's leaves
reduce to one node by themselves; those nodes are the leaves of the next, ``BLOCK`` times
smaller tree, and so on up to one node a group, and from the groups' nodes to the root.
On the way back every superblock is cogrouped with the one row that it needs from outside,
the path from its node to the root: the Python function reduces the superblock again, joins
its inner proofs with that path and folds the leaves to be checked, all at once. No task
holds more than ``BLOCK`` nodes and one path, and no more than hashes are ever shuffled.

A path is text: a part for each level from below, joined by commas; a part is the node's
place in its run (0 to 2) and then the run's other nodes in hexadecimal, left to right.
"""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerhawk.llm.common import stored, table
from ledgerhawk.llm.ranked import ranked

# --- fixed values: arity of the tree, length of a digest in hexadecimal, null's mark, fields of a leaf
ARITY, HEX = 3, 64
NULL = "-"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# ----------------------------------------------------------
LEVELS = 8                                  # levels of a superblock
BLOCK = ARITY ** LEVELS


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf(*fields: Column) -> Column:
    """Hash of a row: each field as its byte count, a colon and the value, or null's mark."""
    parts = [F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")), F.lit(NULL)) for f in fields]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def reduce_block(nodes: list, first: bool) -> list:
    """All levels of a superblock, from its leaves up. The first superblock of a group goes
    up until one node is left, which is less than ``LEVELS`` only if it is the group's
    only one; a later one always goes up ``LEVELS`` levels, be it a single leaf."""
    levels = [nodes]
    while len(levels[-1]) > 1 if first else len(levels) <= LEVELS:
        below = levels[-1]
        levels.append([digest("".join(below[i:i + ARITY])) for i in range(0, len(below), ARITY)])
    return levels


def inner_path(levels: list, at: int) -> list:
    """Parts of the path from leaf ``at`` to the top of its superblock."""
    parts = []
    for nodes in levels[:-1]:
        run = at - at % ARITY
        parts.append(f"{at % ARITY}" + "".join(nodes[i] for i in range(run, min(run + ARITY, len(nodes))) if i != at))
        at //= ARITY
    return parts


def fold(node: str, path: str) -> str:
    """The root that a node and a path lead to."""
    for part in path.split(",") if path else ():
        cut = 1 + int(part[0]) * HEX
        node = digest(part[1:cut] + node + part[cut:])
    return node


def siblings(path: str) -> str:
    """All sibling nodes of a path, one after another."""
    return "".join(part[1:] for part in path.split(","))


def tops(nodes: DataFrame) -> list[DataFrame]:
    """Levels of superblocks over ``grp, pos, node``: the nodes themselves, the tops of
    their superblocks, and so on until every group has one node. Each is stored."""

    def up(key, rows):
        import pandas as pd
        levels = reduce_block(rows.sort_values("pos")["node"].tolist(), key[1] == 0)
        return pd.DataFrame({"grp": [key[0]], "pos": [key[1]], "node": [levels[-1][0]]})

    out = [nodes]
    while True:
        block = F.floor(F.col("pos") / BLOCK).cast("long").alias("block")
        out.append(stored(out[-1].groupBy("grp", block).applyInPandas(up, "grp string, pos long, node string"), "merkle-up"))
        if not out[-1].where("pos > 0").head(1):
            return out


PATH = "grp string, pos long, path string, subroot string, root string"


def _exchange(nodes: DataFrame, outer: DataFrame, fn, schema: str) -> DataFrame:
    """Superblocks of ``nodes`` cogrouped with the row of ``outer`` that is theirs."""
    own = nodes.withColumn("block", F.floor(F.col("pos") / BLOCK).cast("long")).groupBy("grp", "block")
    return own.cogroup(outer.withColumnRenamed("pos", "block").groupBy("grp", "block")).applyInPandas(fn, schema)


def _joined(first: bool, rows, above):
    """The rows of a superblock in order, with their whole paths."""
    rows, rest = rows.sort_values("pos"), above["path"].iloc[0]
    levels = reduce_block(rows["node"].tolist(), first)
    return rows, [",".join([*inner_path(levels, i), *([rest] if rest else [])]) for i in range(len(rows))]


def descend(levels: list[DataFrame], outer: DataFrame) -> DataFrame:
    """Paths of the lowest of ``levels`` but one, from those of the topmost."""

    def down(key, rows, above):
        import pandas as pd
        rows, own = _joined(key[1] == 0, rows, above)
        return pd.DataFrame({"grp": rows["grp"], "pos": rows["pos"], "path": own, "subroot": above["subroot"].iloc[0], "root": above["root"].iloc[0]})

    for nodes in levels[-2:0:-1]:
        outer = stored(_exchange(nodes, outer, down, PATH), "merkle-down")
    return outer


def manifest(leaves: DataFrame, id_col: str = "doc_id", group_col: str = "source") -> DataFrame:
    """``doc_id, leaf, subroot, root, proof, folded_root`` for every row of ``leaves``:
    an id, a text group, ``leaf`` and ``claimed``, hashes in hexadecimal. ``proof`` is the
    path to the root over the group's ``subroot``; ``folded_root`` is where it leads from
    ``claimed``, so a row is as it was if that is ``root``.

    A group's rows are in order of id (null first), rows with one id in order of leaf; equal
    rows are leaves of their own. Null is a group like another and the first. An empty
    table gives an empty result. Other columns are not read."""
    kind = leaves.schema[id_col].dataType.simpleString()
    # null to "", any other name behind a mark: their order stays, and keys are never null
    group = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    rows = stored(leaves.select(F.col(id_col).alias("doc_id"), group.alias("grp"), F.col("leaf").alias("node"), "claimed"), "merkle-leaves")
    placed = stored(ranked(rows, "grp", ["doc_id", "node"], "merkle-order"), "merkle-placed")
    inner = tops(placed.select("grp", "pos", "node"))
    names = stored(inner[-1].select(F.lit("").alias("grp"), "node", F.col("grp").alias("name")), "merkle-names")
    order = stored(ranked(names, "grp", ["name"], "merkle-order"), "merkle-groups")
    over = tops(order.select("grp", "pos", "node"))

    def to_groups(key, rows, above):
        import pandas as pd
        rows, own = _joined(key[1] == 0, rows, above)
        return pd.DataFrame({"grp": rows["name"], "pos": 0, "path": own, "subroot": rows["node"], "root": above["root"].iloc[0]})

    def to_leaves(key, rows, above):
        import pandas as pd
        rows, own = _joined(key[1] == 0, rows, above)
        return pd.DataFrame({"doc_id": rows["doc_id"], "leaf": rows["node"], "subroot": above["subroot"].iloc[0], "root": above["root"].iloc[0],
                             "proof": own, "folded_root": [fold(n, p) for n, p in zip(rows["claimed"], own)]})

    top = over[-1].select("grp", "pos", F.lit("").alias("path"), F.lit("").alias("subroot"), F.col("node").alias("root"))
    groups = stored(_exchange(order, descend(over, top), to_groups, PATH), "merkle-down")
    out = f"doc_id {kind}, leaf string, subroot string, root string, proof string, folded_root string"
    return _exchange(placed, descend(inner, groups), to_leaves, out)


def tampered(docs: DataFrame, fields=FIELDS) -> DataFrame:
    """``docs`` with ``leaf`` and ``claimed``: the hash of a row as it is and as it is found
    later. Every other row, by the checksum of its id, has lost its text's line ends."""
    text = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace(F.col("text"), F.lit("\n"), F.lit(""))) \
        .otherwise(F.col("text"))
    cols = [F.col(f) for f in fields]
    return docs.select("doc_id", "source", leaf(*cols).alias("leaf"),
                       leaf(*[text if f == "text" else c for f, c in zip(fields, cols)]).alias("claimed"))


def op12(spark, sf_dir: str) -> DataFrame:
    """The manifest of the documents, with every other document tampered with."""
    done = manifest(tampered(table(spark, sf_dir, "documents")))
    return done.select("doc_id", "leaf", "subroot", "root", F.sha2(F.regexp_replace("proof", "(^|,)[0-9]", "").cast("binary"), 256).alias("proof_sha256"),
                       "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _tree(name: str, leaves: str) -> str:
    """Nodes of a tree per ``grp``, level by level; ``n`` nodes are on a node's level."""
    return f"""{name} AS (
  SELECT grp, 0 AS lvl, pos, node, count(*) OVER (PARTITION BY grp) AS n FROM {leaves}
  UNION ALL
  SELECT grp, lvl + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), any_value((n + 2) // 3) FROM {name} WHERE n > 1 GROUP BY grp, lvl, pos // 3),
{name}_runs AS (
  SELECT grp, lvl, pos, coalesce(string_agg(node, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
    coalesce(string_agg(node, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b
  FROM {name} WHERE n > 1 WINDOW w AS (PARTITION BY grp, lvl, pos // 3 ORDER BY pos)),
{name}_tops AS (SELECT grp, lvl, node FROM {name} WHERE n = 1)"""


def _climb(name: str, tree: str, start: str) -> str:
    """Rows of ``start`` (row, grp, pos, node, proof) folded up to the top of their tree."""
    return f"""{name}_steps AS (
  SELECT row, grp, 0 AS lvl, pos, node, proof FROM {start}
  UNION ALL
  SELECT s.row, s.grp, s.lvl + 1, s.pos // 3, sha256(concat(r.a, s.node, r.b)), concat(s.proof, r.a, r.b)
  FROM {name}_steps s JOIN {tree}_runs r ON s.grp = r.grp AND s.lvl = r.lvl AND s.pos = r.pos),
{name} AS (SELECT s.row, s.grp, s.node, s.proof, t.node AS top FROM {name}_steps s JOIN {tree}_tops t ON s.grp = t.grp AND s.lvl = t.lvl)"""


def _field(value: str, text: str) -> str:
    return f"coalesce(strlen({text}) || ':' || {value}, '-')"


ORACLE = f"""WITH RECURSIVE doc AS (
  SELECT row_number() OVER () AS row, *, xor(4294967295, list_reduce(list_prepend(4294967295,
      list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, c: list_reduce([xor(crc, c), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))) AS crc FROM documents),
found AS (
  SELECT *, CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS later,
    concat({_field("doc_id", "CAST(doc_id AS VARCHAR)")}, {_field("source", "source")}, {_field("lang", "lang")},
           {_field("n_chars", "CAST(n_chars AS VARCHAR)")}) AS head FROM doc),
placed AS (
  SELECT row, doc_id, coalesce('=' || source, '') AS grp, node, claimed,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, node, row) - 1 AS pos
  FROM (SELECT *, sha256(concat(head, {_field("text", "text")})) AS node, sha256(concat(head, {_field("later", "later")})) AS claimed FROM found) f),
{_tree("own", "placed")},
groups AS (SELECT '' AS grp, grp AS name, node, row_number() OVER (ORDER BY encode(grp)) - 1 AS pos FROM own_tops),
{_tree("over", "groups")},
first_nodes AS (SELECT row, grp, pos, claimed AS node, '' AS proof FROM placed),
{_climb("inside", "own", "first_nodes")},
second_nodes AS (SELECT i.row, '' AS grp, g.pos, i.node, i.proof FROM inside i JOIN groups g ON i.grp = g.name),
{_climb("outside", "over", "second_nodes")}
SELECT p.doc_id, p.node AS leaf, i.top AS subroot, o.top AS root, sha256(o.proof) AS proof_sha256, o.node AS folded_root, o.node = o.top AS verified
FROM placed p JOIN inside i ON p.row = i.row JOIN outside o ON p.row = o.row"""
