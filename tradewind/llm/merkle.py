"""Merkle manifest of a table: a digest of every row, one root, and each row's proof of belonging.

Rows form one binary tree per value of a column; the subroots form a tree of their own. A tree is cut into superblocks
of 2^height consecutive nodes. Going up, each superblock becomes one node of the next level, until a level has a single
superblock. Going down, the nodes of a level and the proofs of their superblocks - the outer nodes that they need - are
cogrouped by superblock; one call reduces the superblock again, joins both halves of each proof and folds it. No task
holds more than a superblock, and no level but the last has less than 2^height times fewer nodes than the one below.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.ranks import numbered
from tradewind.llm.shared import discard, save

HEIGHT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
HEX = 64

_NODE = "tree string, pos long, digest string"
_PROOF = "tree string, block long, proof string, sides string"
_LEAF = "doc_id long, leaf string, subroot string, root string, proof string, sides string, folded_root string"


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 length, a colon and the value, so that no two rows read alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _h(text: str) -> str:
    return sha256(text.encode("ascii")).hexdigest()


def _levels(digests: list[str], height: int | None) -> list[list[str]]:
    """All levels of one superblock: up to ``height``, or (None) up to its single node."""
    levels = [digests]
    while len(levels) <= height if height is not None else len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([_h("".join(last[i : i + 2])) for i in range(0, len(last), 2)])
    return levels


def _grown(nodes: pd.DataFrame, block: int, height: int) -> list[list[str]]:
    """Levels of a superblock. The first one of a tree that is not full is the whole tree; later ones are always raised
    to the full height; a full first one ends at that height either way."""
    return _levels(nodes.sort_values("pos")["digest"].tolist(), height if block else None)


def _proofs(levels: list[list[str]]) -> Iterator[tuple[str, str]]:
    """(siblings, sides) of each node from the lowest level up; a side is l, r or - (no sibling)."""
    for i in range(len(levels[0])):
        siblings, sides = [], []
        for level in levels[:-1]:
            if i ^ 1 < len(level):
                siblings.append(level[i ^ 1])
                sides.append("l" if i & 1 else "r")
            else:
                sides.append("-")
            i >>= 1
        yield "".join(siblings), "".join(sides)


def fold(digest: str, proof: str, sides: str) -> str:
    """The root that a node and its proof lead to."""
    at = 0
    for side in sides:
        other = proof[at : at + HEX] if side != "-" else ""
        at += len(other)
        digest = _h(other + digest if side == "l" else digest + other)
    return digest


def _up(nodes: DataFrame, height: int) -> list[DataFrame]:
    """Stored levels of superblock nodes above ``nodes``; the last one has one node per tree."""

    def reduce(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "digest": [_grown(rows, key[1], height)[-1][0]]})

    levels = []
    while not levels or levels[-1].agg(F.max("pos")).first()[0]:
        below = levels[-1] if levels else nodes
        block = F.shiftright("pos", height).alias("block")
        levels.append(save(below.select("tree", "pos", "digest").groupBy("tree", block).applyInPandas(reduce, _NODE), "merkle-level"))
    return levels


def _down(nodes: DataFrame, outer: DataFrame, height: int) -> DataFrame:
    """Proofs of ``nodes`` up to the root, from those of their superblocks."""

    def join(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows, top = rows.sort_values("pos"), above.iloc[0]
        found = list(_proofs(_grown(rows, key[1], height)))
        return pd.DataFrame(
            {"tree": rows["tree"], "block": rows["pos"], "proof": [p + top.proof for p, _ in found], "sides": [s + top.sides for _, s in found]}
        )

    by = ("tree", F.shiftright("pos", height))
    return nodes.groupBy("tree", by[1].alias("block")).cogroup(outer.groupBy("tree", "block")).applyInPandas(join, _PROOF)


def _proven(levels: list[DataFrame], outer: DataFrame, height: int) -> DataFrame:
    """Proofs of the lowest stored level's nodes; ``outer``: those of the single node of each tree."""
    for below in reversed(levels[:-1]):
        outer = save(_down(below, outer, height), "merkle-proofs")
    return outer


def manifest(
    docs: DataFrame,
    claimed: Column | None = None,
    fields: tuple[str, ...] = FIELDS,
    id_col: str = "doc_id",
    tree_col: str = "lang",
    height: int = HEIGHT,
) -> DataFrame:
    """One row per input row: doc_id, leaf, subroot, root, proof, sides, folded_root, verified.

    leaf: SHA-256 of ``fields``, in this order. Per ``tree_col``, leaves ascend by ``id_col`` (null first, equal ids by
    leaf); every two consecutive nodes become one, a last single one alone. subroot: what remains; subroots by
    ``tree_col`` (null first) likewise give root. proof: siblings from the leaf up to the root, joined; sides: for each
    level l, r or - (no sibling). folded_root: what the proof leads to from ``claimed`` (a leaf that somebody else
    states; null or left out: the row's own). verified: folded_root is the root.

    Nulls are values of their own. Empty and very long texts: one digest each; texts are read once and not shuffled.
    Repeated rows: a leaf each, with equal digests and own proofs. Empty table: empty result. Other columns, whatever
    their names, are not read.
    """
    if not 1 <= height <= 16:
        raise ValueError("height must be from 1 to 16")
    own = leaf([F.col(c) for c in fields])
    tree = F.coalesce(F.concat(F.lit("="), F.col(tree_col).cast("string")), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), tree.alias("tree"), own.alias("digest"), (F.lit(None).cast("string") if claimed is None else claimed).alias("claim"))
    rows = save(rows, "merkle-leaves")
    placed = numbered(rows, ["tree", "doc_id", "digest"], "at", start=0)
    # The trees are as many as the column has values: stored, so that the join goes by a known size.
    first = save(placed.groupBy("tree").agg(F.min("at").alias("first")), "merkle-first")
    nodes = save(placed.join(first, "tree").select("doc_id", "tree", (F.col("at") - F.col("first")).alias("pos"), "digest", "claim"), "merkle-nodes")
    discard(rows, first)

    levels = _up(nodes, height)
    # The subroots are the leaves of one more tree.
    subroots = save(numbered(levels[-1].select(F.col("tree").alias("of"), "digest"), ["of"], "pos", start=0).withColumn("tree", F.lit("")), "merkle-subroots")
    forest = _up(subroots, height)
    top = forest[-1].first()
    root = top.digest if top else ""
    start = forest[-1].select("tree", F.lit(0).cast("long").alias("block"), F.lit("").alias("proof"), F.lit("").alias("sides"))
    proofs = _down(subroots, _proven(forest, start, height), height).withColumnRenamed("block", "pos").drop("tree")
    trees = subroots.select(F.col("of").alias("tree"), "pos", F.col("digest").alias("subroot")).join(proofs, "pos")
    trees = save(trees.select("tree", F.lit(0).cast("long").alias("block"), "proof", "sides", "subroot"), "merkle-trees")
    outer = _proven(levels, trees.drop("subroot"), height)
    # A superblock's proof comes with its tree's subroot, again joined by size.
    outer = outer.join(trees.select("tree", "subroot"), "tree")

    def finish(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows, top = rows.sort_values("pos"), above.iloc[0]
        found = [(p + top.proof, s + top.sides) for p, s in _proofs(_grown(rows, key[1], height))]
        stated = rows["claim"].where(rows["claim"].notna(), rows["digest"])
        return pd.DataFrame(
            {
                "doc_id": rows["doc_id"].astype("Int64"),
                "leaf": rows["digest"],
                "subroot": top.subroot,
                "root": root,
                "proof": [p for p, _ in found],
                "sides": [s for _, s in found],
                "folded_root": [fold(d, p, s) for d, (p, s) in zip(stated, found, strict=True)],
            }
        )

    block = F.shiftright("pos", height).alias("block")
    out = nodes.groupBy("tree", block).cogroup(outer.groupBy("tree", "block")).applyInPandas(finish, _LEAF)
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def off_by_one(docs_id: str = "doc_id", count_col: str = "n_chars", every: int = 7) -> Column:
    """The leaf that a tampered copy would state: where ``every`` divides the CRC32 of the id, its count is one more.
    Null elsewhere, and where id or count is null."""
    values = [F.col(c) + F.lit(1) if c == count_col else F.col(c) for c in FIELDS]
    hit = F.crc32(F.col(docs_id).cast("string").cast("binary")) % every == 0
    return F.when(hit & F.col(count_col).isNotNull(), leaf(values))


#: Levels of all trees by recursion, then each row's siblings on its way up. A null language sorts first as ''.
SQL = """
WITH RECURSIVE rows_ AS (
  SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS tree, n_chars,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM documents
), crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) r(i)
  )
), hit AS (
  SELECT doc_id, xor(list_reduce(
    list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 7 = 0 AS hit
  FROM (SELECT DISTINCT doc_id FROM documents), crc_table
), leaves AS (
  SELECT r.doc_id, tree, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS h,
    CASE WHEN hit AND n_chars IS NOT NULL THEN sha256(head || strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1) || tail) ELSE h END AS stated
  FROM rows_ r LEFT JOIN hit ON r.doc_id = hit.doc_id
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM leaves
), up AS (
  SELECT tree, 0 AS lvl, pos, h, count(*) OVER (PARTITION BY tree) AS n FROM placed
  UNION ALL
  SELECT tree, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 1) // 2) FROM up WHERE n > 1 GROUP BY tree, lvl, pos // 2
), subroots AS (
  SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS pos FROM up WHERE n = 1
), top AS (
  SELECT 0 AS lvl, pos, h, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 1) // 2) FROM top WHERE n > 1 GROUP BY lvl, pos // 2
), way AS (
  SELECT doc_id, tree, 0 AS phase, 0 AS lvl, pos, '' AS proof, h AS leaf, stated AS folded FROM placed
  UNION ALL
  SELECT w.doc_id, w.tree, CASE WHEN w.phase = 0 AND u.n = 1 THEN 1 ELSE w.phase END, CASE WHEN w.phase = 0 AND u.n = 1 THEN 0 ELSE w.lvl + 1 END,
    CASE WHEN w.phase = 0 AND u.n = 1 THEN r.pos ELSE w.pos // 2 END,
    CASE WHEN u.n = 1 THEN w.proof ELSE w.proof || coalesce(s.h, '') END, w.leaf,
    CASE WHEN u.n = 1 THEN w.folded WHEN w.pos % 2 = 1 THEN sha256(s.h || w.folded) ELSE sha256(w.folded || coalesce(s.h, '')) END
  FROM way w
  JOIN (SELECT 0 AS phase, tree, lvl, pos, n FROM up UNION ALL SELECT 1, NULL, lvl, pos, n FROM top WHERE n > 1) u
    ON u.phase = w.phase AND (u.tree = w.tree OR w.phase = 1) AND u.lvl = w.lvl AND u.pos = w.pos
  LEFT JOIN (SELECT 0 AS phase, tree, lvl, pos, h FROM up UNION ALL SELECT 1, NULL, lvl, pos, h FROM top) s
    ON s.phase = w.phase AND (s.tree = w.tree OR w.phase = 1) AND s.lvl = w.lvl AND s.pos = xor(w.pos, 1)
  JOIN subroots r ON r.tree = w.tree
), ends AS (
  SELECT w.* FROM way w WHERE w.phase = 1 AND w.lvl = (SELECT max(lvl) FROM top)
)
SELECT e.doc_id, e.leaf, r.h AS subroot, o.h AS root, sha256(e.proof) AS proof_sha256, e.folded AS folded_root, e.folded = o.h AS verified
FROM ends e JOIN subroots r USING (tree), (SELECT h FROM top WHERE n = 1) o
"""
