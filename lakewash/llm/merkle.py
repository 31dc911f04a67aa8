"""Merkle manifest of a table, and proofs of its rows by octopus multiproofs.

Every row is a leaf. Leaves of a group, in order, form a binary tree (a last
node without a partner is hashed alone); the groups' roots, in order of the
group, form the tree above them. The manifest keeps all nodes as a table.

* Trees are built in rounds: a round takes blocks of up to 4,096 consecutive
  nodes, builds the 12 levels above each block in one task, and hands the
  blocks' tops to the next round. A group of any size is cut into blocks, so
  a group that holds a third of all rows is no task of its own.
* A proof is made for each block of wanted leaves. The block first computes
  which nodes it lacks: the union, over its leaves, of siblings that it can
  neither hold nor derive. These coordinates are joined to the nodes once;
  the block then derives the interior nodes that its leaves share, and reads
  every leaf's own proof off them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewash.llm.common import only, staged, table
from lakewash.operators.ids import key_text, with_surrogate_key

#: Levels that one task builds: a block has up to 2^12 nodes.
BLOCK_LEVELS = 12
#: The tree over the groups' roots; the trees of groups have longer names.
TOP = ""

NODE = "tree string, n long, level int, idx long, digest string"
STEP = "array<struct<left: boolean, digest: string>>"


def digest_of(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field_text(c: Column) -> Column:
    """A value as a leaf holds it: its UTF-8 byte count, ``:`` and itself, or
    ``-`` for null."""
    text = c.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*fields: Column) -> Column:
    return F.sha2(F.concat(*[field_text(c) for c in fields]), 256)


def tree_height(n: int) -> int:
    return max(n - 1, 0).bit_length()


def _height(n: Column) -> Column:
    """:func:`tree_height` as a column."""
    return F.when(n <= 1, F.lit(0)).otherwise(F.length(F.bin(n - 1)))


@dataclass
class Manifest:
    """``leaves``: tree, n, pos, rank (of the tree), leaf and carried columns;
    ``nodes``: every node by tree, level and idx; ``trees``: how many groups;
    ``root``: None for an empty table."""

    leaves: DataFrame
    nodes: DataFrame
    trees: int
    root: str | None


def _grow(base: int):
    """Levels above one block of nodes of level ``base``."""
    def grow(block: pa.Table) -> pa.Table:
        block = block.sort_by("idx")
        tree, n, at = block["tree"][0].as_py(), block["n"][0].as_py(), block["idx"][0].as_py()
        nodes, out = block["digest"].to_pylist(), []
        for level in range(base + 1, min(base + BLOCK_LEVELS, tree_height(n)) + 1):
            nodes = [digest_of(nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
            at >>= 1
            out += [(level, at + i, d) for i, d in enumerate(nodes)]
        level, idx, digest = map(list, zip(*out)) if out else ([], [], [])
        return pa.table({"tree": pa.array([tree] * len(out), pa.string()), "n": pa.array([n] * len(out), pa.int64()),
                         "level": pa.array(level, pa.int32()), "idx": pa.array(idx, pa.int64()),
                         "digest": pa.array(digest, pa.string())})
    return grow


def _nodes_above(leaves: DataFrame, most: int, label: str) -> DataFrame:
    """The nodes above ``leaves`` (columns of NODE at level 0), a staged table
    for each round; ``most`` is the size of the largest tree."""
    found, base, rows = None, 0, leaves
    while base < tree_height(most):
        block = F.shiftright("idx", BLOCK_LEVELS).alias("block")
        # one node is no work: a tree that ended below is left out
        made = staged(rows.where(_height(F.col("n")) > base).groupBy("tree", block).applyInArrow(_grow(base), NODE),
                      f"{label}-{base}")
        found = made if found is None else found.unionByName(made)
        base += BLOCK_LEVELS
        rows = made.where(F.col("level") == base)
    return found if found is not None else leaves.limit(0)


def manifest(docs: DataFrame, fields: Sequence[str], group: str, order: str,
             carry: Mapping[str, Column] | None = None) -> Manifest:
    """The manifest of a table.

    A leaf is the digest of ``fields``; leaves of a ``group`` ascend by
    ``order`` (nulls first) and, where that ties, by their digest, so equal
    rows may change places and nothing else; groups ascend bytewise, null
    first. ``carry`` names further columns, over those of ``docs``, that leaves
    keep. Texts are read once; whatever their length, a leaf is one digest.
    """
    spark = docs.sparkSession
    carry = carry or {}
    own = docs.select(F.col(f"`{group}`").cast("string").alias("_group"), F.col(f"`{order}`").alias("_order"),
                      leaf_digest(*[F.col(f"`{c}`") for c in fields]).alias("leaf"),
                      *[c.alias(name) for name, c in carry.items()])
    at = with_surrogate_key(own, ["_group", "_order", "leaf"], "_at", start=0)
    at = staged(at, "merkle-order")
    groups = at.groupBy("_group").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("n"))
    groups = staged(with_surrogate_key(groups, ["_group"], "rank", start=0)
                    .select(key_text("_group").alias("tree"), "_first", "n", "rank"), "merkle-groups")
    size = groups.agg(F.count(F.lit(1)).alias("trees"), F.max("n").alias("most")).first()
    leaves = staged(at.withColumn("tree", key_text("_group")).join(groups, "tree").select(
        "tree", "n", (F.col("_at") - F.col("_first")).alias("pos"), "rank", "leaf", *carry), "merkle-leaves")
    level = leaves.select("tree", "n", F.lit(0).alias("level"), F.col("pos").alias("idx"), F.col("leaf").alias("digest"))
    nodes = level.unionByName(_nodes_above(level, size.most or 0, "merkle-nodes"))
    ends = nodes.where(F.col("level") == _height(F.col("n"))).join(groups.select("tree", "rank"), "tree")
    top = staged(ends.select(F.lit(TOP).alias("tree"), F.lit(size.trees).cast("long").alias("n"), F.lit(0).alias("level"),
                             F.col("rank").alias("idx"), "digest"), "merkle-top")
    above = top.unionByName(_nodes_above(top, size.trees, "merkle-top-nodes"))
    root = above.where(F.col("level") == tree_height(size.trees)).first()
    return Manifest(leaves, nodes.unionByName(above), size.trees, root.digest if root else None)


def lacking(held: Sequence[int], n: int) -> list[tuple[int, int]]:
    """The nodes (level, idx) that leaves ``held`` of a tree of ``n`` need from
    elsewhere, and no others: siblings that are neither held nor derived."""
    out, level, known, count = [], 0, set(held), n
    while count > 1:
        out += [(level, i ^ 1) for i in sorted(known) if i ^ 1 < count and i ^ 1 not in known]
        known = {i >> 1 for i in known}
        level, count = level + 1, (count + 1) // 2
    return out


def _coordinates(trees: int):
    def coordinates(key: tuple[pa.Scalar, ...], block: pa.Table) -> pa.Table:
        tree, at = key[0].as_py(), key[1].as_py()
        need = [(tree, *c) for c in lacking(block["pos"].to_pylist(), block["n"][0].as_py())]
        need += [(TOP, *c) for c in lacking([block["rank"][0].as_py()], trees)]
        of, level, idx = map(list, zip(*need)) if need else ([], [], [])
        return pa.table({"of": pa.array([tree] * len(need), pa.string()), "block": pa.array([at] * len(need), pa.int64()),
                         "tree": pa.array(of, pa.string()), "level": pa.array(level, pa.int32()),
                         "idx": pa.array(idx, pa.int64())})
    return coordinates


def _derived(held: dict[int, str], fetched: dict[tuple[int, int], str], n: int) -> list[dict[int, str]]:
    """Level by level, all nodes that the held leaves and fetched nodes give."""
    levels, count = [], n
    while True:
        row = dict(held)
        row.update({i: d for (level, i), d in fetched.items() if level == len(levels)})
        levels.append(row)
        if count <= 1:
            return levels
        held = {p: digest_of([row[i] for i in (2 * p, 2 * p + 1) if i < count]) for p in {i >> 1 for i in held}}
        count = (count + 1) // 2


def _steps(levels: list[dict[int, str]], at: int) -> list[dict]:
    """One leaf's way up: its sibling on each level, null where it has none."""
    out = []
    for row in levels[:-1]:
        out.append({"left": bool(at & 1), "digest": row.get(at ^ 1)})
        at >>= 1
    return out


def _expand(trees: int):
    def expand(wanted: pa.Table, fetched: pa.Table) -> pa.Table:
        n, rank, places = wanted["n"][0].as_py(), wanted["rank"][0].as_py(), wanted["pos"].to_pylist()
        own, top = {}, {}
        for of, level, idx, digest in zip(*(fetched[c].to_pylist() for c in ("tree", "level", "idx", "digest"))):
            (top if of == TOP else own)[level, idx] = digest
        levels = _derived(dict(zip(places, wanted["leaf"].to_pylist())), own, n)
        upper = _derived({rank: levels[-1][0]}, top, trees)
        rest = _steps(upper, rank)
        step = pa.list_(pa.struct([("left", pa.bool_()), ("digest", pa.string())]))
        return (wanted.append_column("subroot", pa.array([levels[-1][0]] * len(places), pa.string()))
                .append_column("root", pa.array([upper[-1][0]] * len(places), pa.string()))
                .append_column("proof", pa.array([_steps(levels, at) + rest for at in places], step)))
    return expand


def prove(made: Manifest, wanted: DataFrame) -> DataFrame:
    """``wanted`` rows of ``made.leaves`` with ``subroot``, ``root`` and
    ``proof``: for each level up to the root, on which side the sibling stands
    and its digest (null where the node is hashed alone). Subroot and root are
    those that the block derives from its leaves and the fetched nodes."""
    blocks = wanted.withColumn("block", F.shiftright("pos", BLOCK_LEVELS))
    need = blocks.select("tree", "block", "pos", "n", "rank").groupBy("tree", "block").applyInArrow(
        _coordinates(made.trees), "of string, block long, tree string, level int, idx long")
    fetched = need.join(made.nodes, ["tree", "level", "idx"]).select("of", "block", "tree", "level", "idx", "digest")
    schema = T.StructType([*blocks.schema.fields, *T.StructType.fromDDL(
        f"subroot string, root string, proof {STEP}").fields])
    return blocks.groupBy("tree", "block").cogroup(fetched.groupBy("of", "block")).applyInArrow(
        _expand(made.trees), schema).drop("block")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give, hashed anew."""
    def up(h: Column, step: Column) -> Column:
        s = step["digest"]
        return F.sha2(F.when(s.isNull(), h).when(step["left"], F.concat(s, h)).otherwise(F.concat(h, s)), 256)
    return F.aggregate(proof, leaf, up)


def proof_digest(proof: Column) -> Column:
    """Digest of a proof's siblings, from the leaf up."""
    there = F.filter(F.transform(proof, lambda s: s["digest"]), lambda d: d.isNotNull())
    return F.sha2(F.array_join(there, ""), 256)


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def document_proofs(docs: DataFrame) -> DataFrame:
    """Every document's proof, checked against a copy of the table in which
    some documents were changed: where 7 divides the unsigned CRC-32 of the
    decimal doc_id, one is added to n_chars before the leaf is hashed again.

    ``(doc_id, leaf, subroot, root, proof, folded_root, verified)``. Nulls are
    values of a leaf like any other, and a null doc_id is never tampered with;
    repeated rows are leaves of their own; an empty table has no row; other
    columns are left out. A proof has as many steps as the trees have levels.
    """
    own = only(docs, *FIELDS)
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    other = F.when(hit, leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), more, F.col("text")))
    made = manifest(own, FIELDS, "lang", "doc_id", {"doc_id": F.col("doc_id"), "other": other})
    proved = prove(made, made.leaves)
    end = folded(F.coalesce("other", "leaf"), F.col("proof"))
    return (proved.withColumn("folded_root", end)
            .select("doc_id", "leaf", "subroot", "root", "proof", "folded_root",
                    (F.col("folded_root") == F.lit(made.root)).alias("verified")))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root, digest of the proof and outcome of the check, for
    all documents."""
    proofs = document_proofs(table(spark, sf_dir, "documents"))
    return proofs.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
                         "folded_root", "verified")


def _field_sql(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"


def _leaf_sql(n_chars: str) -> str:
    return f"sha256({' || '.join(_field_sql(c) for c in ['doc_id', 'source', 'lang', n_chars, 'text'])})"


# CRC-32 of a decimal number's characters, bit by bit (3988292384 is its
# reversed polynomial).
_BIT = "list_reduce([{x}, 0, 0, 0, 0, 0, 0, 0, 0], LAMBDA c, z: xor(c >> 1, 3988292384 * (c & 1)))"
_BYTES = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), LAMBDA s: CAST(ascii(s) AS BIGINT))"
_CRC = (f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {_BYTES}), LAMBDA a, b: "
        f"{_BIT.format(x='xor(a, b)')}), 4294967295)")

ORACLE = f"""
WITH RECURSIVE leaves AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('x' || lang, '') AS tree, leaf, other,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM (SELECT doc_id, lang, {_leaf_sql('n_chars')} AS leaf,
               CASE WHEN {_CRC} % 7 = 0 THEN {_leaf_sql('(n_chars + 1)')} END AS other FROM documents)),
nodes AS (
  SELECT tree, n, n AS c, 0 AS level, pos AS idx, leaf AS digest FROM leaves
  UNION ALL
  SELECT tree, n, (c + 1) // 2, level + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)) FROM nodes WHERE c > 1
  GROUP BY tree, n, c, level, idx // 2),
subroots AS (SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE c = 1),
upper AS (
  SELECT n, n AS c, 0 AS level, pos AS idx, digest FROM subroots
  UNION ALL
  SELECT n, (c + 1) // 2, level + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)) FROM upper WHERE c > 1
  GROUP BY n, c, level, idx // 2),
steps AS (
  SELECT l.rid, a.level AS step, (l.pos >> a.level) & 1 AS side, s.digest
  FROM leaves l JOIN (SELECT DISTINCT tree, level FROM nodes WHERE c > 1) a ON a.tree = l.tree
  LEFT JOIN nodes s ON s.tree = l.tree AND s.level = a.level AND s.idx = xor(l.pos >> a.level, 1)
  UNION ALL
  SELECT l.rid, 100 + a.level, (r.pos >> a.level) & 1, s.digest
  FROM leaves l JOIN subroots r ON r.tree = l.tree CROSS JOIN (SELECT DISTINCT level FROM upper WHERE c > 1) a
  LEFT JOIN upper s ON s.level = a.level AND s.idx = xor(r.pos >> a.level, 1)),
proofs AS (SELECT rid, string_agg(digest, '' ORDER BY step) AS joined, list([CAST(side AS VARCHAR), digest] ORDER BY step) AS way
           FROM steps GROUP BY rid),
fold AS (
  SELECT l.rid, 1 AS i, coalesce(l.other, l.leaf) AS h, p.way FROM leaves l LEFT JOIN proofs p ON p.rid = l.rid
  UNION ALL
  SELECT rid, i + 1, sha256(CASE WHEN way[i][2] IS NULL THEN h WHEN way[i][1] = '1' THEN way[i][2] || h ELSE h || way[i][2] END), way
  FROM fold WHERE i <= coalesce(len(way), 0))
SELECT l.doc_id, l.leaf, r.digest AS subroot, t.digest AS root, sha256(coalesce(p.joined, '')) AS proof_sha256,
  f.h AS folded_root, f.h = t.digest AS verified
FROM leaves l JOIN subroots r ON r.tree = l.tree CROSS JOIN (SELECT digest FROM upper WHERE c = 1) t
LEFT JOIN proofs p ON p.rid = l.rid JOIN fold f ON f.rid = l.rid AND f.i = coalesce(len(f.way), 0) + 1
"""
