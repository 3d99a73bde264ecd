"""Operator 12: a Merkle manifest of a table, with octopus multiproofs.

Every row is a leaf, the SHA-256 of its fields with their lengths. Each source is a tree over its leaves in ascending
doc_id; a node hashes up to ``ARITY`` neighbours of the level below. The trees' roots, in the order of their sources,
are the leaves of one more tree (``TOP``), whose root names the whole table. Aligned blocks of ``ARITY ** HEIGHT``
nodes are hashed at once, ``HEIGHT`` levels up, until one node is left.

Proofs are made for leaf partitions of ``PART`` neighbours. A partition works out which nodes its proofs need and its
own leaves do not give: per level, the siblings of the nodes on its paths that are not on a path themselves (the
smallest such union). They are fetched by one join on their coordinates; the partition then hashes the nodes that its
proofs share and spells out the proof of each leaf.

Defined cases: a null field is ``-``, so null and empty texts differ; a null doc_id comes first, a null source is a
tree of its own and the first; rows that share source and doc_id are ordered by their leaves, equal rows among
themselves in any order; a text of any length is hashed whole; a lone leaf is the root of its tree; an empty table has
no root and no rows. Extra columns are not part of the leaf. Rows without doc_id are never tampered with.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.llm.bits import maybe_in
from skyloom.llm.text import blocks
from skyloom.operators.skew import null_safe_join, number_in_group, number_rows
from skyloom.session import store

ARITY = 3
HEIGHT = 8  # levels that one block is hashed up
PART = 5000  # leaves in a leaf partition
TOP = -1  # the tree over the trees' roots
_ROWS_AT_ONCE = 1 << 15
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(text: Column | None = None) -> Column:
    """The leaf of a row of documents, with another ``text`` if given."""
    parts = [_field(text if text is not None and c == "text" else F.col(c)) for c in FIELDS]
    return F.sha2(F.concat(*parts), 256)


def level_sizes(n: int) -> list[int]:
    """How many nodes the levels of a tree over ``n`` leaves have, from the leaves to the root."""
    sizes = [n]
    while sizes[-1] > 1:
        sizes.append(-(-sizes[-1] // ARITY))
    return sizes


def missing_nodes(leaves: np.ndarray, n: int) -> list[tuple[int, int]]:
    """(level, index) of the nodes that proofs of ``leaves`` (sorted) need and that do not follow from them."""
    out, on_path = [], np.asarray(leaves, np.int64)
    for level, size in enumerate(level_sizes(n)[:-1]):
        parents = np.unique(on_path // ARITY)
        run = (parents[:, None] * ARITY + np.arange(ARITY)).ravel()
        needed = np.setdiff1d(run[run < size], on_path, assume_unique=True)
        out += [(level, int(i)) for i in needed]
        on_path = parents
    return out


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _grow(height: int):
    """All nodes up to ``height`` levels above rows (block, tree, level, index, size, digest); ``size``: nodes in the row's level."""

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches, "block", lambda b: b.num_rows, _ROWS_AT_ONCE):
            tree, level, index, size = (table.column(c).to_numpy() for c in ("tree", "level", "index", "size"))
            digests = table.column("digest").to_pylist()
            order = np.lexsort((index, tree))
            tree, level, index, size = tree[order], level[order], index[order], size[order]
            digests = [digests[i] for i in order.tolist()]
            for _ in range(height):
                live = np.flatnonzero(size > 1)
                if not len(live):
                    break
                tree, level, size = tree[live], level[live], size[live]
                parent = index[live] // ARITY
                new = np.ones(len(live), bool)
                new[1:] = (parent[1:] != parent[:-1]) | (tree[1:] != tree[:-1])
                heads = np.flatnonzero(new)
                held = [digests[i] for i in live.tolist()]
                digests = [_digest("".join(held[a:b])) for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(held)])]
                tree, level, index, size = tree[heads], level[heads] + 1, parent[heads], -(-size[heads] // ARITY)
                yield pa.RecordBatch.from_arrays([*map(pa.array, (tree, level, index, size)), pa.array(digests, pa.string())], names=["tree", "level", "index", "size", "digest"])

    return grow


_NODE = "tree long, level int, index long, size long, digest string"


def tree_nodes(leaves: DataFrame) -> DataFrame:
    """tree, level, index, size, digest of all nodes above ``leaves`` (the same columns, level 0); stored."""
    largest = leaves.agg(F.max("size")).first()[0] or 0
    out, rows = None, leaves.select("tree", "level", "index", "size", "digest")
    for low in range(0, len(level_sizes(largest)) - 1, HEIGHT):
        block = F.xxhash64("tree", F.floor(F.col("index") / F.lit(ARITY ** HEIGHT)))
        blocked = rows.filter("size > 1").withColumn("block", block).repartition("block").sortWithinPartitions("block")
        grown = store(blocked.mapInArrow(_grow(HEIGHT), _NODE))
        out = grown if out is None else out.unionByName(grown)
        rows = grown.filter(F.col("level") == low + HEIGHT)
    return out if out is not None else rows.filter("size > 1")


@dataclass
class Manifest:
    """leaves: tree, index, size, doc_id, leaf, tampered; trees: tree, source, size, subroot; nodes: tree, level, index, size, digest."""

    leaves: DataFrame
    trees: DataFrame
    nodes: DataFrame
    root: str | None


def build(docs: DataFrame) -> Manifest:
    """The manifest of ``docs`` (doc_id, source, lang, n_chars, text); texts are hashed in one scan and not moved."""
    text = F.col("text").cast("string")
    fewer = F.replace(text, F.lit("\n"), F.lit(""))
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), leaf_hash().alias("leaf"),
                       F.when(even & text.contains("\n"), leaf_hash(fewer)).alias("tampered"), F.monotonically_increasing_id().alias("_tie"))
    rows = store(rows)
    counted = rows.groupBy("source").agg(F.count(F.lit(1)).alias("size"))
    trees = store(number_rows(counted, F.col("source").asc_nulls_first(), name="tree"))
    placed = null_safe_join(rows, trees, ["source"])
    leaves = number_in_group(placed.drop("source"), ["tree"], ["doc_id", "leaf", "_tie"], "index")
    leaves = store(leaves.select("tree", (F.col("index") - 1).alias("index"), "size", "doc_id", "leaf", "tampered"))
    bottom = leaves.select("tree", F.lit(0).alias("level"), "index", "size", F.col("leaf").alias("digest"))
    nodes = bottom.unionByName(tree_nodes(bottom))
    roots = nodes.filter("size = 1").select("tree", F.col("digest").alias("subroot"))
    trees = store(trees.join(roots, "tree"))
    n = trees.count()
    top = trees.select(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("index"),
                       F.lit(n).cast("long").alias("size"), F.col("subroot").alias("digest"))
    top = top.unionByName(tree_nodes(top))
    first = top.filter("size = 1").select("digest").first()
    return Manifest(leaves, trees, nodes.unionByName(top), first[0] if first else None)


def _wanted(n_trees: int):
    def missing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches, "key", lambda b: b.num_rows, _ROWS_AT_ONCE):
            found = []
            key, tree, part, size, index = (table.column(c).to_numpy() for c in ("key", "tree", "part", "size", "index"))
            for a, b in _cuts(table):
                mine = (int(key[a]), int(tree[a]), int(part[a]))
                found += [(*mine, int(tree[a]), *node) for node in missing_nodes(np.unique(index[a:b]), int(size[a]))]
                found += [(*mine, TOP, *node) for node in missing_nodes(tree[a:a + 1], n_trees)]
            columns = list(zip(*found)) or [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["key", "tree", "part", "of", "level", "index"])

    return missing


def _cuts(table: pa.Table) -> list[tuple[int, int]]:
    """Runs of rows of one partition in a table sorted by key, tree, part."""
    columns = [table.column(c).to_numpy() for c in ("key", "tree", "part")]
    new = np.ones(table.num_rows, bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    heads = np.flatnonzero(new).tolist()
    return list(zip(heads, [*heads[1:], table.num_rows]))


def _paths(known: list[dict[int, str]], own: set[int], sizes: list[int]) -> dict[int, tuple[list[str], list[str]]]:
    """(left, right) siblings of each leaf in ``own``, level by level; shared nodes are hashed into ``known`` once."""
    on_path = [own]
    for level, size in enumerate(sizes[:-1]):
        parents = {i // ARITY for i in on_path[-1]}
        for p in parents:
            known[level + 1][p] = _digest("".join(known[level][c] for c in range(p * ARITY, min(p * ARITY + ARITY, size))))
        on_path.append(parents)
    above: dict[int, tuple[list[str], list[str]]] = {0: ([], [])}
    for level in range(len(sizes) - 2, -1, -1):
        here, size = known[level], sizes[level]
        below = {}
        for i in on_path[level]:
            p = i // ARITY
            left, right = above[p]
            first, end = p * ARITY, min(p * ARITY + ARITY, size)
            below[i] = (["".join(here[c] for c in range(first, i)), *left], ["".join(here[c] for c in range(i + 1, end)), *right])
        above = below
    return above


def _expand(n_trees: int):
    top_sizes = level_sizes(n_trees)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches, "key", lambda b: b.num_rows, _ROWS_AT_ONCE):
            of, level, index, size, tree = (table.column(c).to_numpy(zero_copy_only=False) for c in ("of", "level", "index", "size", "tree"))
            digest = table.column("digest").to_pylist()
            left, right, subroots, rows = [], [], [], []
            for a, b in _cuts(table):
                mine, sizes = int(tree[a]), level_sizes(int(size[a:b].max()))
                known: list[dict[int, str]] = [{} for _ in sizes]
                over: list[dict[int, str]] = [{} for _ in top_sizes]
                leaves = []
                for r in range(a, b):
                    if size[r] > 0:
                        leaves.append(r)
                    (over if of[r] == TOP else known)[level[r]][int(index[r])] = digest[r]
                paths = _paths(known, {int(index[r]) for r in leaves}, sizes)
                subroot = known[-1][0]
                over[0][mine] = subroot
                up = _paths(over, {mine}, top_sizes)[mine]
                rows += leaves
                subroots += [subroot] * len(leaves)
                left += [paths[int(index[r])][0] + up[0] for r in leaves]
                right += [paths[int(index[r])][1] + up[1] for r in leaves]
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([
                *(table.column(c).take(at).combine_chunks() for c in ("doc_id", "digest", "tampered")), pa.array(subroots, pa.string()),
                pa.array(left, pa.list_(pa.string())), pa.array(right, pa.list_(pa.string())),
            ], names=["doc_id", "leaf", "tampered", "subroot", "left", "right"])

    return expand


def proofs(manifest: Manifest, leaves: DataFrame | None = None) -> DataFrame:
    """doc_id, leaf, tampered, subroot, left, right: the proof of each of ``leaves`` (rows of ``manifest.leaves``; all of them if none are given).

    ``left[k]`` and ``right[k]`` are the digests before and behind the node of the leaf's path in its run on level k,
    through the tree of its source and then through the tree over the sources.
    """
    n_trees = manifest.trees.count()
    chosen = (manifest.leaves if leaves is None else leaves).withColumn("part", F.floor(F.col("index") / PART))
    chosen = chosen.withColumn("key", F.xxhash64("tree", "part"))
    spread = chosen.select("key", "tree", "part", "size", "index").repartition("key").sortWithinPartitions("key", "tree", "part")
    needed = store(spread.mapInArrow(_wanted(n_trees), "key long, tree long, part long, of long, level int, index long"))
    place = F.xxhash64("of", "level", "index")
    nodes = manifest.nodes.select(F.col("tree").alias("of"), "level", "index", "digest").filter(maybe_in(needed, place, place))
    none = F.lit(None)
    fetched = needed.join(nodes, ["of", "level", "index"]).select(
        "key", "tree", "part", "of", "level", "index", F.lit(0).cast("long").alias("size"), "digest", none.cast("long").alias("doc_id"), none.cast("string").alias("tampered"))
    own = chosen.select("key", "tree", "part", F.col("tree").alias("of"), F.lit(0).alias("level"), "index", "size", F.col("leaf").alias("digest"), "doc_id", "tampered")
    together = own.unionByName(fetched).repartition("key").sortWithinPartitions("key", "tree", "part")
    return together.mapInArrow(_expand(n_trees), "doc_id long, leaf string, tampered string, subroot string, left array<string>, right array<string>")


def folded(leaf: Column, left: Column, right: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    steps = F.zip_with(left, right, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.aggregate(steps, leaf, lambda node, s: F.sha2(F.concat(s["a"], node, s["b"]), 256))


def manifest_proofs(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row of ``docs``."""
    manifest = build(docs)
    found = proofs(manifest)
    siblings = F.array_join(F.zip_with("left", "right", lambda a, b: F.concat(a, b)), "")
    root = F.lit(manifest.root).cast("string")
    shown = found.select("doc_id", "leaf", "subroot", root.alias("root"), F.sha2(siblings, 256).alias("proof_sha256"),
                         folded(F.coalesce("tampered", "leaf"), F.col("left"), F.col("right")).alias("folded_root"))
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))


def _nibble(value: int) -> int:
    for _ in range(4):
        value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
    return value


#: the checksum's table for four bits at a time
_TABLE = "[" + ", ".join(f"{_nibble(i)}::BIGINT" for i in range(16)) + "]"
_CRC = (f"xor(list_reduce(list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT for c in string_split(doc_id::VARCHAR, '')]), "
        f"lambda c, b: xor(xor(xor(c, b) >> 4, {_TABLE}[(xor(c, b) & 15) + 1]) >> 4, "
        f"{_TABLE}[(xor(xor(c, b) >> 4, {_TABLE}[(xor(c, b) & 15) + 1]) & 15) + 1])), 4294967295)")


def _sql_field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR END"


def _sql_leaf(text: str = "text") -> str:
    return "sha256(" + " || ".join(_sql_field(text if c == "text" else c) for c in FIELDS) + ")"


def _sql_tree(name: str, leaves: str) -> str:
    """Nodes (source, lvl, i, n, h) of trees over ``leaves`` and, per node, its siblings on both sides."""
    return f"""{name}(source, lvl, i, n, h) AS ({leaves} UNION ALL
  SELECT source, lvl + 1, i // 3, any_value((n + 2) // 3), sha256(string_agg(h, '' ORDER BY i)) FROM {name} WHERE n > 1 GROUP BY source, lvl, i // 3),
{name}_steps AS (SELECT x.source, x.lvl, x.i, coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (y.i < x.i), '') || '|' ||
    coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (y.i > x.i), '') AS step
  FROM {name} x JOIN {name} y ON x.source IS NOT DISTINCT FROM y.source AND x.lvl = y.lvl AND x.i // 3 = y.i // 3 WHERE x.n > 1 GROUP BY ALL)"""


_CHANGED = "replace(text, chr(10), '')"
_FEWER = _sql_leaf(_CHANGED)
#: every node of every tree and every path, in DuckDB, over the table ``documents``
ORACLE = f"""
WITH RECURSIVE l AS (SELECT doc_id, source, {_sql_leaf()} AS leaf, CASE WHEN {_CRC} % 2 = 0 THEN {_FEWER} ELSE {_sql_leaf()} END AS shown FROM documents),
b AS (SELECT *, row_number() OVER () AS rid, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n FROM l),
{_sql_tree("low", "SELECT source, 0, pos, n, leaf FROM b")},
trees AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1),
{_sql_tree("up", "SELECT 'top', 0, pos, n, subroot FROM trees")},
root AS (SELECT h AS root FROM up WHERE n = 1),
paths AS (SELECT rid, list(step ORDER BY lvl) AS steps FROM b JOIN low_steps s ON b.source IS NOT DISTINCT FROM s.source AND s.i = pos // CAST(pow(3, lvl) AS BIGINT) GROUP BY rid),
tops AS (SELECT t.source, list(step ORDER BY lvl) AS steps FROM trees t JOIN up_steps s ON s.i = t.pos // CAST(pow(3, lvl) AS BIGINT) GROUP BY t.source),
p AS (SELECT b.doc_id, b.leaf, b.shown, t.subroot, root, list_concat(coalesce(paths.steps, []), coalesce(tops.steps, [])) AS steps
  FROM b JOIN trees t ON b.source IS NOT DISTINCT FROM t.source CROSS JOIN root LEFT JOIN paths USING (rid) LEFT JOIN tops ON b.source IS NOT DISTINCT FROM tops.source),
f AS (SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(steps, ''), '|', '')) AS proof_sha256,
  list_reduce(list_prepend(shown, steps), lambda a, s: sha256(string_split(s, '|')[1] || a || string_split(s, '|')[2])) AS folded_root FROM p)
SELECT *, folded_root = root AS verified FROM f
"""
