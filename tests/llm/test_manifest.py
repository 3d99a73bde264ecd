"""The Merkle manifest against plain hashing, with partial proofs and trees of every small size."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.llm import manifest
from skyloom.session import ship_package

TINY = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, source string, lang string, n_chars int, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    fields = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields))


def climb(leaves):
    """(root, the (left, right) siblings of each leaf level by level)."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for leaf, i in enumerate(at):
            first = i // 3 * 3
            paths[leaf].append((level[first:i], level[i + 1:first + 3]))
        at = [i // 3 for i in at]
        level = [sha("".join(level[i:i + 3])) for i in range(0, len(level), 3)]
    return level[0], paths


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r.source].append((-1 if r.doc_id is None else r.doc_id, leaf_of(r, r.text), r))
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subroots, below = [], {}
    for s in sources:
        groups[s].sort(key=lambda x: x[:2])
        root, below[s] = climb([x[1] for x in groups[s]])
        subroots.append(root)
    root, above = climb(subroots)
    out = []
    for s, subroot, up in zip(sources, subroots, above):
        for (_, leaf, r), path in zip(groups[s], below[s]):
            even = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0
            node = leaf_of(r, r.text.replace("\n", "")) if even and r.text is not None else leaf
            for left, right in path + up:
                node = sha("".join([*left, node, *right]))
            proof = sha("".join(x for left, right in path + up for x in [*left, *right]))
            out.append((r.doc_id, leaf, subroot, root, proof, node, node == root))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


@pytest.mark.parametrize("height,part", [(manifest.HEIGHT, manifest.PART), (1, 4), (2, 7)])
def test_whole_table(spark, monkeypatch, height, part):
    ship_package(spark)
    monkeypatch.setattr(manifest, "HEIGHT", height)
    monkeypatch.setattr(manifest, "PART", part)
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    got = rows_of(manifest.manifest_proofs(docs))
    assert got == brute(docs.collect()) and {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 10, 28])
def test_small_trees_and_odd_rows(spark, monkeypatch, n):
    ship_package(spark)
    monkeypatch.setattr(manifest, "PART", 5)
    rows = [(i, "hot", "en", i, f"line {i}\nnext é") for i in range(n)]
    rows += [(n + i, f"s{i}", None, None, None if i % 2 else "") for i in range(n)]
    rows += [(None, None, None, None, "a\nb"), (None, None, None, None, "a\nb"), (5, "hot", "en", 5, "again\n"), (-4, "", "x", -1, "\n"), (1 << 40, "é", "x", 0, "漢\n字")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = rows_of(manifest.manifest_proofs(docs.withColumns({"tree": F.lit(1), "leaf": F.lit("x"), "key": F.lit(2)})))
    assert got == brute(docs.collect())


def test_no_rows(spark):
    ship_package(spark)
    empty = spark.createDataFrame([], SCHEMA)
    assert manifest.manifest_proofs(empty).count() == 0 and manifest.build(empty).root is None


def test_proofs_of_some_leaves(spark, monkeypatch):
    """A partition of scattered leaves fetches the smallest union of nodes, and its proofs hold."""
    ship_package(spark)
    docs = spark.createDataFrame([(i, "ab"[i % 2], "en", i, f"t{i}") for i in range(400)], SCHEMA)
    built = manifest.build(docs)
    some = built.leaves.filter("doc_id % 7 = 3 or doc_id between 50 and 60")
    found = manifest.proofs(built, some)
    checked = found.select("doc_id", manifest.folded(F.col("leaf"), F.col("left"), F.col("right")).alias("root")).collect()
    assert sorted(r.doc_id for r in checked) == [i for i in range(400) if i % 7 == 3 or 50 <= i <= 60]
    assert {r.root for r in checked} == {built.root}


@pytest.mark.parametrize("n", [1, 2, 9, 100, 244])
def test_missing_nodes_are_the_smallest_union(n):
    rng = np.random.default_rng(n)
    for k in {1, min(5, n), n // 2 + 1}:
        leaves = np.sort(rng.choice(n, k, replace=False))
        sizes = manifest.level_sizes(n)
        needed, path = set(), set(leaves.tolist())
        for level, size in enumerate(sizes[:-1]):
            siblings = {c for i in path for c in range(i // 3 * 3, min(i // 3 * 3 + 3, size))}
            needed |= {(level, c) for c in siblings - path}
            path = {i // 3 for i in path}
        assert sorted(manifest.missing_nodes(leaves, n)) == sorted(needed)
